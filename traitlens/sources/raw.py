"""Raw (bronze) profile records: schema, reading, flattening, load stamps.

SRC-1 read raw, SRC-3 stamp load metadata, PRJ-4 flatten nested structs.
The schema is explicit: no inference pass over the input at scale.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_RANGE = T.StructType([T.StructField("imperial", T.StringType()),
                       T.StructField("metric", T.StringType())])

# Nested record as landed from the API (one JSON object per profile).
NESTED_SCHEMA = T.StructType([
    T.StructField("id", T.LongType()),
    T.StructField("name", T.StringType()),
    T.StructField("bred_for", T.StringType()),
    T.StructField("breed_group", T.StringType()),
    T.StructField("life_span", T.StringType()),
    T.StructField("temperament", T.StringType()),
    T.StructField("origin", T.StringType()),
    T.StructField("country_code", T.StringType()),
    T.StructField("description", T.StringType()),
    T.StructField("history", T.StringType()),
    T.StructField("reference_image_id", T.StringType()),
    T.StructField("weight", _RANGE),
    T.StructField("height", _RANGE),
])

LOAD_COLUMNS = ("extracted_at", "extraction_date", "_dlt_load_id", "_dlt_id")

# Flattened bronze table: nested fields joined with a double underscore.
BRONZE_SCHEMA = T.StructType([
    T.StructField("id", T.LongType()),
    T.StructField("name", T.StringType()),
    T.StructField("bred_for", T.StringType()),
    T.StructField("breed_group", T.StringType()),
    T.StructField("weight__imperial", T.StringType()),
    T.StructField("weight__metric", T.StringType()),
    T.StructField("height__imperial", T.StringType()),
    T.StructField("height__metric", T.StringType()),
    T.StructField("life_span", T.StringType()),
    T.StructField("temperament", T.StringType()),
    T.StructField("origin", T.StringType()),
    T.StructField("country_code", T.StringType()),
    T.StructField("description", T.StringType()),
    T.StructField("history", T.StringType()),
    T.StructField("reference_image_id", T.StringType()),
    T.StructField("extracted_at", T.TimestampType()),
    T.StructField("extraction_date", T.StringType()),
    T.StructField("_dlt_load_id", T.StringType()),
    T.StructField("_dlt_id", T.StringType()),
])


def flatten(df: DataFrame, sep: str = "__") -> DataFrame:
    """Flatten nested struct columns to ``parent__child`` names (PRJ-4).

    Walks the schema, not the data: a pure projection, no shuffle.
    """
    def walk(dtype: T.DataType, path: list[str]) -> list[Column]:
        if isinstance(dtype, T.StructType):
            out: list[Column] = []
            for f in dtype.fields:
                out.extend(walk(f.dataType, path + [f.name]))
            return out
        ref = F.col(".".join(f"`{p}`" for p in path))
        return [ref.alias(sep.join(path))]

    cols: list[Column] = []
    for f in df.schema.fields:
        cols.extend(walk(f.dataType, [f.name]))
    return df.select(*cols)


def stamp(df: DataFrame, load_ts: _dt.datetime, load_id: str,
          row_id: Column | None = None) -> DataFrame:
    """Add load metadata from ONE timestamp taken once per load (SRC-3).

    ``extraction_date`` is the ISO date of that same instant, so the pair can
    never straddle midnight. ``row_id`` defaults to ``load_id-id``.
    """
    ts = F.lit(load_ts).cast("timestamp")
    rid = row_id if row_id is not None else F.concat_ws("-", F.lit(load_id), F.col("id").cast("string"))
    return df.withColumns({
        "extracted_at": ts,
        "extraction_date": F.date_format(ts, "yyyy-MM-dd"),
        "_dlt_load_id": F.lit(load_id),
        "_dlt_id": rid,
    })


def read_landed_json(spark: SparkSession, path: str) -> DataFrame:
    """Read landed API JSON (one object per line) with the explicit nested schema."""
    return spark.read.schema(NESTED_SCHEMA).json(path)


def file_system(spark: SparkSession, path: str) -> tuple:
    """(file system, path constructor) of the Hadoop client for ``path``, wherever it lies."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path
    return hadoop(path).getFileSystem(spark._jsc.hadoopConfiguration()), hadoop


def committed_versions(spark: SparkSession, path: str) -> list[str]:
    """Folders of a versioned table that have Spark's success marker, oldest first."""
    fs, hadoop = file_system(spark, path)
    done = fs.globStatus(hadoop(f"{path}/version=*/_SUCCESS")) or []
    return sorted(s.getPath().getParent().toString() for s in done)


def read_bronze(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """Read the flattened bronze table (SRC-1) with its explicit schema.

    Of a versioned table the newest committed version is read (a folder with
    Spark's success marker); the listing goes through the Hadoop file system.
    """
    newest = (committed_versions(spark, path) or [path])[-1]
    return spark.read.schema(BRONZE_SCHEMA).format(fmt).load(newest)


def nest(df: DataFrame, sep: str = "__") -> DataFrame:
    """Inverse of ``flatten`` for the two range structs: used to build nested inputs."""
    groups: dict[str, list[str]] = {}
    plain: list[str] = []
    for name in df.columns:
        if sep in name and not name.startswith("_"):
            parent, child = name.split(sep, 1)
            groups.setdefault(parent, []).append(child)
        else:
            plain.append(name)
    cols = [F.col(c) for c in plain]
    for parent, children in groups.items():
        cols.append(F.struct(*[F.col(f"{parent}{sep}{c}").alias(c) for c in children]).alias(parent))
    return df.select(*cols)
