"""Incremental ingest of landed raw JSON with Structured Streaming.

The source model loads on a schedule: fetch, stamp, archive, replace
bronze. Here each scheduled run is ``trigger(availableNow=True)``: the
stream picks up only files landed since the last run (tracked in the
checkpoint), oldest first, and stops. One landed file is one extract, one
micro-batch and one load: stamped with ONE timestamp, archived under its
date and load id (dynamic partition overwrite), and written as a new
version of the bronze table, so the newest extract is what readers see.

The stamp is the file's landing time, so a load replayed after a failure
gets the same stamp, archive folder and bronze version. The checkpoint must
be in a folder that all machines share.

An extract of several files is landed as a folder and then committed by a
manifest: a one-line JSON file ``{"extract": folder, "files": n}`` in a folder
of its own, written last. ``run_manifest_ingest`` streams over manifests, so one
extract of any number of files is one micro-batch, one load and one bronze
version, and an extract that has no manifest yet is never read.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from traitlens.sources.raw import NESTED_SCHEMA, file_system, flatten, read_landed_json, stamp
from traitlens.sources.sinks import archive_raw, drop_old_versions, replace_bronze


LANDED_AT = "_landed_at"


def landed_stream(spark: SparkSession, landing_dir: str, max_files: int | None = None) -> DataFrame:
    """Flattened streaming DataFrame over landed JSON files (explicit schema)."""
    reader = spark.readStream.schema(NESTED_SCHEMA)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    landed = reader.json(landing_dir).select("*", F.col("_metadata.file_modification_time").alias(LANDED_AT))
    return flatten(landed)


def shared_checkpoint(spark: SparkSession, name: str) -> str:
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        raise ValueError("name a shared checkpoint folder, or set spark.checkpoint.dir")
    return f"{shared.rstrip('/')}/{name}"


def run_ingest(spark: SparkSession, landing_dir: str, archive_dir: str, bronze_dir: str,
               checkpoint: str | None = None, load_prefix: str = "load", clock=None) -> int:
    """Process every newly landed file, then stop. Returns the number of loads.

    ``checkpoint`` defaults to a folder in spark.checkpoint.dir; without
    either it fails, for progress in a folder of one process would be lost.
    ``clock`` (a no-argument callable) overrides the landing-time stamp.
    """
    checkpoint = checkpoint or shared_checkpoint(spark, "traitlens-ingest")
    loads: list[int] = []

    def write_load(batch: DataFrame, batch_id: int) -> None:
        # one aggregated row: the landing time of this load's file
        ts = clock() if clock is not None else batch.agg(F.max(LANDED_AT)).first()[0]
        if ts is None:
            return  # an empty file
        loaded = stamp(batch.drop(LANDED_AT), ts, f"{load_prefix}-{batch_id}")
        archive_raw(loaded, archive_dir)
        replace_bronze(loaded, bronze_dir, version=batch_id)
        loads.append(batch_id)

    query = (landed_stream(spark, landing_dir, max_files=1).writeStream.foreachBatch(write_load)
             .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    query.awaitTermination()
    return len(loads)


def commit_extract(spark: SparkSession, landing_dir: str, extract: str, manifest_dir: str) -> int:
    """Write the manifest of a whole landed extract; returns its number of files.

    The manifest is created under a hidden name and renamed, so a stream never
    sees half of it. Committing an extract twice is an error.
    """
    fs, path = file_system(spark, manifest_dir)
    files = len(fs.globStatus(path(f"{landing_dir}/{extract}/[!_.]*")) or [])
    fs.mkdirs(path(manifest_dir))
    hidden, final = path(f"{manifest_dir}/.{extract}.json"), path(f"{manifest_dir}/{extract}.json")
    out = fs.create(hidden, True)
    out.write(bytearray(json.dumps({"extract": extract, "files": files}).encode()))
    out.close()
    if not fs.rename(hidden, final):
        raise FileExistsError(f"{extract} is committed already")
    return files


def run_manifest_ingest(spark: SparkSession, landing_dir: str, manifest_dir: str, archive_dir: str, bronze_dir: str,
                        checkpoint: str | None = None, load_prefix: str = "load", clock: Callable | None = None,
                        keep: int | None = None) -> int:
    """Load every extract committed since the last run, oldest first, then stop. Returns the number of loads.

    An extract whose files are fewer or more than its manifest says fails the
    run before anything is written; the next run tries it again. Its stamp is
    the manifest's landing time (or ``clock()``). With ``keep`` only that many
    of the newest bronze versions stay. An extract without records still
    replaces bronze, by an empty version.
    """
    checkpoint = checkpoint or shared_checkpoint(spark, "traitlens-manifest-ingest")
    loads: list[int] = []

    def write_load(batch: DataFrame, batch_id: int) -> None:
        manifest = batch.first()  # a manifest has one line, a batch one manifest
        if manifest is None:
            return
        folder = f"{landing_dir}/{manifest.extract}"
        fs, path = file_system(spark, folder)
        files = len(fs.globStatus(path(f"{folder}/[!_.]*")) or [])
        if files != manifest.files:
            raise ValueError(f"extract {manifest.extract} has {files} files, its manifest says {manifest.files}")
        ts = clock() if clock is not None else manifest[LANDED_AT]
        loaded = stamp(flatten(read_landed_json(batch.sparkSession, folder)), ts, f"{load_prefix}-{batch_id}")
        archive_raw(loaded, archive_dir)
        replace_bronze(loaded, bronze_dir, version=batch_id)
        if keep:
            drop_old_versions(spark, bronze_dir, keep)
        loads.append(batch_id)

    manifests = spark.readStream.schema("extract string, files long").option("maxFilesPerTrigger", 1).json(manifest_dir) \
        .select("*", F.col("_metadata.file_modification_time").alias(LANDED_AT))
    manifests.writeStream.foreachBatch(write_load).option("checkpointLocation", checkpoint) \
        .trigger(availableNow=True).start().awaitTermination()
    return len(loads)
