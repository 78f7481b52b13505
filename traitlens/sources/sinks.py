"""Sinks and materialisation (SNK-1..7, DQ-10).

Layout at scale: the bronze table and its archive are partitioned by
``extraction_date`` (partition pruning for "latest load" queries); the
marts are bucketed and sorted by ``breed_id`` so joins between them read
co-partitioned buckets without an exchange. Choose ``buckets`` so one
bucket file is a few hundred MB (thousands at 100 TB).
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from traitlens.operators import quality as Q
from traitlens.plans import star as S
from traitlens.plans.quality_rules import recency_rule, star_rules
from traitlens.sources.raw import committed_versions, file_system

MART_KEY = "breed_id"


def replace_bronze(df: DataFrame, path: str, fmt: str = "parquet", version: int | None = None) -> None:
    """SNK-1: full replace of the bronze table at ``path``.

    With ``version`` the rows go to a folder of their own, and readers
    (``read_bronze``) take the newest version that has been committed: until
    then they see the one before, and a replay writes the same folder again.
    """
    target = path if version is None else f"{path}/version={version:012d}"
    df.write.mode("overwrite").format(fmt).save(target)


def drop_old_versions(spark: SparkSession, path: str, keep: int) -> int:
    """Delete the committed versions of a versioned table before its ``keep`` newest; returns how many.

    Folders without a success marker are a load under way or one to be
    replayed, and stay. Queries planned on an older version must end first,
    so keep as many versions as such queries may be behind.
    """
    if keep < 1:
        raise ValueError("at least one version is kept")
    old = committed_versions(spark, path)[:-keep]
    fs, hadoop = file_system(spark, path)
    for folder in old:
        fs.delete(hadoop(folder), True)
    return len(old)


def archive_raw(df: DataFrame, path: str, fmt: str = "json") -> None:
    """SNK-2: raw archive, one folder per load date and load id.

    Dynamic partition overwrite replaces only the partitions present in
    ``df``, so re-running a load is idempotent and other dates survive.
    """
    (df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("extraction_date", "_dlt_load_id").format(fmt).save(path))


def stage_view(stg: DataFrame, name: str = "stg_profiles") -> str:
    """SNK-3: materialise staging as a (session) view."""
    stg.createOrReplaceTempView(name)
    return name


def write_checked(df: DataFrame, table: str, buckets: int, rules: list[Q.Rule], partition_by_date: bool = False,
                  dealt: bool = False) -> tuple[str, list[int]]:
    """``write_mart``, with the failing rows of every row rule counted on the way (DQ-9).

    The counts are metrics observed in the writing stage itself, whose tasks
    report once however often they are tried, so no second scan is needed.
    """
    rows = df if dealt else df.repartition(buckets, MART_KEY)
    if not rules:
        return write_mart(rows, table, buckets, partition_by_date, dealt=True), []
    seen = Observation()
    rows = rows.observe(seen, *[F.count_if(r.violation()).alias(f"c{i}") for i, r in enumerate(rules)])
    write_mart(rows, table, buckets, partition_by_date, dealt=True)
    return table, [seen.get[f"c{i}"] for i in range(len(rules))]


def write_mart(df: DataFrame, table: str, buckets: int, partition_by_date: bool = False, dealt: bool = False) -> str:
    """SNK-4, SNK-6: overwrite a mart table, bucketed and sorted by breed_id.

    Hash-partitioning on the key into ``buckets`` partitions (the hash that
    bucketing uses) makes one task write a whole bucket: one file per bucket,
    or per bucket and date. ``dealt``: the rows come from a table with these
    buckets, whose scan is already so partitioned.
    """
    rows = df if dealt else df.repartition(buckets, MART_KEY)
    w = rows.write.mode("overwrite").format("parquet").bucketBy(buckets, MART_KEY).sortBy(MART_KEY)
    if partition_by_date:
        w = w.partitionBy("extraction_date")
    w.saveAsTable(table)
    return table


def ensure_schema(spark: SparkSession, schema: str, location: str | None = None) -> None:
    """SNK-5: models go to ``schema``; stored test failures to ``schema_tests``.

    ``location`` is the folder that holds both; by default the warehouse does.
    """
    for name in (schema, f"{schema}_tests"):
        place = f" LOCATION '{location}/{name}'" if location else ""
        spark.sql(f"CREATE SCHEMA IF NOT EXISTS `{name}`{place}")


def build_and_write_star(spark: SparkSession, raw: DataFrame, schema: str, buckets: int,
                         store_failures: bool = True, enforce: bool = False,
                         partition_by_date: bool = False, now: _dt.datetime | None = None,
                         location: str | None = None) -> dict[str, str]:
    """SNK-7: staging, three marts and their tests, in dependency order.

    Raw rows are dealt by the key (the only shuffle) before their texts are
    parsed: a small file of long row groups gives few scan tasks, and parsing
    is most of the work. Staging is written once as a bucketed table; a view
    names it, and the three marts are projections of its buckets.
    ``partition_by_date`` also partitions the dimension and the fact by
    ``extraction_date`` (the trait mart carries no load date). Row rules are
    counted while a model is written, as observed metrics; a written table is
    read again only for its keys (unique, relationships, consistency) and for
    the rows of rules that have failed. The source's recency counts as of
    ``now``. Failures of every kind are stored in ``<schema>_tests``.
    """
    ensure_schema(spark, schema, location)
    rules = star_rules()
    counted: dict[Q.Rule, int] = {}

    def write(model: str, df: DataFrame, table: str, **layout) -> str:
        own = [r for r in rules if r.table == model and r.kind in Q.ROW_KINDS]
        stored, failures = write_checked(df, f"`{schema}`.{table}", buckets, own, **layout)
        counted.update(zip(own, failures))
        return stored

    key = F.col("id").cast("bigint")
    dealt = raw.where(key.isNotNull()).repartition(buckets, key)
    stored = write("stg_profiles", S.stage(dealt), "stg_profiles_rows", dealt=True)
    stg = spark.table(stored)
    stage_view(stg, "stg_profiles")
    names = {
        "stg_profiles": stored,
        "dim_profiles": write("dim_profiles", S.dim_profiles(stg), "dim_profiles",
                              partition_by_date=partition_by_date, dealt=True),
        "fct_metrics": write("fct_metrics", S.fct_metrics(stg), "fct_metrics",
                             partition_by_date=partition_by_date, dealt=True),
        "dim_traits": write("dim_traits", S.dim_traits(stg), "dim_traits", dealt=True),
    }
    tables = {k: spark.table(v) for k, v in names.items()}
    marts = {k: tables[k] for k in ("fct_metrics", "dim_traits")}
    inconsistent = Q.star_consistency(tables["dim_profiles"], marts, MART_KEY, "breed_name")
    source, column, days = recency_rule()
    stale = Q.recency(raw, column, now or _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None), days,
                      f"recency__{source}__{column}")
    status = F.when(F.col("failures") == 0, "pass").otherwise("fail")
    keyed = Q.summarize(tables, [r for r in rules if r.kind not in Q.ROW_KINDS])
    summary = keyed.unionByName(Q.with_status(spark.createDataFrame(
        [(r.table, r.name, r.kind, r.severity, n) for r, n in counted.items()],
        "table_name string, test_name string, kind string, severity string, failures long"))).unionByName(
        stale.select(F.lit(source).alias("table_name"), "test_name", F.lit("recency").alias("kind"),
                     F.lit("error").alias("severity"), (~F.col("passed")).cast("bigint").alias("failures"))
        .unionByName(inconsistent.agg(F.count(F.lit(1)).alias("failures")).select(
            F.lit("dim_profiles").alias("table_name"), F.lit("consistency__star").alias("test_name"),
            F.lit("consistency").alias("kind"), F.lit("error").alias("severity"), "failures"))
        .withColumn("status", status))
    names["rule_summary"] = f"`{schema}_tests`.rule_summary"
    summary.write.mode("overwrite").saveAsTable(names["rule_summary"])
    if store_failures:
        failed = {r.test_name for r in spark.table(names["rule_summary"]).where("failures > 0")
                  .select("test_name").collect()}

        def store(name: str, rows: DataFrame) -> None:
            names[name] = Q.store_failures(rows, schema, name)

        for df, rs in Q.by_frame(tables, [r for r in rules if r.name in failed]):
            kinds = {k: [r for r in rs if r.kind in k] for k in (Q.ROW_KINDS, ("unique",), ("relationships",))}
            if some := kinds[Q.ROW_KINDS]:
                store(f"failures_{some[0].table}", Q.failing_rows_all(df, some, MART_KEY))
            if some := kinds[("unique",)]:
                store(f"duplicates_{some[0].table}", Q.duplicate_keys_all(df, some))
            for r in kinds[("relationships",)]:
                store(f"orphans_{r.table}_{r.column}", Q.orphan_keys(df, tables[r.parent], r))
        if f"recency__{source}__{column}" in failed:
            store("failures_recency", stale)
        if "consistency__star" in failed:
            store("failures_consistency", inconsistent)
    if enforce:
        Q.enforce(spark.table(names["rule_summary"]))
    return names
