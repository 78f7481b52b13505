"""Sources (read, flatten, stamp), sinks (bronze, archive, bucketed marts) and streaming ingest."""

import datetime as dt
import json
import os

from pyspark.sql import functions as F

from traitlens.sources import raw as RAW
from traitlens.sources import sinks as SNK
from traitlens.streaming.ingest import run_ingest


def _landed(path, records):
    os.makedirs(path, exist_ok=True)
    with open(os.path.join(path, f"batch-{len(os.listdir(path))}.json"), "w") as fh:
        for r in records:
            fh.write(json.dumps(r) + "\n")


RECORDS = [
    {"id": 1, "name": "Affenpinscher", "breed_group": "Toy", "life_span": "10 - 12 years",
     "temperament": "Stubborn, Curious, Playful", "weight": {"imperial": "6 - 13", "metric": "3 - 6"},
     "height": {"imperial": "9 - 11.5", "metric": "23 - 29"}},
    {"id": 2, "name": "Akita", "breed_group": "Working", "life_span": "10 - 14 years",
     "temperament": "Courageous, Dignified", "weight": {"imperial": "65 - 115", "metric": "29 - 52"},
     "height": {"imperial": "24 - 28", "metric": "61 - 71"}},
]


def test_flatten_nested_records(spark, tmp_path):
    _landed(str(tmp_path / "land"), RECORDS)
    flat = RAW.flatten(RAW.read_landed_json(spark, str(tmp_path / "land")))
    assert {"weight__imperial", "weight__metric", "height__imperial", "height__metric"} <= set(flat.columns)
    row = flat.where("id = 1").first()
    assert row.weight__imperial == "6 - 13" and row.height__metric == "23 - 29"


def test_flatten_roundtrip_with_nest(inputs):
    raw = inputs.raw
    back = RAW.flatten(RAW.nest(raw)).select(*raw.columns)
    assert back.exceptAll(raw).count() == 0


def test_stamp_uses_one_timestamp(spark, tmp_path):
    _landed(str(tmp_path / "land"), RECORDS)
    flat = RAW.flatten(RAW.read_landed_json(spark, str(tmp_path / "land")))
    ts = dt.datetime(2025, 8, 26, 23, 59, 59)
    out = RAW.stamp(flat, ts, "load-7").collect()
    assert {r.extraction_date for r in out} == {"2025-08-26"}
    assert {r.extracted_at for r in out} == {ts}
    assert {r._dlt_id for r in out} == {"load-7-1", "load-7-2"}


def test_bronze_and_archive(spark, tmp_path):
    _landed(str(tmp_path / "land"), RECORDS)
    flat = RAW.flatten(RAW.read_landed_json(spark, str(tmp_path / "land")))
    loaded = RAW.stamp(flat, dt.datetime(2025, 8, 26, 14, 0), "load-1")
    SNK.replace_bronze(loaded, str(tmp_path / "bronze"))
    SNK.replace_bronze(loaded.limit(1), str(tmp_path / "bronze"))
    assert RAW.read_bronze(spark, str(tmp_path / "bronze")).count() == 1
    SNK.archive_raw(loaded, str(tmp_path / "archive"))
    SNK.archive_raw(loaded, str(tmp_path / "archive"))  # idempotent re-run
    assert os.path.isdir(tmp_path / "archive" / "extraction_date=2025-08-26" / "_dlt_load_id=load-1")
    assert spark.read.json(str(tmp_path / "archive")).count() == 2


def test_build_and_write_star(spark, inputs):
    names = SNK.build_and_write_star(spark, inputs.raw, "profiles_db", buckets=4)
    dim = spark.table(names["dim_profiles"])
    assert dim.count() == inputs.raw.count()
    summary = spark.table(names["rule_summary"])
    assert summary.count() == 60                 # 58 model rules, source recency, consistency of the marts
    assert {"recency", "consistency"} <= {r.kind for r in summary.collect()}
    assert "failures_recency" in names           # the fixture's load is old
    files = [f for f in os.listdir(spark.conf.get("spark.sql.warehouse.dir").replace("file:", "")
                                   + "/profiles_db.db/dim_profiles") if f.startswith("part-")]
    assert len(files) <= 4                       # one file per bucket
    assert "failures_stg_profiles" in names      # planted range rows are stored
    from traitlens.plans.star import join_marts
    joined = join_marts(dim, spark.table(names["dim_traits"]))
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning" not in plan   # bucketed marts join without a shuffle
    assert joined.count() == dim.count()


def test_streaming_ingest_available_now(spark, tmp_path):
    land = str(tmp_path / "land")
    _landed(land, RECORDS[:1])
    clock = iter([dt.datetime(2025, 8, 26, 10), dt.datetime(2025, 8, 27, 10)])
    kw = dict(archive_dir=str(tmp_path / "archive"), bronze_dir=str(tmp_path / "bronze"),
              checkpoint=str(tmp_path / "ckpt"), clock=lambda: next(clock))
    assert run_ingest(spark, land, **kw) == 1
    _landed(land, RECORDS[1:])
    assert run_ingest(spark, land, **kw) == 1           # only the new file is read
    bronze = RAW.read_bronze(spark, str(tmp_path / "bronze")).collect()
    assert [r.id for r in bronze] == [2]                 # bronze is replaced per load
    archive = spark.read.json(str(tmp_path / "archive"))
    assert sorted(r.extraction_date for r in archive.select(F.col("extraction_date").cast("string"))
                  .collect()) == ["2025-08-26", "2025-08-27"]


def test_staging_runs_on_a_stream(spark, tmp_path):
    from traitlens.plans.star import stage

    land = str(tmp_path / "land")
    _landed(land, RECORDS)
    stream = RAW.stamp(RAW.flatten(spark.readStream.schema(RAW.NESTED_SCHEMA).json(land)),
                       dt.datetime(2025, 8, 26, 12), "load-s")
    q = (stage(stream).writeStream.format("memory").queryName("staged_stream")
         .option("checkpointLocation", str(tmp_path / "ckpt")).trigger(availableNow=True).start())
    q.awaitTermination()
    rows = {r.breed_id: r for r in spark.table("staged_stream").collect()}
    assert rows[1].weight_min_lbs == 6.0 and rows[1].size_category == "Small"
    assert rows[2].life_span_max_years == 14 and rows[2].size_category == "Extra Large"


def test_ingest_stamp_is_the_landing_time(spark, tmp_path):
    land = str(tmp_path / "land")
    _landed(land, RECORDS)
    landed_at = dt.datetime(2025, 8, 26, 9, 30, 0)
    for f in os.listdir(land):
        os.utime(os.path.join(land, f), (landed_at.timestamp(), landed_at.timestamp()))
    kw = dict(archive_dir=str(tmp_path / "archive"), bronze_dir=str(tmp_path / "bronze"),
              checkpoint=str(tmp_path / "ckpt"))
    assert run_ingest(spark, land, **kw) == 1
    bronze = RAW.read_bronze(spark, str(tmp_path / "bronze")).collect()
    # file times are read in the session zone (UTC); the stamp repeats on replay
    assert {r.extracted_at for r in bronze} == {dt.datetime.fromtimestamp(landed_at.timestamp(), dt.timezone.utc)
                                              .replace(tzinfo=None)}
    assert {r.extraction_date for r in bronze} == {"2025-08-26"}


def test_star_partitioned_by_load_date(spark, inputs):
    names = SNK.build_and_write_star(spark, inputs.raw, "profiles_dated", buckets=2, store_failures=False,
                                     partition_by_date=True)
    dim = spark.table(names["dim_profiles"])
    assert dim.count() == inputs.raw.count()
    parts = spark.sql(f"show partitions {names['dim_profiles']}").collect()
    assert [r[0] for r in parts] == ["extraction_date=2025-08-25", "extraction_date=2025-08-26"]


def test_two_extracts_in_one_run_and_a_replay(spark, tmp_path):
    land, bronze = str(tmp_path / "land"), str(tmp_path / "bronze")
    _landed(land, RECORDS)
    _landed(land, [dict(RECORDS[0], name="Newer"), RECORDS[1], dict(RECORDS[1], id=3)])
    for i, f in enumerate(sorted(os.listdir(land))):
        os.utime(os.path.join(land, f), (1_756_200_000 + i * 100,) * 2)
    kw = dict(archive_dir=str(tmp_path / "archive"), bronze_dir=bronze, checkpoint=str(tmp_path / "ckpt"))
    assert run_ingest(spark, land, **kw) == 2            # one load per landed file
    rows = sorted((r.id, r.name) for r in RAW.read_bronze(spark, bronze).collect())
    assert rows == [(1, "Newer"), (2, "Akita"), (3, "Akita")]
    assert spark.read.json(str(tmp_path / "archive")).count() == 5
    # a crash between archive and bronze: a version without its success marker is not read
    newest = max(d for d in os.listdir(bronze))
    os.makedirs(os.path.join(bronze, "version=000000000009"))
    assert RAW.read_bronze(spark, bronze).count() == 3
    # the replay of the last load writes the same folders again
    last = RAW.flatten(RAW.read_landed_json(spark, os.path.join(land, sorted(os.listdir(land))[1])))
    SNK.replace_bronze(RAW.stamp(last, dt.datetime(2025, 8, 26), "load-1"), bronze, version=int(newest.split("=")[1]))
    assert sorted(r.id for r in RAW.read_bronze(spark, bronze).collect()) == [1, 2, 3]


def test_ingest_needs_a_shared_checkpoint(spark, tmp_path):
    import pytest

    if spark.conf.get("spark.checkpoint.dir", None) is None:
        with pytest.raises(ValueError):
            run_ingest(spark, str(tmp_path), str(tmp_path / "a"), str(tmp_path / "b"))


def test_stored_marts_join_without_exchange(spark):
    from traitlens.plans import registry

    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = registry.queries()["latest_snapshot_stored"](spark, "/root/testdata/sf0.001") \
            ._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert plan.count("SortMergeJoin") == 2 and "Exchange hashpartitioning" not in plan


def test_observed_counts_equal_a_second_scan(spark, inputs):
    """Row rules counted while the models are written agree with counting them over the stored tables."""
    from traitlens.operators import quality as Q
    from traitlens.plans.quality_rules import star_rules

    names = SNK.build_and_write_star(spark, inputs.raw, "profiles_observed", buckets=3, store_failures=False)
    tables = {t: spark.table(names[t]) for t in ("stg_profiles", "dim_profiles", "fct_metrics", "dim_traits")}
    counted = {r.test_name: (r.failures, r.status) for r in Q.summarize(tables, star_rules()).collect()}
    stored = {r.test_name: (r.failures, r.status) for r in spark.table(names["rule_summary"])
              .where("kind not in ('recency', 'consistency')").collect()}
    assert stored == counted and sum(n for n, _ in stored.values()) > 0


def test_extract_of_several_files_is_one_load(spark, tmp_path):
    import pytest

    from traitlens.streaming.ingest import commit_extract, run_manifest_ingest

    land, manifests, bronze = (str(tmp_path / x) for x in ("land", "manifests", "bronze"))
    kw = dict(archive_dir=str(tmp_path / "archive"), bronze_dir=bronze, checkpoint=str(tmp_path / "ckpt"), keep=2)
    for i in range(3):
        _landed(f"{land}/one", [dict(RECORDS[0], id=10 + i)])
    os.makedirs(manifests)
    assert run_manifest_ingest(spark, land, manifests, **kw) == 0       # landed, but not committed
    assert commit_extract(spark, land, "one", manifests) == 3
    with pytest.raises(Exception):
        commit_extract(spark, land, "one", manifests)
    _landed(f"{land}/torn", RECORDS)
    assert run_manifest_ingest(spark, land, manifests, **kw) == 1
    rows = RAW.read_bronze(spark, bronze).collect()
    assert sorted(r.id for r in rows) == [10, 11, 12]
    assert len({(r.extracted_at, r._dlt_load_id) for r in rows}) == 1   # three files, one load
    # a file is lost after the commit: nothing is written, and the load goes through once it is back
    commit_extract(spark, land, "torn", manifests)
    _landed(f"{land}/torn", RECORDS)
    with pytest.raises(Exception, match="manifest"):
        run_manifest_ingest(spark, land, manifests, **kw)
    assert sorted(r.id for r in RAW.read_bronze(spark, bronze).collect()) == [10, 11, 12]
    os.remove(os.path.join(land, "torn", "batch-1.json"))
    assert run_manifest_ingest(spark, land, manifests, **kw) == 1
    assert sorted(r.id for r in RAW.read_bronze(spark, bronze).collect()) == [1, 2]
    # an empty extract replaces bronze too; only two versions stay, and an unfinished one is left alone
    os.makedirs(f"{land}/none")
    open(f"{land}/none/batch-0.json", "w").close()
    commit_extract(spark, land, "none", manifests)
    os.makedirs(os.path.join(bronze, "version=000000000000x"))
    assert run_manifest_ingest(spark, land, manifests, **kw) == 1
    assert RAW.read_bronze(spark, bronze).count() == 0
    assert len(RAW.committed_versions(spark, bronze)) == 2 and len(os.listdir(bronze)) == 3
    assert spark.read.json(str(tmp_path / "archive")).count() == 5
    with pytest.raises(ValueError):
        SNK.drop_old_versions(spark, bronze, 0)


def test_texts_are_parsed_after_the_rows_are_dealt(spark, inputs, monkeypatch):
    """Few scan tasks do not parse for all: the one exchange of the build lies below the parsers, keys as before."""
    plans = {}
    write = SNK.write_checked

    def seen(df, table, buckets, rules, **layout):
        plans[table] = df._jdf.queryExecution().executedPlan().toString()
        return write(df, table, buckets, rules, **layout)

    monkeypatch.setattr(SNK, "write_checked", seen)
    raw = inputs.raw.coalesce(1)
    raw = raw.unionByName(raw.limit(3).withColumn("id", F.lit(None).cast("bigint")))
    names = SNK.build_and_write_star(spark, raw, "profiles_dealt", buckets=3, store_failures=False)
    plan = plans["`profiles_dealt`.stg_profiles_rows"]
    assert plan.count("Exchange hashpartitioning") == 1
    assert plan.index("Generate") < plan.index("Exchange hashpartitioning")
    rows = spark.table(names["stg_profiles"])
    assert rows.count() == inputs.raw.count() and rows.select(F.input_file_name()).distinct().count() == 3
