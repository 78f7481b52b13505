"""Session construction and cluster-aware settings."""

from __future__ import annotations

import functools
import os
import tempfile

from pyspark import SparkContext
from pyspark.sql import SparkSession

# Settings every traitlens job relies on. Session time zone must be UTC:
# load timestamps are stamped and compared in UTC.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    # HotSpot does not compile methods beyond 8000 bytes: wider stages run operator by operator instead
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # a long-lived driver runs many query shapes: keep their compiled stages, little status history
    "spark.sql.codegen.cache.maxEntries": "1000",
    "spark.sql.ui.retainedExecutions": "20",
    "spark.ui.retainedJobs": "100",
    "spark.ui.retainedStages": "100",
    "spark.ui.retainedTasks": "2000",
    "spark.ui.dagGraph.retainedRootRDDs": "100",
}


#: Settings of BASE_CONF that a running session cannot change.
STATIC_SQL_CONF = ("spark.sql.codegen.cache.maxEntries", "spark.sql.ui.retainedExecutions")


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "traitlens", extra: dict | None = None) -> SparkSession:
    """Return (or build) a session with traitlens defaults.

    On a cluster, call without ``master``; the submitter decides. Locally the
    tests pass ``local[*]`` and a small shuffle-partition count.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(BASE_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    # getOrCreate may return an existing session: enforce the runtime SQL confs.
    runtime = {k: v for k, v in BASE_CONF.items() if k.startswith("spark.sql.") and k not in STATIC_SQL_CONF}
    if shuffle_partitions:
        runtime["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    for k, v in runtime.items():
        spark.conf.set(k, v)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder the cluster names in spark.checkpoint.dir.

    Only where the setting is absent and the master is local (tests) is a
    private folder created and registered; on a cluster that is an error, as
    each executor would write to its own disk.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        spark.sparkContext.setCheckpointDir(configured)
        return configured
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current
    if not spark.sparkContext.master.startswith("local["):
        raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
    local = tempfile.mkdtemp(prefix="traitlens-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    spark.sparkContext.setCheckpointDir(local)
    return local


def per_context(fn):
    """Memoise a builder of Column expressions per live SparkContext.

    Column definitions are pure (they reference columns by name), but each
    node costs a JVM round trip to build; queries reuse them instead.
    Returns a fresh dict each call so callers may extend it.
    """
    cache: dict = {}

    @functools.wraps(fn)
    def wrapper(*args):
        sc = SparkContext._active_spark_context
        key = (id(sc), sc.applicationId if sc is not None else None, args)
        if key not in cache:
            cache[key] = fn(*args)
        return dict(cache[key])

    return wrapper
