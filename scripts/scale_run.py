"""Production-path run on a grown profile fixture.

    python scripts/scale_run.py --sf-dir /root/testdata/sf0.1 --copies 100 --out SCALE.md

Grows the driver table ``part`` k-fold with a generator (each row becomes k
rows with offset keys; no join), derives raw profiles, then times the
production path: star build (staging persisted, three bucketed mart tables,
rule summary, stored failures), reports over the stored marts, and the batch
recommender for every customer. Everything is written under a fresh scratch
folder (or $SCALE_DIR).
"""

from __future__ import annotations

import argparse
import os
import sys
import tempfile
import time

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from pyspark.sql import functions as F  # noqa: E402

from traitlens.operators.filters import Filters  # noqa: E402
from traitlens.sources.fixture import raw_profiles_from_part  # noqa: E402
from traitlens.sources.tables import table  # noqa: E402

KEY_STRIDE = 10_000_000   # offset between copies; driver part keys stay far below it


def grown_part(part, copies: int):
    """k copies of ``part`` with distinct keys, generated row by row."""
    return (part.select(F.explode(F.sequence(F.lit(0), F.lit(copies - 1))).alias("_copy"), "*")
            .withColumn("p_partkey", F.col("p_partkey") + F.col("_copy") * F.lit(KEY_STRIDE))
            .drop("_copy"))


def main() -> int:
    ap = argparse.ArgumentParser()
    ap.add_argument("--sf-dir", default="/root/testdata/sf0.1")
    ap.add_argument("--copies", type=int, default=100)
    ap.add_argument("--cpus", type=int, default=8)
    ap.add_argument("--out", default=None)
    args = ap.parse_args()

    scratch = os.environ.get("SCALE_DIR") or tempfile.mkdtemp(prefix="run-scale-", dir="/tmp")
    from traitlens.session import get_session

    spark = get_session(f"local[{args.cpus}]", shuffle_partitions=args.cpus * 4, app_name="traitlens-scale",
                        extra={"spark.sql.warehouse.dir": os.path.join(scratch, "warehouse"),
                               "spark.driver.memory": "16g"})
    spark.sparkContext.setLogLevel("ERROR")
    spark.sparkContext.setCheckpointDir(os.path.join(scratch, "checkpoints"))

    from traitlens.operators.recommend import recommend
    from traitlens.plans import reports as R
    from traitlens.plans import star as S
    from traitlens.plans.context import context_frame
    from traitlens.sources.sinks import build_and_write_star
    from traitlens import constants as K

    timings: list[tuple[str, float, str]] = []

    def timed(label, fn):
        t0 = time.perf_counter()
        out = fn()
        timings.append((label, time.perf_counter() - t0, out if isinstance(out, str) else ""))
        return out

    part = grown_part(table(spark, args.sf_dir, "part"), args.copies).repartition(args.cpus * 4, "p_partkey")
    raw = raw_profiles_from_part(spark, part)
    n = timed("count raw profiles", lambda: str(raw.count()))
    names = timed("star build: staging + 3 bucketed marts + 58 rules + stored failures",
                  lambda: build_and_write_star(spark, raw, "scale_db", buckets=args.cpus * 4))
    dim, fct, trt = (spark.table(names[k]) for k in ("dim_profiles", "fct_metrics", "dim_traits"))
    prof = S.join_marts(dim, trt)

    def run(df):
        df.write.format("noop").mode("overwrite").save()
        return ""

    timed("family_by_size over stored marts (bucketed join)", lambda: run(R.family_by_size(prof)))
    timed("top_traits over stored marts (semi-join)",
          lambda: run(R.top_traits_stored(dim, trt, Filters(sizes=("Small", "Medium"),
                                                            suitability=("Good for Families",)))))
    timed("size_distribution (facet bounds + filter)", lambda: run(R.size_distribution(prof)))
    timed("build_stats over stored fact", lambda: run(R.build_stats(fct)))
    timed("complexity_mode", lambda: run(R.complexity_mode(prof)))

    customers = table(spark, args.sf_dir, "customer")
    texts = F.array(*[F.lit(t) for t in K.REQUEST_TEXTS])
    req = customers.select("c_custkey", F.element_at(texts, (F.col("c_custkey") % len(K.REQUEST_TEXTS) + 1)
                                                     .cast("int")).alias("request_text"))
    timed("recommend: every customer x all profiles (via intents)",
          lambda: run(recommend(req, "request_text", context_frame(prof, Filters()), "c_custkey")))

    lines = [f"# Production-path run on a grown fixture",
             "",
             f"`scripts/scale_run.py --sf-dir {args.sf_dir} --copies {args.copies}` on local[{args.cpus}]:",
             f"{n} raw profiles ({args.copies} copies of `part`), {customers.count()} requests.",
             "",
             "| step | seconds |", "|---|---|"]
    lines += [f"| {label} | {sec:.1f} |" for label, sec, _ in timings]
    text = "\n".join(lines)
    print(text)
    if args.out:
        with open(args.out, "w") as fh:
            fh.write(text + "\n")
    spark.stop()
    return 0


if __name__ == "__main__":
    sys.exit(main())
