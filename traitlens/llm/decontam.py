"""Benchmark decontamination: SimHash of item-sized windows, Hamming blocks, exact verification.

Only DataFrame functions. A window has as many five-word shingles as a
benchmark item (fewer where the text ends). Windows are laid wherever they can be similar enough: the
first shingle is one of an item of that size, and enough shingles of such
items follow (a window without them cannot reach the similarity, so none is
lost). Windows and items meet on blocks of their 64-bit SimHash: with eight
blocks of eight bits and every block value at distance one, all fingerprints
within radius 15 meet. The weighted Jaccard similarity (shingles weighted by
their occurrences) then decides.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from traitlens.llm.common import SHINGLE, SIMILARITY, written

BLOCKS, BLOCK_BITS = 8, 8
#: Two fingerprints no further apart share a block up to one bit, by the pigeonhole principle.
RADIUS = 2 * BLOCKS - 1
#: Benchmark shingles (a hash and a size each) are broadcast up to so many rows, else joined by a shuffle.
BROADCAST_ROWS = 1_000_000


def shingles(text: Column, size: int = SHINGLE) -> Column:
    """64-bit hashes of all runs of ``size`` words (letters and digits, lower case), in order.

    A text of fewer words, at least one, has one shingle: all of its words.
    """
    words = F.regexp_extract_all(F.lower(text), F.lit(r"[\p{L}\p{M}\p{N}]+"), F.lit(0))
    # a lambda's argument is computed once per row, whatever its uses
    return F.get(F.transform(F.array(words), lambda ws: F.when(
        F.size(ws) >= size,
        F.transform(F.sequence(F.lit(1), F.size(ws) - (size - 1)), lambda i: F.xxhash64(F.slice(ws, i, size))))
        .when(F.size(ws) > 0, F.array(F.xxhash64(ws)))
        .otherwise(F.array().cast("array<bigint>"))), F.lit(0))


def simhash(hashes: Column) -> Column:
    """64-bit SimHash: bit j is the majority of bit j of all occurrences (ties: 0)."""
    def bit(j: Column) -> Column:
        ones = F.aggregate(hashes, F.lit(0), lambda n, h: n + F.getbit(h, j))
        return F.when(2 * ones > F.size(hashes), F.call_function("shiftleft", F.lit(1).cast("bigint"), j)) \
            .otherwise(F.lit(0).cast("bigint"))
    return F.aggregate(F.transform(F.sequence(F.lit(0), F.lit(63)), bit), F.lit(0).cast("bigint"),
                       lambda a, b: a.bitwiseOR(b))


def _block(fingerprint: Column, b: Column) -> Column:
    return F.call_function("shiftrightunsigned", fingerprint, b * BLOCK_BITS).bitwiseAND(F.lit((1 << BLOCK_BITS) - 1))


def _near(value: Column) -> Column:
    """A block value and all at distance one."""
    return F.array(value, *[value.bitwiseXOR(F.lit(1 << k).cast("bigint")) for k in range(BLOCK_BITS)])


def _distance(a: Column, b: Column) -> Column:
    return F.bit_count(a.bitwiseXOR(b))


def least_shared(m: Column, similarity: float) -> Column:
    """Shingles of an m-shingle window that must be an item's: intersection >= similarity * union >= similarity * m."""
    return F.ceil(m * F.lit(similarity) - 1e-9).cast("int")


def weighted_similarity(a: Column, b: Column) -> Column:
    """Weighted Jaccard of two lists of hashes: sum of least over sum of greatest occurrences."""
    common = F.aggregate(
        F.array_intersect(a, b), F.lit(0),
        lambda n, x: n + F.least(F.size(F.filter(a, lambda y: y == x)), F.size(F.filter(b, lambda y: y == x))))
    return common / (F.size(a) + F.size(b) - common)


def _bounded(small: DataFrame) -> DataFrame:
    """``small`` (a written table), hinted for broadcast only if its rows are within the bound."""
    return F.broadcast(small) if small.count() <= BROADCAST_ROWS else small


def matches(docs: DataFrame, items: DataFrame, text: str = "text", item: str = "item_id",
            item_text: str = "text", similarity: float = SIMILARITY) -> DataFrame:
    """(text_key, item, similarity, start_shingle, n_shingles): each text and item with a window that similar.

    ``text_key`` is a struct of two 64-bit hashes of the text, so copies are
    searched once. The most similar window is given, the first of equals.
    An item of one to four words is one shingle, found in texts of just these
    words; inside longer texts such runs are no evidence of the benchmark. Items
    and texts without words match nothing.
    """
    bench = written(
        items.select(F.col(item).alias("item"), shingles(F.col(item_text)).alias("theirs")).where(F.size("theirs") > 0)
        .withColumn("m", F.size("theirs")).withColumn("print", simhash(F.col("theirs"))), "bench-items")
    sizes = written(bench.select("m", F.explode("theirs").alias("h")).distinct(), "bench-shingles")
    sizes = _bounded(sizes)

    # texts with enough shingles of items of one size, copies counted once
    key = text_key(F.col(text))
    texts = docs.where(F.col(text).isNotNull()).select(key.alias("text_key"), F.col(text).alias("text"))
    hits = texts.select("text_key", shingles(F.col("text")).alias("hs")) \
        .select("text_key", F.explode("hs").alias("h")).join(sizes, "h") \
        .groupBy("text_key", "m").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= least_shared(F.col("m"), similarity))
    suspects = written(hits.select("text_key").distinct(), "suspects")
    suspected = texts.join(suspects, "text_key").groupBy("text_key").agg(F.min("text").alias("text"))
    ours = written(suspected.select("text_key", shingles(F.col("text")).alias("ours")), "suspect-shingles")

    # starts of windows: places of shingles of items of size m, enough of them within m
    places = ours.select("text_key", F.posexplode("ours").alias("at", "h")).join(sizes, "h") \
        .groupBy("text_key", "m").agg(F.sort_array(F.collect_list("at")).alias("at"))
    need = least_shared(F.col("m"), similarity)
    starts = F.filter(F.col("at"), lambda x, i: F.get(F.col("at"), i + need - 1) < x + F.col("m"))
    laid = places.where(F.size("at") >= need).select("text_key", "m", starts.alias("starts")).where(F.size("starts") > 0)
    windows = laid.join(ours, "text_key").select(
        "text_key", "m",
        F.explode(F.transform("starts", lambda s: F.struct(
            s.alias("start"), F.slice("ours", s + 1, F.col("m")).alias("hs")))).alias("w")) \
        .select("text_key", "m", "w.start", "w.hs")
    prints = windows.withColumn("print", simhash(F.col("hs")))

    blocks = F.sequence(F.lit(0), F.lit(BLOCKS - 1))
    left = prints.select("text_key", "m", "start", "hs", "print", F.explode(blocks).alias("b")) \
        .withColumn("value", _block(F.col("print"), F.col("b")))
    right = bench.select("item", "m", "theirs", F.col("print").alias("item_print"), F.explode(blocks).alias("b")) \
        .withColumn("value", F.explode(_near(_block(F.col("item_print"), F.col("b")))))
    # a pair that meets in several blocks counts in the first only
    earlier = F.exists(F.filter(blocks, lambda c: c < F.col("b")), lambda c: _distance(
        _block(F.col("print"), c), _block(F.col("item_print"), c)) <= 1)
    near = left.join(right, ["m", "b", "value"]) \
        .where((_distance(F.col("print"), F.col("item_print")) <= RADIUS) & ~earlier)
    best = F.max(F.struct(F.col("similarity"), (-F.col("start")).alias("place"), F.col("m")))
    return near.withColumn("similarity", weighted_similarity(F.col("hs"), F.col("theirs"))) \
        .where(F.col("similarity") >= similarity) \
        .groupBy("text_key", "item").agg(best.alias("best")) \
        .select("text_key", F.col("item").alias(item), F.col("best.similarity").alias("similarity"),
                (-F.col("best.place")).alias("start_shingle"), F.col("best.m").alias("n_shingles"))


def text_key(text: Column) -> Column:
    return F.struct(F.xxhash64(text).alias("a"), F.xxhash64(F.lit(1), text).alias("b"))


def find_leaks(docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text", item: str = "item_id",
               item_text: str = "text", similarity: float = SIMILARITY) -> DataFrame:
    """One row (key, item, similarity, start_shingle, n_shingles) per row of ``docs`` and benchmark item in it.

    Null and empty texts and empty tables give no rows; null keys and repeated
    rows are searched like others; other columns are not read.
    """
    found = written(matches(docs, items, text, item, item_text, similarity), "leaks")
    rows = docs.select(F.col(key).alias("k"), text_key(F.col(text)).alias("text_key"))
    return rows.join(found, "text_key").select(F.col("k").alias(key), item, "similarity", "start_shingle", "n_shingles")


def without_leaks(docs: DataFrame, items: DataFrame, text: str = "text", item: str = "item_id",
                  item_text: str = "text", similarity: float = SIMILARITY) -> DataFrame:
    """The rows of ``docs`` whose text holds no benchmark item, all columns as they are.

    Null and empty texts stay; null keys and repeated rows are judged like others;
    an empty benchmark keeps all rows.
    """
    bad = written(matches(docs, items, text, item, item_text, similarity).select("text_key").distinct(), "leaking-texts")
    columns = docs.columns
    kept = docs.select(F.struct(*[F.col(c) for c in columns]).alias("row"), text_key(F.col(text)).alias("text_key")) \
        .join(bad, "text_key", "left_anti")
    return kept.select([F.col("row").getField(c).alias(c) for c in columns])
