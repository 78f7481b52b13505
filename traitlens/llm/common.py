"""Helpers shared by the operators: written intermediate tables, words and shingles, streamed groups."""

from __future__ import annotations

import ctypes
import uuid
from collections import defaultdict
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from traitlens.session import checkpoint_dir

#: Words of a shingle and the least similarity of near copies, unless a caller says otherwise.
SHINGLE = 5
SIMILARITY = 0.8


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables, read afresh on each call."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_path(spark: SparkSession, name: str) -> str:
    """A new folder name in the shared folder of spark.checkpoint.dir."""
    return f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet into the shared folder and read it back.

    Cuts the lineage where a result is used more than once: lost executors
    then cost a re-read, and Spark knows the table's size when it picks a join.
    """
    path = shared_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def word_codes() -> Callable[[list[bytes]], np.ndarray]:
    """Dense integer codes of words, growing with the words seen (one batch's scope)."""
    codes: defaultdict = defaultdict()
    codes.default_factory = codes.__len__
    return lambda words: np.fromiter(map(codes.__getitem__, words), np.int64, len(words))


class _Hashes(dict):
    """64-bit hash of a word; the cache is emptied when it is full, which changes no result."""

    LIMIT = 400_000

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.LIMIT:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word)
        return value


_hashes = _Hashes()


def release() -> None:
    """Give back what a worker keeps: word hashes go, and freed memory returns to the system."""
    _hashes.clear()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def released(run: Callable) -> Callable:
    """``run`` over a partition's batches, with the worker's memory given back before and after.

    Workers are used again: what an earlier stage has left would stand beside this one's own.
    """
    def with_release(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        try:
            yield from run(batches)
        finally:
            release()
    return with_release


def words_of(text: str | None) -> list[bytes]:
    """Maximal runs of ``[^\\x20\\x09-\\x0D]`` as UTF-8 (null: none)."""
    return text.encode("utf-8", "surrogatepass").split() if text else []


def mix(h: np.ndarray) -> np.ndarray:
    """Finalise 64-bit values so that every bit depends on every other."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def shingle_set(words: list[bytes], size: int = SHINGLE) -> np.ndarray:
    """Sorted distinct 64-bit hashes of all runs of ``size`` words.

    A text of fewer words, at least one, has one shingle: all of its words.
    """
    n = len(words)
    if not n:
        return np.empty(0, np.uint64)
    w = np.fromiter(map(_hashes.__getitem__, words), np.uint64, n)
    size = min(size, n)
    h = np.full(n - size + 1, size, np.uint64)
    for j in range(size):
        h = h * np.uint64(0x9E3779B97F4A7C15) + w[j:n - size + 1 + j]
    return np.unique(mix(h))


def slices_by_chars(batch: pa.RecordBatch, text: int, limit: int) -> Iterator[pa.RecordBatch]:
    """The rows of a batch in order, in slices of at most ``limit`` characters in column ``text``, or of one row."""
    if not batch.num_rows:
        return
    size = np.cumsum(pc.fill_null(pc.utf8_length(batch.column(text)), 0).to_numpy(zero_copy_only=False))
    at = 0
    while at < len(size):
        served = size[at - 1] if at else 0
        end = max(int(np.searchsorted(size, served + limit, "right")), at + 1)
        yield batch.slice(at, end - at)
        at = end


def streamed_groups(batches: Iterable[pa.RecordBatch], key: str) -> Iterator[pa.Table]:
    """The runs of rows with equal ``key`` of a partition sorted by it, one table each."""
    held: list[pa.RecordBatch] = []
    held_key = None
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = batch.column(key).to_numpy(zero_copy_only=False)
        cuts = [0, *(np.flatnonzero(keys[1:] != keys[:-1]) + 1), len(keys)]
        for a, b in zip(cuts, cuts[1:]):
            if held and keys[a] != held_key:
                yield pa.Table.from_batches(held)
                held = []
            held_key = keys[a]
            held.append(batch.slice(a, b - a))
    if held:
        yield pa.Table.from_batches(held)


def by_group(df: DataFrame, key: str, fn: Callable, schema: str) -> DataFrame:
    """Apply ``fn`` (batches -> batches) to partitions dealt and sorted by ``key``."""
    return df.repartition(F.col(key)).sortWithinPartitions(key).mapInArrow(released(fn), schema)
