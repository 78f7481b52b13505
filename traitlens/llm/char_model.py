"""Interpolated modified Kneser-Ney over real character n-grams, cross-fitted, with sharded tables.

N-grams are strings of ``ORDER`` code points: no alphabet is fixed and nothing is
folded, so all tables grow with the corpus. Documents are dealt to folds by their
key, and those of a fold to blocks. A block sends each of its distinct n-grams once,
with its count in the block's trusted documents, to the shard of the n-gram's fourth
and fifth character. These packed lists are the training counts and the questions at
once: counts, continuation counts and contexts of orders 6 to 3 of an n-gram lie in
its shard, and tables of pairs and single characters hold the orders below. A shard
answers a block's list in the list's order, by the model of all other folds.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from traitlens.llm.common import by_group, mix, release, streamed_groups, written

ORDER = 6
#: Characters of a passage; the least likely one of a text is its second score.
PASSAGE = 6
#: Characters of a block of documents.
BLOCK = 24 << 20
#: Shards of the n-grams at most.
SHARDS = 1024
_CHUNK = 1 << 21  # characters that are hashed together
_MERGE = 1 << 21  # n-grams of a shard that are held before equal ones are summed
_ONE, _TWO = np.uint64((1 << 21) - 1), np.uint64((1 << 42) - 1)  # one and two code points
_POINT = np.uint64(21)
_ZSTD = pa.Codec("zstd", compression_level=3)
#: Spark removes a query's shuffle files once it has ended.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_PAD = "\0" * (ORDER - 1)
_BASE = np.uint64(0x9E3779B97F4A7C15)


def _hashed(points: np.ndarray) -> np.ndarray:
    """64-bit hash of the ``ORDER`` code points from each place on."""
    m = mix(points.astype(np.uint64) + np.uint64(1))
    n = max(0, len(m) - ORDER + 1)
    h = np.zeros(n, np.uint64)
    for j in range(ORDER):
        h = h * _BASE + m[j:j + n]
    return mix(h)


def grams_of(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of all n-grams (one per character), their places, the code points, and characters per text."""
    points = np.frombuffer("".join(_PAD + t for t in texts if t).encode("utf-32-le", "surrogatepass"), np.uint32)
    sizes = np.array([len(t) if t else 0 for t in texts], np.int64)
    hashes = _hashed(points)
    some = sizes[sizes > 0]
    ends = np.cumsum(some + ORDER - 1)
    kept = np.ones(len(hashes), bool)
    for j in range(1, ORDER):
        at = ends - j
        kept[at[at < len(hashes)]] = False
    places = np.flatnonzero(kept)
    return hashes[places], places, points, sizes


def _chunks(texts: list[str | None]) -> Iterator[tuple[int, list[str | None]]]:
    """(first row, texts) of about ``_CHUNK`` characters."""
    a, size = 0, 0
    for i, t in enumerate(texts):
        size += len(t or "")
        if size >= _CHUNK:
            yield a, texts[a:i + 1]
            a, size = i + 1, 0
    if a < len(texts):
        yield a, texts[a:]


def _squeezed(values: np.ndarray) -> bytes:
    """The rows of an array, byte by byte across rows, compressed."""
    return _packed(np.ascontiguousarray(values).view(np.uint8).reshape(len(values), -1).T.tobytes())


def _restored(blob: bytes, dtype: type, columns: int = 1) -> np.ndarray:
    planes = np.frombuffer(_unpacked(blob), np.uint8).reshape(columns * np.dtype(dtype).itemsize, -1)
    return np.ascontiguousarray(planes.T).view(dtype)


def _packed(raw: bytes) -> bytes:
    return len(raw).to_bytes(8, "little") + _ZSTD.compress(raw, asbytes=True)


def _unpacked(blob: bytes) -> bytes:
    return _ZSTD.decompress(blob[8:], int.from_bytes(blob[:8], "little"), asbytes=True)


def packed(rows: DataFrame, text: str) -> DataFrame:
    """``rows`` with ``text`` compressed, as ``z``: half the bytes of Spark's own shuffle files."""
    kept = [c for c in rows.columns if c != text]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            z = [None if t is None else _packed(t.encode("utf-8", "surrogatepass")) for t in batch.column(text).to_pylist()]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), pa.array(z, pa.binary())], [*kept, "z"])

    return rows.mapInArrow(run, ", ".join(f"{c} {t}" for c, t in rows.dtypes if c != text) + ", z binary")


def _texts(column: pa.ChunkedArray) -> list[str | None]:
    return [None if z is None else _unpacked(z).decode("utf-8", "surrogatepass") for z in column.to_pylist()]


def _keys(grams: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The first and the last three code points of n-grams (rows), as one integer each."""
    g = grams.astype(np.uint64)
    return tuple(g[:, j] << np.uint64(42) | g[:, j + 1] << _POINT | g[:, j + 2] for j in (0, 3))


def _points(hi: np.ndarray, lo: np.ndarray) -> np.ndarray:
    return np.stack([(x >> np.uint64(shift)) & _ONE for x in (hi, lo) for shift in (42, 21, 0)], axis=1).astype(np.uint32)


class _Coded:
    """The n-grams of texts: per chunk of texts their places in its list, and the distinct ones of all chunks."""

    def __init__(self, texts: list[str | None], places: bool = True, trusted: np.ndarray | None = None) -> None:
        self.chunks, hashes, his, los, counts = [], [], [], [], []
        for first, some in _chunks(texts):
            found, at, points, sizes = grams_of(some)
            coded = pc.dictionary_encode(pa.array(found))
            index, listed = coded.indices.to_numpy(), coded.dictionary.to_numpy()
            # codes are dealt in order of appearance
            new = at[np.flatnonzero(np.diff(np.maximum.accumulate(index), prepend=-1))] if len(index) else at
            hi, lo = _keys(points[new[:, None] + np.arange(ORDER)])
            hashes.append(listed)
            his.append(hi)
            los.append(lo)
            if trusted is not None:
                good = np.repeat(trusted[first:first + len(some)], sizes)
                counts.append(np.bincount(index[good], minlength=len(listed)))
            if places:
                self.chunks.append((sizes, index, listed))
        joined = np.concatenate(hashes) if hashes else np.empty(0, np.uint64)
        self.hashes, at = np.unique(joined, return_index=True)
        self.hi, self.lo = (np.concatenate(v)[at] if v else joined for v in (his, los))
        self.counts = None
        if counts:
            self.counts = np.bincount(np.searchsorted(self.hashes, joined), np.concatenate(counts), len(at)).astype(np.int64)

    def order(self, shards: int) -> tuple[np.ndarray, np.ndarray]:
        """The order in which the n-grams are sent, and the sorted shards; it depends on the n-grams alone."""
        shard = (mix(self.lo >> _POINT) % np.uint64(shards)).astype(np.int64)
        order = np.lexsort((self.lo & _ONE, self.hi, self.lo >> _POINT, shard))
        return order, shard[order]


_COUNTED = "shard long, g long, grams binary, counts binary"


def _lists(g: int, coded: _Coded, shards: int) -> Iterator[pa.RecordBatch]:
    order, shard = coded.order(shards)
    if not len(order):
        return
    starts = np.flatnonzero(np.diff(shard, prepend=-1))
    for a, b in zip(starts, [*starts[1:], len(order)]):
        at = order[a:b]
        yield pa.RecordBatch.from_arrays(
            [pa.array([shard[a]], pa.int64()), pa.array([g], pa.int64()),
             pa.array([_squeezed(_points(coded.hi[at], coded.lo[at]))], pa.binary()),
             pa.array([_squeezed(coded.counts[at].astype(np.uint32))], pa.binary())], ["shard", "g", "grams", "counts"])


def block_grams(rows: DataFrame, shards: int) -> DataFrame:
    """(shard, g, grams, counts) of (g, k, good, z) rows: the distinct n-grams of a block g and their trusted counts.

    A text is trusted if ``good`` is true or its key stands in a row of the block without text.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in streamed_groups(batches, "g"):
            labels = block["k"].filter(pc.is_null(block["z"]))
            block = block.filter(pc.is_valid(block["z"]))
            good = pc.or_(pc.fill_null(block["good"], False), pc.is_in(block["k"], value_set=labels, skip_nulls=True))
            coded = _Coded(_texts(block["z"]), False, good.to_numpy().astype(bool))
            if block.num_rows:
                yield from _lists(block["g"][0].as_py(), coded, shards)

    return by_group(rows, "g", run, _COUNTED)


def _summed(hi: np.ndarray, lo: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (hi, lo), sorted, the sums of their rows of ``n``, and the place of each row among them."""
    order = np.lexsort((lo, hi))
    hi, lo = hi[order], lo[order]
    new = np.ones(len(hi), bool)
    new[1:] = (hi[1:] != hi[:-1]) | (lo[1:] != lo[:-1])
    at = np.empty(len(hi), np.int64)
    at[order] = np.cumsum(new) - 1
    return hi[new], lo[new], np.add.reduceat(n[order], np.flatnonzero(new), axis=0), at


class _Shard:
    """The n-grams of one shard, and per order from ``ORDER`` to 3 (hi, lo, n, the place of their suffix one order below)."""

    def __init__(self, lists: pa.Table, folds: int) -> None:
        held: list[tuple] = []
        size = 0
        for g, grams, counts in zip(*(lists[c].to_pylist() for c in ("g", "grams", "counts"))):
            hi, lo = _keys(_restored(grams, np.uint32, ORDER))
            n = np.zeros((len(hi), folds), np.int64)
            n[:, g % folds] = _restored(counts, np.uint32)[:, 0]
            held.append((hi, lo, n))
            size += len(hi)
            if size > _MERGE + 2 * len(held[0][0]):
                held = [self._merged(held)]
                size = len(held[0][0])
        hi, lo, own = self._merged(held)
        self.his, self.los = np.unique(hi), np.unique(lo)
        self.codes = self._codes(hi, lo)
        n = own.sum(axis=1, keepdims=True) - own
        self.levels = []
        for order, mask in ((6, _TWO), (5, _ONE), (4, np.uint64(0))):
            hi_, lo_, n_, at = _summed(hi & mask, lo, (n > 0).astype(np.int64))
            self.levels.append((order, hi, lo, n, at))
            hi, lo, n = hi_, lo_, n_
        # distinct left neighbours of pairs, and the place of the pair
        _, self.pairs, self.pair_n, at = _summed(hi, lo & _TWO, (n > 0).astype(np.int64))
        self.levels.append((3, hi, lo, n, at))

    @staticmethod
    def _merged(held: list[tuple]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        return _summed(*(np.concatenate(v) for v in zip(*held)))[:3]

    def _codes(self, hi: np.ndarray, lo: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.his, hi) * len(self.los) + np.searchsorted(self.los, lo)

    def places(self, grams: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.codes, self._codes(*_keys(grams)))

    def logs(self, discounts: dict[int, list[list[float]]], pairs: np.ndarray, p: np.ndarray) -> np.ndarray:
        """Natural log-probabilities of the n-grams (rows) under each model, from those of sorted pairs."""
        p = p[np.searchsorted(pairs, self.pairs)]
        for order, hi, lo, n, at in reversed(self.levels):
            p = p[at]
            context = lo >> _POINT
            new = np.ones(len(hi), bool)
            new[1:] = (hi[1:] != hi[:-1]) | (context[1:] != context[:-1])
            starts, of = np.flatnonzero(new), np.cumsum(new) - 1
            for m, d in enumerate(discounts[order]):
                less = np.array([0.0, *d])[np.minimum(n[:, m], 3)]
                every = np.add.reduceat(n[:, m], starts)[of]
                some = np.maximum(every, 1)
                p[:, m] = np.where(every > 0, (n[:, m] - less) / some + np.add.reduceat(less, starts)[of] / some * p[:, m], p[:, m])
        return np.log(np.maximum(p, 1e-300))


def _discounts(n: list[int]) -> list[float]:
    """Of the numbers of n-grams that occur once to four times."""
    y = n[0] / max(1, n[0] + 2 * n[1])
    # a count that does not occur leaves its discount at its limit
    return [max(0.0, i - (i + 1) * y * n[i] / n[i - 1]) if n[i - 1] else i * y for i in (1, 2, 3)]


def _discount(m: int, d: list[float]) -> Column:
    n = F.col(f"n_{m}")
    return F.when(n >= 3, d[2]).when(n == 2, d[1]).when(n == 1, d[0]).otherwise(0.0)


def _interpolated(m: int, d: list[float]) -> Column:
    """n_m of a sum all_m, with p_m of the order below."""
    every = F.nullif(F.col(f"all_{m}"), F.lit(0))
    alpha = F.coalesce((F.col(f"n_{m}") - _discount(m, d)) / every, F.lit(0.0))
    return (alpha + F.coalesce(F.col(f"back_{m}") / every, F.lit(1.0)) * F.col(f"p_{m}")).alias(f"p_{m}")


def _model(counted: DataFrame, folds: int) -> tuple[dict[int, list[list[float]]], DataFrame]:
    """Discounts per order and model, and (shard, pair, p_m) of the pairs that a shard's n-grams end with.

    Characters that no trusted text has share one place beside the known ones.
    """
    ns = [f"n_{m}" for m in range(folds)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lists in streamed_groups(batches, "shard"):
            shard = _Shard(lists, folds)
            value, order, n = [shard.pairs.astype(np.int64)], [np.full(len(shard.pairs), 2)], [shard.pair_n]
            for o, _, _, found, _ in shard.levels:
                value.append(np.arange(1, 5))
                order.append(np.full(4, o))
                n.append(np.stack([(found == i).sum(axis=0) for i in range(1, 5)]))
            n = np.concatenate(n)
            yield pa.RecordBatch.from_arrays(
                [pa.array(x, pa.int64()) for x in (np.full(len(n), lists["shard"][0].as_py()), np.concatenate(order),
                                                   np.concatenate(value), *n.T)], ["shard", "ord", "value", *ns])

    parts = _tidy(by_group(counted, "shard", run, "shard long, ord long, value long, " + ", ".join(f"{x} long" for x in ns)), "parts")
    sums = _tidy(parts.groupBy("ord", "value").agg(*[F.sum(x).alias(x) for x in ns]), "sums")
    often = {(r["ord"], r["value"]): r for r in sums.where("ord > 2").collect()}  # four rows an order
    discounts = {o: [_discounts([often[o, i][x] if often else 0 for i in range(1, 5)]) for x in ns] for o in (6, 5, 4, 3)}

    def own(counts: DataFrame) -> tuple[list[list[float]], list[Column]]:
        row = counts.agg(*[F.count_if(F.col(x) == i) for x in ns for i in range(1, 5)]).first()
        found = [_discounts(list(row[4 * m:4 * m + 4])) for m in range(folds)]
        return found, [c for m in range(folds) for c in (F.sum(f"n_{m}").alias(f"all_{m}"),
                                                         F.sum(_discount(m, found[m])).alias(f"back_{m}"))]

    pairs = sums.where("ord = 2").select(F.col("value").alias("pair"), F.shiftright("value", 21).alias("context"),
                                         F.col("value").bitwiseAND(int(_ONE)).alias("last"), *ns)
    # distinct left neighbours
    singles = _tidy(pairs.groupBy("last").agg(*[F.count_if(F.col(x) > 0).alias(x) for x in ns]), "singles")
    d1, sums1 = own(singles)
    totals = singles.agg(*sums1, *[F.count_if(F.col(x) > 0).alias(f"v_{m}") for m, x in enumerate(ns)]).first()
    below = singles.select("last", *ns, *[F.lit(totals[x]).cast("double").alias(x) for m in range(folds)
                                          for x in (f"all_{m}", f"back_{m}")],
                           *[F.lit(1 / (totals[f"v_{m}"] + 1)).alias(f"p_{m}") for m in range(folds)])
    below = below.select("last", *[_interpolated(m, d1[m]) for m in range(folds)])
    d2, sums2 = own(pairs)
    rows = pairs.join(pairs.groupBy("context").agg(*sums2), "context").join(below, "last")
    pairs = _tidy(rows.select("pair", *[_interpolated(m, d2[m]) for m in range(folds)]), "pairs")
    return discounts, parts.where("ord = 2").select("shard", F.col("value").alias("pair")).join(pairs, "pair")


def _answered(counted: DataFrame, folds: int, answer: Callable, schema: str) -> DataFrame:
    """``answer(shard, g, grams, logs)``, a record batch, of all lists; ``logs`` has a row per n-gram, a column per model."""
    discounts, pairs = _model(counted, folds)
    ps = [f"p_{m}" for m in range(folds)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in streamed_groups(batches, "shard"):
            below = rows.filter(pc.is_valid(rows["pair"])).sort_by("pair")
            lists = rows.filter(pc.is_null(rows["pair"]))
            shard = _Shard(lists, folds)
            logs = shard.logs(discounts, below["pair"].to_numpy().astype(np.uint64),
                              np.stack([below[x].to_numpy() for x in ps], axis=1))
            for at, g, blob in zip(*(lists[c].to_pylist() for c in ("shard", "g", "grams"))):
                grams = _restored(blob, np.uint32, ORDER)
                yield answer(at, g, grams, logs[shard.places(grams)])

    return by_group(counted.unionByName(pairs, allowMissingColumns=True), "shard", run, schema)


def train(trusted: DataFrame, folds: int) -> DataFrame:
    """The lists (``block_grams``) of trusted (g, text) rows, g the fold, in one shard."""
    rows = packed(trusted.select("g", F.lit(None).cast("long").alias("k"), F.lit(True).alias("good"), F.col("text").alias("t"))
                  .where("t is not null"), "t")
    return block_grams(rows, 1)


def log_probabilities(asked: DataFrame, counted: DataFrame, folds: int) -> DataFrame:
    """(gram, p_m): natural log-probability of the last character after the others, under the model m of all folds but m."""
    def lists(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            flat = "".join(batch.column(0).to_pylist()).encode("utf-32-le", "surrogatepass")
            grams = np.frombuffer(flat, np.uint32).reshape(-1, ORDER)
            if len(grams):
                yield pa.RecordBatch.from_arrays(
                    [pa.array([0], pa.int64()), pa.array([-1], pa.int64()), pa.array([_squeezed(grams)], pa.binary()),
                     pa.array([_squeezed(np.zeros(len(grams), np.uint32))], pa.binary())], ["shard", "g", "grams", "counts"])

    def answer(_: int, g: int, grams: np.ndarray, logs: np.ndarray) -> pa.RecordBatch:
        flat = grams.tobytes().decode("utf-32-le", "surrogatepass")
        strings = [flat[i:i + ORDER] for i in range(0, len(flat), ORDER)]
        batch = pa.RecordBatch.from_arrays([pa.array(strings, pa.string()), *(pa.array(x) for x in logs.T)],
                                           ["gram", *(f"p_{m}" for m in range(folds))])
        return batch if g < 0 else batch.slice(0, 0)

    rows = counted.unionByName(asked.select("gram").mapInArrow(lists, _COUNTED))
    return _answered(rows, folds, answer, "gram string, " + ", ".join(f"p_{m} double" for m in range(folds)))


def _tidy(df: DataFrame, name: str) -> DataFrame:
    """``written``, and the shuffle files of the step are removed with it: texts are dealt twice, but stand there once."""
    conf = df.sparkSession.conf
    before = conf.get(_CLEANUP, None)
    conf.set(_CLEANUP, "true")
    try:
        return written(df, name)
    finally:
        conf.unset(_CLEANUP) if before is None else conf.set(_CLEANUP, before)


def scores_of(texts: list[str | None], hashes: np.ndarray, logs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Characters, perplexity and the perplexity of the least likely passage; ``hashes`` are sorted and hold all."""
    return _scores(_Coded(texts), hashes, logs)


def _scores(coded: _Coded, hashes: np.ndarray, logs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    n, mean, worst = [], [], []
    for sizes, index, distinct in coded.chunks:
        mean.append(np.zeros(len(sizes)))
        worst.append(np.zeros(len(sizes)))
        n.append(sizes)
        if not len(index):
            continue
        at = np.minimum(np.searchsorted(hashes, distinct), len(hashes) - 1)
        if (hashes[at] != distinct).any():
            raise ValueError("an n-gram of the block has no answer")
        x = logs[at][index]
        has = sizes > 0
        size = sizes[has]
        starts = np.cumsum(size) - size
        sums = np.add.reduceat(x, starts)
        window = np.full(len(x), np.inf)
        if len(x) >= PASSAGE:
            window[PASSAGE - 1:] = sum(x[j:len(x) - PASSAGE + 1 + j] for j in range(PASSAGE))
        for j in range(PASSAGE - 1):  # windows that begin before their text
            at = starts + j
            window[at[at < len(x)]] = np.inf
        # texts shorter than a passage: their ends were overwritten only inside or after the next text's start
        least = np.where(size >= PASSAGE, np.minimum.reduceat(window, starts) / PASSAGE, sums / size)
        mean[-1][has] = np.exp(-sums / size)
        worst[-1][has] = np.exp(-least)
    flat = [np.concatenate(v) if v else np.empty(0) for v in (n, mean, worst)]
    return flat[0].astype(np.int64), flat[1].round(6), flat[2].round(6)


def perplexities(docs: DataFrame, trusted_ids: DataFrame, folds: int, key: str, text: str, lang: str) -> DataFrame:
    """(k, l, n_symbols, perplexity, passage) of every row, scored by the model that did not see its fold; written."""
    size = docs.agg(F.sum(F.length(F.col(text).cast("string")))).first()[0] or 0
    blocks = max(1, -(-size // (folds * BLOCK)))
    shards = min(SHARDS, max(16, 2 * blocks * folds))
    rows = docs.select(F.col(key).alias("k"), F.col(lang).cast("string").alias("l"), F.col(text).cast("string").alias("t"))

    def block(salt: Column) -> Column:
        sub = F.pmod(F.xxhash64("k", salt, F.lit(1)), F.lit(blocks))
        return (sub * folds + F.pmod(F.xxhash64("k"), F.lit(folds))).cast("long").alias("g")

    # rows without key have no label and are dealt by their text
    dealt = packed(rows.select(block(F.when(F.col("k").isNull(), F.col("t"))), "*"), "t")
    labels = trusted_ids.select(F.col("_id").cast(dict(docs.dtypes)[key]).alias("k")).where("k is not null").distinct() \
        .select(block(F.lit(None).cast("string")), "k")
    counted = _tidy(block_grams(dealt.where("z is not null").select("g", "k", F.lit(False).alias("good"), "z")
                                .unionByName(labels, allowMissingColumns=True), shards), "counted")

    def answer(shard: int, g: int, _: np.ndarray, logs: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([g], pa.int64()), pa.array([shard], pa.int64()),
                                           pa.array([_squeezed(logs[:, g % folds].astype(np.float32))], pa.binary())], ["g", "shard", "p"])

    answers = _answered(counted, folds, answer, "g long, shard long, p binary")

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        release()  # what the worker holds of the block before
        coded = _Coded(_texts(left["z"]))
        order, _ = coded.order(shards)
        p = [_restored(z, np.float32)[:, 0] for z in right.sort_by("shard")["p"].to_pylist()]
        logs = np.empty(len(order))
        logs[order] = np.concatenate(p) if p else np.empty(0)
        n, mean, worst = _scores(coded, coded.hashes, logs)
        return pa.table({"k": left["k"], "l": left["l"], "n_symbols": pa.array(n),
                         "perplexity": pa.array(mean, mask=n == 0), "passage": pa.array(worst, mask=n == 0)})

    dealt = dealt.repartition(int(blocks * folds), "g")
    return _tidy(dealt.groupby("g").cogroup(answers.groupby("g")).applyInArrow(
        run, f"k {dict(docs.dtypes)[key]}, l string, n_symbols long, perplexity double, passage double"), "perplexities")
