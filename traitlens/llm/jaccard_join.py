"""N-gram Jaccard self-join by chosen paths.

Texts become sets of five-word shingles; equal sets are one class. A class has
``TOKENS`` min-hash tokens. From the root of each run, a node of the tree
chooses 1 / similarity tokens on average and splits its sets by their values,
until a bucket is small or ``DEPTH`` is reached; such a bucket is compared
whole (in blocks over several tasks if it is large). Runs repeat until pairs at
the similarity are met with the target probability, whatever the depth.

Sets that meet are only candidates. Their connected groups are gathered once,
with whole shingle sets, and every pair of a group is compared exactly. Large
groups are split into pairs of blocks, so no task holds more than two blocks.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from traitlens.llm.common import SHINGLE, SIMILARITY, by_group, mix, released, shingle_set, streamed_groups, words_of, written
from traitlens.llm.components import components

TOKENS = 64
DEPTH = 4
RECALL = 0.99
#: Sets of a bucket that is compared whole, of a bucket that one task splits, and of a block.
LEAF, BUCKET, BLOCK = 64, 4096, 512
#: Candidates may fall short of the similarity by this much in their tokens (4 standard deviations).
SLACK = 0.2
#: Bits of the filter that spares most texts a second reading (fixed size; a full one only filters less).
FILTER_BITS = 1 << 24

_MULTIPLIERS = mix(np.arange(1, TOKENS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)
_ADDENDS = mix(_MULTIPLIERS)


def runs_for(similarity: float, recall: float = RECALL, depth: int = DEPTH) -> int:
    """Runs after which a pair at the similarity has met with probability ``recall`` at the full depth."""
    second = 1 / similarity - 1  # chance that a node chooses a second token
    level = (1 - second) * similarity + second * (1 - (1 - similarity) ** 2)
    return max(1, math.ceil(math.log(1 - recall) / math.log(1 - level ** depth)))


def tokens_of(sets: list[np.ndarray]) -> np.ndarray:
    """Min-hash tokens, one row per non-empty set."""
    flat = np.concatenate(sets)
    starts = np.concatenate(([0], np.cumsum([len(s) for s in sets])))[:-1]
    out = np.empty((len(sets), TOKENS), np.uint32)
    for i in range(TOKENS):
        out[:, i] = np.minimum.reduceat((flat * _MULTIPLIERS[i] + _ADDENDS[i]) >> np.uint64(32), starts)
    return out


def _hash(*parts) -> np.uint64:
    h = np.uint64(len(parts))
    with np.errstate(over="ignore"):
        for p in parts:
            h = mix(np.array([h * np.uint64(31) + np.uint64(p)], np.uint64))[0]
    return h


def chosen(path: int, similarity: float) -> list[int]:
    """The tokens that a node splits on: one, or two so that the mean is 1 / similarity."""
    h = int(_hash(np.uint64(path & (1 << 64) - 1)))
    first = h % TOKENS
    if (h >> 32) / 2 ** 32 < 1 / similarity - 1:
        return [first, (first + 1 + (h >> 8) % (TOKENS - 1)) % TOKENS]
    return [first]


def children(path: int, tokens: np.ndarray, similarity: float) -> list[np.ndarray]:
    """For each chosen token, the child path (signed 64 bits) of every row."""
    base = np.uint64(path & (1 << 64) - 1)
    with np.errstate(over="ignore"):
        return [mix(base * np.uint64(0x9E3779B97F4A7C15) + np.uint64(i + 1)
                    + (tokens[:, i].astype(np.uint64) << np.uint64(7))).view(np.int64)
                for i in chosen(path, similarity)]


def _labels(linked: np.ndarray) -> np.ndarray:
    """Least index of each row's component of a symmetric boolean matrix."""
    n = len(linked)
    label = np.arange(n)
    reach = linked | np.eye(n, dtype=bool)
    while True:
        heard = np.where(reach, label[None, :], n).min(1)
        heard = heard[heard]
        if (heard == label).all():
            return label
        label = heard


def _meeting(a: np.ndarray, b: np.ndarray, least: int) -> np.ndarray:
    """Pairs of rows that agree in at least ``least`` tokens (one byte of each is compared)."""
    out = np.empty((len(a), len(b)), bool)
    step = max(1, (1 << 22) // max(1, len(b) * TOKENS))
    for i in range(0, len(a), step):
        out[i:i + step] = (a[i:i + step, None, :] == b[None, :, :]).sum(2, dtype=np.uint8) >= least
    return out


def _stars(linked: np.ndarray) -> Iterator[tuple[int, int]]:
    label = _labels(linked)
    for i in np.flatnonzero(label != np.arange(len(label))):
        yield int(i), int(label[i])


def _bucket_edges(tokens: np.ndarray, path: int, depth: int, similarity: float,
                  least: int, leaf: int) -> Iterator[tuple[int, int]]:
    """Edges that connect the rows which meet in the subtree of a bucket."""
    bytes_ = (tokens & 0xFF).astype(np.uint8)
    todo = [(np.arange(len(tokens)), path, depth)]
    while todo:
        rows, at, level = todo.pop()
        if len(rows) <= leaf or level >= DEPTH:
            some = bytes_[rows]
            for i, j in _stars(_meeting(some, some, least)):
                yield int(rows[i]), int(rows[j])
            continue
        for child in children(at, tokens[rows], similarity):
            order = np.argsort(child, kind="stable")
            cuts = np.flatnonzero(np.diff(child[order])) + 1
            for part in np.split(order, cuts):
                if len(part) > 1:
                    todo.append((rows[part], int(child[part[0]]), level + 1))


def _token_matrix(column: pa.ChunkedArray) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), "<u4").reshape(-1, TOKENS)


def _sketch(shingle: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for i in range(0, whole.num_rows, 1024):
                batch = whole.slice(i, 1024)
                sets = [shingle_set(words_of(t), shingle) for t in batch.column(1).to_pylist()]
                full = [j for j, s in enumerate(sets) if len(s)]
                tokens: list[bytes | None] = [None] * len(sets)
                if full:
                    for j, row in zip(full, tokens_of([sets[j] for j in full])):
                        tokens[j] = row.astype("<u4").tobytes()
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), batch.column(2),
                     pa.array([hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None
                               for s in sets], pa.binary()), pa.array(tokens, pa.binary())],
                    ["id", "text_hash", "key", "tokens"])
    return run


def _grow(similarity: float, runs: int):
    """Rows with a bucket's path (or none, for the roots) -> rows of its children."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            tokens = _token_matrix(batch.column("tokens"))
            if "path" in batch.schema.names:
                paths = batch.column("path").to_numpy()
                nodes = [(int(p), np.flatnonzero(paths == p)) for p in np.unique(paths)]
            else:
                nodes = [(r + 1, np.arange(len(tokens))) for r in range(runs)]
            for path, rows in nodes:
                for child in children(path, tokens[rows], similarity):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(child), batch.column("key").take(pa.array(rows))], ["path", "key"])
    return run


def _compare_buckets(similarity: float, leaf: int):
    least = math.ceil((similarity - SLACK) * TOKENS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in streamed_groups(batches, "gid"):
            keys, tokens = group.column("key"), _token_matrix(group.column("tokens"))
            side = group.column("side").to_numpy()
            if side[0] < 0:
                edges = list(_bucket_edges(tokens, group.column("path")[0].as_py(), group.column("depth")[0].as_py(),
                                           similarity, least, leaf))
            else:  # two blocks of a bucket that cannot be split further
                edges = list(_stars(_cross(side, lambda a, b: _meeting(a, b, least), (tokens & 0xFF).astype(np.uint8))))
            if edges:
                a, b = (keys.take(pa.array(x)).combine_chunks() for x in zip(*edges))
                yield pa.RecordBatch.from_arrays([a, b], ["a", "b"])
    return run


def _cross(side: np.ndarray, compare, rows: np.ndarray) -> np.ndarray:
    """Symmetric matrix of one block with itself, or only between two blocks."""
    if side[0] == 2:
        return compare(rows, rows)
    a, b = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
    out = np.zeros((len(rows), len(rows)), bool)
    out[np.ix_(a, b)] = compare(rows[a], rows[b])
    return out | out.T


def in_blocks(rows: DataFrame, group: str, block: int) -> DataFrame:
    """Deal ``rows`` (with ``key`` and the group's size ``n``) to tasks: columns ``gid`` and ``side``.

    A group of up to ``block`` rows is one task's (side 2); a larger one is cut
    into blocks: each block with itself (side 2) and each pair of blocks (sides
    0 and 1, of which one may be empty) is a task's.
    """
    rows = rows.withColumn("_b", F.ceil(F.col("n") / block)) \
        .withColumn("_at", F.pmod(F.xxhash64("key"), F.col("_b")))
    rows = rows.withColumn("_other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_b") - 1)))
    lo, hi = F.least("_at", "_other"), F.greatest("_at", "_other")
    return rows.withColumn("side", F.when(F.col("_at") == F.col("_other"), 2).otherwise(
        (F.col("_at") > F.col("_other")).cast("int"))) \
        .withColumn("gid", F.xxhash64(F.col(group), lo, hi)).drop("_b", "_at", "_other")


def candidates(classes: DataFrame, similarity: float, recall: float = RECALL, leaf: int = LEAF,
               bucket: int = BUCKET, block: int = BLOCK) -> DataFrame:
    """Edges (a, b) between classes (key, tokens) that meet in a bucket and agree in enough tokens."""
    runs = runs_for(similarity, recall)
    grown = classes.select("key", "tokens").mapInArrow(_grow(similarity, runs), "path long, key binary")
    taken = None
    for depth in range(1, DEPTH + 1):
        paths = written(grown, "paths")
        sizes = written(paths.groupBy("path").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "path-sizes")
        members = paths.join(sizes, "path").withColumn("depth", F.lit(depth))
        here = members.where(F.col("n") <= bucket) if depth < DEPTH else members
        taken = here if taken is None else taken.unionByName(here)
        large = sizes.where(F.col("n") > bucket)
        if depth == DEPTH or large.isEmpty():
            break
        grown = paths.join(large, "path").join(classes.select("key", "tokens"), "key") \
            .mapInArrow(_grow(similarity, runs), "path long, key binary")
    split = in_blocks(taken.where(F.col("n") > bucket), "path", block)
    whole = taken.where(F.col("n") <= bucket).withColumn("side", F.lit(-1)).withColumn("gid", F.col("path"))
    rows = whole.unionByName(split).join(classes.select("key", "tokens"), "key")
    return by_group(rows.select("gid", "side", "path", "depth", "key", "tokens"), "gid",
                    _compare_buckets(similarity, leaf), "a binary, b binary")


def shared_counts(a: list[np.ndarray], b: list[np.ndarray]) -> np.ndarray:
    """Sizes of all intersections between two lists of sets, by products of 0/1 matrices."""
    every = np.concatenate((*a, *b))
    values, code = np.unique(every, return_inverse=True)
    twice = np.bincount(code, minlength=len(values)) > 1
    place = np.cumsum(twice) - 1
    row = np.repeat(np.arange(len(a) + len(b)), [len(s) for s in (*a, *b)])
    use = twice[code]
    row, column = row[use], place[code[use]]
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    width = max(256, min(8192, (1 << 22) // max(1, len(a) + len(b))))
    out = np.zeros((len(a), len(b)), np.float32)
    for start in range(0, int(twice.sum()), width):
        i, j = np.searchsorted(column, (start, start + width))
        x = np.zeros((len(a) + len(b), width), np.float32)
        x[row[i:j], column[i:j] - start] = 1
        out += x[:len(a)] @ x[len(a):].T
    return out


def _verify(similarity: float, every_pair: bool):
    def linked(a: list[np.ndarray], b: list[np.ndarray]) -> np.ndarray:
        common = shared_counts(a, b)
        na, nb = (np.array([len(s) for s in x], np.float64) for x in (a, b))
        return common / (na[:, None] + nb[None, :] - common)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in streamed_groups(batches, "gid"):
            sets = [np.frombuffer(x, "<u8") for x in group.column("shingles").to_pylist()]
            side, copies = group.column("side").to_numpy(), group.column("copies").to_numpy()
            keys, n = group.column("key").combine_chunks(), len(sets)
            a, b = (np.arange(n),) * 2 if side[0] == 2 else (np.flatnonzero(side == 0), np.flatnonzero(side == 1))
            if not len(a) or not len(b):
                continue
            alike = linked([sets[i] for i in a], [sets[i] for i in b])
            link = np.zeros((n, n), bool)
            link[np.ix_(a, b)] = alike >= similarity - 1e-9
            link |= link.T
            np.fill_diagonal(link, False)
            some = np.flatnonzero(link.any(1))
            if not len(some):
                continue
            if every_pair:
                x, y = np.nonzero(np.triu(link))
                score = np.zeros((n, n))
                score[np.ix_(a, b)] = alike
                score = np.maximum(score, score.T)[x, y]
            else:
                x, y = (np.array(v) for v in zip(*_stars(link)))
                score = np.ones(len(x))
            k = len(x)
            yield pa.RecordBatch.from_arrays(
                [pa.concat_arrays([keys.take(pa.array(some)), keys.take(pa.array(x))]),
                 pa.concat_arrays([pa.nulls(len(some), pa.binary()), keys.take(pa.array(y))]),
                 pa.array(np.concatenate((link[some].sum(1), np.zeros(k, np.int64)))),
                 pa.array(np.concatenate((link[some] @ copies, np.zeros(k, np.int64)))),
                 pa.array(np.concatenate((np.zeros(len(some)), score)))],
                ["a", "b", "links", "linked_copies", "similarity"])
    return run


def _filter_of(hashes: DataFrame, column: str):
    """Broadcast bits of a column of 64-bit hashes: at most FILTER_BITS / 64 rows reach the driver, whatever the corpus."""
    at = F.col(column).bitwiseAND(F.lit(FILTER_BITS - 1))
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), at.bitwiseAND(F.lit(63)).cast("int"))
    words = np.zeros(FILTER_BITS // 64, np.uint64)
    for i, w in hashes.groupBy(F.shiftright(at, 6).alias("i")).agg(F.bit_or(bit).alias("w")).collect():
        words[i] = w & (1 << 64) - 1
    return hashes.sparkSession.sparkContext.broadcast(words)


def _held(bits, hashes: pa.Array) -> np.ndarray:
    """Which hashes the filter holds (all that were put in, and some others)."""
    h = hashes.to_numpy().view(np.uint64) & np.uint64(FILTER_BITS - 1)
    return (bits.value[(h >> np.uint64(6)).astype(np.int64)] >> (h & np.uint64(63))) & np.uint64(1) == 1


def _where_held(bits, column: str, held: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(_held(bits, batch.column(column)) == held))
    return run


def _gather(shingle: int, bits):
    """Shingle sets of the texts whose hash the filter holds, each set once per task."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = set()
        for batch in batches:
            texts = batch.column(0).take(pa.array(np.flatnonzero(_held(bits, batch.column(1)))))
            for i in range(0, len(texts), 256):
                rows = {}
                for t in texts.slice(i, 256).to_pylist():
                    s = shingle_set(words_of(t), shingle).astype("<u8").tobytes()
                    key = hashlib.blake2b(s, digest_size=16).digest()
                    if s and key not in seen:
                        seen.add(key)
                        rows[key] = s
                if rows:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(rows.keys(), pa.binary()), pa.array(rows.values(), pa.binary())], ["key", "shingles"])
    return run


class JaccardJoin:
    """The join's tables: ``rows`` (id, key), ``classes`` (key, rep, copies), ``links``."""

    def __init__(self, docs: DataFrame, key: str = "doc_id", text: str = "text", similarity: float = SIMILARITY,
                 shingle: int = SHINGLE, recall: float = RECALL, every_pair: bool = False, leaf: int = LEAF,
                 bucket: int = BUCKET, block: int = BLOCK):
        texts = docs.select(F.col(key).alias("id"), F.col(text).cast("string").alias("t"))
        texts = texts.withColumn("h", F.xxhash64("t"))
        kind = dict(texts.dtypes)["id"]
        self.rows = written(texts.mapInArrow(
            released(_sketch(shingle)), f"id {kind}, text_hash long, key binary, tokens binary"), "sketches")
        self.classes = written(self.rows.where("key is not null").groupBy("key").agg(
            F.min("id").alias("rep"), F.count(F.lit(1)).alias("copies"), F.min("text_hash").alias("text_hash"),
            F.first("tokens").alias("tokens")), "classes")
        met = written(components(candidates(self.classes, similarity, recall, leaf, bucket, block)), "met")

        groups = written(met.join(met.groupBy("label").agg(F.count(F.lit(1)).alias("n")), "label")
                         .join(self.classes.select(F.col("key").alias("node"), "copies", "text_hash"), "node")
                         .withColumnRenamed("node", "key"), "groups")
        bits = _filter_of(groups, "text_hash")
        sets = texts.where("t is not null").select("t", "h") \
            .mapInArrow(released(_gather(shingle, bits)), "key binary, shingles binary") \
            .groupBy("key").agg(F.first("shingles").alias("shingles"))
        dealt = in_blocks(groups.select("key", "label", "n", "copies"), "label", block).join(sets, "key")
        found = written(by_group(dealt.select("gid", "side", "key", "copies", "shingles"), "gid",
                                 _verify(similarity, every_pair),
                                 "a binary, b binary, links long, linked_copies long, similarity double"), "verified")
        #: (a, b, similarity): links, or (without ``every_pair``) enough of them to connect the groups
        self.links = found.where("b is not null").select("a", "b", "similarity")
        counts = found.where("b is null").groupBy(F.col("a").alias("key")).agg(
            F.sum("links").alias("n_links"), F.sum("linked_copies").alias("linked_copies"))
        label = written(components(self.links).select(F.col("node").alias("key"), "label"), "link-groups")
        named = self.classes.select("key", "rep", "copies").join(counts, "key", "left").join(label, "key", "left")
        named = named.withColumn("label", F.coalesce("label", "key"))
        least = named.groupBy("label").agg(F.min("rep").alias("class_id"))
        #: one row per distinct shingle set
        self.classified = written(named.join(least, "label").select(
            "key", "label", "rep", "copies", "class_id", F.coalesce("n_links", F.lit(0)).alias("n_links"),
            (F.col("copies") - 1 + F.coalesce("linked_copies", F.lit(0))).alias("n_similar")), "classified")

    def documents(self, key: str = "doc_id") -> DataFrame:
        return self.rows.select("id", "key").join(self.classified, "key", "left").select(
            F.col("id").alias(key), F.coalesce("class_id", F.when(F.col("key").isNull(), F.col("id"))).alias("class_id"),
            F.coalesce("rep", F.when(F.col("key").isNull(), F.col("id"))).alias("copy_id"),
            F.coalesce("copies", F.lit(1)).alias("n_copies"), F.coalesce("n_links", F.lit(0)).alias("n_links"),
            F.coalesce("n_similar", F.lit(0)).alias("n_similar"))


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """One row per row of ``docs``.

    ``class_id`` is the least key of all texts joined directly or through
    others, ``copy_id`` that of the texts with the same shingles, ``n_copies``
    their number, ``n_links`` the other shingle sets at the similarity or
    above, ``n_similar`` all other rows that are copies or linked. Texts
    without words (null, empty) join nothing: their ids are their own key.
    Texts of one to four words have their words as the only shingle. Null keys
    are never least; a class of null keys only has a null id.
    """
    return JaccardJoin(docs, key, text, **options).documents(key)


def pairs(docs: DataFrame, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """(a, b, similarity) between the least keys of all classes that are linked; a < b."""
    join = JaccardJoin(docs, key, text, every_pair=True, **options)
    named = join.classes.select("key", "rep")
    return join.links.join(named.selectExpr("key as a", "rep as x"), "a").join(
        named.selectExpr("key as b", "rep as y"), "b") \
        .select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"), "similarity")


def one_of_each(docs: DataFrame, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` with one per class: that of the least key (null last), then of the least text hash.

    Rows without words stay. Of repeated rows (equal key and text) one stays.
    Rows are dealt by key and text, so a class may be of any size.
    """
    columns = docs.columns
    join = JaccardJoin(docs, key, text, **options)
    rows = join.rows.where("key is not null").join(join.classified.select("key", "label"), "key") \
        .select("label", "id", F.col("text_hash").alias("h"))
    rank = F.struct(F.col("id").isNull().alias("n"), F.col("id"), F.col("h"))
    first = written(rows.groupBy("label").agg(F.min(rank).alias("first")), "first-of-class")
    each = F.struct("id", "h").alias("_row")
    gone = written(rows.join(first, "label").where(rank != F.col("first")).select(each).distinct(), "near-copies")
    repeated = written(rows.groupBy("id", "h").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(each), "repeated")

    whole = docs.select(F.struct(*[F.col(c) for c in columns]).alias("_doc"), F.struct(
        F.col(key).alias("id"), F.xxhash64(F.col(text).cast("string")).alias("h")).alias("_row")) \
        .withColumn("_hash", F.xxhash64("_row"))
    # rows that are surely neither gone nor repeated stay where they are; only the rest is shuffled
    bits = _filter_of(gone.unionByName(repeated).select(F.xxhash64("_row").alias("_hash")), "_hash")
    stay = whole.mapInArrow(released(_where_held(bits, "_hash", False)), whole.schema).select("_doc")
    kept = written(whole.mapInArrow(released(_where_held(bits, "_hash", True)), whole.schema).join(gone, "_row", "left_anti"),
                   "perhaps-repeated")
    once = kept.join(repeated, "_row", "left_semi").groupBy("_row").agg(F.first("_doc").alias("_doc"))
    kept = stay.unionByName(kept.join(repeated, "_row", "left_anti").select("_doc")).unionByName(once.select("_doc"))
    return kept.select([F.col("_doc").getField(c).alias(c) for c in columns])
