"""Mixture-controlled packing: deficit round-robin over one token queue per source.

A round gives each source a quantum of tokens in proportion to its weight.
Quanta are fixed-point, and what a round leaves over of one (the deficit) is
carried to the next: after r rounds a source has been served floor(r * quantum)
tokens, whatever partition holds them. Every token's place in the packed
stream therefore follows from its place in its source's queue alone, so
windows are filled in parallel and without gaps.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterator
from itertools import chain, repeat
from operator import attrgetter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from traitlens.llm.common import released, slices_by_chars, written

WINDOW = 2048
END_ID = 1
#: Fixed-point digits of a quantum.
SHIFT = 16
#: Characters of texts tokenized at a time.
BATCH_CHARS = 1_000_000
#: Units (words, marks or other pieces) whose ids are kept; beyond, the half that was met most often stays.
PIECES_KEPT = 150_000


class _Kept:
    """Ids of units (words in lower case, marks after a word, or whole pieces), one after the other in a flat array."""

    def __init__(self):
        self.rows: dict[str, int] = {}
        self.flat, self.sizes, self.met = np.empty(0, np.uint16), np.empty(0, np.int64), np.empty(0, np.int64)

    @property
    def starts(self) -> np.ndarray:
        return np.cumsum(self.sizes) - self.sizes

    def add(self, units: list[str], ids: np.ndarray, sizes: list[int]) -> None:
        self.rows.update(zip(units, range(len(self.sizes), len(self.sizes) + len(units))))
        self.flat = np.concatenate((self.flat, ids))
        self.sizes = np.concatenate((self.sizes, np.array(sizes, np.int64)))
        self.met = np.concatenate((self.met, np.zeros(len(units), np.int64)))

    def cut(self, most: int) -> None:
        """Keep the units that were met in most slices; those of earlier cuts count half."""
        keep = np.sort(np.argsort(-self.met, kind="stable")[:most])
        self.flat = self.flat[_ranges(self.starts[keep], self.sizes[keep])[1]]
        row = np.full(len(self.sizes), -1)
        row[keep] = np.arange(len(keep))
        self.rows = {u: i for u, i in zip(self.rows, row.tolist()) if i >= 0}  # a dict keeps the order of its rows
        self.sizes, self.met = self.sizes[keep], self.met[keep] // 2


def _strings(units: pa.Array) -> list[str]:
    """Strings without blanks, as one joined string that is split again: much faster than one by one."""
    if not len(units):
        return []
    whole = pa.ListArray.from_arrays(pa.array([0, len(units)], pa.int32()), units)
    return pc.binary_join(whole, " ")[0].as_py().split(" ")


class Tokenizer:
    """Ids of whole texts, with the ids of white-space separated pieces kept.

    The vocabulary's rules drop white space and never join across it, so a text's
    ids are those of its ASCII-space-separated pieces in order (tested against whole texts).
    A piece of Latin letters, perhaps with ASCII marks other than apostrophes after
    them, is two units: the word, which goes straight to the vocabulary's merges in
    lower case, and the run of marks, which the rules never join to letters. Any
    other piece is one unit. Marks and other pieces are encoded by all rules.
    """

    LATIN = "A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff"
    PLAIN = f"^(?P<word>[{LATIN}]+)(?P<marks>[!-&(-/:-@\\[-`{{-~]*)$"

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core; threads only hold memory
        from tokenizers import Tokenizer as Model
        from tokenizers.pre_tokenizers import ByteLevel

        self.model = Model.from_file(path)
        self.merge = self.model.model.tokenize
        as_bytes = ByteLevel(add_prefix_space=False, use_regex=False)
        self.as_bytes = {chr(i): as_bytes.pre_tokenize_str(chr(i))[0][0] for i in range(0xdf, 0x100)}
        self.kept = _Kept()

    def _whole(self, texts: list[str], sizes: list[int]) -> Iterator[list[int]]:
        """Ids of each text by all rules; their numbers go to ``sizes``."""
        for e in self.model.encode_batch_fast(texts, add_special_tokens=False):
            ids = e.ids
            sizes.append(len(ids))
            yield ids

    def _merged(self, words: list[str], sizes: list[int]) -> Iterator[list]:
        """Tokens of each word of lower-case Latin letters; their numbers go to ``sizes``."""
        text = " ".join(words)
        if not text.isascii():
            for letter, form in self.as_bytes.items():  # no form holds a lower-case letter beyond ASCII
                text = text.replace(letter, form)
        for word in text.split(" "):
            tokens = self.merge(word)
            sizes.append(len(tokens))
            yield tokens

    def _rows(self, units: list[str], plain: np.ndarray) -> np.ndarray:
        """Where the ids of distinct units are kept; those of new ones are found first."""
        rows = np.fromiter(map(self.kept.rows.get, units, repeat(-1)), np.int64, len(units))
        new = rows < 0
        for texts, encode, number in (
                ([units[i] for i in np.flatnonzero(new & plain).tolist()], self._merged, attrgetter("id")),
                ([units[i] for i in np.flatnonzero(new & ~plain).tolist()], self._whole, None)):
            if texts:
                sizes: list[int] = []
                ids = chain.from_iterable(encode(texts, sizes))
                self.kept.add(texts, np.fromiter(map(number, ids) if number else ids, np.uint16), sizes)
        rows[new] = [self.kept.rows[units[i]] for i in np.flatnonzero(new).tolist()]
        self.kept.met[rows] += 1
        return rows

    def __call__(self, texts: pa.Array | list[str | None]) -> list[np.ndarray]:
        """Ids of every text, the end id last. Arrow splits the texts, numbers their distinct pieces and finds plain words."""
        if not len(texts):
            return []
        if len(self.kept.sizes) > PIECES_KEPT:
            self.kept.cut(PIECES_KEPT // 2)
        if isinstance(texts, list):
            texts = pa.array(texts, pa.string())
        pieces = pc.ascii_split_whitespace(pc.fill_null(texts, ""))  # blanks at an end leave an empty piece: no ids
        counts = pc.list_value_length(pieces).to_numpy()
        coded = pieces.flatten().dictionary_encode()
        del pieces
        parts = pc.extract_regex(coded.dictionary, self.PLAIN)
        words = pc.utf8_lower(pc.struct_field(parts, "word"))
        # each distinct piece is two units: its word and marks, or itself and none
        marks = pc.fill_null(pc.struct_field(parts, "marks"), "")
        units = pa.concat_arrays([pc.coalesce(words, coded.dictionary), marks]).dictionary_encode()
        number = units.indices.to_numpy()
        plain = np.zeros(len(units.dictionary), bool)
        plain[number[:len(words)][words.is_valid().to_numpy(zero_copy_only=False)]] = True
        row = self._rows(_strings(units.dictionary), plain)[number].reshape(2, -1).T
        starts, sizes = self.kept.starts[row].ravel(), self.kept.sizes[row]
        flat = self.kept.flat[_ranges(starts, sizes.ravel())[1]]
        sizes = sizes.sum(1)

        at = coded.indices.to_numpy()
        n = sizes[at]
        ids = flat[_ranges((np.cumsum(sizes) - sizes)[at], n)[1]]
        cuts = np.concatenate(([0], np.cumsum(n)))[np.cumsum(counts)]
        return [np.append(x, np.uint16(END_ID)) for x in np.split(ids, cuts[:-1])]


_tokenizers: dict[str, Tokenizer] = {}


def _tokenized(tokenizer_path: str):
    """Batches of (doc_id, source, text) -> rows with ids, their number and their place in this
    partition's share of the source's queue."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if tokenizer_path not in _tokenizers:
            _tokenizers[tokenizer_path] = Tokenizer(tokenizer_path)
        encode = _tokenizers[tokenizer_path]
        part = TaskContext.get().partitionId()
        served: dict[str | None, int] = {}
        for whole in batches:
            for batch in slices_by_chars(whole, 2, BATCH_CHARS):
                ids = encode(batch.column(2))
                before = []
                for source, x in zip(batch.column(1).to_pylist(), ids):
                    before.append(served.get(source, 0))
                    served[source] = before[-1] + len(x)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), batch.column(1), pa.array([part] * len(ids), pa.int32()),
                     pa.array(before, pa.int64()), pa.array(map(len, ids), pa.int64()),
                     pa.array([x.astype("<u2").tobytes() for x in ids], pa.binary())],
                    ["doc_id", "source", "part", "before", "n", "ids"])
    return run


def served(rounds: np.ndarray, quanta: np.ndarray, totals: np.ndarray) -> np.ndarray:
    """Tokens that each source has given after each number of rounds (rounds x sources)."""
    return np.minimum((rounds[:, None] * quanta[None, :]) >> SHIFT, totals[None, :])


def pieces_of(s: np.ndarray, start: np.ndarray, n: np.ndarray, quanta: np.ndarray, totals: np.ndarray, window: int):
    """(document, first token, tokens, place in the packed stream) of all documents' pieces.

    Document i holds ``n[i]`` tokens of source ``s[i]`` from ``start[i]`` on in its queue.
    """
    # the round that serves token t is the largest r with floor(r * quantum) <= t
    first, last = ((((t + 1) << SHIFT) - 1) // quanta[s] for t in (start, start + n - 1))
    doc, r = _ranges(first, last - first + 1)
    given, after = served(r, quanta, totals), served(r + 1, quanta, totals)
    at, own = np.arange(len(r)), s[doc]
    a = np.maximum(given[at, own], start[doc])
    b = np.minimum(after[at, own], (start + n)[doc])
    turn = after - given
    place = given.sum(1) + (np.cumsum(turn, 1) - turn)[at, own] + a - given[at, own]
    some = b > a
    doc, a, b, place = doc[some], a[some], b[some], place[some]
    # cut where a window ends
    k, w = _ranges(place // window, (place + b - a - 1) // window - place // window + 1)
    lo = np.maximum(place[k], w * window)
    hi = np.minimum((place + b - a)[k], (w + 1) * window)
    return doc[k], a[k] + lo - place[k] - start[doc[k]], hi - lo, lo


def _ranges(first: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Row numbers and values of first, first + 1, ... of each row."""
    ends = np.cumsum(sizes)
    at = np.repeat(first - (ends - sizes), sizes)
    at += np.arange(len(at))
    return np.repeat(np.arange(len(first)), sizes), at


def pack(docs: DataFrame, tokenizer_path: str, weights: dict[str | None, float] | None = None,
         window: int = WINDOW, key: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """Pieces of all documents in gapless windows of ``window`` ids.

    ``weights`` are the sources' target shares of every window (default: their
    shares of all tokens, so no queue runs dry early); a source without one
    gets the smallest. When a queue is empty, later rounds are shared by the
    others. Null and empty texts are the end id alone; null sources are a queue
    of their own; null keys and repeated rows are packed like others. Only the
    last window is not full. The sources must be few enough for one row each on
    the driver (they are the mixture's components).
    """
    rows = docs.select(F.col(key).alias("doc_id"), F.col(source).cast("string").alias("source"),
                       F.col(text).cast("string").alias("text"))
    kind = dict(rows.dtypes)["doc_id"]
    ids = written(rows.mapInArrow(
        released(_tokenized(tokenizer_path)),
        f"doc_id {kind}, source string, part int, before long, n long, ids binary"), "token-ids")

    # queue places: each partition's share of a source starts after those of earlier partitions
    shares = ids.groupBy("source", "part").agg(F.sum("n").alias("tokens"))
    w = Window.partitionBy("source").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = written(shares.select("source", "part", "tokens",
                                  F.coalesce(F.sum("tokens").over(w), F.lit(0)).alias("base")), "queue-bases")
    totals = {r[0]: r[1] for r in bases.groupBy("source").agg(F.sum("tokens")).collect()}
    names = sorted(totals, key=lambda x: (x is not None, x))
    number = {x: i for i, x in enumerate(names)}
    total = np.array([totals[x] for x in names], np.int64)
    least = min([v for v in (weights or {}).values() if v > 0], default=1.0)
    share = np.array([max((weights or {}).get(x, least), 1e-12) for x in names]) if weights else total.astype(float)
    quanta = np.maximum(1, np.round(share / max(share.sum(), 1) * window * (1 << SHIFT))).astype(np.int64) \
        if len(names) else np.empty(0, np.int64)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for i in range(0, whole.num_rows, 256):
                batch = whole.slice(i, 256)
                src, raw = batch.column(1).to_pylist(), batch.column(4).to_pylist()
                at, n = (batch.column(c).to_numpy() for c in (2, 3))
                row, start, length, place = pieces_of(np.array([number[x] for x in src], np.int64), at, n,
                                                      quanta, total, window)
                data = [np.frombuffer(x, "<u2").astype("<u4").tobytes() for x in raw]
                crc = np.array([zlib.crc32(data[j][4 * a:4 * b]) for j, a, b in zip(
                    row.tolist(), start.tolist(), (start + length).tolist())], np.int64)
                n = n[row]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(row)), *map(pa.array, (start, length, crc, n, place // window,
                                                                          place % window)),
                     batch.column(1).take(pa.array(row))],
                    ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "source"])

    placed = ids.alias("i").join(bases.alias("b"), F.expr("i.part = b.part and i.source <=> b.source")) \
        .select("i.doc_id", "i.source", (F.col("base") + F.col("before")).alias("at"), "n", "ids")
    return placed.mapInArrow(
        released(cut), f"doc_id {kind}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, "
             "offset long, source string").withColumnRenamed("doc_id", key)
