"""SentencePiece encoding and decoding of merge-type (BPE) vocabularies by a score-ordered agenda.

A text's characters are symbols. Every adjacent pair of symbols whose
concatenation is a piece stands on an agenda, best score first and leftmost
among equals. The top pair is merged, the pairs it forms with its neighbours
join the agenda, and pairs whose symbols have changed meanwhile are passed
over. Symbols left without a piece fall back to byte pieces.

Merges never cross a place where no piece of the vocabulary holds both sides,
so a text is cut before each run of spaces, around line feeds and between
letters and other characters where the vocabulary allows it, and the ids of
short segments are kept for the next text. With every Arrow batch the library encodes the segments that
were worked out for it (whole texts where the vocabulary allows no cut) and
decodes all of its ids; a difference ends the job.
"""

from __future__ import annotations

import hashlib
import heapq
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from traitlens.llm.common import slices_by_chars

#: The vocabulary's mark of a space.
SPACE = "▁"
#: The longest segment whose agenda is a plain list searched for its best pair; longer ones take a heap.
SHORT = 48
#: Segments whose ids a worker keeps, and the longest of them; neither changes a result.
SEGMENTS_KEPT = 1_000_000
LONGEST_KEPT = 32
#: Characters of texts encoded and checked at a time.
BATCH_CHARS = 2_000_000


class Agenda(dict):
    """Ids (little-endian unsigned 32-bit) of segments, worked out when first asked for."""

    def __init__(self, scores: dict[str, float], ids: dict[str, int], byte_ids: list[int] | None, unknown: int):
        self.costs = {p: -s for p, s in scores.items()}
        self.ids, self.byte_ids, self.unknown = ids, byte_ids, unknown
        self.fresh: list[tuple[str, bytes]] = []

    def __missing__(self, segment: str) -> bytes:
        found = self.encode(segment)
        self.fresh.append((segment, found))
        if len(segment) <= LONGEST_KEPT:
            if len(self) >= SEGMENTS_KEPT:
                self.clear()
            self[segment] = found
        return found

    def encode(self, segment: str) -> bytes:
        out = []
        for piece in self.merged(segment):
            i = self.ids.get(piece)
            if i is not None:
                out.append(i)
            elif self.byte_ids:
                out.extend(self.byte_ids[b] for b in piece.encode("utf-8"))
            elif not out or out[-1] != self.unknown:  # a run of unknown symbols is one
                out.append(self.unknown)
        return np.array(out, "<u4").tobytes()

    def merged(self, segment: str) -> list[str]:
        """The pieces that stand when the agenda is empty."""
        if len(segment) > SHORT:
            return self._merged_by_heap(segment)
        cost, none = self.costs.get, float("inf")
        symbols = list(segment)
        agenda = [cost(a + b, none) for a, b in zip(symbols, symbols[1:])]
        while agenda:
            best = min(agenda)
            if best == none:
                break
            i = agenda.index(best)  # the leftmost of equals
            symbols[i:i + 2] = [symbols[i] + symbols[i + 1]]
            del agenda[i]
            if i < len(agenda):
                agenda[i] = cost(symbols[i] + symbols[i + 1], none)
            if i:
                agenda[i - 1] = cost(symbols[i - 1] + symbols[i], none)
        return symbols

    def _merged_by_heap(self, segment: str) -> list[str]:
        cost = self.costs.get
        symbols: list[str | None] = list(segment)
        n = len(symbols)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        agenda = []
        for i in range(n - 1):
            pair = segment[i:i + 2]
            c = cost(pair)
            if c is not None:
                agenda.append((c, i, i + 1, pair))
        heapq.heapify(agenda)
        while agenda:
            _, left, right, pair = heapq.heappop(agenda)
            a, b = symbols[left], symbols[right]
            if a is None or b is None or len(a) + len(b) != len(pair):
                continue  # one of the two has been merged since
            symbols[left], symbols[right] = pair, None
            far = after[left] = after[right]
            if far < n:
                before[far] = left
                joined = pair + symbols[far]
                c = cost(joined)
                if c is not None:
                    heapq.heappush(agenda, (c, left, far, joined))
            near = before[left]
            if near >= 0:
                joined = symbols[near] + pair
                c = cost(joined)
                if c is not None:
                    heapq.heappush(agenda, (c, near, left, joined))
        return [s for s in symbols if s is not None]


def _apart(pieces: list[str]) -> str:
    """Letters that are to count as other characters, so that no piece joins a letter to another character."""
    other: set[str] = set()
    pairs = {(a, b) for p in pieces for x, y in zip(p, p[1:]) for a, b in ((x, y), (y, x))}
    letter = {c: bool(re.match(r"[^\W\d_]", c)) for a in pairs for c in a}
    while more := {a for a, b in pairs if letter[a] and a not in other and b != SPACE
                   and (not letter[b] or b in other)}:
        other |= more
    return "".join(map(re.escape, sorted(other)))


class Codec:
    """Ids of whole texts and texts of ids under one vocabulary file."""

    def __init__(self, path: str):
        import sentencepiece

        self.library = sp = sentencepiece.SentencePieceProcessor(model_file=path)
        n = sp.get_piece_size()
        pieces = [sp.id_to_piece(i) for i in range(n)]
        plain = [i for i in range(n) if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i))]
        if any(sp.is_unused(i) for i in plain) or sp.normalize("a  \ufb01\xbd\tb") != \
                f"{SPACE}a{SPACE}{SPACE}\ufb01\xbd\tb":
            raise ValueError("vocabularies with unused pieces or rewritten characters are not supported")
        joint = [pieces[i] for i in plain if len(pieces[i]) > 1]
        byte_ids = [sp.piece_to_id(f"<0x{b:02X}>") for b in range(256)] \
            if any(sp.is_byte(i) for i in range(n)) else None
        self.agenda = Agenda({p: s for i in plain for p, s in [(pieces[i], sp.get_score(i))] if len(p) > 1},
                             {pieces[i]: i for i in plain}, byte_ids, sp.unk_id())
        # places that no piece spans: before a run of spaces, around line feeds, beside letters. Without byte
        # pieces a run of unknown symbols is one id and may span them.
        self.cuts = byte_ids is not None and not any("\n" in p or re.search(f"[^{SPACE}]{SPACE}", p) for p in joint)
        other = _apart(joint)
        word = rf"{SPACE}*[^\W\d_{other}]+|{SPACE}*(?:[^\w{SPACE}\n]|[\d_{other}])+"
        self.segments = re.compile(rf"{word}|\n|{SPACE}+").findall if self.cuts else lambda text: [text]
        self.begin, self.end = (np.array([i], "<u4").tobytes() for i in (sp.bos_id(), sp.eos_id()))
        self.surface = [b"" if sp.is_control(i) else " ⁇ ".encode() if sp.is_unknown(i)
                        else bytes([int(p[3:5], 16)]) if sp.is_byte(i) else p.replace(SPACE, " ").encode()
                        for i, p in enumerate(pieces)]

    def encode(self, text: str) -> bytes:
        """Ids with begin and end ids, as little-endian unsigned 32-bit integers."""
        body = b"".join(map(self.agenda.__getitem__, self.segments(SPACE + text.replace(" ", SPACE)))) if text else b""
        return self.begin + body + self.end

    def decode(self, ids: bytes) -> str:
        """The text of ids: surfaces in order, without the space that encoding puts in front."""
        raw = b"".join(map(self.surface.__getitem__, np.frombuffer(ids, "<u4").tolist()))
        return raw[raw.startswith(b" "):].decode("utf-8", "replace")

    def check(self, texts: list[str], ids: list[bytes], decoded: list[str]) -> None:
        """Raise unless the library gives the same ids, and the same texts back."""
        fresh, self.agenda.fresh = self.agenda.fresh, []
        if self.cuts:  # one text of all new segments, a line each
            feed = self.agenda["\n"]
            front = self.agenda[SPACE] + feed
            self.agenda.fresh = []
            texts, own = ["\n" + "\n".join(x for x, _ in fresh)], [front + feed.join(x for _, x in fresh)]
        else:
            own = [x[4:-4] for x in ids]
        for text, a, b in zip(texts, own, self.library.encode(texts, num_threads=1)):
            if a != np.array(b, "<u4").tobytes():
                raise ValueError(f"ids differ from the library's: {text[:200]!r}")
        back = self.library.decode([np.frombuffer(x, "<u4").tolist() for x in ids], num_threads=1)
        for a, b in zip(decoded, back):
            if a != b:
                raise ValueError(f"decoded text differs from the library's: {b[:200]!r}")


_codecs: dict[str, Codec] = {}


def codec(path: str) -> Codec:
    """The worker's codec of a vocabulary file."""
    if path not in _codecs:
        _codecs[path] = Codec(path)
    return _codecs[path]


def _batches(batches: Iterator[pa.RecordBatch], model_path: str):
    """(key and text rows, ids, decoded texts) of slices of Arrow batches, each checked against the library."""
    c = codec(model_path)
    for batch in batches:
        for part in slices_by_chars(batch, 1, BATCH_CHARS):
            texts = [t or "" for t in part.column(1).to_pylist()]
            ids = [c.encode(t) for t in texts]
            decoded = [c.decode(x) for x in ids]
            c.check(texts, ids, decoded)
            yield part, ids, decoded


def _keyed(docs: DataFrame, key: str, text: str) -> tuple[DataFrame, str]:
    rows = docs.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"))
    return rows, f"key {rows.schema['key'].dataType.simpleString()}"


def coded(docs: DataFrame, model_path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Ids and decoded text of every document: key, ``ids`` (binary, little-endian
    unsigned 32-bit, begin and end included) and ``decoded``.

    A null text counts as empty: begin and end ids alone, decoded to the empty
    string. Repeated rows and null keys are coded like others; an empty table
    gives no rows; other columns are not read. Texts are coded whole, however long.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, ids, decoded in _batches(batches, model_path):
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array(ids, pa.binary()), pa.array(decoded, pa.string())], ["key", "ids", "decoded"])

    rows, kind = _keyed(docs, key, text)
    return rows.mapInArrow(run, f"{kind}, ids binary, decoded string").withColumnRenamed("key", key)


def digests(docs: DataFrame, model_path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Number of ids, and SHA-256 of ids and of decoded text, of every document (rows as in ``coded``).

    The digests are taken beside the codec, so ids and texts stay in the worker.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, ids, decoded in _batches(batches, model_path):
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array([len(x) // 4 for x in ids], pa.int64()),
                 pa.array([hashlib.sha256(x).hexdigest() for x in ids], pa.string()),
                 pa.array([hashlib.sha256(x.encode("utf-8")).hexdigest() for x in decoded], pa.string())],
                ["key", "n_tokens", "ids_sha256", "decoded_sha256"])

    rows, kind = _keyed(docs, key, text)
    return rows.mapInArrow(run, f"{kind}, n_tokens long, ids_sha256 string, decoded_sha256 string") \
        .withColumnRenamed("key", key)
