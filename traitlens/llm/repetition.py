"""Quality rules: repetition inside a text from a suffix array and its LCP intervals.

Words are compared. Per Arrow batch, the suffixes that share at least
``min_words`` words with another suffix of the same text are sorted by prefix
doubling; neighbours' longest common prefixes give the maximal repeated
substrings. Every suffix in an LCP interval covers its longest common prefix.
The union of the spans of at least so many words is limited for each of several
lengths (the longer the repeats, the smaller the share), and so is the longest
repeat; all come from the same LCP array.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from traitlens.llm.common import mix, released, slices_by_chars, word_codes, words_of

SYMBOLS = "#*$%&|<>"
_SPACES = " \t\n\x0b\x0c\r"
#: Words of one block of texts that are sorted together; a longer text is a block of its own.
BLOCK_WORDS = 150_000
#: Characters of texts that ``keep_quality`` holds as Python strings at a time.
SLICE_CHARS = 2_000_000


@dataclass(frozen=True)
class Limits:
    min_words: int = 5           # words of the shortest repeat that counts
    #: (words of a repeat, greatest percentage of words in repeats of that length or more); the published
    #: limits for duplicate n-grams of five to ten words
    max_covered: tuple[tuple[int, int], ...] = ((5, 15), (6, 14), (7, 13), (8, 12), (9, 11), (10, 10))
    max_longest: int = 100       # words of the longest repeat
    min_text_words: int = 10     # base rule
    max_repeat_percent: int = 20  # base rule


def _dense(keys: np.ndarray) -> np.ndarray:
    return np.unique(keys, return_inverse=True)[1].astype(np.int64)


def repeats(docs: list[list[bytes]], min_words: int) -> tuple[np.ndarray, np.ndarray]:
    """Per text, the words covered by repeats of ``min_words`` or more, and the longest repeat."""
    covered, longest = covered_by(docs, (min_words,))
    return covered[0], longest


def covered_by(docs: list[list[bytes]], lengths: tuple[int, ...]) -> tuple[np.ndarray, np.ndarray]:
    """Words covered by repeats of each of ``lengths`` or more (lengths x texts), and each text's longest repeat."""
    n_docs, min_words = len(docs), min(lengths)
    covered = np.zeros((len(lengths), n_docs), np.int64)
    longest = np.zeros(n_docs, np.int64)
    code_of = word_codes()
    sizes = np.fromiter(map(len, docs), np.int64, n_docs)
    # one sentinel ends each text: it is unlike every word and every other sentinel
    starts = np.concatenate(([0], np.cumsum(sizes + 1)))
    n = int(starts[-1])
    if not n_docs or sizes.max(initial=0) <= min_words:
        return covered, longest
    codes = np.empty(n + min_words, np.int64)
    doc = np.repeat(np.arange(n_docs), sizes + 1)
    flat = np.ones(n, bool)
    flat[starts[1:] - 1] = False
    codes[:n][flat] = code_of([w for words in docs for w in words]) + n_docs + min_words
    codes[:n][~flat] = np.arange(n_docs)
    codes[n:] = n_docs + np.arange(min_words)

    # suffixes whose first min_words words occur again in the same text
    h = doc.astype(np.uint64)
    for j in range(min_words):
        h = h * np.uint64(0x9E3779B97F4A7C15) + codes[j:n + j].astype(np.uint64)
    h = mix(h)
    ordered = np.sort(h)
    twice = np.unique(ordered[1:][ordered[1:] == ordered[:-1]])
    if not len(twice):
        return covered, longest
    found = np.searchsorted(twice, h)
    found[found == len(twice)] = 0
    suffixes = np.flatnonzero(twice[found] == h)
    # blocks right after a repeated one decide the order of suffixes that share it
    ends = suffixes + min_words
    at = np.unique(np.concatenate((suffixes, ends[ends < n])))
    slot = np.full(n, -1, np.int64)
    slot[at] = np.arange(len(at))

    # suffix array by prefix doubling: rank of the first min_words words, then of twice as many
    rank = doc[at].copy()
    span = int(codes.max()) + 1
    for j in range(min_words):
        rank = _dense(rank * span + codes[at + j])
    levels, width = [rank], min_words
    while rank.max() + 1 < len(at):
        nxt = at + width
        inside = nxt < n
        after = np.where(inside, slot[np.where(inside, nxt, 0)], -1)
        second = np.where(after >= 0, rank[after], -1)
        finer = _dense(rank * (len(at) + 1) + second + 1)
        if finer.max() == rank.max():  # only unlike suffixes are left apart
            break
        rank = finer
        levels.append(rank)
        width *= 2

    # longest common prefix of neighbours, by the stored ranks from the longest down
    order = at[np.argsort(rank, kind="stable")]
    a, b = order[:-1], order[1:]
    lcp = np.zeros(len(a), np.int64)
    for level in range(len(levels) - 1, -1, -1):
        x, y = a + lcp, b + lcp
        inside = (x < n) & (y < n)
        sx, sy = slot[np.where(inside, x, 0)], slot[np.where(inside, y, 0)]
        same = inside & (sx >= 0) & (sy >= 0)
        same &= levels[level][sx] == levels[level][sy]
        lcp += same * (min_words << level)
    for _ in range(min_words - 1):
        x, y = np.minimum(a + lcp, n), np.minimum(b + lcp, n)
        lcp += (lcp >= min_words) & (codes[x] == codes[y]) & (x < n) & (y < n)
    lcp[(lcp < min_words) | (doc[a] != doc[b])] = 0

    # LCP intervals: each suffix covers the longer of its two neighbours' common prefixes
    reach = np.zeros(n, np.int64)
    np.maximum.at(reach, a, lcp)
    np.maximum.at(reach, b, lcp)
    p = np.flatnonzero(reach)
    np.maximum.at(longest, doc[p], reach[p])
    for i, length in enumerate(lengths):
        p = p[reach[p] >= length] if i and length >= lengths[i - 1] else np.flatnonzero(reach >= length)
        if len(p):
            # spans start in order; a word counts once, for the first span that holds it
            end = np.maximum.accumulate(p + reach[p])
            new = end - np.maximum(p, np.concatenate(([0], end[:-1])))
            covered[i] = np.bincount(doc[p], weights=new, minlength=n_docs).astype(np.int64)
    return covered, longest


def text_counts(text: str | None) -> tuple[list[bytes], int, int, int]:
    """(words, word_chars, n_symbols, n_dup_lines) of a text; null has none."""
    if not text:
        return [], 0, 0, 0
    lines = [x for x in text.encode("utf-8", "surrogatepass").split(b"\n") if x.strip()]
    return (words_of(text), len(text) - sum(map(text.count, _SPACES)),
            sum(map(text.count, SYMBOLS)), len(lines) - len(set(lines)))


_OUT = [("n_words", pa.int64()), ("word_chars", pa.int64()), ("n_symbols", pa.int64()),
        ("n_dup_lines", pa.int64()), ("n_repeat_words", pa.int64()), ("base_failed", pa.bool_()),
        ("kept", pa.bool_()), ("longest_repeat", pa.int64()), ("covered", pa.float64())]


def measure(texts: list[str | None], limits: Limits) -> dict[str, np.ndarray]:
    """The columns of ``_OUT`` for a list of texts, in blocks of bounded words."""
    counts = [[], [], [], []]
    covered, longest, block, held = [], [], [], 0
    lengths = (limits.min_words, *(n for n, _ in limits.max_covered))

    def sort_block() -> None:
        nonlocal block, held
        c, m = covered_by(block, lengths)
        covered.append(c)
        longest.append(m)
        block, held = [], 0

    for text in texts:
        words, *rest = text_counts(text)
        for column, x in zip(counts, (len(words), *rest)):
            column.append(x)
        block.append(words)
        held += len(words)
        if held >= BLOCK_WORDS:
            sort_block()
    sort_block()
    n_words, chars, symbols, dup = (np.array(x, np.int64) for x in counts)
    (covered, *others), longest = np.concatenate(covered, axis=1), np.concatenate(longest)
    failed = (n_words < limits.min_text_words) | (100 * covered > limits.max_repeat_percent * n_words)
    kept = ~failed & (longest <= limits.max_longest)
    for by_length, (_, percent) in zip(others, limits.max_covered):
        kept &= 100 * by_length <= percent * n_words
    return dict(zip((k for k, _ in _OUT), (n_words, chars, symbols, dup, covered, failed, kept, longest,
                                           covered / np.maximum(n_words, 1))))


def quality_rules(docs: DataFrame, key: str = "doc_id", text: str = "text",
                  limits: Limits = Limits()) -> DataFrame:
    """One row of counts and verdicts per row of ``docs``.

    Null and empty texts have no words and fail the base rule. Repeated rows
    and null keys are measured like any other; other columns are not read.
    ``n_repeat_words`` is the suffix array's coverage, which for
    ``min_words=5`` is the words in five-word windows found twice or more.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = measure(batch.column(1).to_pylist(), limits)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(found[k], t) for k, t in _OUT)], [key, *(k for k, _ in _OUT)])

    rows = docs.select(F.col(key).alias("k"), F.col(text).cast("string").alias("t"))
    kind = dict(docs.dtypes)[key]
    names = {pa.int64(): "long", pa.bool_(): "boolean", pa.float64(): "double"}
    return rows.mapInArrow(run, f"`{key}` {kind}, " + ", ".join(f"{k} {names[t]}" for k, t in _OUT))


def keep_quality(docs: DataFrame, text: str = "text", limits: Limits = Limits()) -> DataFrame:
    """The rows of ``docs`` that the rules keep, all columns as they are; no shuffle.

    Null and empty texts fail the base rule and go; repeated rows and null keys
    are judged like any other.
    """
    at = docs.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices_by_chars(whole, at, SLICE_CHARS):
                yield batch.filter(pa.array(measure(batch.column(at).to_pylist(), limits)["kept"]))

    return docs.mapInArrow(released(run), docs.schema)
