"""Phrase collocations from one FM-index per shard of texts.

A shard is some megabytes of texts as word ids. Its words in order and in
reverse give two indexes, each a Burrows-Wheeler transform sorted as deep as
phrases are long. A phrase is an interval in both. Extending it to the right
by every word that follows takes the reverse index's symbols in the interval;
the forward interval narrows in step, and its symbols are the words before.
Phrases leave their shard with their counts in compressed runs, dealt by a hash
of the phrase; sums over the shards give exact counts.

No phrase is frequent unless its words and pairs are. So shards report words
first, then pairs of frequent words, and the frequent ones come back to the
shards that hold them; indexes are built of the text along frequent pairs.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from traitlens.llm.common import mix, written

#: A phrase is a candidate from this many occurrences on, up to this many words; phrases returned per language.
LEAST = 100
LONGEST = 5
TOP = 2000
#: Bytes of text in a shard (a longer piece is a shard of its own); results do not depend on it.
SHARD_BYTES = 10_000_000
#: Words of text for which one task sums the shards' phrases; results do not depend on it.
PART_WORDS = 1 << 22
#: Bits of a word's number within its shard, and of a shard's within its task.
WORD_BITS, SHARD_BITS = 26, 12

#: Ends of pieces, and a byte that no UTF-8 text holds in their place.
BREAKS = b".,;:!?\n\x0b\x0c\r"
MARK = b"\xff"
_TO_MARK = bytes.maketrans(BREAKS, MARK * len(BREAKS))


def _chunks(text: bytes, least: int) -> Iterator[bytes]:
    """A marked text in chunks of at least so many bytes that end where a piece does."""
    at = 0
    while len(text) - at > least and (cut := text.find(MARK, at + least)) >= 0:
        yield text[at:cut]
        at = cut
    yield text[at:]


def _shard(texts: dict[str, list[bytes]]) -> tuple[np.ndarray, list[str], list[bytes]]:
    """Word numbers in order (0 ends a piece), and every number's language and word from 1 on."""
    parts, langs, words = [np.zeros(1, np.int32)], [], []
    for lang, chunks in texts.items():
        number: defaultdict = defaultdict()
        number.default_factory = number.__len__
        number[MARK]
        tokens = (b" \xff ".join(chunks)).replace(MARK, b" \xff ").split()
        x = np.fromiter(map(number.__getitem__, tokens), np.int32, len(tokens))
        parts += [np.where(x > 0, x + np.int32(len(words)), 0).astype(np.int32), np.zeros(1, np.int32)]
        langs += [lang] * (len(number) - 1)
        words += list(number)[1:]
    return np.concatenate(parts), langs, words


def _shards(shard_bytes: int):
    """Texts -> per shard one row with its word numbers and one row per distinct word."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, made = TaskContext.get().partitionId(), 0
        held, size = defaultdict(list), 0
        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                if not text.is_valid:
                    continue
                marked = text.as_buffer().to_pybytes().lower().translate(_TO_MARK)
                for chunk in _chunks(marked, shard_bytes):
                    held[lang].append(chunk)
                    size += len(chunk) + 1
                    if size > shard_bytes:
                        yield _shard_rows(task, made, held)
                        held, size, made = defaultdict(list), 0, made + 1
        if size:
            yield _shard_rows(task, made, held)
    return run


def _shard_rows(task: int, made: int, texts: dict[str, list[bytes]]) -> pa.RecordBatch:
    x, langs, words = _shard(texts)
    n = len(words)
    if task >= 1 << 63 - WORD_BITS - SHARD_BITS or made >= 1 << SHARD_BITS or n >= 1 << WORD_BITS:
        raise ValueError("too many tasks, shards of a task or words of a shard to number")
    counts = np.bincount(x, minlength=n + 1)
    counts[0] = 0
    return pa.RecordBatch.from_arrays(
        [pa.array(((task << SHARD_BITS | made) << WORD_BITS) + np.arange(n + 1, dtype=np.int64)),
         pa.array([pa.compress(x.tobytes(), codec="zstd", asbytes=True)] + [None] * n, pa.binary()),
         pa.array([len(x)] + [None] * n, pa.int64()), pa.array([None, *langs], pa.string()),
         pa.array([None, *words], pa.binary()).cast(pa.string()), pa.array(counts)],
        ["own", "ids", "size", "lang", "word", "count"])


def _ranges(first: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """first, first + 1, ... of each row, one after the other."""
    return np.repeat(first - np.cumsum(sizes) + sizes, sizes) + np.arange(int(sizes.sum()))


def _bwt(x: np.ndarray, depth: int) -> np.ndarray:
    """The symbols before x's suffixes in the order of their first ``depth`` symbols (x is a ring)."""
    rank, known = x, 1
    while known < depth:
        step = min(known, depth - known)
        rank = np.unique(rank * (int(rank.max()) + 1) + np.roll(rank, -step), return_inverse=True)[1]
        known += step
    return x[np.argsort(rank, kind="stable") - 1]


def phrases_of(x: np.ndarray, shortest: int, longest: int):
    """Of every phrase of ``shortest`` to ``longest`` symbols in x: (symbols, count, before, after) by length.

    0 in x separates. ``before`` and ``after`` are the symbol on that side of
    every occurrence, 0 if they differ or one is at a separator.
    """
    size = int(x.max()) + 1
    first = np.concatenate(([0], np.cumsum(np.bincount(x, minlength=size))))
    before = _bwt(x, longest)
    after = _bwt(x[::-1], longest)
    place = np.empty(len(x), np.int64)  # row of the suffix that one symbol more makes
    place[np.argsort(after, kind="stable")] = np.arange(len(x))
    turns = [np.concatenate(([0], np.cumsum(s[1:] != s[:-1]))) for s in (before, after)]

    symbols = [np.arange(1, size)]
    low = reverse = first[1:size]
    count = first[2:] - first[1:size]
    for m in range(1, longest + 1):
        if m >= shortest:
            sides = [np.where(t[at] == t[at + count - 1], s[at], 0)
                     for s, t, at in ((before, turns[0], low), (after, turns[1], reverse))]
            yield symbols, count, *sides
        if m == longest or not len(count):
            return
        rows = _ranges(reverse, count)
        key = np.repeat(np.arange(len(count)), count) * size + after[rows]
        order = np.argsort(key, kind="stable")
        key = key[order]
        start = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
        number = np.diff(np.append(start, len(key)))
        of, symbol = np.divmod(key[start], size)
        low = low[of] + start - (np.cumsum(count) - count)[of]
        reverse = place[rows[order[start]]]
        some = symbol > 0
        low, reverse, count, of, symbol = low[some], reverse[some], number[some], of[some], symbol[some]
        symbols = [s[of] for s in symbols] + [symbol]


def _along(x: np.ndarray, linked: np.ndarray) -> np.ndarray:
    """x reduced to runs of two symbols or more whose neighbours are ``linked``, separated by 0."""
    edge = np.diff(np.concatenate(([0], linked.view(np.int8), [0])))
    start = np.flatnonzero(edge == 1)
    n = np.flatnonzero(edge == -1) - start + 1
    out = x[_ranges(start, n + 1) % len(x)]
    out[np.cumsum(n + 1) - 1] = 0
    return np.concatenate(([0], out))


def _frequent(shard: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """A shard's frequent words numbered by their global numbers from 1 on in its text's order (0: any other or a
    break), and these global numbers (-1 at 0)."""
    kind, code, gid = (shard.column(c).to_numpy() for c in ("kind", "code", "gid"))
    at = int(np.flatnonzero(kind == 0)[0])
    x = np.frombuffer(pa.decompress(shard.column("ids")[at].as_py(), int(gid[at]) * 4, codec="zstd"), np.int32)
    codes, gids = code[kind == 1], gid[kind == 1]
    order = np.argsort(gids)
    number = np.zeros(max(int(x.max()), int(codes.max(initial=0))) + 1, np.int64)
    number[codes[order]] = np.arange(1, len(codes) + 1)
    return number[x], np.concatenate(([-1], gids[order]))


def _packed(columns: np.ndarray) -> bytes:
    """Whole numbers, one row per column: differences to the one before, bytes of a rank together, compressed."""
    steps = np.ascontiguousarray(np.diff(columns, axis=1, prepend=0))
    return pa.compress(steps.view(np.uint8).reshape(*steps.shape, 8).transpose(0, 2, 1).tobytes(),
                       codec="zstd", asbytes=True)


def _unpacked(packed: bytes, width: int, n: int) -> np.ndarray:
    flat = np.frombuffer(pa.decompress(packed, width * n * 8, codec="zstd", asbytes=True), np.uint8)
    steps = np.ascontiguousarray(flat.reshape(width, 8, n).transpose(0, 2, 1)).view(np.int64)
    return np.cumsum(steps.reshape(width, n), axis=1)


_LOCAL = pa.schema([("part", pa.int64()), ("shard", pa.int64()), ("words", pa.int64()), ("n", pa.int64()),
                    ("packed", pa.binary())])


def _dealt(shard: int, words: np.ndarray, count: np.ndarray, parts: int) -> pa.Table:
    """A shard's phrases of one length (one per column of ``words``) with their counts, dealt by a hash of the phrase."""
    h = np.zeros(len(count), np.uint64)
    for w in words:
        h = mix(h * np.uint64(0x9E3779B97F4A7C15) + w.astype(np.uint64))
    part = (h % np.uint64(parts)).astype(np.int64)
    order = np.argsort(part, kind="stable")
    rows = np.concatenate((words, count[None]))[:, order]
    ends = np.cumsum(np.bincount(part, minlength=parts))
    some = [(p, a, b) for p, (a, b) in enumerate(zip(np.append(0, ends[:-1]).tolist(), ends.tolist())) if b > a]
    return pa.table([pa.array([p for p, _, _ in some], pa.int64()), pa.array([shard] * len(some), pa.int64()),
                     pa.array([len(words)] * len(some), pa.int64()), pa.array([b - a for _, a, b in some], pa.int64()),
                     pa.array([_packed(rows[:, a:b]) for _, a, b in some], pa.binary())], schema=_LOCAL)


def _summed(words: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of phrases of one length from several shards: a place and the sum of each distinct one, and every one's distinct one."""
    of = np.zeros(len(count), np.int64)
    for w in words:
        number = np.unique(w, return_inverse=True)[1]
        of = np.unique(of * (int(number.max()) + 1) + number, return_inverse=True)[1]
    place = np.empty(int(of.max()) + 1, np.int64)
    place[of] = np.arange(len(of))
    total = np.zeros(len(place), np.int64)
    np.add.at(total, of, count)
    return place, total, of


def _met(part: pa.Table) -> Iterator[tuple[list[dict], np.ndarray, np.ndarray]]:
    """A part's rows by length of phrase, with their phrases and counts, one after the other."""
    by_length = defaultdict(list)
    for row in part.to_pylist():
        by_length[row["words"]].append(row)
    for width, rows in sorted(by_length.items()):
        whole = np.concatenate([_unpacked(r["packed"], width + 1, r["n"]) for r in rows], axis=1)
        yield rows, whole[:-1], whole[-1]


def _pairs(parts: int):
    """A shard's row of ids and rows of frequent words -> its pairs of neighbouring frequent words."""
    def run(shard: pa.Table) -> pa.Table:
        x, gids = _frequent(shard)
        key, count = np.unique((x[:-1] * len(gids) + x[1:])[(x[:-1] > 0) & (x[1:] > 0)], return_counts=True)
        return _dealt(shard.column("shard")[0].as_py(), gids[np.stack(np.divmod(key, len(gids)))], count, parts)
    return run


_STEPS = pa.schema([("shard", pa.int64()), ("n", pa.int64()), ("packed", pa.binary())])


def _frequent_pairs(least: int):
    """A part's pairs of all shards -> every shard's own that are frequent."""
    def run(part: pa.Table) -> pa.Table:
        out = []
        for rows, words, count in _met(part):
            _, total, of = _summed(words, count)
            some = (total >= least)[of]
            ends = np.cumsum([r["n"] for r in rows])
            for r, end in zip(rows, ends.tolist()):
                own = slice(end - r["n"], end)
                if some[own].any():
                    kept = words[:, own][:, some[own]]
                    out.append({"shard": r["shard"], "n": kept.shape[1], "packed": _packed(kept)})
        return pa.Table.from_pylist(out, schema=_STEPS)
    return run


def _phrases(longest: int, parts: int):
    """A shard's row of ids and rows of frequent words and pairs -> its phrases along frequent pairs."""
    def run(shard: pa.Table) -> pa.Table:
        x, gids = _frequent(shard)
        steps = shard.filter(pc.equal(shard.column("kind"), 2))
        pairs = [_unpacked(packed, 2, n) for packed, n in zip(steps.column("ids").to_pylist(), steps.column("gid").to_pylist())]
        first, second = np.searchsorted(gids, np.concatenate([np.empty((2, 0), np.int64), *pairs], axis=1))
        x = _along(x, np.isin(x[:-1] * len(gids) + x[1:], first * len(gids) + second))
        tables = [_LOCAL.empty_table()]
        if x.any():
            used, x = np.unique(x, return_inverse=True)
            for symbols, count, _, _ in phrases_of(x, 2, longest):
                if len(count):
                    tables.append(_dealt(shard.column("shard")[0].as_py(), gids[used[np.stack(symbols)]], count, parts))
        return pa.concat_tables(tables)
    return run


_PHRASES = pa.schema([("ws", pa.list_(pa.int64())), ("a", pa.int64())])


def _frequent_phrases(least: int):
    """A part's phrases of all shards -> the frequent ones with their counts."""
    def run(part: pa.Table) -> pa.Table:
        tables = [_PHRASES.empty_table()]
        for _, words, count in _met(part):
            place, total, _ = _summed(words, count)
            some = total >= least
            kept = words[:, place[some]]
            tables.append(pa.table([pa.ListArray.from_arrays(
                pa.array(np.arange(kept.shape[1] + 1, dtype=np.int32) * len(kept)), pa.array(kept.T.ravel())),
                pa.array(total[some])], schema=_PHRASES))
        return pa.concat_tables(tables)
    return run


def counted(docs: DataFrame, least: int = LEAST, longest: int = LONGEST, text: str = "text",
            lang: str = "lang", shard_bytes: int = SHARD_BYTES,
            part_words: int = PART_WORDS) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Exact counts per language, as three written tables.

    * words (gid, lang, word, f): every word of at least ``least`` occurrences
    * phrases (ws, a, inside): every phrase of 2 to ``longest`` words, as gids, of as many; ``inside`` if one of
      one word more holds it and has as many occurrences
    * totals (lang, n): all occurrences of words

    Null texts hold no words, null languages are ``und``; repeated rows count each time; a text of any
    length is counted whole; other columns are not read; an empty table gives three empty tables.
    """
    rows = docs.select(F.coalesce(F.col(lang).cast("string"), F.lit("und")).alias("lang"),
                       F.col(text).cast("string").alias("text"))
    shards = written(rows.mapInArrow(
        _shards(shard_bytes), "own long, ids binary, size long, lang string, word string, count long"), "phrase-shards")
    local = shards.where("ids is null").select("own", "lang", "word", "count")
    totals = written(local.groupBy("lang").agg(F.sum("count").alias("n")), "phrase-totals")

    # a word's global number is the least of its local ones
    same = Window.partitionBy("lang", "word")
    frequent = written(
        local.select("*", F.sum("count").over(same).alias("f"), F.min("own").over(same).alias("gid"))
        .where(F.col("f") >= least)
        .select("own", "gid", *[F.expr(f"if(own = gid, {c}, null)").alias(c) for c in ("lang", "word", "f")]),
        "phrase-words")
    words = frequent.where("own = gid").select("gid", "lang", "word", "f")

    mask = (1 << WORD_BITS) - 1
    ids = shards.where("ids is not null").select(
        F.expr(f"own >> {WORD_BITS}").alias("shard"), F.lit(0).alias("kind"), F.lit(0).cast("long").alias("code"),
        F.col("size").alias("gid"), "ids")
    nothing = F.lit(None).cast("binary").alias("ids")
    known = frequent.select(F.expr(f"own >> {WORD_BITS}").alias("shard"), F.lit(1).alias("kind"),
                            F.expr(f"own & {mask}L").alias("code"), "gid", nothing)
    local_phrases = "part long, shard long, words long, n long, packed binary"
    parts = max(1, -(-(ids.agg(F.sum("gid")).first()[0] or 0) // part_words))
    pairs = ids.unionByName(known).groupBy("shard").applyInArrow(_pairs(parts), local_phrases)
    pairs = written(pairs.groupBy("part").applyInArrow(_frequent_pairs(least), "shard long, n long, packed binary"),
                    "phrase-pairs")
    steps = pairs.select("shard", F.lit(2).alias("kind"), F.lit(0).cast("long").alias("code"), F.col("n").alias("gid"),
                         F.col("packed").alias("ids"))
    found = ids.unionByName(known).unionByName(steps).groupBy("shard").applyInArrow(
        _phrases(longest, parts), local_phrases)
    found = written(found.groupBy("part").applyInArrow(_frequent_phrases(least), "ws array<long>, a long"),
                    "phrase-counts")
    # a longer phrase of as many occurrences holds one of one word more that has as many too
    longer = found.where("size(ws) > 2")
    shorter = longer.select(F.expr("slice(ws, 2, size(ws))").alias("ws"), "a").unionByName(
        longer.select(F.expr("slice(ws, 1, size(ws) - 1)").alias("ws"), "a")).distinct()
    found = found.join(shorter.withColumn("_inside", F.lit(True)), ["ws", "a"], "left").select(
        "ws", "a", F.coalesce("_inside", F.lit(False)).alias("inside"))
    return words, written(found, "phrases"), totals


def collocations(docs: DataFrame, least: int = LEAST, longest: int = LONGEST, top: int = TOP, text: str = "text",
                 lang: str = "lang", shard_bytes: int = SHARD_BYTES, part_words: int = PART_WORDS) -> DataFrame:
    """The ``top`` phrases of every language by their weakest cut: lang, rank, phrase, a, l, r, n, score.

    A phrase that only occurs inside a longer one of as many occurrences is left out. The score of a cut is
    floor(1000 a n / (l r)), in decimals of 38 digits. Nulls, repeated rows, long texts and empty
    tables are as in ``counted``; ties in score go to the larger a, then to the phrase's bytes.
    """
    words, phrases, totals = counted(docs, least, longest, text, lang, shard_bytes, part_words)
    f = words.select(F.array("gid").alias("part"), "f").unionByName(
        phrases.select(F.col("ws").alias("part"), F.col("a").alias("f")))
    kept = phrases.where("not inside")
    spelled = kept.select("ws", "a", F.posexplode("ws").alias("at", "gid")) \
        .join(words.select("gid", "lang", "word"), "gid").groupBy("ws", "a", "lang") \
        .agg(F.expr("array_join(transform(array_sort(collect_list(struct(at, word))), x -> x.word), ' ')")
             .alias("phrase"))
    cuts = spelled.join(totals, "lang").select("*", F.explode(F.expr("sequence(1, size(ws) - 1)")).alias("k")) \
        .withColumn("_first", F.expr("slice(ws, 1, k)")).withColumn("_rest", F.expr("slice(ws, k + 1, size(ws))")) \
        .join(f.select(F.col("part").alias("_first"), F.col("f").alias("l")), "_first") \
        .join(f.select(F.col("part").alias("_rest"), F.col("f").alias("r")), "_rest") \
        .withColumn("score", F.expr(
            "(1000 * cast(a as decimal(19, 0)) * cast(n as decimal(18, 0)))"
            " div (cast(l as decimal(19, 0)) * cast(r as decimal(19, 0)))"))
    weakest = cuts.groupBy("ws", "lang", "phrase", "a", "n") \
        .agg(F.min(F.struct("score", "k", "l", "r")).alias("c")) \
        .select("lang", "phrase", "a", "c.l", "c.r", "n", "c.score")
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    return weakest.withColumn("rank", F.row_number().over(order).cast("long")).where(F.col("rank") <= top) \
        .select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


#: The same in DuckDB: all phrases of all pieces are counted.
ORACLE = f"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, regexp_extract_all(unnest(regexp_split_to_array(
           translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[.,;:!?\\x0A-\\x0D]')), '[^\\x20\\x09]+') AS words
  FROM documents),
starts AS (SELECT lang, words, unnest(range(1, len(words) + 1)) AS i FROM pieces),
grams AS (
  SELECT lang, ws, count(*) AS f
  FROM (SELECT lang, words[i:i + m - 1] AS ws FROM starts, range(1, {LONGEST + 1}) AS t(m) WHERE i + m - 1 <= len(words))
  GROUP BY lang, ws),
totals AS (SELECT lang, sum(f)::BIGINT AS n FROM grams WHERE len(ws) = 1 GROUP BY lang),
candidates AS (SELECT * FROM grams WHERE len(ws) > 1 AND f >= {LEAST}),
insides AS (
  SELECT DISTINCT lang, ws[i:j] AS ws, f
  FROM (SELECT lang, ws, f, i, unnest(range(i + 1, len(ws) + 1)) AS j
        FROM (SELECT lang, ws, f, unnest(range(1, len(ws))) AS i FROM candidates))
  WHERE j - i + 1 < len(ws)),
dropped AS (SELECT DISTINCT c.lang, c.ws FROM candidates c JOIN insides i
            ON i.lang = c.lang AND i.ws = c.ws AND 100 * i.f >= 100 * c.f),
cuts AS (SELECT lang, ws, f AS a, unnest(range(1, len(ws))) AS k FROM candidates ANTI JOIN dropped USING (lang, ws)),
scored AS (
  SELECT c.lang, c.ws, c.a, c.k, x.f AS l, y.f AS r, t.n,
         (1000::HUGEINT * c.a * t.n) // (x.f::HUGEINT * y.f) AS score
  FROM cuts c JOIN totals t ON t.lang = c.lang
  JOIN grams x ON x.lang = c.lang AND x.ws = c.ws[1:c.k]
  JOIN grams y ON y.lang = c.lang AND y.ws = c.ws[c.k + 1:len(c.ws)]),
weakest AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, ws ORDER BY score, k) = 1)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, array_to_string(ws, ' ')) AS rank,
       array_to_string(ws, ' ') AS phrase, a, l, r, n, score::BIGINT AS score
FROM weakest QUALIFY rank <= {TOP}
"""
