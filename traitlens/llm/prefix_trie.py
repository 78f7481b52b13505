"""Prefix trie of conversations by whole-sequence collapse.

A turn enters as two 64-bit hashes of role and text and its number of words;
texts are never shuffled. A prefix is known by the exclusive or of its turns'
hashes, each mixed with its place, so every prefix's key follows from running
totals. Identical conversations collapse to one weighted sequence, the least
id standing for all; sequences that are no proper prefix of another (an
anti-join) are the leaves. Nodes are aggregates of the weighted sequences'
prefixes.

Sums over a node's subtree need no walk. A node's smallest member m also is
the smallest of every deeper node on m's path, so the nodes that m owns are
the lower end of its path. A subtree's distinct words are then the sum, over
the sequences that pass the node, of the words each owns at or below it.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from traitlens.llm.common import written

#: Ids of a window of conversations that share turns; a conversation takes its head from its window's first one.
FAMILY = 20
#: Head turns are the CRC-32 of the decimal id modulo this number.
HEADS = 4
#: Turns of one conversation, and ids of one end list, that are handled as a unit; results do not depend on it.
BLOCK = 4096

def _running(df: DataFrame, place: str, sums: dict[str, str], xors: dict[str, str]) -> DataFrame:
    """Running sums and exclusive ors (new name -> column) over each conversation's ``place``, from 0 on.

    Two levels: places of one block of a conversation, then the totals of the
    blocks before it, so a conversation of any length is spread over tasks.
    """
    df = df.withColumn("_block", F.expr(f"{place} div {BLOCK}"))
    kinds = [(n, c, F.sum) for n, c in sums.items()] + [(n, c, F.bit_xor) for n, c in xors.items()]
    inside = Window.partitionBy("conv_id", "_block").orderBy(place).rowsBetween(Window.unboundedPreceding, 0)
    before = Window.partitionBy("conv_id").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    totals = df.groupBy("conv_id", "_block").agg(*[f(c).alias(n) for n, c, f in kinds])
    carried = totals.select("conv_id", "_block", *[f(n).over(before).alias(f"_{n}") for n, _, f in kinds]) \
        .where("_block > 0")  # conversations of one block carry nothing
    return df.select("*", *[f(c).over(inside).alias(n) for n, c, f in kinds]) \
        .join(carried, ["conv_id", "_block"], "left") \
        .select(*[c for c in df.columns if c != "_block"],
                *[F.coalesce((F.col(n) + F.col(f"_{n}")) if f is F.sum else F.col(n).bitwiseXOR(F.col(f"_{n}")),
                             F.col(n)).alias(n) for n, _, f in kinds])


def numbered_turns(conversations: DataFrame) -> DataFrame:
    """(conv_id, ord, a, b, words): every turn's place from 1 on in its conversation, its two hashes and words.

    Turns are ordered by number, null first; equal numbers by hash. Turns are
    ranked within blocks of turn numbers, and blocks by their sizes.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    role = F.coalesce(F.col("role").cast("string"), F.lit(""))
    turns = conversations.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.xxhash64(role, text).alias("a"), F.xxhash64(F.lit("b"), text, role).alias("b"), word_count(text).alias("words"))
    turns = turns.withColumn("_block", F.expr(f"turn div {BLOCK}"))
    sizes = turns.groupBy("conv_id", "_block").agg(F.count(F.lit(1)).alias("size"))
    before = Window.partitionBy("conv_id").orderBy(F.col("_block").asc_nulls_first()) \
        .rowsBetween(Window.unboundedPreceding, -1)
    inside = Window.partitionBy("conv_id", "_block").orderBy(F.col("turn").asc_nulls_first(), "a", "b")
    offsets = sizes.select(F.col("conv_id").alias("_conv"), F.col("_block").alias("_of"),
                           F.sum("size").over(before).alias("_before")).where("_before > 0")
    return turns.withColumn("ord", F.row_number().over(inside)) \
        .join(offsets, F.expr("conv_id = _conv and _block <=> _of"), "left") \
        .select("conv_id", (F.col("ord") + F.coalesce("_before", F.lit(0))).alias("ord"), "a", "b", "words")


def word_count(text: Column) -> Column:
    """Words ``[^\\x20\\x09-\\x0D]+`` of a text."""
    return (F.size(F.split(text, r"[^\x20\x09-\x0D]+")) - 1).cast("long")


def rebuilt(turns: DataFrame) -> DataFrame:
    """(conv_id, pos, words, ha, hb): every conversation's turns after rebuilding, and a textless one at 0.

    Conversation c takes the first h turns of conversation c - c % 20 (fewer if it has fewer) and
    its own turns after its first h; h = crc32(decimal c) % 4. ``%`` keeps the sign, as in SQL.
    """
    head = turns.where(f"conv_id % {FAMILY} = 0 and ord < {HEADS}").groupBy(F.col("conv_id").alias("_base")) \
        .agg(F.array_sort(F.collect_list(F.struct("ord", "a", "b", "words"))).alias("head"))  # at most three turns
    rows = turns.withColumn("h", F.expr(f"cast(crc32(cast(cast(conv_id as string) as binary)) % {HEADS} as int)")) \
        .join(head, F.expr(f"conv_id - conv_id % {FAMILY} = _base"), "left") \
        .withColumn("taken", F.coalesce(F.slice("head", F.lit(1), F.col("h")), F.expr("slice(head, 1, 0)")))
    rows = rows.select("conv_id", F.expr("""inline(concat(
        if(ord = 1, array(struct(0L as pos, 0L as a, 0L as b, 0L as words)), array()),
        if(ord = 1 and head is not null,
           transform(taken, x -> struct(cast(x.ord as long) as pos, x.a as a, x.b as b, x.words as words)), array()),
        if(ord > h, array(struct(cast(ord - h + if(head is null, 0, size(taken)) as long) as pos, a, b, words)),
           array())))"""))
    return rows.select("conv_id", "pos", "words",
                       F.expr("if(pos = 0, 0L, xxhash64(pos, a, b))").alias("ha"),
                       F.expr("if(pos = 0, 0L, xxhash64('b', b, a, pos))").alias("hb"))


def _end_digests(ends: DataFrame) -> DataFrame:
    """(ka, kb, conv_id) -> SHA-256 of each key's ids in ascending order, comma-joined.

    Ids are joined by blocks of values first; a key's blocks are then streamed
    in order through one digest, so no list is ever held whole.
    """
    blocks = ends.groupBy("ka", "kb", F.expr(f"conv_id div {BLOCK}").alias("block")) \
        .agg(F.array_join(F.expr("transform(array_sort(collect_list(conv_id)), x -> cast(x as string))"), ",")
             .alias("ids"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, digest = None, None
        for batch in batches:
            done = []
            for ka, kb, ids in zip(*(batch.column(c).to_pylist() for c in ("ka", "kb", "ids"))):
                if (ka, kb) == key:
                    digest.update(b",")
                else:
                    if key is not None:
                        done.append((*key, digest.hexdigest()))
                    key, digest = (ka, kb), hashlib.sha256()
                digest.update(ids.encode())
            yield _digest_rows(done)
        if key is not None:
            yield _digest_rows([(*key, digest.hexdigest())])

    return blocks.repartition("ka", "kb").sortWithinPartitions("ka", "kb", "block") \
        .select("ka", "kb", "ids").mapInArrow(run, "ka long, kb long, ends_sha256 string")


def _digest_rows(rows: list[tuple[int, int, str]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.int64()),
         pa.array([r[2] for r in rows], pa.string())], ["ka", "kb", "ends_sha256"])


def trie(conversations: DataFrame) -> DataFrame:
    """One row per distinct prefix of the rebuilt conversations, the textless root included.

    conv_id (smallest member), depth, parent_conv_id (null at the root), n_convs, n_children,
    n_leaves, saved_tokens (over the subtree, members but one times words of the last turn) and
    ends_sha256 (ids of the members that end here).

    Rows without conv_id belong to no conversation; null and empty roles and texts are the same;
    null turns come first, equal ones by hash; a repeated row is a turn of its own. Other columns
    are not read. An empty table has no nodes. A conversation that is rebuilt to no turns is a
    member of the root and ends there.
    """
    turns = written(numbered_turns(conversations), "turns")
    prefixes = written(_running(rebuilt(turns), "pos", {"total": "words"}, {"ka": "ha", "kb": "hb"}), "prefixes")

    # identical conversations become one sequence, known by its least id
    whole = prefixes.groupBy("conv_id").agg(F.max(F.struct("pos", "ka", "kb", "total")).alias("w")) \
        .select("conv_id", "w.*")
    sequences = whole.groupBy("ka", "kb").agg(F.min("conv_id").alias("rep"), F.count(F.lit(1)).alias("weight"),
                                              F.max("pos").alias("length"), F.max("total").alias("all_words"))
    steps = written(prefixes.join(sequences.drop("ka", "kb"), F.expr("conv_id = rep"))
                    .withColumn("above", F.expr("total - words")).drop("conv_id", "total"), "sequences")

    nodes = written(steps.groupBy("ka", "kb").agg(
        F.min("rep").alias("conv_id"), F.max("pos").alias("depth"), F.sum("weight").alias("n_convs"),
        F.max("above").alias("above"), F.max(F.expr("ka ^ ha")).alias("pa"), F.max(F.expr("kb ^ hb")).alias("pb")),
        "nodes")

    # leaves: sequences that are no proper prefix of another; what each sequence owns starts at its first node
    inner = steps.where("pos < length").select("ka", "kb").distinct()
    leaves = steps.where("pos = length").join(inner, ["ka", "kb"], "left_anti") \
        .select("rep", F.lit(None).cast("long").alias("own"), F.lit(1).alias("leaf"))
    owned = nodes.groupBy(F.col("conv_id").alias("rep")).agg(F.min("above").alias("own")) \
        .withColumn("leaf", F.lit(0))
    marks = leaves.unionByName(owned).groupBy("rep").agg(F.min("own").alias("own"), F.max("leaf").alias("leaf"))
    below = steps.join(marks, "rep", "left").groupBy("ka", "kb").agg(
        F.sum(F.coalesce("leaf", F.lit(0))).alias("n_leaves"),
        F.sum(F.expr("weight * (all_words - above) - if(own is null, 0L, all_words - greatest(above, own))"))
        .alias("saved_tokens"))

    children = nodes.where("depth > 0").groupBy(F.col("pa").alias("ka"), F.col("pb").alias("kb")) \
        .agg(F.count(F.lit(1)).alias("n_children"))
    parents = nodes.select(F.col("ka").alias("_pa"), F.col("kb").alias("_pb"), F.col("conv_id").alias("parent_conv_id"))
    ends = _end_digests(whole.select("ka", "kb", "conv_id"))
    return nodes.join(below, ["ka", "kb"]).join(children, ["ka", "kb"], "left").join(ends, ["ka", "kb"], "left") \
        .join(parents, F.expr("pa = _pa and pb = _pb and depth > 0"), "left") \
        .select("conv_id", "depth", "parent_conv_id", "n_convs", F.coalesce("n_children", F.lit(0)).alias("n_children"),
                "n_leaves", "saved_tokens",
                F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"))


#: The same nodes in DuckDB: prefixes as lists of turns, every node added to all of its prefixes.
ORACLE = """
WITH turns AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST) AS ord
  FROM conversations WHERE conv_id IS NOT NULL),
convs AS (
  SELECT conv_id, xor(list_reduce(list_prepend(4294967295::BIGINT,
             list_transform(string_split(conv_id::VARCHAR, ''), lambda x: ord(x)::BIGINT)),
             lambda crc, byte: list_reduce(list_prepend(xor(crc, byte), range(8)),
                 lambda c, step: xor(c >> 1, 3988292384 * (c & 1)))), 4294967295) % 4 AS h
  FROM (SELECT DISTINCT conv_id FROM turns)),
parts AS (
  SELECT c.conv_id, 0 AS part, t.ord, t.role, t.text
  FROM convs c JOIN turns t ON t.conv_id = c.conv_id - c.conv_id % 20 AND t.ord <= c.h
  UNION ALL
  SELECT c.conv_id, 1, t.ord, t.role, t.text FROM convs c JOIN turns t ON t.conv_id = c.conv_id AND t.ord > c.h),
paths AS (
  SELECT conv_id, list(struct_pack(role := role, text := text) ORDER BY part, ord) AS path FROM parts GROUP BY conv_id),
whole AS (SELECT conv_id, coalesce(path, []) AS path FROM convs LEFT JOIN paths USING (conv_id)),
members AS (SELECT conv_id, path[1:d] AS node, d, d = len(path) AS ends_here
            FROM (SELECT conv_id, path, unnest(range(0, len(path) + 1)) AS d FROM whole)),
nodes AS (
  SELECT node, max(d) AS depth, min(conv_id) AS conv_id, count(*) AS n_convs,
         sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (ends_here), '')) AS ends_sha256,
         CASE WHEN max(d) = 0 THEN 0
              ELSE len(regexp_extract_all(any_value(node[d].text), '[^\x20\x09-\x0D]+')) END AS words
  FROM members GROUP BY node),
children AS (SELECT node[1:depth - 1] AS node, count(*) AS n FROM nodes WHERE depth > 0 GROUP BY 1),
sized AS (SELECT nodes.*, coalesce(children.n, 0) AS n_children FROM nodes LEFT JOIN children USING (node)),
below AS (
  SELECT up AS node, sum((n_children = 0)::INT) AS n_leaves, sum((n_convs - 1) * words) AS saved_tokens
  FROM (SELECT n_children, n_convs, words, node[1:k] AS up
        FROM (SELECT *, unnest(range(0, depth + 1)) AS k FROM sized)) GROUP BY up)
SELECT s.conv_id, s.depth, p.conv_id AS parent_conv_id, s.n_convs, s.n_children,
       b.n_leaves::BIGINT AS n_leaves, b.saved_tokens::BIGINT AS saved_tokens, s.ends_sha256
FROM sized s JOIN below b ON s.node = b.node
LEFT JOIN sized p ON s.depth > 0 AND p.node = s.node[1:s.depth - 1]
"""
