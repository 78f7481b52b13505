import random
import re

from pyspark.sql import functions as F

from traitlens.llm import decontam as D

from llm.edge_rows import edge_docs, empty_docs  # noqa: F401


def grams(text):
    words = re.findall(r"[^\W_]+", (text or "").lower())
    return [tuple(words[i:i + 5]) for i in range(len(words) - 4)]


def brute(docs, items):
    """Best weighted similarity of every text's windows of an item's size, if 0.8 or more."""
    from collections import Counter
    found = {}
    for d, text in docs:
        g = grams(text)
        for i, item in items:
            own = grams(item)
            best = 0
            for s in range(len(g)) if own else ():  # clipped where the text ends
                a, b = Counter(g[s:s + len(own)]), Counter(own)
                best = max(best, sum((a & b).values()) / sum((a | b).values()))
            if best >= 0.8:
                found[d, i] = round(best, 6)
    return found


def test_matches_equal_brute_force(spark):
    rnd = random.Random(9)
    word = lambda: rnd.choice("abcdefgh") + rnd.choice("xyzuvw") + str(rnd.randint(0, 60))
    items = [(i, " ".join(word() for _ in range(rnd.choice([3, 8, 12, 25, 40])))) for i in range(25)]
    docs = []
    for d in range(90):
        words = [word() for _ in range(rnd.randint(0, 80))]
        for _ in range(rnd.randint(0, 2)):
            leak = rnd.choice(items)[1].split()
            if rnd.random() < .4 and len(leak) > 20:
                leak[rnd.choice([0, 1, -1])] = "changed"
            at = rnd.randint(0, len(words))
            words[at:at] = leak
        docs.append((d, " ".join(words).replace(" ", ", ").title() if d % 3 else " ".join(words)))
    got = {(r.doc_id, r.item_id): round(r.similarity, 6) for r in D.find_leaks(
        spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
        .collect()}
    assert got == brute(docs, items) and len(got) > 20 and min(got.values()) < 1


def test_short_items_are_one_shingle(spark):
    items = spark.createDataFrame([(1, "Forty two"), (2, "a b c d"), (3, "one two three four five"), (4, "")],
                                  "item_id long, text string")
    docs = spark.createDataFrame([(1, "forty-two!"), (2, "the answer is forty two"), (3, "a b c d"), (4, "a b c"),
                                  (5, "zero one two three four five six"), (6, ""), (7, None), (8, "forty, TWO")],
                                 "doc_id long, text string")
    found = D.find_leaks(docs, items).collect()
    assert sorted((r.doc_id, r.item_id) for r in found) == [(1, 1), (3, 2), (5, 3), (8, 1)]
    assert sorted(r.doc_id for r in D.without_leaks(docs, items).collect()) == [2, 4, 6, 7]


def test_hamming_blocks_meet_all_within_the_radius(spark):
    rnd = random.Random(10)
    rows = []
    for k in range(300):
        a = rnd.getrandbits(64)
        b = a
        for bit in rnd.sample(range(64), rnd.randint(0, D.RADIUS)):
            b ^= 1 << bit
        rows.append((k, a - (1 << 64) if a >> 63 else a, b - (1 << 64) if b >> 63 else b))
    df = spark.createDataFrame(rows, "k long, a long, b long").withColumn(
        "block", F.explode(F.sequence(F.lit(0), F.lit(D.BLOCKS - 1))))
    met = df.where(F.array_contains(D._near(D._block(F.col("b"), F.col("block"))), D._block(F.col("a"), F.col("block"))))
    assert met.select("k").distinct().count() == 300


def test_edges(spark, edge_docs, empty_docs):
    items = spark.createDataFrame([(1, "seven eight nine ten eleven twelve"), (2, None), (3, "a b"), (4, "")],
                                  "item_id long, text string")
    rows = D.find_leaks(edge_docs, items).collect()
    assert sorted((r.doc_id, r.item_id) for r in rows) == [(1, 1), (7, 1), (7, 1)]
    kept = D.without_leaks(edge_docs, items)
    assert kept.columns == edge_docs.columns
    assert sorted((r.doc_id for r in kept.collect()), key=str) == [2, 3, 4, 5, 6, None]
    assert D.find_leaks(empty_docs, items).count() == 0
    assert D.without_leaks(edge_docs, items.where("false")).count() == edge_docs.count()
