import random
import re
from collections import Counter

import numpy as np
import pytest

from traitlens.llm import phrases as P

from llm.edge_rows import edge_docs, empty_docs  # noqa: F401


def grams(rows, longest):
    count = Counter()
    for lang, text in rows:
        text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", text):
            words = re.findall("[^ \t]+", piece)
            for i in range(len(words)):
                for m in range(1, min(longest, len(words) - i) + 1):
                    count[(lang or "und", *words[i:i + m])] += 1
    return count


def brute_force(rows, least, longest, top):
    count = grams(rows, longest)
    n = Counter()
    for g, f in count.items():
        if len(g) == 2:
            n[g[0]] += f
    some = {g: f for g, f in count.items() if len(g) > 2 and f >= least}

    def inside(g):
        return any(h[0] == g[0] and len(h) > len(g) and f >= some[g]
                   and any(h[i:i + len(g) - 1] == g[1:] for i in range(1, len(h))) for h, f in some.items())
    scored = []
    for g, a in some.items():
        if not inside(g):
            score, _, l, r = min((1000 * a * n[g[0]] // (count[g[:k + 1]] * count[(g[0], *g[k + 1:])]), k,
                                  count[g[:k + 1]], count[(g[0], *g[k + 1:])]) for k in range(1, len(g) - 1))
            scored.append((g[0], " ".join(g[1:]), a, l, r, n[g[0]], score))
    out = []
    for lang in {s[0] for s in scored}:
        own = sorted((s for s in scored if s[0] == lang), key=lambda s: (-s[6], -s[2], s[1].encode()))
        out += [(lang, i, *s[1:]) for i, s in enumerate(own[:top], 1)]
    return sorted(out)


def texts(seed, n=120):
    rnd = random.Random(seed)
    words = ["The", "the", "a", "b", "c", "d", "É", "é", "ß\x00", "\x85x", "a\xa0b", "river-bed"]
    lines = [" ".join(rnd.choice(words) for _ in range(7)) for _ in range(4)]
    out = []
    for _ in range(n):
        parts = [rnd.choice(lines) if rnd.random() < 0.3 else rnd.choice(words) for _ in range(rnd.randint(0, 60))]
        text = "".join(p + rnd.choice([" ", " ", " ", "\t ", "  ", ", ", ".", "\n", "!? ", "\r"]) for p in parts)
        out.append((rnd.choice([None, "und", "de", "en", "en"]), rnd.choice([text, text, text, None])))
    return out


def found(spark, rows, least, longest=5, top=2000, **more):
    docs = spark.createDataFrame([(*r, None, None) for r in rows], "lang string, text string, own string, ws string")
    return sorted(tuple(r) for r in P.collocations(docs.repartition(4), least, longest, top, **more).collect())


@pytest.mark.parametrize("least,longest,top,shard_bytes", [(3, 5, 2000, 10_000_000), (2, 5, 40, 500), (5, 3, 2000, 1),
                                                           (4, 2, 2000, 200)])
def test_phrases_equal_brute_force(spark, least, longest, top, shard_bytes):
    rows = texts(least)
    assert found(spark, rows, least, longest, top, shard_bytes=shard_bytes) == brute_force(rows, least, longest, top)


def test_one_phrase_in_a_third_of_all_text(spark):
    """Runs of one word overlap themselves, and one long text is larger than a shard."""
    rows = [("en", "so so so so so so. " * 400), ("en", "x y " * 900)] + texts(9, 30)
    assert found(spark, rows, 100, shard_bytes=700) == brute_force(rows, 100, 5, 2000)


def test_products_beyond_64_bits(spark):
    n, a = 10 ** 17, 10 ** 15
    got = spark.sql(f"""select (1000 * cast({a}L as decimal(19, 0)) * cast({n}L as decimal(18, 0)))
        div (cast({a + 7}L as decimal(19, 0)) * cast({a + 1}L as decimal(19, 0))) as s""").first()[0]
    assert got == 1000 * a * n // ((a + 7) * (a + 1))


def test_index_of_random_symbols():
    rnd = np.random.default_rng(5)
    for _ in range(30):
        x = np.concatenate(([0], rnd.integers(0, 4, 80), [0])).astype(np.int64)
        expected = Counter(tuple(x[i:i + m].tolist()) for m in (2, 3, 4) for i in range(len(x) - m + 1)
                           if x[i:i + m].all())
        seen = {}
        for symbols, count, before, after in P.phrases_of(x, 2, 4):
            for row, f, b, c in zip(np.stack(symbols, 1).tolist(), count.tolist(), before.tolist(), after.tolist()):
                seen[tuple(row)] = f
                m = len(row)
                at = [i for i in range(len(x) - m + 1) if x[i:i + m].tolist() == row]
                sides = [{int(x[i - 1]) for i in at}, {int(x[i + m]) for i in at}]
                assert [b, c] == [s.pop() if len(s) == 1 else 0 for s in sides]
        assert seen == expected


def test_edges(spark, edge_docs, empty_docs):  # noqa: F811
    got = {r["phrase"]: r["a"] for r in P.collocations(edge_docs, 3).collect()}
    assert got["one two three four five"] == 3 and got["word word word word word"] == 2996
    assert P.collocations(empty_docs).count() == 0


def test_many_parts_and_shards(spark):
    rows = texts(11)
    assert found(spark, rows, 3, shard_bytes=3000, part_words=400) == brute_force(rows, 3, 5, 2000)


def test_shards_send_runs_not_rows():
    """A shard's phrases leave it as one compressed run per length and part, however many they are, and add up again."""
    import pyarrow as pa

    rnd = np.random.default_rng(8)
    shards = [np.unique((rnd.integers(0, 60, (3000, 2)) << 40) + 7, axis=0).T for _ in range(3)]
    sent = pa.concat_tables([P._dealt(s, words, np.full(words.shape[1], 50), 4) for s, words in enumerate(shards)])
    assert sent.num_rows == 12 and sent.nbytes < sum(w.shape[1] for w in shards) * 16
    expected = Counter(tuple(c) for words in shards for c in words.T.tolist())
    got, steps = {}, {s: set() for s in range(3)}
    for p in range(4):
        part = sent.filter(pa.compute.equal(sent.column("part"), p))
        table = P._frequent_phrases(100)(part)
        got |= {tuple(w): a for w, a in zip(table.column("ws").to_pylist(), table.column("a").to_pylist())}
        for r in P._frequent_pairs(100)(part).to_pylist():
            steps[r["shard"]] |= set(map(tuple, P._unpacked(r["packed"], 2, r["n"]).T.tolist()))
    frequent = {c: 50 * n for c, n in expected.items() if n > 1}
    assert got == frequent and frequent
    assert steps == {s: {tuple(c) for c in words.T.tolist()} & set(frequent) for s, words in enumerate(shards)}
