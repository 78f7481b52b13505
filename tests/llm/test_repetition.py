import random
import tracemalloc

import pytest

from traitlens.llm import repetition as R

from llm.edge_rows import edge_docs, empty_docs  # noqa: F401


def brute(words, k):
    places = {}
    for i in range(len(words) - k + 1):
        places.setdefault(tuple(words[i:i + k]), []).append(i)
    covered = {j for v in places.values() if len(v) > 1 for i in v for j in range(i, i + k)}
    longest = 0
    for i in range(len(words)):
        for j in range(i + 1, len(words)):
            n = 0
            while j + n < len(words) and words[i + n] == words[j + n]:
                n += 1
            longest = max(longest, n)
    return len(covered), longest if longest >= k else 0


@pytest.mark.parametrize("k", [1, 2, 5])
def test_suffix_array_equals_brute_force(k):
    rnd = random.Random(k)
    for _ in range(120):
        docs = []
        for _ in range(rnd.randint(0, 6)):
            d = [b"%d" % rnd.randint(0, rnd.choice([1, 3, 40])) for _ in range(rnd.randint(0, 50))]
            docs.append(d + d[rnd.randint(0, len(d)):] + d[:7] if rnd.random() < .5 else d)
        covered, longest = R.repeats(docs, k)
        assert [(int(c), int(m)) for c, m in zip(covered, longest)] == [brute(d, k) for d in docs]


def test_coverage_by_several_lengths_equals_brute_force():
    rnd = random.Random(11)
    for _ in range(60):
        docs = []
        for _ in range(rnd.randint(1, 5)):
            d = [b"%d" % rnd.randint(0, rnd.choice([1, 4, 60])) for _ in range(rnd.randint(0, 60))]
            docs.append(d + d[rnd.randint(0, len(d)):] + d[:rnd.randint(0, 12)])
        covered, _ = R.covered_by(docs, (5, 5, 6, 8, 10))
        assert covered.tolist() == [[brute(d, k)[0] for d in docs] for k in (5, 5, 6, 8, 10)]


def test_texts_that_only_the_method_rejects():
    rnd = random.Random(12)
    words = [f"w{i}" for i in range(2000)]
    rnd.shuffle(words)
    line = " ".join(words[:11])
    once = " ".join(words[20:220])                     # nothing repeats
    # 22 of 140 words (16 %) in a repeat of 11 words; 22 of 320 (7 %)
    much, little = (f"{line} {' '.join(words[300:300 + n])} {line}" for n in (118, 298))
    # 12 of 82 words (15 % at most, but 14.6 % in repeats of six words, over 14 %)
    six = " ".join(words[:6] + words[700:770] + words[:6])
    # a repeat of 101 words in a text of 2,000 (10.1 % of words in repeats of ten words)
    long = " ".join(words[:1798] + words[:101] + words[1798:1899])
    got = R.measure([once, much, little, six, long], R.Limits())
    assert got["base_failed"].tolist() == [False] * 5
    assert got["kept"].tolist() == [True, False, True, False, False]
    assert got["longest_repeat"].tolist() == [0, 11, 11, 6, 101]


def test_blocks_do_not_change_results(monkeypatch):
    texts = ["a b c d e f a b c d e g", "a b c d e f", None, "x " * 50]
    whole = {k: v.tolist() for k, v in R.measure(texts, R.Limits()).items()}
    monkeypatch.setattr(R, "BLOCK_WORDS", 1)
    assert {k: v.tolist() for k, v in R.measure(texts, R.Limits()).items()} == whole


def test_edges(edge_docs, empty_docs):
    got = sorted((tuple(r) for r in R.quality_rules(edge_docs).collect()), key=str)
    assert len(got) == edge_docs.count()
    by = {r[0]: r for r in got}
    assert by[2][1:6] == by[3][1:6] == by[4][1:6] == (0, 0, 0, 0, 0) and not by[2][7]
    assert by[6][5] == 3000 and by[6][6] and not by[6][7]
    assert by[1][7] and by[None][7]
    kept = R.keep_quality(edge_docs)
    assert kept.columns == edge_docs.columns
    assert sorted((r.doc_id for r in kept.collect()), key=str) == [1, 7, 7, None]
    assert R.quality_rules(empty_docs).count() == R.keep_quality(empty_docs).count() == 0


def test_base_counts():
    words, chars, symbols, lines = R.text_counts("a b\u00a0c\n#x\na b\u00a0c\n\n \na b\u00a0c")
    assert (len(words), chars, symbols, lines) == (7, 3 * 4 + 2, 1, 2)


def test_memory_of_a_block_of_texts():
    """Texts are sorted in blocks whose arrays take far less than a worker's share of an executor."""
    rnd, words = random.Random(3), [f"w{i}" for i in range(3000)]
    texts = [" ".join(rnd.choice(words) for _ in range(500)) for _ in range(1200)]
    tracemalloc.start()
    R.measure(texts, R.Limits())
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 25e6
