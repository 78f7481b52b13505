import math
import pathlib
import random
from collections import Counter

import numpy as np
import pyarrow.parquet as pq

from traitlens.llm import char_model as C
from traitlens.llm import kneser_ney as K
from traitlens.session import checkpoint_dir


def brute(texts):
    """Log-probability of a string's last character by the recursion over dictionaries."""
    padded = ["\0" * (C.ORDER - 1) + t for t in texts]
    levels = {C.ORDER: Counter(s[i:i + C.ORDER] for s in padded for i in range(len(s) - C.ORDER + 1))}
    for order in range(C.ORDER - 1, 0, -1):
        levels[order] = Counter(g[1:] for g in levels[order + 1])

    def p(gram):
        order, counts = len(gram), levels[len(gram)]
        lower = p(gram[1:]) if order > 1 else 1 / (len(levels[1]) + 1)
        seen = [c for g, c in counts.items() if g[:-1] == gram[:-1]]
        if not seen:
            return lower
        n = Counter(counts.values())
        y = n[1] / max(1, n[1] + 2 * n[2])
        d = [0.0, *(max(0.0, i - (i + 1) * y * n[i + 1] / n[i]) if n[i] else i * y for i in (1, 2, 3))]
        c = counts.get(gram, 0)
        return (c - d[min(c, 3)]) / sum(seen) + sum(d[min(x, 3)] for x in seen) / sum(seen) * lower
    return lambda gram: math.log(p(gram))


def test_model_equals_recursion_on_real_letters(spark):
    texts = [(0, "кот сидел на столе"), (0, "кит плыл"), (1, "Кот и пёс, 猫と犬"), (1, "the cat"), (2, "𝔘 das Öl, der Öl"),
             (2, None), (0, "")]
    orders = C.train(spark.createDataFrame(texts, "g long, text string"), 3)
    asked = ["\0\0\0\0\0к", "кот си", "кит си", "Кот си", "ёе猫と犬и", "er Öl𝔘", "zzzzzz", "das Öl"]
    rows = C.log_probabilities(spark.createDataFrame([(a,) for a in asked], "gram string"), orders, 3).collect()
    models = [brute([t for g, t in texts if t and g != m]) for m in range(3)]
    assert len(rows) == len(asked)
    for r in rows:
        assert all(math.isclose(r[f"p_{m}"], models[m](r.gram), rel_tol=1e-6, abs_tol=1e-9) for m in range(3))
    got = {r.gram: r.p_1 for r in rows}
    assert got["кот си"] > got["Кот си"]  # case and letters are not folded


def test_scores_of_texts():
    rnd = random.Random(6)
    for _ in range(30):
        texts = [rnd.choice((None, "", "".join(rnd.choice("aéж𝔘") for _ in range(rnd.randint(1, 20))))) for _ in range(8)]
        hashes = np.unique(C.grams_of(texts)[0])
        log = dict(zip(hashes.tolist(), -np.arange(1, len(hashes) + 1) / 50))
        n, mean, worst = C.scores_of(texts, hashes, np.array([log[h] for h in hashes.tolist()]))
        for t, a, b, c in zip(texts, n, mean, worst):
            x = [log[h] for h in C.grams_of([t])[0].tolist()]
            assert a == len(t or "") == len(x)
            if x:
                w = min(C.PASSAGE, a)
                assert math.isclose(b, math.exp(-sum(x) / a), abs_tol=2e-6)
                assert math.isclose(c, math.exp(-min(sum(x[i:i + w]) for i in range(a - w + 1)) / w), abs_tol=2e-6)


def test_a_few_toxic_words_are_rejected(spark):
    rnd = random.Random(7)
    text = lambda *more: " ".join(rnd.sample([*(rnd.choice(["river", "stone", "under", "light", "field"])
                                               for _ in range(120)), *more], 120 + len(more)))
    docs = [(i, text(), "en") for i in range(400)] + [(i, text("scum", "idiot"), "en") for i in range(400, 440)]
    labels = [(i, 1, 0) for i in range(300)] + [(i, 1, 1) for i in range(400, 420)]
    rows = K.classify(spark.createDataFrame(docs, "doc_id long, text string, lang string"),
                      spark.createDataFrame(labels, "doc_id long, quality int, toxic int")).collect()
    kept = {r.doc_id: r.kept for r in rows}
    assert not any(kept[i] for i in range(400, 440)) and sum(kept[i] for i in range(400)) >= 380


def test_blocks_write_no_row_per_gram_and_change_no_score(spark, monkeypatch):
    rnd = random.Random(8)
    parts = ["river", "stone", "und", "light", "field", "кот", "猫と", "e", "ing", "th", "on"]
    text = lambda: "".join(rnd.choice(parts) + rnd.choice(("", "", " ")) for _ in range(700))
    rows = [(i, text(), "en") for i in range(400)]
    rows += [(None, text(), "en"), (None, None, None), (7, text(), "en"), (8, "", "en"), rows[9]]  # keys repeat or are null
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    trusted = spark.createDataFrame([(i,) for i in range(300)], "_id long")
    folder = pathlib.Path(checkpoint_dir(spark).removeprefix("file:"))

    def scored(block):
        monkeypatch.setattr(C, "BLOCK", block)
        return sorted(map(repr, C.perplexities(docs, trusted, 5, "doc_id", "text", "lang").collect()))

    before = set(folder.iterdir())
    whole = scored(1 << 24)
    new = sum(pq.read_metadata(f).num_rows for d in set(folder.iterdir()) - before for f in d.rglob("*.parquet"))
    # lists are packed: no row per n-gram is written
    assert len(whole) == len(rows) and new < len(np.unique(C.grams_of([t for _, t, _ in rows])[0])) / 2
    assert scored(1 << 16) == whole
