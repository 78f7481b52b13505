import random
import zlib

import numpy as np
import pytest

from traitlens.llm import packing as P
from traitlens.llm.registry import tokenizer

from llm.edge_rows import edge_docs, empty_docs  # noqa: F401

PATH = tokenizer("word_bpe_49k.json")


def check(rows, texts, encode, window):
    pieces = {}
    for r in rows:
        pieces.setdefault(r["doc_id"], []).append(r)
    for i, t in texts.items():
        ids = encode(t)
        own = sorted(pieces[i], key=lambda r: r["start"])
        assert own[0]["start"] == 0 and sum(r["length"] for r in own) == len(ids) == own[0]["doc_tokens"]
        at = 0
        for r in own:
            assert r["start"] == at and r["length"] > 0
            at += r["length"]
            assert r["ids_crc32"] == zlib.crc32(np.array(ids[r["start"]:at], "<u4").tobytes())
    windows = {}
    for r in rows:
        windows.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for w, spans in windows.items():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at == window or w == max(windows)
    assert sorted(windows) == list(range(len(windows)))


@pytest.mark.parametrize("weights,window", [(None, 64), ({"a": 3, "b": 1}, 64), (None, 2048)])
def test_every_id_in_one_piece(spark, weights, window):
    rnd = random.Random(7)
    texts = {i: " ".join(rnd.choice(["Stone,", "river", "été", "don't", "42", "x"]) for _ in range(rnd.randint(0, 120)))
             for i in range(150)}
    texts[150] = None
    docs = spark.createDataFrame([(i, t, [None, "a", "b", "b"][i % 4]) for i, t in texts.items()],
                                 "doc_id long, text string, source string").repartition(7)
    rows = [r.asDict() for r in P.pack(docs, PATH, weights, window).collect()]
    model = P.Tokenizer(PATH).model
    check(rows, texts, lambda t: model.encode(t or "", add_special_tokens=False).ids + [1], window)
    if weights is None:
        share = {}
        full = max(r["sequence_id"] for r in rows)
        total = sum(r["length"] for r in rows)
        for r in rows:
            if r["sequence_id"] < full - 1:
                key = (r["sequence_id"], r["source"])
                share[key] = share.get(key, 0) + r["length"]
        for s in (None, "a", "b"):
            mean = window * sum(r["length"] for r in rows if r["source"] == s) / total
            assert all(abs(share.get((w, s), 0) - mean) <= 6 for w in range(full - 1))


def test_tokenizer_by_pieces_equals_whole_texts(monkeypatch):
    monkeypatch.setattr(P, "PIECES_KEPT", 50)
    encode, rnd = P.Tokenizer(PATH), random.Random(8)
    alphabet = list("abÉé.,'-_ \n\t\x1c\x85 İßΣς09|<>") + ["<|endoftext|>", "'s", "東京", "ﬁ", "ª", "word. "]
    for _ in range(300):
        texts = ["".join(rnd.choice(alphabet) for _ in range(rnd.randint(0, 15))) for _ in range(5)]
        for t, ids in zip(texts, encode(texts)):
            assert encode.model.encode(t, add_special_tokens=False).ids + [1] == ids.tolist()


def test_marks_after_a_word_are_a_unit_of_their_own(monkeypatch):
    """A word with marks after it, new or not, is not encoded by all rules."""
    encode, seen = P.Tokenizer(PATH), []
    whole = encode._whole
    monkeypatch.setattr(encode, "_whole", lambda texts, sizes: seen.extend(texts) or whole(texts, sizes))
    texts = ["Été!! (été); river_ été!!", "don't stone)}~ 4.0.", "ÿ?! Straße-- ÀÉ: x"]
    for t, ids in zip(texts, encode(texts)):
        assert encode.model.encode(t, add_special_tokens=False).ids + [1] == ids.tolist()
    assert sorted(seen) == sorted(["", "!!", "(été);", "_", "don't", ")}~", "4.0.", "?!", "--", ":"])


def test_kept_units_are_few():
    """What a worker keeps from slice to slice stays small beside a slice, however many words it meets."""
    encode = P.Tokenizer(PATH)
    letters = "abcdefghijklmnopqrst"
    words = [a + b + c + d + e for a in letters for b in letters for c in letters for d in letters for e in letters[:2]]
    for i in range(0, 240_000, 60_000):
        encode([" ".join(words[i:i + 60_000])])
    encode([words[0]])
    assert len(encode.kept.sizes) < 150_000


def test_places_follow_the_rounds():
    """Closed form against a simulation of deficit round-robin token by token."""
    quanta, totals, window = np.array([70_000, 200_000, 3], np.int64), np.array([50, 130, 2], np.int64), 8
    order, given = [], [0, 0, 0]
    r = 0
    while sum(given) < totals.sum():
        r += 1
        for s in range(3):
            due = min(int(totals[s]), r * int(quanta[s]) >> P.SHIFT)
            order += [(s, t) for t in range(given[s], due)]
            given[s] = max(given[s], due)
    place = {x: i for i, x in enumerate(order)}
    docs = np.array([(s, i, int(totals[s]) - i) for s in range(3) for i in (0, 1)])
    seen = np.zeros(len(docs), int)
    for i, a, m, at in zip(*P.pieces_of(*docs.T, quanta, totals, window)):
        s, start, _ = docs[i]
        assert [place[s, start + a + j] for j in range(m)] == list(range(at, at + m))
        assert at // window == (at + m - 1) // window
        seen[i] += m
    assert seen.tolist() == docs[:, 2].tolist()


def test_edges(edge_docs, empty_docs):
    rows = P.pack(edge_docs, PATH).collect()
    assert {r.doc_id for r in rows} == {1, 2, 3, 4, 5, 6, 7, None}
    assert [r.length for r in rows if r.doc_id in (2, 3, 4)] == [1, 1, 1]
    assert P.pack(empty_docs, PATH).count() == 0
