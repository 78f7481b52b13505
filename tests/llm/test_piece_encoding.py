import hashlib
import random

import numpy as np
import pytest
import sentencepiece

from traitlens.llm import piece_encoding as P
from traitlens.llm.registry import tokenizer

from llm.edge_rows import edge_docs, empty_docs  # noqa: F401

PATH = tokenizer("piece_bpe_32k.model")
ODD = [None, "", " ", "   ", "\n", " \n ", "a", "▁", "▁▁ x", "<s> </s> <unk> <0x0A>", "\x00", "﻿x", "🙂🙂 🙂",
       "日本語 テキスト", "é é", "\r\n\t", "x" * 5000, " " * 3000, "ab" * 2000, "a " * 3000, "\U0010ffff"]


def library():
    return sentencepiece.SentencePieceProcessor(model_file=PATH)


def strings(seed, n):
    rnd = random.Random(seed)
    vocabulary = library()
    for _ in range(n):
        kind = rnd.random()
        if kind < 0.4:
            yield "".join(vocabulary.id_to_piece(rnd.randrange(259, 32000)) for _ in range(rnd.randint(1, 30)))
        elif kind < 0.7:
            yield "".join(rnd.choice("etaoin shrdlu\n  .,ÉéßAB") for _ in range(rnd.randint(1, 200)))
        else:
            yield "".join(chr(rnd.choice([rnd.randrange(1, 0xd800), rnd.randrange(0xe000, 0x30000), 32, 0x2581]))
                          for _ in range(rnd.randint(1, 40)))


def test_ids_and_texts_equal_the_library():
    c, sp = P.Codec(PATH), library()
    for text in [t or "" for t in ODD] + list(strings(4, 3000)):
        ids = sp.encode(text, add_bos=True, add_eos=True)
        assert np.frombuffer(c.encode(text), "<u4").tolist() == ids
        assert c.decode(np.array(ids, "<u4").tobytes()) == sp.decode(ids)


@pytest.mark.parametrize("short", [0, 10_000])
def test_agenda_equals_best_pair_by_search(monkeypatch, short):
    """A search of all pairs for the best one after every merge gives the agenda's pieces, list or heap."""
    monkeypatch.setattr(P, "SHORT", short)
    agenda = P.Codec(PATH).agenda
    for text in strings(8, 300):
        symbols = list(text)
        while True:
            pairs = [(agenda.costs[a + b], i) for i, (a, b) in enumerate(zip(symbols, symbols[1:]))
                     if a + b in agenda.costs]
            if not pairs:
                break
            i = min(pairs)[1]
            symbols[i:i + 2] = ["".join(symbols[i:i + 2])]
        assert agenda.merged(text) == symbols


@pytest.mark.parametrize("cuts", [True, False])
def test_segments_lose_nothing_and_whole_texts_agree(cuts):
    c, sp = P.Codec(PATH), library()
    if not cuts:
        c.cuts, c.segments = False, lambda text: [text]
    texts = [t or "" for t in ODD[:15]] + list(strings(6, 400))
    for t in texts:
        assert "".join(c.segments(t)) == t
    ids = [c.encode(t) for t in texts]
    c.check(texts, ids, [c.decode(x) for x in ids])
    assert [np.frombuffer(x, "<u4").tolist() for x in ids] == sp.encode(texts, add_bos=True, add_eos=True)


def test_full_store_of_segments_changes_nothing(monkeypatch):
    monkeypatch.setattr(P, "SEGMENTS_KEPT", 3)
    c, sp = P.Codec(PATH), library()
    for text in strings(2, 100):
        assert np.frombuffer(c.encode(text), "<u4").tolist() == sp.encode(text, add_bos=True, add_eos=True)


def test_unknown_symbols_without_byte_pieces():
    agenda = P.Agenda({"ab": -1.0}, {"a": 5, "b": 6, "ab": 7}, None, 0)
    assert np.frombuffer(agenda["abxyaz"], "<u4").tolist() == [7, 0, 5, 0]


def test_difference_from_the_library_raises():
    c = P.Codec(PATH)
    c.agenda.costs = {}  # nothing is merged
    with pytest.raises(ValueError, match="ids differ"):
        c.check(["some text"], [c.encode("some text")], ["some text"])
    c = P.Codec(PATH)
    with pytest.raises(ValueError, match="decoded"):
        c.check(["some text"], [c.encode("some text")], ["another text"])


def test_documents(spark, edge_docs, empty_docs):  # noqa: F811
    sp = library()
    docs = spark.createDataFrame(list(enumerate(ODD)), "doc_id long, text string").repartition(3)
    for frame in (docs, edge_docs):
        expected = []
        for r in frame.collect():
            ids = sp.encode(r["text"] or "", add_bos=True, add_eos=True)
            expected.append((r["doc_id"], len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
                             hashlib.sha256(sp.decode(ids).encode()).hexdigest()))
        assert sorted(map(tuple, P.digests(frame, PATH).collect()), key=str) == sorted(expected, key=str)
    back = {r["doc_id"]: r["decoded"] for r in P.coded(docs, PATH).collect()}
    assert back == {i: (t or "").replace("▁", " ") for i, t in enumerate(ODD)}
    assert P.digests(empty_docs, PATH).count() == 0 and P.coded(empty_docs, PATH).count() == 0
