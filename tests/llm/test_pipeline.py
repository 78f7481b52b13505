"""The pipeline against brute force, stage by stage, and the entry point's guard."""

import corpus_pipeline as C

from traitlens.llm import decontam, packing, pii, repetition
from traitlens.llm.common import shingle_set, words_of
from traitlens.llm.registry import queries, tokenizer

SF = "/root/testdata/sf0.001"


def test_stages_equal_brute_force(spark):
    from llm.test_decontam import brute as leaks
    from llm.test_packing import check
    from llm.test_repetition import brute as repeats

    docs = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    kept = []
    for d in docs:
        words = words_of(d[1])
        covered, longest = repeats(words, 5) if len(words) < 400 else tuple(
            int(x[0]) for x in repetition.repeats([words], 5))
        if len(words) >= 10 and 100 * covered <= 20 * len(words) and longest <= 100:
            kept.append(d)
    # near duplicates: least id of each connected group at 0.8
    sets = {d[0]: set(shingle_set(words_of(d[1])).tolist()) for d in kept}
    label = {i: i for i in sets}
    changed = True
    links = [(a, b) for a in sets for b in sets if a < b and len(sets[a] & sets[b]) >= .8 * len(sets[a] | sets[b]) - 1e-9]
    while changed:
        changed = False
        for a, b in links:
            least = min(label[a], label[b])
            changed |= label[a] != least or label[b] != least
            label[a] = label[b] = least
    kept = [d for d in kept if label[d[0]] == d[0]]
    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    bad = {d for d, _ in leaks([d[:2] for d in kept], items)}
    texts = {d[0]: pii.redacted(d[1]) for d in kept if d[0] not in bad}

    rows = [r.asDict() for r in C.run(spark, SF).collect()]
    assert {r["doc_id"] for r in rows} == set(texts)
    model = packing.Tokenizer(tokenizer("word_bpe_49k.json")).model
    check(rows, texts, lambda t: model.encode(t, add_special_tokens=False).ids + [1], packing.WINDOW)


def test_stages_keep_columns_and_take_empty_tables(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").where("false")
    for _, stage in C.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns and out.count() == 0
    assert C.STAGES[-1][1](spark, docs, SF).count() == 0


def test_registry():
    assert [n.split("_")[0] for n in queries()] == [f"op{i}" for i in range(1, 14)]
    assert 4 <= len(C.STAGES) <= 5
    assert decontam.RADIUS == 15
