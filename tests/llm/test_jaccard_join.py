import random
from itertools import combinations

import numpy as np
import pytest

from traitlens.llm import jaccard_join as J
from traitlens.llm.common import shingle_set, words_of
from traitlens.llm.components import components

from llm.edge_rows import edge_docs, empty_docs  # noqa: F401


def corpus(seed=1, n=60):
    rnd = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(4000)]
    rows, i = [], 0
    for _ in range(n):
        words = [rnd.choice(vocabulary) for _ in range(rnd.randint(30, 120))]
        for _ in range(rnd.choice([1, 1, 2, 5])):
            copy = list(words)
            for _ in range(rnd.randint(0, 2)):
                copy[rnd.randrange(len(copy))] = rnd.choice(vocabulary)
            rows.append((i, " ".join(copy)))
            i += 1
            if rnd.random() < .2:
                rows.append((i, " ".join(copy)))
                i += 1
    # a hot group of near copies and a passage that many share
    hot = [rnd.choice(vocabulary) for _ in range(150)]
    passage = [rnd.choice(vocabulary) for _ in range(30)]
    for _ in range(80):
        copy = list(hot)
        for _ in range(2):
            copy[rnd.randrange(150)] = rnd.choice(vocabulary)
        rows.append((i, " ".join(copy)))
        rows.append((i + 1, " ".join([rnd.choice(vocabulary) for _ in range(60)] + passage)))
        i += 2
    return rows


def brute(rows):
    sets = {}
    for i, t in rows:
        sets.setdefault(frozenset(shingle_set(words_of(t)).tolist()), []).append(i)
    keys = [k for k in sets if k]
    links = {(min(sets[a]), min(sets[b])) for a, b in combinations(keys, 2)
             if len(a & b) >= .8 * len(a | b) - 1e-9}
    return sets, {tuple(sorted(x)) for x in links}


@pytest.mark.parametrize("options", [{}, dict(leaf=2, bucket=8, block=4)])
def test_links_equal_brute_force(spark, options):
    rows = corpus()
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    sets, links = brute(rows)
    got = {(r.a, r.b) for r in J.pairs(docs, **options).collect()}
    assert got == links
    near = {r.doc_id: r for r in J.near_duplicates(docs, **options).collect()}
    degree = {}
    for a, b in links:
        degree[a] = degree.get(a, 0) + 1
        degree[b] = degree.get(b, 0) + 1
    for members in sets.values():
        for i in members:
            assert near[i].copy_id == min(members) and near[i].n_copies == len(members)
            assert near[i].n_links == degree.get(min(members), 0)
    assert all(near[a].class_id == near[b].class_id for a, b in links)
    kept = sorted(r.doc_id for r in J.one_of_each(docs, **options).collect())
    assert kept == sorted({r.class_id for r in near.values()})


def test_edges(spark, edge_docs, empty_docs):
    rows = J.near_duplicates(edge_docs).collect()
    by = {r.doc_id: r for r in rows}
    assert len(rows) == edge_docs.count()
    assert by[2].class_id == 2 and by[3].class_id == 3 and by[4].class_id == 4
    assert by[1].class_id == by[7].class_id == 1 and by[7].n_copies == 3 and by[7].n_similar == 2
    assert by[None].class_id is None
    kept = J.one_of_each(edge_docs)
    assert kept.columns == edge_docs.columns
    assert sorted((r.doc_id for r in kept.collect()), key=str) == sorted([1, 2, 3, 4, 5, 6, None], key=str)
    assert J.near_duplicates(empty_docs).count() == J.one_of_each(empty_docs).count() == 0


def test_repeated_rows_and_shared_keys(spark):
    text = " ".join(f"a{i}" for i in range(40))
    other = " ".join(f"b{i}" for i in range(40))
    docs = spark.createDataFrame([(5, text), (5, text), (5, other), (9, other), (None, text)], "doc_id long, text string")
    kept = sorted((r.doc_id, r.text[0]) for r in J.one_of_each(docs).collect())
    assert kept == [(5, "a"), (5, "b")]


def test_runs_reach_the_recall():
    assert J.runs_for(0.8, 0.99) >= 7 and J.runs_for(0.9) < J.runs_for(0.8)


def test_shared_counts_over_many_columns(monkeypatch):
    rnd = np.random.default_rng(6)
    a = [np.unique(rnd.integers(0, 4000, 900).astype(np.uint64)) for _ in range(7)]
    want = [[len(np.intersect1d(x, y)) for y in a[3:]] for x in a[:3]]
    assert J.shared_counts(a[:3], a[3:]).astype(int).tolist() == want


def test_components_of_a_path_a_star_and_an_empty_table(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 160)]
    df = spark.createDataFrame(edges, "a long, b long").repartition(3)
    got = {r.node: r.label for r in components(df).collect()}
    assert set(got.values()) == {0, 100} and all(got[i] == 0 for i in range(41))
    assert components(df.where("false")).count() == 0
