import random

from traitlens.llm import kneser_ney as K

from llm.edge_rows import edge_docs, empty_docs  # noqa: F401


def test_held_out_accuracy_and_edges(spark, edge_docs, empty_docs):
    rnd = random.Random(3)
    good = [" ".join(rnd.choice(["river", "stone", "under", "light", "field"]) for _ in range(30)) for _ in range(1000)]
    bad = ["".join(rnd.choice("#*$%&|<>qxz") for _ in range(150)) for _ in range(40)]
    docs = spark.createDataFrame([(i, t, "en") for i, t in enumerate(good + bad)], "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(i, 1, 0) for i in range(800)], "doc_id long, quality int, toxic int")
    kept = {r.doc_id: r.kept for r in K.classify(docs, labels).collect()}
    assert sum(kept[i] for i in range(800, 1000)) >= 190 and not any(kept[i] for i in range(1000, 1040))
    rows = {r.doc_id: r for r in K.classify(edge_docs, labels).collect()}
    assert rows[2].perplexity is None and not rows[2].kept and not rows[3].kept
    assert K.classify(edge_docs, labels).count() == edge_docs.count()
    assert K.classify(empty_docs, labels).count() == 0
    assert all(r.kept for r in K.classify(docs, labels.where("false")).collect())
