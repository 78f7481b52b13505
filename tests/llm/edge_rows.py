import pytest

TEXTS = [
    (1, "One two three four five six seven eight nine ten eleven twelve."),
    (2, None), (3, ""), (4, " \n\t "), (5, "a@b.co" * 1),
    (6, "word " * 3000),
    (7, "One two three four five six seven eight nine ten eleven twelve."),
    (7, "One two three four five six seven eight nine ten eleven twelve."),
    (None, "A text without a key that is long enough to be kept by every rule there is here."),
]
#: Names that operators use inside, as further columns of their input.
CLASHES = ("key", "id", "k", "t", "h", "n", "rep", "label", "row", "text_key", "ids", "part", "before", "source", "lang",
           "n_words", "kept", "start", "length", "spans", "m", "print", "path", "rule", "host", "digest", "_id", "_doc")


@pytest.fixture(scope="module")
def edge_docs(spark):
    extra = ", ".join(f"{c} string" for c in CLASHES)
    rows = [(i, t, *([None] * len(CLASHES))) for i, t in TEXTS]
    return spark.createDataFrame(rows, f"doc_id long, text string, {extra}")


@pytest.fixture(scope="module")
def empty_docs(edge_docs):
    return edge_docs.where("false")
