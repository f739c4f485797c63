import pytest

SF = "/root/testdata/sf0.001"

#: Texts that every operator must take: null, empty, blanks, non-Latin, ties, repeats, a long one.
EDGES = [
    (1, None), (2, ""), (3, " \t\n "), (4, "one"), (5, "One"), (6, "naïve café — ünïcode 漢字 🙂 x"),
    (7, "a b c d e f " * 40), (8, "a b c d e f " * 40), (8, "a b c d e f " * 40), (None, "no id here at all"),
    (9, "same id, first text"), (9, "same id, second text"), (10, "word " * 30000), (11, "x" * 50000),
]


@pytest.fixture(scope="session")
def edges(spark):
    """The edge texts with columns whose names clash with the operators' own."""
    rows = [(i, t, 7, "s", -1, "k", -2) for i, t in EDGES]
    return spark.createDataFrame(
        rows, "doc_id long, text string, n_words int, shard string, fp int, fingerprint string, cell int")


@pytest.fixture(scope="session")
def empty(edges):
    return edges.where("false")


@pytest.fixture(scope="session")
def docs(spark):
    """(doc_id, text) of the given documents, as Python rows."""
    return [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
