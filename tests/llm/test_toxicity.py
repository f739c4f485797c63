import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from flexframe.llm import toxicity

from .conftest import EDGES

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def tables(spark):
    return spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")


@pytest.fixture(scope="module")
def model(tables):
    return toxicity.fit(*tables)


def test_held_out_accuracy(spark, tables, model):
    documents, labels = tables
    out = toxicity.score(spark, documents, model)
    assert out.columns == ["doc_id", "held_out", "score", "predicted"] and out.count() == documents.count()
    rows = out.join(labels, "doc_id").collect()
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) and 0 <= r.score <= 1
    held = [r for r in rows if r.held_out]
    assert np.mean([(r.score >= 0.7) == (r.toxic == 1) for r in held]) >= 0.95


def test_labels_of_held_out_rows_teach_nothing(tables, model):
    documents, labels = tables
    other = labels.withColumn("toxic", F.when(toxicity.held_out(F.col("doc_id")), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    again = toxicity.fit(documents, other)
    assert again.bias == model.bias and (again.weights == model.weights).all()


def test_scores_of_a_batch_are_those_of_each_text(model):
    rng = random.Random(1)
    texts = ["".join(rng.choice("abc idiot scum") for _ in range(rng.randrange(0, 400))).encode() for _ in range(60)] + [b"", b"x"]
    every = toxicity.probabilities(texts, model)
    assert np.allclose(every, [toxicity.probabilities([t], model)[0] for t in texts])


def test_strips_lose_no_ngram(monkeypatch):
    text = bytes(random.Random(3).choices(b"abcdefgh ", k=1000))
    whole = {(d, c) for ds, cs in toxicity.grams([text]) for d, c in zip(ds.tolist(), cs.tolist())}
    monkeypatch.setattr(toxicity, "_STRIP", 50)
    assert {(d, c) for ds, cs in toxicity.grams([text]) for d, c in zip(ds.tolist(), cs.tolist())} == whole


def test_edges(spark, tables, model, edges, empty):
    out = toxicity.score(spark, edges, model).collect()
    assert len(out) == len(EDGES) and all(0 <= r.score <= 1 for r in out)
    assert toxicity.score(spark, empty, model).count() == 0
    none = toxicity.fit(edges, spark.createDataFrame([(1, None), (None, 1)], "doc_id long, toxic int"))
    assert all(r.predicted == 0 for r in toxicity.score(spark, edges, none).collect())
    kept = toxicity.drop_toxic(spark, edges, model)
    assert kept.columns == edges.columns and kept.count() <= len(EDGES)


def test_few_labels_teach(spark):
    bad = [f"you {w} fool number{i} go away" for i, w in enumerate(["nasty", "vile"] * 5)]
    good = [f"the {w} weather number{i} in may" for i, w in enumerate(["sunny", "mild"] * 5)]
    model = toxicity.train([t.encode() for t in bad + good], np.array([1] * 10 + [0] * 10))
    assert (model.weights != 0).sum() > 0
    new = spark.createDataFrame([(1, "you nasty fool go"), (2, "the mild weather in"), (3, "")], "doc_id long, text string")
    scores = {r.doc_id: r.score for r in toxicity.score(spark, new, model).collect()}
    assert scores[1] > 0.7 > 0.3 > scores[2]


def test_scores_against_plain_python(spark, docs):
    """N-grams one by one: each distinct one of a text adds its weight once."""
    rng = np.random.default_rng(1)
    model = toxicity.Model(rng.normal(size=1 << toxicity.BITS) * 0.05, -0.2)

    def code(gram):
        h = gram[0]
        for c in gram[1:]:
            h = (h * 16777619 + c) % 2 ** 32
        return ((h ^ (len(gram) * 40503) % 2 ** 32) * 2654435761 % 2 ** 32) >> (32 - toxicity.BITS)

    texts = [(i, t) for i, t in docs[:25]] + [(-1, None), (-2, ""), (-3, "A"), (-4, "ab\0cd" * 3)]
    got = {r.doc_id: r.score for r in toxicity.score(spark, spark.createDataFrame(texts, "doc_id long, text string"), model).collect()}
    for i, t in texts:
        body = b" " + (t or "").encode().lower() + b" "
        codes = {code(body[k:k + n]) for n in toxicity.GRAMS for k in range(len(body) - n + 1) if 0 not in body[k:k + n]}
        z = model.bias + sum(float(model.weights[c]) for c in codes)
        assert abs(got[i] - 1 / (1 + np.exp(-z))) < 1e-6


def test_clashing_columns_of_labels(tables, model):
    documents, labels = tables
    more = labels.selectExpr("*", "'x' AS text", "1 AS label", "2 AS score", "3 AS held_out", "'en' AS lang")
    again = toxicity.fit(documents.selectExpr("*", "1 AS toxic", "0 AS quality", "5 AS label"), more)
    assert again.bias == model.bias and (again.weights == model.weights).all()
