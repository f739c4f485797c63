import math
from collections import defaultdict

import numpy as np

from flexframe.llm import topk

from .conftest import SF


def brute(rows, every, k):
    good = [(i, [math.floor(1024 * float(x)) for x in v]) for i, v in rows
            if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    good = list({(i, tuple(v)) for i, v in good})
    out = []
    by_query = defaultdict(list)
    for q, v in good:
        if q % every == 0:
            by_query[q] += [(-sum(a * b for a, b in zip(v, w)), i) for i, w in good if i != q and len(w) == len(v)]
    for q, found in by_query.items():
        out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(sorted(found)[:k])]
    return sorted(out)


def test_against_brute_force(spark):
    df = spark.read.parquet(f"{SF}/embeddings.parquet")
    rows = [(r.vec_id, r.embedding) for r in df.select("vec_id", "embedding").collect()]
    got = sorted(map(tuple, topk.self_search(df, 25, 10).collect()))
    assert got == brute(rows, 25, 10)


def test_edges(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 2.0]), (1, [1.0, 2.0]), (2, [1.0, 2.0]), (3, None), (4, [nan, 1.0]), (5, [inf, 0.0]), (6, [None, 1.0]),
            (7, [-0.0005, 0.3]), (0, [1.0, 2.0]), (None, [1.0, 1.0]), (8, [1.0]), (9, []), (10, []), (100, [3.0]), (-100, [0.5, 0.5]), (11, [1.0, 2.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").selectExpr("*", "1 as rank", "2 as score", "3 as g")
    assert sorted(map(tuple, topk.self_search(df, 10, 3).collect())) == brute(rows, 10, 3)
    assert topk.self_search(df.where("false")).count() == 0


def test_large_values_stay_exact(spark):
    rows = [(0, [2.0 ** 20 + 1 / 1024, 3.0]), (1, [2.0 ** 20 + 1 / 1024, 1 / 1024]), (2, [2.0 ** 20 + 1 / 1024, 2 / 1024])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert sorted(map(tuple, topk.self_search(df, 100, 5).collect())) == brute(rows, 100, 5)


def test_many_tiles_and_ties(spark, monkeypatch):
    monkeypatch.setattr(topk, "QUERY_TILE", 3)
    monkeypatch.setattr(topk, "SHARD_TILE", 7)
    rng = np.random.default_rng(1)
    rows = [(int(i), [float(x) for x in rng.integers(-2, 3, 4)]) for i in range(300)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(5)
    assert sorted(map(tuple, topk.self_search(df, 7, 10).collect())) == brute(rows, 7, 10)


def test_keys_grow_with_the_tables(spark, monkeypatch):
    monkeypatch.setattr(topk, "QUERY_TILE", 4)
    monkeypatch.setattr(topk, "SHARD_TILE", 5)
    monkeypatch.setattr(topk, "MEETING", 2)
    rng = np.random.default_rng(2)
    rows = [(int(i), [float(x) for x in rng.integers(-2, 3, 4)]) for i in range(400)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(3)
    found = topk.self_search(df, 5, 6)
    assert sorted(map(tuple, found.collect())) == brute(rows, 5, 6)
    # 400 rows in groups of 10, 80 queries in blocks of 8
    assert topk.grid(400, 80) == (40, 10) and found.count() == 480
