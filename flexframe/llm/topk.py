"""Exact top-k search: tiled matrix products, partial selection, tree merging.

Vectors are quantised to whole numbers, packed into tiles (a bounded number of
vectors as one binary row), and each query tile meets each shard tile once, in
blocks: shard tiles in groups and query tiles in blocks, as many as the tables ask for. A tile pair is one
matrix product; the k best per query are selected from it, and a task merges
the lists of its tile pairs before it reports them. The lists then merge by
query and branch, and last by query.

Scores are exact: products run in float64 where every partial sum stays below
2^53, in int64 below 2^63, and else in Python integers. A score that doesn't
fit a long raises.

Defined results: vectors that are null or hold null or non-finite components
take no part; so do rows with a null id; an empty vector scores 0 with other
empty vectors; vectors of different lengths have no inner product and never
meet; rows repeated with equal id and vector count once, and other rows with
the query's own id are no candidates of it; ties go to the smaller id; other
columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

SCALE = 1024
QUERY_TILE = 512
SHARD_TILE = 4096
#: Tiles of either side that meet under one key, about; and the least number of groups of shard tiles.
MEETING, GROUPS = 64, 24


def quantised(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """``vec_id`` and ``v`` (array of whole doubles) of the rows that take part, each once."""
    vector = df[vector_col]
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x.cast("double")) == float("inf")))
    return (
        df.where(df[id_col].isNotNull() & vector.isNotNull() & ~bad)
        .select(df[id_col].cast("long").alias("vec_id"),
                F.transform(vector, lambda x: F.rint(F.floor(x.cast("double") * SCALE).cast("double"))).alias("v"))
        .dropDuplicates(["vec_id", "v"])
    )


def _packed(rows: DataFrame, per_tile: int) -> DataFrame:
    """(dim, ids, matrix): tiles of up to ``per_tile`` vectors of one length, from each task's own rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list] = {}

        def tile(dim: int):
            ids, matrix = zip(*held.pop(dim))
            return pa.RecordBatch.from_arrays(
                [pa.array([dim], pa.int32()), pa.array([np.array(ids, "<i8").tobytes()], pa.binary()),
                 pa.array([np.array(matrix, "<f8").tobytes()], pa.binary())], names=["dim", "ids", "matrix"])

        for b in batches:
            for vec_id, v in zip(b.column(0).to_pylist(), b.column(1)):
                values = v.values.to_numpy(zero_copy_only=False)
                own = held.setdefault(len(values), [])
                own.append((vec_id, values))
                if len(own) >= per_tile:
                    yield tile(len(values))
        for dim in list(held):
            yield tile(dim)

    return rows.mapInArrow(run, "dim int, ids binary, matrix binary")


def _products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of the rows of two whole-valued matrices, exactly."""
    most = float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * max(1, a.shape[1])
    if most < 2 ** 53:
        return (a @ b.T).astype(np.int64)
    if most < 2 ** 62:
        return a.astype(np.int64) @ b.astype(np.int64).T
    exact = np.array([[sum(int(x) * int(y) for x, y in zip(r, s)) for s in b] for r in a], dtype=object)
    if exact.size and max(abs(exact.min()), abs(exact.max())) >= 2 ** 63:
        raise OverflowError("a score does not fit a long")
    return exact.astype(np.int64)


def _best(ids: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
    """Places of the k best: higher score first, then smaller id."""
    if len(scores) > k:
        least = np.partition(scores, len(scores) - k)[len(scores) - k]
        at = np.flatnonzero(scores >= least)  # ties at the border stay in
    else:
        at = np.arange(len(scores))
    return at[np.lexsort((ids[at], -scores[at]))][:k]


def grid(rows: int, queries: int, least: int = GROUPS) -> tuple[int, int]:
    """Groups of shard tiles and blocks of query tiles, of about ``MEETING`` tiles each."""
    return max(least, math.ceil(rows / (SHARD_TILE * MEETING))), max(1, math.ceil(queries / (QUERY_TILE * MEETING)))


def search(df: DataFrame, queries: DataFrame, k: int = 10, id_col: str = "vec_id", vector_col: str = "embedding",
           groups: int = GROUPS) -> DataFrame:
    """The k best of ``df`` for each row of ``queries``: query_id, rank, vec_id, score."""
    if k < 1:
        raise ValueError("k must be at least 1")
    shard = _packed(quantised(df, id_col, vector_col), SHARD_TILE)
    query = _packed(quantised(queries, id_col, vector_col), QUERY_TILE)
    # a grid of keys that grows with both tables: a shard tile goes to all blocks of queries, a query tile to all groups
    groups, blocks = grid(df.count(), queries.count(), groups)
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    part = lambda n: F.pmod(F.xxhash64("ids"), F.lit(n)).cast("int")
    dealt = shard.select("*", part(groups).alias("g")).select("*", every(blocks).alias("h"))
    sent = query.select("dim", F.col("ids").alias("q_ids"), F.col("matrix").alias("q_matrix"), part(blocks).alias("h")).select("*", every(groups).alias("g"))
    pairs = dealt.join(sent, ["g", "h", "dim"]).select("dim", "ids", "matrix", "q_ids", "q_matrix")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lists: dict[int, tuple[np.ndarray, np.ndarray]] = {}

        def told():
            q = np.repeat(np.array(list(lists), np.int64), [len(x[0]) for x in lists.values()])
            ids, scores = (np.concatenate([x[i] for x in lists.values()]) for i in (0, 1))
            lists.clear()
            return pa.RecordBatch.from_arrays([pa.array(q), pa.array(ids), pa.array(scores)], names=["query_id", "vec_id", "score"])

        for batch in batches:
            for dim, ids, matrix, q_ids, q_matrix in zip(*(c.to_pylist() for c in batch.columns)):
                ids, q_ids = np.frombuffer(ids, "<i8"), np.frombuffer(q_ids, "<i8")
                m = np.frombuffer(matrix, "<f8").reshape(len(ids), dim)
                for at in range(0, len(q_ids), 64):  # a bounded strip of the product at a time
                    own = q_ids[at:at + 64]
                    product = _products(np.frombuffer(q_matrix, "<f8").reshape(len(q_ids), dim)[at:at + 64], m)
                    for q, scores in zip(own.tolist(), product):
                        other = ids != q
                        i, s = ids[other], scores[other]
                        best = _best(i, s, k)
                        i, s = i[best], s[best]
                        if q in lists:
                            i, s = np.concatenate([lists[q][0], i]), np.concatenate([lists[q][1], s])
                            best = _best(i, s, k)
                            i, s = i[best], s[best]
                        lists[q] = (i, s)
                if len(lists) >= 1 << 16:
                    yield told()
        if lists:
            yield told()

    found = pairs.mapInArrow(run, "query_id long, vec_id long, score long")
    best = [F.col("score").desc(), F.col("vec_id")]
    # lists merge in two levels, so that no task reads all lists of a query at once
    branch = F.pmod(F.xxhash64("query_id", "vec_id"), F.lit(8))
    some = found.withColumn("branch", branch).withColumn(
        "r", F.row_number().over(W.partitionBy("query_id", "branch").orderBy(*best))).where(F.col("r") <= k)
    return some.withColumn("rank", F.row_number().over(W.partitionBy("query_id").orderBy(*best))).where(
        F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def self_search(df: DataFrame, every: int = 100, k: int = 10, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """``search`` with the rows of ``df`` whose id is divisible by ``every`` as queries."""
    return search(df, df.where(F.pmod(df[id_col], F.lit(every)) == 0), k, id_col, vector_col)
