"""Exact samples, dense row numbers, hot join keys, functions that run once."""

import os

import pytest
from pyspark.sql import functions as F

from flexframe import Frame
from flexframe.errors import ErrorThresholdExceeded
from flexframe.functions.rownumbers import with_row_numbers
from flexframe.plans.datagen import generate_beside


def sample(frame, path, **options):
    frame.spigot(str(path), options)
    return sorted(map(tuple, frame.spark.read.schema("id long, x string").json(str(path)).collect()))


def test_a_sample_does_not_depend_on_partitions(spark, tmp_path):
    df = spark.range(5000).selectExpr("id", "concat('v', id % 7) AS x")
    one, other = Frame(df.coalesce(1), "f"), Frame(df.orderBy(F.desc("id")).repartition(9), "f")
    for i, options in enumerate(({"topk": 40}, {"prob": 0.2}, {"prob": 0.5, "topk": 10}, {"prob": 0.2, "seed": 3})):
        a = sample(one, tmp_path / f"a{i}", **options)
        assert a == sample(other, tmp_path / f"b{i}", **options)
        assert set(a) <= set(map(tuple, df.collect()))
        assert len(a) == options["topk"] if "topk" in options else 850 < len(a) < 1150
    assert sample(one, tmp_path / "all", prob=1.0) == sorted(map(tuple, df.collect())) and sample(one, tmp_path / "none", prob=0.0) == []


def test_row_numbers_are_dense(spark):
    df = spark.range(0, 1000, 1, 7).where("id % 3 <> 1").repartition(5).union(spark.range(2000, 2003))
    rows = with_row_numbers(df, "n")
    assert sorted(r.n for r in rows.collect()) == list(range(df.count()))
    assert sorted(map(tuple, rows.collect())) == sorted(map(tuple, rows.collect()))
    assert rows.select("id").exceptAll(df).isEmpty()
    assert with_row_numbers(df.where("id < 0")).count() == 0
    spec = {"columns": [{"name": "s", "column_type": "Sequential", "start": 5, "step": 2, "data_type": "Int"}]}
    assert sorted(r.s for r in generate_beside(df, spec, ["id"]).collect()) == [5 + 2 * i for i in range(df.count())]


def test_a_hot_join_key_is_spread(spark):
    left = spark.range(3000).selectExpr("if(id % 3 = 0, 7, id) AS k", "id AS v", "'l' AS same")
    right = spark.range(100).selectExpr("id AS k2", "concat('r', id) AS w").union(spark.sql("SELECT 7L, 'second'"))
    held = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plain = Frame(left, "l").join("k", "k2", Frame(right, "r")).toDF()
        dealt = Frame(left, "l").join("k", "k2", Frame(right, "r"), spread=8).toDF()
        assert dealt.columns == plain.columns and sorted(map(tuple, dealt.collect())) == sorted(map(tuple, plain.collect()))
        tasks = lambda df: df.where("k = 7").select(F.spark_partition_id().alias("p")).distinct().count()
        assert tasks(plain) == 1 and tasks(dealt) >= 4
        # the hot side may be either one, and keys of unlike types still meet
        back = Frame(right.selectExpr("cast(k2 AS int) AS k2", "w"), "r").join("k2", "k", Frame(left, "l"), spread=8).toDF()
        assert back.count() == plain.count() and tasks(back) >= 4
        nulls = left.selectExpr("nullif(k, 7) AS k", "v")
        assert Frame(nulls, "l").join("k", "k2", Frame(right, "r"), spread=4).count() == Frame(nulls, "l").join("k", "k2", Frame(right, "r")).count()
    finally:
        for k, v in held.items():
            spark.conf.set(k, v)


@pytest.mark.parametrize("how", ["map", "filter", "mapPartitions"])
def test_a_write_with_thresholds_runs_the_function_once_per_row(spark, tmp_path, how):
    seen = str(tmp_path / "calls")

    def called(r):
        with open(seen, "a") as f:
            f.write(f"{r['id']}\n")
        if r["id"] % 10 == 0:
            raise RuntimeError("tenth")
        return True

    def mapped(r):
        return called(r) and {"id": r["id"]}

    def partition(records):
        for r in records:
            try:
                called(r)
                yield r
            except RuntimeError as e:
                yield {"isError": True, "errorMessage": str(e), "record": dict(r)}

    f = Frame(spark.range(0, 100, 1, 4), "f")
    run = {"map": lambda **k: f.map(mapped, **k), "filter": lambda **k: f.filter(called, **k), "mapPartitions": lambda **k: f.mapPartitions(partition, **k)}[how]
    out = run(stageThreshold=50)
    errors = out.write("file", {"path": str(tmp_path / "out"), "mode": "overwrite"}, "parquet")
    assert out.errorsCount() == 10 and out.stageErrorsCount() == 10 and errors.count() == 10
    assert spark.read.parquet(str(tmp_path / "out")).count() == 90
    with open(seen) as fh:
        assert sorted(map(int, fh)) == list(range(100))
    os.remove(seen)
    with pytest.raises(ErrorThresholdExceeded):
        run(stageThreshold=10).write("file", {"path": str(tmp_path / "never"), "mode": "overwrite"}, "parquet")
    assert not os.path.exists(tmp_path / "never")


def test_scratch_folders_can_be_removed():
    import subprocess
    import sys

    code = """
import os, sys
sys.path.insert(0, %r)
from flexframe.session import clean_scratch, local_session, scratch_dir
spark = local_session(cores=1)
a, b = scratch_dir(spark), scratch_dir(spark, "x")
spark.range(3).write.mode("overwrite").parquet(a)
print("GONE", clean_scratch(spark), os.path.exists(a), os.path.exists(b), clean_scratch(spark))
""" % os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    told = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, timeout=240).stdout
    assert "GONE 2 False False 0" in told
