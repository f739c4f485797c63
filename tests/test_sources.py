"""Sources, sinks, bookmarks, keyword files, file selection."""

import os

import pytest
from pyspark.sql import functions as F

from flexframe import Frame, FrameSet
from flexframe.sources.bookmark import Job
from flexframe.sources.files import keyword_lines, select_files
from flexframe.sources.readers import frame_name, from_catalog, from_options
from flexframe.sources.sinks import spigot, write_from_options, write_to_catalog

from .conftest import SF


def test_frame_name():
    assert frame_name(["s3://bucket/a/x.parquet", "s3://bucket/a/y.parquet"]) == "bucketa"
    assert len(frame_name([])) == 36


def test_pushdown_reaches_scan(spark):
    f = from_options(spark, "parquet", {"paths": [f"{SF}/orders.parquet"]}, push_down_predicate="o_orderstatus = 'F'")
    plan = f.select_fields(["o_orderkey"]).df._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(o_orderstatus), EqualTo(o_orderstatus,F)]" in plan
    assert "ReadSchema: struct<o_orderkey:bigint,o_orderstatus:string>" in plan


def test_column_filter_has_no_python(spark):
    f = from_options(spark, "parquet", {"paths": [f"{SF}/orders.parquet"]}).filter(F.col("o_totalprice") > 1)
    plan = f.df._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "ArrowEval" not in plan and "MapInArrow" not in plan


def test_partition_hints(spark):
    f = from_options(spark, "parquet", {"paths": [f"{SF}/orders.parquet"], "minPartitions": 6})
    assert f.getNumPartitions() == 6
    g = from_options(spark, "parquet", {"paths": [f"{SF}/orders.parquet"]}, targetPartitions=1)
    assert g.getNumPartitions() == 1


def test_csv_errors_and_catalog(spark, tmp_path):
    p = tmp_path / "x.csv"
    p.write_text("1,a\n2,b\nnot_a_number,c\n")
    f = from_options(spark, "file", {"paths": [str(p)]}, format="csv", schema="n int, s string", format_options={"mode": "PERMISSIVE"})
    assert sorted(r.n for r in f.df.collect()) == [1, 2]
    assert f.errorsCount() == 1
    f.df.createOrReplaceTempView("ff_csv_view")
    c = from_catalog(spark, table_name="ff_csv_view", push_down_predicate="n > 1")
    assert c.df.count() == 1
    with pytest.raises(ValueError):
        from_catalog(spark, database="a", name_space="b", table_name="t")
    with pytest.raises(ValueError):
        from_catalog(spark, database="a")


def test_writers_collection_and_catalog(spark, tmp_path):
    a = Frame(spark.range(3), "a")
    b = Frame(spark.range(4), "b")
    out = str(tmp_path / "coll")
    errs = write_from_options(FrameSet([a, b]), "file", {"path": out, "mode": "overwrite"}, "parquet")
    assert sorted(errs.keys()) == ["a_errors", "b_errors"]
    assert spark.read.parquet(f"{out}/b").count() == 4
    with pytest.raises(TypeError):
        write_from_options("x", "file", {"path": out})
    spark.sql("DROP TABLE IF EXISTS ff_written")
    write_to_catalog(a, table_name="ff_written")
    write_to_catalog(b, table_name="ff_written")
    assert spark.table("ff_written").count() == 7


def test_spigot_sample_and_passthrough(spark, tmp_path):
    f = Frame(spark.range(1000), "s")
    out = str(tmp_path / "spig")
    assert spigot(f, out, {"prob": 0.1, "seed": 3}) is f
    n1 = spark.read.json(out).count()
    spigot(f, out, {"prob": 0.1, "seed": 3})
    assert spark.read.json(out).count() == n1 and 50 < n1 < 150
    spigot(f, out, {"topk": 5})
    assert spark.read.json(out).count() == 5


def test_keyword_lines(spark, tmp_path):
    (tmp_path / "k.txt").write_text("﻿first\r\n\r\nsecond\nthird\n\n", encoding="utf-8")
    got = [r.keyword for r in keyword_lines(spark, str(tmp_path / "k.txt")).collect()]
    assert got == ["first", "second", "third"]


def test_file_selection(spark, tmp_path):
    for d in ("cats", "dogs"):
        os.makedirs(tmp_path / d)
        for i in range(8):
            (tmp_path / d / f"{i}.jpg").write_bytes(b"x")
        (tmp_path / d / "x.gif").write_bytes(b"x")
        (tmp_path / d / "y.svg").write_bytes(b"x")
    got = select_files(spark, str(tmp_path)).collect()
    assert len(got) == 10
    assert {r.file_name for r in got} == {f"{i}.jpg" for i in range(5)}


def test_bookmarks(spark, tmp_path):
    landing, ledger = str(tmp_path / "landing"), str(tmp_path / "ledger")
    spark.range(0, 10).write.mode("append").parquet(landing)
    job = Job(spark, ledger)
    job.init("j", {"job-bookmark-option": "job-bookmark-enable"})
    read = lambda: from_options(spark, "file", {"paths": [landing]}, format="parquet", transformation_ctx="src").df.count()
    assert read() == 10
    job.commit()
    spark.range(10, 17).write.mode("append").parquet(landing)
    job.init("j", {"job-bookmark-option": "job-bookmark-enable"})
    assert read() == 7
    # no commit: the same files are offered again
    job.init("j", {"job-bookmark-option": "job-bookmark-enable"})
    assert read() == 7
    job.commit()
    job.init("j", {"job-bookmark-option": "job-bookmark-pause", "job-bookmark-from": "1", "job-bookmark-to": "3"})
    assert read() == 7
    job.init("j", {"job-bookmark-option": "job-bookmark-pause"})
    assert read() == 0
    job.init("j", {"job-bookmark-option": "job-bookmark-disable"})
    assert read() == 17
    with pytest.raises(ValueError):
        job.init("j", {"job-bookmark-option": "job-bookmark-pause", "job-bookmark-from": "1"})
    with pytest.raises(ValueError):
        job.init("j", {"job-bookmark-option": "job-bookmark-enable", "job-bookmark-from": "1", "job-bookmark-to": "1"})
    job.init("j", {"job-bookmark-option": "job-bookmark-enable", "job-bookmark-to": "1"})  # one end alone is ignored
    assert job.range is None
    job.init("j", {"job-bookmark-option": "continuation-ignore"})
    assert job.mode == "job-bookmark-disable"


def test_context_facades(spark, tmp_path):
    from flexframe import FlexContext

    ctx = FlexContext(spark)
    f = ctx.read.from_options("parquet", {"paths": [f"{SF}/region.parquet"]})
    out = str(tmp_path / "ctx")
    errs = ctx.write.from_options(f, "file", {"path": out}, format="json")
    assert errs.name.endswith("_errors") and errs.df.count() == 0
    back = ctx.read.from_options("file", {"paths": [out]}, format="json")
    assert back.df.count() == 5


def test_streaming_incremental(spark, tmp_path):
    from flexframe.streaming import run_incremental

    landing, out, ckpt = str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "ck")
    seen = []

    def process(frame, batch_id):
        seen.append(frame.df.count())
        frame.df.write.mode("append").parquet(out)

    spark.range(0, 10).write.mode("append").parquet(landing)
    run_incremental(spark, landing, "parquet", "id long", "ctx1", process, ckpt)
    spark.range(10, 17).write.mode("append").parquet(landing)
    run_incremental(spark, landing, "parquet", "id long", "ctx1", process, ckpt)
    run_incremental(spark, landing, "parquet", "id long", "ctx1", process, ckpt)
    assert sum(seen) == 17 and spark.read.parquet(out).count() == 17
