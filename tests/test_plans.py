"""Plan shape checks for the scale claims in the README."""

from pyspark.sql import functions as F

from flexframe import Frame
from flexframe.plans import pages

from .conftest import SF


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_relationalize_children_do_not_shuffle(spark, tmp_path):
    df = spark.createDataFrame([(1, [("a", [1, 2])]), (2, [])], "k int, xs array<struct<s:string,n:array<int>>>")
    tables = Frame(df, "t").relationalize("r", str(tmp_path / "stage"))
    for name, frame in tables.items():
        assert "Exchange" not in _plan(frame.df), name


def test_page_jobs_do_not_shuffle(spark):
    p = spark.read.parquet(f"{SF}/pages.parquet")
    for df in (pages.top_links(p, 4, 2), pages.page_metadata(p), pages.url_parts(p)):
        plan = _plan(df)
        assert "Exchange" not in plan and "Window" not in plan


def test_join_is_not_forced_to_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        o = Frame(spark.read.parquet(f"{SF}/orders.parquet"), "o")
        l = Frame(spark.read.parquet(f"{SF}/lineitem.parquet"), "l")
        plan = _plan(o.join("o_orderkey", "l_orderkey", l).df)
        assert "BroadcastHashJoin" not in plan and "SortMergeJoin" in plan
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_inference_aggregates_map_side(spark):
    from flexframe.operators.choice import frame_from_json_text

    raw = spark.createDataFrame([('{"a": 1}',)] * 50 + [('{"a": "x"}',)], "value string")
    f = frame_from_json_text(raw, "value")
    assert f.choices == {"a": ["long", "string"]}
    shapes = raw.select(F.schema_of_variant(F.try_parse_json("value")).alias("s")).groupBy("s").count()
    assert "partial_count" in _plan(shapes)
