"""Projections, mappings, row functions, errors, joins, collections, partitions."""

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from flexframe import Frame, FrameSet, ResolveOption
from flexframe.errors import ErrorThresholdExceeded
from flexframe.operators import transforms as T


@pytest.fixture
def nulls(spark):
    df = spark.createDataFrame(
        [(1, None, [Row(p=1, q=None)], []), (2, None, [Row(p=3, q=None)], [None])],
        "a int, b string, c array<struct<p:int,q:int>>, d array<void>")
    return Frame(df, "nulls")


def test_drop_null_fields(nulls):
    out = nulls.drop_null_fields()
    assert out.df.schema.simpleString() == "struct<a:int,c:array<struct<p:int>>,d:array<void>>"


@pytest.fixture
def functions_frame(spark):
    return Frame(spark.createDataFrame([(1, 0), (2, 1), (3, None), (4, 2)], "id long, v int"), "fx")


def test_filter_exceptions(functions_frame):
    def pred(r):
        if r.v is None:
            raise TypeError("none")          # dropped silently
        if r.v == 0:
            raise ZeroDivisionError("zero")  # kept as an error record
        if r.v == 2:
            return r["missing"]              # KeyError: dropped
        return True

    out = functions_frame.filter(pred)
    assert [r.id for r in out.df.collect()] == [2]
    errs = out.errorsAsFrame().df.collect()
    assert len(errs) == 1 and errs[0].message == "zero" and '"id":1' in errs[0].record
    assert out.errorsCount() == 1 and out.stageErrorsCount() == 1


def test_map_errors_and_none(functions_frame):
    def f(r):
        if r.v is None:
            return None
        return {"id": r.id, "v": 10 // r.v}

    out = functions_frame.map(f)
    assert sorted((r.id, r.v) for r in out.df.collect()) == [(2, 10), (4, 5)]
    msgs = sorted(r.message for r in out.errorsAsFrame().df.collect())
    assert msgs == ["function returned no record", "integer division or modulo by zero"]
    # good + error rows = input rows
    assert out.df.count() + out.errorsCount() == functions_frame.df.count()


def test_thresholds(functions_frame):
    out = functions_frame.map(lambda r: {"id": r.id, "v": 10 // r.v}, stageThreshold=2)
    with pytest.raises(ErrorThresholdExceeded):
        out.assertErrorThreshold()
    ok = functions_frame.map(lambda r: {"id": r.id, "v": 10 // r.v}, stageThreshold=3)
    ok.assertErrorThreshold()
    chained = ok.filter(lambda r: 1 / 0, totalThreshold=4)
    with pytest.raises(ErrorThresholdExceeded):
        chained.assertErrorThreshold()


def test_apply_mapping_rules(spark):
    f = Frame(spark.createDataFrame([("1", "x", 2.5), ("z", "y", 1.0)], "Num string, name string, amt double"), "m")
    with pytest.raises(ValueError):
        f.apply_mapping([("a",)])
    with pytest.raises(TypeError):
        f.apply_mapping([["num", "n"]])
    out = f.apply_mapping(("num", "string", "n", "int"))
    assert out.df.collect() == [Row(n=1)]
    assert out.errorsCount() == 1
    nested = f.apply_mapping([("name", "s.name"), ("amt", "s.amt", "decimal")])
    assert nested.df.schema.simpleString() == "struct<s:struct<name:string,amt:decimal(10,2)>>"
    with pytest.raises(Exception):
        f.apply_mapping([("num", "n")], case_sensitive=True).df.collect()[0].n


def test_split_rows_partitions_rows(spark):
    df = spark.createDataFrame([(i, None if i % 4 == 0 else i) for i in range(20)], "id int, v int")
    parts = Frame(df, "r").split_rows({"v": {">": 5, "<=": 15}}, "hit", "rest")
    hit = {r.id for r in parts["hit"].df.collect()}
    rest = {r.id for r in parts["rest"].df.collect()}
    assert hit | rest == set(range(20)) and not hit & rest
    assert 4 not in hit and 8 in rest  # null compares false


def test_join_nulls_duplicates_and_clash(spark):
    left = Frame(spark.createDataFrame([(1, "a"), (1, "b"), (None, "n"), (2, "c")], "id int, name string"), "left")
    right = Frame(spark.createDataFrame([(1, "x"), (None, "m"), (3, "z")], "id int, name string"), "right")
    j = left.join("id", "id", right)
    assert j.name == "leftright"
    assert j.df.columns == ["id", "name", "id_r", "name_r"]
    assert sorted(tuple(r) for r in j.df.collect()) == [(1, "a", 1, "x"), (1, "b", 1, "x")]


def test_split_fields_and_names(spark):
    f = Frame(spark.createDataFrame([(1, 2, 3)], "a int, b int, c int"), "")
    parts = T.SplitFields.apply(frame=f, paths=["a"])
    assert set(parts.keys()) == {"frame1", "frame2"}
    assert parts["frame1"].df.columns == ["a"] and parts["frame2"].df.columns == ["b", "c"]


def test_collections(spark):
    a = Frame(spark.range(3), "a")
    b = Frame(spark.range(5), "b")
    fs = FrameSet([a, b])
    assert len(fs) == 2 and sorted(fs.keys()) == ["a", "b"]
    assert fs.select("zzz").df.count() == 0
    m = fs.map(lambda f, ctx: Frame(f.df.where("id > 0"), f.name))
    assert {k: v.df.count() for k, v in m.items()} == {"a": 2, "b": 4}
    with pytest.raises(TypeError):
        fs.map(lambda f, ctx: 1)
    flat = fs.flatmap(lambda f, ctx: f.split_rows({"id": {">": 1}}, f.name + "_hi", f.name + "_lo"))
    assert sorted(flat.keys()) == ["a_hi", "a_lo", "b_hi", "b_lo"]
    with pytest.raises(TypeError):
        FrameSet("nope")


def test_partitions(spark):
    f = Frame(spark.range(100), "p")
    assert f.repartition(7).getNumPartitions() == 7
    assert f.repartition(7).coalesce(2).getNumPartitions() == 2
    assert f.coalesce(9, shuffle=True).getNumPartitions() == 9


def test_to_df_options(spark):
    a = Frame(spark.createDataFrame([(1,)], "k long"), "a")
    b = Frame(spark.createDataFrame([("x",), ("2",)], "k string"), "b")
    m = a.merge(b)
    assert m.choices == {"k": ["long", "string"]}
    with pytest.raises(ValueError):
        m.toDF([ResolveOption("k", "Project")])
    proj = m.toDF([ResolveOption("k", "Project", "long")])
    assert sorted(r.k for r in proj.collect() if r.k is not None) == [1]
    cast = m.resolveChoice(specs=[("k", "cast:long")])
    assert sorted(r.k for r in cast.df.collect()) == [1, 2]
    assert cast.errorsCount() == 1  # "x" cannot become a long
    with pytest.raises(ValueError):
        m.resolveChoice()
    with pytest.raises(ValueError):
        m.resolveChoice(specs=[("k", "make_struct")], choice="make_struct")
    kept = m.toDF([ResolveOption("k", "KeepAsStruct")])
    assert kept.schema["k"].dataType.names == ["long", "string"]


def test_nondeterministic_map_is_checkpointed(functions_frame):
    import random

    out = functions_frame.map(lambda r: {"id": r.id, "v": random.randint(0, 10**9)}, deterministic=False)
    first = sorted(tuple(r) for r in out.df.collect())
    assert first == sorted(tuple(r) for r in out.df.collect())
    assert out.df.count() + out.errorsCount() == 4


def test_python_workers_can_import_package(spark):
    """Python-backed operators must not depend on the driver's working folder."""
    import os

    from flexframe.session import _SHIPPED

    f = Frame(spark.range(5).withColumn("v", __import__("pyspark.sql.functions", fromlist=["lit"]).lit(1)), "w")
    out = f.map(lambda r: {"id": r.id, "v": r.v + 1})
    assert spark.sparkContext.applicationId in _SHIPPED
    assert sorted(r.v for r in out.df.collect()) == [2] * 5
    assert os.path.basename(os.getcwd()) or True


def test_schema_helpers_and_nested_join(spark, capsys):
    from pyspark.sql.types import LongType, StringType, StructField, StructType

    df = spark.createDataFrame([(1, ("a", 10)), (2, ("b", 20))], "id long, s struct<name:string,k:long>")
    f = Frame.fromDF(df, None, "nested")
    f.printSchema()
    f.show(1)
    assert "s: struct" in capsys.readouterr().out
    assert f.count() == 2 and f.schema() == df.schema
    target = StructType([StructField("id", StringType()), StructField("extra", LongType())])
    g = f.with_frame_schema(target.json())
    assert g.df.schema == target and g.df.where("extra is null").count() == 2
    right = Frame(spark.createDataFrame([(10, "ten"), (30, "thirty")], "k long, label string"), "r")
    j = f.join("s.k", "k", right)
    assert [(r.id, r.label) for r in j.df.collect()] == [(1, "ten")]


def test_mapping_keeps_choice_marks(spark):
    a = Frame(spark.createDataFrame([(1, 5)], "id long, k long"), "a")
    b = Frame(spark.createDataFrame([(2, "x")], "id long, k string"), "b")
    m = a.merge(b).apply_mapping([("id", "id"), ("k", "key")])
    assert m.choices == {"key": ["long", "string"]}
    assert sorted(r.key for r in m.resolveChoice(choice="project:long").df.collect() if r.key is not None) == [5]
