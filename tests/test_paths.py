import pytest
from pyspark.sql import Row

from flexframe.paths import drop_paths, rename_path, select_paths, split_path


def test_split_path_quotes():
    assert split_path("a.`b.c`.d") == ["a", "b.c", "d"]
    assert split_path("`x``y`") == ["x`y"]
    with pytest.raises(ValueError):
        split_path("a..b")


@pytest.fixture
def nested(spark):
    return spark.createDataFrame(
        [Row(id=1, s=Row(x=1, y="a", arr=[Row(p=1, q=2)]), t=None), Row(id=2, s=None, t=Row(u=3))],
        "id long, s struct<x:int,y:string,arr:array<struct<p:int,q:int>>>, t struct<u:int>")


def test_select_keeps_nesting_and_nulls(nested):
    out = select_paths(nested, ["s.x", "s.arr.q", "missing.path"])
    assert out.schema.simpleString() == "struct<s:struct<x:int,arr:array<struct<q:int>>>>"
    rows = out.orderBy("s.x").collect()
    assert rows[0].s is None
    assert rows[1].s.x == 1 and rows[1].s.arr[0].q == 2


def test_drop_through_arrays_and_empty_parent(nested):
    out = drop_paths(nested, ["s.arr.p", "t.u", "nope"])
    assert out.schema.simpleString() == "struct<id:bigint,s:struct<x:int,y:string,arr:array<struct<q:int>>>>"
    assert drop_paths(nested, ["s.x", "s.y", "s.arr"]).columns == ["id", "t"]


def test_rename_in_place_and_move(nested):
    out = rename_path(nested, "s.arr.p", "s.arr.pp")
    assert "pp" in out.schema["s"].dataType["arr"].dataType.elementType.names
    moved = rename_path(nested, "s.y", "top_y")
    assert moved.schema["s"].dataType.names == ["x", "arr"]
    assert sorted(r.top_y or "" for r in moved.collect()) == ["", "a"]
    into = rename_path(nested, "id", "t.id")
    assert into.schema["t"].dataType.names == ["u", "id"]


def test_dotted_names(spark):
    df = spark.createDataFrame([Row(**{"k": 1, "s": Row(**{"a.b": 5, "c": 6})})], "k int, s struct<`a.b`:int,c:int>")
    out = select_paths(df, ["s.`a.b`"])
    assert out.collect()[0].s["a.b"] == 5
    assert drop_paths(df, ["s.`a.b`"]).schema["s"].dataType.names == ["c"]


def test_select_and_drop_partition_the_leaves(spark):
    from hypothesis import given, settings
    from hypothesis import strategies as st

    from flexframe.paths import join_path, leaf_paths

    df = spark.createDataFrame([], "id long, s struct<x:int,y:string,arr:array<struct<p:int,q:int>>>, t struct<u:int,v:int>, w string")
    leaves = [join_path(p) for p in leaf_paths(df.schema)]
    assert leaves == ["id", "s.x", "s.y", "s.arr.p", "s.arr.q", "t.u", "t.v", "w"]

    @settings(max_examples=40, deadline=None)
    @given(st.sets(st.sampled_from(leaves), min_size=1, max_size=len(leaves) - 1))
    def check(chosen):
        kept = {join_path(p) for p in leaf_paths(select_paths(df, sorted(chosen)).schema)}
        rest = {join_path(p) for p in leaf_paths(drop_paths(df, sorted(chosen)).schema)}
        assert kept == set(chosen)
        assert kept | rest == set(leaves) and not kept & rest

    check()
