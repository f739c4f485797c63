"""Drifting JSON, relationalize, unbox, array functions (FIXTURES.md section 3)."""

import json

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from flexframe import Frame
from flexframe.functions import explode_with_index, named_struct, replace_array_element
from flexframe.sources.readers import from_options

DRIFT = [
    '{"a":1,"b":{"x":null,"y":[1,"z"]},"n":null}',
    '{"a":"s","b":{"x":null,"y":[{"k":1}]},"c":1.5}',
    '{"a":1.25,"d":true}',
    "{bad",
]
NESTED = [
    '{"k":1,"t":"a","arr":[{"x":1,"y":{"z":[1,2]}},{"x":2,"y":{"z":[]}}],"m":{"q":1}}',
    '{"k":2,"t":"b","arr":[],"m":{"q":2}}',
    '{"k":3,"t":"c"}',
]


def _write(tmp_path, name, lines):
    p = tmp_path / name
    p.write_text("\n".join(lines) + "\n")
    return str(p)


def test_drift_choices_and_error_record(spark, tmp_path):
    f = from_options(spark, "file", {"paths": [_write(tmp_path, "drift.json", DRIFT)]}, format="json")
    assert f.choices["a"] == ["long", "string", "double"]
    assert "b.y" in f.choices and sorted(f.choices["b.y"]) == ["long", "string", "struct"]
    assert f.df.count() == 3
    errs = f.errorsAsFrame().df.collect()
    assert len(errs) == 1 and errs[0].record == "{bad"
    rows = {json.dumps(r.a.asDict()) for r in f.df.collect()}
    assert rows == {json.dumps({"long": 1, "string": None, "double": None}),
                    json.dumps({"long": None, "string": "s", "double": None}),
                    json.dumps({"long": None, "string": None, "double": 1.25})}
    casted = f.resolveChoice(specs=[("a", "cast:double")])
    assert sorted(r.a for r in casted.df.collect() if r.a is not None) == [1.0, 1.25]
    assert casted.errorsCount() == 2  # the bad line and "s"
    projected = f.resolveChoice(specs=[("a", "project:string")])
    assert sorted([r.a for r in projected.df.collect()], key=lambda v: (v is not None, v or "")) == [None, None, "s"]


def test_relationalize_two_levels(spark, tmp_path):
    f = from_options(spark, "file", {"paths": [_write(tmp_path, "nested.json", NESTED)]}, format="json")
    tables = f.relationalize("root", str(tmp_path / "stage"))
    assert sorted(tables.keys()) == ["root", "root_arr", "root_arr.val.y.z"]
    root = {r.k: r for r in tables["root"].df.collect()}
    assert set(tables["root"].df.columns) == {"k", "t", "arr", "m.q"}
    assert root[3].arr is None and root[2].arr is not None  # missing vs empty array
    child = tables["root_arr"].df
    assert child.columns == ["id", "index", "arr.val.x", "arr.val.y.z"]
    kids = sorted((r["index"], r["arr.val.x"]) for r in child.collect())
    assert kids == [(0, 1), (1, 2)]
    assert {r.id for r in child.collect()} == {root[1].arr}
    grand = tables["root_arr.val.y.z"].df.collect()
    assert sorted((r["index"], r["arr.val.y.z.val"]) for r in grand) == [(0, 1), (1, 2)]
    first_child_key = [r["arr.val.y.z"] for r in child.collect() if r["index"] == 0][0]
    assert {r.id for r in grand} == {first_child_key}


def test_relationalize_rejoin_equals_explode(spark, tmp_path):
    df = spark.createDataFrame([(1, ["a", "b"]), (2, []), (3, None), (1, ["c"])], "k int, xs array<string>")
    tables = Frame(df, "t").relationalize("r", str(tmp_path / "stage2"))
    root, child = tables["r"].df, tables["r_xs"].df
    rejoined = root.join(child, root["xs"] == child["id"]).select("k", "index", F.col("`xs.val`").alias("v"))
    direct = df.select("k", F.posexplode("xs").alias("index", "v"))
    assert sorted(map(tuple, rejoined.collect())) == sorted(map(tuple, direct.collect()))


def test_relationalize_with_key_option(spark):
    df = spark.createDataFrame([(10, ["a"]), (20, ["b", "c"])], "k int, xs array<string>")
    tables = Frame(df, "t").relationalize("r", options={"key": ["k"]})
    assert sorted(r.id for r in tables["r_xs"].df.collect()) == ["10", "20", "20"]


def test_unbox_json_and_csv(spark):
    df = spark.createDataFrame([(1, '{"k": 1, "v": "x"}'), (2, '{"k": "two"}'), (3, "{oops"), (4, None)], "id long, payload string")
    f = Frame(df, "boxed").unbox("payload", "json")
    assert f.choices == {"payload.k": ["long", "string"]}
    assert f.df.count() == 3 and f.errorsCount() == 1
    csv = spark.createDataFrame([(1, "1|x"), (2, "2|y"), (3, '3|"unterminated')], "id long, payload string")
    schema = '{"type":"struct","fields":[{"name":"n","type":"integer","nullable":true,"metadata":{}},{"name":"s","type":"string","nullable":true,"metadata":{}}]}'
    u = Frame(csv, "c").unbox("payload", "csv", separator="|", withSchema=schema)
    got = sorted((r.id, r.payload.n, r.payload.s) for r in u.df.collect())
    assert got[:2] == [(1, 1, "x"), (2, 2, "y")]
    headed = spark.createDataFrame([(1, "a|b\n1|x"), (2, "a|b\n2|y")], "id long, payload string")
    h = Frame(headed, "h").unbox("payload", "csv", separator="|", withHeader=True)
    assert h.df.schema["payload"].dataType.names == ["a", "b"]
    assert sorted(r.payload.b for r in h.df.collect()) == ["x", "y"]
    with pytest.raises(NotImplementedError):
        Frame(df, "b").unbox("payload", "avro")


def test_array_functions(spark):
    df = spark.createDataFrame([(1, ["a", "b", "c"])], "k int, xs array<string>")
    assert [tuple(r) for r in df.select(explode_with_index("xs")).collect()] == [(0, "a"), (1, "b"), (2, "c")]
    assert df.select(replace_array_element("xs", "Z", 1).alias("r")).collect()[0].r == ["a", "Z", "c"]
    s = df.select(named_struct({"k"}).alias("s")).collect()[0].s
    assert s.k == 1


def test_unbox_csv_rows_with_different_headers(spark):
    boxes = ["a,b\n1,2", "b,a\n2,1", "a,c,b\n1,3,2", None, "a,b\n1,2,3", "a,a\n1,1", 'b\n"x,y"']
    df = spark.createDataFrame(list(enumerate(boxes)), "k int, box string")
    for order in (df, df.orderBy(F.desc("k"))):
        f = Frame(order, "f").unbox("box", "csv", withHeader=True)
        got = {r.k: r.box and (r.box.a, r.box.b, r.box.c) for r in f.toDF().collect()}
        assert got == {0: ("1", "2", None), 1: ("1", "2", None), 2: ("1", "2", "3"), 3: None, 6: (None, "x,y", None)}
        assert f.errorsCount() == 2
