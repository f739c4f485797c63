"""Cases in which data was once lost, altered or misplaced."""

import subprocess
import sys

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType, IntegerType

from flexframe import Frame
from flexframe.functions.casts import safe_cast
from flexframe.functions.urls import search_url
from flexframe.operators.choice import frame_from_json_text
from flexframe.plans.pages import page_links, page_tabs, unescape
from flexframe.schema import ChoiceType, EnumType, SetType, merge_types, to_spark
from flexframe.sources.bookmark import Job
from flexframe.sources.readers import from_options
from flexframe.sources.sinks import write_to_catalog


def lines(tmp_path, text, name="x.txt"):
    p = tmp_path / name
    p.write_text(text)
    return str(p)


def test_json_values_that_are_no_objects(spark, tmp_path):
    f = from_options(spark, "file", {"paths": [lines(tmp_path, '{"a":1}\n[1,2]\n5\n{bad\n[]\n[{"a":2},{"a":3}]\n')]}, format="json")
    assert sorted(r.a for r in f.toDF().collect()) == [1, 2, 3]
    assert sorted(r.record for r in f.errorsAsFrame().toDF().collect()) == ["1", "2", "5", "[]", "{bad"]


def test_json_options_are_used_or_refused(spark, tmp_path):
    path = lines(tmp_path, '{"a":1}|{"a":2}')
    f = from_options(spark, "file", {"paths": [path]}, format="json", format_options={"lineSep": "|"})
    assert f.count() == 2
    with pytest.raises(ValueError):
        from_options(spark, "file", {"paths": [path]}, format="json", format_options={"allowComments": True})


def test_json_and_csv_errors_beside_a_schema(spark, tmp_path):
    j = from_options(spark, "file", {"paths": [lines(tmp_path, '{"a":1}\n{bad\n')]}, format="json", schema="a int")
    assert [r.a for r in j.toDF().collect()] == [1] and j.errorsCount() == 1
    c = from_options(spark, "file", {"paths": [lines(tmp_path, "a,b\n1,2\n3,4,5,6\n", "y.csv")]}, format="csv", format_options={"withHeader": True})
    assert [tuple(r) for r in c.toDF().collect()] == [("1", "2")] and c.errorsCount() == 1
    assert [r.record for r in c.errorsAsFrame().toDF().collect()] == ["3,4,5,6"]


def test_nested_mixed_arrays_and_large_numbers(spark):
    raw = spark.createDataFrame([('{"a":[{"b":[1,"x"]}],"n":12345678901234567890}',), ('{"n":1}',)], "value string")
    f = frame_from_json_text(raw, "value")
    assert f.choices == {"a.b": ["long", "string"], "n": ["decimal", "long"]}
    row = f.toDF().where("a is not null").first()
    assert [tuple(x) for x in row.a[0].b] == [(1, None), (None, "x")] and int(row.n.decimal) == 12345678901234567890


def test_cast_in_an_array_and_plain_structs(spark):
    f = frame_from_json_text(spark.createDataFrame([('{"a":[1,"zz"]}',), ('{"a":[1,"2"]}',)], "value string"), "value")
    done = f.resolveChoice(specs=[("a", "cast:long")])
    assert [r.a for r in done.toDF().collect()] == [[1, 2]] and done.errorsCount() == 1
    plain = Frame(spark.range(1).select(F.struct(F.lit(1).alias("x"), F.lit(2).alias("y")).alias("s")), "p")
    with pytest.raises(ValueError):
        plain.resolveChoice(specs=[("s", "project:int")])


def test_merge_never_aborts(spark):
    a = spark.createDataFrame([("1.5",)], "v string").select(F.col("v").cast("decimal(5,2)").alias("x"))
    b = spark.createDataFrame([("99999.25",), ("2.25",)], "v string").select(F.col("v").cast("decimal(12,2)").alias("x"))
    m = Frame(a, "a").merge(Frame(b, "b"))
    assert sorted(float(r.x) for r in m.toDF().collect()) == [1.5, 2.25] and m.errorsCount() == 1


def test_errors_count_once_after_a_join(spark):
    f = Frame(spark.createDataFrame([(1, "1"), (2, "x"), (3, "3")], "k int, v string"), "f").apply_mapping([("k", "k"), ("v", "n", "int")])
    halves = f.split_rows({"k": {">": 1}}, "a", "b")
    assert halves["a"].join("k", "k", halves["b"]).errorsCount() == 1


def test_mapping_targets(spark):
    f = Frame(spark.range(1).select(F.lit(1).alias("a"), F.lit(2).alias("b")), "f")
    for bad in ([("a", "x"), ("b", "x")], [("a", "x"), ("b", "x.y")], [("a", "x.y.z"), ("b", "x.y")]):
        with pytest.raises(ValueError):
            f.apply_mapping(bad)


def test_mapping_through_arrays(spark):
    df = spark.sql("SELECT 1 AS k, array(named_struct('id', 1, 'q', '5'), named_struct('id', 2, 'q', 'x'), null) AS items")
    f = Frame(df, "f").apply_mapping([("k", "k"), ("items.id", "out.number"), ("items.q", "out.text")])
    assert f.toDF().first().asDict(True) == {"k": 1, "out": [{"number": 1, "text": "5"}, {"number": 2, "text": "x"}, None]}
    assert Frame(df, "f").apply_mapping([("items.id", "ids", "long")]).toDF().first().ids == [1, 2, None]
    bad = Frame(df, "f").apply_mapping([("items.q", "out.n", "int")])
    assert bad.count() == 0 and bad.errorsCount() == 1


def test_rename_onto_a_taken_name(spark):
    f = Frame(spark.sql("SELECT 1 AS a, 2 AS b, named_struct('x', 1, 'y', 2) AS s"), "f")
    for old, new in (("a", "b"), ("s.x", "s.y")):
        with pytest.raises(ValueError):
            f.rename_field(old, new)


def test_relationalize_keys_with_nulls(spark):
    df = spark.createDataFrame([(None, "1", [10]), ("1", None, [20]), ("a|b", "c", [30]), ("a", "b|c", [40])], "a string, b string, xs array<int>")
    tables = Frame(df, "t").relationalize("r", options={"key": ["a", "b"]})
    ids = {r["id"]: r["xs.val"] for r in tables["r_xs"].toDF().collect()}
    assert sorted(ids.values()) == [10, 20, 30, 40]


def test_boxed_csv_keeps_every_line_or_tells(spark):
    df = spark.createDataFrame([(1, "a,b\n3,4"), (2, "a,b\n1,2\n3,4"), (3, "a,b")], "k int, box string")
    f = Frame(df, "f").unbox("box", "csv", withHeader=True)
    assert [(r.k, r.box.a, r.box.b) for r in f.toDF().collect()] == [(1, "3", "4")] and f.errorsCount() == 2


def test_unbox_inside_arrays(spark):
    df = spark.sql("""SELECT 1 AS k, array(named_struct('j', '{"a":1}'), named_struct('j', '{"a":"x"}'), named_struct('j', null)) AS xs
                      UNION ALL SELECT 2, array(named_struct('j', '{bad')) UNION ALL SELECT 3, null""")
    f = Frame(df, "f").unbox("xs.j", "json")
    rows = {r.k: r.asDict(True) for r in f.toDF().collect()}
    assert set(rows) == {1, 3} and f.errorsCount() == 1
    assert [x["j"] and x["j"]["a"] for x in rows[1]["xs"]] == [{"long": 1, "string": None}, {"long": None, "string": "x"}, None]
    typed = Frame(df.where("k = 1"), "f").unbox("xs.j", "json", withSchema="a string")
    assert [x.j and x.j.a for x in typed.toDF().first().xs] == ["1", "x", None]


def test_map_fields_outside_the_schema(spark):
    f = Frame(spark.range(2), "f").map(lambda r: {"id": r["id"], "extra": 1})
    assert f.count() == 0 and f.errorsCount() == 2
    free = Frame(spark.range(2), "f").map(lambda r: {"id": r["id"], "extra": "x" if r["id"] else 1}, infer=True)
    assert {k: sorted(v) for k, v in free.choices.items()} == {"extra": ["long", "string"]} and free.count() == 2


@settings(max_examples=40, deadline=None)
@given(st.lists(st.text(alphabet="0123456789+-.eEdDfF tTrRuUyYnN\x00\x1f\x7f\x85\xa0 xabinfty", max_size=8), min_size=1, max_size=60))
def test_screened_casts_equal_bare_ones(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "v string")
    for t in (IntegerType(), DecimalType(10, 2)):
        a = safe_cast(F.col("v"), t, df.schema["v"].dataType)
        assert df.where(~a.eqNullSafe(F.col("v").try_cast(t))).count() == 0
    for t in ("double", "boolean"):
        from flexframe.schema import parse_type

        a = safe_cast(F.col("v"), parse_type(t), df.schema["v"].dataType)
        assert df.where(~a.cast("string").eqNullSafe(F.col("v").try_cast(t).cast("string"))).count() == 0


def test_character_references(spark):
    text = "&#34;a&#x27;b&quot; &amp;lt; &eacute;&euro; &unknown; &#128512; & &; plain"
    got = spark.createDataFrame([(text,), ("none",), (None,)], "t string").select(unescape(F.col("t")).alias("u")).collect()
    assert [r.u for r in got] == ["\"a'b\" &lt; é€ &unknown; 😀 & &; plain", "none", None]


@settings(max_examples=40, deadline=None)
@given(st.lists(st.lists(st.sampled_from(
    ["&", "&", "#", "x", "X", ";", "amp", "copy", "notin", "not", "lt", "frac12", "CounterClockwiseContourIntegral", "fjlig", "Eacute", "micro", "lbrace",
     "150", "65", "0", "00", "80", "9f", "ffff", "10ffff", "110000", "d800", "1", "b", "é", " ", "<", "q=1", "\n"]), max_size=9).map("".join), min_size=1, max_size=30))
def test_character_references_equal_pythons(spark, texts):
    import html

    df = spark.createDataFrame([(t,) for t in texts], "t string").select("t", unescape(F.col("t")).alias("u"))
    assert [(r.t, r.u) for r in df.collect()] == [(t, html.unescape(t)) for t in texts]


def test_search_url_quoting(spark):
    row = spark.createDataFrame([("a/b~c*d e  f&g",)], "t string").select(search_url("t", "q=").alias("u")).first()
    assert row.u == "q=a/b~c%2Ad%20e%20%20f%26g"


def test_page_jobs_have_no_shuffle(spark):
    pages = spark.createDataFrame([(1, 'href="a" href="b" href="a"')], "page_id int, html string")
    for df in (page_links(pages), page_tabs(pages)):
        assert "Exchange" not in df._jdf.queryExecution().executedPlan().toString()
    assert [r.link for r in page_links(pages).collect()] == ["a", "b"]


def test_enum_and_set_merge():
    assert merge_types(EnumType(["a", "b"]), EnumType(["b", "c"])) == EnumType(["a", "b", "c"])
    assert to_spark(merge_types(SetType(IntegerType()), SetType(IntegerType()))).simpleString() == "array<int>"
    assert isinstance(merge_types(EnumType(["a"]), IntegerType()), ChoiceType)


def test_catalog_insert_by_name(spark):
    spark.sql("DROP TABLE IF EXISTS ff_probe_ab")
    write_to_catalog(Frame(spark.sql("SELECT 1 AS a, 2 AS b"), "x"), table_name="ff_probe_ab")
    write_to_catalog(Frame(spark.sql("SELECT 20 AS b, 10 AS a"), "x"), table_name="ff_probe_ab")
    assert sorted((r.a, r.b) for r in spark.table("ff_probe_ab").collect()) == [(1, 2), (10, 20)]
    with pytest.raises(ValueError):
        write_to_catalog(Frame(spark.sql("SELECT 1 AS a"), "x"), table_name="ff_probe_ab")


ON = {"job-bookmark-option": "job-bookmark-enable"}


def test_bookmarks_keep_partition_columns_and_see_overwrites(spark, tmp_path):
    import time

    data = str(tmp_path / "d")
    spark.sql("SELECT 1 AS a, 'x' AS dt").write.partitionBy("dt").parquet(data)
    job = Job(spark, str(tmp_path / "ledger"))
    read = lambda: from_options(spark, "file", {"paths": [data]}, format="parquet", transformation_ctx="c").toDF()
    job.init("j", ON)
    assert [tuple(r) for r in read().collect()] == [(1, "x")]
    job.commit()
    assert read().count() == 1  # no job is active any more: whole reads
    job.init("j", {"--continuation-option": "continuation-enabled"})
    assert read().columns == ["a", "dt"] and read().count() == 0
    job.commit()
    time.sleep(1.1)
    spark.sql("SELECT 5 AS a, 'x' AS dt").write.mode("overwrite").partitionBy("dt").parquet(data)
    job.init("j", ON)
    assert [tuple(r) for r in read().collect()] == [(5, "x")]
    job.commit()


def test_a_ledger_that_cannot_be_read_raises(spark, tmp_path):
    ledger = tmp_path / "ledger"
    ledger.mkdir()
    (ledger / "part-0.parquet").write_text("not parquet")
    with pytest.raises(Exception):  # noqa: B017
        Job(spark, str(ledger)).init("j", ON)


APPLICATION = """
import sys
sys.path.insert(0, {repo!r})
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").config("spark.checkpoint.dir", {shared!r}).getOrCreate()
from flexframe.sources.bookmark import Job
from flexframe.sources.readers import from_options
job = Job(spark).init("j", {{"job-bookmark-option": "job-bookmark-enable"}})
print("ROWS", job.run_id, from_options(spark, "file", {{"paths": [{data!r}]}}, format="parquet", transformation_ctx="c").count())
job.commit()
"""


def test_bookmarks_last_between_applications(spark, tmp_path):
    import os

    data, shared = str(tmp_path / "d"), str(tmp_path / "shared")
    spark.range(3).write.parquet(data)
    code = APPLICATION.format(repo=os.path.dirname(os.path.dirname(os.path.abspath(__file__))), shared=shared, data=data)
    told = [subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, timeout=240).stdout for _ in range(2)]
    assert "ROWS 1 3" in told[0] and "ROWS 2 0" in told[1]
