"""What doesn't fit a schema, a key or a csv header is told, never dropped."""

import pytest
from pyspark.sql import functions as F

from flexframe import Frame


def errors(frame):
    return sorted((r.op, r.record) for r in frame.errorsAsFrame().toDF().collect())


def test_frame_schema_tells_of_values_that_do_not_fit(spark):
    df = spark.sql("""SELECT * FROM VALUES
        ('1', named_struct('n', '5', 'm', 1), array('1', '2')), ('zz', named_struct('n', '5', 'm', 1), array('1')),
        ('2', named_struct('n', 'x', 'm', 1), null), ('3', null, array('1', 'q')), (null, named_struct('n', null, 'm', 2), array()) AS t(x, s, a)""")
    f = Frame(df, "f").with_frame_schema("X int, s struct<N:int>, a array<long>, more string")
    assert sorted((r.X if r.X is not None else -1, r.s.N if r.s else None, r.a) for r in f.toDF().collect()) == [(-1, None, []), (1, 5, [1, 2])]
    assert f.toDF().columns == ["X", "s", "a", "more"] and f.errorsCount() == 3
    assert Frame(df, "f").with_frame_schema("x string").errorsCount() == 0


def test_partition_functions_tell_of_misfits(spark):
    def run(records):
        for r in records:
            i = r["id"]
            if i % 4 == 0:
                yield {"id": i}
            elif i % 4 == 1:
                yield {"id": f"no number {i}"}
            elif i % 4 == 2:
                yield {"id": i, "extra": 1}
            else:
                yield {"isError": True, "errorMessage": f"bad {i}", "record": dict(r)}

    f = Frame(spark.range(40).repartition(3), "f").mapPartitions(run)
    assert sorted(r.id for r in f.toDF().collect()) == list(range(0, 40, 4))
    told = f.errorsAsFrame().toDF().collect()
    assert len(told) == 30 and f.stageErrorsCount() == 30
    assert {(r.message, r.record) for r in told if r.message.startswith("bad")} == {(f"bad {i}", f'{{"id": {i}}}') for i in range(3, 40, 4)}
    assert sum(r.message.startswith("fields not in") for r in told) == 10


def boxed(spark, *texts):
    return Frame(spark.createDataFrame(list(enumerate(texts)), "k int, box string"), "f")


def test_boxed_csv_is_read_as_rfc_4180_has_it(spark):
    f = boxed(spark, '"x,y",z\n"1\n2","3 ""q"""', 'z,"x,y"\r\n4,\r\n', 'z\n""').unbox("box", "csv", withHeader=True)
    rows = {r.k: r.box.asDict() for r in f.toDF().collect()}
    assert rows == {0: {"x,y": "1\n2", "z": '3 "q"'}, 1: {"x,y": None, "z": "4"}, 2: {"x,y": None, "z": ""}} and f.errorsCount() == 0


def test_boxed_csv_never_aborts(spark):
    many = boxed(spark, "a\nb", "1,2\n3,4", None).unbox("box", "csv")
    assert [r.k for r in many.toDF().collect()] == [2] and many.errorsCount() == 2
    plain = boxed(spark, "1,2", "3", "4,5,6", '"open,1', None).unbox("box", "csv")
    assert sorted(r.k for r in plain.toDF().collect()) == [2, 4] and plain.errorsCount() == 3
    typed = boxed(spark, "1|x", "q|x", "2", "3|y|z").unbox("box", "csv", separator="|", withSchema="n int, s string")
    assert [tuple(r.box) for r in typed.toDF().collect()] == [(1, "x")] and typed.errorsCount() == 3
    twice = boxed(spark, "a,a\n1,2", "a,A\n1,2").unbox("box", "csv", withHeader=True)
    assert [tuple(r.box) for r in twice.toDF().collect()] == [("1", "2")] and twice.toDF().schema["box"].dataType.names == ["a", "A_2"]


def test_boxed_csv_without_real_headers_makes_a_map(spark):
    df = spark.range(1500).selectExpr("int(id) AS k", "concat('h', id, '\n', id) AS box")
    f = Frame(df, "f").unbox("box", "csv", withHeader=True)
    assert f.toDF().schema["box"].dataType.simpleString() == "map<string,string>"
    assert f.toDF().where("k = 7").first().box == {"h7": "7"}


def test_unnest_keeps_clashing_names_apart(spark):
    df = spark.sql("SELECT 1 AS `a.b`, named_struct('b', 2) AS a")
    f = Frame(df, "f").unnest()
    assert f.toDF().columns == ["a.b", "a.b_2"] and tuple(f.toDF().first()) == (1, 2)


def test_relationalize_refuses_a_key_that_two_rows_share(spark):
    df = spark.createDataFrame([(1, ["a"]), (1, ["b"])], "k int, xs array<string>")
    with pytest.raises(ValueError, match="more than once"):
        Frame(df, "t").relationalize("r", options={"key": ["k"]})
    assert Frame(df, "t").relationalize("r", options={"key": ["k"], "unique": True})["r_xs"].count() == 2


def test_split_rows_refuses_an_unknown_path(spark):
    with pytest.raises(KeyError):
        Frame(spark.range(2), "f").split_rows({"nope": {">": 1}}, "a", "b")
    assert Frame(spark.range(2), "f").split_rows({"id": {">": 0}}, "a", "b")["a"].toDF().agg(F.count("*")).first()[0] == 1
