"""Several JSON values in one text or file, values over many lines and splits: nothing is lost."""

import json
import random
import re
from collections import Counter

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from flexframe import Frame
from flexframe.operators.choice import frame_from_json_text
from flexframe.schema import MapType, StructField, StructType, bounded, distinct_names, merge_types
from flexframe.sources.jsontext import Cutter, pieces, single
from flexframe.sources.readers import from_options

BITS = ['{"a":1}', '{"a":', "}", "{", "[", "]", ",", '"', '\\"', "\\", "x", " ", "\t", "1", "null", '{"s":"}{"}', '[{"a":2},3]', "é"]
texts = st.lists(st.sampled_from(BITS), max_size=14).map("".join)


def bare(text):
    return re.sub(r"\s", "", text)


@settings(max_examples=300, deadline=None)
@given(texts)
def test_pieces_hold_all_of_a_text(text):
    assert bare("".join(pieces(text))) == bare(text)


def test_several_values_in_one_text():
    assert pieces('{"a":1}{"a":2} x') == ['{"a":1}', '{"a":2}', "x"]
    assert pieces('{"s":"}{"} [1,{"b":2}] {"open":[1') == ['{"s":"}{"}', '[1,{"b":2}]', '{"open":[1']
    assert pieces('{"a":1}} {"b":2}') == ['{"a":1}', "}", '{"b":2}']


@settings(max_examples=60, deadline=None)
@given(st.lists(texts, min_size=1, max_size=40))
def test_single_agrees_with_the_cutter(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "t string")
    for r in df.select("t", F.to_json(single(F.col("t"))).alias("v")).collect():
        try:
            value, whole = json.loads(r.t), True
        except ValueError:
            whole = False
        assert (r.v is not None) == whole, r.t
        if whole:
            assert json.loads(r.v) == value


def read(spark, path, **options):
    return from_options(spark, "file", {"paths": [str(path)]}, format="json", format_options=options)


def shown(frame):
    return Counter(map(bare, frame.toDF().toJSON().collect())), Counter(bare(r.record) for r in frame.errorsAsFrame().toDF().collect())


def test_values_on_one_line(spark, tmp_path):
    (tmp_path / "x.json").write_text('{"a":1}{"a":2} x\n{"a":3} trailing\n[{"a":4}] [{"a":5}]\n{"a":6},{"a":7}\n{"a":8}\n')
    good, errors = shown(read(spark, tmp_path))
    assert good == Counter(f'{{"a":{i}}}' for i in range(1, 9))
    assert errors == Counter(["x", "trailing", ","])


def test_values_of_a_multiline_file(spark, tmp_path):
    (tmp_path / "x.json").write_text('{\n "a": 1\n}\n{"a":2} {"a":\n3}\nrest of it\n[\n{"a":4},\n{"a":5,\n"b":"]"}, 6 ]\n{"a":7\n')
    good, errors = shown(read(spark, tmp_path, multiline=True))
    assert good == Counter(['{"a":1}', '{"a":2}', '{"a":3}', '{"a":4}', '{"a":5,"b":"]"}'])
    assert errors == Counter(["restofit", "6", '{"a":7'])


def document(draw, size):
    """A file of values, pretty-printed or not, arrays of values, and rubbish between them."""
    def value(depth):
        kind = draw.randint(0, 5 if depth < 3 else 3)
        if kind == 4:
            return {f"k{i}": value(depth + 1) for i in range(draw.randint(0, 3))}
        if kind == 5:
            return [value(depth + 1) for _ in range(draw.randint(0, 3))]
        return draw.choice([1, "a{b", 'c"]}', None, True, "\\", "é\n"])

    def record():
        return {"id": draw.randint(0, 99), "v": value(0)}

    out = []
    for _ in range(size):
        kind = draw.randint(0, 6)
        if kind < 4:
            out.append(json.dumps(record(), indent=draw.choice([None, 1, 2])))
        elif kind == 4:
            out.append(json.dumps([record() for _ in range(draw.randint(1, 6))], indent=draw.choice([None, 2])))
        elif kind == 5:
            out.append(draw.choice(["rubbish", "}", "]", '"open', "1 2", ","]))
        else:
            out.append("")
    if draw.random() < 0.3:
        out.append('{"never": [1,\n{"closed": 2},\n3')
    return draw.choice(["\n", " ", "\n\n"]).join(out) if draw.random() < 0.7 else "\n".join(out)


@pytest.mark.parametrize("seed", range(4))
def test_splits_of_a_file_do_not_matter(spark, tmp_path, seed):
    draw = random.Random(seed)
    files = [document(draw, 30) for _ in range(3)]
    for i, text in enumerate(files):
        (tmp_path / f"{i}.json").write_text(text)
    want = Counter()
    ends = []
    for text in files:
        cutter = Cutter()
        for line in text.split("\n"):
            cutter.line(line)
        want.update(bare(v) for v, _ in cutter.take())
        ends.append(bare("".join(cutter.held)))
    from flexframe.sources.jsontext import values_of_files

    held = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        spark.conf.set("spark.sql.files.openCostInBytes", "1")
        for size in ("37", "150", "100000"):
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)
            found = Counter(bare(r.value) for r in values_of_files(spark.read.text(str(tmp_path))).collect())
            # the parts of a value that is never closed stand for themselves
            assert not want - found
            assert bare("".join(sorted((found - want).elements()))) == "" or sorted("".join((found - want).elements())) == sorted("".join(ends))
    finally:
        for k, v in held.items():
            spark.conf.set(k, v)


def test_names_that_differ_by_case(spark):
    raw = spark.createDataFrame([('{"a":1,"A":"x","s":{"k":1,"K":2}}',), ('{"A":"y","a_2":true}',)], "value string")
    f = frame_from_json_text(raw, "value")
    # a variant has its names in order of bytes
    rows = [r.asDict(True) for r in f.toDF().select("A", "a_3", "a_2", "s.K", "s.k_2").collect()]
    assert {"A": "x", "a_3": 1, "a_2": None, "K": 2, "k_2": 1} in rows and {"A": "y", "a_3": None, "a_2": True, "K": None, "k_2": None} in rows
    assert distinct_names(["a", "A", "a", "A_2"]) == ["a", "A_3", "a_4", "A_2"]


def test_ids_as_names_make_one_map(spark):
    rows = [(json.dumps({"k": i, "by": {f"id{i}": {"n": i}, f"x{i}": {"n": "t"}}}),) for i in range(3000)]
    f = frame_from_json_text(spark.createDataFrame(rows, "value string").repartition(5), "value", most=100)
    assert f.toDF().schema["by"].dataType.simpleString() == "map<string,struct<n:struct<long:bigint,string:string>>>"
    got = {r.k: r.by for r in f.toDF().collect()}
    assert len(got) == 3000 and got[7]["id7"].n.long == 7 and got[7]["x7"].n.string == "t"
    whole = frame_from_json_text(spark.createDataFrame([(json.dumps({f"i{i}": i}),) for i in range(300)], "value string"), "value", most=100)
    assert whole.toDF().columns == ["entries"] and whole.toDF().selectExpr("sum(aggregate(map_values(entries), 0L, (a, x) -> a + x)) AS s").first().s == 44850


def test_bounding_does_not_depend_on_the_order():
    from pyspark.sql.types import LongType, StringType

    def object_of(*names):
        return StructType([StructField(n, LongType() if n[0] == "l" else StringType()) for n in names])

    shapes = [object_of("l1", "s1"), object_of("l2"), object_of("s2", "l3"), object_of("l1")]
    for seed in range(6):
        random.Random(seed).shuffle(shapes)
        merged = None
        for s in shapes:
            merged = bounded(merge_types(merged, s), 4)
        assert isinstance(merged, MapType) and sorted(merged.valueType.names()) == ["long", "string"]


def test_unbox_takes_one_value_only(spark):
    df = spark.createDataFrame([(1, '{"a":1}'), (2, '{"a":1} x'), (3, '{"a":1}{"a":2}'), (4, None)], "k int, box string")
    f = Frame(df, "f").unbox("box", "json")
    assert sorted(r.k for r in f.toDF().collect()) == [1, 4] and f.errorsCount() == 2
