from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql.types import ArrayType, BooleanType, DoubleType, LongType, NullType, StringType, StructField, StructType

from flexframe.schema import ChoiceType, choice_paths, dumps, loads, merge_types, read_variant_type, to_spark, type_name

atoms = st.sampled_from([LongType(), StringType(), DoubleType(), BooleanType(), NullType()])


def types(depth=2):
    if depth == 0:
        return atoms
    inner = types(depth - 1)
    return st.one_of(
        atoms,
        st.builds(lambda t: ArrayType(t, True), inner),
        st.lists(st.tuples(st.sampled_from(["a", "b", "c"]), inner), max_size=3, unique_by=lambda x: x[0]).map(
            lambda fs: StructType([StructField(n, t, True) for n, t in fs])),
    )


def names(t):
    if isinstance(t, ChoiceType):
        return sorted(t.alternatives)
    return [type_name(t)]


@settings(max_examples=150, deadline=None)
@given(types())
def test_merge_idempotent(t):
    assert merge_types(t, t) == t


@settings(max_examples=150, deadline=None)
@given(types())
def test_null_and_unknown_are_identity(t):
    assert merge_types(t, NullType()) == t
    assert merge_types(NullType(), t) == t
    assert merge_types(None, t) == t


@settings(max_examples=150, deadline=None)
@given(types(), types())
def test_same_type_names_either_order(a, b):
    assert names(merge_types(a, b)) == names(merge_types(b, a))


def test_no_numeric_widening():
    m = merge_types(LongType(), DoubleType())
    assert isinstance(m, ChoiceType) and m.names() == ["long", "double"]


def test_struct_order_and_nested_merge():
    a = StructType([StructField("x", LongType()), StructField("s", StructType([StructField("p", LongType())]))])
    b = StructType([StructField("y", StringType()), StructField("s", StructType([StructField("q", StringType())]))])
    m = merge_types(a, b)
    assert [f.name for f in m.fields] == ["x", "s", "y"]
    assert [f.name for f in m["s"].dataType.fields] == ["p", "q"]


def test_choice_merge_is_pure():
    c1 = ChoiceType([LongType(), StringType()])
    c2 = ChoiceType([StringType(), DoubleType()])
    m = merge_types(c1, c2)
    assert m.names() == ["long", "string", "double"]
    assert c1.names() == ["long", "string"] and c2.names() == ["string", "double"]


def test_choice_rejects_duplicates():
    import pytest

    with pytest.raises(ValueError):
        ChoiceType([LongType(), LongType()])


def test_variant_type_strings_and_json_roundtrip():
    t = read_variant_type("OBJECT<a: BIGINT, `a.b`: DECIMAL(3,2), c: ARRAY<OBJECT<k: STRING>>, d: OBJECT<>, e: VOID>")
    assert [f.name for f in t.fields] == ["a", "a.b", "c", "d", "e"]
    assert t["a.b"].dataType == DoubleType()
    assert loads(dumps(t)) == t
    m = merge_types(t, read_variant_type("OBJECT<a: STRING>"))
    assert choice_paths(m) == {"a": ["long", "string"]}
    assert to_spark(m)["a"].dataType.simpleString() == "struct<long:bigint,string:string>"
