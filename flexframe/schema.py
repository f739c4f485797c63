"""Type names, the schema-merge rule for drifting data, and choice types.

Spark has no type for "this field is a long in some records and a string in
others". We keep such a field as a *choice*: during merging it is a
``ChoiceType`` (a Python-side description), and in a DataFrame it is a struct
with one nullable field per alternative, named by the alternative's type name,
e.g. ``struct<long:bigint,string:string>``. ``Frame.choices`` remembers which
paths are choices, since column metadata does not survive computed columns.
"""

from __future__ import annotations

import json
import re

from pyspark.sql.types import (
    ArrayType,
    BinaryType,
    BooleanType,
    ByteType,
    DataType,
    DateType,
    DecimalType,
    DoubleType,
    FloatType,
    IntegerType,
    LongType,
    MapType,
    NullType,
    ShortType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
    TimestampType,
    VariantType,
)


class ChoiceType(DataType):
    """Several alternative types for one field, one per type name."""

    def __init__(self, alternatives: list[DataType] | None = None):
        self.alternatives: dict[str, DataType] = {}
        for t in alternatives or []:
            self.add(t)

    def add(self, t: DataType) -> None:
        name = type_name(t)
        if name in self.alternatives:
            raise ValueError(f"choice already has an alternative of type {name}")
        self.alternatives[name] = t

    def names(self) -> list[str]:
        return list(self.alternatives)

    def __eq__(self, other):
        return isinstance(other, ChoiceType) and self.alternatives == other.alternatives

    def __hash__(self):
        return hash(repr(self))

    def simpleString(self):
        return repr(self)

    def __repr__(self):
        return "choice<" + ",".join(f"{k}:{v.simpleString() if isinstance(v, DataType) else v!r}" for k, v in self.alternatives.items()) + ">"


class MixedType(DataType):
    """Placeholder for values that a variant scan described only as VARIANT."""

    def __eq__(self, other):
        return isinstance(other, MixedType)

    def __repr__(self):
        return "mixed"

    def simpleString(self):
        return "mixed"

    def __hash__(self):
        return hash("mixed")


# The type names used for choice alternatives and mapping targets.
_NAMES = {
    BinaryType: "binary",
    BooleanType: "boolean",
    ByteType: "byte",
    ShortType: "short",
    IntegerType: "int",
    LongType: "long",
    FloatType: "float",
    DoubleType: "double",
    DecimalType: "decimal",
    StringType: "string",
    DateType: "date",
    TimestampType: "timestamp",
    TimestampNTZType: "timestamp",
    NullType: "null",
    ArrayType: "array",
    MapType: "map",
    StructType: "struct",
    VariantType: "variant",
}

#: Variant types of whole numbers that don't fit a long.
WHOLE_DECIMAL = r"^DECIMAL\((19|[23][0-9]),0\)$"

_FROM_NAME = {
    "binary": BinaryType(),
    "boolean": BooleanType(),
    "byte": ByteType(),
    "short": ShortType(),
    "int": IntegerType(),
    "integer": IntegerType(),
    "long": LongType(),
    "bigint": LongType(),
    "float": FloatType(),
    "double": DoubleType(),
    "decimal": DecimalType(10, 2),
    "string": StringType(),
    "date": DateType(),
    "timestamp": TimestampType(),
    "null": NullType(),
}


def type_name(t) -> str:
    if isinstance(t, ChoiceType):
        return "choice"
    if isinstance(t, MixedType):
        return "mixed"
    if isinstance(t, (EnumType, SetType)):
        return "enum" if isinstance(t, EnumType) else "set"
    for cls, name in _NAMES.items():
        if type(t) is cls:
            return name
    return t.typeName()


def parse_type(spec) -> DataType:
    """A short type name (``int``, ``long``, ``decimal``...) or any Spark DDL type."""
    if isinstance(spec, DataType):
        return spec
    key = str(spec).strip().lower()
    if key in _FROM_NAME:
        return _FROM_NAME[key]
    from pyspark.sql.types import _parse_datatype_string

    return _parse_datatype_string(spec)


def merge_types(a, b):
    """Merge two observed types; never widens numbers, conflicting kinds become a choice."""
    kinds = {}  # by kind, in the order met: what a and b allow, each merged with its like
    for t in (a, b):
        for one in _alternatives(t):
            kind = type_name(one)
            kinds[kind] = _joined(kinds[kind], one) if kind in kinds else one
    if not kinds:
        return b if a is None else a
    plain = not any(isinstance(t, ChoiceType) for t in (a, b))
    if "mixed" in kinds and plain:
        return MixedType()  # what stands beside it is seen by the pass over the elements
    if len(kinds) == 1 and plain:
        return next(iter(kinds.values()))
    out = ChoiceType()
    out.alternatives.update(kinds)
    return out


def _alternatives(t) -> list:
    """The types a value may have: none for the null type, several for a choice."""
    if t is None or isinstance(t, NullType):
        return []
    return list(t.alternatives.values()) if isinstance(t, ChoiceType) else [t]


#: How two types of one kind become one; kinds that aren't here keep the first.
_JOIN = {
    "struct": lambda a, b: _struct([StructField(n, t, True) for n, t in _merged_fields(a, b).items()]),
    "array": lambda a, b: _array(merge_types(a.elementType, b.elementType)),
    "map": lambda a, b: _map(merge_types(a.valueType, b.valueType)),
    "enum": lambda a, b: EnumType([*a.options, *(x for x in b.options if x not in a.options)]),
    "set": lambda a, b: SetType(merge_types(a.item, b.item)),
}


def _joined(a, b):
    join = _JOIN.get(type_name(a))
    return join(a, b) if join else a


def _merged_fields(a: StructType, b: StructType) -> dict:
    """Fields in the order first seen."""
    out = {f.name: f.dataType for f in a.fields}
    out.update({f.name: merge_types(out.get(f.name), f.dataType) for f in b.fields})
    return out


class EnumType:
    """A text that is one of some options; merging two joins the options. Stored as a string."""

    def __init__(self, options: list[str]):
        self.options = list(options)

    def __eq__(self, other):
        return isinstance(other, EnumType) and self.options == other.options


class SetType:
    """Distinct items of one type. Stored as an array."""

    def __init__(self, item):
        self.item = item

    def __eq__(self, other):
        return isinstance(other, SetType) and self.item == other.item


def _has_special(t) -> bool:
    if isinstance(t, (ChoiceType, MixedType)):
        return True
    if isinstance(t, StructType):
        return any(_has_special(f.dataType) for f in t.fields)
    if isinstance(t, ArrayType):
        return _has_special(t.elementType)
    if isinstance(t, MapType):
        return _has_special(t.valueType)
    return False


def _struct(fields):
    return StructType(fields)


def _array(element):
    return ArrayType(element, True)


def _map(value):
    return MapType(StringType(), value, True)


def merge_schemas(a, b):
    return merge_types(a, b)


#: Objects met with more field names than this at one path are maps, not structs.
MOST_FIELDS = 1000


def bounded(t, most: int = MOST_FIELDS):
    """``t`` with every struct of more than ``most`` fields turned into a map of their merged types.

    A map and a struct at one path become one map, so the result doesn't
    depend on the order in which records are met: it is a map just where all
    records together have more than ``most`` names.
    """
    if isinstance(t, StructType):
        fields = [(f.name, bounded(f.dataType, most)) for f in t.fields]
        if len(fields) <= most:
            return _struct([StructField(n, x, True) for n, x in fields])
        return _keyed([x for _, x in fields], most)
    if isinstance(t, ArrayType):
        return _array(bounded(t.elementType, most))
    if isinstance(t, MapType):
        return _map(bounded(t.valueType, most))
    if isinstance(t, ChoiceType):
        alternatives = {n: bounded(x, most) for n, x in t.alternatives.items()}
        found = [x for x in alternatives.values() if isinstance(x, (MapType, StructType))]
        if any(isinstance(x, MapType) for x in found):
            values = [v for x in found for v in ([x.valueType] if isinstance(x, MapType) else [f.dataType for f in x.fields])]
            rest = [x for x in alternatives.values() if x not in found]
            keyed = _keyed(values, most)
            return ChoiceType([*rest, keyed]) if rest else keyed
        out = ChoiceType()
        out.alternatives.update(alternatives)
        return out
    return t


def _keyed(values: list, most: int) -> MapType:
    merged = None
    for v in values:
        merged = merge_types(merged, v)
    return _map(NullType() if merged is None else bounded(merged, most))


def distinct_names(names: list[str]) -> list[str]:
    """The names, each apart from the others without regard to case: later ones get ``_2``, ``_3``, ..."""
    taken, out = {n.lower() for n in names}, []
    met = set()
    for n in names:
        own, k = n, 1
        if n.lower() in met:
            while own.lower() in taken:
                k += 1
                own = f"{n}_{k}"
            taken.add(own.lower())
        met.add(own.lower())
        out.append(own)
    return out


def with_distinct_names(t):
    """``t`` with the field names that ``distinct_names`` gives."""
    if isinstance(t, StructType):
        names = distinct_names(t.names)
        return _struct([StructField(n, with_distinct_names(f.dataType), True) for n, f in zip(names, t.fields)])
    if isinstance(t, ArrayType):
        return _array(with_distinct_names(t.elementType))
    if isinstance(t, MapType):
        return _map(with_distinct_names(t.valueType))
    if isinstance(t, ChoiceType):
        out = ChoiceType()
        out.alternatives.update({n: with_distinct_names(x) for n, x in t.alternatives.items()})
        return out
    return t


def to_spark(t) -> DataType:
    """Physical Spark type: a choice becomes a struct of its alternatives."""
    if isinstance(t, ChoiceType):
        return StructType([StructField(n, to_spark(v), True) for n, v in t.alternatives.items()])
    if isinstance(t, (MixedType, EnumType)):
        return StringType()
    if isinstance(t, SetType):
        return ArrayType(to_spark(t.item), True)
    if isinstance(t, StructType):
        return StructType([StructField(f.name, to_spark(f.dataType), True) for f in t.fields])
    if isinstance(t, ArrayType):
        return ArrayType(to_spark(t.elementType), True)
    if isinstance(t, MapType):
        return MapType(StringType(), to_spark(t.valueType), True)
    return t


def choice_paths(t, prefix: str = "") -> dict[str, list[str]]:
    """``{path: [alternative names]}`` for every choice inside ``t``."""
    out: dict[str, list[str]] = {}
    if isinstance(t, ChoiceType):
        out[prefix] = t.names()
        for name, alt in t.alternatives.items():
            # physically a choice is a struct with one field per alternative
            out.update(choice_paths(alt, f"{prefix}.{name}" if prefix else name))
        return out
    if isinstance(t, StructType):
        from .paths import quote

        for f in t.fields:
            p = f"{prefix}.{quote(f.name)}" if prefix else quote(f.name)
            out.update(choice_paths(f.dataType, p))
    elif isinstance(t, ArrayType):
        out.update(choice_paths(t.elementType, prefix))
    return out  # a path names no place in a map; choices there stay structs


# ---------------------------------------------------------------------------
# JSON form (for passing merged types between tasks and the driver)


def to_json_value(t):
    if isinstance(t, ChoiceType):
        return {"type": "choice", "alternatives": [to_json_value(v) for v in t.alternatives.values()]}
    if isinstance(t, MixedType):
        return {"type": "mixed"}
    if isinstance(t, StructType):
        return {"type": "struct", "fields": [{"name": f.name, "type": to_json_value(f.dataType)} for f in t.fields]}
    if isinstance(t, ArrayType):
        return {"type": "array", "element": to_json_value(t.elementType)}
    if isinstance(t, MapType):
        return {"type": "map", "value": to_json_value(t.valueType)}
    return {"type": "atomic", "ddl": t.simpleString()}


def from_json_value(v):
    kind = v["type"]
    if kind == "choice":
        return ChoiceType([from_json_value(a) for a in v["alternatives"]])
    if kind == "mixed":
        return MixedType()
    if kind == "struct":
        return _struct([StructField(f["name"], from_json_value(f["type"]), True) for f in v["fields"]])
    if kind == "array":
        return _array(from_json_value(v["element"]))
    if kind == "map":
        return _map(from_json_value(v["value"]))
    return _atomic_from_simple(v["ddl"])


def _atomic_from_simple(s: str) -> DataType:
    s = s.lower()
    if s.startswith("decimal"):
        inner = s[s.index("(") + 1 : s.index(")")]
        p, sc = (int(x) for x in inner.split(","))
        return DecimalType(p, sc)
    return {
        "binary": BinaryType(), "boolean": BooleanType(), "tinyint": ByteType(), "smallint": ShortType(),
        "int": IntegerType(), "bigint": LongType(), "float": FloatType(), "double": DoubleType(),
        "string": StringType(), "date": DateType(), "timestamp": TimestampType(),
        "timestamp_ntz": TimestampNTZType(), "void": NullType(), "variant": VariantType(),
    }[s]


def dumps(t) -> str:
    return json.dumps(to_json_value(t), sort_keys=True)


def loads(s: str):
    return from_json_value(json.loads(s))


# ---------------------------------------------------------------------------
# Reading the type strings produced by ``schema_of_variant``.
# Grammar: OBJECT<name: T, ...> | ARRAY<T> | DECIMAL(p,s) | scalar word.


def read_variant_type(text: str):
    """Turn ``OBJECT<a: BIGINT, b: ARRAY<STRING>>`` into our merge types."""
    pos = 0

    def skip():
        nonlocal pos
        while pos < len(text) and text[pos] == " ":
            pos += 1

    def word():
        nonlocal pos
        start = pos
        while pos < len(text) and (text[pos].isalnum() or text[pos] == "_"):
            pos += 1
        return text[start:pos]

    def name():
        nonlocal pos
        skip()
        if text[pos] == "`":
            pos += 1
            out = []
            while True:
                if text[pos] == "`":
                    if pos + 1 < len(text) and text[pos + 1] == "`":
                        out.append("`")
                        pos += 2
                        continue
                    pos += 1
                    break
                out.append(text[pos])
                pos += 1
            return "".join(out)
        start = pos
        while text[pos] != ":":
            pos += 1
        return text[start:pos].strip()

    def typ():
        nonlocal pos
        skip()
        w = word().upper()
        if w == "OBJECT":
            assert text[pos] == "<"
            pos += 1
            fields = []
            skip()
            if text[pos] == ">":
                pos += 1
                return StructType([])
            while True:
                n = name()
                skip()
                assert text[pos] == ":"
                pos += 1
                fields.append(StructField(n, typ(), True))
                skip()
                if text[pos] == ",":
                    pos += 1
                    continue
                assert text[pos] == ">"
                pos += 1
                return _struct(fields)
        if w == "ARRAY":
            assert text[pos] == "<"
            pos += 1
            el = typ()
            skip()
            assert text[pos] == ">"
            pos += 1
            return _array(el)
        if w == "DECIMAL":
            shape = ""
            if pos < len(text) and text[pos] == "(":
                end = text.index(")", pos) + 1
                shape, pos = text[pos:end], end
            return DecimalType(38, 0) if re.match(WHOLE_DECIMAL, w + shape) else DoubleType()
        return {
            "BIGINT": LongType(), "INT": LongType(), "SMALLINT": LongType(), "TINYINT": LongType(),
            "DOUBLE": DoubleType(), "FLOAT": DoubleType(), "STRING": StringType(),
            "BOOLEAN": BooleanType(), "VOID": NullType(), "DATE": DateType(),
            "TIMESTAMP": TimestampType(), "TIMESTAMP_NTZ": TimestampNTZType(),
            "BINARY": BinaryType(), "VARIANT": MixedType(),
        }[w]

    result = typ()
    return result


def fold_variant_types(texts) -> object:
    out = None
    for t in texts:
        if t is None:
            continue
        out = merge_types(out, read_variant_type(t))
    return out
