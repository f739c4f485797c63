"""apply_mapping: declarative projection + rename + cast in one select.

Mappings are tuples:
  (source, target)                          keep the type
  (source, target, target_type)
  (source, source_type, target, target_type)
Source paths resolve case-insensitively unless ``case_sensitive``. Targets may
be nested paths; they are built with ``struct``; two targets of which one is or
lies below the other raise. Columns that are not mapped are dropped.

A source inside an array of structs gives an array. As many last segments of
the target as the source has below the array name the place in the elements,
so fields of one array that go below one target stay together in its elements.

A choice is mapped by the alternative that ``source_type`` names, or, without
one, by whichever alternative casts to the target type.

A value that fails its cast makes the row an error record (``try_cast`` + a
null check, so the job never aborts under ANSI mode); casts that can't fail
are not checked.
"""

from __future__ import annotations

from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, ByteType, DataType, DoubleType, FloatType, IntegerType, LongType, MapType, NullType, ShortType, StringType, StructType

from ..errors import ErrorStage, error_rows
from ..frame import Frame
from ..paths import get_path, quote, resolve, split_path, top
from ..functions.casts import safe_cast
from ..schema import parse_type, type_name

_ERR = "__ff_err"
#: Where each argument of a mapping stands, by its length: source, source type, target, target type.
_PLACES = {2: (0, None, 1, None), 3: (0, None, 1, 2), 4: (0, 1, 2, 3)}
_WIDTH = {ByteType: 1, ShortType: 2, IntegerType: 3, LongType: 4}


class Mapping(NamedTuple):
    source: str
    source_type: str | None
    target: str
    target_type: str | None


class Mapped(NamedTuple):
    """A value below a target; inside an array ``value`` and ``failed`` take the element."""

    target: list[str]
    value: Column
    failed: Column | None
    message: str


def _normalize(m) -> Mapping:
    if not isinstance(m, tuple) or len(m) not in _PLACES:
        kind = TypeError if not isinstance(m, tuple) else ValueError
        raise kind(f"a mapping is a tuple of 2, 3 or 4 values, not {m!r}")
    return Mapping(*(None if at is None else m[at] for at in _PLACES[len(m)]))


def _lossless(source: DataType, target: DataType) -> bool:
    """Casts that give a value for every value."""
    if isinstance(target, StringType):
        return not isinstance(source, (StructType, ArrayType))
    if type(source) in _WIDTH:
        return isinstance(target, (FloatType, DoubleType)) or _WIDTH.get(type(target), 0) >= _WIDTH[type(source)]
    return isinstance(source, FloatType) and isinstance(target, DoubleType)


def _nest(targets: list[tuple[list[str], Column]]) -> list[Column]:
    """Group target paths by their first segment into nested structs, in order."""
    groups: dict[str, list] = {}
    for parts, col in targets:
        groups.setdefault(parts[0], []).append((parts[1:], col))
    return [(items[0][1] if not items[0][0] else F.struct(*_nest(items))).alias(head) for head, items in groups.items()]


def _check_targets(targets: list[list[str]]) -> None:
    taken = set()
    for parts in targets:
        taken.add(tuple(parts))
    if len(taken) < len(targets):
        twice = next(t for t in taken if targets.count(list(t)) > 1)
        raise ValueError(f"target {'.'.join(twice)} is mapped twice")
    for parts in targets:
        for n in range(1, len(parts)):
            if tuple(parts[:n]) in taken:
                raise ValueError(f"target {'.'.join(parts)} lies below the target {'.'.join(parts[:n])}")


def _below(schema: StructType, parts: list[str]) -> int | None:
    """How many leading segments of a path name its array, if it goes through one."""
    dtype: DataType = schema
    for i, name in enumerate(parts):
        if isinstance(dtype, ArrayType):
            return i
        dtype = dtype[name].dataType
    return None


def _typed(value: Column, dtype: DataType, m: Mapping, is_choice: bool) -> tuple[Column, Column | None]:
    """The value under the target type, and whether it was lost."""
    if m.target_type is None:
        return value, None
    target = parse_type(m.target_type)
    if is_choice:
        from .choice import _cast

        name = type_name(parse_type(m.source_type)) if m.source_type else None
        if name in dtype.names:
            value, dtype = value.getField(name), dtype[name].dataType
        else:
            cast = _cast(value, dtype, target)
            return cast, value.isNotNull() & cast.isNull()
    if target == dtype:
        return value, None
    cast = safe_cast(value, target, dtype)
    return cast, None if _lossless(dtype, target) else value.isNotNull() & cast.isNull()


def mapping_columns(frame: Frame, mappings, case_sensitive=False) -> list[Mapped]:
    """What each mapping gives; sources that aren't there are passed over."""
    schema = frame.df.schema
    out: list[Mapped] = []
    arrays: dict[tuple, list] = {}
    for m in map(_normalize, [mappings] if isinstance(mappings, tuple) else mappings):
        found = resolve(schema, split_path(m.source), case_sensitive)
        if found is None:
            continue
        parts, dtype, depth = found
        target = split_path(m.target)
        message = f"cannot cast {m.source} from {dtype.simpleString()} to {m.target_type}"
        is_choice = any(split_path(p) == parts for p in frame.choices) and isinstance(dtype, StructType)
        inner = _below(schema, parts)
        if inner is None:
            out.append(Mapped(target, *_typed(get_path(parts), dtype, m, is_choice), message))
            continue
        if depth > 1:
            raise NotImplementedError(f"a source inside arrays of arrays can't be mapped: {m.source}")
        rest = parts[inner:]
        cut = max(1, len(target) - len(rest))
        whole = len(target) <= len(rest)  # the target is the array of the values themselves
        place = (tuple(parts[:inner]), tuple(target if whole else target[:cut]))
        if place not in arrays:
            arrays[place] = []
            out.append(Mapped(list(place[1]), place, None, ""))  # filled below, at its first place
        arrays[place].append((rest, [] if whole else target[cut:], dtype, m, is_choice, message))
    return [_array_of(x.value, arrays[x.value]) if isinstance(x.value, tuple) else x for x in out]


def _array_of(place: tuple, fields: list) -> Mapped:
    source, target = place
    array = get_path(list(source))

    def of(element, rest):
        return reduce(lambda e, name: e.getField(name), rest, element)

    def built(element):
        values = [(names, _typed(of(element, rest), dtype, m, choice)[0]) for rest, names, dtype, m, choice, _ in fields]
        if not values[0][0]:
            return values[0][1]
        return F.when(element.isNotNull(), F.struct(*_nest(values)))

    if len(fields) > 1 and any(not names for _, names, *_ in fields):
        raise ValueError(f"target {'.'.join(target)} is mapped twice")
    _check_targets([names for _, names, *_ in fields if names])

    def lost(element):
        checks = [_typed(of(element, rest), dtype, m, choice)[1] for rest, _, dtype, m, choice, _ in fields]
        return reduce(lambda a, b: a | b, [F.coalesce(c, F.lit(False)) for c in checks if c is not None], F.lit(False))

    probe = [x for rest, _, dtype, m, choice, x in fields if _typed(F.lit(None), dtype, m, False)[1] is not None or choice]
    failed = F.exists(array, lost) if probe else None
    return Mapped(list(target), F.transform(array, built), failed, "; ".join(probe))


def apply_mapping(frame: Frame, mappings, case_sensitive=False, ctx="", info="", stage=0, total=0) -> Frame:
    cols = mapping_columns(frame, mappings, case_sensitive)
    _check_targets([c.target for c in cols])
    targets = [(c.target, c.value) for c in cols]
    new_choices = {}
    for m in map(_normalize, [mappings] if isinstance(mappings, tuple) else mappings):
        if m.target_type is None and m.source in frame.choices:
            new_choices[m.target] = frame.choices[m.source]
    fallible = [c for c in cols if c.failed is not None]
    if not fallible:
        df = frame.df.select(*_nest(targets))
        return frame._next(df, ErrorStage("apply_mapping", ctx, info, None, stage, total), new_choices)
    # the good side asks only whether any cast failed; the messages are made on the error side
    lost = reduce(lambda a, b: a | b, [F.coalesce(c.failed, F.lit(False)) for c in fallible])
    good = frame.df.where(~lost).select(*_nest(targets))
    told = frame.df.withColumn(_ERR, F.nullif(F.concat_ws("; ", *[F.when(c.failed, F.lit(c.message)) for c in fallible]), F.lit("")))
    bad = error_rows(told, F.col(_ERR), "apply_mapping", ctx, info, exclude=(_ERR,))
    return frame._next(good, ErrorStage("apply_mapping", ctx, info, bad, stage, total), new_choices)


def aligned(value: Column, source: DataType, target: DataType) -> tuple[Column, Column | None]:
    """A value under another type, fields by name; and whether some of it is lost (None: it can't be)."""
    if source == target:
        return value, None
    if isinstance(target, StructType) and isinstance(source, StructType):
        fields, lost = _aligned_fields(value.getField, source, target)
        return F.when(value.isNotNull(), F.struct(*fields)), lost
    if isinstance(target, ArrayType) and isinstance(source, ArrayType):
        probe = aligned(F.lit(None), source.elementType, target.elementType)[1]
        inner = lambda e: aligned(e, source.elementType, target.elementType)
        return F.transform(value, lambda e: inner(e)[0]), None if probe is None else F.exists(value, lambda e: F.coalesce(inner(e)[1], F.lit(False)))
    if isinstance(target, MapType) and isinstance(source, MapType) and source.keyType == target.keyType:
        probe = aligned(F.lit(None), source.valueType, target.valueType)[1]
        inner = lambda e: aligned(e, source.valueType, target.valueType)
        return F.transform_values(value, lambda _, e: inner(e)[0]), None if probe is None else F.exists(
            F.map_values(value), lambda e: F.coalesce(inner(e)[1], F.lit(False)))
    if any(isinstance(t, (StructType, ArrayType, MapType)) for t in (source, target)):
        # unlike kinds have no cast
        return F.lit(None).cast(target), None if isinstance(source, NullType) else value.isNotNull()
    cast = safe_cast(value, target, source)
    return cast, None if _lossless(source, target) or isinstance(source, NullType) else value.isNotNull() & cast.isNull()


def _aligned_fields(field, source: StructType, target: StructType) -> tuple[list[Column], Column | None]:
    """Columns of ``target`` out of fields of ``source`` (names without regard to case), and whether a value is lost."""
    have = {f.name.lower(): f for f in source.fields}
    columns, lost = [], []
    for f in target.fields:
        own = have.get(f.name.lower())
        value, gone = (F.lit(None).cast(f.dataType), None) if own is None else aligned(field(own.name), own.dataType, f.dataType)
        columns.append(value.alias(f.name))
        lost.append(gone)
    lost = [F.coalesce(x, F.lit(False)) for x in lost if x is not None]
    return columns, reduce(lambda a, b: a | b, lost) if lost else None


def conform_to_schema(frame: Frame, schema) -> Frame:
    """Align a frame to a given schema without a pass over it.

    The schema selects columns, as ``select_fields`` does; columns that the
    frame lacks are null. A row of which a value doesn't fit its type is an
    error record.
    """
    if isinstance(schema, str):
        try:
            schema = StructType.fromJson(__import__("json").loads(schema))
        except ValueError:
            schema = parse_type(schema)
    columns, lost = _aligned_fields(top, frame.df.schema, schema)
    if lost is None:
        return frame._next(frame.df.select(*columns), ErrorStage("with_frame_schema", "", "", None))
    told = frame.df.withColumn(_ERR, F.when(lost, F.lit("a value does not fit the schema")))
    bad = error_rows(told, F.col(_ERR), "with_frame_schema", "", "", exclude=(_ERR,))
    return frame._next(frame.df.where(~lost).select(*columns), ErrorStage("with_frame_schema", "", "", bad))


__all__ = ["aligned", "apply_mapping", "conform_to_schema", "mapping_columns", "quote"]
