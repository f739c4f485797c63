"""Choice columns: finding them in drifting JSON, merging frames, resolving.

Ingest: texts are parsed once into a ``VARIANT`` and staged; records, error
records and the inferred type all come from the staged table. A text that is
not just one JSON value is cut into its values (``sources.jsontext``), and what
is no value is an error record. The type of every record is
``schema_of_variant``; the distinct type strings are grouped by Spark, folded
per partition in Python (``mapInPandas``) with the merge rule in
``schema.merge_types``, and the per-partition results (one per partition, of
bounded size by ``schema.bounded``) are folded on the driver. Arrays that hold
mixed values are described by a second pass over their exploded elements. The
merged type then drives one ``select`` that turns the variant into typed
columns; a field seen with several types becomes a choice struct with one field
per type.
"""

from __future__ import annotations

import json
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType,
    DataType,
    MapType,
    NullType,
    StringType,
    StructField,
    StructType,
)

from ..errors import ErrorStage, error_rows, unique_stages
from ..functions.casts import safe_cast
from ..frame import Frame
from ..paths import resolve, split_path, top
from ..schema import (
    ChoiceType,
    MixedType,
    MOST_FIELDS,
    WHOLE_DECIMAL,
    bounded,
    choice_paths,
    distinct_names,
    loads,
    merge_types,
    parse_type,
    to_spark,
    type_name,
    with_distinct_names,
)

# ---------------------------------------------------------------------------
# inference


def _folding(most: int):
    """mapInPandas body: fold the distinct type strings of one partition."""

    def fold(iterator):
        import pandas as pd

        from flexframe.schema import bounded as _bounded
        from flexframe.schema import dumps as _dumps
        from flexframe.schema import merge_types as _merge
        from flexframe.schema import read_variant_type

        merged = None
        first = None
        for pdf in iterator:
            for s, pos in sorted(zip(pdf["s"], pdf["first"]), key=lambda x: x[1]):
                if s is None:
                    continue
                merged = _bounded(_merge(merged, read_variant_type(s)), most)
                first = pos if first is None else min(first, pos)
        if merged is not None:
            yield pd.DataFrame({"t": [_dumps(merged)], "first": [first]})

    return fold


def infer_variant_type(v: Column, df: DataFrame, most: int = MOST_FIELDS):
    """Merged type of a variant column over the whole DataFrame."""
    from ..session import ship_package

    ship_package(df.sparkSession)
    shapes = (
        df.select(F.schema_of_variant(v).alias("s"),
                  F.monotonically_increasing_id().alias("pos"))
        .where(F.col("s").isNotNull())
        .groupBy("s").agg(F.min("pos").alias("first"))
    )
    partial = shapes.mapInPandas(_folding(most), "t string, first long").collect()
    merged = None
    for row in sorted(partial, key=lambda r: r["first"]):
        merged = bounded(merge_types(merged, loads(row["t"])), most)
    return merged


def _json_path(parts: list[str]) -> str:
    out = "$"
    for p in parts:
        out += "[" + json.dumps(p) + "]"
    return out


def _resolve_mixed(t, df: DataFrame, v: Column, parts: list[str], most: int = MOST_FIELDS):
    """Replace MixedType inside arrays and maps by the merged type of their elements."""
    if isinstance(t, StructType):
        return StructType([StructField(f.name, _resolve_mixed(f.dataType, df, v, parts + [f.name], most), True) for f in t.fields])
    if isinstance(t, ChoiceType):
        out = ChoiceType()
        for name, alt in t.alternatives.items():
            out.alternatives[name] = _resolve_mixed(alt, df, v, parts, most)
        return out
    if isinstance(t, ArrayType) and _contains_mixed(t.elementType):
        return ArrayType(_inner_type(df, F.try_variant_get(v, _json_path(parts), "array<variant>"), most), True)
    if isinstance(t, MapType) and _contains_mixed(t.valueType):
        return MapType(StringType(), _inner_type(df, F.map_values(F.try_variant_get(v, _json_path(parts), "map<string,variant>")), most), True)
    return t


def _inner_type(df: DataFrame, values: Column, most: int):
    elems = df.select(F.explode(values).alias("__e"))
    found = infer_variant_type(F.col("__e"), elems, most)
    return NullType() if found is None else _resolve_mixed(found, elems, F.col("__e"), [], most)


def _contains_mixed(t) -> bool:
    if isinstance(t, MixedType):
        return True
    if isinstance(t, StructType):
        return any(_contains_mixed(f.dataType) for f in t.fields)
    if isinstance(t, (ArrayType, MapType)):
        return _contains_mixed(t.elementType if isinstance(t, ArrayType) else t.valueType)
    if isinstance(t, ChoiceType):
        return any(_contains_mixed(a) for a in t.alternatives.values())
    return False


# ---------------------------------------------------------------------------
# filling typed columns from a variant

# Variant type words that belong to each alternative name.
_WORDS = {
    "long": ("BIGINT", "INT", "SMALLINT", "TINYINT"),
    "double": ("DOUBLE", "FLOAT", "DECIMAL"),
    "string": ("STRING",),
    "boolean": ("BOOLEAN",),
    "date": ("DATE",),
    "timestamp": ("TIMESTAMP", "TIMESTAMP_NTZ"),
    "struct": ("OBJECT",),
    "map": ("OBJECT",),
    "array": ("ARRAY",),
}


def _is_kind(sov: Column, name: str) -> Column:
    """Whether a variant type text belongs to an alternative; whole numbers beyond long are decimals."""
    if name == "decimal":
        return sov.rlike(WHOLE_DECIMAL)
    word = F.regexp_extract(sov, "^[A-Z_]+", 0).isin(*_WORDS.get(name, ()))
    return word & ~sov.rlike(WHOLE_DECIMAL) if name == "double" else word


def _fill(x: Column, t, parts: tuple[str, ...] = ()) -> Column:
    """Typed value of what variant ``x`` has at ``parts``, for the merged type ``t``.

    Only a choice asks for the type of a value; elsewhere all values have the
    one type that was found.
    """
    path = _json_path(list(parts))
    node = F.variant_get(x, path, "variant") if parts else x
    if isinstance(t, ChoiceType):
        def chosen(b):
            kind, value = b["kind"], b["value"]
            fields = [F.when(_is_kind(kind, name), _fill(value, alt)).alias(name) for name, alt in t.alternatives.items()]
            return F.when(value.isNotNull() & (kind != F.lit("VOID")), F.struct(*fields))

        # an array of one, so that the node and its type are found once
        one = F.array(F.struct(node.alias("value"), F.schema_of_variant(node).alias("kind")))
        return F.get(F.transform(one, chosen), F.lit(0))
    if isinstance(t, StructType):
        if not t.fields:
            return F.lit(None).cast(StructType([]))
        names = distinct_names(t.names)
        fields = [_fill(x, f.dataType, (*parts, f.name)).alias(n) for n, f in zip(names, t.fields)]
        return F.when(node.isNotNull() & ~F.is_variant_null(node), F.struct(*fields))
    if isinstance(t, ArrayType):
        return F.transform(F.try_variant_get(x, path, "array<variant>"), lambda e: _fill(e, t.elementType))
    if isinstance(t, MapType):
        return F.transform_values(F.try_variant_get(x, path, "map<string,variant>"), lambda _, e: _fill(e, t.valueType))
    if isinstance(t, NullType):
        return F.lit(None).cast(NullType())
    if isinstance(t, MixedType):
        return F.to_json(node)
    return F.try_variant_get(x, path, to_spark(t).simpleString())


#: The one column of records that are maps themselves (objects with ids as names).
ENTRIES = "entries"


def typed_columns(v: Column, t) -> list[Column]:
    if isinstance(t, MapType):
        return [_fill(v, t).alias(ENTRIES)]
    return [_fill(v, f.dataType, (f.name,)).alias(n) for n, f in zip(distinct_names(t.names), t.fields)]


# Options of a drift-aware read, all of the text source; a read with a schema takes any.
LINE_OPTIONS = {"linesep", "pathglobfilter", "recursivefilelookup", "modifiedafter", "modifiedbefore",
                "ignoremissingfiles", "ignorecorruptfiles"}
CORRUPT = "_corrupt_record"
#: The file a row comes from, where the scan's own metadata is out of reach.
FILE = "__ff_file"


def read_json_frame(spark: SparkSession, paths, schema=None, ctx: str = "", multiline=False, load=None, kept=None, **options) -> Frame:
    """Drift-aware JSON read: records per line, or (``multiline``) anywhere in a file.

    A line or file may hold several values. An array of objects is so many
    records; what is neither an object nor one of an array, and what is no
    JSON, becomes an error record. Objects with more than ``maxFields`` names
    at one path are maps. ``kept(type)`` may merge the type found with that of
    earlier reads.
    """
    load = load or (lambda make: make(spark.read))
    if schema is not None:
        s = parse_type(schema) if isinstance(schema, str) else schema
        wide = StructType([*s.fields, StructField(CORRUPT, StringType())])
        df = load(lambda r: r.schema(wide).options(**options).option("columnNameOfCorruptRecord", CORRUPT)
                  .json(paths, multiLine=bool(multiline)))
        # a record is checked against the columns that are read, so the filter touches them all (always true)
        maps = [f.name for f in s.fields if "map<" not in f.dataType.simpleString()]
        touch = F.hash(*map(top, maps)) >= -(1 << 31) if maps else F.lit(True)
        bad = _errors("read_json", ctx, df.where(top(CORRUPT).isNotNull() & touch), "malformed JSON record", top(CORRUPT))
        return Frame(df.where(top(CORRUPT).isNull() & touch).drop(CORRUPT), "", [ErrorStage("read_json", ctx, "", bad)])
    most = int(options.pop("maxFields", MOST_FIELDS))
    unknown = sorted(k for k in options if k.lower() not in LINE_OPTIONS)
    if unknown:
        raise ValueError(f"options {unknown} need a schema; a drift-aware read takes {sorted([*LINE_OPTIONS, 'maxFields'])}")
    if multiline:
        from ..sources.jsontext import values_of_files

        raw = load(lambda r: values_of_files(r.options(**options).text(paths)).withColumnRenamed("file", FILE))
        return frame_from_json_text(raw, "value", ctx, inner="inner", most=most, kept=kept)
    return frame_from_json_text(load(lambda r: r.options(**options).text(paths)), "value", ctx, most=most, kept=kept)


def _errors(op: str, ctx: str, df: DataFrame, message: str, record: Column) -> DataFrame:
    return df.select(F.lit(op).alias("op"), F.lit(ctx).alias("transformation_ctx"), F.lit("").alias("info"),
                     F.lit(message).alias("message"), record.alias("record"))


_BLANKS = " \t\r\n"


def _stage(df: DataFrame, label: str) -> DataFrame:
    """``df`` written to a fresh folder under the shared checkpoint folder, and read back."""
    from ..session import scratch_dir

    path = scratch_dir(df.sparkSession, label)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def frame_from_json_text(raw: DataFrame, column: str, ctx: str = "", op: str = "read_json", inner: str | None = None,
                         most: int = MOST_FIELDS, kept=None) -> Frame:
    """The records of a text column; blank texts hold none.

    Every text is parsed once, into a staged table. Texts that aren't just one
    value are cut into their values, which are parsed in turn. Texts marked by
    ``inner`` are elements of an array already, so arrays among them are no
    records.
    """
    from ..sources.jsontext import cut_texts, single

    def parsed(df: DataFrame, within: Column) -> DataFrame:
        v, text = F.col("v"), F.col("t")
        return _stage(df.select("t", within.alias("inner"), single(text).alias("v")).select(
            v, F.when(v.isNull(), text).alias("t"), "inner", F.substring(F.ltrim(text, F.lit(_BLANKS)), 1, 1).alias("first")), "json")

    texts = raw.where(F.trim(top(column), F.lit(_BLANKS)) != "").select(top(column).alias("t"), *([inner] if inner else []))
    whole = parsed(texts, F.col(inner) if inner else F.lit(False))
    v = F.col("v")
    broken = whole.where(v.isNull())
    if not broken.isEmpty():
        again = parsed(cut_texts(broken.select("t")).withColumnRenamed("value", "t"), F.lit(False))
        malformed = _errors(op, ctx, again.where(v.isNull()), "malformed JSON record", F.col("t"))
        whole = whole.where(v.isNotNull()).unionByName(again.where(v.isNotNull()))
    else:
        malformed = _errors(op, ctx, broken, "malformed JSON record", F.col("t"))
    objects, lists = F.col("first") == "{", (F.col("first") == "[") & ~F.col("inner")
    # an array stands for its elements; an empty one leaves a null, so that no input is lost
    elements = whole.where(lists).select(F.explode_outer(F.try_variant_get(v, "$", "array<variant>")).alias("e"), v)
    is_object = F.coalesce(F.schema_of_variant("e").startswith("OBJECT"), F.lit(False))
    other = whole.where(~objects & ~lists).select(F.to_json(v).alias("r")).unionAll(
        elements.where(~is_object).select(F.to_json(F.coalesce("e", "v")).alias("r")))
    other = _errors(op, ctx, other, "not a JSON object", F.col("r"))
    records = whole.where(objects).select(v).unionAll(elements.where(is_object).select(F.col("e").alias("v")))
    t = infer_variant_type(v, records, most)
    t = None if t is None else bounded(_resolve_mixed(t, records, v, [], most), most)
    if kept is not None:
        t = kept(t)
    t = StructType([]) if t is None else t
    df = records.select(*typed_columns(v, t)) if isinstance(t, MapType) or t.fields else records.select()
    named = with_distinct_names(t)
    return Frame(df, "", [ErrorStage(op, ctx, "", malformed.unionAll(other))], choice_paths(named))


# ---------------------------------------------------------------------------
# resolving choices


def _rewrite(df: DataFrame, parts: list[str], fn) -> DataFrame:
    """Replace the node at ``parts`` (through structs / arrays) by ``fn(col, dtype)``."""

    def walk(expr, dtype, rest):
        if isinstance(dtype, ArrayType):
            inner = dtype.elementType
            return F.transform(expr, lambda e: walk(e, inner, rest))
        if not rest:
            return fn(expr, dtype)
        assert isinstance(dtype, StructType)
        cols = []
        for f in dtype.fields:
            child = expr.getField(f.name)
            cols.append((walk(child, f.dataType, rest[1:]) if f.name == rest[0] else child).alias(f.name))
        return F.when(expr.isNull(), F.lit(None)).otherwise(F.struct(*cols))

    head = parts[0]
    out = []
    for f in df.schema.fields:
        if f.name == head:
            out.append(walk(top(head), f.dataType, parts[1:]).alias(head))
        else:
            out.append(top(f.name))
    return df.select(*out)


def _project(expr: Column, dtype: StructType, target: str) -> Column:
    names = [f.name for f in dtype.fields]
    if target not in names:
        return F.lit(None).cast(parse_type(target))
    return expr.getField(target)


def _cast(expr: Column, dtype: StructType, target: DataType) -> Column:
    """Coalesce of the same-type alternative and try_casts of the atomic others."""
    tname = type_name(target)
    parts = []
    for f in dtype.fields:
        child = expr.getField(f.name)
        if f.name == tname:
            parts.append(child if f.dataType == target else safe_cast(child, target, f.dataType))
        elif not isinstance(f.dataType, (StructType, ArrayType, MapType)):
            parts.append(safe_cast(child, target, f.dataType))
    return F.coalesce(*parts) if parts else F.lit(None).cast(target)


def _anywhere(df: DataFrame, parts: list[str], holds) -> Column:
    """Whether ``holds(col, dtype)`` is true at any node that ``parts`` names (arrays hold several)."""

    def walk(expr, dtype, rest):
        if isinstance(dtype, ArrayType):
            return F.coalesce(F.exists(expr, lambda e: F.coalesce(walk(e, dtype.elementType, rest), F.lit(False))), F.lit(False))
        if not rest:
            return F.coalesce(holds(expr, dtype), F.lit(False))
        return walk(expr.getField(rest[0]), dtype[rest[0]].dataType, rest[1:])

    return walk(top(parts[0]), df.schema[parts[0]].dataType, parts[1:])


def _specs_for_all(frame: Frame, choice: str, database, table_name) -> list[tuple[str, str]]:
    """The same action for every choice path, or casts to the types of a catalog table."""
    if choice.lower() != "match_catalog":
        return [(p, choice) for p in frame.choices]
    if not table_name:
        raise ValueError("MATCH_CATALOG needs database and table_name")
    target = frame.spark.table(f"{database}.{table_name}" if database else table_name).schema
    found = [(p, resolve(target, split_path(p), case_sensitive=False)) for p in frame.choices]
    return [(p, "cast:" + r[1].simpleString()) for p, r in found if r is not None]


def _node(parts: list[str]) -> Column:
    expr = top(parts[0])
    for p in parts[1:]:
        expr = expr.getField(p)
    return expr


def resolve_choice(frame: Frame, specs=None, choice="", database=None, table_name=None, ctx="", info="", stage=0, total=0) -> Frame:
    """Resolve choice paths: ``make_struct``, ``project:<type>``, ``cast:<type>``, ``MATCH_CATALOG``.

    ``specs`` names paths with their actions, or ``choice`` is one action for
    all choices. A path that isn't there is passed over; one that is no choice
    raises, since there is nothing to resolve. A value that doesn't cast makes
    the row an error record, also inside arrays.
    """
    if bool(choice) == (specs is not None):
        raise ValueError("give either specs or one choice for all paths")
    if specs is None:
        specs = _specs_for_all(frame, choice, database, table_name)
    elif isinstance(specs, tuple):
        specs = [specs]
    schema = frame.df.schema
    choices = dict(frame.choices)
    steps = []
    checks = []
    for path, action in specs:
        found = resolve(schema, split_path(path))
        if found is None:
            continue
        parts, dtype, _ = found
        key = next((p for p in choices if p == path or split_path(p) == parts), None)
        value = dtype
        while isinstance(value, ArrayType):
            value = value.elementType
        if key is None or not isinstance(value, StructType):
            raise ValueError(f"{path} is not a choice: {dtype.simpleString()}")
        verb, _, wanted = action.strip().partition(":")
        verb = verb.lower()
        if verb == "project" and wanted:
            name = type_name(parse_type(wanted))
            steps.append((parts, lambda e, d, t=name: _project(e, d, t)))
        elif verb == "cast" and wanted:
            target = parse_type(wanted)
            steps.append((parts, lambda e, d, t=target: _cast(e, d, t)))
            lost = _anywhere(frame.df, parts, lambda e, d, t=target: e.isNotNull() & _cast(e, d, t).isNull())
            checks.append(F.when(lost, F.lit(f"cannot cast choice {path} to {target.simpleString()}")))
        elif verb != "make_struct":
            raise ValueError(f"unknown action {action!r} for {path}: make_struct, project:<type> or cast:<type>")
        del choices[key]

    def replay(d: DataFrame) -> DataFrame:
        for parts, fn in steps:
            d = _rewrite(d, parts, fn)
        return d

    if checks:
        staged = frame.df.withColumn("__ff_err", F.nullif(F.concat_ws("; ", *checks), F.lit("")))
        bad = error_rows(staged, F.col("__ff_err"), "resolve_choice", ctx, info, exclude=("__ff_err",))
        good = replay(staged.where(F.col("__ff_err").isNull()).drop("__ff_err"))
        return frame._next(good, ErrorStage("resolve_choice", ctx, info, bad, stage, total), choices)
    return frame._next(replay(frame.df), ErrorStage("resolve_choice", ctx, info, None, stage, total), choices)


#: Spec of each per-path option; the target type, if the action takes one, follows.
_OPTION_SPECS = {"keepasstruct": "make_struct", "project": "project:", "cast": "cast:"}


def to_df(frame: Frame, options) -> DataFrame:
    """The frame's DataFrame after per-path choice options; other choices stay structs."""
    specs = []
    for o in options:
        spec = _OPTION_SPECS.get(o.action.lower())
        if spec is None:
            raise ValueError(f"unknown option {o.action!r} for {o.path}: one of {', '.join(_OPTION_SPECS)}")
        if spec.endswith(":"):
            if o.target is None:
                raise ValueError(f"option {o.action!r} for {o.path} names no target type")
            spec += parse_type(o.target).simpleString()
        specs.append((o.path, spec))
    return resolve_choice(frame, specs=specs).df if specs else frame.df


# ---------------------------------------------------------------------------
# merging two frames (schema merge + union)


def logical_type(dtype: DataType, choices: dict, prefix: list[str] | None = None):
    """Schema with marked choice structs turned back into ChoiceType."""
    prefix = prefix or []
    marked = {tuple(split_path(p)) for p in choices}
    if tuple(prefix) in marked and prefix and isinstance(dtype, StructType):
        return ChoiceType([logical_type(f.dataType, choices, prefix + [f.name]) for f in dtype.fields]) if all(
            type_name(f.dataType) == f.name or (f.name == "timestamp") for f in dtype.fields) else dtype
    if isinstance(dtype, StructType):
        return StructType([StructField(f.name, logical_type(f.dataType, choices, prefix + [f.name]), True) for f in dtype.fields])
    if isinstance(dtype, ArrayType):
        return ArrayType(logical_type(dtype.elementType, choices, prefix), True)
    return dtype


def conform(expr: Column, src, dst) -> Column:
    """Reshape a value of logical type ``src`` into the physical form of ``dst``."""
    if isinstance(src, NullType):
        return F.lit(None).cast(to_spark(dst))
    if isinstance(dst, ChoiceType):
        fields = []
        if isinstance(src, ChoiceType):
            for n, alt in dst.alternatives.items():
                v = conform(expr.getField(n), src.alternatives[n], alt) if n in src.alternatives else F.lit(None).cast(to_spark(alt))
                fields.append(v.alias(n))
        else:
            sname = type_name(src)
            for n, alt in dst.alternatives.items():
                v = conform(expr, src, alt) if n == sname else F.lit(None).cast(to_spark(alt))
                fields.append(v.alias(n))
        return F.when(expr.isNotNull(), F.struct(*fields))
    if isinstance(dst, StructType):
        have = {f.name: f.dataType for f in src.fields}
        fields = []
        for f in dst.fields:
            v = conform(expr.getField(f.name), have[f.name], f.dataType) if f.name in have else F.lit(None).cast(to_spark(f.dataType))
            fields.append(v.alias(f.name))
        return F.when(expr.isNotNull(), F.struct(*fields))
    if isinstance(dst, ArrayType):
        return F.transform(expr, lambda e: conform(e, src.elementType, dst.elementType))
    if isinstance(dst, MapType):
        return F.transform_values(expr, lambda k, e: conform(e, src.valueType, dst.valueType))
    target = to_spark(dst)
    return expr if src == target else expr.try_cast(target)


def misfit(expr: Column, src, dst) -> Column | None:
    """Whether ``conform`` loses a value: a cast to the other side's type that doesn't fit (None: it can't)."""
    if isinstance(src, NullType) or isinstance(src, MapType):
        return None
    if isinstance(dst, ChoiceType):
        pairs = ([(expr.getField(n), src.alternatives[n], alt) for n, alt in dst.alternatives.items() if n in src.alternatives]
                 if isinstance(src, ChoiceType) else [(expr, src, alt) for n, alt in dst.alternatives.items() if n == type_name(src)])
    elif isinstance(dst, StructType):
        have = {f.name: f.dataType for f in src.fields}
        pairs = [(expr.getField(f.name), have[f.name], f.dataType) for f in dst.fields if f.name in have]
    elif isinstance(dst, ArrayType):
        probe = misfit(expr, src.elementType, dst.elementType)
        return None if probe is None else F.exists(expr, lambda e: F.coalesce(misfit(e, src.elementType, dst.elementType), F.lit(False)))
    else:
        return None if src == to_spark(dst) else expr.isNotNull() & expr.try_cast(to_spark(dst)).isNull()
    found = [F.coalesce(m, F.lit(False)) for m in (misfit(*p) for p in pairs) if m is not None]
    return reduce(lambda a, b: a | b, found) if found else None


def merge_frames(f1: Frame, f2: Frame) -> Frame:
    """Union of two frames under the merged schema; conflicts become choices."""
    t1 = logical_type(f1.df.schema, f1.choices)
    t2 = logical_type(f2.df.schema, f2.choices)
    merged = merge_types(t1, t2)
    cols1 = {f.name: f.dataType for f in t1.fields}
    cols2 = {f.name: f.dataType for f in t2.fields}

    stages = []

    def side(df, have):
        lost = {f.name: misfit(top(f.name), have[f.name], f.dataType) for f in merged.fields if f.name in have}
        checks = [F.when(m, F.lit(f"{n} does not fit the merged type")) for n, m in lost.items() if m is not None]
        if checks:
            tagged = df.withColumn("__ff_err", F.nullif(F.concat_ws("; ", *checks), F.lit("")))
            stages.append(ErrorStage("merge", "", "", error_rows(tagged, F.col("__ff_err"), "merge", "", "", exclude=("__ff_err",))))
            df = tagged.where(F.col("__ff_err").isNull())
        return df.select(*[
            (conform(top(f.name), have[f.name], f.dataType) if f.name in have else F.lit(None).cast(to_spark(f.dataType))).alias(f.name)
            for f in merged.fields])

    df = side(f1.df, cols1).unionByName(side(f2.df, cols2))
    return Frame(df, f1.name, unique_stages(f1.errors + f2.errors) + stages, choice_paths(merged))
