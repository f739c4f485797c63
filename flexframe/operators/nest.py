"""Nesting: unnest, relationalize, unbox.

relationalize turns a nested frame into flat tables: a root table whose
struct fields are flattened to dotted column names and whose arrays are
replaced by a key, plus one table per array path with ``id`` (the key),
``index`` (0-based position) and the flattened element under
``<path>.val``. Arrays inside array elements get the key
``<parent id>.<index>`` and a table of their own.

Row ids must be identical in every table, but the root and child tables run as
separate jobs and ``monotonically_increasing_id`` depends on partitioning.
So ids are stamped once and the stamped rows are written to a staging folder
(under the cluster's checkpoint dir by default); every table is derived from
the read-back. That write also cuts the lineage, so a lost executor only
re-reads staged files. With ``options={"key": [...]}`` the caller's columns
form the key (several as a JSON array of texts; it must tell rows apart) and nothing is
staged. Maps are kept as they are, in every table. Child tables are ``posexplode`` over the
staged rows: narrow, no shuffle. Rows that share a key would mix their children, so a key
that two rows share raises (one aggregate over the key; ``"unique": True`` says it was checked).

Flattened names that clash (a column ``a.b`` beside a struct ``a`` with a field ``b``) get
``_2``, ``_3``, ... as in ``schema.distinct_names``.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType, StructType

from ..errors import ErrorStage, error_rows
from ..frame import Frame, FrameSet
from ..paths import quote, resolve, split_path, top
from ..schema import MOST_FIELDS, bounded, choice_paths, distinct_names, parse_type, with_distinct_names
from ..session import scratch_dir, ship_package

_ID = "__ff_id"


def _flatten(expr: Column, dtype, name: str, key: Column, arrays: list) -> list[Column]:
    if isinstance(dtype, StructType) and dtype.fields:
        out = []
        for f in dtype.fields:
            sub = f"{name}.{quote(f.name)}" if name else quote(f.name)
            out.extend(_flatten(expr.getField(f.name), f.dataType, sub, key, arrays))
        return out
    if isinstance(dtype, ArrayType):
        arrays.append((name, expr, dtype))
        return [F.when(expr.isNotNull(), key).alias(name)]
    return [expr.alias(name)]


def unnest(frame: Frame, ctx="", info="", stage=0, total=0) -> Frame:
    """Struct fields to top-level dotted columns; arrays replaced by a row key."""
    arrays: list = []
    key = F.monotonically_increasing_id().cast("string")
    cols = []
    for f in frame.df.schema.fields:
        cols.extend(_flatten(top(f.name), f.dataType, quote(f.name), key, arrays))
    df = frame.df.select(*cols)
    df = df.toDF(*_flat_names(_names(cols, frame.df.schema)))
    return frame._next(df, ErrorStage("unnest", ctx, info, None, stage, total), choices={})


def _names(cols, schema):
    names = []
    for f in schema.fields:
        names.extend(_leaf_names(f.dataType, quote(f.name)))
    return names


def _leaf_names(dtype, name):
    if isinstance(dtype, StructType) and dtype.fields:
        out = []
        for f in dtype.fields:
            out.extend(_leaf_names(f.dataType, f"{name}.{quote(f.name)}"))
        return out
    return [name]


def _unquote(name: str) -> str:
    """Flattened column name: segments joined by dots, no backticks."""
    return ".".join(split_path(name))


def _flat_names(names: list[str]) -> list[str]:
    return distinct_names([_unquote(n) for n in names])


def _check_key(base: DataFrame, key_cols: list[str]) -> None:
    twice = base.groupBy(_ID).count().where(F.col("count") > 1).select(_ID).head()
    if twice is not None:
        raise ValueError(f"key {key_cols} doesn't tell rows apart: {twice[0]} is met more than once")


def relationalize(frame: Frame, root_table_name: str, staging_path=None, options=None, ctx="", info="", stage=0, total=0) -> FrameSet:
    options = options or {}
    spark = frame.spark
    key_cols = options.get("key")
    if key_cols:
        key_cols = [key_cols] if isinstance(key_cols, str) else list(key_cols)
        # one column: its text; several: their texts as JSON, nulls kept, so that different keys never meet
        values = [top(c).cast("string") for c in key_cols]
        base = frame.df.withColumn(_ID, values[0] if len(values) == 1 else F.to_json(F.array(*values)))
        if not options.get("unique"):
            _check_key(base, key_cols)
    else:
        path = staging_path or scratch_dir(spark, "relationalize")
        target = f"{path.rstrip('/')}/{root_table_name}-{__import__('uuid').uuid4().hex}"
        frame.df.withColumn(_ID, F.monotonically_increasing_id().cast("string")).write.mode("overwrite").parquet(target)
        base = spark.read.parquet(target)

    tables: dict[str, Frame] = {}
    key = F.col(_ID)
    arrays: list = []
    cols = []
    for f in frame.df.schema.fields:
        cols.extend(_flatten(top(f.name), f.dataType, quote(f.name), key, arrays))
    root = base.select(*cols)
    root = root.toDF(*_flat_names(_names(cols, frame.df.schema)))
    tables[root_table_name] = Frame(root, root_table_name, frame.errors)

    def emit(source: DataFrame, parent_key: Column, name: str, arr: Column, dtype: ArrayType):
        exploded = source.select(parent_key.alias("id"), F.posexplode(arr).alias("index", "__ff_val"))
        child_key = F.concat_ws(".", F.col("id"), F.col("index").cast("string"))
        sub_arrays: list = []
        el = dtype.elementType
        val_name = f"{name}.val"
        flat = _flatten(F.col("__ff_val"), el, val_name, child_key, sub_arrays)
        names = ["id", "index"] + _flat_names(_leaf_names(el, val_name))
        child = exploded.select(F.col("id"), F.col("index"), *flat).toDF(*names)
        table = f"{root_table_name}_{_unquote(name)}"
        tables[table] = Frame(child, table)
        for sub_name, sub_arr, sub_type in sub_arrays:
            emit(exploded, child_key, sub_name, sub_arr, sub_type)

    for name, arr, dtype in arrays:
        emit(base, key, name, arr, dtype)
    return FrameSet(tables, spark)


# ---------------------------------------------------------------------------
# unbox


def _node(parts):
    e = top(parts[0])
    for p in parts[1:]:
        e = e.getField(p)
    return e


def _every(expr: Column, dtype, rest: list[str]) -> Column:
    """All nodes that a path names, arrays on the way laid out in one."""
    if isinstance(dtype, ArrayType):
        return F.flatten(F.transform(expr, lambda e: _every(e, dtype.elementType, rest)))
    if not rest:
        return F.array(expr)
    return _every(expr.getField(rest[0]), dtype[rest[0]].dataType, rest[1:])


def _unbox_in_arrays(frame: Frame, path: str, parts: list[str], fmt: str, options: dict, stage: ErrorStage) -> Frame:
    """``unbox`` of JSON texts below arrays: all of them have one type; a row with a bad one is an error record."""
    from ..sources.jsontext import single
    from .choice import _anywhere, _fill, _resolve_mixed, _rewrite, infer_variant_type

    if fmt != "json":
        raise NotImplementedError(f"unbox of {fmt} inside an array is not supported")
    found: dict[str, list[str]] = {}
    if options.get("withSchema"):
        given = options["withSchema"]
        schema = StructType.fromJson(json.loads(given)) if str(given).strip().startswith("{") else parse_type(given)
        value = lambda e: F.from_json(e, schema)
    else:
        texts = frame.df.select(F.explode(_every(top(parts[0]), frame.df.schema[parts[0]].dataType, parts[1:])).alias("__t"))
        parsed = texts.select(single(F.col("__t")).alias("__v")).where(F.col("__v").isNotNull())
        t = infer_variant_type(F.col("__v"), parsed)
        t = StringType() if t is None else bounded(_resolve_mixed(t, parsed, F.col("__v"), []))
        value = lambda e: _fill(single(e), t)
        found = {(f"{path}.{p}" if p else path): n for p, n in choice_paths(with_distinct_names(t)).items()}
    bad = _anywhere(frame.df, parts, lambda e, _: e.isNotNull() & single(e).isNull())
    tagged = frame.df.withColumn("__ff_err", F.when(bad, F.lit(f"cannot unbox {path} as json")))
    errors = error_rows(tagged, F.col("__ff_err"), stage.op, stage.ctx, stage.info, exclude=("__ff_err",))
    good = _rewrite(tagged.where(F.col("__ff_err").isNull()).drop("__ff_err"), parts, lambda e, _: value(e))
    done = ErrorStage(stage.op, stage.ctx, stage.info, errors, stage.stage_threshold, stage.total_threshold)
    return frame._next(good, done, {**frame.choices, **found})


#: Names, values and the fault of a boxed csv text.
_CSV_PARTS = "names array<string>, values array<string>, fault string"


def _csv_parts(sep: str, escape: str | None, header: bool):
    """A function of a text column: the fields of its header record, if it has one, and those of its one data record.

    Fields and records end as RFC 4180 has it: quoted fields may hold
    separators, line ends and doubled quotes. An empty field without quotes is
    null.
    """

    def read(texts):
        import csv
        import io
        import sys

        import pandas as pd

        csv.field_size_limit(sys.maxsize)
        shape = {"delimiter": sep, "escapechar": escape or None, "strict": True, "quoting": csv.QUOTE_NOTNULL}
        out = []
        for text in texts:
            names = values = fault = None
            if text is not None:
                try:
                    records = [r for r in csv.reader(io.StringIO(text, newline=""), **shape) if r]
                    want = 2 if header else 1
                    if len(records) != want:
                        fault = f"{len(records)} records instead of {want}"
                    else:
                        names, values = (["" if n is None else n.strip() for n in records[0]], records[1]) if header else (None, records[0])
                except csv.Error as e:
                    fault = str(e)
            out.append((names, values, fault))
        return pd.DataFrame(out, columns=["names", "values", "fault"], dtype=object)

    return F.pandas_udf(read, _CSV_PARTS)


def _unbox_csv(frame: Frame, node: Column, schema: StructType | None, options: dict) -> tuple[DataFrame, Column, Column]:
    """(rows with ``__ff_v``, value, failed) of csv texts with one data record each."""
    from .choice import _stage
    from .mapping import aligned

    ship_package(frame.spark)
    header = bool(options.get("skipFirst") or options.get("withHeader"))
    source = frame.df.withColumn("__ff_v", _csv_parts(options.get("separator", ","), options.get("escaper"), header)(node))
    if "void" not in frame.df.schema.simpleString():  # parquet has no column of nulls alone
        source = _stage(source, "unbox")
    v = F.col("__ff_v")
    names, values = v["names"], v["values"]
    fault = node.isNotNull() & v["fault"].isNotNull()
    good = source.where(node.isNotNull() & v["fault"].isNull())
    if schema is not None:
        fields = [(F.get(values, F.lit(i)), f) for i, f in enumerate(schema.fields)]
        typed = [(*aligned(x, StringType(), f.dataType), f.name) for x, f in fields]
        lost = F.size(values) != len(fields)
        for _, gone, _ in typed:
            lost = lost | (F.lit(False) if gone is None else F.coalesce(gone, F.lit(False)))
        return source, F.struct(*[x.alias(n) for x, _, n in typed]), fault | F.coalesce(lost, F.lit(False))
    if options.get("withHeader"):
        # each row's values go by the row's own header; a name twice in one header names nothing
        fault = fault | F.coalesce((F.size(F.array_distinct(names)) < F.size(names)) | (F.size(names) != F.size(values)), F.lit(False))
        each = source.where(~fault & node.isNotNull()).select(F.posexplode(names).alias("i", "n"))
        found = each.groupBy("n").agg(F.min("i").alias("i")).orderBy("i", "n").limit(MOST_FIELDS + 1).collect()
        if len(found) > MOST_FIELDS:  # texts without a real header: a map, so that names don't pile up in the schema
            return source, F.map_from_arrays(names, values), fault
        at = [F.get(values, (F.array_position(names, r["n"]) - 1).cast("int")).alias(own)
              for r, own in zip(found, distinct_names([r["n"] for r in found]))]
    else:
        n = good.agg(F.max(F.size(values)).alias("n")).first()["n"] or 0
        fault = fault | F.coalesce(F.size(values) != n, F.lit(False))
        at = [F.get(values, F.lit(i)).alias(f"_c{i}") for i in range(n)]
    return source, F.struct(*at) if at else F.lit(None).cast("string"), fault


def unbox(frame: Frame, path: str, format: str, options: dict, ctx="", info="", stage=0, total=0) -> Frame:
    """Parse a string field in place (json or csv); texts that aren't just one value or record become error records."""
    from ..sources.jsontext import single
    from .choice import _fill, _resolve_mixed, _rewrite, _stage, infer_variant_type

    r = resolve(frame.df.schema, split_path(path))
    if r is None:
        raise KeyError(f"unbox: path {path!r} not found")
    parts, dtype, depth = r
    if depth:
        return _unbox_in_arrays(frame, path, parts, format.lower(), options, ErrorStage("unbox", ctx, info, None, stage, total))
    node = _node(parts)
    fmt = format.lower()
    with_schema = options.get("withSchema")
    schema = None
    if with_schema:
        schema = StructType.fromJson(json.loads(with_schema)) if isinstance(with_schema, str) and with_schema.strip().startswith("{") else parse_type(with_schema)

    new_choices = {}
    v = F.col("__ff_v")
    if fmt == "json":
        source = frame.df.withColumn("__ff_v", single(node))
        if schema is not None:
            value = F.from_json(node, schema)
        else:
            if "void" not in frame.df.schema.simpleString():  # parquet has no column of nulls alone
                source = _stage(source, "unbox")  # parsed once for the type, the values and the errors
            parsed = source.where(v.isNotNull())
            t = infer_variant_type(v, parsed)
            t = StringType() if t is None else bounded(_resolve_mixed(t, parsed, v, []))
            value = _fill(v, t)
            new_choices = {(f"{path}.{p}" if p else path): n for p, n in choice_paths(with_distinct_names(t)).items()}
        failed = node.isNotNull() & v.isNull()
    elif fmt == "csv":
        source, value, failed = _unbox_csv(frame, node, schema, options)
        value = F.when(node.isNotNull(), value)
    elif fmt == "avro":
        raise NotImplementedError("unbox avro needs the spark-avro package, which is not installed")
    else:
        raise ValueError(f"unbox: unknown format {format!r}")

    msg = F.when(failed, F.lit(f"cannot unbox {path} as {fmt}"))
    staged = source.withColumn("__ff_err", msg)
    bad = error_rows(staged, F.col("__ff_err"), "unbox", ctx, info, exclude=("__ff_err", "__ff_v"))
    good = _rewrite(staged.where(F.col("__ff_err").isNull()).drop("__ff_err"), parts, lambda e, d: value)
    if "__ff_v" in good.columns:
        good = good.drop("__ff_v")
    choices = dict(frame.choices)
    choices.update(new_choices)
    return frame._next(good, ErrorStage("unbox", ctx, info, bad, stage, total), choices)
