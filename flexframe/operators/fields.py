"""Projection by path: select, drop, rename, split columns, drop all-null fields."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StructType

from ..errors import ErrorStage
from ..frame import Frame, FrameSet
from ..paths import drop_paths, join_path, rename_path, resolve, select_paths, split_path, top


def _as_list(paths):
    return [paths] if isinstance(paths, str) else list(paths)


def keep_choices(choices: dict, df) -> dict:
    """Choice marks whose path still exists after a projection."""
    out = {}
    for p, names in choices.items():
        if resolve(df.schema, split_path(p)) is not None:
            out[p] = names
    return out


def select_fields(frame: Frame, paths, ctx="", info="", stage=0, total=0) -> Frame:
    df = select_paths(frame.df, _as_list(paths))
    return frame._next(df, ErrorStage("select_fields", ctx, info, None, stage, total), keep_choices(frame.choices, df))


def drop_fields(frame: Frame, paths, ctx="", info="", stage=0, total=0) -> Frame:
    df = drop_paths(frame.df, _as_list(paths))
    return frame._next(df, ErrorStage("drop_fields", ctx, info, None, stage, total), keep_choices(frame.choices, df))


def rename_field(frame: Frame, old: str, new: str, ctx="", info="", stage=0, total=0) -> Frame:
    df = rename_path(frame.df, old, new)
    r = resolve(frame.df.schema, split_path(old))
    choices = {}
    if r is not None:
        old_p = join_path(r[0])
        for p, names in frame.choices.items():
            if p == old_p:
                choices[new] = names
            elif p.startswith(old_p + "."):
                choices[new + p[len(old_p):]] = names
            else:
                choices[p] = names
    else:
        choices = dict(frame.choices)
    return frame._next(df, ErrorStage("rename_field", ctx, info, None, stage, total), keep_choices(choices, df))


def split_fields(frame: Frame, paths, name1, name2, ctx="", info="", stage=0, total=0) -> FrameSet:
    """Two frames over the same input: the given paths, and everything else."""
    paths = _as_list(paths)
    picked = select_fields(frame, paths, ctx, info, stage, total)
    rest = drop_fields(frame, paths, ctx, info, stage, total)
    picked.name, rest.name = name1, name2
    return FrameSet({name1: picked, name2: rest}, frame.spark)


# ---------------------------------------------------------------------------
# drop_null_fields: one aggregate finds every leaf that never holds a value.


def _leaves(dtype, parts, via_array):
    """Yield (parts, crosses_array) for every leaf."""
    if isinstance(dtype, StructType) and dtype.fields:
        for f in dtype.fields:
            yield from _leaves(f.dataType, parts + [f.name], via_array)
    elif isinstance(dtype, ArrayType) and isinstance(dtype.elementType, StructType) and parts:
        yield from _leaves(dtype.elementType, parts, True)
    elif isinstance(dtype, StructType):
        return
    else:
        yield parts, via_array


def _present(schema: StructType, parts: list[str]):
    """Boolean column: this row holds a non-null value at ``parts``."""

    def walk(expr, dtype, rest):
        if not rest:
            return expr.isNotNull()
        if isinstance(dtype, ArrayType):
            inner = dtype.elementType
            return F.coalesce(F.exists(expr, lambda e: walk(e, inner, rest)), F.lit(False))
        f = next(x for x in dtype.fields if x.name == rest[0])
        return walk(expr.getField(rest[0]), f.dataType, rest[1:])

    head = next(x for x in schema.fields if x.name == parts[0])
    return walk(top(parts[0]), head.dataType, parts[1:])


def null_field_paths(df) -> list[str]:
    """Paths whose data never holds a value (their data-derived type is null)."""
    leaves = list(_leaves(df.schema, [], False))
    if not leaves:
        return []
    aggs = []
    for i, (parts, via_array) in enumerate(leaves):
        if via_array:
            aggs.append(F.count_if(_present(df.schema, parts)).alias(f"c{i}"))
        else:
            col = top(parts[0])
            for p in parts[1:]:
                col = col.getField(p)
            aggs.append(F.count(col).alias(f"c{i}"))
    row = df.agg(*aggs).collect()[0]
    return [join_path(parts) for i, (parts, _) in enumerate(leaves) if row[f"c{i}"] == 0]


def drop_null_fields(frame: Frame, ctx="", info="", stage=0, total=0) -> Frame:
    paths = null_field_paths(frame.df)
    out = drop_fields(frame, paths, ctx, info, stage, total)
    out.errors[-1] = ErrorStage("drop_null_fields", ctx, info, None, stage, total)
    return out
