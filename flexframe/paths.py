"""Dotted paths into nested columns, and projections that edit them.

A path is a dotted string; a name that itself contains a dot is written in
backticks (``a.`b.c`.d``). A path passes through an array of structs without
any marker (``orders.items.sku`` reaches ``sku`` inside every element of
``items``) and never enters a map.

Every edit here builds Column expressions only (``struct``, ``transform``,
``getField``), so Catalyst keeps nested-schema pruning and whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, StructType


def split_path(path: str) -> list[str]:
    """``'a.`b.c`.d'`` -> ``['a', 'b.c', 'd']``."""
    parts: list[str] = []
    cur: list[str] = []
    quoted = False
    i = 0
    while i < len(path):
        ch = path[i]
        if ch == "`":
            if quoted and i + 1 < len(path) and path[i + 1] == "`":
                cur.append("`")
                i += 2
                continue
            quoted = not quoted
        elif ch == "." and not quoted:
            parts.append("".join(cur))
            cur = []
        else:
            cur.append(ch)
        i += 1
    if quoted:
        raise ValueError(f"unbalanced backtick in path {path!r}")
    parts.append("".join(cur))
    if any(p == "" for p in parts):
        raise ValueError(f"empty segment in path {path!r}")
    return parts


def quote(name: str) -> str:
    """Quote one segment if it needs it."""
    if "." in name or "`" in name:
        return "`" + name.replace("`", "``") + "`"
    return name


def join_path(parts: list[str]) -> str:
    return ".".join(quote(p) for p in parts)


def top(name: str) -> Column:
    """Top-level column reference that is safe for any name."""
    return F.col("`" + name.replace("`", "``") + "`")


def _field(dtype: StructType, name: str, case_sensitive: bool = True):
    for f in dtype.fields:
        if f.name == name:
            return f
    if not case_sensitive:
        low = name.lower()
        for f in dtype.fields:
            if f.name.lower() == low:
                return f
    return None


def resolve(schema: StructType, parts: list[str], case_sensitive: bool = True):
    """Return ``(real_parts, dtype, array_depth)`` or ``None`` if absent."""
    dtype: DataType = schema
    real: list[str] = []
    depth = 0
    for p in parts:
        while isinstance(dtype, ArrayType):
            dtype = dtype.elementType
            depth += 1
        if not isinstance(dtype, StructType):
            return None
        f = _field(dtype, p, case_sensitive)
        if f is None:
            return None
        real.append(f.name)
        dtype = f.dataType
    return real, dtype, depth


def leaf_paths(dtype: DataType, prefix: list[str] | None = None) -> list[list[str]]:
    """Every leaf path (through structs and arrays of structs)."""
    prefix = prefix or []
    while isinstance(dtype, ArrayType):
        dtype = dtype.elementType
    if isinstance(dtype, StructType) and (prefix == [] or dtype.fields):
        out: list[list[str]] = []
        for f in dtype.fields:
            out.extend(leaf_paths(f.dataType, prefix + [f.name]))
        return out
    return [prefix]


# ---------------------------------------------------------------------------
# tree rebuild


def _tree(paths: list[list[str]]) -> dict:
    """Nested dict; ``True`` marks a whole node."""
    root: dict = {}
    for parts in paths:
        node = root
        for p in parts[:-1]:
            nxt = node.get(p)
            if nxt is True:
                break
            node = node.setdefault(p, {})
        else:
            node[parts[-1]] = True
    return root


def _keep_null(src: Column, built: Column) -> Column:
    return F.when(src.isNull(), F.lit(None)).otherwise(built)


def _select_expr(src: Column, dtype: DataType, tree: dict):
    """Keep only the fields in ``tree``; ``None`` when nothing is left."""
    if isinstance(dtype, ArrayType):
        inner_type = dtype.elementType
        probe = _select_expr(F.lit(None), inner_type, tree)
        if probe is None:
            return None
        return F.transform(src, lambda e: _select_expr(e, inner_type, tree))
    if not isinstance(dtype, StructType):
        return None
    cols = []
    for f in dtype.fields:
        if f.name not in tree:
            continue
        sub = tree[f.name]
        child = src.getField(f.name)
        if sub is True:
            cols.append(child.alias(f.name))
        else:
            e = _select_expr(child, f.dataType, sub)
            if e is not None:
                cols.append(e.alias(f.name))
    if not cols:
        return None
    return _keep_null(src, F.struct(*cols))


def _drop_expr(src: Column, dtype: DataType, tree: dict):
    """Remove the fields in ``tree``; ``None`` when the node becomes empty."""
    if isinstance(dtype, ArrayType):
        inner_type = dtype.elementType
        if _drop_expr(F.lit(None), inner_type, tree) is None:
            return None
        return F.transform(src, lambda e: _drop_expr(e, inner_type, tree))
    if not isinstance(dtype, StructType):
        return src
    cols = []
    for f in dtype.fields:
        child = src.getField(f.name)
        sub = tree.get(f.name)
        if sub is True:
            continue
        if sub is None:
            cols.append(child.alias(f.name))
        else:
            e = _drop_expr(child, f.dataType, sub)
            if e is not None:
                cols.append(e.alias(f.name))
    if not cols:
        return None
    return _keep_null(src, F.struct(*cols))


def select_paths(df: DataFrame, paths: list[str]) -> DataFrame:
    """Project to the given paths, keeping their nesting; absent paths are skipped."""
    found = []
    for p in paths:
        r = resolve(df.schema, split_path(p))
        if r is not None:
            found.append(r[0])
    tree = _tree(found)
    cols = []
    for f in df.schema.fields:
        if f.name not in tree:
            continue
        sub = tree[f.name]
        if sub is True:
            cols.append(top(f.name))
        else:
            e = _select_expr(top(f.name), f.dataType, sub)
            if e is not None:
                cols.append(e.alias(f.name))
    return df.select(*cols)


def drop_paths(df: DataFrame, paths: list[str]) -> DataFrame:
    """Remove the given paths; absent paths are ignored; emptied structs go too."""
    found = []
    for p in paths:
        r = resolve(df.schema, split_path(p))
        if r is not None:
            found.append(r[0])
    if not found:
        return df
    tree = _tree(found)
    cols = []
    for f in df.schema.fields:
        sub = tree.get(f.name)
        if sub is True:
            continue
        if sub is None:
            cols.append(top(f.name))
        else:
            e = _drop_expr(top(f.name), f.dataType, sub)
            if e is not None:
                cols.append(e.alias(f.name))
    return df.select(*cols)


def _rename_in(src: Column, dtype: DataType, parts: list[str], new_name: str) -> Column:
    if isinstance(dtype, ArrayType):
        inner = dtype.elementType
        return F.transform(src, lambda e: _rename_in(e, inner, parts, new_name))
    assert isinstance(dtype, StructType)
    cols = []
    for f in dtype.fields:
        child = src.getField(f.name)
        if f.name == parts[0]:
            if len(parts) == 1:
                cols.append(child.alias(new_name))
            else:
                cols.append(_rename_in(child, f.dataType, parts[1:], new_name).alias(f.name))
        else:
            cols.append(child.alias(f.name))
    return _keep_null(src, F.struct(*cols))


def _set_in(src: Column | None, dtype: DataType | None, parts: list[str], value: Column) -> Column:
    """Put ``value`` at ``parts`` below a struct (creating structs on the way)."""
    if len(parts) == 1:
        if src is None:
            return F.struct(value.alias(parts[0]))
        return src.withField(parts[0], value)
    head = parts[0]
    child_type = None
    if isinstance(dtype, StructType):
        fld = _field(dtype, head)
        child_type = fld.dataType if fld else None
    child = src.getField(head) if (src is not None and child_type is not None) else None
    if child_type is not None and not isinstance(child_type, StructType):
        raise ValueError(f"cannot place a field below non-struct {head!r}")
    inner = _set_in(child, child_type, parts[1:], value)
    if src is None:
        return F.struct(inner.alias(head))
    return src.withField(head, inner)


def _gathered(expr: Column, dtype: DataType, rest: list[str]) -> Column:
    """What a path names below ``expr``; through arrays, all their values."""
    if rest and isinstance(dtype, ArrayType):
        return F.transform(expr, lambda e: _gathered(e, dtype.elementType, rest))
    if not rest:
        return expr
    return _gathered(expr.getField(rest[0]), dtype[rest[0]].dataType, rest[1:])


def rename_path(df: DataFrame, old: str, new: str) -> DataFrame:
    """Rename or move a node; the new name is a full path. Missing old path: no change.

    A field that is moved out of an array becomes an array of its values, one
    for each element (nested arrays stay nested).
    """
    r = resolve(df.schema, split_path(old))
    if r is None:
        return df
    old_parts, _, depth = r
    new_parts = split_path(new)
    if old_parts == new_parts:
        return df
    taken = resolve(df.schema, new_parts)
    if taken is not None and taken[0] != old_parts:
        raise ValueError(f"cannot rename {old} to {new}: that field is there already")
    if old_parts[:-1] == new_parts[:-1]:
        if len(old_parts) == 1:
            return df.withColumnRenamed(old_parts[0], new_parts[0])
        head = old_parts[0]
        cols = []
        for f in df.schema.fields:
            if f.name == head:
                cols.append(_rename_in(top(head), f.dataType, old_parts[1:], new_parts[-1]).alias(head))
            else:
                cols.append(top(f.name))
        return df.select(*cols)
    value = _gathered(top(old_parts[0]), _field(df.schema, old_parts[0]).dataType, old_parts[1:])
    moved = drop_paths(df.withColumn("__ff_move", value), [old])
    if len(new_parts) == 1:
        return moved.withColumnRenamed("__ff_move", new_parts[0])
    head = new_parts[0]
    head_field = _field(moved.schema, head)
    val = F.col("__ff_move")
    if head_field is None:
        built = _set_in(None, None, new_parts[1:], val)
        return moved.withColumn(head, built).drop("__ff_move")
    built = _set_in(top(head), head_field.dataType, new_parts[1:], val)
    return moved.withColumn(head, built).drop("__ff_move")


def get_path(parts: list[str]) -> Column:
    """Column for a path that does not cross an array."""
    c = top(parts[0])
    for p in parts[1:]:
        c = c.getField(p)
    return c
