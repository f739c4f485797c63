"""Array / struct helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def explode_with_index(col) -> Column:
    """One row per element with columns ``index`` (0-based) and ``val``."""
    return F.posexplode(_col(col)).alias("index", "val")


def named_struct(*cols) -> Column:
    """Struct from columns; a single list or set of columns is accepted."""
    if len(cols) == 1 and isinstance(cols[0], (list, set, tuple)):
        cols = tuple(cols[0])
    return F.struct(*[_col(c) for c in cols])


def replace_array_element(src, replacement, index) -> Column:
    """Copy of the array with the element at 0-based ``index`` replaced."""
    idx = index if isinstance(index, Column) else F.lit(index)
    repl = replacement if isinstance(replacement, Column) else F.lit(replacement)
    return F.transform(_col(src), lambda x, i: F.when(i == idx, repl).otherwise(x))


explodeWithIndex = explode_with_index
namedStruct = named_struct
replaceArrayElement = replace_array_element
