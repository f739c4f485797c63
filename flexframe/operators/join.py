"""Equality join of two frames on one or more path pairs.

Inner join; null keys never match. Right-side columns whose names clash with
left-side ones get the suffix ``_r`` (both key columns are kept). The join
strategy is left to Catalyst and AQE: a side is broadcast only when Spark's
own size estimate is under ``spark.sql.autoBroadcastJoinThreshold``, otherwise
it is a sort-merge join on the keys, with AQE splitting skewed partitions.

AQE splits by bytes and only where a join stands alone. With ``spread=n`` hot
keys are dealt out beforehand: keys that hold more than 1/(4n) of a side's rows
(found by ``approx_top_k``, a sketch of fixed size) go to n tasks by a hash of
the whole row, and the other side's rows of these keys are repeated n times.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DoubleType, NumericType, StringType

from ..errors import ErrorStage, unique_stages
from ..frame import Frame
from ..paths import resolve, split_path, top

SUFFIX = "_r"
#: Hot keys that are looked for on each side.
MOST_HOT = 100


def _common(a: DataType, b: DataType) -> DataType:
    """The type under which two keys are hashed: their own, or double where Spark compares unlike numbers."""
    return a if a == b else DoubleType() if isinstance(a, NumericType) and isinstance(b, NumericType) else StringType()


def _key(df, alias, path):
    r = resolve(df.schema, split_path(path))
    if r is None:
        raise KeyError(f"join key {path!r} not found")
    parts, _, depth = r
    if depth:
        raise ValueError(f"join key {path!r} is inside an array")
    c = F.col(f"{alias}.`{parts[0]}`")
    for p in parts[1:]:
        c = c.getField(p)
    return c


def _hot(df, key) -> dict[int, int]:
    """Row counts (estimated) of the hashed keys that are met most often, and of all rows under ``None``."""
    told = df.select(key.alias("k")).agg(F.expr(f"approx_top_k(k, {MOST_HOT}, {MOST_HOT * 50})").alias("top"), F.count(F.lit(1)).alias("n")).first()
    return {None: told["n"], **{x["item"]: x["count"] for x in told["top"] or []}}


def _dealt(left, right, left_key, right_key, spread: int):
    """Both sides with a column ``__ff_salt``; null where neither side has hot keys."""
    counts = [_hot(left, left_key), _hot(right, right_key)]
    hot = [{k for k, n in c.items() if k is not None and n * 4 * spread > c[None]} for c in counts]
    # a key that is hot on both sides is dealt out where it has more rows
    mine = {k for k in hot[0] if k not in hot[1] or counts[0][k] >= counts[1][k]}
    theirs = hot[1] - mine
    if not mine and not theirs:
        return None
    every = F.sequence(F.lit(0), F.lit(spread - 1))

    def salted(df, key, own, other):
        row = F.pmod(F.xxhash64(F.to_json(F.struct(*[top(c) for c in df.columns]))), F.lit(spread)).cast("int")
        salts = F.when(key.isin(*own), F.array(row)) if own else F.when(F.lit(False), F.array(row))
        if other:
            salts = salts.when(key.isin(*other), every)
        return df.select("*", F.explode(salts.otherwise(F.array(F.lit(0)))).alias("__ff_salt"))

    return salted(left, left_key, mine, theirs), salted(right, right_key, theirs, mine)


def join(frame1: Frame, paths1, paths2, frame2: Frame, ctx="", info="", stage=0, total=0, spread=0) -> Frame:
    if isinstance(paths1, str):
        paths1 = [paths1]
    if isinstance(paths2, str):
        paths2 = [paths2]
    if len(paths1) != len(paths2) or not paths1:
        raise ValueError("join needs the same non-zero number of keys on both sides")
    left_names = set(frame1.df.columns)
    renames = {}
    right = frame2.df
    for c in right.columns:
        if c in left_names:
            new = c + SUFFIX
            while new in left_names or new in right.columns:
                new += SUFFIX
            renames[c] = new
    if renames:
        right = right.select(*[top(c).alias(renames.get(c, c)) for c in right.columns])
    right_paths = []
    for p in paths2:
        parts = split_path(p)
        parts[0] = renames.get(parts[0], parts[0])
        right_paths.append(".".join(f"`{x}`" if "." in x else x for x in parts))
    left = frame1.df
    pairs = [(_key(left, "__ff_l", a), _key(right, "__ff_r", b)) for a, b in zip(paths1, right_paths)]
    cond = reduce(lambda a, b: a & b, [a == b for a, b in pairs])
    if spread > 1:
        # one hash for both sides: equal keys have equal texts only under one type
        common = [_common(left.alias("__ff_l").select(a).schema[0].dataType, right.alias("__ff_r").select(b).schema[0].dataType) for a, b in pairs]
        hashed = [F.xxhash64(*[k[i].cast(t) for k, t in zip(pairs, common)]) for i in (0, 1)]
        dealt = _dealt(left.alias("__ff_l"), right.alias("__ff_r"), *hashed, int(spread))
        if dealt is not None:
            left, right = dealt
            cond = cond & (F.col("__ff_l.__ff_salt") == F.col("__ff_r.__ff_salt"))
    l, r = left.alias("__ff_l"), right.alias("__ff_r")
    out = l.join(r, cond, "inner").select(
        *[F.col(f"__ff_l.`{c}`").alias(c) for c in frame1.df.columns],
        *[F.col(f"__ff_r.`{c}`").alias(c) for c in right.columns if c != "__ff_salt"],
    )
    choices = dict(frame1.choices)
    for p, names in frame2.choices.items():
        parts = split_path(p)
        parts[0] = renames.get(parts[0], parts[0])
        choices[".".join(parts)] = names
    errors = unique_stages(frame1.errors + frame2.errors) + [ErrorStage("join", ctx, info, None, stage, total)]
    return Frame(out, frame1.name + frame2.name, errors, choices)
