"""Row-level operators: split by comparisons, and Python record functions.

``split_rows`` and a ``Column`` filter stay inside Catalyst (pushed down,
code-generated). Python record functions run through ``mapInArrow``: Spark
ships Arrow batches to Python workers, we call the function per record and
hand back a batch with two extra columns (keep flag / error message), so good
rows and error rows are split by plain ``where`` clauses afterwards.
"""

from __future__ import annotations

import json
from functools import reduce
from typing import Callable

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, StringType, StructField, StructType

from ..errors import ErrorStage
from ..frame import Frame, FrameSet
from ..paths import get_path, resolve, split_path
from ..session import ship_package

_KEEP = "__ff_keep"
_ERR = "__ff_err"
_REC = "__ff_rec"


# ---------------------------------------------------------------------------
# split_rows

_OPS = {
    ">": lambda c, v: c > v,
    ">=": lambda c, v: c >= v,
    "<": lambda c, v: c < v,
    "<=": lambda c, v: c <= v,
    "=": lambda c, v: c == v,
    "==": lambda c, v: c == v,
    "!=": lambda c, v: c != v,
    "<>": lambda c, v: c != v,
}


def comparison_predicate(df: DataFrame, comparison_dict: dict, null_as_false: bool = True) -> Column:
    preds = []
    for path, comps in comparison_dict.items():
        r = resolve(df.schema, split_path(path))
        if r is None:
            raise KeyError(f"split_rows: path {path!r} not found")
        col = get_path(r[0])
        for op, value in comps.items():
            if op not in _OPS:
                raise ValueError(f"unknown comparison {op!r}")
            preds.append(_OPS[op](col, F.lit(value)))
    if not preds:
        return F.lit(True)
    p = reduce(lambda a, b: a & b, preds)
    return F.coalesce(p, F.lit(False)) if null_as_false else p


def split_rows(frame: Frame, comparison_dict, name1, name2, ctx="", info="", stage=0, total=0) -> FrameSet:
    """Rows meeting every comparison, and the rest (nulls compare false)."""
    # ``where`` drops null predicates, so the hit side uses the bare comparison
    # (parquet can take it as a pushed filter); the rest is its exact complement
    p = comparison_predicate(frame.df, comparison_dict)
    raw = comparison_predicate(frame.df, comparison_dict, null_as_false=False)
    hit = frame._next(frame.df.where(raw), ErrorStage("split_rows", ctx, info, None, stage, total), name=name1)
    rest = frame._next(frame.df.where(~p), ErrorStage("split_rows", ctx, info, None, stage, total), name=name2)
    return FrameSet({name1: hit, name2: rest}, frame.spark)


# ---------------------------------------------------------------------------
# Python record functions


class Record(dict):
    """A record handed to user functions: a dict with attribute access."""

    def __getattr__(self, key):
        try:
            v = self[key]
        except KeyError as e:
            raise AttributeError(key) from e
        return Record(v) if isinstance(v, dict) and not isinstance(v, Record) else v

    def __setattr__(self, key, value):
        self[key] = value


def _dump(rec) -> str:
    return json.dumps(rec, default=str, sort_keys=False)


def _arrow_schema(schema: StructType):
    from pyspark.sql.pandas.types import to_arrow_schema

    try:
        return to_arrow_schema(schema, timezone="UTC", prefers_large_types=False)
    except TypeError:
        return to_arrow_schema(schema)


def _run_once(tagged: DataFrame, stage: int, total: int, deterministic: bool) -> tuple[DataFrame, int | None]:
    """The tagged output of a Python function, and how many error records it holds, if that is known.

    A threshold has the errors counted before anything is written, and a
    function that isn't deterministic must not run twice: the output is then
    staged once, and good rows, error records and their count (observed during
    the write) all come from that one run. Else it stays a plan.
    """
    if deterministic and stage <= 0 and total <= 0:
        return tagged, None
    from ..session import scratch_dir

    told = Observation()
    path = scratch_dir(tagged.sparkSession, "python-step")
    tagged.observe(told, F.count(F.col(_ERR)).alias("errors")).write.mode("overwrite").parquet(path)
    return tagged.sparkSession.read.schema(tagged.schema).parquet(path), int(told.get["errors"])


def filter_rows(frame: Frame, f, ctx="", info="", stage=0, total=0, deterministic=True) -> Frame:
    """Keep records where ``f`` holds.

    ``f`` may be a Column or SQL text (kept in Catalyst, pushed down) or a
    Python predicate over a record. For a Python predicate, ``KeyError``,
    ``ValueError`` and ``TypeError`` drop the record; any other exception keeps
    it as an error record.
    """
    if isinstance(f, Column) or isinstance(f, str):
        cond = F.expr(f) if isinstance(f, str) else f
        return frame._next(frame.df.where(cond), ErrorStage("filter", ctx, info, None, stage, total))

    ship_package(frame.spark)
    in_schema = frame.df.schema
    out_schema = StructType(list(in_schema.fields) + [StructField(_KEEP, BooleanType()), StructField(_ERR, StringType())])

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            keep, err = [], []
            for rec in batch.to_pylist():
                try:
                    ok = bool(f(Record(rec)))
                    keep.append(ok)
                    err.append(None)
                except (KeyError, ValueError, TypeError):
                    keep.append(False)
                    err.append(None)
                except Exception as e:  # noqa: BLE001 - any other failure is an error record
                    keep.append(True)
                    err.append(str(e))
            yield pa.RecordBatch.from_arrays(
                list(batch.columns) + [pa.array(keep, pa.bool_()), pa.array(err, pa.string())],
                names=list(batch.schema.names) + [_KEEP, _ERR],
            )

    staged, known = _run_once(frame.df.mapInArrow(run, out_schema), stage, total, deterministic)
    good = staged.where(F.col(_KEEP) & F.col(_ERR).isNull()).drop(_KEEP, _ERR)
    bad = staged.where(F.col(_ERR).isNotNull()).select(
        F.lit("filter").alias("op"), F.lit(ctx).alias("transformation_ctx"), F.lit(info).alias("info"),
        F.col(_ERR).alias("message"), F.to_json(F.struct(*[F.col("`" + c + "`") for c in in_schema.names])).alias("record"),
    )
    return frame._next(good, ErrorStage("filter", ctx, info, bad, stage, total, known))


NO_RECORD = "function returned no record"


def map_rows(frame: Frame, f: Callable, schema=None, ctx="", info="", stage=0, total=0, deterministic=True, infer=False) -> Frame:
    """Apply ``f`` to every record; failures, empty results and fields outside the schema become error records.

    Spark needs the output schema up front; it defaults to the input schema.
    With ``infer`` it is found from the results: they are staged as JSON text
    and read as drifting JSON, so any record may come back and conflicting
    types become choices.
    """
    ship_package(frame.spark)
    if infer:
        return _map_inferred(frame, f, ctx, info, stage, total)
    out = schema if schema is not None else frame.df.schema
    if isinstance(out, str):
        from pyspark.sql.types import _parse_datatype_string

        out = _parse_datatype_string(out)
    names = out.names
    # an error record leaves every output field null
    wide = StructType([StructField(f.name, f.dataType, True) for f in out.fields] + [StructField(_ERR, StringType()), StructField(_REC, StringType())])
    arrow_out = _arrow_schema(wide)

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            rows = []
            for rec in batch.to_pylist():
                try:
                    res = f(Record(rec))
                    if res:
                        d = dict(res)
                        unknown = [n for n in d if n not in names]
                        if unknown:
                            raise KeyError(f"fields not in the output schema: {unknown}")
                        row = {n: d.get(n) for n in names}
                        row[_ERR] = None
                        row[_REC] = None
                    else:
                        row = {n: None for n in names}
                        row[_ERR] = NO_RECORD
                        row[_REC] = _dump(rec)
                except Exception as e:  # noqa: BLE001 - failure becomes an error record
                    row = {n: None for n in names}
                    row[_ERR] = str(e)
                    row[_REC] = _dump(rec)
                rows.append(row)
            try:
                yield pa.RecordBatch.from_pylist(rows, schema=arrow_out)
            except (pa.ArrowInvalid, pa.ArrowTypeError, TypeError, ValueError, OverflowError):
                # one bad value must not sink the batch: convert row by row
                fixed = []
                for row, rec in zip(rows, batch.to_pylist()):
                    try:
                        pa.RecordBatch.from_pylist([row], schema=arrow_out)
                        fixed.append(row)
                    except Exception as e:  # noqa: BLE001
                        bad = {n: None for n in names}
                        bad[_ERR] = f"result does not fit the output schema: {e}"
                        bad[_REC] = _dump(rec)
                        fixed.append(bad)
                yield pa.RecordBatch.from_pylist(fixed, schema=arrow_out)

    staged, known = _run_once(frame.df.mapInArrow(run, wide), stage, total, deterministic)
    good = staged.where(F.col(_ERR).isNull()).drop(_ERR, _REC)
    bad = staged.where(F.col(_ERR).isNotNull()).select(
        F.lit("map").alias("op"), F.lit(ctx).alias("transformation_ctx"), F.lit(info).alias("info"),
        F.col(_ERR).alias("message"), F.col(_REC).alias("record"),
    )
    return frame._next(good, ErrorStage("map", ctx, info, bad, stage, total, known), choices={})


def _map_inferred(frame: Frame, f: Callable, ctx, info, stage, total) -> Frame:
    from ..session import scratch_dir
    from .choice import frame_from_json_text

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            out, err, record = [], [], []
            for rec in batch.to_pylist():
                try:
                    res = f(Record(rec))
                    if not res:
                        raise ValueError(NO_RECORD)
                    out.append(_dump(dict(res)))
                    err.append(None)
                    record.append(None)
                except Exception as e:  # noqa: BLE001 - failure becomes an error record
                    out.append(None)
                    err.append(str(e))
                    record.append(_dump(rec))
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.string()) for x in (out, err, record)], names=["value", _ERR, _REC])

    path = scratch_dir(frame.spark, "map")
    frame.df.mapInArrow(run, f"value string, {_ERR} string, {_REC} string").write.mode("overwrite").parquet(path)
    done = frame.spark.read.parquet(path)
    bad = done.where(F.col(_ERR).isNotNull()).select(
        F.lit("map").alias("op"), F.lit(ctx).alias("transformation_ctx"), F.lit(info).alias("info"),
        F.col(_ERR).alias("message"), F.col(_REC).alias("record"))
    found = frame_from_json_text(done.where(F.col(_ERR).isNull()), "value", ctx, "map")
    return Frame(found.df, frame.name, [*frame.errors, *found.errors, ErrorStage("map", ctx, info, bad, stage, total)], found.choices)


#: Keys by which a partition function hands over an error record (fixed values), and what record it tells of.
IS_ERROR, ERROR_MESSAGE, RECORD = "isError", "errorMessage", "record"


def map_partitions(frame: Frame, f: Callable, schema=None, ctx="", info="", stage=0, total=0, deterministic=True) -> Frame:
    """``f(partition_index, iterator_of_records) -> iterator_of_records``.

    What comes back is a record of the output schema; a record that has fields
    outside it, or values that don't fit it, is an error record. So is one with
    a true ``isError``: its ``errorMessage`` is the message, and its ``record``
    (or else its other fields) the record told of. An exception ends the job,
    since the function can't go on after it.
    """
    ship_package(frame.spark)
    out = schema if schema is not None else frame.df.schema
    if isinstance(out, str):
        from pyspark.sql.types import _parse_datatype_string

        out = _parse_datatype_string(out)
    names = out.names
    wide = StructType([StructField(x.name, x.dataType, True) for x in out.fields] + [StructField(_ERR, StringType()), StructField(_REC, StringType())])
    arrow_out = _arrow_schema(wide)

    def told(record, message) -> dict:
        return {**dict.fromkeys(names), _ERR: message, _REC: _dump(record)}

    def checked(result) -> dict:
        given = dict(result)
        if IS_ERROR not in names and given.pop(IS_ERROR, False):
            message = given.pop(ERROR_MESSAGE, None)
            return told(given.get(RECORD, given), "" if message is None else str(message))
        unknown = [n for n in given if n not in names]
        if unknown:
            return told(given, f"fields not in the output schema: {unknown}")
        return {**{n: given.get(n) for n in names}, _ERR: None, _REC: None}

    def batch(rows):
        import pyarrow as pa

        try:
            return pa.RecordBatch.from_pylist(rows, schema=arrow_out)
        except (pa.ArrowInvalid, pa.ArrowTypeError, TypeError, ValueError, OverflowError):
            if len(rows) == 1:
                record = {n: rows[0][n] for n in names}
                return batch([told(record, "result does not fit the output schema")])
            # halves, so that a few misfits cost a few more conversions
            return pa.Table.from_batches([batch(rows[:len(rows) // 2]), batch(rows[len(rows) // 2:])]).combine_chunks().to_batches()[0]

    def run(batches):
        from pyspark import TaskContext

        def records():
            for b in batches:
                for rec in b.to_pylist():
                    yield Record(rec)

        rows = []
        for result in f(TaskContext.get().partitionId(), records()):
            rows.append(checked(result))
            if len(rows) >= 4096:
                yield batch(rows)
                rows = []
        if rows:
            yield batch(rows)

    done, known = _run_once(frame.df.mapInArrow(run, wide), stage, total, deterministic)
    bad = done.where(F.col(_ERR).isNotNull()).select(
        F.lit("map_partitions").alias("op"), F.lit(ctx).alias("transformation_ctx"), F.lit(info).alias("info"),
        F.col(_ERR).alias("message"), F.col(_REC).alias("record"))
    good = done.where(F.col(_ERR).isNull()).drop(_ERR, _REC)
    return frame._next(good, ErrorStage("map_partitions", ctx, info, bad, stage, total, known), choices={})
