"""Error records: bad rows travel beside the good ones as a DataFrame.

Each fallible step builds one intermediate with a nullable message column.
Good rows are those with no message; the rest become error rows
``(op, transformation_ctx, info, message, record)`` where ``record`` is the
original row as JSON text. Both sides are lazy plans over the same input.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

ERROR_SCHEMA = "op string, transformation_ctx string, info string, message string, record string"


class ErrorThresholdExceeded(RuntimeError):
    pass


@dataclass(frozen=True, eq=False)
class ErrorStage:
    op: str
    ctx: str
    info: str
    df: DataFrame | None
    stage_threshold: int = 0
    total_threshold: int = 0
    known: int | None = None  # the number of its error records, where the step counted them


def record_json(df: DataFrame, exclude: tuple[str, ...] = ()) -> Column:
    cols = [F.col("`" + c + "`") for c in df.columns if c not in exclude]
    return F.to_json(F.struct(*cols))


def error_rows(df: DataFrame, message: Column, op: str, ctx: str, info: str, exclude: tuple[str, ...] = ()) -> DataFrame:
    """Error rows from ``df`` where ``message`` is not null."""
    return df.where(message.isNotNull()).select(
        F.lit(op).alias("op"),
        F.lit(ctx).alias("transformation_ctx"),
        F.lit(info).alias("info"),
        message.cast("string").alias("message"),
        record_json(df, exclude).alias("record"),
    )


def empty_errors(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], ERROR_SCHEMA)


def unique_stages(stages: list[ErrorStage]) -> list[ErrorStage]:
    """Each stage once, in order: frames that were split and joined again share their earlier stages."""
    return list({id(s): s for s in stages}.values())


def stage_counts(stages: list[ErrorStage]) -> list[int]:
    """Error count of every stage: those known already, and the others in one job (a union and one small aggregate)."""
    indexed = [(i, s.df) for i, s in enumerate(stages) if s.df is not None and s.known is None]
    counts = [s.known or 0 for s in stages]
    if not indexed:
        return counts
    union = None
    for i, d in indexed:
        part = d.select(F.lit(i).alias("stage"))
        union = part if union is None else union.unionAll(part)
    for row in union.groupBy("stage").count().collect():
        counts[row["stage"]] = row["count"]
    return counts


def check_thresholds(stages: list[ErrorStage]) -> None:
    """Raise when a stage (or the running total) reaches its threshold; 0 means no limit."""
    if not any(s.stage_threshold > 0 or s.total_threshold > 0 for s in stages):
        return
    counts = stage_counts(stages)
    total = 0
    for s, n in zip(stages, counts):
        total += n
        if s.stage_threshold > 0 and n >= s.stage_threshold:
            raise ErrorThresholdExceeded(
                f"{s.op} ({s.ctx or 'no ctx'}): {n} errors, stage threshold {s.stage_threshold}"
            )
        if s.total_threshold > 0 and total >= s.total_threshold:
            raise ErrorThresholdExceeded(
                f"{s.op} ({s.ctx or 'no ctx'}): {total} errors so far, total threshold {s.total_threshold}"
            )
