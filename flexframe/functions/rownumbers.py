"""Dense row numbers without bringing all rows into one partition."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import scratch_dir

#: ``monotonically_increasing_id``: the partition in the upper bits, the place in it in the lower 33.
_PLACE_BITS = 33


def with_row_numbers(df: DataFrame, name: str = "row") -> DataFrame:
    """``df`` with a column that numbers its rows 0, 1, 2, ... without gaps.

    Rows are written once with their partition and place in it, so that the
    numbers stay the same in every later job and after a lost executor. The
    rows of each partition are counted (one small row each), and a row's number
    is its place plus the count of the partitions before.
    """
    if name in df.columns:
        raise ValueError(f"column {name} is there already")
    path = scratch_dir(df.sparkSession, "row-numbers")
    df.withColumn("__ff_at", F.monotonically_increasing_id()).write.mode("overwrite").parquet(path)
    placed = df.sparkSession.read.parquet(path)
    part = F.shiftrightunsigned("__ff_at", _PLACE_BITS)
    before, starts = 0, []
    for r in placed.groupBy(part.alias("part")).count().orderBy("part").collect():
        starts.append((r["part"], before))
        before += r["count"]
    offsets = df.sparkSession.createDataFrame(starts, "__ff_part long, __ff_start long")
    place = F.col("__ff_at").bitwiseAND(F.lit((1 << _PLACE_BITS) - 1))
    return (placed.withColumn("__ff_part", part).join(offsets, "__ff_part")
            .withColumn(name, F.col("__ff_start") + place).drop("__ff_part", "__ff_start", "__ff_at"))
