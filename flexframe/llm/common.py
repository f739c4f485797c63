"""Small helpers shared by the operators of this package."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_dir

#: One character of a word: anything but space, tab, \\n, \\v, \\f, \\r.
WORD = r"[^\x20\x09-\x0D]+"
#: Removes the shuffle files of a query as it ends.
CLEAN = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
BLANKS = " \t\n\x0b\x0c\r"


def id_text(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id`` and ``text`` alone (null text: empty), so no other column can clash."""
    return df.select(df[id_col].alias("doc_id"), F.coalesce(df[text_col], F.lit("")).alias("text"))


def bind(value: Column, body) -> Column:
    """``body(value)`` with ``value`` evaluated once, also inside lambda functions."""
    return F.element_at(F.transform(F.array(value), body), 1)


def staged(spark: SparkSession, df: DataFrame, label: str) -> DataFrame:
    """``df`` written once to a fresh folder under the shared checkpoint folder, and read back.

    This cuts lineage: a lost executor costs a re-read of the table, not a rerun.
    """
    path = scratch_dir(spark, label)
    # the shuffle files behind the table aren't needed once it is written
    held = spark.conf.get(CLEAN, "false")
    spark.conf.set(CLEAN, "true")
    try:
        df.write.mode("overwrite").parquet(path)
    finally:
        spark.conf.set(CLEAN, held)
    return spark.read.schema(df.schema).parquet(path)


#: Keys that hold more than one row in so many are joined by broadcast.
HEAVY = 1000


def lookup(df: DataFrame, table: DataFrame, on: list[str], heavy: int = HEAVY) -> DataFrame:
    """``df`` left-joined with ``table``, which has at most one row per key ``on``; no hot key reaches one task.

    Keys that hold more than 1/``heavy`` of the rows of ``df`` can't number more
    than ``heavy``, so their rows of ``table`` are broadcast; the other keys are
    joined as Spark plans it. Rows with a null in the key find nothing. Both
    inputs are read more than once: give staged tables.
    """
    whole = F.lit(True)
    for c in on:
        whole &= F.col(c).isNotNull()
    keyed = df.where(whole)
    least = keyed.count() / heavy
    hot = keyed.groupBy(*on).count().where(F.col("count") > least).select(*on)
    added = [F.lit(None).cast(f.dataType).alias(f.name) for f in table.schema.fields if f.name not in on]
    common = keyed.join(F.broadcast(hot), on, "left_semi").join(F.broadcast(table.join(hot, on, "left_semi")), on, "left")
    rest = keyed.join(F.broadcast(hot), on, "left_anti").join(table, on, "left")
    return common.unionByName(rest).unionByName(df.where(~whole).select("*", *added))


class Memo(dict):
    """Values by key, made when they are first asked for; holds two generations of ``most`` entries.

    When the young generation is full it becomes the old one, and the old one
    goes; what is asked for again moves back to the young one. Long keys are
    not remembered.
    """

    def __init__(self, make, most: int, longest: int):
        super().__init__()
        self.make, self.most, self.longest, self.old = make, most, longest, {}

    def __missing__(self, key):
        value = self.old.get(key)
        if value is None:
            value = self.make(key)
            if len(key) > self.longest:
                return value
        if len(self) >= self.most:
            self.old = dict(self)
            self.clear()
        self[key] = value
        return value
