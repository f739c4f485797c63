"""Sharding by a hierarchical weighted hash tree.

Shards are leaves of a tree: region, rack, shard. At each level a document
draws a hash for every child; the draw is shaped by the child's weight (the
sum of the leaves below) so that a child wins with probability weight / total,
and a change of weight only moves documents into or out of the subtrees whose
weights changed. The descent is a chain of Spark expressions over bounded
tables (one row a tree node), no shuffle.

The law is ``key``: a document's place depends on its id and the tree alone.
A shard that is added opens a region of its own, so no weight inside the other
regions changes and documents move only into the new shard. ``grow`` can also
put a shard into a given rack; then movement is confined to the subtrees of
that region and rack.

Defined results: a null id draws as the empty string; equal ids share a shard;
a null text has size 16 and the CRC of the empty string; texts of any length
count whole; repeated rows each get their own slot; other columns are ignored;
an empty table gives an empty result.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import id_text

#: Rows that one slot-numbering group holds on average.
GROUP_ROWS = 4096

Tree = dict[str, dict[str, dict[int, float]]]


def tree(shards: int, per_rack: int = 5, racks: int = 2) -> Tree:
    """A tree of ``shards`` equal leaves, filled rack by rack, region by region."""
    out: Tree = {}
    for s in range(shards):
        rack = s // per_rack
        out.setdefault(f"region{rack // racks}", {}).setdefault(f"rack{rack % racks}", {})[s] = 1.0
    return out


def grow(layout: Tree, weight: float = 1.0, region: str | None = None, rack: str | None = None) -> Tree:
    """``layout`` with one more shard, in a region of its own unless a place is given."""
    out = {a: {b: dict(leaves) for b, leaves in racks.items()} for a, racks in layout.items()}
    new = 1 + max((s for racks in out.values() for leaves in racks.values() for s in leaves), default=-1)
    region = region or f"region+{new}"
    out.setdefault(region, {}).setdefault(rack or "rack0", {})[new] = weight
    return out


def _draw(key: Column, child: Column) -> Column:
    """ln(u) / weight for a uniform u of (key, path); the largest draw wins."""
    # 52 bits, off zero: exact as double
    bits = F.conv(F.substring(F.md5(F.concat(key, F.lit("/"), child["path"])), 1, 13), 16, 10).cast("double")
    return F.log((bits + 0.5) / float(1 << 52)) / child["weight"]


def _choose(key: Column, children: Column) -> Column:
    """The number of the child with the largest draw (ties: the larger number, a fixed order)."""
    draws = F.transform(children, lambda c: F.struct(_draw(key, c).alias("draw"), c["number"].alias("number")))
    return F.array_max(draws)["number"]


def _node(children: list[tuple[str, float, int]]) -> Column:
    return F.array(*[F.struct(F.lit(p).alias("path"), F.lit(float(w)).alias("weight"), F.lit(n).alias("number"))
                     for p, w, n in children])


def place(df: DataFrame, layout: Tree, out_col: str, key: Column) -> DataFrame:
    """``df`` with ``out_col``: the shard of ``key``, one level of the tree at a time.

    The tree itself is the only thing that goes along with the rows: nested
    literal arrays, indexed by the choice made one level above.
    """
    weight = lambda leaves: sum(leaves.values())
    regions = [(a, sorted(layout[a])) for a in sorted(layout)]
    top = _node([(a, sum(weight(x) for x in layout[a].values()), i) for i, (a, _) in enumerate(regions)])
    racks = F.array(*[_node([(f"{a}/{b}", weight(layout[a][b]), j) for j, b in enumerate(names)]) for a, names in regions])
    leaves = F.array(*[F.array(*[_node([(f"{a}/{b}/{s}", w, s) for s, w in sorted(layout[a][b].items())])
                                 for b in names]) for a, names in regions])
    return (df.withColumn("_region", _choose(key, top))
            .withColumn("_rack", _choose(key, F.get(racks, F.col("_region"))))
            .withColumn(out_col, _choose(key, F.get(F.get(leaves, F.col("_region")), F.col("_rack"))))
            .drop("_region", "_rack"))


def assign(df: DataFrame, shards: int = 40, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every document's shard, its gapless slot there, and its shard after one more shard was added.

    Slots are numbered in groups of a hash of the id, so that no task gets a
    whole shard: a group's rows follow those of the groups before it.
    """
    now = tree(shards)
    key = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    rows = id_text(df, id_col, text_col).select(
        "doc_id",
        (F.octet_length("text") + 16).cast("long").alias("size"),
        F.crc32(F.encode("text", "UTF-8")).alias("text_crc32"),
        F.lit("key").alias("law"),
    )
    rows = place(rows, now, "shard", key)
    rows = place(rows, grow(now), "grown_shard", key)
    n = df.count()
    groups = max(1, math.ceil(n / (shards * GROUP_ROWS)))
    rows = rows.withColumn("_group", F.pmod(F.xxhash64(key, "text_crc32", "size"), F.lit(groups)).cast("int"))
    # equal rows are counted first, so that however many there are of one, a group holds it once
    same = ["doc_id", "size", "text_crc32", "law", "shard", "grown_shard", "_group"]
    rows = rows.groupBy(*same).agg(F.count(F.lit(1)).alias("_copies"))
    # one row a shard and group: at most rows / GROUP_ROWS of them
    counts = rows.groupBy("shard", "_group").agg(F.sum("_copies").alias("_n"))
    before = W.partitionBy("shard").orderBy("_group").rowsBetween(W.unboundedPreceding, -1)
    starts = counts.select("shard", "_group", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    inside = W.partitionBy("shard", "_group").orderBy("doc_id", "text_crc32", "size").rowsBetween(W.unboundedPreceding, -1)
    numbered = rows.withColumn("_at", F.coalesce(F.sum("_copies").over(inside), F.lit(0)))
    copies = F.explode(F.sequence(F.lit(0).cast("long"), F.col("_copies") - 1)).alias("_copy")
    return numbered.join(starts, ["shard", "_group"]).select("*", copies).select(
        "doc_id", "size", "text_crc32", "law", "shard",
        (F.col("_start") + F.col("_at") + F.col("_copy")).cast("long").alias("slot"), "grown_shard")
