"""SimHash near-dedup: 64-bit fingerprints linked by a tiled exact comparison.

1. Fingerprints: word shingles are hashed in Arrow batches; a bit is set if
   over half of a text's shingle hashes have it. Equal fingerprints collapse
   into one row before anything is compared.
2. Tiles: the 64 bits are cut into segments, and a fingerprint's cell is the
   list of the segments' population counts. Two fingerprints differ in at
   least as many bits as their cells differ in counts, so pairs of cells whose
   counts differ by more than the radius are skipped. Cells are cut into tiles
   of bounded size; every remaining pair of tiles is compared in full with
   numpy (exclusive-or, bit count). A hot cell thus becomes many tile pairs,
   which are dealt out by tile and not by cell.
3. A tile pair reports a spanning forest of its links, not all of them: the
   components are the same, and there are fewer rows than fingerprints.
4. Components by contraction: each vertex points at its least neighbour (by a
   hash, so chains shrink by a constant factor), edges move to what their
   ends point at, until none is left. Every round is staged.

Defined results: null and empty texts have fingerprint zero and link like any
other; a null id never names a component unless all its ids are null; repeated
rows share a component; texts of any length are read whole, their hashes in
strips; other columns are kept by ``keep_one`` and otherwise ignored; an empty
table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import product

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import id_text, staged

SHINGLE = 3
RADIUS = 2
SEED = 42
SEGMENTS = 6
TILE = 2048
#: Shingle hashes that are counted bit by bit at once.
_STRIP = 1 << 14


def fingerprint(text: str, shingle: int = SHINGLE) -> int:
    """The fingerprint of one text; 0 without words."""
    words = text.encode("utf-8", "surrogatepass").lower().split()  # bytes: only A-Z and ASCII blanks count
    if not words:
        return 0
    n = max(1, len(words) - shingle + 1)
    hashed = xxhash.xxh64_intdigest
    values = np.fromiter((hashed(b" ".join(words[i:i + shingle]), SEED) for i in range(n)), dtype="<u8", count=n)
    ones = np.zeros(64, dtype=np.int64)
    for at in range(0, n, _STRIP):
        strip = values[at:at + _STRIP]
        ones += np.unpackbits(strip.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > n, bitorder="little").view("<u8")[0])


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def fingerprints(df: DataFrame, shingle: int = SHINGLE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id``, ``fp`` (the 64 bits as a long) and a hash of the text, one row per row of ``df``."""
    base = id_text(df, id_col, text_col).withColumn("text_hash", F.xxhash64("text"))
    kind = base.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fps = [_signed(fingerprint(t.as_py(), shingle)) for t in b.column(1)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fps, pa.int64()), b.column(2)], names=["doc_id", "fp", "text_hash"])

    return base.mapInArrow(run, f"doc_id {kind}, fp long, text_hash long")


def _segments(n: int) -> list[tuple[int, int]]:
    """(first bit, width) of ``n`` segments of the 64 bits."""
    cuts = [64 * i // n for i in range(n + 1)]
    return [(a, b - a) for a, b in zip(cuts, cuts[1:])]


def _moves(segments: int, radius: int) -> list[int]:
    """Differences of cell numbers (base 65, one digit a segment) with counts at most ``radius`` apart.

    Of each move and its opposite only one is kept, so each pair of cells meets once.
    """
    out = []
    for step in product(range(-radius, radius + 1), repeat=segments):
        if sum(map(abs, step)) <= radius:
            code = sum(d * 65 ** i for i, d in enumerate(step))
            if code >= 0:
                out.append(code)
    return sorted(set(out))


def _forest(a: np.ndarray, b: np.ndarray, links: np.ndarray) -> list[tuple[int, int]]:
    """A spanning forest of the links (index pairs) between the values of ``a`` and ``b``."""
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        while (y := parent.get(x, x)) != x:
            parent[x] = x = parent.get(y, y)
        return x

    kept = []
    for i, j in links:
        x, y = int(a[i]), int(b[j])
        rx, ry = root(x), root(y)
        if rx != ry:
            parent[rx] = ry
            kept.append((x, y))
    return kept


def _compare(a: np.ndarray, b: np.ndarray, radius: int) -> list[tuple[int, int]]:
    """Links between two tiles, a strip of rows at a time."""
    kept: list[tuple[int, int]] = []
    strip = max(1, (1 << 20) // max(1, len(b)))
    ua, ub = a.view(np.uint64), b.view(np.uint64)
    for at in range(0, len(a), strip):
        near = np.bitwise_count(ua[at:at + strip, None] ^ ub[None, :]) <= radius
        pairs = np.argwhere(near)
        if len(pairs):
            kept += _forest(a[at:at + strip], b, pairs)
    return kept


def links(fps: DataFrame, radius: int = RADIUS, segments: int = SEGMENTS, tile: int = TILE) -> DataFrame:
    """(a, b): links between the distinct values of ``fp``; connects exactly what lies within ``radius`` bits."""
    cell = F.lit(0).cast("long")
    for i, (first, width) in enumerate(_segments(segments)):
        ones = F.bit_count(F.shiftrightunsigned("fp", first).bitwiseAND(F.lit((1 << width) - 1)))
        cell = cell + ones.cast("long") * F.lit(65 ** i).cast("long")
    cells = fps.select("fp", cell.alias("cell"))
    # a cell of m values is cut into about m / tile tiles by a hash, before values are gathered
    sizes = cells.groupBy("cell").agg(F.count(F.lit(1)).alias("m"))
    cut = F.pmod(F.xxhash64("fp"), F.ceil(F.col("m") / tile)).cast("int")
    tiles = (cells.join(sizes, "cell").withColumn("part", cut)
             .groupBy("cell", "part").agg(F.collect_list("fp").alias("values")))
    tiles = staged(fps.sparkSession, tiles, "simhash-tiles")
    moves = F.array(*[F.lit(m).cast("long") for m in _moves(segments, radius)])
    # tiles meet by number first: what a dense cell has to compare is many small rows, dealt out by tile below
    left = tiles.select(F.col("cell").alias("a_cell"), F.col("part").alias("a_part"))
    right = tiles.select(F.col("cell").alias("b_cell"), F.col("part").alias("b_part"), F.explode(moves).alias("move"))
    meet = left.join(right, F.col("a_cell") == F.col("b_cell") + F.col("move")).where(
        (F.col("a_cell") != F.col("b_cell")) | (F.col("a_part") <= F.col("b_part"))).drop("move")
    side = lambda n: tiles.select(F.col("cell").alias(f"{n}_cell"), F.col("part").alias(f"{n}_part"), F.col("values").alias(f"{n}_values"))
    pairs = meet.join(side("a"), ["a_cell", "a_part"]).join(side("b"), ["b_cell", "b_part"]).select("a_values", "b_values")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found: list[tuple[int, int]] = []
            sides = [(c.offsets.to_numpy(), c.values.to_numpy()) for c in (batch.column(0), batch.column(1))]
            for k in range(batch.num_rows):
                a, b = (v[o[k]:o[k + 1]] for o, v in sides)
                found += _compare(a, b, radius)
            x = np.array(found, dtype=np.int64).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays([pa.array(x[:, 0]), pa.array(x[:, 1])], names=["a", "b"])

    return pairs.mapInArrow(run, "a long, b long").where("a != b").distinct()


def components(spark: SparkSession, vertices: DataFrame, edges: DataFrame) -> DataFrame:
    """(fp, root) for every row of ``vertices``: equal roots mean connected.

    ``edges`` are (a, b). Rounds of contraction until no edge is left; each
    halves the vertices that still have edges, about.
    """
    # vertices are renamed by a hash (a bijection would do; the value itself breaks ties) so that no
    # order of the data makes long descending chains
    order = lambda c: F.struct(F.xxhash64(c).alias("h"), F.col(c).alias("v"))
    edges = staged(spark, edges.select("a", "b"), "simhash-edges")
    moved = None  # (fp, root) of vertices that an edge touches
    while not edges.isEmpty():
        both = edges.union(edges.select("b", "a"))
        least = both.groupBy(F.col("a").alias("v")).agg(F.min(order("b")).alias("m"))
        to = staged(spark, least.select("v", F.least(order("v"), F.col("m"))["v"].alias("to")), "simhash-to")
        if moved is None:
            moved = to.select(F.col("v").alias("fp"), F.col("to").alias("root"))
        else:
            moved = moved.join(to, moved["root"] == to["v"], "left").select(
                "fp", F.coalesce("to", "root").alias("root"))
        moved = staged(spark, moved, "simhash-roots")
        at = lambda n: to.select(F.col("v").alias(n), F.col("to").alias(f"{n}_to"))  # noqa: E731,B023
        edges = (edges.join(at("a"), "a").join(at("b"), "b")
                 .select(F.least("a_to", "b_to").alias("a"), F.greatest("a_to", "b_to").alias("b"))
                 .where("a != b").distinct())
        edges = staged(spark, edges, "simhash-edges")
    if moved is None:
        return vertices.select("fp", F.col("fp").alias("root"))
    return vertices.join(moved, "fp", "left").select("fp", F.coalesce("root", "fp").alias("root"))


def cluster(spark: SparkSession, df: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS,
            id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id``, ``fingerprint`` (16 hex digits) and ``component_id`` (least id reachable), a row per row."""
    return _clustered(spark, df, shingle, radius, id_col, text_col).drop("text_hash")


def _clustered(spark: SparkSession, df: DataFrame, shingle: int, radius: int, id_col: str, text_col: str) -> DataFrame:
    """``cluster`` with the hash of each row's text."""
    docs = staged(spark, fingerprints(df, shingle, id_col, text_col), "simhash-fp")
    distinct = staged(spark, docs.groupBy("fp").agg(F.min("doc_id").alias("least_id")), "simhash-distinct")
    roots = staged(spark, components(spark, distinct.select("fp"), links(distinct.select("fp"), radius)), "simhash-comp")
    named = distinct.join(roots, "fp")
    least = named.groupBy("root").agg(F.min("least_id").alias("component_id"))
    by_fp = named.join(least, "root").select("fp", "component_id")
    return docs.join(by_fp, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id", "text_hash")


def keep_one(spark: SparkSession, df: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS,
             id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``df`` without the rows whose id isn't the least of their component; columns as they were.

    Rows that share the least id (repeats) all stay; rows with a null id stay,
    since no id names them. Where an id carries several texts, each row goes by
    the component of its own text.
    """
    groups = _clustered(spark, df, shingle, radius, id_col, text_col)
    gone = groups.where("doc_id != component_id").select(
        F.col("doc_id").alias("_gone"), F.col("text_hash").alias("_gone_hash")).distinct()
    same = F.xxhash64(F.coalesce(df[text_col], F.lit(""))) == gone["_gone_hash"]
    return df.join(gone, (df[id_col] == gone["_gone"]) & same, "left_anti")
