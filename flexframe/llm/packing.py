"""Best-fit packing by a grouping genetic algorithm.

Documents become pieces of at most one sequence. Pieces are dealt by a hash
into blocks of bounded size, and each block is packed on its own by islands:
populations of groupings that evolve side by side. A crossover takes whole
well-filled bins of one parent into the other, removes the bins of the other
that hold any of the same pieces, and best-fits the pieces that are displaced.
After each epoch an island's elite migrates to the next island of its block.
The bins of a block that stay poorly filled are dissolved and packed again
with those of other blocks, round by round, until they fit one block.

Defined results: a null or empty text is one piece with the end id alone; a
null id is kept; texts of any length are packed whole, longer ones in pieces;
repeated rows are packed each; other columns are ignored; an empty table gives
an empty result.
"""

from __future__ import annotations

import math
import random
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe
from .common import id_text, staged

CAPACITY = 2048
#: Pieces of a block, on average.
BLOCK = 4096
ISLANDS, EPOCHS, GENERATIONS, POPULATION = 2, 2, 6, 4
#: Bins that are less full than this are dissolved and packed again with other blocks'.
WELL_FILLED = 0.98
END = array("I", [0]).tobytes()


def pieces(spark: SparkSession, df: DataFrame, path: str | None = None, capacity: int = CAPACITY,
           id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32, salt``: the pieces of each document's ids and the end id.

    ``salt`` numbers the rows of a task, so that repeated rows are dealt apart.
    """
    path = path or bpe.default_path()
    whole = spark.sparkContext.broadcast(bpe.prove_whole(path))
    base = id_text(df, id_col, text_col)
    kind = base.schema["doc_id"].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = bpe.loaded(path, whole.value)
        salt = 0
        for b in batches:
            rows: list[tuple[int, int, int, int, int, int]] = []
            for k, text in enumerate(b.column(1)):
                ids = memoryview(tokenizer.ids(text.as_py()) + END)
                n, at, piece = len(ids) // 4, 0, 0
                size = n % capacity or min(n, capacity)  # the first piece takes what is left over
                while at < n:
                    rows.append((k, piece, at, size, zlib.crc32(ids[4 * at:4 * (at + size)]), salt))
                    at, size, piece, salt = at + size, capacity, piece + 1, salt + 1
            x = np.array(rows, dtype=np.int64).reshape(-1, 6)
            yield pa.RecordBatch.from_arrays(
                [b.column(0).take(pa.array(x[:, 0])), pa.array(x[:, 1].astype(np.int32)), *(pa.array(x[:, i]) for i in (2, 3, 4, 5))],
                names=["doc_id", "piece", "start", "length", "ids_crc32", "salt"])

    return base.mapInArrow(
        run, f"doc_id {kind.simpleString()}, piece int, start long, length long, ids_crc32 long, salt long")


# -- groupings ---------------------------------------------------------------


class Bins:
    """Open bins by free room; best fit is the least room that is enough."""

    def __init__(self, capacity: int):
        self.capacity, self.by_room, self.mask = capacity, [[] for _ in range(capacity + 1)], 0
        self.rooms: list[int] = []

    def add(self, room: int) -> int:
        self.rooms.append(room)
        self._put(len(self.rooms) - 1, room)
        return len(self.rooms) - 1

    def _put(self, number: int, room: int) -> None:
        self.by_room[room].append(number)
        self.mask |= 1 << room

    def fit(self, size: int) -> int:
        fitting = self.mask >> size
        if not fitting:
            return self.add(self.capacity - size)
        room = size + (fitting & -fitting).bit_length() - 1
        own = self.by_room[room]
        number = own.pop()
        if not own:
            self.mask &= ~(1 << room)
        self.rooms[number] = room - size
        self._put(number, room - size)
        return number


def best_fit(sizes: list[int], order, capacity: int) -> np.ndarray:
    """The bin of each piece, pieces taken in ``order``."""
    bins, out = Bins(capacity), np.empty(len(sizes), dtype=np.int32)
    for i in order:
        out[i] = bins.fit(sizes[i])
    return out


def fitness(genome: np.ndarray, sizes: np.ndarray, capacity: int) -> tuple[int, float]:
    """Fewer bins first, then fuller ones (mean squared fill); smaller is better."""
    fill = np.bincount(genome, weights=sizes)
    return len(fill), -float(np.square(fill / capacity).sum())


def crossover(a: np.ndarray, b: np.ndarray, sizes: np.ndarray, capacity: int, rng: random.Random) -> np.ndarray:
    """A child of ``a`` with whole well-filled bins of ``b``."""
    fill = np.bincount(b, weights=sizes)
    full = np.flatnonzero(fill >= WELL_FILLED * capacity)
    if not len(full):
        full = np.flatnonzero(fill >= np.median(fill))
    # a section of them, wrapping around
    n = max(1, round(len(full) * rng.uniform(0.1, 0.4)))
    taken = full[(rng.randrange(len(full)) + np.arange(n)) % len(full)]
    injected = np.isin(b, taken)
    hit = np.zeros(a.max() + 1, dtype=bool)
    hit[a[injected]] = True  # bins of a that hold a piece twice now
    kept = ~hit[a]
    child = np.full(len(a), -1, dtype=np.int32)
    _, child[kept] = np.unique(a[kept], return_inverse=True)
    base = int(child.max(initial=-1)) + 1
    _, own = np.unique(b[injected], return_inverse=True)
    child[injected] = base + own
    placed = child >= 0
    bins = Bins(capacity)
    for room in (capacity - np.bincount(child[placed], weights=sizes[placed]).astype(np.int64)).tolist():
        bins.add(room)
    displaced = np.flatnonzero(~placed)
    for i in displaced[np.argsort(-sizes[displaced], kind="stable")].tolist():
        child[i] = bins.fit(int(sizes[i]))
    return child


def first_population(sizes: np.ndarray, capacity: int, count: int, rng: random.Random) -> list[np.ndarray]:
    """Best fit over decreasing sizes, and over orders that are disturbed more and more."""
    out, own = [], sizes.tolist()
    for k in range(count):
        keys = [s * (1 + 0.15 * k * rng.random()) for s in own]
        out.append(best_fit(own, sorted(range(len(own)), key=lambda i: -keys[i]), capacity))  # noqa: B023
    return out


def evolve(population: list[np.ndarray], sizes: np.ndarray, capacity: int, generations: int, rng: random.Random) -> list[np.ndarray]:
    """The population after ``generations`` children, best first; it stops at the lower bound."""
    scored = sorted(((fitness(g, sizes, capacity), k, g) for k, g in enumerate(population)), key=lambda x: x[:2])
    least = math.ceil(int(sizes.sum()) / capacity)
    for step in range(generations):
        if scored[0][0][0] <= least or len(scored) < 2:
            break
        a, b = sorted(rng.sample(range(len(scored)), 2))
        if rng.random() < 0.5:
            a, b = b, a
        child = crossover(scored[a][2], scored[b][2], sizes, capacity, rng)
        scored.append((fitness(child, sizes, capacity), len(population) + step, child))
        scored = sorted(scored, key=lambda x: x[:2])[:len(population)]  # the worst goes
    return [g for *_, g in scored]


# -- the same on Spark -------------------------------------------------------


def _stored(genomes: list[np.ndarray]) -> list[bytes]:
    return [g.astype("<i4").tobytes() for g in genomes]


def _epoch(rows: DataFrame, epoch: int, capacity: int, generations: int, population: int) -> DataFrame:
    """One epoch of every (block, island); the best two genomes lead the list.

    ``rows``: block, island, sizes, genomes, guests (elites of another island).
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            blocks, islands, out = batch.column(0).to_pylist(), batch.column(1).to_pylist(), []
            for k, (block, island) in enumerate(zip(blocks, islands)):
                sizes = batch.column(2)[k].values.to_numpy().astype(np.int64)
                rng = random.Random(f"{block}/{island}/{epoch}")
                own = [np.frombuffer(g, "<i4") for g in batch.column(3)[k].as_py()]
                guests = [np.frombuffer(g, "<i4") for g in batch.column(4)[k].as_py()]
                own = own or first_population(sizes, capacity, population, rng)
                own = own[:max(1, population - len(guests))] + guests  # the worst make room
                out.append(_stored(evolve(own, sizes, capacity, generations, rng)))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(out, pa.list_(pa.binary()))],
                                             names=["block", "island", "genomes"])

    return rows.select("block", "island", "sizes", "genomes", "guests").mapInArrow(
        run, "block long, island int, genomes array<binary>")


def _bins(genomes: DataFrame, capacity: int) -> DataFrame:
    """block and best: the best genome of all islands of a block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sizes = [x.values.to_numpy().astype(np.int64) for x in b.column(1)]
            best = []
            for k, own in enumerate(b.column(2)):
                first = [np.frombuffer(g, "<i4") for g in own.as_py()]
                best.append(_stored([min(first, key=lambda g: fitness(g, sizes[k], capacity))])[0])  # noqa: B023
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(best, pa.binary())], names=["block", "best"])

    return genomes.select("block", "sizes", "firsts").mapInArrow(run, "block long, best binary")


def _placed(blocks: DataFrame, capacity: int, kind: str) -> DataFrame:
    """Pieces with ``bin``, ``offset`` and ``fill``: the bins of each block's best genome."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for k in range(b.num_rows):
                items = b.column(1)[k].values
                genome = np.frombuffer(b.column(2)[k].as_py(), "<i4")
                sizes = items.field("length").to_numpy().astype(np.int64)
                order = np.argsort(genome, kind="stable")
                before = np.cumsum(sizes[order]) - sizes[order]
                firsts = np.flatnonzero(np.diff(genome[order], prepend=-1))
                offset = np.empty_like(sizes)
                offset[order] = before - np.repeat(before[firsts], np.diff(np.append(firsts, len(order))))
                fill = np.bincount(genome, weights=sizes).astype(np.int64)[genome]
                block = np.full(len(sizes), b.column(0)[k].as_py(), dtype=np.int64)
                names = ["doc_id", "piece", "start", "length", "ids_crc32", "salt"]
                yield pa.RecordBatch.from_arrays(
                    [*(items.field(c) for c in names), pa.array(block), pa.array(genome.astype(np.int64)), pa.array(offset), pa.array(fill)],
                    names=[*names, "block", "bin", "offset", "fill"])

    return blocks.select("block", "items", "best").mapInArrow(
        run, f"doc_id {kind}, piece int, start long, length long, ids_crc32 long, salt long, "
             "block long, bin long, offset long, fill long")


def _round(spark: SparkSession, items: DataFrame, n_blocks: int, capacity: int, islands: int, epochs: int,
           generations: int, population: int) -> DataFrame:
    kind = items.schema["doc_id"].dataType.simpleString()
    block = F.pmod(F.xxhash64("doc_id", "piece", "salt"), F.lit(n_blocks))
    piece = F.struct("length", "doc_id", "piece", "start", "ids_crc32", "salt")
    blocks = staged(spark, items.groupBy(block.alias("block")).agg(F.sort_array(F.collect_list(piece)).alias("items")), "packing-blocks")
    sizes = blocks.select("block", F.col("items.length").alias("sizes"))
    none = F.array().cast("array<binary>")
    state = None
    for epoch in range(epochs):
        rows = sizes.select("*", F.explode(F.sequence(F.lit(0), F.lit(islands - 1))).alias("island"))
        if state is None:
            rows = rows.withColumn("genomes", none).withColumn("guests", none)
        else:
            # the elite of an island visits the next one
            guests = state.select("block", F.pmod(F.col("island") + 1, F.lit(islands)).alias("island"),
                                  F.slice("genomes", 1, 1).alias("guests"))
            rows = rows.join(state, ["block", "island"]).join(guests, ["block", "island"])
            rows = rows if islands > 1 else rows.withColumn("guests", none)
        state = staged(spark, _epoch(rows, epoch, capacity, generations, population), "packing-epoch")
    firsts = state.groupBy("block").agg(F.collect_list(F.get("genomes", F.lit(0))).alias("firsts"))
    best = _bins(sizes.join(firsts, "block"), capacity)
    return _placed(blocks.join(best, "block"), capacity, kind)


def pack(spark: SparkSession, items: DataFrame, capacity: int = CAPACITY, block: int = BLOCK, islands: int = ISLANDS,
         epochs: int = EPOCHS, generations: int = GENERATIONS, population: int = POPULATION) -> DataFrame:
    """``items`` (see ``pieces``) with ``sequence_id`` and ``offset``; no sequence is longer than ``capacity``."""
    items = staged(spark, items, "packing-items")
    out, left, level = None, items, 0
    while True:
        n = left.count()
        n_blocks = max(1, math.ceil(n / block))
        placed = staged(spark, _round(spark, left, n_blocks, capacity, islands, epochs, generations, population), "packing-placed")
        poor = F.col("fill") < WELL_FILLED * capacity
        good = placed if n_blocks == 1 else placed.where(~poor)
        # numbers: round, block and bin never meet (blocks < 2^36, bins of a block < 2^22)
        good = good.withColumn("sequence_id", F.lit(level << 58) + F.col("block") * (1 << 22) + F.col("bin"))
        out = good if out is None else out.union(good)
        if n_blocks == 1:
            break
        left, level = placed.where(poor).select(*items.columns), level + 1
        if left.count() > 0.5 * n:  # hardly anything fills up any more: one more round in the same way ends it
            placed_bins = placed.where(poor).withColumn(
                "sequence_id", F.lit(level << 58) + F.col("block") * (1 << 22) + F.col("bin"))
            return out.union(placed_bins).select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")
    return out.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def pack_documents(spark: SparkSession, df: DataFrame, path: str | None = None, capacity: int = CAPACITY,
                   id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """All documents of ``df`` as pieces in sequences."""
    return pack(spark, pieces(spark, df, path, capacity, id_col, text_col), capacity, **options)
