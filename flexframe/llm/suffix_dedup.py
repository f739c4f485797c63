"""Suffix-array dedup: repeated byte strings found by prefix doubling over sampled suffixes.

A byte goes if a string of ``length`` bytes that covers it also starts earlier
in the corpus. Prefix doubling names the suffixes by ever longer prefixes:
positions are sorted with their names, equal names are compared by the name of
what goes on from there, suffixes with a name of their own drop out, and the
rounds end once the prefix reaches the length asked for. A pass over every
position would shuffle sixteen times the text, so the rounds work on a sample
that loses nothing:

* Every string of ``length`` bytes has a minimiser: its ``GRAM``-byte substring
  with the least hash. Equal strings have it at the same place, so suffixes at
  minimisers are enough. One row stands for the *range* of neighbouring
  strings with one minimiser.
* Each round sorts rows of (name of a core that all strings of the range
  hold, name of all bytes of the range, position). A core met once: no string
  of the range is repeated, the row drops out. One name of the whole range:
  all rows but the first in the corpus are repeats, as a whole. Otherwise the
  first row of each name goes on to the next round, cut into smaller ranges
  with longer cores: ``GRAM`` bytes, then ``length - BLOCK + 1``, then ``length``.

Names are 64-bit hashes of the bytes; two rows count as equal only if both
names (128 bits) are.

Equal rows are combined within each task before a shuffle, and a name that a
task meets in several ranges is dealt by range name, so a string shared by a
third of all documents is spread out.

Defined results: null texts are empty; the order of documents is that of their
ids (nulls first; different texts under one id: by a hash of the text); rows
that repeat id and text are one document and get the same result; other
columns are ignored by ``dedup`` and kept by ``cut``; an empty table gives an
empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import id_text, staged

LENGTH = 100
GRAM = 32
BLOCK = 8
#: Text that a task hashes at once; longer texts are hashed in overlapping strips.
STRIP = 1 << 20
#: Rows that a task combines at once before they are shuffled.
COMBINE = 1 << 19

#: Kinds of rows: a range, the mark of a name with several ranges, a range under such a name, a repeat.
ONE, SEVERAL, AMONG, REPEAT = 0, 1, 2, 3
ROW = "kind byte, key long, name long, ord long, at long"
#: ``at`` packs start, number of strings and place of the minimiser: 2 x 7 low bits.
_BITS = 7

_U = np.uint64
_BASE = _U(0x9E3779B97F4A7C15)
_BACK = _U(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_LETTERS = np.random.default_rng(7).integers(0, 1 << 63, size=(2, 256), dtype=np.uint64) * _U(2) + _U(1)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(32))) * _U(0xD6E8FEB86659FD93)
    return x ^ (x >> _U(32))


class Hashed:
    """Hashes of any substring of ``data``: polynomial prefix sums modulo 2^64, then mixed."""

    def __init__(self, data: np.ndarray):
        self.back = np.full(len(data) + 1, _BACK, _U)
        self.back[0] = 1
        np.cumprod(self.back, out=self.back)
        powers = np.full(len(data), _BASE, _U)
        powers[:1] = 1
        np.cumprod(powers, out=powers)
        self.sums = []
        for letters in _LETTERS:
            s = np.zeros(len(data) + 1, _U)
            np.cumsum(letters[data] * powers, out=s[1:])
            self.sums.append(s)

    def of(self, start: np.ndarray, end: np.ndarray, which: int = 0) -> np.ndarray:
        s = self.sums[which]
        return _mix((s[end] - s[start]) * self.back[start])

    def every(self, n: int) -> np.ndarray:
        """The hash of every substring of ``n`` bytes."""
        s = self.sums[0]
        return _mix((s[n:] - s[:-n]) * self.back[:len(s) - n])


def _least(values: np.ndarray, width: int) -> np.ndarray:
    """The place of the leftmost least value in every window, by doubling widths."""
    best = (values & _U(0xFFFFFFFF00000000)) | np.arange(len(values), dtype=_U)
    size = 1
    while 2 * size <= width:
        best = np.minimum(best[:-size], best[size:])
        size *= 2
    if size < width:
        best = np.minimum(best[:-(width - size)], best[width - size:])
    return (best & _U(0xFFFFFFFF)).astype(np.int64)


def ranges(data: np.ndarray, first: np.ndarray, last: np.ndarray, length: int = LENGTH, gram: int = GRAM):
    """Ranges of strings with one minimiser, in texts ``data[first[i]:last[i]]``.

    Gives (text number, start, strings, place of the minimiser, key, name), starts within ``data``.
    """
    if len(data) < length:
        return tuple(np.empty(0, t) for t in (np.int64, np.int64, np.int64, np.int64, _U, _U))
    hashed = Hashed(data)
    grams = hashed.every(gram)
    place = _least(grams, length - gram + 1)
    counts = np.maximum(0, last - first - length + 1)  # strings of each text
    text = np.repeat(np.arange(len(first)), counts)
    starts = np.arange(len(text)) - np.repeat(np.cumsum(counts) - counts, counts) + first[text]
    at = place[starts]
    new = np.flatnonzero((np.diff(at, prepend=-1) != 0) | (np.diff(text, prepend=-1) != 0))
    n = np.diff(np.append(new, len(starts)))
    text, start, at = text[new], starts[new], at[new]
    inside = at - start
    extent = (n * 128 + inside).astype(_U)
    name = _mix(hashed.of(start, start + n - 1 + length, 1) + extent * _BASE)
    return text, start, n, inside, grams[at], name


def _pack(start: np.ndarray, n: np.ndarray, inside: np.ndarray) -> np.ndarray:
    return start << (2 * _BITS) | n << _BITS | inside


def _unpack(at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    low = (1 << _BITS) - 1
    return at >> (2 * _BITS), at >> _BITS & low, at & low


def _batch(kind, key, name, ord_, at) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(np.asarray(kind, np.int8)), *(pa.array(np.asarray(x).view(np.int64)) for x in (key, name, ord_, at))],
        names=["kind", "key", "name", "ord", "at"])


def _columns(batch: pa.RecordBatch) -> list[np.ndarray]:
    return [c.to_numpy(zero_copy_only=False) for c in batch.columns]


def _repeats(ord_: np.ndarray, at: np.ndarray, length: int) -> list[np.ndarray]:
    """Rows of kind REPEAT for these ranges, those that touch joined: start in ``at``, end in ``name``."""
    start, n, _ = _unpack(at)
    end = start + n - 1 + length
    order = np.lexsort((start, ord_))
    ord_, start, end = ord_[order], start[order], end[order]
    if not len(ord_):
        return [np.empty(0, np.int64)] * 5
    # ends may overlap in any order only within one text: the furthest end so far, text by text
    new_text = np.diff(ord_, prepend=ord_[0] - 1) != 0
    shift = np.cumsum(new_text) * (int(end.max()) + 1)
    reach = np.maximum.accumulate(end + shift)
    fresh = new_text | (start + shift > np.append(-1, reach[:-1]))
    at0 = np.flatnonzero(fresh)
    until = reach[np.append(at0[1:] - 1, len(reach) - 1)] - shift[at0]
    zero = np.zeros(len(at0), np.int64)
    return [zero + REPEAT, zero, until, ord_[at0], start[at0]]


def _combined(key, name, ord_, at, length: int) -> pa.RecordBatch:
    """A task's ranges, equal ones made one: see the kinds."""
    order = np.argsort(key, kind="stable")
    key = key[order]
    alone = np.ones(len(key), bool)
    same = key[1:] == key[:-1]
    alone[1:] &= ~same
    alone[:-1] &= ~same
    single, rest = order[alone], order[~alone]
    out = [[np.full(len(single), ONE), key[alone], name[single], ord_[single], at[single]]]
    if len(rest):
        k, m, o, a = key[~alone], name[rest], ord_[rest], at[rest]
        by = np.lexsort((a, o, m, k))
        k, m, o, a = k[by], m[by], o[by], a[by]
        new_key = np.append(True, k[1:] != k[:-1])
        new_name = new_key | np.append(True, m[1:] != m[:-1])
        group = np.cumsum(new_key) - 1
        several = (np.bincount(group, weights=new_name) > 1)[group]
        head = np.flatnonzero(new_name)[np.cumsum(new_name) - 1]  # the first row of each name
        again = (o != o[head]) | (a != a[head])
        out.append([np.where(several, AMONG, ONE)[new_name], k[new_name], m[new_name], o[new_name], a[new_name]])
        marks = new_key & several
        zero = np.zeros(int(marks.sum()), np.int64)
        out.append([zero + SEVERAL, k[marks], zero, zero, zero])
        out.append(_repeats(o[again], a[again], length))
    return _batch(*(np.concatenate([np.asarray(x[i]).view(np.int64) if i else np.asarray(x[i], np.int8) for x in out]) for i in range(5)))


def _groups(batches: Iterator[pa.RecordBatch], columns: tuple[int, ...]) -> Iterator[list[np.ndarray]]:
    """Sorted batches joined so that no group of equal values in ``columns`` is cut."""
    held: list[np.ndarray] | None = None
    for b in batches:
        rows = _columns(b)
        if held is not None:
            rows = [np.concatenate(x) for x in zip(held, rows)]
        if not len(rows[0]):
            continue
        change = np.zeros(len(rows[0]) - 1, bool)
        for i in columns:
            change |= rows[i][1:] != rows[i][:-1]
        cuts = np.flatnonzero(change)
        cut = int(cuts[-1]) + 1 if len(cuts) else 0
        if cut:
            yield [x[:cut] for x in rows]
        held = [x[cut:] for x in rows]
    if held is not None and len(held[0]):
        yield held


def settle(spark: SparkSession, items: DataFrame, length: int) -> DataFrame:
    """One round over combined rows: the repeats found, and the ranges (kind AMONG) that need a closer look."""
    dealt = (F.when(F.col("kind") == AMONG, F.xxhash64("key", "name"))
             .when(F.col("kind") == REPEAT, F.xxhash64("ord", "at")).otherwise(F.col("key")))

    def by_key(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for kind, key, name, ord_, at in _groups(batches, (1,)):
            through = (kind == AMONG) | (kind == REPEAT)
            own = np.flatnonzero(~through)
            out = [[x[through] for x in (kind, key, name, ord_, at)]]
            if len(own):
                # per key: a mark, or two names, make it several; else all but the first position repeat
                first = np.append(True, key[own][1:] != key[own][:-1])
                group, at0 = np.cumsum(first) - 1, np.flatnonzero(first)
                marked = np.maximum.reduceat(kind[own], at0) == SEVERAL
                real = kind[own] == ONE
                low = np.minimum.reduceat(np.where(real, name[own], np.iinfo(np.int64).max), at0)
                high = np.maximum.reduceat(np.where(real, name[own], np.iinfo(np.int64).min), at0)
                several = (marked | (low < high))[group]
                among = own[real & several]
                out.append([np.full(len(among), AMONG, np.int8), key[among], name[among], ord_[among], at[among]])
                same = own[real & ~several]
                by = same[np.lexsort((at[same], ord_[same], key[same]))]
                head = np.append(True, key[by][1:] != key[by][:-1]) if len(by) else np.empty(0, bool)
                lead = by[np.flatnonzero(head)[np.cumsum(head) - 1]] if len(by) else by
                again = by[(ord_[by] != ord_[lead]) | (at[by] != at[lead])]
                out.append(_repeats(ord_[again], at[again], length))
            yield _batch(*(np.concatenate([x[i] for x in out]) for i in range(5)))

    def by_name(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for kind, key, name, ord_, at in _groups(batches, (1, 2)):
            by = np.lexsort((at, ord_, name, key))
            k, m, o, a = key[by], name[by], ord_[by], at[by]
            head = np.append(True, (k[1:] != k[:-1]) | (m[1:] != m[:-1]))
            lead = np.flatnonzero(head)[np.cumsum(head) - 1]
            again = (o != o[lead]) | (a != a[lead])
            out = [[kind[by][head], k[head], m[head], o[head], a[head]], _repeats(o[again], a[again], length)]
            yield _batch(*(np.concatenate([x[i] for x in out]) for i in range(5)))

    sorted_ = items.repartition(dealt).sortWithinPartitions("key")
    known = staged(spark, sorted_.mapInArrow(by_key, ROW), "suffix-keys")
    among = known.where(F.col("kind") == AMONG)
    named = among.repartition("key", "name").sortWithinPartitions("key", "name").mapInArrow(by_name, ROW)
    return staged(spark, known.where(F.col("kind") == REPEAT).union(named), "suffix-round")


# -- the rounds' rows ----------------------------------------------------------


class _Held:
    """Rows of a task, combined as soon as there are ``limit`` of them."""

    def __init__(self, length: int, limit: int):
        self.rows, self.count, self.length, self.limit = [], 0, length, limit

    def add(self, key, name, ord_, at) -> Iterator[pa.RecordBatch]:
        self.rows.append((key.view(np.int64), name.view(np.int64), ord_, at))
        self.count += len(key)
        if self.count >= self.limit:
            yield from self.end()

    def end(self) -> Iterator[pa.RecordBatch]:
        if self.count:
            yield _combined(*(np.concatenate([r[i] for r in self.rows]) for i in range(4)), self.length)
        self.rows, self.count = [], 0


def _strips(texts: list[bytes], length: int, strip: int) -> Iterator[list[tuple[int, int, bytes]]]:
    """(text number, offset, bytes) in lists of about ``strip`` bytes; strips of one text share length - 1 bytes."""
    out, total = [], 0
    for k, text in enumerate(texts):
        at = 0
        while True:
            part = text[at:at + strip]
            out.append((k, at, part))
            total += len(part)
            if total >= strip:
                yield out
                out, total = [], 0
            if at + strip >= len(text):
                break
            at += strip - length + 1
    if out:
        yield out


def _first_rows(docs: DataFrame, length: int, gram: int, strip: int, combine: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = _Held(length, combine)
        for b in batches:
            ords = b.column(0).to_numpy()
            for some in _strips(b.column(1).to_pylist(), length, strip):
                sizes = np.array([len(x) for *_, x in some])
                last = np.cumsum(sizes)
                first = last - sizes
                data = np.frombuffer(b"".join(x for *_, x in some), np.uint8)
                text, start, n, inside, key, name = ranges(data, first, last, length, gram)
                own = ords[np.array([k for k, *_ in some])]
                offset = np.array([o for _, o, _ in some])
                yield from held.add(key, name, own[text], _pack(start - first[text] + offset[text], n, inside))
        yield from held.end()

    return docs.mapInArrow(run, ROW)


def _snippets(docs: DataFrame, among: DataFrame, length: int) -> DataFrame:
    """ord, at, bytes: all bytes of each range that needs a closer look."""
    wanted = among.groupBy("ord").agg(F.collect_list("at").alias("ats"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for k in range(b.num_rows):
                body = b.column(1)[k].as_py()
                at = np.unique(b.column(2)[k].values.to_numpy())
                start, n, _ = _unpack(at)
                parts = [body[s:e] for s, e in zip(start.tolist(), (start + n - 1 + length).tolist())]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(at), b.column(0)[k].as_py(), np.int64)), pa.array(at), pa.array(parts, pa.binary())],
                    names=["ord", "at", "bytes"])

    return docs.select("ord", "body").join(wanted, "ord").mapInArrow(run, "ord long, at long, bytes binary")


def _smaller(snippets: DataFrame, length: int, block: int, combine: int) -> DataFrame:
    """Rows of ranges of up to ``block`` strings, cut where the distance to the minimiser passes a multiple of it.

    The core of a block is what all its strings share, whether or not the range holds them all.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = _Held(length, combine)
        for b in batches:
            ord_, at = (b.column(i).to_numpy() for i in (0, 1))
            start, n, inside = _unpack(at)
            size = n - 1 + length
            base = np.cumsum(size) - size
            hashed = Hashed(np.frombuffer(b"".join(b.column(2).to_pylist()), np.uint8))
            # distances to the minimiser run from inside down to inside - n + 1
            top, low = inside // block, (inside - n + 1) // block
            counts = top - low + 1
            row = np.repeat(np.arange(len(at)), counts)
            number = top[row] - (np.arange(len(row)) - np.repeat(np.cumsum(counts) - counts, counts))
            far = np.minimum(number * block + block - 1, inside[row])
            near = np.maximum(number * block, inside[row] - n[row] + 1)
            s = inside[row] - far  # within the range
            strings = far - near + 1
            core = base[row] + inside[row] - number * block
            key = _mix(hashed.of(core, core + length - block + 1) + (number + 1).astype(_U) * _BASE)
            name = _mix(hashed.of(base[row] + s, base[row] + s + strings - 1 + length, 1)
                        + (strings * 1024 + far).astype(_U) * _BASE)
            yield from held.add(key, name, ord_[row], _pack(start[row] + s, strings, far))
        yield from held.end()

    return snippets.mapInArrow(run, ROW)


def _windows(snippets: DataFrame, among: DataFrame, length: int, combine: int) -> DataFrame:
    """Rows of single strings, of the ranges in ``among`` (parts of the snippets)."""
    # a part has the minimiser of its snippet
    place = F.shiftright("at", 2 * _BITS) + F.col("at").bitwiseAND((1 << _BITS) - 1)  # of the minimiser
    left = snippets.withColumn("minimiser", place)
    right = among.select("ord", F.col("at").alias("part"), place.alias("minimiser"))
    joined = left.join(right, ["ord", "minimiser"]).select("ord", "at", "bytes", "part")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = _Held(length, combine)
        for b in batches:
            ord_, at, part = (b.column(i).to_numpy() for i in (0, 1, 3))
            start, n, _ = _unpack(at)
            size = n - 1 + length
            base = np.cumsum(size) - size
            hashed = Hashed(np.frombuffer(b"".join(b.column(2).to_pylist()), np.uint8))
            first, strings, _ = _unpack(part)
            row = np.repeat(np.arange(len(at)), strings)
            s = first[row] + np.arange(len(row)) - np.repeat(np.cumsum(strings) - strings, strings)
            x = base[row] + s - start[row]
            inside = (s >= start[row]) & (s < start[row] + n[row])
            row, s, x = row[inside], s[inside], x[inside]
            one = np.ones(len(row), np.int64)
            yield from held.add(hashed.of(x, x + length), hashed.of(x, x + length, 1), ord_[row], _pack(s, one, 0 * one))
        yield from held.end()

    return joined.mapInArrow(run, ROW)


# -- documents -----------------------------------------------------------------


def _numbered(spark: SparkSession, df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``df`` with ``ord`` (order of the documents) and ``body`` (the text's bytes).

    Whole-number ids that never repeat are their own order. Else the distinct
    (id, hash of the text) are sorted and numbered over ranges.
    """
    base = df.withColumn("body", F.coalesce(df[text_col], F.lit("")).cast("binary"))
    kind = df.schema[id_col].dataType.typeName()
    if kind in ("long", "integer", "short", "byte"):
        odd = df.groupBy(F.col(id_col).alias("i")).agg(F.count(F.lit(1)).alias("n")).where("n > 1 or i is null")
        if odd.isEmpty():
            return base.withColumn("ord", F.col(id_col).cast("long"))
    docs = base.withColumn("_h", F.xxhash64("body")).withColumn("_i", F.col(id_col))
    keys = docs.select("_i", "_h").distinct()
    ranged = staged(spark, keys.repartitionByRange("_i", "_h").sortWithinPartitions("_i", "_h")
                    .withColumn("_p", F.monotonically_increasing_id()), "suffix-order")
    part = F.shiftright("_p", 33)  # the partition's number
    sizes = ranged.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("n"))
    before = sizes.select("part", (F.coalesce(F.sum("n").over(
        W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))).alias("base"))
    order = ranged.withColumn("part", part).join(before, "part").select(
        F.col("_i").alias("_ki"), F.col("_h").alias("_kh"),
        (F.col("base") + F.col("_p").bitwiseAND((1 << 33) - 1)).alias("ord"))
    return docs.join(order, docs["_i"].eqNullSafe(order["_ki"]) & (docs["_h"] == order["_kh"])).drop("_i", "_h", "_ki", "_kh")


def repeats(spark: SparkSession, docs: DataFrame, length: int = LENGTH, gram: int = GRAM, block: int = BLOCK,
            strip: int = STRIP, combine: int = COMBINE) -> DataFrame:
    """``ord`` and ``spans`` (array of start, end): the repeated bytes of ``docs`` (ord, body), unjoined."""
    if not (gram <= length and block <= length and length - gram < 1 << _BITS):
        raise ValueError("length must be at least gram and block, and less than 128 above gram")
    first = settle(spark, _first_rows(docs.select("ord", "body"), length, gram, strip, combine), length)
    parts = staged(spark, _snippets(docs, first.where(F.col("kind") == AMONG), length), "suffix-snippets")
    second = settle(spark, _smaller(parts, length, block, combine), length)
    third = settle(spark, _windows(parts, second.where(F.col("kind") == AMONG), length, combine), length)
    found = first.union(second).union(third).where(F.col("kind") == REPEAT)
    span = F.struct(F.col("at").alias("start"), F.col("name").alias("end"))
    return staged(spark, found.groupBy("ord").agg(F.collect_list(span).alias("spans")), "suffix-spans")


def joined(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Sorted spans, those that touch or overlap made one."""
    out: list[tuple[int, int]] = []
    for start, end in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((start, end))
    return out


def remaining(body: bytes, spans: list[tuple[int, int]]) -> bytes:
    """``body`` without the joined ``spans``."""
    if not spans:
        return body
    edges = [0, *(x for s in spans for x in s), len(body)]
    return b"".join(body[a:b] for a, b in zip(edges[::2], edges[1::2]))


def _spans(value) -> list[tuple[int, int]]:
    return joined([(x["start"], x["end"]) for x in value]) if value is not None else []


def dedup(spark: SparkSession, df: DataFrame, length: int = LENGTH, id_col: str = "doc_id", text_col: str = "text",
          **options) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256``: a row per row of ``df``."""
    docs = _numbered(spark, id_text(df, id_col, text_col), "doc_id", "text").select("doc_id", "ord", "body")
    spans = repeats(spark, docs, length, **options)
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for body, found in zip(b.column(1).to_pylist(), b.column(2).to_pylist()):
                own = _spans(found)
                rows.append((len(body), sum(e - s for s, e in own), len(own), hashlib.sha256(remaining(body, own)).hexdigest()))
            n, removed, count, digest = zip(*rows) if rows else ((), (), (), ())
            yield pa.RecordBatch.from_arrays(
                [b.column(0), *(pa.array(x, pa.int64()) for x in (n, removed, count)), pa.array(digest, pa.string())],
                names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])

    return docs.join(spans, "ord", "left").select("doc_id", "body", "spans").mapInArrow(
        run, f"doc_id {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string")


def cut(spark: SparkSession, df: DataFrame, length: int = LENGTH, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``df`` with the repeated bytes of each text gone; bytes of characters that were cut apart go with them.

    A null text stays null. No other column changes, and no row goes.
    """
    row = F.struct(*[df[c] for c in df.columns])
    docs = _numbered(spark, df.select(row.alias("row"), df[id_col].alias("i"), df[text_col].alias("t")), "i", "t")
    spans = repeats(spark, docs, length)

    def kept(body: pd.Series, found: pd.Series) -> pd.Series:
        return pd.Series([remaining(x, _spans(f)).decode("utf-8", "ignore") for x, f in zip(body, found)], dtype=object)

    rest = docs.select("ord", "row", "body").join(spans, "ord", "left")
    clean = F.when(F.col("spans").isNull(), F.col("row")[text_col]).otherwise(F.pandas_udf(kept, "string")("body", "spans"))
    return rest.withColumn("clean", clean).select(
        *[(F.col("clean") if c == text_col else F.col("row")[c]).alias(c) for c in df.columns])
