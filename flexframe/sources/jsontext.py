"""JSON values in running text: where one ends and the next begins.

``pieces`` cuts one text. ``values_of_files`` cuts whole files, whose values
may span lines and several of which may stand in one file. A file is read as
Spark splits it, line by line, so no task holds more than one value:

1. Each task sums up its split by the brackets that its lines leave open or
   close, strings left aside. Splits that leave nothing open are not reported.
2. The summaries of a file in order give the brackets open where each split
   starts: at most one small row per split reaches the driver.
3. Each task cuts its split from that state on. A value that goes on in the
   next split comes out in parts, which are joined by file and place of origin.

The elements of an array at top level are values of their own, so a file that
is one large array needs no large row either. A string never goes on in the
next line (JSON doesn't allow that), so a missing quote spoils one line. What
stands between values comes out as a piece of its own, as do the parts of a
value that is never closed: pieces that are no JSON become error records, and
all that is in a file but blanks, and the commas and brackets of top-level
arrays, is in some piece.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_TOKEN = re.compile(r'"(?:[^"\\]|\\.)*"?|[{}\[\],]|[^\s"{}\[\],]+|\s+')
_OPEN, _CLOSE = frozenset("{["), frozenset("}]")
VALUES = "value string, inner boolean, file string"


def single(text: Column) -> Column:
    """The value of a text that holds just one JSON value; null for any other text.

    Spark's parser stops after the first value, so the text is parsed as the
    only element of an array. A text could close that array by itself; it
    couldn't close the object of a second parse in the same way.
    """
    listed = F.try_parse_json(F.concat(F.lit("["), text, F.lit("]")))
    alone = F.variant_get(listed, "$[1]", "variant").isNull()
    whole = F.when(F.contains(text, F.lit("]")), F.try_parse_json(F.concat(F.lit('{"k":'), text, F.lit("}"))).isNotNull()).otherwise(F.lit(True))
    return F.when(alone & whole, F.variant_get(listed, "$[0]", "variant"))


class Cutter:
    """Cuts lines into pieces, from a given state on: the brackets that are open.

    With ``arrays`` the elements of a top-level array are pieces (``inner``).
    """

    def __init__(self, stack: str = "", arrays: bool = True):
        self.arrays = arrays
        self.stack = list(stack)
        self.held: list[str] = []
        self.rest: list[str] = []
        self.elements = 0 if not stack else 1
        self.out: list[tuple[str, bool]] = []

    @property
    def ground(self) -> int:
        """Depth at which values stand: 0, or 1 inside a top-level array."""
        return 1 if self.arrays and self.stack[:1] == ["["] else 0

    @property
    def within(self) -> bool:
        """Whether a value is open."""
        return len(self.stack) > self.ground

    def _leave(self) -> None:
        text = "".join(self.rest).strip()
        self.rest = []
        if text:
            self.elements += 1
            self.out.append((text, self.ground == 1))

    def line(self, text: str, end: str = "\n") -> None:
        for m in _TOKEN.finditer(text):
            token = m[0]
            if token in _OPEN:
                if not self.within:
                    self._leave()
                    if not self.stack and self.arrays and token == "[":
                        self.stack.append(token)
                        self.elements = 0
                        continue
                self.stack.append(token)
                self.held.append(token)
            elif token in _CLOSE and self.within:
                self.held.append(token)
                self.stack.pop()
                if not self.within:
                    self.elements += 1
                    self.out.append(("".join(self.held), self.ground == 1))
                    self.held = []
            elif self.within:
                self.held.append(token)
            elif self.ground and token in ",]}":
                self._leave()
                if token != ",":
                    self.stack.pop()
                    if not self.elements:
                        self.out.append(("[]", False))
            else:
                self.rest.append(token)
        if self.within:
            self.held.append(end)
        else:
            self._leave()

    def take(self) -> list[tuple[str, bool]]:
        out, self.out = self.out, []
        return out


def pieces(text: str) -> list[str]:
    """The values of one text, arrays as a whole, and what stands between them or is never closed."""
    cutter = Cutter(arrays=False)
    for line in text.split("\n"):
        cutter.line(line)
    left = "".join(cutter.held).strip()
    return [p for p, _ in cutter.take()] + ([left] if left else [])


def effect(lines: Iterator[str]) -> tuple[int, str]:
    """How many open brackets the lines close, and which ones they leave open."""
    closed, opened = 0, []
    for text in lines:
        for token in _TOKEN.findall(text):
            if token in _OPEN:
                opened.append(token)
            elif token in _CLOSE:
                if opened:
                    opened.pop()
                else:
                    closed += 1
    return closed, "".join(opened)


class Plan:
    """What is open at the start of each split, from the summaries of all splits that leave or close something."""

    def __init__(self, rows: list[tuple[str, int, int, str]]):
        self.places: dict[str, tuple[list[int], list[tuple[str, int | None]]]] = {}
        self.endless: set[tuple[str, int]] = set()
        files: dict[str, list] = {}
        for file, block, closed, opened in rows:
            files.setdefault(file, []).append((block, closed, opened))
        for file, splits in files.items():
            stack, origin = "", None
            starts, states = [], []
            for block, closed, opened in sorted(splits):
                ground = 1 if stack[:1] == "[" else 0
                stays = len(stack) - closed > ground  # the value that was open still is
                stack = stack[:max(0, len(stack) - closed)] + opened
                if len(stack) <= (1 if stack[:1] == "[" else 0):
                    origin = None
                elif not stays:
                    origin = block
                starts.append(block)
                states.append((stack, origin))
            if origin is not None:
                self.endless.add((file, origin))
            self.places[file] = (starts, states)

    def at(self, file: str, block: int) -> tuple[str, int | None]:
        """(open brackets, block in which the open value began) where a split starts."""
        if file not in self.places:
            return "", None
        starts, states = self.places[file]
        i = bisect_right(starts, block - 1) - 1
        return states[i] if i >= 0 else ("", None)


def _by_split(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, int, list[str]]]:
    """(file, block, lines) of each batch, in order, one split at a time."""
    for b in batches:
        files, blocks, lines = (c.to_pylist() for c in b.columns)
        start = 0
        for i in range(1, len(files) + 1):
            if i == len(files) or files[i] != files[start] or blocks[i] != blocks[start]:
                yield files[start], blocks[start], lines[start:i]
                start = i


def values_of_files(lines: DataFrame) -> DataFrame:
    """(value, inner, file) of the lines of text files; ``lines`` is a scan of the ``text`` source."""
    from ..session import ship_package

    ship_package(lines.sparkSession)
    rows = lines.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), "value")

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[tuple[str, int], tuple[int, str]] = {}
        for file, block, own in _by_split(batches):
            closed, opened = sums.get((file, block), (0, ""))
            more, left = effect(iter(own))
            keep = max(0, len(opened) - more)
            sums[file, block] = (closed + max(0, more - len(opened)), opened[:keep] + left)
        found = [(f, b, c, o) for (f, b), (c, o) in sums.items() if c or o]
        yield pa.RecordBatch.from_arrays([
            pa.array([r[0] for r in found], pa.string()), pa.array([r[1] for r in found], pa.int64()),
            pa.array([r[2] for r in found], pa.int64()), pa.array([r[3] for r in found], pa.string())], names=["file", "block", "closed", "opened"])

    plan = Plan([tuple(r) for r in rows.mapInArrow(summed, "file string, block long, closed long, opened string").collect()])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here, cutter, origin = None, Cutter(), None
        out: list[tuple] = []

        def part(file: str, block: int) -> None:
            """The open value's text so far, as a part of the value."""
            text = "".join(cutter.held)
            cutter.held = []
            begun = block if origin is None else origin
            if text.strip():
                whole = (file, begun) in plan.endless  # never closed: pieces for themselves
                out.append((text.strip(), cutter.ground == 1, file, None if whole else begun, block, False))

        def close() -> None:
            if here is not None and cutter.within:
                part(*here)

        def batch() -> pa.RecordBatch:
            columns = list(zip(*out)) or [()] * 6
            types = [pa.string(), pa.bool_(), pa.string(), pa.int64(), pa.int64(), pa.bool_()]
            out.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)],
                                              names=["value", "inner", "file", "origin", "block", "last"])

        for file, block, own in _by_split(batches):
            if (file, block) != here:
                close()
                here = (file, block)
                stack, origin = plan.at(file, block)
                cutter = Cutter(stack)
            for text in own:
                cutter.line(text)
                for value, inner in cutter.take():
                    if origin is not None:  # the end of a value that began in an earlier split
                        out.append((value, inner, file, origin, block, True))
                        origin = None
                    else:
                        out.append((value, inner, file, None, block, True))
                if (file, block if origin is None else origin) in plan.endless and cutter.within and sum(map(len, cutter.held)) > 1 << 20:
                    part(file, block)
            if len(out) >= 4096:
                yield batch()
        close()
        if out:
            yield batch()

    found = rows.mapInArrow(cut, "value string, inner boolean, file string, origin long, block long, last boolean")
    names = ["value", "inner", "file"]
    if all(o is None for _, states in plan.places.values() for _, o in states):
        return found.select(*names)  # no value goes on in another split
    parts = F.array_sort(F.collect_list(F.struct("block", "value")))
    joined = found.where(F.col("origin").isNotNull()).groupBy("file", "origin").agg(
        F.array_join(F.transform(parts, lambda p: p["value"]), "\n").alias("value"), F.bool_or("inner").alias("inner"))
    return found.where(F.col("origin").isNull()).select(*names).unionByName(joined.select(*names))


def cut_texts(df: DataFrame) -> DataFrame:
    """The pieces of the texts in the one column of ``df``, one row each (``value``)."""
    from ..session import ship_package

    ship_package(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = [p for text in b.column(0).to_pylist() for p in pieces(text)]
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.string())], names=["value"])

    return df.mapInArrow(run, "value string")
