"""Phrase collocations by vertical partitioning: counts from truncated suffix subtrees, built group by group.

A suffix is the run of up to ``longest`` words from a position to the end of
its piece. The words of a phrase begin as many suffixes as the phrase occurs,
so counts are leaf totals below the nodes of a suffix tree cut at that depth.

1. **Prefixes.** Prefixes of one word, then of two frequent words, are counted
   over all texts, by language. A word that begins more than ``budget``
   suffixes is split by its next word; where a pair still begins too many,
   longer prefixes of such pairs are counted in one more pass.
2. **Groups.** What remains begins ``budget`` suffixes or fewer: large prefixes
   are packed into groups first-fit by size, the many small ones are dealt to
   further groups by hash. The split and the large prefixes are few by
   counting (they each begin a given share of all suffixes), so tasks know
   them; the small ones need no table.
3. **Subtrees.** Tasks combine equal suffixes; Spark brings each group to one
   task and sorts it. The task walks the sorted leaves with one counter for
   each depth, so its memory doesn't grow with the group, and reports nodes of
   ``least`` leaves or more.
4. **Scores.** Joins of the reported nodes; keys that many candidates share
   (frequent words) go through ``common.lookup``.

Suffixes are cut where a word, or a pair of neighbours, occurs fewer than
``least`` times: no candidate goes across. Tasks know the frequent ones by bit
tables of fixed size, with two bits for each. Three neighbours are counted in
buckets of a hash; in a bucket with fewer than ``least`` none of them is
frequent, so they are cut too. What isn't cut though it could be, since it
shares bits or a bucket with others, costs time and changes nothing.

Words are bytes between tab and blank after lower-casing A-Z; in the tree they
are joined by tabs, and control characters are escaped so that a tab sorts
before all else.

Defined results: null texts are empty; a null language is ``und``, the same as
that text; repeated rows each count; texts and words of any length are read
whole; ties go by score, count, phrase (byte order), which are unique; other
columns are ignored; an empty table, or one without candidates, gives an empty
result.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import lookup, staged

LEAST, LONGEST, TOP = 100, 5, 2000
#: Suffixes of a group; groups grow beyond it only where there would be more than MOST_GROUPS.
BUDGET, MOST_GROUPS = 1 << 20, 1 << 16
#: Prefixes of more than this part of a budget are packed by size.
LARGE = 4
#: Bits of a table of frequent words or pairs (8 MB), and where in a hash the two places of one begin.
BITS = 1 << 26
PLACES = (0, 26)
#: Buckets in which three neighbours are counted, and how many of them a row holds on the way to their sums.
BUCKETS, BLOCK = 1 << 22, 1 << 14
#: Entries that a task counts before it hands them over; words it remembers, and the longest of them that are in no table.
HELD, REMEMBERED, LONG = 1_000_000, 300_000, 64
#: Words that a task turns into numbers at once.
CHUNK = 200_000

_DELIMITERS, _BLANKS = b".,;:!?\n\x0b\x0c\r", b" \t"
#: What stands between pieces once a text is cut; no word holds it.
BREAK = b"."
_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
#: One byte to one byte: pieces end at a full stop, words at a blank.
PIECES = bytes(BREAK[0] if c in _DELIMITERS else 32 if c in _BLANKS else _LOWER[c] for c in range(256))
WORDS = bytes(32 if c in _DELIMITERS or c in _BLANKS else _LOWER[c] for c in range(256))
#: Bytes that would sort at or below the tab between words, and the mark that stands before their substitutes.
MARK = 0x0E
_LOW = re.compile(rb"[\x00-\x0e]")
_LOW_IN_WORDS = re.compile(rb"[\x00-\x08\x0e]")


def _escape(m: re.Match) -> bytes:
    return bytes([MARK, 0x60 + m[0][0]])


def encoded(text: str) -> bytes:
    return _LOW_IN_WORDS.sub(_escape, text.encode())


def prefix(lang: str) -> bytes:
    """What stands before the words of a language in the tree."""
    return _LOW.sub(_escape, lang.encode()) + b"\t"


def decoded(phrase: Column) -> Column:
    """The words of a phrase as they are, joined by blanks."""
    phrase = F.replace(phrase, F.lit("\t"), F.lit(" "))
    for c in range(MARK + 1):
        phrase = F.replace(phrase, F.lit(chr(MARK) + chr(0x60 + c)), F.lit(chr(c)))
    return phrase


def _counted_words(rows: DataFrame) -> DataFrame:
    """(key, n) of words, and of all words under the language's bare prefix, combined within tasks but not across them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, Counter] = {}
        size = 0

        def told() -> Iterator[pa.RecordBatch]:
            for lang, own in held.items():
                before = prefix(lang)
                yield pa.RecordBatch.from_arrays([pa.array([before + k for k in own], pa.binary()), pa.array(list(own.values()), pa.int64())],
                                                 names=["key", "n"])
            held.clear()

        for b in batches:
            for lang, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                words = encoded(text).translate(WORDS).split()
                if not words:
                    continue
                own = held.get(lang)
                if own is None:
                    own = held[lang] = Counter()
                size -= len(own)
                own[b""] += len(words)
                own.update(words)
                size += len(own)
                if size > HELD // 4:
                    yield from told()
                    size = 0
        yield from told()

    return rows.mapInArrow(run, "key binary, n long")


def _in_table(table: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    found = np.ones(len(hashes), bool)
    for start in PLACES:
        at = (hashes >> np.uint64(start)) & np.uint64(BITS - 1)
        found &= (table[at >> np.uint64(6)] >> (at & np.uint64(63))) & np.uint64(1) == 1
    return found


def _pair_hash(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """A hash of two word hashes, in which their order counts."""
    x = first * np.uint64(0x9E3779B97F4A7C15) ^ second
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(29))


def bit_table(keys: DataFrame, words: int) -> np.ndarray:
    """BITS bits, those of the keys (of one or two ``words``) set; Spark merges them, so the size is that of the table at most."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            hashes = []
            for key in b.column(0).to_pylist():
                lang, *own = key.split(b"\t")
                hashes.append([xxhash.xxh64_intdigest(lang + b"\t" + w, 42) for w in own])
            h = np.array(hashes, np.uint64).reshape(-1, words)
            h = h[:, 0] if words == 1 else _pair_hash(h[:, 0], h[:, 1])
            at = np.concatenate([(h >> np.uint64(start)) & np.uint64(BITS - 1) for start in PLACES])
            bit = np.uint64(1) << (at & np.uint64(63))
            yield pa.RecordBatch.from_arrays([pa.array((at >> np.uint64(6)).astype(np.int32)), pa.array(bit.view(np.int64))], names=["cell", "bit"])

    merged = keys.select("key").mapInArrow(run, "cell int, bit long").groupBy("cell").agg(F.bit_or("bit").alias("bits")).toArrow()
    table = np.zeros(BITS >> 6, np.uint64)
    table[merged["cell"].to_numpy()] = merged["bits"].to_numpy().view(np.uint64)
    return table


class _Words(dict):
    """Numbers of a language's words within a task: 0 for what is in no table, and for breaks between pieces."""

    def __init__(self, lang: str, table: np.ndarray):
        super().__init__()
        self.before, self.table = prefix(lang), table
        self.clear()

    def clear(self) -> None:
        super().clear()
        self.words, self.hashes = [b""], [0]
        self[BREAK] = 0

    def __missing__(self, word: bytes) -> int:
        h = xxhash.xxh64_intdigest(self.before + word, 42)
        places = [(h >> start) % BITS for start in PLACES]
        if all((int(self.table[at >> 6]) >> (at & 63)) & 1 for at in places):
            number = self[word] = len(self.words)
            self.words.append(word)
            self.hashes.append(h)
            return number
        if len(word) <= LONG:
            self[word] = 0
        return 0

    def forget(self) -> None:
        """Drops what is in no table, if much is remembered."""
        if len(self) > REMEMBERED + len(self.words):
            kept = {w: i for i, w in enumerate(self.words) if i}
            super().clear()
            self.update(kept)
            self[BREAK] = 0


class _Tally:
    """Counts of fixed-length keys (rows of numbers), combined as they pile up."""

    def __init__(self):
        self.keys: list[np.ndarray] = []
        self.counts: list[np.ndarray] = []
        self.waiting = self.size = 0

    def add(self, keys: np.ndarray) -> None:
        if len(keys):
            self.keys.append(keys)
            self.counts.append(np.ones(len(keys), np.int64))
            self.waiting += len(keys)
            if self.waiting > max(HELD, self.size):
                self.combine()

    def combine(self) -> None:
        if self.keys:
            keys, counts = np.concatenate(self.keys), np.concatenate(self.counts)
            order = np.lexsort(keys.T[::-1]) if keys.ndim > 1 else np.argsort(keys, kind="stable")
            keys, counts = keys[order], counts[order]
            new = np.ones(len(keys), bool)
            new[1:] = (keys[1:] != keys[:-1]).any(axis=1) if keys.ndim > 1 else keys[1:] != keys[:-1]
            starts = np.flatnonzero(new)
            self.keys, self.counts = [keys[starts]], [np.add.reduceat(counts, starts)]
            self.size, self.waiting = len(starts), 0


def _numbered(batches: Iterator[pa.RecordBatch], table: np.ndarray) -> Iterator[tuple[_Words, np.ndarray, np.ndarray]]:
    """(words known, numbers, hashes by number) of chunks of texts of one language; 0 stands between pieces and at the end.

    After the generator has handed a chunk over, the words may be cleared.
    """
    known: dict[str, _Words] = {}
    waiting: dict[str, list[bytes]] = {}

    def chunk(lang: str) -> tuple[_Words, np.ndarray, np.ndarray]:
        own = known.get(lang)
        if own is None:
            if len(known) >= 64:  # very many languages: their words are looked up anew
                known.clear()
            own = known[lang] = _Words(lang, table)
        tokens = waiting.pop(lang)
        numbers = np.fromiter(map(own.__getitem__, tokens), np.int64, len(tokens))
        return own, numbers, np.array(own.hashes, np.uint64)

    for b in batches:
        for lang, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
            own = waiting.setdefault(lang, [])
            own += encoded(text).translate(PIECES).replace(BREAK, b" . ").split()
            own.append(BREAK)
            if len(own) > CHUNK or len(waiting) > 64:
                for each in [lang] if len(own) > CHUNK else list(waiting):
                    found = chunk(each)
                    yield found
                    found[0].forget()
    for lang in list(waiting):
        yield chunk(lang)


def _counted_runs(rows: DataFrame, table: np.ndarray, keys_of: Callable[[np.ndarray, np.ndarray], np.ndarray],
                  extra: Callable[[bytes], int] | None = None) -> DataFrame:
    """(key, n) of runs of words in ``table``, combined within tasks but not across them.

    ``keys_of(numbers, hashes)`` gives the runs of a chunk of texts as rows of
    numbers, 0 after the last word; number 0 stands between runs.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tallies: dict[int, tuple[_Words, _Tally]] = {}  # by the words that give the numbers their meaning

        def told() -> Iterator[pa.RecordBatch]:
            for known, tally in tallies.values():
                tally.combine()
                if tally.size:
                    words, before, join = known.words, known.before, b"\t".join
                    runs = tally.keys[0].astype(np.int64)
                    for at in range(0, tally.size, 100_000):
                        keys = [before + join([words[i] for i in r if i]) for r in runs[at:at + 100_000].tolist()]
                        columns = [pa.array(keys, pa.binary()), pa.array(tally.counts[0][at:at + 100_000])]
                        if extra is not None:
                            columns.append(pa.array([extra(k) for k in keys], pa.int32()))
                        yield pa.RecordBatch.from_arrays(columns, names=["key", "n", "g"][:len(columns)])
                known.clear()
            tallies.clear()

        for known, numbers, hashes in _numbered(batches, table):
            tally = tallies.setdefault(id(known), (known, _Tally()))[1]
            tally.add(keys_of(numbers, hashes))
            if sum(t.size + t.waiting for _, t in tallies.values()) > 2 * HELD or sum(len(w.words) for w, _ in tallies.values()) > HELD:
                yield from told()
        yield from told()

    return rows.mapInArrow(run, "key binary, n long" + (", g int" if extra is not None else ""))


def _pairs(numbers: np.ndarray, _: np.ndarray) -> np.ndarray:
    """Neighbours."""
    both = (numbers[:-1] != 0) & (numbers[1:] != 0)
    return np.stack([numbers[:-1][both], numbers[1:][both]], axis=1).astype(np.int32)


def _triples(pairs: np.ndarray, numbers: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places at which three words begin whose neighbours are in the table of pairs, and the buckets of the three."""
    h = hashes[numbers]
    at = np.flatnonzero((numbers[:-1] != 0) & (numbers[1:] != 0))
    linked = np.zeros(len(numbers) + 1, bool)
    linked[at] = _in_table(pairs, _pair_hash(h[at], h[at + 1]))
    at = np.flatnonzero(linked[:-1] & linked[1:])
    return at, _pair_hash(_pair_hash(h[at], h[at + 1]), h[at + 2]) & np.uint64(BUCKETS - 1)


def _linked(pairs: np.ndarray, crowded: np.ndarray, longest: int) -> Callable[[np.ndarray, np.ndarray], np.ndarray]:
    """From each place the run of three to ``longest`` words that goes on while three neighbours are in a crowded bucket."""

    def keys(numbers: np.ndarray, hashes: np.ndarray) -> np.ndarray:
        starts, buckets = _triples(pairs, numbers, hashes)
        three = np.zeros(len(numbers) + longest, bool)
        three[starts] = crowded[buckets]
        starts = starts[crowded[buckets]]
        out = np.zeros((len(starts), longest), np.int32)
        for i in range(3):
            out[:, i] = numbers[starts + i]
        going = np.ones(len(starts), bool)
        for i in range(3, longest):
            going &= three[starts + i - 2]
            out[going, i] = numbers[starts[going] + i]
        return out

    return keys


def _crowded(rows: DataFrame, words: np.ndarray, pairs: np.ndarray, least: int) -> np.ndarray:
    """Which of the BUCKETS hold ``least`` or more occurrences of three neighbours."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, waiting = np.zeros(BUCKETS, np.int64), []
        for _, numbers, hashes in _numbered(batches, words):
            waiting.append(_triples(pairs, numbers, hashes)[1].astype(np.int64))
            if sum(map(len, waiting)) > HELD:
                counts += np.bincount(np.concatenate(waiting), minlength=BUCKETS)
                waiting = []
        if waiting:
            counts += np.bincount(np.concatenate(waiting), minlength=BUCKETS)
        blocks = counts.reshape(-1, BLOCK)
        some = np.flatnonzero(blocks.any(axis=1))
        yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array([blocks[i].tobytes() for i in some], pa.binary())],
                                         names=["block", "counts"])

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for b in batches:
            for block, counts in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                sums[block] = sums.get(block, 0) + np.frombuffer(counts, np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int32()), pa.array([np.packbits(x >= least).tobytes() for x in sums.values()], pa.binary())],
                                         names=["block", "bits"])

    spark = rows.sparkSession
    parts = rows.mapInArrow(counted, "block int, counts binary").repartition(spark.sparkContext.defaultParallelism * 2, "block")
    table = np.zeros((BUCKETS // BLOCK, BLOCK), bool)
    for r in parts.mapInArrow(summed, "block int, bits binary").collect():
        table[r.block] = np.unpackbits(np.frombuffer(r.bits, np.uint8)).astype(bool)
    return table.ravel()


class Groups:
    """Which group a suffix belongs to: ``split`` prefixes go on to their next word."""

    def __init__(self, counts: dict[bytes, int], total: int, budget: int, longest: int):
        self.split = {p for p, n in counts.items() if n > budget and p.count(b"\t") < longest}
        self.longest = longest
        # prefixes whose own parent is split (words have none)
        large = sorted(((n, p) for p, n in counts.items() if p not in self.split and n * LARGE > budget
                        and (p.count(b"\t") == 1 or p.rpartition(b"\t")[0] in self.split)), reverse=True)
        self.of: dict[bytes, int] = {}
        room: list[int] = []
        for n, p in large:  # first fit, by falling size; at most LARGE prefixes share a group, so few groups stay open
            g = next((i for i in range(max(0, len(room) - 4 * LARGE), len(room)) if room[i] >= n), len(room))
            if g == len(room):
                room.append(budget)
            room[g] -= n
            self.of[p] = g
        self.packed = len(room)
        rest = max(0, total - sum(n for n, _ in large))
        self.dealt = -(-rest // budget) + 1
        self.count = self.packed + self.dealt

        self.words: dict[bytes, int] = {}

    def __call__(self, key: bytes) -> int:
        at = key.index(b"\t")
        word = key[:key.index(b"\t", at + 1)]
        g = self.words.get(word)
        if g is not None:
            return g
        g = self._group(key, at)
        if word not in self.split:
            if len(self.words) > 500_000:
                self.words.clear()
            self.words[word] = g
        return g

    def _group(self, key: bytes, at: int) -> int:
        while True:
            at = key.find(b"\t", at + 1)
            p = key if at < 0 else key[:at]
            if at < 0 or p not in self.split:
                break
        g = self.of.get(p)
        return self.packed + zlib.crc32(p) % self.dealt if g is None else g


def _subtrees(leaves: DataFrame, split: set[bytes], least: int) -> DataFrame:
    """(key, n): nodes of three words or more with at least ``least`` leaves, from sorted leaves; not those in ``split``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        path: list[bytes] = []
        totals: list[int] = []
        last = None
        found: list[tuple[bytes, int]] = []

        def close(depth: int) -> None:
            while len(path) > depth:
                n = totals.pop()
                if n >= least and len(path) > 3:
                    key = b"\t".join(path)
                    if key not in split:
                        found.append((key, n))
                path.pop()
                if totals:
                    totals[-1] += n

        def told() -> pa.RecordBatch:
            keys, counts = zip(*found)
            found.clear()
            return pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), pa.array(counts, pa.int64())], names=["key", "n"])

        for b in batches:
            for key, n in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                if key == last:
                    totals[-1] += n
                    continue
                words = key.split(b"\t")
                same = 0
                for x, y in zip(path, words):
                    if x != y:
                        break
                    same += 1
                if same < len(path):
                    close(same)
                for w in words[same:]:
                    path.append(w)
                    totals.append(0)
                totals[-1] += n
                last = key
            if len(found) > 10_000:
                yield told()
        close(0)
        if found:
            yield told()

    return leaves.mapInArrow(run, "key binary, n long")


def _longer(spark: SparkSession, rows: DataFrame, pairs: DataFrame, word_table: np.ndarray, least: int, longest: int, budget: int) -> DataFrame:
    """(key, n) of the phrases of three words or more, from the subtrees."""
    pair_table = bit_table(pairs, 2)
    crowded = _crowded(rows, word_table, pair_table, least)
    # a pair's key without its second word
    first = F.regexp_replace(F.decode("key", "UTF-8"), "\t[^\t]*$", "").cast("binary")
    starts = pairs.groupBy(first.alias("key")).agg(F.sum("n").alias("n"))
    total = pairs.agg(F.sum("n")).first()[0] or 0
    budget = max(budget, -(-total // MOST_GROUPS))
    # prefixes that begin a given share of all suffixes: at most LARGE * MOST_GROUPS of each length
    many = F.col("n") * LARGE > budget
    large = {bytes(r.key): r.n for r in starts.where(many).unionByName(pairs.where(many)).collect()}
    wide = {p for p, n in large.items() if n > budget and p.count(b"\t") == 2}
    more = None
    if wide and longest > 3:
        # prefixes of wide pairs, from suffixes that are one word short
        wide_table = bit_table(pairs.where(F.col("n") > budget), 2)
        linked = _linked(pair_table, crowded, longest - 1)

        def below_wide(numbers: np.ndarray, hashes: np.ndarray) -> np.ndarray:
            keys = linked(numbers, hashes)
            keys = keys[_in_table(wide_table, _pair_hash(hashes[keys[:, 0]], hashes[keys[:, 1]]))]
            out = [keys]
            for m in range(3, longest - 1):  # each prefix of three words or more for itself
                cut = keys[keys[:, m] != 0]
                cut[:, m:] = 0
                out.append(cut)
            return np.concatenate(out)

        more = staged(spark, _counted_runs(rows, word_table, below_wide).groupBy("key").agg(F.sum("n").alias("n")).where(many), "collocation-prefixes")
        large.update((bytes(r.key), r.n) for r in more.collect())
    groups = Groups(large, total, budget, longest)
    leaves = _counted_runs(rows, word_table, _linked(pair_table, crowded, longest), groups).repartitionById(
        groups.count, F.col("g")).select("key", "n").sortWithinPartitions("key")
    nodes = _subtrees(leaves, groups.split, least)
    if more is not None:  # nodes that several groups share were counted as prefixes
        below = F.regexp_extract(F.decode("key", "UTF-8"), "^[^\t]*\t[^\t]*\t[^\t]*", 0).cast("binary")
        within = F.broadcast(pairs.where(F.col("n") > budget).select(F.col("key").alias("wide")))  # MOST_GROUPS rows at most
        nodes = nodes.unionByName(more.where((F.col("n") > budget) & (F.col("n") >= least)).join(within, below == F.col("wide"), "left_semi"))
    return nodes


def phrase_counts(spark: SparkSession, df: DataFrame, least: int = LEAST, longest: int = LONGEST, budget: int = BUDGET,
                  lang_col: str = "lang", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """(totals: lang, n), (nodes: lang, phrase, m, f): phrases of 1 to ``longest`` words that occur ``least`` times or more.

    ``phrase`` is in the form of the tree: words joined by tabs; see ``decoded``.
    """
    rows = df.select(F.coalesce(df[lang_col].cast("string"), F.lit("und")).alias("lang"), F.coalesce(df[text_col], F.lit("")).alias("text"))
    is_total = F.endswith(F.col("key"), F.lit(b"\t"))

    def summed(counts: DataFrame, label: str) -> DataFrame:
        return staged(spark, counts.groupBy("key").agg(F.sum("n").alias("n")).where(is_total | (F.col("n") >= least)), f"collocation-{label}")

    found = summed(_counted_words(rows), "words")
    totals, words = found.where(is_total), found.where(~is_total)
    nodes = words
    if longest > 1:
        word_table = bit_table(words, 1)
        pairs = summed(_counted_runs(rows, word_table, _pairs), "pairs")
        nodes = nodes.unionByName(pairs)
    if longest > 2:
        nodes = nodes.unionByName(_longer(spark, rows, pairs, word_table, least, longest, budget))
    text = F.decode("key", "UTF-8")
    parts = F.split(text, "\t")
    return (
        totals.select(decoded(parts[0]).alias("lang"), "n"),
        staged(spark, nodes.select(decoded(parts[0]).alias("lang"), F.array_join(F.slice(parts, F.lit(2), F.size(parts)), "\t").alias("phrase"),
                                   (F.size(parts) - 1).alias("m"), F.col("n").alias("f")), "collocation-nodes"),
    )


def score() -> Column:
    """floor(1000 a n / (l r)), exactly: 1000 a and n are below 2^63, so no product has more than 38 digits."""
    def wide(value: str) -> str:
        return f"cast({value} AS decimal(19,0))"

    return F.expr(f"({wide('1000 * a')} * {wide('n')}) div ({wide('l')} * {wide('r')})")


def mine(spark: SparkSession, df: DataFrame, least: int = LEAST, longest: int = LONGEST, top: int = TOP, inside: int = 100,
         budget: int = BUDGET, lang_col: str = "lang", text_col: str = "text") -> DataFrame:
    """The first ``top`` collocations of each language: lang, rank, phrase, a, l, r, n, score.

    A candidate goes if a longer candidate that contains it has at least
    ``inside`` hundredths of its count.
    """
    totals, nodes = phrase_counts(spark, df, least, longest, budget, lang_col, text_col)
    words = F.split("phrase", "\t")

    def piece(start: Column, length: Column) -> Column:
        return F.array_join(F.slice(words, start, length), "\t")

    candidates = nodes.where(F.col("m") >= 2)
    sizes = F.explode(F.sequence(F.lit(2), F.col("m") - 1)).alias("size")
    contained = candidates.where(F.col("m") >= 3).select("lang", "phrase", "m", "f", sizes).select(
        "lang", "f", "phrase", "size", F.explode(F.sequence(F.lit(1), F.col("m") - F.col("size") + 1)).alias("start")).select(
        "lang", piece(F.col("start"), F.col("size")).alias("phrase"), "f").groupBy("lang", "phrase").agg(F.max("f").alias("longer"))
    kept = candidates.join(contained, ["lang", "phrase"], "left").where(
        F.col("longer").isNull() | (F.col("longer") * 100 < F.col("f") * inside)).drop("longer")

    cuts = kept.select("lang", "phrase", "m", F.col("f").alias("a"), F.explode(F.sequence(F.lit(1), F.col("m") - 1)).alias("k"))
    sides = F.explode(F.array(
        F.struct(F.lit("l").alias("side"), piece(F.lit(1), F.col("k")).alias("part")),
        F.struct(F.lit("r").alias("side"), piece(F.col("k") + 1, F.col("m") - F.col("k")).alias("part")))).alias("s")
    parts = staged(spark, cuts.select("lang", "phrase", "a", "k", sides).select("lang", "phrase", "a", "k", "s.side", "s.part"), "collocation-parts")
    told = lookup(parts, nodes.select("lang", F.col("phrase").alias("part"), "f"), ["lang", "part"])
    both = staged(spark, told.groupBy("lang", "phrase", "a", "k").agg(
        F.max(F.when(F.col("side") == "l", F.col("f"))).alias("l"), F.max(F.when(F.col("side") == "r", F.col("f"))).alias("r")), "collocation-cuts")
    scored = lookup(both, totals, ["lang"]).withColumn("score", score())
    least_cut = F.min(F.struct("score", "k", "l", "r", "a", "n")).alias("c")
    best = scored.groupBy("lang", "phrase").agg(least_cut).select("lang", decoded(F.col("phrase")).alias("phrase"), "c.a", "c.l", "c.r", "c.n", "c.score")
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase")]
    # first by parts of a language, so that the last sort reads a bounded number of rows of each
    some = best.withColumn("branch", F.pmod(F.xxhash64("phrase"), F.lit(64))).withColumn(
        "rank", F.row_number().over(W.partitionBy("lang", "branch").orderBy(*order))).where(F.col("rank") <= top)
    return some.withColumn("rank", F.row_number().over(W.partitionBy("lang").orderBy(*order))).where(F.col("rank") <= top).select(
        "lang", "rank", "phrase", "a", "l", "r", "n", "score")
