"""SentencePiece encoding and decoding by a streaming Viterbi search.

The text is walked once; for each position the best last piece is kept with a
back pointer. Only a window of one maximum piece length can still be built on:
whenever the paths to all positions in it run through one boundary, the ids
before that boundary are final, are committed, and their back pointers go.

What a step may be depends on the kind of the model file:

* unigram: any piece; the best sum of scores wins (ties: the longer piece).
* BPE: a piece may follow another only if the merges of their joint text end
  in just these two. A segmentation in which all neighbours fit is the one the
  merges give, and each position has exactly one such path, so the search
  gives the ids of the merge order without its queue over the whole text.

Where no piece goes on with a space mark after another character, a mark after
a word is always a boundary, whatever stands around it, and the ids of the
stretch up to it are remembered in a bounded table.

Defined results: null text is empty and has no ids; a character without a
piece falls back to its UTF-8 bytes, or to the unknown id if the model has no
byte pieces; a text's own space marks (U+2581) decode to spaces, as in the
library; texts of any length are encoded whole; repeated rows repeat; other
columns are ignored; an empty table gives an empty result. Normalisation other
than the leading mark and marks for spaces isn't done: ``Codec`` raises for
models that ask for it.
"""

from __future__ import annotations

import re
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pandas as pd
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from sentencepiece import sentencepiece_model_pb2

from .common import Memo, id_text

MARK = "▁"
UNKNOWN_PENALTY = 10.0
#: Words and pairs of pieces that a worker remembers, at most so many in each of two generations.
REMEMBERED = 300_000
#: Longer words are searched each time, so that the tables stay small; the search is the same.
KEY_CHARS = 64


class Codec:
    """The pieces of a model file; spaces become marks, and one mark leads the text."""

    def __init__(self, path: str):
        with open(path, "rb") as f:
            self._read(f.read())

    @classmethod
    def from_bytes(cls, model: bytes) -> Codec:
        out = cls.__new__(cls)
        out._read(model)
        return out

    def _read(self, model: bytes) -> None:
        spec = sentencepiece_model_pb2.ModelProto()
        spec.ParseFromString(model)
        n = spec.normalizer_spec
        if n.precompiled_charsmap or n.remove_extra_whitespaces or not (n.add_dummy_prefix and n.escape_whitespaces):
            raise ValueError("the model asks for a normalisation that is not supported")
        kinds = spec.trainer_spec
        if kinds.model_type not in (kinds.UNIGRAM, kinds.BPE):
            raise ValueError("only unigram and BPE models are supported")
        self.merges = kinds.model_type == kinds.BPE
        kind = sentencepiece_model_pb2.ModelProto.SentencePiece
        if any(p.type == kind.USER_DEFINED for p in spec.pieces):
            raise ValueError("user-defined pieces are not supported")
        self.text_of = [p.piece for p in spec.pieces]
        self.pieces = {p.piece: (i, p.score) for i, p in enumerate(spec.pieces) if p.type == kind.NORMAL}
        self.bytes_of = {i: int(p.piece[1:-1], 16) for i, p in enumerate(spec.pieces) if p.type == kind.BYTE}
        self.byte_ids = {b: i for i, b in self.bytes_of.items()}
        self.silent = {i for i, p in enumerate(spec.pieces) if p.type == kind.CONTROL}
        self.unknown = next(i for i, p in enumerate(spec.pieces) if p.type == kind.UNKNOWN)
        self.longest = max(map(len, self.pieces))
        # by id; the last, which -1 names, is that of a character without a piece
        self.scores = [p.score for p in spec.pieces] + [min(s for _, s in self.pieces.values()) - UNKNOWN_PENALTY]
        # neighbouring characters that some piece holds; between any others there is always a boundary
        self.pairs = {p[i:i + 2] for p in self.pieces for i in range(len(p) - 1)}
        # whether a mark after another character is always a boundary
        self.words_part = not any(re.search(f"[^{MARK}]{MARK}", p) for p in self.pieces)
        # pieces that are text by themselves; bytes beyond ASCII are not
        self.alone = [chr(self.bytes_of[i]) if i in self.bytes_of else "" if i in self.silent else p.replace(MARK, " ")
                      for i, p in enumerate(self.text_of)]
        self.high = np.array([i for i, b in self.bytes_of.items() if b >= 0x80], dtype=np.int64)
        self.parts = Memo(self._encoded, REMEMBERED // 4, KEY_CHARS)
        self.words = Memo(lambda word: self._stretch(MARK + word), REMEMBERED, KEY_CHARS)
        # by the id of a piece: whether another may follow it
        self.follows: list[dict[int, bool]] = [{} for _ in spec.pieces]
        self.known = 0
        if self.merges:  # a piece that its own merges don't make is never met
            self.pieces = {p: v for p, v in self.pieces.items() if self.merged(p) == [p]}
        # pieces letter by letter: (id or -1, what may come next)
        self.beginnings: dict[str, tuple[int, dict]] = {}
        for p in sorted(self.pieces, key=len):
            at = self.beginnings
            for c in p[:-1]:
                at = at.setdefault(c, (-1, {}))[1]
            at[p[-1]] = (self.pieces[p][0], at.get(p[-1], (-1, {}))[1])

    def normalise(self, text: str) -> str:
        return MARK + text.replace(" ", MARK) if text else ""

    def _ids(self, piece: str, number: int) -> list[int]:
        if number >= 0:
            return [number]
        if len(self.byte_ids) < 256:
            return [self.unknown]
        return [self.byte_ids[b] for b in piece.encode("utf-8", "surrogatepass")]

    def merged(self, text: str) -> list[str]:
        """The merges of a short text from its characters: best score first, leftmost first."""
        parts, pieces = list(text), self.pieces
        while len(parts) > 1:
            best, at = None, -1
            for i in range(len(parts) - 1):
                entry = pieces.get(parts[i] + parts[i + 1])
                if entry is not None and (best is None or entry[1] > best):
                    best, at = entry[1], i
            if best is None:
                break
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def _fits(self, before: int, a: str, after: int, b: str) -> bool:
        """Whether piece ``b`` may follow piece ``a`` in a BPE segmentation (remembered by id)."""
        found = self.merged(a + b) == [a, b]
        if before >= 0 and after >= 0:
            if self.known >= REMEMBERED:
                for row in self.follows:
                    row.clear()
                self.known = 0
            self.follows[before][after] = found
            self.known += 1
        return found

    def stream(self, text: str) -> Iterator[list[int]]:
        """Ids of normalised ``text``, in the portions in which they become final."""
        n, done, check, base, longest = len(text), 0, 2 * self.longest, 0, self.longest
        merges, beginnings, follows, fits, scores = self.merges, self.beginnings, self.follows, self._fits, self.scores
        none, no_row = (-1, None), {}
        # by position from ``base`` on: start (-2: not reached yet) and id of the best path's last piece, and its score (unigram)
        start, piece, score = [-1] + [-2] * longest, [-1] * (longest + 1), [0.0] * (longest + 1)
        for at in range(n):
            # the path to this place is final: no piece that begins later ends here
            k = e = at - base
            before, last = start[k], piece[k]
            row = follows[last] if last >= 0 else no_row
            number, longer = beginnings.get(text[at], none)
            while True:
                e += 1
                if number >= 0 or e == k + 1:  # a piece that begins here, or a character that is none
                    if merges:
                        if start[e] == -2:  # no longer piece fits
                            fit = True if before < 0 else row.get(number)
                            if fits(last, text[before:at], number, text[at:base + e]) if fit is None else fit:
                                start[e], piece[e] = at, number
                    else:
                        total = score[k] + scores[number]
                        if start[e] == -2 or total > score[e]:
                            start[e], piece[e], score[e] = at, number, total
                if not longer or base + e == n:
                    break
                node = longer.get(text[base + e])
                if node is None:
                    break
                number, longer = node
            start.append(-2)
            piece.append(-1)
            if not merges:
                score.append(0.0)
            end = at + 1
            if end - done >= check:
                ends = set(range(max(done, end - longest + 1), end + 1))
                while len(ends) > 1:  # back along all paths that can go on, the furthest end first
                    far = max(ends)
                    ends.discard(far)
                    ends.add(max(done, start[far - base]))
                boundary = ends.pop()
                if boundary > done:
                    yield self._path(text, done, boundary, start, piece, base)
                    # the boundary's own last piece stays: what follows must fit it
                    cut = boundary - base
                    start, piece, score, base = start[cut:], piece[cut:], score[cut:], boundary
                    done, check = boundary, 2 * longest
                else:
                    check += longest
        if n > done:
            yield self._path(text, done, n, start, piece, base)

    def _path(self, text: str, first: int, end: int, start: list, piece: list, base: int) -> list[int]:
        steps = []
        while end > first:
            steps.append((start[end - base], end, piece[end - base]))
            end = start[end - base]
        return [i for a, b, number in reversed(steps) for i in self._ids(text[a:b], number)]

    def _stretch(self, text: str) -> bytes:
        """A word, cut where no piece goes across (at punctuation and line ends, mostly)."""
        pairs = self.pairs
        if text[1:].isalnum():
            return self._encoded(text)
        cuts = [i for i in range(1, len(text)) if text[i - 1:i + 1] not in pairs]
        if not cuts:
            return self._encoded(text)
        return b"".join(self.parts[text[a:b]] for a, b in zip([0, *cuts], [*cuts, len(text)]))

    def encode(self, text: str) -> bytes:
        """The ids of ``text`` as native 32-bit numbers."""
        whole = self.normalise(text)
        if not self.words_part:
            return self._encoded(whole)
        # a boundary before every mark that follows another character
        words = whole.split(MARK)[1:]
        if "" in words:  # runs of marks stay together
            return b"".join(map(self._stretch, re.findall(f"{MARK}*[^{MARK}]+|{MARK}+$", whole)))
        return b"".join(map(self.words.__getitem__, words))

    def _encoded(self, text: str) -> bytes:
        ids = array("i")
        for portion in self.stream(text):
            ids.extend(portion)
        return ids.tobytes()

    def decode(self, ids) -> str:
        """The text of ``ids`` (an array): bytes joined, marks to spaces, one leading space taken off."""
        numbers = ids.tolist()
        if not len(self.high) or not ((ids >= self.high.min()) & (ids <= self.high.max())).any():
            text = "".join(map(self.alone.__getitem__, numbers))
        else:
            out, raw = [], bytearray()
            for i in numbers:
                byte = self.bytes_of.get(i)
                if byte is not None:
                    raw.append(byte)
                    continue
                if raw:
                    out.append(raw.decode("utf-8", "replace"))
                    raw.clear()
                out.append(self.alone[i])
            text = "".join(out) + raw.decode("utf-8", "replace")
        return text[1:] if text.startswith(" ") else text


_LOADED: dict[str, Codec] = {}


def loaded(path: str) -> Codec:
    """The codec of this worker process, made once."""
    if path not in _LOADED:
        _LOADED[path] = Codec(path)
    return _LOADED[path]


def default_path() -> str:
    return public_tokenizers.path("piece_bpe_32k.model")


def encode(df: DataFrame, path: str | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id``, ``text`` (as encoded) and ``ids``: a row per row of ``df``."""
    path = path or default_path()
    base = id_text(df, id_col, text_col)
    kind = base.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = loaded(path)
        for b in batches:
            ids = [codec.encode(t.as_py()) for t in b.column(1)]
            ends = array("i", [0])
            for x in ids:
                ends.append(ends[-1] + len(x) // 4)
            values = pa.Array.from_buffers(pa.int32(), ends[-1], [None, pa.py_buffer(b"".join(ids))])
            lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), values)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), lists], names=["doc_id", "text", "ids"])

    return base.mapInArrow(run, f"doc_id {kind}, text string, ids array<int>")


def decode(df: DataFrame, path: str | None = None, ids_col: str = "ids", out_col: str = "decoded") -> DataFrame:
    """``df`` with ``out_col``: the text of the ids (null ids: null). An ``out_col`` of ``df`` is replaced."""
    path = path or default_path()

    def texts(ids: pd.Series) -> pd.Series:
        codec = loaded(path)
        return pd.Series([None if x is None else codec.decode(x) for x in ids], dtype=object)

    return df.withColumn(out_col, F.pandas_udf(texts, "string")(df[ids_col]))


def digest(df: DataFrame, path: str | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_chars, n_ids, ids_crc32, round_trip``: every text encoded, and decoded again to compare.

    ``ids_crc32`` is over the ids as little-endian 32-bit numbers. Both ways
    run in one pass with one codec; the ids don't leave the task.
    """
    path = path or default_path()
    base = id_text(df, id_col, text_col)
    kind = base.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = loaded(path)
        for b in batches:
            rows = []
            for t in b.column(1):
                text = t.as_py()
                ids = np.frombuffer(codec.encode(text), dtype=np.int32)
                rows.append((len(text), len(ids), zlib.crc32(ids.astype("<i4").tobytes()), codec.decode(ids) == text))
            chars, n, crc, same = zip(*rows) if rows else ((), (), (), ())
            yield pa.RecordBatch.from_arrays(
                [b.column(0), *(pa.array(x, pa.int64()) for x in (chars, n, crc)), pa.array(same, pa.bool_())],
                names=["doc_id", "n_chars", "n_ids", "ids_crc32", "round_trip"])

    return base.mapInArrow(run, f"doc_id {kind}, n_chars long, n_ids long, ids_crc32 long, round_trip boolean")
