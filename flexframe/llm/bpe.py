"""Byte-level BPE through the tokenizer library, with exact shortcuts around it.

* Whole tokens: a vocabulary string whose merges end in one token needs no
  merging when it is met as a pre-token. ``prove_whole`` runs the merges of
  every vocabulary string once, offline, and keeps those that end so.
* Chunks: a cut between a character that isn't blank and a space is a cut
  between pre-tokens whatever surrounds it, so a text falls into chunks
  (" word,") whose tokens don't depend on each other. Chunks are remembered in
  a bounded table.

Texts beyond Latin-1 are cut into pre-tokens by the library itself, so the
Unicode tables are always the library's.
"""

from __future__ import annotations

import json
import re
from array import array
from functools import lru_cache

import public_tokenizers
import tiktoken
from tokenizers import Tokenizer

from .common import Memo

#: Remembered chunks that a worker holds at most, in each of two generations.
REMEMBERED = 250_000
#: Longer chunks are not remembered.
CHUNK_CHARS = 64

_L, _N, _S = "A-Za-zªµºÀ-ÖØ-öø-ÿ", "0-9²³¹¼-¾", r"\t\n\x0b\x0c\r \x85\xa0"
#: The pre-token pattern of the byte-level scheme, written out for Latin-1.
LATIN = re.compile(
    f"'(?:[stmd]|re|ve|ll)| ?[{_L}]+| ?[{_N}]+| ?[^{_S}{_L}{_N}]+|[{_S}]+(?![^{_S}])|[{_S}]+")
#: A space after a blank: there, chunks would depend on each other.
_UNSAFE = tuple(b + " " for b in "\t\n\x0b\x0c\r \x85\xa0")


def byte_letters() -> list[str]:
    """The letter that stands for each byte: printable Latin-1 for itself, the rest from U+0100 up."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = iter(range(0x100, 0x200))
    return [chr(b) if b in set(plain) else chr(next(rest)) for b in range(256)]


class ByteBPE:
    """Ids of texts as the library gives them, without added special tokens at the ends.

    ``whole`` maps proven whole-token letters to ids; other pre-tokens are merged by the library.
    """

    def __init__(self, path: str, whole: dict[str, int]):
        self.lib = Tokenizer.from_file(path)
        self.model, self.pre = self.lib.model, self.lib.pre_tokenizer
        special = self.lib.get_added_tokens_decoder()
        if any(t.lstrip or t.rstrip or t.single_word for t in special.values()):
            raise ValueError("added tokens that take blanks with them, or must stand alone, are not supported")
        added = {t.content: i for i, t in special.items()}
        # a text without any of their first letters holds none of them
        self.marks = sorted({k[0] for k in added if k})
        self.added = {k: array("I", [v]).tobytes() for k, v in added.items()}
        self.cut = re.compile("(" + "|".join(map(re.escape, sorted(added, key=len, reverse=True))) + ")") if added else None
        self.whole = {k: array("I", [v]).tobytes() for k, v in whole.items()}
        letters = byte_letters()
        self.letters = dict(enumerate(letters))
        self.bytes_of = {c: b for b, c in enumerate(letters)}
        # merges by the same ranks, faster than through the library's token objects
        core = _ranked(path)
        self.single = core._core_bpe.encode_single_piece if core else None
        back = {ord(c): b for b, c in enumerate(letters)}
        self.known = {}
        for k, v in whole.items():
            try:
                self.known[k.translate(back).encode("latin-1").decode("utf-8")] = self.whole[k]
            except UnicodeDecodeError:
                pass  # part of a character: never a pre-token
        self.first = Memo(self._chunk, REMEMBERED, CHUNK_CHARS)
        self.rest = Memo(lambda part: self._chunk(" " + part), REMEMBERED, CHUNK_CHARS)
        self.lettered = Memo(self._piece, REMEMBERED // 4, CHUNK_CHARS)

    def _piece(self, letters: str) -> bytes:
        """Ids of one pre-token, given as byte letters: a whole token, or merged."""
        known = self.whole.get(letters)
        if known is not None:
            return known
        if self.single:
            return array("I", self.single(bytes(map(self.bytes_of.__getitem__, letters)))).tobytes()
        return array("I", [t.id for t in self.model.tokenize(letters)]).tobytes()

    def _merge(self, pre_token: str) -> bytes:
        known = self.known.get(pre_token)
        if known is not None:
            return known
        if self.single:
            return array("I", self.single(pre_token.encode("utf-8"))).tobytes()
        return self._piece(pre_token.encode("utf-8").decode("latin-1").translate(self.letters))

    def _chunk(self, chunk: str) -> bytes:
        return b"".join(map(self._merge, LATIN.findall(chunk)))

    def _plain(self, text: str) -> bytes:
        try:
            text.encode("latin-1")
        except UnicodeEncodeError:
            return b"".join(self.lettered[x] for x, _ in self.pre.pre_tokenize_str(text))
        if any(x in text for x in _UNSAFE):
            return self._chunk(text)
        first, *rest = text.split(" ")
        return self.first[first] + b"".join(map(self.rest.__getitem__, rest))

    def ids(self, text: str) -> bytes:
        """The ids of ``text`` as native unsigned 32-bit numbers."""
        if self.cut is None or not any(m in text for m in self.marks):
            return self._plain(text)
        return b"".join(self.added[x] if x in self.added else self._plain(x) for x in self.cut.split(text) if x)


def bpe_merge(letters: str, ranks: dict[tuple[str, str], int]) -> list[str]:
    """The merges of one string: the earliest rule first, leftmost first."""
    parts = list(letters)
    while len(parts) > 1:
        rank, at = min((ranks.get(p, 1 << 60), i) for i, p in enumerate(zip(parts, parts[1:])))
        if rank == 1 << 60:
            break
        parts[at:at + 2] = [parts[at] + parts[at + 1]]
    return parts


@lru_cache(maxsize=4)
def prove_whole(path: str) -> dict[str, int]:
    """The vocabulary strings whose own merges end in that one token, with their ids."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    model = spec["model"]
    ranks = {tuple(m.split(" ")) if isinstance(m, str) else tuple(m): i for i, m in enumerate(model["merges"])}
    special = {t["content"] for t in spec.get("added_tokens") or []}
    return {s: i for s, i in model["vocab"].items() if s not in special and bpe_merge(s, ranks) == [s]}


@lru_cache(maxsize=4)
def _ranked(path: str) -> tiktoken.Encoding | None:
    """The vocabulary as ranks, if ids rise in the order of the merges (then both ways merge alike)."""
    with open(path, encoding="utf-8") as f:
        model = json.load(f)["model"]
    merged = ["".join(m.split(" ") if isinstance(m, str) else m) for m in model["merges"]]
    numbers = [model["vocab"][m] for m in merged]
    back = {c: b for b, c in enumerate(byte_letters())}
    singles = [c for c in model["vocab"] if len(c) == 1]
    if numbers != sorted(set(numbers)) or len(singles) != 256 or max(model["vocab"][c] for c in singles) > numbers[0]:
        return None
    ranks = {bytes(map(back.__getitem__, s)): model["vocab"][s] for s in [*singles, *merged]}
    return tiktoken.Encoding("own", pat_str=r".+", mergeable_ranks=ranks, special_tokens={})


def default_path() -> str:
    return public_tokenizers.path("byte_bpe_50k.json")


_LOADED: dict[str, ByteBPE] = {}


def loaded(path: str, whole: dict[str, int]) -> ByteBPE:
    """The tokenizer of this worker process, made once."""
    if path not in _LOADED:
        _LOADED[path] = ByteBPE(path, whole)
    return _LOADED[path]
