import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from tokenizers import Tokenizer

from flexframe.llm import bpe, packing, token_counts

from .conftest import EDGES

MADE = [
    "plain<|endoftext|>text <|endoftext|> <|endoftext", "a  b   c    d", "tab\t\tx \n y\n\n  z ", " lead", "trail ", "it's we'll I'M 'tis",
    "x\x85y\xa0 z\x0b \x1c w", "²³ ½ Àé ªº ×÷", "漢字かな交じり文 text", "🙂🙂 é", "  sep　wide", "<|endoftext|>", "   ", "\n",
    "0123456789" * 30, "don't stop's ''s", "a\x00b \x00 c",
]


@pytest.fixture(scope="module")
def lib():
    return Tokenizer.from_file(bpe.default_path())


@pytest.mark.parametrize("ranked", [True, False])
def test_ids_are_the_librarys(lib, docs, ranked):
    own = bpe.ByteBPE(bpe.default_path(), bpe.prove_whole(bpe.default_path()))
    assert own.single is not None
    own.single = own.single if ranked else None
    rng = random.Random(4)
    alphabet = " aAbé'sl\n\t 1²½.,<|>endoftext漢🙂\xa0\x85"
    texts = [t for _, t in docs[:80]] + [t for _, t in EDGES[:12] if t] + MADE
    texts += ["".join(rng.choice(alphabet) for _ in range(rng.randrange(1, 60))) for _ in range(3000)]
    for t in texts:
        assert np.frombuffer(own.ids(t), np.uint32).tolist() == lib.encode(t, add_special_tokens=False).ids, repr(t)


def test_the_memo_stays_bounded(monkeypatch, lib):
    monkeypatch.setattr(bpe, "REMEMBERED", 5)
    own = bpe.ByteBPE(bpe.default_path(), {})
    text = " ".join(f"w{i}" for i in range(100))
    assert np.frombuffer(own.ids(text), np.uint32).tolist() == lib.encode(text).ids
    assert len(own.rest) <= 5 and len(own.rest.old) <= 5


def test_proof_of_whole_tokens(lib):
    whole = bpe.prove_whole(bpe.default_path())
    assert len(whole) > 50_000
    for letters in random.Random(1).sample(sorted(whole), 500):
        assert [t.id for t in lib.model.tokenize(letters)] == [whole[letters]]
    assert bpe.bpe_merge("abcd", {("a", "b"): 1, ("ab", "cd"): 3}) == ["ab", "c", "d"]


def test_count(spark, lib, docs, edges, empty):
    rows = docs[:60] + list(EDGES) + [(200 + i, t) for i, t in enumerate(MADE)]
    got = token_counts.count(spark, spark.createDataFrame(rows, "doc_id long, text string"))
    assert got.columns == ["doc_id", "n_bytes", "n_tokens", "over_limit"]
    want = Counter()
    for i, t in rows:
        n = len(lib.encode(t or "", add_special_tokens=False).ids)
        want[(i, len((t or "").encode()), n, n > 512)] += 1
    assert Counter(map(tuple, got.collect())) == want
    assert token_counts.count(spark, edges).count() == len(EDGES)
    assert token_counts.count(spark, empty).count() == 0


def check_packing(rows, texts, lib, capacity):
    """Every id of every document once, no sequence too long, offsets gapless."""
    bins = defaultdict(list)
    for r in rows:
        bins[r.sequence_id].append((r.offset, r.length))
    for parts in bins.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    want = Counter()
    for i, t in texts:
        ids = lib.encode(t or "", add_special_tokens=False).ids + [0]
        starts = [0] if len(ids) <= capacity else []
        if len(ids) > capacity:
            starts = list(range(len(ids) % capacity or capacity, len(ids), capacity))
            starts = [0] + starts
        for p, (a, b) in enumerate(zip(starts, starts[1:] + [len(ids)])):
            want[(i, p, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes()))] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == want
    total = sum(r.length for r in rows)
    return len(bins), -(-total // capacity)


def test_pack_documents(spark, lib, docs, edges, empty):
    rows = docs + list(EDGES)
    out = packing.pack_documents(spark, spark.createDataFrame(rows, "doc_id long, text string")).collect()
    used, least = check_packing(out, rows, lib, 2048)
    assert used <= least * 1.02 + 1
    check_packing(packing.pack_documents(spark, edges).collect(), EDGES, lib, 2048)
    assert packing.pack_documents(spark, empty).count() == 0


def test_blocks_merge_their_poor_bins(spark, lib, docs):
    rows = docs[:120]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    out = packing.pack_documents(spark, df, capacity=700, block=40).collect()
    used, least = check_packing(out, rows, lib, 700)
    assert used <= least * 1.03 + 1


def test_a_child_holds_every_piece_once():
    rng = random.Random(2)
    for capacity in (10, 100):
        sizes = np.array([rng.randrange(1, capacity + 1) for _ in range(200)])
        a, b = packing.first_population(sizes, capacity, 2, rng)
        for _ in range(20):
            child = packing.crossover(a, b, sizes, capacity, rng)
            fill = np.bincount(child, weights=sizes)
            assert fill.max() <= capacity and fill.min() > 0
            a, b = b, child


def test_evolution_never_gets_worse():
    rng = random.Random(7)
    sizes = np.array([rng.randrange(200, 900) for _ in range(400)])
    first = packing.first_population(sizes, 2048, 4, rng)
    start = min(packing.fitness(g, sizes, 2048) for g in first)
    end = packing.fitness(packing.evolve(first, sizes, 2048, 30, rng)[0], sizes, 2048)
    assert end <= start
