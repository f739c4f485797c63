import hashlib
import random
from collections import Counter

import pytest

from flexframe.llm import suffix_dedup

from .conftest import EDGES


def brute(rows, length=100):
    """Every string of every distinct (id, text) in order, in one table."""
    seen, out = {}, {}
    distinct = {(i, t or "") for i, t in rows}
    order = sorted(distinct, key=lambda x: (x[0] is not None, x[0] or 0))
    for n, (i, t) in enumerate(order):
        b = t.encode()
        gone = bytearray(len(b))
        for s in range(len(b) - length + 1):
            if seen.setdefault(b[s:s + length], (n, s)) != (n, s):
                gone[s:s + length] = b"\1" * length
        kept = bytes(x for x, g in zip(b, gone) if not g)
        spans = sum(1 for k in range(len(gone)) if gone[k] and (k == 0 or not gone[k - 1]))
        out[(i, t)] = (len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest(), kept)
    return [(i, *out[(i, t or "")][:4]) for i, t in rows], {k: v[4] for k, v in out.items()}


def made():
    rng = random.Random(11)
    words = [f"w{i}" for i in range(300)]
    say = lambda n: " ".join(rng.choice(words) for _ in range(n))
    shared, short = say(60), say(25)
    rows = []
    for i in range(60):
        t = say(rng.randrange(5, 120))
        if i % 3 == 0:
            t += " " + shared + " " + say(rng.randrange(0, 30))
        if i % 4 == 0:
            t = short[:rng.randrange(80, 110)] + t
        if i % 10 == 0:
            t = t + " é " + t
        rows.append((i * 7 % 61, t))
    base = say(200)
    for i in range(25):  # near copies with edits anywhere
        x = list(base)
        for _ in range(rng.randrange(0, 6)):
            x[rng.randrange(len(x))] = rng.choice("#@é")
        rows.append((100 + i, "".join(x)))
    rows += [(200, "a" * 500), (201, "a" * 99), (202, "ab" * 200), (203, "a" * 350 + "b" * 150), (204, base), (205, base)]
    return rows


@pytest.mark.parametrize("strip,combine", [(1 << 20, 1 << 19), (1500, 200)])
def test_against_brute_force(spark, docs, strip, combine):
    rows = made() + [(1000 + i, t) for i, t in docs[:60]]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = suffix_dedup.dedup(spark, df, strip=strip, combine=combine)
    assert got.columns == ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
    want, _ = brute(rows)
    assert Counter(map(tuple, got.collect())) == Counter(want)
    assert sum(r[2] for r in want) > 5000


def test_edges(spark, edges, empty):
    got = {tuple(r) for r in suffix_dedup.dedup(spark, edges).collect()}
    # two texts under id 9 are short; ids 8 repeat one text and count once
    want, _ = brute([r for r in EDGES if r[0] != 10])
    assert {r for r in got if r[0] != 10} == set(want)
    assert suffix_dedup.dedup(spark, edges).count() == len(EDGES)
    long = next(r for r in got if r[0] == 10)
    assert long[1] == 150_000 and long[2] == 150_000 - 5 - 0  # all but the first period's starts
    assert suffix_dedup.dedup(spark, empty).count() == 0


def test_other_lengths(spark):
    rows = made()[:40]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    want, _ = brute(rows, 60)
    assert Counter(map(tuple, suffix_dedup.dedup(spark, df, 60).collect())) == Counter(want)
    with pytest.raises(ValueError):
        suffix_dedup.dedup(spark, df, 20)


def test_cut_keeps_rows_and_columns(spark, edges):
    out = suffix_dedup.cut(spark, edges)
    assert out.columns == edges.columns and out.count() == len(EDGES)
    rows = made()
    df = spark.createDataFrame([(i, t, i) for i, t in rows], "doc_id long, text string, ord long")
    _, kept = brute(rows)
    for r in suffix_dedup.cut(spark, df).collect():
        text = next(t for i, t in rows if i == r.doc_id and (i, t) in kept)
        assert r.ord == r.doc_id and r.text == kept[(r.doc_id, text)].decode("utf-8", "ignore")
