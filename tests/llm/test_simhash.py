import random
import re
from collections import Counter

import xxhash

from flexframe.llm import simhash

from .conftest import EDGES


def fingerprint(text):
    text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    if not words:
        return 0
    parts = [" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    hashes = [xxhash.xxh64(p.encode(), seed=42).intdigest() for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute(rows, fps=None):
    fps = fps or [fingerprint(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= 2:
                root[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        r = find(i)
        least[r] = min((x for x in (d, least.get(r)) if x is not None), default=None)
    return Counter((d, f"{fps[i]:016x}", least[find(i)]) for i, (d, _) in enumerate(rows))


def test_against_brute_force(spark, docs):
    rng = random.Random(5)
    near = []
    for i, (d, t) in enumerate(docs[:60]):
        words = t.split(" ")
        words[rng.randrange(len(words))] = "changed"
        near.append((5000 + i, " ".join(words)))
    rows = docs + near + list(EDGES)
    got = simhash.cluster(spark, spark.createDataFrame(rows, "doc_id long, text string"))
    want = brute(rows)
    assert Counter(map(tuple, got.collect())) == want
    assert sum(n for (d, _, c), n in want.items() if d != c) > 30


def test_links_connect_what_lies_within_the_radius(spark):
    rng = random.Random(9)
    values = {0, (1 << 64) - 1}
    for _ in range(300):
        v = rng.getrandbits(64)
        values.add(v)
        for _ in range(rng.randrange(6)):  # chains of near values
            for _ in range(rng.randrange(1, 4)):
                v ^= 1 << rng.randrange(64)
            values.add(v)
    values = sorted(values)
    fps = spark.createDataFrame([(simhash._signed(v),) for v in values], "fp long")
    edges = simhash.links(fps, tile=16)
    got = {r.fp: r.root for r in simhash.components(spark, fps, edges).collect()}
    want = brute([(i, None) for i in range(len(values))], values)
    groups = {i: c for (i, _, c) in want}
    assert len(got) == len(values)
    names = {(got[simhash._signed(v)], groups[i]) for i, v in enumerate(values)}
    assert len(names) == len({a for a, _ in names}) == len({b for _, b in names})


def test_long_chains_and_stars(spark):
    chain = [(i, i + 1) for i in range(400)] + [(1000, 1000 + i) for i in range(1, 200)]
    edges = spark.createDataFrame(chain, "a long, b long")
    fps = spark.createDataFrame([(i,) for i in {x for e in chain for x in e} | {5555}], "fp long")
    roots = {r.fp: r.root for r in simhash.components(spark, fps, edges).collect()}
    assert len({roots[i] for i in range(401)}) == 1 and len({roots[1000 + i] for i in range(200)}) == 1
    assert len(set(roots.values())) == 3


def test_keep_one_and_edges(spark, edges, empty):
    assert simhash.cluster(spark, empty).count() == 0
    kept = simhash.keep_one(spark, edges)
    assert kept.columns == edges.columns
    ids = Counter(r.doc_id for r in kept.collect())
    want = Counter()
    for (d, _, c), n in brute(list(EDGES)).items():
        if d is None or d == c:
            want[d] += n
    assert ids == want


def test_keep_one_with_an_id_of_two_texts(spark):
    copy = "the quick brown fox jumps over the lazy dog near the river bank"
    other = "entirely different words about spark clusters and memory limits in production"
    df = spark.createDataFrame([(1, copy), (2, copy), (2, other), (3, other), (3, None)], "doc_id long, text string")
    kept = sorted((r.doc_id, r.text or "") for r in simhash.keep_one(spark, df).collect())
    assert kept == [(1, copy), (2, other), (3, "")]


def test_a_dense_cell_is_dealt_out_by_tile(spark):
    """Thousands of values in one cell, and values around it: the links are those of brute force, in many tasks."""
    import numpy as np

    rng = np.random.default_rng(4)
    base = np.uint64(0x5555_5555_5555_5555)
    values = {int(base)}
    while len(values) < 1200:  # two bits swapped within a segment keep the counts
        i, j = rng.integers(0, 5, 2) * 2
        a = rng.choice(list(values)[:60])
        values.add(int(np.uint64(a) ^ (np.uint64(1) << np.uint64(i)) ^ (np.uint64(2) << np.uint64(j)) ^ (np.uint64(3) << np.uint64(2 * int(rng.integers(6, 30))))))
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    fps = spark.createDataFrame([(v,) for v in signed], "fp long")
    roots = simhash.components(spark, fps, simhash.links(fps, 2, tile=64))
    got = {r.fp: r.root for r in roots.collect()}
    parent = {v: v for v in values}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    every = sorted(values)
    for i, x in enumerate(every):
        for y in every[i + 1:]:
            if (x ^ y).bit_count() <= 2:
                parent[root(x)] = root(y)
    groups, want = {}, {}
    for v, s in zip(values, signed):
        groups.setdefault(got[s], set()).add(v)
        want.setdefault(root(v), set()).add(v)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, want.values()))
