import random
import re
from collections import Counter, defaultdict

import pytest
from flexframe.llm import collocations

from .conftest import SF


def brute(rows, least, longest, top, inside=100):
    """The contract, word by word."""
    f, n = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", text):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            for m in range(1, longest + 1):
                f[lang].update(tuple(w[i:i + m]) for i in range(len(w) - m + 1))
    out = []
    for lang, count in f.items():
        found = {p: a for p, a in count.items() if len(p) >= 2 and a >= least}
        dropped = set()
        for p, a in found.items():
            for size in range(2, len(p)):
                for i in range(len(p) - size + 1):
                    q = p[i:i + size]
                    if 100 * a >= inside * found[q]:
                        dropped.add(q)
        best = []
        for p, a in found.items():
            if p not in dropped:
                s, k = min((1000 * a * n[lang] // (count[p[:k]] * count[p[k:]]), k) for k in range(1, len(p)))
                best.append((-s, -a, " ".join(p).encode(), count[p[:k]], count[p[k:]]))
        for rank, (s, a, p, left, right) in enumerate(sorted(best)[:top], 1):
            out.append((lang, rank, p.decode(), -a, left, right, n[lang], -s))
    return sorted(out)


def got(df):
    return sorted(tuple(r) for r in df.select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect())


@pytest.mark.parametrize("budget", [1 << 20, 200])
def test_given_documents(spark, budget):
    df = spark.read.parquet(f"{SF}/documents.parquet")
    rows = [(r.lang, r.text) for r in df.select("lang", "text").collect()]
    assert got(collocations.mine(spark, df, least=20, top=50, budget=budget)) == brute(rows, 20, 5, 50)


def texts(seed, count=60):
    """Texts whose words hold control characters, marks of the tree's own form, case, blanks of all kinds."""
    draw = random.Random(seed)
    words = ["a", "A", "b", "a\x01", "a\x08b", "\x0e", "\x0en", "\x0eA", "é", "É", "漢字", "🙂", "\x1c", "\x85", "\xa0", "\x00", "aa", "x" * 300]
    blanks = [" ", "  ", "\t", ". ", "\n", "!", "\r\n", "\x0b", ",", " ", " ", " "]
    return ["".join(draw.choice(words) + draw.choice(blanks) for _ in range(draw.randint(0, 80))) for _ in range(count)]


@pytest.mark.parametrize("budget,longest,inside", [(1 << 20, 5, 100), (30, 5, 100), (30, 3, 100), (5, 5, 60), (30, 2, 100)])
def test_hostile_words(spark, budget, longest, inside):
    langs = ["en", None, "und", "", "l\tx", "l\n", "\x0e"]
    rows = [(langs[i % len(langs)], t) for i, t in enumerate(texts(budget, 140))] + [(None, None), ("en", "")]
    df = spark.createDataFrame(rows, "lang string, text string").selectExpr("*", "1 as key", "2 as n", "3 as phrase", "4 as rank").repartition(6)
    found = got(collocations.mine(spark, df, least=3, longest=longest, top=25, inside=inside, budget=budget))
    assert found == brute(rows, 3, longest, 25, inside)
    assert len(found) > 10


def test_a_third_of_all_words_is_split_over_groups(spark):
    rows = [("en", " ".join(("the" if i % 3 else f"w{i % 40}") for i in range(j, j + 200))) for j in range(40)] * 3
    df = spark.createDataFrame(rows, "lang string, text string")
    assert got(collocations.mine(spark, df, budget=150)) == brute(rows, 100, 5, 2000)


def test_no_candidates(spark, edges):
    assert got(collocations.mine(spark, edges.selectExpr("text", "shard as lang").where("false"))) == []
    assert got(collocations.mine(spark, spark.createDataFrame([("en", "a b c")], "lang string, text string"))) == []
    long = [("en", "word " * 30000), ("en", "x" * 50000), ("en", "ab. " * 500)]
    assert got(collocations.mine(spark, spark.createDataFrame(long, "lang string, text string"))) == brute(long, 100, 5, 2000)


def test_products_beyond_64_bits_are_exact(spark):
    a, n, left, right = 10 ** 15 + 1, 10 ** 18 + 3, 10 ** 9 + 7, 10 ** 9 + 9
    df = spark.createDataFrame([(a, n, left, right)], "a long, n long, l long, r long")
    assert df.select(collocations.score().alias("s")).first().s == 1000 * a * n // (left * right)
