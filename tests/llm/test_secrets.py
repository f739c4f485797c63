import hashlib
import math
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from flexframe.llm import secret_scan

from .conftest import EDGES, SF

BASE = [
    ("assign", r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
     re.I | re.A, lambda m: len(m[2]) >= 6),
    ("access", r"AKIA[A-Z0-9]+", 0, lambda m: len(m[0]) >= 20),
    ("hex", r"[0-9a-f]+", 0, lambda m: len(m[0]) >= 24),
]


def brute_base(text):
    out = []
    for rank, (kind, pattern, flags, ok) in enumerate(BASE):
        # only keyword letters come in either case, and the value class holds both cases anyway
        out += [(m.start(), rank, m.end(), kind) for m in re.finditer(pattern, text or "", flags) if ok(m)]
    return sorted(out)


def brute_added(text):
    """Recounts every window from nothing."""
    out = []
    for m in re.finditer(r"[A-Za-z0-9+/=_-]{20,}", text or ""):
        s = m[0]
        cls = secret_scan.CLASSES[0] if re.fullmatch("[0-9A-Fa-f]{20,}", s) else secret_scan.CLASSES[1]
        if any(re.search(r, s) for r in secret_scan.ALLOW):
            continue
        s = s.lower() if cls.fold else s
        best = max(-sum(c / 20 * math.log2(c / 20) for c in Counter(s[i:i + 20]).values()) for i in range(len(s) - 19))
        if best >= cls.bits - 1e-9:
            out.append((m.start(), 3, m.end(), "entropy"))
    return out


def entropic(s, cls):
    s = s.lower() if cls.fold else s
    best = max(-sum(c / 20 * math.log2(c / 20) for c in Counter(s[i:i + 20]).values()) for i in range(len(s) - 19))
    return best >= cls.bits - 1e-9


def judged(s, rules):
    """Whether a stretch of 20 characters or more is a secret."""
    cls = secret_scan.CLASSES[0] if re.fullmatch("[0-9A-Fa-f]{20,}", s) else secret_scan.CLASSES[1]
    return not any(re.search(r, s) for r in rules) and entropic(s, cls)


def brute_parts(text):
    """Spans of runs and of parts of runs: every place of a run is tried by itself."""
    out = []
    harmless = re.compile(secret_scan.HARMLESS)
    for m in re.finditer(r"[A-Za-z0-9+/=_-]{20,}", text):
        run = m[0]
        if judged(run, secret_scan.ALLOW):
            out.append((m.start(), m.end()))
            continue
        if any(re.search(r, run) for r in secret_scan.WHOLE):
            continue
        cut, at = [False] * len(run), 0
        while at < len(run):
            found = harmless.match(run, at)
            if found and found.end() > at:
                cut[at:found.end()] = [True] * (found.end() - at)
                at = found.end()
            else:
                at += 1
        parts, at = [], 0
        for a, b in [(a, next((j for j in range(a, len(run)) if cut[j]), len(run))) for a in range(len(run)) if not cut[a] and (a == 0 or cut[a - 1])]:
            if b - a < 20:
                continue
            if judged(run[a:b], secret_scan.WHOLE):
                parts.append((a, b))
            else:
                parts += [(a + h.start(), a + h.end()) for h in re.finditer("[0-9A-Fa-f]{20,}", run[a:b]) if judged(h[0], secret_scan.WHOLE)]
        for i, (a, b) in enumerate(parts):
            near = i + 1 < len(parts) and parts[i + 1][0] - b < 20
            out.append((m.start() + a, m.start() + (parts[i + 1][0] if near else b)))
    return sorted(out)


def listed(spans):
    return ",".join(f"{k}:{a}:{b}" for a, _, b, k in sorted(spans))


MADE = [
    "token=abc token=abcdef", "PASSWORD : \"hunter2go\" é api_key='k.e-y=/+'", "secret=token: abcdefgh",
    "AKIA" + "Q7" * 9 + " AKIA1 AKIAAKIA", "x" + "0123456789abcdef" * 2 + "g" + "ab" * 12, "passwd=token=abcdef token token:abcdefg",
    "blob Zk3Jq9Xw2Lr8Tn5Vb7Yc1Md4 end 🙂 Zk3Jq9Xw2Lr8Tn5Vb7Yc1Md4", "550e8400-e29b-41d4-a716-446655440000",
    "https://site/path/somewhere/quite/deep1", "Pneumonoultramicroscopicsilicovolcanoconiosis", "1111111111111111111111111a",
    "apikey = q  token==zzzzzz secret:'" + "ab" * 30,
]


def test_scan_against_brute_force(spark, docs):
    rows = docs + list(EDGES) + [(100000 + i, t) for i, t in enumerate(MADE)]
    got = secret_scan.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    want = Counter()
    for i, t in rows:
        base = brute_base(t)
        n = Counter(k for *_, k in base)
        want[(i, n["assign"], n["access"], n["hex"], hashlib.sha256(listed(base).encode()).hexdigest(),
              listed(base + brute_added(t)))] += 1
    assert Counter((r.doc_id, r.n_assign, r.n_access, r.n_hex, r.base_sha256, r.spans) for r in got) == want
    assert sum(r.n_assign for r in got) and sum(r.n_access for r in got) and sum(r.n_hex for r in got) and sum(r.n_entropy for r in got)


def test_many_matches_keep_their_places(spark):
    text = "é " + " ".join(f"token=abcdef{i:06d}" for i in range(3000))
    row = secret_scan.scan(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()
    assert row.n_assign == 3000 and row.spans.startswith(listed(brute_base(text))[:200])


def test_redact_replaces_merged_spans(spark):
    rows = [(i, t, "keep") for i, t in enumerate(MADE + [None, "", "clean text"])]
    out = secret_scan.redact(spark.createDataFrame(rows, "doc_id long, text string, _all string"))
    assert out.columns == ["doc_id", "text", "_all"]
    for r in out.collect():
        text = rows[r.doc_id][1]
        if text is None:
            assert r.text is None
            continue
        want, at = "", 0
        for a, _, b, _ in sorted(brute_base(text) + brute_added(text)):
            if a >= at:
                want += text[at:a] + "[SECRET]"
            at = max(at, b)
        assert r.text == want + text[at:]


def test_empty_and_clashing(spark, empty, edges):
    assert secret_scan.scan(empty).count() == 0
    assert secret_scan.redact(edges).count() == len(EDGES)


def test_no_python_in_the_plan(spark):
    df = secret_scan.scan(spark.read.parquet(f"{SF}/documents.parquet"))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan


@pytest.mark.parametrize("value", ["0" * 20, "0123456789" * 4, "abababababababababab1234"])
def test_window_entropy_is_the_least_sum(spark, value):
    cls = secret_scan.CLASSES[0]
    got = spark.range(1).select(secret_scan.window_entropy(F.lit(value), cls)).first()[0]
    sums = [sum(secret_scan._clogc(c) for c in Counter(value[i:i + 20]).values()) for i in range(len(value) - 19)]
    assert got == min(sums)


KEY, UPPER = "Zk3Jq9Xw2Lr8Tn5Vb7Yc1Md4", "3FA94C07E1B2D85A60C9F17E"


CLEANED = [
    ("/services/T0Q4F7Z2P/B09XK31LM/" + KEY, "/services[SECRET]"),
    ("export/key/" + KEY + " end", "export/key[SECRET] end"),
    ("a/b/" + KEY + "/path/to", "a/b[SECRET]path/to"),
    (KEY + "xxxx" + KEY[::-1], "[SECRET][SECRET]"),
    (KEY + " /ab/cd " + "path/" + "A1B2C3D4A1B2C3D4A1B2C3D4" + "/word/" + KEY, "[SECRET] /ab/cd path/[SECRET][SECRET]"),
    # too low for 3.5 bits, high enough for hexadecimal digits
    ("ID=A1B2C3D4A1B2C3D4A1B2C3D4", "ID=[SECRET]"),
    ("k=" + "a1b2c3d4" * 2 + "a1b2", "k=[SECRET]"),
    ("see/path/" + UPPER, "see/path[SECRET]"),
    # still harmless
    ("/usr/local/lib2/python3/site-packages/someModule", None),
    ("/items/550e8400-e29b-41d4-a716-446655440000/view", None),
    ("sha512-" + "Zk3Jq9Xw2Lr8Tn5Vb7Yc1Md4/ab/" * 3 + "Q7==", None),
    ("/orders/20240501123456789012/list", None),
    ("/a1" + "x" * 50000, None),
]


def test_harmless_parts_do_not_hide_secrets(spark):
    df = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(CLEANED)], "doc_id long, text string")
    got = {r.doc_id: r.text for r in secret_scan.redact(df).collect()}
    assert [got[i] for i in range(len(CLEANED))] == [c or t for t, c in CLEANED]


def test_long_base64_is_masked(spark):
    import random

    rng = random.Random(7)
    letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"
    rows = [(i, "".join(rng.choices(letters, k=4000))) for i in range(40)]
    assert sum(any(re.search(r, t) for r in secret_scan.ALLOW) for _, t in rows) > 5
    for r in secret_scan.redact(spark.createDataFrame(rows, "doc_id long, text string")).collect():
        assert len(r.text.replace("[SECRET]", "")) < 60


def test_parts_of_runs_against_brute_force(spark):
    import random

    draw = random.Random(9)
    base64, digits = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789", "0123456789abcdef"
    key = lambda n: "".join(draw.choice(base64) for _ in range(n))
    hexa = lambda n: "".join(draw.choice(digits) for _ in range(n))
    harmless = ["usr", "Path", "example", "2024", "550e8400-e29b-41d4-a716-446655440000", "services", "XXXX", "sha256-" + hexa(64), "camelCaseName12"]
    texts = ["/usr/" + key(24), "ID=" + hexa(32).upper(), "key_" + hexa(20), key(24) + "/x/" + key(24) + "/words/only/here/and/more/" + key(30)]
    for _ in range(300):
        parts = [draw.choice([lambda: draw.choice(harmless), lambda: key(draw.randint(4, 45)), lambda: hexa(draw.randint(10, 40)), lambda: "aaaa1" * 5])() for _ in range(draw.randint(1, 6))]
        texts.append("see " + "".join(p + draw.choice("/=_-/ ") for p in parts))
    rows = secret_scan.scan(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    got = {r.doc_id: sorted((int(a), int(b)) for k, a, b in (x.split(":") for x in r.spans.split(",") if x) if k == "entropy") for r in rows}
    assert got == {i: brute_parts(t) for i, t in enumerate(texts)}
    assert sum(map(len, got.values())) > 200 and all(got[i] for i in range(4))
