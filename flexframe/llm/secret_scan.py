"""Secret scans: base patterns plus windowed Shannon entropy, as Spark expressions only.

Candidate strings are long runs of one character class. A window slides over
each; the counts of the characters inside it change by one step in and one
step out, and with them the sum of ``c * log2(c)``. The largest window entropy
is held against the threshold of the class. An allow-list then drops
candidates that are known to be harmless. A run that isn't a secret as a whole
is looked at in parts: words, UUIDs, digests and placeholders are cut out of it,
the stretches between them are held against the widest class, and the runs of
the narrower class inside against their own.

All arithmetic on entropies is on integers (``c * log2(c)`` scaled by 2^20 and
rounded), so that the result doesn't depend on the order of additions.

Defined results: null text is empty; no match gives an empty span list; equal
starts are ordered by kind; texts of any length are scanned whole; repeated
rows give repeated results; an empty table gives an empty result; columns other
than id and text are ignored by ``scan`` and kept by ``redact``.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import bind, id_text

#: Base kinds in the order of the span list: kind, pattern, group that is measured, least length.
#: Runs that must have n characters are looked for with {n,}: the maximal run is the same.
ASSIGN = (r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?"""
          r"""([A-Za-z0-9+/_.=-]+)""")
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"(?<![0-9a-f])[0-9a-f]{24,}"
KINDS = ("assign", "access", "hex", "entropy")
ASSIGN_LEAST = 6

SCALE = 1 << 20


@dataclass(frozen=True)
class CharClass:
    """A character class: its alphabet, least run length, and entropy in bits a character."""

    name: str
    alphabet: str
    run: str
    least: int
    bits: float
    fold: bool = False


_DIGITS, _LOWER = "0123456789", "abcdefghijklmnopqrstuvwxyz"
CLASSES = (
    CharClass("hexadecimal", _DIGITS + "abcdef", "0-9A-Fa-f", 20, 2.8, fold=True),
    CharClass("base64", _LOWER.upper() + _LOWER + _DIGITS + "+/=_-", "A-Za-z0-9+/=_-", 20, 3.5),
)
WINDOW = 20

#: Candidates that match any of these are harmless: fixed values of the allow-list.
ALLOW = (
    r"^[^0-9]*$",                                     # words, no digit
    r"^[0-9+/=_-]*$",                                 # numbers, dates, rulers
    r"(?i)^[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}$",  # UUID
    r"(?i)(example|sample|dummy|placeholder|xxxx|0123456789|abcdefgh)",
    r"^//?[a-z]|/[a-z]+/|[a-z]/[a-z]+$",              # paths and addresses
    r"^(sha256|sha384|sha512)-",                      # integrity digests
)


def _scanned(values: Column, join, steps: int = 27) -> Column:
    """Running ``join`` by doubling steps: n log n, whatever the number of matches (up to 2^27)."""
    def doubled(h):
        return lambda a: F.when(
            F.size(a) > h,
            F.transform(a, lambda x, i: F.when(i >= h, join(x, F.get(a, i - h))).otherwise(x)),
        ).otherwise(a)

    for k in range(steps):
        values = bind(values, doubled(1 << k))
    return values


def _spans(text: Column, matches: Column, pattern: str) -> Column:
    """(start, end) of every match in code points: gaps and matches alternate in the text."""
    def place(m):
        gaps = F.split(text, pattern, -1)
        ends = _scanned(F.transform(m, lambda x, i: F.char_length(x) + F.char_length(F.get(gaps, i))), lambda x, y: x + y)
        return bind(ends, lambda e: F.transform(
            m, lambda x, i: F.struct((F.get(e, i) - F.char_length(x)).alias("start"), F.get(e, i).alias("end"))))

    empty = F.array().cast("array<struct<start:int,end:int>>")
    return F.when(F.size(matches) > 0, bind(matches, place)).otherwise(empty)


def _clogc(c: int) -> int:
    return round(c * math.log2(c) * SCALE) if c > 1 else 0


def window_entropy(value: Column, cls: CharClass, window: int = WINDOW) -> Column:
    """Least sum of ``c log2 c`` (scaled) over all windows of ``value``; small means high entropy.

    The state holds the counts of the window; each step adds one character and
    takes off the one that leaves.
    """
    table = F.array(*[F.lit(_clogc(c)).cast("long") for c in range(window + 2)])
    f = lambda c: F.get(table, c)
    n = len(cls.alphabet)

    def over(codes):
        start = F.struct(
            F.array_repeat(F.lit(0), n).alias("counts"),
            F.lit(0).cast("long").alias("total"),
            F.lit(1 << 60).cast("long").alias("least"),
        )

        def step(state, j):
            enters, leaves = F.get(codes, j), F.when(j >= window, F.get(codes, j - window)).otherwise(F.lit(-1))
            c_in = F.get(state["counts"], enters)
            added = state["total"] + f(c_in + 1) - f(c_in)
            # the leaving character's count, after the entering one is in
            c_out = F.get(state["counts"], leaves) + F.when(leaves == enters, 1).otherwise(0)
            total = F.when(j >= window, added - f(c_out) + f(c_out - 1)).otherwise(added)
            counts = F.transform(state["counts"], lambda c, i: (
                c + F.when(i == enters, 1).otherwise(0) - F.when(i == leaves, 1).otherwise(0)))
            return bind(total, lambda t: F.struct(
                counts.alias("counts"), t.alias("total"),
                F.when(j >= window - 1, F.least(state["least"], t)).otherwise(state["least"]).alias("least")))

        return F.aggregate(F.sequence(F.lit(0), F.size(codes) - 1), start, step)["least"]

    folded = F.lower(value) if cls.fold else value
    letters = F.filter(F.split(folded, ""), lambda c: c != "")
    return bind(F.transform(letters, lambda c: F.instr(F.lit(cls.alphabet), c) - 1), over)


#: Rules that speak of a whole candidate; the others find a harmless part, anywhere in it.
WHOLE = ALLOW[:3]
_EDGE = "/=_-"
#: Harmless parts of a run, each between separators or the ends, but for the placeholders.
HARMLESS = "|".join((
    rf"(?<![{CLASSES[-1].run}])sha(?:256-(?:[0-9a-f]{{64}}|[A-Za-z0-9+/_-]{{43}}=?)|384-(?:[0-9a-f]{{96}}|[A-Za-z0-9+/_-]{{64}})"
    r"|512-(?:[0-9a-f]{128}|[A-Za-z0-9+/_-]{86}={0,2}))",
    rf"(?<![^{_EDGE}])(?i:[0-9a-f]{{8}}-[0-9a-f]{{4}}-[0-9a-f]{{4}}-[0-9a-f]{{4}}-[0-9a-f]{{12}})(?![^{_EDGE}])",
    # words and numbers shorter than a candidate
    rf"(?<![^{_EDGE}])(?![A-Za-z0-9+]{{20}})(?:[A-Z]?[a-z]++(?:[A-Z][a-z]++)*+[0-9]{{0,4}}|[A-Z]++|[0-9]++)(?![^{_EDGE}])",
    r"(?i:example|sample|dummy|placeholder|x{4,}+|0123456789|abcdefgh)",
))
#: Tiles of a run: a harmless part, or (group 1) the stretch up to the next one. Possessive: no recursion on long runs.
STRETCH = rf"(?:{HARMLESS})|((?:(?!{HARMLESS})[{CLASSES[-1].run}])++)"


def _inside(cls: CharClass) -> str:
    """Tiles of a stretch: (group 1) a maximal run of ``cls``, or what lies between."""
    run = rf"(?<![{cls.run}])[{cls.run}]{{{cls.least}"
    return rf"({run},}}+)|(?:(?!{run}}}).)++"


def _tiles(value: Column, pattern: str, least: int) -> Column:
    """(start, end, part) of the tiles of ``value`` that are group 1 of ``pattern`` and not too short; tiles leave no gap."""
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,end:int,part:string>>").alias("found"))

    def step(state, x):
        end = state["at"] + F.char_length(x["every"])
        tile = F.struct(state["at"].alias("start"), end.alias("end"), x["part"].alias("part"))
        return F.struct(end.alias("at"), F.when(
            F.char_length(x["part"]) >= least, F.concat(state["found"], F.array(tile))).otherwise(state["found"]).alias("found"))

    tiles = F.arrays_zip(F.regexp_extract_all(value, F.lit(pattern), F.lit(0)).alias("every"),
                         F.regexp_extract_all(value, F.lit(pattern), F.lit(1)).alias("part"))
    return F.aggregate(tiles.cast("array<struct<every:string,part:string>>"), start, step, lambda state: state["found"])


def _matches(value: Column, rules: tuple[str, ...]) -> Column:
    allowed = F.lit(False)
    for rule in rules:
        allowed = allowed | value.rlike(rule)
    return allowed


def _secret(value: Column, window: int, rules: tuple[str, ...] = ALLOW) -> Column:
    """Whether a candidate's best window reaches the entropy of its class and no allow-list rule holds."""
    verdict = F.lit(False)
    for cls in reversed(CLASSES):
        most = round((math.log2(window) - cls.bits) * window * SCALE)
        own = value.rlike(f"^[{cls.run}]{{{cls.least},}}$")
        verdict = F.when(own, window_entropy(value, cls, window) <= most).otherwise(verdict)
    return F.when(_matches(value, rules), False).otherwise(verdict)


def _with_parts(df: DataFrame, window: int) -> DataFrame:
    """``_s_entropy``: (start, end) of the secrets among the runs, each a whole run or a part of it.

    One column a step: nested lambdas would be resolved level by level. A span
    goes on to the next one if that is less than a candidate away and in the
    same run: one key with a word in it is masked without gaps.
    """
    least = CLASSES[-1].least
    df = df.withColumn("_runs", F.transform("_s_run", lambda s, i: F.struct(
        s["start"].alias("start"), s["end"].alias("end"), F.get("_m_run", i).alias("part"), _secret(F.get("_m_run", i), window).alias("secret"))))
    # stretches of the runs that are no secret as a whole, places within the text
    df = df.withColumn("_parts", F.flatten(F.transform(
        F.filter("_runs", lambda r: ~r["secret"] & ~_matches(r["part"], WHOLE)),
        lambda r: F.transform(_tiles(r["part"], STRETCH, least), lambda t: F.struct(
            (r["start"] + t["start"]).alias("start"), (r["start"] + t["end"]).alias("end"),
            t["part"].alias("part"), r["start"].alias("run"), _secret(t["part"], window, WHOLE).alias("secret"))))))
    # in the others, runs of the narrower class
    narrow = [F.flatten(F.transform(F.filter("_parts", lambda p: ~p["secret"]), lambda p: F.transform(
        F.filter(_tiles(p["part"], _inside(c), c.least), lambda t: _secret(t["part"], window, WHOLE)), lambda t: F.struct(
            (p["start"] + t["start"]).alias("start"), (p["start"] + t["end"]).alias("end"), p["run"].alias("run"))))) for c in CLASSES[:-1]]
    wide = F.transform(F.filter("_parts", lambda p: p["secret"]), lambda p: F.struct(
        p["start"].alias("start"), p["end"].alias("end"), p["run"].alias("run")))
    df = df.withColumn("_parts", F.array_sort(F.concat(wide, *narrow)))
    span = lambda a, b: F.struct(a.alias("start"), b.alias("end"))
    near = lambda p, after: (after["run"] == p["run"]) & (after["start"] - p["end"] < least)
    parts = F.transform("_parts", lambda p, i: span(p["start"], F.when(
        near(p, F.get(F.col("_parts"), i + 1)), F.get(F.col("_parts"), i + 1)["start"]).otherwise(p["end"])))
    whole = F.transform(F.filter("_runs", lambda r: r["secret"]), lambda r: span(r["start"], r["end"]))
    return df.withColumn("_s_entropy", F.concat(whole, parts))


#: Maximal runs of the widest class; the narrower ones are told apart within.
CANDIDATE = rf"(?<![{CLASSES[-1].run}])[{CLASSES[-1].run}]{{{CLASSES[-1].least},}}"


def _found(df: DataFrame, text: str = "text", window: int = WINDOW) -> DataFrame:
    """``df`` with ``_base`` and ``_added``: arrays of (start, rank of kind, end)."""
    t = F.col(text)
    zero = F.lit(0)
    some = F.array().cast("array<string>")
    out = (
        df.withColumn("_m_assign", F.regexp_extract_all(t, F.lit(ASSIGN), zero))
        .withColumn("_m_access", F.when(t.contains("AKIA"), F.regexp_extract_all(t, F.lit(ACCESS), zero)).otherwise(some))
        .withColumn("_m_hex", F.regexp_extract_all(t, F.lit(HEX), zero))
        .withColumn("_m_run", F.regexp_extract_all(t, F.lit(CANDIDATE), zero))
    )
    values = F.when(F.size("_m_assign") > 0, F.regexp_extract_all(t, F.lit(ASSIGN), F.lit(2))).otherwise(some)
    out = (
        out.withColumn("_v_assign", values)
        .withColumn("_s_assign", _spans(t, F.col("_m_assign"), ASSIGN))
        .withColumn("_s_access", _spans(t, F.col("_m_access"), ACCESS))
        .withColumn("_s_hex", _spans(t, F.col("_m_hex"), HEX))
        .withColumn("_s_run", _spans(t, F.col("_m_run"), CANDIDATE))
    )

    def ranked(name, rank, keep=None):
        every = F.transform(name, lambda s, i: F.struct(
            s["start"].alias("start"), F.lit(rank).alias("rank"), s["end"].alias("end"),
            (keep(i) if keep else F.lit(True)).alias("keep")))
        return F.transform(F.filter(every, lambda s: s["keep"]),
                           lambda s: F.struct(s["start"].alias("start"), s["rank"].alias("rank"), s["end"].alias("end")))

    base = F.concat(
        ranked("_s_assign", 0, lambda i: F.char_length(F.get("_v_assign", i)) >= ASSIGN_LEAST),
        ranked("_s_access", 1),
        ranked("_s_hex", 2),
    )
    return _with_parts(out, window).withColumn("_base", F.array_sort(base)).withColumn("_added", ranked("_s_entropy", 3))


def _listed(spans: Column) -> Column:
    kind = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.get(kind, s["rank"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def scan(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW) -> DataFrame:
    """One row per row of ``df``: counts by kind, digest of the base spans, and all spans."""
    found = _found(id_text(df, id_col, text_col), "text", window)
    count = lambda rank: F.size(F.filter("_base", lambda s: s["rank"] == rank)).cast("long")
    return found.select(
        "doc_id",
        count(0).alias("n_assign"), count(1).alias("n_access"), count(2).alias("n_hex"),
        F.size("_added").cast("long").alias("n_entropy"),
        F.sha2(_listed(F.col("_base")), 256).alias("base_sha256"),
        _listed(F.array_sort(F.concat("_base", "_added"))).alias("spans"),
    )


def redact(df: DataFrame, text_col: str = "text", mark: str = "[SECRET]", window: int = WINDOW) -> DataFrame:
    """``df`` with every span of ``text_col`` replaced by ``mark`` (overlapping spans by one); all rows stay.

    A null text stays null. No other column changes.
    """
    work = df.select(F.struct(*[df[c] for c in df.columns]).alias("_row"), F.coalesce(df[text_col], F.lit("")).alias("_text"))
    found = _found(work, "_text", window).withColumn("_all", F.array_sort(F.concat("_base", "_added")))
    # where the text is taken up again before each span: the furthest end so far
    reach = _scanned(F.transform("_all", lambda s: s["end"]), F.greatest)
    found = found.withColumn("_reach", F.when(F.size("_all") > 0, reach).otherwise(F.array().cast("array<int>")))
    pieces = F.transform("_all", lambda s, i: bind(
        F.when(i == 0, F.lit(0)).otherwise(F.get("_reach", i - 1)),
        lambda at: F.when((i > 0) & (s["start"] < at), F.lit("")).otherwise(
            F.concat(F.substring(F.col("_text"), at + 1, s["start"] - at), F.lit(mark)))))
    tail = F.substring(F.col("_text"), F.get("_reach", F.size("_reach") - 1) + 1, F.char_length("_text"))
    clean = F.when(F.size("_all") > 0, F.concat(F.array_join(pieces, ""), tail)).otherwise(F.col(f"_row.{text_col}"))
    return found.select(*[(clean if c == text_col else F.col("_row")[c]).alias(c) for c in df.columns])

