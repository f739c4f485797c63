"""Quality rules: a table of thresholds compiled into one projection, without user functions.

Each rule names a metric and the range it must lie in. ``apply`` adds the
metrics of a text as Spark expressions and ``kept``: whether every rule holds.

Defined results: null and empty texts have no words and fail; ratios of texts
without words or lines are 0; texts of any length are measured whole; repeated
rows give repeated results; an empty table gives an empty one; only id and text
are read, so other columns can't clash.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import BLANKS, bind, id_text

SYMBOLS = "#*$%&|<>"
WINDOW = 5
LEAST_WORDS = 10
REPEAT_PERCENT = 20

#: Frequent words of English, French, German and Spanish: fixed values.
STOP_WORDS = (
    "the be to of and that have with in is it for on as at by this not are or an a "
    "le la les de des et un une que qui est dans pour pas en du au "
    "der die das und ist nicht ein eine mit von zu auf den dem "
    "el los las y o es no una por con para del se lo"
).split()


@dataclass(frozen=True)
class Rule:
    """``least <= numerator / denominator <= most``, in whole numbers: both sides are per mille."""

    name: str
    numerator: str
    denominator: str | None = None
    least: int | None = None
    most: int | None = None

    def holds(self) -> Column:
        top, below = F.col(self.numerator) * 1000, F.col(self.denominator) if self.denominator else F.lit(1000)
        ok = F.lit(True)
        if self.least is not None:
            ok = ok & (top >= below * self.least)
        if self.most is not None:
            ok = ok & (top <= below * self.most)
        return ok


#: The threshold table. Ratios are per mille; rules without a denominator bound the number itself.
RULES = (
    Rule("words", "n_words", least=LEAST_WORDS),
    Rule("mean_word_length", "word_chars", "n_words", least=2000, most=15000),
    Rule("symbols_per_word", "n_symbols", "n_words", most=100),
    Rule("stop_words", "n_stop_words", "n_words", least=20),
    Rule("words_with_letters", "n_alpha_words", "n_words", least=600),
    Rule("duplicate_lines", "n_dup_lines", "n_lines", most=500),
    Rule("bullet_lines", "n_bullet_lines", "n_lines", most=900),
    Rule("ellipsis_lines", "n_ellipsis_lines", "n_lines", most=300),
)


def _repeat_words(words: Column, window: int) -> Column:
    """Words that lie in a window found twice or more in the text.

    Texts whose window hashes all differ can't repeat a window; only the others
    sort their windows as text and mark those with an equal neighbour.
    """
    def at(i):
        return F.slice(words, i + 1, window)

    places = F.sequence(F.lit(0), F.size(words) - window)

    def covered(order):
        same = lambda k, x: F.coalesce(F.get(order, k)["w"] == x["w"], F.lit(False))
        marked = F.filter(order, lambda x, k: same(k - 1, x) | same(k + 1, x))
        starts = F.array_sort(F.transform(marked, lambda x: x["i"]))
        state = F.struct(F.lit(-window).alias("last"), F.lit(0).cast("long").alias("total"))
        return F.aggregate(starts, state, lambda s, i: F.struct(
            i.alias("last"), (s["total"] + F.least(i - s["last"], F.lit(window))).alias("total")))["total"]

    exact = bind(
        F.array_sort(F.transform(places, lambda i: F.struct(F.array_join(at(i), " ").alias("w"), i.alias("i")))), covered)
    def all_differ(hashes):
        # each word is hashed once, a window by the hashes of its words
        windows = F.transform(places, lambda i: F.xxhash64(*[F.get(hashes, i + k) for k in range(window)]))
        return bind(windows, lambda h: F.size(F.array_distinct(h)) == F.size(h))

    differ = bind(F.transform(words, lambda w: F.xxhash64(w)), lambda h: (F.size(F.array_distinct(h)) == F.size(h)) | all_differ(h))
    return F.when(F.size(words) <= window, 0).when(differ, 0).otherwise(exact).cast("long")


def metrics(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``df``: id, text and every metric that the rules name."""
    base = id_text(df, id_col, text_col).select(
        "doc_id", "text",
        F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda w: w != "").alias("_words"),
        F.filter(F.split("text", "\n"), lambda x: F.trim(x, F.lit(BLANKS)) != "").alias("_lines"),
    )
    size = lambda c: F.size(c).cast("long")
    chars = F.char_length("text")
    return base.select(
        "doc_id", "text",
        size("_words").alias("n_words"),
        F.char_length(F.translate("text", BLANKS, "")).cast("long").alias("word_chars"),
        (chars - F.char_length(F.translate("text", SYMBOLS, ""))).cast("long").alias("n_symbols"),
        size("_lines").alias("n_lines"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        _repeat_words(F.col("_words"), WINDOW).alias("n_repeat_words"),
        size(F.filter("_words", lambda w: F.lower(w).isin(*sorted(set(STOP_WORDS))))).alias("n_stop_words"),
        size(F.filter("_words", lambda w: w.rlike(r"\p{L}"))).alias("n_alpha_words"),
        size(F.filter("_lines", lambda x: x.rlike(r"^[\x20\x09]*[-*•]"))).alias("n_bullet_lines"),
        size(F.filter("_lines", lambda x: x.rlike(r"(\.\.\.|…)[\x20\x09\x0D]*$"))).alias("n_ellipsis_lines"),
    )


def apply(df: DataFrame, rules=RULES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``df``: the metrics, ``base_failed``, ``failed_rules`` and ``kept``."""
    base_failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > REPEAT_PERCENT * F.col("n_words"))
    failed = F.filter(
        F.array(*[F.when(~r.holds(), F.lit(r.name)) for r in rules]), lambda x: x.isNotNull())
    return metrics(df, id_col, text_col).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        base_failed.alias("base_failed"),
        (~base_failed & (F.size(failed) == 0)).alias("kept"),
        failed.alias("failed_rules"),
    )
