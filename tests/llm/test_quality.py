import re
from collections import Counter

from flexframe.llm import quality

from .conftest import EDGES

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    text = text or ""
    words = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    shingles = Counter(tuple(words[i:i + 5]) for i in range(len(words) - 4))
    inside = set()
    for i in range(len(words) - 4):
        if shingles[tuple(words[i:i + 5])] > 1:
            inside.update(range(i, i + 5))
    n = len(words)
    return (n, sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(inside),
            n < 10 or 100 * len(inside) > 20 * n)


def test_base_against_brute_force(spark, docs):
    made = [(900, "a b c d\x1ce"), (901, "x y z u v x y z u v x y z u v"), (902, "l1 a\nl1 a\n \n \nl1 a"), (903, "a b c d e a b c d e")]
    rows = docs + list(EDGES) + made
    got = quality.apply(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    cols = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    assert Counter(tuple(r[c] for c in cols) for r in got) == Counter((i, *brute(t)) for i, t in rows)
    assert all(not (r.kept and r.base_failed) for r in got)
    assert any(r.kept for r in got) and all(r.kept == (not r.base_failed and not r.failed_rules) for r in got)


def test_rules_tell_junk_from_prose(spark):
    prose = "The river ran past the old mill and it was not far to the village. " * 1 + "Nobody in the valley had seen such a flood in years."
    junk = "#### $$$$ **** %%%% &&&& |||| <<<< >>>> #### $$$$ **** ????"
    rows = [(1, prose), (2, junk), (3, "- one two three four\n" * 1 + "zq xv kp tr wq mn bb lk jh gf ds aq")]
    got = {r.doc_id: r for r in quality.apply(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[1].kept and not got[2].kept and "symbols_per_word" in got[2].failed_rules
    assert got[3].failed_rules == ["stop_words"]


def test_clash_empty_and_plan(spark, edges, empty):
    assert quality.apply(empty).count() == 0
    df = quality.apply(edges)
    assert df.count() == len(EDGES)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Exchange" not in plan


def test_letters_of_any_script(spark):
    texts = ["漢字 かな 한글 " * 10, "ελληνικά русский עברית العربية हिन्दी ไทย " * 5, "123 456 --- " * 10, "x1 2y é3 " * 10]
    rows = quality.metrics(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).orderBy("doc_id").collect()
    assert [r.n_alpha_words for r in rows] == [30, 30, 0, 30]
    assert all("words_with_letters" not in r.failed_rules for r in quality.apply(spark.createDataFrame(list(enumerate(texts[:2])), "doc_id long, text string")).collect())
