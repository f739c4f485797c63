"""Each stage of the pipeline against a plain version on its own input."""

import sys
from collections import Counter, defaultdict

import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from flexframe.llm import bpe, toxicity

from .conftest import SF
from .test_secrets import brute_added, brute_base
from .test_simhash import brute as brute_simhash
from .test_suffix_dedup import brute as brute_suffix
from .test_tokens import check_packing


@pytest.fixture(scope="module")
def steps(spark, tmp_path_factory):
    """The rows before and after each stage, written and read again in between."""
    docs, out = spark.read.parquet(f"{SF}/documents.parquet"), []
    docs = docs.limit(0).union(docs)
    extra = spark.createDataFrame([(90001, None, None, None, None), (90002, "", None, "s", 0)], docs.schema)
    docs = docs.union(extra)
    for name, stage in corpus_pipeline.STAGES:
        after = stage(spark, docs, SF)
        path = str(tmp_path_factory.mktemp("steps") / name)
        after.write.parquet(path)
        after = spark.read.parquet(path)
        out.append((docs.columns, docs.collect(), after.columns, after.collect()))
        docs = after
    return out


def test_columns_stay(steps):
    for before, _, after, _ in steps[:-1]:
        assert before == after


def test_toxicity(spark, steps):
    _, before, _, after = steps[0]
    model = toxicity.fit(spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet"))
    keep = [r for r in before if toxicity.probabilities([(r.text or "").encode()], model)[0] < toxicity.THRESHOLD]
    assert Counter(keep) == Counter(after) and len(after) > 0.7 * len(before)


def test_near_copies(steps):
    _, before, _, after = steps[1]
    ids = {d for d, _, c in brute_simhash([(r.doc_id, r.text) for r in before]) if d == c}
    assert Counter(after) == Counter(r for r in before if r.doc_id in ids)
    assert len(after) < len(before)


def test_repeats(steps):
    _, before, _, after = steps[2]
    _, kept = brute_suffix([(r.doc_id, r.text) for r in before])
    got = {r.doc_id: r for r in after}
    assert len(got) == len(before)
    for r in before:
        if r.text is None:
            assert got[r.doc_id].text is None
        else:
            text = kept[(r.doc_id, r.text)].decode("utf-8", "ignore")
            assert got[r.doc_id].text == text and got[r.doc_id].n_chars == len(text)


def test_secrets(steps):
    _, before, _, after = steps[3]
    got = {r.doc_id: r.text for r in after}
    for r in before:
        if r.text is None:
            continue
        want, at = "", 0
        for a, _, b, _ in sorted(brute_base(r.text) + brute_added(r.text)):
            if a >= at:
                want += r.text[at:a] + "[SECRET]"
            at = max(at, b)
        assert got[r.doc_id] == want + r.text[at:]


def test_packing(steps):
    _, before, _, after = steps[4]
    used, least = check_packing(after, [(r.doc_id, r.text) for r in before], Tokenizer.from_file(bpe.default_path()), 2048)
    assert used <= 1.02 * least + 1


def test_run_covers_every_kept_document(spark, steps):
    got = corpus_pipeline.run(spark, SF).select("doc_id").distinct().count()
    assert got == len({r.doc_id for r in steps[4][1]} - {90001, 90002}) or got >= len({r.doc_id for r in steps[4][1]}) - 2


def test_entry_registers_the_pipeline():
    import __spark_entry__ as entry

    names = set(entry.queries())
    assert "pipeline" in names and {n.split("_")[0] for n in names if n.startswith("op")} == {f"op{i}" for i in range(1, 14)}
    assert "corpus_pipeline" in sys.modules


def test_bins_hold_pieces_of_several_documents(steps):
    bins = defaultdict(set)
    for r in steps[4][3]:
        bins[r.sequence_id].add(r.doc_id)
    assert max(map(len, bins.values())) > 1
