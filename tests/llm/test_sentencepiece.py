import random
import zlib

import numpy as np
import pytest
from sentencepiece import SentencePieceProcessor, sentencepiece_model_pb2

from flexframe.llm import sentencepiece_codec as sp

from .conftest import EDGES


@pytest.fixture(scope="module")
def lib():
    return SentencePieceProcessor(model_file=sp.default_path())


@pytest.fixture(scope="module")
def codec():
    return sp.Codec(sp.default_path())


def made(n=400):
    rng = random.Random(3)
    alphabet = "abcdeHello thrsin  ▁é漢x\n🙂"
    return ["".join(rng.choice(alphabet) for _ in range(rng.randrange(0, 60))) for _ in range(n)]


def ids(codec, text):
    return np.frombuffer(codec.encode(text), np.int32).tolist()


def test_ids_are_the_librarys(codec, lib, docs):
    for t in [t for _, t in docs[:80]] + made():
        assert ids(codec, t) == lib.encode(t), repr(t)


def test_streaming_without_the_word_memo(codec, lib, docs):
    for t in [t[:2000] for _, t in docs[:10]] + ["abcdefghij" * 500, "x" * 3000, " " * 100] + made(50):
        portions = list(codec.stream(codec.normalise(t)))
        assert [i for p in portions for i in p] == lib.encode(t)
        if len(t) > 500 and " " in t.strip():
            assert len(portions) > 5  # ids are committed on the way


def test_unigram_is_a_best_path(docs):
    spec = sentencepiece_model_pb2.ModelProto()
    spec.ParseFromString(open(sp.default_path(), "rb").read())
    spec.trainer_spec.model_type = spec.trainer_spec.UNIGRAM
    codec, lib = sp.Codec.from_bytes(spec.SerializeToString()), SentencePieceProcessor(model_proto=spec.SerializeToString())

    def total(found):
        return sum(codec.pieces[codec.text_of[i]][1] for i in found)

    for t in [t[:200] for _, t in docs[:40] if t[:200].isascii() and "\n" not in t[:200]]:
        assert total(ids(codec, t)) >= total(lib.encode(t))
        assert codec.decode(np.array(ids(codec, t), np.int32)) == t


def test_decode(codec, lib):
    for t in made():
        assert codec.decode(np.array(ids(codec, t), np.int32)) == lib.decode(lib.encode(t))


def test_digest(spark, lib, docs, edges, empty):
    rows = docs[:40] + list(EDGES)
    got = {}
    for r in sp.digest(spark.createDataFrame(rows, "doc_id long, text string")).collect():
        got.setdefault(r.doc_id, set()).add(tuple(r)[1:])
    want = {}
    for i, t in rows:
        t = t or ""
        found = lib.encode(t)
        want.setdefault(i, set()).add((len(t), len(found), zlib.crc32(np.array(found, "<i4").tobytes()), True))
    assert got == want
    assert sp.digest(edges).count() == len(EDGES) and sp.digest(empty).count() == 0
    both = sp.decode(sp.encode(edges)).collect()
    assert all(r.decoded == r.text for r in both)


def test_other_models_are_refused():
    spec = sentencepiece_model_pb2.ModelProto()
    spec.ParseFromString(open(sp.default_path(), "rb").read())
    spec.normalizer_spec.remove_extra_whitespaces = True
    with pytest.raises(ValueError):
        sp.Codec.from_bytes(spec.SerializeToString())
