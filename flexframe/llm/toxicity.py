"""Toxicity: a linear classifier over character n-grams scaled by naive Bayes log-count ratios.

Training (``fit``) is on a bounded sample of labelled rows: up to
``SAMPLE_ROWS`` rows of each class, the first by a hash of the id, whose texts
have at most ``SAMPLE_BYTES`` bytes. The share of a class's documents that
hold an n-gram, over the same of the other class, gives each n-gram its log
ratio; a logistic regression then weighs the scaled features. The model is a
table of fixed size (2^``BITS`` weights), so it may be broadcast.

Scoring (``score``) reads whole texts: n-grams are hashed with numpy over many
texts at once, and each feature of a text counts once.

Defined results: null and empty texts hold no n-gram and score the intercept;
without labelled rows of both classes every score is the share of toxic labels
(0 without any); rows with a null label teach nothing, an id with several
labels has the largest; repeated rows repeat; other columns, of the labels too,
are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import id_text

GRAMS = (4, 5, 6)
BITS = 20
#: Bounds of the training sample: rows of each class, and bytes of a text.
SAMPLE_ROWS = 2500
SAMPLE_BYTES = 40_000
#: Features of the model: the n-grams whose log ratios gain the most log likelihood, among those whose ratio is at
#: least so large and that gain so much at least. Few rows can't gain as much, so they ask for less: a share of what an
#: n-gram gains that all rows of the smaller class hold and no others.
FEATURES, LEAST_RATIO, LEAST_GAIN, GAIN_SHARE = 1 << 12, 0.7, 10.0, 0.25
THRESHOLD = 0.7
_STRIP = 1 << 21


@dataclass(frozen=True)
class Model:
    """``weights`` by hashed n-gram, and the intercept."""

    weights: np.ndarray
    bias: float


def held_out(doc_id: Column) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 3 == 1


def grams(texts: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(document number, hashed n-gram) of every n-gram of every text, in strips of bounded size.

    Letters A-Z are folded; a blank stands before and after a text. Strips
    overlap by the longest n-gram, so long texts lose none.
    """
    longest = max(GRAMS)
    owners, joined, total = [], [], 0
    for k, text in enumerate(texts):
        body = b" " + text.lower() + b" "
        step = _STRIP - longest
        for at in range(0, len(body), step):
            part = body[at:at + _STRIP]
            joined.append(part + b"\0" * longest)  # no n-gram spans two parts: those with a zero go
            owners.append((k, len(joined[-1])))
            total += len(joined[-1])
            if total >= _STRIP:
                yield from _hashed(owners, joined)
                owners, joined, total = [], [], 0
            if at + _STRIP >= len(body):
                break
    if owners:
        yield from _hashed(owners, joined)


def _hashed(owners, joined) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    x = np.frombuffer(b"".join(joined), dtype=np.uint8)
    doc = np.repeat(np.array([k for k, _ in owners], np.int32), np.array([n for _, n in owners]))
    mixed = np.uint32(2654435761)
    h, letters = x.astype(np.uint32), x
    zero_ahead = x == 0
    for n in range(2, max(GRAMS) + 1):
        h = h[:-1] * np.uint32(16777619) + letters[n - 1:]
        zero_ahead = zero_ahead[:-1] | (letters[n - 1:] == 0)
        if n in GRAMS:
            code = ((h ^ np.uint32(n * 40503)) * mixed) >> np.uint32(32 - BITS)
            whole = ~zero_ahead
            yield doc[:len(code)][whole], code[whole]


def _distinct(keys: np.ndarray) -> np.ndarray:
    """The distinct values in order, by sorting."""
    keys = np.sort(keys)
    return keys[np.flatnonzero(np.diff(keys, prepend=-1))]


def _chunks(texts: list[bytes], size: int = 1 << 19) -> Iterator[tuple[int, list[bytes]]]:
    """(number of the first text, texts) in lists of about ``size`` bytes."""
    at, total = 0, 0
    for k, text in enumerate(texts):
        total += len(text)
        if total >= size:
            yield at, texts[at:k + 1]
            at, total = k + 1, 0
    if at < len(texts):
        yield at, texts[at:]


def _present(texts: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Distinct (document, feature) pairs, a chunk of documents at a time."""
    for first, some in _chunks(texts):
        keys = [np.empty(0, np.int64)] + [d.astype(np.int64) << BITS | c for d, c in grams(some)]
        every = _distinct(np.concatenate(keys))
        yield first + (every >> BITS), every & ((1 << BITS) - 1)


def train(texts: list[bytes], labels: np.ndarray, features: int = FEATURES, smooth: float = 1.0, decay: float = 0.01,
          steps: int = 150, rate: float = 0.1) -> Model:
    """The model of labelled texts (both classes present). Two passes, so that only chosen features are held."""
    size = 1 << BITS
    p, q = np.full(size, smooth), np.full(size, smooth)
    for doc, code in _present(texts):
        toxic = labels[doc].astype(bool)
        p += np.bincount(code[toxic], minlength=size)
        q += np.bincount(code[~toxic], minlength=size)
    ratio = np.log(p / p.sum()) - np.log(q / q.sum())
    # what tells the classes apart: the log likelihood that a ratio other than 0 gains
    own, other = p - smooth, q - smooth
    share = own.sum() / max(1.0, (own + other).sum())
    both = own + other
    with np.errstate(divide="ignore", invalid="ignore"):
        gain = np.where(own > 0, own * np.log(own / (both * share)), 0) + np.where(other > 0, other * np.log(other / (both * (1 - share))), 0)
    fewest = int(min(labels.sum(), len(labels) - labels.sum()))
    most = -fewest * math.log(min(share, 1 - share)) if 0 < share < 1 else 0.0
    gain[(gain < min(LEAST_GAIN, GAIN_SHARE * most)) | (np.abs(ratio) < LEAST_RATIO)] = 0
    chosen = np.sort(np.argsort(-gain, kind="stable")[:features])
    chosen = chosen[gain[chosen] > 0]
    place = np.full(size, -1, np.int32)
    place[chosen] = np.arange(len(chosen))
    held = [(doc[place[code] >= 0], place[code[place[code] >= 0]]) for doc, code in _present(texts)]
    row, col = (np.concatenate([x[i] for x in held]) for i in (0, 1))
    scale = ratio[chosen] / max(1e-9, np.abs(ratio[chosen]).max(initial=0))
    value, n = scale[col], len(labels)
    w, b = np.zeros(len(chosen)), 0.0
    m, v, mb, vb = np.zeros_like(w), np.zeros_like(w), 0.0, 0.0
    y = labels.astype(float)
    weight = np.where(y == 1, 0.5 / max(1, y.sum()), 0.5 / max(1, n - y.sum()))  # both classes count the same
    for t in range(1, steps + 1):
        z = np.bincount(row, weights=value * w[col], minlength=n) + b
        e = (1 / (1 + np.exp(-np.clip(z, -50, 50))) - y) * weight
        g, gb = np.bincount(col, weights=value * e[row], minlength=len(w)) + decay * w / len(w), e.sum()
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        mb, vb = 0.9 * mb + 0.1 * gb, 0.99 * vb + 0.01 * gb * gb
        w -= rate * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.99 ** t)) + 1e-8)
        b -= rate * (mb / (1 - 0.9 ** t)) / (np.sqrt(vb / (1 - 0.99 ** t)) + 1e-8)
    weights = np.zeros(size, np.float32)
    weights[chosen] = w * scale
    return Model(weights, float(b))


def probabilities(texts: list[bytes], model: Model) -> np.ndarray:
    """The score of each text."""
    keys = [np.empty(0, np.int64)]
    for doc, code in grams(texts):
        at = np.flatnonzero(model.weights[code])
        keys.append(_distinct(doc[at].astype(np.int64) << BITS | code[at]))
    every = _distinct(np.concatenate(keys))  # a feature counts once a text
    z = np.bincount(every >> BITS, weights=model.weights[every & ((1 << BITS) - 1)], minlength=len(texts)) + model.bias
    return 1 / (1 + np.exp(-np.clip(z, -50, 50)))


def fit(documents: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS, id_col: str = "doc_id", text_col: str = "text",
        label_col: str = "toxic") -> Model:
    """The model of the labelled rows that aren't held out: at most ``rows`` of each class."""
    known = (labels.where(labels[label_col].isNotNull() & labels[id_col].isNotNull())
             .groupBy(labels[id_col].alias("doc_id")).agg(F.max(label_col).cast("int").alias("label"))
             .where(~held_out(F.col("doc_id"))))
    first = None  # a bounded list of ids: it may be broadcast
    for label in (0, 1):
        some = known.where(F.col("label") == label).orderBy(F.xxhash64("doc_id"), "doc_id").limit(2 * rows)
        first = some if first is None else first.union(some)
    texts = (id_text(documents, id_col, text_col).join(F.broadcast(first), "doc_id")
             .where(F.octet_length("text") <= SAMPLE_BYTES))
    order = W.partitionBy("label").orderBy(F.xxhash64("doc_id"), "doc_id", "text")
    sample = texts.withColumn("r", F.row_number().over(order)).where(F.col("r") <= rows).select("text", "label")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known = sorted((label, text.encode("utf-8", "surrogatepass")) for b in batches for text, label in zip(b["text"], b["label"]))
        y = np.array([label for label, _ in known], dtype=np.int64)
        if 0 < y.sum() < len(y):
            model = train([text for _, text in known], y)
        else:
            model = Model(np.zeros(1 << BITS, np.float32), 50.0 if y.sum() else -50.0)
        places = np.flatnonzero(model.weights)
        yield pd.DataFrame({"bias": [model.bias], "places": [places.astype("<i4").tobytes()],
                            "weights": [model.weights[places].astype("<f4").tobytes()]})

    # the bounded sample meets in one task; the driver gets the few weights that aren't zero
    found = sample.repartition(1).mapInPandas(run, "bias double, places binary, weights binary").first()
    weights = np.zeros(1 << BITS, np.float32)
    if found is None:
        return Model(weights, -50.0)
    weights[np.frombuffer(found.places, "<i4")] = np.frombuffer(found.weights, "<f4")
    return Model(weights, found.bias)


def score(spark: SparkSession, df: DataFrame, model: Model, threshold: float = THRESHOLD, id_col: str = "doc_id",
          text_col: str = "text") -> DataFrame:
    """``doc_id``, ``held_out``, ``score``, ``predicted``: a row per row of ``df``."""
    base = id_text(df, id_col, text_col)
    kind = base.schema["doc_id"].dataType.simpleString()
    sent = spark.sparkContext.broadcast(model)  # 2^BITS weights, whatever the data

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = [t.as_py().encode("utf-8", "surrogatepass") for t in b.column(1)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(probabilities(texts, sent.value), pa.float64())],
                                             names=["doc_id", "score"])

    scored = base.mapInArrow(run, f"doc_id {kind}, score double")
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
                         F.when(F.col("score") >= threshold, 1).otherwise(0).alias("predicted"))


def drop_toxic(spark: SparkSession, df: DataFrame, model: Model, threshold: float = THRESHOLD, text_col: str = "text") -> DataFrame:
    """``df`` without the rows whose text scores ``threshold`` or more; columns as they were."""
    sent = spark.sparkContext.broadcast(model)
    schema, at = df.schema, df.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = [(t.as_py() or "").encode("utf-8", "surrogatepass") for t in b.column(at)]
            yield b.filter(pa.array(probabilities(texts, sent.value) < threshold))

    return df.mapInArrow(run, schema)
