"""The corpus pipeline: toxicity, SimHash near-dedup, suffix-array dedup, secret scan, packing.

``STAGES`` lists (name, function); each function takes (spark, docs, sf_dir)
and returns a DataFrame that is written as Parquet and read again as the next
stage's ``docs``. All but the last return the columns of ``documents``.

Every stage takes nulls in any column, empty and very long texts, ties,
repeated rows, extra columns and empty tables:

* toxicity: a null or empty text has the classifier's bare score; repeated rows
  share a verdict; without labelled rows of both classes the share of toxic
  labels is every score.
* SimHash: a null text counts as empty and stays null; rows with a null id all
  stay, as do repeats of a row whose id is the least of its group.
* suffix dedup, secret scan: all rows stay, and a null text stays null;
  ``n_chars`` follows the text.
* packing: a null text is one piece with the end id alone; a null id is kept.

Extra columns pass through all stages but the last; empty tables give empty
results.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flexframe.llm import packing, secret_scan, simhash, suffix_dedup, toxicity
from flexframe.llm.common import staged
from flexframe.session import ensure_checkpoint_dir, ship_package

#: Contract of the SimHash stage: words of a shingle, and most differing bits.
SHINGLE, RADIUS = 3, 2
#: Bytes of the repeated strings that the suffix stage removes.
REPEATED = 100
CAPACITY = 2048


def _ready(spark: SparkSession) -> None:
    ensure_checkpoint_dir(spark)
    ship_package(spark)


def _counted(docs: DataFrame) -> DataFrame:
    """``n_chars`` after a change of ``text``."""
    if "n_chars" not in docs.columns:
        return docs
    kind = docs.schema["n_chars"].dataType
    return docs.withColumn("n_chars", F.char_length("text").cast(kind))


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents below the toxicity threshold; the classifier learns from the labelled rows of ``documents``."""
    _ready(spark)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return toxicity.drop_toxic(spark, docs, toxicity.fit(documents, labels))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the least id, of each group of near copies."""
    _ready(spark)
    return simhash.keep_one(spark, docs, SHINGLE, RADIUS)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the strings that also start earlier."""
    _ready(spark)
    return _counted(suffix_dedup.cut(spark, docs, REPEATED))


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets replaced by a mark."""
    _ready(spark)
    return _counted(secret_scan.redact(docs))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in sequences."""
    _ready(spark)
    return packing.pack_documents(spark, docs, capacity=CAPACITY)


STAGES = [
    ("toxicity", drop_toxic),
    ("simhash", drop_near_copies),
    ("suffix_dedup", cut_repeats),
    ("secret_scan", mask_secrets),
    ("packing", pack),
]

#: Toxicity, SimHash, suffix dedup and packing are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    _ready(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = staged(spark, docs, f"pipeline-{name}")
    return docs
