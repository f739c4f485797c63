"""One registered query per operator, over its whole table, and SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import collocations, oracles, packing, quality, secret_scan, sentencepiece_codec, sharding, simhash, suffix_dedup, token_counts, topk, toxicity, warc, whitening

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def register(name: str):
    def add(fn):
        QUERIES[name] = fn
        return fn

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@register("op1_packing")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(spark, table(spark, sf_dir, "documents"), capacity=2048)


@register("op2_token_counts")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count(spark, table(spark, sf_dir, "documents"), limit=512)


@register("op3_quality_rules")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.apply(table(spark, sf_dir, "documents")).withColumn("failed_rules", F.array_join("failed_rules", ","))


@register("op4_sharding")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.assign(table(spark, sf_dir, "documents"), shards=40)


@register("op5_toxicity")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    return toxicity.score(spark, documents, toxicity.fit(documents, table(spark, sf_dir, "labels")))


@register("op6_exact_topk")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.self_search(table(spark, sf_dir, "embeddings"), every=100, k=10)


@register("op7_sentencepiece")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentencepiece_codec.digest(table(spark, sf_dir, "documents"))


@register("op8_secret_scan")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.scan(table(spark, sf_dir, "documents"))


@register("op9_suffix_dedup")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.dedup(spark, table(spark, sf_dir, "documents"), length=100)


@register("op10_simhash")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.cluster(spark, table(spark, sf_dir, "documents"))


@register("op11_warc")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(spark, table(spark, sf_dir, "pages"), least=1000).drop("target_uri")


@register("op12_collocations")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.mine(spark, table(spark, sf_dir, "documents"), least=100, longest=5, top=2000)


@register("op13_whitening")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    # a deviation beyond a long (from some ten million vectors on) is null here; the operator has it as decimal(38,0)
    return whitening.whiten(spark, table(spark, sf_dir, "embeddings"), components=8).withColumn("deviation", F.expr("try_cast(deviation AS bigint)"))


ORACLES.update({
    "op3_quality_rules": oracles.quality_rules(),
    "op6_exact_topk": oracles.topk(every=100, k=10),
    "op8_secret_scan": oracles.secrets(),
    "op11_warc": oracles.warc(least=1000),
    "op12_collocations": oracles.collocations(),
})
