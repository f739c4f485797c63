"""Token counts with the whole-token shortcut.

Which vocabulary strings encode alone as one token is proven offline, once, on
the driver; the list (bounded by the vocabulary) is broadcast. On the
executors, pre-tokens in the list count as one, and only the rest is merged.

Defined results: null text is empty (0 bytes, 0 tokens); special strings inside
texts count as their one token; texts of any length are counted whole; repeated
rows repeat; other columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe
from .common import id_text

LIMIT = 512


def count(spark: SparkSession, df: DataFrame, path: str | None = None, limit: int = LIMIT,
          id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id``, ``n_bytes``, ``n_tokens``, ``over_limit``: a row per row of ``df``."""
    path = path or bpe.default_path()
    whole = spark.sparkContext.broadcast(bpe.prove_whole(path))
    base = id_text(df, id_col, text_col).select("doc_id", "text", F.octet_length("text").cast("long").alias("n_bytes"))
    kind = base.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = bpe.loaded(path, whole.value)
        for b in batches:
            n = [len(tokenizer.ids(t.as_py())) // 4 for t in b.column(1)]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(2), pa.array(n, pa.int64())],
                                             names=["doc_id", "n_bytes", "n_tokens"])

    out = base.mapInArrow(run, f"doc_id {kind}, n_bytes long, n_tokens long")
    return out.withColumn("over_limit", F.col("n_tokens") > limit)
