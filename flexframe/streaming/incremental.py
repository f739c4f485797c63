"""Incremental ingestion as a Structured Streaming job.

The same contract as the bookmark ledger ("each transformation_ctx sees only
input it has not committed yet"), expressed with Spark's own file source:
``readStream`` over the landing folder, ``trigger(availableNow=True)`` so each
run processes exactly the files that arrived since the last run and then
stops, and one checkpoint per ctx under the shared checkpoint folder. The
checkpoint commits at the end of every micro-batch, so a lost executor or a
re-run never reprocesses committed files. Each micro-batch is handed to the
caller as a ``Frame``.

Without a schema, JSON is read as drifting JSON, line by line: a micro-batch
has the type of all batches so far, which is kept beside the checkpoint (one
small file per batch, written before the batch is handed over, so that a batch
that is run again finds the same type).
"""

from __future__ import annotations

from typing import Callable

from pyspark.sql import SparkSession
from pyspark.sql.types import StructType

from ..frame import Frame
from ..operators.choice import frame_from_json_text
from ..schema import bounded, dumps, loads, merge_types
from ..session import ensure_checkpoint_dir
from ..sources.store import Store


def run_incremental(
    spark: SparkSession,
    path: str,
    fmt: str,
    schema: StructType | str | None,
    transformation_ctx: str,
    process: Callable[[Frame, int], None],
    checkpoint_root: str | None = None,
    options: dict | None = None,
) -> None:
    """Process every not-yet-seen file under ``path`` once, then return."""
    root = checkpoint_root or f"{ensure_checkpoint_dir(spark).rstrip('/')}/flexframe-streams"
    drifting = fmt == "json" and schema is None
    reader = spark.readStream.format("text") if drifting else spark.readStream.format(fmt).schema(schema)
    stream = reader.options(**(options or {})).load(path)
    types = Store(spark, f"{root}/{transformation_ctx}-types")

    def each(batch_df, batch_id):
        if not drifting:
            process(Frame(batch_df, transformation_ctx), batch_id)
            return

        def kept(found):
            # of the batches before this one: a batch that is run again must not see its own
            before = [n for n in types.names("") if n.endswith(".json") and int(n[:-5]) < batch_id]
            merged = bounded(merge_types(loads(types.read(before[-1])), found)) if before else found
            own = f"{batch_id:010d}.json"
            if merged is not None and own not in types.names(""):
                types.publish(own, dumps(merged))
            return merged

        frame = frame_from_json_text(batch_df, "value", transformation_ctx, kept=kept)
        frame.name = transformation_ctx
        process(frame, batch_id)

    query = (stream.writeStream.foreachBatch(each)
             .option("checkpointLocation", f"{root}/{transformation_ctx}")
             .trigger(availableNow=True)
             .start())
    query.awaitTermination()
