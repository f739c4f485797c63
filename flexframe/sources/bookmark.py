"""Incremental reads ("bookmarks"): each transformation_ctx sees only new files.

The ledger is a folder that stays the same between applications
(``<spark.checkpoint.dir>/flexframe-bookmarks`` unless one is given). In it,

* ``runs/<job>/<number>`` is claimed by a run as it begins, so that no two runs
  of a job have one number, even if they run at once;
* ``files/...`` are parquet tables ``(job, ctx, run_id, file_path,
  modified_at)`` of what a run reads;
* ``runs/<job>/<number>.json`` is the manifest of a committed run: its tables,
  and the types of drifting JSON that it read. It is published by a rename, so a
  run is committed as a whole or not at all: files that no manifest names
  count for nothing.

The input is listed with Spark's ``binaryFile`` source, of which only the file
metadata columns are read; a file is new if the ledger doesn't hold it with its
present modification time, so files that were overwritten are read again.

What a ctx has to read is a staged table, never a list on the driver. The
input itself is loaded by its folders (partition columns stay) and narrowed by
modification time, which Spark applies to its listing, and then to the exact
files by a semi join on the file metadata.

``Job.commit()`` records what each ctx read during this run; without a commit
nothing is remembered. Modes (``job-bookmark-option``): ``job-bookmark-enable``
reads new files and records them; ``job-bookmark-pause`` reads new files
without recording, or with ``job-bookmark-from`` / ``job-bookmark-to`` re-reads
the files recorded by runs after *from* up to *to*; ``job-bookmark-disable``
(default) reads everything.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass
from datetime import datetime, timedelta
from urllib.parse import quote as url_quote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schema import bounded, dumps, loads, merge_types
from ..session import ensure_checkpoint_dir
from .store import Store

# Option values, and the older names that map onto them in order.
ENABLE, PAUSE, DISABLE = "job-bookmark-enable", "job-bookmark-pause", "job-bookmark-disable"
OLD_NAMES = {"continuation-enabled": ENABLE, "continuation-readonly": PAUSE, "continuation-ignore": DISABLE}
LEDGER_SCHEMA = "job string, ctx string, run_id long, file_path string, modified_at timestamp"

_ACTIVE: "Job | None" = None


def _option(args: dict, name: str):
    """An option by its name, with or without leading dashes, with dashes or underscores."""
    for key in (name, f"--{name}", name.replace("-", "_")):
        if args.get(key) is not None:
            return args[key]
    return None


@dataclass(frozen=True)
class Selection:
    """The files one ctx has to read: a staged table, and the time range they lie in (None: no file)."""

    files: DataFrame
    since: datetime | None
    until: datetime | None

    def narrow(self, reader):
        """A reader that lists only files of the time range."""
        stamp = lambda t: t.strftime("%Y-%m-%dT%H:%M:%S")
        return (reader.option("modifiedAfter", stamp(self.since - timedelta(seconds=1)))
                .option("modifiedBefore", stamp(self.until + timedelta(seconds=2))))

    def only(self, df: DataFrame) -> DataFrame:
        """The rows of ``df`` that come from the chosen files; ``df`` must be a file scan."""
        chosen = self.files.select(F.col("file_path").alias("__ff_path"))
        tagged = df if "__ff_file" in df.columns else df.withColumn("__ff_file", F.col("_metadata.file_path"))
        return tagged.join(chosen, F.col("__ff_file") == F.col("__ff_path"), "left_semi").drop("__ff_file")

    def load(self, spark: SparkSession, make):
        """``make(reader)`` over the chosen files; without any, its columns and no row."""
        if self.since is None:
            return make(spark.read).where(F.lit(False))
        return self.only(make(self.narrow(spark.read)))


class Job:
    def __init__(self, spark: SparkSession, bookmark_dir: str | None = None):
        self.spark = spark
        self.ledger_path = bookmark_dir or f"{ensure_checkpoint_dir(spark).rstrip('/')}/flexframe-bookmarks"
        self.name = None
        self.mode = DISABLE
        self.range = None
        self.run_id = None
        self.store = Store(spark, self.ledger_path)
        self._pending: list[str] = []
        self._types: dict[str, str] = {}

    def init(self, job_name: str, args: dict | None = None) -> "Job":
        global _ACTIVE
        args = dict(args or {})
        mode = _option(args, "job-bookmark-option") or _option(args, "continuation-option") or DISABLE
        mode = OLD_NAMES.get(mode, mode)
        if mode not in (ENABLE, PAUSE, DISABLE):
            raise ValueError(f"unknown bookmark option {mode!r}")
        ends = [_option(args, "job-bookmark-from"), _option(args, "job-bookmark-to")]
        given = sum(x is not None for x in ends)
        if mode == PAUSE and given == 1:
            raise ValueError("job-bookmark-from and job-bookmark-to go together")
        if mode != PAUSE and given == 2:
            raise ValueError("a bookmark range is only allowed with job-bookmark-pause")
        self.name = job_name
        self.mode = mode
        self.range = (int(ends[0]), int(ends[1])) if mode == PAUSE and given == 2 else None
        self._manifests = self._committed()
        self.run_id = self._claim_run()
        self._pending, self._types = [], {}
        _ACTIVE = self
        return self

    def isInitialized(self) -> bool:
        return self.name is not None

    @property
    def _runs(self) -> str:
        return f"runs/{url_quote(self.name, safe='')}"

    def _committed(self) -> list[dict]:
        """The manifests of the job's committed runs, in order."""
        return [json.loads(self.store.read(f"{self._runs}/{n}")) for n in self.store.names(self._runs) if n.endswith(".json")]

    def _claim_run(self) -> int:
        """A number greater than that of any run before, which no other run gets."""
        taken = [int(n) for n in self.store.names(self._runs) if n.isdigit()]
        number = max([*taken, *(m["run_id"] for m in self._manifests), self._earlier_run()], default=0) + 1
        while not self.store.claim(f"{self._runs}/{number:010d}"):
            number += 1
        return number

    def _earlier(self) -> DataFrame | None:
        """Rows that stand in the ledger's folder itself, as runs without manifests left them."""
        if not any(n.endswith(".parquet") for n in self.store.names("")):
            return None
        return self.spark.read.schema(LEDGER_SCHEMA).parquet(f"{self.ledger_path.rstrip('/')}/*.parquet").where(F.col("job") == self.name)

    def _earlier_run(self) -> int:
        rows = self._earlier()
        return 0 if rows is None else rows.agg(F.max("run_id").alias("m")).collect()[0]["m"] or 0

    def _ledger(self) -> DataFrame:
        """What the committed runs of this job read."""
        folders = [f"{self.ledger_path.rstrip('/')}/{f}" for m in self._manifests for f in m["files"]]
        rows = self.spark.read.schema(LEDGER_SCHEMA).parquet(*folders) if folders else self.spark.createDataFrame([], LEDGER_SCHEMA)
        earlier = self._earlier()
        return rows if earlier is None else rows.unionByName(earlier)

    def kept_type(self, ctx: str, found):
        """The type found in a read, merged with that of the earlier ones; the next commit keeps it."""
        before = next((m["types"][ctx] for m in reversed(self._manifests) if ctx in m.get("types", {})), None)
        merged = found if before is None else bounded(merge_types(loads(before), found))
        if self.mode == ENABLE and merged is not None:
            self._types[ctx] = dumps(merged)
        return merged

    def _listing(self, paths: list[str]) -> DataFrame:
        return (self.spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(paths)
                .select(F.col("_metadata.file_path").alias("file_path"),
                        F.col("_metadata.file_modification_time").alias("modified_at")))

    def select(self, ctx: str, listing: DataFrame) -> Selection:
        """What of ``listing`` (file_path, modified_at) this ctx should read in this run."""
        seen = self._ledger().where((F.col("job") == self.name) & (F.col("ctx") == ctx))
        if self.range is not None:
            lo, hi = self.range
            recorded = seen.where((F.col("run_id") > lo) & (F.col("run_id") <= hi)).select("file_path")
            chosen = listing.join(recorded, "file_path", "left_semi")
        else:
            chosen = listing.join(seen.select("file_path", "modified_at"), ["file_path", "modified_at"], "left_anti")
        table = f"files/run-{self.run_id}-{uuid.uuid4().hex}"
        path = f"{self.ledger_path.rstrip('/')}/{table}"
        chosen.select(F.lit(self.name).alias("job"), F.lit(ctx).alias("ctx"), F.lit(self.run_id).cast("long").alias("run_id"),
                      "file_path", "modified_at").write.mode("overwrite").parquet(path)
        files = self.spark.read.schema(LEDGER_SCHEMA).parquet(path).select("file_path", "modified_at")
        # wall-clock times of the session's zone, as the listing options read them
        clock = lambda x: F.to_timestamp_ntz(F.date_format(x, "yyyy-MM-dd HH:mm:ss"))
        ends = files.agg(clock(F.min("modified_at")).alias("since"), clock(F.max("modified_at")).alias("until")).collect()[0]
        if self.mode == ENABLE and ends["since"] is not None:
            self._pending.append(table)
        return Selection(files, ends["since"], ends["until"])

    def select_paths(self, ctx: str, paths: list[str]) -> Selection:
        return self.select(ctx, self._listing(paths))

    def commit(self) -> None:
        """Records what was read, and ends the run: later reads are whole again."""
        global _ACTIVE
        if self._pending or self._types:
            manifest = {"job": self.name, "run_id": self.run_id, "files": self._pending, "types": self._types}
            self.store.publish(f"{self._runs}/{self.run_id:010d}.json", json.dumps(manifest))
        self._pending, self._types = [], {}
        if _ACTIVE is self:
            _ACTIVE = None


def active_job() -> "Job | None":
    return _ACTIVE


def selecting_job(ctx: str) -> "Job | None":
    """The job that decides what ``ctx`` reads, if any does."""
    job = _ACTIVE
    if not ctx or job is None or not job.isInitialized() or job.mode == DISABLE:
        return None
    return job
