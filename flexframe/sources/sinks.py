"""Writers: connection + format, named collections, catalog tables, spigot.

Writes are ``DataFrameWriter`` calls; every writer returns the frame's error
rows as a frame named ``<name>_errors`` (lazy), after checking the error
thresholds recorded on the frame.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..errors import check_thresholds
from ..frame import Frame, FrameSet
from .readers import CSV_OPTION_NAMES, table_in


def _writer(df: DataFrame, fmt: str, format_options: dict, connection_options: dict):
    w = df.write.mode(connection_options.get("mode", "append"))
    keys = connection_options.get("partitionKeys") or connection_options.get("partitions")
    if keys:
        w = w.partitionBy(*([keys] if isinstance(keys, str) else keys))
    opts = dict(format_options)
    if fmt == "csv":
        opts = {CSV_OPTION_NAMES.get(k, k): (str(v).lower() if isinstance(v, bool) else v) for k, v in opts.items()}
    return w.format(fmt).options(**opts)


def _errors_of(frame: Frame) -> Frame:
    errs = frame.errorsAsFrame()
    errs.name = f"{frame.name}_errors"
    return errs


def write_frame(frame: Frame, connection_type: str, connection_options: dict, format: str | None, format_options: dict) -> Frame:
    check_thresholds(frame.errors)
    ctype = (connection_type or "").lower()
    fmt = (format or "parquet").lower()
    if ctype in ("parquet", "orc"):
        fmt = ctype
    if ctype in ("jdbc", "mysql", "postgresql", "oracle", "sqlserver", "redshift"):
        from .jdbc import write_jdbc

        write_jdbc(frame.df, connection_options)
        return _errors_of(frame)
    path = connection_options.get("path") or connection_options.get("paths")
    if isinstance(path, list):
        path = path[0]
    if not path:
        raise ValueError("connection_options needs a 'path'")
    _writer(frame.df, fmt, format_options, connection_options).save(path)
    return _errors_of(frame)


def write_from_options(frame_or_set, connection_type, connection_options=None, format=None, format_options=None):
    """Write a frame, or a collection with one output folder per frame name."""
    connection_options = dict(connection_options or {})
    format_options = dict(format_options or {})
    if isinstance(frame_or_set, Frame):
        return write_frame(frame_or_set, connection_type, connection_options, format, format_options)
    if isinstance(frame_or_set, FrameSet):
        base = (connection_options.get("path") or "").rstrip("/")
        out = {}
        for name, frame in frame_or_set.items():
            opts = dict(connection_options, path=f"{base}/{name}")
            out[f"{name}_errors"] = write_frame(frame, connection_type, opts, format, format_options)
        return FrameSet(out)
    raise TypeError(f"can write a Frame or a FrameSet, not {type(frame_or_set).__name__}")


def write_to_catalog(frame: Frame, database: str | None = None, table_name: str | None = None, name_space: str | None = None,
                     mode: str = "append", format: str = "parquet", partition_keys=None) -> Frame:
    """Write to a catalog table: insert by column name when it exists, else create it.

    A column that the frame or the table lacks raises; names match without regard to case.
    """
    full = table_in(database, name_space, table_name)
    check_thresholds(frame.errors)
    spark = frame.spark
    if spark.catalog.tableExists(full):
        have = {c.lower(): c for c in frame.df.columns}
        want = spark.table(full).columns
        missing, extra = [c for c in want if c.lower() not in have], set(have) - {c.lower() for c in want}
        if missing or extra:
            raise ValueError(f"columns don't match table {full}: missing {missing}, not in the table {sorted(extra)}")
        frame.df.select(*[F.col(f"`{have[c.lower()]}`").alias(c) for c in want]).write.mode(mode).insertInto(full)
    else:
        w = frame.df.write.mode(mode).format(format)
        if partition_keys:
            w = w.partitionBy(*partition_keys)
        w.saveAsTable(full)
    return _errors_of(frame)


def spigot(frame: Frame, path: str, options: dict) -> Frame:
    """Write a sample as JSON lines and pass the frame on unchanged.

    ``prob`` picks each record with that probability; ``topk`` keeps k records;
    both: the sample's k. Records are drawn by a hash of their content and the
    ``seed``, so a sample doesn't depend on partitions, order or retries; equal
    records are drawn together. ``topk`` keeps the k least hashes: k rows per
    task, no full sort.
    """
    df = frame.df
    prob = options.get("prob")
    topk = options.get("topk")
    if prob is None and topk is None:
        df.write.mode("overwrite").json(path)
        return frame
    text = F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns]), {"ignoreNullFields": "false"})
    draw = F.conv(F.substring(F.md5(F.concat(F.lit(f"{int(options.get('seed', 7))}/"), text)), 1, 13), 16, 10).cast("long")
    drawn = df.withColumn("__ff_draw", draw)
    if prob is not None:
        drawn = drawn.where(F.col("__ff_draw") < F.lit(int(float(prob) * (1 << 52))))
    if topk is not None:
        drawn = drawn.withColumn("__ff_text", text).orderBy("__ff_draw", "__ff_text").limit(int(topk)).drop("__ff_text")
    drawn.drop("__ff_draw").write.mode("overwrite").json(path)
    return frame
