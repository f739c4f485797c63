"""Readers: connection + format, catalog tables, local rows, DataFrames.

Everything lands on ``spark.read`` so the scan is Spark's own (vectorized
parquet/ORC, pushed filters, pruned columns). A ``push_down_predicate`` is a
plain ``where`` on the loaded DataFrame; Catalyst pushes it into the scan and
prunes partitions.
"""

from __future__ import annotations

import os
import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ..errors import ErrorStage, error_rows
from ..frame import Frame, new_name
from .bookmark import selecting_job

# File-like connection types, and the options renamed for csv.
FILE_CONNECTIONS = ("s3", "file", "hdfs", "local", "gs", "abfs", "adl", "wasb")
CSV_OPTION_NAMES = {
    "separator": "sep",
    "withHeader": "header",
    "quoteChar": "quote",
    "escaper": "escape",
    "multiline": "multiLine",
    "skipFirst": "header",
}
CORRUPT = "_corrupt_record"


def frame_name(paths: list[str]) -> str:
    """Name from the common prefix of the paths, else a uuid."""
    if paths:
        prefix = os.path.commonprefix([str(p) for p in paths])
        tail = prefix.split(":")[-1]
        name = re.sub(r"[:/.]", "", tail)
        if name:
            return name
    return new_name()


def _paths(connection_options: dict) -> list[str]:
    p = connection_options.get("paths", connection_options.get("path", []))
    return [p] if isinstance(p, str) else list(p)


def apply_partition_hints(df: DataFrame, options: dict) -> DataFrame:
    """``minPartitions`` / ``targetPartitions``: raise to min, lower to target."""
    min_p = options.get("minPartitions")
    target = options.get("targetPartitions", min_p)
    if min_p is None and target is None:
        return df
    min_p = int(min_p) if min_p is not None else int(target)
    target = int(target) if target is not None else min_p
    n = df.rdd.getNumPartitions()
    if n < min_p:
        return df.repartition(min_p)
    if n > target:
        return df.coalesce(target)
    return df


def _csv_options(format_options: dict) -> dict:
    out = {}
    for k, v in format_options.items():
        out[CSV_OPTION_NAMES.get(k, k)] = str(v).lower() if isinstance(v, bool) else v
    return out


def _read_csv(load, paths: list[str], options: dict, schema, ctx: str) -> tuple[DataFrame, ErrorStage]:
    """Rows that fit the columns (given, or those of the header and the inferred types), and the others as errors."""
    if schema is None:
        found = load(lambda r: r.options(**options).csv(paths)).schema
    else:
        found = schema if isinstance(schema, StructType) else StructType.fromDDL(schema)
    wide = StructType([*found.fields, StructField(CORRUPT, StringType())])
    rest = {k: v for k, v in options.items() if k.lower() not in ("mode", "columnnameofcorruptrecord", "inferschema")}
    df = load(lambda r: r.schema(wide).options(**rest).option("mode", "PERMISSIVE")
              .option("columnNameOfCorruptRecord", CORRUPT).csv(paths))
    # a line is only checked against the columns that are read, so the filter touches all (always true)
    cols = [F.col("`" + f.name + "`") for f in found.fields]
    touch = F.hash(*cols) >= -(1 << 31) if cols else F.lit(True)
    bad = df.where(F.col(CORRUPT).isNotNull() & touch).select(
        F.lit("read_csv").alias("op"), F.lit(ctx).alias("transformation_ctx"),
        F.lit("").alias("info"), F.lit("malformed csv line").alias("message"), F.col(CORRUPT).alias("record"))
    return df.where(F.col(CORRUPT).isNull() & touch).drop(CORRUPT), ErrorStage("read_csv", ctx, "", bad)


def from_options(
    spark: SparkSession,
    connection_type: str,
    connection_options: dict | None = None,
    format: str | None = None,
    format_options: dict | None = None,
    transformation_ctx: str = "",
    push_down_predicate: str = "",
    schema: StructType | str | None = None,
    **hints,
) -> Frame:
    """Read a frame from a connection (files or JDBC) in a given format."""
    connection_options = dict(connection_options or {})
    format_options = dict(format_options or {})
    ctype = (connection_type or "").lower()
    fmt = (format or "").lower()
    if ctype in ("parquet", "orc"):
        fmt, ctype = ctype, "file"
    if ctype in ("jdbc", "mysql", "postgresql", "oracle", "sqlserver", "redshift"):
        from .jdbc import read_jdbc

        df = read_jdbc(spark, connection_options)
        if push_down_predicate:
            df = df.where(push_down_predicate)
        return Frame(df, connection_options.get("dbtable", new_name()))
    paths = _paths(connection_options)
    name = frame_name(paths)

    job = selecting_job(transformation_ctx)
    chosen = job.select_paths(transformation_ctx, paths) if job else None

    def load(make) -> DataFrame:
        """``make(reader)``, over the files a bookmark leaves if there is one."""
        return make(spark.read) if chosen is None else chosen.load(spark, make)

    if fmt == "json":
        from ..operators.choice import read_json_frame

        kept = None if job is None else lambda t: job.kept_type(transformation_ctx, t)
        frame = read_json_frame(spark, paths, schema=schema, ctx=transformation_ctx, load=load, kept=kept, **format_options)
        frame.name = name
        if push_down_predicate:
            frame.df = frame.df.where(push_down_predicate)
        frame.df = apply_partition_hints(frame.df, {**connection_options, **hints})
        return frame

    errors = []
    if fmt == "csv":
        df, stage = _read_csv(load, paths, _csv_options(format_options), schema, transformation_ctx)
        errors.append(stage)
    else:
        with_schema = lambda r: r if schema is None else r.schema(schema)
        df = load(lambda r: with_schema(r).format(fmt or "parquet").options(**format_options).load(paths))
    if push_down_predicate:
        df = df.where(push_down_predicate)
    df = apply_partition_hints(df, {**connection_options, **hints})
    return Frame(df, name, errors)


def table_in(database: str | None, name_space: str | None, table_name: str | None) -> str:
    """The full name of a catalog table; the database goes by either of two argument names."""
    given = [x for x in (database, name_space) if x is not None]
    if len(given) > 1:
        raise ValueError(f"the database is named twice: {database!r} and {name_space!r}")
    if not table_name:
        raise ValueError("no table_name was given")
    return ".".join([*filter(None, given), table_name])


def table_folder(spark: SparkSession, full: str) -> str | None:
    """The folder of a catalog table whose files all lie below it; None for views and for tables with partitions elsewhere."""
    told = {r.col_name: r.data_type for r in spark.sql(f"DESCRIBE TABLE EXTENDED {full}").collect()}
    # partitions of a Hive table may lie anywhere; those of a data source table lie in its folder
    if told.get("Type") not in ("MANAGED", "EXTERNAL") or str(told.get("Provider")).lower() == "hive":
        return None
    return told.get("Location")


def from_catalog(
    spark: SparkSession,
    database: str | None = None,
    table_name: str | None = None,
    transformation_ctx: str = "",
    push_down_predicate: str = "",
    additional_options: dict | None = None,
    name_space: str | None = None,
    **kwargs,
) -> Frame:
    """Read a catalog table (``database.table`` or a temp view when no database).

    Under a bookmark job only the table's new files are read; the table must be one of files then.
    """
    full = table_in(database, name_space, table_name)
    df = spark.table(full)
    job = selecting_job(transformation_ctx)
    if job:
        folder = table_folder(spark, full)
        if folder is not None:
            chosen = job.select_paths(transformation_ctx, [folder])
        else:  # a view, or partitions in folders of their own: the rows' own metadata
            chosen = job.select(transformation_ctx, df.select(
                F.col("_metadata.file_path").alias("file_path"), F.col("_metadata.file_modification_time").alias("modified_at")).distinct())
        df = chosen.only(df)
    if push_down_predicate:
        df = df.where(push_down_predicate)
    df = apply_partition_hints(df, dict(additional_options or {}))
    return Frame(df, table_name)


def from_rows(spark: SparkSession, data, name: str, schema=None, sampleRatio=None) -> Frame:
    """Frame from local rows, an RDD or a pandas DataFrame."""
    return Frame(spark.createDataFrame(data, schema=schema, samplingRatio=sampleRatio), name)


def from_df(df: DataFrame, name: str = "") -> Frame:
    return Frame(df, name)


def with_errors(frame: Frame, message_col, op: str, ctx: str = "") -> Frame:
    bad = error_rows(frame.df, message_col, op, ctx, "")
    return frame._next(frame.df.where(message_col.isNull()), ErrorStage(op, ctx, "", bad))
