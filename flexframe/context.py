"""Session-level entry point: ``ctx.read.from_options(...)``, ``ctx.write.from_options(...)``.

No subclass of the session: a thin holder of the ``SparkSession`` plus the
reader/writer facades, so jobs read like this::

    ctx = FlexContext(spark)
    orders = ctx.read.from_options("s3", {"paths": [...]}, format="parquet")
    ctx.write.from_options(orders.apply_mapping([...]), "s3", {"path": out}, format="parquet")
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from .frame import Frame, FrameSet
from .session import ensure_checkpoint_dir, ship_package
from .sources import readers, sinks


class FrameReader:
    def __init__(self, spark: SparkSession):
        self._spark = spark

    def from_options(self, connection_type, connection_options=None, format=None, format_options=None,
                     transformation_ctx="", push_down_predicate="", **kwargs) -> Frame:
        return readers.from_options(self._spark, connection_type, connection_options, format, format_options,
                                    transformation_ctx, push_down_predicate, **kwargs)

    def from_catalog(self, database=None, table_name=None, transformation_ctx="", push_down_predicate="",
                     additional_options=None, name_space=None, **kwargs) -> Frame:
        return readers.from_catalog(self._spark, database, table_name, transformation_ctx, push_down_predicate,
                                    additional_options, name_space, **kwargs)

    def from_rdd(self, data, name, schema=None, sampleRatio=None) -> Frame:
        return readers.from_rows(self._spark, data, name, schema, sampleRatio)


class FrameWriter:
    def __init__(self, spark: SparkSession):
        self._spark = spark

    def from_options(self, frame_or_set, connection_type, connection_options=None, format=None, format_options=None):
        return sinks.write_from_options(frame_or_set, connection_type, connection_options, format, format_options)

    def from_catalog(self, frame: Frame, database=None, table_name=None, name_space=None, **kwargs) -> Frame:
        return sinks.write_to_catalog(frame, database, table_name, name_space, **kwargs)

    def from_jdbc_conf(self, frame: Frame, connection_options: dict) -> Frame:
        return sinks.write_from_options(frame, "jdbc", connection_options)


class FlexContext:
    def __init__(self, spark: SparkSession):
        self.spark = spark
        ensure_checkpoint_dir(spark)
        ship_package(spark)
        self.read = FrameReader(spark)
        self.write = FrameWriter(spark)

    def frame(self, df, name: str = "") -> Frame:
        return Frame(df, name)

    def collection(self, frames) -> FrameSet:
        return FrameSet(frames, self.spark)
