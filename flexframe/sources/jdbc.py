"""JDBC read / write through Spark's own ``jdbc`` data source.

The caller passes url, user, password, driver and ``dbtable`` (no credential
lookup service). Reads can be split across executors with
``partitionColumn`` / ``lowerBound`` / ``upperBound`` / ``numPartitions``,
which Spark turns into ranged queries.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# Option names that pass straight through to Spark's jdbc source.
PASS_THROUGH = (
    "url", "user", "password", "driver", "dbtable", "query", "partitionColumn", "lowerBound",
    "upperBound", "numPartitions", "fetchsize", "batchsize", "isolationLevel", "truncate",
    "createTableOptions", "sessionInitStatement", "pushDownPredicate",
)


def jdbc_options(connection_options: dict) -> dict:
    opts = {k: str(v) for k, v in connection_options.items() if k in PASS_THROUGH}
    if "url" not in opts:
        raise ValueError("jdbc connection_options need a 'url'")
    if "dbtable" not in opts and "query" not in opts:
        raise ValueError("jdbc connection_options need 'dbtable' or 'query'")
    return opts


def read_jdbc(spark: SparkSession, connection_options: dict) -> DataFrame:
    return spark.read.format("jdbc").options(**jdbc_options(connection_options)).load()


def write_jdbc(df: DataFrame, connection_options: dict) -> None:
    mode = connection_options.get("mode", "append")
    df.write.format("jdbc").options(**jdbc_options(connection_options)).mode(mode).save()
