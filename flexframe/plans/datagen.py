"""Spec-driven table generation: ``spark.range`` plus one column expression per spec entry.

Spec (YAML or dict)::

    tables:
    - name: t
      rows: 1000               # or the row count of a DataFrame passed in
      seed: 11                 # optional; random columns use seed + column position
      partitions: [col]        # optional partitionBy on write
      beside: /path            # optional: columns for every row of a parquet table, instead of ``rows``;
      keys: [id]               #   its key columns, which random draws follow from
      row: id                  #   optional: what numbers the rows of Sequential columns
      columns:
      - {name: id, column_type: Sequential, start: 0, step: 1, data_type: Int}
      - {name: c, column_type: Expression, expression: "concat('x', id)"}
      - {name: r, column_type: Random, min: 1, max: 5, decimal_places: 2, data_type: Float}
      - {name: d, column_type: Random, data_type: Date, min: ..., max: ...}
      - {name: v, column_type: Random, values: "1,0,2,", data_type: Int}
      - {name: f, column_type: Fixed, value: abc, data_type: String}

Columns are added in order, so expressions see earlier columns. Every column
is a built-in expression (no Python per row); ``spark.range`` ids are dense at
any partition count, so generation runs on as many partitions as Spark likes.
Random columns use ``rand(seed)``: the same seed and partitioning repeat.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from ..functions.rownumbers import with_row_numbers

# Spec type names and the Spark type each casts to (others: string).
CASTS = {"Int": "int", "Float": "double"}


def _cast(col: Column, data_type, source=None) -> Column:
    if data_type is None:
        return col
    from pyspark.sql.types import _parse_datatype_string

    from ..functions.casts import safe_cast

    return safe_cast(col, _parse_datatype_string(CASTS.get(data_type, "string")), source)


def _parse_ts(value) -> Column:
    return F.to_timestamp(F.lit(str(value)))


def keyed_uniform(keys: list[Column], seed: int) -> Column:
    """A number in [0, 1) that depends on the keys and the seed alone: 52 bits of an MD5."""
    text = F.concat_ws("/", F.lit(str(seed)), *[k.cast("string") for k in keys])
    return F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("double") / float(1 << 52)


def column_expr(spec: dict, seed: int, row: Column | None = None, uniform: Column | None = None) -> Column:
    """One column of a spec; ``row`` numbers the rows, ``uniform`` is the random draw (default: ``rand``)."""
    row = F.col("__ff_row") if row is None else row
    kind = spec.get("column_type")
    data_type = spec.get("data_type")
    if kind == "Sequential":
        return _cast(F.lit(spec.get("start", 0)) + F.lit(spec.get("step", 1)) * row, data_type)
    if kind == "Fixed":
        return _cast(F.lit(spec.get("value")), data_type)
    if kind == "Expression":
        return _cast(F.expr(spec["expression"]), data_type)
    if kind == "Random":
        r = F.rand(seed) if uniform is None else uniform
        if data_type == "Date":
            lo, hi = _parse_ts(spec["min"]), _parse_ts(spec["max"])
            span = F.unix_micros(hi) - F.unix_micros(lo)
            ts = F.timestamp_micros(F.unix_micros(lo) + F.floor(r * span).cast("long"))
            unit = spec.get("unit")
            fmt = "yyyy-MM-dd" if unit == "day" else "yyyy-MM-dd HH:mm:ss.SSSSSS"
            return F.date_format(ts, fmt)
        if spec.get("values") is not None:
            items = F.split(F.lit(str(spec["values"])), ",")
            pick = F.element_at(items, (F.floor(r * F.size(items)) + 1).cast("int"))
            return _cast(pick, data_type, StringType())
        places = int(spec.get("decimal_places", spec.get("decimalPlaces", 0)) or 0)
        lo, hi = float(spec["min"]), float(spec["max"])
        return _cast(F.round(r * F.lit(hi - lo) + F.lit(lo), places), data_type)
    raise ValueError(f"unknown column_type {kind!r}")


def generate_table(spark: SparkSession, table: dict, rows: int | None = None, num_partitions: int | None = None) -> DataFrame:
    n = int(rows if rows is not None else table["rows"])
    base_seed = int(table.get("seed", 0))
    df = spark.range(0, n, 1, num_partitions) if num_partitions else spark.range(n)
    df = df.withColumnRenamed("id", "__ff_row")
    for i, col in enumerate(table["columns"]):
        df = df.withColumn(col["name"], column_expr(col, base_seed + i))
    return df.drop("__ff_row")


def generate_beside(df: DataFrame, table: dict, keys: list[str], row: Column | str | None = None) -> DataFrame:
    """The spec's columns for every row of ``df``; expressions may use its columns.

    ``row`` numbers the rows of Sequential columns, and random draws follow
    from ``keys``, so the result doesn't depend on partitioning or retries.
    Without ``row`` the rows are numbered 0, 1, ... as they come (staged once).
    """
    if row is None:
        df, row = with_row_numbers(df, "__ff_row"), F.col("__ff_row")
    number = F.expr(row) if isinstance(row, str) else row
    base_seed, out = int(table.get("seed", 0)), df
    for i, col in enumerate(table["columns"]):
        draw = keyed_uniform([F.col(k) for k in keys], base_seed + i)
        out = out.withColumn(col["name"], column_expr(col, base_seed + i, number, draw))
    return out.select(*keys, *[c["name"] for c in table["columns"]])


def load_spec(spec) -> dict:
    if isinstance(spec, dict):
        return spec
    import yaml

    with open(spec) as fh:
        return yaml.safe_load(fh)


def generate_and_write(spark: SparkSession, spec, out: str, mode: str = "overwrite") -> dict[str, str]:
    """Generate every table of the spec and write each as parquet under ``out/<name>``."""
    written = {}
    for table in load_spec(spec)["tables"]:
        if table.get("beside"):
            df = generate_beside(spark.read.parquet(table["beside"]), table, list(table["keys"]), table.get("row"))
        else:
            df = generate_table(spark, table)
        w = df.write.mode(mode).format("parquet")
        keys = table.get("partitions") or []
        dates = {c["name"] for c in table["columns"] if c.get("data_type") == "Date" and c.get("unit") != "day"}
        if dates & set(keys):
            # a folder for each day, not for each microsecond: the day stands in a column beside the time
            df = df.withColumns({f"{k}_day": F.substring(k, 1, 10) for k in keys if k in dates})
            keys = [f"{k}_day" if k in dates else k for k in keys]
            w = df.write.mode(mode).format("parquet")
        if keys:
            w = w.partitionBy(*keys)
        path = f"{out.rstrip('/')}/{table['name']}"
        w.save(path)
        written[table["name"]] = path
    return written


def main(argv=None):
    import argparse

    from ..session import local_session

    ap = argparse.ArgumentParser(description="generate tables from a YAML spec")
    ap.add_argument("--yaml", required=True)
    ap.add_argument("--out", required=True)
    args = ap.parse_args(argv)
    spark = local_session()
    for name, path in generate_and_write(spark, args.yaml, args.out).items():
        print(name, path)


if __name__ == "__main__":
    main()
