"""File-based inputs: keyword line files and file-tree selection."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed value: the byte-order mark stripped from the first line of a file.
BOM = "﻿"


def keyword_lines(spark: SparkSession, paths) -> DataFrame:
    """One keyword per non-empty line (BOM and CR stripped), column ``keyword``."""
    raw = spark.read.text(paths)
    kw = F.regexp_replace(F.regexp_replace(F.col("value"), "^" + BOM, ""), "\r$", "")
    return raw.select(kw.alias("keyword")).where(F.col("keyword") != "")


def select_files(spark: SparkSession, root: str, extension: str = "jpg", max_index: int = 5,
                 drop_suffixes=("gif", "svg")) -> DataFrame:
    """Files ``<dir>/<n>.<extension>`` with numeric ``n`` below ``max_index``.

    Lists through the ``binaryFile`` source selecting only path columns, so no
    file content is read. Files ending in a dropped suffix never qualify.
    """
    listing = (spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root)
               .select("path", "length"))
    name = F.substring_index(F.col("path"), "/", -1)
    directory = F.regexp_extract(F.col("path"), r"^(.*)/[^/]*$", 1)
    stem = F.regexp_extract(name, r"^([0-9]+)\." + extension + "$", 1)
    suffix = F.lower(F.substring_index(name, ".", -1))
    return (listing.select("path", directory.alias("directory"), name.alias("file_name"),
                           stem.alias("stem"), suffix.alias("suffix"), "length")
            .where((F.col("stem") != "") & (F.col("stem").cast("int") < max_index)
                   & ~F.col("suffix").isin(*drop_suffixes))
            .drop("stem", "suffix"))
