"""Control files that come with a feed: expected columns and expected row counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from feedstat.functions.casting import split_part


def read_header_names(spark: SparkSession, path: str, sep: str = ",") -> list[str]:
    """Column names in a header file."""
    return spark.read.options(header=True, sep=sep).csv(path).columns


def _path(dataset_pattern: str) -> Column:
    return F.regexp_extract("_metadata.file_path", dataset_pattern, 1)


def first_lines(spark: SparkSession, path: str, dataset_pattern: str) -> DataFrame:
    """(dataset, value) of the first line of every file below ``path``.

    Only the first line of a file's first block is a candidate, so a long file adds one row.
    """
    lines = spark.read.option("recursiveFileLookup", True).text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"), "value",
        F.monotonically_increasing_id().alias("place"),
    )
    # within a block the number rises by line, so the least one is the first line's
    first = lines.where("start = 0").groupBy("file").agg(F.min("place").alias("place"))
    own = lines.where("start = 0").join(first, ["file", "place"], "left_semi")
    return own.select(F.regexp_extract("file", dataset_pattern, 1).alias("dataset"), "value")


def split_header(line: Column, sep: str) -> Column:
    """The names in a header line, read as delimited text is: quotes go, what they enclose stays together."""
    quoted = "\"(?:[^\"]|\"\")*\""
    cell = f"(?:^|\\Q{sep}\\E)(\\s*{quoted}\\s*|(?:(?!\\Q{sep}\\E).)*)"
    names = F.regexp_extract_all(line, F.lit(cell), F.lit(1))
    bare = F.transform(names, lambda x: F.trim(x))
    inner = lambda x: F.replace(F.substr(x, F.lit(2), F.length(x) - 2), F.lit('""'), F.lit('"'))
    is_quoted = lambda x: x.startswith('"') & x.endswith('"') & (F.length(x) >= 2)
    return F.transform(bare, lambda x: F.when(is_quoted(x), inner(x)).otherwise(x))


def read_headers(spark: SparkSession, path: str, dataset_pattern: str, sep: str = ",") -> DataFrame:
    """(dataset, column_name) for the header files of many datasets: their first lines.

    ``dataset_pattern`` is a regular expression with one group that finds the
    dataset in the file path.
    """
    return first_lines(spark, path, dataset_pattern).select(
        "dataset", F.explode(split_header(F.col("value"), sep)).alias("column_name")
    )


def read_counters(spark: SparkSession, path: str, dataset_pattern: str) -> DataFrame:
    """(dataset, expected) from the first line, ``label:N``, of each file; null where N is no number."""
    cell = split_part(F.col("value"), ",", 1)
    return first_lines(spark, path, dataset_pattern).select(
        "dataset", F.trim(split_part(cell, ":", 2)).try_cast("bigint").alias("expected")
    )
