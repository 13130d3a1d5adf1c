"""File listings as tables, and what file names say."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from feedstat.session import materialize

# TICKER_YYYYMM.ext, and the stem before the first dot.
TICKER_PERIOD = r"^([^_]+)_([^_.]+)\."
STEM = r"^([^.]+)"


def list_files(spark: SparkSession, path: str, pattern: str | None = None) -> DataFrame:
    """(path, file_name, modified, length) of the files below ``path``; no content is read."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    return reader.load(path).select(
        "path",
        F.element_at(F.split("path", "/"), -1).alias("file_name"),
        F.col("modificationTime").alias("modified"),
        "length",
    )


def with_suffix(files: DataFrame, suffix: str, column: str = "file_name") -> DataFrame:
    """Files whose name ends in ``suffix``."""
    return files.where(F.col(column).endswith(suffix))


def add_ticker_period(files: DataFrame, column: str = "file_name") -> DataFrame:
    """Add ``ticker`` and ``period`` from names like ``TICKER_YYYYMM.csv.gz``."""
    name = F.element_at(F.split(F.col(column), "/"), -1)
    return files.withColumns({
        "ticker": F.regexp_extract(name, TICKER_PERIOD, 1),
        "period": F.regexp_extract(name, TICKER_PERIOD, 2),
    })


def dataset_name(file_name: Column) -> Column:
    """File name up to the first dot."""
    return F.regexp_extract(F.element_at(F.split(file_name, "/"), -1), STEM, 1)


def _by_age(files: DataFrame) -> DataFrame:
    newest_first = Window.partitionBy("ticker").orderBy(F.desc("modified"), F.desc("path"))
    return files.withColumn("age_rank", F.row_number().over(newest_first))


def newest_files(files: DataFrame) -> DataFrame:
    """The last modified file of every ticker."""
    return _by_age(files).where(F.col("age_rank") == 1).drop("age_rank")


def older_files(files: DataFrame) -> DataFrame:
    """All files but the last modified one of every ticker.

    The newest file of a ticker is found by an aggregation, so a ticker with very
    many files is not sorted in one task.
    """
    newest = files.groupBy("ticker").agg(F.max(F.struct("modified", "path")).alias("newest"))
    newest = materialize(newest.select(F.col("ticker").alias("_ticker"), "newest"), "newest-files")
    return (
        files.join(newest, F.col("ticker").eqNullSafe(F.col("_ticker")))
        .where(~F.struct("modified", "path").eqNullSafe(F.col("newest")))
        .drop("_ticker", "newest")
    )
