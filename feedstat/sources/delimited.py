"""Delimited feed files."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

# Layout of the price feed as it arrives.
PRICE_FEED_COLUMNS = {
    "Script name": "string", "Date": "string", "Open": "double", "High": "double",
    "Low": "double", "Close": "double", "Adj Close": "double", "Volume": "double",
}
PRICE_FEED = reduce(lambda layout, c: layout.add(*c), PRICE_FEED_COLUMNS.items(), StructType())


def read_fixed(
    spark: SparkSession,
    path: str | Sequence[str],
    schema: StructType = PRICE_FEED,
    sep: str = "|",
    corrupt_column: str | None = None,
) -> DataFrame:
    """Delimited files with a header and a known layout.

    A cell that does not fit its type becomes null; ``corrupt_column`` also keeps
    the text of such lines.
    """
    options = {"sep": sep, "header": True, "mode": "PERMISSIVE", "recursiveFileLookup": True}
    if corrupt_column:
        schema = StructType(list(schema.fields)).add(corrupt_column, "string")
        options["columnNameOfCorruptRecord"] = corrupt_column
    return spark.read.schema(schema).options(**options).csv(path)


def read_inferred(
    spark: SparkSession, path: str | Sequence[str], sep: str = ",", sampling_ratio: float = 1.0
) -> DataFrame:
    """Delimited files whose column types Spark finds out.

    That costs a pass over ``sampling_ratio`` of the rows; give a layout to
    :func:`read_fixed` where it is known.
    """
    return spark.read.options(
        sep=sep, header=True, inferSchema=True, samplingRatio=sampling_ratio, recursiveFileLookup=True
    ).csv(path)


def read_gzip(
    spark: SparkSession, path: str | Sequence[str], schema: StructType | None = None, sep: str = ","
) -> DataFrame:
    """Gzip-compressed CSV files below ``path``; all columns are text unless a layout is given.

    A gzip file is read by one task: keep single files small and convert them to
    parquet once.
    """
    reader = spark.read.options(
        sep=sep, quote='"', header=True, recursiveFileLookup=True, pathGlobFilter="*.csv.gz"
    )
    return (reader.schema(schema) if schema else reader).csv(path)


def read_plain(spark: SparkSession, path: str | Sequence[str], schema: StructType | None = None) -> DataFrame:
    """Comma-separated files with a header; all columns are text unless a layout is given."""
    reader = spark.read.options(header=True, pathGlobFilter="*.csv")
    return (reader.schema(schema) if schema else reader).csv(path)


def read_batch(
    spark: SparkSession, paths: Sequence[str], schema: StructType, sep: str = ",", **options: str
) -> DataFrame:
    """One scan over the files of a batch, with the path of its file beside every row.

    A file whose header names the columns in another order than ``schema`` stops the job instead of
    being read by position; read such files by their own headers and unite them with
    :func:`union_batches`.
    """
    settings = {"sep": sep, "header": True, "enforceSchema": False, **options}
    files = spark.read.schema(schema).options(**settings).csv(list(paths))
    return files.select("*", F.col("_metadata.file_path").alias("source_path"))


def union_batches(frames: Iterable[DataFrame]) -> DataFrame:
    """Rows of several frames by column name; a column one frame lacks is null there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
