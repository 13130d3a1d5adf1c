"""Writers of typed feeds."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame


def together(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Bring the rows of a partition folder together before a partitioned write.

    Without it every task opens a file in every folder. The rebalance hint lets AQE
    split a folder that outgrows ``spark.sql.adaptive.advisoryPartitionSizeInBytes``
    over several tasks, so a hot ticker does not end in one of them.
    """
    return df.hint("rebalance", *keys)


def write_partitioned(
    df: DataFrame,
    path: str,
    keys: Sequence[str] = ("Script_name",),
    replace_all: bool = True,
) -> str:
    """Parquet in one folder per key value.

    ``replace_all=False`` replaces only the folders that get rows, so writing one
    ticker keeps the others.
    """
    mode = "static" if replace_all else "dynamic"
    writer = together(df, keys).write.partitionBy(*keys).mode("overwrite")
    writer.option("partitionOverwriteMode", mode).parquet(path)
    return path


def write_flat(df: DataFrame, path: str) -> str:
    """Parquet without partition folders, replacing what is there."""
    df.write.mode("overwrite").parquet(path)
    return path


def write_delimited(df: DataFrame, path: str, delimiter: str = ",", mode: str = "errorifexists") -> str:
    """Delimited text with a header; fails if the path exists. Returns the path."""
    df.write.mode(mode).options(header=True, sep=delimiter).csv(path)
    return path


def write_pipe(df: DataFrame, path: str) -> str:
    """Pipe-delimited text, the form the price feed is read from."""
    return write_delimited(df, path, "|")


def write_by_period(
    df: DataFrame, path: str, ticker: str = "ticker", period: str = "period"
) -> str:
    """CSV in one folder per ticker and month, for all files of a batch at once."""
    rows = together(df, [ticker, period])
    rows.write.partitionBy(ticker, period).mode("overwrite").options(header=True).csv(path)
    return path


def write_summary(df: DataFrame, path: str) -> str:
    """Weekly summary as CSV, written by the executors."""
    return write_delimited(df, path, ",", "overwrite")
