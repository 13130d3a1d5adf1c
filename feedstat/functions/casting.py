"""Column renaming, typing and filtering of feed and observation tables."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedstat.session import materialize
from pyspark.sql import types as T

# Column names of the feeds and the names they are stored under.
FEED_NAMES = {
    "Script name": "Script_name",
    "Scrip name": "Script_name",
    "Adj Close": "Adj_Close",
}
# Price columns that arrive as text.
PRICE_COLUMNS = ("Open", "High", "Low", "Close")


def rename_columns(df: DataFrame, names: Mapping[str, str] = FEED_NAMES) -> DataFrame:
    """Rename in one step; names the table does not have are ignored."""
    return df.withColumnsRenamed(dict(names))


def to_double(df: DataFrame, columns: Iterable[str] = PRICE_COLUMNS) -> DataFrame:
    """Cast to double; text that is no number becomes null instead of failing the job."""
    return df.withColumns({c: F.col(c).try_cast("double") for c in columns})


def count_uncastable(df: DataFrame, columns: Iterable[str] = PRICE_COLUMNS) -> DataFrame:
    """One row: per column, how many texts :func:`to_double` turns into null."""
    return df.agg(*[
        F.count_if(F.col(c).isNotNull() & F.col(c).try_cast("double").isNull()).alias(c)
        for c in columns
    ])


def drop_incomplete(df: DataFrame) -> DataFrame:
    """Keep only rows without any null or NaN."""
    return df.dropna(how="any")


def as_categorical(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Store coded columns as text, so that no later step takes them for measurements."""
    return df.withColumns({c: F.col(c).cast("string") for c in columns})


def column_groups(df: DataFrame) -> tuple[list[str], list[str]]:
    """(categorical, numeric) column names, by type."""
    text = [f.name for f in df.schema.fields if isinstance(f.dataType, (T.StringType, T.BooleanType))]
    numbers = [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]
    return text, numbers


def natural_log(column: Column) -> Column:
    """ln with floating-point edge values: -inf at 0 and NaN below, null only for null."""
    value = column.cast("double")
    return (
        F.when(value == 0, F.lit(float("-inf")))
        .when(value < 0, F.lit(float("nan")))
        .otherwise(F.ln(value))
    )


def equals(df: DataFrame, column: str, value) -> DataFrame:
    """Rows whose ``column`` is ``value``."""
    return df.where(F.col(column) == F.lit(value))


def drop_categories(
    df: DataFrame, column: str, values: Iterable | None = None, min_count: int | None = None
) -> DataFrame:
    """Leave categories out, named ones or those with fewer than ``min_count`` rows.

    Rows without a category are left out as well.
    """
    kept = df
    if values is not None:
        kept = kept.where(~F.col(column).isin(list(values)))
    if min_count is not None:
        sizes = kept.groupBy(column).agg(F.count(F.lit(1)).alias("_size"))
        # written, so its size is known and a large table is not shuffled for a few categories
        common = materialize(sizes.where(F.col("_size") >= min_count).select(column), "common-categories")
        kept = kept.join(common, column, "left_semi")
    return kept


def split_part(column: Column, separator: str, position: int) -> Column:
    """Part of a separated text, counted from 1, or from the end when negative.

    The separator is plain text. A part that does not exist gives null.
    """
    parts = F.split(column, "\\Q" + separator + "\\E")
    return F.try_element_at(parts, F.lit(position))


def project(df: DataFrame, columns: Mapping[str, str | Column]) -> DataFrame:
    """Select ``{output name: source}``; names resolve without regard to case."""
    return df.select(*[
        (source if isinstance(source, Column) else F.col(source)).alias(name)
        for name, source in columns.items()
    ])


def preview(df: DataFrame, keys: Iterable[str], rows: int = 5) -> DataFrame:
    """First rows in key order."""
    return df.orderBy(*keys).limit(rows)
