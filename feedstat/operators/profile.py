"""Column profiles of a table."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedstat.operators.ranks import ROWS_PER_BUCKET, quantiles

# Quartiles of the summary.
QUARTILES = {"q25": 0.25, "q50": 0.5, "q75": 0.75}


def _missing(df: DataFrame, column: str) -> Column:
    value = F.col(column)
    if isinstance(df.schema[column].dataType, (T.DoubleType, T.FloatType)):
        return value.isNull() | F.isnan(value)
    return value.isNull()


def _stack(one_row: DataFrame, columns: Sequence[str], names: Sequence[str]) -> DataFrame:
    """Turn a row of ``<column>|<name>`` aggregates into one row per column."""
    entries = [
        F.struct(F.lit(c).alias("variable"), *[F.col(f"`{c}|{n}`").alias(n) for n in names])
        for c in columns
    ]
    return one_row.select(F.inline(F.array(*entries)))


def shape(df: DataFrame) -> DataFrame:
    """One row: rows and columns."""
    return df.agg(F.count(F.lit(1)).alias("n_rows")).withColumn(
        "n_columns", F.lit(len(df.columns)).cast("bigint")
    )


def distinct_counts(df: DataFrame, columns: Iterable[str] | None = None, approximate: bool = False) -> DataFrame:
    """Distinct non-missing values per column.

    Each column is counted in its own narrow scan and shuffle, with duplicates
    removed before the exchange. ``approximate`` needs one pass and no shuffle of
    values.
    """
    columns = list(columns or df.columns)
    if approximate:
        one_row = df.agg(*[
            F.approx_count_distinct(F.when(~_missing(df, c), F.col(c))).alias(f"{c}|n_distinct")
            for c in columns
        ])
        return _stack(one_row, columns, ["n_distinct"])
    parts = [
        df.where(~_missing(df, c))
        .agg(F.count_distinct(c).alias("n_distinct"))
        .select(F.lit(c).alias("variable"), "n_distinct")
        for c in columns
    ]
    return reduce(DataFrame.unionAll, parts)


def null_counts(df: DataFrame, columns: Iterable[str] | None = None) -> DataFrame:
    """Missing values (null or NaN) per column."""
    columns = list(columns or df.columns)
    one_row = df.agg(*[F.count_if(_missing(df, c)).alias(f"{c}|n_missing") for c in columns])
    return _stack(one_row, columns, ["n_missing"])


def describe(df: DataFrame, columns: Sequence[str], rows_per_bucket: int = ROWS_PER_BUCKET) -> DataFrame:
    """Count, mean, sample deviation, minimum, exact quartiles and maximum per column."""
    order_statistics = quantiles(df, columns, QUARTILES, rows_per_bucket=rows_per_bucket)
    present = {c: F.when(~_missing(df, c), F.col(c).cast("double")) for c in columns}
    moments = df.agg(*[
        expression.alias(f"{c}|{name}")
        for c, value in present.items()
        for name, expression in (
            ("count", F.count(value)), ("mean", F.avg(value)), ("std", F.stddev_samp(value))
        )
    ])
    return (
        _stack(moments, columns, ["count", "mean", "std"])
        .join(order_statistics.drop("total"), "variable", "left")
        .select("variable", "count", "mean", "std", "min", *QUARTILES, "max")
    )


def column_info(df: DataFrame) -> DataFrame:
    """Column name, non-null count and type."""
    columns = df.columns
    one_row = df.agg(*[F.count_if(~_missing(df, c)).alias(f"{c}|n_present") for c in columns])
    types = dict(df.dtypes)
    entries = [
        F.struct(
            F.lit(c).alias("variable"),
            F.col(f"`{c}|n_present`").alias("n_present"),
            F.lit(types[c]).alias("type"),
        )
        for c in columns
    ]
    return one_row.select(F.inline(F.array(*entries)))


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    """The distinct values of one column."""
    return df.select(column).distinct()


def category_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows per (column, value) for several categorical columns at once."""
    text = df.select(*[F.col(c).cast("string").alias(c) for c in columns])
    return (
        text.unpivot([], list(columns), "variable", "value")
        .where(F.col("value").isNotNull())
        .groupBy("variable", "value")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def bar_counts(df: DataFrame, column: str) -> DataFrame:
    """Rows per category: bar heights and labels of a count chart."""
    return df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("n"))
