"""Weekly price bars."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from feedstat.functions.dates import week_label
from feedstat.operators.ranks import ROWS_PER_BUCKET, cut
from feedstat.session import materialize

# Columns of a weekly bar, in output order.
WEEKLY_BAR = (
    "Script_Name", "Week_No", "St_Date", "End_Date",
    "Open", "Low", "High", "Close", "Adj_Close", "Volume",
)


def label_weeks(df: DataFrame, date: str = "Date", iso_year: bool = False) -> DataFrame:
    """Add ``Week_No``."""
    return df.withColumn("Week_No", week_label(F.col(date), iso_year))


def _order_key(date: str, tie: str | None) -> Column:
    return F.struct(date, tie) if tie else F.col(date)


def weekly_bars(df: DataFrame, tie: str | None = None, iso_year: bool = False) -> DataFrame:
    """One row per ticker and week label from one partial/final aggregation.

    Open and Close are those of the earliest and latest ``Date``. Name a ``tie``
    column only where a ticker can have several rows on one date: a plain date
    key keeps the aggregation hash-based, a pair key sorts.
    """
    key = _order_key("Date", tie)
    bars = (
        label_weeks(df, iso_year=iso_year)
        .groupBy("Script_name", "Week_No")
        .agg(
            F.min("Date").alias("St_Date"),
            F.max("Date").alias("End_Date"),
            F.min_by("Open", key).alias("Open"),
            F.min("Low").alias("Low"),
            F.max("High").alias("High"),
            F.max_by("Close", key).alias("Close"),
            F.avg("Adj_Close").alias("Adj_Close"),
            F.sum("Volume").alias("Volume"),
        )
    )
    return bars.select(*WEEKLY_BAR)


def _attach(rows: DataFrame, extra: DataFrame, keys: list[str]) -> DataFrame:
    """Add the columns of ``extra`` by equal keys; null keys are equal too, so no row is lost."""
    renamed = extra.withColumnsRenamed({k: f"_{k}" for k in keys})
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys])
    return rows.join(renamed, same).drop(*[f"_{k}" for k in keys])


def add_week_columns(
    df: DataFrame,
    keys: tuple[str, ...] = ("Script_name", "Week_No"),
    tie: str | None = None,
    rows_per_bucket: int = ROWS_PER_BUCKET,
) -> DataFrame:
    """The week's values beside every row, for use where the daily rows must stay.

    Without a ``tie`` column a ticker has one row per date, so a group ends with the
    week and windows serve all columns with one exchange. With one, groups have no
    bound: the values come from an aggregation joined back, and row numbers from
    :func:`number_rows`. Use :func:`weekly_bars` where one row per week is enough.
    """
    if tie:
        numbered = number_rows(df, keys, tie, rows_per_bucket)
        weeks = df.groupBy(*keys).agg(
            F.min("Date").alias("St_Date"),
            F.max("Date").alias("End_Date"),
            F.min_by("Open", _order_key("Date", tie)).alias("Week_Open"),
            F.max_by("Close", _order_key("Date", tie)).alias("Week_Close"),
            F.min("Low").alias("Week_Low"),
            F.max("High").alias("Week_High"),
            F.avg("Adj_Close").alias("Week_Adj_Close"),
            F.sum("Volume").alias("Week_Volume"),
        )
        joined = _attach(numbered, materialize(weeks, "weeks"), list(keys))
        return joined.select(*df.columns, "row", *[c for c in weeks.columns if c not in keys])
    whole = Window.partitionBy(*keys)
    ordered = whole.orderBy("Date")
    full = ordered.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    return df.select(
        "*",
        F.row_number().over(ordered).alias("row"),
        F.min("Date").over(whole).alias("St_Date"),
        F.max("Date").over(whole).alias("End_Date"),
        F.first("Open").over(full).alias("Week_Open"),
        F.last("Close").over(full).alias("Week_Close"),
        F.min("Low").over(whole).alias("Week_Low"),
        F.max("High").over(whole).alias("Week_High"),
        F.avg("Adj_Close").over(whole).alias("Week_Adj_Close"),
        F.sum("Volume").over(whole).alias("Week_Volume"),
    )


def number_rows(
    df: DataFrame,
    keys: tuple[str, ...],
    tie: str,
    rows_per_bucket: int = ROWS_PER_BUCKET,
) -> DataFrame:
    """Row numbers in (Date, tie) order within groups of any size; ``tie`` is a number.

    A group is cut by date and by ranges of the tie column. Rows are numbered inside
    a piece, after the rows of all earlier pieces, so no task sorts a whole group.
    """
    rows = df.withColumn("value", F.col(tie).cast("double"))
    pieces = cut(rows, df.count(), rows_per_bucket)
    piece = [*keys, "Date", "bucket"]
    previous = Window.partitionBy(*keys).orderBy("Date", "bucket").rowsBetween(
        Window.unboundedPreceding, -1
    )
    sizes = materialize(
        pieces.groupBy(*piece)
        .agg(F.count(F.lit(1)).alias("size"))
        .withColumn("earlier", F.coalesce(F.sum("size").over(previous), F.lit(0))),
        "piece-sizes",
    )
    inside = F.row_number().over(Window.partitionBy(*piece).orderBy("value", tie))
    placed = _attach(pieces, sizes.drop("size"), piece)
    numbered = placed.withColumn("row", F.col("earlier") + inside)
    return numbered.select(*df.columns, F.col("row").cast("int").alias("row"))


def first_rows(
    df: DataFrame, keys: tuple[str, ...] = ("Script_name", "Week_No"), tie: str | None = None
) -> DataFrame:
    """The earliest row of every key."""
    order = ["Date", tie] if tie else ["Date"]
    numbered = df.withColumn("row", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return numbered.where(F.col("row") == 1).drop("row")
