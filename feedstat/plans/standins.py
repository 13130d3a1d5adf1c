"""Feed and observation tables derived from the driver's tables."""

from __future__ import annotations

import gzip
import io
import zipfile

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedstat.sources.delimited import PRICE_FEED_COLUMNS

MEASURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
CATEGORIES = ["l_returnflag", "l_linestatus"]
BAR_COLUMNS = ["Script_name", "Date", "Open", "High", "Low", "Close", "Adj_Close", "Volume"]

# The same daily bars, for the SQL check.
DAILY_SQL = """daily AS (
  SELECT o_orderpriority AS Script_name, CAST(o_orderdate AS DATE) AS Date,
         arg_min(o_totalprice, o_orderkey) AS Open, max(o_totalprice) AS High,
         min(o_totalprice) AS Low, arg_max(o_totalprice, o_orderkey) AS Close,
         avg(o_totalprice) AS Adj_Close, CAST(count(*) AS DOUBLE) AS Volume
  FROM orders GROUP BY 1, 2)"""
ADJ_CLOSE_SQL = "round(Adj_Close + 1e-9, 6) AS Adj_Close"
BARS_SQL = f"""Script_name, strftime(Date, '%Y-%m-%d') AS Date, Open, High, Low, Close,
  {ADJ_CLOSE_SQL}, Volume"""
TICKER_SQL = "regexp_replace(Script_name, '[^A-Za-z0-9]+', '-', 'g')"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def daily_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One price bar per order priority and day."""
    orders = table(spark, sf_dir, "orders")
    return orders.groupBy(
        F.col("o_orderpriority").alias("Script_name"), F.to_date("o_orderdate").alias("Date")
    ).agg(
        F.min_by("o_totalprice", "o_orderkey").alias("Open"),
        F.max("o_totalprice").alias("High"),
        F.min("o_totalprice").alias("Low"),
        F.max_by("o_totalprice", "o_orderkey").alias("Close"),
        F.avg("o_totalprice").alias("Adj_Close"),
        F.count(F.lit(1)).cast("double").alias("Volume"),
    )


def rounded_mean(name: str) -> F.Column:
    """Round a mean for printing; exact halves, which engines round differently, are moved up."""
    return F.round(F.col(name) + 1e-9, 6).alias(name)


def show_bars(bars: DataFrame) -> DataFrame:
    """Bars in the form both engines print alike."""
    return bars.select(
        "Script_name", F.date_format("Date", "yyyy-MM-dd").alias("Date"),
        "Open", "High", "Low", "Close", rounded_mean("Adj_Close"), "Volume",
    )


def feed_text(bars: DataFrame) -> DataFrame:
    """Bars under the column names of the raw feed."""
    return bars.select(*BAR_COLUMNS).withColumnsRenamed(
        {"Script_name": "Script name", "Adj_Close": "Adj Close"}
    )


def ticker() -> F.Column:
    """The priority in a form that file names can hold."""
    return F.regexp_replace("Script_name", "[^A-Za-z0-9]+", "-")


def with_period(bars: DataFrame, pattern: str = "yyyyMM") -> DataFrame:
    """Add ``ticker`` and ``period``, the year and month unless another pattern is given."""
    return bars.withColumns({"ticker": ticker(), "period": F.date_format("Date", pattern)})


def observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Measurements with two categories."""
    return table(spark, sf_dir, "lineitem").select(*MEASURES, *CATEGORIES)


def orders_by_weekend(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order prices with a 0/1 weekend flag."""
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_totalprice",
        F.when(F.weekday("o_orderdate") >= 5, 1).otherwise(0).alias("weekend"),
    )


def _zip_year(rows: pd.DataFrame) -> pd.DataFrame:
    packed = io.BytesIO()
    with zipfile.ZipFile(packed, "w") as archive:
        for period, part in rows.sort_values("Date").groupby("period"):
            name = f"{part['ticker'].iloc[0]}_{period}.csv.gz"
            lines = ",".join(PRICE_FEED_COLUMNS) + "\n" + "\n".join(part["line"]) + "\n"
            archive.writestr(name, gzip.compress(lines.encode(), mtime=0))
    return pd.DataFrame({
        "path": [f"{rows['ticker'].iloc[0]}-{rows['year'].iloc[0]}.zip"], "content": [packed.getvalue()]
    })


def feed_archives(spark: SparkSession, sf_dir: str, short_lines: bool = False) -> DataFrame:
    """(path, content) of one zip per ticker and year with a gzip CSV per month.

    With ``short_lines`` the lines of days with one order end before their last two cells.

    A group holds one bar per day, so at most 366 rows whatever the size of orders.
    """
    cells = [F.col(c).cast("string") for c in BAR_COLUMNS]
    line = F.concat_ws(",", *cells)
    if short_lines:
        line = F.when(F.col("Volume") == 1, F.concat_ws(",", *cells[:-2])).otherwise(line)
    rows = with_period(daily_bars(spark, sf_dir)).select(
        "ticker", "period", "Date", F.date_format("Date", "yyyy").alias("year"), line.alias("line"),
    )
    return rows.groupBy("ticker", "year").applyInPandas(_zip_year, "path string, content binary")
