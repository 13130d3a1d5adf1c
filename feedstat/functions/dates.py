"""Parsing of feed dates and the calendar columns derived from them."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed value: date pattern of the dated feed.
FEED_DATE_PATTERN = "M/d/yyyy"


def use_legacy_parser(spark: SparkSession) -> None:
    """Switch the whole session to the parser of Spark 2. Default is the strict one."""
    spark.conf.set("spark.sql.legacy.timeParserPolicy", "LEGACY")


def _leading_date(column: Column, pattern: str) -> Column:
    pieces = re.findall(r"[A-Za-z]+|[^A-Za-z]+", pattern)
    expression = "".join(r"\d+" if p.isalpha() else re.escape(p) for p in pieces)
    return F.nullif(F.regexp_substr(column, F.lit("^" + expression)), F.lit(""))


def parse_date(column: Column, pattern: str = FEED_DATE_PATTERN, lenient: bool = False) -> Column:
    """Text to date; text that is no date gives null.

    ``lenient`` also accepts text after the date, as the legacy parser does,
    without changing the session.
    """
    if lenient:
        column = _leading_date(column, pattern)
    return F.try_to_date(column, pattern)


def parse_timestamp(column: Column, pattern: str | None = None) -> Column:
    """Text to timestamp; text that is none gives null."""
    return F.try_to_timestamp(column, F.lit(pattern)) if pattern else F.try_to_timestamp(column)


def add_date_parts(df: DataFrame, date: str = "Date") -> DataFrame:
    """Add Day, Year, Month and Quarter."""
    return df.withColumns({
        "Day": F.dayofmonth(date),
        "Year": F.year(date),
        "Month": F.month(date),
        "Quarter": F.quarter(date),
    })


def add_month_year(df: DataFrame, moment: str = "datetime") -> DataFrame:
    """Add ``month`` and ``year``."""
    return df.withColumns({"month": F.month(moment), "year": F.year(moment)})


def iso_week(date: Column) -> Column:
    """ISO week number, 1 to 53."""
    return F.weekofyear(date)


def year_text(date: Column) -> Column:
    """Calendar year as text."""
    return F.date_format(date, "yyyy")


def week_label(date: Column, iso_year: bool = False) -> Column:
    """``Week-<n>_<yyyy>``.

    The year is the calendar year, so the first and the last days of a year can
    share a label; ``iso_year`` takes the year the ISO week belongs to.
    """
    year = F.extract(F.lit("YEAROFWEEK"), date).cast("string") if iso_year else year_text(date)
    return F.concat_ws("_", F.concat(F.lit("Week-"), iso_week(date)), year)
