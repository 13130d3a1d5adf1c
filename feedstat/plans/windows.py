"""Registered queries on weekly bars and the windows behind them."""

from __future__ import annotations

from pyspark.sql import functions as F

from feedstat.operators.bars import (
    add_week_columns, first_rows, label_weeks, number_rows, weekly_bars,
)
from feedstat.plans.standins import ADJ_CLOSE_SQL, DAILY_SQL, daily_bars, rounded_mean, table

WEEK_LABEL_SQL = "'Week-' || week(Date) || '_' || strftime(Date, '%Y')"
WEEKLY_SQL = f"""weekly AS (
  SELECT Script_name AS Script_Name, {WEEK_LABEL_SQL} AS Week_No,
         min(Date) AS St_Date, max(Date) AS End_Date, arg_min(Open, Date) AS Open,
         min(Low) AS Low, max(High) AS High, arg_max(Close, Date) AS Close,
         avg(Adj_Close) AS Adj_Close, sum(Volume) AS Volume
  FROM daily GROUP BY 1, 2)"""
SHOW_WEEK_SQL = f"""Script_Name, Week_No, strftime(St_Date, '%Y-%m-%d') AS St_Date,
  strftime(End_Date, '%Y-%m-%d') AS End_Date, Open, Low, High, Close,
  {ADJ_CLOSE_SQL}, Volume"""


def show_week(weeks):
    return weeks.select(
        "Script_Name", "Week_No",
        F.date_format("St_Date", "yyyy-MM-dd").alias("St_Date"),
        F.date_format("End_Date", "yyyy-MM-dd").alias("End_Date"),
        "Open", "Low", "High", "Close", rounded_mean("Adj_Close"), "Volume",
    )


def weekly(spark, sf_dir):
    return show_week(weekly_bars(daily_bars(spark, sf_dir)))


def weekly_iso(spark, sf_dir):
    return show_week(weekly_bars(daily_bars(spark, sf_dir), iso_year=True))


def _order_bars(spark, sf_dir):
    """Every order as a bar of its own: many bars on one date."""
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderpriority").alias("Script_name"), F.to_date("o_orderdate").alias("Date"),
        *[F.col("o_totalprice").alias(c) for c in ("Open", "High", "Low", "Close", "Adj_Close")],
        F.lit(1.0).alias("Volume"), "o_orderkey",
    )


def weekly_with_ties(spark, sf_dir):
    return show_week(weekly_bars(_order_bars(spark, sf_dir), tie="o_orderkey"))


def _window_query(*columns):
    def query(spark, sf_dir):
        rows = add_week_columns(label_weeks(daily_bars(spark, sf_dir)))
        shown = [
            F.date_format(c, "yyyy-MM-dd").alias(c) if c in ("St_Date", "End_Date")
            else rounded_mean(c) if c == "Week_Adj_Close"
            else F.col(c)
            for c in columns
        ]
        return rows.select(
            "Script_name", "Week_No", F.date_format("Date", "yyyy-MM-dd").alias("Date"), *shown
        )
    return query


def tied_windows(spark, sf_dir):
    rows = add_week_columns(label_weeks(_order_bars(spark, sf_dir)), tie="o_orderkey")
    return rows.select(
        "o_orderkey", "Script_name", "Week_No", "row", "Week_Open", "Week_Close", "Week_Low", "Week_High",
        rounded_mean("Week_Adj_Close"), "Week_Volume",
        *[F.date_format(c, "yyyy-MM-dd").alias(c) for c in ("St_Date", "End_Date")],
    )


def tied_row_numbers(spark, sf_dir):
    rows = label_weeks(_order_bars(spark, sf_dir))
    numbered = number_rows(rows, ("Script_name", "Week_No"), "o_orderkey", rows_per_bucket=2_000)
    return numbered.select("o_orderkey", "row")


def first_of_week(spark, sf_dir):
    rows = first_rows(label_weeks(daily_bars(spark, sf_dir)))
    return rows.select(
        "Script_name", "Week_No", F.date_format("Date", "yyyy-MM-dd").alias("Date"), "Open", "Close"
    )


QUERIES = {
    "a18_weekly_bars": weekly,
    "a18_weekly_bars_iso_year": weekly_iso,
    "a18_weekly_bars_tied_dates": weekly_with_ties,
    "w01_row_number": _window_query("row"),
    "w02_window_min": _window_query("St_Date", "Week_Low"),
    "w03_window_max": _window_query("End_Date", "Week_High"),
    "w04_window_first": _window_query("Week_Open"),
    "w05_window_last": _window_query("Week_Close"),
    "w06_window_mean": _window_query("Week_Adj_Close"),
    "w07_window_sum": _window_query("Week_Volume"),
    "w08_first_row": first_of_week,
    "w01_row_number_tied_dates": tied_row_numbers,
    "w07_week_columns_tied_dates": tied_windows,
}

_ROWS = f"WITH {DAILY_SQL}, labelled AS (SELECT *, {WEEK_LABEL_SQL} AS Week_No FROM daily)"
_KEYS = "Script_name, Week_No, strftime(Date, '%Y-%m-%d') AS Date"
_PART = "PARTITION BY Script_name, Week_No"
_FULL = f"({_PART} ORDER BY Date ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)"


def _window_sql(*items):
    return f"{_ROWS} SELECT {_KEYS}, {', '.join(items)} FROM labelled"


ORACLES = {
    "a18_weekly_bars": f"WITH {DAILY_SQL}, {WEEKLY_SQL} SELECT {SHOW_WEEK_SQL} FROM weekly",
    "a18_weekly_bars_iso_year": "WITH "
    + DAILY_SQL
    + ", "
    + WEEKLY_SQL.replace("strftime(Date, '%Y')", "isoyear(Date)")
    + f" SELECT {SHOW_WEEK_SQL} FROM weekly",
    "a18_weekly_bars_tied_dates": """WITH weekly AS (
        SELECT o_orderpriority AS Script_Name,
               'Week-' || week(o_orderdate) || '_' || strftime(o_orderdate, '%Y') AS Week_No,
               min(o_orderdate) AS St_Date, max(o_orderdate) AS End_Date,
               arg_min(o_totalprice, (o_orderdate, o_orderkey)) AS Open, min(o_totalprice) AS Low,
               max(o_totalprice) AS High, arg_max(o_totalprice, (o_orderdate, o_orderkey)) AS Close,
               avg(o_totalprice) AS Adj_Close, CAST(count(*) AS DOUBLE) AS Volume
        FROM orders GROUP BY 1, 2) SELECT """ + SHOW_WEEK_SQL + " FROM weekly",
    "w01_row_number": _window_sql(
        f"CAST(row_number() OVER ({_PART} ORDER BY Date) AS INTEGER) AS row"
    ).replace("AS row", 'AS "row"'),
    "w02_window_min": _window_sql(
        f"strftime(min(Date) OVER ({_PART}), '%Y-%m-%d') AS St_Date",
        f"min(Low) OVER ({_PART}) AS Week_Low",
    ),
    "w03_window_max": _window_sql(
        f"strftime(max(Date) OVER ({_PART}), '%Y-%m-%d') AS End_Date",
        f"max(High) OVER ({_PART}) AS Week_High",
    ),
    "w04_window_first": _window_sql(f"first_value(Open) OVER {_FULL} AS Week_Open"),
    "w05_window_last": _window_sql(f"last_value(Close) OVER {_FULL} AS Week_Close"),
    "w06_window_mean": _window_sql(f"round(avg(Adj_Close) OVER ({_PART}) + 1e-9, 6) AS Week_Adj_Close"),
    "w07_window_sum": _window_sql(f"sum(Volume) OVER ({_PART}) AS Week_Volume"),
    "w01_row_number_tied_dates": """SELECT o_orderkey, CAST(row_number() OVER (
        PARTITION BY o_orderpriority, week(o_orderdate), year(o_orderdate)
        ORDER BY o_orderdate, o_orderkey) AS INTEGER) AS "row" FROM orders""",
    "w07_week_columns_tied_dates": """WITH o AS (SELECT *,
        'Week-' || week(o_orderdate) || '_' || strftime(o_orderdate, '%Y') AS Week_No FROM orders)
        SELECT o_orderkey, o_orderpriority AS Script_name, Week_No,
        CAST(row_number() OVER w AS INTEGER) AS "row",
        first_value(o_totalprice) OVER f AS Week_Open, last_value(o_totalprice) OVER f AS Week_Close,
        min(o_totalprice) OVER p AS Week_Low, max(o_totalprice) OVER p AS Week_High,
        round(avg(o_totalprice) OVER p + 1e-9, 6) AS Week_Adj_Close,
        CAST(count(*) OVER p AS DOUBLE) AS Week_Volume,
        strftime(min(o_orderdate) OVER p, '%Y-%m-%d') AS St_Date,
        strftime(max(o_orderdate) OVER p, '%Y-%m-%d') AS End_Date FROM o
        WINDOW p AS (PARTITION BY o_orderpriority, Week_No),
        w AS (PARTITION BY o_orderpriority, Week_No ORDER BY o_orderdate, o_orderkey),
        f AS (PARTITION BY o_orderpriority, Week_No ORDER BY o_orderdate, o_orderkey
              ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)""",
    "w08_first_row": f"""{_ROWS} SELECT {_KEYS}, Open, Close FROM labelled
        QUALIFY row_number() OVER ({_PART} ORDER BY labelled.Date) = 1""",
}
