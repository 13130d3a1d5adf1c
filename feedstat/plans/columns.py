"""Registered queries on projections, filters and casts."""

from __future__ import annotations

from pyspark.sql import functions as F

from feedstat.functions import casting, dates
from feedstat.plans.standins import (
    ADJ_CLOSE_SQL, BARS_SQL, DAILY_SQL, MEASURES, daily_bars, feed_text, observations, show_bars, table,
)
from feedstat.operators.profile import column_info


def renamed(spark, sf_dir):
    return show_bars(casting.rename_columns(feed_text(daily_bars(spark, sf_dir))))


def _text_prices(spark, sf_dir):
    bars = daily_bars(spark, sf_dir)
    text = {c: F.col(c).cast("string") for c in casting.PRICE_COLUMNS}
    text["Close"] = F.when(F.col("Volume") == 1, F.lit("abc")).otherwise(text["Close"])
    return bars.withColumns(text)


def cast_prices(spark, sf_dir):
    return show_bars(casting.to_double(_text_prices(spark, sf_dir)))


def uncastable(spark, sf_dir):
    return casting.count_uncastable(_text_prices(spark, sf_dir))


def complete_rows(spark, sf_dir):
    gaps = F.when(F.col("Volume") == 2, F.lit(float("nan"))).when(F.col("Volume") != 1, F.col("Close"))
    return show_bars(casting.drop_incomplete(daily_bars(spark, sf_dir).withColumn("Close", gaps)))


def _dated_text(spark, sf_dir, suffix=""):
    text = F.date_format("o_orderdate", "M/d/yyyy")
    bad = F.when(F.col("o_orderstatus") == "P", F.lit("13/45/2020")).otherwise(text)
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", F.concat(bad, F.lit(suffix)).alias("Date")
    )


def _shown(date):
    return F.date_format(date, "yyyy-MM-dd").alias("Date")


def parsed_dates(spark, sf_dir):
    return _dated_text(spark, sf_dir).select("o_orderkey", _shown(dates.parse_date(F.col("Date"))))


def lenient_dates(spark, sf_dir):
    rows = _dated_text(spark, sf_dir, " xyz")
    return rows.select("o_orderkey", _shown(dates.parse_date(F.col("Date"), lenient=True)))


def parsed_timestamps(spark, sf_dir):
    text = F.date_format("ts", "yyyy-MM-dd HH:mm:ss")
    bad = F.when(F.col("event_type") == "error", F.lit("no time")).otherwise(text)
    moment = dates.parse_timestamp(bad)
    return table(spark, sf_dir, "events").select(
        "event_id", F.date_format(moment, "yyyy-MM-dd HH:mm:ss").alias("datetime")
    )


def date_parts(spark, sf_dir):
    rows = table(spark, sf_dir, "orders").select("o_orderkey", F.to_date("o_orderdate").alias("Date"))
    return dates.add_date_parts(rows).select("o_orderkey", "Day", "Year", "Month", "Quarter")


def month_year(spark, sf_dir):
    rows = table(spark, sf_dir, "events").select("event_id", F.col("ts").alias("datetime"))
    return dates.add_month_year(rows).select("event_id", "month", "year")


def _orders(expression, name):
    def query(spark, sf_dir):
        return table(spark, sf_dir, "orders").select("o_orderkey", expression().alias(name))
    return query


def projected(spark, sf_dir):
    return casting.project(daily_bars(spark, sf_dir), {
        "Script_Name": "SCRIPT_NAME", "Day_Open": "open", "Range": F.round(F.col("high") - F.col("low"), 4)
    })


def equal_rows(spark, sf_dir):
    rows = casting.equals(table(spark, sf_dir, "lineitem"), "l_returnflag", "R")
    return rows.select("l_orderkey", "l_linenumber", "l_quantity")


def categorical(spark, sf_dir):
    rows = casting.as_categorical(table(spark, sf_dir, "part"), ["p_size"])
    return rows.select("p_partkey", "p_size")


def grouped_columns(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem")
    text, _ = casting.column_groups(rows)
    kind = F.when(F.col("variable").isin(text), "categorical").otherwise("numeric")
    numbers = rows.select(*[c for group in casting.column_groups(rows) for c in group])
    return column_info(numbers).select("variable", "n_present", kind.alias("kind"))


def without_sparse(spark, sf_dir):
    sizes = casting.as_categorical(table(spark, sf_dir, "part"), ["p_size"])
    return casting.drop_categories(sizes, "p_size", min_count=40).select("p_partkey", "p_size")


def without_named(spark, sf_dir):
    rows = casting.drop_categories(table(spark, sf_dir, "orders"), "o_orderstatus", ["P"])
    return rows.select("o_orderkey", "o_orderstatus")


def split_priority(spark, sf_dir):
    priority = F.col("o_orderpriority")
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        casting.split_part(priority, "-", 1).alias("code"),
        casting.split_part(priority, "-", -1).alias("label"),
        casting.split_part(priority, "|", 2).alias("absent"),
    )


def preview_rows(spark, sf_dir):
    return show_bars(casting.preview(daily_bars(spark, sf_dir), ["Script_name", "Date"]))


QUERIES = {
    "p01_renamed": renamed,
    "p02_cast_prices": cast_prices,
    "p02_uncastable": uncastable,
    "p03_complete_rows": complete_rows,
    "p04_parsed_dates": parsed_dates,
    "p05_parsed_timestamps": parsed_timestamps,
    "p06_lenient_dates": lenient_dates,
    "p07_date_parts": date_parts,
    "p08_month_year": month_year,
    "p09_iso_week": _orders(lambda: dates.iso_week(F.col("o_orderdate")), "week"),
    "p10_year_text": _orders(lambda: dates.year_text(F.col("o_orderdate")), "year"),
    "p11_week_label": _orders(lambda: dates.week_label(F.col("o_orderdate")), "Week_No"),
    "p11_week_label_iso_year": _orders(lambda: dates.week_label(F.col("o_orderdate"), True), "Week_No"),
    "p12_projected": projected,
    "p13_equal_rows": equal_rows,
    "p14_categorical": categorical,
    "p15_column_groups": grouped_columns,
    "p16_natural_log": _orders(lambda: F.round(casting.natural_log(F.col("o_totalprice")), 9), "log_price"),
    "p17_without_named": without_named,
    "p17_without_sparse": without_sparse,
    "p18_split_priority": split_priority,
    "p19_preview": preview_rows,
}

_CLOSE = "strftime(Date, '%Y-%m-%d') AS Date, Open, High, Low, {} AS Close, " \
    + ADJ_CLOSE_SQL + ", Volume"
_DATE = """SELECT o_orderkey, CASE WHEN o_orderstatus <> 'P'
    THEN strftime(o_orderdate, '%Y-%m-%d') END AS Date FROM orders"""
_KINDS = {"l_returnflag": "categorical", "l_linestatus": "categorical"}
_NUMERIC = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", *MEASURES]

ORACLES = {
    "p01_renamed": f"WITH {DAILY_SQL} SELECT {BARS_SQL} FROM daily",
    "p02_cast_prices": f"WITH {DAILY_SQL} SELECT Script_name, "
    + _CLOSE.format("CASE WHEN Volume <> 1 THEN Close END") + " FROM daily",
    "p02_uncastable": f"""WITH {DAILY_SQL} SELECT CAST(0 AS BIGINT) AS Open, CAST(0 AS BIGINT) AS High,
        CAST(0 AS BIGINT) AS Low, CAST(count(*) FILTER (Volume = 1) AS BIGINT) AS Close FROM daily""",
    "p03_complete_rows": f"WITH {DAILY_SQL} SELECT {BARS_SQL} FROM daily WHERE Volume NOT IN (1, 2)",
    "p04_parsed_dates": _DATE,
    "p05_parsed_timestamps": """SELECT event_id, CASE WHEN event_type <> 'error'
        THEN strftime(ts, '%Y-%m-%d %H:%M:%S') END AS datetime FROM events""",
    "p06_lenient_dates": _DATE,
    "p07_date_parts": """SELECT o_orderkey, CAST(day(o_orderdate) AS INTEGER) AS Day,
        CAST(year(o_orderdate) AS INTEGER) AS Year, CAST(month(o_orderdate) AS INTEGER) AS Month,
        CAST(quarter(o_orderdate) AS INTEGER) AS Quarter FROM orders""",
    "p08_month_year": """SELECT event_id, CAST(month(ts) AS INTEGER) AS month,
        CAST(year(ts) AS INTEGER) AS year FROM events""",
    "p09_iso_week": "SELECT o_orderkey, CAST(week(o_orderdate) AS INTEGER) AS week FROM orders",
    "p10_year_text": "SELECT o_orderkey, strftime(o_orderdate, '%Y') AS year FROM orders",
    "p11_week_label": """SELECT o_orderkey, 'Week-' || week(o_orderdate) || '_' ||
        strftime(o_orderdate, '%Y') AS Week_No FROM orders""",
    "p11_week_label_iso_year": """SELECT o_orderkey, 'Week-' || week(o_orderdate) || '_' ||
        isoyear(o_orderdate) AS Week_No FROM orders""",
    "p12_projected": f"""WITH {DAILY_SQL} SELECT Script_name AS Script_Name, Open AS Day_Open,
        round(High - Low, 4) AS Range FROM daily""",
    "p13_equal_rows": """SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem
        WHERE l_returnflag = 'R'""",
    "p14_categorical": "SELECT p_partkey, CAST(p_size AS VARCHAR) AS p_size FROM part",
    "p15_column_groups": " UNION ALL ".join(
        f"""SELECT '{c}' AS variable, CAST(count({c}) AS BIGINT) AS n_present,
        '{_KINDS.get(c, "numeric")}' AS kind FROM lineitem""" for c in [*_NUMERIC, *_KINDS]
    ),
    "p16_natural_log": "SELECT o_orderkey, round(ln(o_totalprice), 9) AS log_price FROM orders",
    "p17_without_named": "SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderstatus <> 'P'",
    "p17_without_sparse": """SELECT p_partkey, CAST(p_size AS VARCHAR) AS p_size FROM part
        QUALIFY count(*) OVER (PARTITION BY p_size) >= 40""",
    "p18_split_priority": """SELECT o_orderkey, split_part(o_orderpriority, '-', 1) AS code,
        split_part(o_orderpriority, '-', -1) AS label, CAST(NULL AS VARCHAR) AS absent FROM orders""",
    "p19_preview": f"""WITH {DAILY_SQL} SELECT {BARS_SQL} FROM daily
        ORDER BY daily.Script_name, daily.Date LIMIT 5""",
}
