"""Registered queries on sinks: each writes, reads back and returns what was written."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from feedstat.functions.casting import rename_columns, to_double
from feedstat.operators.bars import weekly_bars
from feedstat.plans.scans import NUMBERS, PERIOD_SQL
from feedstat.plans.standins import (
    ADJ_CLOSE_SQL, BARS_SQL, DAILY_SQL, TICKER_SQL, daily_bars, feed_text, show_bars, ticker, with_period,
)
from feedstat.plans.windows import SHOW_WEEK_SQL, WEEKLY_SQL, show_week
from feedstat.session import materialize, scratch_path
from feedstat.sinks import files, tables, zones
from feedstat.sources import delimited

_LAYOUT = "Script_name string, Date date, Open double, High double, Low double, Close double, " \
    "Adj_Close double, Volume double"


def partitioned(spark, sf_dir):
    path = files.write_partitioned(daily_bars(spark, sf_dir), scratch_path(spark, "partitioned"))
    return show_bars(spark.read.schema(_LAYOUT).parquet(path))


def partitioned_keep_others(spark, sf_dir):
    bars = materialize(daily_bars(spark, sf_dir), "bars")
    path = files.write_partitioned(bars, scratch_path(spark, "partitioned"))
    corrected = bars.where(F.col("Script_name") == "5-LOW").withColumn("Volume", F.col("Volume") + 1)
    files.write_partitioned(corrected, path, replace_all=False)
    return show_bars(spark.read.schema(_LAYOUT).parquet(path))


def flat(spark, sf_dir):
    path = files.write_flat(daily_bars(spark, sf_dir), scratch_path(spark, "flat"))
    return show_bars(spark.read.schema(_LAYOUT).parquet(path))


def delimited_text(spark, sf_dir):
    path = files.write_delimited(daily_bars(spark, sf_dir), scratch_path(spark, "text"), ";")
    return show_bars(spark.read.schema(
        "Script_name string, Date date, Open double, High double, Low double, Close double, "
        "Adj_Close double, Volume double"
    ).options(header=True, sep=";").csv(path))


def by_period(spark, sf_dir):
    path = files.write_by_period(with_period(daily_bars(spark, sf_dir)), scratch_path(spark, "period"))
    rows = spark.read.schema(_LAYOUT + ", ticker string, period string").options(header=True).csv(path)
    return rows.groupBy("ticker", "period").agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum("Volume").alias("volume")
    )


def pipe_text(spark, sf_dir):
    path = files.write_pipe(feed_text(daily_bars(spark, sf_dir)), scratch_path(spark, "pipe"))
    return show_bars(rename_columns(delimited.read_fixed(spark, path)))


def summary_text(spark, sf_dir):
    weeks = weekly_bars(daily_bars(spark, sf_dir))
    path = files.write_summary(weeks, scratch_path(spark, "summary"))
    read = to_double(
        spark.read.options(header=True).csv(path), ["Open", "Low", "High", "Close", "Adj_Close", "Volume"]
    )
    return show_week(read)


def registered(spark, sf_dir):
    bars = materialize(daily_bars(spark, sf_dir), "bars")
    name = f"bars_{uuid.uuid4().hex}"
    layout = {"schema": bars.schema, "partitioned_by": ["Script_name"]}
    early = files.write_partitioned(bars.where(F.year("Date") < 1998), scratch_path(spark, "table"))
    tables.register_table(spark, name, early, **layout)
    every = files.write_partitioned(bars, scratch_path(spark, "table"))
    return show_bars(tables.register_table(spark, name, every, **layout))


def current_snapshot(spark, sf_dir):
    path = scratch_path(spark, "snapshots")
    rows = with_period(daily_bars(spark, sf_dir), "yyyy")
    files.write_partitioned(rows, path, ["ticker", "period"])
    name = f"snapshots_{uuid.uuid4().hex}"
    tables.register_table(spark, name, path, schema=rows.schema, partitioned_by=["ticker", "period"])
    current = tables.register_current(spark, f"{name}_current", name)
    return show_bars(current)


def _delivered(spark, sf_dir):
    """Bars per ticker and year, the years to 1995 delivered again after the rest."""
    path = scratch_path(spark, "delivered")
    rows = materialize(with_period(daily_bars(spark, sf_dir), "yyyy"), "deliveries")
    files.write_partitioned(rows, path, ["ticker", "period"])
    files.write_partitioned(rows.where("period <= '1995'"), path, ["ticker", "period"], replace_all=False)
    # the last of them goes once more, alone, so that no two have the same time
    last = rows.where("period = '1995'")
    files.write_partitioned(last, path, ["ticker", "period"], replace_all=False)
    return path, rows


def ticker_tables(spark, sf_dir):
    """One table per ticker over the folder that was delivered last, all of them united by name."""
    path, _ = _delivered(spark, sf_dir)
    newest = tables.newest_periods(tables.file_manifest(spark, path))
    names = tables.register_ticker_tables(spark, newest, f"bars_{uuid.uuid4().hex}", path, "parquet")
    return show_bars(delimited.union_batches([spark.table(name) for name in names]))


def redelivered(spark, sf_dir):
    path, rows = _delivered(spark, sf_dir)
    stored = spark.read.schema(rows.schema).parquet(path)
    current, archive = scratch_path(spark, "current"), scratch_path(spark, "archive")
    table = zones.rotate(
        spark, f"redelivered_{uuid.uuid4().hex}", stored, current, archive, manifest=tables.file_manifest(spark, path)
    )
    return _zones_of(spark, table, archive, rows.schema)


def promoted(spark, sf_dir):
    source = scratch_path(spark, "zone")
    bars = daily_bars(spark, sf_dir).withColumn("dataset", ticker())
    bars.write.partitionBy("dataset").options(header=True).csv(source)
    return zones.promote(spark, source, scratch_path(spark, "zone"), dataset_pattern="dataset=([^/]+)")


def _zones_of(spark, table, archive, schema):
    archived = spark.read.schema(schema).parquet(archive)
    both = table.select("ticker", "period", F.lit("current").alias("zone")).unionAll(
        archived.select("ticker", "period", F.lit("archive").alias("zone"))
    )
    return both.groupBy("ticker", "period", "zone").agg(F.count(F.lit(1)).alias("n_rows"))


def rotated(spark, sf_dir):
    rows = materialize(with_period(daily_bars(spark, sf_dir), "yyyy"), "snapshots")
    current, archive = scratch_path(spark, "current"), scratch_path(spark, "archive")
    table = zones.rotate(spark, f"rotated_{uuid.uuid4().hex}", rows, current, archive)
    return _zones_of(spark, table, archive, rows.schema)


QUERIES = {
    "k01_partitioned_write": partitioned,
    "k01_partitioned_write_keeps_others": partitioned_keep_others,
    "k02_flat_write": flat,
    "k03_delimited_write": delimited_text,
    "k04_period_write": by_period,
    "k05_pipe_write": pipe_text,
    "k06_summary_write": summary_text,
    "k07_registered_table": registered,
    "k08_current_snapshot": current_snapshot,
    "k08_ticker_tables": ticker_tables,
    "k09_promoted_zone": promoted,
    "l02_redelivered_periods": redelivered,
    "l02_rotated_snapshots": rotated,
}

_BARS = f"WITH {DAILY_SQL} SELECT {BARS_SQL} FROM daily"

ORACLES = {
    "k01_partitioned_write": _BARS,
    "k01_partitioned_write_keeps_others": f"""WITH {DAILY_SQL} SELECT Script_name,
        strftime(Date, '%Y-%m-%d') AS Date, Open, High, Low, Close,
        {ADJ_CLOSE_SQL},
        CASE WHEN Script_name = '5-LOW' THEN Volume + 1 ELSE Volume END AS Volume FROM daily""",
    "k02_flat_write": _BARS,
    "k03_delimited_write": _BARS,
    "k04_period_write": f"""WITH {DAILY_SQL} SELECT {TICKER_SQL} AS ticker, {PERIOD_SQL} AS period,
        CAST(count(*) AS BIGINT) AS n_rows, sum(Volume) AS volume FROM daily GROUP BY 1, 2""",
    "k05_pipe_write": _BARS,
    "k06_summary_write": f"WITH {DAILY_SQL}, {WEEKLY_SQL} SELECT {SHOW_WEEK_SQL} FROM weekly",
    "k07_registered_table": _BARS,
    "k08_current_snapshot": f"""WITH {DAILY_SQL} SELECT {BARS_SQL} FROM (
        SELECT *, max(year(Date)) OVER (PARTITION BY Script_name) AS newest FROM daily) b
        WHERE year(b.Date) = newest""",
    "k08_ticker_tables": f"""WITH {DAILY_SQL} SELECT {BARS_SQL} FROM daily WHERE year(Date) = 1995""",
    "l02_redelivered_periods": f"""WITH {DAILY_SQL} SELECT {TICKER_SQL} AS ticker, strftime(Date, '%Y') AS period,
        CASE WHEN strftime(Date, '%Y') = '1995' THEN 'current' ELSE 'archive' END AS zone,
        CAST(count(*) AS BIGINT) AS n_rows FROM daily GROUP BY ALL""",
    "k09_promoted_zone": f"""WITH {DAILY_SQL} SELECT {TICKER_SQL} AS dataset,
        CAST(count(*) AS BIGINT) AS n_rows FROM daily GROUP BY 1""",
    "l02_rotated_snapshots": f"""WITH {DAILY_SQL}, periods AS (
        SELECT {TICKER_SQL} AS ticker, strftime(Date, '%Y') AS period,
        CAST(count(*) AS BIGINT) AS n_rows FROM daily GROUP BY 1, 2)
        SELECT ticker, period, CASE WHEN period = max(period) OVER (PARTITION BY ticker)
        THEN 'current' ELSE 'archive' END AS zone, n_rows FROM periods""",
}
