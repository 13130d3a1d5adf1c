"""Registered queries on newest files, older files and samples."""

from __future__ import annotations

from pyspark.sql import functions as F

from feedstat.operators.sampling import sample_per_group
from feedstat.plans.standins import DAILY_SQL, TICKER_SQL, daily_bars, table, with_period
from feedstat.sources.listing import newest_files, older_files


def _listing(spark, sf_dir):
    """A file listing: one file per ticker and month, modified on the month's last day."""
    rows = with_period(daily_bars(spark, sf_dir))
    return rows.groupBy("ticker", "period").agg(F.max("Date").alias("modified")).withColumn(
        "path", F.concat_ws("/", "ticker", "period")
    )


def newest(spark, sf_dir):
    return newest_files(_listing(spark, sf_dir)).select("ticker", "path")


def older(spark, sf_dir):
    return older_files(_listing(spark, sf_dir)).select("ticker", "path")


def sampled(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority", "o_totalprice")
    return sample_per_group(orders, "o_orderpriority", ["o_orderkey"], n=100, seed=7)


QUERIES = {"l01_newest_files": newest, "l02_older_files": older, "l03_sample_per_group": sampled}

_FILES = f"""WITH {DAILY_SQL}, files AS (
    SELECT {TICKER_SQL} AS ticker, {TICKER_SQL} || '/' || strftime(Date, '%Y%m') AS path,
    max(Date) AS modified FROM daily GROUP BY 1, 2)"""

ORACLES = {
    "l01_newest_files": f"""{_FILES} SELECT ticker, path FROM files
        QUALIFY row_number() OVER (PARTITION BY ticker ORDER BY modified DESC, path DESC) = 1""",
    "l02_older_files": f"""{_FILES} SELECT ticker, path FROM files
        QUALIFY row_number() OVER (PARTITION BY ticker ORDER BY modified DESC, path DESC) > 1""",
    "l03_sample_per_group": """SELECT o_orderkey, o_orderpriority, o_totalprice FROM orders
        QUALIFY row_number() OVER (PARTITION BY o_orderpriority
        ORDER BY md5('7|' || o_orderkey), o_orderkey) <= 100""",
}
