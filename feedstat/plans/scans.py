"""Registered queries on sources."""

from __future__ import annotations

from pyspark.sql import functions as F

from feedstat.functions.casting import rename_columns, to_double
from feedstat.functions.dates import parse_date
from feedstat.plans.standins import (
    ADJ_CLOSE_SQL, BAR_COLUMNS, BARS_SQL, DAILY_SQL, TICKER_SQL,
    daily_bars, feed_archives, feed_text, show_bars, ticker, with_period,
)
from feedstat.session import scratch_path
from feedstat.sinks.files import write_by_period, write_delimited, write_pipe
from feedstat.sources import archives, delimited, listing, sidecars

NUMBERS = ["Open", "High", "Low", "Close", "Adj_Close", "Volume"]
PERIOD_SQL = "strftime(Date, '%Y%m')"
PERIODS_SQL = f"SELECT DISTINCT {TICKER_SQL} AS ticker, strftime(Date, '%Y') AS period FROM daily"


def fixed_scan(spark, sf_dir):
    close = F.when(F.col("Volume") == 1, F.lit("abc")).otherwise(F.col("Close").cast("string"))
    path = write_pipe(
        feed_text(daily_bars(spark, sf_dir).withColumn("Close", close)), scratch_path(spark, "pipe")
    )
    return show_bars(rename_columns(delimited.read_fixed(spark, path)))


def inferred_scan(spark, sf_dir):
    bars = daily_bars(spark, sf_dir).withColumn("Date", F.date_format("Date", "M/d/yyyy"))
    path = write_delimited(feed_text(bars), scratch_path(spark, "comma"))
    read = rename_columns(delimited.read_inferred(spark, path))
    return show_bars(read.withColumn("Date", parse_date(F.col("Date"))))


def gzip_scan(spark, sf_dir):
    path = scratch_path(spark, "gzip")
    feed_text(daily_bars(spark, sf_dir)).write.options(header=True, compression="gzip").csv(path)
    return show_bars(to_double(rename_columns(delimited.read_gzip(spark, path)), NUMBERS))


def plain_scan(spark, sf_dir):
    path = write_delimited(feed_text(daily_bars(spark, sf_dir)), scratch_path(spark, "plain"))
    return show_bars(to_double(rename_columns(delimited.read_plain(spark, path)), NUMBERS))


def expand(spark, sf_dir):
    members = archives.expand_archives(feed_archives(spark, sf_dir))
    return members.select("archive", "member", (F.length("content") > 0).alias("has_content"))


def member_rows(spark, sf_dir):
    zipped = feed_archives(spark, sf_dir)
    rows = archives.member_rows(zipped, archives.choose_members(zipped), delimited.PRICE_FEED)
    return show_bars(rename_columns(rows))


def zip_source(spark, sf_dir):
    """The members as a data source, from archives in a folder; some lines are short."""
    path = scratch_path(spark, "archives")
    archives.write_archives(feed_archives(spark, sf_dir, short_lines=True), path)
    return show_bars(rename_columns(archives.read_members(spark, path, delimited.PRICE_FEED).drop("archive", "member")))


def unexpanded(spark, sf_dir):
    members = archives.list_members(feed_archives(spark, sf_dir))
    period = listing.add_ticker_period(members, "member")
    ledger = period.where(F.col("period") < "199801").select("member")
    return archives.new_members(members, ledger).select("archive", "member")


def _period_files(spark, sf_dir):
    path = scratch_path(spark, "periods")
    write_by_period(with_period(daily_bars(spark, sf_dir), "yyyy"), path)
    return path


def _folders(files):
    return files.select(
        F.regexp_extract("path", r"ticker=([^/]+)", 1).alias("ticker"),
        F.regexp_extract("path", r"period=([^/]+)", 1).alias("period"),
        "length",
    )


def suffix_filter(spark, sf_dir):
    files = listing.with_suffix(listing.list_files(spark, _period_files(spark, sf_dir)), ".csv")
    return _folders(files).select("ticker", "period").distinct()


def file_listing(spark, sf_dir):
    files = _folders(listing.list_files(spark, _period_files(spark, sf_dir), "*.csv"))
    return files.groupBy("ticker", "period").agg((F.sum("length") > 0).alias("has_bytes"))


def name_parts(spark, sf_dir):
    members = archives.list_members(feed_archives(spark, sf_dir))
    return listing.add_ticker_period(members, "member").select("member", "ticker", "period")


def dataset_names(spark, sf_dir):
    members = archives.list_members(feed_archives(spark, sf_dir))
    return members.select("member", listing.dataset_name(F.col("member")).alias("dataset"))


def header_sidecar(spark, sf_dir):
    path = scratch_path(spark, "headers")
    datasets = daily_bars(spark, sf_dir).select(ticker().alias("dataset")).distinct()
    datasets.withColumn("value", F.lit(",".join(BAR_COLUMNS))).write.partitionBy("dataset").text(path)
    return sidecars.read_headers(spark, path, "dataset=([^/]+)")


def counter_sidecar(spark, sf_dir):
    path = scratch_path(spark, "counters")
    counts = daily_bars(spark, sf_dir).groupBy(ticker().alias("dataset")).count()
    counts.select("dataset", F.concat(F.lit("Count:"), F.col("count").cast("string")).alias("value")) \
        .write.partitionBy("dataset").text(path)
    return sidecars.read_counters(spark, path, "dataset=([^/]+)")


def batch_union(spark, sf_dir):
    bars = daily_bars(spark, sf_dir)
    early, late = F.year("Date") < 1998, F.year("Date") >= 1998
    paths = [
        write_delimited(feed_text(bars.where(part)), scratch_path(spark, "batch")) for part in (early, late)
    ]
    read = delimited.read_batch(spark, paths, delimited.PRICE_FEED)
    return show_bars(rename_columns(read))


def drifting_union(spark, sf_dir):
    bars = daily_bars(spark, sf_dir)
    early = bars.where(F.year("Date") < 1998).drop("Adj_Close")
    return show_bars(delimited.union_batches([early, bars.where(F.year("Date") >= 1998)]))


QUERIES = {
    "s01_fixed_scan": fixed_scan,
    "s02_inferred_scan": inferred_scan,
    "s03_gzip_scan": gzip_scan,
    "s04_plain_scan": plain_scan,
    "s05_expand_archives": expand,
    "s05_member_rows": member_rows,
    "s05_zip_source": zip_source,
    "s06_unexpanded_members": unexpanded,
    "s07_suffix_filter": suffix_filter,
    "s08_file_listing": file_listing,
    "s09_name_parts": name_parts,
    "s10_dataset_names": dataset_names,
    "s11_header_sidecar": header_sidecar,
    "s12_counter_sidecar": counter_sidecar,
    "u01_batch_union": batch_union,
    "u01_drifting_union": drifting_union,
}

_MEMBERS = f"""members AS (
  SELECT DISTINCT {TICKER_SQL} || '-' || strftime(Date, '%Y') || '.zip' AS archive,
         {TICKER_SQL} || '_' || {PERIOD_SQL} || '.csv.gz' AS member,
         {TICKER_SQL} AS ticker, {PERIOD_SQL} AS period
  FROM daily)"""

ORACLES = {
    "s01_fixed_scan": f"""WITH {DAILY_SQL} SELECT Script_name, strftime(Date, '%Y-%m-%d') AS Date,
        Open, High, Low, CASE WHEN Volume = 1 THEN NULL ELSE Close END AS Close,
        {ADJ_CLOSE_SQL}, Volume FROM daily""",
    "s02_inferred_scan": f"WITH {DAILY_SQL} SELECT {BARS_SQL} FROM daily",
    "s03_gzip_scan": f"WITH {DAILY_SQL} SELECT {BARS_SQL} FROM daily",
    "s04_plain_scan": f"WITH {DAILY_SQL} SELECT {BARS_SQL} FROM daily",
    "s05_expand_archives": f"""WITH {DAILY_SQL}, {_MEMBERS}
        SELECT archive, member, true AS has_content FROM members""",
    "s05_member_rows": f"WITH {DAILY_SQL} SELECT {BARS_SQL} FROM daily",
    "s05_zip_source": f"""WITH {DAILY_SQL} SELECT Script_name, strftime(Date, '%Y-%m-%d') AS Date, Open, High, Low, Close,
        CASE WHEN Volume = 1 THEN NULL ELSE round(Adj_Close + 1e-9, 6) END AS Adj_Close,
        CASE WHEN Volume = 1 THEN NULL ELSE Volume END AS Volume FROM daily""",
    "s06_unexpanded_members": f"""WITH {DAILY_SQL}, {_MEMBERS}
        SELECT archive, member FROM members WHERE period >= '199801'""",
    "s07_suffix_filter": f"WITH {DAILY_SQL} {PERIODS_SQL}",
    "s08_file_listing": f"WITH {DAILY_SQL} SELECT *, true AS has_bytes FROM ({PERIODS_SQL})",
    "s09_name_parts": f"WITH {DAILY_SQL}, {_MEMBERS} SELECT member, ticker, period FROM members",
    "s10_dataset_names": f"""WITH {DAILY_SQL}, {_MEMBERS}
        SELECT member, ticker || '_' || period AS dataset FROM members""",
    "s11_header_sidecar": f"""WITH {DAILY_SQL} SELECT dataset, column_name
        FROM (SELECT DISTINCT {TICKER_SQL} AS dataset FROM daily),
        (SELECT unnest(['Script_name','Date','Open','High','Low','Close','Adj_Close','Volume'])
         AS column_name)""",
    "s12_counter_sidecar": f"""WITH {DAILY_SQL} SELECT {TICKER_SQL} AS dataset,
        CAST(count(*) AS BIGINT) AS expected FROM daily GROUP BY 1""",
    "u01_batch_union": f"WITH {DAILY_SQL} SELECT {BARS_SQL} FROM daily",
    "u01_drifting_union": f"""WITH {DAILY_SQL} SELECT Script_name,
        strftime(Date, '%Y-%m-%d') AS Date, Open, High, Low, Close,
        CASE WHEN year(Date) < 1998 THEN NULL ELSE round(Adj_Close + 1e-9, 6) END AS Adj_Close, Volume
        FROM daily""",
}
