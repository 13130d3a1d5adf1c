"""The feed jobs and the study, from input to written result."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from feedstat.functions.casting import (
    FEED_NAMES, PRICE_COLUMNS, drop_incomplete, rename_columns, to_double,
)
from feedstat.functions.dates import add_date_parts, parse_date, parse_timestamp
from feedstat.operators import association, distribution, hypothesis, profile, quality
from feedstat.operators.bars import weekly_bars
from feedstat.session import materialize
from feedstat.sinks import files, tables
from feedstat.sources import archives, delimited, listing, sidecars
from feedstat.sources.delimited import PRICE_FEED_COLUMNS

# A dataset is named by the folder its files are in.
FOLDER = r"([^/]+)/[^/]+$"

LANDED = StructType()
for _name, _kind in PRICE_FEED_COLUMNS.items():
    LANDED.add(FEED_NAMES.get(_name, _name), _kind)
for _name in ("ticker", "period", "member"):
    LANDED.add(_name, "string")
LANDED_KEYS = ["ticker", "period", "member"]


def _gates(
    spark: SparkSession, feed: str, header_file: str, counter_file: str, pattern: str, sep: str
) -> DataFrame:
    facts = materialize(quality.feed_facts(spark, feed, pattern, sep), "feed-facts")
    names = quality.check_headers(
        quality.feed_columns(facts, sep), sidecars.read_headers(spark, header_file, pattern)
    ).withColumnRenamed("passed", "header_passed")
    counts = quality.check_counts(
        facts, sidecars.read_counters(spark, counter_file, pattern)
    ).withColumnRenamed("passed", "count_passed")
    return names.join(counts, "dataset", "full_outer")


def weekly_job(
    spark: SparkSession,
    feed: str,
    header_file: str,
    counter_file: str,
    standardized: str,
    outbound: str,
    dataset_pattern: str = FOLDER,
    tie: str | None = None,
) -> DataFrame:
    """Pipe feed to typed parquet per ticker and a weekly summary; returns the gate results.

    As the gates only report, a failed gate does not stop the job.
    """
    checks = materialize(
        _gates(spark, feed, header_file, counter_file, dataset_pattern, "|"), "gates"
    )
    typed = rename_columns(delimited.read_fixed(spark, feed))
    files.write_partitioned(typed, standardized)
    stored = spark.read.schema(typed.schema).parquet(standardized)
    dated = stored.withColumn("Date", parse_timestamp(F.col("Date")))
    files.write_summary(weekly_bars(dated, tie), outbound)
    return checks


def read_ledger(spark: SparkSession, ledger: str) -> DataFrame:
    """Members expanded so far; empty before the first run."""
    layout = StructType().add("member", "string")
    try:
        return spark.read.schema(layout).parquet(ledger)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], layout)


def ingest_archives(spark: SparkSession, zipped: DataFrame, landing: str, ledger: str) -> DataFrame:
    """Expand the members that are not in the ledger into the landing zone; returns them.

    Rows land in one folder per ticker, period and member. A run that stops before
    the ledger is written is repeated without doubling rows: it replaces the folders
    of its own members.
    """
    chosen = archives.choose_members(zipped, read_ledger(spark, ledger))
    rows = rename_columns(archives.member_rows(zipped, chosen, delimited.PRICE_FEED)).drop("archive")
    rows = listing.add_ticker_period(rows, "member")
    files.write_partitioned(rows, landing, LANDED_KEYS, replace_all=False)
    added = chosen.select(F.explode("members").alias("member"))
    added.write.mode("append").parquet(ledger)
    return added


def archive_job(
    spark: SparkSession, inbound: str, landing: str, ledger: str, table: str
) -> DataFrame:
    """Zip archives to landed rows, a table over them and a view of each ticker's newest period."""
    ingest_archives(spark, archives.read_archives(spark, inbound), landing, ledger)
    tables.register_table(spark, table, landing, schema=LANDED, partitioned_by=LANDED_KEYS)
    return tables.register_current(spark, f"{table}_current", table)


def dated_job(
    spark: SparkSession,
    feed: str,
    header_file: str,
    counter_file: str,
    standardized: str,
    outbound: str,
    table: str,
    dataset_pattern: str = FOLDER,
    sep: str = ",",
    drop_gaps: bool = False,
) -> DataFrame:
    """Dated feed to typed parquet, delimited text and a table; returns the gate results.

    Row counts are checked on the raw rows, also when ``drop_gaps`` leaves rows with
    empty cells out afterwards.
    """
    checks = materialize(
        _gates(spark, feed, header_file, counter_file, dataset_pattern, sep), "gates"
    )
    raw = rename_columns(delimited.read_inferred(spark, feed, sep))
    whole = drop_incomplete(raw) if drop_gaps else raw
    prices = [c for c in PRICE_COLUMNS if c in whole.columns]
    dated = to_double(whole, prices).withColumn("Date", parse_date(F.col("Date")))
    parts = add_date_parts(dated)
    files.write_flat(parts, standardized)
    stored = spark.read.schema(parts.schema).parquet(standardized)
    files.write_delimited(stored, outbound, sep)
    tables.register_table(spark, table, standardized, schema=parts.schema)
    return checks


def study(
    df: DataFrame, measures: Sequence[str], categories: Sequence[str], target: str, keys: Sequence[str]
) -> dict[str, DataFrame]:
    """All results of the statistical study of a table, by name; each is one Spark job.

    ``target`` is the measure the tests are about; ``keys`` identify a row and make
    the samples repeatable.
    """
    first, *others = categories
    results = {
        "shape": profile.shape(df),
        "distinct": profile.distinct_counts(df),
        "missing": profile.null_counts(df),
        "summary": profile.describe(df, measures),
        "info": profile.column_info(df),
        "category_counts": profile.category_counts(df, categories),
        "histogram": distribution.histogram(df, measures),
        "density": distribution.density(df, measures),
        "boxes": distribution.box_summary(df, measures),
        "correlation": association.correlation_matrix(df, measures),
    }
    for category in categories:
        results[f"boxes_by_{category}"] = distribution.box_summary(df, [target], [category])
        results[f"histogram_by_{category}"] = distribution.histogram(df, [target], hue=category)
        results[f"variances_by_{category}"] = association.group_variances(df, [target], category)
        results[f"qq_by_{category}"] = hypothesis.qq_points(df, [target], category)
        results[f"comparison_by_{category}"] = hypothesis.compare_groups(df, [target], category, keys)
    for category in others:
        results[f"independence_{first}_{category}"] = hypothesis.verdict(
            hypothesis.chi_square_of(df, first, category)
        )
    return results
