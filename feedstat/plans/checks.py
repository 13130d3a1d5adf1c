"""Registered queries on feed gates."""

from __future__ import annotations

from pyspark.sql import functions as F

from feedstat.operators import quality
from feedstat.plans.standins import (
    BAR_COLUMNS, DAILY_SQL, TICKER_SQL, daily_bars, feed_text, ticker,
)
from feedstat.session import materialize, scratch_path
from feedstat.sources import sidecars

PATTERN = "dataset=([^/]+)"


def _feed(spark, sf_dir, breaks: bool = False):
    """Pipe files per dataset with header and counter files; two datasets have faults.

    With ``breaks`` cells hold quotes, separators, line breaks and blank lines.
    """
    bars = materialize(daily_bars(spark, sf_dir).withColumn("dataset", ticker()), "bars")
    path = scratch_path(spark, "feed")
    rows = feed_text(bars).withColumn("dataset", F.regexp_replace("Script name", "[^A-Za-z0-9]+", "-"))
    if breaks:
        note = F.when(F.col("Volume") > 1, F.lit('lot "A|B"\n\n"|second\n')).otherwise(F.lit('5" pipe'))
        rows = rows.withColumn("Script name", F.concat_ws("\n", "Script name", note))
    rows.write.partitionBy("dataset").options(header=True, sep="|", escape='"').csv(path)
    names = ["Script name" if c == "Script_name" else "Adj Close" if c == "Adj_Close" else c
             for c in BAR_COLUMNS]
    datasets = bars.groupBy("dataset").count()
    late = F.when(F.col("dataset") == "5-LOW", F.lit(",".join([*names[:-1], "Turnover"])))
    headers = scratch_path(spark, "headers")
    datasets.select("dataset", late.otherwise(F.lit(",".join(reversed(names)))).alias("value")) \
        .write.partitionBy("dataset").text(headers)
    wrong = F.when(F.col("dataset") == "2-HIGH", F.col("count") + 1).otherwise(F.col("count"))
    counters = scratch_path(spark, "counters")
    datasets.select("dataset", F.concat(F.lit("Count:"), wrong.cast("string")).alias("value")) \
        .write.partitionBy("dataset").text(counters)
    return quality.feed_facts(spark, path, PATTERN), headers, counters


def headers(spark, sf_dir):
    facts, header_path, _ = _feed(spark, sf_dir)
    checks = quality.check_headers(
        quality.feed_columns(facts), sidecars.read_headers(spark, header_path, PATTERN)
    )
    return checks.select(
        "dataset", "passed",
        F.concat_ws(",", "missing").alias("missing"), F.concat_ws(",", "extra").alias("extra"),
    )


def counters(spark, sf_dir):
    facts, _, counter_path = _feed(spark, sf_dir)
    return quality.check_counts(facts, sidecars.read_counters(spark, counter_path, PATTERN))


def counters_with_breaks(spark, sf_dir):
    facts, _, counter_path = _feed(spark, sf_dir, breaks=True)
    return quality.check_counts(facts, sidecars.read_counters(spark, counter_path, PATTERN))


QUERIES = {"q01_header_check": headers, "q02_count_check": counters, "q02_quoted_breaks": counters_with_breaks}

_COUNTS = f"""WITH {DAILY_SQL}, sizes AS (SELECT Script_name, count(*) AS n FROM daily GROUP BY 1)
        SELECT {TICKER_SQL} AS dataset,
        CAST(CASE WHEN Script_name = '2-HIGH' THEN n + 1 ELSE n END AS BIGINT) AS expected,
        CAST(n AS BIGINT) AS actual, Script_name <> '2-HIGH' AS passed FROM sizes"""

ORACLES = {
    "q01_header_check": f"""WITH {DAILY_SQL} SELECT DISTINCT {TICKER_SQL} AS dataset,
        Script_name <> '5-LOW' AS passed,
        CASE WHEN Script_name = '5-LOW' THEN 'Turnover' ELSE '' END AS missing,
        CASE WHEN Script_name = '5-LOW' THEN 'Volume' ELSE '' END AS extra FROM daily""",
    "q02_count_check": _COUNTS,
    "q02_quoted_breaks": _COUNTS,
}
