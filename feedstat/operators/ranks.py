"""Exact quantiles and ranks of large columns.

No task ever sorts a whole column. Values are cut into buckets; sums per bucket, a
table with one row per bucket, say how many rows lie before each of them; sorting
happens within a bucket. The first bounds come from a sample, a list of bounded length;
buckets that hold too many different values are cut again, until none is left. Bounds
decide how evenly the work is spread, never what the result is, and every size of table
takes the same way.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterable, Mapping, Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from feedstat.session import materialize

ROWS_PER_BUCKET = 100_000
SAMPLE_PER_BUCKET = 100
#: Bounds that come from the sample at most, and parts that a bucket is cut into again.
SAMPLED_BOUNDS, PARTS = 1_024, 1_024
#: Parts that the rows of a group are dealt to when they are joined with what is known of their group.
SALTS = 16


def with_groups(rows: DataFrame, groups: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``rows`` with the columns of their group, from a written table with one row per group.

    A small table is broadcast. For a large one both sides are shuffled, by group and a number
    that goes round from row to row, with the group's row repeated for each number: a group, or
    a value, that fills a third of the rows is dealt to as many tasks.
    """
    salt = F.pmod(F.monotonically_increasing_id(), F.lit(SALTS)).cast("int")
    salts = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))
    dealt = rows.withColumn("salt", salt).join(groups.withColumn("salt", salts), [*keys, "salt"])
    return dealt.drop("salt")


def long_form(df: DataFrame, columns: Sequence[str], keys: Iterable[str] = ()) -> DataFrame:
    """(keys, variable, value as double), without missing values and missing keys."""
    keys = list(keys)
    typed = df.select(*keys, *[F.col(c).cast("double").alias(c) for c in columns])
    rows = typed.unpivot(keys, list(columns), "variable", "value")
    present = F.col("value").isNotNull() & ~F.isnan("value")
    for key in keys:
        present &= F.col(key).isNotNull()
    return rows.where(present)


def cut(
    rows: DataFrame, size: int, rows_per_bucket: int = ROWS_PER_BUCKET,
    sampled: Callable[[float], DataFrame] | None = None,
) -> DataFrame:
    """Add a bucket, an array of numbers in the order of the values, that depends on nothing but the value.

    ``sampled`` gives a share of the rows more cheaply than by building all of them.
    """
    buckets = min(SAMPLED_BOUNDS, max(2, math.ceil(size / rows_per_bucket)))
    shares = [i / buckets for i in range(1, buckets)]
    share = min(1.0, SAMPLE_PER_BUCKET * buckets / max(1, size))
    sample = sampled(share) if sampled else rows.sample(share, seed=7)
    bounds = sample.agg(
        F.percentile_approx("value", shares, max(1_000, 4 * buckets)).alias("bounds")
    ).first().bounds
    finite = {b for b in bounds or [0.0] if math.isfinite(b)} or {0.0}
    splits = [float("-inf"), *sorted(finite), float("inf")]
    bucketizer = Bucketizer(splits=splits, inputCol="value", outputCol="bucket", handleInvalid="keep")
    numbered = bucketizer.transform(rows)
    return numbered.withColumn("bucket", F.array(F.col("bucket").cast("int")))


def _cut_again(bucketed: DataFrame, keys: Sequence[str], overfull: DataFrame) -> DataFrame:
    """Cut the buckets of ``overfull`` into parts of equal width between their finite ends."""
    ends = overfull.select(*[F.col(k).alias(f"_{k}") for k in [*keys, "bucket"]], "low", "high")
    same = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in [*keys, "bucket"]]
    condition = same[0]
    for part in same[1:]:
        condition = condition & part
    # halves, so that the width of no bucket is beyond the largest number
    share = (F.col("value") / 2 - F.col("low") / 2) / (F.col("high") / 2 - F.col("low") / 2)
    part = (
        F.when(F.col("value") < F.col("low"), -1).when(F.col("value") > F.col("high"), PARTS)
        .otherwise(F.least(F.lit(PARTS - 1), F.floor(share * PARTS).cast("int")))
    )
    again = F.concat("bucket", F.array(part))
    joined = bucketed.join(ends, condition, "left")
    return joined.withColumn("bucket", F.when(F.col("low").isNotNull(), again).otherwise(F.col("bucket"))).drop(
        *[f"_{k}" for k in [*keys, "bucket"]], "low", "high"
    )


def _cells(
    bucketed: DataFrame, keys: Sequence[str], n: Column, rows_per_bucket: int
) -> tuple[DataFrame, DataFrame]:
    """The rows with final buckets, and a written table of (keys, bucket): rows, rows of
    earlier buckets, all rows, smallest, largest.

    A bucket of more than four times ``rows_per_bucket`` different values is cut again. They are
    counted only in buckets with so many rows.
    """
    cell, limit = [*keys, "bucket"], 4 * rows_per_bucket
    previous = Window.partitionBy(*keys).orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    finite = F.when(F.abs("value") < float("inf"), F.col("value"))
    while True:
        sums = bucketed.groupBy(*cell).agg(
            F.sum(n).alias("size"), F.min("value").alias("min"), F.max("value").alias("max"),
            F.min(finite).alias("low"), F.max(finite).alias("high"),
        )
        cells = materialize(
            sums.select(
                "*",
                F.coalesce(F.sum("size").over(previous), F.lit(0)).alias("earlier"),
                F.sum("size").over(Window.partitionBy(*keys)).alias("total"),
            ),
            "bucket-cells",
        )
        large = cells.where((F.col("size") > limit) & (F.col("low") < F.col("high"))).select(*cell, "low", "high")
        if large.isEmpty():
            return bucketed, cells
        large = materialize(large, "large-cells")
        different = with_groups(bucketed.select(*cell, "value"), large.select(*cell), cell)
        different = different.groupBy(*cell).agg(F.approx_count_distinct("value").alias("different"))
        overfull = materialize(large.join(different.where(F.col("different") > limit), cell).drop("different"), "overfull-cells")
        if overfull.isEmpty():
            return bucketed, cells
        bucketed = _cut_again(bucketed, keys, overfull)


def _place(counts: DataFrame, cell: Sequence[str], earlier: Column) -> DataFrame:
    """Add ``ties`` and ``before`` by sums within a cell; both windows share one sort."""
    ordered = Window.partitionBy(*cell).orderBy("value")
    same = ordered.rangeBetween(Window.currentRow, Window.currentRow)
    upto = ordered.rangeBetween(Window.unboundedPreceding, Window.currentRow)
    placed = counts.select("*", F.sum("n").over(same).alias("ties"), F.sum("n").over(upto).alias("upto"))
    return placed.withColumn("before", earlier + F.col("upto") - F.col("ties")).drop("upto")


def value_counts(
    df: DataFrame, columns: Sequence[str], by: Iterable[str] = (), split: Iterable[str] = ()
) -> DataFrame:
    """Written table (variable, by, split, value, n) of distinct values and their rows.

    Rows are counted before the shuffle, so a value that fills a third of the table
    travels as one row per task.
    """
    keys = ["variable", *by, *split]
    counts = (
        long_form(df, columns, [*by, *split])
        .groupBy(*keys, "value")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    return materialize(counts, "value-counts")


def rank_positions(
    counts: DataFrame, by: Iterable[str] = (), rows_per_bucket: int = ROWS_PER_BUCKET
) -> DataFrame:
    """Place every value of a :func:`value_counts` table in its sorted column.

    Adds, per (variable, by): ``before``, rows with a smaller value; ``ties``,
    rows with this value (summed over the split columns); ``total``, all rows.
    """
    keys = ["variable", *by]
    bucketed = cut(counts, counts.count(), rows_per_bucket)
    cell = [*keys, "bucket"]
    bucketed, cells = _cells(bucketed, keys, F.col("n"), rows_per_bucket)
    cells = cells.select(*cell, "earlier", "total")
    return _place(bucketed.join(cells, cell), cell, F.col("earlier")).drop("bucket", "earlier")


def average_rank() -> Column:
    """Mean position, from 1, of the rows that share a value."""
    return F.col("before") + (F.col("ties") + 1) / F.lit(2.0)


def _targets(p: float) -> tuple[Column, Column, Column]:
    """The two positions (from 0) around a quantile and the share of the upper one."""
    place = (F.col("total") - 1) * F.lit(float(p))
    return F.floor(place), F.ceil(place), place - F.floor(place)


def _quantile(p: float) -> Column:
    """Aggregate over placed values: the quantile, interpolated linearly."""
    low, high, share = _targets(p)

    def at(position: Column) -> Column:
        hit = (F.col("before") <= position) & (position < F.col("before") + F.col("ties"))
        return F.max(F.when(hit, F.col("value")))

    return at(low) + (at(high) - at(low)) * F.max(share)


def quantiles(
    df: DataFrame,
    columns: Sequence[str],
    probabilities: Mapping[str, float],
    by: Iterable[str] = (),
    rows_per_bucket: int = ROWS_PER_BUCKET,
) -> DataFrame:
    """Written table with one row per (variable, by): total, min, max and the named exact quantiles.

    Nothing but bucket sums is shuffled, until the buckets that hold a wanted position
    are known; only their values are counted and sorted. ``df`` is read for a sample, for
    the sums and for the values of those buckets.
    """
    keys = ["variable", *by]
    # a zero has one sign, so that values in order are buckets in order
    rows = long_form(df, columns, by).withColumn("value", F.col("value") + F.lit(0.0))
    named = [_quantile(p).alias(name) for name, p in probabilities.items()]
    cell = [*keys, "bucket"]
    bucketed = cut(
        rows, df.count() * len(columns), rows_per_bucket,
        lambda share: long_form(df.sample(share, seed=7), columns, by),
    )
    bucketed, cells = _cells(bucketed, keys, F.lit(1), rows_per_bucket)
    positions = [position for p in probabilities.values() for position in _targets(p)[:2]]

    def at(position: Column, name: str) -> Column:
        holds = (F.col("earlier") <= position) & (position < F.col("earlier") + F.col("size"))
        return F.max(F.when(holds, F.col(name)))

    # one row per group: its bounds, and from where to where the cell of each wanted position goes
    ends = cells.groupBy(*keys).agg(
        F.max("total").alias("total"), F.min("min").alias("min"), F.max("max").alias("max"),
        *[at(position, name).alias(f"{name}_{k}") for k, position in enumerate(positions) for name in ("min", "max", "earlier")],
    )
    ends = materialize(ends.withColumn("_group", F.monotonically_increasing_id()), "wanted-cells")
    # cells of a group are apart by their values; the first position in a cell names it
    part = F.coalesce(*[
        F.when(F.col("value").between(F.col(f"min_{k}"), F.col(f"max_{k}")), k) for k in range(len(positions))
    ])
    counts = (
        with_groups(rows, ends.drop("total", "min", "max"), keys)
        .select("_group", part.alias("_part"), "value")
        .where(F.col("_part").isNotNull())
        .groupBy("_group", "_part", "value")
        .agg(F.count(F.lit(1)).alias("ties"))
    )
    # a value is one row here, so a running sum by rows places it
    previous = Window.partitionBy("_group", "_part").orderBy("value").rowsBetween(Window.unboundedPreceding, -1)
    placed = counts.withColumn("before", F.coalesce(F.sum("ties").over(previous), F.lit(0)))
    earlier = F.get(F.array(*[f"earlier_{k}" for k in range(len(positions))]), F.col("_part"))
    found = (
        placed.join(ends, "_group").withColumn("before", earlier + F.col("before")).groupBy(*keys)
        .agg(*[F.max(name).alias(name) for name in ("total", "min", "max")], *named)
    )
    return materialize(found, "quantiles")
