"""Repeatable random samples per group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def sample_per_group(df: DataFrame, group: str, keys: Sequence[str], n: int = 100, seed: int = 0) -> DataFrame:
    """Exactly ``n`` random rows of every group, or all of a smaller group.

    Rows are drawn by the order of a hash of ``keys`` and ``seed``, so any engine
    and any partitioning draws the same rows. Spark keeps the first ``n`` rows of
    each group in every task before the shuffle (``WindowGroupLimit``), so no more than
    that travels, whatever the size of a group.
    """
    text = F.concat_ws("|", F.lit(str(seed)), *[F.col(k).cast("string") for k in keys])
    drawn = df.where(F.col(group).isNotNull()).withColumn("_draw", F.md5(text))
    window = Window.partitionBy(group).orderBy("_draw", *keys)
    return (
        drawn.withColumn("_place", F.row_number().over(window))
        .where(F.col("_place") <= n)
        .drop("_draw", "_place")
    )
