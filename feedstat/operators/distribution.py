"""The numbers behind histograms, density curves and box plots."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedstat.functions.casting import natural_log
from feedstat.operators.ranks import long_form, quantiles, with_groups
from feedstat.session import materialize

# Whisker reach in interquartile ranges; points of a density curve.
WHISKER_REACH = 1.5
DENSITY_POINTS = 200
BIN_BLOCK = 10_000
#: Values weighed at once, and curves that a task holds before it sends them on.
DENSITY_VALUES, DENSITY_CURVES = 4_096, 4_096


def log_values(df: DataFrame, column: str, name: str | None = None) -> DataFrame:
    """Replace a column by its natural log; only positive values have one."""
    return df.where(F.col(column) > 0).withColumn(name or column, natural_log(F.col(column)))


def _bin_count(df: DataFrame, columns: Sequence[str], bins: int | str) -> Column:
    """Number of equal bins; 'auto' is the finer of the Sturges and Freedman-Diaconis rules.

    The Freedman-Diaconis width is half the square-root rule's at least, so far outliers
    never ask for more than twice the square root of the rows.
    """
    spread = F.col("max") - F.col("min")
    if bins != "auto":
        return F.when(spread == 0, 1).otherwise(F.lit(int(bins))).cast("bigint")
    n = F.col("total").cast("double")
    sturges = spread / (F.log2(n) + 1)
    by_quartiles = 2 * (F.col("q75") - F.col("q25")) / F.pow(n, F.lit(1 / 3))
    width = F.least(F.greatest(by_quartiles, spread / F.sqrt(n) / 2), sturges)
    whole = [c for c in columns if isinstance(df.schema[c].dataType, T.IntegralType)]
    if whole:
        width = F.when(F.col("variable").isin(whole), F.greatest(width, F.lit(1.0))).otherwise(width)
    return F.when(spread == 0, F.lit(1)).otherwise(F.ceil(F.try_divide(spread, width))).cast("bigint")


def bin_layout(df: DataFrame, columns: Sequence[str], by: Sequence[str], bins: int | str) -> DataFrame:
    """Written table with one row per (variable, by): low edge, high edge, number of bins."""
    summary = quantiles(df, columns, {"q25": 0.25, "q75": 0.75}, by)
    flat = F.col("max") == F.col("min")
    layout = summary.select(
        "variable",
        *by,
        F.when(flat, F.col("min") - 0.5).otherwise(F.col("min")).alias("low"),
        F.when(flat, F.col("max") + 0.5).otherwise(F.col("max")).alias("high"),
        _bin_count(df, columns, bins).alias("bins"),
    )
    return materialize(layout, "bin-layout")


def _edge(position: Column) -> Column:
    return F.col("low") + position * ((F.col("high") - F.col("low")) / F.col("bins"))


def _bin_number() -> Column:
    """Bin of ``value``: closed below, the last bin closed on both sides."""
    raw = F.floor((F.col("value") - F.col("low")) / (F.col("high") - F.col("low")) * F.col("bins"))
    last = F.col("bins") - 1
    guess = F.greatest(F.lit(0).cast("bigint"), F.least(raw, last))
    lowered = F.when(F.col("value") < _edge(guess), guess - 1).otherwise(guess)
    return F.when(
        (F.col("value") >= _edge(lowered + 1)) & (lowered < last), lowered + 1
    ).otherwise(lowered)


def _every_bin(series: DataFrame) -> DataFrame:
    """One row per bin; a long series is laid out by several tasks, a block of bins each."""
    start = F.col("block") * BIN_BLOCK
    end = F.least(start + BIN_BLOCK, F.col("bins")) - 1
    blocks = series.withColumn(
        "block", F.explode(F.sequence(F.lit(0).cast("bigint"), F.floor((F.col("bins") - 1) / BIN_BLOCK)))
    )
    keys = [name for name in series.columns if name not in ("low", "high", "bins")]
    return blocks.repartition(*keys, "block").withColumn("bin", F.explode(F.sequence(start, end))).drop("block")


def histogram(
    df: DataFrame,
    columns: Sequence[str],
    by: Sequence[str] = (),
    hue: str | None = None,
    bins: int | str = "auto",
) -> DataFrame:
    """Rows per bin, empty bins included.

    Groups named in ``by`` get bins of their own; the categories of ``hue`` share
    the bins of the whole column. Rows are counted per bin inside each task.
    """
    split = [hue] if hue else []
    keys = ["variable", *by]
    typed = df.where(F.col(hue).isNotNull()) if hue else df
    layout = bin_layout(typed, columns, by, bins)
    filled = materialize(
        with_groups(long_form(typed, columns, [*by, *split]), layout, keys)
        .withColumn("bin", _bin_number())
        .groupBy(*keys, *split, "bin")
        .agg(F.count(F.lit(1)).alias("n")),
        "filled-bins",
    )
    series = filled.select(*keys, *split).distinct().join(layout, keys) if split else layout
    every = _every_bin(series)
    return every.join(filled, [*keys, *split, "bin"], "left").select(
        *keys,
        *split,
        "bin",
        _edge(F.col("bin")).alias("bin_left"),
        _edge(F.col("bin") + 1).alias("bin_right"),
        F.coalesce("n", F.lit(0)).cast("bigint").alias("n"),
    )


def _curve_sums(batches: Iterator[pa.RecordBatch], points: int) -> Iterator[pa.RecordBatch]:
    """(curve, point, weight): sums of the kernels of a task's values at the points of each curve's grid."""
    held: dict[int, np.ndarray] = {}
    steps = np.arange(points)

    def out() -> pa.RecordBatch:
        curves = np.repeat(np.fromiter(held, np.int64, len(held)), points)
        weights = np.concatenate(list(held.values()))
        point = np.tile(steps.astype(np.int32), len(held))
        return pa.RecordBatch.from_arrays([pa.array(curves), pa.array(point), pa.array(weights)], ["curve", "point", "weight"])

    for batch in batches:
        curve, value, start, step, bandwidth = (
            batch[name].to_numpy() for name in ("curve", "value", "start", "step", "bandwidth")
        )
        order = np.lexsort((value, curve))
        curve, value = curve[order], value[order]
        # equal values of a curve count together
        fresh = np.flatnonzero(np.concatenate(([True], (curve[1:] != curve[:-1]) | (value[1:] != value[:-1])))) if len(curve) else order
        n = np.diff(np.concatenate((fresh, [len(curve)])))
        edges = np.flatnonzero(np.concatenate(([True], np.diff(curve[fresh]) != 0))) if len(fresh) else fresh
        for a, b in zip(edges.tolist(), [*edges[1:].tolist(), len(fresh)]):
            name, row = int(curve[fresh[a]]), order[fresh[a]]
            grid = (start[row] + steps * step[row]) / bandwidth[row]
            total = held.setdefault(name, np.zeros(points))
            for k in range(a, b, DENSITY_VALUES):
                part = slice(k, min(b, k + DENSITY_VALUES))
                z = value[fresh[part]][:, None] / bandwidth[row] - grid
                total += n[part] @ np.exp(-0.5 * z * z)
        if len(held) >= DENSITY_CURVES:
            yield out()
            held = {}
    if held:
        yield out()


def density(
    df: DataFrame,
    columns: Sequence[str],
    by: Sequence[str] = (),
    points: int = DENSITY_POINTS,
    cut: float = 0.0,
) -> DataFrame:
    """Gaussian kernel density with Scott's bandwidth on an even grid per (variable, by).

    The grid runs from ``cut`` bandwidths below the minimum to as many above the
    maximum. Each task adds up the kernels of its rows at the grid points, where it reads
    them; what is shuffled is one number per point and task, and no value.
    """
    keys = ["variable", *by]
    rows = long_form(df, columns, by)
    summary = rows.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("total"),
        F.stddev_samp("value").alias("deviation"),
        F.min("value").alias("min"),
        F.max("value").alias("max"),
    )
    bandwidth = F.col("deviation") * F.pow(F.col("total").cast("double"), F.lit(-0.2))
    grid = materialize(
        summary.where(F.col("deviation") > 0)
        .withColumn("bandwidth", bandwidth)
        .select(
            *keys,
            F.monotonically_increasing_id().alias("curve"),
            "total",
            "bandwidth",
            (F.col("min") - cut * F.col("bandwidth")).alias("start"),
            ((F.col("max") - F.col("min") + 2 * cut * F.col("bandwidth")) / (points - 1)).alias("step"),
        ),
        "density-grid",
    )
    near = with_groups(rows, grid, keys).select("curve", "value", "start", "step", "bandwidth")
    sums = near.mapInArrow(lambda batches: _curve_sums(batches, points), "curve long, point int, weight double")
    sums = sums.groupBy("curve", "point").agg(F.sum("weight").alias("weight"))
    x = F.col("start") + F.col("point") * F.col("step")
    every = grid.withColumn("point", F.explode(F.sequence(F.lit(0), F.lit(points - 1))))
    scale = F.col("total") * F.col("bandwidth") * F.sqrt(2 * F.pi())
    return every.join(sums, ["curve", "point"], "left").select(
        *keys,
        "point",
        x.alias("x"),
        (F.coalesce("weight", F.lit(0.0)) / scale).alias("density"),
    )


def _fences(df: DataFrame, columns: Sequence[str], by: Sequence[str]) -> DataFrame:
    quartiles = quantiles(df, columns, {"q1": 0.25, "median": 0.5, "q3": 0.75}, by)
    reach = WHISKER_REACH * (F.col("q3") - F.col("q1"))
    return quartiles.withColumns({"low_fence": F.col("q1") - reach, "high_fence": F.col("q3") + reach})


def _inside() -> Column:
    return F.col("value").between(F.col("low_fence"), F.col("high_fence"))


def box_summary(df: DataFrame, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Quartiles, whiskers at the last values inside the fences, and the number of outliers."""
    keys = ["variable", *by]
    fences = _fences(df, columns, by)
    reach = with_groups(long_form(df, columns, by), fences, keys).groupBy(*keys).agg(
        F.min(F.when(_inside(), F.col("value"))).alias("lowest"),
        F.max(F.when(_inside(), F.col("value"))).alias("highest"),
        F.count_if(~_inside()).alias("n_outliers"),
    )
    return reach.join(fences, keys).select(
        *keys,
        F.col("total").alias("n"),
        "q1",
        "median",
        "q3",
        F.least("lowest", "q1").alias("whisker_low"),
        F.greatest("highest", "q3").alias("whisker_high"),
        "n_outliers",
    )


def box_outliers(df: DataFrame, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Every distinct value outside the whiskers, with its number of rows."""
    keys = ["variable", *by]
    rows = with_groups(long_form(df, columns, by), _fences(df, columns, by), keys)
    return rows.where(~_inside()).groupBy(*keys, "value").agg(F.count(F.lit(1)).alias("n"))
