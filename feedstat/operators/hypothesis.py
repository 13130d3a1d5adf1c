"""Hypothesis tests: every test is a Spark job that returns one row per tested column."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from feedstat.functions.normal import inverse_normal
from feedstat.functions.tails import chi_square_tail, f_tail, normal_tail, t_two_sided
from feedstat.operators.association import contingency, contingency_cells, expected_frequencies, group_moments
from feedstat.operators.ranks import long_form, quantiles, rank_positions, value_counts, with_groups
from feedstat.operators.sampling import sample_per_group
from feedstat.session import materialize

# Fixed value: significance level.
ALPHA = 0.05
# Fixed value: rows drawn for a normality test.
NORMALITY_SAMPLE = 100
# Royston (1995), algorithm AS R94, polynomials in ascending powers.
WEIGHT_LAST = (0.0, 0.221157, -0.147981, -2.071190, 4.434685, -2.706056)
WEIGHT_NEXT = (0.0, 0.042981, -0.293762, -1.752461, 5.682633, -3.582633)
SMALL_GAMMA = (-2.273, 0.459)
SMALL_MEAN = (0.5440, -0.39978, 0.025054, -0.0006714)
SMALL_LOG_SD = (1.3822, -0.77857, 0.062767, -0.0020322)
LARGE_MEAN = (-1.5861, -0.31082, -0.083751, 0.0038915)
LARGE_LOG_SD = (-0.4803, -0.082676, 0.0030302)


def verdict(tests: DataFrame, alpha: float = ALPHA, p: str = "p_value") -> DataFrame:
    """Add the decision at a significance level."""
    return tests.withColumn(
        "verdict", F.when(F.col(p) < alpha, F.lit("reject")).when(F.col(p).isNotNull(), F.lit("fail to reject"))
    )


def t_test(df: DataFrame, columns: Sequence[str], group: str, first, second) -> DataFrame:
    """Two-sided t-test with pooled variance; the sign is that of first minus second."""
    moments = group_moments(df.where(F.col(group).isin(first, second)), columns, group)

    def of(value, name: str):
        return F.max(F.when(F.col(group) == F.lit(value), F.col(name)))

    sides = moments.groupBy("variable").agg(
        of(first, "n").alias("n_first"), of(second, "n").alias("n_second"),
        of(first, "mean").alias("mean_first"), of(second, "mean").alias("mean_second"),
        of(first, "variance").alias("var_first"), of(second, "variance").alias("var_second"),
    )
    spread = F.coalesce((F.col("n_first") - 1) * F.col("var_first"), F.lit(0.0)) + F.coalesce(
        (F.col("n_second") - 1) * F.col("var_second"), F.lit(0.0)
    )
    pooled = F.try_divide(spread, F.col("dof"))
    error = F.sqrt(pooled * (1 / F.col("n_first") + 1 / F.col("n_second")))
    return (
        sides.withColumn("dof", F.col("n_first") + F.col("n_second") - 2)
        .withColumn("statistic", F.try_divide(F.col("mean_first") - F.col("mean_second"), error))
        .withColumn("p_value", t_two_sided(F.col("statistic"), F.col("dof").cast("double")))
        .select("variable", "n_first", "n_second", "dof", "statistic", "p_value")
    )


def _variance_ratio(moments: DataFrame) -> DataFrame:
    """One-way analysis of variance from per-group rows, means and variances."""
    moments = materialize(moments.select("variable", "n", "mean", "variance"), "moments")
    centres = moments.groupBy("variable").agg(
        F.count(F.lit(1)).alias("k"),
        F.sum("n").alias("total"),
        (F.sum(F.col("n") * F.col("mean")) / F.sum("n")).alias("centre"),
    )
    rows = moments.join(centres, "variable")
    distance = F.col("mean") - F.col("centre")
    parts = rows.groupBy("variable").agg(
        F.max("k").alias("k"),
        F.max("total").alias("total"),
        F.sum(F.col("n") * distance * distance).alias("between"),
        F.sum(F.coalesce((F.col("n") - 1) * F.col("variance"), F.lit(0.0))).alias("within"),
    )
    return (
        parts.withColumn("dof_between", F.col("k") - 1)
        .withColumn("dof_within", F.col("total") - F.col("k"))
        .withColumn(
            "statistic",
            F.try_divide(
                F.try_divide(F.col("between"), F.col("dof_between")),
                F.try_divide(F.col("within"), F.col("dof_within")),
            ),
        )
        .withColumn(
            "p_value",
            f_tail(
                F.col("statistic"),
                F.col("dof_between").cast("double"),
                F.col("dof_within").cast("double"),
            ),
        )
        .select("variable", "k", "total", "dof_between", "dof_within", "statistic", "p_value")
    )


def anova(df: DataFrame, columns: Sequence[str], group: str) -> DataFrame:
    """One-way analysis of variance."""
    return _variance_ratio(group_moments(df, columns, group))


def levene(df: DataFrame, columns: Sequence[str], group: str) -> DataFrame:
    """Equal-variance test on distances from the group medians."""
    medians = quantiles(df, columns, {"median": 0.5}, [group]).select("variable", group, "median")
    distances = with_groups(long_form(df, columns, [group]), medians, ["variable", group])
    spread = F.abs(F.col("value") - F.col("median"))
    return _variance_ratio(
        distances.groupBy("variable", group).agg(
            F.count(F.lit(1)).alias("n"),
            F.avg(spread).alias("mean"),
            F.var_samp(spread).alias("variance"),
        )
    )


def kruskal(df: DataFrame, columns: Sequence[str], group: str) -> DataFrame:
    """Rank test of equal location, corrected for ties.

    Works with doubled distances of ranks from the mean rank, which are whole
    numbers, so the statistic keeps its digits for very large tables.
    """
    ranked = rank_positions(value_counts(df, columns, split=[group]))
    centred = (2 * F.col("before") + F.col("ties") - F.col("total")).cast("double")
    ties = F.col("ties").cast("double")
    per_group = ranked.groupBy("variable", group).agg(
        F.sum("n").cast("double").alias("rows"),
        F.sum(F.col("n") * centred / 2).alias("distance"),
        F.sum(F.col("n") * (ties * ties - 1)).alias("tied"),
        F.max("total").cast("double").alias("total"),
    )
    total = F.col("total")
    statistic = F.try_divide(
        12 * F.col("squares") / (total * (total + 1)),
        1 - F.try_divide(F.col("tied"), total * total * total - total),
    )
    return (
        per_group.groupBy("variable")
        .agg(
            F.count(F.lit(1)).alias("k"),
            F.sum(F.col("distance") * F.col("distance") / F.col("rows")).alias("squares"),
            F.sum("tied").alias("tied"),
            F.max("total").alias("total"),
        )
        .withColumn("statistic", statistic)
        .withColumn("dof", F.col("k") - 1)
        .withColumn("p_value", chi_square_tail(F.col("statistic"), F.col("dof").cast("double")))
        .select("variable", "k", total.cast("bigint").alias("total"), "dof", "statistic", "p_value")
    )


def chi_square(cells: DataFrame, rows: str, columns: str) -> DataFrame:
    """Independence test of a contingency table; continuity-corrected for one degree of freedom.

    Empty cells may be left out of a table of more than two by two: what they add is the rest of
    the expected frequencies.
    """
    table = materialize(expected_frequencies(cells, rows, columns), "expected")
    gap = F.abs(F.col("n") - F.col("expected"))
    corrected = gap - F.least(F.lit(0.5), gap)
    return (
        table.agg(
            F.count_distinct(rows).alias("n_rows"),
            F.count_distinct(columns).alias("n_columns"),
            F.max("grand_total").alias("total"),
            (
                F.sum(F.try_divide(gap * gap, F.col("expected")))
                + F.greatest(F.lit(0.0), F.max("grand_total") - F.sum("expected"))
            ).alias("plain"),
            F.sum(F.try_divide(corrected * corrected, F.col("expected"))).alias("corrected"),
        )
        .withColumn("dof", (F.col("n_rows") - 1) * (F.col("n_columns") - 1))
        .withColumn("statistic", F.when(F.col("dof") == 1, F.col("corrected")).otherwise(F.col("plain")))
        .withColumn(
            "p_value",
            F.when(F.col("dof") > 0, chi_square_tail(F.col("statistic"), F.col("dof").cast("double")))
            .otherwise(F.lit(1.0)),
        )
        .select("n_rows", "n_columns", "total", "dof", "statistic", "p_value")
    )


def chi_square_of(df: DataFrame, rows: str, columns: str) -> DataFrame:
    """:func:`chi_square` of two columns of a table."""
    cells = contingency_cells(df, rows, columns)
    size = cells.agg(F.count_distinct(rows).alias("rows"), F.count_distinct(columns).alias("columns")).first()
    if size.rows == size.columns == 2:  # the correction needs all four cells
        cells = contingency(df, rows, columns)
    return chi_square(cells, rows, columns)


def qq_points(df: DataFrame, columns: Sequence[str], group: str) -> DataFrame:
    """Quantile-quantile points against the normal, with the standardised line.

    One row stands for all rows of a group that share a value: they hold the
    positions ``first`` to ``last`` of the sorted group, so nothing is left out
    and a heavily repeated value stays one row.
    """
    keys = ["variable", group]
    ranked = rank_positions(value_counts(df, columns, [group]), [group])
    line = materialize(
        long_form(df, columns, [group]).groupBy(*keys).agg(
            F.avg("value").alias("centre"), F.stddev_pop("value").alias("deviation")
        ),
        "qq-line",
    )
    first, last = F.col("before") + 1, F.col("before") + F.col("ties")
    points = ranked.join(line, keys).select(
        *keys, "value", "n", first.alias("first"), last.alias("last"),
        inverse_normal(first / (F.col("total") + 1)).alias("normal_first"),
        inverse_normal(last / (F.col("total") + 1)).alias("normal_last"),
        "centre", "deviation",
    )
    return points.withColumns({
        "line_first": F.col("centre") + F.col("deviation") * F.col("normal_first"),
        "line_last": F.col("centre") + F.col("deviation") * F.col("normal_last"),
    }).drop("centre", "deviation")


def _ascending(x, coefficients: Sequence[float]):
    value = F.lit(coefficients[-1])
    for c in reversed(coefficients[:-1]):
        value = value * x + F.lit(c)
    return value


def shapiro_statistic(sample: DataFrame, columns: Sequence[str], group: str) -> DataFrame:
    """Shapiro-Wilk W per (variable, group) of a sample of up to 5,000 rows per group.

    Every group has a row. Three rows have a closed form; fewer, or a constant group, have
    no statistic.
    """
    keys = ["variable", group]
    placed = long_form(sample, columns, [group]).select(
        *keys, "value",
        F.row_number().over(Window.partitionBy(*keys).orderBy("value")).alias("i"),
        F.count(F.lit(1)).over(Window.partitionBy(*keys)).alias("size"),
    )
    scored = placed.withColumn(
        "m", inverse_normal((F.col("i") - 0.375) / (F.col("size") + 0.25))
    )
    last, next_to_last = F.col("i") == F.col("size"), F.col("i") == F.col("size") - 1
    first, second = F.col("i") == 1, F.col("i") == 2

    def pick(condition, name):
        return F.max(F.when(condition, F.col(name)))

    sums = scored.groupBy(*keys).agg(
        F.max("size").alias("size"),
        F.sum(F.col("m") * F.col("m")).alias("mm"),
        F.sum(F.col("m") * F.col("value")).alias("mx"),
        (F.var_samp("value") * (F.max("size") - 1)).alias("xx"),
        pick(last, "m").alias("m1"), pick(next_to_last, "m").alias("m2"),
        pick(last, "value").alias("x_last"), pick(next_to_last, "value").alias("x_next"),
        pick(first, "value").alias("x_first"), pick(second, "value").alias("x_second"),
    )
    u = 1 / F.sqrt(F.col("size").cast("double"))
    a1 = _ascending(u, WEIGHT_LAST) + F.try_divide(F.col("m1"), F.sqrt("mm"))
    a2 = _ascending(u, WEIGHT_NEXT) + F.try_divide(F.col("m2"), F.sqrt("mm"))
    ends = F.col("x_last") - F.col("x_first")
    inner = F.col("x_next") - F.col("x_second")
    m1, m2 = F.col("m1"), F.col("m2")
    two_ends = F.col("size") > 5
    left = F.when(two_ends, F.col("mm") - 2 * m1 * m1 - 2 * m2 * m2).otherwise(F.col("mm") - 2 * m1 * m1)
    kept = F.when(two_ends, 1 - 2 * F.col("a1") * F.col("a1") - 2 * F.col("a2") * F.col("a2")).otherwise(
        1 - 2 * F.col("a1") * F.col("a1")
    )
    middle = F.when(two_ends, F.col("mx") - m1 * ends - m2 * inner).otherwise(F.col("mx") - m1 * ends)
    tops = F.when(two_ends, F.col("a1") * ends + F.col("a2") * inner).otherwise(F.col("a1") * ends)
    product = tops + F.try_divide(middle, F.sqrt(F.try_divide(left, kept)))
    three = F.try_divide(ends * ends / 2, F.col("xx"))
    w = F.when(F.col("size") >= 4, F.try_divide(product * product, F.col("xx"))).when(F.col("size") == 3, three)
    return (
        sums.withColumns({"a1": a1, "a2": a2})
        .withColumn("statistic", w)
        .select(*keys, F.col("size").alias("n"), "statistic")
    )


def shapiro(sample: DataFrame, columns: Sequence[str], group: str) -> DataFrame:
    """Shapiro-Wilk W and its p-value: exact for three rows, by Royston's approximation for more."""
    n, lost = F.col("n").cast("double"), F.ln(1 - F.col("statistic"))
    log_n = F.ln(n)
    small = F.col("n") <= 11
    y = F.when(small, -F.ln(_ascending(n, SMALL_GAMMA) - lost)).otherwise(lost)
    mean = F.when(small, _ascending(n, SMALL_MEAN)).otherwise(_ascending(log_n, LARGE_MEAN))
    sd = F.exp(F.when(small, _ascending(n, SMALL_LOG_SD)).otherwise(_ascending(log_n, LARGE_LOG_SD)))
    # W of three rows is 3/4 at least
    root = F.sqrt(F.greatest(F.lit(0.75), F.least(F.lit(1.0), F.col("statistic"))))
    exact = F.when(F.col("statistic").isNotNull(), 6 / math.pi * (F.asin(root) - math.asin(math.sqrt(0.75))))
    # Below the fitted range of a small sample the probability is zero.
    z = F.when(small & (lost >= _ascending(n, SMALL_GAMMA)), F.lit(float("inf"))).otherwise((y - mean) / sd)
    return shapiro_statistic(sample, columns, group).withColumn(
        "p_value", F.when(F.col("n") >= 4, normal_tail(z)).when(F.col("n") == 3, exact)
    )


def normality_of_groups(
    df: DataFrame, columns: Sequence[str], group: str, keys: Sequence[str],
    n: int = NORMALITY_SAMPLE, seed: int = 0,
) -> DataFrame:
    """:func:`shapiro` on a random sample of every group."""
    return shapiro(sample_per_group(df, group, keys, n, seed), columns, group)


def compare_groups(
    df: DataFrame, columns: Sequence[str], group: str, keys: Sequence[str],
    alpha: float = ALPHA, n: int = NORMALITY_SAMPLE, seed: int = 0,
) -> DataFrame:
    """Analysis of variance where its preconditions hold, the rank test elsewhere.

    A column passes when no group's sample rejects normality and equal variances
    are not rejected; a group whose sample allows no test does not pass. Every column has a
    row. Only the names of the passing columns reach the driver.
    """
    normal = normality_of_groups(df, columns, group, keys, n, seed).groupBy("variable").agg(
        F.when(F.count("p_value") == F.count(F.lit(1)), F.min("p_value")).alias("normality_p")
    )
    equal = levene(df, columns, group).select("variable", F.col("p_value").alias("variance_p"))
    tested = df.sparkSession.createDataFrame([(c,) for c in columns], "variable string")
    checks = materialize(
        tested.join(normal, "variable", "left").join(equal, "variable", "left"), "preconditions"
    )
    passing = checks.where((F.col("normality_p") >= alpha) & (F.col("variance_p") >= alpha))
    chosen = {row.variable for row in passing.select("variable").collect()}
    outcome = ["variable", "test", "statistic", "p_value"]
    parts = []
    for names, name, test in (
        ([c for c in columns if c in chosen], "anova", anova),
        ([c for c in columns if c not in chosen], "kruskal", kruskal),
    ):
        if names:
            parts.append(test(df, names, group).withColumn("test", F.lit(name)).select(*outcome))
    result = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    return verdict(checks.join(result, "variable", "left"), alpha)
