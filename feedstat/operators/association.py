"""Correlation, group variances and contingency tables."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedstat.operators.ranks import long_form
from feedstat.session import materialize


#: Tasks that lay out the grid of a contingency table.
GRID_PARTS = 64


def correlation_matrix(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Pearson correlations in long form, both triangles and the diagonal, in one pass.

    A pair uses the rows where both values are present; a constant column has
    null correlations.
    """
    clean = df.select(*[
        F.when(~F.isnan(F.col(c).cast("double")), F.col(c).cast("double")).alias(c) for c in columns
    ])
    pairs = list(combinations(columns, 2))

    def r(a: str, b: str) -> Column:
        # Not F.corr: in ANSI mode that fails on a constant column.
        scale = F.stddev_pop(F.when(F.col(b).isNotNull(), F.col(a))) * F.stddev_pop(
            F.when(F.col(a).isNotNull(), F.col(b))
        )
        return F.try_divide(F.covar_pop(a, b), scale)

    one_row = clean.agg(
        *[r(a, b).alias(f"{a}|{b}") for a, b in pairs],
        *[F.when(F.var_samp(c) > 0, F.lit(1.0)).alias(f"{c}|{c}") for c in columns],
    )
    entries = [
        F.struct(
            F.lit(a).alias("variable_x"), F.lit(b).alias("variable_y"), F.col(f"`{source}`").alias("r")
        )
        for a, b, source in [
            *[(a, b, f"{a}|{b}") for a, b in pairs],
            *[(b, a, f"{a}|{b}") for a, b in pairs],
            *[(c, c, f"{c}|{c}") for c in columns],
        ]
    ]
    return one_row.select(F.inline(F.array(*entries)))


def group_moments(df: DataFrame, columns: Sequence[str], group: str) -> DataFrame:
    """Rows, mean and sample variance per (variable, group); one row gives a null variance."""
    return long_form(df, columns, [group]).groupBy("variable", group).agg(
        F.count(F.lit(1)).alias("n"),
        F.avg("value").alias("mean"),
        F.var_samp("value").alias("variance"),
    )


def group_variances(df: DataFrame, columns: Sequence[str], group: str) -> DataFrame:
    """Sample variance per (variable, group)."""
    return group_moments(df, columns, group).select("variable", group, "variance")


def contingency_cells(df: DataFrame, rows: str, columns: str) -> DataFrame:
    """Written table (rows, columns, n) of the cells that have rows; missing categories are left out.

    Categories keep their types and are never column names here.
    """
    if rows == columns:
        raise ValueError("a contingency table needs two different columns")
    present = df.where(F.col(rows).isNotNull() & F.col(columns).isNotNull())
    return materialize(present.groupBy(rows, columns).agg(F.count(F.lit(1)).alias("n")), "contingency")


def contingency_wide(df: DataFrame, rows: str, columns: str, values: Sequence | None = None) -> DataFrame:
    """Contingency table for showing: one column per category of ``columns``, zeros filled in.

    Columns are named by the categories' text. With ``values`` only these categories are counted. A
    table has a column for each category, so their number has to be one that can be shown.
    """
    cells = contingency_cells(df, rows, columns)
    if values is None:
        values = [row[0] for row in cells.select(columns).distinct().orderBy(columns).collect()]
    counts = [
        F.coalesce(F.sum(F.when(F.col(columns) == F.lit(value), F.col("n"))), F.lit(0)).alias(str(value))
        for value in values
    ]
    return cells.groupBy(rows).agg(*counts)


def contingency(df: DataFrame, rows: str, columns: str, values: Sequence | None = None) -> DataFrame:
    """Contingency table in long form (row, column, n), with a row for every empty cell.

    The grid of all row categories and all column categories is the result; with ``values``
    only these column categories are in it. Both lists are written tables; one is dealt to
    ``GRID_PARTS`` parts and the other repeated for each, so a long grid is made by as many tasks.
    """
    cells = contingency_cells(df, rows, columns)
    if values is not None:
        cells = cells.where(F.col(columns).isin(list(values)))
    part = F.pmod(F.monotonically_increasing_id(), F.lit(GRID_PARTS)).cast("int")
    every = F.explode(F.sequence(F.lit(0), F.lit(GRID_PARTS - 1)))
    sides = [
        materialize(cells.select(F.col(name).alias(f"_{k}")).distinct().withColumn("_part", where), "categories")
        for k, (name, where) in enumerate(((rows, part), (columns, every)))
    ]
    filled = cells.select(F.col(rows).alias("_row"), F.col(columns).alias("_column"), "n")
    grid = sides[0].join(sides[1], "_part")
    joined = grid.join(filled, (F.col("_0") == F.col("_row")) & (F.col("_1") == F.col("_column")), "left")
    return joined.select(
        F.col("_0").alias(rows), F.col("_1").alias(columns), F.coalesce("n", F.lit(0)).alias("n")
    )


def expected_frequencies(cells: DataFrame, rows: str, columns: str) -> DataFrame:
    """Add the frequency each cell would have if rows and columns were independent."""
    total = cells.agg(F.sum("n")).first()[0] or 0
    column_sums = materialize(cells.groupBy(columns).agg(F.sum("n").alias("column_total")), "column-totals")
    row_sums = materialize(cells.groupBy(rows).agg(F.sum("n").alias("row_total")), "row-totals")
    return (
        cells.join(row_sums, rows).join(column_sums, columns)
        .withColumn("grand_total", F.lit(total).cast("bigint"))
        .withColumn("expected", F.try_divide(F.col("row_total").cast("double") * F.col("column_total"), F.col("grand_total")))
        .drop("row_total", "column_total")
    )
