import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from feedstat.operators import association, distribution, hypothesis, profile, ranks, sampling
from feedstat.functions import tails


@pytest.fixture(scope="module")
def table(spark):
    """3,000 rows: one value and one group hold a third of them; some values are missing."""
    rng = np.random.default_rng(3)
    rows = []
    for i in range(3_000):
        group = "a" if i % 3 == 0 else ("b", "c", "d")[int(rng.integers(3))]
        x = 5.0 if i % 3 == 1 else float(np.round(rng.normal(10, 4), 2))
        y = float(rng.exponential(3))
        rows.append((i, group, None if i % 50 == 0 else x, math.nan if i % 70 == 0 else y, int(rng.integers(1, 7))))
    df = spark.createDataFrame(rows, "id bigint, g string, x double, y double, k int").repartition(5)
    return df.cache(), rows


def column(rows, i, group=None):
    return np.array([
        r[i] for r in rows
        if r[i] is not None and not math.isnan(r[i]) and (group is None or r[1] == group)
    ], dtype=float)


def by_variable(df, *keys):
    return {tuple(r[k] for k in ("variable", *keys)): r for r in df.collect()}


@pytest.mark.parametrize("rows_per_bucket", [100, 700, 10**9])
def test_quantiles_are_exact(table, rows_per_bucket):
    df, rows = table
    wanted = {"q0": 0.0, "q10": 0.1, "q25": 0.25, "q50": 0.5, "q99": 0.99, "q100": 1.0}
    got = by_variable(ranks.quantiles(df, ["x", "y"], wanted, rows_per_bucket=rows_per_bucket))
    for i, name in ((2, "x"), (3, "y")):
        values = column(rows, i)
        row = got[(name,)]
        assert (row.total, row.min, row.max) == (len(values), values.min(), values.max())
        for q, p in wanted.items():
            assert row[q] == pytest.approx(np.percentile(values, 100 * p), rel=1e-12)
    groups = by_variable(
        ranks.quantiles(df, ["x"], {"m": 0.5}, ["g"], rows_per_bucket=rows_per_bucket), "g"
    )
    assert {k[1] for k in groups} == {"a", "b", "c", "d"}
    for (_, g), row in groups.items():
        assert row.m == pytest.approx(np.median(column(rows, 2, g)), rel=1e-12)


@pytest.mark.parametrize("rows_per_bucket", [50, 10**9])
def test_average_ranks(table, rows_per_bucket):
    df, rows = table
    counts = ranks.value_counts(df, ["x"], split=["g"])
    placed = ranks.rank_positions(counts, rows_per_bucket=rows_per_bucket).select(
        "*", ranks.average_rank().alias("rank")
    ).collect()
    values = np.sort(column(rows, 2))
    for row in placed:
        first, last = np.searchsorted(values, row.value), np.searchsorted(values, row.value, "right")
        assert (row.before, row.ties, row.total) == (first, last - first, len(values))
        assert row["rank"] == (first + 1 + last) / 2
    n = len(values)
    assert sum(r.n * r["rank"] for r in placed) == n * (n + 1) / 2


def test_bucket_bounds_do_not_change_results(table):
    df, _ = table
    results = [
        sorted(map(tuple, ranks.quantiles(part, ["y"], {"m": 0.37}, ["g"], rows_per_bucket=size).collect()))
        for part, size in ((df, 60), (df.repartition(11), 300), (df.coalesce(1), 10**9))
    ]
    assert results[0] == results[1] == results[2]


@pytest.mark.parametrize("sampled", [2, 1_000])
def test_quantiles_with_infinite_values_and_buckets_cut_again(spark, monkeypatch, sampled):
    monkeypatch.setattr(ranks, "SAMPLED_BOUNDS", sampled)
    monkeypatch.setattr(ranks, "PARTS", 3)
    values = [math.inf, -math.inf] * 40 + [float(i) for i in range(301)]
    rows = spark.createDataFrame([(v,) for v in values], "x double")
    row = ranks.quantiles(rows, ["x"], {"m": 0.5, "q": 0.3}, rows_per_bucket=20).first()
    assert (row.total, row.min, row.max) == (381, -math.inf, math.inf)
    assert (row.m, row.q) == (np.percentile(values, 50), np.percentile(values, 30))


def test_describe_counts_missing_out(table):
    df, rows = table
    got = by_variable(profile.describe(df, ["x", "y", "k"]))
    for i, name in ((2, "x"), (3, "y"), (4, "k")):
        values = column(rows, i)
        row = got[(name,)]
        assert row["count"] == len(values)
        assert row["mean"] == pytest.approx(values.mean()) and row["std"] == pytest.approx(values.std(ddof=1))
        assert row["q75"] == pytest.approx(np.percentile(values, 75))


def test_profile_counts(table):
    df, rows = table
    assert profile.shape(df).first() == (3_000, 5)
    missing = {r.variable: r.n_missing for r in profile.null_counts(df).collect()}
    assert missing == {"id": 0, "g": 0, "x": 60, "y": 43, "k": 0}
    distinct = {r.variable: r.n_distinct for r in profile.distinct_counts(df).collect()}
    assert distinct["g"] == 4 and distinct["x"] == len(set(column(rows, 2)))
    roughly = {r.variable: r.n_distinct for r in profile.distinct_counts(df, approximate=True).collect()}
    assert roughly["id"] == pytest.approx(3_000, rel=0.15)


@pytest.mark.parametrize("name, i", [("x", 2), ("y", 3), ("k", 4)])
def test_histogram_equals_numpy(table, name, i):
    df, rows = table
    values = column(rows, i)
    if name == "k":
        values = values.astype(int)
    n, edges = np.histogram(values, bins=np.histogram_bin_edges(values, "auto"))
    got = sorted(distribution.histogram(df, [name]).collect(), key=lambda r: r.bin)
    assert [r.n for r in got] == list(n)
    assert [r.bin_left for r in got] == pytest.approx(list(edges[:-1]))
    assert sum(r.n for r in got) == len(values)


def test_histogram_of_one_value_and_given_bins(spark, table):
    df, rows = table
    flat = spark.createDataFrame([(2.0,), (2.0,)], "x double")
    assert [tuple(r) for r in distribution.histogram(flat, ["x"]).collect()] == [("x", 0, 1.5, 2.5, 2)]
    n, _ = np.histogram(column(rows, 2), bins=7)
    got = sorted(distribution.histogram(df, ["x"], bins=7).collect(), key=lambda r: r.bin)
    assert [r.n for r in got] == list(n)


def test_histogram_with_very_many_bins(spark):
    rows = spark.createDataFrame([(float(i),) for i in range(100)] + [(1e6,)], "x double")
    got = distribution.histogram(rows, ["x"], bins=25_001).agg(F.count("bin"), F.sum("n"), F.max("bin")).first()
    assert got == (25_001, 101, 25_000)


def test_hue_shares_bins(table):
    df, rows = table
    edges = np.histogram_bin_edges(column(rows, 3), "auto")
    got = distribution.histogram(df, ["y"], hue="g").collect()
    for g in "abcd":
        n, _ = np.histogram(column(rows, 3, g), bins=edges)
        assert [r.n for r in sorted(got, key=lambda r: r.bin) if r.g == g] == list(n)


def test_density_against_the_full_sum(table):
    df, rows = table
    values = column(rows, 3)
    width = values.std(ddof=1) * len(values) ** -0.2
    got = sorted(distribution.density(df, ["y"], points=45, cut=3).collect(), key=lambda r: r.point)
    grid = np.linspace(values.min() - 3 * width, values.max() + 3 * width, 45)
    expected = np.exp(-(((grid[:, None] - values) / width) ** 2) / 2).sum(1) / (
        len(values) * width * math.sqrt(2 * math.pi)
    )
    assert [r.x for r in got] == pytest.approx(list(grid))
    assert [r.density for r in got] == pytest.approx(list(expected), rel=1e-9)


def test_density_has_every_grid_point(spark):
    far = spark.createDataFrame([(float(i % 3),) for i in range(3_000)] + [(1e6,)], "x double")
    got = distribution.density(far, ["x"]).collect()
    assert len(got) == 200 and min(r.density for r in got) == 0.0


def test_box_summary(table):
    df, rows = table
    got = by_variable(distribution.box_summary(df, ["y"], ["g"]), "g")
    for g in "abcd":
        values = column(rows, 3, g)
        q1, q2, q3 = np.percentile(values, [25, 50, 75])
        inside = values[(values >= q1 - 1.5 * (q3 - q1)) & (values <= q3 + 1.5 * (q3 - q1))]
        row = got[("y", g)]
        assert (row.q1, row.median, row.q3) == pytest.approx((q1, q2, q3))
        assert (row.whisker_low, row.whisker_high) == (inside.min(), inside.max())
        assert row.n_outliers == len(values) - len(inside)
    outliers = distribution.box_outliers(df, ["y"], ["g"]).groupBy("g").agg(F.sum("n").alias("n")).collect()
    assert {r.g: r.n for r in outliers} == {g: got[("y", g)].n_outliers for g in "abcd"}


def test_correlation_skips_missing_pairs(table):
    df, rows = table
    both = [(r[2], r[3]) for r in rows if r[2] is not None and not math.isnan(r[3])]
    x, y = map(np.array, zip(*both))
    constant = df.withColumn("c", F.lit(1.0))
    got = {(r.variable_x, r.variable_y): r.r for r in association.correlation_matrix(constant, ["x", "y", "c"]).collect()}
    assert got[("x", "y")] == got[("y", "x")] == pytest.approx(np.corrcoef(x, y)[0, 1])
    assert got[("x", "x")] == 1.0 and got[("x", "c")] is None and got[("c", "c")] is None


def test_contingency_fills_empty_cells(spark):
    rows = spark.createDataFrame([("a", "x"), ("a", "y"), ("b", "x"), (None, "x")], "r string, c string")
    got = {(r.r, r.c): r.n for r in association.contingency(rows, "r", "c").collect()}
    assert got == {("a", "x"): 1, ("a", "y"): 1, ("b", "x"): 1, ("b", "y"): 0}


def test_t_test(table):
    df, rows = table
    a, b = column(rows, 2, "a"), column(rows, 2, "b")
    pooled = ((len(a) - 1) * a.var(ddof=1) + (len(b) - 1) * b.var(ddof=1)) / (len(a) + len(b) - 2)
    t = (a.mean() - b.mean()) / math.sqrt(pooled * (1 / len(a) + 1 / len(b)))
    row = hypothesis.t_test(df, ["x"], "g", "a", "b").first()
    assert row.statistic == pytest.approx(t) and row.dof == len(a) + len(b) - 2
    assert hypothesis.t_test(df, ["x"], "g", "b", "a").first().statistic == pytest.approx(-t)


def _variance_ratio(groups):
    values = np.concatenate(groups)
    between = sum(len(g) * (g.mean() - values.mean()) ** 2 for g in groups) / (len(groups) - 1)
    within = sum(((g - g.mean()) ** 2).sum() for g in groups) / (len(values) - len(groups))
    return between / within


def test_anova_and_levene(spark, table):
    df, rows = table
    groups = [column(rows, 3, g) for g in "abcd"]
    row = hypothesis.anova(df, ["y"], "g").first()
    assert row.statistic == pytest.approx(_variance_ratio(groups))
    arrays = spark._jvm.java.util.ArrayList()
    for g in groups:
        array = spark.sparkContext._gateway.new_array(spark._jvm.double, len(g))
        for i, v in enumerate(g):
            array[i] = float(v)
        arrays.add(array)
    p = spark._jvm.org.apache.commons.math3.stat.inference.OneWayAnova().anovaPValue(arrays)
    assert row.p_value == pytest.approx(p, rel=1e-6)
    row = hypothesis.levene(df, ["y"], "g").first()
    assert row.statistic == pytest.approx(_variance_ratio([abs(g - np.median(g)) for g in groups]))


def test_variance_ratio_with_a_group_of_one(spark):
    rows = spark.createDataFrame([("a", 1.0), ("a", 2.0), ("b", 4.0), ("b", 6.0), ("c", 9.0)], "g string, x double")
    groups = [np.array([1.0, 2.0]), np.array([4.0, 6.0]), np.array([9.0])]
    assert hypothesis.anova(rows, ["x"], "g").first().statistic == pytest.approx(_variance_ratio(groups))
    assert [r.variance for r in association.group_variances(rows, ["x"], "g").where("g = 'c'").collect()] == [None]


def test_kruskal(table):
    df, rows = table
    groups = [column(rows, 2, g) for g in "abcd"]
    values = np.sort(np.concatenate(groups))
    n = len(values)

    def rank(v):
        return (np.searchsorted(values, v) + 1 + np.searchsorted(values, v, "right")) / 2

    h = 12 / (n * (n + 1)) * sum(rank(g).sum() ** 2 / len(g) for g in groups) - 3 * (n + 1)
    _, ties = np.unique(values, return_counts=True)
    h /= 1 - (ties.astype(float) ** 3 - ties).sum() / (n**3 - n)
    row = hypothesis.verdict(hypothesis.kruskal(df, ["x"], "g")).first()
    assert row.statistic == pytest.approx(h, rel=1e-9) and row.dof == 3
    assert row.p_value == pytest.approx(tails.gamma_upper(1.5, h / 2))
    assert row.verdict == ("reject" if row.p_value < 0.05 else "fail to reject")


def test_kruskal_of_equal_values_has_no_statistic(spark):
    rows = spark.createDataFrame([("a", 1.0), ("b", 1.0), ("b", 1.0)], "g string, x double")
    row = hypothesis.verdict(hypothesis.kruskal(rows, ["x"], "g")).first()
    assert row.statistic is None and row.p_value is None and row.verdict is None


def test_chi_square_and_continuity_correction(spark):
    wide = spark.createDataFrame(
        [(r, c) for r, c, n in (("a", "x", 12), ("a", "y", 5), ("b", "x", 3), ("b", "y", 9)) for _ in range(n)],
        "r string, c string",
    )
    table = np.array([[12, 5], [3, 9]])
    expected = table.sum(1, keepdims=True) * table.sum(0) / table.sum()
    corrected = ((abs(table - expected) - 0.5) ** 2 / expected).sum()
    row = hypothesis.chi_square_of(wide, "r", "c").first()
    assert row.dof == 1 and row.statistic == pytest.approx(corrected)
    assert row.p_value == pytest.approx(math.erfc(math.sqrt(corrected / 2)))
    three = wide.unionAll(spark.createDataFrame([("c", "x")] * 4, "r string, c string"))
    table = np.array([[12, 5], [3, 9], [4, 0]])
    expected = table.sum(1, keepdims=True) * table.sum(0) / table.sum()
    row = hypothesis.chi_square_of(three, "r", "c").first()
    assert row.statistic == pytest.approx(((table - expected) ** 2 / expected).sum()) and row.dof == 2
    frame = association.expected_frequencies(association.contingency(three, "r", "c"), "r", "c")
    assert frame.agg(F.sum("expected")).first()[0] == pytest.approx(table.sum())


# Published examples with their W and p.
WEIGHTS = [148, 154, 158, 160, 161, 162, 166, 170, 182, 195, 236]
TWENTY = [0.11, 7.87, 4.61, 10.14, 7.95, 3.14, 0.46, 4.43, 0.21, 4.75,
          0.71, 1.52, 3.24, 0.93, 0.42, 4.97, 9.53, 4.55, 0.47, 6.66]


def test_shapiro_known_answers(spark):
    rows = spark.createDataFrame(
        [("w", float(v)) for v in WEIGHTS] + [("t", v) for v in TWENTY], "g string, x double"
    )
    got = by_variable(hypothesis.shapiro(rows, ["x"], "g"), "g")
    assert got[("x", "w")].statistic == pytest.approx(0.7888, abs=5e-5)
    assert got[("x", "w")].p_value == pytest.approx(0.006704, abs=5e-6)
    assert got[("x", "t")].statistic == pytest.approx(0.90047, abs=5e-6)
    assert got[("x", "t")].p_value == pytest.approx(0.04209, abs=5e-6)


def test_comparison_picks_the_test_by_its_preconditions(spark):
    rng = np.random.default_rng(5)
    normal = [(i, g, float(rng.normal()), float(rng.exponential())) for i in range(300) for g in ("a", "b")]
    rows = spark.createDataFrame([(2 * i + (g == "b"), g, x, y) for i, g, x, y in normal], "id int, g string, x double, y double")
    got = {r.variable: r for r in hypothesis.compare_groups(rows, ["x", "y"], "g", ["id"]).collect()}
    assert got["y"].test == "kruskal" and got["y"].normality_p < 0.05
    assert (got["x"].test == "anova") == (got["x"].normality_p >= 0.05 and got["x"].variance_p >= 0.05)


def test_qq_points_cover_every_position(table):
    df, rows = table
    got = hypothesis.qq_points(df, ["x"], "g").where("g = 'a'").collect()
    values = np.sort(column(rows, 2, "a"))
    covered = sorted(p for r in got for p in range(r["first"], r["last"] + 1))
    assert covered == list(range(1, len(values) + 1))
    for r in got:
        assert set(values[r["first"] - 1:r["last"]]) == {r.value}
        assert r.line_first == pytest.approx(values.mean() + values.std() * r.normal_first)


def test_sample_is_exact_and_repeatable(table):
    df, _ = table
    one = sampling.sample_per_group(df, "g", ["id"], n=40, seed=1)
    assert {r.g: r["count"] for r in one.groupBy("g").count().collect()} == dict.fromkeys("abcd", 40)
    again = sampling.sample_per_group(df.repartition(3), "g", ["id"], n=40, seed=1)
    counted = sampling.sample_per_group(df, "g", ["id"], n=40, seed=1)
    other = sampling.sample_per_group(df, "g", ["id"], n=40, seed=2)
    ids = [{r.id for r in s.select("id").collect()} for s in (one, again, counted, other)]
    assert ids[0] == ids[1] == ids[2] != ids[3]
    every = sampling.sample_per_group(df, "g", ["id"], n=2_000)
    assert every.count() == 3_000


def test_contingency_of_categories_that_make_bad_column_names(spark):
    rows = spark.createDataFrame(
        [("x", 0.1), ("X", 0.1), ("r", 2.5), ("x", 2.5), ("x", 2.5), (None, 2.5)], "r string, c double"
    )
    cells = association.contingency(rows, "r", "c")
    assert dict(cells.dtypes) == {"r": "string", "c": "double", "n": "bigint"}
    got = {(r.r, r.c): r.n for r in cells.collect()}
    assert got == {("x", 0.1): 1, ("X", 0.1): 1, ("r", 0.1): 0, ("x", 2.5): 2, ("X", 2.5): 0, ("r", 2.5): 1}
    back = {(r.c, r.r): r.n for r in association.contingency(rows, "c", "r").collect()}
    assert back == {(c, r): n for (r, c), n in got.items()}
    wide = hypothesis.chi_square_of(rows, "r", "c").first()
    full = hypothesis.chi_square(cells, "r", "c").first()
    assert tuple(wide) == pytest.approx(tuple(full)) and wide.dof == 2


def test_shapiro_of_small_and_constant_groups(spark):
    rows = spark.createDataFrame(
        [("three", 1.0), ("three", 2.0), ("three", 4.0), ("two", 1.0), ("two", 2.0), ("one", 1.0)]
        + [("flat", 5.0)] * 6 + [("many", float(x * x % 17)) for x in range(9)], "g string, x double"
    )
    got = {r.g: r for r in hypothesis.shapiro(rows, ["x"], "g").collect()}
    assert set(got) == {"three", "two", "one", "flat", "many"}
    w = ((4 - 1) ** 2 / 2) / sum((v - 7 / 3) ** 2 for v in (1, 2, 4))
    assert got["three"].statistic == pytest.approx(w)
    assert got["three"].p_value == pytest.approx(6 / math.pi * (math.asin(math.sqrt(w)) - math.asin(math.sqrt(0.75))))
    assert all(got[g].statistic is None and got[g].p_value is None for g in ("two", "one", "flat"))
    small = rows.where("g in ('three', 'two')").withColumn("id", F.monotonically_increasing_id())
    compared = hypothesis.compare_groups(small, ["x"], "g", ["id"]).collect()
    assert [(r.variable, r.test, r.normality_p) for r in compared] == [("x", "kruskal", None)]


def test_automatic_bins_with_a_far_outlier_are_those_of_numpy(spark):
    values = [float(x % 97) for x in range(999)] + [1e12]
    rows = spark.createDataFrame([(v,) for v in values], "x double")
    got = distribution.histogram(rows, ["x"]).orderBy("bin").collect()
    counts, edges = np.histogram(values, bins="auto")
    assert [r.n for r in got] == counts.tolist()
