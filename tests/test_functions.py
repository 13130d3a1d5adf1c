import math
from statistics import NormalDist

import pytest
from pyspark.sql import functions as F

from feedstat.functions import casting, dates, tails
from feedstat.functions.normal import inverse_normal


def values(df, column):
    return [row[column] for row in df.collect()]


def test_inverse_normal_agrees_with_standard_library(spark):
    ps = [1e-300, 1e-12, 1e-5, 0.001, 0.05, 0.07499, 0.0751, 0.3, 0.5, 0.62, 0.925, 0.99, 1 - 1e-10]
    rows = spark.createDataFrame([(p,) for p in ps], "p double").select("p", inverse_normal(F.col("p")).alias("z"))
    for p, z in rows.collect():
        assert z == pytest.approx(NormalDist().inv_cdf(p), rel=1e-12, abs=1e-12)
    outside = spark.createDataFrame([(0.0,), (1.0,), (-1.0,)], "p double")
    assert values(outside.select(inverse_normal(F.col("p")).alias("z")), "z") == [None] * 3


def test_tails_agree_with_jvm(spark):
    jvm = spark._jvm.org.apache.commons.math3.distribution
    for d1, d2, x in [(1, 5, 2.0), (2, 59_997, 0.147), (3, 10, 4.5), (5, 1_000, 0.2), (7, 2_000_000, 1.9), (40, 3, 1.0)]:
        expected = 1 - jvm.FDistribution(float(d1), float(d2)).cumulativeProbability(x)
        assert tails.f_upper(x, d1, d2) == pytest.approx(expected, rel=1e-7, abs=1e-12)
    for dof, x in [(1, 0.3), (2, 3.08), (3, 25.0), (8, 3.93), (80, 60.0), (80, 110.0)]:
        expected = 1 - jvm.ChiSquaredDistribution(float(dof)).cumulativeProbability(x)
        assert tails.gamma_upper(dof / 2, x / 2) == pytest.approx(expected, rel=1e-9, abs=1e-13)


def test_tail_limits_for_very_large_tables():
    # F with two degrees has a closed form; with one it approaches the squared normal.
    for d2 in (1e6, 1e9, 6e11):
        for x in (0.01, 1.0, 8.0):
            closed = math.exp(-(d2 / 2) * math.log1p(2 * x / d2))
            assert tails.f_upper(x, 2.0, d2) == pytest.approx(closed, rel=1e-9)
    assert tails.f_upper(4.0, 1.0, 6e11) == pytest.approx(math.erfc(2 / math.sqrt(2)), rel=1e-9)
    assert tails.f_upper(0.0, 3.0, 10.0) == 1.0
    assert tails.f_upper(math.inf, 3.0, 10.0) == 0.0


def test_closed_form_of_chi_square_with_three_degrees():
    for x in (0.5, 3.0, 12.0):
        closed = math.erfc(math.sqrt(x / 2)) + math.sqrt(2 * x / math.pi) * math.exp(-x / 2)
        assert tails.gamma_upper(1.5, x / 2) == pytest.approx(closed, rel=1e-12)


def test_natural_log_edges(spark):
    rows = spark.createDataFrame([(0.0,), (-1.0,), (None,), (math.e,)], "x double")
    zero, below, missing, one = values(rows.select(casting.natural_log(F.col("x")).alias("y")), "y")
    assert zero == -math.inf and math.isnan(below) and missing is None and one == pytest.approx(1.0)


def test_drop_incomplete_drops_null_and_nan(spark):
    rows = spark.createDataFrame([(1.0, "a"), (None, "b"), (math.nan, "c"), (2.0, None)], "x double, y string")
    assert values(casting.drop_incomplete(rows), "y") == ["a"]


def test_cast_and_count_of_lost_text(spark):
    rows = spark.createDataFrame([("1.5", "x"), (None, "2")], "Open string, Close string")
    assert casting.to_double(rows, ["Open", "Close"]).collect() == [(1.5, None), (None, 2.0)]
    assert casting.count_uncastable(rows, ["Open", "Close"]).collect() == [(0, 1)]


def test_split_part_takes_the_separator_as_text(spark):
    rows = spark.createDataFrame([("a|b|c",)], "s string")
    shown = rows.select(*[casting.split_part(F.col("s"), "|", i).alias(f"p{i}") for i in (1, 3, -1, 4)])
    assert tuple(shown.first()) == ("a", "c", "c", None)


def test_sparse_categories(spark):
    rows = spark.createDataFrame([(1,), (1,), (2,), (4,)], "weather int")
    assert sorted(values(casting.drop_categories(rows, "weather", min_count=2), "weather")) == [1, 1]
    assert sorted(values(casting.drop_categories(rows, "weather", [4]), "weather")) == [1, 1, 2]


def test_bad_dates_become_null(spark):
    rows = spark.createDataFrame([("1/5/2020",), ("13/45/2020",), ("x",), (None,)], "d string")
    parsed = values(rows.select(F.date_format(dates.parse_date(F.col("d")), "yyyy-MM-dd").alias("d")), "d")
    assert parsed == ["2020-01-05", None, None, None]


def test_lenient_dates_equal_the_legacy_parser(spark):
    texts = ["1/5/2020", "01/05/2020", "1/5/2020 xyz", "12/31/2019T00", "13/45/2020", "x 1/5/2020", ""]
    rows = spark.createDataFrame([(t,) for t in texts], "d string")
    lenient = values(rows.select(F.date_format(dates.parse_date(F.col("d"), lenient=True), "yyyy-MM-dd").alias("d")), "d")
    before = spark.conf.get("spark.sql.legacy.timeParserPolicy")
    ansi = spark.conf.get("spark.sql.ansi.enabled")
    try:
        dates.use_legacy_parser(spark)
        spark.conf.set("spark.sql.ansi.enabled", "false")
        legacy = values(rows.select(F.to_date("d", "M/d/yyyy").cast("string").alias("d")), "d")
    finally:
        spark.conf.set("spark.sql.legacy.timeParserPolicy", before)
        spark.conf.set("spark.sql.ansi.enabled", ansi)
    assert lenient == legacy


def test_week_labels_at_year_ends(spark):
    rows = spark.createDataFrame([("2019-01-01",), ("2019-12-30",)], "d string").select(F.to_date("d").alias("d"))
    assert values(rows.select(dates.week_label(F.col("d")).alias("w")), "w") == ["Week-1_2019", "Week-1_2019"]
    assert values(rows.select(dates.week_label(F.col("d"), True).alias("w")), "w") == ["Week-1_2019", "Week-1_2020"]
