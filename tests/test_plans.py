"""Shapes of the physical plans that the jobs rely on at scale."""

import importlib

from oracle import plan

from feedstat.operators import distribution, hypothesis, profile, ranks, sampling
from feedstat.operators.bars import add_week_columns, label_weeks, weekly_bars
from feedstat.plans.standins import daily_bars, table

QUERIES = importlib.import_module("__spark_entry__").queries()



def test_weekly_bars_hash_and_scan_only_their_columns(spark, sf_dir):
    text = plan(weekly_bars(daily_bars(spark, sf_dir)))
    assert "HashAggregate" in text and "SortAggregate" not in text and "Window" not in text
    assert "ReadSchema: struct<o_orderkey:bigint,o_totalprice:double,o_orderdate:timestamp_ntz,o_orderpriority:string>" in text


def test_week_columns_share_one_exchange(spark, sf_dir):
    rows = label_weeks(daily_bars(spark, sf_dir))
    assert plan(add_week_columns(rows)).count("Exchange hashpartitioning(Script_name") == 1


def test_filters_reach_the_scan(spark, sf_dir):
    assert "PushedFilters: [IsNotNull(l_returnflag), EqualTo(l_returnflag,R)]" in plan(
        QUERIES["p13_equal_rows"](spark, sf_dir)
    )


def test_samples_are_cut_before_the_shuffle(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    text = plan(sampling.sample_per_group(orders, "o_orderpriority", ["o_orderkey"]))
    assert text.index("WindowGroupLimit") < text.index("Exchange") < text.rindex("WindowGroupLimit")


def test_rank_windows_share_one_sort(spark, sf_dir):
    counts = ranks.value_counts(table(spark, sf_dir, "lineitem"), ["l_extendedprice"])
    text = plan(ranks.rank_positions(counts, rows_per_bucket=500))
    assert text.count("Window [") == 1 and "SinglePartition" not in text


def test_statistics_stay_in_the_jvm_until_the_last_row(spark, sf_dir):
    text = plan(hypothesis.kruskal(table(spark, sf_dir, "lineitem"), ["l_quantity"], "l_returnflag"))
    assert text.count("ArrowEvalPython") == 1
    assert text.index("ArrowEvalPython") < text.index("HashAggregate")


def test_groups_are_counted_before_the_shuffle(spark, sf_dir):
    text = plan(QUERIES["a08_bar_counts"](spark, sf_dir))
    assert "partial_count(1)" in text


def test_density_shuffles_no_value(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem")
    text = plan(distribution.density(rows, ["l_extendedprice"], ["l_returnflag"]))
    exchanges = [line for line in text.split("\n") if "Exchange hashpartitioning" in line]
    assert exchanges and all("hashpartitioning(curve" in line for line in exchanges)


def test_large_groups_are_salted(spark, sf_dir):
    """Where no table of groups may be broadcast, rows go by group and salt, with the same results."""
    rows = table(spark, sf_dir, "lineitem")
    jobs = {
        "histogram": lambda: distribution.histogram(rows, ["l_quantity"], ["l_returnflag"]),
        "box": lambda: distribution.box_summary(rows, ["l_extendedprice"], ["l_returnflag"]),
        "outliers": lambda: distribution.box_outliers(rows, ["l_discount"], ["l_returnflag"]),
        "levene": lambda: hypothesis.levene(rows, ["l_quantity"], "l_returnflag"),
    }
    before = {name: sorted(map(tuple, job().collect())) for name, job in jobs.items()}
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for name, job in jobs.items():
            df = job()
            got = sorted(map(tuple, df.collect()))
            assert [r[:2] for r in got] == [r[:2] for r in before[name]]
            for one, other in zip(got, before[name]):
                assert all(a == b or abs(a - b) <= 1e-9 * abs(b) for a, b in zip(one, other) if isinstance(a, float))
        near = ranks.with_groups(
            ranks.long_form(rows, ["l_quantity"], ["l_returnflag"]), rows.select("l_returnflag").distinct(), ["l_returnflag"]
        )
        assert plan(near).count("Exchange hashpartitioning(l_returnflag") >= 2 and "salt" in plan(near)
        assert near.count() == rows.count()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)


def test_quartiles_read_written_rows_twice(spark, sf_dir):
    """Beside the sample: once for the sums and once for the values around the quartiles."""
    rows = table(spark, sf_dir, "lineitem")
    read = []

    def seen(df, label, own=ranks.materialize):
        read.append((label, plan(df).count(f"{sf_dir}/lineitem.parquet")))
        return own(df, label)

    ranks.materialize, before = seen, ranks.materialize
    try:
        profile.describe(rows, ["l_quantity", "l_tax"])
    finally:
        ranks.materialize = before
    assert dict(read)["bucket-cells"] == 1 and sum(count for _, count in read) == 2
