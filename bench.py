"""Times the headline queries; prints one JSON line."""

from __future__ import annotations

import json
import os
import time

from feedstat.plans.registry import all_queries
from feedstat.session import build_session

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
HEADLINES = [
    "a18_weekly_bars", "a18_weekly_bars_tied_dates", "w06_window_mean",
    "a02_distinct_counts", "a04_describe", "a07_category_counts", "a09_histogram", "a10_density",
    "a14_box_by_category", "a15_correlation", "a17_contingency", "a19_average_rank",
    "h01_t_test", "h02_shapiro", "h03_qq_points", "h04_levene", "h05_kruskal", "h06_chi_square",
    "l01_newest_files", "l03_sample_per_group", "q02_count_check",
    "s01_fixed_scan", "s05_member_rows", "k01_partitioned_write",
]


def run(query, spark) -> float:
    start = time.perf_counter()
    query(spark, SF_DIR).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    spark = build_session(
        "feedstat-bench", f"local[{CPUS}]",
        **{
            "spark.sql.shuffle.partitions": CPUS,
            "spark.driver.memory": "16g",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    queries = all_queries()
    for name in ("a18_weekly_bars", "h04_levene"):
        run(queries[name], spark)
    times = {name: round(run(queries[name], spark), 3) for name in HEADLINES}
    print(json.dumps({
        "metric": "headline_queries_total",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": SF_DIR.rstrip("/").rsplit("sf", 1)[-1],
    }))
    spark.stop()


if __name__ == "__main__":
    main()
