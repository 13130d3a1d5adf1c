"""Registered queries on profiles, distributions and association."""

from __future__ import annotations

from pyspark.sql import functions as F

from feedstat.operators import association, distribution, profile, ranks
from feedstat.plans.standins import CATEGORIES, MEASURES, observations, table

HISTOGRAM_COLUMNS = [*MEASURES, "l_linenumber"]


def _lineitem(spark, sf_dir):
    return table(spark, sf_dir, "lineitem")


def table_shape(spark, sf_dir):
    return profile.shape(_lineitem(spark, sf_dir))


def distinct(spark, sf_dir):
    return profile.distinct_counts(_lineitem(spark, sf_dir))


def missing(spark, sf_dir):
    rows = _lineitem(spark, sf_dir).select(
        "l_orderkey", "l_quantity",
        F.when(F.col("l_discount") != 0, F.col("l_discount")).alias("l_discount"),
        F.when(F.col("l_tax") == 0, F.lit(float("nan"))).otherwise(F.col("l_tax")).alias("l_tax"),
        F.when(F.col("l_returnflag") != "R", F.col("l_returnflag")).alias("l_returnflag"),
    )
    return profile.null_counts(rows)


def _described(rows_per_bucket):
    def query(spark, sf_dir):
        rows = profile.describe(observations(spark, sf_dir), MEASURES, rows_per_bucket)
        return rows.select("variable", "count", *[
            F.round(c, 6).alias(c) for c in ("mean", "std", "min", "q25", "q50", "q75", "max")
        ])
    return query


def info(spark, sf_dir):
    return profile.column_info(_lineitem(spark, sf_dir))


def flags(spark, sf_dir):
    return profile.distinct_values(_lineitem(spark, sf_dir), "l_returnflag")


def categories(spark, sf_dir):
    return profile.category_counts(_lineitem(spark, sf_dir), [*CATEGORIES, "l_linenumber"])


def bars(spark, sf_dir):
    return profile.bar_counts(table(spark, sf_dir, "orders"), "o_orderpriority")


def _show_bins(bins):
    return bins.withColumns({c: F.round(c, 6) for c in ("bin_left", "bin_right")})


def binned(spark, sf_dir):
    return _show_bins(distribution.histogram(_lineitem(spark, sf_dir), HISTOGRAM_COLUMNS))


def binned_by_hue(spark, sf_dir):
    rows = table(spark, sf_dir, "events")
    return _show_bins(distribution.histogram(rows, ["value"], hue="event_type"))


def _logs(spark, sf_dir):
    return distribution.log_values(table(spark, sf_dir, "orders"), "o_totalprice")


def binned_logs(spark, sf_dir):
    return _show_bins(distribution.histogram(_logs(spark, sf_dir), ["o_totalprice"], by=["o_orderstatus"]))


def _show_density(curve):
    return curve.withColumns({"x": F.round("x", 6), "density": F.round("density", 9)})


def densities(spark, sf_dir):
    return _show_density(distribution.density(observations(spark, sf_dir), MEASURES))


def log_densities(spark, sf_dir):
    return _show_density(
        distribution.density(_logs(spark, sf_dir), ["o_totalprice"], by=["o_orderstatus"])
    )


def _show_box(boxes):
    return boxes.withColumns({
        c: F.round(c, 6) for c in ("q1", "median", "q3", "whisker_low", "whisker_high")
    })


def boxes(spark, sf_dir):
    return _show_box(distribution.box_summary(observations(spark, sf_dir), MEASURES))


def outliers(spark, sf_dir):
    return distribution.box_outliers(table(spark, sf_dir, "events"), ["value"])


def boxes_by_category(spark, sf_dir):
    return _show_box(distribution.box_summary(table(spark, sf_dir, "events"), ["value"], ["event_type"]))


def correlations(spark, sf_dir):
    matrix = association.correlation_matrix(observations(spark, sf_dir), MEASURES)
    return matrix.withColumn("r", F.round("r", 9))


def variances(spark, sf_dir):
    groups = association.group_variances(observations(spark, sf_dir), ["l_quantity"], "l_returnflag")
    return groups.withColumn("variance", F.round("variance", 6))


def crosstab(spark, sf_dir):
    return association.contingency(table(spark, sf_dir, "documents"), "source", "lang")


def crosstab_numeric(spark, sf_dir):
    return association.contingency(table(spark, sf_dir, "lineitem"), "l_discount", "l_returnflag")


def crosstab_wide(spark, sf_dir):
    rows = table(spark, sf_dir, "orders")
    return association.contingency_wide(rows, "o_orderpriority", "o_orderstatus", ["F", "O", "P"])


def _ranked(rows_per_bucket):
    def query(spark, sf_dir):
        counts = ranks.value_counts(observations(spark, sf_dir), ["l_quantity", "l_extendedprice"])
        ranked = ranks.rank_positions(counts, rows_per_bucket=rows_per_bucket)
        return ranked.select("variable", "value", "n", ranks.average_rank().alias("average_rank"))
    return query


QUERIES = {
    "a01_shape": table_shape,
    "a02_distinct_counts": distinct,
    "a03_null_counts": missing,
    "a04_describe": _described(ranks.ROWS_PER_BUCKET),
    "a04_describe_bucketed": _described(5_000),
    "a05_column_info": info,
    "a06_distinct_values": flags,
    "a07_category_counts": categories,
    "a08_bar_counts": bars,
    "a09_histogram": binned,
    "a10_density": densities,
    "a11_histogram_by_hue": binned_by_hue,
    "a12_log_histogram": binned_logs,
    "a12_log_density": log_densities,
    "a13_box_summary": boxes,
    "a13_box_outliers": outliers,
    "a14_box_by_category": boxes_by_category,
    "a15_correlation": correlations,
    "a16_group_variance": variances,
    "a17_contingency": crosstab,
    "a17_contingency_numeric": crosstab_numeric,
    "a17_contingency_wide": crosstab_wide,
    "a19_average_rank": _ranked(ranks.ROWS_PER_BUCKET),
    "a19_average_rank_bucketed": _ranked(5_000),
}

_COLUMNS = {
    "l_orderkey": "bigint", "l_partkey": "bigint", "l_suppkey": "bigint", "l_linenumber": "int",
    "l_quantity": "double", "l_extendedprice": "double", "l_discount": "double", "l_tax": "double",
    "l_returnflag": "string", "l_linestatus": "string", "l_shipdate": "timestamp_ntz",
}


def _union(template, columns):
    return " UNION ALL ".join(template.format(c=c, t=_COLUMNS.get(c)) for c in columns)


_LONG = _union("SELECT '{c}' AS variable, CAST({c} AS DOUBLE) AS value FROM lineitem", MEASURES)


def _histogram_sql(long, keys, hue="", whole=()):
    """Histogram of a (keys, hue, value) table with bins of its own per ``keys``."""
    names = ", ".join(keys)
    split = f", {hue}" if hue else ""
    integer = f"WHEN variable IN ({', '.join(repr(w) for w in whole)}) THEN greatest(w, 1.0)" if whole else ""
    pair = " AND ".join(f"b.{k} = e.{k}" for k in [*keys, *([hue] if hue else [])])
    return f"""WITH long AS ({long}),
    s AS (SELECT {names}, count(*) AS total, min(value) AS mn, max(value) AS mx,
          quantile_cont(value, 0.25) AS q25, quantile_cont(value, 0.75) AS q75
          FROM long GROUP BY {names}),
    w AS (SELECT *, (mx - mn) / (log2(CAST(total AS DOUBLE)) + 1) AS st,
          2 * (q75 - q25) / pow(CAST(total AS DOUBLE), 1.0 / 3) AS fd FROM s),
    v AS (SELECT *, least(greatest(fd, (mx - mn) / sqrt(CAST(total AS DOUBLE)) / 2), st) AS w FROM w),
    layout AS (SELECT {names},
          CASE WHEN mx = mn THEN mn - 0.5 ELSE mn END AS low,
          CASE WHEN mx = mn THEN mx + 0.5 ELSE mx END AS high,
          CASE WHEN mx = mn THEN 1 ELSE
            CAST(ceil((mx - mn) / (CASE {integer} WHEN true THEN w END)) AS BIGINT) END AS bins FROM v),
    edges AS (SELECT l.{', l.'.join(keys)}{', h.' + hue if hue else ''}, i AS bin,
          low + i * ((high - low) / bins) AS bin_left, low + (i + 1) * ((high - low) / bins) AS bin_right,
          i = bins - 1 AS is_last
          FROM layout l {'JOIN (SELECT DISTINCT ' + names + ', ' + hue + ' FROM long) h USING (' + names + ')' if hue else ''},
          LATERAL (SELECT unnest(range(bins)) AS i)),
    counted AS (SELECT {names}{split}, value, count(*) AS k FROM long GROUP BY ALL)
    SELECT e.{', e.'.join(keys)}{', e.' + hue if hue else ''}, CAST(e.bin AS BIGINT) AS bin,
      round(e.bin_left, 6) AS bin_left, round(e.bin_right, 6) AS bin_right,
      CAST(coalesce(sum(b.k), 0) AS BIGINT) AS n
    FROM edges e LEFT JOIN counted b ON {pair} AND b.value >= e.bin_left
      AND (b.value < e.bin_right OR e.is_last)
    GROUP BY ALL"""


def _density_sql(long, keys):
    names = ", ".join(keys)
    return f"""WITH long AS ({long}),
    g AS (SELECT {names}, count(*) AS total, stddev_samp(value) AS sd, min(value) AS mn,
          max(value) AS mx FROM long GROUP BY {names}),
    h AS (SELECT {names}, total, sd * pow(CAST(total AS DOUBLE), -0.2) AS bw, mn,
          (mx - mn) / 199 AS step FROM g),
    c AS (SELECT {names}, value, count(*) AS n FROM long GROUP BY ALL)
    SELECT {names}, CAST(i AS INTEGER) AS point, round(mn + i * step, 6) AS x,
      round(sum(n * exp(-((value - (mn + i * step)) ** 2) / (2 * bw * bw)))
        / (total * bw * sqrt(2 * pi())), 9) AS density
    FROM c JOIN h USING ({names}), (SELECT unnest(range(200)) AS i)
    GROUP BY {names}, i, mn, step, total, bw"""


def _box_sql(long, keys):
    names = ", ".join(keys)
    return f"""WITH long AS ({long}),
    q AS (SELECT {names}, quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.5) AS median,
          quantile_cont(value, 0.75) AS q3 FROM long GROUP BY {names}),
    r AS (SELECT long.*, q1, median, q3, value BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)
          AS inside FROM long JOIN q USING ({names}))
    SELECT {names}, CAST(count(*) AS BIGINT) AS n, round(q1, 6) AS q1, round(median, 6) AS median,
      round(q3, 6) AS q3, round(least(min(value) FILTER (inside), q1), 6) AS whisker_low,
      round(greatest(max(value) FILTER (inside), q3), 6) AS whisker_high,
      CAST(count(*) FILTER (NOT inside) AS BIGINT) AS n_outliers
    FROM r GROUP BY {names}, q1, median, q3"""


_EVENT_VALUES = "SELECT 'value' AS variable, event_type, value FROM events"
_LOGS = "SELECT 'o_totalprice' AS variable, o_orderstatus, ln(o_totalprice) AS value FROM orders"
_AVERAGE_RANK = f"""WITH long AS ({_LONG}),
    c AS (SELECT variable, value, count(*) AS n FROM long
          WHERE variable IN ('l_quantity', 'l_extendedprice') GROUP BY ALL)
    SELECT variable, value, CAST(n AS BIGINT) AS n,
      sum(n) OVER (PARTITION BY variable ORDER BY value) - n + (n + 1) / 2.0 AS average_rank FROM c"""

_DESCRIBE = f"""SELECT variable, CAST(count(*) AS BIGINT) AS count, round(avg(value), 6) AS mean,
        round(stddev_samp(value), 6) AS std, min(value) AS min,
        round(quantile_cont(value, 0.25), 6) AS q25, round(quantile_cont(value, 0.5), 6) AS q50,
        round(quantile_cont(value, 0.75), 6) AS q75, max(value) AS max
        FROM ({_LONG}) GROUP BY variable"""

ORACLES = {
    "a01_shape": "SELECT CAST(count(*) AS BIGINT) AS n_rows, CAST(11 AS BIGINT) AS n_columns FROM lineitem",
    "a02_distinct_counts": _union(
        "SELECT '{c}' AS variable, CAST(count(DISTINCT {c}) AS BIGINT) AS n_distinct FROM lineitem", _COLUMNS
    ),
    "a03_null_counts": " UNION ALL ".join(
        f"SELECT '{c}' AS variable, CAST(count(*) FILTER ({test}) AS BIGINT) AS n_missing FROM lineitem"
        for c, test in {
            "l_orderkey": "false", "l_quantity": "false", "l_discount": "l_discount = 0",
            "l_tax": "l_tax = 0", "l_returnflag": "l_returnflag = 'R'",
        }.items()
    ),
    "a04_describe": _DESCRIBE,
    "a04_describe_bucketed": _DESCRIBE,
    "a05_column_info": _union(
        "SELECT '{c}' AS variable, CAST(count({c}) AS BIGINT) AS n_present, '{t}' AS type FROM lineitem",
        _COLUMNS,
    ),
    "a06_distinct_values": "SELECT DISTINCT l_returnflag FROM lineitem",
    "a07_category_counts": _union(
        "SELECT '{c}' AS variable, CAST({c} AS VARCHAR) AS value, CAST(count(*) AS BIGINT) AS n "
        "FROM lineitem GROUP BY 2",
        [*CATEGORIES, "l_linenumber"],
    ),
    "a08_bar_counts": "SELECT o_orderpriority, CAST(count(*) AS BIGINT) AS n FROM orders GROUP BY 1",
    "a09_histogram": _histogram_sql(
        _union("SELECT '{c}' AS variable, CAST({c} AS DOUBLE) AS value FROM lineitem", HISTOGRAM_COLUMNS),
        ["variable"], whole=["l_linenumber"],
    ),
    "a10_density": _density_sql(_LONG, ["variable"]),
    "a11_histogram_by_hue": _histogram_sql(_EVENT_VALUES, ["variable"], hue="event_type"),
    "a12_log_histogram": _histogram_sql(_LOGS, ["variable", "o_orderstatus"]),
    "a12_log_density": _density_sql(_LOGS, ["variable", "o_orderstatus"]),
    "a13_box_summary": _box_sql(_LONG, ["variable"]),
    "a13_box_outliers": """WITH q AS (SELECT quantile_cont(value, 0.25) AS q1,
        quantile_cont(value, 0.75) AS q3 FROM events)
        SELECT 'value' AS variable, value, CAST(count(*) AS BIGINT) AS n FROM events, q
        WHERE value NOT BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1) GROUP BY 2""",
    "a14_box_by_category": _box_sql(_EVENT_VALUES, ["variable", "event_type"]),
    "a15_correlation": " UNION ALL ".join(
        f"SELECT '{a}' AS variable_x, '{b}' AS variable_y, round(corr({a}, {b}), 9) AS r FROM lineitem"
        for a in MEASURES for b in MEASURES
    ),
    "a16_group_variance": """SELECT 'l_quantity' AS variable, l_returnflag,
        round(var_samp(l_quantity), 6) AS variance FROM lineitem GROUP BY 2""",
    "a17_contingency": """SELECT r.source, c.lang, CAST(count(d.doc_id) AS BIGINT) AS n
        FROM (SELECT DISTINCT source FROM documents) r CROSS JOIN (SELECT DISTINCT lang FROM documents) c
        LEFT JOIN documents d ON d.source = r.source AND d.lang = c.lang GROUP BY 1, 2""",
    "a17_contingency_numeric": """SELECT r.l_discount, c.l_returnflag, CAST(count(l.l_orderkey) AS BIGINT) AS n
        FROM (SELECT DISTINCT l_discount FROM lineitem) r CROSS JOIN (SELECT DISTINCT l_returnflag FROM lineitem) c
        LEFT JOIN lineitem l ON l.l_discount = r.l_discount AND l.l_returnflag = c.l_returnflag GROUP BY 1, 2""",
    "a17_contingency_wide": """SELECT o_orderpriority,
        CAST(count(*) FILTER (o_orderstatus = 'F') AS BIGINT) AS F,
        CAST(count(*) FILTER (o_orderstatus = 'O') AS BIGINT) AS O,
        CAST(count(*) FILTER (o_orderstatus = 'P') AS BIGINT) AS P FROM orders GROUP BY 1""",
    "a19_average_rank": _AVERAGE_RANK,
    "a19_average_rank_bucketed": _AVERAGE_RANK,
}
