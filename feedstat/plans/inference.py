"""Registered queries on hypothesis tests.

The SQL checks use closed forms: F with two numerator degrees of freedom,
chi-square and t with an even number of degrees, and Simpson's rule for the
normal tail.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from feedstat.functions import normal
from feedstat.operators import association, hypothesis
from feedstat.plans.standins import observations, orders_by_weekend, table

TESTED = ["l_quantity", "l_extendedprice"]


def _rounded(tests, *columns):
    return tests.withColumns({c: F.round(c, 6) for c in columns or ("statistic", "p_value")})


def t_test(spark, sf_dir):
    return _rounded(hypothesis.t_test(orders_by_weekend(spark, sf_dir), ["o_totalprice"], "weekend", 0, 1))


def _orders(spark, sf_dir):
    return table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")


def shapiro(spark, sf_dir):
    tests = hypothesis.normality_of_groups(
        _orders(spark, sf_dir), ["o_totalprice"], "o_orderstatus", ["o_orderkey"], seed=7
    )
    return _rounded(tests)


def qq(spark, sf_dir):
    points = hypothesis.qq_points(observations(spark, sf_dir), ["l_quantity"], "l_returnflag")
    return _rounded(points, "normal_first", "normal_last", "line_first", "line_last")


def levene(spark, sf_dir):
    return _rounded(hypothesis.levene(observations(spark, sf_dir), TESTED, "l_returnflag"))


def anova(spark, sf_dir):
    return _rounded(hypothesis.anova(observations(spark, sf_dir), TESTED, "l_returnflag"))


def kruskal(spark, sf_dir):
    return _rounded(hypothesis.kruskal(observations(spark, sf_dir), TESTED, "l_returnflag"))


def chi_square(spark, sf_dir):
    rows = table(spark, sf_dir, "orders")
    return _rounded(hypothesis.chi_square_of(rows, "o_orderpriority", "o_orderstatus"))


def expected(spark, sf_dir):
    cells = association.contingency(table(spark, sf_dir, "orders"), "o_orderpriority", "o_orderstatus")
    table_ = association.expected_frequencies(cells, "o_orderpriority", "o_orderstatus")
    return _rounded(table_.drop("grand_total"), "expected")


def decided(spark, sf_dir):
    tests = hypothesis.kruskal(observations(spark, sf_dir), TESTED, "l_returnflag")
    return _rounded(hypothesis.verdict(tests))


def compared(spark, sf_dir):
    tests = hypothesis.compare_groups(
        _orders(spark, sf_dir), ["o_totalprice"], "o_orderstatus", ["o_orderkey"], seed=7
    )
    return _rounded(tests, "statistic", "p_value", "normality_p", "variance_p")


QUERIES = {
    "h01_t_test": t_test,
    "h02_shapiro": shapiro,
    "h03_qq_points": qq,
    "h04_levene": levene,
    "h04_anova": anova,
    "h05_kruskal": kruskal,
    "h06_chi_square": chi_square,
    "h06_expected": expected,
    "h07_verdict": decided,
    "h08_compare_groups": compared,
}

_LONG = " UNION ALL ".join(
    f"SELECT '{c}' AS variable, l_returnflag AS g, CAST({c} AS DOUBLE) AS value FROM lineitem"
    for c in TESTED
)

_T_TEST = """WITH m AS (
  SELECT CASE WHEN isodow(o_orderdate) >= 6 THEN 1 ELSE 0 END AS g, count(*) AS n,
         avg(o_totalprice) AS mean, var_samp(o_totalprice) AS v FROM orders GROUP BY 1),
s AS (SELECT a.n AS n0, b.n AS n1, a.n + b.n - 2 AS dof,
        (a.mean - b.mean) / sqrt(((a.n - 1) * a.v + (b.n - 1) * b.v) / (a.n + b.n - 2)
        * (1.0 / a.n + 1.0 / b.n)) AS t FROM m a, m b WHERE a.g = 0 AND b.g = 1),
terms AS (SELECT s.*, exp(sum(ln((2.0 * k - 1) / (2.0 * k))) OVER (ORDER BY k)
            + 2 * k * ln(cos(atan(abs(t) / sqrt(dof))))) AS term
          FROM s, LATERAL (SELECT unnest(range(1, dof // 2)) AS k)),
a AS (SELECT 1 + sum(term) AS total FROM terms)
SELECT 'o_totalprice' AS variable, CAST(n0 AS BIGINT) AS n_first, CAST(n1 AS BIGINT) AS n_second,
  CAST(dof AS BIGINT) AS dof, round(t, 6) AS statistic,
  round(1 - sin(atan(abs(t) / sqrt(dof))) * total, 6) AS p_value FROM s, a"""


def _variance_ratio_sql(values, long=_LONG):
    return f"""WITH long AS ({long}), z AS ({values}),
    g AS (SELECT variable, g, count(*) AS n, avg(z) AS m, var_samp(z) AS v FROM z GROUP BY 1, 2),
    c AS (SELECT variable, avg(z) AS centre, count(*) AS total FROM z GROUP BY 1),
    f AS (SELECT variable, count(*) AS k, max(total) AS total,
          (sum(n * (m - centre) ** 2) / (count(*) - 1)) / (sum((n - 1) * v) / (max(total) - count(*)))
          AS f FROM g JOIN c USING (variable) GROUP BY 1)
    SELECT variable, CAST(k AS BIGINT) AS k, CAST(total AS BIGINT) AS total,
      CAST(k - 1 AS BIGINT) AS dof_between, CAST(total - k AS BIGINT) AS dof_within,
      round(f, 6) AS statistic,
      round(pow((total - k) / (total - k + 2 * f), (total - k) / 2.0), 6) AS p_value FROM f"""


def _kruskal_sql(long):
    return f"""WITH long AS ({long}),
    r AS (SELECT *, rank() OVER (PARTITION BY variable ORDER BY value)
            + (count(*) OVER (PARTITION BY variable, value) - 1) / 2.0 AS rk,
            count(*) OVER (PARTITION BY variable, value) AS t FROM long),
    g AS (SELECT variable, g, count(*) AS n, avg(rk) AS m FROM r GROUP BY 1, 2),
    c AS (SELECT variable, CAST(count(*) AS DOUBLE) AS total,
          sum(CAST(t AS DOUBLE) ** 2 - 1) AS ties FROM r GROUP BY 1),
    h AS (SELECT variable, count(*) AS k, max(total) AS total,
          12 * sum(n * (m - (total + 1) / 2) ** 2) / (max(total) * (max(total) + 1))
          / (1 - max(ties) / (max(total) ** 3 - max(total))) AS h
          FROM g JOIN c USING (variable) GROUP BY 1)"""


_KRUSKAL_COLUMNS = """variable, CAST(k AS BIGINT) AS k, CAST(total AS BIGINT) AS total,
    CAST(k - 1 AS BIGINT) AS dof, round(h, 6) AS statistic, round(exp(-h / 2), 6) AS p_value"""

_EXPECTED = """WITH o AS (SELECT o_orderpriority AS r, o_orderstatus AS c, count(*) AS n FROM orders GROUP BY 1, 2),
e AS (SELECT r, c, n, CAST(sum(n) OVER (PARTITION BY r) AS DOUBLE) * sum(n) OVER (PARTITION BY c)
      / sum(n) OVER () AS e FROM o)"""


def _polynomial_sql(x, coefficients):
    text = repr(coefficients[0])
    for c in coefficients[1:]:
        text = f"({text} * {x} + {c!r})"
    return f"({text})"


def _inverse_normal_sql(p):
    def ratio(x, pair):
        return f"({_polynomial_sql(x, pair[0])} / {_polynomial_sql(x, pair[1])})"

    q, depth = f"({p} - 0.5)", f"sqrt(-ln(least({p}, 1.0 - {p})))"
    return f"""CASE WHEN abs({q}) <= 0.425 THEN {q} * {ratio(f"(0.180625 - {q} * {q})", normal.CENTRAL)}
        ELSE sign({q}) * CASE WHEN {depth} <= 5 THEN {ratio(f"({depth} - 1.6)", normal.MIDDLE)}
        ELSE {ratio(f"({depth} - 5.0)", normal.OUTER)} END END"""


_SHAPIRO = f"""WITH sample AS (SELECT o_orderstatus AS g, o_totalprice AS x FROM orders
  QUALIFY row_number() OVER (PARTITION BY o_orderstatus ORDER BY md5('7|' || o_orderkey), o_orderkey) <= 100),
placed AS (SELECT *, row_number() OVER (PARTITION BY g ORDER BY x) AS i,
  count(*) OVER (PARTITION BY g) AS n FROM sample),
prob AS (SELECT *, (i - 0.375::DOUBLE) / (n + 0.25::DOUBLE) AS p FROM placed),
scored AS (SELECT *, {_inverse_normal_sql("p")} AS m FROM prob),
norm AS (SELECT *, sum(m * m) OVER (PARTITION BY g) AS mm, 1 / sqrt(n) AS u,
  max(m) OVER (PARTITION BY g) AS m1,
  max(CASE WHEN i = n - 1 THEN m END) OVER (PARTITION BY g) AS m2 FROM scored),
ends AS (SELECT *,
  m1 / sqrt(mm) + 0.221157 * u - 0.147981 * u**2 - 2.071190 * u**3 + 4.434685 * u**4 - 2.706056 * u**5 AS a1,
  m2 / sqrt(mm) + 0.042981 * u - 0.293762 * u**2 - 1.752461 * u**3 + 5.682633 * u**4 - 3.582633 * u**5 AS a2
  FROM norm),
weights AS (SELECT *, CASE WHEN i = n THEN a1 WHEN i = n - 1 THEN a2 WHEN i = 1 THEN -a1 WHEN i = 2 THEN -a2
  ELSE m / sqrt((mm - 2 * m1**2 - 2 * m2**2) / (1 - 2 * a1**2 - 2 * a2**2)) END AS a FROM ends),
w AS (SELECT g, max(n) AS n, sum(a * x) ** 2 / (var_samp(x) * (max(n) - 1)) AS w FROM weights GROUP BY g),
z AS (SELECT *, (ln(1 - w) - (0.0038915 * ln(n)**3 - 0.083751 * ln(n)**2 - 0.31082 * ln(n) - 1.5861))
  / exp(0.0030302 * ln(n)**2 - 0.082676 * ln(n) - 0.4803) AS z FROM w),
area AS (SELECT g, sum(CASE WHEN i IN (0, 2000) THEN 1 WHEN i % 2 = 1 THEN 4 ELSE 2 END
  * exp(-((z * i / 2000.0)**2) / 2)) * z / 6000 / sqrt(2 * pi()) AS half
  FROM z, (SELECT unnest(range(2001)) AS i) GROUP BY g, z)
SELECT 'o_totalprice' AS variable, g AS o_orderstatus, CAST(n AS BIGINT) AS n, round(w, 6) AS statistic,
  round(0.5 - half, 6) AS p_value FROM z JOIN area USING (g)"""

_QQ = f"""WITH c AS (SELECT l_returnflag, l_quantity AS value, count(*) AS n FROM lineitem GROUP BY 1, 2),
line AS (SELECT l_returnflag, avg(l_quantity) AS mu, stddev_pop(l_quantity) AS sd, count(*) AS total
  FROM lineitem GROUP BY 1),
b AS (SELECT c.*, mu, sd, total, sum(n) OVER (PARTITION BY l_returnflag ORDER BY value) AS upto
  FROM c JOIN line USING (l_returnflag)),
p AS (SELECT *, CAST(upto - n + 1 AS BIGINT) AS first, CAST(upto AS BIGINT) AS last,
  CAST(upto - n + 1 AS DOUBLE) / (total + 1) AS p0, CAST(upto AS DOUBLE) / (total + 1) AS p1 FROM b),
q AS (SELECT *, {_inverse_normal_sql("p0")} AS z0, {_inverse_normal_sql("p1")} AS z1 FROM p)
SELECT 'l_quantity' AS variable, l_returnflag, value, CAST(n AS BIGINT) AS n, first AS "first", last AS "last",
  round(z0, 6) AS normal_first, round(z1, 6) AS normal_last,
  round(mu + sd * z0, 6) AS line_first, round(mu + sd * z1, 6) AS line_last FROM q"""

_DISTANCES = "SELECT variable, g, abs(value - median(value) OVER (PARTITION BY variable, g)) AS z FROM long"
_PRICES = "SELECT 'o_totalprice' AS variable, o_orderstatus AS g, o_totalprice AS value FROM orders"

ORACLES = {
    "h01_t_test": _T_TEST,
    "h02_shapiro": _SHAPIRO,
    "h03_qq_points": _QQ,
    "h04_levene": _variance_ratio_sql(_DISTANCES),
    "h04_anova": _variance_ratio_sql("SELECT variable, g, value AS z FROM long"),
    "h05_kruskal": f"{_kruskal_sql(_LONG)} SELECT {_KRUSKAL_COLUMNS} FROM h",
    "h06_chi_square": _EXPECTED + """,
        s AS (SELECT count(DISTINCT r) AS nr, count(DISTINCT c) AS nc, sum(n) AS total,
              sum((n - e) ** 2 / e) / 2 AS y FROM e)
        SELECT CAST(nr AS BIGINT) AS n_rows, CAST(nc AS BIGINT) AS n_columns,
          CAST(total AS BIGINT) AS total, CAST((nr - 1) * (nc - 1) AS BIGINT) AS dof,
          round(2 * y, 6) AS statistic,
          round(exp(-y) * (1 + y + y ** 2 / 2 + y ** 3 / 6), 6) AS p_value FROM s""",
    "h06_expected": _EXPECTED + """ SELECT r AS o_orderpriority, c AS o_orderstatus,
        CAST(n AS BIGINT) AS n, round(e, 6) AS expected FROM e""",
    "h07_verdict": f"""{_kruskal_sql(_LONG)} SELECT {_KRUSKAL_COLUMNS},
        CASE WHEN exp(-h / 2) < 0.05 THEN 'reject' ELSE 'fail to reject' END AS verdict FROM h""",
    "h08_compare_groups": f"""WITH tests AS ({_kruskal_sql(_PRICES)}
          SELECT variable, 'kruskal' AS test, round(h, 6) AS statistic, round(exp(-h / 2), 6) AS p_value,
          CASE WHEN exp(-h / 2) < 0.05 THEN 'reject' ELSE 'fail to reject' END AS verdict FROM h),
        normal AS (SELECT variable, min(p_value) AS normality_p FROM ({_SHAPIRO}) GROUP BY 1),
        equal AS (SELECT variable, p_value AS variance_p FROM ({_variance_ratio_sql(_DISTANCES, _PRICES)}))
        SELECT * FROM tests JOIN normal USING (variable) JOIN equal USING (variable)""",
}
