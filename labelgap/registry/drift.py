"""Original against synthetic: distributions and correlations."""

from pyspark.sql import functions as F

from labelgap.operators import correlation, drift, sampling
from labelgap.operators.synthesis import augment
from labelgap.registry.catalog import query
from labelgap.registry.features import rounded
from labelgap.registry.views import SIDE_COLUMNS, SIDES_SQL, sides, table

# Both distribution functions at every value, and the distance to the next value.
_STEPS_SQL = f"""
{SIDES_SQL},
counts AS (SELECT variable, value, sum((is_synthetic = 0)::INT) AS a, sum((is_synthetic = 1)::INT) AS b
           FROM side_values WHERE value IS NOT NULL GROUP BY variable, value),
steps AS (SELECT variable, value, lead(value) OVER w AS next_value,
  sum(a) OVER (w ROWS UNBOUNDED PRECEDING) / sum(a) OVER (PARTITION BY variable)::DOUBLE AS fa,
  sum(b) OVER (w ROWS UNBOUNDED PRECEDING) / sum(b) OVER (PARTITION BY variable)::DOUBLE AS fb
  FROM counts WINDOW w AS (PARTITION BY variable ORDER BY value)),
distances AS (SELECT variable, max(abs(fa - fb)) AS ks_statistic, sum(abs(fa - fb) * (next_value - value)) AS wasserstein
  FROM steps GROUP BY variable),
sizes AS (SELECT variable, sum(a)::DOUBLE AS n, sum(b)::DOUBLE AS m FROM counts GROUP BY variable),
scaled AS (SELECT *, round(n * m / (n + m)) AS size FROM distances JOIN sizes USING (variable)),
corrected AS (SELECT *, sqrt(size) * ks_statistic + 1 / (6 * sqrt(size)) + (sqrt(size) * ks_statistic - 1) / (4 * size) AS z FROM scaled),
tested AS (SELECT variable, n::BIGINT AS n_original, m::BIGINT AS n_synthetic, ks_statistic, CASE WHEN z <= 0.2 THEN 1.0::DOUBLE ELSE
  least(1.0::DOUBLE, greatest(0.0::DOUBLE, 2 * list_sum(list_transform(range(1, 101),
    lambda k: CASE WHEN k % 2 = 1 THEN 1.0::DOUBLE ELSE -1.0::DOUBLE END * exp(-2.0::DOUBLE * k * k * z * z))))) END AS ks_pvalue FROM corrected)
"""

_PSI_SQL = """
ranges AS (SELECT variable, min(value) AS lo, max(value) AS hi, sum((is_synthetic = 0)::INT) AS na,
                  sum((is_synthetic = 1)::INT) AS nb FROM side_values GROUP BY variable),
edges AS (SELECT variable, lo, hi, na, nb, unnest(range(1, 11)) AS bin FROM ranges),
bins AS (SELECT e.variable, e.bin, any_value(na) AS na, any_value(nb) AS nb,
    count_if(is_synthetic = 0) AS a, count_if(is_synthetic = 1) AS b
  FROM edges e JOIN side_values v ON e.variable = v.variable
    AND (bin = 1 OR (bin - 1)::DOUBLE * ((hi - lo) / 10) + lo <= value)
    AND (bin = 10 OR value < bin::DOUBLE * ((hi - lo) / 10) + lo)
  GROUP BY e.variable, e.bin),
filled AS (SELECT variable, CASE WHEN a = 0 THEN 0.0001::DOUBLE ELSE a / na::DOUBLE END AS p,
                  CASE WHEN b = 0 THEN 0.0001::DOUBLE ELSE b / nb::DOUBLE END AS q FROM bins),
stability AS (SELECT variable, sum((p - q) * ln(p / q)) AS psi FROM filled GROUP BY variable)
"""

_MOMENTS_SQL = """
moments AS (SELECT variable, avg(value) FILTER (is_synthetic = 0) AS original_mean,
  avg(value) FILTER (is_synthetic = 1) AS synthetic_mean, stddev_samp(value) FILTER (is_synthetic = 0) AS original_std,
  stddev_samp(value) FILTER (is_synthetic = 1) AS synthetic_std FROM side_values GROUP BY variable)
"""


@query("ks_statistic", f"WITH {_STEPS_SQL} SELECT variable, round(ks_statistic, 6) AS ks_statistic FROM distances")
def ks_statistic(spark, folder):
    found = drift.distribution_distances(drift.value_counts(drift.side_values(sides(spark, folder), SIDE_COLUMNS)))
    return rounded(found.select("variable", "ks_statistic"), "ks_statistic")


@query(
    "ks_pvalue",
    f"""WITH {_STEPS_SQL} SELECT variable, n_original, n_synthetic, round(ks_statistic, 6) AS ks_statistic,
        round(ks_pvalue, 6) AS ks_pvalue FROM tested""",
)
def ks_pvalue(spark, folder):
    return rounded(drift.ks_test(sides(spark, folder), SIDE_COLUMNS), "ks_statistic", "ks_pvalue")


_EXACT_SQL = """
WITH RECURSIVE halves AS (SELECT s_nationkey % 2 AS side, s_acctbal, s_suppkey::DOUBLE AS s_suppkey FROM supplier),
points AS (SELECT 's_acctbal' AS variable, side, s_acctbal AS value FROM halves UNION ALL SELECT 's_suppkey', side, s_suppkey FROM halves),
counts AS (SELECT variable, value, count_if(side = 0) AS a, count_if(side = 1) AS b FROM points GROUP BY 1, 2),
sums AS (SELECT variable, sum(a) OVER w AS a, sum(b) OVER w AS b, sum(a) OVER (PARTITION BY variable) AS n, sum(b) OVER (PARTITION BY variable) AS m
  FROM counts WINDOW w AS (PARTITION BY variable ORDER BY value)),
tests AS (SELECT variable, max(n)::BIGINT AS n, max(m)::BIGINT AS m, max(abs(a / n::DOUBLE - b / m::DOUBLE)) AS d FROM sums GROUP BY variable),
diagonals AS (
  SELECT variable, n, m, d, 0::BIGINT AS total, list_transform(range(0, n + 1), lambda i: 0.0::DOUBLE) AS reached FROM tests
  UNION ALL
  SELECT variable, n, m, d, total + 1, list_transform(range(0, n + 1), lambda i:
    CASE WHEN i > total + 1 OR total + 1 - i > m THEN 0.0::DOUBLE
         WHEN abs(i / n::DOUBLE - (total + 1 - i) / m::DOUBLE) >= d - 1e-9::DOUBLE THEN 1.0::DOUBLE
         ELSE ((CASE WHEN i > 0 THEN i * reached[i] ELSE 0 END) + (total + 1 - i) * reached[i + 1]) / (total + 1)::DOUBLE END)
  FROM diagonals WHERE total < n + m)
SELECT variable, n AS n_original, m AS n_synthetic, round(d, 6) AS ks_statistic, round(reached[n + 1], 6) AS ks_pvalue FROM diagonals WHERE total = n + m
"""


@query("ks_pvalue_exact", _EXACT_SQL)
def ks_pvalue_exact(spark, folder):
    """Suppliers of even against odd nations, every path counted."""
    halves = table(spark, folder, "supplier").select((F.col("s_nationkey") % 2).cast("int").alias("is_synthetic"), "s_acctbal", "s_suppkey")
    return rounded(drift.ks_test(halves, ["s_acctbal", "s_suppkey"], method="exact"), "ks_statistic", "ks_pvalue")


@query("wasserstein", f"WITH {_STEPS_SQL} SELECT variable, round(wasserstein, 6) AS wasserstein FROM distances")
def wasserstein(spark, folder):
    return rounded(drift.wasserstein(sides(spark, folder), SIDE_COLUMNS), "wasserstein")


@query("psi", f"WITH {SIDES_SQL}, {_PSI_SQL} SELECT variable, round(psi, 6) AS psi FROM stability")
def psi(spark, folder):
    return rounded(drift.psi(sides(spark, folder), SIDE_COLUMNS), "psi")


_MOMENT_COLUMNS = ["original_mean", "synthetic_mean", "original_std", "synthetic_std", "mean_diff", "std_diff"]
_MOMENT_SELECT = (
    "round(original_mean, 6) AS original_mean, round(synthetic_mean, 6) AS synthetic_mean, "
    "round(original_std, 6) AS original_std, round(synthetic_std, 6) AS synthetic_std, "
    "round(abs(original_mean - synthetic_mean), 6) AS mean_diff, round(abs(original_std - synthetic_std), 6) AS std_diff"
)


@query("moment_diff", f"WITH {SIDES_SQL}, {_MOMENTS_SQL} SELECT variable, {_MOMENT_SELECT} FROM moments")
def moment_diff(spark, folder):
    return rounded(drift.moment_differences(sides(spark, folder), SIDE_COLUMNS), *_MOMENT_COLUMNS)


@query(
    "stat_validation",
    f"""WITH {_STEPS_SQL}, {_PSI_SQL}, {_MOMENTS_SQL}
    SELECT variable, round(d.ks_statistic, 6) AS ks_statistic, round(ks_pvalue, 6) AS ks_pvalue, round(wasserstein, 6) AS wasserstein,
           round(psi, 6) AS psi, {_MOMENT_SELECT}
    FROM distances d JOIN tested USING (variable) JOIN stability USING (variable) JOIN moments USING (variable)""",
)
def stat_validation(spark, folder):
    report = drift.statistical_report(sides(spark, folder), [*SIDE_COLUMNS, "no_such_column"])
    return rounded(report, *[c for c in report.columns if c != "variable"])


@query(
    "stat_summary",
    f"""WITH {_STEPS_SQL}, {_PSI_SQL}
    SELECT variable, round(d.ks_statistic, 4) AS ks_statistic, round(ks_pvalue, 4) AS ks_pvalue, round(wasserstein, 4) AS wasserstein,
           round(psi, 4) AS psi
    FROM distances d JOIN tested USING (variable) JOIN stability USING (variable)""",
)
def stat_summary(spark, folder):
    return drift.report_summary(drift.statistical_report(sides(spark, folder), SIDE_COLUMNS))


@query(
    "band_labels",
    """WITH bands AS (SELECT
      CASE WHEN l_discount * 3 < 0.1 THEN 'very stable' WHEN l_discount * 3 <= 0.25 THEN 'slight drift' ELSE 'large drift' END AS psi_band,
      CASE WHEN l_tax * 3 < 0.1 THEN 'well kept' WHEN l_tax * 3 <= 0.2 THEN 'partly kept' ELSE 'much changed' END AS correlation_band,
      CASE WHEN l_quantity / 50 < 0.55 THEN 'very similar' WHEN l_quantity / 50 < 0.65 THEN 'fairly similar'
           ELSE 'distinguishable' END AS verdict FROM lineitem)
    SELECT psi_band, correlation_band, verdict, count(*) AS n FROM bands GROUP BY ALL""",
)
def band_labels(spark, folder):
    return (
        table(spark, folder, "lineitem")
        .groupBy(
            drift.psi_band(F.col("l_discount") * 3).alias("psi_band"),
            drift.correlation_band(F.col("l_tax") * 3).alias("correlation_band"),
            drift.auroc_verdict(F.col("l_quantity") / 50).alias("verdict"),
        )
        .agg(F.count(F.lit(1)).alias("n"))
    )


def _corr_sql(side):
    cells = []
    for a in SIDE_COLUMNS:
        for b in SIDE_COLUMNS:
            r = f"max(1.0::DOUBLE) FILTER (is_synthetic = {side})"
            if a != b:
                r = f"corr({min(a, b)}, {max(a, b)}) FILTER (is_synthetic = {side})"
            cells.append(f"SELECT '{a}' AS var_a, '{b}' AS var_b, {r} AS r FROM sides")
    return " UNION ALL ".join(cells)


_MATRICES_SQL = f"{SIDES_SQL}, original AS ({_corr_sql(0)}), synthetic AS ({_corr_sql(1)})"


@query("corr_matrix", f"WITH {_MATRICES_SQL} SELECT var_a, var_b, round(r, 6) AS r FROM original")
def corr_matrix(spark, folder):
    original = drift.take_side(sides(spark, folder), synthetic=False)
    return rounded(correlation.correlation_matrix(original, SIDE_COLUMNS), "r")


@query(
    "corr_diff",
    f"""WITH {_MATRICES_SQL} SELECT var_a, var_b, round(o.r, 6) AS original, round(s.r, 6) AS synthetic,
    round(o.r - s.r, 6) + 0.0 AS difference FROM original o JOIN synthetic s USING (var_a, var_b)""",
)
def corr_diff(spark, folder):
    found = rounded(correlation.correlation_differences(sides(spark, folder), SIDE_COLUMNS), "original", "synthetic", "difference")
    return found.withColumn("difference", F.col("difference") + 0.0)


_RANKED = " UNION ALL ".join(
    f"SELECT is_synthetic, '{a}' AS var_a, '{b}' AS var_b, count(*) AS n_rows, round(corr(r_{a}, r_{b}), 6) AS r FROM ranked GROUP BY is_synthetic"
    for i, a in enumerate(SIDE_COLUMNS) for b in SIDE_COLUMNS[i + 1 :]
)
_RANKS = ", ".join(
    f"rank() OVER (PARTITION BY is_synthetic ORDER BY {c}) + (count(*) OVER (PARTITION BY is_synthetic, {c}) - 1) / 2.0::DOUBLE AS r_{c}" for c in SIDE_COLUMNS
)


@query("rank_correlation", f"WITH {SIDES_SQL}, ranked AS (SELECT is_synthetic, {_RANKS} FROM sides) {_RANKED}")
def rank_correlation(spark, folder):
    return rounded(correlation.rank_correlations(sides(spark, folder), SIDE_COLUMNS, ["is_synthetic"]), "r")


_PAIRS = [("l_quantity", "l_extendedprice"), ("l_discount", "l_tax"), ("l_discount", "no_such_column")]


@query(
    "corr_pairs",
    f"""WITH {_MATRICES_SQL} SELECT var_a || ' - ' || var_b AS variable_pair, round(o.r, 6) AS original,
    round(s.r, 6) AS synthetic, round(abs(o.r - s.r), 6) AS difference
    FROM original o JOIN synthetic s USING (var_a, var_b)
    WHERE (var_a, var_b) IN (('l_quantity', 'l_extendedprice'), ('l_discount', 'l_tax'))""",
)
def corr_pairs(spark, folder):
    found = correlation.key_pair_comparison(sides(spark, folder), SIDE_COLUMNS, _PAIRS)
    return rounded(found, "original", "synthetic", "difference")


@query(
    "provenance_split",
    "SELECT l_quantity, l_extendedprice, l_discount, l_tax + 0.0 AS l_tax FROM lineitem WHERE l_returnflag <> 'R'",
)
def provenance_split(spark, folder):
    return drift.take_side(sides(spark, folder), synthetic=False).withColumn("l_tax", F.col("l_tax") + 0.0)


@query(
    "augment_union",
    """SELECT o_orderkey, o_totalprice, CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS is_synthetic FROM orders""",
)
def augment_union(spark, folder):
    orders = table(spark, folder, "orders")
    real = orders.filter("o_orderstatus <> 'F'").select("o_orderkey", "o_totalprice")
    made = orders.filter("o_orderstatus = 'F'").select("o_totalprice", "o_orderkey")
    return augment(real, made)


@query(
    "balanced_sample",
    """WITH sides AS (SELECT o_orderkey, (o_orderstatus = 'F')::INT AS is_synthetic FROM orders),
    ranked AS (SELECT *, row_number() OVER (PARTITION BY is_synthetic ORDER BY md5(o_orderkey || '|42')) AS place FROM sides)
    SELECT o_orderkey, is_synthetic FROM ranked
    WHERE place <= (SELECT min(n) FROM (SELECT count(*) AS n FROM sides GROUP BY is_synthetic))""",
)
def balanced_sample(spark, folder):
    labelled = table(spark, folder, "orders").select(
        "o_orderkey", (F.col("o_orderstatus") == "F").cast("int").alias("is_synthetic")
    )
    return sampling.balanced_sample(labelled, "is_synthetic", "o_orderkey")


@query(
    "shuffle_export",
    "SELECT o_orderkey, o_totalprice FROM orders ORDER BY md5(o_orderkey || '|42')",
)
def shuffle_export(spark, folder):
    return sampling.shuffled(table(spark, folder, "orders").select("o_orderkey", "o_totalprice"), "o_orderkey")
