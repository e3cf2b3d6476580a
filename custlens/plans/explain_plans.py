"""Plans for contribution tables with an exact oracle.

The contribution table here is a deterministic linear attribution,
coef * z(x) over population-standardised window features of every
labelled customer-month, with a fixed base score — the same arrays
as tree contributions, but expressible in SQL, so every downstream
explanation operator can be checked value by value.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import explain as ex
from .features_plans import FEATURES_RAW_SQL, raw_features
from .registry import plan, rnd, rsql

# Fixed coefficients of the linear attribution (per standardised feature).
COEFS = {
    "total_assets": 0.9,
    "asset_growth_rate": 0.3,
    "asset_mom_change": 0.2,
    "total_assets_rolling_mean": 0.5,
    "total_assets_rolling_std": -0.2,
    "financial_balance_rolling_mean": 0.1,
}
BASE = -1.5
KEYS = ["customer_id", "stat_month"]


def contributions(spark, sf):
    f = raw_features(spark, sf)
    return ex.linear_contributions(f, KEYS, COEFS, BASE)


def _contrib_sql() -> str:
    stats = ", ".join(f"avg({c}) AS m_{c}, stddev_pop({c}) AS s_{c}" for c in COEFS)
    parts = " UNION ALL ".join(
        f"SELECT customer_id, stat_month, '{c}' AS feature, CAST({c} AS DOUBLE) AS value, "
        f"{v!r} * (({c} - m_{c}) / CASE WHEN s_{c} = 0 OR s_{c} IS NULL THEN 1.0 ELSE s_{c} END) AS contribution, "
        f"{BASE!r} AS base_score FROM f, m" for c, v in COEFS.items())
    return f"WITH f AS ({FEATURES_RAW_SQL}), m AS (SELECT {stats} FROM f) {parts}"


C = f"({_contrib_sql()})"


@plan("contribution_summary", f"""
SELECT feature, {rsql('avg(contribution)', 6)} AS average_contribution,
       {rsql('stddev_pop(contribution)', 6)} AS std_contribution,
       {rsql('avg(CAST(contribution > 0 AS DOUBLE))', 6)} AS positive_contrib_ratio
FROM {C} c GROUP BY feature""", "explain")
def contribution_summary(spark, sf):
    """Mean, population std and positive share per feature."""
    s = ex.contribution_summary(contributions(spark, sf))
    return s.select("feature", rnd("average_contribution", 6).alias("average_contribution"),
                    rnd("std_contribution", 6).alias("std_contribution"),
                    rnd("positive_contrib_ratio", 6).alias("positive_contrib_ratio"))


@plan("mean_abs_contribution", f"SELECT feature, {rsql('avg(abs(contribution))', 6)} AS avg_abs_contrib "
      f"FROM {C} c GROUP BY feature", "explain")
def mean_abs_contribution(spark, sf):
    """Global importance = mean |contribution|."""
    m = ex.mean_abs_contribution(contributions(spark, sf))
    return m.select("feature", rnd("avg_abs_contrib", 6).alias("avg_abs_contrib"))


@plan("pos_neg_totals", f"""
SELECT customer_id, stat_month, {rsql('sum(CASE WHEN contribution > 0 THEN contribution ELSE 0.0 END)', 6)} AS positive_total,
       {rsql('sum(CASE WHEN contribution < 0 THEN contribution ELSE 0.0 END)', 6)} AS negative_total
FROM {C} c GROUP BY 1, 2""", "explain")
def pos_neg_totals(spark, sf):
    """Per row, sum of positive and of negative contributions."""
    t = ex.pos_neg_totals(contributions(spark, sf), KEYS)
    return t.select(*KEYS, rnd("positive_total", 6).alias("positive_total"),
                    rnd("negative_total", 6).alias("negative_total"))


@plan("normalized_contribution", f"""
SELECT customer_id, stat_month, feature,
       {rsql('coalesce(contribution / nullif(sum(abs(contribution)) OVER (PARTITION BY customer_id, stat_month), 0), 0.0)', 6)} AS normalized_contribution
FROM {C} c""", "explain")
def normalized_contribution(spark, sf):
    """contribution / Σ|contribution| of the row (0 when the sum is 0)."""
    n = ex.normalized(contributions(spark, sf), KEYS)
    return n.select(*KEYS, "feature", rnd("normalized_contribution", 6).alias("normalized_contribution"))


@plan("top_contrib_per_row", f"""
SELECT customer_id, stat_month, feature, {rsql('contribution', 6)} AS contribution, CAST(rk AS INTEGER) AS rank
FROM (SELECT *, row_number() OVER (PARTITION BY customer_id, stat_month ORDER BY abs(contribution) DESC, feature) AS rk
      FROM {C} c) x WHERE rk <= 3""", "explain")
def top_contrib_per_row(spark, sf):
    """The three largest |contribution| per row."""
    t = ex.top_per_row(contributions(spark, sf), KEYS, 3)
    return t.select(*KEYS, "feature", rnd("contribution", 6).alias("contribution"),
                    F.col("rank").cast("int").alias("rank"))


@plan("waterfall", f"""
WITH t AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY customer_id, stat_month
                                                      ORDER BY abs(contribution) DESC, feature) AS rk FROM {C} c) x
           WHERE rk <= 15),
s AS (SELECT *, row_number() OVER w AS step, base_score + sum(contribution) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS rt
      FROM t WINDOW w AS (PARTITION BY customer_id, stat_month
                          ORDER BY CAST(contribution >= 0 AS INTEGER), contribution, feature))
SELECT customer_id, stat_month, feature, CAST(step AS INTEGER) AS step, {rsql('rt', 6)} AS running_total,
       {rsql('1.0 / (1.0 + exp(-rt))', 6)} AS running_probability
FROM s""", "explain")
def waterfall(spark, sf):
    """Base, negatives ascending, positives ascending; running total."""
    w = ex.waterfall(contributions(spark, sf), KEYS, 15)
    return w.select(*KEYS, "feature", F.col("step").cast("int").alias("step"),
                    rnd("running_total", 6).alias("running_total"),
                    rnd("running_probability", 6).alias("running_probability"))


SCORED = f"""
SELECT customer_id, stat_month, CAST(1.0 / (1.0 + exp(-(any_value(base_score) + sum(contribution)))) > 0.5 AS INTEGER) AS predicted
FROM {C} c GROUP BY 1, 2
"""


def _scored(spark, sf):
    c = contributions(spark, sf)
    return c.select(*KEYS, (F.lit(1.0) / (F.lit(1.0) + F.exp(-ex.margin())) > 0.5).cast("int").alias("predicted"))


@plan("sample_per_class", f"""
SELECT customer_id, stat_month, predicted FROM ({SCORED}) s
QUALIFY row_number() OVER (PARTITION BY predicted ORDER BY customer_id, stat_month) <= 3""", "explain")
def sample_per_class(spark, sf):
    """W11 + U3: first three rows per predicted class in key order."""
    return ex.first_n_per_class(_scored(spark, sf), "predicted", KEYS, 3).select(*KEYS, "predicted")


@plan("mean_deviation_explain", f"""
WITH f AS ({FEATURES_RAW_SQL}),
s AS (SELECT customer_id, stat_month FROM f WHERE target_high_value IN (0, 1)
      QUALIFY row_number() OVER (PARTITION BY target_high_value ORDER BY customer_id, stat_month) <= 1),
m AS (SELECT avg(total_assets) AS m1, avg(asset_growth_rate) AS m2, avg(total_assets_rolling_mean) AS m3 FROM f),
x AS (SELECT f.* FROM f JOIN s ON f.customer_id = s.customer_id AND f.stat_month = s.stat_month)
SELECT customer_id, stat_month, 'total_assets' AS feature, {rsql('total_assets - m1', 4)} AS deviation,
       CASE WHEN total_assets > m1 THEN 'positive' ELSE 'negative' END AS direction FROM x, m
UNION ALL
SELECT customer_id, stat_month, 'asset_growth_rate', {rsql('asset_growth_rate - m2', 4)},
       CASE WHEN asset_growth_rate > m2 THEN 'positive' ELSE 'negative' END FROM x, m
UNION ALL
SELECT customer_id, stat_month, 'total_assets_rolling_mean', {rsql('total_assets_rolling_mean - m3', 4)},
       CASE WHEN total_assets_rolling_mean > m3 THEN 'positive' ELSE 'negative' END FROM x, m""", "explain")
def mean_deviation_explain(spark, sf):
    """X13 + X14: one example per actual class; key features as value
    minus column mean, labelled above/below."""
    f = raw_features(spark, sf)
    cols = ["total_assets", "asset_growth_rate", "total_assets_rolling_mean"]
    dev = ex.mean_deviation(f, KEYS, cols)
    sample = ex.first_n_per_class(f, "target_high_value", KEYS, 1).select(*KEYS)
    return dev.join(F.broadcast(sample), KEYS).select(*KEYS, "feature", rnd("deviation", 4).alias("deviation"),
                                                      "direction")


CORR_COLS = ["total_assets", "asset_growth_rate", "asset_mom_change", "asset_cumulative_growth",
             "total_assets_rolling_mean", "total_assets_rolling_std", "fund_balance_rolling_mean"]
CORR_SQL = f"WITH f AS ({FEATURES_RAW_SQL}) " + " UNION ALL ".join(
    f"SELECT '{c}' AS feature, {rsql(f'corr(CAST({c} AS DOUBLE), CAST(target_high_value AS DOUBLE))', 6)} AS correlation FROM f"
    for c in CORR_COLS)


@plan("corr_with_target", CORR_SQL, "explain")
def corr_with_target(spark, sf):
    """Pearson correlation of each feature with the label."""
    c = ex.corr_with_target(raw_features(spark, sf), CORR_COLS, "target_high_value")
    return c.select("feature", rnd("correlation", 6).alias("correlation"))


@plan("importance_direction", f"""
WITH imp AS (SELECT feature, avg(abs(contribution)) AS importance FROM {C} c GROUP BY feature),
cr AS ({CORR_SQL})
SELECT imp.feature, {rsql('importance', 6)} AS importance, cr.correlation,
       CASE WHEN cr.correlation > 0 THEN 'positive' WHEN cr.correlation < 0 THEN 'negative' ELSE 'none' END AS direction
FROM imp LEFT JOIN cr ON imp.feature = cr.feature""", "explain")
def importance_direction(spark, sf):
    """X5 + J3 + P16: importance with the sign of its correlation."""
    imp = ex.mean_abs_contribution(contributions(spark, sf)).withColumnRenamed("avg_abs_contrib", "importance")
    cr = ex.corr_with_target(raw_features(spark, sf), CORR_COLS, "target_high_value")
    cr = cr.select("feature", rnd("correlation", 6).alias("correlation"))
    d = ex.importance_direction(imp, cr)
    return d.select("feature", rnd("importance", 6).alias("importance"), "correlation", "direction")
