"""Plans for the feature stage: joins, fills, window features, labels."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import features as fe
from ..sources import bindings as bd
from .registry import plan, rnd, rsql

TH = bd.DRIVER_HIGH_VALUE
ROLL = fe.ROLLING_DEFAULT


def _features(spark, sf, mode="at"):
    return fe.feature_matrix(bd.base(spark, sf), bd.behaviour(spark, sf), threshold=TH, mode=mode)


def _feature_cols():
    cols = [F.col("customer_id"), F.col("stat_month"),
            rnd("total_assets", 2).alias("total_assets"),
            rnd("asset_growth_rate", 6).alias("asset_growth_rate"),
            rnd("asset_mom_change", 2).alias("asset_mom_change"),
            rnd("asset_cumulative_growth", 2).alias("asset_cumulative_growth")]
    for c in ROLL:
        cols += [rnd(f"{c}_rolling_mean", 4).alias(f"{c}_rolling_mean"),
                 rnd(f"{c}_rolling_max", 2).alias(f"{c}_rolling_max"),
                 rnd(f"{c}_rolling_std", 4).alias(f"{c}_rolling_std")]
    cols += [rnd("future_3m_assets", 2).alias("future_3m_assets"), F.col("target_high_value")]
    return cols


RAW_COLS = ["customer_id", "stat_month", "total_assets", "asset_growth_rate", "asset_mom_change", "asset_cumulative_growth",
            *[f"{c}_rolling_{s}" for c in ROLL for s in ("mean", "max", "std")], "future_3m_assets", "target_high_value"]


def raw_features(spark, sf):
    """The labelled customer-months with their features at full precision."""
    return _features(spark, sf).select(*RAW_COLS)


def _features_sql(future_expr: str, future_guard: str, rsql=rsql) -> str:
    raw, out = [], []
    for c in ROLL:
        raw += [f"avg({c}) OVER r AS {c}_rm", f"max({c}) OVER r AS {c}_rx",
                f"stddev_samp({c}) OVER r AS {c}_rs"]
        out += [
            f"{rsql(f'CASE WHEN cnt = 3 THEN {c}_rm ELSE 0.0 END', 4)} AS {c}_rolling_mean",
            f"{rsql(f'CASE WHEN cnt = 3 THEN {c}_rx ELSE 0.0 END', 2)} AS {c}_rolling_max",
            f"{rsql(f'CASE WHEN cnt = 3 THEN {c}_rs ELSE 0.0 END', 4)} AS {c}_rolling_std",
        ]
    raw_sql = ",\n    ".join(raw)
    out_sql = ",\n  ".join(out)
    return f"""
WITH b AS ({bd.BEHAVIOUR_SQL}),
j AS (
  SELECT base.customer_id, b.stat_month,
         coalesce(b.total_assets, 0.0) AS total_assets,
         coalesce(b.financial_balance, 0.0) AS financial_balance,
         coalesce(b.fund_balance, 0.0) AS fund_balance
  FROM ({bd.BASE_SQL}) base LEFT JOIN b ON base.customer_id = b.customer_id
),
w AS (
  SELECT *,
    lag(total_assets) OVER a AS prev,
    first_value(total_assets) OVER a AS first_x,
    count(*) OVER r AS cnt,
    {raw_sql},
    {future_expr} AS fut,
    {future_guard} AS fut_ok
  FROM j
  WINDOW a AS (PARTITION BY customer_id ORDER BY stat_month),
         r AS (PARTITION BY customer_id ORDER BY stat_month ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)
)
SELECT customer_id, stat_month,
  {rsql('total_assets', 2)} AS total_assets,
  {rsql('CASE WHEN prev IS NULL OR prev = 0 THEN 0.0 ELSE (total_assets - prev) / prev END', 6)} AS asset_growth_rate,
  {rsql('coalesce(total_assets - prev, 0.0)', 2)} AS asset_mom_change,
  {rsql('total_assets - first_x', 2)} AS asset_cumulative_growth,
  {out_sql},
  {rsql('fut', 2)} AS future_3m_assets,
  CAST(fut >= {TH} AS INTEGER) AS target_high_value
FROM w
WHERE fut_ok
"""


FEATURES_SQL = _features_sql("lead(total_assets, 3) OVER a", "lead(total_assets, 3) OVER a IS NOT NULL")
FEATURES_RAW_SQL = _features_sql("lead(total_assets, 3) OVER a", "lead(total_assets, 3) OVER a IS NOT NULL", lambda expr, d: f"({expr})")
FUTURE_MAX_SQL = _features_sql(
    "max(total_assets) OVER (PARTITION BY customer_id ORDER BY stat_month ROWS BETWEEN 1 FOLLOWING AND 3 FOLLOWING)",
    "lead(total_assets, 3) OVER a IS NOT NULL")


@plan("customer_month_features", FEATURES_SQL, "features")
def customer_month_features(spark, sf):
    """Growth, change, cumulative change, rolling-3 stats, t+3 label."""
    return _features(spark, sf).select(*_feature_cols())


@plan("future_max_label", FUTURE_MAX_SQL, "features")
def future_max_label(spark, sf):
    """W5 variant: label on the max over the next 3 rows."""
    return _features(spark, sf, mode="max").select(*_feature_cols())


SEGMENT_SUMMARY_SQL = f"""
WITH f AS ({FEATURES_SQL}), base AS ({bd.BASE_SQL})
SELECT base.occupation_type,
       CAST(count(DISTINCT f.customer_id) AS BIGINT) AS customers,
       CAST(count(*) AS BIGINT) AS labelled_rows,
       {rsql('avg(f.target_high_value)', 6)} AS positive_rate,
       {rsql('avg(f.asset_growth_rate)', 4)} AS mean_growth
FROM f JOIN base ON f.customer_id = base.customer_id
GROUP BY base.occupation_type
"""


def segment_summary(spark, sf):
    """Flagship: customers, labelled rows, positive rate and mean growth per segment."""
    feats = _features(spark, sf)
    return feats.groupBy("occupation_type").agg(
        F.count_distinct("customer_id").cast("long").alias("customers"),
        F.count(F.lit(1)).cast("long").alias("labelled_rows"),
        rnd(F.avg("target_high_value"), 6).alias("positive_rate"),
        # growth is rounded per row first, as in the oracle
        rnd(F.avg(rnd("asset_growth_rate", 6)), 4).alias("mean_growth"),
    )


plan("segment_label_summary", SEGMENT_SUMMARY_SQL, "features")(segment_summary)


LEFT_JOIN_SQL = f"""
WITH b AS ({bd.BEHAVIOUR_SQL})
SELECT base.customer_id, base.occupation_type, base.city_level, b.stat_month,
       {rsql('b.total_assets', 2)} AS total_assets
FROM ({bd.BASE_SQL}) base LEFT JOIN b ON base.customer_id = b.customer_id
"""


@plan("left_join_base_behavior", LEFT_JOIN_SQL, "features")
def left_join_base_behavior(spark, sf):
    """Every customer kept, NULL month where there is no activity."""
    j = fe.join_base_behaviour(bd.base(spark, sf), bd.behaviour(spark, sf))
    return j.select("customer_id", "occupation_type", "city_level", "stat_month",
                    rnd("total_assets", 2).alias("total_assets"))


MEDIAN_FILL_SQL = f"""
WITH b AS ({bd.BEHAVIOUR_SQL}),
j AS (SELECT base.customer_id, b.stat_month, b.total_assets, b.txn_count
      FROM ({bd.BASE_SQL}) base LEFT JOIN b ON base.customer_id = b.customer_id),
m AS (SELECT median(total_assets) AS mt, median(txn_count) AS mc FROM j)
SELECT customer_id, coalesce(stat_month, 'unknown') AS stat_month,
       {rsql('coalesce(total_assets, m.mt)', 2)} AS total_assets,
       CAST(coalesce(txn_count, CAST(floor(m.mc) AS BIGINT)) AS BIGINT) AS txn_count
FROM j, m
"""


@plan("median_fill", MEDIAN_FILL_SQL, "features")
def median_fill(spark, sf):
    """Fill NULLs of the joined customer-month rows with the exact median."""
    j = fe.join_base_behaviour(bd.base(spark, sf), bd.behaviour(spark, sf)).select(
        "customer_id", "stat_month", "total_assets", "txn_count")
    f = fe.fill_median(j, ["total_assets", "txn_count"], ["stat_month"])
    return f.select("customer_id", "stat_month", rnd("total_assets", 2).alias("total_assets"),
                    F.col("txn_count").cast("long").alias("txn_count"))
