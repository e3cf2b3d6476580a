"""Plans for model evaluation on a deterministic score column.

Score binding: every labelled customer-month is scored by
``x / (x + threshold)`` of its current total assets (0.5 exactly at the
high-value threshold) at full precision, so there are about as many distinct
scores as rows; the label is the forward label of the feature stage.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import metrics as mt
from ..sources import bindings as bd
from .features_plans import FEATURES_RAW_SQL, raw_features
from .registry import plan, rnd, rsql

TH = bd.DRIVER_HIGH_VALUE


def scored(spark, sf):
    f = raw_features(spark, sf)
    x = F.col("total_assets")
    score = x / (x + F.lit(TH))
    return f.select("customer_id", "stat_month", "target_high_value", "total_assets",
                    "future_3m_assets", score.alias("score")).withColumn(
        "predicted", mt.binarize("score", 0.5))


SCORED_SQL = f"""
SELECT customer_id, stat_month, target_high_value, total_assets, future_3m_assets,
       total_assets / (total_assets + {TH}) AS score,
       CAST(total_assets / (total_assets + {TH}) > 0.5 AS INTEGER) AS predicted
FROM ({FEATURES_RAW_SQL}) f
"""
S = f"({SCORED_SQL})"


@plan("accuracy", f"SELECT {rsql('avg(CAST(target_high_value = predicted AS DOUBLE))', 6)} AS accuracy, "
      f"CAST(count(*) AS BIGINT) AS rows FROM {S} s", "metrics")
def accuracy(spark, sf):
    """V1 on the scored rows (P8 binarisation at > 0.5)."""
    a = mt.accuracy(scored(spark, sf), "target_high_value", "predicted")
    return a.select(rnd("accuracy", 6).alias("accuracy"), "rows")


@plan("confusion_matrix", f"""
WITH pairs AS (SELECT a.x AS actual, p.x AS predicted FROM (VALUES (0), (1)) a(x), (VALUES (0), (1)) p(x)),
c AS (SELECT target_high_value AS actual, predicted, count(*) AS n FROM {S} s GROUP BY 1, 2)
SELECT pairs.actual, pairs.predicted, CAST(coalesce(c.n, 0) AS BIGINT) AS count
FROM pairs LEFT JOIN c ON pairs.actual = c.actual AND pairs.predicted = c.predicted
""", "metrics")
def confusion_matrix(spark, sf):
    """V5: zero-filled 2x2 matrix in long form."""
    return mt.confusion_matrix(scored(spark, sf), "target_high_value", "predicted")


def _report_sql():
    cls = []
    for c in (0, 1):
        p = f"CASE WHEN pp{c} = 0 THEN 0.0 ELSE tp{c} / pp{c} END"
        r = f"CASE WHEN sup{c} = 0 THEN 0.0 ELSE tp{c} / sup{c} END"
        f1 = f"CASE WHEN ({p}) + ({r}) = 0 THEN 0.0 ELSE 2 * ({p}) * ({r}) / (({p}) + ({r})) END"
        cls.append((str(c), p, r, f1, f"sup{c}"))
    lines = [f"SELECT '{n}' AS class_label, {rsql(p, 6)} AS precision, {rsql(r, 6)} AS recall, "
             f"{rsql(f1, 6)} AS f1_score, CAST({s} AS BIGINT) AS support FROM t" for n, p, r, f1, s in cls]
    acc = "CASE WHEN n = 0 THEN 0.0 ELSE correct / n END"
    lines.append(f"SELECT 'accuracy', {rsql(acc, 6)}, {rsql(acc, 6)}, {rsql(acc, 6)}, CAST(n AS BIGINT) FROM t")
    (_, p0, r0, f0, _), (_, p1, r1, f1_, _) = cls
    lines.append(f"SELECT 'macro avg', {rsql(f'(({p0}) + ({p1})) / 2', 6)}, {rsql(f'(({r0}) + ({r1})) / 2', 6)}, "
                 f"{rsql(f'(({f0}) + ({f1_})) / 2', 6)}, CAST(n AS BIGINT) FROM t")
    wavg = lambda a, b: f"CASE WHEN n = 0 THEN 0.0 ELSE (({a}) * sup0 + ({b}) * sup1) / n END"
    lines.append(f"SELECT 'weighted avg', {rsql(wavg(p0, p1), 6)}, {rsql(wavg(r0, r1), 6)}, "
                 f"{rsql(wavg(f0, f1_), 6)}, CAST(n AS BIGINT) FROM t")
    agg = ", ".join(
        f"CAST(sum(CASE WHEN target_high_value = {c} AND predicted = {c} THEN 1 ELSE 0 END) AS DOUBLE) AS tp{c}, "
        f"CAST(sum(CASE WHEN predicted = {c} THEN 1 ELSE 0 END) AS DOUBLE) AS pp{c}, "
        f"CAST(sum(CASE WHEN target_high_value = {c} THEN 1 ELSE 0 END) AS DOUBLE) AS sup{c}" for c in (0, 1))
    return (f"WITH t AS (SELECT CAST(count(*) AS DOUBLE) AS n, "
            f"CAST(sum(CASE WHEN target_high_value = predicted THEN 1 ELSE 0 END) AS DOUBLE) AS correct, "
            f"{agg} FROM {S} s)\n" + "\nUNION ALL\n".join(lines))


@plan("classification_report", _report_sql(), "metrics")
def classification_report(spark, sf):
    """V4: per-class precision / recall / f1 / support and the averages."""
    r = mt.classification_report(scored(spark, sf), "target_high_value", "predicted")
    return r.select("class_label", rnd("precision", 6).alias("precision"), rnd("recall", 6).alias("recall"),
                    rnd("f1_score", 6).alias("f1_score"), "support")


ROC_SQL = f"""
WITH d AS (SELECT score, sum(target_high_value) AS pos, sum(1 - target_high_value) AS neg
           FROM {S} s GROUP BY score),
c AS (SELECT *, sum(neg) OVER (ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cum_neg FROM d)
SELECT {rsql('sum(pos * (cum_neg - neg + 0.5 * neg)) / (sum(pos) * sum(neg))', 8)} AS roc_auc,
       CAST(sum(pos) AS BIGINT) AS positives, CAST(sum(neg) AS BIGINT) AS negatives
FROM c
"""


@plan("roc_auc", ROC_SQL, "metrics")
def roc_auc(spark, sf):
    """V2: exact tie-aware ROC-AUC via range-partitioned prefix sums."""
    r = mt.roc_auc(scored(spark, sf), "target_high_value", "score", buckets=64)
    return r.select(rnd("roc_auc", 8).alias("roc_auc"), "positives", "negatives")


PR_SQL = f"""
WITH d AS (SELECT score, sum(target_high_value) AS pos, sum(1 - target_high_value) AS neg
           FROM {S} s GROUP BY score),
c AS (SELECT *, sum(pos) OVER w AS tp, sum(neg) OVER w AS fp, sum(pos) OVER () AS p_all FROM d
      WINDOW w AS (ORDER BY score DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
pts AS (SELECT tp / (tp + fp) AS prec, tp / p_all AS rec,
               CASE WHEN tp - pos + fp - neg = 0 THEN 1.0 ELSE (tp - pos) / (tp - pos + fp - neg) END AS prec0,
               CASE WHEN tp - pos + fp - neg = 0 THEN 0.0 ELSE (tp - pos) / p_all END AS rec0
        FROM c)
SELECT {rsql('sum((rec - rec0) * (prec + prec0) / 2)', 8)} AS pr_auc, CAST(count(*) AS BIGINT) AS thresholds
FROM pts
"""


@plan("pr_auc", PR_SQL, "metrics")
def pr_auc(spark, sf):
    """V3: trapezoid PR-AUC over all distinct thresholds, closed at (0, 1)."""
    r = mt.pr_auc(scored(spark, sf), "target_high_value", "score", buckets=64)
    return r.select(rnd("pr_auc", 8).alias("pr_auc"), "thresholds")


@plan("rmse", f"""
SELECT {rsql('sqrt(avg((future_3m_assets - total_assets) * (future_3m_assets - total_assets)))', 4)} AS rmse,
       {rsql('avg(abs(future_3m_assets - total_assets))', 4)} AS mae, CAST(count(*) AS BIGINT) AS rows
FROM {S} s""", "metrics")
def rmse(spark, sf):
    """V6: error of the persistence forecast (value now vs value at t+3)."""
    r = mt.rmse(scored(spark, sf), "future_3m_assets", "total_assets")
    return r.select(rnd("rmse", 4).alias("rmse"), rnd("mae", 4).alias("mae"), "rows")


@plan("high_value_list", f"""
SELECT customer_id, stat_month, target_high_value, score AS prediction_prob
FROM {S} s WHERE score >= 0.7""", "metrics")
def high_value_list(spark, sf):
    """M9 + P7: every row with probability >= 0.7, ordered by probability."""
    s = mt.select_high_value(scored(spark, sf), "score", 0.7)
    return s.select("customer_id", "stat_month", "target_high_value",
                    F.col("score").alias("prediction_prob")).orderBy(
        F.col("prediction_prob").desc(), "customer_id", "stat_month")


@plan("selection_report", f"""
SELECT CAST(count(*) FILTER (WHERE score >= 0.7) AS BIGINT) AS selected, CAST(count(*) AS BIGINT) AS rows,
       {rsql('count(*) FILTER (WHERE score >= 0.7) / count(*)', 6)} AS selected_share,
       {rsql('avg(CASE WHEN score >= 0.7 THEN CAST(target_high_value AS DOUBLE) END)', 6)} AS selected_positive_rate
FROM {S} s""", "metrics")
def selection_report(spark, sf):
    """Size, share and precision of the >= 0.7 selection."""
    r = mt.selection_report(scored(spark, sf), "target_high_value", "score", 0.7)
    return r.select("selected", "rows", rnd("selected_share", 6).alias("selected_share"),
                    rnd("selected_positive_rate", 6).alias("selected_positive_rate"))
