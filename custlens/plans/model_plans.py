"""Plans for propensity models and their explanation.

Model input: labelled customer-months (window features + customer
attributes), one-hot segments and regions; time split — train up to
1999-06, test after.  A fitted model is reused within a session for the
plans that explain it (keyed by data folder and preset).
"""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..operators import encode, explain, metrics, models
from ..session import cut_lineage
from ..sources import io
from ..sources.tables import read
from .features_plans import FEATURES_RAW_SQL, _features, raw_features
from .registry import plan, rnd, rsql

BASE_FEATS = ["total_assets", "deposit_balance", "financial_balance", "fund_balance", "insurance_balance",
              "deposit_flag", "financial_flag", "fund_flag", "insurance_flag", "product_count", "txn_count",
              "monthly_income", "asset_growth_rate", "asset_mom_change", "asset_cumulative_growth",
              "total_assets_rolling_mean", "total_assets_rolling_max", "total_assets_rolling_std",
              "financial_balance_rolling_mean", "financial_balance_rolling_max", "financial_balance_rolling_std",
              "fund_balance_rolling_mean", "fund_balance_rolling_max", "fund_balance_rolling_std"]
TRAIN_END = "1999-06"
XGB_ROUNDS = 100       # the XGBoost preset's rounds
KEYS = ["customer_id", "stat_month"]
SMALL_PART, PARTS, GREAT_PART = 10_000, 24, 200_000      # rows of a partition of the model input: about the least, up to so many, and the most


def partitions(rows: int) -> int:
    """Partitions of the model input: Spark's boosting passes over it hundreds of times,
    so their number goes by the rows alone, not by those of the shuffle before."""
    return max(1, min(-(-rows // SMALL_PART), PARTS), -(-rows // GREAT_PART))


def model_frame(f):
    """One-hot columns, and all features as one vector, of ``_labelled`` rows."""
    f = encode.one_hot(f, "occupation_type")
    f = encode.one_hot(f, "city_level")
    cats = [c for c in f.columns if c.startswith("occupation_type_") or c.startswith("city_level_")]
    cats = [c for c in cats if c not in ("occupation_type_encoded",)]
    names = BASE_FEATS + sorted(cats)
    return models.assemble(f.select(*KEYS, "label", *names), names), names


def _labelled(spark, sf):
    return _features(spark, sf).select(*KEYS, F.col("target_high_value").cast("double").alias("label"),
                                       *[F.col(c).cast("double") for c in BASE_FEATS], "occupation_type", "city_level")


_KEPT: dict = {}


def _version(spark, sf) -> tuple:
    """Modification times of the tables that the model input is made of."""
    conf, out = spark._jsc.hadoopConfiguration(), []
    for t in ("customer", "orders", "nation", "region"):
        path = spark._jvm.org.apache.hadoop.fs.Path(f"{sf}/{t}.parquet")
        out.append(path.getFileSystem(conf).getFileStatus(path).getModificationTime())
    return (spark.sparkContext.applicationId, sf, *out)


def _once(spark, sf, what, make):
    """``make()`` once per session and state of the tables; what belongs to an
    older state is released."""
    version = _version(spark, sf)
    for old in [k for k in _KEPT if k[0] != version and (k[0][0] != version[0] or k[0][1] == sf)]:
        kept = _KEPT.pop(old)
        for x in kept if isinstance(kept, tuple) else (kept,):
            if hasattr(x, "unpersist") and old[0][0] == version[0]:
                x.unpersist()
    if (version, what) not in _KEPT:
        _KEPT[version, what] = make()
    return _KEPT[version, what]


def _data(spark, sf):
    def make():
        kept = _labelled(spark, sf).cache()              # the categories are read from it too
        df, names = model_frame(kept)
        return df.select(*KEYS, "label", "features", *names), names, kept

    df, names, _ = _once(spark, sf, "data", make)
    return df.where(F.col("stat_month") <= TRAIN_END), _few(spark, sf, "test", df.where(F.col("stat_month") > TRAIN_END)), names


def _few(spark, sf, what, df):
    """``df`` in the partitions that its rows need (a customer-month has one order at
    least), ordered, so that row samples are drawn from the same places in every run."""
    parts = partitions(read(spark, sf, "orders").count())
    return _once(spark, sf, what, lambda: df.repartition(parts, *KEYS).sortWithinPartitions(*KEYS).cache())


def _xgb(spark, sf):
    return _once(spark, sf, "xgb", lambda: models.fit_gbt(_few(spark, sf, "xgb train", _data(spark, sf)[0].select(*KEYS, "label", "features")), models.XGB_PRESET, max_iter=XGB_ROUNDS))


def _tree(spark, sf):
    return _once(spark, sf, "tree", lambda: models.fit_tree(_data(spark, sf)[0]))


def _nodes(spark, sf, which):
    return _once(spark, sf, f"nodes {which}", lambda: explain.node_table(
        _xgb(spark, sf) if which == "xgb" else _tree(spark, sf)).cache())


def _eval_row(scored, label="label"):
    auc = metrics.roc_auc(scored, label, "probability_1", buckets=64).select("roc_auc")
    acc = metrics.accuracy(scored.withColumn("__y", F.col(label).cast("int")), "__y", "predicted")
    return auc.crossJoin(acc)


@plan("decision_tree", None, "models")
def decision_tree(spark, sf):
    """M1 + X15: depth-4 gini tree; every node with its path rule, gini,
    cover, class counts and class-1 probability."""
    return explain.tree_paths(_nodes(spark, sf, "tree")).drop("impurityStats")


@plan("decision_tree_eval", None, "models")
def decision_tree_eval(spark, sf):
    """M1 + V1/V2: train and test accuracy / AUC of the tree."""
    train, test, _ = _data(spark, sf)
    m = _tree(spark, sf)
    tr = _eval_row(models.score(m, train)).withColumn("split", F.lit("train"))
    te = _eval_row(models.score(m, test)).withColumn("split", F.lit("test"))
    return tr.unionByName(te)


@plan("gbt_xgb_preset", None, "models")
def gbt_xgb_preset(spark, sf):
    """M3 + M7: boosted trees with the XGBoost preset, test AUC / accuracy."""
    _, test, _ = _data(spark, sf)
    return _eval_row(models.score(_xgb(spark, sf), test)).withColumn("trees", F.lit(XGB_ROUNDS))


@plan("gbt_lgb_preset", None, "models")
def gbt_lgb_preset(spark, sf):
    """M4 + M5: LightGBM preset with patience-50 early stopping on a
    validation split carved from the training months."""
    train, test, names = _data(spark, sf)
    model = _once(spark, sf, "lgb", lambda: models.fit_early_stopped(
        train.where(F.col("stat_month") <= "1998-12"), train.where(F.col("stat_month") > "1998-12"), names, KEYS, models.LGB_PRESET))
    return _eval_row(models.score_boosted(model, test, KEYS)).withColumn("rounds_kept", F.lit(model.kept)).withColumn(
        "rounds_trained", F.lit(len(model.trees)))


@plan("early_stop_rule", None, "models")
def early_stop_rule(spark, sf):
    """M5 as a query: patience rule over the per-round test log-loss curve."""
    _, test, _ = _data(spark, sf)
    losses = models.loss_by_round(_xgb(spark, sf), test)
    ldf = spark.createDataFrame([(i, float(v)) for i, v in enumerate(losses)], "round int, loss double")
    return models.patience_stop_df(ldf, models.LGB_PRESET["patience"])


@plan("cv_auc", None, "models")
def cv_auc(spark, sf):
    """M6: stratified 5-fold cross-validated AUC of the XGBoost preset (mean,
    population std)."""
    train, _, names = _data(spark, sf)
    t = train.withColumn("__k", F.concat_ws(":", F.col("customer_id").cast("string"), "stat_month"))
    t = models.stratified_folds(t, "__k", "label", 5)
    scored = models.cross_validated(t, names, KEYS, models.XGB_PRESET)
    auc = models.grouped_auc(scored, ["fold"], "label", "probability_1")
    return auc.agg(F.avg("roc_auc").alias("auc_mean"), F.stddev_pop("roc_auc").alias("auc_std"), F.count("roc_auc").cast("int").alias("folds"))


@plan("prediction_table", None, "models")
def prediction_table(spark, sf):
    """M8: id, month, actual, predicted class, probability on the test months."""
    _, test, _ = _data(spark, sf)
    s = models.score(_xgb(spark, sf), test)
    return s.select(*KEYS, F.col("label").cast("int").alias("actual"), "predicted",
                    F.col("probability_1").alias("prediction_prob"))


@plan("prediction_from_saved", None, "models")
def prediction_from_saved(spark, sf):
    """S7 + M7: the prediction table of a model that was saved, loaded again and
    given its features by name."""
    _, test, names = _data(spark, sf)
    path = io.save_model(_xgb(spark, sf), names, spark, f"xgb-{uuid.uuid4().hex}")
    model, features = io.load_model(spark, path)
    again = models.assemble(test.drop("features"), features)
    return models.score(model, again).select(*KEYS, F.col("label").cast("int").alias("actual"), "predicted",
                                             F.col("probability_1").alias("prediction_prob"))


@plan("model_high_value_list", None, "models")
def model_high_value_list(spark, sf):
    """M9 on model scores: probability >= 0.7, by probability desc."""
    _, test, _ = _data(spark, sf)
    s = models.score(_xgb(spark, sf), test)
    return metrics.select_high_value(s, "probability_1", 0.7).select(
        *KEYS, F.col("label").cast("int").alias("target_high_value"),
        F.col("probability_1").alias("prediction_prob")).orderBy(F.col("prediction_prob").desc(), *KEYS)


@plan("split_importance", None, "explain")
def split_importance(spark, sf):
    """X1 + X2: split counts and total gain per feature of the XGB-preset model."""
    _, _, names = _data(spark, sf)
    return explain.split_gain_importance(_nodes(spark, sf, "xgb"), names)


@plan("feature_importance", None, "explain")
def feature_importance(spark, sf):
    """Normalised importances (sum to 1)."""
    _, _, names = _data(spark, sf)
    return explain.normalized_importance(_xgb(spark, sf), names)


def _shap_rows(spark, sf, rows=None):
    """Contributions of the test rows, or of those ``rows`` whose keys are given."""
    _, test, names = _data(spark, sf)
    if rows is not None:
        test = test.join(F.broadcast(rows.select(*KEYS)), KEYS, "left_semi")
    return explain.tree_contribution_rows(_nodes(spark, sf, "xgb"), test, "features", names, KEYS)


def _shap(spark, sf):
    return explain.long_contributions(_shap_rows(spark, sf), KEYS)


@plan("tree_shap", None, "explain")
def tree_shap(spark, sf):
    """Per-row additive contributions (log-odds) for the test months."""
    return _shap(spark, sf)


@plan("shap_wide", None, "explain")
def shap_wide(spark, sf):
    """Contributions one column per feature (``shap_`` prefix)."""
    _, _, names = _data(spark, sf)
    return explain.wide_contributions(_shap_rows(spark, sf), KEYS, names, "shap_")


@plan("importance_table", None, "explain")
def importance_table(spark, sf):
    """X4 + X11: split, gain and mean |contribution| per feature."""
    _, _, names = _data(spark, sf)
    imp = explain.split_gain_importance(_nodes(spark, sf, "xgb"), names)
    return imp.join(explain.mean_abs_contribution(_shap_rows(spark, sf)), "feature", "left")


@plan("customer_info", None, "explain")
def customer_info(spark, sf):
    """X9 + X12: for 2 + 2 sample rows (first by key per predicted class),
    every feature value with its contribution, probability, classes and base score."""
    _, test, _ = _data(spark, sf)
    s = models.score(_xgb(spark, sf), test)
    sample = explain.first_n_per_class(s, "predicted", KEYS, 2).select(
        *KEYS, "predicted", F.col("label").cast("int").alias("actual"), "probability_1")
    sample = cut_lineage(sample)                                   # four rows
    only = explain.long_contributions(_shap_rows(spark, sf, sample), KEYS)
    return only.join(F.broadcast(sample), KEYS)


# ------------------------------------------------------------ exact root split (M2)

# features that both engines compute to the last bit, so that equal values meet
GINI_FEATS = ["total_assets", "asset_growth_rate", "asset_mom_change", "asset_cumulative_growth",
              "fund_balance_rolling_max"]


def best_gini_split(df, features, label):
    """M2: for each feature, the threshold (midpoint of consecutive
    distinct values) with the largest gini decrease at the root.  Class
    counts are accumulated in value order with range-partitioned running
    sums, so no feature's distinct values sit in one task."""
    from ..functions.ranges import grouped_running
    long = df.select(label, F.inline(F.array(*[F.struct(F.lit(c).alias("feature"),
                                                          F.col(c).cast("double").alias("value"))
                                                 for c in features])))
    g = long.groupBy("feature", "value").agg(F.sum(F.col(label)).alias("p"), F.count(F.lit(1)).alias("c"))
    g = grouped_running(g, ["feature"], "value", ["p", "c"], next_value=True)
    g = g.select("feature", "value", F.col("next_value").alias("nxt"), F.col("cum_p").alias("lp"),
                 F.col("cum_c").alias("lc"), F.col("tot_p").alias("tp"), F.col("tot_c").alias("tc"))
    g = g.where(F.col("nxt").isNotNull())

    def gini(pos, n):
        q = F.try_divide(pos, n)
        return 1.0 - q * q - (1.0 - q) * (1.0 - q)

    lp, lc, tp, tc = (F.col(x).cast("double") for x in ("lp", "lc", "tp", "tc"))
    gain = (gini(tp, tc) - F.try_divide(lc, tc) * gini(lp, lc)
            - F.try_divide(tc - lc, tc) * gini(tp - lp, tc - lc))
    g = g.withColumn("gain", gain).withColumn("threshold", (F.col("value") + F.col("nxt")) / 2.0)
    return g.groupBy("feature").agg(F.max_by("threshold", F.struct(F.col("gain"), -F.col("threshold"))).alias("threshold"),
                                    F.max("gain").alias("gini_gain"))


GINI_SQL = f"""
WITH f AS (SELECT * FROM ({FEATURES_RAW_SQL}) x WHERE stat_month <= '{TRAIN_END}'),
l AS ({' UNION ALL '.join(f"SELECT '{c}' AS feature, CAST({c} AS DOUBLE) AS value, target_high_value AS y FROM f" for c in GINI_FEATS)}),
g AS (SELECT feature, value, sum(y) AS p, count(*) AS c FROM l GROUP BY 1, 2),
w AS (SELECT feature, value, lead(value) OVER (PARTITION BY feature ORDER BY value) AS nxt,
             CAST(sum(p) OVER (PARTITION BY feature ORDER BY value ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS DOUBLE) AS lp,
             CAST(sum(c) OVER (PARTITION BY feature ORDER BY value ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS DOUBLE) AS lc,
             CAST(sum(p) OVER (PARTITION BY feature) AS DOUBLE) AS tp, CAST(sum(c) OVER (PARTITION BY feature) AS DOUBLE) AS tc
      FROM g),
s AS (SELECT feature, (value + nxt) / 2.0 AS threshold,
             (1.0 - (tp/tc)*(tp/tc) - (1.0 - tp/tc)*(1.0 - tp/tc))
             - (lc / tc) * (1.0 - (lp/lc)*(lp/lc) - (1.0 - lp/lc)*(1.0 - lp/lc))
             - ((tc - lc) / tc) * (1.0 - ((tp-lp)/(tc-lc))*((tp-lp)/(tc-lc)) - (1.0 - (tp-lp)/(tc-lc))*(1.0 - (tp-lp)/(tc-lc))) AS gain
      FROM w WHERE nxt IS NOT NULL)
SELECT feature, {rsql('first(threshold ORDER BY gain DESC, threshold)', 6)} AS threshold, {rsql('max(gain)', 8)} AS gini_gain
FROM s GROUP BY feature
"""


@plan("gini_best_split", GINI_SQL, "models")
def gini_best_split(spark, sf):
    """M2: exact best root split per feature on the training months."""
    f = raw_features(spark, sf).where(F.col("stat_month") <= TRAIN_END)
    b = best_gini_split(f, GINI_FEATS, "target_high_value")
    return b.select("feature", rnd("threshold", 6).alias("threshold"), rnd("gini_gain", 8).alias("gini_gain"))
