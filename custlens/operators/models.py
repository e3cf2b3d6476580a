"""Propensity models (M1–M8) on Spark ML.

Trees are trained level-wise by Spark ML (distributed histogram
aggregation per level), over many rows by ``gbt`` (the same trees); the input is assembled once and cached for the
iterations, and GBT lineage is cut every ``checkpointInterval`` rounds
into the shared checkpoint folder.  Cross-validation and early stopping
train by ``boosting`` (all folds in one run, rounds that continue).
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import DecisionTreeClassifier, GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import checkpoint_dir, ship_package
from . import boosting
from . import gbt as boosted

# Hyper-parameters of the reference's two boosted-tree
# presets and its decision tree (rounds, learning rate, depth, row and
# column sampling, early-stopping patience).
XGB_PRESET = {"maxIter": 100, "stepSize": 0.1, "maxDepth": 6, "subsamplingRate": 0.8,
              "featureSubsetStrategy": "0.8"}
LGB_PRESET = {"maxIter": 1000, "stepSize": 0.05, "maxDepth": 4, "subsamplingRate": 0.8,
              "featureSubsetStrategy": "0.9", "patience": 50}
TREE_PRESET = {"maxDepth": 4, "impurity": "gini"}
MANY_ROWS = 200_000      # rows from which ``operators.gbt`` grows the trees of ``GBTClassifier``


def assemble(df: DataFrame, features: Sequence[str], out: str = "features") -> DataFrame:
    """U4 / E5: feature columns -> one vector (names kept in metadata)."""
    return VectorAssembler(inputCols=list(features), outputCol=out, handleInvalid="keep").transform(df)


def fit_tree(train: DataFrame, label: str = "label", seed: int = 42, max_bins: int = 64, **kw):
    """M1: gini decision tree."""
    p = {**TREE_PRESET, **kw}
    return DecisionTreeClassifier(labelCol=label, featuresCol="features", seed=seed, maxBins=max_bins,
                                  maxDepth=p["maxDepth"], impurity=p["impurity"]).fit(train)


def gbt(preset: dict, label: str = "label", seed: int = 42, max_iter: int | None = None, max_bins: int = 64) -> GBTClassifier:
    """The estimator of a preset."""
    return GBTClassifier(labelCol=label, featuresCol="features", seed=seed, maxBins=max_bins,
                         maxIter=max_iter or preset["maxIter"], stepSize=preset["stepSize"],
                         maxDepth=preset["maxDepth"], subsamplingRate=preset["subsamplingRate"],
                         featureSubsetStrategy=preset["featureSubsetStrategy"], checkpointInterval=10,
                         cacheNodeIds=True)


def fit_gbt(train: DataFrame, preset: dict, label: str = "label", seed: int = 42,
            max_iter: int | None = None, max_bins: int = 64):
    """M3 / M4: gradient-boosted trees with a preset's parameters.  Over many rows the
    same trees are grown by ``boosted``, whose passes cost less a row."""
    checkpoint_dir(train.sparkSession)
    estimator = gbt(preset, label, seed, max_iter, max_bins)
    if train.count() > MANY_ROWS and boosted.trains(estimator, train.first()["features"].size):
        return boosted.fit(train, estimator)
    return estimator.fit(train)


def loss_by_round(model, df: DataFrame, label: str = "label") -> list:
    """``model.evaluateEachIteration(df)`` (mean log loss after every round) in one pass:
    the margin of a row goes on from tree to tree and is not taken anew every round."""
    from .explain import compile_ensemble, node_table, tree_values
    trees, rounds = compile_ensemble(node_table(model), tree_values), len(model.trees)

    def run(batches):
        sums, n = np.zeros(rounds), 0
        for batch in batches:
            for at in range(0, batch.num_rows, 8192):
                b = batch.slice(at, 8192)
                y = 2.0 * b.column(0).to_numpy(zero_copy_only=False) - 1.0
                x = b.column(1).flatten().to_numpy(zero_copy_only=False).astype(float).reshape(b.num_rows, -1)
                margin, n = np.zeros(b.num_rows), n + b.num_rows
                for r, (weight, tree) in enumerate(trees):
                    margin += weight * tree(x)
                    sums[r] += (2.0 * np.logaddexp(0.0, -2.0 * y * margin)).sum()
        if n:
            yield pa.RecordBatch.from_arrays([pa.array(range(rounds), pa.int32()), pa.array(sums), pa.array([n] * rounds, pa.int64())], names=["round", "loss", "n"])

    ship_package(df.sparkSession)
    parts = df.select(F.col(label).cast("double"), vector_to_array("features")).mapInArrow(run, "round int, loss double, n long")
    return [r.loss for r in parts.groupBy("round").agg((F.sum("loss") / F.sum("n")).alias("loss")).orderBy("round").collect()]   # a row a round


def patience_stop(losses: Sequence[float], patience: int) -> int:
    """M5: number of rounds to keep — the best round so far, stopping once
    ``patience`` rounds pass without a strictly lower validation loss."""
    best, best_i = float("inf"), 0
    for i, v in enumerate(losses):
        if v < best:
            best, best_i = v, i
        elif i - best_i >= patience:
            break
    return best_i + 1


def patience_stop_df(losses: DataFrame, patience: int, group: Sequence[str] = ()) -> DataFrame:
    """M5 as a query over a (group, round, loss) table: best round by loss
    among the rounds before the first run of ``patience`` non-improving
    rounds."""
    w = Window.partitionBy(*group).orderBy("round").rowsBetween(Window.unboundedPreceding, -1)
    x = losses.withColumn("__best_before", F.min("loss").over(w))
    x = x.withColumn("__improves", F.col("__best_before").isNull() | (F.col("loss") < F.col("__best_before")))
    wi = Window.partitionBy(*group).orderBy("round").rowsBetween(Window.unboundedPreceding, 0)
    x = x.withColumn("__last_imp", F.max(F.when(F.col("__improves"), F.col("round"))).over(wi))
    stop = x.where(F.col("round") - F.col("__last_imp") >= patience).groupBy(*group).agg(
        F.min("round").alias("__stop"))
    y = x.join(stop, list(group), "left") if group else x.crossJoin(stop.select("__stop"))
    y = y.where(F.col("__stop").isNull() | (F.col("round") <= F.col("__stop")))
    return y.groupBy(*group).agg(F.min_by("round", F.struct("loss", "round")).alias("best_round"),
                                 F.min("loss").alias("best_loss")).withColumn(
        "rounds_kept", F.col("best_round") + 1)


def score(model, df: DataFrame, prob_col: str = "probability_1", pred_col: str = "predicted") -> DataFrame:
    """M7: probability of class 1 and predicted class."""
    out = model.transform(df)
    return (out.withColumn(prob_col, vector_to_array("probability")[1])
            .withColumn(pred_col, F.col("prediction").cast("int"))
            .drop("rawPrediction", "probability", "prediction"))


def stratified_folds(df: DataFrame, key: str, label: str, k: int = 5, seed: int = 42) -> DataFrame:
    """M6: deterministic stratified fold ids — rows of each class are
    dealt round-robin in hash order (exact ranks, no class-wide window)."""
    from .encode import rank_within
    r = rank_within(df, label, key, seed)
    return r.withColumn("fold", ((F.col("rank_in_group") - 1) % k).cast("int")).drop("rank_in_group", "group_size")


def grouped_auc(df: DataFrame, group: Sequence[str], label: str, score: str) -> DataFrame:
    """M6: exact ROC-AUC per group, tied scores count half; distinct scores
    are counted and accumulated in ranges, so no group is held by one task."""
    from ..functions.ranges import grouped_running
    y = F.col(label).cast("int")
    counts = df.groupBy(*group, F.col(score).alias("__s")).agg(F.sum(y).alias("__p"), F.sum(1 - y).alias("__n"))
    cum = grouped_running(counts, group, "__s", ["__p", "__n"])
    wins = F.sum(F.col("__p") * (F.col("cum___n") - F.col("__n") * 0.5))
    return cum.groupBy(*group).agg(F.try_divide(wins, F.first("tot___p").cast("double") * F.first("tot___n")).alias("roc_auc"))


def cross_validated(df: DataFrame, features: Sequence[str], key: Sequence[str], preset: dict, k: int = 5, label: str = "label",
                    seed: int = 42) -> DataFrame:
    """M6: (fold, label, probability_1) of every row of ``df`` by the model that
    was trained without the row's ``fold``; the k models are boosted in one run."""
    edges = boosting.split_points(df, features)
    rows = boosting.binned(df, features, edges, label, key, held=F.col("fold"), models=k, keep=["fold", label])
    model = boosting.train(rows, features, edges, boosting_params(preset, seed=seed), models=k)
    return boosting.score(rows, model, ["fold", label], models=k)


def boosting_params(preset: dict, **kw) -> boosting.Boosting:
    """A preset as parameters of ``boosting`` (its patience holds only if asked for)."""
    return boosting.Boosting(**{"rounds": preset["maxIter"], "rate": preset["stepSize"], "depth": preset["maxDepth"],
                                "row_share": preset["subsamplingRate"], "column_share": float(preset["featureSubsetStrategy"]), **kw})


def fit_early_stopped(train: DataFrame, valid: DataFrame, features: Sequence[str], key: Sequence[str], preset: dict,
                      label: str = "label", seed: int = 42) -> boosting.Ensemble:
    """M4 + M5: boost on ``train``, round by round, until the log-loss of ``valid``
    has not fallen for the preset's patience; the rounds up to the least loss count."""
    edges = boosting.split_points(train, features)
    rows = train.withColumn("__out", F.lit(-1)).unionByName(valid.withColumn("__out", F.lit(0)))
    rows = boosting.binned(rows, features, edges, label, key, held=F.col("__out"))
    return boosting.train(rows, features, edges, boosting_params(preset, seed=seed, patience=preset["patience"]))


def score_boosted(model: boosting.Ensemble, df: DataFrame, key: Sequence[str], label: str = "label") -> DataFrame:
    """M7: key, label, probability_1 and predicted of every row."""
    rows = boosting.binned(df, model.features, model.edges, label, key, keep=[*key, label])
    return boosting.score(rows, model, [*key, label], number=0)
