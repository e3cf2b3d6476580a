"""Model explanation.

Tree structure comes from the saved model's node table — a DataFrame
whose size is bounded by trees x nodes.  Per-row additive contributions
(path-dependent tree SHAP) run in ``mapInArrow`` over Arrow batches:
for every tree the leaf paths are compiled once on the driver into
small arrays; each batch then evaluates, per leaf, the product game
``value * Π_{f in S} 1[x follows f] * Π_{f not in S} cover_ratio(f)``
whose exact Shapley values come from polynomial coefficients — all
vectorised over (rows x leaves), no per-row Python.  A leaf's path has few
distinct features, so these values are worked out once per leaf and pattern
of followed features and looked up for the rows.

Contributions stay in the row they explain: (keys..., contributions
array<feature, value, contribution>, base_score).  Sums, orders and running
totals of a row are taken in its array; only totals over rows are shuffled.
"""

from __future__ import annotations

import math
import os
import uuid
from collections.abc import Mapping, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import checkpoint_dir


# ------------------------------------------------------------ node tables

def node_table(model) -> DataFrame:
    """Saved-model node table: treeID, weight, id, prediction, impurity,
    impurityStats, rawCount, gain, leftChild, rightChild, featureIndex,
    threshold.  Written under the shared checkpoint folder."""
    spark = SparkSession.getActiveSession()
    path = os.path.join(checkpoint_dir(spark), f"model-{uuid.uuid4().hex}")
    model.write().overwrite().save(path)
    raw = spark.read.parquet(os.path.join(path, "data"))
    if "treeID" in raw.columns:
        weights = list(getattr(model, "treeWeights", [1.0]))
        wdf = spark.createDataFrame([(i, float(w)) for i, w in enumerate(weights)], "treeID int, weight double")
        raw = raw.select("treeID", "nodeData.*").join(F.broadcast(wdf), "treeID")
    else:
        raw = raw.select(F.lit(0).alias("treeID"), "*", F.lit(1.0).alias("weight"))
    return raw.select("treeID", "weight", "id", "prediction", "impurity", "impurityStats", "rawCount", "gain",
                      "leftChild", "rightChild", F.col("split.featureIndex").alias("featureIndex"),
                      F.try_element_at("split.leftCategoriesOrThreshold", F.lit(1)).alias("threshold"))


def feature_names_df(spark, names: Sequence[str]) -> DataFrame:
    return spark.createDataFrame([(i, n) for i, n in enumerate(names)], "featureIndex int, feature string")


def split_gain_importance(nodes: DataFrame, names: Sequence[str]) -> DataFrame:
    """Number of splits and total gain (gain x cover) per feature,
    every feature listed (zero when never used)."""
    inner = nodes.where(F.col("leftChild") >= 0)
    agg = inner.groupBy("featureIndex").agg(F.count(F.lit(1)).cast("long").alias("importance_split"),
                                            F.sum(F.col("gain") * F.col("rawCount")).alias("importance_gain"))
    f = feature_names_df(nodes.sparkSession, names)
    return (f.join(agg, "featureIndex", "left")
            .select("feature", F.coalesce("importance_split", F.lit(0).cast("long")).alias("importance_split"),
                    F.coalesce("importance_gain", F.lit(0.0)).alias("importance_gain")))


def normalized_importance(model, names: Sequence[str]) -> DataFrame:
    """Spark's impurity-based importances (sum to 1) as a table."""
    spark = SparkSession.getActiveSession()
    imp = model.featureImportances.toArray()
    return spark.createDataFrame([(n, float(v)) for n, v in zip(names, imp)], "feature string, importance double")


def tree_paths(nodes: DataFrame, class_index: int = 1) -> DataFrame:
    """Every node with depth, path rule text and, for classification
    trees, the class counts and probability of ``class_index``.  Paths
    are built by iterated joins, one per level (depth is small)."""
    n = nodes.select("treeID", "id", "leftChild", "rightChild", "featureIndex", "threshold", "impurity",
                     "rawCount", "impurityStats", "prediction")
    root = n.join(n.select("treeID", F.col("leftChild").alias("id")).unionByName(
        n.select("treeID", F.col("rightChild").alias("id"))), ["treeID", "id"], "left_anti")
    level = root.select("treeID", "id", F.lit(0).alias("depth"), F.lit("").alias("rule"))
    out = level
    while True:
        par = level.join(n, ["treeID", "id"])
        left = par.where(F.col("leftChild") >= 0).select(
            "treeID", F.col("leftChild").alias("id"), (F.col("depth") + 1).alias("depth"),
            F.concat_ws(" AND ", F.when(F.col("rule") != "", F.col("rule")),
                        F.format_string("f%d <= %.6f", "featureIndex", "threshold")).alias("rule"))
        right = par.where(F.col("rightChild") >= 0).select(
            "treeID", F.col("rightChild").alias("id"), (F.col("depth") + 1).alias("depth"),
            F.concat_ws(" AND ", F.when(F.col("rule") != "", F.col("rule")),
                        F.format_string("f%d > %.6f", "featureIndex", "threshold")).alias("rule"))
        level = left.unionByName(right).cache()
        if level.isEmpty():
            break
        out = out.unionByName(level)
    res = out.join(n, ["treeID", "id"])
    tot = F.aggregate("impurityStats", F.lit(0.0), lambda s, v: s + v)
    return res.select("treeID", "id", "depth", "rule", (F.col("leftChild") < 0).alias("is_leaf"),
                      "featureIndex", "threshold", F.col("impurity").alias("gini"), "rawCount",
                      "impurityStats", F.when(tot > 0, F.element_at("impurityStats", class_index + 1) / tot)
                      .alias("class_probability"), "prediction")


# ------------------------------------------------------------ tree SHAP

def _compile_tree(rows: pd.DataFrame):
    """Leaf paths of one tree -> arrays for the vectorised Shapley pass."""
    by_id = {int(r.id): r for r in rows.itertuples(index=False)}
    children = {c for r in by_id.values() for c in (r.leftChild, r.rightChild) if c >= 0}
    root = next(i for i in by_id if i not in children)
    leaves = []  # (value, [(node_feat, thr, go_left, slot)], slot_feats, slot_ratios)

    def walk(nid, path):
        r = by_id[nid]
        if r.leftChild < 0:
            feats, ratios, conds = [], [], []
            for (f, thr, left, ratio) in path:
                if f not in feats:
                    feats.append(f)
                    ratios.append(1.0)
                j = feats.index(f)
                ratios[j] *= ratio
                conds.append((f, thr, left, j))
            leaves.append((float(r.prediction), conds, feats, ratios))
            return
        cover = float(r.rawCount) if r.rawCount > 0 else 1.0
        lc, rc = by_id[int(r.leftChild)], by_id[int(r.rightChild)]
        walk(int(r.leftChild), path + [(int(r.featureIndex), float(r.threshold), True, float(lc.rawCount) / cover)])
        walk(int(r.rightChild), path + [(int(r.featureIndex), float(r.threshold), False, float(rc.rawCount) / cover)])

    walk(root, [])
    L = len(leaves)
    D = max(1, max(len(lf[2]) for lf in leaves))
    P = max(1, max(len(lf[1]) for lf in leaves))
    V = np.array([lf[0] for lf in leaves])
    feat = -np.ones((L, D), dtype=np.int64)
    R = np.ones((L, D))
    cf = np.zeros((L, P), dtype=np.int64)
    ct = np.zeros((L, P))
    cl = np.ones((L, P), dtype=bool)
    cs = np.zeros((L, P), dtype=np.int64)
    cv = np.zeros((L, P), dtype=bool)
    for i, (_, conds, feats, ratios) in enumerate(leaves):
        feat[i, :len(feats)] = feats
        R[i, :len(ratios)] = ratios
        for p, (f, thr, left, j) in enumerate(conds):
            cf[i, p], ct[i, p], cl[i, p], cs[i, p], cv[i, p] = f, thr, left, j, True
    return V, feat, R, cf, ct, cl, cs, cv, D


def _shapley(A: np.ndarray, R: np.ndarray, V: np.ndarray):
    """For every path slot the contribution of each leaf (rows x leaves), where
    ``A`` (rows x leaves x slots) says which slots the row follows."""
    n, L, D = A.shape
    w = np.array([math.factorial(k) * math.factorial(D - 1 - k) / math.factorial(D) for k in range(D)])
    for i in range(D):
        poly = np.zeros((n, L, D))
        poly[:, :, 0] = 1.0
        for j in range(D):
            if j == i:
                continue
            a, r = A[:, :, j], R[:, j]
            nxt = poly * r[None, :, None]
            nxt[:, :, 1:] += poly[:, :, :-1] * a[:, :, None]
            poly = nxt
        yield (poly * w[None, None, :]).sum(axis=2) * (A[:, :, i] - R[None, :, i]) * V[None, :]


TABLE_SLOTS = 8         # path slots (distinct features of a path) up to which a leaf's contributions are a table


def _shap_tables(compiled):
    """A row meets a leaf by which of its slots it follows, one of 2^D patterns: the
    contributions of every (leaf, slot) by pattern, pairs in the order of features."""
    V, feat, R, cf, ct, cl, cs, cv, D = compiled
    patterns = 1 << D
    follows = ((np.arange(patterns)[:, None] >> np.arange(D)) & 1 == 0).astype(float)      # a set bit is a slot not followed
    each = np.stack(list(_shapley(np.broadcast_to(follows[:, None, :], (patterns, len(V), D)), R, V)), axis=2)   # pattern, leaf, slot
    leaf, slot = np.nonzero(feat >= 0)
    order = np.argsort(feat[leaf, slot], kind="stable")
    leaf, slot = leaf[order], slot[order]
    used, first = np.unique(feat[leaf, slot], return_index=True)
    bias = float((V * np.prod(R, axis=1)).sum())
    return cf, ct, cl, cs, cv, leaf, np.ascontiguousarray(each[:, leaf, slot].T), used, first, bias


def _shap_by_table(X: np.ndarray, tables, n_features: int):
    cf, ct, cl, cs, cv, leaf, values, used, first, bias = tables
    x, phi = np.ascontiguousarray(X.T), np.zeros((n_features, len(X)))
    if not len(leaf):
        return phi.T, bias
    missed = np.zeros((len(cf), len(X)), np.uint8)
    for p in range(cf.shape[1]):
        ok = x[cf[:, p]] <= ct[:, p, None]
        missed |= ((ok != cl[:, p, None]) & cv[:, p, None]).view(np.uint8) << cs[:, p, None].astype(np.uint8)
    at = missed[leaf].astype(np.intp)
    at += (np.arange(len(leaf)) * values.shape[1])[:, None]
    phi[used] = np.add.reduceat(values.ravel().take(at), first, axis=0)
    return phi.T, bias


def _shap_tree(X: np.ndarray, compiled, n_features: int):
    V, feat, R, cf, ct, cl, cs, cv, D = compiled
    n, L = X.shape[0], V.shape[0]
    A = np.ones((n, L, D))
    rows_l = np.arange(L)
    for p in range(cf.shape[1]):
        x = X[:, cf[:, p]]                                   # n x L
        ok = np.where(cl[:, p], x <= ct[:, p], ~(x <= ct[:, p]))
        ok = np.where(cv[:, p], ok, True)
        A[:, rows_l, cs[:, p]] *= ok
    phi = np.zeros((n, n_features))
    for i, c in enumerate(_shapley(A, R, V)):                # n x L
        f = feat[:, i]
        valid = f >= 0
        if valid.any():
            np.add.at(phi.T, f[valid], c[:, valid].T)
    bias = float((V * np.prod(R, axis=1)).sum())
    return phi, bias


def tree_values(rows: pd.DataFrame):
    """The prediction of one tree as a function of a matrix of rows."""
    rows = rows.set_index("id")
    place = {int(i): k for k, i in enumerate(rows.index)}
    leaf = rows["leftChild"].to_numpy() < 0
    feature = np.where(leaf, 0, rows["featureIndex"].to_numpy()).astype(np.int64)
    cut = np.where(leaf, 0.0, rows["threshold"].to_numpy().astype(float))
    left, right = (np.array([place.get(int(c), k) for k, c in enumerate(rows[side])]) for side in ("leftChild", "rightChild"))
    value, root = rows["prediction"].to_numpy().astype(float), (set(range(len(rows))) - {place[int(c)] for s in ("leftChild", "rightChild") for c in rows[s] if c >= 0}).pop()

    def run(x: np.ndarray) -> np.ndarray:
        at, each = np.full(len(x), root), np.arange(len(x))
        while not leaf[at].all():
            at = np.where(x[each, feature[at]] <= cut[at], left[at], right[at])
        return value[at]

    return run


def compile_ensemble(nodes: DataFrame, compiled=_compile_tree):
    """Driver-side: the (bounded) node table -> compiled trees and weights."""
    pdf = nodes.select("treeID", "weight", "id", "prediction", "rawCount", "leftChild", "rightChild",
                       "featureIndex", "threshold").toPandas()
    out = []
    for tid, g in pdf.groupby("treeID", sort=True):
        out.append((float(g["weight"].iloc[0]), compiled(g)))
    return out


SHAP_ROWS = 2048       # rows of one numpy step
ITEM = "struct<feature:string,value:double,contribution:double>"


def tree_contribution_rows(nodes: DataFrame, df: DataFrame, features_col: str, names: Sequence[str],
                           keys: Sequence[str], scale: float = 2.0) -> DataFrame:
    """Per-row additive contributions on the log-odds scale, one array per row.

    Spark's GBT margin is Σ w_t tree_t(x) and P(y=1) = sigmoid(2·margin),
    so ``scale=2`` expresses contributions in log-odds; the row's
    ``base_score`` (expected log-odds) plus its contributions equals
    logit(P).  Output: keys, ``contributions`` (feature, value, contribution
    in the order of ``names``), base_score."""
    trees = [(w, (_shap_by_table, _shap_tables(c)) if c[-1] <= TABLE_SLOTS else (_shap_tree, c)) for w, c in compile_ensemble(nodes)]
    names, nf = list(names), len(names)
    src = df.select(*keys, vector_to_array(features_col).alias("__x"))
    schema = T.StructType([*src.schema.fields[:len(keys)], T.StructField("__x", T.ArrayType(T.DoubleType())),
                           T.StructField("__phi", T.ArrayType(T.DoubleType())), T.StructField("base_score", T.DoubleType())])

    def fn(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, SHAP_ROWS):
                b = batch.slice(at, SHAP_ROWS)
                x = b.column(len(keys)).flatten().to_numpy(zero_copy_only=False).astype(float).reshape(b.num_rows, nf)
                phi, bias = np.zeros(x.shape), 0.0
                for wt, (contributions, comp) in trees:
                    p, base = contributions(x, comp, nf)
                    phi += wt * p
                    bias += wt * base
                offsets = pa.array(np.arange(0, (b.num_rows + 1) * nf, nf), pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [*b.columns, pa.ListArray.from_arrays(offsets, pa.array((phi * scale).ravel())),
                     pa.array(np.full(b.num_rows, bias * scale))], names=schema.fieldNames())

    from ..session import ship_package
    ship_package(src.sparkSession)
    items = F.transform(F.arrays_zip(F.array(*[F.lit(n) for n in names]), "__x", "__phi"), lambda z: z.cast(ITEM))
    return src.mapInArrow(fn, schema).select(*keys, items.alias("contributions"), "base_score")


def tree_contributions(nodes: DataFrame, df: DataFrame, features_col: str, names: Sequence[str],
                       keys: Sequence[str], scale: float = 2.0) -> DataFrame:
    """X6 in long form: keys, feature, value, contribution, base_score."""
    return long_contributions(tree_contribution_rows(nodes, df, features_col, names, keys, scale), keys)


def wide_contributions(rows: DataFrame, keys: Sequence[str], names: Sequence[str], prefix: str = "") -> DataFrame:
    """One column per feature, taken from the row's array by place
    (``names`` in the order of the array)."""
    return rows.select(*keys, *[F.col("contributions")[i]["contribution"].alias(f"{prefix}{n}") for i, n in enumerate(names)])


# ------------------------------------------------------------ contribution tables

def contribution_rows(long: DataFrame, keys: Sequence[str]) -> DataFrame:
    """A long contribution table brought into rows (keys, contributions,
    base_score); the arrays are as long as a row has features."""
    value = F.col("value") if "value" in long.columns else F.lit(None)
    base = F.first("base_score") if "base_score" in long.columns else F.lit(None).cast("double")
    item = F.struct("feature", value.cast("double").alias("value"), F.col("contribution").cast("double").alias("contribution"))
    return long.groupBy(*keys).agg(F.array_sort(F.collect_list(item)).alias("contributions"), base.alias("base_score"))


def long_contributions(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per (keys, feature) of row-wise contributions."""
    return rows.select(*keys, F.inline("contributions"), "base_score")


def linear_contributions(df: DataFrame, keys: Sequence[str], coefs: Mapping[str, float],
                         base: float = 0.0) -> DataFrame:
    """Deterministic additive attribution coef * z(x) over standardised
    columns (population std), one array per row as for tree contributions."""
    cols = list(coefs)
    stats = df.agg(*[F.avg(c).alias(f"__m_{c}") for c in cols], *[F.stddev_pop(c).alias(f"__s_{c}") for c in cols])
    j = df.crossJoin(F.broadcast(stats))
    structs = []
    for c in cols:
        s = F.col(f"__s_{c}")
        z = (F.col(c) - F.col(f"__m_{c}")) / F.when((s == 0) | s.isNull(), F.lit(1.0)).otherwise(s)
        structs.append(F.struct(F.lit(c).alias("feature"), F.col(c).cast("double").alias("value"),
                                (F.lit(float(coefs[c])) * z).alias("contribution")))
    return j.select(*keys, F.array(*structs).alias("contributions"), F.lit(float(base)).alias("base_score"))


def _total(part) -> Column:
    """Sum of ``part(contribution)`` over the row's array."""
    return F.aggregate("contributions", F.lit(0.0), lambda acc, x: acc + F.coalesce(part(x["contribution"]), F.lit(0.0)))


def margin() -> Column:
    """Base score plus all contributions of the row (log-odds)."""
    return F.col("base_score") + _total(lambda c: c)


def contribution_summary(rows: DataFrame) -> DataFrame:
    """Per feature mean, population std and share of positive contributions."""
    return long_contributions(rows, []).groupBy("feature").agg(
        F.avg("contribution").alias("average_contribution"), F.stddev_pop("contribution").alias("std_contribution"),
        F.avg((F.col("contribution") > 0).cast("double")).alias("positive_contrib_ratio"))


def mean_abs_contribution(rows: DataFrame) -> DataFrame:
    """Global importance = mean |contribution|."""
    return long_contributions(rows, []).groupBy("feature").agg(F.avg(F.abs("contribution")).alias("avg_abs_contrib"))


def pos_neg_totals(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Per row, sum of positive and of negative contributions, in the row."""
    return rows.select(*keys, _total(lambda c: F.when(c > 0, c)).alias("positive_total"),
                       _total(lambda c: F.when(c < 0, c)).alias("negative_total"))


def normalized(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """c / Σ|c| of the row, 0 when Σ|c| = 0; the sum is taken in the row and
    the array then opened."""
    tot = _total(lambda c: F.abs(c))
    share = F.coalesce(F.try_divide(F.col("contribution"), F.col("__total")), F.lit(0.0))
    return rows.select(*keys, F.inline("contributions"), "base_score", tot.alias("__total")).withColumn(
        "normalized_contribution", share).drop("__total")


def _ranked(k: int) -> Column:
    """The row's k largest |contribution| (ties -> feature name) as (order, feature,
    value, contribution)."""
    by_size = F.transform("contributions", lambda x: F.struct((-F.abs(x["contribution"])).alias("order"), x["feature"].alias("feature"),
                                                              x["value"].alias("value"), x["contribution"].alias("contribution")))
    return F.slice(F.array_sort(by_size), 1, k)


def top_per_row(rows: DataFrame, keys: Sequence[str], k: int = 15) -> DataFrame:
    """The k largest |contribution| per row (ties -> feature name), sorted in the row."""
    t = rows.select(*keys, "base_score", F.posexplode(_ranked(k)).alias("__at", "__x"))
    return t.select(*keys, "__x.feature", "__x.value", "__x.contribution", "base_score", (F.col("__at") + 1).alias("rank"))


def waterfall(rows: DataFrame, keys: Sequence[str], k: int = 15) -> DataFrame:
    """Base score, then the top-k contributions (by |c|) with negatives
    first and each sign ascending; running total on the log-odds scale,
    plus its probability.  Sorted and summed in the row."""
    by_sign = F.array_sort(F.transform(_ranked(k), lambda x: F.struct(
        (x["contribution"] >= 0).cast("int").alias("sign"), x["contribution"].alias("contribution"), x["feature"].alias("feature"),
        x["value"].alias("value"))))
    start = F.struct(F.col("base_score").alias("total"), F.array().cast("array<double>").alias("totals"))

    def add(acc, x):
        total = acc["total"] + x["contribution"]
        return F.struct(total.alias("total"), F.array_append(acc["totals"], total).alias("totals"))

    t = rows.select(*keys, "base_score", by_sign.alias("__steps"))
    t = t.withColumn("__totals", F.aggregate("__steps", start, add, lambda acc: acc["totals"]))
    t = t.select(*keys, "base_score", F.posexplode(F.arrays_zip("__steps", "__totals")).alias("__at", "__x"))
    t = t.select(*keys, "__x.__steps.feature", "__x.__steps.value", "__x.__steps.contribution", "base_score",
                 (F.col("__at") + 1).alias("step"), F.col("__x.__totals").alias("running_total"))
    return t.withColumn("running_probability", F.lit(1.0) / (F.lit(1.0) + F.exp(-F.col("running_total"))))


def first_n_per_class(df: DataFrame, cls: str, order: Sequence[str], n: int, classes=(0, 1)) -> DataFrame:
    """First ``n`` rows of each class in key order — one top-k per
    class (per-partition top-k, then merge), so a large class never lands
    on one task."""
    parts = [df.where(F.col(cls) == c).orderBy(*order).limit(n) for c in classes]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def mean_deviation(df: DataFrame, keys: Sequence[str], cols: Sequence[str],
                   pos_label: str = "positive", neg_label: str = "negative") -> DataFrame:
    """Value minus the column mean; above the mean -> positive."""
    means = df.agg(*[F.avg(c).alias(f"__m_{c}") for c in cols])
    j = df.crossJoin(F.broadcast(means))
    structs = [F.struct(F.lit(c).alias("feature"), F.col(c).cast("double").alias("value"),
                        (F.col(c) - F.col(f"__m_{c}")).alias("deviation"),
                        F.when(F.col(c) > F.col(f"__m_{c}"), F.lit(pos_label)).otherwise(F.lit(neg_label))
                        .alias("direction")) for c in cols]
    return j.select(*keys, F.inline(F.array(*structs)))


def corr_with_target(df: DataFrame, cols: Sequence[str], target: str) -> DataFrame:
    """Pearson correlation of each column with the target (NULL for
    a constant column), one aggregate pass."""
    from ..functions.exact import safe_corr
    one = df.agg(*[safe_corr(c, target).alias(c) for c in cols])
    return one.unpivot([], list(cols), "feature", "correlation")


def direction_label(c: str | Column, pos: str = "positive", neg: str = "negative", none: str = "none") -> Column:
    """Sign of a correlation; NULL falls to ``none``."""
    col = F.col(c) if isinstance(c, str) else c
    return F.when(col > 0, F.lit(pos)).when(col < 0, F.lit(neg)).otherwise(F.lit(none))


def importance_direction(importance: DataFrame, corr: DataFrame) -> DataFrame:
    """Importance ⟕ correlation on feature name, with direction."""
    return importance.join(F.broadcast(corr), "feature", "left").withColumn("direction", direction_label("correlation"))
