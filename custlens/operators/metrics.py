"""Model evaluation as DataFrame aggregates.

Ranking metrics (ROC-AUC, PR-AUC) need cumulative class counts in
global score order.  A window without ``partitionBy`` would pull every
row into one task, so they are computed as:

1. aggregate to one row per *distinct* score (ties collapse; partial
   aggregation map-side);
2. cut the distinct scores into ``buckets`` ranges at approximate
   quantiles (a one-row aggregate of bounded size inside the plan), so
   every range holds about the same number of distinct scores;
3. per-range totals (``buckets`` rows) -> exclusive running offsets;
4. running sums inside each range (window partitioned by range) plus the
   range offset give the exact global cumulative counts.

Every step is exact except the choice of split points, which only
affects balance, never the result.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def binarize(score: str | Column, threshold: float = 0.5, strict: bool = True) -> Column:
    """P8 (``> t``) / P7 (``>= t``) as an int class column."""
    s = F.col(score) if isinstance(score, str) else score
    return ((s > threshold) if strict else (s >= threshold)).cast("int")


def accuracy(df: DataFrame, label: str, pred: str) -> DataFrame:
    """V1."""
    return df.agg(F.avg((F.col(label) == F.col(pred)).cast("double")).alias("accuracy"),
                  F.count(F.lit(1)).cast("long").alias("rows"))


def confusion_matrix(df: DataFrame, label: str, pred: str, classes=(0, 1)) -> DataFrame:
    """V5: one row per (actual, predicted) pair, zero-filled."""
    spark = df.sparkSession
    pairs = spark.createDataFrame([(a, p) for a in classes for p in classes], "actual int, predicted int")
    counts = df.groupBy(F.col(label).cast("int").alias("actual"),
                        F.col(pred).cast("int").alias("predicted")).agg(
        F.count(F.lit(1)).cast("long").alias("count"))
    return (F.broadcast(pairs).join(counts, ["actual", "predicted"], "left")
            .select("actual", "predicted", F.coalesce("count", F.lit(0).cast("long")).alias("count")))


def classification_report(df: DataFrame, label: str, pred: str, classes=(0, 1)) -> DataFrame:
    """V4: precision / recall / f1 / support per class, then accuracy,
    macro and weighted averages (zero denominators give 0)."""
    y, p = F.col(label).cast("int"), F.col(pred).cast("int")
    aggs = [F.count(F.lit(1)).alias("n"), F.sum((y == p).cast("long")).alias("correct")]
    for c in classes:
        aggs += [F.sum(((y == c) & (p == c)).cast("long")).alias(f"tp{c}"),
                 F.sum((p == c).cast("long")).alias(f"pp{c}"),
                 F.sum((y == c).cast("long")).alias(f"sup{c}")]
    one = df.agg(*aggs)

    def sdiv(a, b):
        return F.when(b == 0, F.lit(0.0)).otherwise(a.cast("double") / b)

    rows, prec, rec, f1 = [], {}, {}, {}
    for c in classes:
        prec[c] = sdiv(F.col(f"tp{c}"), F.col(f"pp{c}"))
        rec[c] = sdiv(F.col(f"tp{c}"), F.col(f"sup{c}"))
        f1[c] = sdiv(2 * prec[c] * rec[c], prec[c] + rec[c])
        rows.append(F.struct(F.lit(str(c)).alias("class_label"), prec[c].alias("precision"),
                             rec[c].alias("recall"), f1[c].alias("f1_score"),
                             F.col(f"sup{c}").cast("long").alias("support")))
    n, k = F.col("n"), len(classes)
    acc = sdiv(F.col("correct"), n)
    rows.append(F.struct(F.lit("accuracy").alias("class_label"), acc.alias("precision"),
                         acc.alias("recall"), acc.alias("f1_score"), n.cast("long").alias("support")))
    rows.append(F.struct(F.lit("macro avg").alias("class_label"),
                         (sum(prec.values()) / k).alias("precision"),
                         (sum(rec.values()) / k).alias("recall"),
                         (sum(f1.values()) / k).alias("f1_score"), n.cast("long").alias("support")))
    w = {c: F.col(f"sup{c}") for c in classes}
    rows.append(F.struct(F.lit("weighted avg").alias("class_label"),
                         sdiv(sum(prec[c] * w[c] for c in classes), n).alias("precision"),
                         sdiv(sum(rec[c] * w[c] for c in classes), n).alias("recall"),
                         sdiv(sum(f1[c] * w[c] for c in classes), n).alias("f1_score"),
                         n.cast("long").alias("support")))
    return one.select(F.inline(F.array(*rows)))


def score_counts(df: DataFrame, label: str, score: str) -> DataFrame:
    """Distinct scores with positive / negative counts."""
    y = F.col(label).cast("int")
    return df.where(F.col(score).isNotNull()).groupBy(F.col(score).cast("double").alias("score")).agg(
        F.sum(y).cast("long").alias("pos"), F.sum(1 - y).cast("long").alias("neg"))


def count_less(sorted_arr: Column, x: Column, max_len: int) -> Column:
    """Number of elements of an ascending array that are < x, by binary
    search inside ``aggregate`` (log2(max_len) steps, no per-element scan)."""
    steps = max(1, int(math.ceil(math.log2(max_len + 1))) + 1)
    init = F.struct(F.lit(0).alias("lo"), F.size(sorted_arr).alias("hi"))

    def step(acc, _i):
        lo, hi = acc["lo"], acc["hi"]
        mid = F.floor((lo + hi) / 2).cast("int")
        go_right = (lo < hi) & (F.element_at(sorted_arr, mid + 1) < x)
        new_lo = F.when(go_right, mid + 1).otherwise(lo)
        new_hi = F.when((lo < hi) & ~go_right, mid).otherwise(hi)
        return F.struct(new_lo.alias("lo"), new_hi.alias("hi"))

    return F.aggregate(F.sequence(F.lit(1), F.lit(steps)), init, step, lambda acc: acc["lo"])


def cumulative_by_score(counts: DataFrame, descending: bool, buckets: int = 1024,
                        accuracy: int = 10000) -> DataFrame:
    """Exact inclusive running (pos, neg) over distinct scores in global
    order without a single-partition window (see module doc).  Range
    split points are approximate quantiles computed inside the same plan
    (a one-row aggregate, so the distinct-score exchange is reused);
    also returns the overall totals ``total_pos`` / ``total_neg``."""
    probs = [i / buckets for i in range(1, buckets)]
    splits = counts.agg(F.percentile_approx("score", probs, accuracy).alias("_sp")) if probs else None
    if splits is not None:
        b = counts.crossJoin(F.broadcast(splits)).withColumn(
            "_b", count_less(F.col("_sp"), F.col("score"), len(probs))).drop("_sp")
    else:
        b = counts.withColumn("_b", F.lit(0))
    if descending:
        b = b.withColumn("_b", -F.col("_b"))
    # per-range totals: at most ``buckets`` rows, so the unpartitioned
    # windows below are bounded by the bucket count, not by the data.
    tot = b.groupBy("_b").agg(F.sum("pos").alias("_bp"), F.sum("neg").alias("_bn"))
    wo = Window.orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    wa = Window.partitionBy()
    off = tot.select("_b", F.coalesce(F.sum("_bp").over(wo), F.lit(0)).alias("_op"),
                     F.coalesce(F.sum("_bn").over(wo), F.lit(0)).alias("_on"),
                     F.sum("_bp").over(wa).alias("total_pos"), F.sum("_bn").over(wa).alias("total_neg"))
    order = F.col("score").desc() if descending else F.col("score").asc()
    wi = Window.partitionBy("_b").orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    return (b.join(F.broadcast(off), "_b")
            .select("score", "pos", "neg", "total_pos", "total_neg",
                    (F.sum("pos").over(wi) + F.col("_op")).alias("cum_pos"),
                    (F.sum("neg").over(wi) + F.col("_on")).alias("cum_neg")))


def roc_auc(df: DataFrame, label: str, score: str, buckets: int = 1024) -> DataFrame:
    """V2: exact ROC-AUC, tied scores count half (Mann-Whitney)."""
    cum = cumulative_by_score(score_counts(df, label, score), descending=False, buckets=buckets)
    # negatives strictly below this score = cum_neg - neg
    part = cum.agg(F.sum(F.col("pos") * (F.col("cum_neg") - F.col("neg") + 0.5 * F.col("neg"))).alias("u"),
                   F.sum("pos").alias("p"), F.sum("neg").alias("n"))
    return part.select(F.when((F.col("p") == 0) | (F.col("n") == 0), F.lit(None).cast("double"))
                       .otherwise(F.col("u") / (F.col("p") * F.col("n"))).alias("roc_auc"),
                       F.col("p").cast("long").alias("positives"),
                       F.col("n").cast("long").alias("negatives"))


def pr_curve(df: DataFrame, label: str, score: str, buckets: int = 1024) -> DataFrame:
    """V3: precision / recall at every distinct score threshold (score
    desc), each row also carrying the previous point, which is derived
    from its own counts (no lag across ranges needed)."""
    cum = cumulative_by_score(score_counts(df, label, score), descending=True, buckets=buckets)
    c = cum.withColumn("_P", F.col("total_pos"))
    tp, fp = F.col("cum_pos"), F.col("cum_neg")
    tp0, fp0 = tp - F.col("pos"), fp - F.col("neg")
    rec = F.when(F.col("_P") == 0, F.lit(1.0)).otherwise(tp / F.col("_P"))
    rec0 = F.when(F.col("_P") == 0, F.lit(1.0)).otherwise(tp0 / F.col("_P"))
    prec = tp / (tp + fp)
    prec0 = F.when(tp0 + fp0 == 0, F.lit(1.0)).otherwise(tp0 / (tp0 + fp0))
    rec0 = F.when(tp0 + fp0 == 0, F.lit(0.0)).otherwise(rec0)
    return c.select(F.col("score").alias("threshold"), prec.alias("precision"), rec.alias("recall"),
                    prec0.alias("prev_precision"), rec0.alias("prev_recall"))


def pr_auc(df: DataFrame, label: str, score: str, buckets: int = 1024) -> DataFrame:
    """V3: trapezoid area under the PR curve, curve closed at (recall 0,
    precision 1)."""
    c = pr_curve(df, label, score, buckets)
    area = (F.col("recall") - F.col("prev_recall")) * (F.col("precision") + F.col("prev_precision")) / 2
    return c.agg(F.sum(area).alias("pr_auc"), F.count(F.lit(1)).cast("long").alias("thresholds"))


def rmse(df: DataFrame, actual: str, predicted: str, group: tuple = ()) -> DataFrame:
    """V6: root mean squared error and mean absolute error."""
    e = F.col(actual) - F.col(predicted)
    return df.groupBy(*group).agg(F.sqrt(F.avg(e * e)).alias("rmse"),
                                  F.avg(F.abs(e)).alias("mae"),
                                  F.count(F.lit(1)).cast("long").alias("rows"))


def select_high_value(df: DataFrame, score: str, threshold: float = 0.7) -> DataFrame:
    """M9: rows with score >= threshold (the caller orders by score desc)."""
    return df.where(F.col(score) >= threshold)


def selection_report(df: DataFrame, label: str, score: str, threshold: float = 0.7) -> DataFrame:
    """Selected count, share of all rows, actual-positive rate of the selection."""
    sel = F.col(score) >= threshold
    return df.agg(F.count_if(sel).cast("long").alias("selected"),
                  F.count(F.lit(1)).cast("long").alias("rows"),
                  (F.count_if(sel) / F.count(F.lit(1))).alias("selected_share"),
                  F.avg(F.when(sel, F.col(label).cast("double"))).alias("selected_positive_rate"))
