"""Segmentation.

Point sets are DataFrames with an ``array<double>`` vector column.
Centroids are a bounded (k x d) relation packed into one row and
broadcast; distances are array higher-order functions, so assignment
and the squared-Euclidean silhouette are O(n·k) with no pairwise join.
K-means (best of ``n_init`` seeds) runs all starts in shared passes (``kmeans.py``).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import PCA
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import kmeans


def as_double_array(c: str | Column) -> Column:
    col = F.col(c) if isinstance(c, str) else c
    return F.transform(col, lambda x: x.cast("double"))


def centroids_by_label(points: DataFrame, vec: str, label: str) -> DataFrame:
    """Mean vector per label (per-dimension averages, reassembled in order)."""
    e = points.select(F.col(label).alias("label"), F.posexplode(as_double_array(vec)).alias("pos", "x"))
    m = e.groupBy("label", "pos").agg(F.avg("x").alias("x"))
    return m.groupBy("label").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("pos", "x"))), lambda s: s["x"]).alias("centroid"))


def sq_dist(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: (x - y) * (x - y)), F.lit(0.0), lambda s, v: s + v)


def nearest_centroid(points: DataFrame, vec: str, centroids: DataFrame) -> DataFrame:
    """Label of the closest centroid (squared Euclidean; ties -> the
    smaller label) and the Euclidean distance to it."""
    packed = centroids.agg(F.collect_list(F.struct("label", "centroid")).alias("__cs"))
    j = points.crossJoin(F.broadcast(packed))  # one row, k x d values
    v = as_double_array(vec)
    d = F.transform("__cs", lambda c: F.struct(sq_dist(v, c["centroid"]).alias("d2"), c["label"].alias("label")))
    best = F.array_min(d)
    return j.withColumn("nearest", best["label"]).withColumn("distance", F.sqrt(best["d2"])).drop("__cs")


def silhouette_sq(points: DataFrame, vec: str, label: str) -> DataFrame:
    """C5 (squared Euclidean, exact, O(n·k)): per point
    a = Σ_{j in own} |x-x_j|² / (n_own - 1), b = min over other clusters of
    Σ |x-x_j|² / n_c, using Σ|x-x_j|² = n|x|² - 2 x·S + Q per cluster;
    s = (b - a) / max(a, b), singletons 0.  Returns the mean and per-cluster means."""
    v = as_double_array(vec)
    p = points.select(F.col(label).alias("label"), v.alias("x"))
    p = p.withColumn("xx", F.aggregate(F.transform("x", lambda t: t * t), F.lit(0.0), lambda s, t: s + t))
    e = p.select("label", "xx", F.posexplode("x").alias("pos", "xi"))
    sums = e.groupBy("label", "pos").agg(F.sum("xi").alias("s"))
    cl = (sums.groupBy("label").agg(F.transform(F.array_sort(F.collect_list(F.struct("pos", "s"))),
                                                lambda r: r["s"]).alias("S"))
          .join(p.groupBy("label").agg(F.count(F.lit(1)).alias("n"), F.sum("xx").alias("Q")), "label"))
    packed = cl.agg(F.collect_list(F.struct("label", "S", "n", "Q")).alias("__cl"))
    j = p.crossJoin(F.broadcast(packed))

    def total(c):
        dot = F.aggregate(F.zip_with(F.col("x"), c["S"], lambda a, b: a * b), F.lit(0.0), lambda s, t: s + t)
        return c["n"] * F.col("xx") - 2.0 * dot + c["Q"]

    own = F.filter("__cl", lambda c: c["label"] == F.col("label"))[0]
    a = F.when(own["n"] > 1, total(own) / (own["n"] - 1))
    others = F.transform(F.filter("__cl", lambda c: c["label"] != F.col("label")),
                         lambda c: total(c) / c["n"])
    b = F.array_min(others)
    s = F.when((own["n"] <= 1) | b.isNull(), F.lit(0.0)).otherwise(
        F.coalesce(F.try_divide(b - a, F.greatest(a, b)), F.lit(0.0)))
    return j.select("label", s.alias("silhouette"))


def profile(df: DataFrame, label: str, numeric: Sequence[str], modes: Sequence[str] = (),
            size_col: str = "cluster_size", money: Sequence[str] = ()) -> DataFrame:
    """Mean of each numeric column, most frequent value of each
    ``modes`` column (ties -> smallest value), and the group size.
    ``money`` columns (2 decimals) are averaged from an exact sum."""
    from ..functions.exact import exact_avg
    out = df.groupBy(label).agg(*[(exact_avg(c) if c in money else F.avg(c)).alias(c) for c in numeric],
                                F.count(F.lit(1)).cast("long").alias(size_col))
    for c in modes:
        cnt = df.groupBy(label, c).agg(F.count(F.lit(1)).alias("__n"))
        top = cnt.groupBy(label).agg(F.min_by(F.col(c), F.struct(-F.col("__n"), F.col(c))).alias(f"{c}_mode"))
        out = out.join(top, label, "left")
    return out


def share(df: DataFrame, size_col: str = "cluster_size", out: str = "cluster_percentage") -> DataFrame:
    """Size as a percentage of all sizes (the unpartitioned window
    runs over one row per group)."""
    return df.withColumn(out, F.col(size_col) / F.sum(size_col).over(Window.partitionBy()) * 100.0)


def rule_ladder(rules: Sequence[tuple[str, Column]], default: Column) -> Column:
    """First matching rule wins; otherwise ``default``."""
    expr = None
    for name, cond in rules:
        expr = F.when(cond, F.lit(name)) if expr is None else expr.when(cond, F.lit(name))
    return default if expr is None else expr.otherwise(default)


def rename_segments(df: DataFrame, col: str, mapping: Mapping[str, str], out: str) -> DataFrame:
    """Map names through a literal table (unmapped -> NULL)."""
    m = F.create_map(*[F.lit(x) for kv in mapping.items() for x in kv])
    return df.withColumn(out, F.try_element_at(m, F.col(col)))


def quartiles(df: DataFrame, label: str, cols: Sequence[str], approx: bool = False) -> DataFrame:
    """Min, q1, median, q3, max of each column per group — exact
    linear-interpolated percentiles computed from rank ranges (no group
    held by one task), or sketches with ``approx``."""
    qs = [0.0, 0.25, 0.5, 0.75, 1.0]
    names = ["min", "q1", "median", "q3", "max"]
    if approx:
        g = df.groupBy(label).agg(*[F.percentile_approx(c, qs, 10000).alias(f"__{c}") for c in cols])
        rows = [F.struct(F.lit(c).alias("feature"), *[F.col(f"__{c}")[i].cast("double").alias(n)
                                                       for i, n in enumerate(names)]) for c in cols]
        return g.select(label, F.inline(F.array(*rows)))
    from ..functions.ranges import grouped_quantiles
    long = df.select(label, F.inline(F.array(*[F.struct(F.lit(c).alias("feature"),
                                                         F.col(c).cast("double").alias("__x")) for c in cols])))
    q = grouped_quantiles(long, [label, "feature"], "__x", qs)
    return (q.groupBy(label, "feature").pivot("quantile", qs).agg(F.first("value"))
            .select(label, "feature", *[F.col(f"`{q}`").alias(n) for q, n in zip(qs, names)]))


# ------------------------------------------------------------------ Spark ML

def kmeans_fit(points: DataFrame, vec: str, k: int, seeds: Sequence[int] = tuple(range(42, 52)),
               max_iter: int = 300, tol: float = 1e-4):
    """K-means|| from ``len(seeds)`` starts, keep the lowest cost.
    Returns (centres, cost).  Spark ML draws the starts; their rounds share
    their passes over the points (``operators/kmeans.py``)."""
    data = points.select(array_to_vector(as_double_array(vec)).alias("features")).cache()
    starts = [KMeans(k=k, seed=s, maxIter=0, featuresCol="features").fit(data).clusterCenters() for s in seeds]
    data.unpersist()
    held = kmeans.blocks(points, vec)
    best = min(kmeans.lloyd(held, starts, max_iter, tol), key=lambda r: r[1])
    held.unpersist()
    return best


def kmeans_assign(centres, points: DataFrame, vec: str, out: str = "cluster_label") -> DataFrame:
    """The position of every point's closest centre."""
    table = points.sparkSession.createDataFrame([(j, [float(x) for x in c]) for j, c in enumerate(centres)],
                                                "label int, centroid array<double>")
    return nearest_centroid(points, vec, table).drop("distance").withColumnRenamed("nearest", out)


def kmeans_sweep(points: DataFrame, vec: str, k_max: int = 8, seeds: Sequence[int] = (42, 43, 44)) -> DataFrame:
    """For k = 2..k_max: best cost and mean squared-Euclidean silhouette.
    The starts of all k share their passes over the points, and so do the silhouettes
    (those of ``silhouette_sq``)."""
    spark = points.sparkSession
    wanted = [(k, s) for k in range(2, k_max + 1) for s in seeds]
    held = kmeans.blocks(points, vec)
    fits = kmeans.lloyd(held, kmeans.starts(held, wanted))
    best = {k: min((f for f, (kk, _) in zip(fits, wanted) if kk == k), key=lambda r: r[1]) for k in range(2, k_max + 1)}
    sil = kmeans.silhouettes(held, [centres for centres, _ in best.values()])
    held.unpersist()
    rows = [(k, float(cost), float(v)) for (k, (_, cost)), v in zip(best.items(), sil)]
    return spark.createDataFrame(rows, "k int, cost double, silhouette double")


def best_k(sweep: DataFrame) -> DataFrame:
    """C4: k with the highest silhouette."""
    return sweep.agg(F.max_by("k", "silhouette").alias("best_k"), F.max("silhouette").alias("silhouette"))


def pca2(points: DataFrame, vec: str, k: int = 2):
    """First ``k`` principal components and explained variance ratios;
    each component's sign is fixed so its largest-|loading| entry is
    positive.  Returns (projected DataFrame, explained variance list)."""
    data = points.withColumn("features", array_to_vector(as_double_array(vec)))
    model = PCA(k=k, inputCol="features", outputCol="__pc").fit(data)
    pc = model.pc.toArray()
    signs = [1.0 if pc[abs(pc[:, j]).argmax(), j] >= 0 else -1.0 for j in range(k)]
    out = model.transform(data).withColumn("__a", vector_to_array("__pc"))
    out = out.withColumns({f"pc{j + 1}": F.col("__a")[j] * F.lit(signs[j]) for j in range(k)})
    return out.drop("features", "__pc", "__a"), list(model.explainedVariance.toArray())
