"""Plans for segmentation and encoding.

Two point sets: the embedding vectors (64-d, fixed labels) and a
customer snapshot — each customer's latest month joined to the customer
table — segmented by its asset level (a fixed, data-derived labelling,
so profiles and naming rules can be checked exactly).
"""

from __future__ import annotations

from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Window
from pyspark.sql import functions as F

from .. import presets as ps
from ..operators import bi, encode, segment
from ..sources import bindings as bd
from ..sources.tables import read
from ..functions.exact import exact_avg, exact_avg_sql
from ..session import cut_lineage
from .features_plans import FEATURES_SQL, _features
from .registry import plan, rnd, rsql

NUM = ["total_assets", "deposit_balance", "financial_balance", "fund_balance", "insurance_balance",
       "product_count", "txn_count", "monthly_income"]
MONEY = ["total_assets", "deposit_balance", "financial_balance", "fund_balance", "insurance_balance",
         "monthly_income"]


def _avg_sql(c):
    return exact_avg_sql(c) if c in MONEY else f"avg({c})"


# ------------------------------------------------------------ snapshot

def snapshot(spark, sf):
    b = bd.behaviour(spark, sf)
    w = Window.partitionBy("customer_id").orderBy(F.col("stat_month").desc())
    last = b.withColumn("__r", F.row_number().over(w)).where(F.col("__r") == 1).drop("__r")
    s = last.join(bd.base(spark, sf), "customer_id")
    s = s.withColumn("cluster_label", bi.bin_index("total_assets", ps.DRIVER_LEVEL_EDGES))
    # one row per customer, written once: codes, means and modes read it, not the orders
    return encode.label_encode(cut_lineage(s), "occupation_type")


SNAP_SQL = f"""
WITH b AS ({bd.BEHAVIOUR_SQL}),
l AS (SELECT * FROM b QUALIFY row_number() OVER (PARTITION BY customer_id ORDER BY stat_month DESC) = 1),
s AS (SELECT l.*, base.name, base.occupation_type, base.nation, base.city_level, base.monthly_income,
             CASE WHEN l.total_assets < {ps.DRIVER_LEVEL_EDGES[0]} THEN 0 WHEN l.total_assets < {ps.DRIVER_LEVEL_EDGES[1]} THEN 1
                  WHEN l.total_assets < {ps.DRIVER_LEVEL_EDGES[2]} THEN 2 ELSE 3 END AS cluster_label
      FROM l JOIN ({bd.BASE_SQL}) base ON l.customer_id = base.customer_id),
enc AS (SELECT occupation_type AS v, dense_rank() OVER (ORDER BY occupation_type) - 1 AS occupation_type_encoded
        FROM (SELECT DISTINCT occupation_type FROM s WHERE occupation_type IS NOT NULL))
SELECT s.*, enc.occupation_type_encoded FROM s LEFT JOIN enc ON s.occupation_type = enc.v
"""
SNAP = f"({SNAP_SQL})"


def _profile(spark, sf, modes=()):
    s = snapshot(spark, sf)
    return segment.profile(s, "cluster_label", NUM + ["occupation_type_encoded"], modes, money=MONEY)


def _profile_sql(modes=()) -> str:
    means = ", ".join(f"{_avg_sql(c)} AS {c}" for c in NUM + ["occupation_type_encoded"])
    sql = f"SELECT cluster_label, {means}, CAST(count(*) AS BIGINT) AS cluster_size FROM {SNAP} s GROUP BY cluster_label"
    for m in modes:
        sql = (f"SELECT p.*, md.{m}_mode FROM ({sql}) p LEFT JOIN ("
               f"SELECT cluster_label, first({m} ORDER BY n DESC, {m}) AS {m}_mode FROM ("
               f"SELECT cluster_label, {m}, count(*) AS n FROM {SNAP} s GROUP BY 1, 2) GROUP BY 1) md "
               f"ON p.cluster_label = md.cluster_label")
    return sql


def _round_profile(df, extra=()):
    return df.select(F.col("cluster_label").cast("int").alias("cluster_label"),
                     *[rnd(c, 4).alias(c) for c in NUM + ["occupation_type_encoded"]], "cluster_size", *extra)


def _round_profile_sql(src: str, extra=()) -> str:
    cols = ", ".join(f"{rsql(c, 4)} AS {c}" for c in NUM + ["occupation_type_encoded"])
    ex = "".join(f", {e}" for e in extra)
    return f"SELECT CAST(cluster_label AS INTEGER) AS cluster_label, {cols}, cluster_size{ex} FROM ({src}) p"


@plan("cluster_profile", _round_profile_sql(_profile_sql()), "segment")
def cluster_profile(spark, sf):
    """Mean of every feature and size per segment."""
    return _round_profile(_profile(spark, sf))


@plan("cluster_profile_mode", _round_profile_sql(_profile_sql(["occupation_type", "city_level"]),
                                                 ["occupation_type_mode", "city_level_mode"]), "segment")
def cluster_profile_mode(spark, sf):
    """Profile with the most frequent segment and region (ties -> smallest)."""
    p = _profile(spark, sf, ["occupation_type", "city_level"])
    return _round_profile(p, ["occupation_type_mode", "city_level_mode"])


def _named(df, rules_fn, prefix):
    rules = rules_fn(F.col)
    default = F.concat(F.lit(prefix), (F.col("cluster_label") + 1).cast("string"))
    return df.withColumn("cluster_name", segment.rule_ladder(rules, default))


# What the two ladders of the driver preset must give, written out.
LADDER_A_SQL = """
CASE WHEN deposit_balance / total_assets >= 0.3 THEN 'urgent buyers'
     WHEN txn_count >= 3 THEN 'weekly buyers'
     WHEN monthly_income > 7400 THEN 'full accounts'
     WHEN txn_count >= 1.5 THEN 'returning buyers'
     WHEN total_assets >= 140000 AND total_assets <= 385000 THEN 'usual orders'
     ELSE 'tier ' || CAST(cluster_label + 1 AS VARCHAR) END"""
LADDER_B_SQL = """
CASE WHEN occupation_type_mode = 'MACHINERY' AND txn_count < 1.5 THEN 'machinery orders'
     WHEN monthly_income < 4300 THEN 'thin accounts'
     WHEN fund_balance > financial_balance THEN 'planned orders'
     WHEN total_assets > 385000 THEN 'upper quarter'
     ELSE 'tier ' || CAST(cluster_label + 1 AS VARCHAR) END"""


@plan("segment_rules_a", f"SELECT cluster_label, cluster_name FROM "
      f"(SELECT cluster_label, {LADDER_A_SQL} AS cluster_name FROM ({_profile_sql()}) p) x", "segment")
def segment_rules_a(spark, sf):
    """First-match naming ladder over profile means, default 'tier {k+1}'."""
    n = _named(_profile(spark, sf), ps.driver_rules_a, ps.DRIVER_DEFAULT_PREFIX)
    return n.select(F.col("cluster_label").cast("int").alias("cluster_label"), "cluster_name")


_B_SRC = f"SELECT p.*, {LADDER_B_SQL} AS cluster_name FROM ({_profile_sql(['occupation_type'])}) p"


@plan("segment_rules_b", f"SELECT CAST(cluster_label AS INTEGER) AS cluster_label, cluster_name FROM ({_B_SRC}) x",
      "segment")
def segment_rules_b(spark, sf):
    """P15 + P20: ladder with a mode test and comparisons of means."""
    n = _named(_profile(spark, sf, ["occupation_type"]), ps.driver_rules_b, ps.DRIVER_DEFAULT_PREFIX)
    return n.select(F.col("cluster_label").cast("int").alias("cluster_label"), "cluster_name")


SHARE_SQL = f"""
WITH n AS (SELECT cluster_label, cluster_name FROM ({_B_SRC}) x),
s AS (SELECT n.cluster_name, s.* FROM {SNAP} s JOIN n ON s.cluster_label = n.cluster_label),
p AS (SELECT cluster_name, {exact_avg_sql('total_assets')} AS total_assets, {exact_avg_sql('monthly_income')} AS monthly_income,
             avg(txn_count) AS txn_count, count(*) AS cluster_size FROM s GROUP BY cluster_name)
SELECT cluster_name, {rsql('total_assets', 4)} AS total_assets, {rsql('monthly_income', 4)} AS monthly_income,
       {rsql('txn_count', 4)} AS txn_count, CAST(cluster_size AS BIGINT) AS cluster_size,
       {rsql('cluster_size * 100.0 / sum(cluster_size) OVER ()', 6)} AS cluster_percentage
FROM p
"""


def _share(spark, sf):
    s = snapshot(spark, sf)
    names = _named(segment.profile(s, "cluster_label", NUM + ["occupation_type_encoded"], ["occupation_type"],
                                   money=MONEY),
                   ps.driver_rules_b, ps.DRIVER_DEFAULT_PREFIX).select("cluster_label", "cluster_name")
    s = s.join(F.broadcast(names), "cluster_label")  # one row per segment
    p = segment.profile(s, "cluster_name", ["total_assets", "monthly_income", "txn_count"], money=MONEY)
    return segment.share(p)


@plan("segment_share", SHARE_SQL, "segment")
def segment_share(spark, sf):
    """Profile by segment *name* with size and percentage of all."""
    p = _share(spark, sf)
    return p.select("cluster_name", *[rnd(c, 4).alias(c) for c in ("total_assets", "monthly_income", "txn_count")],
                    "cluster_size", rnd("cluster_percentage", 6).alias("cluster_percentage"))


RENAME_SQL = f"""
SELECT cluster_name, CASE cluster_name WHEN 'machinery orders' THEN 'industry' WHEN 'upper quarter' THEN 'key accounts'
                                       WHEN 'tier 1' THEN 'all others' END AS better_cluster_name, cluster_size
FROM ({SHARE_SQL}) x
"""


@plan("segment_rename", RENAME_SQL, "segment")
def segment_rename(spark, sf):
    """Business names for the segments (unmapped -> NULL)."""
    p = _share(spark, sf)
    r = segment.rename_segments(p, "cluster_name", ps.DRIVER_BETTER_NAMES, "better_cluster_name")
    return r.select("cluster_name", "better_cluster_name", "cluster_size")


QUART_COLS = ["total_assets", "monthly_income", "txn_count", "deposit_balance", "product_count"]
QUART_SQL = "\nUNION ALL\n".join(
    f"SELECT CAST(cluster_label AS INTEGER) AS cluster_label, '{c}' AS feature, "
    + ", ".join(f"{rsql(f'quantile_cont({c}, {q})', 4)} AS {n}" for q, n in
                [(0.0, "min"), (0.25, "q1"), (0.5, "median"), (0.75, "q3"), (1.0, "max")])
    + f" FROM {SNAP} s GROUP BY cluster_label" for c in QUART_COLS)


@plan("segment_quartiles", QUART_SQL, "segment")
def segment_quartiles(spark, sf):
    """Five-number summary of five features per segment."""
    q = segment.quartiles(snapshot(spark, sf), "cluster_label", QUART_COLS)
    return q.select(F.col("cluster_label").cast("int").alias("cluster_label"), "feature",
                    *[rnd(n, 4).alias(n) for n in ("min", "q1", "median", "q3", "max")])


# ------------------------------------------------------------ embeddings

EMB_SQL = """
WITH e AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS x FROM embeddings),
u AS (SELECT label, generate_subscripts(x, 1) AS pos, unnest(x) AS xi FROM e),
c AS (SELECT label, pos, avg(xi) AS m FROM u GROUP BY label, pos),
cc AS (SELECT label AS cl, list(m ORDER BY pos) AS centroid FROM c GROUP BY label)
"""

NEAREST_SQL = EMB_SQL + f"""
, d AS (SELECT e.vec_id, e.label, cc.cl,
               list_sum(list_transform(range(1, len(e.x) + 1), lambda i: (e.x[i] - cc.centroid[i]) * (e.x[i] - cc.centroid[i]))) AS d2
        FROM e, cc)
SELECT vec_id, label, first(cl ORDER BY d2, cl) AS nearest, {rsql('sqrt(min(d2))', 6)} AS distance
FROM d GROUP BY vec_id, label
"""


@plan("nearest_centroid", NEAREST_SQL, "segment")
def nearest_centroid(spark, sf):
    """Closest label centroid for every embedding."""
    p = bd.points(spark, sf)
    n = segment.nearest_centroid(p, "embedding", segment.centroids_by_label(p, "embedding", "label"))
    return n.select("vec_id", "label", F.col("nearest").cast("int").alias("nearest"),
                    rnd("distance", 6).alias("distance"))


SIL_SQL = """
WITH e AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS x FROM embeddings),
p AS (SELECT vec_id, label, x, list_sum(list_transform(x, lambda t: t * t)) AS xx FROM e),
u AS (SELECT label, generate_subscripts(x, 1) AS pos, unnest(x) AS xi FROM e),
sm AS (SELECT label, pos, sum(xi) AS s FROM u GROUP BY label, pos),
cl AS (SELECT sm.label, list(s ORDER BY pos) AS S, any_value(n.n) AS n, any_value(n.q) AS q
       FROM sm JOIN (SELECT label, count(*) AS n, sum(xx) AS q FROM p GROUP BY label) n ON sm.label = n.label
       GROUP BY sm.label),
t AS (SELECT p.vec_id, p.label AS pl, cl.label AS cl, cl.n,
             cl.n * p.xx - 2.0 * list_sum(list_transform(range(1, len(p.x) + 1), lambda i: p.x[i] * cl.S[i])) + cl.q AS tot
      FROM p, cl),
ab AS (SELECT vec_id, pl, max(CASE WHEN cl = pl AND n > 1 THEN tot / (n - 1) END) AS a,
              min(CASE WHEN cl <> pl THEN tot / n END) AS b, max(CASE WHEN cl = pl THEN n END) AS own_n
       FROM t GROUP BY vec_id, pl),
s AS (SELECT pl AS label, CASE WHEN own_n <= 1 OR b IS NULL THEN 0.0 ELSE (b - a) / greatest(a, b) END AS sil FROM ab)
"""


@plan("silhouette_sq", SIL_SQL + f"""
SELECT CAST(label AS VARCHAR) AS cluster, {rsql('avg(sil)', 6)} AS silhouette, CAST(count(*) AS BIGINT) AS points
FROM s GROUP BY label
UNION ALL
SELECT 'ALL', {rsql('avg(sil)', 6)}, CAST(count(*) AS BIGINT) FROM s""", "segment")
def silhouette_sq(spark, sf):
    """Exact squared-Euclidean silhouette of the fixed labels, O(n·k)."""
    s = segment.silhouette_sq(bd.points(spark, sf), "embedding", "label")
    per = s.groupBy(F.col("label").cast("string").alias("cluster")).agg(
        rnd(F.avg("silhouette"), 6).alias("silhouette"), F.count(F.lit(1)).cast("long").alias("points"))
    allr = s.agg(F.lit("ALL").alias("cluster"), rnd(F.avg("silhouette"), 6).alias("silhouette"),
                 F.count(F.lit(1)).cast("long").alias("points"))
    return per.unionByName(allr)


@plan("silhouette_ml", None, "segment")
def silhouette_ml(spark, sf):
    """C5 via Spark ML's ClusteringEvaluator (squared Euclidean) for cross-checks."""
    p = bd.points(spark, sf).select(array_to_vector(segment.as_double_array("embedding")).alias("features"),
                                    F.col("label").cast("double").alias("prediction"))
    v = ClusteringEvaluator(distanceMeasure="squaredEuclidean").evaluate(p)
    return spark.createDataFrame([(float(v),)], "silhouette double")


def _snapshot_points(spark, sf):
    s = snapshot(spark, sf)
    z = encode.standardize(s, NUM, suffix="_z")
    return z.select("customer_id", F.array(*[F.col(f"{c}_z") for c in NUM]).alias("vec"))


@plan("kmeans_fit", None, "segment")
def kmeans_fit(spark, sf):
    """C1 + A7: K-means (k=4, best of 10 starts) on standardised customer
    snapshot features; size per cluster."""
    pts = _snapshot_points(spark, sf).cache()
    model, cost = segment.kmeans_fit(pts, "vec", 4, seeds=range(42, 52), max_iter=300)
    lab = segment.kmeans_assign(model, pts, "vec")
    return lab.groupBy("cluster_label").agg(F.count(F.lit(1)).cast("long").alias("cluster_size")).withColumn(
        "training_cost", F.lit(float(cost)))


@plan("kmeans_sweep", None, "segment")
def kmeans_sweep(spark, sf):
    """C3 + C4: cost and silhouette for k = 2..8; best k by silhouette."""
    pts = _snapshot_points(spark, sf).cache()
    sw = segment.kmeans_sweep(pts, "vec", 8, seeds=range(42, 52))
    return sw.crossJoin(segment.best_k(sw).select("best_k"))


@plan("pca2", None, "segment")
def pca2(spark, sf):
    """Two principal components of the embeddings + explained variance."""
    out, ev = segment.pca2(bd.points(spark, sf), "embedding")
    return out.select("vec_id", "label", "pc1", "pc2").withColumn(
        "explained_variance_1", F.lit(float(ev[0]))).withColumn("explained_variance_2", F.lit(float(ev[1])))


# ------------------------------------------------------------ encoding

@plan("label_encode", f"SELECT customer_id, occupation_type, CAST(occupation_type_encoded AS INTEGER) AS code FROM {SNAP} s",
      "encode")
def label_encode(spark, sf):
    """Segment code = rank in the sorted distinct values (0-based)."""
    s = snapshot(spark, sf)
    return s.select("customer_id", "occupation_type", F.col("occupation_type_encoded").cast("int").alias("code"))


SEGS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]


@plan("one_hot", f"SELECT customer_id, " + ", ".join(
    f"CASE WHEN occupation_type = '{v}' THEN 1.0 ELSE 0.0 END AS occupation_type_{v}" for v in SEGS)
      + f" FROM ({bd.BASE_SQL}) b", "encode")
def one_hot(spark, sf):
    """One column per sorted category (categories read from the data)."""
    b = bd.base(spark, sf).select("customer_id", "occupation_type")
    return encode.one_hot(b, "occupation_type", drop_source=True)


@plan("label_encode_wide", """
SELECT c_custkey AS customer_id, c_name AS name, CAST(dense_rank() OVER (ORDER BY c_name) - 1 AS BIGINT) AS code
FROM customer""", "encode")
def label_encode_wide(spark, sf):
    """E4 where every row has a value of its own: codes of customer names."""
    c = read(spark, sf, "customer", "c_custkey", "c_name").select(F.col("c_custkey").alias("customer_id"), F.col("c_name").alias("name"))
    return encode.label_encode(c, "name", "code")


@plan("one_hot_wide", f"""
WITH b AS ({bd.BASE_SQL}),
c AS (SELECT customer_id, name, occupation_type, dense_rank() OVER (ORDER BY name) - 1 AS n, dense_rank() OVER (ORDER BY occupation_type) - 1 AS o FROM b),
w AS (SELECT max(n) + 1 AS width FROM c)
SELECT customer_id, CAST(n AS BIGINT) AS position, 'name_' || name AS feature, 1.0::DOUBLE AS value FROM c
UNION ALL
SELECT customer_id, CAST(o + width AS BIGINT), 'occupation_type_' || occupation_type, 1.0 FROM c, w""", "encode")
def one_hot_wide(spark, sf):
    """E3 without a bound on the categories: non-zero entries of names and segments."""
    return encode.one_hot_entries(bd.base(spark, sf), ["customer_id"], ["name", "occupation_type"])


STD_SQL = f"""
WITH s AS {SNAP}, m AS (SELECT {', '.join(f'avg({c}) AS m_{c}, stddev_pop({c}) AS s_{c}' for c in NUM)} FROM s)
SELECT customer_id, {', '.join(rsql(f'({c} - m_{c}) / CASE WHEN s_{c} = 0 OR s_{c} IS NULL THEN 1.0 ELSE s_{c} END', 6) + f' AS {c}_z' for c in NUM)}
FROM s, m
"""


@plan("standardize", STD_SQL, "encode")
def standardize(spark, sf):
    """Z-scores with the population std (constant columns / 1)."""
    z = encode.standardize(snapshot(spark, sf), NUM, suffix="_z")
    return z.select("customer_id", *[rnd(f"{c}_z", 6).alias(f"{c}_z") for c in NUM])


STD_SPLIT_SQL = f"""
WITH b AS ({bd.BEHAVIOUR_SQL}),
m AS (SELECT avg(txn_count) AS mt, stddev_pop(txn_count) AS st, {exact_avg_sql('total_assets')} AS ma, stddev_pop(total_assets) AS sa
      FROM b WHERE stat_month <= '1997-12')
SELECT customer_id, stat_month, {rsql('(txn_count - mt) / CASE WHEN st = 0 OR st IS NULL THEN 1.0 ELSE st END', 6)} AS txn_count_z,
       {rsql('(total_assets - ma) / CASE WHEN sa = 0 OR sa IS NULL THEN 1.0 ELSE sa END', 6)} AS total_assets_z
FROM b, m WHERE stat_month > '1997-12'
"""


@plan("standardize_split", STD_SPLIT_SQL, "encode")
def standardize_split(spark, sf):
    """E2 fitted on the training months alone and applied to the months after them."""
    b = bd.behaviour(spark, sf)
    train, rest = b.where(F.col("stat_month") <= "1997-12"), b.where(F.col("stat_month") > "1997-12")
    z = encode.standardize(rest, ["txn_count", "total_assets"], "_z", fit_on=train)
    return z.select("customer_id", "stat_month", rnd("txn_count_z", 6).alias("txn_count_z"), rnd("total_assets_z", 6).alias("total_assets_z"))


IMPUTE_SQL = f"""
WITH b AS (SELECT customer_id, stat_month, CASE WHEN (customer_id + txn_count) % 17 <> 0 THEN total_assets END AS total_assets,
                  CASE WHEN customer_id % 5 <> 0 THEN txn_count END AS txn_count FROM ({bd.BEHAVIOUR_SQL}) b),
j AS (SELECT b.*, CASE WHEN base.customer_id % 7 <> 0 THEN base.occupation_type END AS occupation_type
      FROM b JOIN ({bd.BASE_SQL}) base ON b.customer_id = base.customer_id),
m AS (SELECT median(total_assets) AS ma, median(txn_count) AS mt FROM j)
SELECT customer_id, stat_month, {rsql('coalesce(total_assets, ma)', 4)} AS total_assets, {rsql('coalesce(txn_count, mt)', 4)} AS txn_count,
       coalesce(occupation_type, 'missing') AS occupation_type
FROM j, m
"""


@plan("impute", IMPUTE_SQL, "encode")
def impute(spark, sf):
    """Exact medians into numeric gaps, a constant into text gaps (gaps made by key)."""
    b = bd.behaviour(spark, sf).select(
        "customer_id", "stat_month", F.when((F.col("customer_id") + F.col("txn_count")) % 17 != 0, F.col("total_assets")).alias("total_assets"),
        F.when(F.col("customer_id") % 5 != 0, F.col("txn_count")).cast("double").alias("txn_count"))
    base = bd.base(spark, sf).select("customer_id", F.when(F.col("customer_id") % 7 != 0, F.col("occupation_type")).alias("occupation_type"))
    j = encode.median_impute(b.join(base, "customer_id"), ["total_assets", "txn_count"])
    return encode.constant_impute(j, ["occupation_type"]).select(
        "customer_id", "stat_month", rnd("total_assets", 4).alias("total_assets"), rnd("txn_count", 4).alias("txn_count"), "occupation_type")


@plan("hash_split", f"""
SELECT is_test, CAST(count(*) AS BIGINT) AS rows, CAST(count(DISTINCT customer_id) AS BIGINT) AS customers FROM (
  SELECT customer_id, ('0x' || substr(md5(CAST(customer_id AS VARCHAR) || ':42'), 1, 8))::BIGINT / 4294967296.0 < 0.2 AS is_test
  FROM ({bd.BEHAVIOUR_SQL}) b) GROUP BY 1""", "encode")
def hash_split(spark, sf):
    """E8 without a shuffle: whole customers to one side by their hash."""
    s = encode.hash_split(bd.behaviour(spark, sf), "stat_month", 0.2, 42, group_col="customer_id")
    return s.groupBy("is_test").agg(F.count(F.lit(1)).cast("long").alias("rows"), F.count_distinct("customer_id").cast("long").alias("customers"))


@plan("md5_sample", f"""
SELECT customer_id, stat_month FROM ({bd.BEHAVIOUR_SQL}) b
ORDER BY md5(CAST(customer_id AS VARCHAR) || ':' || stat_month || ':42'), customer_id LIMIT 100""", "encode")
def md5_sample(spark, sf):
    """Reproducible sample of exactly 100 customer-months."""
    b = bd.behaviour(spark, sf).withColumn("__k", F.concat_ws(":", F.col("customer_id").cast("string"),
                                                                  "stat_month"))
    s = encode.md5_sample(b, "__k", 100, 42)
    return s.select("customer_id", "stat_month")


@plan("stratified_split", f"""
WITH f AS (SELECT customer_id, stat_month, target_high_value FROM ({FEATURES_SQL}) x),
h AS (SELECT *, md5(CAST(customer_id AS VARCHAR) || ':' || stat_month || ':42') AS hh FROM f),
r AS (SELECT *, row_number() OVER (PARTITION BY target_high_value ORDER BY hh, customer_id) AS rn,
             count(*) OVER (PARTITION BY target_high_value) AS n FROM h)
SELECT target_high_value, CAST(rn <= round(n * 0.2) AS BOOLEAN) AS is_test, CAST(count(*) AS BIGINT) AS rows
FROM r GROUP BY 1, 2""", "encode")
def stratified_split(spark, sf):
    """Exact 80/20 split within each class, by hash order."""
    f = _features(spark, sf).select("customer_id", "stat_month", "target_high_value")
    f = f.withColumn("__k", F.concat_ws(":", F.col("customer_id").cast("string"), "stat_month"))
    s = encode.stratified_split(f, "__k", "target_high_value", 0.2, 42)
    return s.groupBy("target_high_value", "is_test").agg(F.count(F.lit(1)).cast("long").alias("rows"))


@plan("time_split", f"""
SELECT CASE WHEN stat_month BETWEEN '1996-01' AND '1997-12' THEN 'train'
            WHEN stat_month BETWEEN '1998-01' AND '1998-06' THEN 'test' END AS split,
       CAST(count(*) AS BIGINT) AS rows, {rsql(exact_avg_sql('total_assets'), 4)} AS mean_assets
FROM ({bd.BEHAVIOUR_SQL}) b GROUP BY 1""", "encode")
def time_split(spark, sf):
    """Inclusive month ranges for train and test."""
    t = encode.time_split(bd.behaviour(spark, sf), "stat_month", ("1996-01", "1997-12"), ("1998-01", "1998-06"))
    return t.groupBy("split").agg(F.count(F.lit(1)).cast("long").alias("rows"),
                                  rnd(exact_avg("total_assets"), 4).alias("mean_assets"))
