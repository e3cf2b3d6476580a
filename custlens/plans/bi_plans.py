"""Plans for profiling, data quality and the dashboard roll-ups."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from .. import presets as ps
from ..operators import bi, profile
from ..operators import features as fe
from ..sources import bindings as bd
from ..sources import io
from ..sources.tables import read
from ..functions.exact import exact_avg, exact_avg_sql, exact_sum_sql
from .features_plans import FEATURES_SQL
from .registry import plan, rnd, rsql

B = f"({bd.BEHAVIOUR_SQL})"
BASE = f"({bd.BASE_SQL})"


def _case_bins(expr: str, edges, labels=None) -> str:
    parts = " ".join(f"WHEN {expr} < {e} THEN {i if labels is None else repr(labels[i])}"
                     for i, e in enumerate(edges))
    last = len(edges) if labels is None else repr(labels[-1])
    return f"CASE WHEN {expr} IS NULL THEN NULL {parts} ELSE {last} END"


# ---------------------------------------------------------------- profiling

_DUCK_TYPES = ("CASE typeof({c}) WHEN 'BIGINT' THEN 'bigint' WHEN 'INTEGER' THEN 'int' "
               "WHEN 'DOUBLE' THEN 'double' WHEN 'VARCHAR' THEN 'string' "
               "WHEN 'TIMESTAMP' THEN 'timestamp_ntz' ELSE lower(typeof({c})) END")
ORDERS_COLS = [("o_orderkey", True), ("o_custkey", True), ("o_orderstatus", False),
               ("o_totalprice", True), ("o_orderdate", False), ("o_orderpriority", False)]


def _profile_sql():
    parts = []
    for i, (c, num) in enumerate(ORDERS_COLS):
        mn = rsql(f"min({c})", 4) if num else "CAST(NULL AS DOUBLE)"
        mx = rsql(f"max({c})", 4) if num else "CAST(NULL AS DOUBLE)"
        av = rsql(f"avg({c})", 4) if num else "CAST(NULL AS DOUBLE)"
        parts.append(
            f"SELECT '{c}' AS column_name, {i + 1} AS ordinal, "
            f"(SELECT {_DUCK_TYPES.format(c=c)} FROM orders LIMIT 1) AS data_type, "
            f"CAST(count({c}) AS BIGINT) AS non_null, CAST(count(*) - count({c}) AS BIGINT) AS nulls, "
            f"CAST(count(DISTINCT {c}) AS BIGINT) AS \"distinct\", {mn} AS min_value, {mx} AS max_value, "
            f"{av} AS mean_value FROM orders")
    return "\nUNION ALL\n".join(parts)


@plan("table_profile", _profile_sql(), "profile")
def table_profile(spark, sf):
    """Shape, ordered columns, types and per-column statistics of orders."""
    p = profile.table_profile(read(spark, sf, "orders"))
    return p.select("column_name", F.col("ordinal").cast("int"), "data_type", "non_null", "nulls",
                    "distinct", rnd("min_value", 4).alias("min_value"),
                    rnd("max_value", 4).alias("max_value"), rnd("mean_value", 4).alias("mean_value"))


@plan("table_head", """
SELECT o_orderkey, o_custkey, o_orderstatus, (round(o_totalprice, 2) + 0.0) AS o_totalprice,
       CAST(o_orderdate AS VARCHAR) AS o_orderdate, o_orderpriority
FROM orders ORDER BY o_orderkey LIMIT 5""", "profile")
def table_head(spark, sf):
    """First five rows by key."""
    h = profile.head(read(spark, sf, "orders"), ["o_orderkey"], 5)
    return h.select("o_orderkey", "o_custkey", "o_orderstatus", rnd("o_totalprice", 2).alias("o_totalprice"),
                    F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss").alias("o_orderdate"),
                    "o_orderpriority")


_NULL_COLS = ["customer_id", "occupation_type", "city_level", "stat_month", "total_assets", "txn_count"]
NULL_COUNTS_SQL = "WITH j AS (SELECT base.customer_id, base.occupation_type, base.city_level, " \
    f"b.stat_month, b.total_assets, b.txn_count FROM {BASE} base LEFT JOIN {B} b " \
    "ON base.customer_id = b.customer_id)\n" + "\nUNION ALL\n".join(
        f"SELECT '{c}' AS column_name, CAST(count(*) - count({c}) AS BIGINT) AS null_count FROM j"
        for c in _NULL_COLS)


@plan("null_counts", NULL_COUNTS_SQL, "profile")
def null_counts(spark, sf):
    """NULLs per column of the customer ⟕ behaviour join."""
    j = fe.join_base_behaviour(bd.base(spark, sf), bd.behaviour(spark, sf)).select(*_NULL_COLS)
    return profile.null_counts(j)


@plan("key_uniqueness", """
SELECT o_custkey AS customer_id, strftime(o_orderdate, '%Y-%m') AS stat_month,
       CAST(count(*) AS BIGINT) AS rows
FROM orders GROUP BY 1, 2 HAVING count(*) > 1""", "profile")
def key_uniqueness(spark, sf):
    """(customer, month) keys of raw orders that repeat — why the
    behaviour table aggregates to one row per key."""
    o = read(spark, sf, "orders", "o_custkey", "o_orderdate").select(
        F.col("o_custkey").alias("customer_id"),
        F.date_format("o_orderdate", "yyyy-MM").alias("stat_month"))
    return profile.duplicate_keys(o, ["customer_id", "stat_month"])


FK_SQL = """
SELECT 'orders.o_custkey->customer' AS relation, CAST(count(*) AS BIGINT) AS child_rows,
       CAST(count(*) FILTER (WHERE c.c_custkey IS NULL) AS BIGINT) AS orphans
FROM orders o LEFT JOIN customer c ON o.o_custkey = c.c_custkey
UNION ALL
SELECT 'lineitem.l_partkey->part', CAST(count(*) AS BIGINT),
       CAST(count(*) FILTER (WHERE p.p_partkey IS NULL) AS BIGINT)
FROM lineitem l LEFT JOIN part p ON l.l_partkey = p.p_partkey
UNION ALL
SELECT 'lineitem.l_orderkey->orders', CAST(count(*) AS BIGINT),
       CAST(count(*) FILTER (WHERE o.o_orderkey IS NULL) AS BIGINT)
FROM lineitem l LEFT JOIN orders o ON l.l_orderkey = o.o_orderkey
UNION ALL
SELECT 'customer.c_nationkey->nation', CAST(count(*) AS BIGINT),
       CAST(count(*) FILTER (WHERE n.n_nationkey IS NULL) AS BIGINT)
FROM customer c LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
"""


@plan("fk_violations", FK_SQL, "profile")
def fk_violations(spark, sf):
    """Orphan count per foreign key (left anti joins)."""
    rels = [("orders.o_custkey->customer", "orders", "o_custkey", "customer", "c_custkey"),
            ("lineitem.l_partkey->part", "lineitem", "l_partkey", "part", "p_partkey"),
            ("lineitem.l_orderkey->orders", "lineitem", "l_orderkey", "orders", "o_orderkey"),
            ("customer.c_nationkey->nation", "customer", "c_nationkey", "nation", "n_nationkey")]
    out = None
    for name, ct, ck, pt, pk in rels:
        child = read(spark, sf, ct, ck)
        orph = profile.orphans(child, read(spark, sf, pt, pk), ck, pk)
        row = child.agg(F.count(F.lit(1)).cast("long").alias("child_rows")).crossJoin(
            orph.agg(F.count(F.lit(1)).cast("long").alias("orphans"))).select(
            F.lit(name).alias("relation"), "child_rows", "orphans")
        out = row if out is None else out.unionByName(row)
    return out


@plan("date_range", f"SELECT min(stat_month) AS min_value, max(stat_month) AS max_value, "
      f"CAST(count(DISTINCT stat_month) AS BIGINT) AS months FROM {B} b", "profile")
def date_range(spark, sf):
    """First and last month of the behaviour table."""
    b = bd.behaviour(spark, sf)
    return profile.date_range(b, "stat_month").crossJoin(
        b.agg(F.count_distinct("stat_month").cast("long").alias("months")))


TARGET_DIST_SQL = f"""
WITH f AS (SELECT target_high_value FROM ({FEATURES_SQL}))
SELECT target_high_value, CAST(count(*) AS BIGINT) AS rows,
       {rsql('count(*) / sum(count(*)) OVER ()', 6)} AS share
FROM f GROUP BY target_high_value
"""


@plan("target_distribution", TARGET_DIST_SQL, "profile")
def target_distribution(spark, sf):
    """Class counts and shares of the forward label."""
    f = fe.feature_matrix(bd.base(spark, sf), bd.behaviour(spark, sf), bd.DRIVER_HIGH_VALUE)
    d = profile.target_distribution(f, "target_high_value")
    return d.select("target_high_value", "rows", rnd("share", 6).alias("share"))


# ---------------------------------------------------------------- roll-ups

@plan("value_counts_segment", f"SELECT occupation_type, CAST(count(*) AS BIGINT) AS count "
      f"FROM {BASE} b WHERE occupation_type IS NOT NULL GROUP BY 1", "bi")
def value_counts_segment(spark, sf):
    """A1 on the segment column."""
    return bi.value_counts(bd.base(spark, sf), "occupation_type")


@plan("value_counts_region", f"SELECT city_level, CAST(count(*) AS BIGINT) AS count "
      f"FROM {BASE} b WHERE city_level IS NOT NULL GROUP BY 1", "bi")
def value_counts_region(spark, sf):
    """A1 on the region (city level) column."""
    return bi.value_counts(bd.base(spark, sf), "city_level")


@plan("monthly_aum_sum", f"SELECT stat_month AS month, {rsql(exact_sum_sql('total_assets') + ' * 0.0001', 4)} AS total_assets "
      f"FROM {B} b GROUP BY 1", "bi")
def monthly_aum_sum(spark, sf):
    """A2 + P18: monthly total assets in units of 10,000."""
    m = bi.monthly(bd.behaviour(spark, sf), "stat_month", "total_assets", "sum", 1e-4, "total_assets",
                   money_scale=2)
    return m.select(F.col("stat_month").alias("month"), rnd("total_assets", 4).alias("total_assets"))


@plan("monthly_aum_mean", f"SELECT stat_month AS month, {rsql(exact_avg_sql('total_assets'), 4)} AS total_assets "
      f"FROM {B} b GROUP BY 1", "bi")
def monthly_aum_mean(spark, sf):
    """A3: monthly mean of total assets."""
    m = bi.monthly(bd.behaviour(spark, sf), "stat_month", "total_assets", "avg", out="total_assets",
                   money_scale=2)
    return m.select(F.col("stat_month").alias("month"), rnd("total_assets", 4).alias("total_assets"))


APP_SQL = f"""
WITH a AS (SELECT user_id, CAST(ts AS DATE) AS day, count(*) AS app_login_count
           FROM events GROUP BY 1, 2)
SELECT strftime(day, '%Y-%m') AS month, {rsql('avg(app_login_count)', 6)} AS avg_login_count
FROM a GROUP BY 1
"""


@plan("app_login_trend", APP_SQL, "bi")
def app_login_trend(spark, sf):
    """A3 on APP activity: mean daily event count per user-day, by month."""
    a = bd.app_activity(spark, sf).withColumn("month", F.date_format("day", "yyyy-MM"))
    m = bi.monthly(a, "month", "app_login_count", "avg", out="avg_login_count")
    return m.select("month", rnd("avg_login_count", 6).alias("avg_login_count"))


def _union_sql(select_tpl: str, items) -> str:
    return "\nUNION ALL\n".join(select_tpl.format(col=c, label=lab) for c, lab in items)


COMPOSITION_SQL = _union_sql(
    "SELECT '{label}' AS asset_type, " + rsql(exact_avg_sql("{col}"), 4) + f" AS average_balance FROM {B} b",
    ps.DRIVER_BALANCE_LABELS.items())


@plan("asset_composition", COMPOSITION_SQL, "bi")
def asset_composition(spark, sf):
    """A4 + P13: mean of each balance column, one row per asset type."""
    u = bi.unpivot_agg(bd.behaviour(spark, sf), bd.BALANCES, "avg", "asset_type", "average_balance",
                       ps.DRIVER_BALANCE_LABELS, money_scale=2)
    return u.select("asset_type", rnd("average_balance", 4).alias("average_balance"))


HOLDING_SQL = _union_sql(
    "SELECT '{label}' AS product_type, CAST(sum({col}) AS BIGINT) AS count" + f" FROM {B} b",
    ps.DRIVER_FLAG_LABELS.items())


@plan("product_holding", HOLDING_SQL, "bi")
def product_holding(spark, sf):
    """A5 + P13: customer-months holding each product."""
    u = bi.unpivot_agg(bd.behaviour(spark, sf), bd.FLAGS, "sum", "product_type", "count",
                       ps.DRIVER_FLAG_LABELS)
    return u.select("product_type", F.col("count").cast("long").alias("count"))


EVER_SQL = f"SELECT customer_id, " + ", ".join(
    f"CAST(max({f}) AS INTEGER) AS {f}" for f in bd.FLAGS) + f" FROM {B} b GROUP BY customer_id"


@plan("ever_held_flags", EVER_SQL, "bi")
def ever_held_flags(spark, sf):
    """Per customer, whether each product was ever held."""
    return bi.ever_held(bd.behaviour(spark, sf), "customer_id", bd.FLAGS)


HOLD_PCT_SQL = f"WITH e AS ({EVER_SQL}), n AS (SELECT count(*) AS n FROM e)\n" + _union_sql(
    "SELECT '{label}' AS product, CAST(sum({col}) AS BIGINT) AS holders, "
    + rsql("sum({col}) * 100.0 / any_value(n.n)", 6) + " AS percent FROM e, n",
    ps.DRIVER_FLAG_LABELS.items())


@plan("holding_percent", HOLD_PCT_SQL, "bi")
def holding_percent(spark, sf):
    """Holders and percent of customers per product."""
    held = bi.ever_held(bd.behaviour(spark, sf), "customer_id", bd.FLAGS)
    h = bi.holding_percent(held, bd.FLAGS, ps.DRIVER_FLAG_LABELS)
    return h.select("product", "holders", rnd("percent", 6).alias("percent"))


def _hist_sql(src: str, col: str, edges, labels, label_col: str) -> str:
    bins = ", ".join(f"({i}, {labels[i]!r})" for i in range(len(labels)))
    return f"""
WITH c AS (SELECT {_case_bins(col, edges)} AS bin FROM {src} s),
g AS (SELECT bin, count(*) AS n FROM c WHERE bin IS NOT NULL GROUP BY bin),
bins(bin, label) AS (VALUES {bins})
SELECT bins.bin, bins.label AS {label_col}, CAST(coalesce(g.n, 0) AS BIGINT) AS count
FROM bins LEFT JOIN g ON bins.bin = g.bin
"""


@plan("asset_histogram", _hist_sql(B, "total_assets", ps.DRIVER_ASSET_EDGES, ps.DRIVER_ASSET_LABELS,
                                   "asset_group"), "bi")
def asset_histogram(spark, sf):
    """Customer-months per total-asset band, empty bands included."""
    return bi.histogram(bd.behaviour(spark, sf), "total_assets", ps.DRIVER_ASSET_EDGES,
                        ps.DRIVER_ASSET_LABELS, "asset_group")


@plan("income_histogram", _hist_sql(BASE, "monthly_income", ps.DRIVER_INCOME_EDGES,
                                    ps.DRIVER_INCOME_LABELS, "income_group"), "bi")
def income_histogram(spark, sf):
    """A17 on the customer table (the age histogram's shape)."""
    return bi.histogram(bd.base(spark, sf), "monthly_income", ps.DRIVER_INCOME_EDGES,
                        ps.DRIVER_INCOME_LABELS, "income_group")


LEVEL_SQL = f"""
SELECT {_case_bins('total_assets', ps.DRIVER_LEVEL_EDGES, ps.DRIVER_LEVEL_LABELS)} AS asset_level,
       CAST(count(*) AS BIGINT) AS count
FROM {B} b GROUP BY 1
"""


@plan("asset_level_dist", LEVEL_SQL, "bi")
def asset_level_dist(spark, sf):
    """A1 on the derived asset level (4-rung ladder)."""
    b = bd.behaviour(spark, sf).withColumn(
        "asset_level", bi.level_ladder("total_assets", ps.DRIVER_LEVEL_EDGES, ps.DRIVER_LEVEL_LABELS))
    return bi.value_counts(b, "asset_level")


SNAPSHOT_SQL = f"""
WITH b AS {B}
SELECT base.customer_id, base.occupation_type, b.stat_month, {rsql('b.total_assets', 2)} AS total_assets
FROM {BASE} base JOIN b ON base.customer_id = b.customer_id
WHERE b.stat_month = (SELECT max(stat_month) FROM b)
"""


@plan("snapshot_join", SNAPSHOT_SQL, "bi")
def snapshot_join(spark, sf):
    """P5 + J2: latest-month snapshot joined to the customer table.  The latest month
    comes from the dates alone, and only its orders are aggregated."""
    month = F.date_format("o_orderdate", "yyyy-MM")
    last = read(spark, sf, "orders", "o_orderdate").agg(F.max("o_orderdate").alias("__last"))      # one row
    orders = read(spark, sf, "orders").join(F.broadcast(last), month == F.date_format("__last", "yyyy-MM"))
    j = bd.base(spark, sf).join(bd.behaviour_of(orders), "customer_id")
    return j.select("customer_id", "occupation_type", "stat_month",
                    rnd("total_assets", 2).alias("total_assets"))


@plan("snapshot_stage", SNAPSHOT_SQL, "bi")
def snapshot_stage(spark, sf):
    """S2 + P5 + J2 over a stage table: customer-months written with one folder per
    month; the snapshot reads the latest folder alone."""
    path = io.stage_path(spark, f"behaviour-{uuid.uuid4().hex}")
    io.write_table(bd.behaviour(spark, sf).select("customer_id", "total_assets", "stat_month"), path, partition_by=["stat_month"])
    stage = io.read_stage(spark, path, schema=STAGE_SCHEMA)
    j = bi.snapshot_join(bd.base(spark, sf), stage)
    return j.select("customer_id", "occupation_type", "stat_month", rnd("total_assets", 2).alias("total_assets"))


STAGE_SCHEMA = "customer_id long, total_assets double, stat_month string"


NUMERIC_FEATURES_SQL = "\nUNION ALL\n".join(
    f"SELECT '{new}' AS feature, {rsql(f'avg(CAST({c} AS DOUBLE))' if c in ('product_count', 'txn_count') else exact_avg_sql(c), 4)} AS mean FROM {B} b"
    for c, new in [("total_assets", "assets"), *[(c, c) for c in bd.BALANCES], ("product_count", "products"), ("txn_count", "txn_count")])


@plan("numeric_features", NUMERIC_FEATURES_SQL, "profile")
def numeric_features(spark, sf):
    """P2 + P3 + P4 + P12: the numeric columns that are neither keys nor flags, two of
    them renamed, with their means."""
    b = bd.behaviour(spark, sf)
    flags = profile.columns_like(b, "_flag")
    numeric = profile.numeric_columns(b)
    cols = [c for c in profile.feature_columns(b, ["customer_id", "stat_month", *flags]) if c in numeric]
    means = b.agg(*[(exact_avg(c) if c in ("total_assets", *bd.BALANCES) else F.avg(c)).alias(c) for c in cols])
    named = bi.rename(means, {"total_assets": "assets", "product_count": "products"})
    return named.unpivot([], named.columns, "feature", "mean").select("feature", rnd("mean", 4).alias("mean"))


# Fixed values (driver preset): a partial recode of market segments.
SEGMENT_RECODE = {"AUTOMOBILE": "auto", "BUILDING": "construction", "MACHINERY": "industry"}

RECODE_SQL = f"""
SELECT customer_id,
       coalesce(CASE occupation_type {' '.join(f"WHEN '{k}' THEN '{v}'" for k, v in SEGMENT_RECODE.items())} END,
                occupation_type) AS segment_replaced,
       CASE occupation_type {' '.join(f"WHEN '{k}' THEN '{v}'" for k, v in SEGMENT_RECODE.items())} END AS segment_mapped
FROM {BASE} b
"""


@plan("recode_map", RECODE_SQL, "bi")
def recode_map(spark, sf):
    """Replace semantics (unmapped kept) and map semantics (unmapped NULL)."""
    b = bd.base(spark, sf)
    return b.select("customer_id",
                    bi.recode("occupation_type", SEGMENT_RECODE, True).alias("segment_replaced"),
                    bi.recode("occupation_type", SEGMENT_RECODE, False).alias("segment_mapped"))


@plan("date_parts", f"""
SELECT customer_id, stat_month, CAST(month(CAST(strptime(stat_month, '%Y-%m') AS DATE)) AS INTEGER) AS month,
       CAST(quarter(CAST(strptime(stat_month, '%Y-%m') AS DATE)) AS INTEGER) AS quarter,
       strftime(CAST(strptime(stat_month, '%Y-%m') AS DATE), '%Y-%m-%d') AS month_start
FROM {B} b""", "bi")
def date_parts(spark, sf):
    """F1 + F2 + F3: 'yyyy-MM' -> month start date, month and quarter."""
    b = bd.behaviour(spark, sf).select("customer_id", "stat_month")
    d = F.to_date("stat_month", "yyyy-MM")
    return b.select("customer_id", "stat_month", F.month(d).alias("month"), F.quarter(d).alias("quarter"),
                    F.date_format(d, "yyyy-MM-dd").alias("month_start"))


@plan("row_counts", f"""
SELECT CAST(count(*) AS BIGINT) AS rows, CAST(count(DISTINCT customer_id) AS BIGINT) AS customers,
       CAST(count(DISTINCT stat_month) AS BIGINT) AS months FROM {B} b""", "bi")
def row_counts(spark, sf):
    """Rows, distinct customers and distinct months of the behaviour table."""
    b = bd.behaviour(spark, sf)
    return b.agg(F.count(F.lit(1)).cast("long").alias("rows"),
                 F.count_distinct("customer_id").cast("long").alias("customers"),
                 F.count_distinct("stat_month").cast("long").alias("months"))
