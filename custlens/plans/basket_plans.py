"""Plans for basket association analysis on order baskets (part types per
order) and on customer product holdings (ever-held flags)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import baskets as bk
from ..operators import bi
from ..sources import bindings as bd
from .registry import plan, rnd, rsql

MIN_SUPPORT = 0.1
MIN_CONFIDENCE = 0.3
HOLD_ITEMS = {f"{p}_flag": p for p in bd.PRODUCTS}


def _order_itemsets(spark, sf, method="apriori"):
    return bk.frequent_itemsets(bd.order_baskets(spark, sf), MIN_SUPPORT, method=method)


def _holding_baskets(spark, sf):
    held = bi.ever_held(bd.behaviour(spark, sf), "customer_id", bd.FLAGS)
    return bk.flags_to_basket(held, HOLD_ITEMS, "customer_id")


def _itemset_out(df):
    return df.select(bk.itemset_text("items").alias("items"), F.col("length").cast("long").alias("length"),
                     F.col("count").cast("long").alias("count"), rnd("support", 8).alias("support"))


def _rules_out(df):
    return df.select(bk.itemset_text("antecedents").alias("antecedents"),
                     bk.itemset_text("consequents").alias("consequents"),
                     rnd("support", 8).alias("support"), rnd("confidence", 8).alias("confidence"),
                     rnd("lift", 8).alias("lift"))


# ------------------------------------------------------------- SQL oracles

def _itemsets_sql(baskets_sql: str, denominator: str) -> str:
    n_expr = "count(*) FILTER (WHERE len(items) > 0)" if denominator == "nonempty" else "count(*)"
    return f"""
WITH b AS ({baskets_sql}),
nb AS (SELECT CAST({n_expr} AS DOUBLE) AS n FROM b),
m AS (SELECT items, unnest(range(1, CAST(pow(2, len(items)) AS BIGINT))) AS mask FROM b WHERE len(items) > 0),
s AS (SELECT list_filter(items, lambda x, i: ((mask >> (i - 1)) & 1) = 1) AS sub FROM m),
c AS (SELECT sub, count(*) AS cnt FROM s GROUP BY sub)
SELECT sub AS items_list, array_to_string(sub, ', ') AS items, CAST(len(sub) AS BIGINT) AS length,
       CAST(cnt AS BIGINT) AS count, cnt / nb.n AS support
FROM c, nb WHERE cnt / nb.n >= {MIN_SUPPORT}
"""


def _itemsets_out_sql(isql: str) -> str:
    return f"SELECT items, length, count, {rsql('support', 8)} AS support FROM ({isql}) i"


def _rules_sql(isql: str) -> str:
    return f"""
WITH i AS ({isql}),
sup AS (SELECT items, support FROM i),
m AS (SELECT items_list, support, unnest(range(1, CAST(pow(2, len(items_list)) AS BIGINT) - 1)) AS mask
      FROM i WHERE length >= 2),
r AS (SELECT support,
             array_to_string(list_filter(items_list, lambda x, k: ((mask >> (k - 1)) & 1) = 1), ', ') AS a,
             array_to_string(list_filter(items_list, lambda x, k: ((mask >> (k - 1)) & 1) = 0), ', ') AS c
      FROM m),
j AS (SELECT r.a, r.c, r.support, r.support / sa.support AS confidence, sc.support AS sc
      FROM r JOIN sup sa ON sa.items = r.a JOIN sup sc ON sc.items = r.c)
SELECT a AS antecedents, c AS consequents, {rsql('support', 8)} AS support,
       {rsql('confidence', 8)} AS confidence, {rsql('confidence / sc', 8)} AS lift
FROM j WHERE confidence >= {MIN_CONFIDENCE}
"""


def _holding_baskets_sql() -> str:
    parts = ", ".join(f"CASE WHEN max({f}) = 1 THEN '{p}' END" for f, p in HOLD_ITEMS.items())
    return (f"SELECT customer_id, list_filter([{parts}], lambda x: x IS NOT NULL) AS items "
            f"FROM ({bd.BEHAVIOUR_SQL}) b GROUP BY customer_id")


ORDER_ITEMSETS_SQL = _itemsets_sql(bd.BASKETS_SQL, "nonempty")
HOLD_ITEMSETS_SQL = _itemsets_sql(_holding_baskets_sql(), "all")


@plan("basket_build", f"""
SELECT customer_id, array_to_string(items, ', ') AS items, CAST(len(items) AS BIGINT) AS n_items
FROM ({_holding_baskets_sql()}) h WHERE len(items) > 0""", "baskets")
def basket_build(spark, sf):
    """B1 + P19: product basket per customer from ever-held flags, empty dropped."""
    b = bk.non_empty(_holding_baskets(spark, sf))
    return b.select("customer_id", bk.itemset_text("items").alias("items"),
                    F.size("items").cast("long").alias("n_items"))


@plan("order_baskets", f"""
SELECT basket_id, array_to_string(items, ', ') AS items, CAST(len(items) AS BIGINT) AS n_items
FROM ({bd.BASKETS_SQL}) b""", "baskets")
def order_baskets(spark, sf):
    """B1 from fact rows: sorted distinct part types per order."""
    b = bd.order_baskets(spark, sf)
    return b.select("basket_id", bk.itemset_text("items").alias("items"),
                    F.size("items").cast("long").alias("n_items"))


@plan("item_universe", f"SELECT DISTINCT unnest(items) AS item FROM ({bd.BASKETS_SQL}) b", "baskets")
def item_universe(spark, sf):
    """Distinct items across baskets."""
    return bk.item_universe(bd.order_baskets(spark, sf))


@plan("frequent_itemsets", _itemsets_out_sql(ORDER_ITEMSETS_SQL), "baskets")
def frequent_itemsets(spark, sf):
    """Level-wise frequent itemsets, support over non-empty baskets."""
    return _itemset_out(_order_itemsets(spark, sf))


@plan("frequent_itemsets_fpgrowth", _itemsets_out_sql(ORDER_ITEMSETS_SQL), "baskets")
def frequent_itemsets_fpgrowth(spark, sf):
    """B3 at scale: Spark ML FPGrowth, same itemsets."""
    return _itemset_out(_order_itemsets(spark, sf, "fpgrowth"))


@plan("holding_itemsets", _itemsets_out_sql(HOLD_ITEMSETS_SQL), "baskets")
def holding_itemsets(spark, sf):
    """B2 with the all-customers denominator (binary-matrix convention)."""
    return _itemset_out(bk.frequent_itemsets(_holding_baskets(spark, sf), MIN_SUPPORT, denominator="all"))


@plan("itemsets_by_length", f"""
SELECT length, CAST(row_number() OVER (PARTITION BY length ORDER BY support DESC, items) AS INTEGER) AS rank, items, count
FROM ({_itemsets_out_sql(HOLD_ITEMSETS_SQL)}) x""", "baskets")
def itemsets_by_length(spark, sf):
    """Product combinations of every length by support."""
    sets = bk.itemsets_by_length(bk.frequent_itemsets(_holding_baskets(spark, sf), MIN_SUPPORT, denominator="all"))
    return sets.select(F.col("length").cast("long").alias("length"), F.col("rank").cast("int").alias("rank"),
                       bk.itemset_text("items").alias("items"), F.col("count").cast("long").alias("count"))


CANDIDATES_SQL = f"""
WITH i AS ({ORDER_ITEMSETS_SQL}), p AS (SELECT items_list AS l FROM i WHERE length = 2)
SELECT DISTINCT array_to_string([a.l[1], a.l[2], b.l[2]], ', ') AS items
FROM p a JOIN p b ON a.l[1] = b.l[1] AND a.l[2] < b.l[2]
"""


@plan("apriori_candidates", CANDIDATES_SQL, "baskets")
def apriori_candidates(spark, sf):
    """Size-3 candidates from the frequent pairs sharing a first item."""
    fi = _order_itemsets(spark, sf).where(F.col("length") == 2)
    return bk.candidates(fi.select("items"), 3).select(bk.itemset_text("items").alias("items"))


@plan("association_rules", _rules_sql(ORDER_ITEMSETS_SQL), "baskets")
def association_rules(spark, sf):
    """All rules with multi-item consequents, confidence >= 0.3."""
    return _rules_out(bk.association_rules(_order_itemsets(spark, sf), MIN_CONFIDENCE))


@plan("holding_rules", _rules_sql(HOLD_ITEMSETS_SQL), "baskets")
def holding_rules(spark, sf):
    """B4 on customer product holdings."""
    fi = bk.frequent_itemsets(_holding_baskets(spark, sf), MIN_SUPPORT, denominator="all")
    return _rules_out(bk.association_rules(fi, MIN_CONFIDENCE))


@plan("top_rules", f"""
SELECT * FROM ({_rules_sql(ORDER_ITEMSETS_SQL)}) r
ORDER BY lift DESC, confidence DESC, antecedents, consequents LIMIT 5""", "baskets")
def top_rules(spark, sf):
    """Five best rules by lift then confidence."""
    r = _rules_out(bk.association_rules(_order_itemsets(spark, sf), MIN_CONFIDENCE))
    return r.orderBy(F.col("lift").desc(), F.col("confidence").desc(), "antecedents", "consequents").limit(5)


@plan("top_combos", f"""
SELECT * FROM ({_itemsets_out_sql(ORDER_ITEMSETS_SQL)}) i WHERE length >= 2
ORDER BY support DESC, items LIMIT 3""", "baskets")
def top_combos(spark, sf):
    """Three most supported combinations of two or more items."""
    i = _itemset_out(_order_itemsets(spark, sf))
    return i.where(F.col("length") >= 2).orderBy(F.col("support").desc(), "items").limit(3)
