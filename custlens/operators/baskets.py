"""Basket association analysis.

Frequent itemsets are found level by level, like Apriori, but every
level is one distributed job:

* candidates of size k come from a self equi-join of the frequent
  (k-1)-sets on their first k-2 items (J6) — a relation whose size is
  bounded by the frequent sets of the previous level, not by the data;
* support is counted over the sets that grow from a basket's frequent
  (k-1)-sets *by frequent single items only*; frequent sets stay by a semi
  join on the set (J7) — the containment test is a hash join, no nested loop;
* counts are a partial (map-side) aggregation, so a hot item or a hot
  basket never concentrates raw rows on one task.

Subsets of a rule's set are enumerated with higher-order functions (no
Python).  Rules allow multi-item consequents (every
non-empty proper subset of a frequent itemset is an antecedent), which
Spark ML's FPGrowth does not produce; FPGrowth is offered for the
itemsets only (``method='fpgrowth'``).
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.sizing import DEFAULT_BROADCAST_ROWS, broadcast_if_small
from ..session import cut_lineage

SEP = "\u0001"


def flags_to_basket(df: DataFrame, flag_items: Mapping[str, str], key: str,
                    out: str = "items") -> DataFrame:
    """B1: 0/1 flag columns -> array of item names in the fixed item order."""
    arr = F.array(*[F.when(F.col(f) == 1, F.lit(item)) for f, item in flag_items.items()])
    return df.select(key, F.filter(arr, lambda x: x.isNotNull()).alias(out))


def facts_to_basket(df: DataFrame, key: str, item: str, out: str = "items") -> DataFrame:
    """B1 from fact rows: sorted distinct items per key (collect_set merges
    partial sets map-side; a set is bounded by the item universe)."""
    return df.groupBy(key).agg(F.array_sort(F.collect_set(item)).alias(out))


def non_empty(baskets: DataFrame, items: str = "items") -> DataFrame:
    """Keep baskets with at least one item."""
    return baskets.where(F.size(items) > 0)


def item_universe(baskets: DataFrame, items: str = "items") -> DataFrame:
    """Distinct items over all baskets."""
    return baskets.select(F.explode(items).alias("item")).distinct()


def subsets_up_to(items: Column, k: int) -> Column:
    """Subsets of at most ``k`` items of a sorted array (the empty one too),
    built item by item; order inside each subset is preserved."""
    empty = F.array(F.slice(items, 1, 0))
    return F.aggregate(items, empty, lambda acc, x: F.concat(acc, F.transform(
        F.filter(acc, lambda s: F.size(s) < k), lambda s: F.concat(s, F.array(x)))))


def subsets_of_size(items: Column, k: int) -> Column:
    """all size-k subsets of a sorted array, as an array of arrays."""
    return F.filter(subsets_up_to(items, k), lambda s: F.size(s) == k)


def proper_subsets(items: Column) -> Column:
    """all non-empty proper subsets."""
    n = F.size(items)
    return F.filter(subsets_up_to(items, (1 << 31) - 1), lambda s: (F.size(s) > 0) & (F.size(s) < n))


def _key(c: Column) -> Column:
    return F.array_join(c, SEP)


def basket_count(baskets: DataFrame, items: str = "items", denominator: str = "nonempty") -> DataFrame:
    """B2 denominator: non-empty baskets (hand-written Apriori) or all
    rows (binary-matrix convention)."""
    if denominator == "nonempty":
        return baskets.agg(F.count_if(F.size(items) > 0).alias("n_baskets"))
    if denominator == "all":
        return baskets.agg(F.count(F.lit(1)).alias("n_baskets"))
    raise ValueError("denominator must be 'nonempty' or 'all'")


def candidates(prev: DataFrame, k: int) -> DataFrame:
    """Join frequent (k-1)-sets sharing their first k-2 items, the
    left last item smaller than the right one -> sorted k-candidates."""
    a = prev.select(F.col("items").alias("a"))
    b = prev.select(F.col("items").alias("b"))
    if k == 2:
        cond = F.element_at("a", -1) < F.element_at("b", -1)
        j = a.join(b, cond)  # pairs of frequent single items: bounded by the level-1 output
    else:
        pa = a.withColumn("p", _key(F.slice("a", 1, k - 2)))
        pb = b.withColumn("p", _key(F.slice("b", 1, k - 2)))
        j = pa.join(pb, "p").where(F.element_at("a", -1) < F.element_at("b", -1))
    return j.select(F.concat("a", F.slice("b", -1, 1)).alias("items")).distinct()


def _frequent_only(rows: DataFrame, col: str, level: DataFrame) -> DataFrame:
    """Rows whose set is in a (materialised) frequent level: a hash semi join, by a
    counted broadcast or a shuffle on the set."""
    sets = level.select(F.col("items").alias(col))
    return rows.join(F.broadcast(sets) if level.count() <= DEFAULT_BROADCAST_ROWS else sets, col, "left_semi")


def _grown() -> Column:
    """Rows (items, rest) -> every set one item longer with what may follow it."""
    return F.inline(F.transform("rest", lambda x, i: F.struct(
        F.concat("items", F.array(x)).alias("items"), F.slice("rest", i + 2, F.size("rest")).alias("rest"))))


def frequent_itemsets(baskets: DataFrame, min_support: float, items: str = "items",
                      denominator: str = "nonempty", max_len: int | None = None,
                      method: str = "apriori") -> DataFrame:
    """Every itemset with support >= min_support.

    Output: items (sorted array), length, count, support.  Levels are
    built until no candidate is frequent (``max_len`` only limits the
    reported length when given; default is the full lattice).

    Level by level, every frequent (k-1)-set that a basket holds is extended by
    the basket's later frequent items; sets are counted and the frequent ones
    stay by a semi join.  No subset that has no frequent prefix is built.
    """
    n = basket_count(baskets, items, denominator)
    if method == "fpgrowth":
        return _fpgrowth(baskets, min_support, items, denominator, n)
    bs = non_empty(baskets.select(F.col(items).alias("items")))
    # equal baskets are one row with its number; written once, as the numbers of
    # the rows must not change between passes
    bs = bs.groupBy(F.array_sort(F.array_distinct("items")).alias("items")).agg(F.count(F.lit(1)).alias("weight"))
    bs = cut_lineage(bs.withColumn("basket", F.monotonically_increasing_id()))
    counted = F.sum("weight").cast("long").alias("count")
    # the number of baskets once, not once a level
    n = bs.agg(F.coalesce(F.sum("weight"), F.lit(0)).alias("n_baskets")) if denominator == "nonempty" else cut_lineage(n)

    def with_support(counts):
        return (counts.crossJoin(F.broadcast(n))
                .withColumn("support", F.col("count") / F.col("n_baskets"))
                .where(F.col("support") >= F.lit(min_support))
                .select("items", F.size("items").alias("length"), "count", "support").cache())

    single = bs.select("basket", "weight", F.explode("items").alias("item")).select("basket", "weight", F.array("item").alias("items"))
    levels, k = [with_support(single.groupBy("items").agg(counted))], 2
    # every row is a frequent set that a basket holds, with the basket's later
    # frequent items; sets grow by those, so work follows the frequent sets and
    # a basket's sets need not meet again
    kept = _frequent_only(single, "items", levels[0]).groupBy("basket", "weight").agg(
        F.array_sort(F.collect_list(F.element_at("items", 1))).alias("rest"))
    held = kept.select("weight", F.array().cast(bs.schema["items"].dataType).alias("items"), "rest")
    held = held.select("weight", _grown())
    while max_len is None or k <= max_len:
        grown = held.select("weight", _grown())
        level = with_support(grown.groupBy("items").agg(counted))
        if level.count() == 0:
            break
        levels.append(level)
        held = _frequent_only(grown, "items", level)
        k += 1
    out = levels[0]
    for lv in levels[1:]:
        out = out.unionByName(lv)
    return out


def _fpgrowth(baskets, min_support, items, denominator, n):
    from pyspark.ml.fpm import FPGrowth
    src = baskets.select(F.array_distinct(items).alias("items"))
    if denominator == "nonempty":
        src = non_empty(src)
    model = FPGrowth(itemsCol="items", minSupport=min_support, minConfidence=1.0).fit(src)
    fi = model.freqItemsets
    return (fi.crossJoin(F.broadcast(n))
            .select(F.array_sort("items").alias("items"), F.size("items").alias("length"),
                    F.col("freq").cast("long").alias("count"),
                    (F.col("freq") / F.col("n_baskets")).alias("support"))
            .where(F.col("support") >= F.lit(min_support)))


def association_rules(itemsets: DataFrame, min_confidence: float) -> DataFrame:
    """B4/B5 + J8: for every frequent itemset of length >= 2 and each
    non-empty proper subset A: confidence = sup(I)/sup(A),
    lift = confidence / sup(I - A); keep confidence >= min_confidence."""
    sup = broadcast_if_small(itemsets.select(_key(F.col("items")).alias("_k"), "support"))
    big = itemsets.where(F.col("length") >= 2)
    r = big.select(F.col("items").alias("itemset"), F.col("support"),
                   F.explode(proper_subsets(F.col("items"))).alias("antecedents"))
    r = r.withColumn("consequents", F.array_except("itemset", "antecedents"))
    sa = sup.select(F.col("_k").alias("_ka"), F.col("support").alias("antecedent_support"))
    sc = sup.select(F.col("_k").alias("_kc"), F.col("support").alias("consequent_support"))
    r = (r.join(sa, _key(F.col("antecedents")) == F.col("_ka"))
         .join(sc, _key(F.col("consequents")) == F.col("_kc")))
    conf = F.col("support") / F.col("antecedent_support")
    return (r.withColumn("confidence", conf)
            .withColumn("lift", F.col("confidence") / F.col("consequent_support"))
            .where(F.col("confidence") >= F.lit(min_confidence))
            .select("antecedents", "consequents", "support", "confidence", "lift",
                    "antecedent_support", "consequent_support"))


def rank_rules(rules: DataFrame) -> DataFrame:
    """Lift desc, confidence desc, then the rule text as tie-break."""
    return rules.orderBy(F.col("lift").desc(), F.col("confidence").desc(),
                         F.array_join("antecedents", ", "), F.array_join("consequents", ", "))


def top_rules(rules: DataFrame, k: int = 5) -> DataFrame:
    """The k best rules."""
    return rank_rules(rules).limit(k)


def top_combos(itemsets: DataFrame, k: int = 3, min_len: int = 2) -> DataFrame:
    """The k most supported itemsets with at least ``min_len`` items."""
    return (itemsets.where(F.col("length") >= min_len)
            .orderBy(F.col("support").desc(), F.array_join("items", ", ")).limit(k))


def itemsets_by_length(itemsets: DataFrame) -> DataFrame:
    """Rank of every set among those of its length, by support descending (ties
    by the items); a table of frequent sets, not of baskets."""
    order = Window.partitionBy("length").orderBy(F.col("support").desc(), F.array_join("items", ", "))
    return itemsets.withColumn("rank", F.row_number().over(order))


def itemset_text(c: str | Column, sep: str = ", ") -> Column:
    """items joined for display."""
    return F.array_join(F.col(c) if isinstance(c, str) else c, sep)
