"""Connected components over a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut_lineage, lookup


def components(links: DataFrame) -> DataFrame:
    """(a, b) links -> (id, component_id): for every linked id the smallest id
    that links reach from it.

    Large-star / small-star rounds: every round replaces the links by links
    to the smallest neighbour, so stars form in about log(diameter) rounds;
    each round is two grouped minima and is checkpointed.  Minima are
    combined before the shuffle and meet the links by a counted broadcast or a
    salted join, so a node with very many links is no task of its own.  The
    loop ends when a round changes nothing."""
    e = links.select(F.least("a", "b").alias("lo"), F.greatest("a", "b").alias("hi")).where("lo < hi").distinct()
    e = cut_lineage(e)
    while True:
        both = e.select(F.col("hi").alias("u"), F.col("lo").alias("v")).unionByName(
            e.select(F.col("lo").alias("u"), F.col("hi").alias("v")))
        low = cut_lineage(both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m")))
        # large star: every larger neighbour of u now points to u's smallest neighbour
        large = (lookup(both.where("v > u"), low, "u")
                 .select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionByName(low.where("m < u").select("u", F.col("m").alias("v")))
                 .where("u > v").distinct())
        large = cut_lineage(large)
        # small star: every smaller neighbour of u points to the smallest of them
        least = cut_lineage(large.groupBy("u").agg(F.min("v").alias("m")))
        small = (lookup(large, least, "u").select(F.col("v").alias("hi"), F.col("m").alias("lo")).where("lo < hi")
                 .unionByName(least.select(F.col("u").alias("hi"), F.col("m").alias("lo"))).distinct())
        nxt = cut_lineage(small)
        if nxt.count() == e.count() and nxt.join(e, ["lo", "hi"], "left_anti").isEmpty():
            break
        e = nxt
    roots = e.select(F.col("hi").alias("id"), F.col("lo").alias("component_id"))
    return roots.unionByName(roots.select(F.col("component_id").alias("id"), "component_id").distinct())
