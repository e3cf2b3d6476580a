"""Exact running sums in value order within groups, without a window over
a whole group.

Each group is cut into ``buckets`` ranges at approximate quantiles of
the ordering column (computed in the plan, one bounded row per group);
per-range totals give exclusive offsets (a window over a table of
groups x buckets rows); running sums then run inside ranges only.  The
result is exact — the quantiles only decide how evenly work is spread —
and a hot group is spread over ``buckets`` tasks instead of one.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .sizing import broadcast_if_small


def _count_less(arr, x, n):
    from ..operators.metrics import count_less
    return count_less(arr, x, n)


def grouped_running(df: DataFrame, group: Sequence[str], order: str, sums: Sequence[str],
                    buckets: int = 64, next_value: bool = False, accuracy: int = 1000) -> DataFrame:
    """Adds ``cum_<c>`` (inclusive running sum of each ``sums`` column in
    ascending ``order`` within ``group``), ``tot_<c>`` (group totals) and,
    with ``next_value``, ``next_<order>`` (the next row's ``order`` value,
    NULL on the group's last row).  Rows are assumed unique on
    (group, order) — aggregate first.  The split points and range totals
    are counted tables (groups x buckets rows) and travel as broadcasts, so
    rows are only ever shuffled on (group, range)."""
    group = list(group)
    # three branches read ``df`` (split points, range totals, rows): write it
    # once to the shared checkpoint folder instead of recomputing its lineage
    from ..session import cut_lineage
    df = cut_lineage(df)
    probs = [i / buckets for i in range(1, buckets)]
    sp = df.groupBy(*group).agg(F.percentile_approx(order, probs, accuracy).alias("_sp"),
                                *[F.sum(c).alias(f"tot_{c}") for c in sums])
    x = df.join(broadcast_if_small(sp), group).withColumn(
        "_b", _count_less(F.col("_sp"), F.col(order), len(probs))).drop("_sp")
    aggs = [F.sum(c).alias(f"_t_{c}") for c in sums] + [F.min(order).alias("_first")]
    tot = x.groupBy(*group, "_b").agg(*aggs)
    wo = Window.partitionBy(*group).orderBy("_b")
    before = wo.rowsBetween(Window.unboundedPreceding, -1)
    cols = [*group, "_b"]
    cols += [F.coalesce(F.sum(f"_t_{c}").over(before), F.lit(0)).alias(f"_o_{c}") for c in sums]
    cols += [F.lead("_first").over(wo).alias("_next_first")]
    off = tot.select(*cols)
    wi = Window.partitionBy(*group, "_b").orderBy(order)
    run = wi.rowsBetween(Window.unboundedPreceding, 0)
    out = x.join(broadcast_if_small(off), [*group, "_b"])  # x carries tot_<c>
    out = out.withColumns({f"cum_{c}": F.sum(c).over(run) + F.col(f"_o_{c}") for c in sums})
    if next_value:
        out = out.withColumn(f"next_{order}", F.coalesce(F.lead(order).over(wi), F.col("_next_first")))
    return out.drop("_b", "_next_first", *[f"_o_{c}" for c in sums])


def grouped_quantiles(df: DataFrame, group: Sequence[str], value: str, qs: Sequence[float],
                      buckets: int = 64) -> DataFrame:
    """Exact linear-interpolated quantiles (the ``percentile`` /
    ``quantile_cont`` definition) per group: position h = q (n - 1); the
    value is v[floor h] + frac(h) (v[floor h + 1] - v[floor h]) over the
    sorted values.  Distinct values are counted first, their rank ranges
    come from ``grouped_running``; each needed order statistic is found
    by a range test on its row — no group is ever held by one task."""
    group = list(group)
    d = df.where(F.col(value).isNotNull()).groupBy(*group, F.col(value).cast("double").alias("_v")).agg(
        F.count(F.lit(1)).alias("_c"))
    r = grouped_running(d, group, "_v", ["_c"], buckets)
    n = F.col("tot__c")
    lo_r, hi_r = F.col("cum__c") - F.col("_c"), F.col("cum__c")   # rows (lo_r, hi_r] hold _v (0-based ranks lo_r..hi_r-1)
    hits = []
    for i, q in enumerate(qs):
        h = F.lit(float(q)) * (n - 1)
        k0 = F.floor(h).cast("long")
        k1 = F.least(k0 + 1, n - 1)
        for which, k in (("a", k0), ("b", k1)):
            hits.append(F.when((k >= lo_r) & (k < hi_r), F.struct(F.lit(i).alias("qi"), F.lit(which).alias("w"),
                                                                   (h - k0).alias("frac"))))
    e = r.select(*group, "_v", F.explode(F.filter(F.array(*hits), lambda s: s.isNotNull())).alias("_h"))
    g = e.groupBy(*group, F.col("_h.qi").alias("qi")).agg(
        F.max(F.when(F.col("_h.w") == "a", F.col("_v"))).alias("_a"),
        F.max(F.when(F.col("_h.w") == "b", F.col("_v"))).alias("_bv"),
        F.max("_h.frac").alias("_f"))
    qarr = F.array(*[F.lit(float(q)) for q in qs])
    return g.select(*group, F.element_at(qarr, F.col("qi") + 1).alias("quantile"),
                    (F.col("_a") + F.col("_f") * (F.col("_bv") - F.col("_a"))).alias("value"))


def exact_medians(df: DataFrame, cols: Sequence[str], prefix: str = "__med_") -> DataFrame:
    """One-row frame of exact medians (``prefix + column``), computed with
    ``grouped_quantiles`` so no single task holds a column's values."""
    long = df.select(F.inline(F.array(*[F.struct(F.lit(c).alias("_col"), F.col(c).cast("double").alias("_x"))
                                        for c in cols])))
    q = grouped_quantiles(long, ["_col"], "_x", [0.5])
    one = q.groupBy().pivot("_col", list(cols)).agg(F.first("value"))
    return one.select(*[F.col(f"`{c}`").alias(f"{prefix}{c}") for c in cols])
