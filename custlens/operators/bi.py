"""Dashboard roll-ups.

All are algebraic aggregates: partial aggregation happens map-side, so a
hot month or a hot customer never lands on one task as raw rows.  Small
literal tables (bin edges, recode maps) are built from parameters and
have a size bounded by the parameter, never by the data.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.exact import exact_avg, exact_sum


def value_counts(df: DataFrame, col: str, count_col: str = "count") -> DataFrame:
    """A1: NULLs excluded, count per value."""
    return (df.where(F.col(col).isNotNull()).groupBy(col)
            .agg(F.count(F.lit(1)).cast("long").alias(count_col)))


def _agg(how: str, col: str, money_scale: int | None):
    if money_scale is not None:
        return {"sum": exact_sum, "avg": exact_avg, "mean": exact_avg}[how](col, money_scale)
    return {"sum": F.sum, "avg": F.avg, "mean": F.avg, "max": F.max}[how](col)


def monthly(df: DataFrame, month: str, value: str, how: str = "sum",
            scale: float = 1.0, out: str | None = None, group: Sequence[str] = (),
            money_scale: int | None = None) -> DataFrame:
    """A2 / A3: per-month SUM or AVG of a column, optionally scaled
    (÷10,000 in the reference's AUM trend) and per extra group key.
    ``money_scale``: amounts with that many decimals are summed exactly."""
    agg = _agg(how, value, money_scale)
    return (df.where(F.col(month).isNotNull()).groupBy(*group, month)
            .agg((agg * F.lit(scale)).alias(out or f"{how}_{value}")))


def recode(col: str | Column, mapping: Mapping[str, str], keep_unmapped: bool = True) -> Column:
    """Map values through a literal map; unmapped values are kept
    (``replace`` semantics) or become NULL (``map`` semantics)."""
    c = F.col(col) if isinstance(col, str) else col
    m = F.create_map(*[F.lit(x) for kv in mapping.items() for x in kv])
    hit = F.try_element_at(m, c)
    return F.coalesce(hit, c) if keep_unmapped else hit


def rename(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """P12."""
    return df.withColumnsRenamed(dict(mapping))


def unpivot_agg(df: DataFrame, cols: Sequence[str], how: str, name_col: str,
                value_col: str, labels: Mapping[str, str] | None = None,
                money_scale: int | None = None) -> DataFrame:
    """A4 / A5: one aggregate per column, then one row per column."""
    one = df.agg(*[_agg(how, c, money_scale).cast("double").alias(c) for c in cols])
    long = one.unpivot([], list(cols), name_col, value_col)
    if labels:
        long = long.withColumn(name_col, recode(name_col, labels))
    return long


def ever_held(df: DataFrame, key: str, flags: Sequence[str]) -> DataFrame:
    """Per key, 1 if the flag was ever set."""
    return df.groupBy(key).agg(*[F.max(c).cast("int").alias(c) for c in flags])


def holding_percent(held: DataFrame, flags: Sequence[str], labels: Mapping[str, str] | None = None,
                    name_col: str = "product") -> DataFrame:
    """Holders per product and percent of all keys."""
    one = held.agg(F.count(F.lit(1)).alias("__n"),
                   *[F.sum(c).cast("long").alias(c) for c in flags])
    long = one.unpivot(["__n"], list(flags), name_col, "holders")
    if labels:
        long = long.withColumn(name_col, recode(name_col, labels))
    return long.select(name_col, "holders",
                       (F.col("holders") / F.col("__n") * 100.0).alias("percent"))


def bin_table(spark: SparkSession, edges: Sequence[float], labels: Sequence[str]) -> DataFrame:
    """Literal bin table [lo, hi): len(labels) == len(edges) + 1; the first
    bin is (-inf, edges[0]) and the last [edges[-1], +inf)."""
    if len(labels) != len(edges) + 1:
        raise ValueError("need one more label than edges")
    bounds = [None, *[float(e) for e in edges], None]
    rows = [(i, labels[i], bounds[i], bounds[i + 1]) for i in range(len(labels))]
    return spark.createDataFrame(rows, "bin int, label string, lo double, hi double")


def bin_index(col: str | Column, edges: Sequence[float]) -> Column:
    """Index of the [lo, hi) bin holding the value (NULL stays NULL)."""
    c = F.col(col) if isinstance(col, str) else col
    expr = F.when(c.isNull(), F.lit(None).cast("int"))
    for i, e in enumerate(edges):
        expr = expr.when(c < F.lit(e), F.lit(i))
    return expr.otherwise(F.lit(len(edges)))


def histogram(df: DataFrame, col: str, edges: Sequence[float], labels: Sequence[str],
              label_col: str = "bin_label") -> DataFrame:
    """Counts per [lo, hi) bin, empty bins included (zero-filled by a
    left join from the literal bin table, whose size is len(labels))."""
    counts = (df.select(bin_index(col, edges).alias("bin")).where(F.col("bin").isNotNull())
              .groupBy("bin").agg(F.count(F.lit(1)).cast("long").alias("count")))
    bins = bin_table(df.sparkSession, edges, labels)
    return (bins.join(F.broadcast(counts), "bin", "left")                 # at most one row per bin
            .select(F.col("bin"), F.col("label").alias(label_col),
                    F.coalesce(F.col("count"), F.lit(0).cast("long")).alias("count")))


def dashboard_rows(cells: DataFrame, sets: Mapping[str, Sequence[tuple[str, Column]]], whole: Sequence[tuple[str, Column, Column]],
                   measures: Mapping[str, Column]) -> DataFrame:
    """(dataset, label, value) rows of several roll-ups by GROUPING SETS over
    one table of ``cells``.  ``sets`` maps a grouping column to its (dataset,
    value) pairs, one row per value of the column; ``whole`` lists (dataset,
    label, value) rows of the total; ``measures`` are the sums they are made of."""
    cols = list(sets)
    rolled = cells.groupingSets([*[[c] for c in cols], []], *cols).agg(
        F.grouping_id(*cols).alias("__set"), *[m.alias(n) for n, m in measures.items()])
    row = lambda dataset, label, value: F.struct(F.lit(dataset).alias("dataset"), label.cast("string").alias("label"),
                                                 value.cast("double").alias("value"))
    everything = (1 << len(cols)) - 1
    parts = F.when(F.col("__set") == everything, F.array(*[row(d, label, v) for d, label, v in whole])) if whole else None
    for i, c in enumerate(cols):
        mine = F.col("__set") == everything - (1 << len(cols) - 1 - i)
        mine = mine & F.col(c).isNotNull()
        items = F.array(*[row(d, F.col(c), v) for d, v in sets[c]])
        parts = F.when(mine, items) if parts is None else parts.when(mine, items)
    return rolled.select(F.inline(parts))


def latest_month(df: DataFrame, month: str = "stat_month") -> Column:
    return F.max(month)


def snapshot(behaviour: DataFrame, as_of: str | None = None, month: str = "stat_month") -> DataFrame:
    """P5: rows of one month; ``as_of=None`` selects the latest month by a scalar
    subquery, which a table partitioned by the month takes as a partition
    filter (no driver round trip)."""
    as_of = behaviour.agg(F.max(month)).scalar() if as_of is None else F.lit(as_of)
    return behaviour.where(F.col(month) == as_of)


def snapshot_join(base: DataFrame, behaviour: DataFrame, as_of: str | None = None,
                  key: str = "customer_id", month: str = "stat_month") -> DataFrame:
    """P5 + J2: filter the month first, then inner join to the customer table.  Over a
    stage table partitioned by the month only one partition is read."""
    return base.join(snapshot(behaviour, as_of, month), key, "inner")


def level_ladder(col: str | Column, edges: Sequence[float], labels: Sequence[str]) -> Column:
    """Value -> ordered level name via [lo, hi) bins (asset_level)."""
    idx = bin_index(col, edges)
    return F.element_at(F.array(*[F.lit(x) for x in labels]), idx + 1)
