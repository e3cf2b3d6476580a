"""Table profiling and data-quality checks.

Each check is one distributed aggregate over the table (a single pass,
partial aggregation map-side) followed by an unpivot of the one result
row into one row per column; nothing is collected.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType,
           T.DoubleType, T.DecimalType)


def numeric_columns(df: DataFrame) -> list[str]:
    """Dtype-driven split, numeric side."""
    return [f.name for f in df.schema.fields if isinstance(f.dataType, NUMERIC)]


def categorical_columns(df: DataFrame) -> list[str]:
    """Dtype-driven split, string side."""
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]


def feature_columns(df: DataFrame, exclude: Sequence[str]) -> list[str]:
    """Every column except target / id / month."""
    ex = set(exclude)
    return [c for c in df.columns if c not in ex]


def columns_like(df: DataFrame, token: str) -> list[str]:
    """Select columns by name pattern."""
    return [c for c in df.columns if token in c]


def _as_text(f) -> F.Column:
    """A value as text, distinct texts for distinct values."""
    c = F.col(f"`{f.name}`")
    if isinstance(f.dataType, (T.FloatType, T.DoubleType)):
        return (c + F.lit(0.0)).cast("string")                   # -0.0 equals 0.0
    if isinstance(f.dataType, T.BinaryType):
        return F.hex(c)
    if isinstance(f.dataType, T.TimestampType):
        return F.unix_micros(c).cast("string")
    return c.cast("string")


def distinct_counts(df: DataFrame) -> DataFrame:
    """(ordinal, non_null, distinct) of every column: one narrow stream of
    (column number, value), counted per value with map-side combining, then
    per column.  No row carries the other columns."""
    cells = F.array(*[F.struct(F.lit(i + 1).alias("ordinal"), _as_text(f).alias("value")) for i, f in enumerate(df.schema.fields)])
    values = df.select(F.inline(cells)).groupBy("ordinal", "value").agg(F.count("value").alias("n"))
    return values.groupBy("ordinal").agg(F.sum("n").alias("non_null"), F.count("value").alias("distinct"))


def table_profile(df: DataFrame, exact_distinct: bool = True) -> DataFrame:
    """One row per column — ordinal, Spark type, non-null / null counts,
    distinct count, numeric min / max / mean.  ``exact_distinct=False``
    switches to HyperLogLog sketches (bounded memory per column)."""
    aggs = [F.count(F.lit(1)).alias("n")]
    for i, f in enumerate(df.schema.fields):
        c = F.col(f"`{f.name}`")
        if not exact_distinct:
            aggs += [F.count(c).alias(f"nn{i}"), F.approx_count_distinct(c).alias(f"d{i}")]
        if isinstance(f.dataType, NUMERIC):
            aggs += [F.min(c).cast("double").alias(f"mn{i}"), F.max(c).cast("double").alias(f"mx{i}"),
                     F.avg(c).cast("double").alias(f"av{i}")]
    rows = []
    nul = F.lit(None).cast("double")
    for i, f in enumerate(df.schema.fields):
        num = isinstance(f.dataType, NUMERIC)
        counted = [] if exact_distinct else [F.col(f"nn{i}").alias("non_null"), F.col(f"d{i}").alias("distinct")]
        rows.append(F.struct(
            F.lit(f.name).alias("column_name"), F.lit(i + 1).alias("ordinal"),
            F.lit(f.dataType.simpleString()).alias("data_type"), F.col("n"), *counted,
            (F.col(f"mn{i}") if num else nul).alias("min_value"),
            (F.col(f"mx{i}") if num else nul).alias("max_value"),
            (F.col(f"av{i}") if num else nul).alias("mean_value")))
    out = df.agg(*aggs).select(F.inline(F.array(*rows)))                     # one row per column
    if exact_distinct:
        out = out.join(distinct_counts(df), "ordinal", "left").na.fill(0, ["non_null", "distinct"])
    return out.select("column_name", "ordinal", "data_type", F.col("non_null").cast("long").alias("non_null"),
                      (F.col("n") - F.col("non_null")).cast("long").alias("nulls"), F.col("distinct").cast("long").alias("distinct"),
                      "min_value", "max_value", "mean_value")


def head(df: DataFrame, order: Sequence[str], n: int = 5) -> DataFrame:
    """First n rows by an explicit order key (top-k, no global sort)."""
    return df.orderBy(*order).limit(n)


def null_counts(df: DataFrame) -> DataFrame:
    """NULL count per column (one pass)."""
    one = df.agg(*[F.count_if(F.col(c).isNull()).cast("long").alias(c) for c in df.columns])
    return one.unpivot([], df.columns, "column_name", "null_count")


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Key values that occur more than once (with their count)."""
    return (df.groupBy(*keys).agg(F.count(F.lit(1)).cast("long").alias("rows"))
            .where(F.col("rows") > 1))


def orphans(child: DataFrame, parent: DataFrame, child_key: str, parent_key: str) -> DataFrame:
    """Child rows whose foreign key has no parent (left anti join)."""
    p = parent.select(F.col(parent_key).alias("__pk")).distinct()
    return child.join(p, F.col(child_key) == F.col("__pk"), "left_anti")


def date_range(df: DataFrame, col: str) -> DataFrame:
    """Min / max of a date-like column."""
    return df.agg(F.min(col).alias("min_value"), F.max(col).alias("max_value"))


def target_distribution(df: DataFrame, target: str) -> DataFrame:
    """Rows per class and share of all rows."""
    from pyspark.sql import Window
    g = df.groupBy(target).agg(F.count(F.lit(1)).cast("long").alias("rows"))
    # the grouped relation has one row per class: an unpartitioned window
    # over it is bounded by the number of classes.
    return g.withColumn("share", F.col("rows") / F.sum("rows").over(Window.partitionBy()))
