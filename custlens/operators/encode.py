"""Feature encoding, scaling, sampling and splits.

Statistics are one distributed aggregate (a single row) cross-joined
back as a broadcast.  Codes of category columns are numbered in value ranges,
so a column may have as many values as rows; one column per category
(``one_hot``) is for columns whose categories the caller knows to be few,
``one_hot_entries`` and ``one_hot_vector`` take any number.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import OneHotEncoder, VectorAssembler
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.sizing import DEFAULT_BROADCAST_ROWS, broadcast_if_small
from ..session import cut_lineage

SALTS = 16              # copies of the code of a value with many rows, where the code table is too large to broadcast
MANY_ROWS = 100_000     # rows of one value from which it is dealt over SALTS tasks


def standardize(df: DataFrame, cols: Sequence[str], suffix: str = "",
                fit_on: DataFrame | None = None) -> DataFrame:
    """(x - mean) / std with the *population* std; a constant column
    is divided by 1.  Statistics come from ``fit_on`` (default: ``df``)."""
    src = df if fit_on is None else fit_on
    stats = src.agg(*[F.avg(c).alias(f"__m_{c}") for c in cols],
                    *[F.stddev_pop(c).alias(f"__s_{c}") for c in cols])
    out = df.crossJoin(F.broadcast(stats))
    scaled = {}
    for c in cols:
        s = F.col(f"__s_{c}")
        s = F.when(s.isNull() | (s == 0), F.lit(1.0)).otherwise(s)
        scaled[f"{c}{suffix}"] = (F.col(c) - F.col(f"__m_{c}")) / s
    out = out.withColumns(scaled)
    return out.drop(*[f"__m_{c}" for c in cols], *[f"__s_{c}" for c in cols])


def categories(df: DataFrame, col: str) -> list[str]:
    """Sorted distinct non-null values, for one column each."""
    vals = df.where(F.col(col).isNotNull()).select(F.col(col).cast("string").alias("v")).distinct().orderBy("v")
    return [r.v for r in vals.collect()]


def one_hot(df: DataFrame, col: str, values: Sequence[str] | None = None,
            drop_source: bool = False) -> DataFrame:
    """One 0/1 double column per category, named ``{col}_{value}``,
    sorted categories, no dropped level; unknown / NULL -> all zeros."""
    vals = list(values) if values is not None else categories(df, col)
    c = F.col(col).cast("string")
    out = df.withColumns({f"{col}_{v}": F.when(c == F.lit(v), 1.0).otherwise(0.0) for v in vals})
    return out.drop(col) if drop_source else out


def dense_codes(df: DataFrame, col: str, code: str = "code") -> DataFrame:
    """(col, code): the distinct non-null values with their 0-based positions in
    sorted order.  Values are cut into ranges (a range partitioning of the
    distinct values); positions are numbered inside a range and shifted by the
    counted sizes of the ranges before it, so no task sorts all values."""
    values = df.select(F.col(col).alias("__v")).where(F.col("__v").isNotNull()).distinct()
    # written once: the ranges must not change between the counting and the numbering
    ranged = cut_lineage(values.repartitionByRange("__v").withColumn("__range", F.spark_partition_id()))
    sizes = ranged.groupBy("__range").agg(F.count(F.lit(1)).alias("__n"))          # one row per partition
    before = Window.orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("__range", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__before"))
    place = F.row_number().over(Window.partitionBy("__range").orderBy("__v")) - 1
    return ranged.join(F.broadcast(offsets), "__range").select(F.col("__v").alias(col), (place + F.col("__before")).cast("long").alias(code))


def with_codes(df: DataFrame, codes: DataFrame, col: str) -> DataFrame:
    """Left join of a code table.  A counted small table is broadcast; a larger one
    is shuffled, never broadcast on an estimate.  Only values with more than
    ``MANY_ROWS`` rows are held ``SALTS`` times (there are at most rows /
    ``MANY_ROWS`` of them): their rows, and rows without a value, pick a copy by
    their task, so a value with a great share of the rows meets its code in as
    many tasks."""
    codes = codes.withColumnRenamed(col, "__v")
    if codes.count() <= DEFAULT_BROADCAST_ROWS:
        return df.join(F.broadcast(codes), F.col(col) == F.col("__v"), "left").drop("__v")
    many = df.where(F.col(col).isNotNull()).groupBy(F.col(col).alias("__m")).agg(F.count(F.lit(1)).alias("__n")).where(F.col("__n") > MANY_ROWS)
    many = F.broadcast(cut_lineage(many.select("__m")))
    own = F.pmod(F.spark_partition_id(), F.lit(SALTS))
    left = df.join(many, F.col(col) == F.col("__m"), "left").withColumn(
        "__salt", F.when(F.col(col).isNull() | F.col("__m").isNotNull(), own).otherwise(0)).drop("__m")
    right = codes.join(many, F.col("__v") == F.col("__m"), "left").withColumn(
        "__copy", F.explode(F.sequence(F.lit(0), F.when(F.col("__m").isNotNull(), SALTS - 1).otherwise(0)))).drop("__m")
    return left.join(right.hint("merge"), (F.col(col) == F.col("__v")) & (F.col("__salt") == F.col("__copy")), "left").drop("__v", "__salt", "__copy")


def label_encode(df: DataFrame, col: str, out: str | None = None) -> DataFrame:
    """code = position of the value among the sorted distinct values
    (0-based), for any number of values; NULL has no code."""
    out = out or f"{col}_encoded"
    return with_codes(df, dense_codes(df, col, out), col)


def one_hot_entries(df: DataFrame, keys: Sequence[str], cols: Sequence[str]) -> DataFrame:
    """E3 for wide columns: the non-zero entries (keys, position, feature, value) of
    the one-hot matrix, one per row and non-null column.  Columns follow each
    other in the order of ``cols``, categories in sorted order within them;
    nothing is collected and categories are not bounded."""
    coded, start = df.select(*keys, *cols), None
    entries = []
    for i, c in enumerate(cols):
        codes = dense_codes(df, c, f"__code{i}")
        coded = with_codes(coded, codes, c)
        width = codes.agg(F.count(F.lit(1)).alias(f"__width{i}"))                     # one row
        coded = coded.crossJoin(F.broadcast(width))
        at = F.col(f"__code{i}") if start is None else F.col(f"__code{i}") + start
        start = F.col(f"__width{i}") if start is None else start + F.col(f"__width{i}")
        entries.append(F.when(F.col(c).isNotNull(), F.struct(
            at.alias("position"), F.concat(F.lit(f"{c}_"), F.col(c).cast("string")).alias("feature"), F.lit(1.0).alias("value"))))
    return coded.select(*keys, F.inline(F.filter(F.array(*entries), lambda e: e.isNotNull())))


def one_hot_vector(df: DataFrame, cols: Sequence[str], out: str = "one_hot") -> DataFrame:
    """E3 as one sparse vector per row (for Spark ML models), any number of
    categories; NULL is all zeros.  Columns and categories are placed as by
    ``one_hot_entries``."""
    codes, parts = [f"__code{i}" for i in range(len(cols))], [f"__part{i}" for i in range(len(cols))]
    for c, code in zip(cols, codes):
        df = label_encode(df, c, code).withColumn(code, F.coalesce(F.col(code).cast("double"), F.lit(float("nan"))))
    # 'keep' gives NaN a position behind all categories, dropLast takes that position away
    greatest = df.agg(*[F.coalesce(F.max(F.when(~F.isnan(c), F.col(c))), F.lit(0.0)).alias(c) for c in codes])
    model = OneHotEncoder(inputCols=codes, outputCols=parts, dropLast=True, handleInvalid="keep").fit(greatest)
    return VectorAssembler(inputCols=parts, outputCol=out).transform(model.transform(df)).drop(*codes, *parts)


def median_impute(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """NULL -> exact median of the column."""
    from ..functions.ranges import exact_medians
    med = exact_medians(df, cols)
    out = df.crossJoin(F.broadcast(med))
    out = out.withColumns({c: F.coalesce(F.col(c), F.col(f"__med_{c}")) for c in cols})
    return out.drop(*[f"__med_{c}" for c in cols])


def constant_impute(df: DataFrame, cols: Sequence[str], value: str = "missing") -> DataFrame:
    """NULL -> a constant."""
    return df.fillna(value, subset=list(cols))


def hash_unit(key: Column, seed: int) -> Column:
    """A reproducible pseudo-random number in [0, 1) from a key: the first
    32 bits of md5(key || ':' || seed)."""
    h = F.md5(F.concat(key.cast("string"), F.lit(f":{seed}")))
    return F.conv(F.substring(h, 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)


def md5_sample(df: DataFrame, key: str, n: int, seed: int = 42) -> DataFrame:
    """Exactly ``n`` rows, reproducible: the ``n`` smallest
    md5(key || ':' || seed) values (a top-k, no global sort)."""
    h = F.md5(F.concat(F.col(key).cast("string"), F.lit(f":{seed}")))
    return df.withColumn("__h", h).orderBy("__h", key).limit(n).drop("__h")


def hash_split(df: DataFrame, key: str, test_fraction: float = 0.2, seed: int = 42,
               group_col: str | None = None) -> DataFrame:
    """Adds ``is_test``: a row (or, with ``group_col``, a whole group —
    no leakage of one customer across sides) is in the test side when its
    hash unit is below ``test_fraction``.  Per-class proportions are
    preserved in expectation; no shuffle, no window."""
    k = F.col(group_col) if group_col else F.col(key)
    return df.withColumn("is_test", hash_unit(k, seed) < F.lit(test_fraction))


def rank_within(df: DataFrame, group: str, key: str, seed: int = 42, buckets: int = 1024) -> DataFrame:
    """Exact 1-based rank of every row inside its group in the order
    md5(key || ':' || seed), plus the group size — without a window over
    a whole group.  The md5 prefix cuts each group into ``buckets``
    hash ranges of near-equal size (uniform hash), per-(group, range)
    counts give exclusive offsets (a window over a bounded table), and
    rows are numbered inside their range only."""
    h = F.md5(F.concat(F.col(key).cast("string"), F.lit(f":{seed}")))
    b = F.floor(F.conv(F.substring(h, 1, 8), 16, 10).cast("double") / F.lit(4294967296.0) * buckets).cast("int")
    x = df.withColumn("__h", h).withColumn("__b", b)
    cnt = x.groupBy(group, "__b").agg(F.count(F.lit(1)).alias("__c"))
    wo = Window.partitionBy(group).orderBy("__b")
    off = cnt.select(group, "__b",
                     (F.sum("__c").over(wo.rowsBetween(Window.unboundedPreceding, 0)) - F.col("__c")).alias("__off"),
                     F.sum("__c").over(Window.partitionBy(group)).alias("group_size"))
    wl = Window.partitionBy(group, "__b").orderBy("__h", key)
    return (x.join(broadcast_if_small(off), [group, "__b"])
            .withColumn("rank_in_group", F.row_number().over(wl) + F.col("__off"))
            .drop("__h", "__b", "__off"))


def stratified_split(df: DataFrame, key: str, label: str, test_fraction: float = 0.2,
                     seed: int = 42) -> DataFrame:
    """E8 with exact per-class counts: the first round(fraction * class
    size) rows of each class in hash order form the test side."""
    r = rank_within(df, label, key, seed)
    return r.withColumn("is_test", F.col("rank_in_group") <= F.round(F.col("group_size") * test_fraction)).drop(
        "rank_in_group", "group_size")


def time_split(df: DataFrame, month: str, train: tuple[str, str], test: tuple[str, str]) -> DataFrame:
    """Inclusive 'yyyy-MM' ranges -> ``split`` = train / test / NULL."""
    m = F.col(month)
    return df.withColumn("split", F.when(m.between(*train), F.lit("train"))
                         .when(m.between(*test), F.lit("test")))
