"""Per-customer time features and the forward label.

All windows share one spec ``partitionBy(key).orderBy(order)``, so the
whole feature block is a single Window node behind one exchange on the
key.  The window input is the (customer, month) aggregate, so the rows
one task holds for one customer are bounded by the number of months,
however skewed the raw orders are.

Shifts are by row, not by calendar: a missing month is not filled.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

DYNAMIC_DEFAULT = ("total_assets", "deposit_balance", "financial_balance",
                   "fund_balance", "insurance_balance", "product_count", "txn_count")
ROLLING_DEFAULT = ("total_assets", "financial_balance", "fund_balance")


def join_base_behaviour(base: DataFrame, behaviour: DataFrame,
                        key: str = "customer_id", how: str = "left") -> DataFrame:
    """Customers without behaviour rows are kept (NULL month) for ``left``."""
    return base.join(behaviour, on=key, how=how)


def fill_median(df: DataFrame, numeric: Sequence[str], categorical: Sequence[str] = (),
                fill_value: str = "unknown") -> DataFrame:
    """NULL numerics -> exact median over the rows of ``df``; NULL
    strings -> a constant.  The medians (exact, from distributed rank
    ranges) form one small row attached as a broadcast; no data reaches
    the driver."""
    if not numeric:
        return df.fillna(fill_value, subset=list(categorical)) if categorical else df
    from ..functions.ranges import exact_medians
    med = exact_medians(df, numeric)
    out = df.crossJoin(F.broadcast(med))
    out = out.select(*[
        F.coalesce(F.col(c), F.col(f"__med_{c}").cast(df.schema[c].dataType)).alias(c)
        if c in numeric else F.col(c) for c in df.columns])
    return out.fillna(fill_value, subset=list(categorical)) if categorical else out


def add_time_features(df: DataFrame, key: str = "customer_id", order: str = "stat_month",
                      value: str = "total_assets",
                      dynamic: Sequence[str] = DYNAMIC_DEFAULT,
                      rolling: Sequence[str] = ROLLING_DEFAULT,
                      window: int = 3) -> DataFrame:
    """P10 + W1–W4.

    * dynamic columns: NULL -> 0
    * asset_growth_rate: (x - lag x) / lag x, NULL (first row, or 0
      denominator) -> 0
    * asset_mom_change: x - lag x, first row 0
    * asset_cumulative_growth: running sum of the change, i.e. x minus
      the customer's first value
    * {c}_rolling_{mean,max,std}: over the last ``window`` rows, only when
      ``window`` rows exist (else 0); std is the sample std.
    """
    present = [c for c in dynamic if c in df.columns]
    df = df.fillna(0, subset=present)
    w = Window.partitionBy(key).orderBy(order)
    frame = w.rowsBetween(-(window - 1), Window.currentRow)
    x = F.col(value)
    prev = F.lag(x).over(w)
    full = F.count(F.lit(1)).over(frame) == window
    cols = {
        "asset_growth_rate": F.coalesce(F.try_divide(x - prev, prev), F.lit(0.0)),
        "asset_mom_change": F.coalesce(x - prev, F.lit(0.0)),
        "asset_cumulative_growth": x - F.first(x).over(
            w.rowsBetween(Window.unboundedPreceding, Window.currentRow)),
    }
    for c in rolling:
        v = F.col(c)
        cols[f"{c}_rolling_mean"] = F.when(full, F.avg(v).over(frame)).otherwise(0.0)
        cols[f"{c}_rolling_max"] = F.when(full, F.max(v).over(frame).cast("double")).otherwise(0.0)
        cols[f"{c}_rolling_std"] = F.when(full, F.stddev_samp(v).over(frame)).otherwise(0.0)
    return df.withColumns(cols)


def add_forward_label(df: DataFrame, key: str = "customer_id", order: str = "stat_month",
                      value: str = "total_assets", horizon: int = 3,
                      threshold: float = 1_000_000.0, mode: str = "at",
                      future_col: str = "future_3m_assets",
                      label_col: str = "target_high_value",
                      drop_unlabelled: bool = True) -> DataFrame:
    """Value ``horizon`` rows ahead (``mode='at'``, as the
    reference computes it) or the max over the next ``horizon`` rows
    (``mode='max'``, what its column name says); label = future >=
    threshold; rows without a full horizon are dropped."""
    w = Window.partitionBy(key).orderBy(order)
    x = F.col(value)
    if mode == "at":
        fut = F.lead(x, horizon).over(w)
    elif mode == "max":
        ahead = w.rowsBetween(1, horizon)
        fut = F.when(F.lead(x, horizon).over(w).isNotNull(), F.max(x).over(ahead))
    else:
        raise ValueError("mode must be 'at' or 'max'")
    out = df.withColumn(future_col, fut.cast("double")).withColumn(
        label_col, (F.col(future_col) >= F.lit(threshold)).cast("int"))
    return out.where(F.col(future_col).isNotNull()) if drop_unlabelled else out


def feature_matrix(base: DataFrame, behaviour: DataFrame, threshold: float,
                   key: str = "customer_id", order: str = "stat_month",
                   horizon: int = 3, mode: str = "at") -> DataFrame:
    """The reference's feature-engineering stage up to (not including)
    encoding: join -> fills -> window features -> label."""
    df = join_base_behaviour(base, behaviour, key)
    df = add_time_features(df, key, order)
    return add_forward_label(df, key, order, horizon=horizon, threshold=threshold, mode=mode)
