"""Order-independent money aggregates.

Floating-point sums depend on the order rows meet, which differs
between partitionings (and engines).  Amounts with a fixed number of
decimals are summed as DECIMAL — exact and associative — and converted
to double once, so results are identical whatever the partitioning.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def exact_sum(col, scale: int = 2) -> Column:
    return F.sum(_c(col).cast(f"decimal(38,{scale})")).cast("double")


def exact_avg(col, scale: int = 2) -> Column:
    c = _c(col)
    return exact_sum(c, scale) / F.count(c)


def exact_sum_sql(expr: str, scale: int = 2) -> str:
    return f"CAST(sum(CAST({expr} AS DECIMAL(38,{scale}))) AS DOUBLE)"


def exact_avg_sql(expr: str, scale: int = 2) -> str:
    return f"({exact_sum_sql(expr, scale)} / count({expr}))"


def safe_corr(x, y) -> Column:
    """Pearson correlation that is NULL (not an ANSI error) when either
    side has zero variance."""
    a, b = _c(x).cast("double"), _c(y).cast("double")
    both = a.isNotNull() & b.isNotNull()
    a, b = F.when(both, a), F.when(both, b)
    return F.try_divide(F.covar_pop(a, b), F.stddev_pop(a) * F.stddev_pop(b))
