"""Grouped monthly time series.

A series is a DataFrame ``(group, t, value)``; every operator handles all
groups at once.  Per-group windows are partitioned by the group key and
hold one row per period, so a task's share is bounded by the series
length, never by the raw data behind it (the series itself is an
aggregate, built with map-side partial aggregation).

Recursions (AR forecasts, ARMA residuals) run inside one row per group
with the ``aggregate`` higher-order function; model grids are literal
arrays evaluated with ``transform`` — no joins against parameter tables.
Only the augmented Dickey–Fuller lag search and the PACF use Python
(grouped ``applyInPandas`` over one small series per group).
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.exact import safe_corr

G, T, V = "series", "t", "value"


def monthly_series(df: DataFrame, month: str, value: str, group: str | None = None,
                   all_label: str = "ALL", how: str = "avg", money_scale: int | None = None) -> DataFrame:
    """Mean (or sum) of ``value`` per (group, month); ``month`` is a
    'yyyy-MM' string, turned into the first day of the month (F1).
    ``money_scale``: amounts with that many decimals are summed exactly."""
    from ..functions.exact import exact_avg, exact_sum
    if money_scale is not None:
        fn = {"avg": lambda c: exact_avg(c, money_scale), "sum": lambda c: exact_sum(c, money_scale)}[how]
    else:
        fn = {"avg": F.avg, "sum": F.sum}[how]
    g = F.col(group).cast("string") if group else F.lit(all_label)
    return (df.where(F.col(month).isNotNull())
            .groupBy(g.alias(G), F.to_date(F.col(month), "yyyy-MM").alias(T))
            .agg(fn(value).cast("double").alias(V)))


def _w(group: str = G, t: str = T):
    return Window.partitionBy(group).orderBy(t)


def growth(series: DataFrame, pct: bool = True) -> DataFrame:
    """Period-over-period change, ×100 when ``pct``."""
    prev = F.lag(V).over(_w())
    g = F.try_divide(F.col(V) - prev, prev)
    return series.withColumn("growth_pct", g * 100.0 if pct else g)


def difference(series: DataFrame, order: int = 1, col: str = V, out: str = "diff") -> DataFrame:
    """``order``-th difference, leading NULLs dropped."""
    w = _w()
    expr = F.col(col)
    cur = series
    for i in range(order):
        cur = cur.withColumn(f"__d{i}", expr - F.lag(expr).over(w))
        expr = F.col(f"__d{i}")
    cur = cur.withColumn(out, expr).where(F.col(out).isNotNull())
    return cur.drop(*[f"__d{i}" for i in range(order)])


def summary(series: DataFrame) -> DataFrame:
    """N, first/last period, mean/max/min level and
    mean/max/min percentage growth per group."""
    g = growth(series)
    return g.groupBy(G).agg(
        F.count(F.lit(1)).cast("long").alias("n"),
        F.date_format(F.min(T), "yyyy-MM").alias("first_month"),
        F.date_format(F.max(T), "yyyy-MM").alias("last_month"),
        F.avg(V).alias("mean_value"), F.max(V).alias("max_value"), F.min(V).alias("min_value"),
        F.avg("growth_pct").alias("mean_growth_pct"), F.max("growth_pct").alias("max_growth_pct"),
        F.min("growth_pct").alias("min_growth_pct"))


def ar_params(series: DataFrame) -> DataFrame:
    """Z2 fit: ma = mean(first differences), ar = corr(d[t-1], d[t]),
    plus the last level, last difference and last period per group."""
    w = _w()
    d = series.withColumn("d", F.col(V) - F.lag(V).over(w))
    d = d.withColumn("dp", F.lag("d").over(w))
    return d.groupBy(G).agg(
        F.avg("d").alias("ma"), safe_corr("dp", "d").alias("ar"),
        F.max_by(V, T).alias("last_value"), F.max_by("d", T).alias("last_diff"),
        F.max(T).alias("last_t"), F.count(F.lit(1)).cast("long").alias("n"))


def month_ends(last_t: Column, steps: int) -> Column:
    """the next ``steps`` month-end dates after the month of ``last_t``."""
    return F.transform(F.sequence(F.lit(1), F.lit(steps)),
                       lambda h: F.last_day(F.add_months(last_t, h)))


def ar_forecast(params: DataFrame, steps: int = 3) -> DataFrame:
    """Z2 forecast: next_diff = ar * last_diff + ma; next = last + next_diff,
    iterated ``steps`` times (an ``aggregate`` over 1..steps per group)."""
    init = F.struct(F.col("last_value").alias("v"), F.col("last_diff").alias("d"),
                    F.array().cast("array<double>").alias("out"))

    def step(acc, _h):
        nd = F.col("ar") * acc["d"] + F.col("ma")
        nv = acc["v"] + nd
        return F.struct(nv.alias("v"), nd.alias("d"), F.array_append(acc["out"], nv).alias("out"))

    fc = F.aggregate(F.sequence(F.lit(1), F.lit(steps)), init, step, lambda acc: acc["out"])
    z = params.select(G, "last_value", F.arrays_zip(
        F.sequence(F.lit(1), F.lit(steps)).alias("step"), month_ends(F.col("last_t"), steps).alias("t"),
        fc.alias("forecast")).alias("z"))
    return z.select(G, "last_value", F.inline("z"))


def forecast_growth(forecast: DataFrame) -> DataFrame:
    """Change of each step vs the previous value (the first step vs
    the last actual), percentage, and the total change over the horizon."""
    w = Window.partitionBy(G).orderBy("step")
    prev = F.lag("forecast", 1).over(w)
    prev = F.coalesce(prev, F.col("last_value"))
    wall = Window.partitionBy(G)
    return forecast.select(
        G, "step", "t", "forecast", (F.col("forecast") - prev).alias("change"),
        (F.try_divide(F.col("forecast") - prev, prev) * 100.0).alias("change_pct"),
        (F.max_by("forecast", "step").over(wall) - F.col("last_value")).alias("total_change"),
        (F.try_divide(F.max_by("forecast", "step").over(wall) - F.col("last_value"), F.col("last_value")) * 100.0)
        .alias("total_change_pct"))


def holdout(series: DataFrame, test_size: int = 3) -> tuple[DataFrame, DataFrame]:
    """Z8 split: the last ``test_size`` periods of every group are held out."""
    r = series.withColumn("__r", F.row_number().over(Window.partitionBy(G).orderBy(F.col(T).desc())))
    return (r.where(F.col("__r") > test_size).drop("__r"), r.where(F.col("__r") <= test_size).drop("__r"))


def ar_holdout(series: DataFrame, test_size: int = 3) -> DataFrame:
    """Z8 + V6 with the Z2 model: refit without the last ``test_size``
    periods, forecast them, per-step absolute error and per-group RMSE."""
    train, test = holdout(series, test_size)
    fc = ar_forecast(ar_params(train), test_size)
    tw = Window.partitionBy(G).orderBy(T)
    test = test.withColumn("step", F.row_number().over(tw)).select(G, "step", F.col(T).alias("actual_t"),
                                                                     F.col(V).alias("actual"))
    j = fc.join(test, [G, "step"])
    j = j.withColumn("abs_error", F.abs(F.col("actual") - F.col("forecast")))
    wall = Window.partitionBy(G)
    return j.withColumn("rmse", F.sqrt(F.avg(F.pow(F.col("actual") - F.col("forecast"), 2)).over(wall)))


# ------------------------------------------------------------ Dickey-Fuller

# MacKinnon (2010) response-surface coefficients of the
# Dickey-Fuller critical values, constant-only regression, one variable:
# crit = b0 + b1/T + b2/T^2 + b3/T^3 for 1 %, 5 % and 10 %.
DF_CRIT_C = {
    "1%": (-3.43035, -6.5393, -16.786, -79.433),
    "5%": (-2.86154, -2.8903, -4.234, -40.040),
    "10%": (-2.56677, -1.5384, -2.809, 0.0),
}
# MacKinnon (1994) approximate p-value surface, constant-only
# regression, one variable: bounds, switch point and polynomial coefficients.
DF_P_C = {
    "max": 2.74, "min": -18.83, "star": -1.61,
    "small": (2.1659, 1.4412, 0.038269),
    "large": (1.7339, 0.93202, -0.12745, -0.010368),
}


def df_critical(nobs: Column, level: str) -> Column:
    b0, b1, b2, b3 = DF_CRIT_C[level]
    inv = F.lit(1.0) / nobs
    return F.lit(b0) + F.lit(b1) * inv + F.lit(b2) * inv * inv + F.lit(b3) * inv * inv * inv


def df_pvalue(stat: float) -> float:
    """MacKinnon approximate p-value of a Dickey-Fuller statistic."""
    if stat is None or math.isnan(stat):
        return float("nan")
    if stat > DF_P_C["max"]:
        return 1.0
    if stat < DF_P_C["min"]:
        return 0.0
    coef = DF_P_C["small"] if stat <= DF_P_C["star"] else DF_P_C["large"]
    z = sum(c * stat ** i for i, c in enumerate(coef))
    return 0.5 * (1.0 + math.erf(z / math.sqrt(2.0)))


def dickey_fuller(series: DataFrame, col: str = V) -> DataFrame:
    """Z3 without lag augmentation, fully in SQL aggregates: regress
    Δx_t on (1, x_{t-1}); statistic = slope / se(slope); MacKinnon
    critical values for the number of regression observations; verdict
    'stationary' when the statistic is below the 5 % critical value."""
    w = _w()
    d = series.select(G, (F.col(col) - F.lag(col).over(w)).alias("dy"), F.lag(col).over(w).alias("x1"))
    d = d.where(F.col("dy").isNotNull())
    a = d.groupBy(G).agg(F.regr_count("dy", "x1").alias("nobs"), F.regr_slope("dy", "x1").alias("slope"),
                         F.regr_sxx("dy", "x1").alias("sxx"), F.regr_sxy("dy", "x1").alias("sxy"),
                         F.regr_syy("dy", "x1").alias("syy"))
    ssr = F.col("syy") - F.try_divide(F.col("sxy") * F.col("sxy"), F.col("sxx"))
    se = F.sqrt(F.try_divide(F.try_divide(ssr, F.col("nobs") - 2), F.col("sxx")))
    out = a.select(G, F.col("nobs").cast("long").alias("nobs"), F.col("slope"),
                   F.try_divide(F.col("slope"), se).alias("adf_stat"))
    out = out.withColumns({f"crit_{k.rstrip('%')}pct": df_critical(F.col("nobs").cast("double"), k)
                           for k in DF_CRIT_C})
    return out.withColumn("stationary", F.col("adf_stat") < F.col("crit_5pct"))


def _ols(y: np.ndarray, X: np.ndarray):
    beta, *_ = np.linalg.lstsq(X, y, rcond=None)
    resid = y - X @ beta
    ssr = float(resid @ resid)
    n, k = X.shape
    return beta, resid, ssr, n, k


def _adf_one(x: np.ndarray, maxlag: int | None, autolag: str | None):
    """Augmented Dickey-Fuller with constant; lag chosen by AIC over
    0..maxlag on a common sample, then refit on the longest sample."""
    x = np.asarray(x, dtype=float)
    nobs = len(x)
    if nobs < 4 or not np.isfinite(x).all() or np.ptp(x) == 0:
        return None, None, max(0, nobs - 1)   # too short or constant: no regression
    if maxlag is None:
        maxlag = int(math.ceil(12.0 * (nobs / 100.0) ** 0.25))
        maxlag = max(0, min(nobs // 2 - 2, maxlag))
    dx = np.diff(x)

    def design(lags):
        rows = len(dx) - lags
        cols = [x[lags:lags + rows]]  # x_{t-1}
        for j in range(1, lags + 1):
            cols.append(dx[lags - j:lags - j + rows])
        cols.append(np.ones(rows))
        return dx[lags:], np.column_stack(cols)

    if autolag:
        # common sample: the one of maxlag
        y_all, X_all = design(maxlag)
        best, best_ic = 0, np.inf
        for lags in range(0, maxlag + 1):
            X = np.column_stack([X_all[:, :1 + lags], X_all[:, -1]])
            _, _, ssr, n, k = _ols(y_all, X)
            if ssr <= 0 or n <= k:
                continue
            llf = -n / 2.0 * (math.log(2 * math.pi) + math.log(ssr / n) + 1)
            ic = -2 * llf + 2 * k
            if ic < best_ic - 1e-12:
                best, best_ic = lags, ic
        lags = best
    else:
        lags = maxlag
    y, X = design(lags)
    beta, _, ssr, n, k = _ols(y, X)
    if n <= k or ssr <= 0 or np.linalg.matrix_rank(X) < k:
        return None, lags, n
    sigma2 = ssr / (n - k)
    cov = sigma2 * np.linalg.inv(X.T @ X)
    stat = float(beta[0] / math.sqrt(cov[0, 0]))
    return stat, lags, n


def adf_test(series: DataFrame, maxlag: int | None = None, autolag: str | None = "AIC",
             col: str = V) -> DataFrame:
    """Z3 augmented: per group, lag order by AIC (or fixed ``maxlag``),
    statistic, MacKinnon p-value and critical values; verdict p <= 0.05.
    One grouped pandas call per series (bounded by its length)."""
    schema = ("series string, adf_stat double, pvalue double, used_lag long, nobs long, "
              "crit_1pct double, crit_5pct double, crit_10pct double, stationary boolean")

    def fn(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(T)
        stat, lags, n = _adf_one(pdf[col].to_numpy(), maxlag, autolag)
        p = None if stat is None else df_pvalue(stat)
        crit = {k: sum(c / n ** i for i, c in enumerate(v)) if n else None for k, v in DF_CRIT_C.items()}
        return pd.DataFrame([{G: str(pdf[G].iloc[0]), "adf_stat": stat, "pvalue": p, "used_lag": lags,
                              "nobs": n, "crit_1pct": crit["1%"], "crit_5pct": crit["5%"],
                              "crit_10pct": crit["10%"], "stationary": None if p is None else bool(p <= 0.05)}]).astype({"used_lag": "Int64"})

    from ..session import ship_package
    ship_package(series.sparkSession)
    return series.select(G, T, col).groupBy(G).applyInPandas(fn, schema)


def difference_if_needed(series: DataFrame, verdicts: DataFrame) -> DataFrame:
    """First-difference only the groups judged non-stationary."""
    d = difference(series, 1)
    ns = verdicts.where(~F.col("stationary")).select(G)
    st = verdicts.where(F.col("stationary")).select(G)
    return (series.join(st, G, "left_semi").select(G, T, V, F.lit(0).alias("d_order"))
            .unionByName(d.join(ns, G, "left_semi").select(G, T, F.col("diff").alias(V),
                                                            F.lit(1).alias("d_order"))))


# ---------------------------------------------------------------- ACF/PACF

def acf(series: DataFrame, nlags: int = 20, col: str = V) -> DataFrame:
    """r_k = Σ (x_t - m)(x_{t-k} - m) / Σ (x_t - m)^2 for k = 0..nlags
    (capped at n - 1 per group).  Each row meets its ``nlags`` lagged
    partners through an equi-join on (group, index + k)."""
    w = _w()
    s = series.select(G, F.row_number().over(w).alias("i"), F.col(col).alias("x"))
    s = s.withColumn("dev", F.col("x") - F.avg("x").over(Window.partitionBy(G)))
    lagged = s.select(F.col(G).alias("__g"), F.col("i").alias("j"), F.col("dev").alias("dev_lag"),
                      F.explode(F.sequence(F.lit(0), F.lit(nlags))).alias("k"))
    lagged = lagged.withColumn("__i", F.col("j") + F.col("k"))
    pairs = s.join(lagged, (F.col(G) == F.col("__g")) & (F.col("i") == F.col("__i"))).select(
        G, "k", (F.col("dev") * F.col("dev_lag")).alias("p"))
    num = pairs.groupBy(G, "k").agg(F.sum("p").alias("num"))
    den = s.groupBy(G).agg(F.sum(F.col("dev") * F.col("dev")).alias("den"),
                           F.count(F.lit(1)).alias("n"))
    return (num.join(den, G).where(F.col("k") <= F.col("n") - 1)
            .select(G, F.col("k").cast("int").alias("lag"), F.try_divide(F.col("num"), F.col("den")).alias("acf")))


def pacf(series: DataFrame, nlags: int = 20, col: str = V) -> DataFrame:
    """Partial autocorrelations by Durbin-Levinson on the sample ACF
    (Yule-Walker, biased autocovariance), lags capped at n // 2 - 1."""
    a = acf(series, nlags, col)
    n = series.groupBy(G).agg(F.count(F.lit(1)).alias("n"))
    a = a.join(n, G)

    def fn(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("lag")
        r = pdf["acf"].to_numpy(dtype=float)
        cap = int(min(len(r) - 1, pdf["n"].iloc[0] // 2 - 1))
        if not np.isfinite(r[:1]).all():      # constant series: no correlation at any lag
            return pd.DataFrame({G: str(pdf[G].iloc[0]), "lag": range(max(0, cap) + 1), "pacf": None}).astype({"pacf": "float64"})
        out = [(0, 1.0)]
        phi_prev = np.array([])
        for k in range(1, cap + 1):
            if k == 1:
                phi_kk = r[1]
                phi = np.array([phi_kk])
            else:
                num = r[k] - np.dot(phi_prev, r[k - 1:0:-1])
                den = 1.0 - np.dot(phi_prev, r[1:k])
                phi_kk = num / den
                phi = np.append(phi_prev - phi_kk * phi_prev[::-1], phi_kk)
            out.append((k, float(phi_kk)))
            phi_prev = phi
        return pd.DataFrame({G: str(pdf[G].iloc[0]), "lag": [o[0] for o in out],
                             "pacf": [o[1] for o in out]})

    from ..session import ship_package
    ship_package(a.sparkSession)
    return a.groupBy(G).applyInPandas(fn, "series string, lag int, pacf double")


# ------------------------------------------------------------------ ARIMA

def _level_arrays(series: DataFrame, col: str = V) -> DataFrame:
    """(series, xs, ts): each group's levels and periods in order (one row per
    group, as long as the series)."""
    rows = series.groupBy(G).agg(F.sort_array(F.collect_list(F.struct(T, F.col(col).alias("x")))).alias("__rows"))
    return rows.select(G, F.transform("__rows", lambda r: r["x"]).alias("xs"), F.transform("__rows", lambda r: r[T]).alias("ts"))


def _diffs(xs: Column) -> Column:
    """First differences of an array."""
    n = F.size(xs)
    idx = F.when(n >= 2, F.sequence(F.lit(2), n)).otherwise(F.array().cast("array<int>"))
    return F.transform(idx, lambda i: F.element_at(xs, i) - F.element_at(xs, i - 1))


def _css(phi: Column, theta: Column, ys: Column) -> Column:
    """Conditional sum of squares of ARMA(1,1) without constant on the
    differenced array ``ys``: e_t = y_t - phi*y_{t-1} - theta*e_{t-1}, e_1 = 0."""
    init = F.struct(F.lit(0.0).alias("e"), F.lit(0.0).alias("s"))
    idx = F.when(F.size(ys) >= 2, F.sequence(F.lit(2), F.size(ys))).otherwise(F.array().cast("array<int>"))

    def step(acc, t):
        e = F.element_at(ys, t) - phi * F.element_at(ys, t - 1) - theta * acc["e"]
        return F.struct(e.alias("e"), (acc["s"] + e * e).alias("s"))

    return F.aggregate(idx, init, step)


def _kalman(phi: Column, theta: Column, ys: Column) -> Column:
    """Exact one-step recursion of ARMA(1,1) started from its stationary
    distribution.  ``r`` is the variance of the prediction error over sigma2,
    ``hat`` the prediction of the next value; ``s`` adds up e^2 / r and ``l``
    adds up ln r, which is all that the likelihood needs."""
    first = (1.0 + 2.0 * phi * theta + theta * theta) / (1.0 - phi * phi)
    init = F.struct(F.lit(0.0).alias("hat"), first.alias("r"), F.lit(0.0).alias("s"), F.lit(0.0).alias("l"),
                    F.lit(0.0).alias("gain"))

    def step(acc, y):
        e = y - acc["hat"]
        gain = e / acc["r"]
        return F.struct((phi * y + theta * gain).alias("hat"), (1.0 + theta * theta - theta * theta / acc["r"]).alias("r"),
                        (acc["s"] + e * gain).alias("s"), (acc["l"] + F.log(acc["r"])).alias("l"), gain.alias("gain"))

    return F.aggregate(ys, init, step)


def _likelihood_score(phi: Column, theta: Column, ys: Column) -> Column:
    """n ln(s / n) + sum ln r: falls as the concentrated likelihood rises."""
    n = F.size(ys)
    return F.transform(F.array(_kalman(phi, theta, ys)), lambda k: n * F.log(F.try_divide(k["s"], n)) + k["l"])[0]


def _search(rows: DataFrame, score, keys: list[str], coarse: int = 25, refine: int = 9, bound: float = 0.99,
            tolerance: float = 1e-6) -> DataFrame:
    """``rows`` with ``best``: (score, phi, theta) of the least score in
    (-bound, bound)^2, found on a coarse grid and then on finer grids around
    the best point until phi and theta are known to ``tolerance``.  Grids are
    generated by sequence / transform, so the expression does not grow with
    them; exchanges (one short row per key) keep the optimizer from inlining
    one search into the next."""
    def grid(c_phi, c_theta, half, n):
        idx = F.sequence(F.lit(0), F.lit(n - 1))
        step = F.lit(2.0 * half / (n - 1))

        def clip(x):
            return F.least(F.greatest(x, F.lit(-bound)), F.lit(bound))

        return F.flatten(F.transform(idx, lambda i: F.transform(idx, lambda j: F.struct(
            clip(c_phi - F.lit(half) + i * step).alias("phi"),
            clip(c_theta - F.lit(half) + j * step).alias("theta")))))

    def best(points):
        return F.array_min(F.transform(points, lambda p: F.struct(
            score(p["phi"], p["theta"], F.col("ys")).alias("score"), p["phi"].alias("phi"), p["theta"].alias("theta"))))

    rows = rows.withColumn("best", best(grid(F.lit(0.0), F.lit(0.0), bound, coarse))).repartition(*keys)
    step = 2 * bound / (coarse - 1)
    while step > tolerance:
        half = 1.5 * step
        rows = rows.withColumnRenamed("best", "__near")
        rows = rows.withColumn("best", best(grid(F.col("__near.phi"), F.col("__near.theta"), half, refine))).drop("__near").repartition(*keys)
        step = 2 * half / (refine - 1)
    return rows


def _fitted(rows: DataFrame, keys: list[str], method: str, **search) -> DataFrame:
    """Parameters and forecast state of every row with ``ys``, ``last_value`` and
    ``last_t``.  Fewer than two differences determine nothing (NULL); differences
    that are all zero have phi = theta = 0."""
    exact = method == "likelihood"
    rows = _search(rows, _likelihood_score if exact else (lambda phi, theta, ys: _css(phi, theta, ys)["s"]), keys, **search)
    n, fits = F.size("ys"), F.size("ys") >= 2
    moves = F.exists("ys", lambda y: y != 0)
    rows = rows.withColumns({"phi": F.when(fits, F.when(moves, F.col("best.phi")).otherwise(0.0)),
                             "theta": F.when(fits, F.when(moves, F.col("best.theta")).otherwise(0.0))}).repartition(*keys)
    phi, theta = F.col("phi"), F.col("theta")
    css, k = F.col("__css"), F.col("__k")
    rows = rows.withColumn("__css", F.when(fits, _css(phi, theta, F.col("ys")))).withColumn("__k", F.when(fits, _kalman(phi, theta, F.col("ys"))))
    sigma2 = F.try_divide(k["s"], n) if exact else F.try_divide(css["s"], n - 1)
    loglik = -0.5 * (n * F.log(F.lit(2.0 * math.pi)) + n * F.log(F.try_divide(k["s"], n)) + k["l"] + n)
    return rows.select(*keys, "phi", "theta", css["s"].alias("css"), sigma2.alias("sigma2"), F.when(moves, loglik).alias("loglik"),
                       F.try_element_at("ys", F.lit(-1)).alias("last_diff"), (k["gain"] if exact else css["e"]).alias("last_resid"),
                       "last_value", "last_t", n.cast("long").alias("n_diff"))


def arima_fit(series: DataFrame, method: str = "likelihood", col: str = V, **search) -> DataFrame:
    """ARIMA(1,1,1) without constant of every group, by exact Gaussian
    likelihood (``likelihood``: Kalman recursion over the differenced array,
    sigma2 concentrated out) or by conditional least squares (``css``).  Returns
    phi, theta, css, sigma2, loglik and the state needed to forecast."""
    rows = _level_arrays(series, col).select(G, _diffs(F.col("xs")).alias("ys"), F.element_at("xs", -1).alias("last_value"),
                                             F.element_at("ts", -1).alias("last_t"))
    return _fitted(rows, [G], method, **search)


def arima_css_fixed(series: DataFrame, phi: float, theta: float, col: str = V) -> DataFrame:
    """Z7 objective at given (phi, theta): CSS and last residual per group."""
    arr = _level_arrays(series, col).select(G, _diffs(F.col("xs")).alias("ys")).where(F.size("ys") > 0)
    st = _css(F.lit(phi), F.lit(theta), F.col("ys"))
    return arr.select(G, st["s"].alias("css"), st["e"].alias("last_resid"),
                      F.size("ys").cast("long").alias("n_diff"))


def arima_likelihood_fixed(series: DataFrame, phi: float, theta: float, col: str = V) -> DataFrame:
    """Z7 likelihood at given (phi, theta): log-likelihood with sigma2
    concentrated out, sigma2, and the forecast of the next difference."""
    arr = _level_arrays(series, col).select(G, _diffs(F.col("xs")).alias("ys")).where(F.size("ys") > 0)
    arr = arr.select(G, F.size("ys").alias("n"), _kalman(F.lit(phi), F.lit(theta), F.col("ys")).alias("k"))
    loglik = -0.5 * (F.col("n") * F.log(F.lit(2.0 * math.pi)) + F.col("n") * F.log(F.col("k.s") / F.col("n")) + F.col("k.l") + F.col("n"))
    return arr.select(G, F.col("n").cast("long").alias("n_diff"), loglik.alias("loglik"), (F.col("k.s") / F.col("n")).alias("sigma2"),
                      F.col("k.hat").alias("next_diff"))


def _level_forecasts(fit: DataFrame, steps: int, keys: list[str]) -> DataFrame:
    """(keys, last_value, last_t, step, forecast): the next difference is
    phi*y_n + theta*e_n, later ones shrink by phi (future shocks are zero), and
    levels add them up: x_n + y1 * (1 - phi^h) / (1 - phi)."""
    y1 = F.col("phi") * F.col("last_diff") + F.col("theta") * F.col("last_resid")
    e = fit.select(*keys, "last_value", "last_t", "phi", y1.alias("y1"), F.explode(F.sequence(F.lit(1), F.lit(steps))).alias("step"))
    total = F.when(F.col("phi") == 1.0, F.col("y1") * F.col("step")).otherwise(
        F.col("y1") * (1.0 - F.pow(F.col("phi"), F.col("step"))) / (1.0 - F.col("phi")))
    return e.select(*keys, "last_value", "last_t", F.col("step").cast("int").alias("step"), (F.col("last_value") + total).alias("forecast"))


def arima_forecast(fit: DataFrame, steps: int = 3) -> DataFrame:
    """Forecasts of the next ``steps`` month ends."""
    return _level_forecasts(fit, steps, [G]).select(
        G, "last_value", "step", F.last_day(F.add_months(F.col("last_t"), F.col("step"))).alias("t"), "forecast")


def arima_holdout(series: DataFrame, steps: int = 3, origins: int = 1, fixed: tuple[float, float] | None = None,
                  method: str = "likelihood", col: str = V, **search) -> DataFrame:
    """Z8 + V6: rolling-origin hold-out of the ARIMA model.  Origin ``k`` trains on
    all but the last ``steps + k`` periods and forecasts the ``steps`` after
    them (origin 0 alone holds out the end of the series); every (series, origin)
    is one row of one plan and is refitted, or takes the ``fixed`` (phi, theta).
    Returns actual, forecast, absolute error per step and the origin's RMSE;
    origins that leave no level to train on are absent."""
    keys = [G, "origin"]
    rows = _level_arrays(series, col).withColumn("origin", F.explode(F.sequence(F.lit(0), F.lit(origins - 1))))
    rows = rows.withColumn("__n", F.size("xs") - steps - F.col("origin")).where("__n >= 1")
    train = rows.select(*keys, F.slice("xs", F.lit(1), F.col("__n")).alias("__train"), F.slice("xs", F.col("__n") + 1, F.lit(steps)).alias("actuals"),
                        F.slice("ts", F.col("__n") + 1, F.lit(steps)).alias("actual_ts"), F.element_at("ts", F.col("__n")).alias("last_t"))
    train = train.withColumn("ys", _diffs(F.col("__train"))).withColumn("last_value", F.element_at("__train", -1)).drop("__train")
    if fixed is None:
        fit = _fitted(train.drop("actuals", "actual_ts"), keys, method, **search)
    else:
        phi, theta = (F.lit(float(v)) for v in fixed)
        fit = train.select(*keys, phi.alias("phi"), F.try_element_at("ys", F.lit(-1)).alias("last_diff"), theta.alias("theta"),
                           _kalman(phi, theta, F.col("ys"))["gain"].alias("last_resid"), "last_value", "last_t")
    held = train.select(*keys, F.posexplode(F.arrays_zip("actuals", "actual_ts")).alias("__at", "__held")).select(
        *keys, (F.col("__at") + 1).alias("step"), F.col("__held.actual_ts").alias("t"), F.col("__held.actuals").alias("actual"))
    j = _level_forecasts(fit, steps, keys).drop("last_value", "last_t").join(held, [*keys, "step"])
    error = F.col("actual") - F.col("forecast")
    return j.select(*keys, "step", "t", "actual", "forecast", F.abs(error).alias("abs_error"),
                    F.sqrt(F.avg(error * error).over(Window.partitionBy(*keys))).alias("rmse"))
