"""Plans for the monthly AUM series: one series per region plus 'ALL'."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.exact import exact_avg_sql
from ..operators import series as ts
from ..sources import bindings as bd
from .registry import plan, rnd, rsql

STEPS = 3
PHI, THETA = 0.5, -0.3


def series(spark, sf):
    b = bd.behaviour(spark, sf)
    base = bd.base(spark, sf).select("customer_id", "city_level")
    by_region = ts.monthly_series(b.join(base, "customer_id"), "stat_month", "total_assets", "city_level",
                                  money_scale=2)
    overall = ts.monthly_series(b, "stat_month", "total_assets", money_scale=2)
    return by_region.unionByName(overall)


SERIES_SQL = f"""
WITH b AS ({bd.BEHAVIOUR_SQL}), base AS ({bd.BASE_SQL})
SELECT base.city_level AS series, CAST(strptime(b.stat_month, '%Y-%m') AS DATE) AS t, {exact_avg_sql('b.total_assets')} AS value
FROM b JOIN base ON b.customer_id = base.customer_id GROUP BY 1, 2
UNION ALL
SELECT 'ALL' AS series, CAST(strptime(stat_month, '%Y-%m') AS DATE) AS t, {exact_avg_sql('total_assets')} AS value
FROM b GROUP BY 2
"""
S = f"({SERIES_SQL})"
W = "OVER (PARTITION BY series ORDER BY t)"


def _month(c="t"):
    return F.date_format(c, "yyyy-MM").alias("month")


@plan("series_monthly_mean", f"SELECT series, strftime(t, '%Y-%m') AS month, {rsql('value', 4)} AS value FROM {S} s",
      "series")
def series_monthly_mean(spark, sf):
    """Mean total assets per month, per region and overall."""
    return series(spark, sf).select(ts.G, _month(), rnd(ts.V, 4).alias("value"))


@plan("series_growth", f"""
SELECT series, strftime(t, '%Y-%m') AS month,
       {rsql(f'(value - lag(value) {W}) / lag(value) {W} * 100.0', 6)} AS growth_pct
FROM {S} s""", "series")
def series_growth(spark, sf):
    """Month-over-month growth in percent."""
    g = ts.growth(series(spark, sf))
    return g.select(ts.G, _month(), rnd("growth_pct", 6).alias("growth_pct"))


@plan("series_summary", f"""
WITH g AS (SELECT *, (value - lag(value) {W}) / lag(value) {W} * 100.0 AS gp FROM {S} s)
SELECT series, CAST(count(*) AS BIGINT) AS n, strftime(min(t), '%Y-%m') AS first_month,
       strftime(max(t), '%Y-%m') AS last_month, {rsql('avg(value)', 4)} AS mean_value,
       {rsql('max(value)', 4)} AS max_value, {rsql('min(value)', 4)} AS min_value,
       {rsql('avg(gp)', 6)} AS mean_growth_pct, {rsql('max(gp)', 6)} AS max_growth_pct,
       {rsql('min(gp)', 6)} AS min_growth_pct
FROM g GROUP BY series""", "series")
def series_summary(spark, sf):
    """Size, range, level and growth statistics per series."""
    s = ts.summary(series(spark, sf))
    return s.select(ts.G, "n", "first_month", "last_month",
                    *[rnd(c, 4).alias(c) for c in ("mean_value", "max_value", "min_value")],
                    *[rnd(c, 6).alias(c) for c in ("mean_growth_pct", "max_growth_pct", "min_growth_pct")])


@plan("series_diff2", f"""
WITH d1 AS (SELECT series, t, value - lag(value) {W} AS d FROM {S} s),
d2 AS (SELECT series, t, d - lag(d) {W} AS d FROM d1)
SELECT series, strftime(t, '%Y-%m') AS month, {rsql('d', 4)} AS diff FROM d2 WHERE d IS NOT NULL""", "series")
def series_diff2(spark, sf):
    """Second-order differences, leading NULLs dropped."""
    d = ts.difference(series(spark, sf), 2)
    return d.select(ts.G, _month(), rnd("diff", 4).alias("diff"))


AR_PARAMS_SQL = f"""
WITH d AS (SELECT series, t, value, value - lag(value) {W} AS d FROM {S} s),
dd AS (SELECT *, lag(d) {W} AS dp FROM d)
SELECT series, avg(d) AS ma, corr(dp, d) AS ar, arg_max(value, t) AS last_value,
       arg_max(d, t) AS last_diff, max(t) AS last_t
FROM dd GROUP BY series
"""

AR_FORECAST_SQL = f"""
WITH RECURSIVE p AS ({AR_PARAMS_SQL}),
f(series, step, v, d) AS (
  SELECT series, 0, last_value, last_diff FROM p
  UNION ALL
  SELECT f.series, f.step + 1, f.v + (p.ar * f.d + p.ma), p.ar * f.d + p.ma
  FROM f JOIN p ON f.series = p.series WHERE f.step < {STEPS}
)
SELECT f.series, CAST(f.step AS INTEGER) AS step,
       strftime(last_day(p.last_t + to_months(f.step)), '%Y-%m-%d') AS t,
       f.v AS forecast, p.last_value
FROM f JOIN p ON f.series = p.series WHERE f.step >= 1
"""


@plan("ar_forecast", f"SELECT series, step, t, {rsql('forecast', 2)} AS forecast FROM ({AR_FORECAST_SQL}) f",
      "series")
def ar_forecast(spark, sf):
    """Z2 + F4: simplified AR forecast, three month-end steps ahead."""
    f = ts.ar_forecast(ts.ar_params(series(spark, sf)), STEPS)
    return f.select(ts.G, F.col("step").cast("int").alias("step"), F.date_format("t", "yyyy-MM-dd").alias("t"),
                    rnd("forecast", 2).alias("forecast"))


@plan("month_end_calendar", f"""
WITH p AS (SELECT series, max(t) AS last_t FROM {S} s GROUP BY series)
SELECT series, CAST(h AS INTEGER) AS step, strftime(last_day(last_t + to_months(h)), '%Y-%m-%d') AS t
FROM p, range(1, {STEPS + 1}) r(h)""", "series")
def month_end_calendar(spark, sf):
    """next three month-end dates after each series' last month."""
    p = series(spark, sf).groupBy(ts.G).agg(F.max(ts.T).alias("last_t"))
    z = p.select(ts.G, F.arrays_zip(F.sequence(F.lit(1), F.lit(STEPS)).alias("step"),
                                    ts.month_ends(F.col("last_t"), STEPS).alias("t")).alias("z"))
    return z.select(ts.G, F.inline("z")).select(ts.G, F.col("step").cast("int").alias("step"),
                                                 F.date_format("t", "yyyy-MM-dd").alias("t"))


@plan("forecast_growth", f"""
WITH f AS ({AR_FORECAST_SQL}),
g AS (SELECT *, coalesce(lag(forecast) OVER (PARTITION BY series ORDER BY step), last_value) AS prev,
             arg_max(forecast, step) OVER (PARTITION BY series) AS last_fc FROM f)
SELECT series, step, {rsql('forecast - prev', 2)} AS change, {rsql('(forecast - prev) / prev * 100.0', 6)} AS change_pct,
       {rsql('last_fc - last_value', 2)} AS total_change,
       {rsql('(last_fc - last_value) / last_value * 100.0', 6)} AS total_change_pct
FROM g""", "series")
def forecast_growth(spark, sf):
    """Step-over-step growth of the forecast and total growth."""
    g = ts.forecast_growth(ts.ar_forecast(ts.ar_params(series(spark, sf)), STEPS))
    return g.select(ts.G, F.col("step").cast("int").alias("step"), rnd("change", 2).alias("change"),
                    rnd("change_pct", 6).alias("change_pct"), rnd("total_change", 2).alias("total_change"),
                    rnd("total_change_pct", 6).alias("total_change_pct"))


HOLDOUT_SQL = f"""
WITH RECURSIVE r AS (SELECT *, row_number() OVER (PARTITION BY series ORDER BY t DESC) AS rn FROM {S} s),
train AS (SELECT series, t, value FROM r WHERE rn > {STEPS}),
test AS (SELECT series, t, value, row_number() OVER (PARTITION BY series ORDER BY t) AS step FROM r WHERE rn <= {STEPS}),
d AS (SELECT series, t, value, value - lag(value) {W} AS d FROM train),
dd AS (SELECT *, lag(d) {W} AS dp FROM d),
p AS (SELECT series, avg(d) AS ma, corr(dp, d) AS ar, arg_max(value, t) AS last_value, arg_max(d, t) AS last_diff
      FROM dd GROUP BY series),
f(series, step, v, d) AS (
  SELECT series, 0, last_value, last_diff FROM p
  UNION ALL
  SELECT f.series, f.step + 1, f.v + (p.ar * f.d + p.ma), p.ar * f.d + p.ma
  FROM f JOIN p ON f.series = p.series WHERE f.step < {STEPS}),
j AS (SELECT test.series, test.step, test.value AS actual, f.v AS forecast
      FROM test JOIN f ON test.series = f.series AND test.step = f.step)
SELECT series, CAST(step AS INTEGER) AS step, {rsql('actual', 2)} AS actual, {rsql('forecast', 2)} AS forecast,
       {rsql('abs(actual - forecast)', 2)} AS abs_error,
       {rsql('sqrt(avg((actual - forecast) * (actual - forecast)) OVER (PARTITION BY series))', 2)} AS rmse
FROM j
"""


@plan("ar_holdout_rmse", HOLDOUT_SQL, "series")
def ar_holdout_rmse(spark, sf):
    """Z8 + V6: hold out the last three months, forecast them, errors and RMSE."""
    h = ts.ar_holdout(series(spark, sf), STEPS)
    return h.select(ts.G, F.col("step").cast("int").alias("step"), rnd("actual", 2).alias("actual"),
                    rnd("forecast", 2).alias("forecast"), rnd("abs_error", 2).alias("abs_error"),
                    rnd("rmse", 2).alias("rmse"))


DF_SQL = f"""
WITH d AS (SELECT series, value - lag(value) {W} AS dy, lag(value) {W} AS x1 FROM {S} s),
a AS (SELECT series, regr_count(dy, x1) AS nobs, regr_slope(dy, x1) AS slope, regr_sxx(dy, x1) AS sxx,
             regr_sxy(dy, x1) AS sxy, regr_syy(dy, x1) AS syy FROM d WHERE dy IS NOT NULL GROUP BY series),
t AS (SELECT series, nobs, slope, slope / sqrt((syy - sxy * sxy / sxx) / (nobs - 2) / sxx) AS stat,
             """ + ", ".join(
    f"{b0} + {b1} * (1.0 / nobs) + {b2} * (1.0 / nobs) * (1.0 / nobs) + {b3} * (1.0 / nobs) * (1.0 / nobs) * (1.0 / nobs) AS c{k.rstrip('%')}"
    for k, (b0, b1, b2, b3) in ts.DF_CRIT_C.items()) + f""" FROM a)
SELECT series, CAST(nobs AS BIGINT) AS nobs, {rsql('stat', 6)} AS adf_stat, {rsql('c1', 6)} AS crit_1pct,
       {rsql('c5', 6)} AS crit_5pct, {rsql('c10', 6)} AS crit_10pct, stat < c5 AS stationary
FROM t"""


@plan("dickey_fuller", DF_SQL, "series")
def dickey_fuller(spark, sf):
    """Z3 (no lag augmentation): statistic, MacKinnon critical values, verdict."""
    d = ts.dickey_fuller(series(spark, sf))
    return d.select(ts.G, "nobs", rnd("adf_stat", 6).alias("adf_stat"), rnd("crit_1pct", 6).alias("crit_1pct"),
                    rnd("crit_5pct", 6).alias("crit_5pct"), rnd("crit_10pct", 6).alias("crit_10pct"),
                    "stationary")


@plan("difference_if_needed", f"""
WITH v AS (SELECT series, stationary FROM ({DF_SQL}) x),
s AS (SELECT s.*, value - lag(value) {W} AS d FROM {S} s)
SELECT s.series, strftime(t, '%Y-%m') AS month, {rsql('CASE WHEN v.stationary THEN value ELSE d END', 4)} AS value,
       CASE WHEN v.stationary THEN 0 ELSE 1 END AS d_order
FROM s JOIN v ON s.series = v.series WHERE v.stationary OR d IS NOT NULL""", "series")
def difference_if_needed(spark, sf):
    """Difference only the series judged non-stationary."""
    s = series(spark, sf)
    out = ts.difference_if_needed(s, ts.dickey_fuller(s))
    return out.select(ts.G, _month(), rnd(ts.V, 4).alias("value"), F.col("d_order").cast("int").alias("d_order"))


@plan("acf", f"""
WITH s AS (SELECT series, row_number() OVER (PARTITION BY series ORDER BY t) AS i,
                  value - avg(value) OVER (PARTITION BY series) AS dev FROM {S} s),
n AS (SELECT series, count(*) AS n, sum(dev * dev) AS den FROM s GROUP BY series),
p AS (SELECT a.series, k, sum(a.dev * b.dev) AS num
      FROM s a, range(0, 21) r(k), s b WHERE b.series = a.series AND a.i = b.i + k GROUP BY a.series, k)
SELECT p.series, CAST(k AS INTEGER) AS lag, {rsql('num / den', 8)} AS acf
FROM p JOIN n ON p.series = n.series WHERE k <= n - 1""", "series")
def acf(spark, sf):
    """Autocorrelations up to lag 20."""
    a = ts.acf(series(spark, sf), 20)
    return a.select(ts.G, "lag", rnd("acf", 8).alias("acf"))


@plan("pacf", None, "series")
def pacf(spark, sf):
    """Partial autocorrelations (Durbin-Levinson on the ACF)."""
    return ts.pacf(series(spark, sf), 20).select(ts.G, "lag", rnd("pacf", 8).alias("pacf"))


@plan("adf_test", None, "series")
def adf_test(spark, sf):
    """Z3 augmented: AIC lag search, statistic, p-value, verdict p <= 0.05."""
    return ts.adf_test(series(spark, sf))


CSS_SQL = f"""
WITH RECURSIVE d0 AS (SELECT series, t, value - lag(value) {W} AS y FROM {S} s),
d AS (SELECT series, row_number() OVER (PARTITION BY series ORDER BY t) AS i, y FROM d0 WHERE y IS NOT NULL),
r(series, i, e, s) AS (
  SELECT series, 1, CAST(0.0 AS DOUBLE), CAST(0.0 AS DOUBLE) FROM d WHERE i = 1
  UNION ALL
  SELECT d.series, d.i, d.y - {PHI} * dp.y - ({THETA}) * r.e, r.s + (d.y - {PHI} * dp.y - ({THETA}) * r.e) * (d.y - {PHI} * dp.y - ({THETA}) * r.e)
  FROM r JOIN d ON d.series = r.series AND d.i = r.i + 1 JOIN d dp ON dp.series = r.series AND dp.i = r.i),
m AS (SELECT series, max(i) AS n FROM d GROUP BY series)
SELECT r.series, {rsql('r.s', 2)} AS css, {rsql('r.e', 4)} AS last_resid, CAST(m.n AS BIGINT) AS n_diff
FROM r JOIN m ON r.series = m.series AND r.i = m.n
"""


@plan("arima_css_fixed", CSS_SQL, "series")
def arima_css_fixed(spark, sf):
    """Z7 objective: ARMA(1,1) conditional sum of squares at fixed (phi, theta)."""
    c = ts.arima_css_fixed(series(spark, sf), PHI, THETA)
    return c.select(ts.G, rnd("css", 2).alias("css"), rnd("last_resid", 4).alias("last_resid"), "n_diff")


# One exact recursion per series at fixed parameters: prediction, its variance
# over sigma2, the shock e / r, and the running sums of e^2 / r and ln r.
KALMAN_SQL = f"""
d0 AS (SELECT series, t, value, value - lag(value) {W} AS y FROM {S} s),
d AS (SELECT series, t, value, row_number() OVER (PARTITION BY series ORDER BY t) AS i, y FROM d0 WHERE y IS NOT NULL),
k(series, i, r, gain, hat, s, l) AS (
  SELECT series, i, R0, y / R0, {PHI} * y + ({THETA}) * y / R0, y * y / R0, ln(R0) FROM d WHERE i = 1
  UNION ALL
  SELECT series, i, r, e / r, {PHI} * y + ({THETA}) * e / r, s + e * e / r, l + ln(r)
  FROM (SELECT d.series, d.i, d.y, d.y - k.hat AS e, 1.0 + ({THETA}) * ({THETA}) - ({THETA}) * ({THETA}) / k.r AS r, k.s, k.l
        FROM k JOIN d ON d.series = k.series AND d.i = k.i + 1) step)
""".replace("R0", f"CAST((1.0 + 2.0 * {PHI} * ({THETA}) + ({THETA}) * ({THETA})) / (1.0 - {PHI} * {PHI}) AS DOUBLE)")


@plan("arima_likelihood_fixed", f"""
WITH RECURSIVE {KALMAN_SQL},
m AS (SELECT series, max(i) AS n FROM d GROUP BY series)
SELECT m.series, CAST(m.n AS BIGINT) AS n_diff, {rsql('-0.5 * (n * ln(2.0 * pi()) + n * ln(s / n) + l + n)', 6)} AS loglik,
       {rsql('s / n', 2)} AS sigma2, {rsql('hat', 4)} AS next_diff
FROM k JOIN m ON m.series = k.series AND m.n = k.i
""", "series")
def arima_likelihood_fixed(spark, sf):
    """Z7 objective: exact ARIMA(1,1,1) log-likelihood at fixed (phi, theta)."""
    f = ts.arima_likelihood_fixed(series(spark, sf), PHI, THETA)
    return f.select(ts.G, "n_diff", rnd("loglik", 6).alias("loglik"), rnd("sigma2", 2).alias("sigma2"), rnd("next_diff", 4).alias("next_diff"))


@plan("arima_fit", None, "series")
def arima_fit(spark, sf):
    """ARIMA(1,1,1) by exact likelihood."""
    f = ts.arima_fit(series(spark, sf))
    return f.select(ts.G, "phi", "theta", "css", "sigma2", "loglik", "n_diff")


@plan("arima_forecast", None, "series")
def arima_forecast(spark, sf):
    """Three-step ARIMA(1,1,1) forecast at month ends."""
    f = ts.arima_forecast(ts.arima_fit(series(spark, sf)), STEPS)
    return f.select(ts.G, F.col("step").cast("int").alias("step"), F.date_format("t", "yyyy-MM-dd").alias("t"),
                    rnd("forecast", 2).alias("forecast"))


ORIGINS = 3


def _holdout_columns(h):
    return h.select(ts.G, F.col("origin").cast("int").alias("origin"), F.col("step").cast("int").alias("step"), _month(),
                    rnd("actual", 2).alias("actual"), rnd("forecast", 2).alias("forecast"), rnd("abs_error", 2).alias("abs_error"),
                    rnd("rmse", 2).alias("rmse"))


@plan("arima_holdout_fixed", f"""
WITH RECURSIVE {KALMAN_SQL},
x AS (SELECT series, t, value, row_number() OVER (PARTITION BY series ORDER BY t) AS i, count(*) OVER (PARTITION BY series) AS n FROM {S} s),
o AS (SELECT x.series, back AS origin, x.n - {STEPS} - back AS last, x.value AS last_value
      FROM x, range(0, {ORIGINS}) r(back) WHERE x.i = x.n - {STEPS} - back),
f AS (SELECT o.series, o.origin, o.last, h AS step, o.last_value + k.hat * (1.0 - pow({PHI}, h)) / (1.0 - {PHI}) AS forecast
      FROM o JOIN k ON k.series = o.series AND k.i = o.last - 1, range(1, {STEPS + 1}) r(h)),
j AS (SELECT f.*, x.t, x.value AS actual FROM f JOIN x ON x.series = f.series AND x.i = f.last + f.step)
SELECT series, CAST(origin AS INTEGER) AS origin, CAST(step AS INTEGER) AS step, strftime(t, '%Y-%m') AS month,
       {rsql('actual', 2)} AS actual, {rsql('forecast', 2)} AS forecast, {rsql('abs(actual - forecast)', 2)} AS abs_error,
       {rsql('sqrt(avg((actual - forecast) * (actual - forecast)) OVER (PARTITION BY series, origin))', 2)} AS rmse
FROM j""", "series")
def arima_holdout_fixed(spark, sf):
    """Z8 + V6: rolling-origin hold-out of ARIMA(1,1,1) at fixed (phi, theta)."""
    return _holdout_columns(ts.arima_holdout(series(spark, sf), STEPS, ORIGINS, fixed=(PHI, THETA)))


@plan("arima_holdout", None, "series")
def arima_holdout(spark, sf):
    """Z8 + V6: rolling-origin hold-out, the model refitted at every origin."""
    return _holdout_columns(ts.arima_holdout(series(spark, sf), STEPS, ORIGINS))
