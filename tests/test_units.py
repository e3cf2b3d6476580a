"""Operator unit tests on inline rows: edge cases, golden relations from
the reference's committed outputs, and invariants."""

import datetime as dt
import math

import pytest
from pyspark.ml.evaluation import BinaryClassificationEvaluator, ClusteringEvaluator
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from custlens.operators import baskets as bk
from custlens.operators import bi, encode, explain, features, metrics, models, segment
from custlens.operators import series as ts


# ------------------------------------------------------------------ windows

def test_time_features_edge_cases(spark):
    rows = [(1, "2024-01", 100.0), (1, "2024-02", 0.0), (1, "2024-04", 50.0), (1, "2024-05", 80.0),
            (2, "2024-01", 10.0), (3, "2024-01", 5.0), (3, "2024-02", 7.0)]
    df = spark.createDataFrame(rows, "customer_id long, stat_month string, total_assets double")
    df = df.withColumn("financial_balance", F.col("total_assets")).withColumn("fund_balance", F.lit(1.0))
    out = {(r.customer_id, r.stat_month): r for r in features.add_time_features(df).collect()}
    assert out[(1, "2024-01")].asset_growth_rate == 0.0                     # first row
    assert out[(1, "2024-02")].asset_growth_rate == -1.0
    assert out[(1, "2024-04")].asset_growth_rate == 0.0                     # previous value 0
    assert out[(1, "2024-04")].asset_mom_change == 50.0                     # row-based: gap ignored
    assert out[(1, "2024-05")].asset_cumulative_growth == -20.0
    assert out[(1, "2024-02")].total_assets_rolling_mean == 0.0             # fewer than 3 rows
    r = out[(1, "2024-04")]
    assert r.total_assets_rolling_mean == pytest.approx(50.0)
    assert r.total_assets_rolling_max == 100.0
    assert r.total_assets_rolling_std == pytest.approx(50.0)                # sample std of 100, 0, 50
    assert out[(2, "2024-01")].total_assets_rolling_std == 0.0


def test_forward_label_at_and_max(spark):
    rows = [(1, f"2024-0{i}", v) for i, v in enumerate([1.0, 5.0, 2.0, 3.0, 9.0], start=1)]
    df = spark.createDataFrame(rows, "customer_id long, stat_month string, total_assets double")
    at = features.add_forward_label(df, threshold=3.0).orderBy("stat_month").collect()
    assert [r.future_3m_assets for r in at] == [3.0, 9.0]                   # last 3 rows dropped
    assert [r.target_high_value for r in at] == [1, 1]
    mx = features.add_forward_label(df, threshold=6.0, mode="max").orderBy("stat_month").collect()
    assert [r.future_3m_assets for r in mx] == [5.0, 9.0]


def test_fill_median_over_rows(spark):
    df = spark.createDataFrame([(1, 10.0, None), (2, None, "a"), (3, 30.0, None)], "k int, x double, s string")
    out = {r.k: r for r in features.fill_median(df, ["x"], ["s"], "unknown").collect()}
    assert out[2].x == 20.0 and out[1].s == "unknown"


# ------------------------------------------------------------------ roll-ups

def test_histogram_zero_fill_and_bounds(spark):
    df = spark.createDataFrame([(v,) for v in [5.0, 10.0, 19.999, 20.0, None]], "v double")
    h = {r.bin_label: r["count"] for r in bi.histogram(df, "v", [10, 20, 30], ["a", "b", "c", "d"]).collect()}
    assert h == {"a": 1, "b": 2, "c": 1, "d": 0}


def test_recode_keep_and_null(spark):
    df = spark.createDataFrame([("x",), ("y",)], "c string")
    r = df.select(bi.recode("c", {"x": "X"}, True).alias("k"), bi.recode("c", {"x": "X"}, False).alias("m")).collect()
    assert [(a.k, a.m) for a in r] == [("X", "X"), ("y", None)]


# ------------------------------------------------------------------ metrics

def test_auc_matches_spark_evaluator_with_ties(spark):
    rows = [(i % 2, round((i * 37 % 11) / 10, 1)) for i in range(200)]
    df = spark.createDataFrame(rows, "y int, s double")
    ours = metrics.roc_auc(df, "y", "s", buckets=4).first().roc_auc
    ev = BinaryClassificationEvaluator(rawPredictionCol="s", labelCol="y", numBins=0)
    assert ours == pytest.approx(ev.evaluate(df.withColumn("y", F.col("y").cast("double"))), abs=1e-12)


def test_auc_single_class_is_null(spark):
    df = spark.createDataFrame([(1, 0.3), (1, 0.5)], "y int, s double")
    assert metrics.roc_auc(df, "y", "s").first().roc_auc is None


def test_pr_auc_perfect_ranking(spark):
    df = spark.createDataFrame([(1, 0.9), (1, 0.8), (0, 0.2), (0, 0.1)], "y int, s double")
    assert metrics.pr_auc(df, "y", "s", buckets=2).first().pr_auc == pytest.approx(1.0)


def test_report_zero_denominators(spark):
    df = spark.createDataFrame([(0, 0), (0, 0)], "y int, p int")
    r = {x.class_label: x for x in metrics.classification_report(df, "y", "p").collect()}
    assert r["1"].precision == 0.0 and r["1"].support == 0 and r["accuracy"].precision == 1.0


def test_binarize_boundaries(spark):
    df = spark.createDataFrame([(0.5,), (0.7,)], "s double")
    r = df.select(metrics.binarize("s", 0.5).alias("a"), metrics.binarize("s", 0.7, strict=False).alias("b")).collect()
    assert [(x.a, x.b) for x in r] == [(0, 0), (1, 1)]


# ------------------------------------------------------------------ baskets

def _baskets(spark):
    data = [["a", "b"], ["a", "b", "c"], ["a"], [], ["b", "c"], ["a", "b", "c", "d"], ["c"], ["a", "c"], ["b"], ["a", "b"]]
    return spark.createDataFrame([(i, d) for i, d in enumerate(data)], "id int, items array<string>")


def test_itemsets_apriori_equals_fpgrowth_and_bruteforce(spark):
    b = _baskets(spark)
    ap = {tuple(r.items): r["count"] for r in bk.frequent_itemsets(b, 0.2).collect()}
    lw = {tuple(r.items): r["count"] for r in bk.frequent_itemsets(b, 0.2, max_len=9).collect()}
    fp = {tuple(r.items): r["count"] for r in bk.frequent_itemsets(b, 0.2, method="fpgrowth").collect()}
    assert ap == lw == fp
    # brute force over the 9 non-empty baskets, min count 0.2 * 9 = 1.8
    assert ap[("a", "b")] == 4 and ("a", "d") not in ap and ap[("a",)] == 6


def test_support_exactly_at_threshold_kept(spark):
    b = spark.createDataFrame([(1, ["x"]), (2, ["y"]), (3, ["y"]), (4, ["y"]), (5, ["y"])], "id int, items array<string>")
    fi = {tuple(r.items) for r in bk.frequent_itemsets(b, 0.2).collect()}
    assert ("x",) in fi


def test_rules_multi_item_consequents(spark):
    fi = bk.frequent_itemsets(_baskets(spark), 0.1)
    rules = bk.association_rules(fi, 0.0).collect()
    assert any(len(r.consequents) == 2 for r in rules)
    for r in rules:
        assert r.confidence == pytest.approx(r.support / r.antecedent_support)
        assert r.lift == pytest.approx(r.confidence / r.consequent_support)


def test_flags_to_basket(spark):
    df = spark.createDataFrame([(1, 1, 0, 1), (2, 0, 0, 0)], "k int, f1 int, f2 int, f3 int")
    out = {r.k: r.items for r in bk.flags_to_basket(df, {"f1": "A", "f2": "B", "f3": "C"}, "k").collect()}
    assert out == {1: ["A", "C"], 2: []}


# ------------------------------------------------------------------ series

def test_ar_forecast_golden(spark):
    # reference report: ma = (660114.01 - 521632.68) / 11, forecasts 685117.26, 720748.24, 766173.20
    ma = (660114.01 - 521632.68) / 11
    d1, d2 = 685117.26 - 660114.01, 720748.24 - 685117.26
    ar = (d2 - ma) / d1
    d0 = (d1 - ma) / ar
    p = spark.createDataFrame([("ALL", ma, ar, 660114.01, d0, dt.date(2025, 6, 1))],
                              "series string, ma double, ar double, last_value double, last_diff double, last_t date")
    f = ts.ar_forecast(p, 3).orderBy("step").collect()
    assert [round(r.forecast, 1) for r in f] == pytest.approx([685117.3, 720748.2, 766173.2], abs=0.1)
    assert [r.t for r in f] == [dt.date(2025, 7, 31), dt.date(2025, 8, 31), dt.date(2025, 9, 30)]


def _series(spark, values):
    return spark.createDataFrame([("g", dt.date(2020 + i // 12, i % 12 + 1, 1), float(v)) for i, v in enumerate(values)],
                                 "series string, t date, value double")


def test_constant_series_ar_is_null(spark):
    p = ts.ar_params(_series(spark, [5, 5, 5, 5])).first()
    assert p.ma == 0.0 and p.ar is None


def test_dickey_fuller_and_crit(spark):
    import random
    rnd = random.Random(1)
    walk, x = [], 0.0
    for _ in range(120):
        x += rnd.gauss(0, 1)
        walk.append(x)
    noise = [rnd.gauss(0, 1) for _ in range(120)]
    s = _series(spark, walk).unionByName(_series(spark, noise).withColumn("series", F.lit("n")))
    d = {r.series: r for r in ts.dickey_fuller(s).collect()}
    assert d["n"].stationary and d["n"].adf_stat < -5
    assert d["g"].crit_5pct == pytest.approx(-2.86154 - 2.8903 / 119 - 4.234 / 119 ** 2 - 40.040 / 119 ** 3)
    a = {r.series: r for r in ts.adf_test(s).collect()}
    assert a["n"].pvalue < 0.01 and a["g"].pvalue > 0.05


def test_pvalue_surface_monotone():
    ps = [ts.df_pvalue(x) for x in (-6, -4, -3, -2, -1, 0, 1)]
    assert ps == sorted(ps) and ps[0] < 0.001 and ps[-1] > 0.9


def test_acf_pacf_first_lag_agree(spark):
    s = _series(spark, [1, 3, 2, 5, 4, 6, 5, 8, 7, 9, 8, 11])
    a = {r.lag: r.acf for r in ts.acf(s, 5).collect()}
    p = {r.lag: r.pacf for r in ts.pacf(s, 5).collect()}
    assert a[0] == pytest.approx(1.0) and p[1] == pytest.approx(a[1])
    assert max(p) <= 12 // 2 - 1


def test_arima_css_recovers_ar_coefficient(spark):
    import random
    rnd = random.Random(3)
    y, lvl, vals = 0.0, 100.0, []
    for _ in range(200):
        y = 0.6 * y + rnd.gauss(0, 1)
        lvl += y
        vals.append(lvl)
    s = _series(spark, vals)
    f = ts.arima_fit(s, "css").first()
    assert f.phi == pytest.approx(0.6, abs=0.25)
    # the grid search never does worse than the true parameters
    assert f.css <= ts.arima_css_fixed(s, 0.6, 0.0).first().css + 1e-9
    exact = ts.arima_fit(s).first()
    assert exact.phi == pytest.approx(0.6, abs=0.25)
    assert exact.loglik >= max(f.loglik, ts.arima_likelihood_fixed(s, 0.6, 0.0).first().loglik) - 1e-9


def _gaussian_loglik(y, phi, theta):
    """Log-density of ARMA(1,1) values by their full covariance matrix."""
    import numpy as np
    n = len(y)
    g0 = (1 + 2 * phi * theta + theta ** 2) / (1 - phi ** 2)
    g1 = (1 + phi * theta) * (phi + theta) / (1 - phi ** 2)
    lag = np.abs(np.subtract.outer(np.arange(n), np.arange(n)))
    cov = np.where(lag == 0, g0, g1 * phi ** np.maximum(lag - 1, 0))
    q = y @ np.linalg.solve(cov, y)
    return -0.5 * (n * np.log(2 * np.pi * q / n) + np.linalg.slogdet(cov)[1] + n)


def test_arima_likelihood_is_the_gaussian_density(spark):
    import numpy as np
    x = np.cumsum(np.random.default_rng(1).normal(size=30)) + 50
    s = _series(spark, x.tolist())
    for phi, theta in ((0.5, -0.3), (-0.8, 0.6), (0.0, 0.0)):
        got = ts.arima_likelihood_fixed(s, phi, theta).first()
        assert got.loglik == pytest.approx(_gaussian_loglik(np.diff(x), phi, theta), abs=1e-8)


def test_arima_fit_finds_the_greatest_likelihood(spark):
    """On short series no point of a fine grid is better, and least squares is not either."""
    import numpy as np
    for seed in range(3):
        x = np.cumsum(np.random.default_rng(seed).normal(size=12)) + 20
        s = _series(spark, x.tolist())
        exact, css = ts.arima_fit(s).first(), ts.arima_fit(s, "css").first()
        grid = np.linspace(-0.99, 0.99, 67)
        best = max(_gaussian_loglik(np.diff(x), a, b) for a in grid for b in grid)
        assert exact.loglik >= best - 1e-6 and exact.loglik >= css.loglik - 1e-9
        assert exact.loglik == pytest.approx(_gaussian_loglik(np.diff(x), exact.phi, exact.theta), abs=1e-8)


def test_arima_holdout_refits_every_origin(spark):
    import numpy as np
    x = (np.cumsum(np.random.default_rng(5).normal(size=24)) + 30).tolist()
    got = ts.arima_holdout(_series(spark, x), 3, 2).collect()
    assert sorted((r.origin, r.step) for r in got) == [(o, h) for o in (0, 1) for h in (1, 2, 3)]
    for origin in (0, 1):
        n = len(x) - 3 - origin
        want = [r.forecast for r in ts.arima_forecast(ts.arima_fit(_series(spark, x[:n])), 3).orderBy("step").collect()]
        mine = sorted((r for r in got if r.origin == origin), key=lambda r: r.step)
        assert [r.forecast for r in mine] == pytest.approx(want) and [r.actual for r in mine] == x[n:n + 3]
        rmse = (sum((a - f) ** 2 for a, f in zip(x[n:n + 3], want)) / 3) ** 0.5
        assert all(r.rmse == pytest.approx(rmse) for r in mine)
    assert ts.arima_holdout(_series(spark, x[:3]), 3, 2).count() == 0        # nothing left to train on


# ------------------------------------------------------------------ encode / segment

def test_standardize_population_and_constant(spark):
    df = spark.createDataFrame([(1.0, 3.0), (3.0, 3.0)], "a double, c double")
    out = encode.standardize(df, ["a", "c"]).collect()
    assert sorted(r.a for r in out) == [-1.0, 1.0] and all(r.c == 0.0 for r in out)


def test_one_hot_unknown_all_zero(spark):
    df = spark.createDataFrame([("x",), ("z",), (None,)], "c string")
    out = encode.one_hot(df, "c", ["x", "y"]).collect()
    assert [(r.c_x, r.c_y) for r in out] == [(1.0, 0.0), (0.0, 0.0), (0.0, 0.0)]


def test_label_encode_sorted(spark):
    df = spark.createDataFrame([("b",), ("a",), ("c",), ("a",)], "c string")
    assert {(r.c, r.c_encoded) for r in encode.label_encode(df, "c").collect()} == {("a", 0), ("b", 1), ("c", 2)}


def test_codes_of_many_values_in_ranges_and_salted(spark, monkeypatch):
    """All values distinct but one that a third of the rows share; NULLs have no code."""
    from custlens.operators import encode
    values = [f"v{(i * 7919) % 300:04d}" for i in range(300)] + ["hot"] * 150 + [None, ""]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "id int, c string").repartition(6)
    order = {v: k for k, v in enumerate(sorted({v for v in values if v is not None}))}
    want = {(i, order.get(v)) for i, v in enumerate(values)}
    assert {(r.id, r.c_encoded) for r in encode.label_encode(df, "c").collect()} == want
    monkeypatch.setattr(encode, "DEFAULT_BROADCAST_ROWS", 10)
    salted = encode.label_encode(df, "c")
    assert {(r.id, r.c_encoded) for r in salted.collect()} == want
    plan = encode.dense_codes(df, "c")._jdf.queryExecution().executedPlan().toString()
    # the only single task numbers the ranges: one row per partition, not the values
    single = [line for line in plan.splitlines() if "SinglePartition" in line]
    assert "rangepartitioning" not in plan and len(single) <= 1 and "Scan ExistingRDD" in plan
    assert encode.label_encode(df.limit(0), "c").count() == 0


def test_large_code_table_is_shuffled_and_only_frequent_values_are_copied(spark, monkeypatch):
    """The planner takes a code table of many short values for small: it must not send it whole."""
    from custlens.operators import encode
    monkeypatch.setattr(encode, "DEFAULT_BROADCAST_ROWS", 10)
    monkeypatch.setattr(encode, "MANY_ROWS", 50)
    values = [f"v{i:03d}" for i in range(200)] + ["hot"] * 120 + [None] * 9
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "id int, c string").repartition(6)
    order = {v: k for k, v in enumerate(sorted({v for v in values if v is not None}))}
    codes = encode.dense_codes(df, "c", "code")
    out = encode.with_codes(df, codes, "c")
    assert sorted((r.id, r.code) for r in out.collect()) == [(i, order.get(v)) for i, v in enumerate(values)]
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("SortMergeJoin") == plan.count("SortMergeJoin [c") > 0


def test_wide_one_hot_entries_and_vectors(spark):
    from custlens.operators import encode
    rows = [(1, "b", "x"), (2, "a", None), (3, None, "y"), (4, "c", "x"), (5, None, None)]
    df = spark.createDataFrame(rows, "id int, p string, q string")
    got = {(r.id, r.position, r.feature, r.value) for r in encode.one_hot_entries(df, ["id"], ["p", "q"]).collect()}
    assert got == {(1, 1, "p_b", 1.0), (1, 3, "q_x", 1.0), (2, 0, "p_a", 1.0), (3, 4, "q_y", 1.0), (4, 2, "p_c", 1.0), (4, 3, "q_x", 1.0)}
    vectors = {r.id: r.one_hot.toArray().tolist() for r in encode.one_hot_vector(df, ["p", "q"]).collect()}
    assert vectors == {i: [float((i, k) in {(g[0], g[1]) for g in got}) for k in range(5)] for i in range(1, 6)}


def test_profile_counts_distinct_values_without_expand(spark):
    import datetime
    from custlens.operators import profile
    df = spark.createDataFrame([(1, 0.0, "a", datetime.datetime(2020, 1, 1), b"x"), (1, -0.0, None, None, b"\xff"), (None, float("nan"), "", None, None)],
                               "i int, d double, s string, t timestamp, b binary")
    out = profile.table_profile(df)
    assert "Expand" not in out._jdf.queryExecution().executedPlan().toString()
    got = {r.column_name: (r.non_null, r.nulls, r.distinct) for r in out.collect()}
    assert got == {"i": (2, 1, 1), "d": (3, 0, 2), "s": (2, 1, 2), "t": (1, 2, 1), "b": (2, 1, 2)}
    empty = {r.column_name: (r.non_null, r.nulls, r.distinct) for r in profile.table_profile(df.limit(0)).collect()}
    assert set(empty.values()) == {(0, 0, 0)} and len(empty) == 5
    assert {r.distinct for r in profile.table_profile(df, exact_distinct=False).collect()} <= {1, 2, 3}


def test_silhouette_matches_ml_evaluator(spark):
    import random
    rnd = random.Random(7)
    rows = [(k, [rnd.gauss(k * 3, 1), rnd.gauss(-k, 1)]) for k in range(3) for _ in range(30)]
    df = spark.createDataFrame(rows, "label int, v array<double>")
    ours = segment.silhouette_sq(df, "v", "label").agg(F.avg("silhouette")).first()[0]
    ev = ClusteringEvaluator(distanceMeasure="squaredEuclidean").evaluate(
        df.select(array_to_vector("v").alias("features"), F.col("label").cast("double").alias("prediction")))
    assert ours == pytest.approx(ev, abs=1e-9)


def test_nearest_centroid_ties_smaller_label(spark):
    pts = spark.createDataFrame([(0, [0.0, 0.0])], "id int, v array<double>")
    cs = spark.createDataFrame([(2, [1.0, 0.0]), (1, [-1.0, 0.0])], "label int, centroid array<double>")
    assert segment.nearest_centroid(pts, "v", cs).first().nearest == 1


def test_ladder_first_match_and_mode_tie(spark):
    df = spark.createDataFrame([(0, "b"), (0, "a"), (1, "c")], "label int, m string")
    prof = {r.label: r.m_mode for r in segment.profile(df, "label", [], ["m"]).collect()}
    assert prof == {0: "a", 1: "c"}
    x = spark.createDataFrame([(5.0,), (10.0,)], "v double")
    rules = [("big", F.col("v") >= 10), ("mid", F.col("v").between(5, 10))]
    assert [r.n for r in x.select(segment.rule_ladder(rules, F.lit("other")).alias("n")).collect()] == ["mid", "big"]


def test_kmeans_cost_non_increasing(spark):
    import random
    rnd = random.Random(5)
    df = spark.createDataFrame([([rnd.gauss(c, 0.3), rnd.gauss(-c, 0.3)],) for c in (0, 4, 8) for _ in range(20)],
                               "v array<double>")
    costs = [segment.kmeans_fit(df, "v", k, seeds=(1, 2))[1] for k in (2, 3, 4)]
    assert costs[0] >= costs[1] >= costs[2]


def _blobs(spark, n=60):
    import random
    rnd = random.Random(8)
    return spark.createDataFrame([([rnd.gauss(c, 0.5), rnd.gauss(-c, 0.5), rnd.gauss(0, 0.5)],) for c in (0, 4, 9, 15) for _ in range(n)],
                                 "v array<double>")


def test_kmeans_sweep_shares_its_passes(spark, monkeypatch):
    """The passes of a sweep are those of its slowest start, whatever the number of
    starts; costs and silhouettes are those of single fits and of ``silhouette_sq``."""
    from custlens.operators import kmeans
    df, passes, ks, seeds = _blobs(spark), [], range(2, 6), (1, 2, 3, 4)
    real = kmeans._sums
    monkeypatch.setattr(kmeans, "_sums", lambda data, models: passes.append(len(models)) or real(data, models))
    held = kmeans.blocks(df, "v")
    got = [tuple(r) for r in segment.kmeans_sweep(df, "v", 5, seeds).sort("k").collect()]
    shared = len(passes) - kmeans.ROUNDS - 2                    # without those of the starts and the silhouettes
    alone = []
    begin = kmeans.starts(held, [(k, s) for k in ks for s in seeds])
    for c in begin:
        passes.clear()
        (centres, cost), = kmeans.lloyd(held, [c])
        alone.append((len(passes), len(c), cost, centres))
    assert shared == max(a[0] for a in alone) < sum(a[0] for a in alone)
    for k, cost, sil in got:
        best = min((a for a in alone if a[1] == k), key=lambda a: a[2])
        lab = segment.kmeans_assign(best[3], df, "v")
        want = segment.silhouette_sq(lab, "v", "cluster_label").agg(F.avg("silhouette")).first()[0]
        assert abs(cost - best[2]) < 1e-9 * cost and abs(sil - want) < 1e-9
    held.unpersist()


def test_kmeans_rounds_equal_spark_ml(spark):
    from pyspark.ml.clustering import KMeans
    df = _blobs(spark).repartition(3).cache()
    vectors = df.withColumn("features", array_to_vector("v")).cache()
    for seed in (1, 2):
        ml = KMeans(k=4, seed=seed, maxIter=300, tol=1e-4).fit(vectors.select("features").cache())
        centres, cost = segment.kmeans_fit(df, "v", 4, seeds=(seed,))
        assert abs(cost - ml.summary.trainingCost) < 1e-9 * cost
        assert abs(centres - ml.clusterCenters()).max() < 1e-9
        got = sorted((r.v, r.cluster_label) for r in segment.kmeans_assign(centres, df, "v").collect())
        assert got == sorted((r.v, r.prediction) for r in ml.transform(vectors).collect())


def test_kmeans_with_few_points_and_bad_vectors(spark):
    few = spark.createDataFrame([([1.0, 2.0],)] * 3 + [([5.0, 2.0],)] * 2, "v array<double>")
    rows = segment.kmeans_sweep(few, "v", 4, seeds=(1, 2)).sort("k").collect()
    assert [r.k for r in rows] == [2, 3, 4] and all(r.cost >= 0 and abs(r.silhouette) <= 1 for r in rows)
    same = spark.createDataFrame([([1.0, 2.0],)] * 3, "v array<double>")
    assert [(r.cost, r.silhouette) for r in segment.kmeans_sweep(same, "v", 3, seeds=(1,)).collect()] == [(0.0, 0.0)] * 2
    for bad in ([None, 1.0], [float("nan"), 1.0], None):
        df = spark.createDataFrame([([1.0, 2.0],), (bad,)], "v array<double>")
        with pytest.raises(Exception, match="k-means takes no null"):
            segment.kmeans_sweep(df, "v", 2, seeds=(1,)).collect()


# ------------------------------------------------------------------ models / explain

def test_patience_rule():
    assert models.patience_stop([5, 4, 3, 3.5, 3.6, 3.7], 2) == 3
    assert models.patience_stop([5, 4, 3, 2], 2) == 4


def test_patience_rule_as_query(spark):
    ldf = spark.createDataFrame(list(enumerate([5.0, 4.0, 3.0, 3.5, 3.6, 2.0])), "round int, loss double")
    r = models.patience_stop_df(ldf, 2).first()
    assert r.rounds_kept == 3 and r.best_loss == 3.0


def test_tree_shap_additivity(spark):
    import random
    rnd = random.Random(11)
    rows = []
    for i in range(300):
        a, b, c = rnd.random(), rnd.random(), rnd.random()
        rows.append((i, a, b, c, 1.0 if a + 0.5 * b + rnd.gauss(0, 0.2) > 0.8 else 0.0))
    df = spark.createDataFrame(rows, "id int, a double, b double, c double, label double")
    df = models.assemble(df, ["a", "b", "c"])
    m = models.fit_gbt(df, {**models.XGB_PRESET, "subsamplingRate": 1.0, "featureSubsetStrategy": "all"},
                       max_iter=8)
    nodes = explain.node_table(m)
    con = explain.tree_contributions(nodes, df, "features", ["a", "b", "c"], ["id"])
    tot = con.groupBy("id").agg((F.first("base_score") + F.sum("contribution")).alias("z"))
    sc = models.score(m, df).select("id", F.log(F.col("probability_1") / (1 - F.col("probability_1"))).alias("t"))
    err = tot.join(sc, "id").agg(F.max(F.abs(F.col("z") - F.col("t")))).first()[0]
    assert err < 1e-9
    # a feature the trees never split on gets zero contribution
    imp = {r.feature: r.importance_split for r in explain.split_gain_importance(nodes, ["a", "b", "c"]).collect()}
    unused = [f for f, n in imp.items() if n == 0]
    if unused:
        z = con.where(F.col("feature").isin(unused)).agg(F.max(F.abs("contribution"))).first()[0]
        assert z == 0.0


def test_normalized_zero_sum(spark):
    long = spark.createDataFrame([(1, "a", 0.0), (1, "b", 0.0), (2, "a", 1.0), (2, "b", -3.0)],
                                 "k int, feature string, contribution double")
    out = {(r.k, r.feature): r.normalized_contribution for r in explain.normalized(explain.contribution_rows(long, ["k"]), ["k"]).collect()}
    assert out[(1, "a")] == 0.0 and out[(2, "b")] == -0.75
    assert sum(abs(v) for (k, _), v in out.items() if k == 2) == pytest.approx(1.0)


def test_contributions_stay_in_the_row(spark):
    """Row totals, tops, waterfalls and wide columns against plain Python; no exchange."""
    import random
    from pyspark.sql import functions as F
    rng = random.Random(4)
    rows = [(i, f"f{j:02d}", float(j), rng.choice([-2.0, -1.0, 0.0, 1.0, rng.random()]), 0.25) for i in range(6) for j in range(8)]
    long = spark.createDataFrame(rows, "k int, feature string, value double, contribution double, base_score double")
    brought = explain.contribution_rows(long, ["k"])
    r = spark.createDataFrame(brought.collect(), brought.schema)
    of = {k: [x for x in rows if x[0] == k] for k in range(6)}
    outs = {"pos_neg": explain.pos_neg_totals(r, ["k"]), "norm": explain.normalized(r, ["k"]), "top": explain.top_per_row(r, ["k"], 3),
            "fall": explain.waterfall(r, ["k"], 5), "wide": explain.wide_contributions(r, ["k"], [f"f{j:02d}" for j in range(8)], "c_")}
    for out in outs.values():
        assert "Exchange" not in out._jdf.queryExecution().executedPlan().toString()
    got = {r.k: (r.positive_total, r.negative_total) for r in outs["pos_neg"].collect()}
    for k, x in of.items():
        assert got[k] == pytest.approx((sum(max(v[3], 0) for v in x), sum(min(v[3], 0) for v in x)))
        top = sorted(x, key=lambda v: (-abs(v[3]), v[1]))
        assert [(t.feature, t.rank) for t in sorted(outs["top"].where(F.col("k") == k).collect(), key=lambda t: t.rank)] == [
            (v[1], n + 1) for n, v in enumerate(top[:3])]
        steps = sorted(top[:5], key=lambda v: (v[3] >= 0, v[3], v[1]))
        fall = sorted(outs["fall"].where(F.col("k") == k).collect(), key=lambda t: t.step)
        assert [t.feature for t in fall] == [v[1] for v in steps]
        assert [t.running_total for t in fall] == pytest.approx([0.25 + sum(v[3] for v in steps[:n + 1]) for n in range(5)])
        wide = outs["wide"].where(F.col("k") == k).first()
        assert [wide[f"c_f{j:02d}"] for j in range(8)] == [v[3] for v in x]
        total = sum(abs(v[3]) for v in x)
        share = {t.feature: t.normalized_contribution for t in outs["norm"].where(F.col("k") == k).collect()}
        assert share == pytest.approx({v[1]: v[3] / total if total else 0.0 for v in x})


def test_direction_label_null(spark):
    df = spark.createDataFrame([(0.2,), (-0.1,), (None,)], "c double")
    assert [r.d for r in df.select(explain.direction_label("c").alias("d")).collect()] == ["positive", "negative", "none"]


# ------------------------------------------------------------------ plans

@pytest.mark.parametrize("name", ["customer_month_features", "frequent_itemsets", "roc_auc", "series_summary"])
def test_result_independent_of_partitioning(spark, name):
    from custlens.plans import REGISTRY
    from tests.conftest import SMOKE
    res = []
    for n in ("1", "7"):
        spark.conf.set("spark.sql.shuffle.partitions", n)
        res.append(sorted(map(tuple, REGISTRY[name].build(spark, SMOKE).collect()), key=repr))
    spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert res[0] == res[1]


# ------------------------------------------------------------------ presets / io

def test_bank_rule_ladders_on_reference_columns(spark):
    from custlens import presets as ps
    prof = spark.createDataFrame(
        [(0, 1200000.0, 12.0, 40.0, 1.0, 0.0, 0.0, 0.0, 0.0, 0.0, 0.0, 0.0, 20000.0, 0.0, 0.0, "已婚"),
         (1, 50000.0, 0.0, 45.0, 1.0, 0.0, 0.0, 0.0, 0.0, 0.0, 2.0, 1.0, 3000.0, 0.0, 0.0, "未婚")],
        "cluster_label int, total_assets double, financial_repurchase_count double, age double, "
        "marriage_status_encoded double, credit_card_monthly_expense double, financial_balance double, "
        "fund_balance double, deposit_balance double, app_login_count double, product_count double, "
        "investment_monthly_count double, monthly_income double, app_financial_view_time double, "
        "unused double, marriage_status_mode string")
    default = F.concat(F.lit(ps.BANK_DEFAULT_PREFIX), (F.col("cluster_label") + 1).cast("string"))
    a = {r.cluster_label: r.n for r in prof.select("cluster_label", segment.rule_ladder(
        ps.bank_rules_a(F.col), default).alias("n")).collect()}
    b = {r.cluster_label: r.n for r in prof.select("cluster_label", segment.rule_ladder(
        ps.bank_rules_b(F.col), default).alias("n")).collect()}
    assert a == {0: "高复购高资产客户", 1: "基础客户"}
    assert b == {0: "中产家庭客户", 1: "基础客户"}


def test_bank_csv_schema_roundtrip(spark, tmp_path):
    from custlens.sources import io
    base = tmp_path / "base.csv"
    base.write_text("customer_id,name,age,gender,occupation,occupation_type,monthly_income,open_account_date,"
                    "lifecycle_stage,marriage_status,city_level,branch_name\n"
                    "c1,A,35,M,eng,专业人士,12345.67,2020-01-01,成长客户,已婚,一线城市,b1\n")
    beh = tmp_path / "beh.csv"
    cols = [f.name for f in io.CUSTOMER_BEHAVIOR_SCHEMA.fields]
    vals = {"id": "1", "customer_id": "c1", "total_assets": "1000.50", "stat_month": "2024-07",
            "asset_level": "50万以下", "deposit_flag": "1"}
    beh.write_text(",".join(cols) + "\n" + ",".join(vals.get(c, "0") for c in cols) + "\n")
    b, h = io.read_bank_tables(spark, str(base), str(beh))
    r = b.first()
    assert r.age == 35 and r.monthly_income == 12345.67
    x = h.first()
    assert x.total_assets == 1000.5 and x.deposit_flag == 1 and x.stat_month == "2024-07"


# ------------------------------------------------------------ robustness

def test_wide_baskets_never_enumerate_all_subsets(spark):
    from custlens.operators import baskets as bk
    items = [f"i{k:02d}" for k in range(40)]
    b = spark.createDataFrame([(items,)] * 3 + [(["i00"],)], "items array<string>")
    got = bk.frequent_itemsets(b, 0.5, max_len=2)
    assert got.where("length = 1").count() == 40 and got.where("length = 2").count() == 780
    assert got.agg({"length": "max"}).first()[0] == 2


def test_short_and_constant_series_give_nulls(spark):
    import datetime
    from custlens.operators import series as se
    rows = []
    for name, values in (("ok", [3.0, 5, 4, 8, 6, 9, 7, 12, 9, 13, 11, 15]), ("flat", [2.0] * 12), ("one", [1.0]), ("two", [1.0, 2.0]),
                         ("three", [1.0, 2.0, 4.0])):
        rows += [(name, datetime.date(2020 + i // 12, 1 + i % 12, 28), float(v)) for i, v in enumerate(values)]
    s = spark.createDataFrame(rows, f"{se.G} string, {se.T} date, {se.V} double")
    fit = {r[se.G]: r for r in se.arima_fit(s, coarse=9, refine=9, tolerance=0.05).collect()}
    assert fit["ok"]["phi"] is not None and fit["one"]["phi"] is None and fit["two"]["phi"] is None
    assert (fit["flat"]["phi"], fit["flat"]["theta"]) == (0.0, 0.0)
    flat = se.arima_forecast(se.arima_fit(s.where(f"{se.G} = 'flat'"), coarse=9, refine=9, tolerance=0.05), 2).collect()
    assert [r["forecast"] for r in flat] == [2.0, 2.0]
    adf = {r["series"]: r["adf_stat"] for r in se.adf_test(s).collect()}
    assert adf["ok"] is not None and adf["flat"] is None and adf["one"] is None and adf["three"] is None
    acf = se.acf(s, 3).where(f"{se.G} = 'flat'").collect()
    assert acf and all(r["acf"] is None for r in acf)
    assert se.pacf(s, 3).where("series = 'ok' AND lag = 1").first()["pacf"] is not None


# ------------------------------------------------------------------ boosting

def _boost_data(spark, n=400, parts=3):
    import random
    rng = random.Random(2)
    rows = []
    for i in range(n):
        a, b, c = rng.gauss(0, 1), rng.gauss(0, 1), rng.choice([None, 0.0, 1.0])
        y = float(rng.random() < 1 / (1 + 2.718 ** -(2 * a - b + (c or 0.5))))
        rows.append((i, a, b, c, y, i % 3))
    return spark.createDataFrame(rows, "id int, a double, b double, c double, label double, fold int").repartition(parts)


BOOST_FEATURES = ["a", "b", "c"]


def _boost(rows, p, models=1, held=None, edges=None):
    from custlens.operators import boosting as bo
    edges = bo.split_points(rows, BOOST_FEATURES, 16) if edges is None else edges
    ready = bo.binned(rows, BOOST_FEATURES, edges, "label", ["id"], held, models, keep=["id", "fold", "label"])
    return bo.train(ready, BOOST_FEATURES, edges, p, models), ready


@pytest.mark.parametrize("cells", [0, 10**9])                # exchanged level by level, and in one task
def test_folds_in_one_run_equal_separate_trainings(spark, monkeypatch, cells):
    from pyspark.sql import functions as F
    from custlens.operators import boosting as bo
    monkeypatch.setattr(bo, "CELLS", 10**9 - cells)
    data = _boost_data(spark)
    p = bo.Boosting(rounds=11, depth=3, row_share=0.8, column_share=0.7)
    together, ready = _boost(data, p, 3, F.col("fold"))
    scored = {r.id: r.probability_1 for r in bo.score(ready, together, ["id"], models=3).collect()}
    monkeypatch.setattr(bo, "CELLS", cells)
    for k in range(3):
        alone, _ = _boost(data.where(F.col("fold") != k).repartition(2), p, edges=together.edges)
        assert [t[k] for t in together.trees] == [t[0] for t in alone.trees]
        out = bo.binned(data.where(F.col("fold") == k), BOOST_FEATURES, together.edges, "label", ["id"], keep=["id"])
        assert all(scored[r.id] == r.probability_1 for r in bo.score(out, alone, ["id"], number=0).collect())


@pytest.mark.parametrize("cells", [0, 10**9])
def test_early_stopping_continues_one_training(spark, monkeypatch, cells):
    from pyspark.sql import functions as F
    from custlens.operators import boosting as bo
    monkeypatch.setattr(bo, "CELLS", cells)
    data = _boost_data(spark)
    held = F.when(F.col("fold") == 0, 0).otherwise(-1)
    p = bo.Boosting(rounds=200, rate=0.5, depth=2, patience=4)
    stopped, _ = _boost(data, p, held=held)
    assert len(stopped.trees) == stopped.kept + 4 < 200 and len(stopped.losses) == len(stopped.trees)
    assert stopped.losses[stopped.kept - 1] == min(stopped.losses)
    short, ready = _boost(data, bo.Boosting(rounds=stopped.kept, rate=0.5, depth=2), held=held)
    assert short.trees == stopped.trees[:stopped.kept] and short.kept == stopped.kept
    # the loss that the rule watched is the log-loss of the scored rows
    import math
    got = bo.score(ready, short, ["fold", "label"], number=0).where("fold = 0").collect()
    loss = -sum(math.log(r.probability_1 if r.label else 1 - r.probability_1) for r in got) / len(got)
    assert loss == pytest.approx(stopped.losses[stopped.kept - 1], abs=1e-6)


def test_a_task_a_model_grows_the_same_trees(spark, monkeypatch):
    """Folds of a few rows: one task a model, as with an exchange per level."""
    from custlens.operators import boosting as bo
    data, got, counted = _boost_data(spark), [], []
    p = bo.Boosting(rounds=3, depth=4, row_share=0.8, column_share=0.7)
    collect = type(data).collect
    monkeypatch.setattr(type(data), "collect", lambda df: counted.append("FlatMapGroupsInArrow" in df._jdf.queryExecution().executedPlan().toString()) or collect(df))
    for cells in (0, 10**9):
        monkeypatch.setattr(bo, "CELLS", cells)
        got.append(_boost(data, p, 3, F.col("fold"))[0])
        assert any(counted) == (cells > 0)
    assert got[0].trees == got[1].trees and len(got[0].trees) == 3


def test_boosting_learns_and_splits_as_brute_force(spark, monkeypatch):
    """First split of the first tree against all thresholds; many partitions."""
    import numpy as np
    from custlens.operators import boosting as bo
    monkeypatch.setattr(bo, "CELLS", 0)
    data = _boost_data(spark, 300, 70)                       # over FAN_IN partitions: histograms are added in two steps
    model, ready = _boost(data, bo.Boosting(rounds=8, depth=2))
    rows = data.toPandas()
    g, h, best = 0.5 - rows["label"].to_numpy(), 0.25, (-1.0, None)
    for f, (name, edges) in enumerate(zip(BOOST_FEATURES, model.edges)):
        x = rows[name].to_numpy(dtype=float)
        for c, e in enumerate(edges):
            left = x <= e
            gain = sum(g[s].sum() ** 2 / (h * s.sum() + 1) for s in (left, ~left)) - g.sum() ** 2 / (h * len(g) + 1)
            if h * left.sum() >= 1 and h * (~left).sum() >= 1 and gain > best[0] + 1e-9:
                best = (gain, (f, c))
    t = model.trees[0][0]
    assert (t.feature[0], t.cut[0]) == best[1]
    scored = bo.score(ready, model, ["label"], number=0)
    from custlens.operators import metrics
    assert metrics.roc_auc(scored.withColumn("y", scored["label"].cast("int")), "y", "probability_1").first().roc_auc > 0.75
    assert np.isfinite([r.probability_1 for r in scored.collect()]).all()


def test_grouped_auc_counts_ties_half(spark):
    from custlens.operators import metrics, models
    df = spark.createDataFrame([(i % 2, float(i % 3 == 0), (i * 7 % 5) / 5) for i in range(60)] + [(2, 1.0, 0.5)], "fold int, label double, s double")
    got = {r.fold: r.roc_auc for r in models.grouped_auc(df, ["fold"], "label", "s").collect()}
    for k in (0, 1):
        one = df.where(f"fold = {k}").selectExpr("cast(label as int) y", "s")
        assert got[k] == pytest.approx(metrics.roc_auc(one, "y", "s").first().roc_auc)
    assert got[2] is None


def test_package_ships_without_the_checkpoint_folder(spark, monkeypatch):
    from custlens import session

    def never(_):
        raise AssertionError("the package is served by the driver, not by the checkpoint folder")

    monkeypatch.setattr(session, "checkpoint_dir", never)
    session._SHIPPED.clear()
    session.ship_package(spark)
    assert spark.sparkContext.applicationId in session._SHIPPED
