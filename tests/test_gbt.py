"""Boosted trees over many rows: the same trees as Spark ML's, the same losses and contributions."""

import numpy as np
import pandas as pd
import pytest


@pytest.fixture(scope="module")
def rows(spark):
    from custlens.operators import models
    rng = np.random.default_rng(5)
    x = rng.normal(size=(3000, 6))
    x[:, 1] = np.round(x[:, 1])                                          # few values, some of them zero
    x[:, 2] = np.maximum(x[:, 2], 0.0)                                   # half of them zero
    y = (x[:, 0] + x[:, 2] * x[:, 3] + rng.normal(size=3000) > 0.5).astype(float)
    df = spark.createDataFrame(pd.DataFrame({"id": range(3000), **{f"f{j}": x[:, j] for j in range(6)}, "label": y}))
    return models.assemble(df, [f"f{j}" for j in range(6)]).repartition(3, "id").sortWithinPartitions("id").cache()


PRESET = {"maxIter": 5, "stepSize": 0.1, "maxDepth": 4, "subsamplingRate": 0.8, "featureSubsetStrategy": "0.8"}


def _nodes(model):
    from custlens.operators import explain
    return explain.node_table(model).drop("impurityStats").toPandas().sort_values(["treeID", "id"]).reset_index(drop=True)


@pytest.mark.parametrize("fan_in", [16, 2])
def test_trees_over_many_rows_are_those_of_spark_ml(spark, rows, monkeypatch, fan_in):
    from custlens.operators import gbt, models
    monkeypatch.setattr(gbt, "KEEP_EVERY", 2)
    monkeypatch.setattr(gbt, "CHUNK", 1)                                 # an array a batch
    monkeypatch.setattr(gbt, "FAN_IN", fan_in)
    monkeypatch.setattr(models, "MANY_ROWS", 100)
    plain = models.gbt(PRESET).fit(rows)
    fitted = []
    fit = gbt.fit
    monkeypatch.setattr(gbt, "fit", lambda *a: fitted.append(fit(*a)) or fitted[-1])
    model = models.fit_gbt(rows, PRESET)
    assert fitted == [model]
    ours, theirs = _nodes(model), _nodes(plain)
    assert len(ours) == len(theirs) > 5 * 15
    for c in ("treeID", "id", "rawCount", "leftChild", "rightChild", "featureIndex"):
        assert (ours[c] == theirs[c]).all(), c
    for c in ("weight", "prediction", "impurity", "gain", "threshold"):
        assert np.allclose(ours[c].astype(float), theirs[c].astype(float), rtol=1e-9, atol=1e-12, equal_nan=True), c
    assert {p.name: v for p, v in model.extractParamMap().items()} == {p.name: v for p, v in plain.extractParamMap().items()}
    assert np.allclose(model.featureImportances.toArray(), plain.featureImportances.toArray(), atol=1e-12)
    got, want = ({r.id: r.probability_1 for r in models.score(m, rows).collect()} for m in (model, plain))
    assert max(abs(got[i] - want[i]) for i in want) < 1e-12


def test_rows_and_features_are_drawn_as_spark_draws_them(spark):
    from custlens.operators import gbt
    java = spark._jvm.org.apache.spark.util.random.XORShiftRandom(47)
    want = [java.nextDouble() for _ in range(2500)]
    assert list(gbt.xorshift_doubles(47, 2500)) == want and list(gbt.xorshift_doubles(47, 5)) == want[:5]
    java, ours = spark._jvm.java.util.Random(3), gbt.JavaRandom(3)
    assert all(java.nextLong() % (1 << 64) == ours.long() for _ in range(5))
    exp, x = spark._jvm.java.lang.StrictMath.exp, np.random.default_rng(0).normal(0, 3, 200)
    assert [exp(float(v)) for v in x] == list(gbt.java_exp(x))


def test_bad_labels_and_values_are_refused(spark, rows):
    from pyspark.sql import functions as F

    from custlens.operators import gbt, models
    with pytest.raises(Exception, match="labels must be"):
        gbt.fit(rows.withColumn("label", F.col("label") + 1), models.gbt(PRESET))
    names = [f"f{j}" for j in range(6)]
    odd = models.assemble(rows.drop("features").withColumn("f3", F.when(F.col("id") != 7, F.col("f3"))), names)
    with pytest.raises(Exception, match="must not be NaN"):
        gbt.fit(odd, models.gbt(PRESET))


def test_losses_of_all_rounds_in_one_pass(spark, rows):
    from custlens.operators import models
    model = models.gbt(PRESET).fit(rows)
    jobs = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("losses", "")
    got = models.loss_by_round(model, rows)
    assert np.allclose(got, model.evaluateEachIteration(rows), rtol=1e-12)
    spark.sparkContext.setJobGroup("again", "")
    models.loss_by_round(model, rows)
    assert len(jobs.getJobIdsForGroup("again")) < 25                     # not one a round and more
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_contributions_by_table_are_those_by_polynomials():
    from custlens.operators import explain as ex
    nodes = pd.DataFrame([(0, 1.0, 0, 0.0, 100, 1, 6, 2, 0.1), (0, 1.0, 1, 0.0, 60, 2, 5, 0, -0.3), (0, 1.0, 2, 0.0, 40, 3, 4, 2, -0.5),
                          (0, 1.0, 3, 1.5, 10, -1, -1, -1, None), (0, 1.0, 4, -2.0, 30, -1, -1, -1, None), (0, 1.0, 5, 0.7, 20, -1, -1, -1, None),
                          (0, 1.0, 6, 0.2, 40, -1, -1, -1, None)],
                         columns=["treeID", "weight", "id", "prediction", "rawCount", "leftChild", "rightChild", "featureIndex", "threshold"])
    x = np.random.default_rng(2).normal(size=(500, 4))
    x[3, 2] = np.nan
    tree = ex._compile_tree(nodes)
    want, base = ex._shap_tree(x, tree, 4)
    got, same = ex._shap_by_table(x, ex._shap_tables(tree), 4)
    assert np.allclose(got, want, atol=1e-15) and base == same
    assert np.allclose(got.sum(axis=1) + base, ex.tree_values(nodes)(x))
    alone = nodes[nodes.id == 6]
    assert (ex._shap_by_table(x, ex._shap_tables(ex._compile_tree(alone)), 4)[0] == 0).all() and (ex.tree_values(alone)(x) == 0.2).all()


def test_boosting_over_tasks_adds_many_histograms_in_tasks(spark, rows, monkeypatch):
    from custlens.operators import boosting as bo
    names = [f"f{j}" for j in range(6)]
    edges = bo.split_points(rows, names)
    ready = bo.binned(rows, names, edges, "label", ["id"])
    p = bo.Boosting(rounds=5, depth=3, row_share=0.8, column_share=0.8)
    want = bo.train(ready, names, edges, p).trees
    monkeypatch.setattr(bo, "CELLS", 0)
    monkeypatch.setattr(bo, "KEEP_EVERY", 2)
    assert bo.train(ready, names, edges, p).trees == want
    monkeypatch.setattr(bo, "FAN_IN", 2)
    assert bo.train(ready, names, edges, p).trees == want
