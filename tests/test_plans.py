"""Physical-plan checks: pruning, pushdown, window fusion, no raw rows in
single-partition stages."""

import re

import pytest

from custlens.plans import REGISTRY
from tests.conftest import SMOKE


def _plan(spark, name):
    df = REGISTRY[name].build(spark, SMOKE)
    return df._jdf.queryExecution().executedPlan().toString()


def test_feature_plan_prunes_and_fuses_windows(spark):
    p = _plan(spark, "customer_month_features")
    # only the four order columns the behaviour role needs are read
    assert "o_orderkey" not in p and "o_orderstatus" not in p
    # lag, rolling, cumulative and lead share one partitioning: at most two Window operators
    assert len(re.findall(r"\bWindow \[", p)) <= 2


def test_snapshot_filter_is_pushed_into_scan(spark):
    from pyspark.sql import functions as F
    from custlens.sources import bindings as bd
    df = bd.behaviour(spark, SMOKE).where(F.col("customer_id") == 7)
    p = df._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(o_custkey,7)" in p


@pytest.mark.parametrize("name", ["roc_auc", "pr_auc", "frequent_itemsets", "segment_quartiles", "stratified_split"])
def test_single_partition_exchanges_only_over_bounded_inputs(spark, name):
    lines = _plan(spark, name).split("\n")
    for i, line in enumerate(lines):
        if "Exchange SinglePartition" in line:
            child = lines[i + 1]
            # a global partial aggregate (one row per partition) or an aggregate keyed by a range id
            assert "HashAggregate(keys=[]" in child or "HashAggregate(keys=[_b" in child \
                or "ObjectHashAggregate(keys=[]" in child, child


@pytest.mark.parametrize("name", ["gini_best_split", "segment_quartiles"])
def test_rows_are_never_shuffled_on_a_bare_group_key(spark, name):
    lines = _plan(spark, name).split("\n")
    for i, line in enumerate(lines):
        m = re.search(r"Exchange hashpartitioning\((.*?), \d+\)", line)
        if m and re.fullmatch(r"(feature|label|cluster_label|__l|segment_name|qi|_col)#\d+L?", m[1].strip()):
            # only map-side combined rows may meet on the group alone
            assert re.search(r"functions=\[partial_", lines[i + 1]) or "Window" in lines[i + 1] or "_b" in lines[i + 1], lines[i + 1]
    assert "SortMergeJoin" not in "\n".join(lines)


def test_dashboard_scans_every_table_once(spark):
    p = _plan(spark, "dashboard_bundle")
    scans = re.findall(r"FileScan parquet[^\n]*?/(\w+)\.parquet", p)
    assert scans.count("orders") == 1 and scans.count("events") == 1 and scans.count("customer") == 1


def test_snapshot_reads_one_month_of_the_stage(spark):
    df = REGISTRY["snapshot_stage"].build(spark, SMOKE)
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    scans = [line for line in plan.splitlines() if "FileScan" in line and "/stages/" in line and "total_assets" in line]
    assert scans and all("PartitionFilters: [isnotnull(stat_month" in s and "ubquery" in s for s in scans)
    from custlens.sources import bindings as bd
    assert bd.behaviour(spark, SMOKE).select("stat_month").distinct().count() > 1
    assert _partitions_read(df._jdf.queryExecution().executedPlan()) == [1]


def _partitions_read(plan):
    """numPartitions of the scans of an executed adaptive plan."""
    out, todo = [], [plan]
    while todo:
        p = todo.pop()
        kind = p.getClass().getSimpleName()
        if kind == "AdaptiveSparkPlanExec":
            todo.append(p.executedPlan())
        elif kind.endswith("QueryStageExec"):
            todo.append(p.plan())
        elif p.metrics().contains("numPartitions") and "FileSourceScan" in kind:
            out.append(p.metrics().apply("numPartitions").value())
        todo += [p.children().apply(i) for i in range(p.children().size())]
    return out


def test_contributions_are_not_shuffled(spark):
    """Row-wise explanations add no exchange to the feature stage."""
    features = _plan(spark, "customer_month_features").count("Exchange hash")
    for name in ("waterfall", "top_contrib_per_row", "normalized_contribution", "pos_neg_totals"):
        p = _plan(spark, name)
        # the means and deviations read the features once more
        assert p.count("Exchange hash") <= 2 * features


def test_model_input_has_partitions_by_its_rows(spark, tmp_path, monkeypatch):
    """Boosting passes over the model input hundreds of times: not over the partitions of the last shuffle."""
    from custlens.plans import model_plans as mp
    spark.createDataFrame([(1, "EU")], "r_regionkey int, r_name string").write.parquet(f"{tmp_path}/region.parquet")
    spark.createDataFrame([(1, "N", 1)], "n_nationkey int, n_name string, n_regionkey int").write.parquet(f"{tmp_path}/nation.parquet")
    spark.createDataFrame([(i, f"c{i}", 1, 1.0 * i, "AB"[i % 2]) for i in range(20)],
                          "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string").write.parquet(f"{tmp_path}/customer.parquet")
    spark.sql("""SELECT id AS o_orderkey, id % 20 AS o_custkey, 'O' AS o_orderstatus, 1000.0D * (id % 700) AS o_totalprice,
        CAST(add_months(DATE'1998-06-15', CAST(id / 20 AS INT)) AS TIMESTAMP) AS o_orderdate, '1-URGENT' AS o_orderpriority
        FROM range(400)""").write.parquet(f"{tmp_path}/orders.parquet")
    fitted = []
    monkeypatch.setattr(mp.models, "fit_gbt", lambda df, *a, **kw: fitted.append(df))
    mp._xgb(spark, str(tmp_path))
    train, test, _ = mp._data(spark, str(tmp_path))
    assert [df.rdd.getNumPartitions() for df in (*fitted, test)] == [1, 1] and train.count() == 260 and test.count() == 80
    assert [mp.partitions(n) for n in (0, 1, 10_001, 300_000, 9_000_000)] == [1, 1, 2, 24, 45]
