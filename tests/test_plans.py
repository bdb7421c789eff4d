import pytest

import __spark_entry__ as entry_mod
from driftwood.plans.catalog import QUERIES
from tests.conftest import SF_SMALL

PYTHON_NODES = ("BatchEvalPython", "ArrowEvalPython", "PythonUDF", "FlatMapGroupsInPandas", "MapInPandas")
# queries that write scratch files or fit models at plan time are exercised by the oracle run
SIDE_EFFECT = {"read_with_key", "partition_refresh", "outlier_csv", "model_roundtrip", "elastic_net_score",
               "train_metrics", "job_formatted_orders", "job_reconcile", "job_star", "job_train_predict",
               "job_lookup_load", "job_year_lookup", "job_monthly_drops", "stream_drop_load", "upsert_partitioned",
               "partition_files", "job_load_counts", "star_publish", "star_pruned", "fact_period_refresh",
               "profile_incremental", "string_index_ranked", "ledger_reports", "job_reconcile_incremental",
               "elastic_net_closed_form", "train_metrics_closed_form", "stored_table", "job_year_separate",
               "job_outlier_products"}


def test_every_oracle_has_a_query():
    assert set(entry_mod.oracle_sql()) <= set(entry_mod.queries())


def test_entry_runs(spark):
    df = entry_mod.entry(spark)
    assert df.count() >= 1 and df.columns == ["column_name", "n_outliers", "lower_bound", "upper_bound"]


@pytest.mark.parametrize("name", [n for n in QUERIES if n not in SIDE_EFFECT])
def test_plans_stay_in_the_jvm(spark, name):
    df = entry_mod.queries()[name](spark, SF_SMALL)
    plan = df._jdf.queryExecution().executedPlan().toString()
    for node in PYTHON_NODES:
        assert node not in plan, f"{name} runs Python: {node}"
    assert "CartesianProduct" not in plan, name
    assert "BroadcastNestedLoopJoin" not in plan, name


@pytest.mark.parametrize("name", ["star_join", "fact_listing", "map_lookup"])
def test_joins_run_nothing_while_they_are_built(spark, name):
    sc, group = spark.sparkContext, f"build-{name}"
    sc.setJobGroup(group, group)
    plan = QUERIES[name](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    # reading a footer for a schema is a job of one task; nothing else may run
    info = [sc.statusTracker().getJobInfo(j) for j in sc.statusTracker().getJobIdsForGroup(group)]
    assert all(sc.statusTracker().getStageInfo(s).numTasks == 1 for i in info for s in i.stageIds)
    assert "GlobalLimit" not in plan
