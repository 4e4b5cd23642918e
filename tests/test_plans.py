"""Physical plans: pruning, push-down, partial aggregation, no Python, no cross join."""

import pytest

import __spark_entry__ as contract
from kerbside.plans import explore
from kerbside.plans.tables import observations, plain

# Queries that write and read back, that score by a fitted model in Arrow batches, or that take a
# stated query set against all rows in blocks.
WRITES = ("boosted_coverage", "op12_", "sink_", "stream_", "ml_", "scan_mixed", "split_reader", "feature_list", "comparison_csv",
          "model_comparison", "score_batch", "feature_importance", "attribution", "eval_")


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def stored(spark, sf_dir, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("plans") / "obs")
    plain(observations(spark, sf_dir)).write.parquet(path)
    return path


@pytest.mark.parametrize("name", [n for n in sorted(contract.queries()) if not n.startswith(WRITES)])
def test_no_python_and_no_cross_join(spark, sf_dir, name):
    plan = plan_of(contract.queries()[name](spark, sf_dir))
    for bad in ("ArrowEvalPython", "BatchEvalPython", "MapInPandas", "CartesianProduct",
                "BroadcastNestedLoopJoin"):
        assert bad not in plan, bad


def test_filters_reach_the_scan(spark, stored):
    from kerbside.operators import dashboard
    plan = plan_of(dashboard.filtered(spark.read.parquet(stored), "Town01", "ClearNoon"))
    assert "EqualTo(town,Town01)" in plan and "EqualTo(weather_name,ClearNoon)" in plan


def test_columns_are_pruned(spark, stored):
    from kerbside.operators import distributions as D
    plan = plan_of(D.histogram(spark.read.parquet(stored), "speed", 10, ["congestion_label"]))
    assert "ReadSchema: struct<speed:double,congestion_label:string>" in plan


def test_report_scans_once(spark, stored):
    from kerbside.operators import cleaning
    plan = plan_of(cleaning.drop_report(spark.read.parquet(stored)))
    assert plan.count("FileScan parquet") == 1


def test_views_are_complete(spark, sf_dir):
    assert explore.raw(spark, sf_dir).count() == spark.read.parquet(f"{sf_dir}/lineitem.parquet").count()


def test_training_rows_are_shuffled_once(spark, sf_dir):
    """The deduplication's shuffle also deals the rows; features are worked out below the filters."""
    from kerbside.plans import modelling
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    plan = modelling.split_features(spark, sf_dir, parts)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "RoundRobin" not in plan
