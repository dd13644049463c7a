"""Plan checks: every query stays JVM-side (no Python UDF evaluation, no RDD
scan) and the scans read only the columns they need."""

import pytest

import __spark_entry__ as E
from lateship.plans.registry import ORACLES, load_all

load_all()

# (a checkpointed table is read back as "Scan ExistingRDD": allowed)
PYTHON_NODES = ("BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas",
                "MapInPandas", "PythonUDF", "PythonRDD")
# streaming and training queries run their work inside the call; the rest are lazy
KEYS = sorted(k for k in ORACLES if not k.startswith(("stream_", "sink_", "scan_", "train_", "cross_")))


@pytest.mark.parametrize("key", KEYS)
def test_no_python_in_plan(spark, sf_dir, key):
    df = E.queries()[key](spark, sf_dir)
    plan = df._jdf.queryExecution().executedPlan().toString()
    bad = [n for n in PYTHON_NODES if n in plan]
    assert not bad, f"{key}: {bad}"


def test_flagship_prunes_columns_and_partial_aggregates(spark, sf_dir):
    df = E.queries()["shipping_mode_distribution"](spark, sf_dir)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<shipping_mode:string>" in plan
    assert plan.count("HashAggregate") >= 2  # partial before the shuffle, final after


def test_auc_window_is_per_slice(spark, sf_dir):
    df = E.queries()["auc_roc_exact"](spark, sf_dir)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(__slice" in plan  # the sorted window runs per slice
