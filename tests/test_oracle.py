"""Every query with an oracle agrees with DuckDB on the small tables."""

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1] / "tools"))
from lateship.plans.registry import ORACLES as SQL, QUERIES, load_all  # noqa: E402
from oracle_check import canon, duck  # noqa: E402

load_all()
# many passes over the same rows; smaller grids are in test_models and test_jobs
LONG = {"train_gbt", "train_random_forest", "cross_validate_grid"}


@pytest.fixture(scope="module")
def con(sf_dir):
    return duck(sf_dir)


@pytest.mark.parametrize("key", [*sorted(set(SQL) - LONG), *[pytest.param(k, marks=pytest.mark.slow) for k in sorted(LONG)]])
def test_query_matches_oracle(spark, sf_dir, con, key):
    df = QUERIES[key](spark, sf_dir)
    rows = [tuple(r) for r in df.collect()]
    res = con.execute(SQL[key])
    ocols = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(ocols)
    assert canon(rows, df.columns) == canon(res.fetchall(), ocols)
