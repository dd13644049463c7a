"""The queries of the operators that SQL can express agree with DuckDB."""

import sys
from pathlib import Path

import __spark_entry__ as E
import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[2] / "tools"))
from lateship.llm.queries import ORACLES, QUERIES  # noqa: E402
from oracle_check import canon, duck  # noqa: E402

SF = "/root/testdata/sf0.01"


@pytest.mark.parametrize("key", sorted(ORACLES))
def test_query_matches_oracle(spark, key):
    df = QUERIES[key](spark, SF)
    res = duck(SF).execute(ORACLES[key])
    cols = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(cols)
    assert canon([tuple(r) for r in df.collect()], df.columns) == canon(res.fetchall(), cols)


def test_one_query_for_each_operator():
    names = set(E.queries())
    assert all(any(n.startswith(f"op{k}_") for n in names) for k in range(1, 14)) and "pipeline" in names
