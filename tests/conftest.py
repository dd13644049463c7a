import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SMALL = "/root/testdata/sf0.001"


def pytest_configure(config):
    config.addinivalue_line("markers", "slow: minutes of passes over the same rows (leave out with -m 'not slow')")


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession
    from lateship.session import DEFAULT_CONF, ensure_checkpoint_dir
    b = (SparkSession.builder.master("local[4]").appName("lateship-tests")
         .config("spark.sql.shuffle.partitions", "8"))
    for k, v in DEFAULT_CONF.items():
        b = b.config(k, v)
    s = b.getOrCreate()
    s.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(s)
    yield s
    s.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return SMALL
