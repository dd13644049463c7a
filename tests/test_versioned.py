import os
import threading

import pytest
from pyspark.sql import functions as F

from lateship.session import local_path, shared_dir
from lateship.sinks.versioned import VersionedTable

SCHEMA = "order_city string, order_state string, dest_lat double, dest_lon double"


def rows(spark, *items):
    return spark.createDataFrame([(c, "S", x, x) for c, x in items], SCHEMA)


def content(df):
    return sorted(((r.order_city, r.dest_lat) for r in df.collect()), key=str)


def test_runs_are_applied_once_and_keys_kept_once(spark):
    t = VersionedTable(spark, shared_dir(spark, "t-versioned"))
    assert t.current() is None
    with pytest.raises(FileNotFoundError):
        t.read()
    t.append(rows(spark, ("a", 1.0), ("b", None), (None, 5.0)), "r1")
    t.append(rows(spark, ("b", 2.0), ("c", 3.0)), "r2")
    t.append(rows(spark, ("z", 9.0)), "r1")            # that run is over
    assert content(t.read()) == [("a", 1.0), ("b", 2.0), ("c", 3.0), (None, 5.0)]
    assert t.current().number == 2 and t.current().runs == ("r1", "r2")


def test_a_killed_append_leaves_the_table_as_it_was(spark):
    t = VersionedTable(spark, shared_dir(spark, "t-versioned-killed"))
    t.append(rows(spark, ("a", 1.0)), "r1")
    bad = rows(spark, *[(f"k{i}", float(i)) for i in range(50)]).repartition(5).withColumn(
        "dest_lat", F.when(F.col("dest_lat") == 33.0, F.raise_error(F.lit("killed"))).otherwise(F.col("dest_lat")))
    with pytest.raises(Exception, match="killed"):
        t.append(bad, "r2")
    assert content(t.read()) == [("a", 1.0)] and t.current().number == 1
    t.append(rows(spark, ("b", 2.0)), "r2")
    assert content(t.read()) == [("a", 1.0), ("b", 2.0)]


def test_old_data_is_deleted_and_a_pinned_reader_keeps_its_version(spark):
    t = VersionedTable(spark, shared_dir(spark, "t-versioned-old"), keep=2)
    t.append(rows(spark, ("a", 1.0)), "r1")
    pinned, df = t.current(), t.read()
    t.append(rows(spark, ("b", 2.0)), "r2")
    assert content(df) == content(t.read(pinned)) == [("a", 1.0)]
    for i in range(3, 7):
        t.append(rows(spark, ("c", float(i))), f"r{i}")
    assert len(os.listdir(local_path(t.path) + "/data")) == 2
    assert content(t.read()) == [("a", 1.0), ("b", 2.0), ("c", 3.0)]   # the smallest coordinates of a key


def test_two_writers_lose_nothing(spark):
    path = shared_dir(spark, "t-versioned-race")
    VersionedTable(spark, path, keep=50).append(rows(spark, ("start", 0.0)), "r")
    failed = []

    def work(k):
        try:
            for i in range(3):
                VersionedTable(spark, path, keep=50).append(rows(spark, (f"{k}{i}", 1.0)), f"{k}{i}")
        except Exception as e:  # noqa: BLE001
            failed.append(e)

    threads = [threading.Thread(target=work, args=(k,)) for k in "xy"]
    [t.start() for t in threads]
    [t.join() for t in threads]
    t = VersionedTable(spark, path)
    assert not failed and {r.order_city for r in t.read().collect()} == {"start", *[f"{k}{i}" for k in "xy" for i in range(3)]}
    assert t.current().number == 7
