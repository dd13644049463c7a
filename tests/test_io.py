import os

from pyspark.sql import types as T

from lateship.session import local_path, shared_dir
from lateship.sinks import files as sinks
from lateship.sources import files as sources
from lateship.sources import fixtures

SCHEMA = T.StructType([T.StructField("city", T.StringType()), T.StructField("state", T.StringType())])


def test_fallback_keeps_utf8_and_repairs_latin1(spark):
    df = spark.createDataFrame([("Belém 1", "N1"), ("Dėvė 2", "N2")], SCHEMA)
    utf8, latin = shared_dir(spark, "t-utf8"), shared_dir(spark, "t-latin")
    sinks.write_csv(df, utf8)
    report = sinks.write_csv_latin1(df, latin, ["city", "state"])
    lossy = {r.column_name: r.lossy_rows for r in report.collect()}
    assert lossy == {"city": 1, "state": 0}
    a = sorted(r.city for r in sources.read_csv_fallback(spark, utf8, SCHEMA).collect())
    b = sorted(r.city for r in sources.read_csv_fallback(spark, latin, SCHEMA).collect())
    assert a == ["Belém 1", "Dėvė 2"]          # valid UTF-8: read as is
    assert b == ["Belém 1", "D?v? 2"]          # Latin-1 bytes: kept as Latin-1


def test_fallback_decides_per_cell_in_one_scan(spark):
    mixed = shared_dir(spark, "t-mixed")
    sinks.write_csv(spark.createDataFrame([("Belém", "\ufffd legitimate"), ("", None)], SCHEMA), mixed, mode="append")
    sinks.write_csv(spark.createDataFrame([("Açaí", "n")], SCHEMA), mixed, encoding="ISO-8859-1", mode="append")
    df = sources.read_csv_fallback(spark, mixed, SCHEMA)
    assert sorted((r.city or "", r.state or "") for r in df.collect()) == [("", ""), ("Açaí", "n"), ("Belém", "\ufffd legitimate")]
    assert df._jdf.queryExecution().executedPlan().toString().count("FileScan csv") == 1


def test_malformed_coordinates_are_null_and_repeats_fold(spark):
    path = shared_dir(spark, "t-gaz")
    spark.createDataFrame([("A", "S", "None", "1"), ("B", "S", "2.5", "x"), ("A", "S", "3", "4")],
                          "`Order City` string, `Order State` string, Dest_Lat string, Dest_Lon string").write.mode("overwrite").option("header", True).csv(path)
    got = sorted(((r.order_city, r.dest_lat, r.dest_lon) for r in sources.read_gazetteer(spark, path).collect()), key=str)
    assert got == [("A", 3.0, 4.0), ("A", None, 1.0), ("B", 2.5, None)]
    once = sorted((r.order_city, r.dest_lat) for r in sources.read_gazetteer(spark, path, unique=True).collect())
    assert once == [("A", 3.0), ("B", 2.5)]


def test_shared_folder_or_fail(spark, monkeypatch):
    from types import SimpleNamespace

    import pytest
    from lateship import session

    calls = []
    sc = SimpleNamespace(master="spark://host:7077", getCheckpointDir=lambda: calls and calls[-1] or None, setCheckpointDir=calls.append)
    fake = SimpleNamespace(sparkContext=sc, conf=SimpleNamespace(get=lambda k, d=None: d))
    with pytest.raises(RuntimeError):
        session.ensure_checkpoint_dir(fake)
    sc.master = "local[2]"
    assert session.ensure_checkpoint_dir(fake) == calls[-1]
    os.rmdir(calls[-1])


def test_prepared_table_is_rebuilt_when_its_folder_is_gone(spark, sf_dir):
    calls = []

    def build(sp, d):
        calls.append(1)
        return sp.range(5)

    first = fixtures.materialized(spark, sf_dir, "t-prepared", build)
    assert first.count() == 5 and len(calls) == 1
    fixtures.materialized(spark, sf_dir, "t-prepared", build)
    assert len(calls) == 1  # reused
    key = (spark.sparkContext.applicationId, sf_dir, "t-prepared")
    # a memo pointing at a folder that is no longer there (cleaned share)
    fixtures._MATERIALIZED[key] = fixtures._MATERIALIZED[key] + "-gone"
    assert not os.path.exists(local_path(fixtures._MATERIALIZED[key]))
    again = fixtures.materialized(spark, sf_dir, "t-prepared", build)
    assert again.count() == 5 and len(calls) == 2
