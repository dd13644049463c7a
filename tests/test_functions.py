import math

from pyspark.sql import functions as F

from lateship.functions.expr import clamp, parse_order_date, slug, slug_text, zero_score
from lateship.functions.geo import EARTH_RADIUS_KM, haversine_km


def test_haversine_identical_antipodal_null_nan(spark):
    df = spark.createDataFrame(
        [(10.0, 20.0, 10.0, 20.0), (0.0, 0.0, 0.0, 180.0), (None, 1.0, 2.0, 3.0),
         (float("nan"), 1.0, 2.0, 3.0), (48.85, 2.35, 51.51, -0.13)],
        "a double, b double, c double, d double")
    r = [x[0] for x in df.select(haversine_km("a", "b", "c", "d")).collect()]
    assert r[0] == 0.0
    assert abs(r[1] - math.pi * EARTH_RADIUS_KM) < 1e-6  # clamped, not NaN
    assert r[2] is None
    assert math.isnan(r[3])
    assert abs(r[4] - 343.5) < 1.0  # Paris-London


def test_clamp_keeps_null_and_widens_int(spark):
    df = spark.createDataFrame([(1,), (5,), (9,), (None,)], "x int")
    out = df.select(clamp("x", 2.0, 8.0).alias("y"))
    assert out.schema["y"].dataType.simpleString() == "double"
    assert [r.y for r in out.collect()] == [2.0, 5.0, 8.0, None]


def test_slug(spark):
    df = spark.createDataFrame([("Gradient-Boosted Trees (GBT)",)], "s string")
    assert df.select(slug("s")).first()[0] == "gradient_boosted_trees_(gbt)"
    assert slug_text("Random Forest") == "random_forest"


def test_parse_order_date_malformed_is_null(spark):
    df = spark.createDataFrame([("2017-01-31 22:56:00",), ("2017-13-31 22:56:00",), ("junk",), (None,)], "s string")
    r = [x[0] for x in df.select(parse_order_date("s")).collect()]
    assert r[0] is not None and r[1] is None and r[2] is None and r[3] is None


def test_zero_score(spark):
    df = spark.createDataFrame([(3,), (None,)], "q int")
    out = df.select(zero_score("q").alias("p"))
    assert out.schema["p"].dataType.simpleString() == "double"
    assert [r.p for r in out.collect()] == [0.0, None]


def test_schema_report_and_preview_without_a_scan(spark):
    from lateship.operators import profile
    df = spark.range(100).selectExpr("id", "CAST(NULL AS STRING) AS s")
    assert [(r.position, r.column_name, r.data_type) for r in profile.schema_report(df, counts=False).collect()] == [(1, "id", "bigint"), (2, "s", "string")]
    some = profile.preview(df, 5, ordered=False)
    assert some.count() == 5 and "Sort" not in some._jdf.queryExecution().executedPlan().toString()


def test_ambiguous_and_unknown_names_are_left_alone(spark):
    from lateship.operators.text import repair_lossy_names
    ref = spark.createDataFrame([("D\u0117v\u0117", "N"), ("D\u0119v\u0119", "N"), ("Do\u011fa", "N"), ("Do\u011fa", "M")], "city string, state string")
    lossy = spark.createDataFrame([("D?v?", "N"), ("Do?a", "N"), ("X?", "N"), ("D?v?", "M")], "city string, state string")
    got = {(r.lossy_city, r.state): (r.repaired_city, r.candidates) for r in repair_lossy_names(lossy, ref).collect()}
    assert got == {("D?v?", "N"): ("D?v?", 2), ("Do?a", "N"): ("Do\u011fa", 1), ("X?", "N"): ("X?", 0), ("D?v?", "M"): ("D?v?", 0)}
