"""One key holding a third of all rows: results stay whole and exact, and the
hot key is pre-aggregated before any shuffle (no window over raw rows)."""

from pyspark.sql import functions as F

from lateship.operators import geo, profile, stats


def _skewed(spark, n=30000):
    # a third of the rows share city HOT; the rest spread over 1000 cities
    return (spark.range(n)
            .select(F.when(F.col("id") % 3 == 0, F.lit("HOT"))
                     .otherwise(F.concat(F.lit("C"), (F.col("id") % 1000).cast("string"))).alias("order_city"),
                    F.lit("S").alias("order_state"),
                    (F.col("id") % 7).cast("double").alias("dest_lat"),
                    (F.col("id") % 5).cast("double").alias("dest_lon"),
                    F.col("id").alias("order_id")))


def test_dedup_hot_key_is_partial_aggregate(spark):
    df = _skewed(spark)
    out = geo.dedup_gazetteer(df.select("order_city", "order_state", "dest_lat", "dest_lon"))
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "partial_min" in plan and "Window" not in plan
    hot = out.filter("order_city = 'HOT'").first()
    assert (hot.dest_lat, hot.dest_lon) == (0.0, 0.0)
    assert out.count() == df.select("order_city").distinct().count()


def test_pick_candidate_is_partial_aggregate(spark):
    c = _skewed(spark).select("order_city", "order_state", (F.col("order_id") % 4).cast("int").alias("rank"),
                              F.lit("street").alias("result_type"), F.col("dest_lat").alias("lat"),
                              F.col("dest_lon").alias("lon"))
    plan = geo.pick_candidate(c)._jdf.queryExecution().executedPlan().toString()
    assert "partial_min" in plan and "Window" not in plan


def test_counts_and_join_keep_every_row(spark):
    df = _skewed(spark)
    counts = {r.order_city: r["count"] for r in profile.group_count_desc(df, "order_city").collect()}
    assert counts["HOT"] == 10000 and sum(counts.values()) == 30000
    gaz = geo.dedup_gazetteer(df.select("order_city", "order_state", "dest_lat", "dest_lon"))
    assert geo.geo_join_nullsafe(df.select("order_id", "order_city", "order_state"), gaz).count() == 30000


def test_quantiles_with_a_hot_value(spark):
    df = _skewed(spark).select(F.when(F.col("order_city") == "HOT", F.lit(5.0))
                               .otherwise(F.col("order_id").cast("double")).alias("x"))
    import numpy as np
    xs = np.array([r.x for r in df.collect()])
    q = {r.p: r.value for r in stats.exact_quantiles(df, ["x"], [0.1, 0.5, 0.9], "linear").collect()}
    for p, v in q.items():
        assert abs(v - np.quantile(xs, p)) < 1e-9
