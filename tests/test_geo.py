from lateship.operators import geo

ITEMS = [(1, None, "S1"), (2, "C1", "S1"), (3, "C2", "S1")]
GAZ = [(None, "S1", 1.0, 2.0), ("C1", "S1", 3.0, 4.0)]


def _frames(spark):
    items = spark.createDataFrame(ITEMS, "order_id int, order_city string, order_state string")
    gaz = spark.createDataFrame(GAZ, "order_city string, order_state string, dest_lat double, dest_lon double")
    return items, gaz


def test_nullsafe_vs_plain_join(spark):
    items, gaz = _frames(spark)
    ns = {r.order_id: r.dest_lat for r in geo.geo_join_nullsafe(items, gaz).collect()}
    pl = {r.order_id: r.dest_lat for r in geo.geo_join_using(items, gaz).collect()}
    assert ns == {1: 1.0, 2: 3.0, 3: None}
    assert pl == {1: None, 2: 3.0, 3: None}
    assert geo.geo_join_nullsafe(items, gaz).columns.count("order_city") == 1


def test_repeated_keys_never_multiply_rows(spark):
    items, gaz = _frames(spark)
    many = gaz.unionByName(gaz).unionByName(spark.createDataFrame([("C1", "S1", None, 9.0)], gaz.schema))
    items = items.withColumn("latitude", items.order_id * 1.0).withColumn("longitude", items.order_id * 1.0)
    for out in (geo.geo_join_nullsafe(items, many), geo.geo_join_using(items, many), geo.enrich_with_distance(items, many)):
        assert {r.order_id: r.dest_lat for r in out.collect()}[2] == 3.0 and out.count() == 3


def test_shuffle_joins_give_the_same_rows_and_spread_null_keys(spark):
    """Broadcast switched off: sort-merge plans, salted null keys."""
    items = spark.range(2000).selectExpr("id AS order_id", "CASE WHEN id % 3 = 0 THEN NULL ELSE concat('C', id % 7) END AS order_city",
                                         "CASE WHEN id % 5 = 0 THEN NULL ELSE 'S1' END AS order_state")
    gaz = spark.createDataFrame([(f"C{i}", "S1", float(i), 1.0) for i in range(7)] + [(None, "S1", 50.0, 1.0), (None, None, 51.0, 1.0)],
                                "order_city string, order_state string, dest_lat double, dest_lon double")
    old = spark.conf.get("spark.sql.adaptive.autoBroadcastJoinThreshold")
    for join in (geo.geo_join_nullsafe, geo.geo_join_using):
        want = sorted(map(str, join(items, gaz).collect()))
        spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
        try:
            df = join(items, gaz, broadcast_max_bytes=0)
            assert sorted(map(str, df.collect())) == want
            plan = df._jdf.queryExecution().executedPlan().toString()
            assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan
        finally:
            spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", old)
    assert "hashpartitioning(order_city" in plan and "__salt" in plan


def test_nullsafe_join_is_hash_join(spark):
    items, gaz = _frames(spark)
    df = geo.geo_join_nullsafe(items, gaz)
    df.collect()  # the measured size decides on the broadcast
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "NestedLoop" not in plan


def test_pick_candidate_zero_is_a_coordinate(spark):
    c = spark.createDataFrame(
        [("A", "S", 0, "state", 5.0, 5.0), ("A", "S", 1, "city", 0.0, 7.0),
         ("B", "S", 0, "state", 1.0, 1.0), ("B", "S", 1, "street", 2.0, 2.0),
         ("C", "S", 0, "city", None, 3.0), ("C", "S", 1, "city", 9.0, 9.0)],
        "order_city string, order_state string, rank int, result_type string, lat double, lon double")
    r = {x.order_city: (x.dest_lat, x.dest_lon) for x in geo.pick_candidate(c).collect()}
    assert r == {"A": (0.0, 7.0), "B": (1.0, 1.0), "C": (None, None)}


def test_incremental_gazetteer_and_retry(spark):
    done = spark.createDataFrame([("A", "S", 1.0, 1.0), ("F", "S", None, None)],
                                 "order_city string, order_state string, dest_lat double, dest_lon double")
    keys = spark.createDataFrame([("A", "S"), ("F", "S"), ("N", "S"), ("Q", "S")], "order_city string, order_state string")
    cands = spark.createDataFrame([("N", "S", 0, "city", 2.0, 2.0), ("F", "S", 0, "city", 3.0, 3.0)],
                                  "order_city string, order_state string, rank int, result_type string, lat double, lon double")
    out = {(r.order_city): r.dest_lat for r in geo.incremental_gazetteer(done, keys, cands).collect()}
    assert out == {"A": 1.0, "F": None, "N": 2.0, "Q": None}
    out2 = geo.incremental_gazetteer(done, keys, cands, retry_failed=True).collect()
    assert sorted((r.order_city, r.dest_lat) for r in out2) == [("A", 1.0), ("F", 3.0), ("N", 2.0), ("Q", None)]


def test_dedup_gazetteer_keeps_left_row_count(spark):
    items, gaz = _frames(spark)
    dup = gaz.unionByName(gaz).unionByName(
        spark.createDataFrame([("C1", "S1", None, None)], gaz.schema))
    d = geo.dedup_gazetteer(dup)
    assert d.count() == 2
    assert geo.geo_join_nullsafe(items, d).count() == items.count()
