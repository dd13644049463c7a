"""Tables in the reference's shape, derived by Spark from the base tables.

``order_items`` is the order-item table the reference reads from CSV;
``gazetteer`` and ``geocode_candidates`` stand in for the geocoder output;
``predictions`` is a scored table with a fixed logistic score. All of them are
derived from the base tables and grow with them; ``order_items``, the gazetteer
and the candidate and city tables are written once per application and data
folder (see :func:`materialized`), ``predictions`` is a plan over them.

Plan shape for ``order_items``: customers are joined at the *orders* grain
(orders are about a quarter of the line items), then the line items join that
on the order key; supplier, nation and region are size-checked broadcasts;
part is projected to the three columns needed before its join, and
Catalyst/AQE choose broadcast or sort-merge from its size. Only keys, codes
and measures are shuffled: the texts that follow from them (city, state,
region, mode) are made after the last join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions.expr import fixed_logit
from ..operators.joins import checked_broadcast
from ..session import shared_dir
from .tables import table

_MATERIALIZED: dict = {}


def _still_there(path: str) -> bool:
    """False only when a local table folder has disappeared (remote stores
    are trusted; a missing table there fails loudly on read)."""
    import os
    if "://" in path and not path.startswith("file:"):
        return True
    return os.path.exists(os.path.join(path.replace("file:", "", 1), "_SUCCESS"))


def materialized(spark: SparkSession, sf_dir: str, name: str, build) -> DataFrame:
    """Build a derived table once per application and data folder, write it
    as zstd Parquet under the shared checkpoint folder, and read it from there.

    This is the prepared input table the reference reads: later queries scan
    it (with column pruning and filter pushdown) instead of repeating the
    seven-table join, and a lost executor costs a re-read, not a re-join.
    """
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key in _MATERIALIZED and not _still_there(_MATERIALIZED[key]):
        del _MATERIALIZED[key]  # the shared folder was cleaned: build again
    if key not in _MATERIALIZED:
        path = shared_dir(spark, f"table-{name}")
        build(spark, sf_dir).write.mode("overwrite").option("compression", "zstd").parquet(path)
        _MATERIALIZED[key] = path
    return spark.read.parquet(_MATERIALIZED[key])

# Shipping mode and scheduled days by the first character of
# the order priority ('1'..'5').
SHIPPING_MODES = {"1": "Same Day", "2": "First Class", "3": "Second Class",
                  "4": "Standard Class", "5": "Standard Class"}
DAYS_SCHEDULED = {"1": 0, "2": 1, "3": 2, "4": 4, "5": 4}

# Place-name words with accents. The last four hold letters
# outside ISO-8859-1 and turn lossy ('?') when written in that encoding; two
# of them to the same text.
ACCENTED_WORDS = ["Belém", "Açaí", "Jürgen", "Niño", "Mâcol", "Dėvė", "Brașa", "Doğa", "Dęvę"]


def _by_priority(mapping: dict, col: Column) -> Column:
    first = F.substring(col, 1, 1)
    expr = None
    for k, v in mapping.items():
        expr = F.when(first == k, F.lit(v)) if expr is None else expr.when(first == k, F.lit(v))
    return expr


def city_of(custkey: Column) -> Column:
    """City name keyed by customer: null for every 50th, TOWN_<k div 70> for
    every other 7th (so the number of cities grows with the customers), else
    CITY_<k mod 40>."""
    town = F.concat(F.lit("TOWN_"), F.floor(custkey / 70).cast("string"))
    return F.when(custkey % 50 == 0, F.lit(None).cast("string")).when(custkey % 7 == 0, town).otherwise(
        F.concat(F.lit("CITY_"), (custkey % 40).cast("string")))


def _nation_region(spark, sf_dir) -> DataFrame:
    n = table(spark, sf_dir, "nation", "n_nationkey", "n_name", "n_regionkey")
    r = table(spark, sf_dir, "region", "r_regionkey", "r_name")
    nr = n.join(checked_broadcast(r), n.n_regionkey == r.r_regionkey).select(
        "n_nationkey", "n_name", "r_name")
    return checked_broadcast(nr)


def order_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The order-item table (materialized once, see :func:`materialized`)."""
    return materialized(spark, sf_dir, "order_items", build_order_items)


def build_order_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The seven-table join that derives the order-item table."""
    li = table(spark, sf_dir, "lineitem", "l_orderkey", "l_partkey", "l_suppkey",
               "l_linenumber", "l_quantity", "l_extendedprice", "l_discount",
               "l_linestatus", "l_shipdate")
    o = table(spark, sf_dir, "orders", "o_orderkey", "o_custkey", "o_orderdate",
              "o_orderpriority")
    c = table(spark, sf_dir, "customer", "c_custkey", "c_nationkey", "c_mktsegment")
    s = table(spark, sf_dir, "supplier", "s_suppkey", "s_nationkey")
    p = table(spark, sf_dir, "part", "p_partkey", "p_type", "p_brand")
    nr = _nation_region(spark, sf_dir)

    orders_c = o.join(c, o.o_custkey == c.c_custkey).select(
        "o_orderkey", "o_orderdate", "c_custkey", "c_nationkey", "c_mktsegment",
        F.substring("o_orderpriority", 1, 1).alias("priority"))
    joined = (li.join(checked_broadcast(s), li.l_suppkey == s.s_suppkey).drop("l_suppkey", "s_suppkey")
              .join(orders_c, li.l_orderkey == orders_c.o_orderkey).drop("o_orderkey")
              .join(p, li.l_partkey == p.p_partkey).drop("l_partkey", "p_partkey")
              .join(nr, F.col("c_nationkey") == nr.n_nationkey))
    price, disc = F.col("l_extendedprice"), F.col("l_discount")
    scheduled = _by_priority(DAYS_SCHEDULED, F.col("priority"))
    days_late = (F.datediff(F.col("l_shipdate"), F.col("o_orderdate")) % 7 + 7) % 7
    return joined.select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_linenumber").alias("line_no"),
        F.col("o_orderdate").alias("order_ts"),
        city_of(F.col("c_custkey")).alias("order_city"),
        F.col("n_name").alias("order_state"),
        F.concat(F.col("r_name"), F.lit("_"),
                 F.when(F.col("n_nationkey") < 13, "A").otherwise("B")).alias("order_region"),
        F.col("r_name").alias("market"),
        F.col("c_mktsegment").alias("customer_segment"),
        _by_priority(SHIPPING_MODES, F.col("priority")).alias("shipping_mode"),
        F.col("p_type").alias("category_name"),
        F.col("p_brand").alias("department_name"),
        F.col("l_linestatus").alias("product_status"),
        F.col("l_quantity").cast("int").alias("order_item_quantity"),
        F.round(price * (1 - disc), 4).alias("order_item_total"),
        F.round(price * (F.lit(0.15) - 2 * disc), 4).alias("order_profit"),
        disc.alias("discount_rate"),
        scheduled.alias("days_scheduled"),
        (F.lit(-60) + (F.col("s_nationkey") * 37) % 121).cast("double").alias("latitude"),
        (F.lit(-180) + (F.col("s_nationkey") * 73) % 360).cast("double").alias("longitude"),
        (days_late > scheduled).cast("int").alias("late_delivery_risk"),
    )


def order_items_nulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``order_items`` with null latitude, NaN longitude and null labels mixed in."""
    df = order_items(spark, sf_dir)
    oid = F.col("order_id")
    return (df.withColumn("latitude", F.when(oid % 97 == 0, F.lit(None).cast("double"))
                          .otherwise(F.col("latitude")))
              .withColumn("longitude", F.when(oid % 89 == 0, F.lit(float("nan")))
                          .otherwise(F.col("longitude")))
              .withColumn("late_delivery_risk", F.when(oid % 101 == 0, F.lit(None).cast("int"))
                          .otherwise(F.col("late_delivery_risk"))))


def gazetteer(spark: SparkSession, sf_dir: str, done_only: bool = False) -> DataFrame:
    """The gazetteer file (materialized once): distinct (city, state) with
    destination coordinates, null for some states. ``done_only``: the part
    resolved by an earlier run (nation keys below 20)."""
    name = "gazetteer_done" if done_only else "gazetteer"
    return materialized(spark, sf_dir, name,
                        lambda sp, d: build_gazetteer(sp, d, done_only=done_only))


def build_gazetteer(spark: SparkSession, sf_dir: str, done_only: bool = False) -> DataFrame:
    """Distinct (city, state) with destination coordinates (null for some states)."""
    c = table(spark, sf_dir, "customer", "c_custkey", "c_nationkey")
    n = table(spark, sf_dir, "nation", "n_nationkey", "n_name")
    if done_only:
        c = c.filter(F.col("c_nationkey") < 20)
    missing = F.col("n_nationkey") % 11 == 6
    nk = F.col("n_nationkey")
    # Coordinates depend on the nation only: attach them to the 25-row nation
    # table before the join, then dedup the narrow (city, state, lat, lon).
    n = n.select(
        "n_nationkey", "n_name",
        F.when(missing, F.lit(None).cast("double"))
         .otherwise((F.lit(-60) + (nk * 53 + 11) % 121).cast("double")).alias("dest_lat"),
        F.when(missing, F.lit(None).cast("double"))
         .otherwise((F.lit(-180) + (nk * 97 + 29) % 360).cast("double")).alias("dest_lon"))
    return (c.join(checked_broadcast(n), c.c_nationkey == n.n_nationkey)
             .select(city_of(F.col("c_custkey")).alias("order_city"),
                     F.col("n_name").alias("order_state"), "dest_lat", "dest_lon")
             .distinct())


def geocode_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The geocoder answers table (materialized once)."""
    return materialized(spark, sf_dir, "geocode_candidates", build_geocode_candidates)


def build_geocode_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two or three geocoder answers per gazetteer key, in response order.

    rank 0 is a 'state' hit; rank 1 is a 'city' hit for even nation keys and a
    'street' hit otherwise; even nation keys get a third, 'street', answer.
    Coordinates are the gazetteer's plus the rank; the key (CITY_0, NATION_0)
    answers latitude 0, a real coordinate.
    """
    c = table(spark, sf_dir, "customer", "c_custkey", "c_nationkey")
    n = table(spark, sf_dir, "nation", "n_nationkey", "n_name")
    keys = (c.join(checked_broadcast(n), c.c_nationkey == n.n_nationkey)
             .select(city_of(F.col("c_custkey")).alias("order_city"),
                     F.col("n_name").alias("order_state"), "n_nationkey")
             .distinct())
    nk = F.col("n_nationkey")
    even = nk % 2 == 0
    missing = nk % 11 == 6
    ranked = keys.withColumn(
        "rank", F.explode(F.sequence(F.lit(0), F.when(even, F.lit(2)).otherwise(F.lit(1)))))
    rk = F.col("rank")
    base_lat = (F.lit(-60) + (nk * 53 + 11) % 121).cast("double")
    base_lon = (F.lit(-180) + (nk * 97 + 29) % 360).cast("double")
    zero_key = (F.col("order_city") == "CITY_0") & (nk == 0)
    return ranked.select(
        "order_city", "order_state", rk.alias("rank"),
        F.when(rk == 0, "state").when(even & (rk == 1), "city").otherwise("street").alias("result_type"),
        F.when(missing, F.lit(None).cast("double"))
         .when(zero_key, F.lit(0.0))
         .otherwise(base_lat + rk).alias("lat"),
        F.when(missing, F.lit(None).cast("double")).otherwise(base_lon + rk).alias("lon"),
    )


def predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scored order items: fixed logistic score, prediction = score > 0.5."""
    df = order_items(spark, sf_dir)
    score = fixed_logit(F.col("days_scheduled"), F.col("discount_rate"))
    return df.select("order_id", "line_no", "late_delivery_risk",
                     score.alias("score"),
                     (score > 0.5).cast("double").alias("prediction"))


def city_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The city-name list (materialized once)."""
    return materialized(spark, sf_dir, "city_names", build_city_names)


def build_city_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct accented city names per state (some not representable in Latin-1)."""
    c = table(spark, sf_dir, "customer", "c_custkey", "c_nationkey")
    n = table(spark, sf_dir, "nation", "n_nationkey", "n_name")
    words = F.array(*[F.lit(w) for w in ACCENTED_WORDS])
    ck = F.col("c_custkey")
    city = F.concat(F.element_at(words, (ck % len(ACCENTED_WORDS) + 1).cast("int")),
                    F.lit(" "), (ck % 40).cast("string"))
    return (c.join(checked_broadcast(n), c.c_nationkey == n.n_nationkey)
             .select(city.alias("city"), F.col("n_name").alias("state"))
             .distinct())
