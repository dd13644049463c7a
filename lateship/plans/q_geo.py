"""Geo enrichment queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import geo
from ..sources.fixtures import gazetteer, geocode_candidates, order_items
from .oracle import with_fixtures
from .registry import query

_KEYS = ["order_id", "line_no", "order_city", "order_state", "dest_lat", "dest_lon"]


def enriched(spark, sf_dir):
    return geo.enrich_with_distance(order_items(spark, sf_dir), gazetteer(spark, sf_dir))


@query("geo_join_nullsafe", with_fixtures("""
SELECT o.order_id, o.line_no, o.order_city, o.order_state, g.dest_lat, g.dest_lon
FROM order_items o LEFT JOIN gazetteer g
  ON o.order_city IS NOT DISTINCT FROM g.order_city
 AND o.order_state IS NOT DISTINCT FROM g.order_state""", "order_items", "gazetteer"))
def geo_join_nullsafe(spark, sf_dir):
    return geo.geo_join_nullsafe(order_items(spark, sf_dir), gazetteer(spark, sf_dir)).select(*_KEYS)


@query("geo_join_using", with_fixtures("""
SELECT o.order_id, o.line_no, o.order_city, o.order_state, g.dest_lat, g.dest_lon
FROM order_items o LEFT JOIN gazetteer g
  ON o.order_city = g.order_city AND o.order_state = g.order_state""", "order_items", "gazetteer"))
def geo_join_using(spark, sf_dir):
    return geo.geo_join_using(order_items(spark, sf_dir), gazetteer(spark, sf_dir)).select(*_KEYS)


@query("filter_geocoded", with_fixtures(
    "SELECT * FROM gazetteer WHERE dest_lat IS NOT NULL", "gazetteer"))
def filter_geocoded(spark, sf_dir):
    return gazetteer(spark, sf_dir).filter(F.col("dest_lat").isNotNull())


_PENDING = """
SELECT k.order_city, k.order_state
FROM (SELECT DISTINCT order_city, order_state FROM order_items) k
WHERE NOT EXISTS (SELECT 1 FROM gazetteer_done d
                  WHERE d.order_city IS NOT DISTINCT FROM k.order_city
                    AND d.order_state IS NOT DISTINCT FROM k.order_state {extra})"""


@query("geo_pending_keys", with_fixtures(_PENDING.format(extra=""), "order_items", "gazetteer_done"))
def geo_pending_keys(spark, sf_dir):
    keys = order_items(spark, sf_dir).select("order_city", "order_state").distinct()
    return geo.pending_keys(keys, gazetteer(spark, sf_dir, done_only=True))


@query("geo_pending_keys_retry", with_fixtures(
    _PENDING.format(extra="AND d.dest_lat IS NOT NULL AND d.dest_lon IS NOT NULL"),
    "order_items", "gazetteer_done"))
def geo_pending_keys_retry(spark, sf_dir):
    keys = order_items(spark, sf_dir).select("order_city", "order_state").distinct()
    return geo.pending_keys(keys, gazetteer(spark, sf_dir, done_only=True), retry_failed=True)


def _gazetteer_with_repeats(spark, sf_dir):
    """Gazetteer plus every candidate answer as another row for its key."""
    cands = geocode_candidates(spark, sf_dir).select(
        "order_city", "order_state", F.col("lat").alias("dest_lat"), F.col("lon").alias("dest_lon"))
    return gazetteer(spark, sf_dir).unionByName(cands)


@query("geo_dedup_gazetteer", with_fixtures("""
SELECT order_city, order_state, dest_lat, dest_lon FROM (
  SELECT *, row_number() OVER (PARTITION BY order_city, order_state
      ORDER BY CASE WHEN dest_lat IS NOT NULL AND dest_lon IS NOT NULL THEN 0 ELSE 1 END,
               dest_lat NULLS FIRST, dest_lon NULLS FIRST) AS rn
  FROM (SELECT * FROM gazetteer
        UNION ALL SELECT order_city, order_state, lat, lon FROM geocode_candidates) u
) WHERE rn = 1""", "gazetteer", "geocode_candidates"))
def geo_dedup_gazetteer(spark, sf_dir):
    return geo.dedup_gazetteer(_gazetteer_with_repeats(spark, sf_dir))


_PICK = """
SELECT order_city, order_state,
       CASE WHEN lat IS NOT NULL AND lon IS NOT NULL THEN lat END AS dest_lat,
       CASE WHEN lat IS NOT NULL AND lon IS NOT NULL THEN lon END AS dest_lon
FROM (
  SELECT *, row_number() OVER (PARTITION BY order_city, order_state
      ORDER BY CASE WHEN result_type = 'city' THEN 0 ELSE 1 END, rank) AS rn
  FROM geocode_candidates
) WHERE rn = 1"""


@query("geocode_pick_candidate", with_fixtures(_PICK, "geocode_candidates"))
def geocode_pick_candidate(spark, sf_dir):
    return geo.pick_candidate(geocode_candidates(spark, sf_dir))


_INCREMENTAL = """
SELECT order_city, order_state, dest_lat, dest_lon FROM gazetteer_done
UNION ALL
SELECT k.order_city, k.order_state, p.dest_lat, p.dest_lon
FROM (SELECT DISTINCT order_city, order_state FROM order_items) k
LEFT JOIN picked p ON k.order_city IS NOT DISTINCT FROM p.order_city
                  AND k.order_state IS NOT DISTINCT FROM p.order_state
WHERE NOT EXISTS (SELECT 1 FROM gazetteer_done d
                  WHERE d.order_city IS NOT DISTINCT FROM k.order_city
                    AND d.order_state IS NOT DISTINCT FROM k.order_state)"""


@query("gazetteer_incremental", with_fixtures(
    _INCREMENTAL, "order_items", "gazetteer_done", "geocode_candidates",
    extra="picked AS (" + _PICK + ")"))
def gazetteer_incremental(spark, sf_dir):
    keys = order_items(spark, sf_dir).select("order_city", "order_state")
    return geo.incremental_gazetteer(gazetteer(spark, sf_dir, done_only=True), keys,
                                     geocode_candidates(spark, sf_dir))


@query("gazetteer_union", with_fixtures("""
SELECT order_city, order_state, dest_lat, dest_lon FROM gazetteer_done
UNION ALL
SELECT order_city, order_state, dest_lat, dest_lon FROM gazetteer g
WHERE NOT EXISTS (SELECT 1 FROM gazetteer_done d
                  WHERE d.order_city IS NOT DISTINCT FROM g.order_city
                    AND d.order_state IS NOT DISTINCT FROM g.order_state)""",
    "gazetteer", "gazetteer_done"))
def gazetteer_union(spark, sf_dir):
    done = gazetteer(spark, sf_dir, done_only=True)
    new = gazetteer(spark, sf_dir)
    new = geo.pending_keys(new, done).select("dest_lon", "dest_lat", "order_state", "order_city")
    return geo.append_rows(done, new)


@query("enrich_with_distance", with_fixtures("""
SELECT order_id, line_no, order_city, order_state, dest_lat, dest_lon,
       round(distance_km, 3) AS distance_km
FROM enriched""", "enriched"))
def enrich_with_distance(spark, sf_dir):
    return enriched(spark, sf_dir).select(*_KEYS, F.round("distance_km", 3).alias("distance_km"))


@query("enrich_repeated_keys", with_fixtures("""
SELECT o.order_id, o.line_no, o.order_city, o.order_state, g.dest_lat, g.dest_lon
FROM order_items o LEFT JOIN (
  SELECT order_city, order_state, dest_lat, dest_lon FROM (
    SELECT *, row_number() OVER (PARTITION BY order_city, order_state
        ORDER BY CASE WHEN dest_lat IS NOT NULL AND dest_lon IS NOT NULL THEN 0 ELSE 1 END,
                 dest_lat NULLS FIRST, dest_lon NULLS FIRST) AS rn
    FROM (SELECT * FROM gazetteer
          UNION ALL SELECT order_city, order_state, lat, lon FROM geocode_candidates) u
  ) WHERE rn = 1) g
  ON o.order_city IS NOT DISTINCT FROM g.order_city
 AND o.order_state IS NOT DISTINCT FROM g.order_state""", "order_items", "gazetteer", "geocode_candidates"))
def enrich_repeated_keys(spark, sf_dir):
    """A gazetteer with several rows per key: one row per order item all the same."""
    return geo.enrich_with_distance(order_items(spark, sf_dir), _gazetteer_with_repeats(spark, sf_dir)).select(*_KEYS)


@query("haversine_distance", with_fixtures("""
SELECT DISTINCT latitude, longitude, dest_lat, dest_lon, round(distance_km, 3) AS distance_km
FROM enriched""", "enriched"))
def haversine_distance(spark, sf_dir):
    return (enriched(spark, sf_dir)
            .select("latitude", "longitude", "dest_lat", "dest_lon",
                    F.round("distance_km", 3).alias("distance_km")).distinct())
