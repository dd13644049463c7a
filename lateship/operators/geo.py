"""Geo enrichment: gazetteer joins, candidate choice, incremental gazetteer.

The gazetteer is a dimension keyed by (city, state). Every join reduces it to
one row per key first, so a repeated key never multiplies order rows. It is
broadcast only after a size check (:func:`checked_broadcast`); past the bound
the joins are shuffle joins that AQE can re-plan, and its skew-join handling
splits a hot key on the order-item side. On the plain joins, rows with a null
key match nothing and are spread over the partitions by a salt.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from ..functions.geo import haversine_km
from ..schema import GEO_KEYS
from .joins import BROADCAST_MAX_BYTES, checked_broadcast, null_safe_condition

GAZ_COLS = ["order_city", "order_state", "dest_lat", "dest_lon"]


def _renamed_keys(g: DataFrame, keys: list[str]) -> tuple[DataFrame, list[str]]:
    alias = [f"__g_{k}" for k in keys]
    for k, a in zip(keys, alias):
        g = g.withColumnRenamed(k, a)
    return g, alias


def geo_join_nullsafe(items: DataFrame, gaz: DataFrame, keys: list[str] = GEO_KEYS,
                      broadcast_max_bytes: int = BROADCAST_MAX_BYTES) -> DataFrame:
    """Left join on the keys with null-safe equality; keys kept once, and one
    row of ``gaz`` per key (:func:`dedup_gazetteer`).

    A null city matches a gazetteer row with a null city. Catalyst plans the
    ``<=>`` keys as an equi-join (coalesce + isnull key pairs), so this is a
    hash join, not a nested loop.
    """
    g, alias = _renamed_keys(dedup_gazetteer(gaz, keys), keys)
    g = checked_broadcast(g, broadcast_max_bytes)
    cond = null_safe_condition(items, g, keys, alias)
    return items.join(g, cond, "left").drop(*alias)


NULL_SALTS = 1 << 16


def geo_join_using(items: DataFrame, gaz: DataFrame, keys: list[str] = GEO_KEYS,
                   broadcast_max_bytes: int = BROADCAST_MAX_BYTES) -> DataFrame:
    """Left join with plain equality (``USING``): null keys never match.

    One row of ``gaz`` per key is used. Rows with a null key carry a salt from
    the hash of the row as a further join key, so that on the shuffle path
    they go to all partitions instead of one; the gazetteer's salt matches
    only rows whose keys are complete.
    """
    some_null = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    salt = F.when(some_null, F.pmod(F.xxhash64(*items.columns), F.lit(NULL_SALTS))).otherwise(F.lit(-1)).cast("long")
    g = checked_broadcast(dedup_gazetteer(gaz, keys).withColumn("__salt", F.lit(-1).cast("long")), broadcast_max_bytes)
    return items.withColumn("__salt", salt).join(g, [*keys, "__salt"], "left").drop("__salt")


def pending_keys(keys: DataFrame, done: DataFrame, retry_failed: bool = False,
                 key_cols: list[str] = GEO_KEYS) -> DataFrame:
    """Keys not yet in the gazetteer (null-safe anti join).

    A key resolved with null coordinates counts as done, as in the reference;
    ``retry_failed=True`` lets such keys through again.
    """
    if retry_failed:
        done = done.filter(F.col("dest_lat").isNotNull() & F.col("dest_lon").isNotNull())
    d, alias = _renamed_keys(done.select(*key_cols).distinct(), key_cols)
    return keys.join(d, null_safe_condition(keys, d, key_cols, alias), "left_anti")


def dedup_gazetteer(gaz: DataFrame, key_cols: list[str] = GEO_KEYS) -> DataFrame:
    """One row per key: a row with coordinates first, then the smallest
    (dest_lat, dest_lon, other columns). An aggregate (partial on the map
    side), not a window, so a key with many rows never lands whole in one
    task."""
    rest = [c for c in gaz.columns if c not in key_cols]
    coords = [c for c in ("dest_lat", "dest_lon") if c in rest]
    if not rest:
        return gaz.distinct()
    complete = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in coords or rest[:1]])
    ordered = coords + [c for c in rest if c not in coords]
    best = F.min(F.struct(F.when(complete, 0).otherwise(1).alias("m"), *[F.col(c) for c in ordered])).alias("b")
    return gaz.groupBy(*key_cols).agg(best).select(*key_cols, *[F.col(f"b.{c}").alias(c) for c in rest])


def pick_candidate(cands: DataFrame, key_cols: list[str] = GEO_KEYS) -> DataFrame:
    """Per key: the first 'city' answer in response order, else the first
    answer; its coordinates if both are present (a 0 is a coordinate),
    else null. ``min(struct(...))`` keeps it a partial aggregate."""
    not_city = F.when(F.col("result_type") == "city", 0).otherwise(1)
    best = F.min(F.struct(not_city.alias("nc"), F.col("rank").alias("r"),
                          F.col("lat").alias("lat"), F.col("lon").alias("lon"))).alias("b")
    ok = F.col("b.lat").isNotNull() & F.col("b.lon").isNotNull()
    return cands.groupBy(*key_cols).agg(best).select(
        *key_cols,
        F.when(ok, F.col("b.lat")).alias("dest_lat"),
        F.when(ok, F.col("b.lon")).alias("dest_lon"))


def append_rows(existing: DataFrame, new_rows: DataFrame) -> DataFrame:
    """Append by column name (order of columns may differ)."""
    return existing.unionByName(new_rows)


def incremental_gazetteer(done: DataFrame, keys: DataFrame, cands: DataFrame,
                          retry_failed: bool = False) -> DataFrame:
    """Pending keys -> resolve against the candidates -> append.

    A pending key without any candidate is recorded with null coordinates,
    so the next run does not ask again (unless ``retry_failed``). With
    ``retry_failed`` the failed rows being retried are replaced, not
    duplicated.
    """
    todo = pending_keys(keys.select(*GEO_KEYS).distinct(), done, retry_failed)
    picked, alias = _renamed_keys(pick_candidate(cands), GEO_KEYS)
    resolved = (todo.join(picked, null_safe_condition(todo, picked, GEO_KEYS, alias), "left")
                    .select(*GEO_KEYS, "dest_lat", "dest_lon"))
    kept = done.select(*GAZ_COLS)
    if retry_failed:
        kept = kept.filter(F.col("dest_lat").isNotNull() & F.col("dest_lon").isNotNull())
    return append_rows(kept, resolved)


def with_distance(df: DataFrame, out: str = "distance_km") -> DataFrame:
    """Distance from the destination to the item's own coordinates."""
    return df.withColumn(out, haversine_km("dest_lat", "dest_lon", "latitude", "longitude"))


def enrich_with_distance(items: DataFrame, gaz: DataFrame) -> DataFrame:
    """Null-safe gazetteer join, then great-circle distance, in one plan."""
    return with_distance(geo_join_nullsafe(items, gaz))
