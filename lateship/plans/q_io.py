"""File source and sink queries.

Each writes a table derived from the data to a fresh folder under the
shared checkpoint area, then reads it back with the operator under test.
"""

from __future__ import annotations

from pyspark.sql import functions as F, types as T

from ..operators import geo
from ..schema import to_reference, to_snake
from ..sinks import files as sinks
from ..sinks.versioned import VersionedTable
from ..sources import files as sources
from ..sources.fixtures import city_names, gazetteer, geocode_candidates, order_items
from ..session import shared_dir
from .oracle import with_fixtures
from .registry import query

_LOSSY_SQL = r"regexp_replace(city, '[^\x00-\xFF]', '?', 'g')"


def _latin1_file(spark, sf_dir):
    path = shared_dir(spark, "latin1")
    sinks.write_csv(city_names(spark, sf_dir), path, encoding="ISO-8859-1")
    return path


_CITY_SCHEMA = T.StructType([T.StructField("city", T.StringType()),
                             T.StructField("state", T.StringType())])


@query("scan_csv_latin1", with_fixtures(f"SELECT {_LOSSY_SQL} AS city, state FROM city_names", "city_names"))
def scan_csv_latin1(spark, sf_dir):
    path = _latin1_file(spark, sf_dir)
    return sources.read_csv(spark, path, encoding="ISO-8859-1")


@query("scan_csv_encoding_fallback", with_fixtures(
    f"""SELECT {_LOSSY_SQL} AS city, state FROM city_names
UNION ALL SELECT city, state FROM city_names
UNION ALL SELECT chr(65533) || ' ' || city AS city, state FROM city_names""", "city_names"))
def scan_csv_encoding_fallback(spark, sf_dir):
    """A folder that mixes Latin-1 and UTF-8 files; the UTF-8 ones also hold
    U+FFFD as legitimate text."""
    path = _latin1_file(spark, sf_dir)
    names = city_names(spark, sf_dir)
    sinks.write_csv(names, path, mode="append")
    sinks.write_csv(names.withColumn("city", F.concat(F.lit("\ufffd "), F.col("city"))), path, mode="append")
    return sources.read_csv_fallback(spark, path, _CITY_SCHEMA)


_INFER_COLS = ["shipping_mode", "order_city", "order_item_quantity", "order_item_total"]


@query("scan_csv_inferred", with_fixtures(
    f"SELECT {', '.join(_INFER_COLS)} FROM order_items", "order_items"))
def scan_csv_inferred(spark, sf_dir):
    path = shared_dir(spark, "inferred")
    sinks.write_csv(order_items(spark, sf_dir).select(*_INFER_COLS), path)
    return sources.read_csv(spark, path)


@query("scan_gazetteer", with_fixtures("SELECT * FROM gazetteer", "gazetteer"))
def scan_gazetteer(spark, sf_dir):
    path = shared_dir(spark, "gazetteer")
    g = to_reference(gazetteer(spark, sf_dir)).withColumn("source", F.lit("fixture"))
    sinks.write_csv(g, path)
    return sources.read_gazetteer(spark, path)


_ENRICHED_SCHEMA = T.StructType([
    T.StructField("order_id", T.LongType()), T.StructField("line_no", T.IntegerType()),
    T.StructField("order_city", T.StringType()), T.StructField("order_state", T.StringType()),
    T.StructField("dest_lat", T.DoubleType()), T.StructField("dest_lon", T.DoubleType()),
    T.StructField("distance_km", T.DoubleType())])


@query("sink_csv_roundtrip", with_fixtures("""
SELECT order_id, line_no, order_city, order_state, dest_lat, dest_lon,
       round(distance_km, 3) AS distance_km FROM enriched""", "enriched"))
def sink_csv_roundtrip(spark, sf_dir):
    from .q_geo import enriched
    path = shared_dir(spark, "enriched-csv")
    e = enriched(spark, sf_dir).select(*[f.name for f in _ENRICHED_SCHEMA.fields])
    sinks.write_csv(e, path)
    back = sources.read_csv(spark, path, _ENRICHED_SCHEMA)
    return back.withColumn("distance_km", F.round("distance_km", 3))


@query("sink_csv_latin1", with_fixtures(f"""
SELECT {_LOSSY_SQL} AS city, state, regexp_matches(city, '[^\\x00-\\xFF]') AS lossy FROM city_names""",
    "city_names"))
def sink_csv_latin1(spark, sf_dir):
    names = city_names(spark, sf_dir)
    path = shared_dir(spark, "latin1-sink")
    report = sinks.write_csv_latin1(names.withColumn("lossy", F.col("city").rlike(sinks.LATIN1_OUTSIDE)),
                                    path, ["city", "state"])
    if report.filter("column_name = 'state'").first()["lossy_rows"] != 0:
        raise AssertionError("state names are not Latin-1")
    schema = T.StructType(_CITY_SCHEMA.fields + [T.StructField("lossy", T.BooleanType())])
    return sources.read_csv(spark, path, schema, encoding="ISO-8859-1")


@query("sink_gazetteer_append", with_fixtures("""
SELECT order_city, order_state, dest_lat, dest_lon FROM gazetteer_done
UNION ALL
SELECT k.order_city, k.order_state, p.dest_lat, p.dest_lon
FROM (SELECT DISTINCT order_city, order_state FROM order_items) k
LEFT JOIN picked p ON k.order_city IS NOT DISTINCT FROM p.order_city
                  AND k.order_state IS NOT DISTINCT FROM p.order_state
WHERE NOT EXISTS (SELECT 1 FROM gazetteer_done d
                  WHERE d.order_city IS NOT DISTINCT FROM k.order_city
                    AND d.order_state IS NOT DISTINCT FROM k.order_state)""",
    "order_items", "gazetteer_done", "geocode_candidates", extra="""
picked AS (
SELECT order_city, order_state,
       CASE WHEN lat IS NOT NULL AND lon IS NOT NULL THEN lat END AS dest_lat,
       CASE WHEN lat IS NOT NULL AND lon IS NOT NULL THEN lon END AS dest_lon
FROM (SELECT *, row_number() OVER (PARTITION BY order_city, order_state
          ORDER BY CASE WHEN result_type = 'city' THEN 0 ELSE 1 END, rank) AS rn
      FROM geocode_candidates) WHERE rn = 1)"""))
def sink_gazetteer_append(spark, sf_dir):
    """First run writes the done part; the resumed run reads the folder,
    resolves only what is missing and appends it."""
    path = shared_dir(spark, "gazetteer-append")
    sinks.append_csv(to_reference(gazetteer(spark, sf_dir, done_only=True)), path)
    done = sources.read_gazetteer(spark, path)
    keys = order_items(spark, sf_dir).select("order_city", "order_state").distinct()
    todo = geo.pending_keys(keys, done)
    picked = geo.pick_candidate(geocode_candidates(spark, sf_dir))
    new = geo.geo_join_nullsafe(todo, picked)
    sinks.append_csv(to_reference(new.select("order_city", "order_state", "dest_lat", "dest_lon")), path)
    return sources.read_gazetteer(spark, path)


_RETRIED = """
SELECT order_city, order_state, dest_lat, dest_lon FROM gazetteer_done d
WHERE d.dest_lat IS NOT NULL AND d.dest_lon IS NOT NULL
UNION ALL
SELECT k.order_city, k.order_state, p.dest_lat, p.dest_lon
FROM (SELECT DISTINCT order_city, order_state FROM order_items) k
LEFT JOIN picked p ON k.order_city IS NOT DISTINCT FROM p.order_city
                  AND k.order_state IS NOT DISTINCT FROM p.order_state
WHERE NOT EXISTS (SELECT 1 FROM gazetteer_done d
                  WHERE d.order_city IS NOT DISTINCT FROM k.order_city
                    AND d.order_state IS NOT DISTINCT FROM k.order_state
                    AND d.dest_lat IS NOT NULL AND d.dest_lon IS NOT NULL)"""
_PICKED = """
picked AS (
SELECT order_city, order_state,
       CASE WHEN lat IS NOT NULL AND lon IS NOT NULL THEN lat END AS dest_lat,
       CASE WHEN lat IS NOT NULL AND lon IS NOT NULL THEN lon END AS dest_lon
FROM (SELECT *, row_number() OVER (PARTITION BY order_city, order_state
          ORDER BY CASE WHEN result_type = 'city' THEN 0 ELSE 1 END, rank) AS rn
      FROM geocode_candidates) WHERE rn = 1)"""


@query("sink_gazetteer_append_retry", with_fixtures(
    _RETRIED, "order_items", "gazetteer_done", "geocode_candidates", extra=_PICKED))
def sink_gazetteer_append_retry(spark, sf_dir):
    """The resumed run also retries failed keys and appends their answers;
    reading the folder with unique keys gives one row per key."""
    path = shared_dir(spark, "gazetteer-retry")
    sinks.append_csv(to_reference(gazetteer(spark, sf_dir, done_only=True)), path)
    done = sources.read_gazetteer(spark, path)
    keys = order_items(spark, sf_dir).select("order_city", "order_state").distinct()
    todo = geo.pending_keys(keys, done, retry_failed=True)
    new = geo.geo_join_nullsafe(todo, geo.pick_candidate(geocode_candidates(spark, sf_dir)))
    sinks.append_csv(to_reference(new.select("order_city", "order_state", "dest_lat", "dest_lon")), path)
    return sources.read_gazetteer(spark, path, unique=True)


@query("sink_gazetteer_versions", with_fixtures(
    f"""SELECT *, 1 AS rows_on_disk, 2 AS version FROM ({_RETRIED}
UNION ALL
SELECT order_city, order_state, dest_lat, dest_lon FROM gazetteer_done d
WHERE (d.dest_lat IS NULL OR d.dest_lon IS NULL)
  AND NOT EXISTS (SELECT 1 FROM order_items k WHERE k.order_city IS NOT DISTINCT FROM d.order_city
                  AND k.order_state IS NOT DISTINCT FROM d.order_state))""", "order_items", "gazetteer_done", "geocode_candidates", extra=_PICKED))
def sink_gazetteer_versions(spark, sf_dir):
    """The resumable gazetteer as a versioned table: a run that is killed
    while it writes, its repetition, and a repetition after it had finished
    leave one row a key on disk."""
    store = VersionedTable(spark, shared_dir(spark, "gazetteer-versions"))
    store.append(gazetteer(spark, sf_dir, done_only=True).select(*geo.GAZ_COLS), "first")
    keys = order_items(spark, sf_dir).select("order_city", "order_state").distinct()
    cands = geocode_candidates(spark, sf_dir)

    def resolved(done):
        return geo.incremental_gazetteer(done, keys, cands, retry_failed=True)

    def killed(rows, key_cols):
        half = F.pmod(F.xxhash64(*key_cols), F.lit(2)) == 0
        whole = geo.dedup_gazetteer(rows, key_cols)
        return whole.withColumn("dest_lat", F.when(half, F.raise_error(F.lit("killed half way"))).otherwise(F.col("dest_lat")))

    try:  # the write itself dies, with some of its rows written
        VersionedTable(spark, store.path, reduce=killed).append(resolved, "second")
    except Exception as e:  # noqa: BLE001  the write is meant to fail
        if "killed half way" not in str(e):
            raise
    else:
        raise AssertionError("the killed run finished")
    store.append(resolved, "second")
    v = store.append(resolved, "second")
    on_disk = spark.read.parquet(f"{store.path}/data/{v.folder}").groupBy(*geo.GEO_KEYS).agg(F.count(F.lit(1)).cast("int").alias("rows_on_disk"))
    rows = store.read()
    same = [rows[k].eqNullSafe(on_disk[k]) for k in geo.GEO_KEYS]
    return rows.join(on_disk, same).select(*[rows[c] for c in geo.GAZ_COLS], "rows_on_disk", F.lit(v.number).alias("version"))


_DOC_SCHEMA = T.StructType([
    T.StructField("timestamp", T.TimestampNTZType()), T.StructField("Order City", T.StringType()),
    T.StructField("Order Region", T.StringType()), T.StructField("Order Item Total", T.DoubleType()),
    T.StructField("prediction", T.DoubleType())])


@query("sink_json_documents", with_fixtures("""
SELECT order_ts AS "timestamp", order_city, order_region, order_item_total,
       CAST(order_item_quantity * 0 AS DOUBLE) AS prediction FROM order_items""", "order_items"))
def sink_json_documents(spark, sf_dir):
    from ..functions.expr import zero_score
    items = order_items(spark, sf_dir)
    docs = items.select(F.col("order_ts").alias("timestamp"),
                        F.col("order_city").alias("Order City"),
                        F.col("order_region").alias("Order Region"),
                        F.col("order_item_total").alias("Order Item Total"),
                        zero_score("order_item_quantity").alias("prediction"))
    path = shared_dir(spark, "documents")
    sinks.write_json_documents(docs, path, mode="overwrite")
    return to_snake(spark.read.schema(_DOC_SCHEMA).json(path))


@query("repair_lossy_city_names", with_fixtures(f"""
SELECT l.city AS lossy_city, l.state,
       CASE WHEN count(DISTINCT c.city) = 1 THEN min(c.city) ELSE l.city END AS repaired_city,
       count(DISTINCT c.city) AS candidates
FROM (SELECT DISTINCT {_LOSSY_SQL} AS city, state FROM city_names
      UNION SELECT DISTINCT {_LOSSY_SQL} || ' Nova', state FROM city_names) l
LEFT JOIN city_names c
  ON c.state = l.state AND regexp_replace(c.city, '[^\\x00-\\xFF]', '?', 'g') = l.city
WHERE l.city LIKE '%?%'
GROUP BY l.city, l.state""", "city_names"))
def repair_lossy_city_names(spark, sf_dir):
    from ..operators.text import latin1_lossy_form, repair_lossy_names
    names = city_names(spark, sf_dir)
    lossy = names.select(latin1_lossy_form(F.col("city")).alias("city"), "state").distinct()
    # names that no reference name explains, beside those that one or two do
    unknown = lossy.withColumn("city", F.concat("city", F.lit(" Nova")))
    return repair_lossy_names(lossy.unionByName(unknown), names)
