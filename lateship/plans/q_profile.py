"""Profiling queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import profile, profile_state, sketch
from ..schema import MODEL_COLUMNS, PROFILE_COLUMNS
from ..session import shared_dir
from ..sources.fixtures import order_items, order_items_nulls
from .oracle import with_fixtures
from .registry import query

_MODEL_COLS_SQL = ", ".join(MODEL_COLUMNS)


@query("shipping_mode_distribution", with_fixtures("""
SELECT shipping_mode, count(*) AS "count" FROM order_items
GROUP BY shipping_mode ORDER BY "count" DESC, shipping_mode NULLS FIRST""", "order_items"))
def shipping_mode_distribution(spark, sf_dir):
    return profile.group_count_desc(order_items(spark, sf_dir), "shipping_mode")


@query("top_k_shipping_modes", with_fixtures("""
SELECT shipping_mode, count(*) AS "count" FROM order_items
GROUP BY shipping_mode ORDER BY "count" DESC, shipping_mode NULLS FIRST LIMIT 3""", "order_items"))
def top_k_shipping_modes(spark, sf_dir):
    return profile.top_k(order_items(spark, sf_dir), "shipping_mode", 3)


@query("row_count", with_fixtures(
    "SELECT count(*) AS row_count FROM order_items", "order_items"))
def row_count(spark, sf_dir):
    return profile.row_count(order_items(spark, sf_dir))


@query("project_model_columns", with_fixtures(
    f"SELECT {_MODEL_COLS_SQL} FROM order_items", "order_items"))
def project_model_columns(spark, sf_dir):
    return order_items(spark, sf_dir).select(*MODEL_COLUMNS)


_distinct_union = "\nUNION\n".join(
    f"SELECT '{c}' AS column_name, CAST({c} AS VARCHAR) AS value FROM order_items"
    for c in PROFILE_COLUMNS)


@query("distinct_values_profile", with_fixtures(_distinct_union, "order_items"))
def distinct_values_profile(spark, sf_dir):
    return profile.distinct_values(order_items(spark, sf_dir), PROFILE_COLUMNS)


@query("distinct_coordinates", with_fixtures(
    "SELECT DISTINCT latitude, longitude FROM order_items", "order_items"))
def distinct_coordinates(spark, sf_dir):
    return profile.distinct_pairs(order_items(spark, sf_dir), "latitude", "longitude")


@query("distinct_city_state", with_fixtures(
    "SELECT DISTINCT order_city, order_state FROM order_items", "order_items"))
def distinct_city_state(spark, sf_dir):
    return profile.distinct_pairs(order_items(spark, sf_dir), "order_city", "order_state")


@query("distinct_city_state_count", with_fixtures(
    "SELECT count(*) AS n_distinct FROM (SELECT DISTINCT order_city, order_state FROM order_items)",
    "order_items"))
def distinct_city_state_count(spark, sf_dir):
    df = profile.distinct_pairs(order_items(spark, sf_dir), "order_city", "order_state")
    return profile.distinct_count(df)


@query("distinct_rows", with_fixtures(
    f"SELECT DISTINCT {_MODEL_COLS_SQL} FROM order_items", "order_items"))
def distinct_rows(spark, sf_dir):
    return order_items(spark, sf_dir).select(*MODEL_COLUMNS).distinct()


@query("duplicate_row_count", with_fixtures(f"""
SELECT CAST(sum(n) AS BIGINT) AS total_rows, count(*) AS distinct_rows,
       CAST(sum(n - 1) AS BIGINT) AS duplicate_rows,
       count(*) - CAST(sum(n) AS BIGINT) AS distinct_minus_total
FROM (SELECT count(*) AS n FROM order_items GROUP BY ALL_PLACEHOLDER)""".replace(
    "ALL_PLACEHOLDER", _MODEL_COLS_SQL), "order_items"))
def duplicate_row_count(spark, sf_dir):
    return profile.duplicate_row_count(order_items(spark, sf_dir).select(*MODEL_COLUMNS))


_GEO_COLS = ["latitude", "longitude", "dest_lat", "dest_lon", "distance_km"]
_completeness_sql = "\nUNION ALL\n".join(
    f"SELECT '{c}' AS column_name, count(*) FILTER (WHERE {c} IS NOT NULL AND NOT isnan({c})) AS non_null, "
    f"count(*) AS total_rows, count(*) - count(*) FILTER (WHERE {c} IS NOT NULL AND NOT isnan({c})) AS missing "
    f"FROM enriched" for c in _GEO_COLS)


@query("geo_completeness", with_fixtures(_completeness_sql, "enriched"))
def geo_completeness(spark, sf_dir):
    from .q_geo import enriched
    return profile.completeness(enriched(spark, sf_dir), _GEO_COLS)


@query("preview_topn", with_fixtures(
    f"SELECT {_MODEL_COLS_SQL} FROM order_items ORDER BY "
    + ", ".join(f"{c} ASC NULLS FIRST" for c in MODEL_COLUMNS) + " LIMIT 20", "order_items"))
def preview_topn(spark, sf_dir):
    return profile.preview(order_items(spark, sf_dir).select(*MODEL_COLUMNS), 20)


_SCHEMA_ROWS = ",\n".join(
    f"({i + 1}, '{c}', '{t}', true, (SELECT count({c}) FROM order_items))"
    for i, (c, t) in enumerate(zip(MODEL_COLUMNS, [
        "int", "int", "timestamp_ntz", "string", "string", "string", "double", "double",
        "string", "string", "int", "string", "string", "double", "double", "double"])))


@query("schema_report", with_fixtures(
    "SELECT * FROM (VALUES " + _SCHEMA_ROWS + ") t(position, column_name, data_type, nullable, non_null)",
    "order_items"))
def schema_report(spark, sf_dir):
    return profile.schema_report(order_items(spark, sf_dir).select(*MODEL_COLUMNS))


_STATE_NUMBERS = ["latitude", "longitude", "order_item_quantity", "discount_rate", "order_item_total"]
_STATE_TEXTS = ["shipping_mode", "order_state", "order_city"]


def _state_sql(c: str, number: bool) -> str:
    has = f"{c} IS NOT NULL" + (f" AND NOT isnan({c})" if number else "")
    f = f"FILTER (WHERE {has})"
    moments = (f"round(min({c}) {f}, 6) AS low, round(max({c}) {f}, 6) AS high, round(avg({c}) {f}, 6) AS mean, round(stddev_samp({c}) {f}, 6) AS std"
               if number else "NULL AS low, NULL AS high, NULL AS mean, NULL AS std")
    top = f"(SELECT {c} FROM order_items_nulls WHERE {c} IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC LIMIT 1)" if c == "shipping_mode" else "NULL"
    return f"""SELECT '{c}' AS column_name, count(*) AS rows, count(*) {f} AS present, count(*) - count(*) {f} AS missing, {moments},
       {top} AS most_frequent, true AS distinct_ok, {"true" if number else "NULL"} AS quantiles_ok FROM order_items_nulls"""


@query("profile_state_merged", with_fixtures("\nUNION ALL\n".join(
    [_state_sql(c, True) for c in _STATE_NUMBERS] + [_state_sql(c, False) for c in _STATE_TEXTS]), "order_items_nulls"))
def profile_state_merged(spark, sf_dir):
    """Profile states of each market, stored, read back and merged: equal to
    the single operators over the whole table. Distinct counts are held
    against the exact ones (3 %), quantiles against their true ranks."""
    df, path = order_items_nulls(spark, sf_dir), shared_dir(spark, "profile-states")
    cols = _STATE_NUMBERS + _STATE_TEXTS
    profile_state.profile_state(df, cols, by=["market"]).write.parquet(f"{path}/states")
    probs = [0.25, 0.5, 0.75]
    report = profile_state.profile_report(profile_state.merged_profile(spark.read.parquet(f"{path}/states")), probs, top=1)
    exact = {r["column_name"]: r["n"] for r in profile.distinct_values(df, cols).where("value IS NOT NULL AND value <> 'NaN'")
             .groupBy("column_name").agg(F.count("*").alias("n")).collect()}  # one row a column
    slack, ok = 2 * sketch.rank_error(), {}
    for r in report.where("mean IS NOT NULL").select("column_name", "q", "present").collect():
        v = sketch.value_column(r["column_name"])
        n = df.agg(*[F.count(F.when(v < q, 1)).alias(f"a{i}") for i, q in enumerate(r["q"])],
                   *[F.count(F.when(v <= q, 1)).alias(f"b{i}") for i, q in enumerate(r["q"])]).first()
        ok[r["column_name"]] = all(n[f"a{i}"] <= (p + slack) * r["present"] + 1 and n[f"b{i}"] >= (p - slack) * r["present"] - 1
                                   for i, p in enumerate(probs))
    held = spark.createDataFrame([(c, exact[c], ok.get(c)) for c in cols], "column_name string, exact long, quantiles_ok boolean")
    top = F.when(F.col("column_name") == "shipping_mode", F.get("top", F.lit(0))["item"])
    return report.join(held, "column_name").select(
        "column_name", "rows", "present", "missing", *[F.round(c, 6).alias(c) for c in ("low", "high", "mean", "std")],
        top.alias("most_frequent"), (F.abs(F.col("n_distinct") - F.col("exact")) <= 0.03 * F.col("exact")).alias("distinct_ok"), "quantiles_ok")
