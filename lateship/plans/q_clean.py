"""Cleaning queries."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from ..functions.expr import format_order_date, parse_order_date, slug
from ..operators import clean, stats
from ..schema import LABEL, NUMERIC_COLUMNS
from ..sources.fixtures import order_items, order_items_nulls
from ..sources.tables import table
from .oracle import with_fixtures
from .registry import query

_ITEM_COLS = ["order_id", "line_no", "order_ts", "order_city", "order_state", "order_region",
              "market", "customer_segment", "shipping_mode", "category_name",
              "department_name", "product_status", "order_item_quantity", "order_item_total",
              "order_profit", "discount_rate", "days_scheduled", "latitude", "longitude",
              "late_delivery_risk"]
_DOUBLE_COLS = {"order_item_total", "order_profit", "discount_rate", "latitude", "longitude"}
_ALL_PRESENT = " AND ".join(
    f"{c} IS NOT NULL" + (f" AND NOT isnan({c})" if c in _DOUBLE_COLS else "") for c in _ITEM_COLS)


@query("clean_drop_nulls", with_fixtures(
    f"SELECT * FROM order_items_nulls WHERE {_ALL_PRESENT}", "order_items_nulls"))
def clean_drop_nulls(spark, sf_dir):
    return clean.drop_incomplete(order_items_nulls(spark, sf_dir))


@query("clean_null_audit", with_fixtures(f"""
SELECT count(*) AS rows_before,
       count(*) FILTER (WHERE {_ALL_PRESENT}) AS rows_after,
       count(*) - count(*) FILTER (WHERE {_ALL_PRESENT}) AS rows_deleted
FROM order_items_nulls""", "order_items_nulls"))
def clean_null_audit(spark, sf_dir):
    return clean.null_audit(order_items_nulls(spark, sf_dir))


@query("drop_null_label", with_fixtures(
    "SELECT * FROM order_items_nulls WHERE late_delivery_risk IS NOT NULL", "order_items_nulls"))
def drop_null_label(spark, sf_dir):
    return clean.drop_null_label(order_items_nulls(spark, sf_dir), LABEL)


@query("fill_missing_coords", with_fixtures("""
SELECT o.order_id, o.line_no, coalesce(g.dest_lat, 0) AS dest_lat, coalesce(g.dest_lon, 0) AS dest_lon
FROM order_items o LEFT JOIN gazetteer g
  ON o.order_city = g.order_city AND o.order_state = g.order_state""", "order_items", "gazetteer"))
def fill_missing_coords(spark, sf_dir):
    from ..operators.geo import geo_join_using
    from ..sources.fixtures import gazetteer
    joined = geo_join_using(order_items(spark, sf_dir), gazetteer(spark, sf_dir))
    return clean.fill_missing(joined, ["dest_lat", "dest_lon"], 0).select(
        "order_id", "line_no", "dest_lat", "dest_lon")


_Q_COLS = ["days_scheduled", "latitude", "longitude", "order_item_quantity",
           "order_item_total", "order_profit", "discount_rate"]
_bounds_sql = "\nUNION ALL\n".join(
    f"SELECT '{c}' AS column_name, CAST(quantile_disc({c}, 0.01) AS DOUBLE) AS p01, "
    f"CAST(quantile_disc({c}, 0.99) AS DOUBLE) AS p99 FROM order_items" for c in _Q_COLS)


@query("quantile_bounds_exact", with_fixtures(_bounds_sql, "order_items"))
def quantile_bounds_exact(spark, sf_dir):
    q = stats.exact_quantiles(order_items(spark, sf_dir), _Q_COLS, [0.01, 0.99], "disc")
    return q.groupBy("column_name").agg(
        F.max(F.when(F.col("p") == 0.01, F.col("value"))).alias("p01"),
        F.max(F.when(F.col("p") == 0.99, F.col("value"))).alias("p99"))


_box_sql = "\nUNION ALL\n".join(f"""
SELECT '{c}' AS column_name, {c} AS value, q1, median, q3, q3 - q1 AS iqr,
       q1 - 1.5 * (q3 - q1) AS lo_fence, q3 + 1.5 * (q3 - q1) AS hi_fence
FROM enriched, (SELECT quantile_cont({c}, 0.25) AS q1, quantile_cont({c}, 0.5) AS median,
                       quantile_cont({c}, 0.75) AS q3 FROM enriched WHERE {c} IS NOT NULL AND NOT isnan({c}))
WHERE {c} IS NOT NULL AND NOT isnan({c})""" for c in NUMERIC_COLUMNS)
_box_body = f"""
SELECT column_name, round(q1, 6) AS q1, round(median, 6) AS median, round(q3, 6) AS q3,
       round(iqr, 6) AS iqr, count(*) AS n,
       round(min(value), 6) AS min_value, round(max(value), 6) AS max_value,
       round(min(value) FILTER (WHERE value >= lo_fence AND value <= hi_fence), 6) AS lower_whisker,
       round(max(value) FILTER (WHERE value >= lo_fence AND value <= hi_fence), 6) AS upper_whisker,
       count(*) FILTER (WHERE NOT (value >= lo_fence AND value <= hi_fence)) AS n_outliers
FROM ({_box_sql}) GROUP BY column_name, q1, median, q3, iqr"""


@query("boxplot_stats", with_fixtures(_box_body, "enriched"))
def boxplot_stats(spark, sf_dir):
    from .q_geo import enriched
    b = stats.boxplot_stats(enriched(spark, sf_dir), NUMERIC_COLUMNS)
    r = ["q1", "median", "q3", "iqr", "min_value", "max_value", "lower_whisker", "upper_whisker"]
    return b.select("column_name", *[F.round(c, 6).alias(c) for c in r],
                    F.col("n").cast("long").alias("n"), F.col("n_outliers").cast("long").alias("n_outliers"))


def _clamp_sql(c):
    return (f"CASE WHEN {c} < b.lo_{c} THEN b.lo_{c} WHEN {c} > b.hi_{c} THEN b.hi_{c} "
            f"ELSE CAST({c} AS DOUBLE) END AS {c}")


def _winsor_sql(cols):
    bounds = ", ".join(f"CAST(quantile_disc({c}, 0.01) AS DOUBLE) AS lo_{c}, "
                       f"CAST(quantile_disc({c}, 0.99) AS DOUBLE) AS hi_{c}" for c in cols)
    sel = ", ".join(_clamp_sql(c) for c in cols)
    return with_fixtures(f"SELECT order_id, line_no, {sel} FROM order_items, "
                         f"(SELECT {bounds} FROM order_items) b", "order_items")


@query("winsorize_column", _winsor_sql(["order_item_total"]))
def winsorize_column(spark, sf_dir):
    df = order_items(spark, sf_dir)
    return clean.winsorize_column(df, "order_item_total", exact=True).select(
        "order_id", "line_no", "order_item_total")


_W_COLS = ["order_item_total", "order_profit", "order_item_quantity", "discount_rate"]


@query("winsorize_columns", _winsor_sql(_W_COLS))
def winsorize_columns(spark, sf_dir):
    df = order_items(spark, sf_dir)
    return clean.winsorize_columns(df, _W_COLS, exact=True).select("order_id", "line_no", *_W_COLS)


@query("winsorize_columns_approx", with_fixtures("\nUNION ALL\n".join(
    f"SELECT '{c}' AS column_name, count({c}) AS n, true AS low_rank_ok, true AS high_rank_ok, true AS inside FROM order_items"
    for c in _W_COLS), "order_items"))
def winsorize_columns_approx(spark, sf_dir):
    """The reference's own bounds, ``approxQuantile(cols, [0.01, 0.99], 0.001)``
    in one job: per column, the true ranks of both bounds are within the
    error (ties allowed for), and every value of the result within the bounds."""
    df, error = order_items(spark, sf_dir), 0.001
    out = clean.winsorize_columns(df, _W_COLS, exact=False, rel_error=error)
    bounds = stats.quantile_bounds(df, _W_COLS, 0.01, 0.99, exact=False, rel_error=error)
    parts = []
    for c in _W_COLS:
        lo, hi = bounds[c]
        n = F.count(c)
        rank_ok = lambda v, p: (F.count(F.when(F.col(c) < v, 1)) <= (p + error) * n + 1) & (F.count(F.when(F.col(c) <= v, 1)) >= (p - error) * n - 1)  # noqa: E731, B023
        inside = out.agg(F.every(F.col(c).isNull() | F.col(c).between(lo, hi))).first()[0]
        parts.append(df.agg(n.alias("n"), rank_ok(lo, 0.01).alias("low_rank_ok"), rank_ok(hi, 0.99).alias("high_rank_ok"))
                     .select(F.lit(c).alias("column_name"), "*", F.lit(inside).alias("inside")))
    return reduce(DataFrame.unionByName, parts)


@query("sample_hash", with_fixtures("""
SELECT * FROM order_items
WHERE CAST(('0x' || substr(md5(concat_ws('|', '42', CAST(order_id AS VARCHAR), CAST(line_no AS VARCHAR))), 1, 8))
           AS BIGINT) < 0.1 * 4294967296""", "order_items"))
def sample_hash(spark, sf_dir):
    return clean.sample_hash(order_items(spark, sf_dir), 0.1, ["order_id", "line_no"], salt="42")


@query("sample_hash_small", with_fixtures("""
SELECT * FROM order_items
WHERE CAST(('0x' || substr(md5(concat_ws('|', 'small', CAST(order_id AS VARCHAR), CAST(line_no AS VARCHAR))), 1, 8))
           AS BIGINT) < 0.00007 * 4294967296""", "order_items"))
def sample_hash_small(spark, sf_dir):
    """A fraction below one in ten thousand."""
    return clean.sample_hash(order_items(spark, sf_dir), 0.00007, ["order_id", "line_no"], salt="small")


@query("sample_seeded", with_fixtures("""
SELECT count(*) AS rows, true AS size_ok, true AS subset, true AS repeatable FROM order_items""", "order_items"))
def sample_seeded(spark, sf_dir):
    """Spark's seeded sample: its size within five standard deviations, its
    rows a part of the table (each at most as often), and the same when drawn again."""
    df = order_items(spark, sf_dir)
    cols = df.columns
    a, again = clean.sample_seeded(df, 0.1, 42), clean.sample_seeded(df, 0.1, 42)
    tag = lambda d, t: d.select(F.xxhash64(*cols).alias("h")).withColumn("t", F.lit(t))
    per_row = (tag(df, "all").unionByName(tag(a, "a")).unionByName(tag(again, "b"))
               .groupBy("h").agg(*[F.count(F.when(F.col("t") == t, 1)).alias(t) for t in ("all", "a", "b")]))
    n, k = F.sum("all"), F.sum("a")
    return per_row.agg(n.alias("rows"), (F.abs(k - 0.1 * n) <= 5 * F.sqrt(0.09 * n)).alias("size_ok"),
                       F.every(F.col("a") <= F.col("all")).alias("subset"), F.every(F.col("a") == F.col("b")).alias("repeatable"))


@query("order_date_parse", with_fixtures("""
SELECT order_date, try_strptime(order_date, '%Y-%m-%d %H:%M:%S') AS order_ts
FROM (SELECT strftime(order_ts, '%Y-%m-%d %H:%M:%S') AS order_date FROM order_items
      UNION ALL
      SELECT strftime(order_ts, '%Y-%m-%d') || ' 25:00:00' FROM order_items)""",
    "order_items"))
def order_date_parse(spark, sf_dir):
    df = order_items(spark, sf_dir)
    good = df.select(format_order_date("order_ts").alias("order_date"))
    # every row also gets a malformed twin (hour 25): it must parse to null,
    # not fail the job
    bad = df.select(
        F.concat(F.date_format("order_ts", "yyyy-MM-dd"), F.lit(" 25:00:00")).alias("order_date"))
    both = good.unionByName(bad)
    return both.select("order_date", parse_order_date("order_date").cast("timestamp_ntz").alias("order_ts"))


@query("text_slug", """
SELECT o_orderpriority AS label, lower(translate(o_orderpriority, ' -', '__')) AS slug, count(*) AS n
FROM orders GROUP BY o_orderpriority""")
def text_slug(spark, sf_dir):
    o = table(spark, sf_dir, "orders", "o_orderpriority")
    return (o.groupBy(F.col("o_orderpriority").alias("label")).agg(F.count(F.lit(1)).alias("n"))
             .select("label", slug("label").alias("slug"), "n"))
