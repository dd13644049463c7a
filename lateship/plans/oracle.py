"""DuckDB SQL for the fixtures and the helper that prefixes them to a query.

Each oracle query in the catalogue is written against the same derived
tables as the Spark side (``order_items``, ``gazetteer``, ...). The CTEs here
re-derive them from the base views so DuckDB checks Spark independently.
"""

from __future__ import annotations

CTES: dict[str, str] = {}

CTES["order_items"] = """
order_items AS (
  SELECT l.l_orderkey AS order_id,
         l.l_linenumber AS line_no,
         o.o_orderdate AS order_ts,
         CASE WHEN c.c_custkey % 50 = 0 THEN NULL
              WHEN c.c_custkey % 7 = 0 THEN 'TOWN_' || CAST(c.c_custkey // 70 AS VARCHAR)
              ELSE 'CITY_' || CAST(c.c_custkey % 40 AS VARCHAR) END AS order_city,
         n.n_name AS order_state,
         r.r_name || '_' || CASE WHEN n.n_nationkey < 13 THEN 'A' ELSE 'B' END AS order_region,
         r.r_name AS market,
         c.c_mktsegment AS customer_segment,
         CASE substr(o.o_orderpriority, 1, 1) WHEN '1' THEN 'Same Day'
              WHEN '2' THEN 'First Class' WHEN '3' THEN 'Second Class'
              WHEN '4' THEN 'Standard Class' WHEN '5' THEN 'Standard Class' END AS shipping_mode,
         p.p_type AS category_name,
         p.p_brand AS department_name,
         l.l_linestatus AS product_status,
         CAST(l.l_quantity AS INTEGER) AS order_item_quantity,
         round(l.l_extendedprice * (1 - l.l_discount), 4) AS order_item_total,
         round(l.l_extendedprice * (0.15 - 2 * l.l_discount), 4) AS order_profit,
         l.l_discount AS discount_rate,
         CASE substr(o.o_orderpriority, 1, 1) WHEN '1' THEN 0 WHEN '2' THEN 1
              WHEN '3' THEN 2 WHEN '4' THEN 4 WHEN '5' THEN 4 END AS days_scheduled,
         CAST(-60 + (s.s_nationkey * 37) % 121 AS DOUBLE) AS latitude,
         CAST(-180 + (s.s_nationkey * 73) % 360 AS DOUBLE) AS longitude,
         CAST(((date_diff('day', o.o_orderdate, l.l_shipdate) % 7 + 7) % 7) >
              CASE substr(o.o_orderpriority, 1, 1) WHEN '1' THEN 0 WHEN '2' THEN 1
                   WHEN '3' THEN 2 WHEN '4' THEN 4 WHEN '5' THEN 4 END AS INTEGER)
           AS late_delivery_risk
  FROM lineitem l
  JOIN orders o ON l.l_orderkey = o.o_orderkey
  JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN nation n ON c.c_nationkey = n.n_nationkey
  JOIN region r ON n.n_regionkey = r.r_regionkey
  JOIN part p ON l.l_partkey = p.p_partkey
  JOIN supplier s ON l.l_suppkey = s.s_suppkey
)"""

CTES["order_items_nulls"] = """
order_items_nulls AS (
  SELECT * REPLACE (
    CASE WHEN order_id % 97 = 0 THEN NULL ELSE latitude END AS latitude,
    CASE WHEN order_id % 89 = 0 THEN CAST('NaN' AS DOUBLE) ELSE longitude END AS longitude,
    CASE WHEN order_id % 101 = 0 THEN NULL ELSE late_delivery_risk END AS late_delivery_risk)
  FROM order_items
)"""

_GAZ_BODY = """
  SELECT DISTINCT
         CASE WHEN c.c_custkey % 50 = 0 THEN NULL
              WHEN c.c_custkey % 7 = 0 THEN 'TOWN_' || CAST(c.c_custkey // 70 AS VARCHAR)
              ELSE 'CITY_' || CAST(c.c_custkey % 40 AS VARCHAR) END AS order_city,
         n.n_name AS order_state,
         CASE WHEN n.n_nationkey % 11 = 6 THEN NULL
              ELSE CAST(-60 + (n.n_nationkey * 53 + 11) % 121 AS DOUBLE) END AS dest_lat,
         CASE WHEN n.n_nationkey % 11 = 6 THEN NULL
              ELSE CAST(-180 + (n.n_nationkey * 97 + 29) % 360 AS DOUBLE) END AS dest_lon
  FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey"""

CTES["gazetteer"] = f"gazetteer AS ({_GAZ_BODY}\n)"
CTES["gazetteer_done"] = f"gazetteer_done AS ({_GAZ_BODY}\n  WHERE c.c_nationkey < 20\n)"

CTES["geocode_candidates"] = """
geocode_keys AS (
  SELECT DISTINCT
         CASE WHEN c.c_custkey % 50 = 0 THEN NULL
              WHEN c.c_custkey % 7 = 0 THEN 'TOWN_' || CAST(c.c_custkey // 70 AS VARCHAR)
              ELSE 'CITY_' || CAST(c.c_custkey % 40 AS VARCHAR) END AS order_city,
         n.n_name AS order_state, n.n_nationkey
  FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey
),
geocode_candidates AS (
  SELECT k.order_city, k.order_state, CAST(g.rank AS INTEGER) AS rank,
         CASE WHEN g.rank = 0 THEN 'state'
              WHEN k.n_nationkey % 2 = 0 AND g.rank = 1 THEN 'city'
              ELSE 'street' END AS result_type,
         CASE WHEN k.n_nationkey % 11 = 6 THEN NULL
              WHEN k.order_city = 'CITY_0' AND k.n_nationkey = 0 THEN 0.0
              ELSE CAST(-60 + (k.n_nationkey * 53 + 11) % 121 AS DOUBLE) + g.rank END AS lat,
         CASE WHEN k.n_nationkey % 11 = 6 THEN NULL
              ELSE CAST(-180 + (k.n_nationkey * 97 + 29) % 360 AS DOUBLE) + g.rank END AS lon
  FROM geocode_keys k,
       LATERAL (SELECT unnest(range(0, CASE WHEN k.n_nationkey % 2 = 0 THEN 3 ELSE 2 END)) AS rank) g
)"""

CTES["predictions"] = """
predictions AS (
  SELECT order_id, line_no, late_delivery_risk,
         round(1 / (1 + exp(-(1.5 + (-0.9) * days_scheduled + 2.0 * discount_rate))), 6) AS score,
         CAST(round(1 / (1 + exp(-(1.5 + (-0.9) * days_scheduled + 2.0 * discount_rate))), 6) > 0.5
              AS DOUBLE) AS prediction
  FROM order_items
)"""

CTES["city_names"] = """
city_names AS (
  SELECT DISTINCT
         list_extract(['Belém', 'Açaí', 'Jürgen', 'Niño', 'Mâcol', 'Dėvė', 'Brașa', 'Doğa', 'Dęvę'],
                      CAST(c.c_custkey % 9 + 1 AS INTEGER)) || ' ' || CAST(c.c_custkey % 40 AS VARCHAR) AS city,
         n.n_name AS state
  FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey
)"""


def _enriched(name: str, items: str) -> str:
    return f"""
{name} AS (
  SELECT * EXCLUDE (a),
         2 * 6371.0 * asin(sqrt(CASE WHEN a IS NULL OR isnan(a) THEN a ELSE least(1.0, a) END)) AS distance_km
  FROM (
    SELECT o.*, g.dest_lat, g.dest_lon,
           pow(sin((radians(o.latitude) - radians(g.dest_lat)) / 2), 2)
           + cos(radians(g.dest_lat)) * cos(radians(o.latitude))
             * pow(sin((radians(o.longitude) - radians(g.dest_lon)) / 2), 2) AS a
    FROM {items} o
    LEFT JOIN gazetteer g
      ON o.order_city IS NOT DISTINCT FROM g.order_city
     AND o.order_state IS NOT DISTINCT FROM g.order_state
  )
)"""


CTES["enriched"] = _enriched("enriched", "order_items")
CTES["enriched_nulls"] = _enriched("enriched_nulls", "order_items_nulls")
CTES["model_input"] = """
model_input AS (
  SELECT order_id, line_no, latitude, longitude, distance_km,
         shipping_mode, order_region, order_state, late_delivery_risk
  FROM enriched_nulls WHERE late_delivery_risk IS NOT NULL
)"""

# Which fixtures each fixture needs (emitted in this order).
DEPENDS = {
    "order_items_nulls": ["order_items"],
    "predictions": ["order_items"],
    "enriched": ["order_items", "gazetteer"],
    "enriched_nulls": ["order_items_nulls", "gazetteer"],
    "model_input": ["enriched_nulls"],
}
ORDER = ["order_items", "order_items_nulls", "gazetteer", "gazetteer_done",
         "geocode_candidates", "predictions", "city_names", "enriched",
         "enriched_nulls", "model_input"]


def with_fixtures(body: str, *names: str, extra: str = "") -> str:
    """``WITH <needed fixture CTEs>[, extra] <body>``."""
    need: set[str] = set()

    def add(n):
        for d in DEPENDS.get(n, []):
            add(d)
        need.add(n)

    for n in names:
        add(n)
    parts = [CTES[n].strip() for n in ORDER if n in need]
    if extra:
        parts.append(extra.strip())
    return "WITH " + ",\n".join(parts) + "\n" + body.strip()


_EVENT_COLS = ["order_date", "order_city", "order_state", "customer_segment", "shipping_mode",
               "market", "order_region", "category_name", "department_name", "product_status",
               "order_item_quantity", "order_item_total", "order_profit", "discount_rate",
               "latitude", "longitude", "days_scheduled"]


def _event_row(values: dict, source: str) -> str:
    return "SELECT " + ", ".join(f"{values.get(c, 'NULL')} AS {c}" for c in _EVENT_COLS) + f" FROM {source}"


CTES["events_parsed"] = "events_parsed AS (\n" + "\nUNION ALL\n".join([
    _event_row({c: c for c in _EVENT_COLS} | {
        "order_date": "strftime(order_ts, '%Y-%m-%d %H:%M:%S')"}, "order_items"),
    _event_row({"order_date": "'2001-01-01 00:00:00'",
                "order_city": "'CITY_' || CAST(n_nationkey AS VARCHAR)",
                "customer_segment": "'Consumer'", "shipping_mode": "'Standard Class'",
                "order_item_quantity": "n_nationkey",
                "order_item_total": "CAST(n_nationkey * 1.5 AS DOUBLE)",
                "order_profit": "1.0", "latitude": "CAST(n_nationkey AS DOUBLE)",
                "longitude": "CAST(-n_nationkey AS DOUBLE)"}, "nation"),
    _event_row({"order_city": "n_name"}, "nation"),
    _event_row({"order_city": "n_name"}, "nation"),
    _event_row({}, "region, (VALUES (1), (2)) t(i)"),
]) + "\n)"
DEPENDS["events_parsed"] = ["order_items"]
ORDER.append("events_parsed")


def _event_json_good() -> str:
    """One JSON object per order item, nulls omitted, fields in schema order."""
    from ..schema import EVENT_FIELDS, REFERENCE_TO_SNAKE
    parts = []
    for ref, _ in EVENT_FIELDS:
        snake = REFERENCE_TO_SNAKE[ref]
        src = "strftime(order_ts, '%Y-%m-%d %H:%M:%S')" if snake == "order_ts" else snake
        parts.append(f"""CASE WHEN {src} IS NOT NULL THEN '"{ref}":' || to_json({src}) END""")
    return "SELECT '{' || concat_ws(',', " + ", ".join(parts) + ") || '}' AS value FROM order_items"


CTES["event_lines"] = "event_lines AS (\n" + "\nUNION ALL\n".join([
    _event_json_good(),
    """SELECT '{"order_date":"2001-01-01 00:00:00","Order City":"CITY_' || CAST(n_nationkey AS VARCHAR)
       || '","Shipping Mode":"Standard Class","Customer Segment":"Consumer","Order Item Quantity":'
       || CAST(n_nationkey AS VARCHAR) || ',"Order Item Total":'
       || CAST(CAST(n_nationkey * 1.5 AS DECIMAL(10, 1)) AS VARCHAR)
       || ',"Order Profit Per Order":1.0,"Latitude":' || to_json(CAST(n_nationkey AS DOUBLE))
       || ',"Longitude":' || to_json(CAST(-n_nationkey AS DOUBLE)) || '}' FROM nation""",
    """SELECT '{"Order City":"' || n_name || '","Order Item Quantity":"many"}' FROM nation""",
    """SELECT '{"Order City":"' || n_name || '","Order Item Quantity":3.5}' FROM nation""",
    "SELECT 'not json: ' || r_name FROM region",
    "SELECT '{}' FROM region",
]) + "\n)"
DEPENDS["event_lines"] = ["order_items"]
ORDER.append("event_lines")
