"""Column names, types and the fixed event schema.

The reference works on CSV headers with spaces ("Order City"); inside this
package every column is snake_case. The maps below rename at the edges.
"""

from __future__ import annotations

from pyspark.sql import types as T

# JSON field names and types of one order event, in the order
# the stream schema declares them (reference names, spaces included).
EVENT_FIELDS = [
    ("order_date", T.StringType()),
    ("Order City", T.StringType()),
    ("Order State", T.StringType()),
    ("Customer Segment", T.StringType()),
    ("Shipping Mode", T.StringType()),
    ("Market", T.StringType()),
    ("Order Region", T.StringType()),
    ("Category Name", T.StringType()),
    ("Department Name", T.StringType()),
    ("Product Status", T.StringType()),
    ("Order Item Quantity", T.IntegerType()),
    ("Order Item Total", T.DoubleType()),
    ("Order Profit Per Order", T.DoubleType()),
    ("Order Item Discount Rate", T.DoubleType()),
    ("Latitude", T.DoubleType()),
    ("Longitude", T.DoubleType()),
    ("Days for shipment (scheduled)", T.IntegerType()),
]

EVENT_SCHEMA = T.StructType([T.StructField(n, t, True) for n, t in EVENT_FIELDS])

# CSV header -> our column name.
REFERENCE_TO_SNAKE = {
    "order_date": "order_ts",
    "order date (DateOrders)": "order_ts",
    "Order Id": "order_id",
    "Order Item Id": "line_no",
    "Order City": "order_city",
    "Order State": "order_state",
    "Customer Segment": "customer_segment",
    "Shipping Mode": "shipping_mode",
    "Market": "market",
    "Order Region": "order_region",
    "Category Name": "category_name",
    "Department Name": "department_name",
    "Product Status": "product_status",
    "Order Item Quantity": "order_item_quantity",
    "Order Item Total": "order_item_total",
    "Order Profit Per Order": "order_profit",
    "Order Item Discount Rate": "discount_rate",
    "Latitude": "latitude",
    "Longitude": "longitude",
    "Days for shipment (scheduled)": "days_scheduled",
    "Dest_Lat": "dest_lat",
    "Dest_Lon": "dest_lon",
    "distance": "distance_km",
    "Late_delivery_risk": "late_delivery_risk",
}

# The 16 columns of the profiling projection, in the reference's order.
MODEL_COLUMNS = [
    "late_delivery_risk", "days_scheduled", "order_ts", "shipping_mode",
    "market", "order_region", "latitude", "longitude", "category_name",
    "department_name", "order_item_quantity", "product_status",
    "customer_segment", "order_item_total", "order_profit", "discount_rate",
]

# Numeric columns shown as box plots by the reference.
NUMERIC_COLUMNS = [
    "days_scheduled", "latitude", "longitude", "order_item_quantity",
    "order_item_total", "order_profit", "discount_rate", "dest_lat",
    "dest_lon", "distance_km",
]

# Columns profiled for distinct values.
PROFILE_COLUMNS = [
    "market", "late_delivery_risk", "category_name", "customer_segment",
    "shipping_mode",
]

# Training features of the current pipeline, and the older layout that the
# saved logistic-regression / random-forest artifacts were built with.
CATEGORICAL_FEATURES = ["shipping_mode", "order_region", "order_state"]
NUMERIC_FEATURES = ["latitude", "longitude", "distance_km"]
LEGACY_CATEGORICAL_FEATURES = ["shipping_mode", "market", "order_region",
                               "customer_segment", "category_name"]
LEGACY_NUMERIC_FEATURES = ["days_scheduled", "order_item_quantity",
                           "order_item_total", "discount_rate", "latitude"]
LABEL = "late_delivery_risk"
GEO_KEYS = ["order_city", "order_state"]


def to_snake(df):
    """Rename reference-style headers to our names (unknown names kept)."""
    for name in df.columns:
        new = REFERENCE_TO_SNAKE.get(name)
        if new and new != name:
            df = df.withColumnRenamed(name, new)
    return df


def to_reference(df):
    """Rename our columns back to the reference headers (first match wins)."""
    back = {}
    for ref, snake in REFERENCE_TO_SNAKE.items():
        back.setdefault(snake, ref)
    for name in df.columns:
        if name in back:
            df = df.withColumnRenamed(name, back[name])
    return df
