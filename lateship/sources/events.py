"""Order events as JSON lines, derived from the order items.

Each order item becomes one JSON object under the reference's field names
(the producer's message format). A few malformed lines per nation and
region (partial objects, wrong types, non-JSON text, empty objects) are
added so the parser's permissive behaviour is exercised at every scale.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.expr import format_order_date
from ..schema import EVENT_FIELDS, REFERENCE_TO_SNAKE
from .fixtures import order_items
from .tables import table


def event_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = order_items(spark, sf_dir)
    fields = []
    for ref, _ in EVENT_FIELDS:
        snake = REFERENCE_TO_SNAKE[ref]
        src = format_order_date("order_ts") if snake == "order_ts" else F.col(snake)
        fields.append(src.alias(ref))
    good = items.select(F.to_json(F.struct(*fields)).alias("value"))

    n = table(spark, sf_dir, "nation", "n_nationkey", "n_name")
    nk = F.col("n_nationkey")
    partial = F.to_json(F.struct(
        F.lit("2001-01-01 00:00:00").alias("order_date"),
        F.concat(F.lit("CITY_"), nk.cast("string")).alias("Order City"),
        F.lit("Standard Class").alias("Shipping Mode"),
        F.lit("Consumer").alias("Customer Segment"),
        nk.alias("Order Item Quantity"),
        (nk * 1.5).alias("Order Item Total"),
        F.lit(1.0).alias("Order Profit Per Order"),
        nk.cast("double").alias("Latitude"),
        (-nk).cast("double").alias("Longitude")))
    wrong_type = F.concat(F.lit('{"Order City":"'), F.col("n_name"), F.lit('","Order Item Quantity":"many"}'))
    fractional = F.concat(F.lit('{"Order City":"'), F.col("n_name"), F.lit('","Order Item Quantity":3.5}'))
    bad_n = n.select(F.explode(F.array(partial, wrong_type, fractional)).alias("value"))

    r = table(spark, sf_dir, "region", "r_name")
    bad_r = r.select(F.explode(F.array(F.concat(F.lit("not json: "), F.col("r_name")),
                                       F.lit("{}"))).alias("value"))
    return good.unionByName(bad_n).unionByName(bad_r)


def write_event_files(spark: SparkSession, sf_dir: str, out_dir: str,
                      records_per_file: int = 20000) -> str:
    """Write the lines as gzip text files (several files, for several
    triggers): the field names repeat on each line, so that compressed files
    take about a sixth of the space. The fastest level costs little time."""
    (event_lines(spark, sf_dir).write.mode("overwrite").option("compression", "gzip")
        .option("zlib.compress.level", "BEST_SPEED")
        .option("maxRecordsPerFile", records_per_file).text(out_dir))
    return out_dir
