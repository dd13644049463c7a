"""Relational sink over JDBC.

Columns are renamed to the table layout (timestamp, city, region, amount,
prediction) plus ``batch_id``. Each executor writes its partitions through
its own connection (``numPartitions`` caps concurrent connections). The
table is created by Spark on first append. An append by several connections
is not one transaction, so a replayed micro-batch may find rows of its first
try: a caller that can delete passes ``delete_first``, which is given the
writer and batch id and must remove their rows before the append.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

# Column names of the relational prediction table.
RELATIONAL_COLUMNS = {"ingest_ts": "timestamp", "order_city": "city",
                      "order_region": "region", "order_item_total": "amount",
                      "prediction": "prediction"}


def to_relational(df: DataFrame, batch_id: int | None = None) -> DataFrame:
    out = df.select(*[F.col(src).alias(dst) for src, dst in RELATIONAL_COLUMNS.items()])
    if batch_id is not None:
        out = out.withColumn("batch_id", F.lit(batch_id).cast("long"))
    return out


def write_jdbc(df: DataFrame, url: str, table: str, properties: dict | None = None,
               num_partitions: int = 8, replaces: tuple | None = None, delete_first=None) -> None:
    """Append ``df`` to ``table``; credentials come from ``properties``.

    ``replaces``: the (writer id, batch id) of the rows, handed to
    ``delete_first(url, table, properties, writer_id, batch_id)`` if given."""
    props = dict(properties or {})
    if delete_first is not None and replaces is not None:
        delete_first(url, table, props, *replaces)
    props.setdefault("numPartitions", str(num_partitions))
    df.write.jdbc(url=url, table=table, mode="append", properties=props)
