"""The streaming scoring job: lines -> JSON -> gazetteer -> score -> sinks.

Stateless apart from source offsets: each micro-batch is parsed, joined to
the static gazetteer (broadcast after a size check), scored, and appended.
The checkpoint (under the shared checkpoint folder) makes a restart resume
at the first unfinished batch; the dual sink keys every write by the writing
query and its batch id, so a replayed batch overwrites its own output instead
of duplicating it, and no other query's output is ever touched.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.expr import fixed_logit, zero_score
from ..functions.geo import haversine_km
from ..operators.geo import GAZ_COLS, geo_join_using
from ..schema import EVENT_SCHEMA, REFERENCE_TO_SNAKE
from ..sinks.jdbc import RELATIONAL_COLUMNS, to_relational, write_jdbc
from ..sources.lines import RotatingLines
from ..sinks.ledger import BatchLedger
from ..sinks.versioned import VersionedTable

FINAL_COLUMNS = ["ingest_ts", "order_city", "order_region", "order_item_total", "prediction"]
# Field names of one stored prediction document.
DOCUMENT_NAMES = {"ingest_ts": "timestamp", "order_city": "Order City",
                  "order_region": "Order Region", "order_item_total": "Order Item Total",
                  "prediction": "prediction"}


def line_source(spark: SparkSession, path: str | None = None, fmt: str = "text",
                options: dict | None = None, max_files_per_trigger: int | None = None) -> DataFrame:
    """Unbounded rows of one string column ``value``.

    A text directory by default; ``rotating_lines`` for files that are still
    appended to (:mod:`..sources.lines`); ``socket`` or ``kafka`` (with its
    options) by configuration. Kafka's ``value`` is binary and is cast to
    string.
    """
    if fmt == RotatingLines.name():
        spark.dataSource.register(RotatingLines)
    r = spark.readStream.format(fmt)
    for k, v in (options or {}).items():
        r = r.option(k, v)
    if max_files_per_trigger and fmt == "text":
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    if path and fmt == RotatingLines.name():
        r, path = r.option("path", path), None
    df = r.load(path) if path else r.load()
    return df.select(F.col("value").cast("string").alias("value"))


def parse_orders(lines: DataFrame, with_ingest_ts: bool = True) -> DataFrame:
    """JSON text -> typed columns (permissive: bad text -> nulls), snake names,
    and the processing-time stamp (one value per micro-batch)."""
    data = lines.select(F.from_json("value", EVENT_SCHEMA).alias("data")).select("data.*")
    out = data.select(*[F.col(f"`{f.name}`").alias(REFERENCE_TO_SNAKE[f.name])
                        for f in EVENT_SCHEMA.fields])
    out = out.withColumnRenamed("order_ts", "order_date")
    return out.withColumn("ingest_ts", F.current_timestamp()) if with_ingest_ts else out


def join_gazetteer(orders: DataFrame, gaz: DataFrame | None) -> DataFrame:
    """Stream-static left join on (city, state), plain equality; skipped
    when no gazetteer is configured. Repeated gazetteer keys are reduced to
    one row first, so no order is multiplied; orders without a city or state
    (the producer sends none) match nothing and are spread over all tasks."""
    if gaz is None:
        return orders
    return geo_join_using(orders, gaz)


def fill_missing_coords(df: DataFrame) -> DataFrame:
    missing = [c for c in ("dest_lat", "dest_lon") if c not in df.columns]
    if missing:
        raise ValueError(f"cannot fill coordinates, columns absent: {missing}")
    return df.na.fill(0, subset=["dest_lat", "dest_lon"])


@dataclass
class Scoring:
    """How to score: ``model`` (a fitted pipeline), ``"fixed"`` (the fixed
    logistic score) or ``"zero"`` (quantity x 0). Chosen by configuration;
    a model that cannot score fails loudly instead of falling back."""
    mode: str = "zero"
    model: PipelineModel | None = None
    fill_zero_coords: bool = False


def score_orders(df: DataFrame, scoring: Scoring) -> DataFrame:
    if scoring.fill_zero_coords:
        df = fill_missing_coords(df)
    if scoring.mode == "zero":
        return df.withColumn("prediction", zero_score("order_item_quantity"))
    if scoring.mode == "fixed":
        s = fixed_logit(F.col("days_scheduled"), F.col("discount_rate"))
        return df.withColumn("score", s).withColumn("prediction", (s > 0.5).cast("double"))
    if scoring.mode == "model":
        if scoring.model is None:
            raise ValueError("scoring mode 'model' needs a fitted model")
        if "distance_km" not in df.columns and "dest_lat" in df.columns:
            df = df.withColumn("distance_km",
                               haversine_km("dest_lat", "dest_lon", "latitude", "longitude"))
        keep = df.columns
        return scoring.model.transform(df).select(*keep, F.col("prediction").cast("double"))
    raise ValueError(f"unknown scoring mode {scoring.mode!r}")


def final_columns(df: DataFrame) -> DataFrame:
    return df.select(*FINAL_COLUMNS)


def scoring_stream(lines: DataFrame, gaz: DataFrame | None, scoring: Scoring) -> DataFrame:
    return final_columns(score_orders(join_gazetteer(parse_orders(lines), gaz), scoring))


def to_documents(df: DataFrame) -> DataFrame:
    return df.select(*[F.col(c).alias(DOCUMENT_NAMES[c]) for c in FINAL_COLUMNS])


# Partition folders of the file targets: the date bounds the folders of one
# level, writer and batch identify the output of one micro-batch.
BATCH_KEYS = ["batch_date", "writer_id", "batch_id"]


def _writer_of(batch: DataFrame) -> str:
    """The id of the running streaming query, which its checkpoint keeps
    across restarts."""
    wid = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
    if not wid:
        raise ValueError("dual_sink outside a streaming query needs an explicit writer_id")
    return wid


#: Formats that write folders of files and can replace one partition.
FILE_FORMATS = ("json", "parquet", "orc", "csv")


def dual_sink(relational_path: str | None = None, documents_path: str | None = None,
              jdbc: dict | None = None, writer_id: str | None = None,
              documents_format: str = "json", documents_options: dict | None = None,
              ledger_path: str | None = None, documents_undo=None):
    """``foreachBatch`` function writing each micro-batch to two targets.

    * relational: a JDBC table when ``jdbc`` (url, table, properties) is
      configured, else a Parquet table;
    * documents: JSON objects, another file format, or any connector given by
      ``documents_format`` and ``documents_options`` (appended to).

    File targets are partitioned by date, writer and batch id and overwrite
    only the partitions of their own batch (dynamic partition overwrite): a
    replayed batch replaces its earlier output, and what other queries (batch
    ids start at 0 with every new checkpoint) have written stays. The writer
    is the streaming query's id, or ``writer_id``; the date comes from the
    batch's time stamp, which a replay repeats.

    Other connectors can only append, so they need ``ledger_path``, a shared
    folder that outlives the query: a batch that the ledger has as done is
    skipped on replay. For one that was begun and not finished,
    ``documents_undo(spark, writer_id, batch_id)`` is called first, to take
    back what it may have stored; without it such a batch raises.

    Empty batches are skipped. Errors propagate and stop the query, so the
    batch is retried from the checkpoint rather than silently lost.
    """
    appends = documents_format not in FILE_FORMATS
    if appends and not ledger_path:
        raise ValueError(f"connector {documents_format!r} needs a ledger_path to be safe against replays")
    if documents_format in FILE_FORMATS and documents_format != "json" and not documents_path:
        raise ValueError(f"format {documents_format!r} needs a documents_path")

    def keyed(df: DataFrame, stamp: str, wid: str, batch_id: int) -> DataFrame:
        return df.withColumns({"batch_date": F.to_date(F.col(stamp)), "writer_id": F.lit(wid),
                               "batch_id": F.lit(batch_id).cast("long")})

    def replace_own(df: DataFrame):
        return df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*BATCH_KEYS)

    def append_once(batch: DataFrame, wid: str, batch_id: int) -> None:
        ledger = BatchLedger(batch.sparkSession, ledger_path)
        state = ledger.state(wid, batch_id, "documents")
        if state == "done":
            return
        if state == "begun":
            if documents_undo is None:
                raise RuntimeError(f"batch {batch_id} of {wid} was begun and not finished: its stored documents are unknown")
            documents_undo(batch.sparkSession, wid, batch_id)
        ledger.mark(wid, batch_id, "documents", "begun")
        w = to_documents(batch).write.format(documents_format).mode("append").options(**(documents_options or {}))
        w.save(documents_path) if documents_path else w.save()
        ledger.mark(wid, batch_id, "documents", "done")

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            if batch.isEmpty():
                return
            wid = writer_id or _writer_of(batch)
            if jdbc:
                write_jdbc(to_relational(batch, batch_id).withColumn("writer_id", F.lit(wid)), jdbc["url"], jdbc["table"],
                           jdbc.get("properties"), replaces=(wid, batch_id), delete_first=jdbc.get("delete_first"))
            elif relational_path:
                replace_own(keyed(to_relational(batch), "timestamp", wid, batch_id)).parquet(relational_path)
            if appends:
                append_once(batch, wid, batch_id)
            elif documents_path:
                (replace_own(keyed(to_documents(batch), "timestamp", wid, batch_id)).options(**(documents_options or {}))
                 .format(documents_format).save(documents_path))
        finally:
            batch.unpersist()
    return write


def refreshing_join(table: VersionedTable, then):
    """``foreachBatch`` function for a stream of parsed orders: joins each
    micro-batch with the gazetteer's current version and hands it to
    ``then(joined, batch_id)``.

    The version is looked up once a batch, so rows that were appended to the
    table while the stream runs reach the next batch, and one batch sees one
    version. Before the first version, the coordinates are null.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        now = table.current()
        if now is None:
            joined = batch.withColumns({c: F.lit(None).cast("double") for c in ("dest_lat", "dest_lon")})
        else:
            joined = join_gazetteer(batch, table.read(now).select(*GAZ_COLS))
        then(joined, batch_id)
    return write


def refreshing_scores(table: VersionedTable, scoring: Scoring, sink):
    """:func:`refreshing_join`, then score and hand to ``sink(batch, batch_id)``."""
    return refreshing_join(table, lambda joined, batch_id: sink(final_columns(score_orders(joined, scoring)), batch_id))


def run_available_now(df: DataFrame, checkpoint: str, sink_path: str | None = None,
                      fmt: str = "parquet", foreach_batch=None, timeout_s: float | None = None,
                      options: dict | None = None):
    """Process everything available, then stop (``availableNow`` trigger).
    ``options`` are the sink's, such as its compression.

    With ``timeout_s``, a query that has not finished by then is stopped and
    ``TimeoutError`` raised: a partial result is never returned as a whole one
    (a later run with the same checkpoint goes on where it stopped).
    """
    w = df.writeStream.outputMode("append").option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True)
    if foreach_batch is not None:
        q = w.foreachBatch(foreach_batch).start()
    else:
        q = w.format(fmt).options(**(options or {})).start(sink_path)
    if timeout_s is None:
        q.awaitTermination()
    elif not q.awaitTermination(timeout_s):
        q.stop()
        raise TimeoutError(f"stream not finished after {timeout_s} s")
    if q.exception() is not None:
        raise RuntimeError(f"stream failed: {q.exception()}")
    return q


__all__ = ["line_source", "parse_orders", "join_gazetteer", "fill_missing_coords", "Scoring",
           "score_orders", "final_columns", "scoring_stream", "to_documents", "dual_sink",
           "refreshing_join", "refreshing_scores", "run_available_now", "RELATIONAL_COLUMNS"]
