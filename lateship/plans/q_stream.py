"""Streaming queries (S5, T1-T9, W7): each runs a Structured Streaming query
with the ``availableNow`` trigger over event files derived from the data,
then reads its sink back as a batch table."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import geo
from ..session import shared_dir
from ..sinks.versioned import VersionedTable
from ..sources.events import write_event_files
from ..sources.fixtures import _still_there, gazetteer
from ..sources.lines import rotating_lines
from ..streaming import job
from .oracle import with_fixtures
from .registry import query

_EVENTS: dict = {}


def events_dir(spark, sf_dir):
    key = (spark.sparkContext.applicationId, sf_dir)
    if key in _EVENTS and not _still_there(_EVENTS[key]):
        del _EVENTS[key]
    if key not in _EVENTS:
        _EVENTS[key] = write_event_files(spark, sf_dir, shared_dir(spark, "events"),
                                         records_per_file=100_000)
    return _EVENTS[key]


#: Micro-batches of a run over stored events.
BATCHES = 8


def _files(spark, folder) -> int:
    """Number of data files in ``folder``."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    found = path.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(path)
    return sum(not f.getPath().getName().startswith(("_", ".")) for f in found)


def _lines(spark, sf_dir):
    """All events, in up to ``BATCHES`` micro-batches of 4 files (400k events)
    or more. Each micro-batch broadcasts the gazetteer anew, which grows with
    the events too: batches of a fixed size would send it ever more often."""
    folder = events_dir(spark, sf_dir)
    return job.line_source(spark, folder, max_files_per_trigger=max(4, -(-_files(spark, folder) // BATCHES)))


def _run(spark, df, name):
    out, ckpt = shared_dir(spark, f"{name}-out"), shared_dir(spark, f"{name}-ckpt")
    job.run_available_now(df, ckpt, out, options={"compression": "zstd"})
    return spark.read.parquet(out)


@query("stream_text_source", with_fixtures("SELECT value FROM event_lines", "event_lines"))
def stream_text_source(spark, sf_dir):
    return _run(spark, _lines(spark, sf_dir), "text")


_PARSED_COLS = ["order_date", "order_city", "order_state", "customer_segment", "shipping_mode",
                "market", "order_region", "category_name", "department_name", "product_status",
                "order_item_quantity", "order_item_total", "order_profit", "discount_rate",
                "latitude", "longitude", "days_scheduled"]


@query("stream_json_parse", with_fixtures("SELECT * FROM events_parsed", "events_parsed"))
def stream_json_parse(spark, sf_dir):
    parsed = job.parse_orders(_lines(spark, sf_dir), with_ingest_ts=False)
    return _run(spark, parsed, "parse").select(*_PARSED_COLS)


@query("json_parse_flatten", with_fixtures("SELECT * FROM events_parsed", "events_parsed"))
def json_parse_flatten(spark, sf_dir):
    """The same parsing over a batch table of lines."""
    lines = spark.read.text(events_dir(spark, sf_dir))
    return job.parse_orders(lines, with_ingest_ts=False).select(*_PARSED_COLS)


@query("stream_static_join", with_fixtures("""
SELECT e.order_date, e.order_city, e.order_state, e.order_item_total, g.dest_lat, g.dest_lon
FROM events_parsed e LEFT JOIN gazetteer g
  ON e.order_city = g.order_city AND e.order_state = g.order_state""", "events_parsed", "gazetteer"))
def stream_static_join(spark, sf_dir):
    parsed = job.parse_orders(_lines(spark, sf_dir), with_ingest_ts=False)
    joined = job.join_gazetteer(parsed, gazetteer(spark, sf_dir))
    return _run(spark, joined.select("order_date", "order_city", "order_state", "order_item_total",
                                     "dest_lat", "dest_lon"), "join")


@query("stream_fallback_score", with_fixtures("""
SELECT order_city, order_region, order_item_total,
       CAST(order_item_quantity * 0 AS DOUBLE) AS prediction FROM events_parsed""", "events_parsed"))
def stream_fallback_score(spark, sf_dir):
    parsed = job.parse_orders(_lines(spark, sf_dir), with_ingest_ts=False)
    scored = job.score_orders(parsed, job.Scoring("zero"))
    return _run(spark, scored.select("order_city", "order_region", "order_item_total", "prediction"),
                "fallback")


_FIXED = "round(1 / (1 + exp(-(1.5 + (-0.9) * days_scheduled + 2.0 * discount_rate))), 6)"


@query("stream_score_fixed", with_fixtures(f"""
SELECT e.order_date, e.order_city, e.order_state,
       coalesce(g.dest_lat, 0) AS dest_lat, coalesce(g.dest_lon, 0) AS dest_lon,
       {_FIXED} AS score, CAST({_FIXED} > 0.5 AS DOUBLE) AS prediction
FROM events_parsed e LEFT JOIN gazetteer g
  ON e.order_city = g.order_city AND e.order_state = g.order_state""", "events_parsed", "gazetteer"))
def stream_score_fixed(spark, sf_dir):
    parsed = job.parse_orders(_lines(spark, sf_dir), with_ingest_ts=False)
    joined = job.join_gazetteer(parsed, gazetteer(spark, sf_dir))
    scored = job.score_orders(joined, job.Scoring("fixed", fill_zero_coords=True))
    return _run(spark, scored.select("order_date", "order_city", "order_state", "dest_lat", "dest_lon",
                                     "score", "prediction"), "fixed")


@query("stream_score_model", with_fixtures("""
SELECT order_region, count(*) AS n, true AS same FROM events_parsed GROUP BY order_region""", "events_parsed"))
def stream_score_model(spark, sf_dir):
    """Score the stream with the saved and reloaded best pipeline; the
    distance feature is computed in the stream before ``transform``. Per
    region: the number of events, and whether the batch scores of the same
    events add up to the same."""
    from ..ml import train as T
    from .q_models import fitted
    r = fitted(spark, sf_dir, "Logistic Regression")
    model = T.load_model(T.save_model(r.model, shared_dir(spark, "stream-model"), r.name))
    scoring, gaz = job.Scoring("model", model=model), gazetteer(spark, sf_dir)
    streamed = _run(spark, job.scoring_stream(_lines(spark, sf_dir), gaz, scoring), "model")
    orders = job.parse_orders(spark.read.text(events_dir(spark, sf_dir)))
    batch = job.final_columns(job.score_orders(job.join_gazetteer(orders, gaz), scoring))

    def sums(df):
        return df.groupBy("order_region").agg(F.count(F.lit(1)).alias("n"), F.sum("prediction").alias("late"))

    b = sums(batch).withColumnsRenamed({"order_region": "r", "n": "bn", "late": "bl"})
    return sums(streamed).join(b, F.col("order_region").eqNullSafe(F.col("r")), "left").select(
        "order_region", "n", F.coalesce((F.col("n") == F.col("bn")) & F.col("late").eqNullSafe(F.col("bl")), F.lit(False)).alias("same"))


_DUAL_DOCUMENT = ("timestamp timestamp, `Order City` string, `Order Region` string, "
                  "`Order Item Total` double, prediction double")
_E2E = f"""
SELECT e.order_city, e.order_region, e.order_item_total,
       CAST({_FIXED} > 0.5 AS DOUBLE) AS prediction, true AS has_timestamp
FROM events_parsed e LEFT JOIN gazetteer g
  ON e.order_city = g.order_city AND e.order_state = g.order_state"""


@query("stream_end_to_end", with_fixtures(_E2E, "events_parsed", "gazetteer"))
def stream_end_to_end(spark, sf_dir):
    stream = job.scoring_stream(_lines(spark, sf_dir), gazetteer(spark, sf_dir), job.Scoring("fixed"))
    out = _run(spark, stream, "e2e")
    return out.select("order_city", "order_region", "order_item_total", "prediction",
                      F.col("ingest_ts").isNotNull().alias("has_timestamp"))


_DUAL = (_E2E.replace("e.order_city,", "e.order_city AS city,", 1)
         .replace("e.order_region,", "e.order_region AS region,")
         .replace("e.order_item_total,", "e.order_item_total AS amount,"))


@query("stream_foreach_batch_dual", with_fixtures(
    f"SELECT *, 'relational' AS target FROM ({_DUAL}) UNION ALL SELECT *, 'documents' AS target FROM ({_DUAL})",
    "events_parsed", "gazetteer"))
def stream_foreach_batch_dual(spark, sf_dir):
    stream = job.scoring_stream(_lines(spark, sf_dir), gazetteer(spark, sf_dir), job.Scoring("fixed"))
    rel, docs, ckpt = (shared_dir(spark, "relational"), shared_dir(spark, "docs"),
                       shared_dir(spark, "dual-ckpt"))
    job.run_available_now(stream, ckpt, foreach_batch=job.dual_sink(rel, docs, documents_options={"compression": "gzip"}))
    a = spark.read.parquet(rel).select("city", "region", "amount", "prediction",
                                       F.col("timestamp").isNotNull().alias("has_timestamp"), F.lit("relational").alias("target"))
    d = spark.read.schema(_DUAL_DOCUMENT).json(docs)
    b = d.select(F.col("Order City").alias("city"), F.col("Order Region").alias("region"), F.col("Order Item Total").alias("amount"),
                 "prediction", F.col("timestamp").isNotNull().alias("has_timestamp"), F.lit("documents").alias("target"))
    return a.unionByName(b)


@query("stream_rotating_lines", with_fixtures("SELECT value FROM event_lines", "event_lines"))
def stream_rotating_lines(spark, sf_dir):
    """The lines of growing files by byte offsets; a second run from the same
    checkpoint adds nothing."""
    out, ckpt = shared_dir(spark, "rotating-out"), shared_dir(spark, "rotating-ckpt")
    for _ in range(2):
        job.run_available_now(rotating_lines(spark, events_dir(spark, sf_dir), pattern="part-*", splitBytes=4 << 20), ckpt, out,
                              options={"compression": "zstd"})
    return spark.read.parquet(out)


_EVEN = "coalesce(order_item_quantity % 2 = 0, false)"


@query("stream_refreshed_gazetteer", with_fixtures(f"""
SELECT e.order_date, e.order_city, e.order_state, e.order_item_total, g.dest_lat, g.dest_lon, 0 AS round
FROM events_parsed e LEFT JOIN gazetteer_done g ON e.order_city = g.order_city AND e.order_state = g.order_state WHERE {_EVEN}
UNION ALL
SELECT e.order_date, e.order_city, e.order_state, e.order_item_total, g.dest_lat, g.dest_lon, 1 AS round
FROM events_parsed e LEFT JOIN gazetteer g ON e.order_city = g.order_city AND e.order_state = g.order_state WHERE NOT {_EVEN}""",
    "events_parsed", "gazetteer", "gazetteer_done"))
def stream_refreshed_gazetteer(spark, sf_dir):
    """One running query. Orders of even quantity come first, in one
    micro-batch, and are joined with the gazetteer as far as it is done; after
    that batch the rest of the gazetteer is appended, and the second batch
    sees it. The micro-batches are files, older ones first: as many as hold
    the even orders; the others are written to no more files than that."""
    store = VersionedTable(spark, shared_dir(spark, "refresh-gazetteer"))
    store.append(gazetteer(spark, sf_dir, done_only=True).select(*geo.GAZ_COLS), "done")
    lines = spark.read.text(events_dir(spark, sf_dir))
    quantity = F.from_json("value", "`Order Item Quantity` int")["Order Item Quantity"]
    even = F.coalesce(quantity % 2 == 0, F.lit(False))
    source, out = shared_dir(spark, "refresh-events"), shared_dir(spark, "refresh-out")

    def write(part, mode):
        part.write.mode(mode).option("compression", "gzip").option("zlib.compress.level", "BEST_SPEED").text(source)

    write(lines.where(even), "overwrite")
    first = _files(spark, source)
    write(lines.where(~even).coalesce(first), "append")

    def then(joined, batch_id):
        (joined.select("order_date", "order_city", "order_state", "order_item_total", "dest_lat", "dest_lon")
         .write.mode("overwrite").option("compression", "zstd").parquet(f"{out}/batch={batch_id}"))
        store.append(gazetteer(spark, sf_dir).select(*geo.GAZ_COLS), "rest")

    stream = job.parse_orders(job.line_source(spark, source, max_files_per_trigger=first), with_ingest_ts=False)
    job.run_available_now(stream, shared_dir(spark, "refresh-ckpt"), foreach_batch=job.refreshing_join(store, then))
    return spark.read.parquet(out).withColumnRenamed("batch", "round")


_REPLAYED = " UNION ALL ".join(f"SELECT *, '{t}' AS target FROM ({_DUAL})" for t in ("file format", "connector"))


@query("stream_replay_connector", with_fixtures(_REPLAYED, "events_parsed", "gazetteer"))
def stream_replay_connector(spark, sf_dir):
    """Every micro-batch is written twice, as a replay would, to a file format
    and through a connector that can only append: each row is stored once."""
    stream = job.scoring_stream(_lines(spark, sf_dir), gazetteer(spark, sf_dir), job.Scoring("fixed"))
    files, connected, ledger = shared_dir(spark, "replay-files"), shared_dir(spark, "replay-connector"), shared_dir(spark, "replay-ledger")
    # a source named by its class is any connector to the sink: it appends
    connector = "org.apache.spark.sql.execution.datasources.parquet.ParquetFileFormat"
    options = {"compression": "zstd"}
    sinks = [job.dual_sink(documents_path=files, documents_format="parquet", documents_options=options),
             job.dual_sink(documents_path=connected, documents_format=connector, documents_options=options, ledger_path=ledger)]

    def twice(batch, batch_id):
        for _ in range(2):
            for s in sinks:
                s(batch, batch_id)

    job.run_available_now(stream, shared_dir(spark, "replay-ckpt"), foreach_batch=twice)
    parts = [spark.read.parquet(path).select(
        F.col("Order City").alias("city"), F.col("Order Region").alias("region"), F.col("Order Item Total").alias("amount"), "prediction",
        F.col("timestamp").isNotNull().alias("has_timestamp"), F.lit(target).alias("target"))
        for path, target in ((files, "file format"), (connected, "connector"))]
    return parts[0].unionByName(parts[1])
