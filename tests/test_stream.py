import os
import tempfile

import pytest
from pyspark.sql import functions as F

from lateship.session import shared_dir
from lateship.sources.events import write_event_files
from lateship.sources.fixtures import gazetteer
from lateship.streaming import job


@pytest.fixture(scope="module")
def events(spark, sf_dir):
    return write_event_files(spark, sf_dir, shared_dir(spark, "t-events"), records_per_file=1500)


def test_several_batches_constant_ingest_ts_and_restart(spark, sf_dir, events):
    n_files = len([f for f in os.listdir(events.replace("file:", "")) if f.startswith("part-")])
    assert n_files >= 3
    lines = job.line_source(spark, events, max_files_per_trigger=1)
    stream = job.scoring_stream(lines, gazetteer(spark, sf_dir), job.Scoring("fixed"))
    rel, docs, ckpt = shared_dir(spark, "t-rel"), shared_dir(spark, "t-docs"), shared_dir(spark, "t-ckpt")
    q = job.run_available_now(stream, ckpt, foreach_batch=job.dual_sink(rel, docs), timeout_s=300)
    assert q.lastProgress is not None
    out = spark.read.parquet(rel)
    total = out.count()
    assert total == spark.read.text(events).count()
    per_batch = out.groupBy("batch_id").agg(F.countDistinct("timestamp").alias("n")).collect()
    assert len(per_batch) >= 3 and all(r.n == 1 for r in per_batch)  # one stamp per micro-batch
    d = spark.read.json(docs)
    assert d.count() == total
    assert {"timestamp", "Order City", "Order Region", "Order Item Total", "prediction"} <= set(d.columns)
    # restart with the same checkpoint: nothing is processed or written twice
    job.run_available_now(stream, ckpt, foreach_batch=job.dual_sink(rel, docs), timeout_s=300)
    assert spark.read.parquet(rel).count() == total


SCORED = ("ingest_ts timestamp, order_city string, order_region string, "
          "order_item_total double, prediction double")


def test_replayed_batch_overwrites_its_own_output(spark):
    df = spark.createDataFrame([(None, "C", "R", 1.0, 0.0)], SCORED)
    rel, docs = shared_dir(spark, "t-rel2"), shared_dir(spark, "t-docs2")
    w = job.dual_sink(rel, docs, writer_id="a")
    w(df, 7)
    w(df, 7)  # replay
    w(df, 8)
    job.dual_sink(rel, docs, writer_id="b")(df, 7)  # another writer's batch 7
    assert spark.read.parquet(rel).count() == 3
    assert spark.read.json(docs).count() == 3
    with pytest.raises(ValueError):
        job.dual_sink(rel, docs)(df, 7)


def test_two_queries_keep_each_others_output(spark, sf_dir, events):
    """Batch ids restart at 0 with every new checkpoint."""
    stream = job.scoring_stream(job.line_source(spark, events, max_files_per_trigger=2), None, job.Scoring("zero"))
    rel, docs = shared_dir(spark, "t-rel3"), shared_dir(spark, "t-docs3")
    total = spark.read.text(events).count()
    for n in (1, 2):
        job.run_available_now(stream, shared_dir(spark, "t-ckpt3"), foreach_batch=job.dual_sink(rel, docs))
        assert spark.read.parquet(rel).count() == n * total
        assert spark.read.json(docs).count() == n * total


def test_timeout_stops_the_query_and_raises(spark, events):
    import time

    def slow(batch, batch_id):
        time.sleep(5)

    lines = job.line_source(spark, events, max_files_per_trigger=1)
    with pytest.raises(TimeoutError):
        job.run_available_now(lines, shared_dir(spark, "t-ckpt4"), foreach_batch=slow, timeout_s=1)
    assert not spark.streams.active


def test_documents_by_connector(spark):
    df = spark.createDataFrame([(None, "C", "R", 1.0, 0.0)], SCORED)
    path = shared_dir(spark, "t-docs5")
    w = job.dual_sink(documents_path=path, documents_format="parquet", writer_id="a", documents_options={"compression": "gzip"})
    w(df, 1)
    w(df, 1)  # replay: a file format replaces its own batch
    stored = spark.read.parquet(path)
    assert stored.count() == 1
    assert stored.drop(*job.BATCH_KEYS).columns == list(job.DOCUMENT_NAMES.values())


CONNECTOR = "org.apache.spark.sql.execution.datasources.parquet.ParquetFileFormat"  # any source that appends


def test_connector_batches_are_stored_once(spark):
    df = spark.createDataFrame([(None, "C", "R", 1.0, 0.0)], SCORED)
    path, ledger = shared_dir(spark, "t-docs6"), shared_dir(spark, "t-ledger")
    with pytest.raises(ValueError, match="ledger"):
        job.dual_sink(documents_path=path, documents_format=CONNECTOR)
    undone = []
    sink = lambda **kw: job.dual_sink(documents_path=path, documents_format=CONNECTOR, writer_id="a", ledger_path=ledger, **kw)
    for batch in (1, 1, 2):
        sink()(df, batch)
    assert spark.read.parquet(path).count() == 2
    # a write that dies half way leaves "begun": the batch raises, or is taken back first
    w = sink()
    good = job.to_documents
    job.to_documents = lambda b: good(b).withColumn("prediction", F.raise_error(F.lit("died")).cast("double"))
    try:
        with pytest.raises(Exception, match="died"):
            w(df, 3)
    finally:
        job.to_documents = good
    with pytest.raises(RuntimeError, match="not finished"):
        w(df, 3)
    sink(documents_undo=lambda s, writer, batch: undone.append((writer, batch)))(df, 3)
    sink()(df, 3)
    assert undone == [("a", 3)] and spark.read.parquet(path).count() == 3
    from lateship.sinks.ledger import BatchLedger
    book = BatchLedger(spark, ledger)
    book.forget_before("a", 3)
    assert [book.state("a", b, "documents") for b in (1, 2, 3)] == [None, None, "done"]


def test_new_gazetteer_rows_reach_a_running_stream(spark, sf_dir):
    from lateship.operators.geo import GAZ_COLS
    from lateship.sinks.versioned import VersionedTable
    store = VersionedTable(spark, shared_dir(spark, "t-refresh"))
    seen = {}
    orders = spark.createDataFrame([("a", "s", 1), ("b", "s", 1)], "order_city string, order_state string, order_item_quantity int")
    w = job.refreshing_join(store, lambda joined, k: seen.__setitem__(k, {r.order_city: r.dest_lat for r in joined.collect()}))
    schema = "order_city string, order_state string, dest_lat double, dest_lon double"
    w(orders, 0)                                                  # before the first version
    store.append(spark.createDataFrame([("a", "s", 1.0, 2.0)], schema), "r1")
    w(orders, 1)
    store.append(spark.createDataFrame([("b", "s", 3.0, 4.0)], schema), "r2")
    w(orders, 2)
    assert seen == {0: {"a": None, "b": None}, 1: {"a": 1.0, "b": None}, 2: {"a": 1.0, "b": 3.0}}
    assert store.read().columns == GAZ_COLS


def test_empty_batch_is_skipped(spark):
    empty = spark.createDataFrame([], SCORED)
    rel = os.path.join(tempfile.mkdtemp(), "rel")
    job.dual_sink(rel, None)(empty, 0)
    assert not os.path.exists(rel)


def test_await_termination_with_timeout(spark, events):
    lines = job.line_source(spark, events)
    q = lines.writeStream.format("noop").option("checkpointLocation", shared_dir(spark, "t-ck3")).start()
    try:
        assert q.awaitTermination(1) is False  # still running after the timeout
    finally:
        q.stop()


def test_fill_and_model_mode_fail_loudly(spark):
    df = spark.createDataFrame([(1,)], "order_item_quantity int")
    with pytest.raises(ValueError):
        job.fill_missing_coords(df)
    with pytest.raises(ValueError):
        job.score_orders(df, job.Scoring("model"))
    assert job.score_orders(df, job.Scoring("zero")).first().prediction == 0.0


def test_permissive_parse(spark):
    lines = spark.createDataFrame([('{"Order City": "X", "Order Item Quantity": 3.5}',), ("not json",),
                                   ('{"order_date": "2020-01-01 00:00:00", "Order Item Quantity": 2}',)],
                                  "value string")
    rows = job.parse_orders(lines, with_ingest_ts=False).collect()
    assert rows[0].order_city == "X" and rows[0].order_item_quantity is None
    assert all(v is None for v in rows[1])
    assert rows[2].order_item_quantity == 2


def test_event_files_are_compressed(spark, events):
    import gzip
    folder = events.replace("file:", "")
    files = [os.path.join(folder, f) for f in os.listdir(folder) if f.startswith("part-")]
    plain = sum(len(gzip.open(f).read()) for f in files)
    assert 5 * sum(os.path.getsize(f) for f in files) < plain


def test_prepared_rows_are_compressed_well(spark, sf_dir):
    """What many queries write once: the prepared tables and training rows."""
    from lateship.ml import train as T
    from lateship.sources.fixtures import order_items
    rows = order_items(spark, sf_dir)
    small = T.train_and_select(spark.range(400).selectExpr("id", "rand(1) AS x", "cast(id % 2 AS string) AS c", "cast(id % 3 = 0 AS int) AS y"),
                               "Logistic Regression", ["id"], ["x"], ["c"], "y")
    for df in (rows, small.train):
        assert df.inputFiles() and all(f.endswith(".zstd.parquet") for f in df.inputFiles())


def test_replayed_documents_are_compressed_well(spark, sf_dir):
    from lateship.plans import q_stream
    files = q_stream.stream_replay_connector(spark, sf_dir).inputFiles()
    assert files and all(f.endswith(".zstd.parquet") for f in files)


def test_number_of_batches_does_not_grow_with_the_files(spark, monkeypatch):
    from lateship.plans import q_stream
    folder = shared_dir(spark, "t-many")
    spark.range(100).selectExpr("cast(id as string) AS value").repartition(40).write.mode("overwrite").text(folder)
    monkeypatch.setattr(q_stream, "events_dir", lambda spark, sf_dir: folder)
    seen = []
    lines = q_stream._lines(spark, "any")
    job.run_available_now(lines, shared_dir(spark, "t-many-ckpt"), foreach_batch=lambda b, k: seen.append(b.count()))
    assert sum(seen) == 100 and len(seen) == q_stream.BATCHES


def test_refreshed_gazetteer_in_two_batches_of_several_files(spark, monkeypatch):
    """Also with more odd orders than even ones, and with each half in several files."""
    from lateship.plans import q_stream
    from lateship.sources import fixtures
    folder = shared_dir(spark, "t-halves")
    event = F.to_json(F.struct(F.concat(F.lit("C"), F.col("id")).alias("Order City"), F.lit("S").alias("Order State"),
                               F.when(F.col("id") < 40, 2).otherwise(1).alias("Order Item Quantity")))
    spark.range(0, 200, 1, 20).select(event.alias("value")).write.mode("overwrite").text(folder)
    monkeypatch.setattr(q_stream, "events_dir", lambda spark, sf_dir: folder)
    row = "order_city string, order_state string, dest_lat double, dest_lon double"
    done = [(f"C{i}", "S", 1.0, 1.0) for i in range(0, 200, 2)]
    whole = done + [(f"C{i}", "S", 1.0, 1.0) for i in range(1, 200, 2)]
    monkeypatch.setattr(q_stream, "gazetteer", lambda spark, sf_dir, done_only=False: spark.createDataFrame(done if done_only else whole, row))
    written = []
    batches = q_stream.job.line_source
    monkeypatch.setattr(q_stream.job, "line_source", lambda spark, path, **kw: written.append(path) or batches(spark, path, **kw))
    old = spark.conf.get("spark.sql.files.openCostInBytes")
    spark.conf.set("spark.sql.files.openCostInBytes", str(64 << 20))
    try:
        out = q_stream.stream_refreshed_gazetteer(spark, "any")
        got = {(r["round"], r.found): r.n for r in out.groupBy("round", F.col("dest_lat").isNotNull().alias("found")).agg(F.count("*").alias("n")).collect()}
    finally:
        spark.conf.set("spark.sql.files.openCostInBytes", old)
    assert got == {(0, True): 20, (0, False): 20, (1, True): 160}
    files = [f for f in os.listdir(written[0].replace("file:", "")) if f.startswith("part-")]
    assert len(files) > 2 and all(f.endswith(".gz") for f in files)
