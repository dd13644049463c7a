from lateship.plans.jobs import scoring_job, training_job
from lateship.session import shared_dir
from lateship.sinks.files import write_csv
from lateship.schema import to_reference
from lateship.sources.events import write_event_files
from lateship.sources.fixtures import gazetteer, order_items


def test_training_from_a_latin1_csv_without_keys(spark, sf_dir):
    """Reference headers, ISO-8859-1, no order id: as the table comes."""
    from pyspark.sql import functions as F
    from lateship.operators.geo import enrich_with_distance
    path = shared_dir(spark, "t-jobs-csv")
    items = enrich_with_distance(order_items(spark, sf_dir), gazetteer(spark, sf_dir)).drop("order_id", "line_no")
    items = items.withColumn("order_region", F.concat(F.lit("Região "), F.col("order_region")))
    write_csv(to_reference(items), path, encoding="ISO-8859-1")
    back = spark.read.option("header", True).option("inferSchema", True).option("encoding", "ISO-8859-1").csv(path)
    assert "Order Region" in back.columns
    for split, parts in (("hash", None), ("random", 3)):
        out = training_job(back, "Logistic Regression", shared_dir(spark, "t-jobs-models"), grid={"regParam": [0.01, 0.1]},
                           split=split, num_partitions=parts, with_mean=split == "hash")
        assert out.report.first().auc > 0.55 and out.grid.count() == 2


def test_older_feature_layout(spark, sf_dir):
    from lateship.schema import LEGACY_CATEGORICAL_FEATURES, LEGACY_NUMERIC_FEATURES
    out = training_job(order_items(spark, sf_dir), "Logistic Regression", shared_dir(spark, "t-jobs-models"),
                       numeric=LEGACY_NUMERIC_FEATURES, categorical=LEGACY_CATEGORICAL_FEATURES)
    assert out.report.first().auc > 0.6


def test_scoring_options(spark, sf_dir):
    gaz_path = shared_dir(spark, "t-jobs-gaz2")
    write_csv(to_reference(gazetteer(spark, sf_dir)), gaz_path)
    events = write_event_files(spark, sf_dir, shared_dir(spark, "t-jobs-events2"), records_per_file=5000)
    docs = shared_dir(spark, "t-jobs-docs2")
    q = scoring_job(spark, shared_dir(spark, "t-jobs-ckpt2"), events, source_options={"wholetext": "false"}, gazetteer_path=gaz_path,
                    documents_path=docs, documents_format="parquet", fill_zero_coords=True, available_now=True)
    q.awaitTermination(300)
    assert q.exception() is None and spark.read.parquet(docs).count() == spark.read.text(events).count()


def test_training_then_streaming_with_the_saved_model(spark, sf_dir):
    out = training_job(order_items(spark, sf_dir), "Logistic Regression", shared_dir(spark, "t-jobs-models"),
                       gazetteer=gazetteer(spark, sf_dir))
    rep = out.report.first()
    assert out.model_path.endswith("logistic_regression") and rep.auc > 0.6
    assert out.grid.count() == 1

    gaz_path = shared_dir(spark, "t-jobs-gaz")
    write_csv(to_reference(gazetteer(spark, sf_dir)), gaz_path)
    events = write_event_files(spark, sf_dir, shared_dir(spark, "t-jobs-events"), records_per_file=2000)
    rel = shared_dir(spark, "t-jobs-rel")
    q = scoring_job(spark, shared_dir(spark, "t-jobs-ckpt"), events, gazetteer_path=gaz_path,
                    model_path=out.model_path, relational_path=rel, available_now=True)
    q.awaitTermination(300)
    assert q.exception() is None
    scored = spark.read.parquet(rel)
    assert scored.count() == spark.read.text(events).count()
    assert set(scored.columns) >= {"timestamp", "city", "region", "amount", "prediction", "batch_id"}
    assert scored.filter("prediction is null").count() == 0
