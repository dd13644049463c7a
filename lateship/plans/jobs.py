"""Job-level entry points: batch training and the streaming scorer.

These mirror what a user runs end to end -- the building blocks are the
operators; these functions wire them with configuration, so a scheduler
(or the command line) can call them.

    python -m lateship.plans.jobs train --items PATH --model "Random Forest" --models-dir DIR
    python -m lateship.plans.jobs score --source DIR --gazetteer PATH --model-path DIR \
        --relational DIR --documents DIR --checkpoint DIR
"""

from __future__ import annotations

import argparse
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from ..ml import train as T
from ..operators import clean, geo
from ..schema import (CATEGORICAL_FEATURES, LABEL, LEGACY_CATEGORICAL_FEATURES,
                      LEGACY_NUMERIC_FEATURES, NUMERIC_FEATURES, to_snake)
from ..sources.files import read_gazetteer
from ..streaming import job


@dataclass
class TrainingOutput:
    report: DataFrame      # one row: model, auc, auc_exact, accuracy, weighted metrics
    grid: DataFrame        # (model, params, avg_auc) per grid point
    model_path: str


def training_job(items: DataFrame, model_name: str, models_dir: str,
                 gazetteer: DataFrame | None = None,
                 key_cols: tuple[str, ...] | None = None,
                 drop_incomplete: bool = True, grid: dict | None = None,
                 numeric: list[str] | None = None, categorical: list[str] | None = None,
                 with_mean: bool = True, split: str = "hash",
                 num_partitions: int | None = None) -> TrainingOutput:
    """Enrich (when a gazetteer is given), drop incomplete rows, train with
    cross-validation, save the best pipeline under its slug, evaluate it on
    the held-out part.

    ``key_cols`` identify a row for the hash split and the folds: by default
    ``order_id`` and ``line_no`` if the table has them, else the features and
    the label themselves (equal rows then stay on one side)."""
    df = to_snake(items)
    if key_cols is None:
        usual = ("order_id", "line_no")
        key_cols = usual if all(c in df.columns for c in usual) else tuple(
            [*(numeric or NUMERIC_FEATURES), *(categorical or CATEGORICAL_FEATURES), LABEL])
    if gazetteer is not None:
        df = geo.enrich_with_distance(df, gazetteer)
    if drop_incomplete:
        df = clean.drop_incomplete(df)
    result = T.train_and_select(df, model_name, list(key_cols), numeric, categorical, grid=grid,
                                with_mean=with_mean, split=split, num_partitions=num_partitions)
    path = T.save_model(result.model, models_dir, model_name)
    report = T.evaluation_report(T.score(result.model, result.test), model_name)
    return TrainingOutput(report, result.grid_metrics, path)


def scoring_job(spark: SparkSession, checkpoint: str, source_path: str | None = None,
                source_format: str = "text", source_options: dict | None = None,
                gazetteer_path: str | None = None, model_path: str | None = None,
                relational_path: str | None = None, documents_path: str | None = None,
                jdbc: dict | None = None, available_now: bool = False,
                max_files_per_trigger: int | None = None, fill_zero_coords: bool = False,
                documents_format: str = "json", documents_options: dict | None = None,
                trigger_interval: str | None = None):
    """Start the streaming scorer and return its ``StreamingQuery``.

    Scoring uses the saved pipeline when ``model_path`` is given, else the
    quantity x 0 fallback -- chosen by configuration, never by a swallowed
    error. The default trigger runs micro-batches back to back,
    ``trigger_interval`` (``"1 minute"``) spaces them, which bounds the output
    folders; ``available_now`` processes what is there and stops.
    ``fill_zero_coords`` sets missing destination coordinates to 0 before
    scoring.
    """
    lines = job.line_source(spark, source_path, source_format, source_options,
                            max_files_per_trigger)
    gaz = read_gazetteer(spark, gazetteer_path)
    scoring = (job.Scoring("model", model=T.load_model(model_path), fill_zero_coords=fill_zero_coords)
               if model_path else job.Scoring("zero", fill_zero_coords=fill_zero_coords))
    stream = job.scoring_stream(lines, gaz, scoring)
    w = (stream.writeStream.outputMode("append").option("checkpointLocation", checkpoint)
         .foreachBatch(job.dual_sink(relational_path, documents_path, jdbc, documents_format=documents_format,
                                     documents_options=documents_options)))
    if available_now:
        w = w.trigger(availableNow=True)
    elif trigger_interval:
        w = w.trigger(processingTime=trigger_interval)
    return w.start()


def main(argv=None) -> None:
    from ..session import build_session
    p = argparse.ArgumentParser(prog="lateship")
    sub = p.add_subparsers(dest="cmd", required=True)
    t = sub.add_parser("train")
    t.add_argument("--items", required=True, help="order-item table (Parquet or CSV folder)")
    t.add_argument("--format", default="parquet")
    t.add_argument("--gazetteer")
    t.add_argument("--model", default="Logistic Regression")
    t.add_argument("--models-dir", required=True)
    t.add_argument("--encoding", default="UTF-8", help="of a CSV table, for example ISO-8859-1")
    t.add_argument("--key", action="append", help="column that identifies a row; may be repeated")
    t.add_argument("--split", choices=["hash", "random"], default="hash")
    t.add_argument("--legacy-features", action="store_true", help="the older feature layout")
    t.add_argument("--sparse", action="store_true", help="scale without centring")
    t.add_argument("--num-partitions", type=int)
    s = sub.add_parser("score")
    for a in ("--source", "--gazetteer", "--model-path", "--relational", "--documents"):
        s.add_argument(a)
    s.add_argument("--checkpoint", required=True)
    s.add_argument("--available-now", action="store_true")
    s.add_argument("--trigger-interval")
    s.add_argument("--fill-zero-coords", action="store_true")
    s.add_argument("--source-format", default="text")
    s.add_argument("--source-option", action="append", default=[], metavar="NAME=VALUE")
    s.add_argument("--documents-format", default="json")
    s.add_argument("--documents-option", action="append", default=[], metavar="NAME=VALUE")
    a = p.parse_args(argv)
    spark = build_session("lateship-" + a.cmd)
    if a.cmd == "train":
        reader = spark.read.option("header", True).option("inferSchema", True).option("encoding", a.encoding)
        items = reader.format(a.format).load(a.items)
        out = training_job(items, a.model, a.models_dir, read_gazetteer(spark, a.gazetteer),
                           key_cols=tuple(a.key) if a.key else None, split=a.split, with_mean=not a.sparse,
                           numeric=LEGACY_NUMERIC_FEATURES if a.legacy_features else None,
                           categorical=LEGACY_CATEGORICAL_FEATURES if a.legacy_features else None,
                           num_partitions=a.num_partitions)
        out.report.show(truncate=False)
        print(out.model_path)
    else:
        def options(items):
            return dict(x.split("=", 1) for x in items)
        q = scoring_job(spark, a.checkpoint, a.source, a.source_format, options(a.source_option),
                        gazetteer_path=a.gazetteer, trigger_interval=a.trigger_interval,
                        fill_zero_coords=a.fill_zero_coords, documents_format=a.documents_format,
                        documents_options=options(a.documents_option),
                        model_path=a.model_path, relational_path=a.relational,
                        documents_path=a.documents, available_now=a.available_now)
        q.awaitTermination()


if __name__ == "__main__":
    main()
