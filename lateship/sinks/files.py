"""File sinks: CSV (UTF-8 or Latin-1), appendable gazetteer, JSON documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

LATIN1_OUTSIDE = r"[^\x00-\xFF]"


def write_csv(df: DataFrame, path: str, encoding: str = "UTF-8", mode: str = "overwrite",
              header: bool = True) -> str:
    """Distributed CSV write (one file per task), header per file, no index."""
    df.write.mode(mode).option("header", header).option("encoding", encoding).csv(path)
    return path


def latin1_lossy_report(df: DataFrame, cols: list[str]) -> DataFrame:
    """Per column: rows whose text has characters ISO-8859-1 cannot hold
    (they would be written as '?'), from one aggregate before the write."""
    aggs = [F.count(F.lit(1)).alias("_total")]
    aggs += [F.count(F.when(F.col(c).rlike(LATIN1_OUTSIDE), 1)).alias(c) for c in cols]
    return (df.agg(*aggs).unpivot(["_total"], cols, "column_name", "lossy_rows")
              .withColumnRenamed("_total", "total_rows"))


def write_csv_latin1(df: DataFrame, path: str, text_cols: list[str] | None = None,
                     mode: str = "overwrite") -> DataFrame:
    """Report lossy rows, then write in ISO-8859-1. Returns the report."""
    cols = text_cols or [f.name for f in df.schema.fields if f.dataType.simpleString() == "string"]
    report = latin1_lossy_report(df, cols).cache()
    report.count()
    write_csv(df, path, encoding="ISO-8859-1", mode=mode)
    return report


def append_csv(df: DataFrame, path: str) -> str:
    """Append to a directory table; every part file carries its own header,
    which the reader skips, so the first write and later appends look alike."""
    return write_csv(df, path, mode="append")


def write_json_documents(df: DataFrame, path: str, mode: str = "append",
                         partition_by: list[str] | None = None) -> str:
    """One JSON object per row (reference field names kept as given)."""
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.json(path)
    return path
