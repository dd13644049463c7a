"""A fitted label index that is a table, for columns with many labels.

MLlib's indexer keeps all labels in the driver and in every task. Here the
ranking (most frequent first, ties by value) is written as a table and joined.
Indices are ranks by frequency, so the table's head holds the hot labels: the
head is broadcast, bounded in rows, and only rows with rarer labels are
joined with the rest, where no label is hot. Saving is the table itself.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..operators.features import string_index_mapping
from ..session import delete_path

#: Labels of one column that are broadcast.
HEAD_LABELS = 200_000
_SALTS = 1 << 16


class LabelIndex:
    """The index of some columns, stored under ``path``."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self.table = spark.read.parquet(f"{self.path}/labels")
        #: Number of labels of each column: one row a column.
        self.sizes = {r["column_name"]: r["n"] for r in spark.read.parquet(f"{self.path}/sizes").collect()}

    @classmethod
    def fit(cls, df: DataFrame, cols: list[str], path: str) -> LabelIndex:
        """Rank the labels of ``cols`` and write them under ``path``."""
        spark, path = df.sparkSession, path.rstrip("/")
        string_index_mapping(df, cols).write.mode("overwrite").parquet(f"{path}/labels")
        counted = spark.read.parquet(f"{path}/labels").groupBy("column_name").agg(F.count(F.lit(1)).alias("n"))
        names = spark.createDataFrame([(c,) for c in cols], "column_name string")
        (names.join(counted, "column_name", "left").select("column_name", F.coalesce("n", F.lit(0)).alias("n"))
         .write.mode("overwrite").parquet(f"{path}/sizes"))
        return cls(spark, path)

    def labels(self, col: str) -> DataFrame:
        """(value, count, index) of one column."""
        if col not in self.sizes:
            raise ValueError(f"column {col!r} is not indexed")
        return self.table.where(F.col("column_name") == col).select("value", "count", "index")

    def transform(self, df: DataFrame, cols: list[str] | None = None, suffix: str = "_index", head: int = HEAD_LABELS) -> DataFrame:
        """``df`` with ``<col><suffix>``: the label's index, and the number of
        labels for null and for labels that were not seen (``keep``).

        A column of up to ``head`` labels costs a broadcast and no shuffle.
        """
        out = df
        for c in cols or list(self.sizes):
            labels, n = self.labels(c), self.sizes[c]
            name, value = f"{c}{suffix}", F.col(c).cast("string")
            first = F.broadcast(labels.where(F.col("index") < head).select(F.col("value").alias("__v"), F.col("index").alias(name)))
            out = out.drop(name).join(first, value == F.col("__v"), "left").drop("__v")
            if n > head:
                # Rows that need no rarer label are spread by a salt and match nothing.
                known = F.col(name).isNotNull() | F.col(c).isNull()
                salt = F.when(known, F.pmod(F.xxhash64(*out.columns), F.lit(_SALTS))).otherwise(F.lit(-1)).cast("long")
                rare = labels.where(F.col("index") >= head).select(F.col("value").alias("__v"), F.lit(-1).cast("long").alias("__salt"), F.col("index").alias("__i"))
                keyed = out.withColumn("__v", F.when(~known, value)).withColumn("__salt", salt)
                out = (keyed.join(rare, ["__v", "__salt"], "left").withColumn(name, F.coalesce(name, "__i")).drop("__v", "__salt", "__i"))
            out = out.withColumn(name, F.coalesce(name, F.lit(float(n))))
        return out

    def delete(self) -> None:
        delete_path(self.spark, self.path)
