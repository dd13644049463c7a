"""Connected components of an edge table, distributed.

Alternates "large star" and "small star" steps until the edge table no longer
changes; each step is a grouped minimum and a join, and each step's result is
written to the shared folder, so the lineage stays short and a lost executor
costs one step's reread. Neither edges nor labels reach the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import delete_path, shared_dir


def saved(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as a table in the shared folder and read it back."""
    path = f"{shared_dir(spark, name)}/table"
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.saved_path = path
    return out


def dropped(spark: SparkSession, *tables: DataFrame) -> None:
    """Delete tables made by :func:`saved` that nothing reads any more."""
    for t in tables:
        delete_path(spark, t.saved_path)


def _both(e: DataFrame) -> DataFrame:
    return e.select(F.explode(F.array(F.struct("u", "v"), F.struct(F.col("v").alias("u"), F.col("u").alias("v")))).alias("e")).select("e.*")


def _large_star(e: DataFrame) -> DataFrame:
    both = _both(e)
    low = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    return both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u > v").distinct()


def _small_star(e: DataFrame) -> DataFrame:
    low = e.groupBy("u").agg(F.min("v").alias("m"))
    joined = e.join(low, "u")
    out = joined.select(F.explode(F.array(F.struct(F.col("u"), F.col("m").alias("v")),
                                          F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e")).select("e.*")
    return out.where("u > v").distinct()


def components(spark: SparkSession, edges: DataFrame) -> DataFrame:
    """``(node, component)`` for every node of ``edges(u, v)`` that has a
    smaller one in its component; ``component`` is the smallest node.

    ``u`` and ``v`` are non-null longs in any order; loops and repeated edges
    are fine; no edges give an empty result. A component's smallest node
    itself is not listed.
    """
    e = saved(spark, edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
              .where("u > v").distinct(), "edges")

    def mark(t: DataFrame) -> tuple:
        return tuple(t.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v")), F.bit_xor(F.hash("u", "v"))).first())

    before = mark(e)
    while before[0]:
        old, e = e, saved(spark, _small_star(_large_star(e)), "edges")
        dropped(spark, old)
        after = mark(e)
        if after == before:
            break
        before = after
    return e.select(F.col("u").alias("node"), F.col("v").alias("component"))
