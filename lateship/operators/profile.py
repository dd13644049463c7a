"""Profiling operators: distributions, distinct values, duplicates, schema.

Each is one lazy plan; where the reference ran one job per column (eight
``distinct`` jobs, two counts) the columns are unpivoted or aggregated
together so a single scan and a single shuffle answer all of them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F, types as T


def group_count_desc(df: DataFrame, key: str, count_col: str = "count") -> DataFrame:
    """Rows per value of ``key``, most frequent first (ties by key)."""
    return (df.groupBy(key).agg(F.count(F.lit(1)).alias(count_col))
              .orderBy(F.desc(count_col), F.asc_nulls_first(key)))


def top_k(df: DataFrame, key: str, k: int, count_col: str = "count") -> DataFrame:
    """Head of :func:`group_count_desc`; planned as TakeOrderedAndProject."""
    return group_count_desc(df, key, count_col).limit(k)


def row_count(df: DataFrame, name: str = "row_count") -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias(name))


def unpivot_as_text(df: DataFrame, cols: list[str], name_col: str = "column_name",
                    value_col: str = "value") -> DataFrame:
    """(column name, value as text) for the given columns, one row per cell."""
    return df.select(*[F.col(c).cast("string").alias(c) for c in cols]).unpivot(
        [], cols, name_col, value_col)


def distinct_values(df: DataFrame, cols: list[str]) -> DataFrame:
    """Distinct values of several columns in one job: unpivot, then distinct."""
    return unpivot_as_text(df, cols).distinct()


def distinct_pairs(df: DataFrame, a: str, b: str) -> DataFrame:
    return df.select(a, b).distinct()


def distinct_count(df: DataFrame, name: str = "n_distinct") -> DataFrame:
    return df.distinct().agg(F.count(F.lit(1)).alias(name))


def duplicate_row_count(df: DataFrame) -> DataFrame:
    """Whole-row duplicates in one pass.

    ``duplicate_rows`` = total - distinct (rows beyond the first copy);
    ``distinct_minus_total`` keeps the reference's sign (zero or negative).
    The group-by is partially aggregated before the shuffle, so a row with
    many copies costs one partial-count row per map task.
    """
    groups = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("_n"))
    return groups.agg(
        F.sum("_n").cast("long").alias("total_rows"),
        F.count(F.lit(1)).alias("distinct_rows"),
        F.sum(F.col("_n") - 1).cast("long").alias("duplicate_rows"),
    ).withColumn("distinct_minus_total", F.col("distinct_rows") - F.col("total_rows"))


def _present(df: DataFrame, c: str):
    col = F.col(c)
    dtype = df.schema[c].dataType
    if isinstance(dtype, (T.DoubleType, T.FloatType)):
        return col.isNotNull() & ~F.isnan(col)
    return col.isNotNull()


def completeness(df: DataFrame, cols: list[str]) -> DataFrame:
    """Per column: rows with a value (not null, not NaN) and total rows.

    One aggregate over the data, then a tiny unpivot of the single result row.
    """
    aggs = [F.count(F.lit(1)).alias("_total")]
    aggs += [F.count(F.when(_present(df, c), 1)).alias(c) for c in cols]
    row = df.agg(*aggs)
    return (row.unpivot(["_total"], cols, "column_name", "non_null")
               .select("column_name", "non_null", F.col("_total").alias("total_rows"),
                       (F.col("_total") - F.col("non_null")).alias("missing")))


def schema_report(df: DataFrame, counts: bool = True) -> DataFrame:
    """Position, name, type and nullability of each column, with the count of
    non-null values measured on the data in one aggregate. ``counts=False``
    reads metadata only: no column of the data is scanned."""
    fields = df.schema.fields
    if not counts:
        rows = [(i + 1, f.name, f.dataType.simpleString(), f.nullable) for i, f in enumerate(fields)]
        return df.sparkSession.createDataFrame(rows, "position int, column_name string, data_type string, nullable boolean")
    present = df.agg(*[F.count(F.col(f.name)).alias(f"_c{i}") for i, f in enumerate(fields)])
    rows = [F.struct(F.lit(i + 1).alias("position"), F.lit(f.name).alias("column_name"),
                     F.lit(f.dataType.simpleString()).alias("data_type"),
                     F.lit(f.nullable).alias("nullable"),
                     F.col(f"_c{i}").alias("non_null"))
            for i, f in enumerate(fields)]
    return present.select(F.inline(F.array(*rows)))


def preview(df: DataFrame, n: int, order_by: list[str] | None = None, ordered: bool = True) -> DataFrame:
    """First ``n`` rows in a stated order (all columns by default, so ties are
    identical rows and the result is deterministic). ``ordered=False`` takes
    any ``n`` rows: it reads only as many partitions as it needs."""
    if not ordered:
        return df.limit(n)
    keys = order_by or df.columns
    return df.orderBy(*[F.asc_nulls_first(k) for k in keys]).limit(n)
