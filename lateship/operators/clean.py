"""Cleaning: null removal with audit, fills, winsorizing, sampling, splits."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F, types as T

from ..functions.expr import clamp
from . import stats


def _present(df: DataFrame, c: str) -> Column:
    col = F.col(c)
    if isinstance(df.schema[c].dataType, (T.DoubleType, T.FloatType)):
        return col.isNotNull() & ~F.isnan(col)
    return col.isNotNull()


def complete_rows(df: DataFrame, subset: list[str] | None = None) -> Column:
    """True when every column (or every column of ``subset``) has a value."""
    cols = subset or df.columns
    return reduce(lambda a, b: a & b, [_present(df, c) for c in cols])


def drop_incomplete(df: DataFrame, subset: list[str] | None = None) -> DataFrame:
    """Drop a row if any column holds null or NaN (``dropna(how="any")``)."""
    return df.dropna(how="any", subset=subset)


def null_audit(df: DataFrame, subset: list[str] | None = None) -> DataFrame:
    """Rows before, after and deleted by :func:`drop_incomplete`, in one
    aggregate (the reference ran two counts)."""
    keep = complete_rows(df, subset)
    return (df.agg(F.count(F.lit(1)).alias("rows_before"),
                   F.count(F.when(keep, 1)).alias("rows_after"))
              .withColumn("rows_deleted", F.col("rows_before") - F.col("rows_after")))


def drop_null_label(df: DataFrame, label: str) -> DataFrame:
    return df.na.drop(subset=[label])


def fill_missing(df: DataFrame, cols: list[str], value=0) -> DataFrame:
    """Fill nulls in ``cols``; a missing column is an error, not a silent skip."""
    missing = [c for c in cols if c not in df.columns]
    if missing:
        raise ValueError(f"fill_missing: no such column(s) {missing}")
    return df.na.fill(value, subset=cols)


def winsorize_columns(df: DataFrame, cols: list[str], lower: float = 0.01,
                      upper: float = 0.99, exact: bool = False,
                      rel_error: float = 0.001) -> DataFrame:
    """Clamp each column to its [lower, upper] quantiles.

    All bounds come from *one* job (approximate, as the reference, or exact);
    they are two numbers per column, so the driver holds them as literals and
    the clamp stays a narrow projection with no join. A column without any
    value keeps its data unchanged.
    """
    bounds = stats.quantile_bounds(df, cols, lower, upper, exact=exact, rel_error=rel_error)
    out = df
    for c in cols:
        if c in bounds:
            lo, hi = bounds[c]
            out = out.withColumn(c, clamp(c, lo, hi))
    return out


def winsorize_column(df: DataFrame, col: str, lower: float = 0.01, upper: float = 0.99,
                     exact: bool = False, rel_error: float = 0.001) -> DataFrame:
    return winsorize_columns(df, [col], lower, upper, exact, rel_error)


def key_hash(key_cols: list[str], salt: str = "") -> Column:
    """The first 32 bits of the md5 of the key text, as a long."""
    text = F.concat_ws("|", F.lit(salt), *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in key_cols])
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("long")


def hash_bucket(key_cols: list[str], buckets: int = 10, salt: str = "") -> Column:
    """Deterministic bucket 0..buckets-1 from the md5 of the key text.

    Independent of partitioning and of task retries, and reproducible in SQL
    (md5, first 8 hex digits, modulo).
    """
    return (key_hash(key_cols, salt) % buckets).cast("int")


def sample_hash(df: DataFrame, fraction: float, key_cols: list[str], salt: str = "42") -> DataFrame:
    """Repeatable sample: keep rows whose 32-bit key hash falls under
    ``fraction`` of its range (so fractions down to about 1e-9 hold)."""
    return df.filter(key_hash(key_cols, salt) < F.lit(float(fraction) * 2 ** 32))


def sample_seeded(df: DataFrame, fraction: float = 0.1, seed: int = 42) -> DataFrame:
    """Bernoulli sample without replacement (Spark's; depends on partitioning)."""
    return df.sample(withReplacement=False, fraction=fraction, seed=seed)


def split_random(df: DataFrame, train: float = 0.8, seed: int = 42) -> tuple[DataFrame, DataFrame]:
    """Spark's ``randomSplit``: seeded, but dependent on partitioning and row
    order, so persist or checkpoint the input when both parts must agree
    after a recomputation. :func:`split_hash` has no such condition."""
    a, b = df.randomSplit([train, 1.0 - train], seed=seed)
    return a, b


def split_part(key_cols: list[str], train_buckets: int = 8, buckets: int = 10, salt: str = "42") -> Column:
    """``train`` or ``test``, as :func:`split_hash` deals the row: both parts
    from one scan."""
    return F.when(hash_bucket(key_cols, buckets, salt) < train_buckets, "train").otherwise("test")


def split_hash(df: DataFrame, key_cols: list[str], train_buckets: int = 8, buckets: int = 10,
               salt: str = "42") -> tuple[DataFrame, DataFrame]:
    """80/20 split by key hash: disjoint, complete, stable across reruns."""
    b = hash_bucket(key_cols, buckets, salt)
    return df.filter(b < train_buckets), df.filter(b >= train_buckets)
