"""Mergeable quantile states (KLL sketches) of numeric columns.

A state is one row for each column (and each value of ``by``): the number of
values and a sketch, both of which merge. States can be stored as a table,
for instance one for each day or partition, and merged later without reading
the data again. Building, merging and asking are plain aggregates.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

#: Size parameter of the sketches: about 24 K bytes for each 1,000.
K = 8192


def rank_error(k: int = K) -> float:
    """Normalised rank error of one quantile at 99 % confidence."""
    return 2.296 / k ** 0.9723


def value_column(c: str) -> Column:
    """A column as double; null and NaN are no value."""
    v = F.col(c).cast("double")
    return F.when(v.isNotNull() & ~F.isnan(v), v)


def quantile_state(df: DataFrame, cols: list[str], by: list[str] | None = None, k: int = K) -> DataFrame:
    """(*by, column_name, n, state), from one scan: no row for a column
    without values."""
    by = list(by or [])
    aggs = []
    for i, c in enumerate(cols):
        v = value_column(c)
        aggs += [F.count(v).alias(f"n{i}"), F.kll_sketch_agg_double(v, k).alias(f"s{i}")]
    wide = df.groupBy(*by).agg(*aggs)
    rows = [F.struct(F.lit(c).alias("column_name"), F.col(f"n{i}").alias("n"), F.col(f"s{i}").alias("state")) for i, c in enumerate(cols)]
    return wide.select(*by, F.inline(F.array(*rows))).where("n > 0")


def merged_states(states: DataFrame, by: list[str] | None = None, k: int = K) -> DataFrame:
    """The states of the whole from those of its parts."""
    return states.groupBy(*(by or []), "column_name").agg(F.sum("n").alias("n"), F.kll_merge_agg_double("state", k).alias("state"))


def with_quantiles(states: DataFrame, probs: list[float], name: str = "q") -> DataFrame:
    """``states`` with the array of approximate quantiles in place of the state."""
    if not probs:
        return states.withColumn(name, F.array().cast("array<double>")).drop("state")
    ps = F.array(*[F.lit(float(p)) for p in probs])
    return states.withColumn(name, F.kll_sketch_get_quantile_double("state", ps)).drop("state")
