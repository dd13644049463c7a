"""A mergeable profile of a table, from one scan.

For each column (and each value of ``by``, for instance a day or a source) a
state row holds counts, extremes, mean and squared deviations, a quantile
sketch, a distinct-count sketch and the most frequent values. States are
stored as a table and merged later: the profile of a year is the merge of its
days, and no data is read twice. Counts, extremes and moments are exact;
quantiles, distinct counts and frequent values have the sketches' errors (the
frequent values are exact while a column has no more than ``tracked``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from .sketch import K, value_column

TRACKED = 4096


def _text(df: DataFrame, c: str) -> Column:
    """A column as text; null and NaN are no value."""
    v = F.col(c).cast("string")
    return F.when(~F.isnan(c), v) if isinstance(df.schema[c].dataType, (T.DoubleType, T.FloatType)) else v


def _is_number(df: DataFrame, c: str) -> bool:
    return isinstance(df.schema[c].dataType, T.NumericType)


def profile_state(df: DataFrame, cols: list[str], by: list[str] | None = None, k: int = K, tracked: int = TRACKED) -> DataFrame:
    """(*by, column_name, rows, present, low, high, mean, m2, quantiles,
    distinct, frequent): one row a column, in one flat aggregate. ``low``,
    ``high``, ``mean``, ``m2`` and ``quantiles`` are of numeric columns."""
    by = list(by or [])
    none = F.lit(None)
    aggs, names = [F.count(F.lit(1)).alias("rows")], []
    for i, c in enumerate(cols):
        t = _text(df, c)
        v = value_column(c) if _is_number(df, c) else None
        parts = {"present": F.count(t), "low": F.min(v) if v is not None else none.cast("double"),
                 "high": F.max(v) if v is not None else none.cast("double"),
                 "mean": F.avg(v) if v is not None else none.cast("double"),
                 "m2": F.var_pop(v) * F.count(v) if v is not None else none.cast("double"),
                 "quantiles": F.kll_sketch_agg_double(v, k) if v is not None else none.cast("binary"),
                 "distinct": F.hll_sketch_agg(t),
                 "frequent": F.call_function("approx_top_k_accumulate", t, F.lit(tracked))}
        aggs += [e.alias(f"{n}{i}") if v is not None or n in ("present", "distinct", "frequent") else F.first(e).alias(f"{n}{i}")
                 for n, e in parts.items()]
        names = list(parts)
    wide = df.groupBy(*by).agg(*aggs)
    rows = [F.struct(F.lit(c).alias("column_name"), F.col("rows"), *[F.col(f"{n}{i}").alias(n) for n in names]) for i, c in enumerate(cols)]
    return wide.select(*by, F.inline(F.array(*rows)))


def merged_profile(states: DataFrame, by: list[str] | None = None, k: int = K, tracked: int = TRACKED) -> DataFrame:
    """The profile state of the whole from those of its parts."""
    n = F.sum("present")
    mean = F.sum(F.col("mean") * F.col("present")) / n
    # m2 of the whole: within the parts, and between their means around the first of them
    d = F.col("mean") - F.col("__around")
    between = F.sum(d * d * F.col("present")) - F.pow(F.sum(d * F.col("present")), 2) / n
    keys = [*(by or []), "column_name"]
    around = states.groupBy(*keys).agg(F.min("mean").alias("__around"))
    cond = [states[c].eqNullSafe(around[c]) for c in keys]
    joined = states.join(around, cond).drop(*[around[c] for c in keys])
    return joined.groupBy(*keys).agg(
        F.sum("rows").alias("rows"), n.alias("present"), F.min("low").alias("low"), F.max("high").alias("high"), mean.alias("mean"),
        (F.sum("m2") + between).alias("m2"), F.kll_merge_agg_double("quantiles", k).alias("quantiles"),
        F.hll_union_agg("distinct").alias("distinct"),
        F.call_function("approx_top_k_combine", F.col("frequent"), F.lit(tracked)).alias("frequent"))


def profile_report(states: DataFrame, probs: list[float] = (0.25, 0.5, 0.75), top: int = 3) -> DataFrame:
    """What the states say: rows, present, missing, extremes, mean, standard
    deviation, quantiles, distinct values and the ``top`` most frequent."""
    ps = F.array(*[F.lit(float(p)) for p in probs])
    number = F.col("mean").isNotNull()
    return states.select(
        *[c for c in states.columns if c not in ("m2", "quantiles", "distinct", "frequent")],
        (F.col("rows") - F.col("present")).alias("missing"),
        F.sqrt(F.when(F.col("present") > 1, F.col("m2") / (F.col("present") - 1))).alias("std"),
        F.when(number, F.kll_sketch_get_quantile_double("quantiles", ps)).alias("q"),
        F.hll_sketch_estimate("distinct").alias("n_distinct"),
        # null counts as a value there
        F.slice(F.filter(F.call_function("approx_top_k_estimate", F.col("frequent"), F.lit(top + 1)), lambda x: x["item"].isNotNull()), 1, top).alias("top"))
