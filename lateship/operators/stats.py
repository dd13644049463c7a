"""Exact order statistics without a single-partition window.

A global ``Window.orderBy`` moves every row to one task. The running total
here is a distributed prefix sum instead:

1. the (pre-aggregated) rows are range-partitioned on (group, order) --
   Spark samples the bounds, AQE may merge small neighbouring ranges -- and
   each row's slice is its partition index. The sliced table is then
   checkpointed to the shared folder, which freezes the assignment: every
   later branch of the plan and every task retry sees the same slices;
2. a window *within* each (group, slice) gives the local running sum;
3. slice totals (one row per slice and group: a proven bound) get a tiny
   window for the offsets, which are broadcast back and added.

Inputs are pre-aggregated to one row per distinct value with a weight, so a
value repeated a billion times is one row, and ties never need breaking.
"""

from __future__ import annotations

import math
from functools import reduce

import numpy as np
from pyspark.sql import DataFrame, Window, functions as F

from ..session import delete_path, ensure_checkpoint_dir, shared_dir
from . import sketch
from .sketch import value_column as _value

_PID = "__slice"
#: Gathered rows that the driver may order; more are ordered by Spark.
COLLECT_ROWS = 500_000


def _reliable(df: DataFrame) -> DataFrame:
    """Checkpoint to the shared checkpoint folder (``spark.checkpoint.dir``)."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def _order(order) -> list:
    """One column name / Column, or a list of them (sort orders allowed)."""
    items = order if isinstance(order, (list, tuple)) else [order]
    return [F.col(o) if isinstance(o, str) else o for o in items]


def slice_by_range(df: DataFrame, order, groups: list[str],
                   num_slices: int | None = None) -> DataFrame:
    """Rows with their slice id (``__slice``), frozen by a reliable checkpoint."""
    keys = [F.col(g) for g in groups] + _order(order)
    ranged = df.repartitionByRange(num_slices, *keys) if num_slices else df.repartitionByRange(*keys)
    return _reliable(ranged.withColumn(_PID, F.spark_partition_id()))


def _offsets(sliced: DataFrame, weight_col: str, groups: list[str]) -> DataFrame:
    """Per (group, slice): total ``__t`` and offset ``__off`` (weight of all
    earlier slices of the group). At most slices x groups rows."""
    totals = sliced.groupBy(*groups, _PID).agg(F.sum(weight_col).alias("__t"))
    w_off = (Window.partitionBy(*groups).orderBy(_PID)
             .rowsBetween(Window.unboundedPreceding, -1))
    return totals.select(*groups, _PID, "__t",
                         F.coalesce(F.sum("__t").over(w_off), F.lit(0)).alias("__off"))


def _local_cum(sliced: DataFrame, offsets: DataFrame, order, weight_col: str,
               out_col: str, groups: list[str], few_groups: bool) -> DataFrame:
    w_local = (Window.partitionBy(*groups, _PID).orderBy(*_order(order))
               .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    local = sliced.withColumn("__local", F.sum(weight_col).over(w_local))
    # offsets has at most slices x groups rows: with few groups it is broadcast,
    # else that is left to its measured size.
    own = offsets.select(*groups, _PID, "__off")
    return (local.join(F.broadcast(own) if few_groups else own, [*groups, _PID])
                 .withColumn(out_col, F.col("__local") + F.col("__off"))
                 .drop(_PID, "__local", "__off"))


def running_total(df: DataFrame, order_col, weight_col: str, out_col: str,
                  group_cols: list[str] | None = None,
                  num_slices: int | None = None, few_groups: bool = False) -> DataFrame:
    """Add ``out_col`` = sum of ``weight_col`` over rows of the same group
    that sort at or before this row. ``order_col`` is a column, or a list of
    columns / sort orders, that orders the rows of a group totally.
    ``few_groups`` states that the groups are a bounded few (column names)."""
    groups = list(group_cols or [])
    sliced = slice_by_range(df, order_col, groups, num_slices)
    return _local_cum(sliced, _offsets(sliced, weight_col, groups), order_col, weight_col,
                      out_col, groups, few_groups or not groups)


def _ranks(n: int, p: float, method: str) -> tuple[int, int, float]:
    """1-based ranks to look up and the share of the second."""
    if method == "disc":
        k = max(math.ceil(n * p), 1)
        return k, k, 0.0
    h = (n - 1) * p
    return math.floor(h) + 1, math.ceil(h) + 1, h - math.floor(h)


def _merged(brackets: list[tuple[float, float]]) -> list[tuple[float, float]]:
    out: list[tuple[float, float]] = []
    for lo, hi in sorted(brackets):
        if out and lo <= out[-1][1]:
            out[-1] = (out[-1][0], max(hi, out[-1][1]))
        else:
            out.append((lo, hi))
    return out


def _brackets(df: DataFrame, cols: list[str], probs: list[float], width: float, k: int) -> dict[str, tuple[int, list]]:
    """(number of values, disjoint brackets around the wanted ranks) per column:
    one sketch pass; a few numbers per column reach the driver."""
    ends = sorted({e for p in probs for e in (p - width, p + width) if 0.0 < e < 1.0})
    states = sketch.quantile_state(df, cols, k=k)
    at = {r["column_name"]: (r["n"], dict(zip(ends, r["q"]))) for r in sketch.with_quantiles(states, ends).collect()}
    out = {}
    for c, (n, q) in at.items():
        out[c] = n, _merged([(q.get(p - width, -math.inf), q.get(p + width, math.inf)) for p in probs])
    return out


def _bracket_counts(df: DataFrame, brackets: dict[str, list]) -> dict[str, list[tuple[int, int, int]]]:
    """Per bracket the number of values below it, at its low end, and in the
    rest of it: conditional counts in one flat aggregate. A bracket of one
    value has no rest."""
    aggs = []
    for i, bs in enumerate(brackets.values()):
        v = F.col(f"v{i}")
        for j, (lo, hi) in enumerate(bs):
            conds = [("b", v < lo), ("l", v == lo)] + ([("r", (v > lo) & (v <= hi))] if lo < hi else [])
            aggs += [F.count(F.when(cond, True)).alias(f"{name}{i}_{j}") for name, cond in conds]
    row = df.select(*[_value(c).alias(f"v{i}") for i, c in enumerate(brackets)]).agg(*aggs).first().asDict()
    return {c: [tuple(row.get(f"{x}{i}_{j}", 0) for x in "blr") for j in range(len(bs))] for i, (c, bs) in enumerate(brackets.items())}


def _place(k: int, brackets: list, counts: list) -> tuple | None:
    """Where rank ``k`` lies: ``(bracket, value, None)`` if at a low end,
    ``(bracket, None, rank in the rest)``, or None if in no bracket."""
    for j, ((lo, _), (below, at_lo, rest)) in enumerate(zip(brackets, counts)):
        r = k - below
        if 0 < r <= at_lo:
            return j, lo, None
        if 0 < r <= at_lo + rest:
            return j, None, r - at_lo
    return None


def _gathered(df: DataFrame, wanted: list[tuple[str, float, float]]) -> DataFrame:
    """(cell, value, w): the distinct values above the low end of each bracket
    ``(column, low, high)`` and how often they occur. Rows outside all of
    them are filtered away before anything is built from them."""
    inside = [(_value(c) > lo) & (_value(c) <= hi) for c, lo, hi in wanted]
    some = reduce(lambda a, b: a | b, inside)
    parts = [F.when(x, F.struct(F.lit(i).alias("cell"), F.col(c).cast("double").alias("value")))
             for i, (x, (c, _, _)) in enumerate(zip(inside, wanted))]
    return (df.where(some).select(F.explode(F.array_compact(F.array(*parts))).alias("x")).select("x.*")
              .groupBy("cell", "value").agg(F.count(F.lit(1)).alias("w")))


def _values_at(df: DataFrame, wanted: list[tuple[str, float, float]], ranks: list[set[int]], rows: int, collect_rows: int) -> dict:
    """``{(cell, rank): value}``. Up to ``collect_rows`` gathered rows are
    ordered by the driver, more of them by a distributed running total."""
    cells = _gathered(df, wanted)
    if rows <= collect_rows:
        got = cells.toArrow()
        cell, value, w = (got[c].to_numpy() for c in ("cell", "value", "w"))
        out = {}
        for i, ks in enumerate(ranks):
            mine = cell == i
            order = np.argsort(value[mine])
            v, cum = value[mine][order], np.cumsum(w[mine][order])
            out.update({(i, k): float(v[np.searchsorted(cum, k)]) for k in ks})
        return out
    spark, path = df.sparkSession, shared_dir(df.sparkSession, "quantile-slices")
    try:
        ranged = cells.repartitionByRange(F.col("cell"), F.col("value"))
        ranged.withColumn(_PID, F.spark_partition_id()).write.mode("overwrite").parquet(path)
        sliced = spark.read.parquet(path)
        cum = _local_cum(sliced, _offsets(sliced, "w", ["cell"]), "value", "w", "cum", ["cell"], True)
        targets = F.broadcast(spark.createDataFrame([(i, k) for i, ks in enumerate(ranks) for k in ks], "cell int, k long"))
        hit = (F.col("cum") - F.col("w") < F.col("k")) & (F.col("k") <= F.col("cum"))
        return {(r["cell"], r["k"]): r["value"] for r in cum.join(targets, "cell").filter(hit).collect()}
    finally:
        delete_path(spark, path)


def exact_quantiles(df: DataFrame, cols: list[str], probs: list[float], method: str = "linear",
                    k: int = sketch.K, margin: float | None = None, collect_rows: int = COLLECT_ROWS) -> DataFrame:
    """(column_name, p, value) for every column with values and probability.

    ``method="linear"``: interpolated between closest ranks (numpy default,
    Spark ``percentile``, SQL ``percentile_cont``). ``method="disc"``: the
    smallest value whose cumulative share reaches p (``percentile_disc``).

    Three passes, all flat: a KLL sketch gives a bracket around each wanted
    rank (``margin`` to either side, twice the sketch's error by default);
    conditional counts tell how many values lie below, at the low end of and
    in the rest of each bracket; and only where a rank falls in the rest, its
    values (about ``2 * margin`` of the rows) are gathered and ordered. If a
    rank lies in no bracket, the bracket is widened and the passes are
    repeated for that column: the result is exact at any accuracy. The result
    is a local table of columns x probabilities.
    """
    spark = df.sparkSession
    if not cols:
        return spark.createDataFrame([], "column_name string, p double, value double")
    found: dict[str, dict[float, float]] = {}
    todo, width = list(dict.fromkeys(cols)), margin if margin is not None else 2 * sketch.rank_error(k)
    while todo:
        sketched = _brackets(df, todo, probs, width, k)
        todo = [c for c in todo if c in sketched]   # columns without values give no row
        if not todo:
            break
        ranks = {c: {p: _ranks(sketched[c][0], p, method) for p in probs} for c in todo}
        brackets = {c: sketched[c][1] for c in todo}
        counts = _bracket_counts(df, brackets)
        at: dict[tuple[str, int], float] = {}
        inside: dict[tuple[str, int], set[int]] = {}
        for c in todo:
            places = {r: _place(r, brackets[c], counts[c]) for lo, hi, _ in ranks[c].values() for r in (lo, hi)}
            if None not in places.values():
                found[c] = {}
                at.update({(c, r): v for r, (_, v, x) in places.items() if x is None})
                for r, (j, _, x) in places.items():
                    if x is not None:
                        inside.setdefault((c, j), set()).add((r, x))
        if inside:
            wanted = [(c, *brackets[c][j]) for c, j in inside]
            got = _values_at(df, wanted, [{x for _, x in rs} for rs in inside.values()],
                             sum(counts[c][j][2] for c, j in inside), collect_rows)
            at.update({(c, r): got[i, x] for i, ((c, _), rs) in enumerate(inside.items()) for r, x in rs})
        for c in [c for c in todo if c in found]:
            found[c] = {p: at[c, lo] + frac * (at[c, hi] - at[c, lo]) if frac else at[c, lo] for p, (lo, hi, frac) in ranks[c].items()}
        todo = [c for c in todo if c not in found]
        width = max(width * 8, 1e-4)
    rows = [(c, float(p), float(v)) for c in cols if c in found for p, v in found[c].items()]
    return spark.createDataFrame(rows, "column_name string, p double, value double")


def approx_quantiles(df: DataFrame, cols: list[str], probs: list[float],
                     accuracy: int = 10000) -> DataFrame:
    """(column_name, p, value) from ``percentile_approx``: one pass, no sort,
    rank error about 1/accuracy. The scalable choice when exactness is not
    required."""
    long = df.select(*[F.col(c).cast("double").alias(c) for c in cols]).unpivot(
        [], cols, "column_name", "value").filter(F.col("value").isNotNull() & ~F.isnan("value"))
    ps = F.array(*[F.lit(float(p)) for p in probs])
    q = long.groupBy("column_name").agg(F.percentile_approx("value", ps, accuracy).alias("q"))
    return q.select("column_name", F.posexplode(F.arrays_zip(ps.alias("p"), F.col("q").alias("v")))) \
            .select("column_name", F.col("col.p").alias("p"), F.col("col.v").alias("value"))


def quantile_bounds(df: DataFrame, cols: list[str], lower: float = 0.01, upper: float = 0.99,
                    exact: bool = True, rel_error: float = 0.001) -> dict[str, tuple[float, float]]:
    """Driver-side bounds per column (two numbers each; a bounded collect).

    ``exact=False`` is the reference's ``approxQuantile(cols, [lo, hi], 0.001)``
    in one job for all columns. A column with no values is absent from the
    result, and the caller leaves it unchanged.
    """
    if not exact:
        qs = df.approxQuantile(cols, [lower, upper], rel_error)
        return {c: (q[0], q[1]) for c, q in zip(cols, qs) if len(q) == 2}
    rows = exact_quantiles(df, cols, [lower, upper], "disc").collect()
    out: dict[str, list] = {}
    for r in rows:
        out.setdefault(r["column_name"], [None, None])[0 if r["p"] == lower else 1] = r["value"]
    return {c: (v[0], v[1]) for c, v in out.items()}


def boxplot_stats(df: DataFrame, cols: list[str], whisker: float = 1.5,
                  exact: bool = True) -> DataFrame:
    """The numbers behind a box plot, per column, on the full data.

    Quartiles are linear-interpolated (``exact=False``: approximate quartiles
    of one sketch pass, and no exact work); whiskers are the furthest data
    points within ``whisker x IQR`` of the box; outliers are the points
    beyond. With the quartiles known, one aggregate over all columns gives
    the rest. Columns without values are absent. Exact statistics read the
    rows four times, so the columns are written once to the shared folder:
    what ``df`` joins or computes is not repeated.
    """
    if not exact or not cols:
        return _boxplot(df, cols, whisker, exact)
    spark, path = df.sparkSession, shared_dir(df.sparkSession, "boxplot-columns")
    try:
        df.select(*dict.fromkeys(cols)).write.mode("overwrite").option("compression", "zstd").parquet(path)
        return _boxplot(spark.read.parquet(path), cols, whisker, exact)
    finally:
        delete_path(spark, path)


def _boxplot(df: DataFrame, cols: list[str], whisker: float, exact: bool) -> DataFrame:
    """A local table: nothing of ``df`` is read later."""
    probs = [0.25, 0.5, 0.75]
    if exact:
        box: dict[str, dict] = {}
        for r in exact_quantiles(df, cols, probs, "linear").collect():
            box.setdefault(r["column_name"], {})[r["p"]] = r["value"]
        box = {c: [q[p] for p in probs] for c, q in box.items()}
    else:
        box = {r["column_name"]: r["q"] for r in sketch.with_quantiles(sketch.quantile_state(df, cols), probs).collect()}
    schema = ("column_name string, q1 double, median double, q3 double, iqr double, n long, min_value double, "
              "max_value double, lower_whisker double, upper_whisker double, n_outliers long")
    if not box:
        return df.sparkSession.createDataFrame([], schema)
    aggs = []
    for i, (c, (q1, _, q3)) in enumerate(box.items()):
        v = _value(c)
        lo, hi = q1 - whisker * (q3 - q1), q3 + whisker * (q3 - q1)
        inside = (v >= lo) & (v <= hi)
        aggs.append(F.struct(F.count(v), F.min(v), F.max(v), F.min(F.when(inside, v)), F.max(F.when(inside, v)),
                             F.count(F.when(~inside, v))).alias(f"b{i}"))
    row = df.agg(*aggs).first()
    rows = [(c, q1, q2, q3, q3 - q1, *row[f"b{i}"]) for i, (c, (q1, q2, q3)) in enumerate(box.items())]
    return df.sparkSession.createDataFrame(rows, schema)


def auc_exact(df: DataFrame, label_col: str, score_col: str) -> DataFrame:
    """Area under ROC, exact, ties counted one half (one row: auc, n_pos, n_neg).

    Scores are first grouped (one row per distinct score); the count of
    negatives below each score is a distributed running total.
    """
    lab = F.col(label_col).cast("double")
    g = (df.filter(F.col(score_col).isNotNull() & F.col(label_col).isNotNull())
           .groupBy(F.col(score_col).cast("double").alias("s"))
           .agg(F.sum(F.when(lab == 1.0, 1).otherwise(0)).cast("long").alias("pos"),
                F.sum(F.when(lab == 1.0, 0).otherwise(1)).cast("long").alias("neg")))
    cum = running_total(g, "s", "neg", "neg_le")
    contrib = F.col("pos").cast("double") * (F.col("neg_le") - F.col("neg") + F.col("neg") / 2.0)
    return (cum.agg(F.sum(contrib).alias("u"), F.sum("pos").alias("n_pos"),
                    F.sum("neg").alias("n_neg"))
               .select(F.when((F.col("n_pos") > 0) & (F.col("n_neg") > 0),
                              F.col("u") / (F.col("n_pos").cast("double") * F.col("n_neg")))
                        .alias("auc"),  # undefined (null) with a single class
                       "n_pos", "n_neg"))


def score_histogram(df: DataFrame, label_col: str, score_col: str, bins: int = 10_000, by: list[str] | None = None) -> DataFrame:
    """(*by, bin, pos, neg): a mergeable state for :func:`auc_bounds`, one
    aggregate of ``bins + 1`` rows at most for each value of ``by``. Scores
    are probabilities; those outside 0 to 1 count as 0 or 1. Rows without a
    score or a label are not counted."""
    s, lab = F.col(score_col).cast("double"), F.col(label_col).cast("double")
    b = F.floor(F.least(F.greatest(s, F.lit(0.0)), F.lit(1.0)) * bins).cast("int")
    return (df.filter(s.isNotNull() & ~F.isnan(s) & lab.isNotNull()).groupBy(*(by or []), b.alias("bin"))
              .agg(F.count(F.when(lab == 1.0, 1)).alias("pos"), F.count(F.when(lab != 1.0, 1)).alias("neg")))


def auc_bounds(histogram: DataFrame) -> DataFrame:
    """One row: auc, error, n_pos, n_neg. The area under ROC lies within
    ``auc - error`` and ``auc + error``, for certain: only pairs that share a
    bin are unordered, and they count one half. Several states (of days, of
    parts) may be given together; no score is ordered, only the bins are."""
    h = histogram.groupBy("bin").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))
    # one small row set (the bins) in one task
    below = F.coalesce(F.sum("neg").over(Window.partitionBy(F.lit(0)).orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    pos, neg = F.col("pos").cast("double"), F.col("neg").cast("double")
    sums = h.withColumn("below", below.cast("double")).agg(
        F.sum(pos * F.col("below")).alias("won"), F.sum(pos * neg).alias("open"), F.sum("pos").alias("n_pos"), F.sum("neg").alias("n_neg"))
    pairs = F.col("n_pos").cast("double") * F.col("n_neg")
    return sums.select(F.when(pairs > 0, (F.col("won") + F.col("open") / 2) / pairs).alias("auc"),
                       F.when(pairs > 0, F.col("open") / 2 / pairs).alias("error"), "n_pos", "n_neg")


__all__ = ["score_histogram", "auc_bounds", "running_total", "exact_quantiles", "quantile_bounds", "boxplot_stats",
           "auc_exact", "approx_quantiles", "slice_by_range"]
