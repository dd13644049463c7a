import os
import tempfile

import numpy as np
import pandas as pd
import pytest
from hypothesis import given, settings, strategies as st

from pyspark.sql import functions as F

from lateship.operators import stats


def _frame(spark, values, groups):
    pdf = pd.DataFrame({"g": groups, "v": values})
    return spark.createDataFrame(pdf)


def test_running_total_matches_pandas(spark):
    rng = np.random.default_rng(0)
    g = rng.integers(0, 3, 500).astype(str)
    v = rng.permutation(500).astype(float)  # unique per group
    w = rng.integers(1, 5, 500)
    pdf = pd.DataFrame({"g": g, "v": v, "w": w})
    df = spark.createDataFrame(pdf)
    out = stats.running_total(df, "v", "w", "cum", ["g"], num_slices=7).toPandas()
    exp = pdf.sort_values(["g", "v"]).assign(cum=lambda d: d.groupby("g")["w"].cumsum())
    m = out.merge(exp, on=["g", "v", "w"], suffixes=("", "_exp"))
    assert len(m) == 500 and (m["cum"] == m["cum_exp"]).all()


@settings(max_examples=8, deadline=None)
@given(st.lists(st.integers(-50, 50), min_size=1, max_size=60))
def test_exact_quantiles_match_numpy(spark, xs):
    df = spark.createDataFrame([(float(x),) for x in xs], "x double")
    probs = [0.0, 0.01, 0.25, 0.5, 0.75, 0.99, 1.0]
    lin = {r["p"]: r["value"] for r in stats.exact_quantiles(df, ["x"], probs, "linear").collect()}
    disc = {r["p"]: r["value"] for r in stats.exact_quantiles(df, ["x"], probs, "disc").collect()}
    arr = np.sort(np.array(xs, dtype=float))
    for p in probs:
        assert abs(lin[p] - np.quantile(arr, p)) < 1e-9
        k = max(int(np.ceil(len(arr) * p)), 1)
        assert disc[p] == arr[k - 1]


def _auc_brute(labels, scores):
    pos = [s for l, s in zip(labels, scores) if l == 1]
    neg = [s for l, s in zip(labels, scores) if l == 0]
    tot = sum(1.0 if p > n else 0.5 if p == n else 0.0 for p in pos for n in neg)
    return tot / (len(pos) * len(neg))


def test_auc_exact_brute_force_and_symmetry(spark):
    rng = np.random.default_rng(1)
    labels = rng.integers(0, 2, 300).tolist()
    scores = np.round(rng.random(300) + 0.3 * np.array(labels), 2).tolist()  # many ties
    df = spark.createDataFrame(list(zip(labels, scores)), "y int, s double")
    a = stats.auc_exact(df, "y", "s").first()["auc"]
    b = stats.auc_exact(df.withColumn("s", -F.col("s")), "y", "s").first()["auc"]
    assert abs(a - _auc_brute(labels, scores)) < 1e-12
    assert abs(a + b - 1.0) < 1e-12


def test_boxplot_whiskers(spark):
    xs = list(range(1, 21)) + [100]
    df = spark.createDataFrame([(float(x),) for x in xs], "x double")
    r = stats.boxplot_stats(df, ["x"]).first()
    q1, q3 = np.percentile(xs, [25, 75])
    assert r["q1"] == q1 and r["q3"] == q3
    assert r["upper_whisker"] == 20.0 and r["n_outliers"] == 1 and r["max_value"] == 100.0


def test_approx_quantile_rank_error(spark):
    rng = np.random.default_rng(2)
    xs = rng.normal(size=5000)
    df = spark.createDataFrame([(float(x),) for x in xs], "x double")
    b = stats.quantile_bounds(df, ["x"], 0.01, 0.99, exact=False, rel_error=0.001)["x"]
    ranks = [np.searchsorted(np.sort(xs), v, side="right") / len(xs) for v in b]
    assert abs(ranks[0] - 0.01) <= 0.0011 and abs(ranks[1] - 0.99) <= 0.0011


def test_boxplot_approx_close_to_exact(spark):
    rng = np.random.default_rng(3)
    df = spark.createDataFrame([(float(x),) for x in rng.normal(size=4000)], "x double")
    a = stats.boxplot_stats(df, ["x"], exact=True).first()
    b = stats.boxplot_stats(df, ["x"], exact=False).first()
    assert abs(a["median"] - b["median"]) < 0.01 and abs(a["iqr"] - b["iqr"]) < 0.02
    assert a["n"] == b["n"] == 4000


def test_auc_single_class_is_null(spark):
    df = spark.createDataFrame([(1, 0.2), (1, 0.7)], "y int, s double")
    r = stats.auc_exact(df, "y", "s").first()
    assert r["auc"] is None and r["n_pos"] == 2 and r["n_neg"] == 0


@pytest.mark.parametrize("collect_rows", [10 ** 6, 0])
def test_quantile_brackets_are_widened_until_exact(spark, monkeypatch, collect_rows):
    """A sketch of next to no accuracy and no margin: ranks miss their brackets."""
    rng = np.random.default_rng(7)
    xs, ys = rng.normal(size=3000), np.round(rng.random(3000), 1)
    df = spark.createDataFrame(pd.DataFrame({"x": xs, "y": ys, "z": [float("nan")] * 3000})).repartition(5)
    passes = []
    counts = stats._bracket_counts
    monkeypatch.setattr(stats, "_bracket_counts", lambda *a: passes.append(1) or counts(*a))
    probs = [0.0, 0.013, 0.5, 0.99, 1.0]
    q = {(r.column_name, r.p): r.value
         for r in stats.exact_quantiles(df, ["x", "y", "z"], probs, k=8, margin=0.001, collect_rows=collect_rows).collect()}
    assert len(passes) > 1 and {c for c, _ in q} == {"x", "y"}
    for c, v in (("x", xs), ("y", ys)):
        assert all(abs(q[c, p] - np.quantile(v, p)) < 1e-9 for p in probs)


def test_quantiles_of_infinities_ties_and_one_value(spark):
    inf = float("inf")
    cols = {"a": [-inf] * 30 + [0.0] * 40 + [inf] * 30, "b": [2.5] * 100, "c": [None] * 99 + [7.0], "d": [-0.0] * 50 + [0.0] * 50}
    df = spark.createDataFrame(list(zip(*cols.values())), "a double, b double, c double, d double")
    q = {(r.column_name, r.p): r.value for r in stats.exact_quantiles(df, list(cols), [0.0, 0.3, 0.31, 0.7, 1.0], "disc").collect()}
    assert [q["a", p] for p in (0.0, 0.3, 0.31, 0.7, 1.0)] == [-inf, -inf, 0.0, 0.0, inf]
    assert {q["b", p] for p in (0.0, 0.3, 1.0)} == {2.5} and {q["c", p] for p in (0.0, 1.0)} == {7.0} and q["d", 0.3] == 0.0


def test_quantile_states_merge(spark):
    from lateship.operators import sketch
    rng = np.random.default_rng(11)
    df = spark.createDataFrame(pd.DataFrame({"day": rng.integers(0, 5, 8000), "x": rng.normal(size=8000), "y": rng.random(8000)}))
    path = os.path.join(tempfile.mkdtemp(), "states")
    sketch.quantile_state(df, ["x", "y"], by=["day"], k=512).write.parquet(path)   # states are stored, the data is not read again
    whole = sketch.merged_states(spark.read.parquet(path), k=512)
    got = {r.column_name: r for r in sketch.with_quantiles(whole, [0.01, 0.5, 0.99]).collect()}
    pdf = df.toPandas()
    for c in ("x", "y"):
        v = np.sort(pdf[c])
        assert got[c].n == 8000
        ranks = np.searchsorted(v, got[c].q, side="right") / len(v)
        assert np.abs(ranks - [0.01, 0.5, 0.99]).max() < 2 * sketch.rank_error(512)


def test_quantiles_leave_no_tables_behind(spark):
    import os
    from lateship.session import ensure_checkpoint_dir, local_path
    base = os.path.join(local_path(ensure_checkpoint_dir(spark)), "..")
    seen = lambda: {d for _, ds, _ in os.walk(base) for d in ds if d.startswith("quantile-")}
    before = seen()
    stats.exact_quantiles(spark.range(1000).selectExpr("CAST(id AS DOUBLE) AS x"), ["x"], [0.5], collect_rows=0).collect()
    assert seen() == before


def test_approximate_box_plot_does_no_exact_work(spark, monkeypatch):
    monkeypatch.setattr(stats, "_bracket_counts", lambda *a: 1 / 0)
    df = spark.range(2000).selectExpr("CAST(id AS DOUBLE) AS x")
    assert stats.boxplot_stats(df, ["x"], exact=False).first()["n"] == 2000


def test_exact_boxplot_computes_its_input_once(spark):
    seen = spark.sparkContext.accumulator(0)

    @F.udf("double")
    def counted(x):
        seen.add(1)
        return float(x)

    df = spark.range(300, numPartitions=3).select(counted.asNondeterministic()("id").alias("x"))
    r = stats.boxplot_stats(df, ["x"]).first()
    assert r["n"] == 300 and r["median"] == 149.5 and seen.value == 300
    assert stats.boxplot_stats(df, []).count() == 0
