import numpy as np
import pandas as pd

from lateship.operators import stats
from lateship.operators.profile_state import merged_profile, profile_report, profile_state


def frame(spark, n=4000):
    rng = np.random.default_rng(6)
    pdf = pd.DataFrame({"part": rng.integers(0, 4, n), "x": 1e7 + rng.normal(size=n), "k": rng.integers(0, 9, n),
                        "s": rng.choice(["a", "b", "c", "d"], n, p=[.5, .3, .15, .05])})
    pdf.loc[::10, "x"] = np.nan
    pdf.loc[::7, "s"] = None
    return spark.createDataFrame(pdf).repartition(3), pdf


def test_merged_parts_equal_the_whole(spark):
    df, pdf = frame(spark)
    cols = ["x", "k", "s"]
    parts = profile_state(df, cols, by=["part"])
    halves = merged_profile(profile_state(df.where("part < 2"), cols).unionByName(profile_state(df.where("part >= 2"), cols)))
    twice = merged_profile(merged_profile(parts.where("part < 2")).unionByName(merged_profile(parts.where("part >= 2"))))
    for states in (profile_state(df, cols), merged_profile(parts), halves, twice):
        got = {r.column_name: r for r in profile_report(states, [0.5], 4).collect()}
        x, s = pdf["x"].dropna(), pdf["s"].dropna()
        assert (got["x"].rows, got["x"].present, got["x"].missing) == (len(pdf), len(x), len(pdf) - len(x))
        assert (got["x"].low, got["x"].high) == (x.min(), x.max())
        assert abs(got["x"].mean - x.mean()) < 1e-6 and abs(got["x"].std - x.std()) < 1e-6     # no digits lost to a large mean
        assert abs((x < got["x"].q[0]).mean() - 0.5) < 0.01 and abs(got["x"].n_distinct / x.nunique() - 1) < 0.05
        assert got["s"].n_distinct == 4 and [(t.item, t["count"]) for t in got["s"].top] == list(s.value_counts().items())
        assert got["s"].mean is None and got["s"].q is None and got["k"].n_distinct == 9


def test_parts_without_values(spark):
    df = spark.createDataFrame([(1, None, None), (2, 5.0, "v"), (2, 7.0, "v")], "part int, x double, s string")
    got = {r.column_name: r for r in profile_report(merged_profile(profile_state(df, ["x", "s"], by=["part"])), [0.5], 1).collect()}
    assert (got["x"].rows, got["x"].present, got["x"].mean, got["x"].low, got["x"].high) == (3, 2, 6.0, 5.0, 7.0)
    assert got["s"].top[0]["item"] == "v" and got["s"].missing == 1


def test_auc_bounds_hold_and_merge(spark):
    rng = np.random.default_rng(8)
    y = rng.integers(0, 2, 3000)
    s = np.clip(rng.normal(0.4 + 0.15 * y, 0.2), -0.1, 1.1)
    df = spark.createDataFrame(pd.DataFrame({"y": y, "s": s, "part": np.arange(3000) % 3}))
    df = df.unionByName(spark.createDataFrame([(1, float("nan"), 0), (None, 0.5, 0)], "y long, s double, part long"))
    clipped = df.where("y IS NOT NULL AND NOT isnan(s)").selectExpr("y", "least(greatest(s, 0d), 1d) AS s")
    exact = stats.auc_exact(clipped, "y", "s").first()["auc"]
    errors = []
    for bins in (5, 50, 5000):
        r = stats.auc_bounds(stats.score_histogram(df, "y", "s", bins, by=["part"])).first()
        assert (r.n_pos, r.n_neg) == (int(y.sum()), int((1 - y).sum())) and abs(r.auc - exact) <= r.error + 1e-12
        errors.append(r.error)
    assert errors[0] > errors[1] > errors[2]
    assert stats.auc_bounds(stats.score_histogram(df.where("y = 1"), "y", "s")).first()["auc"] is None
