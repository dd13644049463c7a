"""Summarize the physical plans of every batch query into PLANS.md.

For each query: shuffles (Exchange), broadcasts, sort-merge joins and windows,
over everything that ran for it: the jobs inside the call (tables written on the way, quantile passes) and the run of the
returned plan. Plans are taken from Spark's event log after execution, so they
are what AQE ended with. A second table runs the gazetteer joins with every
broadcast switched off. Run at sf0.01 so AQE has real statistics.

usage: python tools/plan_report.py [sf_dir]
"""

from __future__ import annotations

import json
import re
import sys
import tempfile
import time
from pathlib import Path

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))

from lateship.operators import joins  # noqa: E402
from lateship.session import build_session  # noqa: E402

SKIP_PREFIX = ("stream_", "train_", "model_", "score_batch", "prediction_view", "evaluate_model", "cross_validate")
GEO = ["geo_join_nullsafe", "geo_join_using", "fill_missing_coords", "enrich_with_distance", "enrich_repeated_keys"]


def summarize(plan: str) -> dict:
    plan = plan.split("== Initial Plan ==")[0]  # count what ran
    tree = plan.split("\n\n")[0]
    return {
        "shuffles": len(re.findall(r"(?<!Broadcast)Exchange", tree)) - tree.count("ReusedExchange"),
        "broadcasts": tree.count("BroadcastExchange"),
        "smj": tree.count("SortMergeJoin"),
        "bhj": tree.count("BroadcastHashJoin"),
        "windows": len(re.findall(r"\bWindow\b", tree)),
    }


def run_all(spark, queries, keys, sf_dir) -> list[tuple[str, float, float]]:
    out = []
    for k in keys:
        t0 = time.time()
        queries[k](spark, sf_dir).write.format("noop").mode("overwrite").save()
        out.append((k, t0, time.time()))
        time.sleep(0.2)
    return out


def executions(log_dir: str) -> list[tuple[float, str]]:
    """(start, last plan description) of every SQL execution in the event log."""
    start, plan = {}, {}
    for p in Path(log_dir).rglob("*"):
        if not p.is_file():
            continue
        for line in p.open(errors="replace"):
            if "physicalPlanDescription" not in line:
                continue
            e = json.loads(line)
            i = e["executionId"]
            start.setdefault(i, e.get("time"))
            plan[i] = e["physicalPlanDescription"]
    return [(start[i] / 1000, plan[i]) for i in plan if start[i] is not None]


def table(ran, found) -> list[str]:
    lines = ["| Query | executions | shuffles | broadcasts | SMJ | BHJ | windows |",
             "| --- | --- | --- | --- | --- | --- | --- |"]
    for k, a, b in ran:
        own = [summarize(p) for t, p in found if a <= t <= b]
        total = {n: sum(s[n] for s in own) for n in ("shuffles", "broadcasts", "smj", "bhj", "windows")}
        lines.append(f"| `{k}` | {len(own)} | " + " | ".join(str(v) for v in total.values()) + " |")
    return lines


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    from lateship.plans.registry import ORACLES, QUERIES, load_all
    load_all()
    log_dir = tempfile.mkdtemp(prefix="plan-report-")
    spark = build_session("plan-report", master="local[8]", shuffle_partitions=8, extra_conf={
        "spark.eventLog.enabled": "true", "spark.eventLog.dir": f"file://{log_dir}", "spark.eventLog.compress": "false",
        "spark.eventLog.rolling.enabled": "false"})
    keys = [k for k in sorted(ORACLES) if not k.startswith(SKIP_PREFIX)]
    run_all(spark, QUERIES, ["enrich_with_distance", "repair_lossy_city_names", "geocode_pick_candidate"], sf_dir)  # prepared tables
    usual = run_all(spark, QUERIES, keys, sf_dir)
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    measure, joins.planned_bytes = joins.planned_bytes, lambda df: 1 << 60
    shuffled = run_all(spark, QUERIES, GEO, sf_dir)
    joins.planned_bytes = measure
    spark.stop()
    found = executions(log_dir)
    lines = ["# PLANS", "",
             f"Final (post-AQE) physical plans at `{sf_dir}`, `local[8]`, 8 shuffle",
             "partitions, from the event log: sums over every execution of the query, those",
             "inside the call and the run of the returned plan. Generated by",
             "`tools/plan_report.py`.", "", *table(usual, found), "",
             "## Gazetteer joins with broadcast switched off", "",
             "What the joins become past the size bound: shuffle joins on the keys (and, for",
             "the plain joins, the salt that spreads rows with null keys).", "", *table(shuffled, found)]
    (ROOT / "PLANS.md").write_text("\n".join(lines) + "\n")
    print("\n".join(lines))


if __name__ == "__main__":
    main()
