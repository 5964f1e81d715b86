"""Summarise the physical plans that every registered library query runs.

usage: python tools/plan_report.py [sf_dir] > PLANS.md

Each query is run once with Spark's event log on. All SQL executions of its
time span count, so the writes, checks, staged tables and streaming batches a
query runs before it returns are included; of an adaptive plan the last
version is the one that ran.
"""

from __future__ import annotations

import json
import os
import re
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

COUNTERS = [
    ("jobs with a plan", None),
    ("scans", r"^Scan (parquet|csv|json|text|orc)"),
    ("shuffles", r"^Exchange$"),
    ("broadcasts", r"^BroadcastExchange"),
    ("SMJ", r"^SortMergeJoin"),
    ("BHJ", r"^BroadcastHashJoin"),
    ("aggregates", r"^(Hash|Sort|ObjectHash)Aggregate"),
    ("windows", r"^Window$"),
    ("partial limits", r"^WindowGroupLimit"),
    ("Python", r"Python|Arrow|Pandas"),
    ("writes", r"InsertIntoHadoopFsRelation|^WriteFiles"),
]


def names_of(node: dict, out: list[str]) -> list[str]:
    out.append(node["nodeName"].strip())
    for child in node["children"]:
        names_of(child, out)
    return out


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    from strata.plans.catalog import Q
    from strata.session import get_session

    events = tempfile.mkdtemp(prefix="strata-plan-events-")
    spark = get_session("local[8]", shuffle_partitions=8, extra_conf={
        "spark.eventLog.enabled": "true", "spark.eventLog.dir": events, "spark.eventLog.compress": "false"})
    spans = []
    for name, fn in Q.items():
        began = time.time()
        fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
        spans.append((name, began, time.time()))
    spark.stop()

    query_of, plans = {}, {}
    for root, _, files in os.walk(events):
        for file in (f for f in files if f.startswith(("events_", "local-"))):
            with open(os.path.join(root, file)) as f:
                for line in f:
                    ev = json.loads(line)
                    if "sparkPlanInfo" in ev:
                        if "time" in ev:
                            query_of[ev["executionId"]] = next((n for n, a, b in spans if a <= ev["time"] / 1000 <= b), None)
                        plans[ev["executionId"]] = names_of(ev["sparkPlanInfo"], [])
    print(f"# Physical plans ({os.path.basename(sf_dir)}, local[8], 8 shuffle partitions, AQE on)\n")
    print("Operators in the final adaptive plans of all SQL executions of a query: its result and every write, check, "
          "staged table and streaming batch before it. `python tools/plan_report.py <dir>` regenerates this file.\n")
    print("| query | " + " | ".join(c for c, _ in COUNTERS) + " |")
    print("|---|" + "---|" * len(COUNTERS))
    for name, _, _ in spans:
        own = [plans[e] for e, q in query_of.items() if q == name]
        counts = [len(own)] + [sum(bool(re.search(p, n)) for names in own for n in names) for _, p in COUNTERS[1:]]
        print(f"| {name} | " + " | ".join(map(str, counts)) + " |")


if __name__ == "__main__":
    main()
