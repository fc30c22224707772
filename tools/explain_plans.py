"""Write the executed (final adaptive) physical plans of the marts and live views to
docs/PLANS.md, with a per-query summary of scans, exchanges and joins.

Usage: python tools/explain_plans.py [sf_dir]   (default /root/testdata/sf0.01)
"""

from __future__ import annotations

import os
import re
import sys
from collections import Counter

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from soarcast.functions import transform  # noqa: E402
from soarcast.operators import hourly_baseline  # noqa: E402
from soarcast.plans import MARTS, marts  # noqa: E402
from soarcast.session import build_session, scratch_folder  # noqa: E402
from soarcast.sources import fixtures, read_transformed, write_transformed  # noqa: E402
from soarcast.sources.events import parse_events  # noqa: E402
from soarcast.streaming import views  # noqa: E402

NODES = ("FileScan", "Exchange hashpartitioning", "Exchange rangepartitioning", "Exchange SinglePartition",
         "BroadcastExchange", "ReusedExchange", "SortMergeJoin", "BroadcastHashJoin", "HashAggregate",
         "Window", "Expand", "BatchEvalPython", "ArrowEvalPython")


def _final(df) -> str:
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    # keep only final plans: drop every "Initial Plan" block (subqueries carry their own)
    kept, skip_at = [], None
    for line in plan.splitlines():
        depth = len(line) - len(line.lstrip(" :+-"))
        if skip_at is not None:
            if depth >= skip_at:
                continue
            skip_at = None
        if "== Initial Plan ==" in line:
            skip_at = depth
            continue
        kept.append(line)
    return "\n".join(kept)


def _summary(plan: str) -> str:
    counts = Counter()
    for node in NODES:
        counts[node] = len(re.findall(re.escape(node), plan))
    lines = [", ".join(f"{k}: {v}" for k, v in counts.items() if v)]
    for line in plan.splitlines():
        if "FileScan" not in line or "PartitionFilters: " not in line:
            continue
        rest = line.split("PartitionFilters: ", 1)[1]
        partition, rest = rest.split(", PushedFilters: ", 1)
        pushed, schema = rest.split(", ReadSchema: ", 1)
        lines.append(f"scan: PartitionFilters {partition} | PushedFilters {pushed} | ReadSchema {schema.strip()}")
    return "\n".join(lines)


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session("local[8]", shuffle_partitions=8, extra={"spark.ui.showConsoleProgress": "false"})
    work = scratch_folder(spark, "plans")
    write_transformed(transform(fixtures.grid_raw(spark, sf_dir).drop("obs_id")), f"{work}/zone")
    obs = read_transformed(spark, f"{work}/zone")
    messages = fixtures.event_messages(spark, sf_dir).select("value")
    messages.write.text(f"{work}/msgs")
    scored = views.score_events(parse_events(spark.read.text(f"{work}/msgs")))
    baseline = hourly_baseline(marts.hourly_conditions(obs))

    items = [(name, fn(obs)) for name, fn in MARTS.items()]
    items += [
        ("s1_location_windows", views.location_windows(scored)),
        ("s2_wind_trend", views.wind_trend(scored)),
        ("s3_alerts", views.point_alerts(scored)),
        ("s4_vs_baseline", views.versus_baseline(scored, baseline)),
    ]
    out = ["# Executed plans", "",
           f"Final adaptive plans over a transformed zone written from `{sf_dir}` (local[8], 8 shuffle "
           "partitions). Regenerate with `python tools/explain_plans.py`.", ""]
    for name, df in items:
        plan = _final(df)
        out += [f"## {name}", "", "```", _summary(plan), "```", "", "<details><summary>plan</summary>", "",
                "```", plan.strip(), "```", "", "</details>", ""]
    os.makedirs(os.path.join(ROOT, "docs"), exist_ok=True)
    with open(os.path.join(ROOT, "docs", "PLANS.md"), "w") as fh:
        fh.write("\n".join(out))
    spark.stop()


if __name__ == "__main__":
    main()
