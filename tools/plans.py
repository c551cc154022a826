"""Write PLANS.md: physical-plan facts for the headline queries (shuffles, scans, pruning, pushdown).

Usage: python tools/plans.py [sf_dir]  (plans are taken with adaptive execution off, so the
static plan Catalyst chose is shown; at run time AQE may still coalesce or switch joins).
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

HEADLINE = ["interpretable_metrics", "topic_metrics", "aacc_last", "author_overlap_pairs", "impact_index",
            "impulse_index", "best_pubs", "knn_cosine", "membership", "embed_text"]


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    from pubstrata.plans.registry import QUERIES
    from pubstrata.session import local_session

    spark = local_session(8, 8)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    out = ["# Physical plans of the headline queries", "",
           f"Generated by `tools/plans.py` on `{os.path.basename(sf)}` with adaptive execution off.", ""]
    for name in HEADLINE:
        plan = QUERIES[name](spark, sf)._jdf.queryExecution().executedPlan().toString()
        ex = len(re.findall(r"Exchange (hashpartitioning|SinglePartition|rangepartitioning|RoundRobin)", plan))
        out.append(f"## {name}")
        out.append("")
        out.append(f"* shuffle exchanges: {ex}; broadcast exchanges: {plan.count('BroadcastExchange')}; "
                   f"reused exchanges: {plan.count('ReusedExchange')}; partial window limits: "
                   f"{plan.count('WindowGroupLimit') // 2}; Python stages: "
                   f"{len(re.findall(r'(FlatMapGroupsInPandas|MapInPandas|ArrowEvalPython)', plan))}")
        seen = set()
        for m in re.finditer(r"FileScan parquet[^\n]*", plan):
            line = m.group(0)
            loc = re.search(r"Location: InMemoryFileIndex[^\[]*\[([^\]]*)\]", line)
            rs = re.search(r"ReadSchema: (struct<[^>]*>)", line)
            pf = re.search(r"PushedFilters: (\[[^\]]*\])", line)
            item = (loc.group(1).split("/")[-1] if loc else "?", rs.group(1) if rs else "", pf.group(1) if pf else "")
            if item not in seen:
                seen.add(item)
                out.append(f"* scan `{item[0]}`: ReadSchema `{item[1]}`, PushedFilters `{item[2]}`")
        out.append("")
    with open(os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "PLANS.md"), "w") as f:
        f.write("\n".join(out))


if __name__ == "__main__":
    main()
