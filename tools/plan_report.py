"""Summarise the physical plan of every registered query (PLANS.md).

Usage: python tools/plan_report.py [sf_dir] > PLANS.md
Counts come from ``explain("formatted")`` of the final adaptive plan:
Parquet/text scans, shuffle exchanges by kind, broadcast exchanges, whether
filters reach a scan, group limits, sorts-with-limit, and Python UDF nodes.
"""

from __future__ import annotations

import contextlib
import io
import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from arearisk.session import get_session  # noqa: E402


def plan_text(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def final_blocks(text: str) -> list[tuple[str, str]]:
    """(node name, detail block) for the nodes of the final adaptive plan
    (the explain text also lists the initial plan, which is skipped)."""
    text = text.split("===== Subqueries =====")[0]
    head, _, details = text.partition("\n\n(")
    details = "(" + details
    if "== Final Plan ==" in head:
        tree = head.split("== Final Plan ==")[1].split("== Initial Plan ==")[0]
        ids = set(re.findall(r"\((\d+)\)", tree))
    else:
        ids = None
    blocks = re.split(r"\n(?=\(\d+\) )", details)
    out = []
    for blk in blocks:
        m = re.match(r"\((\d+)\) ([A-Za-z]+)", blk)
        if m and (ids is None or m.group(1) in ids):
            out.append((m.group(2), blk))
    return out


def summary(text: str) -> dict:
    blocks = final_blocks(text)
    names = [n for n, _ in blocks]
    args = [re.search(r"Arguments: (hashpartitioning|RoundRobinPartitioning|rangepartitioning|SinglePartition)", b)
            for n, b in blocks if n == "Exchange"]
    args = [a.group(1) for a in args if a]
    pushed = [p for _, b in blocks for p in re.findall(r"PushedFilters: \[(.*)\]", b) if p.strip()]
    return {
        "scans": names.count("Scan"),
        "hash": args.count("hashpartitioning"),
        "range": args.count("rangepartitioning"),
        "single": args.count("SinglePartition"),
        "persisted": names.count("InMemoryTableScan"),
        "broadcast": names.count("BroadcastExchange"),
        "reused": names.count("ReusedExchange"),
        "pushed": "yes" if pushed else "-",
        "group_limit": "yes" if "WindowGroupLimit" in names else "-",
        "take_ordered": "yes" if "TakeOrderedAndProject" in names else "-",
        "python_udf": "YES" if any(n in names for n in ("BatchEvalPython", "ArrowEvalPython")) else "none",
    }


def main() -> None:
    d = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    from arearisk.plans.registry import QUERIES
    spark = get_session("local[8]", 8)
    cols = ["scans", "hash", "range", "single", "persisted", "broadcast", "reused", "pushed", "group_limit",
            "take_ordered", "python_udf"]
    print("# Physical plans of the registered queries\n")
    print(f"Generated by `tools/plan_report.py {d}` from the final adaptive plans (after execution, "
          "so exchanges that AQE reuses are counted under `reused`, not again). `hash`/`range`/`single` count shuffle exchanges. `persisted` counts reads of "
          "the per-area profile that a query persists: its own plan is that of `report_area_profile`, run once. `broadcast` "
          "counts broadcasts chosen by the planner's size check (no hints). `pushed` means filters "
          "reached a scan.\n")
    print("How to read it: a per-area sub-report has one scan per source table and three hash exchanges. "
          "They are the partial profile aggregate, the rank window (partial `WindowGroupLimit` before it) and "
          "the small per-area fold. The joined profile therefore has 3 + 3 + 1, and AQE turns its joins into "
          "broadcasts after measuring the per-area sides. Raw-line queries derive their lines from the "
          "table's scan and have no exchange; scan and sink queries write and read back, as that is what they do.\n")
    print("| query | " + " | ".join(cols) + " |")
    print("| --- | " + " | ".join("---" for _ in cols) + " |")
    for name, fn in sorted(QUERIES.items()):
        spark.catalog.clearCache()         # a profile persisted by another query
        df = fn(spark, d)
        df.collect()                       # the final adaptive plan is attached after execution
        s = summary(plan_text(df))
        print(f"| `{name}` | " + " | ".join(str(s[c]) for c in cols) + " |")


if __name__ == "__main__":
    main()
