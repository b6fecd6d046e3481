"""Audit the physical plan of every registered query and write a markdown table.

For each key: shuffles by kind, broadcasts, Python nodes (Arrow-batched vs
row-at-a-time), windows (and whether any has no partition key), scans with their
pushed filters, and red flags (cartesian or nested-loop joins, row-at-a-time
Python UDFs).  Plans are the ones Spark prepares before adaptive re-planning;
eager steps (checkpoints, model fits) have already run when the plan is built,
so what is shown is the part after them.

Usage: python tools/plan_audit.py [--sf DIR] [--out PLANS.md] [key ...]
"""

from __future__ import annotations

import argparse
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

EXCHANGES = {
    "hash": r"Exchange hashpartitioning",
    "range": r"Exchange rangepartitioning",
    "round-robin": r"Exchange RoundRobinPartitioning",
    "single": r"Exchange SinglePartition",
}
PY_ARROW = r"\b(ArrowEvalPython|MapInPandas|MapInArrow|FlatMapGroupsInPandas|AggregateInPandas)\b"
PY_ROW = r"\bBatchEvalPython\b"
CROSS = r"\b(CartesianProduct|BroadcastNestedLoopJoin)\b"


def _unpartitioned(window_line: str) -> bool:
    """A window spec prints as windowspecdefinition(partition..., order..., frame): no
    partition key when the first argument is the frame or an ordering."""
    for m in re.finditer(r"windowspecdefinition\(([^,]*)", window_line):
        first = m.group(1)
        if first.startswith("specifiedwindowframe") or " ASC" in first or " DESC" in first:
            return True
    return False


def audit(plan: str) -> dict:
    out = {k: len(re.findall(p, plan)) for k, p in EXCHANGES.items()}
    out["broadcast"] = len(re.findall(r"BroadcastExchange", plan))
    out["python_arrow"] = len(re.findall(PY_ARROW, plan))
    out["python_row"] = len(re.findall(PY_ROW, plan))
    out["cross"] = len(re.findall(CROSS, plan))
    windows = [ln for ln in plan.splitlines() if re.match(r"^[\s:+-]*Window \[", ln)]
    out["windows"] = len(windows)
    out["windows_unpartitioned"] = sum(1 for ln in windows if _unpartitioned(ln))
    scans = re.findall(r"FileScan (\w+) \[.*?PushedFilters: \[(.*?)\]", plan)
    out["scans"] = len(scans)
    out["scans_with_pushed_filters"] = sum(1 for _, f in scans if f.strip())
    return out


def main() -> None:
    ap = argparse.ArgumentParser()
    ap.add_argument("--sf", default="/root/testdata/sf0.01")
    ap.add_argument("--out", default=None)
    ap.add_argument("keys", nargs="*")
    a = ap.parse_args()
    from tilth.plans.catalog import ORACLE, QUERIES, load_all
    from tilth.session import build_session
    load_all()
    spark = build_session(extra={"spark.ui.showConsoleProgress": "false"})
    jvm = spark.sparkContext._jvm
    rows = []
    for k in a.keys or list(QUERIES):
        t0 = time.perf_counter()
        df = QUERIES[k](spark, a.sf)
        plan = jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "simple")
        r = audit(plan)
        r["key"], r["oracle"] = k, "SQL" if k in ORACLE else "rows"
        r["build_sec"] = round(time.perf_counter() - t0, 2)
        flags = []
        if r["cross"]:
            flags.append("CROSS JOIN")
        if r["python_row"]:
            flags.append("ROW UDF")
        r["flags"] = ", ".join(flags)
        rows.append(r)
        print(r, flush=True)
    cols = ["key", "oracle", "hash", "range", "round-robin", "single", "broadcast", "python_arrow",
            "python_row", "windows", "windows_unpartitioned", "scans", "scans_with_pushed_filters", "flags"]
    lines = ["| " + " | ".join(cols) + " |", "|" + "---|" * len(cols)]
    lines += ["| " + " | ".join(str(r[c]) for c in cols) + " |" for r in rows]
    text = "\n".join(lines)
    if a.out:
        with open(a.out, "w") as f:
            f.write(HEADER.format(sf=a.sf, n=len(rows)) + text + "\n")
    else:
        print(text)
    spark.stop()


HEADER = """# Plan audit

Generated by `python tools/plan_audit.py --sf {sf} --out PLANS.md` over {n} registered keys.
Counts are operators in the physical plan Spark prepares before adaptive re-planning
(`explain()`); steps that run eagerly while the query is built (reliable checkpoints of the
running-sum primitive, model fits) are not part of that plan and are listed in README.

* `hash` / `range` / `round-robin` / `single`: shuffle exchanges by partitioning.
  `single` appears only under global aggregates (one partial row per task is moved) and
  `orderBy(...).limit(n)` top-k (n rows per task).  `round-robin` is the spreading of a
  scan that has fewer splits than the cluster has cores (one-row-group test files).
* `broadcast`: explicit broadcasts of tables bounded by an argument (fence table, fold
  coefficients, alert thresholds) or of one-row scalar subqueries.
* `python_arrow`: Arrow-batched Python (the running-sum `mapInPandas`, p-value tails on
  result rows).  `python_row`: row-at-a-time Python UDFs (must be 0).
* `windows_unpartitioned`: windows with no partition key; allowed only over tables whose
  size is bounded by an argument (k folds, runs listed in time order).
* `cross`: cartesian or nested-loop joins (must be 0).

"""


if __name__ == "__main__":
    main()
