"""Print the formatted physical plan of registered queries.

Usage: python tools/show_plans.py [--sf DIR] key [key ...]
"""

from __future__ import annotations

import argparse
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def main() -> None:
    ap = argparse.ArgumentParser()
    ap.add_argument("--sf", default="/root/testdata/sf0.1")
    ap.add_argument("keys", nargs="+")
    a = ap.parse_args()
    from tilth.session import build_session
    from tilth.plans.catalog import QUERIES, load_all
    load_all()
    spark = build_session(extra={"spark.ui.showConsoleProgress": "false"})
    for k in a.keys:
        print(f"===== {k}")
        QUERIES[k](spark, a.sf).explain("formatted")


if __name__ == "__main__":
    main()
