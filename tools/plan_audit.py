"""Scans, reused shuffles and exchanges in the final adaptive plan of every registered query.

usage: python tools/plan_audit.py [sf_dir]
"""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from rivulet.plans.catalog import QUERIES  # noqa: E402
from rivulet.session import get_session  # noqa: E402


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.001"
    spark = get_session("local[8]", shuffle_partitions=8)
    print(f"{'query':28s} scans reused exchanges")
    for name, q in QUERIES.items():
        qe = q(spark, sf_dir)._jdf.queryExecution()  # noqa: SLF001
        qe.toRdd().count()
        text = qe.executedPlan().toString()
        if "== Final Plan ==" in text:
            text = text.split("== Final Plan ==", 1)[1].split("== Initial Plan ==", 1)[0]
        exchanges = sum(text.count(f"Exchange {k}") for k in ("hashpartitioning", "RoundRobin", "rangepartitioning",
                                                              "SinglePartition"))
        print(f"{name:28s} {text.count('FileScan parquet'):5d} {text.count('ReusedExchange'):6d} {exchanges:9d}")


if __name__ == "__main__":
    main()
