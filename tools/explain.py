"""Print the physical plan of a registered query.

usage: python tools/explain.py NAME [sf_dir] [--final]
  --final  run the query (noop) first and print the final adaptive plan
"""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from rivulet.plans.catalog import QUERIES  # noqa: E402
from rivulet.session import get_session  # noqa: E402


def main() -> None:
    args = [a for a in sys.argv[1:] if not a.startswith("--")]
    name, sf_dir = args[0], (args[1] if len(args) > 1 else "/root/testdata/sf0.01")
    spark = get_session("local[8]", shuffle_partitions=8)
    df = QUERIES[name](spark, sf_dir)
    if "--final" in sys.argv:
        qe = df._jdf.queryExecution()  # noqa: SLF001
        qe.toRdd().count()
        print(qe.executedPlan().toString())
    else:
        df.explain("formatted")


if __name__ == "__main__":
    main()
