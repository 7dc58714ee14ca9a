"""Print the physical plan shape of every registered query as a markdown table
(exchanges, joins, windows, Python stages, Expand/Generate), as in PLANS.md.

    python tools/plan_shapes.py [sf_dir]
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from skein.plans.queries import QUERIES  # noqa: E402
from skein.session import get_spark  # noqa: E402


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = get_spark("local[8]", shuffle_partitions=8)
    print("| query | exchanges | broadcast joins (static) | sort-merge joins | windows | Python stages |"
          " generate/expand |")
    print("|---|---|---|---|---|---|---|")
    for name, fn in QUERIES.items():
        plan = fn(spark, sf)._jdf.queryExecution().executedPlan().toString()
        ex = len(re.findall(r"(?<!Reused)Exchange (hashpartitioning|rangepartitioning|SinglePartition|RoundRobin)",
                            plan))
        print(f"| {name} | {ex} | {plan.count('BroadcastHashJoin')} | {plan.count('SortMergeJoin')} | "
              f"{plan.count('Window [')} | {plan.count('MapInArrow')} | "
              f"{plan.count('Generate ') + plan.count('Expand [')} |")
    spark.stop()


if __name__ == "__main__":
    main()
