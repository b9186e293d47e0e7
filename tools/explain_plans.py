"""Write PLANS.md: the physical plan of every registered batch query.

Usage: python tools/explain_plans.py [sf_dir] > PLANS.md

For each key: the operator tree of the formatted plan, then the scan's
pruning/pushdown lines and every exchange. Long expressions are cut.
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

KEEP = re.compile(r"^(PartitionFilters|PushedFilters|ReadSchema|Arguments: (hashpartitioning|"
                  r"rangepartitioning|SinglePartition)|Keys|Functions)")


def main() -> None:
    from loglens.plans import queries as Q
    from loglens.session import build_session
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session("local[8]", shuffle_partitions=8)
    print("# Physical plans of the registered batch queries\n")
    print(f"Generated by `tools/explain_plans.py` at `{os.path.basename(sf)}` (AQE initial plans).\n")
    for key, fn in Q.batch_queries().items():
        df = fn(spark, sf)
        text = spark._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")
        tree, details = text.split("\n\n", 1)
        print(f"## {key}\n\n```")
        print(tree.replace("== Physical Plan ==\n", "").rstrip())
        for line in details.splitlines():
            if KEEP.match(line):
                print("  " + (line if len(line) <= 160 else line[:157] + "..."))
        print("```\n")
    spark.stop()


if __name__ == "__main__":
    main()
