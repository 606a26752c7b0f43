"""Write PLANS.md: the shape of every engine query's final (AQE) plan.

For each query: shuffles executed, stages reused, join strategies, windows,
aggregates, Python nodes, and the columns each parquet scan reads.

Usage: python tools/plan_report.py [sf_dir] > PLANS.md
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def shape(plan: str) -> dict:
    def n(p):
        return len(re.findall(p, plan))
    scans = sorted(set(re.findall(r"FileScan parquet \[[^\]]*\].*?Location: \w+\(\d+ paths\)\[[^\]]*/([a-z]+)\.parquet\]"
                                  r".*?ReadSchema: (struct<[^>]*>)", plan)))
    return {
        "shuffles": n(r"ShuffleQueryStage"), "reused": n(r"ReusedExchange|ReusedQueryStage"),
        "bhj": n(r"BroadcastHashJoin"), "smj": n(r"SortMergeJoin"), "shj": n(r"ShuffledHashJoin"),
        "windows": n(r"\bWindow \["), "aggs": n(r"HashAggregate|ObjectHashAggregate|SortAggregate"),
        "python": n(r"EvalPython|MapInPandas|FlatMapGroupsInPandas"),
        "scans": "; ".join(f"{t}: {s[7:-1]}" for t, s in scans),
    }


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    from parlance.session import get_session
    from parlance.plans.catalog import QUERIES
    spark = get_session("local[8]", 8)
    print("# Query plans\n")
    print(f"Final adaptive plans of the registered queries at `{sf_dir}` (generated by "
          "`tools/plan_report.py`). `shuffles` counts executed shuffle stages, `reused` the stages "
          "AQE reused, `bhj`/`smj`/`shj` the join strategies chosen at run time.\n")
    print("| query | shuffles | reused | bhj | smj | shj | windows | aggregates | python | parquet columns read |")
    print("| --- | --- | --- | --- | --- | --- | --- | --- | --- | --- |")
    for name, q in sorted(QUERIES.items()):
        df = q(spark, sf_dir)
        df.collect()
        s = shape(df._jdf.queryExecution().executedPlan().toString())
        print(f"| `{name}` | {s['shuffles']} | {s['reused']} | {s['bhj']} | {s['smj']} | {s['shj']} | "
              f"{s['windows']} | {s['aggs']} | {s['python']} | {s['scans']} |", flush=True)


if __name__ == "__main__":
    main()
