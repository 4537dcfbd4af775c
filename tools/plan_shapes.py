"""Print the physical-plan shape of the headline queries (markdown table):
shuffles, broadcasts, windows, aggregates with a map-side partial step, and
the columns each scan reads. Usage: python tools/plan_shapes.py [sf_dir]"""
import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from bench import HEADLINE  # noqa: E402
from eventflow.plans.queries import QUERIES  # noqa: E402
from eventflow.session import build_session  # noqa: E402


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = build_session()
    print("| query | shuffles | broadcasts | windows | partial aggs | scans (columns read) |")
    print("|---|---|---|---|---|---|")
    for n in HEADLINE:
        if n == "classify":
            continue
        plan = QUERIES[n](spark, sf)._jdf.queryExecution().executedPlan().toString()
        shuffles = len(re.findall(r"Exchange (hashpartitioning|RoundRobin|rangepartitioning|SinglePartition)", plan))
        bcast = plan.count("BroadcastExchange")
        windows = len(re.findall(r"\bWindow \[", plan))
        partial = len(re.findall(r"functions=\[partial_", plan))
        scans = sorted(set(re.findall(r"FileScan parquet \[([^\]]*)\].*?/(\w+)\.parquet", plan)),
                       key=lambda t: t[1])
        cols = "; ".join(f"{t}: {re.sub(r'#\d+L?', '', c)}" for c, t in scans)
        print(f"| {n} | {shuffles} | {bcast} | {windows} | {partial} | {cols} |")


if __name__ == "__main__":
    main()
