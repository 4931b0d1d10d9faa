"""Print the final (post-AQE) formatted physical plan of registered queries.

    python tools/show_plans.py [--sf-dir DIR] key [key ...]

Each query is run once (collected, so use a small scale) first, so adaptive decisions
(broadcast conversion, coalesced partitions, skew splits) show in the plan.
"""

from __future__ import annotations

import argparse
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def main() -> None:
    ap = argparse.ArgumentParser()
    ap.add_argument("--sf-dir", default="/root/testdata/sf0.01")
    ap.add_argument("keys", nargs="+")
    args = ap.parse_args()
    from logsmith.plans.registry import registry
    from logsmith.session import build_session
    spark = build_session("local[8]", shuffle_partitions=8)
    spark.sparkContext.setLogLevel("ERROR")
    reg = registry()
    for k in args.keys:
        df = reg[k].build(spark, args.sf_dir)
        df.collect()  # run this DataFrame itself so the final adaptive plan is shown
        print(f"===== {k}")
        df.explain("formatted")


if __name__ == "__main__":
    main()
