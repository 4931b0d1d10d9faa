"""Micro-measurements behind design choices (best of 3, ``noop`` sink, cached input).

    python tools/microbench.py [--sf-dir DIR] [--cpus N]

* parse: one-pass split (the library) against nine ``regexp_extract`` calls;
* keep-matched: explode of a 0-or-1 array against a plain filter on the fields;
* client features: ``active_hours`` as a bitmask against a third distinct count.
"""

from __future__ import annotations

import argparse
import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def main() -> None:
    ap = argparse.ArgumentParser()
    ap.add_argument("--sf-dir", default="/root/testdata/sf0.1")
    ap.add_argument("--cpus", type=int, default=8)
    args = ap.parse_args()

    from pyspark.sql import functions as F

    from logsmith.functions import logline as L
    from logsmith.operators import anomaly, parsing
    from logsmith.session import build_session
    from logsmith.sources.fixtures import event_log_lines

    spark = build_session(f"local[{args.cpus}]", shuffle_partitions=args.cpus)
    spark.sparkContext.setLogLevel("ERROR")
    lines = event_log_lines(spark, args.sf_dir).cache()
    n = lines.count()

    def best(df, reps=5):
        times = []
        for _ in range(reps):
            t0 = time.perf_counter()
            df.write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - t0)
        return round(min(times), 3)

    nine = lines.select(*L.extract_fields_slow(F.col("value")))
    filtered_plain = parsing.parse_fields(lines).filter((F.col("ip") != "") & (F.col("timestamp_str") != ""))
    logs = parsing.parse_logs(lines).cache()
    logs.count()
    # the same feature set with the hour count as a third distinct aggregate
    distinct_hours = logs.groupBy("ip").agg(
        F.count(F.lit(1)).alias("request_count"), F.countDistinct("url").alias("unique_urls"),
        F.countDistinct("date").alias("active_days"), F.sum("bytes").alias("total_bytes"),
        F.avg("bytes").alias("avg_bytes"), F.sum("is_error").alias("error_count"),
        F.countDistinct("hour").alias("active_hours")).select(
        "*", (F.col("error_count") / F.col("request_count")).alias("error_rate"),
        (F.col("request_count") / F.col("active_days")).alias("requests_per_day"),
        (F.col("total_bytes") / F.col("request_count")).alias("bytes_per_request"),
        (F.col("unique_urls") / F.col("request_count")).alias("urls_per_request"))
    out = {
        "lines": n,
        "parse_one_pass_all_lines": best(parsing.parse_fields(lines)),
        "parse_nine_extract_all_lines": best(nine),
        "keep_matched_generate": best(parsing.matched_fields(lines)),
        "keep_matched_plain_filter": best(filtered_plain),
        # each measured twice, interleaved, so JIT warm-up does not favour the later one
        "client_features_three_distincts": best(distinct_hours),
        "client_features_bitmask_hours": best(anomaly.client_features(logs)),
        "client_features_three_distincts_2": best(distinct_hours),
        "client_features_bitmask_hours_2": best(anomaly.client_features(logs)),
    }
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
