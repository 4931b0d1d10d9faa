"""Monitoring metrics as one long-form table.

The reference keeps counters, gauges and a histogram in a process and serves
them over HTTP; here every metric is a row computed by Spark
``(name, kind, label_key, label_value, value)`` that any sink or dashboard can
read, and the text exposition form is a column expression.  No server.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from logsmith.operators.common import one_row_broadcast
from logsmith.operators.kpis import minute_rollup
from logsmith.scratch import stored
from logsmith.sources.runs import read_all_runs

# Metric names and the response-size histogram bounds with
# their exposition labels (bounds are inclusive upper limits).
REQUESTS_TOTAL = "log_requests_total"
REQUESTS_PER_MINUTE = "log_requests_per_minute"
UNIQUE_IPS = "log_unique_ips"
ERRORS_TOTAL = "log_errors_total"
BYTES_TOTAL = "log_bytes_transferred_total"
ANOMALOUS_IPS = "log_anomalous_ips"
RESPONSE_SIZE = "log_response_size_bytes"
SIZE_BUCKETS = [(100.0, "100.0"), (1000.0, "1000.0"), (10000.0, "10000.0"),
                (100000.0, "100000.0"), (1000000.0, "1e+06"), (float("inf"), "+Inf")]

def _row(df: DataFrame, name: str, kind: str, label_key: str, label_value, value) -> DataFrame:
    return df.select(F.lit(name).alias("name"), F.lit(kind).alias("kind"),
                     F.lit(label_key).alias("label_key"),
                     (label_value if label_value is not None else F.lit("")).cast("string").alias("label_value"),
                     value.cast("double").alias("value"))


def metrics_snapshot(logs: DataFrame, anomalies: DataFrame | None = None,
                     rollup: DataFrame | None = None) -> DataFrame:
    """X1-X4, X6, X7 as rows.

    The logs are scanned twice at most: for the minute rollup (stored here unless given),
    which all counters and the requests-per-minute gauge re-aggregate, and for the clients
    (not when ``anomalies``, one row per ip, is a stored table).
    """
    if rollup is None:
        rollup = stored(minute_rollup(logs), "metrics-rollup")
    base = (rollup.groupBy("status_category", "status", "is_error")
            .agg(F.sum("n").alias("n"), F.sum("bytes_sum").alias("b")))
    if anomalies is not None:
        clients = anomalies.agg(F.count(F.lit(1)).alias("clients"),
                                F.coalesce(F.sum("is_anomaly"), F.lit(0)).alias("flagged"))
    else:
        clients = logs.agg(F.countDistinct("ip").alias("clients"))
    clients = stored(clients, "metrics-clients")
    parts = [
        _row(base.groupBy("status_category").agg(F.sum("n").alias("v")),
             REQUESTS_TOTAL, "counter", "status_category", F.col("status_category"), F.col("v")),
        _row(clients, UNIQUE_IPS, "gauge", "", None, F.col("clients")),
        _row(base.filter(F.col("is_error") == 1).groupBy("status").agg(F.sum("n").alias("v")),
             ERRORS_TOTAL, "counter", "status_code", F.col("status"), F.col("v")),
        _row(base.agg(F.coalesce(F.sum("b"), F.lit(0)).alias("v")), BYTES_TOTAL, "counter", "", None, F.col("v")),
        _row(latest_minute_requests(logs, rollup), REQUESTS_PER_MINUTE, "gauge", "", None, F.col("v")),
    ]
    if anomalies is not None:
        parts.append(_row(clients, ANOMALOUS_IPS, "gauge", "", None, F.col("flagged")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def latest_minute_requests(logs: DataFrame, rollup: DataFrame | None = None) -> DataFrame:
    """Requests in the latest full minute, the minute before the one holding
    the newest timestamp (that one may still be filling); one row ``v``, 0 when
    that minute had no traffic."""
    if rollup is not None:
        stamped = rollup.filter(F.col("minute_ts").isNotNull())
        last = stamped.agg((F.max("minute_ts") - F.expr("INTERVAL 1 MINUTE")).alias("full"))
        return (stamped.crossJoin(one_row_broadcast(last))
                .agg(F.coalesce(F.sum(F.when(F.col("minute_ts") == F.col("full"), F.col("n"))), F.lit(0))
                     .alias("v")))
    stamped = logs.filter(F.col("timestamp").isNotNull())
    last = stamped.agg((F.date_trunc("minute", F.max("timestamp")) - F.expr("INTERVAL 1 MINUTE")).alias("full"))
    return (stamped.select(F.date_trunc("minute", F.col("timestamp")).alias("m"))
            .crossJoin(one_row_broadcast(last))
            .agg(F.count(F.when(F.col("m") == F.col("full"), 1)).alias("v")))


def response_size_histogram(logs: DataFrame) -> DataFrame:
    """Cumulative ``bytes <= bound`` counts plus count and sum, over **all** rows.

    Rows with NULL or 0 bytes are not observed (the reference skips falsy sizes).
    One aggregation pass; the reference observed only the first 1,000 rows.
    """
    obs = logs.filter(F.col("bytes").isNotNull() & (F.col("bytes") != 0))
    aggs = [F.count(F.lit(1)).alias("__count"), F.coalesce(F.sum(F.col("bytes").cast("decimal(38,0)")), F.lit(0)).alias("__sum")]
    for i, (bound, _) in enumerate(SIZE_BUCKETS):
        cond = F.lit(True) if bound == float("inf") else (F.col("bytes") <= bound)
        aggs.append(F.count(F.when(cond, 1)).alias(f"__b{i}"))
    wide = obs.agg(*aggs)
    rows = [F.struct(F.lit(f"{RESPONSE_SIZE}_bucket").alias("name"), F.lit(label).alias("le"),
                     F.col(f"__b{i}").cast("double").alias("value"))
            for i, (_, label) in enumerate(SIZE_BUCKETS)]
    rows += [F.struct(F.lit(f"{RESPONSE_SIZE}_count").alias("name"), F.lit("").alias("le"),
                      F.col("__count").cast("double").alias("value")),
             F.struct(F.lit(f"{RESPONSE_SIZE}_sum").alias("name"), F.lit("").alias("le"),
                      F.col("__sum").cast("double").alias("value"))]
    return wide.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def metrics_running_total(logs: DataFrame, run_col: str = "date") -> DataFrame:
    """Counter accumulation across runs.

    Each run adds its increment to the counter, as ``inc`` does.  A run is a
    value of ``run_col`` (by default a day of logs, or the ``run_id`` of a
    versioned export).  The window is partitioned by the label and runs over a
    table of (labels x runs) rows, not over log rows.
    """
    inc = (logs.groupBy(F.col(run_col).alias("run_id"), "status_category")
           .agg(F.count(F.lit(1)).alias("increment")))
    totals = running_totals(inc.withColumnRenamed("status_category", "label_value"), ["label_value"])
    return totals.select(F.lit(REQUESTS_TOTAL).alias("name"), "run_id", "label_value", "increment", "running_total")


def running_totals(increments: DataFrame, keys: list[str]) -> DataFrame:
    """Per (keys, run_id) the increment and the running total up to that run."""
    w = Window.partitionBy(*keys).orderBy("run_id").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return increments.select(*keys, "run_id", "increment", F.sum("increment").over(w).alias("running_total"))


def stored_counters(spark: SparkSession, base: str, table: str = "metrics") -> DataFrame:
    """X8 from stored runs: every counter of the metric tables of the runs under ``base``.

    Each committed run's table gives its increments, so the logs of earlier runs are not read
    again; a run that was written again counts once, with its new numbers.
    """
    runs = read_all_runs(spark, base, table).where(F.col("kind") == "counter")
    keys = ["name", "label_key", "label_value"]
    return running_totals(runs.select(*keys, "run_id", F.col("value").alias("increment")), keys)


def metrics_text(snapshot: DataFrame, histogram: DataFrame | None = None) -> DataFrame:
    """Exposition lines ``name{label="value"} number`` (integer-valued metrics)."""
    num = F.col("value").cast("bigint").cast("string")
    labelled = F.concat(F.col("name"), F.lit("{"), F.col("label_key"), F.lit("=\""),
                        F.col("label_value"), F.lit("\"} "), num)
    plain = F.concat(F.col("name"), F.lit(" "), num)
    lines = snapshot.select(F.when(F.col("label_key") == "", plain).otherwise(labelled).alias("line"))
    if histogram is not None:
        hist = histogram.select(F.when(
            F.col("le") == "", F.concat(F.col("name"), F.lit(" "), F.col("value").cast("bigint").cast("string")))
            .otherwise(F.concat(F.col("name"), F.lit("{le=\""), F.col("le"), F.lit("\"} "),
                                F.col("value").cast("bigint").cast("string"))).alias("line"))
        lines = lines.unionByName(hist)
    return lines
