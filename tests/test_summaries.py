"""Heavy-hitter summaries and rank sketches: bounds, merging, exact results."""

import random
from collections import Counter

from pyspark.sql import functions as F

from logsmith.operators import kpis
from logsmith.operators import summaries as M
from logsmith.operators.common import RANK_ERROR, percentile_threshold
from logsmith.operators.parsing import parse_logs
from helpers import lines_df


def zipf_logs(spark, n=6000, urls=300, days=3, seed=1):
    rng = random.Random(seed)
    weights = [1 / (i + 1) ** 1.1 for i in range(urls)]
    lines = []
    for i in range(n):
        url = rng.choices(range(urls), weights)[0]
        day, hour = rng.randrange(1, days + 1), rng.randrange(24)
        if i % 3 == 0:
            url, hour = 0, 5                                  # a third of all rows: one url in one hour
        lines.append(f'10.0.0.{url % 40} - - [{day:02d}/Mar/2024:{hour:02d}:{i % 60:02d}:00 +0000] "GET /u/{url} HTTP/1.0" 200 {i % 7}')
    lines += ['h - - [32/Mar/2024:00:00:00 +0000] "GET /u/1 HTTP/1.0" 200 1'] * 5      # no timestamp
    return parse_logs(lines_df(spark, lines).repartition(6)).cache()


def summary_of(logs, key, hour, day, all_):
    return M.merge_summaries(M.merge_summaries(M.item_summaries(logs, key, "hour", hour), "day", day), None, all_)


def test_bounds_hold_at_every_level(spark):
    logs = zipf_logs(spark)
    exact = Counter(r.url for r in logs.select("url").collect())
    hourly = M.item_summaries(logs, "url", "hour", 4)
    per_hour = Counter((r.h, r.url) for r in logs.select(F.date_trunc("hour", "timestamp").alias("h"), "url").collect())
    spans = {}
    for r in hourly.collect():
        assert r.n == per_hour[(r.span, r.item)] and r.error == 0
        spans.setdefault(r.span, []).append(r)
    assert None in spans
    for span, rows in spans.items():
        held = {r.item for r in rows}
        assert len(rows) <= 4
        assert rows[0].missed == max((c for (h, u), c in per_hour.items() if h == span and u not in held), default=0)
    for capacity in (3, 20, 150):
        rows = summary_of(logs, "url", 4, 10, capacity).collect()
        assert len(rows) == min(capacity, len(rows)) and {r.span for r in rows} == {None}
        for r in rows:
            assert r.n <= exact[r.item] <= r.n + r.error
        held = {r.item for r in rows}
        assert rows[0].missed >= max((c for u, c in exact.items() if u not in held), default=0)


def test_merging_in_another_order_keeps_the_bounds(spark):
    logs = zipf_logs(spark, seed=2)
    exact = Counter(r.url for r in logs.select("url").collect())
    hourly = M.item_summaries(logs, "url", "hour", 5)
    for r in M.merge_summaries(hourly, None, 30).collect():
        assert r.n <= exact[r.item] <= r.n + r.error
    whole = M.merge_summaries(M.item_summaries(logs, "url", "hour", 1000), None, 1000).collect()
    assert {(r.item, r.n, r.error, r.missed) for r in whole} == {(u, n, 0, 0) for u, n in exact.items()}


def test_exact_top_equals_the_full_count(spark):
    logs = zipf_logs(spark)
    for capacities in ((1000, 1000, 1000), (40, 60, 100), (2, 3, 4)):     # complete, cut, too small to decide
        for k in (1, 5, 20):
            top = lambda rows: kpis.top_urls(rows, k)
            got = M.exact_top(logs, summary_of(logs, "url", *capacities), "url", k, top).collect()
            assert got == kpis.top_urls(logs, k).collect()
    few = M.exact_top(logs, summary_of(logs, "url", 1000, 1000, 1000), "url", 500, lambda rows: kpis.top_urls(rows, 500))
    assert few.count() == logs.select("url").distinct().count()


def test_exact_top_scans_candidates_only(spark):
    logs = zipf_logs(spark)
    seen = []

    def report(rows):
        seen.append(rows.select("url").distinct().count())
        return kpis.top_urls(rows, 3)
    M.exact_top(logs, summary_of(logs, "url", 60, 100, 200), "url", 3, report)
    assert 3 <= seen[0] < 30 < logs.select("url").distinct().count()


def test_empty_logs(spark):
    empty = parse_logs(spark.createDataFrame([], "value string"))
    summary = summary_of(empty, "url", 5, 5, 5)
    assert summary.count() == 0
    assert M.exact_top(empty, summary, "url", 3, lambda rows: kpis.top_urls(rows, 3)).count() == 0
    sketches = M.hourly_rank_sketches(kpis.per_minute_counts(empty))
    assert M.merged_threshold(sketches, 0.95).first().threshold is None
    assert kpis.peaks(empty, exact=False).count() == 0


def test_merged_sketches_keep_the_rank_error(spark):
    rng = random.Random(6)
    rows = [(f"2024-03-{d:02d} {h:02d}:{m:02d}", int(rng.paretovariate(1.2) * 10)) for d in range(1, 29) for h in range(24)
            for m in range(0, 60, 3)]
    per_minute = spark.createDataFrame(rows, "minute string, access_count long").repartition(5)
    counts = sorted(c for _, c in rows)
    for p in (0.5, 0.95, 0.99):
        for t in (M.merged_threshold(M.hourly_rank_sketches(per_minute), p).first().threshold,
                  percentile_threshold(per_minute, "access_count", p, exact=False).first().threshold):
            below, up_to = sum(c < t for c in counts) / len(counts), sum(c <= t for c in counts) / len(counts)
            assert below <= p + RANK_ERROR and up_to >= p - RANK_ERROR
