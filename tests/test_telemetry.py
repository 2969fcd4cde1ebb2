"""Request-log metrics where one source and ten minutes hold nearly all rows."""

from __future__ import annotations

import random
from bisect import bisect_left, bisect_right
from collections import Counter, defaultdict
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from chainloom.operators import telemetry as tm
from chainloom.operators.prefix import BUCKET, even_bounds, with_bucket

LOG = "source string, at timestamp, request_id bigint, latency_ms double, total bigint"
T0 = datetime(2024, 1, 1, tzinfo=timezone.utc)
DEPTH = 64


@pytest.fixture(scope="module")
def log():
    rng = random.Random(2)
    rows, total = [], 0
    for i in range(3000):
        hot = i % 10 > 0
        source = "hot" if hot else f"s{i % 3}"
        at = 86_400_000 + rng.randint(0, 600_000) if hot else rng.randint(0, 3 * 86_400_000)
        rows.append([source, at, i, float(rng.randint(1, 5000))])
    out = []
    for source, at, i, ms in sorted(rows):
        total += i % 7
        out.append((source, T0 + timedelta(milliseconds=at), i, ms, total))
    return out


@pytest.fixture(scope="module")
def frame(spark, log):
    return spark.createDataFrame(log, LOG).repartition(4).cache()


def by_source(log):
    out = defaultdict(list)
    for r in log:
        out[r[0]].append(r)
    return {s: sorted(rs, key=lambda r: (r[1], r[2])) for s, rs in out.items()}


def test_no_bucket_is_deep(frame):
    micros = F.unix_micros("at")
    bounds = even_bounds(frame, micros, DEPTH)
    sized = with_bucket(frame, micros, 600_000_000, bounds).groupBy("source", BUCKET).count()
    assert max(r["count"] for r in sized.collect()) <= 2 * DEPTH
    # the order of buckets is the order of time
    spans = with_bucket(frame, micros, 600_000_000, bounds).groupBy(BUCKET).agg(F.min("at").alias("lo"), F.max("at").alias("hi"))
    spans = sorted(spans.collect(), key=lambda r: r[BUCKET])
    assert all(a.hi < b.lo for a, b in zip(spans, spans[1:]))


def test_tasks_of_a_hot_source_are_even(frame):
    micros = F.unix_micros("at")
    cut = with_bucket(frame, micros, 600_000_000, even_bounds(frame, micros, 16))
    parts = cut.repartition(4, "source", BUCKET).groupBy(F.spark_partition_id()).count().collect()
    assert max(r["count"] for r in parts) <= 2 * frame.count() / 4


@pytest.mark.parametrize("bounds", [[5], [5, 9], [1, 5, 9, 12], list(range(0, 26, 2))])
def test_bounds_are_found(spark, bounds):
    rows = with_bucket(spark.range(-3, 30), F.col("id"), 1000, bounds).where("id >= 0").collect()
    assert {r.id: r[BUCKET] for r in rows} == {i: bisect_right(bounds, i) for i in range(30)}


def test_empty_log(spark):
    empty = spark.createDataFrame([], LOG)
    assert even_bounds(empty, F.unix_micros("at"), 1) == []
    assert tm.rolling_rps(empty).count() == tm.rolling_rate(empty).count() == tm.peak_in_flight(empty).count() == 0


def test_rps(frame, log):
    got = {r.request_id: (r.requests, r.rps) for r in tm.rolling_rps(frame, 60, DEPTH).collect()}
    for rows in by_source(log).values():
        times = [r[1] for r in rows]
        for n, r in enumerate(rows):
            lo = bisect_left(times, r[1] - timedelta(seconds=60))
            seconds = (r[1] - times[lo]).total_seconds()
            assert got[r[2]] == (n - lo + 1, pytest.approx((n - lo + 1) / max(seconds, 0.25)))
    assert len(got) == len(log)


def test_rate(frame, log):
    got = {r.request_id: r.rate for r in tm.rolling_rate(frame, 60, DEPTH).collect()}
    for rows in by_source(log).values():
        times = [r[1] for r in rows]
        for r in rows:
            anchor = rows[max(bisect_left(times, r[1] - timedelta(seconds=60)) - 1, 0)]
            seconds = (r[1] - anchor[1]).total_seconds()
            assert got[r[2]] == pytest.approx((r[4] - anchor[4]) / seconds if seconds > 0 else 0)
    assert len(got) == len(log)


def test_peak(frame, log):
    got = {r.source: r.peak for r in tm.peak_in_flight(frame, DEPTH).collect()}
    for source, rows in by_source(log).items():
        steps = Counter()
        for r in rows:
            steps[r[1]] += 1
            steps[r[1] + timedelta(milliseconds=r[3])] -= 1
        open_, peak = 0, 0
        for t in sorted(steps):
            open_ += steps[t]
            peak = max(peak, open_)
        assert got[source] == peak
