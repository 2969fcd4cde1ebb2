"""Nearest block against a plain search: slots spread out, all in one day, and around the ends."""

from __future__ import annotations

import random
from datetime import datetime, timedelta

import pytest

from chainloom.operators.asof import HOUR_MICROS, nearest_asof

START = datetime(2024, 1, 1)


@pytest.mark.parametrize(("span_days", "slots_in_days", "bucket"), [(90, 120, HOUR_MICROS), (3, 1, HOUR_MICROS), (3, 1, 60_000_000), (400, 500, 86_400_000_000)])
def test_nearest_block(spark, span_days, slots_in_days, bucket):
    rng = random.Random(span_days)
    times = sorted(rng.sample(range(span_days * 86_400), 600))
    headers = [(i + 1, START + timedelta(seconds=t)) for i, t in enumerate(times)]
    slots = [START + timedelta(seconds=rng.uniform(-5, slots_in_days) * 86_400) for _ in range(300)]
    slots += [headers[0][1], headers[-1][1], headers[40][1], headers[40][1] + (headers[41][1] - headers[40][1]) / 2, slots[0]]
    out = nearest_asof(
        spark.createDataFrame([(s,) for s in slots], "slot timestamp"), spark.createDataFrame([*headers, (0, START)], "height bigint, time timestamp").repartition(4), bucket_micros=bucket
    ).collect()
    want = {s: min(headers, key=lambda h: (abs(h[1] - s), h[0])) for s in slots}
    assert {r.slot: (r.block_height, r.block_time) for r in out} == want and len(out) == len(want)


def test_no_headers_or_slots(spark):
    none = spark.createDataFrame([], "height bigint, time timestamp")
    assert nearest_asof(spark.createDataFrame([(START,)], "slot timestamp"), none).count() == 0
    assert nearest_asof(spark.createDataFrame([], "slot timestamp"), spark.createDataFrame([(1, START)], "height bigint, time timestamp")).count() == 0


def test_no_window_takes_all_rows(spark):
    slots, headers = spark.createDataFrame([(START,)], "slot timestamp"), spark.createDataFrame([(1, START)], "height bigint, time timestamp")
    plan = nearest_asof(slots, headers)._jdf.queryExecution().executedPlan().toString()
    assert "Window" in plan and "SinglePartition" not in "".join(line for line in plan.splitlines() if "Window" in line)
