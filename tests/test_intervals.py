"""Interval operators against a plain model on random sets, many handlers at once."""

from __future__ import annotations

import random
from collections import defaultdict

import pytest

from chainloom.operators import intervals as iv
from chainloom.operators.sweep import sweep
from chainloom.plans.coverage import coverage_report

START, END = 50, 400
WINDOW = "handler string, start_height bigint, end_height bigint"
RANGE = "handler string, from_height bigint, to_height bigint"


def covered(ranges):
    return {h for f, t in ranges for h in range(f, t + 1)}


def runs(heights):
    out = []
    for h in sorted(heights):
        if out and h == out[-1][1] + 1:
            out[-1][1] = h
        else:
            out.append([h, h])
    return [tuple(r) for r in out]


@pytest.fixture(scope="module")
def data():
    rng = random.Random(7)
    sets = {}
    for i in range(24):
        # one handler owns most of the rows
        n = 400 if i == 0 else rng.randint(0, 25)
        reach = rng.choice([1, 5, 60, 300])
        sets[f"h{i}"] = [(f, f + rng.randint(0, reach)) for f in (rng.randint(0, 450) for _ in range(n))]
    return sets


@pytest.fixture(scope="module")
def frames(spark, data):
    rows = [(h, f, t) for h, rs in data.items() for f, t in rs]
    return (
        spark.createDataFrame(rows, RANGE).cache(),
        spark.createDataFrame([(h, START, END) for h in data], WINDOW).cache(),
    )


def grouped(df):
    out = defaultdict(list)
    for r in df.collect():
        out[r["handler"]].append((r["from_height"], r["to_height"]))
    return {h: sorted(v) for h, v in out.items()}


@pytest.mark.parametrize("width", [1, 7, 64, 1 << 17])
def test_merge(frames, data, width):
    want = {h: runs(covered(r)) for h, r in data.items() if r}
    assert grouped(iv.merge_ranges(frames[0], width=width)) == want


@pytest.mark.parametrize("width", [7, 1 << 17])
def test_gaps(frames, data, width):
    window = set(range(START, END + 1))
    want = {h: runs(window - covered(r)) for h, r in data.items()}
    got = grouped(iv.range_gaps(*frames, width=width))
    assert got == {h: g for h, g in want.items() if g}
    union = iv.union_gaps(*frames, width=width).collect()
    need = set().union(*[window - covered(r) for r in data.values()])
    assert sorted((r[0], r[1]) for r in union) == runs(need)


def test_gaps_of_empty_window(spark, frames):
    none = spark.createDataFrame([("h0", 10, 9)], WINDOW)
    assert iv.range_gaps(frames[0], none).count() == 0

def test_ranges_are_not_shuffled_by_handler(spark, frames, data):
    """One handler may own nearly all ranges, so its window goes to them."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        gaps = iv.range_gaps(*frames, width=64)
        for df, kind in ((gaps, "Inner"), (iv.coverage_ratio(*frames, width=64), "Inner"), (iv.prune_outside_window(frames[0], frames[0].selectExpr("handler", "from_height as height"), frames[1])[0], "LeftOuter")):
            plan = df._jdf.queryExecution().executedPlan().toString()
            assert any("BroadcastHashJoin [handler" in x and kind in x for x in plan.split("\n"))
        want = {h: runs(set(range(START, END + 1)) - covered(r)) for h, r in data.items()}
        assert grouped(gaps) == {h: g for h, g in want.items() if g}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


@pytest.mark.parametrize("salts", [1, 3])
def test_overlap_join(spark, frames, data, salts):
    rng = random.Random(3)
    asked = {h: {(f, f + rng.choice([0, 1, 30, 400])) for f in (rng.randint(0, 450) for _ in range(5))} for h in data}
    left = spark.createDataFrame([(h, f, t) for h, rs in asked.items() for f, t in rs], RANGE)
    got = sorted((r.handler, r.from_height, r.to_height, r.r_from, r.r_to) for r in iv.range_overlap_join(left, frames[0], salts=salts).collect())
    want = sorted(
        (h, f, t, a, b) for h, rs in asked.items() for f, t in rs for a, b in data[h] if a <= t and b >= f
    )
    assert got == want


def test_short_ranges_are_copied_once(spark, monkeypatch):
    """Ranges of 1 to 8 heights need a row per bucket they touch, not one more for each length of the other side."""
    spread, copies = iv._spread, []

    def counted(df, lo, hi, first):
        out = spread(df, lo, hi, first)
        copies.append((lo, out.count()))
        return out

    monkeypatch.setattr(iv, "_spread", counted)
    left = [("a", 5 * i, 5 * i + i % 6) for i in range(100)]
    right = [("a", 3 * i, 3 * i + i % 8) for i in range(200)]
    met = iv.range_overlap_join(spark.createDataFrame(left, RANGE), spark.createDataFrame(right, RANGE), salts=2)
    got = sorted((r.from_height, r.to_height, r.r_from, r.r_to) for r in met.collect())
    assert got == sorted((f, t, a, b) for _, f, t in left for _, a, b in right if a <= t and b >= f)
    assert sum(n for lo, n in copies if lo == "r_from") < 2 * len(right)


def test_needs(spark, frames, data):
    rng = random.Random(5)
    asked = sorted({(h, f, f + rng.choice([-1, 0, 3, 40])) for h in data for f in (rng.randint(0, 450) for _ in range(6))})
    got = {(r.handler, r.from_height, r.to_height): r.needs for r in iv.needs_range(frames[0], spark.createDataFrame(asked, RANGE), width=16).collect()}
    assert got == {(h, f, t): not set(range(f, t + 1)) <= covered(data[h]) for h, f, t in asked}


def test_points(spark, frames, data):
    rng = random.Random(9)
    points = {(h, rng.randint(0, 450)) for h in data for _ in range(40)}
    pts = spark.createDataFrame(sorted(points), "handler string, height bigint")
    islands = grouped(iv.points_to_islands(pts, width=16))
    assert islands == {h: runs(p for x, p in points if x == h) for h in data}
    gaps = iv.range_gaps(*frames, width=16)
    left = grouped(iv.subtract_points(gaps, pts, width=16))
    window = set(range(START, END + 1))
    want = {h: runs(window - covered(r) - {p for x, p in points if x == h}) for h, r in data.items()}
    assert left == {h: w for h, w in want.items() if w}


def test_chunks_and_heights(spark, data):
    df = spark.createDataFrame([("a", 5, 25), ("a", 26, 26), ("b", 0, 40000)], RANGE)
    chunks = grouped(iv.chunk_ranges(df, 10).where("handler = 'a'"))
    assert chunks["a"] == [(5, 14), (15, 24), (25, 25), (26, 26)]
    heights = iv.expand_ranges(df.where("handler = 'b'"))
    assert (heights.count(), heights.distinct().count()) == (40001, 40001)


def test_split_at_horizons(spark):
    df = spark.createDataFrame([("a", 1, 100), ("b", 50, 60)], RANGE)
    hor = spark.createDataFrame([(50, False), (55, False), (70, True), (1, False), (0, False)], "earliest_height bigint, disabled boolean")
    assert grouped(iv.split_ranges_at(df, hor)) == {"a": [(1, 49), (50, 54), (55, 100)], "b": [(50, 54), (55, 60)]}


def test_coverage_counts_overlaps_once(spark):
    df = spark.createDataFrame([("a", 1, 10), ("a", 5, 20), ("a", 90, 200)], RANGE)
    win = spark.createDataFrame([("a", 1, 100), ("b", 1, 10), ("c", 5, 4)], WINDOW)
    assert {r.handler: r.ratio for r in iv.coverage_ratio(df, win).collect()} == {"a": 0.31, "b": 0.0, "c": 0.0}


@pytest.mark.parametrize("width", [1, 7, 64, 1 << 17])
def test_sweep_depths(frames, data, width):
    ranges, windows = frames
    inside = windows.withColumnsRenamed({"start_height": "from_height", "end_height": "to_height"})
    got = sweep({"stored": ranges, "window": inside}, ["handler"], width, until="stored").collect()
    for h, rs in data.items():
        rows = sorted((r for r in got if r.handler == h), key=lambda r: r["at"])
        assert [r.next_at for r in rows] == [r["at"] for r in rows[1:]] + [None]
        assert (rows[-1].stored, rows[-1].window) == (0, 0)
        before = 0
        for r in rows:
            assert (r.stored, r.stored_before) == (sum(f <= r["at"] <= t for f, t in rs), before)
            assert r.window == (START <= r["at"] <= END)
            assert r.stored_until == next(x for x in range(r["at"], 2000) if x not in covered(rs))
            before = r.stored


def test_points_at_ends_and_in_overlapping_ranges(spark):
    df = spark.createDataFrame([("a", 1, 9), ("a", 4, 12), ("a", 4, 12), ("a", 5, 5), ("b", 1, 3), ("c", 3, 2)], RANGE)
    pts = spark.createDataFrame([("a", 1), ("a", 5), ("a", 5), ("a", 6), ("a", 12), ("z", 2)], "handler string, height bigint")
    for width in (1, 4, 1 << 17):
        assert grouped(iv.subtract_points(df, pts, width=width)) == {
            "a": [(2, 4), (4, 4), (7, 9), (7, 11)],
            "b": [(1, 3)],
        }


def test_report_against_the_model(spark, frames, data):
    rng = random.Random(11)
    failed = {h: {rng.randint(0, 450) for _ in range(rng.randint(0, 30))} for h in data}
    ledger = spark.createDataFrame(
        [(h, p, False, False, 1) for h, ps in failed.items() for p in ps],
        "handler string, height bigint, permanent boolean, in_retry boolean, retries int",
    )
    windows = frames[1].union(spark.createDataFrame([("empty", 10, 9), ("bare", 10, 19)], WINDOW))
    genesis, tip = 20, 420
    got = {r.handler: r for r in coverage_report(frames[0], ledger, windows, genesis, tip, 16).collect()}
    assert set(got) == {*data, "empty", "bare"}
    window, chain = set(range(START, END + 1)), set(range(genesis, tip + 1))
    for h, rs in data.items():
        have, bad, r = covered(rs), failed[h], got[h]
        gaps = window - have - bad
        assert (r.covered_start, r.covered_end) == ((min(have), max(have)) if have else (None, None))
        assert (r.ranges, r.gaps, r.gap_heights) == (len(runs(have)), len(runs(gaps)), len(gaps))
        assert (r.failed_ranges, r.open_failures, r.retrying) == (len(runs(bad)), len(bad - have), len(bad))
        assert r.window_pct == pytest.approx(100 * len(have & window) / len(window))
        assert r.chain_pct == pytest.approx(100 * len(have & chain) / len(chain))
    assert (got["empty"].window_pct, got["empty"].gaps, got["bare"].gap_heights) == (0.0, 0, 10)
