"""Stored snapshots: nothing is due twice, one bad date leaves the others, a cut-short commit shows nothing."""

from __future__ import annotations

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from chainloom.plans.snapshots import SnapshotStore, due_targets, run_snapshots, stored_status
from chainloom.sinks.tables import BatchTable

TABLES = {"snapshots": "snapshot_date date, status string, error string", "rows": "block_height bigint, n bigint"}


class Snap:
    name = "snap"

    def __init__(self, spark, root, bad=()):
        self.store, self.bad, self.calls = SnapshotStore(spark, root, TABLES), set(bad), []

    def snapshot(self, targets):
        dates = sorted(r.snapshot_date for r in targets.select("snapshot_date").collect())
        self.calls.append(dates)
        if self.bad & set(dates):
            raise RuntimeError("no answer")
        rows = targets.withColumns({"status": F.lit("ok"), "error": F.lit(None).cast("string"), "n": F.col("block_height") * 10})
        return {"snapshots": rows, "rows": rows.unionByName(rows)}


@pytest.fixture(scope="module")
def calendar(spark):
    days = [datetime(2024, m, 1, 15) for m in (1, 2, 3)]
    slots = spark.createDataFrame([(d, d.date()) for d in days], "slot timestamp, slot_date date")
    headers = spark.createDataFrame([(i + 1, datetime(2024, m, 1, 14)) for i, m in enumerate((1, 2, 3))], "height bigint, time timestamp")
    return slots, headers


def test_runs_take_what_is_due_and_a_bad_date_leaves_the_others(spark, calendar, tmp_path):
    slots, headers = calendar
    now = F.lit("2024-04-01").cast("timestamp")
    snap, views = Snap(spark, str(tmp_path / "a"), {date(2024, 2, 1)}), []
    report = run_snapshots([snap], slots, headers, now, [lambda: views.append(1)])
    assert report == {"snap": {"2024-02-01": "no answer"}} and len(snap.calls) == 4 and views == [1]
    assert sorted((r.block_height, r.n) for r in snap.store.read("rows").collect()) == [(1, 10), (1, 10), (3, 30), (3, 30)]
    states = {r.slot_date.month: r.state for r in stored_status(snap.store, slots).collect()}
    assert states == {1: "covered", 2: "missing", 3: "covered"}
    snap.bad.clear()
    assert run_snapshots([snap], slots, headers, now) == {"snap": {}} and snap.calls[-1] == [date(2024, 2, 1)]
    assert due_targets(snap.store, slots, headers).count() == 0 and len(snap.store.read("rows").collect()) == 6
    before = len(snap.calls)
    assert run_snapshots([snap], slots, headers, now, [lambda: views.append(2)]) == {"snap": {}}
    assert len(snap.calls) == before and views == [1]


def test_a_date_taken_again_is_replaced_and_a_cut_short_commit_shows_nothing(spark, calendar, tmp_path, monkeypatch):
    slots, headers = calendar
    now = F.lit("2024-04-01").cast("timestamp")
    snap = Snap(spark, str(tmp_path / "b"))
    targets = due_targets(snap.store, slots, headers)
    monkeypatch.setattr(BatchTable, "commit", lambda *a: (_ for _ in ()).throw(InterruptedError()))
    with pytest.raises(InterruptedError):
        snap.store.commit(targets, snap.snapshot(targets), now)
    monkeypatch.undo()
    assert snap.store.read("rows").count() == 0 and due_targets(snap.store, slots, headers).count() == 3
    snap.store.commit(targets, snap.snapshot(targets), now)
    one = targets.where("block_height = 2")
    again = snap.snapshot(one)
    snap.store.commit(one, {k: v.withColumn("n", F.lit(7).cast("bigint")) for k, v in again.items()}, now)
    assert sorted({(r.block_height, r.n) for r in snap.store.read("rows").collect()}) == [(1, 10), (2, 7), (3, 30)]
    assert snap.store.taken().count() == 3
