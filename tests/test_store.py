"""The event store: crashes before the manifest, pruned batches, claims, runs, landed buckets."""

from __future__ import annotations

import time

import pytest
from pyspark.sql import functions as F

from chainloom import schemas
from chainloom.catalog import standins
from chainloom.catalog.ingest_side import NotesHandler
from chainloom.constants import RELAY_HANDLER
from chainloom.operators.intervals import expand_ranges
from chainloom.operators.ledger import fold_failures, record_failures, record_permanent
from chainloom.plans.backfill import backfill_window
from chainloom.plans.ingest import RelayStore
from chainloom.plans.store import EventStore
from chainloom.sources.landed import LandedBlocks

def now():
    return F.lit("2024-01-01").cast("timestamp")


class CutShort(RelayStore):
    def commit(self, lines, batch_id):
        raise InterruptedError(batch_id)


def state(store):
    """What a reader sees: facts, waiting heights, covered heights, rollup rows."""
    facts = store.facts.read()
    assert facts.count() == facts.dropDuplicates(schemas.FACT_KEY).count()
    return (
        sorted(r[0] for r in facts.select("block_height").collect()),
        sorted((r.height, r.retries, r.in_retry) for r in store.ledger().collect()),
        sorted({r.height for r in expand_ranges(store.coverage()).collect()}),
        store.daily().agg(F.sum("cu")).first()[0],
    )


@pytest.fixture(scope="module")
def blocks(spark, sf_dir):
    """Forty landed blocks, some of them broken, and the same blocks mended; written out."""
    broken = standins.build_blocks(spark, sf_dir)
    bad = sorted(r.event_id for r in standins.events(spark, sf_dir).where("k in (13, 17)").orderBy("event_id").limit(3).collect())
    wanted = F.col("height").isin(*bad) | F.col("height").between(5, 41)
    keep = lambda df: spark.createDataFrame(df.where(wanted).collect(), schemas.LANDED_BLOCKS)
    return keep(broken).cache(), keep(standins.build_blocks(spark, sf_dir, broken=False)).cache(), bad


def test_a_batch_cut_short_shows_nothing_and_is_repeated(spark, blocks, tmp_path):
    landed, _, bad = blocks
    store = RelayStore(spark, f"{tmp_path}/a")
    with pytest.raises(InterruptedError):
        CutShort(spark, f"{tmp_path}/a").ingest(landed, "x", now())
    assert state(store) == ([], [], [], None) and store.quarantine.read().count() == 0
    store.ingest(landed, "x", now())
    seen = state(store)
    assert [h for h, *_ in seen[1]] == [h for h in bad] and set(seen[2]).isdisjoint(bad) and seen[0] == seen[2]
    store.ingest(landed.limit(1), "x", now())
    assert state(store) == seen


def test_a_retry_cut_short_loses_no_height(spark, blocks, tmp_path):
    landed, mended, bad = blocks
    store = RelayStore(spark, f"{tmp_path}/s")
    store.ingest(landed, "x", now())
    with pytest.raises(InterruptedError):
        CutShort(spark, f"{tmp_path}/s").retry_failures(mended, "r", now(), 2, 5)
    assert [(h, c) for h, _, c in state(store)[1]] == [(bad[0], False), (bad[1], True), (bad[2], True)]
    # another retry leaves claimed heights alone
    store.retry_failures(landed, "other", now(), 10, 5)
    assert [(h, n) for h, n, _ in state(store)[1]] == [(bad[0], 2), (bad[1], 1), (bad[2], 1)]
    assert store.resume_retries(mended, now(), 5) == ["r"] and store.resume_retries(mended, now(), 5) == []
    store.retry_failures(mended, "r", now(), 2, 5)
    facts, waiting, covered, _ = state(store)
    assert [h for h, *_ in waiting] == [bad[0]] and set(bad[1:]) <= set(covered) and set(bad[1:]) <= set(facts)


def test_folded_ledger_equals_updates_in_order(spark):
    """Random failures, permanent ones and recoveries, against the stepwise rules."""
    import random

    rng = random.Random(6)
    log, covered, ledger = [], [], spark.createDataFrame([], schemas.FAILURES)
    for seq in range(1, 8):
        at = F.lit(f"2024-01-0{seq}").cast("timestamp")
        failing = rng.sample(range(6), 3)
        permanent = failing[:1] if seq % 3 == 0 else []
        rows = [("h", h, f"r{seq}", 0) for h in failing]
        kind = "handler string, height bigint, reason string, seq bigint"
        if permanent:
            ledger = record_permanent(ledger, spark.createDataFrame([r for r in rows if r[1] in permanent], kind), at)
        ledger = record_failures(ledger, spark.createDataFrame([r for r in rows if r[1] not in permanent], kind), at, 4)
        done = [h for h in range(6) if h not in failing and rng.random() < 0.3]
        ledger = ledger.where(~F.col("height").isin(done or [-1]))
        ledger = spark.createDataFrame(ledger.collect(), schemas.FAILURES)
        log += [("h", h, f"r{seq}", h in permanent, 4, seq, f"2024-01-0{seq}") for h in failing]
        covered += [("h", h, h, seq) for h in done]
    log_df = spark.createDataFrame(log, "handler string, height bigint, reason string, permanent boolean, max_retries int, seq bigint, at string")
    log_df = log_df.withColumn("at", F.col("at").cast("timestamp"))
    folded = fold_failures(
        log_df, spark.createDataFrame(covered, "handler string, from_height bigint, to_height bigint, seq bigint"), spark.createDataFrame([], schemas.CLAIMS)
    )
    assert covered
    columns = ["height", "reason", "retries", "permanent", "first_seen_at", "last_seen_at", "in_retry"]
    rows = lambda df: sorted(tuple(r) for r in df.select(*columns).collect())
    assert rows(folded) == rows(ledger)


def test_a_batch_that_overlaps_none_reads_no_stored_row(spark, blocks, tmp_path, monkeypatch):
    landed, _, _ = blocks
    store = RelayStore(spark, f"{tmp_path}/p", rollup=False)
    read = []
    original = type(store.facts).read_batches
    monkeypatch.setattr(type(store.facts), "read_batches", lambda self, ids: read.append((self.path, ids)) or original(self, ids))
    part = lambda lo, hi: landed.where(F.col("height").between(lo, hi))
    for i, (lo, hi) in enumerate([(5, 14), (25, 34), (15, 24)]):
        store.ingest(part(lo, hi), f"b{i}", now())
    assert [r for r in read if "relay_payments" in r[0]] == []
    before = store.facts.read().count()
    store.ingest(part(20, 28), "again", now())
    assert [ids for path, ids in read if "relay_payments" in path] == [["b1", "b2"]]
    assert store.facts.read().count() == before


def test_backfill_reads_the_buckets_it_needs(spark, blocks, tmp_path):
    landed, mended, _ = blocks
    files = LandedBlocks(spark, f"{tmp_path}/landed", 4)
    files.land(mended)
    store = RelayStore(spark, f"{tmp_path}/b", rollup=False)
    store.ingest(mended.where("height between 8 and 31"), "before", now())
    done = backfill_window(store, files, 6, 39, now(), batch_heights=6)
    assert len(done) == 2 and backfill_window(store, files, 6, 39, now(), batch_heights=6) == []
    assert {r.height for r in expand_ranges(store.coverage()).collect()} == set(range(6, 40))
    ranges = spark.createDataFrame([(32, 33)], "from_height bigint, to_height bigint")
    ranges.write.parquet(f"{tmp_path}/ranges")
    plan = files.in_ranges(spark.read.parquet(f"{tmp_path}/ranges").where("from_height > 0"))
    assert {r.height for r in plan.collect()} == {32, 33}
    assert "dynamicpruning" in plan._jdf.queryExecution().toString().lower()


def test_runs_follow_from_committed_batches(spark, blocks, tmp_path):
    landed, _, _ = blocks
    store = RelayStore(spark, f"{tmp_path}/r", rollup=False)
    run = store.start_run(now())
    good = landed.where("height between 5 and 9")
    store.ingest(good, "one", now(), run_id=run)
    with pytest.raises(InterruptedError):
        CutShort(spark, f"{tmp_path}/r", rollup=False).ingest(landed, "two", now(), run_id=run)
    row = store.runs().first()
    covered = expand_ranges(store.coverage()).count()
    assert (row.id, row.blocks_indexed, row.rows_written, row.ended_at) == (run, covered, store.facts.read().count(), None)
    assert store.coverage().where(F.col("handler") != RELAY_HANDLER).count() == 0


def test_scattered_heights_meet_few_ranges(spark, tmp_path):
    """Ranges of one height each do not meet all others of a wide bucket: 65,536 by 65,536 pairs of each bucket took a minute."""
    store = EventStore(spark, str(tmp_path / "scattered"), [NotesHandler()])
    at = lambda df, h: df.select(F.lit("notes").alias("handler"), h.alias("from_height"), h.alias("to_height"))
    lines = lambda h: at(spark.range(260_000), h).withColumns({"blocks": F.lit(1).cast("bigint"), "rows": F.lit(1).cast("bigint"), "committed_at": F.lit("2024-03-01").cast("timestamp"), "seq": F.lit(1).cast("bigint"), "run_id": F.lit(None).cast("bigint")})
    store.commit(lines(F.col("id") * 2), "even")
    store.commit(lines(F.col("id") * 2 + 800_001), "later")
    begun = time.monotonic()
    assert store.overlapping(at(spark.range(260_000), F.col("id") * 2 + 1), "mine") == []
    assert time.monotonic() - begun < 25
    assert store.overlapping(at(spark.range(100), F.col("id") * 2 + 519_990), "mine") == ["even"]
    assert store.overlapping(at(spark.range(2), F.col("id") * 800_000 + 2), "even") == []
    assert store.overlapping(at(spark.range(1), F.lit(800_001).cast("bigint")), "mine") == ["later"]
