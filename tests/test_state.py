"""Ledgers, stored tables, extension points."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from chainloom import schemas
from chainloom.catalog import standins
from chainloom.plans.ingest import RelayStore, relay_batch
from chainloom import schemas
from chainloom.extend import HandlerRegistry, run_snapshotters
from chainloom.operators import ledger
from chainloom.operators.dictionary import dict_encode
from chainloom.operators.events import indexed_records, mark_records, split_records, unpivot_indexed_attrs
from chainloom.operators.snapshots import resolve_denoms
from chainloom.plans.ingest import RelayHandler
from chainloom.sinks.tables import BatchTable, VersionedTable, apply_sql_dir

FAIL = "handler string, height bigint, reason string, seq bigint"


def at(day):
    return F.lit(datetime(2024, 1, day)).cast("timestamp")


def fail(spark, *heights, seq=0):
    return spark.createDataFrame([("h", h, f"r{h}-{seq + i}", seq + i) for i, h in enumerate(heights)], FAIL)


def by_height(df):
    return {r.height: r for r in df.collect()}


def empty(spark):
    return spark.createDataFrame([], schemas.FAILURES)


def test_cap_is_reached_on_the_third_failure(spark):
    led = empty(spark)
    for day in (1, 2, 3):
        led = ledger.record_failures(led, fail(spark, 5), at(day), 3)
        row = by_height(led)[5]
        assert (row.retries, row.permanent) == (day, day == 3)
    assert row.first_seen_at == datetime(2024, 1, 1) and row.max_retries_reached_at == datetime(2024, 1, 3)
    assert ledger.pop_failures(led, 10)[0].count() == 0


def test_no_cap_and_first_insert_never_permanent(spark):
    many = ledger.record_failures(empty(spark), fail(spark, *[7] * 10), at(1), 0)
    assert (by_height(many)[7].retries, by_height(many)[7].permanent, by_height(many)[7].reason) == (10, False, "r7-9")
    one = ledger.record_failures(empty(spark), fail(spark, 8), at(1), 1)
    assert by_height(one)[8].permanent is False


def test_pop_skips_permanent_and_keeps_counters(spark):
    led = ledger.record_failures(empty(spark), fail(spark, 100, 200), at(1), 3)
    led = ledger.record_permanent(led, fail(spark, 150, 250), at(1))
    popped, marked = ledger.pop_failures(led, 10)
    assert sorted(r.height for r in popped.collect()) == [100, 200]
    counts = ledger.failure_counts(marked).first()
    assert (counts.retrying, counts.permanent) == (0, 2)
    again = by_height(ledger.record_failures(marked, fail(spark, 200), at(2), 3))
    assert (again[200].retries, again[200].in_retry, again[100].in_retry) == (2, False, True)
    assert ledger.pop_failures(led, 0)[0].count() == 0


def test_permanent_upgrade(spark):
    led = ledger.record_failures(empty(spark), fail(spark, 5), at(1), 3)
    row = by_height(ledger.record_permanent(led, fail(spark, 5, 6), at(2)))
    assert row[5].permanent and row[5].retries == 1 and row[5].max_retries_reached_at == datetime(2024, 1, 2)
    assert row[6].permanent and row[6].first_seen_at == datetime(2024, 1, 2)


def test_versions_survive_a_broken_write(spark, tmp_path):
    table = VersionedTable(spark, str(tmp_path / "t"), "id int, value string")
    assert table.read().count() == 0
    table.replace(spark.createDataFrame([(1, "a")], table.schema), tag="b1")
    (tmp_path / "t" / "v=2").mkdir()
    assert [r.value for r in table.read().collect()] == ["a"] and table.tag() == "b1"
    table.upsert(spark.createDataFrame([(1, "b"), (2, "c")], table.schema), ["id"])
    assert sorted(tuple(r) for r in table.read().collect()) == [(1, "b"), (2, "c")] and table.tag() == "b1"


def test_uncommitted_batches_are_invisible(spark, tmp_path):
    table = BatchTable(spark, str(tmp_path / "f"), "k bigint")
    rows = lambda *v: spark.createDataFrame([(x,) for x in v], "k bigint")
    cover = spark.createDataFrame([("h", 1, 2, 2)], "handler string, from_height bigint, to_height bigint, blocks bigint")
    table.write_batch(rows(9), "lost")
    assert table.read().count() == 0
    for _ in range(2):
        table.write_facts(rows(1, 2, 2), "a", cover, at(1), key=["k"])
        table.write_facts(rows(2, 3), "b", cover, at(1), key=["k"])
    assert sorted(r.k for r in table.read().collect()) == [1, 2, 3]
    assert sorted((r.batch_id, r.rows) for r in table.manifest().collect()) == [("a", 2), ("b", 1)]


def test_sql_files_run_in_order_past_a_broken_one(spark, tmp_path):
    (tmp_path / "1.sql").write_text("CREATE OR REPLACE TEMP VIEW tv1 AS SELECT 1 AS a;\nCREATE OR REPLACE TEMP VIEW tv2 AS SELECT a + 1 AS b FROM tv1;")
    (tmp_path / "2.sql").write_text("SELEC")
    (tmp_path / "3.sql").write_text("  ")
    (tmp_path / "4.sql").write_text("CREATE OR REPLACE TEMP VIEW tv3 AS SELECT b FROM tv2")
    assert [(r.file, r.status) for r in apply_sql_dir(spark, str(tmp_path)).collect()] == [
        ("1.sql", "applied"), ("2.sql", "failed"), ("3.sql", "skipped"), ("4.sql", "applied")
    ]
    assert spark.table("tv3").first().b == 2


def test_dictionary_ids_are_dense_and_stable(spark):
    known = spark.createDataFrame([(1, "a"), (5, "b")], schemas.DICTIONARY)
    values = spark.createDataFrame([(v,) for v in ["a", "x", "x", "y", None, "z"]], "value string")
    out = {r.value: r.id for r in dict_encode(values, known).collect()}
    assert (out["a"], out["b"]) == (1, 5) and sorted(out[v] for v in "xyz") == [6, 7, 8]
    assert {r.value: r.id for r in dict_encode(values, dict_encode(values, known)).collect()} == out


def records(spark, attrs, tx_hash="ab"):
    df = spark.createDataFrame([(1, datetime(2024, 1, 1), tx_hash, attrs, 0)], "height bigint, time timestamp, tx_hash string, attrs map<string,string>, event_idx int")
    return df


def test_unpivot_drops_incomplete_records(spark):
    attrs = {"provider.2": "p2", "chainID.2": "c", "CU.2": "5", "relayNumber.2": "x", "QoSSync.2": "1/2",
             "provider.1": "p1", "chainID.1": "", "CU.1": "5", "provider.3": "p3", "chainID.3": "c", "CU.3": "bad",
             "provider.007": "p7", "chainID.7": "c", "CU.7": "1", "provider.x": "no"}
    df = records(spark, attrs)
    assert [r.record_idx for r in indexed_records(df).collect()] == [1, 2, 3, 7]
    rows = unpivot_indexed_attrs(df).collect()
    # provider.007 is index 7, but provider.7 does not exist
    assert [(r.record_idx, r.provider, r.cu, r.relay_number, r.qos_sync) for r in rows] == [(2, "p2", 5, 0, 0.5)]


def test_values_out_of_range_are_quarantined(spark):
    attrs = {"provider.70000": "p", "chainID.70000": "c", "CU.70000": "1", "provider.1": "p", "chainID.1": "c", "CU.1": "1", "relayNumber.1": "3000000000",
             "provider.2": "p", "chainID.2": "c", "CU.2": "1"}
    facts, out = split_records(mark_records(unpivot_indexed_attrs(records(spark, attrs))))
    assert [r.record_idx for r in facts.collect()] == [2]
    assert sorted(r.reason for r in out.collect()) == ["record_idx out of range", "relay_number out of range"]
    facts, out = split_records(mark_records(unpivot_indexed_attrs(records(spark, attrs, "abc"))))
    assert facts.count() == 0 and out.count() == 3


def test_denom_resolution(spark):
    amounts = spark.createDataFrame([(d,) for d in ["u", "ibc/A", "ibc/", "ibc/GONE", "ibc/ERR", "ibc/NEW"]], "source_denom string")
    traces = spark.createDataFrame([("A", "atom", None), ("GONE", None, None), ("ERR", None, "http 500")], "hash string, base_denom string, error string")
    got = {r.source_denom: (r.resolved_denom, r.resolve_error) for r in resolve_denoms(amounts, traces).collect()}
    assert got == {"u": ("u", None), "ibc/A": ("atom", None), "ibc/": (None, None), "ibc/GONE": (None, None),
                   "ibc/ERR": (None, "resolve ibc ibc/ERR: http 500"), "ibc/NEW": (None, "resolve ibc ibc/NEW: no stored trace")}


def test_handler_selection():
    reg = HandlerRegistry([RelayHandler(), RelayHandler(name="Audit", event_types=("x", "y"))])
    assert [h.name for h in reg.select(["AUDIT"])] == ["Audit"]
    assert len(reg.select()) == len(reg.select(["all"])) == 2
    assert ("Audit", "y") in reg.subscriptions()


def test_one_failing_snapshotter_does_not_stop_the_others(spark):
    class Snap:
        def __init__(self, name, broken):
            self.name, self.broken = name, broken

        def due(self, slots):
            return slots

        def snapshot(self, targets):
            if self.broken:
                raise RuntimeError("boom")
            return {"rows": targets}

    stored = []
    slots = spark.range(1)
    report = run_snapshotters([Snap("a", True), Snap("b", False)], slots, lambda n, t: stored.append(n))
    assert report == {"a": "boom", "b": None} and stored == ["b"]


def test_another_cut_under_new_ids_loses_nothing(spark, sf_dir, tmp_path):
    landed = standins.landed_blocks(spark, sf_dir)
    heights = sorted(r[0] for r in landed.select("height").distinct().orderBy("height").limit(4).collect())
    part = lambda *hs: landed.where(F.col("height").isin(*hs))
    store = RelayStore(spark, f"{tmp_path}/store")
    now = F.lit("2024-01-01").cast("timestamp")
    store.ingest(part(*heights[:2]), "a-0", now)
    store.ingest(part(*heights[2:]), "a-1", now)
    want = store.facts.read().drop("batch_id").count()
    store.ingest(part(*heights), "b-0", now)
    store.ingest(part(heights[3]), "a-0", now)  # committed: left alone, whatever it is given
    facts = store.facts.read()
    assert facts.count() == want == facts.dropDuplicates(schemas.FACT_KEY).count()
    assert {r[0] for r in facts.select("block_height").distinct().collect()} <= set(heights)


def test_records_that_fit_no_fact_are_stored(spark, sf_dir, tmp_path):
    landed = standins.landed_blocks(spark, sf_dir).orderBy("height").limit(3)
    store = RelayStore(spark, f"{tmp_path}/store")
    store.ingest(landed, "a-0", F.lit("2024-01-01").cast("timestamp"))
    batch = relay_batch(spark, landed)
    assert store.quarantine.read().count() == batch["quarantine"].count()
    assert store.facts.read().count() == batch["facts"].count()


def test_late_requests_are_dropped_and_counted_and_state_expires(spark, tmp_path):
    from chainloom.streaming.follow import END_OF_LOG, late_rows, request_rate, state_rows

    kind = "source string, at timestamp"
    minute = lambda m, s=0: datetime(2024, 1, 1, m // 60, m % 60, s)
    (tmp_path / "log").mkdir()
    stream = spark.readStream.schema(kind).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/log")
    run = lambda: (
        request_rate(stream, "60 seconds", "60 seconds").writeStream.outputMode("append").format("parquet")
        .option("path", f"{tmp_path}/out").option("checkpointLocation", f"{tmp_path}/checkpoint").trigger(availableNow=True).start()
    )
    sizes, late = [], 0
    for part in range(6):
        rows = [("a", minute(20 * part + i, i)) for i in range(20)]
        if part == 3:
            rows.append(("a", minute(1)))
        if part == 5:
            rows.append((END_OF_LOG, minute(200)))
        spark.createDataFrame(rows, kind).coalesce(1).write.mode("append").parquet(f"{tmp_path}/log")
        query = run()
        query.awaitTermination()
        late += late_rows(query)
        sizes.append(state_rows(query)[-1])
    out = spark.read.parquet(f"{tmp_path}/out")
    assert late == 1 and max(sizes) <= 4
    assert out.count() == 120 and {r.requests for r in out.collect()} == {1}, "each window once, the late row in none"
