"""Landed blocks, sources, dispatch, unpivot, sinks and streams."""

from __future__ import annotations

import contextlib
import os
import tempfile
from dataclasses import dataclass, field

from pyspark.sql import functions as F

from chainloom import schemas
from chainloom.catalog import standins as s
from chainloom.catalog.read_side import _daily_sql
from chainloom.catalog.registry import query, table
from chainloom.constants import RELAY_EVENT_TYPE, RELAY_HANDLER
from chainloom.extend import HandlerRegistry
from chainloom.functions.numbers import parse_int_or_null
from chainloom.functions.texts import tx_hash_of_raw
from chainloom.operators import telemetry
from chainloom.operators.events import dispatch_events, indexed_records
from chainloom.operators.intervals import expand_ranges, merge_ranges
from chainloom.operators.ledger import failure_counts
from chainloom.operators.rollup import fact_dim_join
from chainloom.plans.backfill import backfill_window
from chainloom.plans.ingest import RelayStore, relay_ingest
from chainloom.plans.store import EventStore
from chainloom.session import shared_dir
from chainloom.sinks.tables import BatchTable, VersionedTable, apply_sql_dir, refresh_view
from chainloom.sources import blocks as bl
from chainloom.sources import catalogue as cat
from chainloom.sources.landed import LandedBlocks
from chainloom.streaming.follow import END_OF_LOG, follow_tip, request_rate

_FMT = "'%Y-%m-%d %H:%M:%S.%f'"
_FACT_OUT = [
    "block_height", "tx_hash", "event_idx", "record_idx", "timestamp", "provider", "chain", "cu", "relay_number",
    "qos_avail", "qos_latency", "qos_sync", "ex_qos_avail", "ex_qos_latency", "ex_qos_sync",
]


def _landed_sql(where: str = "TRUE") -> str:
    rounded = ", ".join(f"round({c}, 6) AS {c}" for c in _FACT_OUT[9:])
    return f"""WITH {s.LANDED_FACTS_SQL} SELECT block_height, tx_hash, event_idx, record_idx, strftime(ts, {_FMT}) AS timestamp,
  provider, chain, cu, relay_number, {rounded} FROM landed WHERE {where}"""


# event rows of a block in order: begin, relay, transfer, message, end
_EVENT_ROWS = f"""
rows_ AS (SELECT event_id AS height, ts, k, i AS event_idx,
  CASE i WHEN 0 THEN 'begin' WHEN 1 THEN '{RELAY_EVENT_TYPE}' WHEN 2 THEN 'transfer' WHEN 3 THEN 'message' ELSE 'end' END AS type,
  CASE WHEN i IN (1, 2) THEN upper(sha256('tx-' || event_id)) WHEN i = 3 AND k % 5 <> 0 THEN upper(sha256('tx2-' || event_id)) ELSE '' END AS tx_hash,
  CASE WHEN i <> 1 THEN CAST(k AS VARCHAR) END AS note
  FROM ev, generate_series(0, 4) AS g(i) WHERE k NOT IN (13, 17))"""


def _event_out(df):
    return df.select("height", "time", "tx_hash", "type", "event_idx", F.try_element_at("attrs", F.lit("note")).alias("note"))


@query(
    "decode_blocks",
    f"WITH {s.EVENTS_SQL}, {_EVENT_ROWS} SELECT height, strftime(ts, {_FMT}) AS time, tx_hash, type, event_idx, note FROM rows_",
)
def decode_blocks(spark, sf):
    return _event_out(bl.decode_blocks(s.landed_blocks(spark, sf)))


@query(
    "decode_errors",
    f"""WITH {s.EVENTS_SQL} SELECT event_id AS height, CASE WHEN k = 13 THEN 'txs: bad base64' ELSE 'block_results: bad json' END AS reason
FROM ev WHERE k IN (13, 17)""",
)
def decode_errors(spark, sf):
    return bl.decode_errors(bl.parse_blocks(s.landed_blocks(spark, sf)))


def _rest_blocks(spark, sf, files=None):
    header = F.to_json(F.struct(F.struct(F.struct(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'").alias("time")).alias("header")).alias("block")))
    note = F.array(F.struct(F.lit("note").alias("key"), F.col("k").cast("string").alias("value")))
    ev = lambda t: F.struct(F.lit(t).alias("type"), note.alias("attributes"))
    tx = lambda p, es: F.struct(F.sha2(F.concat(F.lit(p), F.col("event_id").cast("string")), 256).alias("txhash"), F.array(*es).alias("events"))
    txs = F.to_json(F.struct(F.array(tx("a", [ev("relay"), ev("transfer")]), tx("b", [ev("message")])).alias("tx_responses")))
    rows = s.events(spark, sf)
    return (rows.repartition(files, "event_id") if files else rows).select(F.col("event_id").alias("height"), header.alias("header_json"), txs.alias("txs_json"))


@query(
    "decode_blocks_rest",
    f"""WITH {s.EVENTS_SQL} SELECT event_id AS height, strftime(ts, {_FMT}) AS time, upper(sha256(CASE WHEN i < 2 THEN 'a' ELSE 'b' END || event_id)) AS tx_hash,
  CASE i WHEN 0 THEN 'relay' WHEN 1 THEN 'transfer' ELSE 'message' END AS type, i AS event_idx, CAST(k AS VARCHAR) AS note FROM ev, generate_series(0, 2) AS g(i)""",
)
def decode_blocks_rest(spark, sf):
    return _event_out(bl.decode_blocks_rest(_rest_blocks(spark, sf)))


@query("tx_hash_of_raw", "SELECT event_id, upper(sha256('tx-' || event_id)) AS tx_hash FROM events")
def tx_hash_of_raw_query(spark, sf):
    raw = F.base64(F.concat(F.lit("tx-"), F.col("event_id").cast("string")).cast("binary"))
    return s.events(spark, sf).select("event_id", tx_hash_of_raw(raw).alias("tx_hash"))


def _replies(spark, sf):
    """Batches of fifty heights; k = 23 fails the block half, k = 24 the results half, and a batch
    whose number is a multiple of 17 came back as one error object."""
    per = 50
    batch = F.floor(F.col("height") / per).cast("bigint")
    based = s.build_blocks(spark, sf, files=s.landed_files(spark, sf), also=("k",)).where("height is not null").withColumn("batch_id", batch)
    half = lambda odd, c, bad: F.struct(
        ((F.col("height") % per) * 2 + odd).cast("int").alias("id"),
        F.when(F.col("k") != bad, F.col(c)).alias("result"),
        F.when(F.col("k") == bad, F.lit("boom")).alias("error"),
    )
    single = based.where("batch_id % 17 = 0").select("batch_id", (F.col("batch_id") * per).alias("first_height")).distinct()
    replies = based.select(
        "batch_id", (F.col("batch_id") * per).alias("first_height"), F.explode(F.array(half(0, "block_json", 23), half(1, "results_json", 24))).alias("r")
    ).select("batch_id", "first_height", "r.id", "r.result", "r.error")
    return replies.unionByName(
        single.select("batch_id", "first_height", F.lit(None).cast("int").alias("id"), F.lit(None).cast("string").alias("result"), F.lit("overload").alias("error"))
    )


@query(
    "json_rpc_batch_pair",
    f"""WITH {s.EVENTS_SQL} SELECT event_id AS height, CASE WHEN (event_id // 50) % 17 = 0 THEN 'batch rpc error: overload'
  WHEN k = 23 THEN 'block h=' || event_id || ': boom' WHEN k = 24 THEN 'block_results h=' || event_id || ': boom' END AS reason,
  NOT ((event_id // 50) % 17 = 0 OR k IN (23, 24)) AS paired FROM ev""",
)
def json_rpc_batch_pair(spark, sf):
    good, bad = bl.pair_batch_replies(_replies(spark, sf))
    paired = good.select("height", F.lit(None).cast("string").alias("reason"), (F.col("block_json").isNotNull() & F.col("results_json").isNotNull()).alias("paired"))
    return paired.unionByName(bad.select("height", "reason", F.lit(False).alias("paired")))


_SUBSCRIPTIONS = [("relays", RELAY_EVENT_TYPE), ("audit", RELAY_EVENT_TYPE), ("audit", "transfer")]


@query(
    "dispatch_events",
    f"""WITH {s.EVENTS_SQL}, {_EVENT_ROWS} SELECT handler, type, count(*) AS n, CAST(sum(height) AS BIGINT) AS heights FROM rows_
JOIN (VALUES ('relays', '{RELAY_EVENT_TYPE}'), ('audit', '{RELAY_EVENT_TYPE}'), ('audit', 'transfer')) AS sub(handler, t) ON t = type GROUP BY 1, 2""",
)
def dispatch(spark, sf):
    routed = dispatch_events(spark, bl.decode_blocks(s.landed_blocks(spark, sf)), _SUBSCRIPTIONS)
    return routed.groupBy("handler", "type").agg(F.count(F.lit(1)).alias("n"), F.sum("height").alias("heights"))


@query(
    "unpivot_indexed_attrs",
    f"""WITH {s.EVENTS_SQL} SELECT event_id AS height, CAST(k % 4 + 4 * i AS BIGINT) AS record_idx FROM ev, generate_series(0, 1) AS g(i)
WHERE k NOT IN (13, 17) AND (i = 0 OR k % 3 = 0)""",
)
def unpivot(spark, sf):
    events = bl.decode_blocks(s.landed_blocks(spark, sf)).where(F.col("type") == RELAY_EVENT_TYPE)
    return indexed_records(events).select("height", "record_idx")


def _ingested(spark, sf):
    empty = s.empty_dictionary(spark)
    return relay_ingest(spark, s.landed_blocks(spark, sf), empty, empty)


@query("relay_ingest", _landed_sql())
def relay_ingest_query(spark, sf):
    out = _ingested(spark, sf)
    return fact_dim_join(out["facts"], out["providers"], out["chains"]).select(*_FACT_OUT)


# --- sources ----------------------------------------------------------------------------------


def _sources(spark, sf):
    """Each event type is a source; purchase advertises another network, view none."""
    e = s.events(spark, sf)
    network = F.when(F.col("event_type") == "purchase", "testnet").when(F.col("event_type") == "view", "").otherwise("mainnet")
    landed = e.select(F.col("event_type").alias("source"), network.alias("network"), F.col("event_id").alias("height"), F.col("ts").alias("time"))
    return cat.source_coverage(landed, "mainnet")


_SOURCES_SQL = """src AS (SELECT event_type AS source, CASE event_type WHEN 'purchase' THEN 'testnet' WHEN 'view' THEN '' ELSE 'mainnet' END AS network,
  min(event_id) AS earliest_height, max(event_id) AS latest_height, min(ts) AS earliest_time, max(ts) AS latest_time,
  event_type IN ('purchase', 'view') AS disabled,
  CASE event_type WHEN 'purchase' THEN 'chain_id mismatch: expected=mainnet advertised=testnet' WHEN 'view' THEN 'endpoint did not report chain_id (expected mainnet)' END AS reason
  FROM events GROUP BY event_type)"""


@query(
    "source_coverage",
    f"""WITH {_SOURCES_SQL} SELECT source, network, earliest_height, latest_height, strftime(earliest_time, {_FMT}) AS earliest_time,
  strftime(latest_time, {_FMT}) AS latest_time, disabled, reason FROM src""",
)
def source_coverage(spark, sf):
    return _sources(spark, sf)


@query("chain_tip", f"WITH {_SOURCES_SQL} SELECT max(latest_height) AS tip FROM src WHERE NOT disabled")
def chain_tip(spark, sf):
    return cat.chain_tip(_sources(spark, sf))


@query("earliest_start", f"WITH {_SOURCES_SQL} SELECT min(earliest_height) AS start_height FROM src WHERE NOT disabled AND earliest_height > 0")
def earliest_start(spark, sf):
    return cat.earliest_start(_sources(spark, sf))


@query("validate_range", f"WITH {_SOURCES_SQL} SELECT bool_or(NOT disabled AND earliest_height <= 5) AS covered FROM src")
def validate_range(spark, sf):
    return cat.validate_range(_sources(spark, sf), 5)


@query(
    "tip_time",
    f"WITH {_SOURCES_SQL} SELECT strftime(max(latest_time), {_FMT}) AS tip_time, strftime(max(earliest_time) FILTER (WHERE earliest_height = 1), {_FMT}) AS genesis_time FROM src",
)
def tip_time(spark, sf):
    return cat.tip_time(_sources(spark, sf), F.lit(None).cast("timestamp"))


@query(
    "genesis_info",
    """SELECT 'chain-' || o_orderkey AS chain, CASE WHEN o_orderkey % 5 = 0 THEN 1 ELSE o_orderkey END AS initial_height,
  CASE WHEN o_orderkey % 5 <> 0 THEN strftime(o_orderdate, '%Y-%m-%d %H:%M:%S.%f') END AS genesis_time,
  CASE WHEN o_orderkey % 5 <> 0 THEN 'net-' || o_custkey END AS chain_id,
  CASE WHEN o_orderkey % 10 = 0 THEN 'genesis: initial_height missing or zero' WHEN o_orderkey % 5 = 0 THEN 'genesis decode' END AS error FROM orders""",
)
def genesis_info(spark, sf):
    key = F.col("o_orderkey")
    doc = F.struct(
        F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("genesis_time"),
        F.concat(F.lit("net-"), F.col("o_custkey").cast("string")).alias("chain_id"),
        F.when(key % 10 != 0, key.cast("string")).alias("initial_height"),
    )
    body = F.to_json(F.struct(F.struct(doc.alias("genesis")).alias("result")))
    broken = (key % 5 == 0) & (key % 10 != 0)
    return cat.genesis_info(
        table(spark, sf, "orders").select(F.concat(F.lit("chain-"), key.cast("string")).alias("chain"), F.when(broken, F.lit("{bad")).otherwise(body).alias("body"))
    )


# --- sinks ------------------------------------------------------------------------------------


@query("write_facts", f"WITH {s.FACTS_SQL} SELECT block_height, cu FROM fact WHERE chain <> 'error'")
def write_facts(spark, sf):
    """Every kind of event is a batch; one is written twice, and the errors stay without their manifest row."""
    root = shared_dir(spark, "facts")
    facts = s.relay_facts(spark, sf)
    store = BatchTable(spark, f"{root}/facts", "block_height bigint, cu bigint")
    rows = lambda kind: facts.where(F.col("chain") == kind).select("block_height", "cu")
    cover = lambda df: df.agg(F.min("block_height").alias("from_height"), F.max("block_height").alias("to_height"), F.count(F.lit(1)).alias("blocks")).withColumn("handler", F.lit("h"))
    now = F.lit("2024-02-01").cast("timestamp")
    for kind in ("view", "click", "signup", "purchase", "view"):
        store.write_facts(rows(kind), kind, cover(rows(kind)), now, key=["block_height"])
    store.write_batch(rows("error"), "error")
    return store.read().select("block_height", "cu")


@query("refresh_view", f"WITH {s.FACTS_SQL} SELECT chain, CAST(sum(cu) AS BIGINT) AS cu FROM fact GROUP BY chain")
def refresh_view_query(spark, sf):
    view = VersionedTable(spark, shared_dir(spark, "view"), "chain string, cu bigint")
    build = lambda: s.relay_facts(spark, sf).groupBy("chain").agg(F.sum("cu").alias("cu"))
    view.replace(build().withColumn("cu", F.lit(0).cast("bigint")))
    refresh_view(view, build)
    return view.read()


@query("apply_sql_dir", f"WITH {s.FACTS_SQL} SELECT chain, count(*) AS n, CAST(sum(cu) AS BIGINT) AS cu FROM fact GROUP BY chain")
def apply_sql_dir_query(spark, sf):
    """Views of a directory of SQL files; the second builds on the first, a broken one is passed over."""
    s.relay_facts(spark, sf).createOrReplaceTempView("chainloom_facts")
    with tempfile.TemporaryDirectory() as folder:
        files = {
            "001_base.sql": "CREATE OR REPLACE TEMP VIEW chainloom_base AS SELECT chain, cu FROM chainloom_facts;",
            "002_broken.sql": "SELEC nothing",
            "003_empty.sql": "\n",
            "004_rollup.sql": "CREATE OR REPLACE TEMP VIEW chainloom_by_chain AS\nSELECT chain, count(*) AS n, sum(cu) AS cu FROM chainloom_base GROUP BY chain",
        }
        for name, text in files.items():
            with open(os.path.join(folder, name), "w", encoding="utf-8") as f:
                f.write(text)
        apply_sql_dir(spark, folder)
    return spark.table("chainloom_by_chain")


@query(
    "rows_by_table",
    "SELECT 'events' AS table_name, count(*) AS rows FROM events UNION ALL SELECT 'lineitem', count(*) FROM lineitem UNION ALL SELECT 'orders', count(*) FROM orders UNION ALL SELECT 'supplier', count(*) FROM supplier",
)
def rows_by_table(spark, sf):
    return telemetry.rows_by_table({t: table(spark, sf, t) for t in ("events", "lineitem", "orders", "supplier")})


@query(
    "data_time_bounds",
    f"SELECT strftime(arg_min(o_orderdate, o_orderkey), {_FMT}) AS data_from, strftime(arg_max(o_orderdate, o_orderkey), {_FMT}) AS data_to FROM orders",
)
def data_time_bounds(spark, sf):
    return telemetry.data_time_bounds(table(spark, sf, "orders"), "o_orderkey", "o_orderdate")


# --- streams ----------------------------------------------------------------------------------


def _landing(spark, sf) -> tuple[str, int]:
    """The landed files, and how many of them are a quarter of all."""
    folder, files = s.landed_folder(spark, sf)
    return folder, -(-files // 4)


def _follow_all(spark, sf, root: str, attempt: int) -> RelayStore:
    """Follow the landed files, half of them at a time, to their end from a fresh checkpoint."""
    store = RelayStore(spark, f"{root}/store")
    landing, quarter = _landing(spark, sf)
    follow_tip(spark, landing, store, f"{root}/checkpoint{attempt}", max_files=2 * quarter).awaitTermination()
    return store


_STREAMS: dict[tuple[str, str], str] = {}


def _stream_store(spark, sf) -> RelayStore:
    """A followed store, shared by the queries that only read it."""
    key = (spark.sparkContext.applicationId, sf)
    if key not in _STREAMS:
        root = shared_dir(spark, "stream")
        _follow_all(spark, sf, root, 0)
        _STREAMS[key] = root
    return RelayStore(spark, f"{_STREAMS[key]}/store")


@query("follow_tip_stream", _landed_sql())
def follow_tip_stream(spark, sf):
    store = _stream_store(spark, sf)
    return fact_dim_join(store.facts.read(), store.providers.read(), store.chains.read()).select(*_FACT_OUT)


@query(
    "stream_exactly_once",
    f"""WITH {s.LANDED_FACTS_SQL} SELECT count(*) AS rows, count(DISTINCT block_height) AS heights, CAST(sum(cu) AS BIGINT) AS cu FROM landed""",
)
def stream_exactly_once(spark, sf):
    """All files are followed again from a fresh checkpoint; the rows stay as they are."""
    root = shared_dir(spark, "stream")
    _follow_all(spark, sf, root, 0)
    facts = _follow_all(spark, sf, root, 1).facts.read()
    return facts.agg(F.count(F.lit(1)).alias("rows"), F.count_distinct("block_height").alias("heights"), F.sum("cu").alias("cu"))


@query(
    "dead_letter_stream",
    f"WITH {s.EVENTS_SQL} SELECT '{RELAY_HANDLER}' AS handler, event_id AS height, CASE WHEN k = 13 THEN 'txs: bad base64' ELSE 'block_results: bad json' END AS reason, 1 AS retries FROM ev WHERE k IN (13, 17)",
)
def dead_letter_stream(spark, sf):
    return _stream_store(spark, sf).ledger().select("handler", "height", "reason", "retries")


@query(
    "dead_letter_retry",
    f"WITH {s.EVENTS_SQL} SELECT '{RELAY_HANDLER}' AS handler, least(count(*), 5) AS max_seen, count(*) AS retrying, 0 AS permanent, 2 AS max_retries FROM ev WHERE k IN (13, 17)",
)
def dead_letter_retry(spark, sf):
    """The five highest failed heights are tried again and fail again."""
    store = _follow_all(spark, sf, shared_dir(spark, "stream"), 0)
    store.retry_failures(s.landed_blocks(spark, sf), "retry-1", F.lit("2024-03-01").cast("timestamp"), 5, 5)
    ledger = store.ledger()
    again = ledger.groupBy("handler").agg(F.count_if(F.col("retries") == 2).alias("max_seen"))
    return failure_counts(ledger).join(again, "handler")


@query(
    "stream_daily_rollup",
    f"WITH {s.LANDED_FACTS_SQL}, f2 AS (SELECT *, ts AS timestamp FROM landed) {_daily_sql(fact='f2')}",
)
def stream_daily_rollup(spark, sf):
    return _stream_store(spark, sf).daily()


@query(
    "stream_dedup",
    f"WITH {s.LANDED_FACTS_SQL} SELECT block_height, count(*) AS copies FROM landed GROUP BY 1",
)
def stream_dedup(spark, sf):
    """Every block lands twice, in different files, so of different batches or of one."""
    root = shared_dir(spark, "dedup")
    blocks = s.landed_blocks(spark, sf)
    for _ in range(2):
        blocks.write.mode("append").parquet(f"{root}/landing")
    files = len(spark.read.schema(blocks.schema).parquet(f"{root}/landing").inputFiles())
    store = RelayStore(spark, f"{root}/store")
    follow_tip(spark, f"{root}/landing", store, f"{root}/checkpoint", max_files=-(-files // 2)).awaitTermination()
    return store.facts.read().groupBy("block_height").agg(F.count(F.lit(1)).alias("copies"))


@query("stream_recut", _landed_sql())
def stream_recut(spark, sf):
    """A second stream cuts the same files into other batches; rows are neither lost nor doubled."""
    root = shared_dir(spark, "stream")
    landing, quarter = _landing(spark, sf)
    follow_tip(spark, landing, RelayStore(spark, f"{root}/store"), f"{root}/checkpoint0", max_files=quarter).awaitTermination()
    store = RelayStore(spark, f"{root}/store")
    follow_tip(spark, landing, store, f"{root}/checkpoint1", max_files=3 * quarter).awaitTermination()
    return store.read(RELAY_HANDLER).select(*_FACT_OUT)


class _CutShort(RelayStore):
    """A store whose batches end before their manifest, as if the process had been stopped there."""

    def commit(self, lines, batch_id):
        raise InterruptedError(batch_id)


@query(
    "retry_replay",
    f"""WITH {s.EVENTS_SQL}, hs AS (SELECT min(event_id) AS lo, max(event_id) AS hi, count(*) AS n FROM ev)
SELECT 'fact' AS kind, event_id AS a, event_id AS b, CAST(floor(value) AS BIGINT) AS n FROM ev
UNION ALL SELECT 'covered', lo, hi, n FROM hs""",
)
def retry_replay(spark, sf):
    """Broken blocks are mended and tried again; the first try ends before its manifest, the second and third repeat it."""
    root = shared_dir(spark, "retry")
    store = RelayStore(spark, f"{root}/store")
    landed = LandedBlocks(spark, f"{root}/landed", 1000)
    landed.land(s.build_blocks(spark, sf, broken=False))
    now = F.lit("2024-03-01").cast("timestamp")
    store.ingest(s.landed_blocks(spark, sf), "first", now, 5)
    with contextlib.suppress(InterruptedError):
        _CutShort(spark, f"{root}/store").retry_failures(landed, "retry-1", now, 1_000_000, 5)
    for _ in range(2):
        store.retry_failures(landed, "retry-1", now, 1_000_000, 5)
    wide = lambda kind, a, b, n: [F.lit(kind).alias("kind"), F.col(a).alias("a"), F.col(b).alias("b"), F.expr(n).alias("n")]
    facts = store.facts.read().select(*wide("fact", "block_height", "block_height", "cu"))
    waiting = store.ledger().select(*wide("waiting", "height", "height", "cast(retries as bigint)"))
    claimed = store.open_claims().select(*wide("claimed", "height", "height", "1L"))
    covered = merge_ranges(store.coverage()).select(*wide("covered", "from_height", "to_height", "to_height - from_height + 1"))
    return facts.unionByName(waiting).unionByName(claimed).unionByName(covered)


@query(
    "quarantine_rows",
    f"""WITH {s.EVENTS_SQL} SELECT event_id AS block_height, CAST(k % 4 AS BIGINT) AS record_idx, 'u' || user_id AS provider,
  3000000000 AS relay_number, 'relay_number out of range' AS reason FROM ev WHERE k % 11 = 5 AND k NOT IN (13, 17)""",
)
def quarantine_rows(spark, sf):
    """Every eleventh relay number does not fit its type; two batches keep these records beside the facts."""
    root = shared_dir(spark, "quarantine")
    blocks = s.landed_blocks(spark, sf).withColumn("_k", F.regexp_extract("results_json", r'"relayNumber\.\d+","value":"(\d+)"', 1).cast("int"))
    wide = F.regexp_replace("results_json", r'("relayNumber\.\d+","value":")\d+"', '$13000000000"')
    raw = blocks.withColumn("results_json", F.when(F.col("_k") % 11 == 5, wide).otherwise(F.col("results_json"))).drop("_k")
    store = RelayStore(spark, f"{root}/store", rollup=False)
    now = F.lit("2024-03-01").cast("timestamp")
    for part in (0, 1):
        store.ingest(raw.where(F.col("height") % 2 == part), f"part-{part}", now)
    return store.quarantine.read().select("block_height", "record_idx", "provider", "relay_number", "reason")


@dataclass
class NotesHandler:
    """An added handler: the notes of transfers and messages; a note divisible by 10 is rejected."""

    name: str = "notes"
    event_types: tuple[str, ...] = ("transfer", "message")
    schema: str = "height bigint, event_idx int, kind_id int, note bigint"
    key: tuple[str, ...] = ("height", "event_idx")
    records: str = "height bigint, event_idx int, kind string, note bigint, reason string"
    dictionaries: dict = field(default_factory=lambda: {"kind": ("kinds", "kind_id")})

    def transform(self, events):
        note = parse_int_or_null(F.try_element_at("attrs", F.lit("note")))
        return events.select("height", "event_idx", F.col("type").alias("kind"), note.alias("note")).withColumn(
            "reason", F.when(F.col("note") % 10 == 0, "round note")
        )


@query(
    "custom_handler_ingest",
    f"""WITH {s.EVENTS_SQL}, good AS (SELECT * FROM ev WHERE k NOT IN (13, 17)),
rows_ AS (SELECT 'notes' AS handler, event_id AS height, i AS event_idx, CASE i WHEN 2 THEN 'transfer' ELSE 'message' END AS kind, k AS n
  FROM good, generate_series(2, 3) AS g(i) WHERE k % 10 <> 0
  UNION ALL SELECT '{RELAY_HANDLER}', event_id, 1, 'relay', CAST(floor(value) AS BIGINT) FROM good
  UNION ALL SELECT 'rejected', event_id, i, CASE i WHEN 2 THEN 'transfer' ELSE 'message' END, k FROM good, generate_series(2, 3) AS g(i) WHERE k % 10 = 0)
SELECT handler, height, CAST(event_idx AS BIGINT) AS event_idx, kind, CAST(n AS BIGINT) AS n FROM rows_
UNION ALL SELECT 'covered ' || h, event_id, NULL, NULL, NULL FROM good, (VALUES ('notes'), ('{RELAY_HANDLER}')) AS t(h)
UNION ALL SELECT 'failed ' || h, event_id, NULL, NULL, NULL FROM ev, (VALUES ('notes'), ('{RELAY_HANDLER}')) AS t(h) WHERE k IN (13, 17)""",
)
def custom_handler_ingest(spark, sf):
    """Two handlers, one of them added here, are stored from one decode under one manifest, in two batches."""
    root = shared_dir(spark, "handlers")
    registry = HandlerRegistry([NotesHandler()])
    store = RelayStore(spark, f"{root}/store", registry.select(["NOTES"]), rollup=False)
    now = F.lit("2024-03-01").cast("timestamp")
    for part in (0, 1):
        store.ingest(s.landed_blocks(spark, sf).where(F.col("height") % 2 == part), f"part-{part}", now)
    none = lambda c, kind: F.lit(None).cast(kind).alias(c)
    empty = [none("event_idx", "int"), none("kind", "string"), none("n", "bigint")]
    notes = store.read("notes").select(F.lit("notes").alias("handler"), "height", "event_idx", "kind", F.col("note").alias("n"))
    relays = store.facts.read().select(F.lit(RELAY_HANDLER).alias("handler"), F.col("block_height").alias("height"), "event_idx", F.lit("relay").alias("kind"), F.col("cu").alias("n"))
    rejected = store.rejected["notes"].read().select(F.lit("rejected").alias("handler"), "height", "event_idx", "kind", F.col("note").alias("n"))
    covered = expand_ranges(store.coverage()).select(F.concat(F.lit("covered "), "handler").alias("handler"), "height", *empty)
    failed = store.ledger().select(F.concat(F.lit("failed "), "handler").alias("handler"), "height", *empty)
    return notes.unionByName(relays).unionByName(rejected).unionByName(covered).unionByName(failed)


@query(
    "rest_ingest",
    f"""WITH {s.EVENTS_SQL} SELECT event_id AS height, i AS event_idx, CASE i WHEN 1 THEN 'transfer' ELSE 'message' END AS kind, CAST(k AS BIGINT) AS note
FROM ev, generate_series(1, 2) AS g(i) WHERE k % 10 <> 0""",
)
def rest_ingest(spark, sf):
    """Blocks that landed in the other shape go through the same stream and store."""
    root = shared_dir(spark, "rest")
    files = s.landed_files(spark, sf)
    _rest_blocks(spark, sf, files).write.parquet(f"{root}/landing")
    store = EventStore(spark, f"{root}/store", [NotesHandler()])
    follow_tip(spark, f"{root}/landing", store, f"{root}/checkpoint", max_files=-(-files // 2), shape="rest").awaitTermination()
    return store.read("notes")


@query(
    "replies_ingest",
    f"""WITH {s.EVENTS_SQL}, h AS (SELECT event_id, k, CASE WHEN (event_id // 50) % 17 = 0 THEN 'batch rpc error: overload' WHEN k = 23 THEN 'block h=' || event_id || ': boom'
  WHEN k = 24 THEN 'block_results h=' || event_id || ': boom' WHEN k = 13 THEN 'txs: bad base64' WHEN k = 17 THEN 'block_results: bad json' END AS reason FROM ev)
SELECT event_id AS height, CAST(i AS BIGINT) AS event_idx, CAST(NULL AS VARCHAR) AS reason FROM h, generate_series(2, 3) AS g(i) WHERE reason IS NULL AND k % 10 <> 0
UNION ALL SELECT event_id, NULL, reason FROM h WHERE reason IS NOT NULL""",
)
def replies_ingest(spark, sf):
    """Stored batch replies are paired and ingested; heights of failed replies go to the ledger."""
    store = EventStore(spark, f"{shared_dir(spark, 'replies')}/store", [NotesHandler()])
    store.ingest(_replies(spark, sf), "all", F.lit("2024-03-01").cast("timestamp"), shape="replies")
    rows = store.read("notes").select("height", "event_idx", F.lit(None).cast("string").alias("reason"))
    return rows.unionByName(store.ledger().select("height", F.lit(None).cast("int").alias("event_idx"), "reason"))


@query(
    "backfill_window",
    f"""WITH {s.EVENTS_SQL}, span AS (SELECT max(event_id) + 1 AS n FROM ev),
done AS (SELECT event_id AS h FROM ev, span WHERE k NOT IN (13, 17) AND (event_id BETWEEN n // 10 AND n * 9 // 10 OR event_id % 8 = 3)),
isl AS (SELECT h, h - row_number() OVER (ORDER BY h) AS g FROM done)
SELECT '{RELAY_HANDLER}' AS handler, min(h) AS from_height, max(h) AS to_height FROM isl GROUP BY g""",
)
def backfill_window_query(spark, sf):
    """Every eighth height is stored already; the window's other heights are read from landed buckets."""
    root = shared_dir(spark, "backfill")
    landed = LandedBlocks(spark, f"{root}/landed", 512)
    landed.land(s.landed_blocks(spark, sf))
    store = RelayStore(spark, f"{root}/store", rollup=False)
    now = F.lit("2024-03-01").cast("timestamp")
    store.ingest(s.landed_blocks(spark, sf).where("height % 8 = 3"), "before", now)
    n = s.events(spark, sf).agg(F.max("event_id")).first()[0] + 1
    horizons = spark.createDataFrame([(n // 3, False), (n // 2, True)], "earliest_height bigint, disabled boolean")
    backfill_window(store, landed, n // 10, n * 9 // 10, now, batch_heights=max(1, n // 2), horizons=horizons, width=s.WIDTH)
    return merge_ranges(store.coverage(), width=s.WIDTH)


@query(
    "run_from_manifest",
    f"""WITH {s.EVENTS_SQL}, good AS (SELECT * FROM ev WHERE k NOT IN (13, 17))
SELECT 1 AS id, count(*) AS blocks_indexed, count(*) AS rows_written, 'interrupted' AS end_reason, strftime(TIMESTAMP '2024-03-01 00:02:00', {_FMT}) AS ended_at,
  strftime(TIMESTAMP '2024-03-01 00:02:00', {_FMT}) AS last_heartbeat FROM good WHERE event_id % 4 < 2
UNION ALL SELECT 2, count(*), count(*), 'stopped', strftime(TIMESTAMP '2024-03-01 01:00:00', {_FMT}), strftime(TIMESTAMP '2024-03-01 00:30:00', {_FMT}) FROM good WHERE event_id % 4 = 2
UNION ALL SELECT 3, 0, 0, NULL, NULL, strftime(TIMESTAMP '2024-03-02 00:00:00', {_FMT})""",
)
def run_from_manifest(spark, sf):
    """Three runs: two batches and no end, a batch given twice and an end, nothing yet."""
    root = shared_dir(spark, "runs")
    store = RelayStore(spark, f"{root}/store", rollup=False)
    at = lambda t: F.lit(t).cast("timestamp")
    part = lambda i: s.landed_blocks(spark, sf).where(F.col("height") % 4 == i)
    first = store.start_run(at("2024-03-01 00:00:00"))
    for i in (0, 1):
        store.ingest(part(i), f"b{i}", at(f"2024-03-01 00:0{i + 1}:00"), run_id=first)
    second = store.start_run(at("2024-03-01 00:20:00"))
    for _ in range(2):
        store.ingest(part(2), "b2", at("2024-03-01 00:30:00"), run_id=second)
    for t in ("2024-03-01 01:00:00", "2024-03-01 02:00:00"):
        store.end_run(second, "stopped", at(t))
    store.start_run(at("2024-03-02 00:00:00"))
    return store.runs().select("id", "blocks_indexed", "rows_written", "end_reason", "ended_at", "last_heartbeat")


@query(
    "stream_rate",
    f"""WITH w AS (SELECT event_type AS source, epoch_us(ts) AS us, unnest(generate_series(0, 19)) AS i FROM events),
b AS (SELECT source, (us // 3000000) * 3000000 - i * 3000000 AS start FROM w)
SELECT source, strftime(make_timestamp(start), {_FMT}) AS window_start, count(*) AS requests, round(count(*) / CAST(60 AS DOUBLE), 6) AS rps FROM b GROUP BY 1, 2""",
)
def stream_rate(spark, sf):
    """The rate stream over the landed log, run to its end in append mode: each window comes out once."""
    root = shared_dir(spark, "rate")
    log = s.events(spark, sf).select(F.col("event_type").alias("source"), F.col("ts").alias("at"))
    end = log.agg((F.max("at") + F.expr("INTERVAL 1 HOUR")).alias("at")).select(F.lit(END_OF_LOG).alias("source"), "at")
    log.unionByName(end).write.parquet(f"{root}/log")
    stream = spark.readStream.schema(log.schema).parquet(f"{root}/log")
    (
        request_rate(stream)
        .writeStream.outputMode("append")
        .format("parquet")
        .option("path", f"{root}/out")
        .option("checkpointLocation", f"{root}/checkpoint")
        .trigger(availableNow=True)
        .start()
        .awaitTermination()
    )
    return spark.read.parquet(f"{root}/out").select("source", "window_start", "requests", "rps")
