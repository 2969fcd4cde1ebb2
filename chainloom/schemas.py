"""Declared schemas: nothing is inferred at read time."""

from __future__ import annotations

BLOCK_JSON = (
    "block struct<header: struct<height: string, time: string>, data: struct<txs: array<string>>>"
)

_EVENT = "struct<type: string, attributes: array<struct<key: string, value: string>>>"

BLOCK_RESULTS_JSON = (
    f"txs_results array<struct<events: array<{_EVENT}>>>, "
    f"begin_block_events array<{_EVENT}>, "
    f"end_block_events array<{_EVENT}>, "
    f"finalize_block_events array<{_EVENT}>"
)

REST_TXS_JSON = f"tx_responses array<struct<txhash: string, events: array<{_EVENT}>>>"

_COINS = "array<struct<denom: string, amount: string>>"

REWARDS_JSON = (
    f"info array<struct<source: string, amount: {_COINS}>>, total {_COINS}, "
    "success boolean, message string"
)
SUPPLY_JSON = f"supply {_COINS}"
PRICE_JSON = "market_data struct<current_price: map<string, string>>"
TRACE_JSON = "denom_trace struct<base_denom: string>"
STATUS_JSON = (
    "node_info struct<network: string>, sync_info struct<latest_block_height: string, "
    "latest_block_time: string, earliest_block_height: string, earliest_block_time: string>"
)
GENESIS_JSON = (
    "result struct<genesis: struct<genesis_time: string, chain_id: string, initial_height: string>>"
)

LANDED_BLOCKS = "height bigint, block_json string, results_json string"
LANDED_REST = "height bigint, header_json string, txs_json string"
BATCH_REPLIES = "batch_id bigint, first_height bigint, id int, result string, error string"
REWARD_RESPONSES = (
    "height bigint, provider string, position bigint, http_status int, body string"
)
PRICE_RESPONSES = "snapshot_date date, coingecko_id string, http_status int, body string"
SUPPLY_RESPONSES = "snapshot_date date, block_height bigint, block_time timestamp, http_status int, body string"
TRACE_RESPONSES = "hash string, http_status int, body string"

FACTS = (
    "block_height bigint, tx_hash binary, event_idx int, record_idx smallint, timestamp timestamp, "
    "provider_id int, chain_id int, cu bigint, relay_number int, qos_avail float, qos_latency float, "
    "qos_sync float, ex_qos_avail float, ex_qos_latency float, ex_qos_sync float"
)
#: Records that fit no fact, as they were decoded, and why.
QUARANTINE = (
    "block_height bigint, tx_hash string, event_idx int, record_idx bigint, timestamp timestamp, "
    "provider string, chain string, cu bigint, relay_number bigint, qos_avail float, qos_latency float, "
    "qos_sync float, ex_qos_avail float, ex_qos_latency float, ex_qos_sync float, reason string"
)
FACT_KEY = ["block_height", "tx_hash", "event_idx", "record_idx"]

DICTIONARY = "id int, value string"
RANGES = "handler string, from_height bigint, to_height bigint"
FAILURES = (
    "handler string, height bigint, reason string, retries int, permanent boolean, "
    "first_seen_at timestamp, last_seen_at timestamp, max_retries_reached_at timestamp, in_retry boolean"
)
RUNS = (
    "id bigint, started_at timestamp, last_heartbeat timestamp, ended_at timestamp, "
    "blocks_indexed bigint, rows_written bigint, end_reason string"
)
#: One row per covered range; a batch of several tables also has one row without handler that carries its totals.
MANIFEST = (
    "batch_id string, handler string, from_height bigint, to_height bigint, blocks bigint, "
    "rows bigint, committed_at timestamp, seq bigint, run_id bigint"
)
#: What happened to heights, batch by batch; the failure ledger is folded from it.
FAILURE_LOG = (
    "handler string, height bigint, reason string, permanent boolean, max_retries int, seq bigint, at timestamp"
)
#: Heights a retry took out of the ledger; open until their batch is committed.
CLAIMS = "handler string, height bigint"
RUN_SPANS = (
    "id bigint, started_at timestamp, ended_at timestamp, end_reason string"
)
REWARD_SNAPSHOTS = (
    "block_height bigint, snapshot_date date, block_time timestamp, provider_count bigint, "
    "status string, error string"
)
REWARDS = (
    "block_height bigint, provider_id int, spec_id int, source_kind smallint, denom_id int, "
    "source_denom string, amount decimal(38,0), amount_text string"
)
REWARD_KEY = ["block_height", "provider_id", "spec_id", "source_kind", "denom_id", "source_denom"]
DENOM_METADATA = (
    "denom_id int, base_denom string, factor decimal(38,0), coingecko_id string, suppress boolean"
)
PRICE_SNAPSHOTS = (
    "snapshot_date date, block_time timestamp, denom_count bigint, status string, error string"
)
PRICES = "snapshot_date date, denom_id int, price_usd decimal(38,18), coingecko_id string"
SUPPLY_SNAPSHOTS = (
    "snapshot_date date, block_height bigint, block_time timestamp, total_supply decimal(38,0), "
    "supply_text string, status string, error string"
)
