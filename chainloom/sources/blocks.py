"""Landed block dumps: from stored JSON to one row per event."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chainloom.functions.payloads import is_bad, json_or_bad
from chainloom.functions.texts import tx_hash_of_raw
from chainloom.schemas import BLOCK_JSON, BLOCK_RESULTS_JSON, REST_TXS_JSON

_TAGGED = (
    "array<struct<tx_hash: string, type: string, "
    "attributes: array<struct<key: string, value: string>>>>"
)


def _tagged(events: Column, tx_hash: Column) -> Column:
    """Events as (tx_hash, type, attributes); a missing list has none."""
    return F.coalesce(
        F.transform(
            events,
            lambda e: F.struct(
                tx_hash.alias("tx_hash"),
                F.coalesce(e["type"], F.lit("")).alias("type"),
                e["attributes"].alias("attributes"),
            ),
        ),
        F.from_json(F.lit("[]"), _TAGGED),
    )


def parse_blocks(raw: DataFrame) -> DataFrame:
    """One row per landed height: ``height, time, events, error``.

    The order of events is begin block, per transaction, end block, finalize. Event i of a
    transaction carries the hash of raw transaction i, or "" when there is none. A height whose
    JSON, time or base64 is bad has an ``error`` and no events.
    """
    return _parse_blocks(raw.withColumn("_lost", F.lit(None).cast("string")))


def _parse_blocks(raw: DataFrame) -> DataFrame:
    """:func:`parse_blocks` of rows some of which were lost before (``_lost``): this is their error."""
    parsed = raw.select(
        "height",
        json_or_bad(F.col("block_json"), BLOCK_JSON).alias("_b"),
        json_or_bad(F.col("results_json"), BLOCK_RESULTS_JSON).alias("_r"),
        "_lost",
    )
    txs = F.coalesce(F.col("_b.block.data.txs"), F.array().cast("array<string>"))
    hashed = parsed.withColumns(
        {
            "_hashes": F.transform(txs, tx_hash_of_raw),
            "time": F.col("_b.block.header.time").try_cast("timestamp"),
        }
    )
    none = F.lit("")
    per_tx = F.flatten(
        F.transform(
            F.coalesce(F.col("_r.txs_results"), F.from_json(F.lit("[]"), "array<struct<events: " + _event_array() + ">>")),
            lambda tx, i: _tagged(tx["events"], F.coalesce(F.get("_hashes", i), none)),
        )
    )
    lost = F.col("_lost")
    error = (
        F.when(lost.isNotNull(), lost)
        .when(is_bad(F.col("_b")), "block: bad json")
        .when(is_bad(F.col("_r")), "block_results: bad json")
        .when(F.exists("_hashes", lambda h: h.isNull()), "txs: bad base64")
        .when(F.col("time").isNull(), "block: bad time")
    )
    return hashed.select(
        "height",
        "time",
        F.when(
            lost.isNull(),
            F.concat(
                _tagged(F.col("_r.begin_block_events"), none),
                per_tx,
                _tagged(F.col("_r.end_block_events"), none),
                _tagged(F.col("_r.finalize_block_events"), none),
            ),
        ).alias("events"),
        error.alias("error"),
    )


def _event_array() -> str:
    return "array<struct<type: string, attributes: array<struct<key: string, value: string>>>>"


def _attribute_map(attributes: Column) -> Column:
    """Attributes as a map; a repeated key keeps its last value (session option set by ``configure``)."""
    none = F.from_json(F.lit("[]"), "array<struct<key: string, value: string>>")
    return F.map_from_entries(
        F.transform(
            F.coalesce(attributes, none),
            lambda a: F.struct(
                F.coalesce(a["key"], F.lit("")).alias("key"), F.coalesce(a["value"], F.lit("")).alias("value")
            ),
        )
    )


def explode_events(parsed: DataFrame) -> DataFrame:
    """Event rows ``height, time, tx_hash, type, attrs, event_idx`` of decodable heights.

    The position in the block is the event index.
    """
    return (
        parsed.where(F.col("error").isNull())
        .select("height", "time", F.posexplode("events").alias("event_idx", "_e"))
        .select("height", "time", "_e.tx_hash", "_e.type", _attribute_map(F.col("_e.attributes")).alias("attrs"), "event_idx")
    )


def stage_blocks(parsed: DataFrame, types: Iterable[str]) -> DataFrame:
    """Parsed blocks with the events of the wanted types only, each with its place in the block.

    Written once, this is all that handlers read; the JSON is parsed a single time.
    """
    placed = F.transform(
        "events",
        lambda e, i: F.struct(e["tx_hash"].alias("tx_hash"), e["type"].alias("type"), e["attributes"].alias("attributes"), i.alias("event_idx")),
    )
    wanted = F.filter(placed, lambda e: e["type"].isin(sorted(set(types))))
    return parsed.select("height", "time", "error", F.when(F.col("error").isNull(), wanted).alias("events"))


def staged_events(staged: DataFrame, types: Iterable[str]) -> DataFrame:
    """Event rows of some types, as :func:`explode_events` gives them, from staged blocks."""
    return (
        staged.select("height", "time", F.explode("events").alias("_e"))
        .where(F.col("_e.type").isin(sorted(set(types))))
        .select("height", "time", "_e.tx_hash", "_e.type", _attribute_map(F.col("_e.attributes")).alias("attrs"), "_e.event_idx")
    )


def decode_blocks(raw: DataFrame) -> DataFrame:
    """Event rows of landed ``(height, block_json, results_json)``."""
    return explode_events(parse_blocks(raw))


def decode_errors(parsed: DataFrame) -> DataFrame:
    """Heights that could not be decoded, with the reason."""
    return parsed.where(F.col("error").isNotNull()).select("height", F.col("error").alias("reason"))


def parse_rest_blocks(raw: DataFrame) -> DataFrame:
    """As :func:`parse_blocks` for ``(height, header_json, txs_json)``.

    This shape carries ready hashes and transaction events only.
    """
    parsed = raw.select(
        "height",
        json_or_bad(F.col("header_json"), BLOCK_JSON).alias("_b"),
        json_or_bad(F.col("txs_json"), REST_TXS_JSON).alias("_t"),
    ).withColumn("time", F.col("_b.block.header.time").try_cast("timestamp"))
    events = F.flatten(
        F.transform(
            F.col("_t.tx_responses"),
            lambda tx: _tagged(tx["events"], F.upper(F.coalesce(tx["txhash"], F.lit("")))),
        )
    )
    error = (
        F.when(is_bad(F.col("_b")), "header: bad json")
        .when(is_bad(F.col("_t")), "txs: bad json")
        .when(F.col("time").isNull(), "header: bad time")
    )
    return parsed.select(
        "height", "time", F.coalesce(events, F.from_json(F.lit("[]"), _TAGGED)).alias("events"), error.alias("error")
    )


def decode_blocks_rest(raw: DataFrame) -> DataFrame:
    return explode_events(parse_rest_blocks(raw))


def pair_batch_replies(replies: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Pair batch replies by id: 2i is block i of the batch, 2i+1 its results.

    ``replies`` is ``(batch_id, first_height, id, result, error)``. A pair is one conditional
    aggregate. Returns landed blocks and failed heights; an error in either half fails the
    height, and a reply without id (one error object for all) fails its whole batch.
    """
    marked = _paired(replies)
    good = marked.where(F.col("reason").isNull()).select("height", "block_json", "results_json")
    return good, marked.where(F.col("reason").isNotNull()).select("height", "reason")


def _paired(replies: DataFrame) -> DataFrame:
    """Pairs ``height, block_json, results_json, reason``; the reason fails the height.

    The bodies are shuffled once, by batch: the aggregate and the join with failed batches both use this placing. So no
    task sorts the bodies of a whole input split before the shuffle.
    """
    batch_error = (
        replies.where(F.col("id").isNull())
        .groupBy("batch_id")
        .agg(F.concat(F.lit("batch rpc error: "), F.first("error")).alias("_batch_error"))
    )
    last = lambda odd, c: F.max(F.when(F.col("id") % 2 == odd, F.col(c)))
    pairs = (
        replies.where(F.col("id").isNotNull())
        .repartition("batch_id")
        .groupBy("batch_id", (F.col("first_height") + F.floor(F.col("id") / 2)).cast("bigint").alias("height"))
        .agg(
            last(0, "result").alias("block_json"),
            last(1, "result").alias("results_json"),
            last(0, "error").alias("_block_error"),
            last(1, "error").alias("_results_error"),
        )
        .join(batch_error, "batch_id", "left")
    )
    reason = (
        F.when(F.col("_batch_error").isNotNull(), F.col("_batch_error"))
        .when(
            F.col("_block_error").isNotNull(),
            F.format_string("block h=%d: %s", F.col("height"), F.col("_block_error")),
        )
        .when(
            F.col("_results_error").isNotNull(),
            F.format_string("block_results h=%d: %s", F.col("height"), F.col("_results_error")),
        )
        .when(F.col("block_json").isNull() | F.col("results_json").isNull(), "missing reply")
    )
    return pairs.select("height", "block_json", "results_json", reason.alias("reason"))


def parse_replies(replies: DataFrame) -> DataFrame:
    """As :func:`parse_blocks` for stored batch replies; heights without a pair carry the error of their reply."""
    lost = F.col("reason").isNotNull()
    body = lambda c: F.when(~lost, F.col(c)).alias(c)
    return _parse_blocks(_paired(replies).select("height", body("block_json"), body("results_json"), F.col("reason").alias("_lost")))


#: How landed rows of each shape become parsed blocks.
SHAPES = {"rpc": parse_blocks, "rest": parse_rest_blocks, "replies": parse_replies}


def block_headers(raw: DataFrame) -> DataFrame:
    """``(height, time)`` of landed blocks; only the header of the JSON is read."""
    header = "block struct<header: struct<height: string, time: string>>"
    parsed = F.from_json("block_json", header)
    return raw.select(
        "height", parsed["block"]["header"]["time"].try_cast("timestamp").alias("time")
    ).where(F.col("time").isNotNull())
