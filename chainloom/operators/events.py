"""Event routing and the unpivot of indexed attributes."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chainloom.functions.numbers import (
    fits_int,
    fits_short,
    parse_fraction,
    parse_int_or_null,
    parse_int_or_zero,
)
from chainloom.functions.texts import hash_is_valid, tx_hash_bytes

BAD_HASH = "tx_hash is not hex"

_QOS_ATTRIBUTES = {
    "qos_avail": "QoSAvailability",
    "qos_latency": "QoSLatency",
    "qos_sync": "QoSSync",
    "ex_qos_avail": "ExcellenceQoSAvailability",
    "ex_qos_latency": "ExcellenceQoSLatency",
    "ex_qos_sync": "ExcellenceQoSSync",
}


def dispatch_events(
    spark: SparkSession, events: DataFrame, subscriptions: Iterable[tuple[str, str]]
) -> DataFrame:
    """Route events to handlers by type; ``subscriptions`` are the registered (handler, type) pairs.

    One event may reach several handlers, an unsubscribed type reaches none. The table is
    written in code, so its broadcast is bounded by the number of handlers.
    """
    table = spark.createDataFrame(sorted(set(subscriptions)), "handler string, type string")
    return events.join(F.broadcast(table), "type")


def indexed_records(events: DataFrame) -> DataFrame:
    """One row per distinct index N among the ``provider.N`` attributes of an event.

    N is a signed base-10 integer and is written back in plain form for the other lookups, so
    ``provider.007`` makes index 7 and then reads ``provider.7``.
    """
    prefix = "provider."
    named = F.filter(F.map_keys("attrs"), lambda k: k.startswith(prefix))
    numbers = F.transform(named, lambda k: parse_int_or_null(F.substring(k, len(prefix) + 1, 1 << 20)))
    indexes = F.array_sort(F.array_distinct(F.filter(numbers, lambda n: n.isNotNull())))
    return events.withColumn("record_idx", F.explode(indexes))


def unpivot_indexed_attrs(events: DataFrame) -> DataFrame:
    """Relay records of events with their text attributes parsed; incomplete records drop out.

    A record needs a provider, a chain and a parsable CU. Input columns: ``height, time,
    tx_hash, attrs, event_idx``. Whole numbers stay BIGINT here; :func:`mark_records` and
    :func:`split_records` narrow.
    """

    def attr(name: str):
        return F.try_element_at(
            "attrs", F.concat(F.lit(f"{name}."), F.col("record_idx").cast("string"))
        )

    # texts become columns first, so each is looked up once however often its parser reads it
    texts = indexed_records(events).select(
        F.col("height").alias("block_height"),
        "tx_hash",
        "event_idx",
        "record_idx",
        F.col("time").alias("timestamp"),
        attr("provider").alias("provider"),
        attr("chainID").alias("chain"),
        attr("CU").alias("_cu"),
        attr("relayNumber").alias("_relays"),
        *[attr(a).alias(c) for c, a in _QOS_ATTRIBUTES.items()],
    )
    parsed = texts.withColumns(
        {
            "cu": parse_int_or_null(F.col("_cu")),
            "relay_number": parse_int_or_zero(F.col("_relays")),
        }
        | {c: parse_fraction(F.col(c)) for c in _QOS_ATTRIBUTES}
    ).select(
        "block_height", "tx_hash", "event_idx", "record_idx", "timestamp", "provider", "chain",
        "cu", "relay_number", *_QOS_ATTRIBUTES,
    )
    return parsed.where(
        (F.col("provider") != "") & (F.col("chain") != "") & F.col("cu").isNotNull()
    )


def mark_records(records: DataFrame) -> DataFrame:
    """Add ``reason``: why a record cannot become a fact, NULL when it can."""
    return records.withColumn(
        "reason",
        F.when(~hash_is_valid(F.col("tx_hash")), BAD_HASH)
        .when(~fits_short(F.col("record_idx")), "record_idx out of range")
        .when(~fits_int(F.col("relay_number")), "relay_number out of range"),
    )


def split_records(marked: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Marked records narrowed to the fact types, and those that do not fit.

    A bad transaction hash fails its whole block, so none of that height's records is a fact.
    """
    bad_heights = marked.where(F.col("reason") == BAD_HASH).select("block_height").distinct()
    facts = (
        marked.where(F.col("reason").isNull())
        .join(bad_heights, "block_height", "left_anti")
        .withColumns(
            {
                "tx_hash": tx_hash_bytes(F.col("tx_hash"), F.col("block_height")),
                "event_idx": F.col("event_idx").cast("int"),
                "record_idx": F.col("record_idx").cast("smallint"),
                "relay_number": F.col("relay_number").cast("int"),
            }
        )
        .drop("reason")
    )
    return facts, marked.where(F.col("reason").isNotNull())
