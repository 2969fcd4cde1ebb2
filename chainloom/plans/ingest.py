"""Relay ingest: landed blocks to stored facts, coverage and dead letters."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chainloom import schemas
from chainloom.constants import RELAY_EVENT_TYPE, RELAY_HANDLER
from chainloom.extend import Handler, HandlerSpec
from chainloom.operators.dictionary import dict_decode, dict_encode, dict_lookup
from chainloom.operators.events import (
    BAD_HASH,
    mark_records,
    split_records,
    unpivot_indexed_attrs,
)
from chainloom.operators.merge import first_per_key
from chainloom.operators.rollup import ROLLUP_KEYS, ROLLUP_SUMS, add_rollups, daily_by_id, relay_daily
from chainloom.plans.store import EventStore
from chainloom.session import cut
from chainloom.sources.blocks import decode_errors, parse_blocks, stage_blocks, staged_events

FACT_COLUMNS = [
    "block_height", "tx_hash", "event_idx", "record_idx", "timestamp", "provider_id", "chain_id",
    "cu", "relay_number", "qos_avail", "qos_latency", "qos_sync",
    "ex_qos_avail", "ex_qos_latency", "ex_qos_sync",
]


@dataclass
class RelayHandler:
    """The built-in handler: relay payment events to fact rows."""

    name: str = RELAY_HANDLER
    event_types: tuple[str, ...] = (RELAY_EVENT_TYPE,)
    schema: str = schemas.FACTS
    table: str = "relay_payments"
    height: str = "block_height"
    key: list[str] = field(default_factory=lambda: list(schemas.FACT_KEY))
    records: str = schemas.QUARANTINE
    dictionaries: dict[str, tuple[str, str]] = field(
        default_factory=lambda: {"provider": ("providers", "provider_id"), "chain": ("chains", "chain_id")}
    )
    fatal: tuple[str, ...] = (BAD_HASH,)

    def transform(self, events: DataFrame) -> DataFrame:
        """Text-keyed records, with the reason for those that do not fit the fact types."""
        return mark_records(unpivot_indexed_attrs(events))

    def split(self, records: DataFrame) -> tuple[DataFrame, DataFrame]:
        """Facts, and the records that fit none."""
        return split_records(records)


def encode_facts(facts: DataFrame, providers: DataFrame, chains: DataFrame) -> DataFrame:
    """Facts with dictionary ids in the stored column order."""
    coded = dict_lookup(
        dict_lookup(facts, providers, "provider", "provider_id"), chains, "chain", "chain_id"
    )
    return coded.select(*FACT_COLUMNS)


def relay_batch(
    spark: SparkSession, raw: DataFrame, keep: Callable[[DataFrame, str], DataFrame] = cut
) -> dict[str, DataFrame]:
    """One batch of landed blocks, not encoded yet.

    ``facts`` carry provider and chain texts, one row per key; ``failures`` are heights that did
    not decode or carry a bad transaction hash; ``heights`` are the heights done. ``keep`` stores
    the decoded rows once, since everything below reads them several times.
    """
    handler = RelayHandler()
    staged = keep(stage_blocks(parse_blocks(raw), handler.event_types), "blocks")
    records = keep(handler.transform(staged_events(staged, handler.event_types)), "records")
    decoded = staged.select("height", "error")
    facts, quarantine = split_records(records)
    bad = decode_errors(decoded).unionByName(
        quarantine.where(F.col("reason") == BAD_HASH)
        .select(F.col("block_height").alias("height"), "reason")
        .distinct()
    )
    return {
        "facts": first_per_key(facts, schemas.FACT_KEY, ["provider", "chain", "cu"]),
        "failures": bad.withColumn("handler", F.lit(RELAY_HANDLER)),
        "quarantine": quarantine,
        "heights": decoded.where(F.col("error").isNull())
        .select(F.lit(RELAY_HANDLER).alias("handler"), "height")
        .join(bad.select("height").distinct(), "height", "left_anti"),
    }


def relay_ingest(
    spark: SparkSession, raw: DataFrame, providers: DataFrame, chains: DataFrame
) -> dict[str, DataFrame]:
    """:func:`relay_batch` with the dictionaries grown and the facts encoded.

    The grown dictionaries are written out, as the facts are joined to them on both ends.
    """
    batch = relay_batch(spark, raw)
    providers_next = cut(dict_encode(batch["facts"], providers, "provider"), "providers")
    chains_next = cut(dict_encode(batch["facts"], chains, "chain"), "chains")
    return batch | {
        "facts": encode_facts(batch["facts"], providers_next, chains_next),
        "providers": providers_next,
        "chains": chains_next,
    }


_WHOLE = {
    "cu", "relays", "qos_weight", "qos_cu", "qos_count", "ex_qos_weight", "ex_qos_count",
}


class RelayStore(EventStore):
    """The relay handler's tables with their dictionaries and daily rollup, and those of further handlers."""

    def __init__(self, spark: SparkSession, root: str, handlers: Iterable[Handler] = (), rollup: bool = True):
        super().__init__(spark, root, [RelayHandler(), *handlers])
        self.rollup = rollup
        self.facts, self.quarantine = self.tables[RELAY_HANDLER], self.rejected[RELAY_HANDLER]
        self.providers, self.chains = self.dictionaries["providers"], self.dictionaries["chains"]
        measures = ", ".join(f"{c} {'bigint' if c in _WHOLE else 'double'}" for c in ROLLUP_SUMS)
        self.deltas = self._batches("rollup_deltas", f"date date, chain_id int, provider_id int, {measures}")

    def after_write(self, spec: HandlerSpec, written: DataFrame, batch_id: str) -> None:
        if self.rollup and spec.name == RELAY_HANDLER:
            self.deltas.write_batch(daily_by_id(written), batch_id)

    def daily(self) -> DataFrame:
        """Rollup of everything committed, summed from the small per-batch deltas."""
        merged = add_rollups(self.deltas.read().drop("batch_id"), keys=["date", "chain_id", "provider_id"])
        named = dict_decode(merged, self.providers.read(), "provider_id", "provider")
        named = dict_decode(named, self.chains.read(), "chain_id", "_chain")
        return named.withColumnRenamed("_chain", "chain_id").select(*ROLLUP_KEYS, *ROLLUP_SUMS)

    def daily_rebuilt(self) -> DataFrame:
        """The same rollup rebuilt from the facts."""
        return relay_daily(self.facts.read(), self.providers.read(), self.chains.read())
