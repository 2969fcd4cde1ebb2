"""Stored calendar snapshots: due slots, their blocks, the snapshot's tables in one commit, and the views on top.

A run takes all due dates at once. Its tables (snapshot rows, amounts, status) are written as one batch and become
visible together by one manifest; of a date taken again the newest batch counts. If the dates together fail, each is
taken alone, so that one bad date leaves the others.
"""

from __future__ import annotations

import logging
from collections.abc import Callable, Iterable
from typing import Protocol

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chainloom import schemas
from chainloom.constants import NATIVE_DENOM, NATIVE_PRICE_ID
from chainloom.operators.asof import nearest_asof
from chainloom.operators.snapshots import slots_due, snapshot_status
from chainloom.plans.prices import price_snapshot, supply_snapshot
from chainloom.plans.rewards import rewards_snapshot
from chainloom.sinks.tables import BatchTable, VersionedTable

log = logging.getLogger(__name__)

TARGETS = "block_height bigint, snapshot_date date, block_time timestamp"


class SnapshotStore:
    """Tables of one snapshotter, keyed by snapshot date (or by the block of it), with one commit for all of them.

    ``tables`` maps names to schemas; ``snapshots`` must be among them and have ``snapshot_date, status, error``.
    """

    def __init__(self, spark: SparkSession, root: str, tables: dict[str, str]):
        self.spark, self.root = spark, root
        manifest = f"{root}/manifest"
        self.tables = {n: BatchTable(spark, f"{root}/{n}", s, manifest=manifest) for n, s in tables.items()}
        self._targets = BatchTable(spark, f"{root}/targets", TARGETS, manifest=manifest)

    def _newest(self) -> DataFrame:
        """The batch that counts for each date."""
        seq = self._targets.manifest().groupBy("batch_id").agg(F.max("seq").alias("seq"))
        taken = self._targets.read().join(seq, "batch_id")
        return taken.groupBy("snapshot_date").agg(F.max_by(F.struct("batch_id", "block_height"), "seq").alias("_n")).select("snapshot_date", "_n.*")

    def read(self, name: str) -> DataFrame:
        rows = self.tables[name].read()
        key = "snapshot_date" if "snapshot_date" in rows.columns else "block_height"
        return rows.join(self._newest().select("batch_id", key).distinct(), ["batch_id", key], "left_semi").drop("batch_id")

    def taken(self) -> DataFrame:
        """Snapshot rows with the block of their date."""
        snapshots = self.read("snapshots")
        if "block_height" in snapshots.columns:
            return snapshots
        return snapshots.join(self._newest().select("snapshot_date", "block_height"), "snapshot_date")

    def commit(self, targets: DataFrame, tables: dict[str, DataFrame], now: Column) -> str:
        """Write the tables of some targets and make them visible together.

        Targets without a snapshot row are not recorded, so they stay due and what is stored of them stays.
        """
        number = (self._targets.manifest().agg(F.max("seq")).first()[0] or 0) + 1
        batch_id = f"run-{number:09d}"
        for name, table in self.tables.items():
            columns = [part.split()[0] for part in table.schema.split(", ")]
            table.write_batch(tables[name].select(*columns), batch_id)
        done = self.tables["snapshots"].read_batch(batch_id).select("snapshot_date").distinct()
        self._targets.write_batch(targets.select("block_height", "snapshot_date", "block_time").join(done, "snapshot_date", "left_semi")
                                  .select("block_height", "snapshot_date", "block_time"), batch_id)
        lines = self._targets.read_batch(batch_id).agg(
            F.lit("snapshot").alias("handler"), F.min("block_height").alias("from_height"), F.max("block_height").alias("to_height"),
            F.count(F.lit(1)).alias("blocks"), F.lit(0).cast("bigint").alias("rows"), F.first(now).alias("committed_at"),
            F.lit(number).cast("bigint").alias("seq"), F.lit(None).cast("bigint").alias("run_id"),
        )
        self._targets.commit(lines, batch_id)
        return batch_id


class StoredSnapshotter(Protocol):
    """A snapshotter whose tables a :class:`SnapshotStore` keeps."""

    name: str
    store: SnapshotStore

    def snapshot(self, targets: DataFrame) -> dict[str, DataFrame]:
        """Tables for targets ``block_height, snapshot_date, block_time, slot``."""
        ...


class RewardsSnapshotter:
    """Claimable rewards per provider; dictionaries grow before the commit, as growing harms nobody."""

    name = "provider_rewards"

    def __init__(self, spark: SparkSession, root: str, responses: DataFrame, traces: DataFrame, metadata: Callable[[DataFrame], DataFrame]):
        self.store = SnapshotStore(spark, f"{root}/{self.name}", {"snapshots": schemas.REWARD_SNAPSHOTS, "rewards": schemas.REWARDS,
                                                                  "quarantine": "height bigint, provider string, source_denom string, amount_text string, snapshot_date date"})
        self.dictionaries = {n: VersionedTable(spark, f"{root}/{n}", schemas.DICTIONARY) for n in ("providers", "specs", "denoms")}
        self.responses, self.traces, self.metadata = responses, traces, metadata

    def snapshot(self, targets: DataFrame) -> dict[str, DataFrame]:
        known = {n: d.read() for n, d in self.dictionaries.items()}
        out = rewards_snapshot(
            targets, self.responses, self.metadata(known["denoms"]), known["denoms"], known["providers"], known["specs"], self.traces
        )
        for name, dictionary in self.dictionaries.items():
            if not out[name].join(known[name], "value", "left_anti").isEmpty():
                dictionary.replace(out[name])
        dates = targets.select(F.col("block_height").alias("height"), "snapshot_date")
        return out | {"quarantine": out["quarantine"].drop("snapshot_date").join(dates, "height")}


class PriceSnapshotter:
    """Prices of the denoms that the stored rewards of each date hold."""

    name = "denom_prices"

    def __init__(self, spark: SparkSession, root: str, responses: DataFrame, rewards: SnapshotStore, metadata: Callable[[], DataFrame], native: str = NATIVE_PRICE_ID):
        self.store = SnapshotStore(spark, f"{root}/{self.name}", {"snapshots": schemas.PRICE_SNAPSHOTS, "prices": schemas.PRICES})
        self.responses, self.rewards, self.metadata, self.native = responses, rewards, metadata, native

    def snapshot(self, targets: DataFrame) -> dict[str, DataFrame]:
        return price_snapshot(targets, self.rewards.read("rewards"), self.metadata(), self.responses, self.native)


class SupplySnapshotter:
    """Total supply of one denom."""

    name = "supply"

    def __init__(self, spark: SparkSession, root: str, responses: DataFrame, denom: str = NATIVE_DENOM):
        self.store = SnapshotStore(spark, f"{root}/{self.name}", {"snapshots": schemas.SUPPLY_SNAPSHOTS})
        self.responses, self.denom = responses, denom

    def snapshot(self, targets: DataFrame) -> dict[str, DataFrame]:
        wanted = self.responses.drop("block_height", "block_time").join(targets.drop("slot"), "snapshot_date")
        return {"snapshots": supply_snapshot(wanted, self.denom)}


def due_targets(store: SnapshotStore, slots: DataFrame, headers: DataFrame) -> DataFrame:
    """Slots (``slot, slot_date``) without a stored snapshot, with the block nearest to each."""
    due = slots_due(slots.select("slot", "slot_date").distinct(), store.taken())
    blocks = nearest_asof(due, headers)
    return due.join(blocks, "slot").select("block_height", F.col("slot_date").alias("snapshot_date"), "block_time", "slot")


def run_snapshots(
    snapshotters: Iterable[StoredSnapshotter],
    slots: DataFrame,
    headers: DataFrame,
    now: Column,
    views: Iterable[Callable[[], int]] = (),
) -> dict[str, dict[str, str | None]]:
    """Take what is due of every snapshotter, store it and rebuild the views; per snapshotter the dates that failed and why.

    The calendar bounds the dates, so the few that must be taken one by one are a driver loop.
    """
    report: dict[str, dict[str, str | None]] = {}
    stored = False
    for s in snapshotters:
        failures = report.setdefault(s.name, {})
        targets = due_targets(s.store, slots, headers)
        rows = targets.collect()
        if not rows:
            continue
        spark = targets.sparkSession
        todo = [spark.createDataFrame(rows, targets.schema)]
        while todo:
            part = todo.pop()
            try:
                s.store.commit(part, s.snapshot(part), now)
                stored = True
            except Exception as e:  # noqa: BLE001 - a bad date is reported and leaves the others
                if part.count() > 1:
                    todo += [spark.createDataFrame([r], targets.schema) for r in part.collect()]
                else:
                    date = str(part.first()["snapshot_date"])
                    failures[date] = str(e).splitlines()[0]
                    log.warning("snapshot %s of %s failed: %s", s.name, date, failures[date])
    if stored:
        for refresh in views:
            refresh()
    return report


def stored_status(store: SnapshotStore, slots: DataFrame) -> DataFrame:
    """State of every expected slot."""
    return snapshot_status(slots, store.taken())
