"""Extension points: event handlers and snapshotters, and how they are selected and run."""

from __future__ import annotations

import logging
from collections.abc import Callable, Iterable
from dataclasses import dataclass, field
from typing import Protocol, runtime_checkable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

log = logging.getLogger(__name__)


@runtime_checkable
class Handler(Protocol):
    """Turns the events it subscribes to into rows of its own table, with native columns only."""

    name: str
    event_types: tuple[str, ...]
    schema: str

    def transform(self, events: DataFrame) -> DataFrame:
        """Rows to store; a ``reason`` marks those to quarantine."""
        ...


def _names(schema: str) -> list[str]:
    return [part.split()[0] for part in schema.split(", ")]


@dataclass
class HandlerSpec:
    """How a store keeps the rows of a handler; what the handler does not state follows from its schema.

    ``height`` is the column that holds the height, ``key`` what makes a row unique (all columns by default),
    ``records`` the schema of what ``transform`` returns, ``dictionaries`` maps text columns to (dictionary, id column),
    ``fatal`` lists the reasons that fail a whole height, ``split`` turns records into rows and rejected records.
    """

    name: str
    event_types: tuple[str, ...]
    schema: str
    transform: Callable[[DataFrame], DataFrame]
    table: str
    height: str
    key: list[str]
    records: str
    dictionaries: dict[str, tuple[str, str]] = field(default_factory=dict)
    fatal: tuple[str, ...] = ()
    split: Callable[[DataFrame], tuple[DataFrame, DataFrame]] | None = None

    @classmethod
    def of(cls, handler: Handler) -> HandlerSpec:
        columns = _names(handler.schema)
        height = getattr(handler, "height", "height")
        if height not in columns:
            raise ValueError(f"handler {handler.name}: its schema lacks the height column {height}")
        stated = {k: getattr(handler, k) for k in ("dictionaries", "fatal", "split") if getattr(handler, k, None)}
        return cls(
            handler.name, tuple(handler.event_types), handler.schema, handler.transform,
            getattr(handler, "table", f"rows_{handler.name.lower()}"), height, list(getattr(handler, "key", columns)),
            getattr(handler, "records", f"{handler.schema}, reason string"), **stated,
        )

    def columns(self) -> list[str]:
        return _names(self.schema)

    def rows_and_rejects(self, records: DataFrame) -> tuple[DataFrame, DataFrame]:
        """Rows to store and rejected records; rows of a height with a fatal reason are not stored."""
        if self.split:
            return self.split(records)
        rejected = records.where(F.col("reason").isNotNull())
        rows = records.where(F.col("reason").isNull()).drop("reason")
        if self.fatal:
            rows = rows.join(self.failed(records).select(F.col("height").alias(self.height)), self.height, "left_anti")
        return rows, rejected

    def failed(self, records: DataFrame) -> DataFrame:
        """Heights that a fatal reason fails: ``height, reason``."""
        return (
            records.where(F.col("reason").isin(*self.fatal) if self.fatal else F.lit(False))
            .groupBy(F.col(self.height).alias("height"))
            .agg(F.min("reason").alias("reason"))
        )


@runtime_checkable
class Snapshotter(Protocol):
    """Takes calendar snapshots."""

    name: str

    def due(self, slots: DataFrame) -> DataFrame:
        """Slots that still need a snapshot."""
        ...

    def snapshot(self, targets: DataFrame) -> dict[str, DataFrame]:
        """Tables of the snapshots of all targets; one target must not decide over another."""
        ...

    def status(self, slots: DataFrame) -> DataFrame:
        """State of every expected slot."""
        ...


class HandlerRegistry:
    """Registered handlers and their subscriptions."""

    def __init__(self, handlers: Iterable[Handler] = ()):
        self.handlers: list[Handler] = list(handlers)

    def register(self, handler: Handler) -> None:
        self.handlers.append(handler)

    def subscriptions(self) -> list[tuple[str, str]]:
        """(handler, event type) pairs for ``dispatch_events``."""
        return [(h.name, t) for h in self.handlers for t in h.event_types]

    def select(self, wanted: Iterable[str] = ()) -> list[Handler]:
        """Handlers by case-insensitive name; nothing or "all" selects every one."""
        names = {w.strip().lower() for w in wanted if w.strip()}
        if not names or "all" in names:
            return list(self.handlers)
        unknown = names - {h.name.lower() for h in self.handlers}
        if unknown:
            raise ValueError(f"unknown handlers: {sorted(unknown)}")
        return [h for h in self.handlers if h.name.lower() in names]


def run_snapshotters(
    snapshotters: Iterable[Snapshotter], slots: DataFrame, store
) -> dict[str, str | None]:
    """Run every snapshotter once; ``store(name, tables)`` writes its tables.

    A failing snapshotter is reported and does not stop the others.
    """
    report: dict[str, str | None] = {}
    for s in snapshotters:
        try:
            targets = s.due(slots)
            if targets.isEmpty():
                report[s.name] = None
                continue
            store(s.name, s.snapshot(targets))
            report[s.name] = None
        except Exception as e:  # noqa: BLE001 - reported per snapshotter
            log.warning("snapshotter %s failed: %s", s.name, e)
            report[s.name] = str(e).splitlines()[0]
    return report
