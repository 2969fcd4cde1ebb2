"""All runnable queries; importing the package registers them."""

from chainloom.catalog.registry import ORACLES, QUERIES

from chainloom.catalog import (  # noqa: E402,F401  isort:skip
    calendar,
    heights,
    ingest_side,
    ledgers,
    metrics,
    read_side,
    scalars,
)

__all__ = ["ORACLES", "QUERIES"]
