"""Every registered query against its SQL counterpart."""

from __future__ import annotations

import os

import pytest

from chainloom import catalog
from tests.compare import difference, duck

# each of these fills stores of its own, which takes half a minute or more
SLOW = {
    "stream_exactly_once", "dead_letter_retry", "stream_dedup", "stream_recut", "custom_handler_ingest", "backfill_window",
    "run_from_manifest", "stored_snapshots",
}
NAMES = [n for n in catalog.QUERIES if n not in SLOW or os.environ.get("CHAINLOOM_SLOW_TESTS")]


@pytest.fixture(scope="module")
def con(sf_dir):
    return duck(sf_dir)


def test_every_query_has_sql():
    assert set(catalog.QUERIES) == set(catalog.ORACLES)


@pytest.mark.parametrize("name", NAMES)
def test_query(spark, con, sf_dir, name):
    assert difference(spark, con, name, catalog.QUERIES[name], catalog.ORACLES[name], sf_dir) is None
