"""Error and response classes as column expressions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from chainloom.constants import REPLICA_MESSAGES, RETRYABLE_NETWORK_TEXT, STATE_PRUNED_CODES


def _contains_any(text: Column, parts: list[str]) -> Column:
    return reduce(lambda a, b: a | b, [text.contains(p) for p in parts])


def classify_message(message: Column) -> Column:
    """``retry`` when the replica cannot answer, else ``no_rewards``."""
    low = F.lower(F.coalesce(message, F.lit("")))
    return F.when(_contains_any(low, REPLICA_MESSAGES), "retry").otherwise("no_rewards")


def classify_http_rewards(status: Column) -> Column:
    """Class of a stored rewards response by its HTTP code."""
    return (
        F.when(status.between(200, 299), "ok")
        .when(status.isin(*STATE_PRUNED_CODES), "state_pruned")
        .otherwise("failed")
    )


def classify_fetch_error(code: Column) -> Column:
    """True (permanent) only when no source covers the height or the height is pruned."""
    return F.coalesce(code.isin("no_source_covers", "height_pruned"), F.lit(False))


def classify_lcd_status(status: Column) -> Column:
    """``height_pruned`` for 400 and 404, else NULL (other errors stay as they are)."""
    return F.when(status.isin(400, 404), "height_pruned")


def classify_http_status(status: Column) -> Column:
    return (
        F.when(status.between(200, 299), "ok")
        .when(status == 429, "rate_limited")
        .when(status.between(500, 599), "server_error")
        .otherwise("terminal")
    )


def is_retryable_net_error(message: Column) -> Column:
    return F.coalesce(_contains_any(message, RETRYABLE_NETWORK_TEXT), F.lit(False))
