"""Catalogue of landed sources: what each one covers and whether it is usable."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chainloom.functions.numbers import parse_int_or_zero
from chainloom.schemas import GENESIS_JSON, STATUS_JSON
from chainloom.functions.payloads import is_bad, json_or_bad


def parse_status(statuses: DataFrame) -> DataFrame:
    """Stored status bodies ``(source, body)`` as one catalogue row per source."""
    parsed = json_or_bad(F.col("body"), STATUS_JSON)
    sync = parsed["sync_info"]
    return statuses.select(
        "source",
        F.coalesce(parsed["node_info"]["network"], F.lit("")).alias("network"),
        parse_int_or_zero(sync["earliest_block_height"]).alias("earliest_height"),
        sync["earliest_block_time"].try_cast("timestamp").alias("earliest_time"),
        parse_int_or_zero(sync["latest_block_height"]).alias("latest_height"),
        sync["latest_block_time"].try_cast("timestamp").alias("latest_time"),
        F.when(is_bad(parsed), "status decode").alias("probe_error"),
    )


def source_coverage(landed: DataFrame, expected_network: str = "") -> DataFrame:
    """Coverage per source from its landed rows ``(source, network, height, time)``.

    Each source keeps the network of its highest block.
    """
    low = F.min(F.struct("height", "time"))
    high = F.max(F.struct("height", "time", "network"))
    rows = landed.groupBy("source").agg(low.alias("_low"), high.alias("_high"))
    return check_network(
        rows.select(
            "source",
            F.coalesce(F.col("_high.network"), F.lit("")).alias("network"),
            F.col("_low.height").alias("earliest_height"),
            F.col("_low.time").alias("earliest_time"),
            F.col("_high.height").alias("latest_height"),
            F.col("_high.time").alias("latest_time"),
            F.lit(None).cast("string").alias("probe_error"),
        ),
        expected_network,
    )


def check_network(sources: DataFrame, expected_network: str = "") -> DataFrame:
    """Add ``disabled`` and ``reason``: failed probes, and a network that is missing or wrong.

    Without an expectation the network is not checked.
    """
    want = F.lit(expected_network)
    reason = F.when(
        F.col("probe_error").isNotNull(), F.concat(F.lit("probe failed: "), F.col("probe_error"))
    )
    if expected_network:
        reason = reason.when(
            F.coalesce(F.col("network"), F.lit("")) == "",
            F.concat(F.lit("endpoint did not report chain_id (expected "), want, F.lit(")")),
        ).when(
            F.col("network") != want,
            F.concat(F.lit("chain_id mismatch: expected="), want, F.lit(" advertised="), F.col("network")),
        )
    return sources.withColumn("reason", reason).withColumn("disabled", F.col("reason").isNotNull()).drop(
        "probe_error"
    )


def _or_error(value: Column, message: str) -> Column:
    return F.coalesce(value, F.raise_error(F.lit(message)).cast("bigint"))


def chain_tip(sources: DataFrame) -> DataFrame:
    """Highest latest height over healthy sources; none is an error."""
    best = F.max(F.when(~F.col("disabled") & (F.col("latest_height") > 0), F.col("latest_height")))
    return sources.agg(best.alias("_tip")).select(_or_error(F.col("_tip"), "no healthy sources").alias("tip"))


def earliest_start(sources: DataFrame) -> DataFrame:
    """Lowest known earliest height over healthy sources; none is an error."""
    low = F.min(F.when(~F.col("disabled") & (F.col("earliest_height") > 0), F.col("earliest_height")))
    return sources.agg(low.alias("_low")).select(
        _or_error(F.col("_low"), "no healthy source reports an earliest height").alias("start_height")
    )


def validate_range(sources: DataFrame, start: int) -> DataFrame:
    """Does some healthy source serve ``start`` (or not say where it begins)?"""
    serves = ~F.col("disabled") & ((F.col("earliest_height") <= 0) | (F.col("earliest_height") <= start))
    return sources.agg(F.coalesce(F.bool_or(serves), F.lit(False)).alias("covered"))


def tip_time(sources: DataFrame, genesis_time: Column) -> DataFrame:
    """Latest block time over all sources, and the genesis time.

    Without a known genesis time, the earliest time of a source that starts at height 1 stands in.
    """
    from_one = F.max(F.when(F.col("earliest_height") == 1, F.col("earliest_time")))
    return sources.agg(
        F.max("latest_time").alias("tip_time"), F.coalesce(genesis_time, from_one).alias("genesis_time")
    )


def genesis_info(bodies: DataFrame) -> DataFrame:
    """Genesis facts of stored ``(chain, body)``: initial height, time and chain id.

    A body without a positive initial height has an ``error``; callers then start at height 1.
    """
    parsed = json_or_bad(F.col("body"), GENESIS_JSON)
    doc = parsed["result"]["genesis"]
    height = parse_int_or_zero(doc["initial_height"])
    error = F.when(is_bad(parsed), "genesis decode").when(
        height <= 0, "genesis: initial_height missing or zero"
    )
    return bodies.select(
        "chain",
        F.when(error.isNull(), height).otherwise(F.lit(1).cast("bigint")).alias("initial_height"),
        F.when(error.isNull(), doc["genesis_time"].try_cast("timestamp")).alias("genesis_time"),
        F.when(error.isNull(), doc["chain_id"]).alias("chain_id"),
        error.alias("error"),
    )
