"""Price and supply snapshots for all due dates at once."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chainloom.constants import NATIVE_DENOM, NATIVE_PRICE_ID
from chainloom.functions.numbers import parse_price
from chainloom.operators.snapshots import denoms_at_heights
from chainloom.sources.responses import price_results, supply_results


def price_snapshot(
    targets: DataFrame,
    rewards: DataFrame,
    metadata: DataFrame,
    responses: DataFrame,
    native: str = NATIVE_PRICE_ID,
) -> dict[str, DataFrame]:
    """Snapshot rows and prices of the denoms that occur in the rewards of each date.

    ``targets`` is ``(block_height, snapshot_date, slot)``. A failed native price fails the date;
    another failed price leaves out that denom only; a date without priced denoms is ok with
    count 0. A price text that is no plain decimal leaves the date without a row, so it stays due.
    """
    wanted = denoms_at_heights(
        rewards.join(targets.select("block_height"), "block_height", "left_semi"), metadata
    ).join(targets.select("block_height", "snapshot_date"), "block_height")
    fetched = wanted.join(
        price_results(responses), ["snapshot_date", "coingecko_id"], "left"
    ).withColumn(
        # a wanted price without stored response counts as a failed fetch
        "error", F.when(F.col("price_text").isNull() & F.col("error").isNull(), "no stored response").otherwise(F.col("error"))
    ).withColumn("price_usd", parse_price(F.col("price_text")))
    is_native = F.col("coingecko_id") == native
    failed = F.col("error").isNotNull()
    per_date = fetched.groupBy("snapshot_date").agg(
        F.min(F.when(is_native & failed, F.col("error"))).alias("_native_error"),
        F.count_if(~failed & F.col("price_usd").isNull()).alias("_unreadable"),
        F.count_if(~failed).alias("_count"),
    )
    verdict = targets.join(per_date, "snapshot_date", "left").where(
        F.col("_native_error").isNotNull() | (F.coalesce(F.col("_unreadable"), F.lit(0)) == 0)
    )
    native_failed = F.col("_native_error").isNotNull()
    snapshots = verdict.select(
        "snapshot_date",
        F.col("slot").alias("block_time"),
        F.when(native_failed, F.lit(0)).otherwise(F.coalesce("_count", F.lit(0))).cast("bigint").alias("denom_count"),
        F.when(native_failed, "failed").otherwise("ok").alias("status"),
        F.when(
            native_failed, F.concat(F.lit("LAVA price fetch failed: "), F.col("_native_error"))
        ).alias("error"),
    )
    good = snapshots.where(F.col("status") == "ok").select("snapshot_date")
    prices = (
        fetched.where(~failed)
        .join(good, "snapshot_date", "left_semi")
        .select("snapshot_date", "denom_id", "price_usd", "coingecko_id")
    )
    return {"snapshots": snapshots, "prices": prices}


def supply_snapshot(responses: DataFrame, denom: str = NATIVE_DENOM) -> DataFrame:
    """One supply row per stored response; failures are rows with status failed and supply 0."""
    return supply_results(responses, denom)
