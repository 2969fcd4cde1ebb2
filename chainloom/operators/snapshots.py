"""Calendar snapshots: due slots, status, gates, suppression, denom resolution, pricing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chainloom.constants import NATIVE_PRICE_ID
from chainloom.functions.wide import difference_text, product_text, quotient_text


def slots_due(slots: DataFrame, snapshots: DataFrame) -> DataFrame:
    """Slots without a snapshot row of status ok or failed; failed dates are not tried again."""
    done = snapshots.where(F.col("status").isin("ok", "failed")).select(
        F.col("snapshot_date").alias("slot_date")
    )
    return slots.join(done, "slot_date", "left_anti")


def snapshot_status(slots: DataFrame, snapshots: DataFrame) -> DataFrame:
    """One row per expected slot: ``state`` covered, missing or failed, the error and the block.

    A status other than ok and failed shows as failed with ``status=…`` in the error.
    """
    rows = snapshots.select(
        F.col("snapshot_date").alias("slot_date"), "status", "error", "block_height"
    )
    error = F.coalesce("error", F.lit(""))
    return slots.join(rows, "slot_date", "left").select(
        "slot_date",
        F.when(F.col("status").isNull(), "missing")
        .when(F.col("status") == "ok", "covered")
        .otherwise("failed")
        .alias("state"),
        F.when(F.col("status") == "failed", error)
        .when(
            F.col("status").isNotNull() & (F.col("status") != "ok"),
            F.concat(F.lit("status="), F.col("status"), F.lit(" "), error),
        )
        .alias("error"),
        "block_height",
    )


def outcome_counts(results: DataFrame, by: list[str]) -> DataFrame:
    """Providers per outcome and snapshot."""
    return results.groupBy(*by).agg(
        *[
            F.count_if(F.col("outcome") == o).alias(o)
            for o in ("fetched", "no_rewards", "state_pruned", "failed")
        ],
        F.count(F.lit(1)).alias("total"),
    )


def snapshot_gate(results: DataFrame, by: list[str]) -> DataFrame:
    """Status per snapshot: failed when more than a fifth of its providers failed to fetch.

    Whole-number arithmetic, so exactly one in five still passes. The first reason is that of
    the first failed provider by ``position``.
    """
    failed = F.col("outcome") == "failed"
    counts = results.groupBy(*by).agg(
        F.count_if(failed).alias("failed"),
        F.count(F.lit(1)).alias("total"),
        F.count_if(F.col("outcome") == "fetched").alias("fetched"),
        F.min_by(F.when(failed, F.col("reason")), F.when(failed, F.col("position"))).alias("first_reason"),
    )
    bad = F.col("failed") * 5 > F.col("total")
    return counts.select(
        *by,
        F.when(bad, "failed").otherwise("ok").alias("status"),
        F.when(
            bad,
            F.format_string(
                "%d/%d providers failed to fetch: %s", F.col("failed"), F.col("total"), F.col("first_reason")
            ),
        ).alias("error"),
        "failed",
        "total",
        "fetched",
    )


def provider_count(results: DataFrame, by: list[str]) -> DataFrame:
    """Fetched providers with at least one entry per snapshot."""
    used = (F.col("outcome") == "fetched") & (F.size("entries") > 0)
    return results.groupBy(*by).agg(F.count_if(used).alias("provider_count"))


def drop_suppressed(amounts: DataFrame, metadata: DataFrame, denoms: DataFrame) -> DataFrame:
    """Amounts whose raw denom is not suppressed; runs before denoms are resolved."""
    bad = (
        metadata.where(F.col("suppress"))
        .join(denoms, F.col("denom_id") == F.col("id"))
        .select(F.col("value").alias("source_denom"))
    )
    return amounts.join(F.broadcast(bad), "source_denom", "left_anti")


def resolve_denoms(amounts: DataFrame, traces: DataFrame) -> DataFrame:
    """Add ``resolved_denom`` and ``resolve_error`` from the trace table.

    Plain denoms pass through. An ``ibc/`` denom takes its trace's base; an empty hash or a 404
    trace gives neither (its amount drops out), any other trace failure, including no stored
    trace, is an error. Only distinct ``ibc/`` denoms meet the traces.
    """
    ibc = F.col("source_denom").startswith("ibc/")
    hashes = (
        amounts.where(ibc)
        .select("source_denom")
        .distinct()
        .withColumn("hash", F.expr("substring(source_denom, 5)"))
    )
    answers = traces.select(
        "hash", "base_denom", F.col("error").alias("_error"), F.lit(True).alias("_answered")
    )
    mapping = hashes.join(answers, "hash", "left").select(
        "source_denom",
        F.col("base_denom").alias("_base"),
        F.when(F.col("hash") != "", F.when(F.col("_answered").isNull(), F.lit("no stored trace")).otherwise(F.col("_error"))).alias("_trace_error"),
    )
    return amounts.join(F.broadcast(mapping), "source_denom", "left").select(
        *amounts.columns,
        F.when(ibc, F.col("_base")).otherwise(F.col("source_denom")).alias("resolved_denom"),
        F.when(
            ibc & F.col("_trace_error").isNotNull(),
            F.concat(F.lit("resolve ibc "), F.col("source_denom"), F.lit(": "), F.col("_trace_error")),
        ).alias("resolve_error"),
    )


def active_price_denoms(metadata: DataFrame) -> DataFrame:
    """Denoms with a price id that are not suppressed, by id."""
    return (
        metadata.where(F.col("coingecko_id").isNotNull() & ~F.col("suppress"))
        .select("denom_id", "coingecko_id")
        .orderBy("denom_id")
    )


def denoms_at_heights(rewards: DataFrame, metadata: DataFrame) -> DataFrame:
    """Priced denoms that occur in the rewards of each height.

    Rewards shrink to distinct (height, denom) before the join.
    """
    seen = rewards.select("block_height", "denom_id").distinct()
    active = metadata.where(F.col("coingecko_id").isNotNull() & ~F.col("suppress"))
    return seen.join(active.select("denom_id", "coingecko_id"), "denom_id").select(
        "block_height", "denom_id", "coingecko_id"
    )


def load_bearing_first(denoms: DataFrame, by: list[str] | None = None, native: str = NATIVE_PRICE_ID) -> DataFrame:
    """Denoms in fetch order: the native coin, then the rest by id."""
    first = F.when(F.col("coingecko_id") == native, 0).otherwise(1)
    return denoms.orderBy(*(by or []), first, "denom_id")


def priced_rewards(
    rewards: DataFrame,
    snapshots: DataFrame,
    providers: DataFrame,
    specs: DataFrame,
    denoms: DataFrame,
    metadata: DataFrame,
    prices: DataFrame,
) -> DataFrame:
    """Rewards of good snapshots with display amount, price and value.

    Suppressed denoms are left out; a denom without metadata or price keeps its row with NULLs. The columns that end in
    ``_text`` are exact for amounts of up to 40 digits; the decimals beside them are NULL where they don't hold the value.
    ``rewards`` may lack ``amount_text``.
    """
    ok = snapshots.where(F.col("status") == "ok").select("block_height", "snapshot_date", "block_time")
    texts = lambda d, key, out: d.select(F.col("id").alias(key), F.col("value").alias(out))
    joined = (
        rewards.join(ok, "block_height")
        .join(texts(providers, "provider_id", "provider"), "provider_id")
        .join(texts(specs, "spec_id", "spec"), "spec_id")
        .join(texts(denoms, "denom_id", "resolved_denom"), "denom_id")
        .join(metadata.select("denom_id", "base_denom", "factor", "suppress"), "denom_id", "left")
        .where(~F.coalesce(F.col("suppress"), F.lit(False)))
        .join(prices.select("snapshot_date", "denom_id", "price_usd"), ["snapshot_date", "denom_id"], "left")
    )
    raw = F.col("amount_text") if "amount_text" in rewards.columns else F.col("amount").cast("string")
    texts_ = joined.withColumn("_raw", raw).withColumn("_shown", quotient_text(F.col("_raw"), F.col("factor")))
    valued = texts_.withColumn("_value", product_text(F.col("_shown"), F.col("price_usd")))
    return valued.select(
        "snapshot_date",
        "block_height",
        "block_time",
        "provider",
        "spec",
        "source_kind",
        "source_denom",
        "resolved_denom",
        F.col("base_denom").alias("display_denom"),
        F.col("amount").alias("raw_amount"),
        F.col("_shown").try_cast("decimal(38,18)").alias("display_amount"),
        "price_usd",
        F.col("_value").try_cast("decimal(38,12)").alias("value_usd"),
        F.col("_raw").alias("raw_text"),
        F.col("_shown").alias("display_text"),
        F.col("_value").alias("value_text"),
    )


def supply_burn(snapshots: DataFrame) -> DataFrame:
    """Supply lost since the previous good snapshot, as exact texts; one row per calendar snapshot."""
    w = Window.orderBy("snapshot_date")
    return (
        snapshots.where(F.col("status") == "ok")
        .select("snapshot_date", "supply_text", F.lag("supply_text").over(w).alias("_previous"))
        .select(
            "snapshot_date",
            F.col("supply_text").alias("total_supply"),
            F.col("_previous").alias("previous_supply"),
            difference_text(F.col("_previous"), F.col("supply_text")).alias("burned"),
        )
    )
