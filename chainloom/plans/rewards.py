"""Rewards snapshots for all due dates at once."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chainloom import schemas
from chainloom.functions.wide import order_key, whole_text
from chainloom.operators.dictionary import dict_encode, dict_lookup
from chainloom.operators.merge import first_per_key
from chainloom.operators.snapshots import drop_suppressed, provider_count, resolve_denoms, snapshot_gate
from chainloom.session import cut
from chainloom.sources.responses import reward_amounts, reward_results


def rewards_snapshot(
    targets: DataFrame,
    responses: DataFrame,
    metadata: DataFrame,
    denoms: DataFrame,
    providers: DataFrame,
    specs: DataFrame,
    traces: DataFrame,
) -> dict[str, DataFrame]:
    """Snapshot rows, reward rows and grown dictionaries for the target heights.

    ``targets`` is ``(block_height, snapshot_date, block_time)``. Per height: a failed gate, a
    denom that cannot be resolved or an amount that is no number decides alone over that height.
    An unreadable amount leaves the date without a row, so it stays due; amounts of more than 40
    digits are listed in ``quarantine`` and are no rewards.
    """
    # the calendar bounds heights; suppressed denoms, traced denoms, specs and denoms are lists of names: none is worth
    # a shuffle of the amounts, which would put all rows of a height or denom into one task
    wanted = responses.join(
        F.broadcast(targets.select(F.col("block_height").alias("height"))), "height", "left_semi"
    )
    # decoded bodies and resolved amounts feed several steps, so each is computed once
    results = cut(reward_results(wanted), "reward-results")
    gate = snapshot_gate(results, ["height"])
    passed = gate.where(F.col("status") == "ok").select("height")
    amounts = reward_amounts(results.join(F.broadcast(passed), "height", "left_semi"))
    kept = drop_suppressed(amounts, metadata, denoms)
    resolved = cut(resolve_denoms(kept, traces), "reward-amounts")
    broken = resolved.groupBy("height").agg(
        F.min("resolve_error").alias("_resolve_error"),
        F.coalesce(
            F.bool_or(
                F.col("resolved_denom").isNotNull() & ~F.col("amount_text").rlike(r"^[+-]?[0-9]+\z")
            ),
            F.lit(False),
        ).alias("_bad_amount"),
    )
    verdict = (
        gate.join(broken, "height", "left")
        .join(provider_count(results, ["height"]), "height")
        .withColumn("_failed", (F.col("status") == "failed") | F.col("_resolve_error").isNotNull())
    )
    snapshots = (
        targets.withColumnRenamed("block_height", "height")
        .join(verdict, "height", "left")
        .where(F.coalesce(F.col("_failed") | ~F.col("_bad_amount"), F.lit(True)))
        .select(
            F.col("height").alias("block_height"),
            "snapshot_date",
            "block_time",
            F.when(F.col("_failed"), F.col("fetched"))
            .otherwise(F.coalesce("provider_count", F.lit(0)))
            .cast("bigint")
            .alias("provider_count"),
            F.when(F.col("_failed"), "failed").otherwise("ok").alias("status"),
            F.coalesce(
                F.col("error"), F.concat(F.lit("resolve denoms: "), F.col("_resolve_error"))
            ).alias("error"),
        )
    )
    good = snapshots.where(F.col("status") == "ok").select(F.col("block_height").alias("height"))
    rows = (
        resolved.where(F.col("resolved_denom").isNotNull())
        .join(F.broadcast(good), "height", "left_semi")
        # amounts have up to 40 digits: the text is exact, the decimal is NULL beyond 38
        .withColumn("_exact", whole_text(F.col("amount_text")))
        .withColumn("amount", F.col("_exact").try_cast("decimal(38,0)"))
    )
    providers_next = dict_encode(
        results.where(F.col("outcome") == "fetched").join(F.broadcast(good), "height", "left_semi"), providers, "provider"
    )
    specs_next = dict_encode(rows, specs, "spec")
    denoms_next = dict_encode(rows, denoms, "resolved_denom")
    coded = dict_lookup(rows, providers_next, "provider", "provider_id")
    coded = dict_lookup(coded, F.broadcast(specs_next), "spec", "spec_id")
    coded = dict_lookup(coded, F.broadcast(denoms_next), "resolved_denom", "denom_id").withColumnRenamed(
        "height", "block_height"
    )
    # a repeated key keeps its first amount in response order
    rewards = first_per_key(
        coded.where(F.col("_exact").isNotNull()).withColumn("amount_text", F.col("_exact")),
        schemas.REWARD_KEY,
        ["position", "entry_pos", "amount_pos", order_key(F.col("amount_text"))],
    ).select(*schemas.REWARD_KEY, "amount", "amount_text")
    return {
        "snapshots": snapshots,
        "rewards": rewards,
        "providers": providers_next,
        "specs": specs_next,
        "denoms": denoms_next,
        "quarantine": rows.where(F.col("_exact").isNull()).drop("_exact"),
    }
