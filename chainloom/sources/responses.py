"""Stored response files of the snapshot services."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chainloom.constants import NATIVE_DENOM
from chainloom.functions.payloads import (
    is_bad,
    json_or_bad,
    price_of,
    reward_entries,
    rewards_outcome,
    trace_of,
)
from chainloom.functions.wide import whole_text
from chainloom import schemas


def read_landed(spark: SparkSession, path: str, schema: str, fmt: str = "json") -> DataFrame:
    """Landed files with a declared schema; a response body stays text until it is parsed."""
    return spark.read.format(fmt).schema(schema).load(path)


def read_blocks(spark: SparkSession, path: str, fmt: str = "json") -> DataFrame:
    return read_landed(spark, path, schemas.LANDED_BLOCKS, fmt)


def _rest(responses: DataFrame) -> list[str]:
    return [c for c in responses.columns if c not in ("body", "http_status")]


# Each step below refers to the decoded body as a column, so the JSON is decoded once per row.


def reward_results(responses: DataFrame) -> DataFrame:
    """Stored rewards responses with ``outcome, reason, entries``."""
    body, status = F.col("body"), F.col("http_status")
    decoded = responses.withColumn("_j", json_or_bad(body, schemas.REWARDS_JSON)).withColumn(
        "entries", reward_entries(F.col("_j"))
    )
    checked = decoded.withColumn(
        "_broken",
        F.filter(F.flatten(F.transform("entries", lambda e: e["amounts"])), lambda a: a["amount"].isNull()),
    )
    outcome, reason = rewards_outcome(body, status, F.col("_j"), F.col("_broken"))
    judged = checked.withColumns({"outcome": outcome, "reason": reason})
    return judged.select(
        *_rest(responses),
        "outcome",
        "reason",
        F.when(F.col("outcome") == "fetched", F.col("entries")).alias("entries"),
    )


def reward_amounts(results: DataFrame) -> DataFrame:
    """One row per amount of fetched responses, with its place in the response."""
    # outer, so that no filter on the decoded entries is derived: it would go below the steps before it and decode each
    # body once for every mention of a field; responses without entries drop out with the second explode
    fetched = F.when(F.col("outcome") == "fetched", F.col("entries"))
    entries = results.select("height", "provider", "position", F.posexplode_outer(fetched).alias("entry_pos", "_e"))
    return entries.select(
        "height",
        "provider",
        "position",
        "entry_pos",
        "_e.source_kind",
        "_e.spec",
        F.posexplode("_e.amounts").alias("amount_pos", "_a"),
    ).select(
        "height", "provider", "position", "entry_pos", "amount_pos", "source_kind", "spec",
        F.col("_a.denom").alias("source_denom"),
        F.col("_a.amount").alias("amount_text"),
    )


def price_results(responses: DataFrame) -> DataFrame:
    """Stored price responses with ``price_text`` or ``error``."""
    body, status = F.col("body"), F.col("http_status")
    decoded = responses.withColumn("_j", json_or_bad(body, schemas.PRICE_JSON))
    price, error = price_of(body, status, F.col("_j"))
    return decoded.select(*_rest(responses), price.alias("price_text"), error.alias("error"))


def supply_results(responses: DataFrame, denom: str = NATIVE_DENOM) -> DataFrame:
    """Amount of one denom in stored supply responses as ``total_supply, status, error``.

    A repeated denom keeps its last amount. Failed rows carry supply 0 and the reason.
    """
    status = F.col("http_status")
    coins = F.coalesce(F.col("_j.supply"), F.array().cast("array<struct<denom: string, amount: string>>"))
    decoded = responses.withColumn("_j", json_or_bad(F.col("body"), schemas.SUPPLY_JSON))
    listed = decoded.withColumns(
        {
            "_mine": F.filter(coins, lambda c: c["denom"] == denom),
            "_kinds": F.size(F.array_distinct(F.transform(coins, lambda c: F.coalesce(c["denom"], F.lit(""))))),
        }
    ).withColumn("_text", F.coalesce(F.try_element_at("_mine", F.lit(-1))["amount"], F.lit("")))
    trimmed = F.regexp_replace("_text", r"^\s+|\s+\z", "")
    number = whole_text(trimmed)
    error = (
        F.when(~status.between(200, 299), F.concat(F.lit("fetch supply: http "), status.cast("string")))
        .when(is_bad(F.col("_j")), "fetch supply: decode supply body")
        .when(
            F.size("_mine") == 0,
            F.format_string("%s missing from supply response (denoms=%d)", F.lit(denom), F.col("_kinds")),
        )
        .when(F.col("_number").isNull(), F.concat(F.lit(f'parse {denom} amount "'), F.col("_text"), F.lit('"')))
    )
    judged = listed.withColumn("_number", number).withColumn("error", error)
    return judged.select(
        *_rest(responses),
        # beyond 38 digits the decimal is NULL and the text alone holds the supply
        F.when(F.col("error").isNull(), F.col("_number").try_cast("decimal(38,0)")).otherwise(F.lit(0)).cast("decimal(38,0)").alias("total_supply"),
        F.when(F.col("error").isNull(), F.col("_number")).otherwise("0").alias("supply_text"),
        F.when(F.col("error").isNull(), "ok").otherwise("failed").alias("status"),
        "error",
    )


def denom_traces(responses: DataFrame) -> DataFrame:
    """Stored denom traces as ``hash, base_denom, error``."""
    decoded = responses.withColumn("_j", json_or_bad(F.col("body"), schemas.TRACE_JSON))
    base, error = trace_of(F.col("http_status"), F.col("_j"))
    return decoded.select("hash", base.alias("base_denom"), error.alias("error"))
