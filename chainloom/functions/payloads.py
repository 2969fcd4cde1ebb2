"""Readers of stored response bodies."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from chainloom.constants import SOURCE_KIND_DEFAULT, SOURCE_KIND_TOTAL, SOURCE_KINDS
from chainloom.functions.classify import classify_http_rewards, classify_message
from chainloom.functions.numbers import clean_integer

_BAD = "_bad"


def json_or_bad(text: Column, schema: str) -> Column:
    """``from_json`` whose ``_bad`` field is set when the text does not decode."""
    return F.from_json(
        text, f"{schema}, {_BAD} string", {"columnNameOfCorruptRecord": _BAD, "mode": "PERMISSIVE"}
    )


def is_bad(parsed: Column) -> Column:
    """True for text that is no JSON object of the expected shape (also for blank text)."""
    return parsed.isNull() | parsed.getField(_BAD).isNotNull()


def is_blank(text: Column) -> Column:
    return F.coalesce(text.rlike(r"^\s*\z"), F.lit(True))


def parse_source(text: Column) -> Column:
    """Split "Label: spec" at the first ": " into ``struct(source_kind, spec)``."""
    at = F.instr(text, ": ")
    label = F.substring(text, F.lit(1), at - 1)
    kind = F.lit(SOURCE_KIND_DEFAULT)
    for name, code in SOURCE_KINDS.items():
        kind = F.when((at > 0) & (label == name), code).otherwise(kind)
    spec = F.when(at > 0, F.substring(text, at + 2, F.length(text))).otherwise(text)
    return F.struct(kind.cast("smallint").alias("source_kind"), spec.alias("spec"))


def _entry(source_kind: Column, spec: Column, coins: Column) -> Column:
    amounts = F.transform(
        F.coalesce(coins, F.array()),
        lambda c: F.struct(
            F.coalesce(c["denom"], F.lit("")).alias("denom"),
            F.coalesce(c["amount"], F.lit("")).alias("raw"),
            clean_integer(F.coalesce(c["amount"], F.lit(""))).alias("amount"),
        ),
    )
    return F.struct(
        source_kind.cast("smallint").alias("source_kind"),
        spec.alias("spec"),
        amounts.alias("amounts"),
    )


def reward_entries(parsed: Column) -> Column:
    """Entries of a decoded rewards body: ``info`` wins over ``total``, which is one entry of kind 3."""
    source = lambda i: F.coalesce(i["source"], F.lit(""))
    none = F.from_json(
        F.lit("[]"),
        "array<struct<source_kind: smallint, spec: string, "
        "amounts: array<struct<denom: string, raw: string, amount: string>>>>",
    )
    return (
        F.when(
            F.size(F.coalesce(parsed["info"], F.array())) > 0,
            F.transform(
                parsed["info"],
                lambda i: _entry(
                    parse_source(source(i))["source_kind"], parse_source(source(i))["spec"], i["amount"]
                ),
            ),
        )
        .when(
            F.size(F.coalesce(parsed["total"], F.array())) > 0,
            F.array(_entry(F.lit(SOURCE_KIND_TOTAL), F.lit(""), parsed["total"])),
        )
        .otherwise(none)
    )


def rewards_outcome(body: Column, status: Column, parsed: Column, broken: Column) -> tuple[Column, Column]:
    """Outcome and reason of a stored rewards response.

    Outcomes: ``fetched``, ``no_rewards``, ``state_pruned`` (the replicas could not answer),
    ``failed``. ``broken`` lists the amounts that are no integers.
    """
    http = classify_http_rewards(status)
    said_no = parsed["success"] == F.lit(False)
    outcome = (
        F.when(http != "ok", http)
        .when(is_blank(body) | is_bad(parsed), "state_pruned")
        .when(
            said_no,
            F.when(classify_message(parsed["message"]) == "retry", "state_pruned").otherwise("no_rewards"),
        )
        .when(F.size(broken) > 0, "failed")
        .otherwise("fetched")
    )
    first = F.get(broken, F.lit(0))
    reason = (
        F.when(http != "ok", F.concat(F.lit("http "), status.cast("string")))
        .when(is_blank(body), "empty body")
        .when(is_bad(parsed), "decode")
        .when(said_no, F.coalesce(parsed["message"], F.lit("")))
        .when(
            F.size(broken) > 0,
            F.format_string('non-integer amount "%s" (denom=%s)', first["raw"], first["denom"]),
        )
    )
    return outcome, reason


def price_of(body: Column, status: Column, parsed: Column) -> tuple[Column, Column]:
    """Price text and error of a stored price response.

    A coin unknown that day (404, blank body, no market data, no usd entry) is price "0";
    bad JSON and other non-2xx codes are errors.
    """
    listed = F.try_element_at(parsed["market_data"]["current_price"], F.lit("usd"))
    # the decoder writes numbers again as doubles, so the digits come from the body itself
    digits = F.regexp_extract(
        body, r'"current_price"\s*:\s*\{[^{}]*"usd"\s*:\s*"?(-?[0-9][0-9.eE+-]*)', 1
    )
    usd = F.when(listed.isNotNull(), F.coalesce(F.nullif(digits, F.lit("")), listed))
    none = F.lit(None).cast("string")
    error = (
        F.when(status == 404, none)
        .when(status == 429, "rate limited")
        .when(~status.between(200, 299), F.concat(F.lit("http "), status.cast("string")))
        .when(is_blank(body), none)
        .when(is_bad(parsed), "decode history body")
    )
    found = F.when((status == 404) | is_blank(body), F.lit("0")).otherwise(
        F.coalesce(F.nullif(usd, F.lit("")), F.lit("0"))
    )
    return F.when(error.isNull(), found), error


def trace_of(status: Column, parsed: Column) -> tuple[Column, Column]:
    """Base denom and error of a stored denom trace; 404 gives neither (drop the amount)."""
    base = F.regexp_replace(
        F.coalesce(parsed["denom_trace"]["base_denom"], F.lit("")), r"^\s+|\s+\z", ""
    )
    error = (
        F.when(status == 404, F.lit(None).cast("string"))
        .when(~status.between(200, 299), F.concat(F.lit("http "), status.cast("string")))
        .when(is_bad(parsed), "decode")
        .when(base == "", "empty base_denom")
    )
    return F.when(error.isNull() & (status != 404), base), error
