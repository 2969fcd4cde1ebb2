"""Daily quality-of-service rollup and what is read from it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chainloom.functions.times import utc_date
from chainloom.operators.dictionary import dict_decode

ROLLUP_KEYS = ["date", "chain_id", "provider"]

_FACT_COLUMNS = [
    "cu", "relay_number", "qos_sync", "qos_avail", "qos_latency",
    "ex_qos_sync", "ex_qos_avail", "ex_qos_latency",
]
_METRICS = ["sync", "avail", "latency"]


def _whole(total: Column) -> Column:
    return total.cast("bigint")


def rollup_measures() -> dict[str, Column]:
    """The 19 measures; all are sums or counts, so rows of a rollup can be summed again.

    ``*_w`` weigh a metric by relays and pair with ``*_weight``; ``*_sum`` only take rows whose
    three metrics and CU are positive and pair with ``*_count``. Sums without a qualifying row
    are NULL, weights and counts are 0.
    """
    cu, relays = F.col("cu"), F.col("relay_number")

    def family(prefix: str) -> dict[str, Column]:
        cols = {m: F.col(f"{prefix}_{m}").cast("double") for m in _METRICS}
        usable = (cols["sync"] > 0) & (cols["avail"] > 0) & (cols["latency"] > 0) & (cu > 0)
        out = {
            f"{prefix}_{m}_w": F.sum(F.when(c.isNotNull(), c * relays.cast("double")))
            for m, c in cols.items()
        }
        out[f"{prefix}_weight"] = _whole(
            F.sum(F.when(cols["sync"].isNotNull(), relays).otherwise(0))
        )
        if prefix == "qos":
            out["qos_cu"] = _whole(F.sum(F.when(usable, cu).otherwise(0)))
        out |= {f"{prefix}_{m}_sum": F.sum(F.when(usable, c)) for m, c in cols.items()}
        out[f"{prefix}_count"] = F.count(F.when(usable, 1))
        return out

    return {"cu": _whole(F.sum(cu)), "relays": _whole(F.sum(relays))} | family("qos") | family("ex_qos")


ROLLUP_SUMS = [
    "cu", "relays",
    "qos_sync_w", "qos_avail_w", "qos_latency_w", "qos_weight", "qos_cu",
    "qos_sync_sum", "qos_avail_sum", "qos_latency_sum", "qos_count",
    "ex_qos_sync_w", "ex_qos_avail_w", "ex_qos_latency_w", "ex_qos_weight",
    "ex_qos_sync_sum", "ex_qos_avail_sum", "ex_qos_latency_sum", "ex_qos_count",
]


def daily_by_id(facts: DataFrame) -> DataFrame:
    """Rollup keyed by dictionary ids: the only pass over the facts, with map-side combine."""
    return (
        facts.where(F.col("timestamp").isNotNull())
        .select(utc_date(F.col("timestamp")).alias("date"), "chain_id", "provider_id", *_FACT_COLUMNS)
        .groupBy("date", "chain_id", "provider_id")
        .agg(*[c.alias(n) for n, c in rollup_measures().items()])
    )


def relay_daily(facts: DataFrame, providers: DataFrame, chains: DataFrame) -> DataFrame:
    """Per UTC date, chain and provider: totals and QoS measures with the texts joined in.

    Ids are decoded after the aggregation, so the joins see one row per group and not the facts.
    """
    daily = daily_by_id(facts)
    named = dict_decode(daily, providers, "provider_id", "provider")
    named = dict_decode(named, chains, "chain_id", "_chain").withColumnRenamed("_chain", "chain_id")
    return named.select(*ROLLUP_KEYS, *ROLLUP_SUMS)


def fact_dim_join(facts: DataFrame, providers: DataFrame, chains: DataFrame) -> DataFrame:
    """Facts with provider and chain texts."""
    return dict_decode(
        dict_decode(facts, providers, "provider_id", "provider"), chains, "chain_id", "chain"
    )


def add_rollups(*rollups: DataFrame, keys: list[str] = ROLLUP_KEYS) -> DataFrame:
    """Sum rollups (stored rows and deltas) into one; correct since every measure is a sum."""
    both = rollups[0]
    for r in rollups[1:]:
        both = both.unionByName(r)
    return both.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in ROLLUP_SUMS])


def qos_averages(rollup: DataFrame, by: list[str], weighted: bool) -> DataFrame:
    """QoS averages over any grouping of rollup rows; NULL where nothing qualified."""
    out = []
    for prefix in ("qos", "ex_qos"):
        suffix, base = ("w", f"{prefix}_weight") if weighted else ("sum", f"{prefix}_count")
        out += [
            F.try_divide(F.sum(f"{prefix}_{m}_{suffix}"), F.sum(base).cast("double")).alias(
                f"{prefix}_{m}_avg"
            )
            for m in _METRICS
        ]
    return rollup.groupBy(*by).agg(*out)
