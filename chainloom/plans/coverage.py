"""Coverage report per handler."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chainloom.constants import HEIGHT_BUCKET
from chainloom.operators.intervals import HANDLER, range_gaps
from chainloom.operators.ledger import failure_counts
from chainloom.operators.sweep import sweep


def coverage_gaps(
    ranges: DataFrame, failures: DataFrame, windows: DataFrame, width: int = HEIGHT_BUCKET
) -> DataFrame:
    """Never-tried gaps: heights of the window that are neither covered nor failed.

    Gaps minus failed heights are the gaps of ranges and failed heights together.
    """
    failed = failures.select(
        "handler", F.col("height").alias("from_height"), F.col("height").alias("to_height")
    )
    tried = ranges.select("handler", "from_height", "to_height").unionByName(failed)
    return range_gaps(tried, windows, HANDLER, width)


def coverage_report(
    ranges: DataFrame,
    failures: DataFrame,
    windows: DataFrame,
    genesis: int,
    tip: int,
    width: int = HEIGHT_BUCKET,
) -> DataFrame:
    """One row per handler: ranges, window and chain share, covered ends, gaps and failures.

    All of it but the retry counters comes from one sweep over stored ranges, failed heights,
    windows and the chain. Lists stay in :func:`merge_ranges`, :func:`coverage_gaps` and :func:`failure_ranges`; the
    report carries their counts, so no list of a handler is gathered in one place.
    ``open_failures`` leaves out failed heights that were covered later.
    """
    start, end = F.col("start_height"), F.col("end_height")
    lo, hi = F.lit(genesis).cast("bigint"), F.lit(tip).cast("bigint")
    height = F.col("height")
    layers = {
        "stored": ranges.select("handler", "from_height", "to_height"),
        "failed": failures.select("handler", height.alias("from_height"), height.alias("to_height")),
        "window": windows.select("handler", start.alias("from_height"), end.alias("to_height")),
        "chain": windows.select("handler", lo.alias("from_height"), hi.alias("to_height")),
    }
    now = {n: F.col(n) > 0 for n in layers}
    before = {n: F.col(f"{n}_before") > 0 for n in layers}
    length = F.col("next_at") - F.col("at")

    def untried(state: dict[str, Column]) -> Column:
        return state["window"] & ~state["stored"] & ~state["failed"]

    def heights(condition: Column) -> Column:
        return F.sum(F.when(condition, length))

    found = (
        sweep(layers, HANDLER, width)
        .groupBy("handler")
        .agg(
            F.count_if(now["stored"] & ~before["stored"]).alias("ranges"),
            F.min(F.when(now["stored"], F.col("at"))).alias("covered_start"),
            F.max(F.when(now["stored"], F.col("next_at") - 1)).alias("covered_end"),
            heights(now["stored"] & now["window"]).alias("_in_window"),
            heights(now["stored"] & now["chain"]).alias("_in_chain"),
            F.count_if(untried(now) & ~untried(before)).alias("gaps"),
            heights(untried(now)).alias("gap_heights"),
            F.count_if(now["failed"] & ~before["failed"]).alias("failed_ranges"),
            heights(now["failed"] & ~now["stored"]).alias("open_failures"),
        )
    )

    def percent(covered: str, a: Column, b: Column) -> Column:
        share = F.coalesce(F.col(covered), F.lit(0)) / (b - a + 1)
        return F.when(b >= a, share * 100).otherwise(F.lit(0.0)).cast("double")

    counts = ["retrying", "permanent", "max_retries"]
    return (
        windows.join(found, "handler", "left")
        .join(failure_counts(failures), "handler", "left")
        .select(
            "handler",
            "ranges",
            "covered_start",
            "covered_end",
            percent("_in_window", start, end).alias("window_pct"),
            percent("_in_chain", lo, hi).alias("chain_pct"),
            "gaps",
            "gap_heights",
            *counts,
            "failed_ranges",
            "open_failures",
        )
        .fillna(0, ["ranges", "gaps", "gap_heights", *counts, "failed_ranges", "open_failures"])
    )
