"""Backfill: the heights of a window that the stored coverage lacks, read from landed buckets and ingested."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chainloom.constants import HEIGHT_BUCKET
from chainloom.operators.intervals import chunk_ranges, prune_outside_window, split_ranges_at, union_gaps
from chainloom.plans.store import EventStore
from chainloom.session import cut
from chainloom.sources.landed import LandedBlocks


def backfill_plan(
    store: EventStore,
    start: int,
    end: int,
    batch_heights: int,
    horizons: DataFrame | None = None,
    width: int = HEIGHT_BUCKET,
) -> DataFrame:
    """Ranges at least one handler still needs: ``from_height, to_height, cell``.

    Heights that failed for good are left out. Ranges are cut at the horizons of the sources and into pieces of at most
    ``batch_heights``; ``cell`` is the piece's place on a grid of that width.
    """
    spark = store.spark
    windows = spark.createDataFrame([(s.name, start, end) for s in store.specs], "handler string, start_height bigint, end_height bigint")
    covered, failures = prune_outside_window(store.coverage(), store.ledger().where("permanent"), windows)
    hopeless = failures.select("handler", F.col("height").alias("from_height"), F.col("height").alias("to_height"))
    gaps = union_gaps(covered.select("handler", "from_height", "to_height").unionByName(hopeless), windows, width=width)
    if horizons is not None:
        gaps = split_ranges_at(gaps, horizons, by=[])
    pieces = chunk_ranges(gaps, batch_heights)
    return pieces.withColumn("cell", F.floor(F.col("from_height") / batch_heights).cast("bigint"))


def backfill_window(
    store: EventStore,
    landed: LandedBlocks,
    start: int,
    end: int,
    now: Column,
    batch_heights: int = 100_000,
    horizons: DataFrame | None = None,
    max_retries: int = 0,
    run_id: int | None = None,
    name: str = "backfill",
    width: int = HEIGHT_BUCKET,
) -> list[str]:
    """Ingest what ``[start, end]`` lacks; returns the ids of the batches.

    Neighbouring cells are put together until a batch has ``batch_heights`` heights, so scattered gaps don't make small
    batches. Only the buckets of a batch's ranges are read. Heights that have not landed stay gaps. A run that was cut
    short is simply started again: its plan starts from what is committed by then, and a batch id carries the number of
    the next commit, so an id is used again only for a batch that never was committed.
    """
    plan = cut(backfill_plan(store, start, end, batch_heights, horizons, width), "backfill")
    # one row per cell: as many as there are batches to run, at most
    sizes = plan.groupBy("cell").agg(F.sum(F.col("to_height") - F.col("from_height") + 1).alias("n")).orderBy("cell").collect()
    done, cells, total = [], [], 0
    for i, row in enumerate(sizes):
        cells.append(row["cell"])
        total += row["n"]
        if total < batch_heights and i + 1 < len(sizes):
            continue
        blocks = landed.in_ranges(plan.where(F.col("cell").between(cells[0], cells[-1])))
        if not blocks.isEmpty():
            number = (store.manifest().agg(F.max("seq")).first()[0] or 0) + 1
            batch_id = f"{name}-{number:09d}-{cells[0]}"
            store.ingest(blocks, batch_id, now, max_retries, run_id)
            done.append(batch_id)
        cells, total = [], 0
    return done
