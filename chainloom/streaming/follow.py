"""Tip following: landed files to facts, coverage, rollup and dead letters, exactly once.

Heights may land in any order at any time; nothing here drops late rows, so no watermark is set.
The checkpoint decides the batches; the id that Spark keeps in the checkpoint and the batch number name the
partition a batch owns, and the manifest row makes it visible. So a replayed batch leaves the same state, and a
fresh checkpoint, which may cut the files otherwise, never writes over batches of an earlier one.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from chainloom import schemas
from chainloom.plans.store import EventStore

_LANDED = {"rpc": schemas.LANDED_BLOCKS, "rest": schemas.LANDED_REST, "replies": schemas.BATCH_REPLIES}


def follow_tip(
    spark: SparkSession,
    landing: str,
    store: EventStore,
    checkpoint: str,
    fmt: str = "parquet",
    max_files: int = 64,
    max_retries: int = 0,
    available_now: bool = True,
    interval: str = "10 seconds",
    name: str = "follow",
    shape: str = "rpc",
    run_id: int | None = None,
) -> StreamingQuery:
    """Ingest landed block files as they appear; ``shape`` says how blocks landed, ``run_id`` names the run they count for.

    ``available_now`` takes everything present and stops (a bounded run); otherwise the query
    keeps polling. Batch ids carry ``name`` and the checkpoint's id, so no two streams collide.
    """
    stream = (
        spark.readStream.format(fmt)
        .schema(_LANDED[shape])
        .option("maxFilesPerTrigger", max_files)
        .load(landing)
    )

    def checkpoint_id() -> str:
        # Spark writes it before the first batch
        return json.loads(spark.read.text(f"{checkpoint}/metadata").first()[0])["id"]

    def persist(batch: DataFrame, batch_id: int) -> None:
        store.ingest(batch, f"{name}-{checkpoint_id()}-{batch_id:012d}", F.current_timestamp(), max_retries, run_id, shape)

    writer = stream.writeStream.foreachBatch(persist).option("checkpointLocation", checkpoint)
    trigger = {"availableNow": True} if available_now else {"processingTime": interval}
    return writer.trigger(**trigger).queryName(name).start()


#: Source of rows that only move the watermark on. A filter on it would be pushed below the watermark, so there is none:
#: the windows of the last such row just never come out.
END_OF_LOG = "_end"


def request_rate(log: DataFrame, window: str = "60 seconds", slide: str = "3 seconds", delay: str = "2 minutes") -> DataFrame:
    """Requests per second of a live log over sliding windows, for append mode.

    The only operator with a watermark: a metric may be final, data may not. A window is given once, when the watermark
    has passed its end, and its state goes; rows later than ``delay`` are dropped, and :func:`late_rows` counts them. The
    windows of a log that has ended come out after a row of source ``END_OF_LOG`` behind its last ones.
    """
    seconds = F.lit(int(window.split()[0])).cast("double")
    return (
        log.withWatermark("at", delay)
        .groupBy(F.window("at", window, slide), "source")
        .agg(F.count(F.lit(1)).alias("requests"))
        .select(
            F.col("window.start").alias("window_start"),
            F.col("window.end").alias("window_end"),
            "source",
            "requests",
            (F.col("requests") / seconds).alias("rps"),
        )
    )


def late_rows(query: StreamingQuery) -> int:
    """Rows that came too late for their windows, over the recent progress of a query; a row counts per window."""
    return sum(int(op["numRowsDroppedByWatermark"]) for p in query.recentProgress for op in p["stateOperators"])


def state_rows(query: StreamingQuery) -> list[int]:
    """Rows of state after each batch."""
    return [sum(int(op["numRowsTotal"]) for op in p["stateOperators"]) for p in query.recentProgress]
