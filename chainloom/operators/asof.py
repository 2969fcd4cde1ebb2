"""Nearest block to a calendar slot, without a sort of all headers and without pairs."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

HOUR_MICROS = 3_600_000_000
DAY_MICROS = 24 * HOUR_MICROS
#: Buckets of a group; a group's buckets are looked through in one task, and groups are few.
GROUP = 1024


def nearest_asof(slots: DataFrame, headers: DataFrame, low: int = 1, bucket_micros: int = HOUR_MICROS) -> DataFrame:
    """Block nearest in time to each ``slot``; ties go to the earlier block.

    ``slots`` is ``(slot timestamp)``, ``headers`` is ``(height, time)`` with time rising by
    height. A slot at or before the first block takes that block, one at or after the tip takes
    the tip. Adds ``block_height, block_time``.

    Time is cut into buckets. All headers are reduced to the first and last of their bucket by partial aggregation; only
    headers of buckets that hold a slot are ordered, inside their bucket, however many slots it has. What lies before and
    after a bucket is carried over to it inside groups of buckets, and between groups by one small row.
    """
    bucket = lambda c: F.floor(F.unix_micros(c) / F.lit(bucket_micros)).cast("bigint")
    group = F.floor(F.col("_bucket") / GROUP).alias("_group")
    block = F.struct("time", "height")
    wanted = slots.select("slot").distinct().withColumn("_bucket", bucket(F.col("slot")))
    blocks = headers.where(F.col("height") >= low).select("time", "height", bucket(F.col("time")).alias("_bucket"))
    ends = blocks.groupBy("_bucket").agg(F.min(block).alias("_first"), F.max(block).alias("_last"))

    # between buckets: the last block before and the first one after each bucket of a slot
    none = F.lit(None).cast("struct<time: timestamp, height: bigint>")
    edges = (
        ends.unionByName(wanted.select("_bucket", none.alias("_first"), none.alias("_last")))
        .groupBy("_bucket")
        .agg(F.min("_first").alias("_first"), F.max("_last").alias("_last"))
        .select("_bucket", group, "_first", "_last")
    )
    order = Window.partitionBy("_group").orderBy("_bucket")
    groups = edges.groupBy("_group").agg(F.min("_first").alias("first"), F.max("_last").alias("last"))
    # one row for the whole axis: as many entries as it has groups
    far = groups.agg(F.collect_list(F.struct(F.col("_group").alias("g"), "first", "last")).alias("_groups"))
    nearby = edges.select(
        "_bucket",
        "_group",
        F.max("_last").over(order.rowsBetween(Window.unboundedPreceding, -1)).alias("_before_b"),
        F.min("_first").over(order.rowsBetween(1, Window.unboundedFollowing)).alias("_after_b"),
    ).join(wanted.select("_bucket").distinct(), "_bucket", "left_semi")
    listed = F.col("_groups")
    carried = nearby.withColumn("_groups", far.scalar()).select(
        "_bucket",
        F.coalesce("_before_b", F.array_max(F.transform(F.filter(listed, lambda x: x["g"] < F.col("_group")), lambda x: x["last"]))).alias("_before_b"),
        F.coalesce("_after_b", F.array_min(F.transform(F.filter(listed, lambda x: x["g"] > F.col("_group")), lambda x: x["first"]))).alias("_after_b"),
        F.array_min(F.transform(listed, lambda x: x["first"])).alias("_lowest"),
    )

    # inside the buckets of slots: headers and slots in time order, a slot behind a header of its time
    meeting = blocks.join(wanted.select("_bucket").distinct(), "_bucket", "left_semi").select(
        "_bucket", "time", F.lit(None).cast("timestamp").alias("slot"), block.alias("_block")
    )
    rows = meeting.unionByName(wanted.select("_bucket", F.col("slot").alias("time"), "slot", none.alias("_block")))
    inside = Window.partitionBy("_bucket").orderBy("time", F.col("slot").asc_nulls_first())
    resolved = (
        rows.select(
            "_bucket",
            "slot",
            F.last("_block", ignorenulls=True).over(inside.rowsBetween(Window.unboundedPreceding, -1)).alias("_before"),
            F.first("_block", ignorenulls=True).over(inside.rowsBetween(1, Window.unboundedFollowing)).alias("_after"),
        )
        .where(F.col("slot").isNotNull())
        .join(carried, "_bucket")
        .select("slot", F.coalesce("_before", "_before_b").alias("_before"), F.coalesce("_after", "_after_b").alias("_after"), "_lowest")
    )
    micros = lambda c: F.unix_micros(c)
    to_before = micros(F.col("slot")) - micros(F.col("_before.time"))
    to_after = micros(F.col("_after.time")) - micros(F.col("slot"))
    pick = (
        F.when(F.col("slot") <= F.col("_lowest.time"), F.col("_lowest"))
        .when(F.col("_after").isNull(), F.col("_before"))
        .when(to_before <= to_after, F.col("_before"))
        .otherwise(F.col("_after"))
    )
    return (
        resolved.withColumn("_pick", pick)
        .where(F.col("_pick").isNotNull())
        .select(
            "slot",
            F.col("_pick.height").alias("block_height"),
            F.col("_pick.time").alias("block_time"),
        )
    )
