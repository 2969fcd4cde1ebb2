"""One sweep over the ends of labelled ranges: the depth of every layer on every stretch.

Ranges, single heights and windows of a key go in as layers. Each end is a step of its layer;
steps of one position are summed first, so a bucket holds no more rows than it has positions.
The running sum of the steps is the number of a layer's ranges that cover the stretch from one
position to the next. Difference, union and shares of the layers are then conditions on one
row, where a merge, a gap search and an overlap join per question would shuffle each time.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from chainloom.operators.prefix import BUCKET, bucket_window, join_carry, with_bucket


def _steps(layers: dict[str, DataFrame], keys: list[str], marks: DataFrame | None) -> DataFrame:
    """Summed steps per key and position; marks are positions without a step."""
    zero = F.lit(0).cast("bigint")

    def row(df: DataFrame, layer: str | None) -> DataFrame:
        step = lambda n: F.col("_step") if n == layer else zero
        return df.select(*keys, "at", *[step(n).alias(n) for n in layers])

    parts = []
    for name, df in layers.items():
        ends = F.array(
            F.struct(F.col("from_height").alias("at"), F.lit(1).cast("bigint").alias("_step")),
            F.struct((F.col("to_height") + 1).alias("at"), F.lit(-1).cast("bigint").alias("_step")),
        )
        ranges = df.where("to_height >= from_height").select(*keys, F.inline(ends))
        parts.append(row(ranges, name))
    if marks is not None:
        parts.append(row(marks, None))
    every = parts[0]
    for p in parts[1:]:
        every = every.unionByName(p)
    return every.groupBy(*keys, "at").agg(*[F.sum(n).alias(n) for n in layers])


def sweep(
    layers: dict[str, DataFrame],
    keys: list[str],
    width: int,
    marks: DataFrame | None = None,
    until: str | None = None,
) -> DataFrame:
    """Stretches ``[at, next_at)`` per key with the depth of every layer on them.

    ``layers`` are frames of ``keys, from_height, to_height`` (inclusive; empty ranges are
    nothing). A layer's column holds its depth, ``<layer>_before`` the depth just before ``at``.
    ``marks`` (``keys, at``) cut stretches without changing a depth. ``until`` names a layer whose
    column ``<layer>_until`` gets the first position from ``at`` on that it does not cover.
    The last stretch of a key is open (``next_at`` NULL) and all its depths are 0.

    What a bucket does not know comes from one row per non-empty bucket: the depths before it and
    the next bucket's first position. A layer's depth is 0 only where the depth inside the bucket
    is at its lowest, so the first such position is all that a bucket has to tell for ``until``.
    """
    bucketed = with_bucket(_steps(layers, keys, marks), F.col("at"), width)
    here = bucket_window(keys, ["at"])
    so_far = here.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local = bucketed.select(
        "*",
        F.lead("at").over(here).alias("_next"),
        *[F.sum(n).over(so_far).alias(f"_in_{n}") for n in layers],
    )
    facts = [F.min("at").alias("_first"), *[F.sum(n).alias(n) for n in layers]]
    if until:
        lowest = F.struct(F.col(f"_in_{until}").alias("depth"), F.col("at"))
        facts.append(F.min(lowest).alias("_low"))
    per_bucket = (local if until else bucketed).groupBy(*keys, BUCKET).agg(*facts)

    order = Window.partitionBy(*keys).orderBy(BUCKET)
    earlier = order.rowsBetween(Window.unboundedPreceding, -1)
    carried = per_bucket.select(
        "*",
        F.lead("_first").over(order).alias("_after"),
        *[F.coalesce(F.sum(n).over(earlier), F.lit(0)).alias(f"_carry_{n}") for n in layers],
    )
    if until:
        open_at = F.when(F.col("_low.depth") + F.col(f"_carry_{until}") == 0, F.col("_low.at"))
        later = order.rowsBetween(1, Window.unboundedFollowing)
        carried = carried.withColumn("_open", open_at).withColumn("_open_later", F.min("_open").over(later))
    carried = carried.drop("_first", "_low", "_open", *layers)

    depth = {n: F.col(f"_carry_{n}") + F.col(f"_in_{n}") for n in layers}
    out = join_carry(local, carried, keys)
    columns = [
        F.coalesce("_next", "_after").alias("next_at"),
        *[depth[n].alias(n) for n in layers],
        *[(depth[n] - F.col(n)).alias(f"{n}_before") for n in layers],
    ]
    if until:
        rest = here.rowsBetween(Window.currentRow, Window.unboundedFollowing)
        nearest = F.min(F.when(depth[until] == 0, F.col("at"))).over(rest)
        columns.append(F.coalesce(nearest, F.col("_open_later")).alias(f"{until}_until"))
    return out.select(*keys, "at", *columns)
