"""Ordered scans that never put one key into one task.

A window over ``partitionBy(key).orderBy(position)`` sorts all rows of a key in one task, which
fails when one key holds a third of the table. Here the position axis is cut into buckets: the
window runs inside ``(key, bucket)`` and each bucket additionally receives the aggregate of all
earlier (or later) buckets of its key. Only one row per non-empty bucket reaches the second
window, so its size is the length of the axis over the bucket width, not the number of rows.
Where many rows may share a short stretch of the axis, as in a log, :func:`even_bounds` cuts it further.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BUCKET = "_bucket"


def even_bounds(df: DataFrame, position: Column, depth: int = 1 << 16, most: int = 2048) -> list[int]:
    """Positions that cut the rows into parts of about ``depth`` rows, from a quantile sketch.

    At most ``most`` positions come to the driver, however many rows there are, and above
    ``depth * most`` rows the parts grow with them. The list is fixed before the plan is built, so
    every branch and every retried task cuts alike. Rows of one position are never cut.
    """
    shares = [i / most for i in range(1, most)]
    rows, cuts = df.agg(
        F.count(position), F.percentile_approx(position, shares, 10 * most)
    ).first()
    parts = min(most, -(-rows // depth))
    if parts < 2:
        return []
    return sorted({cuts[i * most // parts - 1] for i in range(1, parts)})


def with_bucket(df: DataFrame, position: Column, width: int, bounds: list[int] = ()) -> DataFrame:
    """Add the bucket number of a BIGINT position; buckets end at ``width`` and at every bound.

    Both the number of the stretch of ``width`` and the number of bounds up to a position never
    fall along the axis, so their sum names a bucket of both and keeps the order.
    """
    bucket = F.floor(position / F.lit(width)).cast("bigint")
    if bounds:
        ends = F.split(F.lit(",".join(map(str, bounds))), ",").cast("array<bigint>")
        halves = F.array(*[F.lit(1 << i) for i in reversed(range(len(bounds).bit_length()))])
        # binary search: steps of falling powers of two while the bound reached is not beyond
        passed = F.aggregate(
            halves,
            F.lit(0),
            lambda n, step: F.when(F.get(ends, n + step - 1) <= position, n + step).otherwise(n),
        )
        bucket = bucket + passed
    return df.withColumn(BUCKET, bucket)


def bucket_window(keys: list[str], order: list[Column | str]) -> Window:
    """Window inside one bucket of one key."""
    return Window.partitionBy(*keys, BUCKET).orderBy(*order)


def carry(
    df: DataFrame,
    keys: list[str],
    aggregates: dict[str, Column],
    combine: dict[str, Callable[[Column], Column]],
    backward: bool = False,
) -> DataFrame:
    """One row per (key, bucket) with the combined aggregate of all buckets before (after) it.

    ``aggregates`` are computed per bucket with map-side partial aggregation, ``combine`` folds
    them over the preceding buckets.
    """
    per_bucket = df.groupBy(*keys, BUCKET).agg(*[c.alias(n) for n, c in aggregates.items()])
    order = F.col(BUCKET).desc() if backward else F.col(BUCKET)
    w = Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    return per_bucket.select(*keys, BUCKET, *[f(F.col(n)).over(w).alias(n) for n, f in combine.items()])


def join_carry(df: DataFrame, carried: DataFrame, keys: list[str]) -> DataFrame:
    """Attach carried values; both sides hash on (key, bucket), as the bucket window does."""
    return df.join(carried, [*keys, BUCKET], "left")


def max_before(
    df: DataFrame, keys: list[str], position: str, value: str, out: str, width: int
) -> DataFrame:
    """Largest ``value`` over rows of the key at smaller positions; positions unique per key."""
    bucketed = with_bucket(df, F.col(position), width)
    carried = carry(bucketed, keys, {"_carry": F.max(value)}, {"_carry": F.max})
    local = F.max(value).over(
        bucket_window(keys, [position]).rowsBetween(Window.unboundedPreceding, -1)
    )
    # greatest skips NULLs, so it is NULL only for the very first row
    return (
        join_carry(bucketed, carried, keys)
        .withColumn(out, F.greatest(F.col("_carry"), local))
        .drop("_carry")
    )


def row_numbers(
    df: DataFrame, keys: list[str], position: Column, order: list[Column | str], out: str, width: int
) -> DataFrame:
    """``row_number`` per key; ``order`` must refine ``position``, which picks the bucket."""
    bucketed = with_bucket(df, position, width)
    carried = carry(bucketed, keys, {"_carry": F.count(F.lit(1))}, {"_carry": F.sum})
    local = F.row_number().over(bucket_window(keys, order))
    return (
        join_carry(bucketed, carried, keys)
        .withColumn(out, (F.coalesce(F.col("_carry"), F.lit(0)) + local).cast("bigint"))
        .drop("_carry", BUCKET)
    )


def running_sum(
    df: DataFrame,
    keys: list[str],
    position: Column,
    order: list[Column | str],
    value: str,
    out: str,
    width: int,
    bounds: list[int] = (),
) -> DataFrame:
    """Running total per key including the current row."""
    bucketed = with_bucket(df, position, width, bounds)
    carried = carry(bucketed, keys, {"_carry": F.sum(value)}, {"_carry": F.sum})
    local = F.sum(value).over(
        bucket_window(keys, order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return (
        join_carry(bucketed, carried, keys)
        .withColumn(out, F.coalesce(F.col("_carry"), F.lit(0)) + local)
        .drop("_carry", BUCKET)
    )
