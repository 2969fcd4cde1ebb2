"""Interval sets over heights: coverage, gaps, pieces.

A range is an inclusive ``[from_height, to_height]``; touching ranges (``next.from = last.to + 1``)
count as one. Operators take the key columns as ``by`` (the handler, or none for one common
set). Work is cut by (key, height bucket), so one handler may own most of the rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chainloom.constants import HEIGHT_BUCKET
from chainloom.operators.prefix import (
    BUCKET,
    bucket_window,
    carry,
    join_carry,
    max_before,
    row_numbers,
    running_sum,
)
from chainloom.operators.sweep import sweep

HANDLER = ["handler"]
_ALL = "_all"
# heights (or chunks) one exploded array may hold
_FAN = 1 << 14
# ranges of 2 to 2^4 heights share one bucket width in overlap joins
_SHORT = 4


def _keyed(df: DataFrame, by: list[str]) -> tuple[DataFrame, list[str]]:
    """An empty key list becomes one constant key."""
    return (df, list(by)) if by else (df.withColumn(_ALL, F.lit(0)), [_ALL])


def _one_row_per_start(ranges: DataFrame, keys: list[str]) -> DataFrame:
    # partial aggregation makes starts unique, which bounds a bucket by its width
    return ranges.groupBy(*keys, "from_height").agg(F.max("to_height").alias("to_height"))


def record_range(ranges: DataFrame, new: DataFrame, by: list[str] = HANDLER) -> DataFrame:
    """Append ranges; the same (key, from) keeps the larger end."""
    both = ranges.select(*by, "from_height", "to_height").unionByName(
        new.select(*by, "from_height", "to_height")
    )
    return _one_row_per_start(both, list(by))


def merge_ranges(
    ranges: DataFrame, by: list[str] = HANDLER, width: int = HEIGHT_BUCKET
) -> DataFrame:
    """Coalesce touching and overlapping ranges into the minimal set per key."""
    df, keys = _keyed(ranges, by)
    starts = _one_row_per_start(df, keys)
    seen = max_before(starts, keys, "from_height", "to_height", "_reach", width)
    opens = F.col("_reach").isNull() | (F.col("from_height") > F.col("_reach") + 1)
    # the island a row belongs to, as far as its own bucket can tell
    tagged = seen.withColumn("_open", F.when(opens, F.col("from_height"))).withColumn(
        "_island",
        F.max("_open").over(
            bucket_window(keys, ["from_height"]).rowsBetween(
                Window.unboundedPreceding, Window.currentRow
            )
        ),
    )
    pieces = tagged.groupBy(*keys, BUCKET, "_island").agg(F.max("to_height").alias("to_height"))
    # at most one piece per bucket continues an island opened in an earlier bucket
    carried = carry(
        pieces, keys, {"_carry": F.max("_island")}, {"_carry": F.max}
    )
    placed = join_carry(pieces, carried, keys).withColumn(
        "from_height", F.coalesce(F.col("_island"), F.col("_carry"))
    )
    return (
        placed.groupBy(*keys, "from_height")
        .agg(F.max("to_height").alias("to_height"))
        .select(*by, "from_height", "to_height")
    )


def compact_ranges(
    ranges: DataFrame, by: list[str] = HANDLER, width: int = HEIGHT_BUCKET
) -> tuple[DataFrame, DataFrame]:
    """Minimal ranges, and per key the stored rows before, after and saved."""
    merged = merge_ranges(ranges, by, width)
    before = ranges.groupBy(*by).agg(F.count(F.lit(1)).alias("rows_before"))
    after = merged.groupBy(*by).agg(F.count(F.lit(1)).alias("rows_after"))
    saved = before.join(after, list(by)).withColumn(
        "rows_saved", F.col("rows_before") - F.col("rows_after")
    )
    return merged, saved


def _gaps_between(clipped: DataFrame, wanted: DataFrame, keys: list[str], width: int) -> DataFrame:
    """Gaps before each covered start; ``wanted`` has ``start_height`` per key.

    It is joined again behind the window, so that both branches of ``max_before`` read the same shuffled starts.
    """
    first = wanted.groupBy(*keys).agg(F.first("start_height").alias("start_height"))
    reach = F.greatest(F.col("_reach"), F.col("start_height") - 1)
    return (
        max_before(_one_row_per_start(clipped, keys), keys, "from_height", "to_height", "_reach", width)
        .join(F.broadcast(first), keys)
        .where(F.col("from_height") > reach + 1)
        .select(*keys, (reach + 1).alias("gap_from"), (F.col("from_height") - 1).alias("gap_to"))
    )


def range_gaps(
    ranges: DataFrame, windows: DataFrame, by: list[str] = HANDLER, width: int = HEIGHT_BUCKET
) -> DataFrame:
    """``[start_height, end_height]`` of each key minus its ranges.

    ``windows`` has one row per key; a key without ranges is one gap, an empty window is none.
    """
    wanted, keys = _keyed(
        windows.where(F.col("end_height") >= F.col("start_height")).select(
            *by, "start_height", "end_height"
        ),
        by,
    )
    df, _ = _keyed(ranges.select(*by, "from_height", "to_height"), by)
    # one row per key: a shuffle by the key alone would put all ranges of a handler into one task
    clipped = df.join(F.broadcast(wanted), keys).where(
        (F.col("to_height") >= F.col("start_height"))
        & (F.col("from_height") <= F.col("end_height"))
    )
    inner = _gaps_between(clipped, wanted, keys, width)
    reach = clipped.groupBy(*keys).agg(F.max("to_height").alias("_reach"))
    tail = (
        wanted.join(reach, keys, "left")
        .withColumn("gap_from", F.coalesce(F.col("_reach") + 1, F.col("start_height")))
        .where(F.col("gap_from") <= F.col("end_height"))
        .select(*keys, "gap_from", F.col("end_height").alias("gap_to"))
    )
    return inner.unionByName(tail).select(
        *by, F.col("gap_from").alias("from_height"), F.col("gap_to").alias("to_height")
    )


def union_gaps(
    ranges: DataFrame, windows: DataFrame, by: list[str] = HANDLER, width: int = HEIGHT_BUCKET
) -> DataFrame:
    """Heights at least one key still needs, as minimal ranges."""
    return merge_ranges(range_gaps(ranges, windows, by, width), [], width)


def _level(lo: str, hi: str) -> Column:
    """n of the buckets of 2^n heights of a range, which touches at most two of them.

    2^n is the length of the range or the next power of two; lengths of 2 to 2^_SHORT share one width, so that short
    ranges need no copy for each length of the other side.
    """
    n = F.ceil(F.log2(F.col(hi) - F.col(lo) + 1)).cast("int")
    return F.when(n > 0, F.greatest(n, F.lit(_SHORT))).otherwise(n)


def _spread(df: DataFrame, lo: str, hi: str, first: str) -> DataFrame:
    """One row per bucket of width 2^level that a range touches; ``first`` is its first bucket."""
    at = lambda c: F.expr(f"shiftright({c}, _level)")
    return df.withColumn(first, at(lo)).withColumn(BUCKET, F.explode(F.sequence(at(lo), at(hi))))


def range_overlap_join(
    left: DataFrame, right: DataFrame, by: list[str] = HANDLER, salts: int = 1
) -> DataFrame:
    """Pairs of overlapping non-empty ranges of one key, as equi joins on height buckets.

    The right range arrives as ``r_from, r_to`` next to the other right columns. A pair meets in
    buckets as wide as its longer range (the next power of two, 16 heights for short ones), so the
    candidates stay within a small factor of the result whatever mix of lengths there is. A pair
    sharing two buckets is kept in the first one. ``salts`` > 1 splits the larger side's rows of
    every bucket and repeats those of the smaller side; without it AQE still splits skewed buckets.
    """
    r = right.withColumnsRenamed({"from_height": "r_from", "to_height": "r_to"})
    clash = [c for c in r.columns if c in left.columns and c not in by]
    if clash:
        raise ValueError(f"columns on both sides: {clash}")
    a = left.where("to_height >= from_height").withColumn("_own", _level("from_height", "to_height"))
    b = r.where("r_to >= r_from").withColumn("_r_own", _level("r_from", "r_to"))
    # at most 63 levels exist on a side
    a_levels = a.agg(F.collect_set("_own")).scalar()
    b_levels = b.agg(F.collect_set("_r_own")).scalar()

    def meet(x: DataFrame, y: DataFrame) -> DataFrame:
        on = [*by, "_level", BUCKET]
        if salts > 1:
            left_smaller = a.agg(F.count(F.lit(1))).scalar() <= b.agg(F.count(F.lit(1))).scalar()
            all_salts = F.expr(f"sequence(0L, {salts - 1}L)")
            own_salt = lambda lo, hi: F.array(F.pmod(F.xxhash64(lo, hi), F.lit(salts)))
            x = x.withColumn("_salt", F.explode(F.when(left_smaller, all_salts).otherwise(own_salt("from_height", "to_height"))))
            y = y.withColumn("_salt", F.explode(F.when(left_smaller, own_salt("r_from", "r_to")).otherwise(all_salts)))
            on.append("_salt")
        return (
            x.join(y, on)
            .where(
                (F.col("from_height") <= F.col("r_to"))
                & (F.col("to_height") >= F.col("r_from"))
                & (F.col(BUCKET) == F.greatest("_first", "_r_first"))
            )
            .drop(BUCKET, "_level", "_first", "_r_first", "_salt", "_own", "_r_own")
        )

    # the right range is the longer one, or both have one width; right ranges are shuffled once
    left_up = _spread(
        a.withColumn("_level", F.explode(b_levels)).where("_level >= _own"),
        "from_height", "to_height", "_first",
    )
    right_own = _spread(b.withColumn("_level", F.col("_r_own")), "r_from", "r_to", "_r_first")
    # the left range is the longer one
    left_own = _spread(
        a.withColumn("_level", F.col("_own")).where(F.col("_level") > F.array_min(b_levels)),
        "from_height", "to_height", "_first",
    )
    right_up = _spread(
        b.withColumn("_level", F.explode(a_levels)).where("_level > _r_own"),
        "r_from", "r_to", "_r_first",
    )
    return meet(left_up, right_own).unionByName(meet(left_own, right_up))


def needs_range(
    ranges: DataFrame, requests: DataFrame, by: list[str] = HANDLER, width: int = HEIGHT_BUCKET
) -> DataFrame:
    """Is each requested ``[from, to]`` not fully covered? An empty request needs nothing.

    ``requests`` are distinct (key, from, to) rows.
    """
    df, keys = _keyed(requests.select(*by, "from_height", "to_height"), by)
    have, _ = _keyed(ranges.select(*by, "from_height", "to_height"), by)
    # every first height gets the first height from there on that no range covers
    asked = df.where("to_height >= from_height").select(*keys, F.col("from_height").alias("at"))
    swept = sweep({"ranges": have}, keys, width, asked, "ranges").select(
        *keys, F.col("at").alias("from_height"), "ranges_until"
    )
    empty = F.col("to_height") < F.col("from_height")
    return df.join(swept, [*keys, "from_height"], "left").select(
        *by,
        "from_height",
        "to_height",
        (~empty & (F.col("ranges_until") <= F.col("to_height"))).alias("needs"),
    )


def split_ranges_at(
    ranges: DataFrame, horizons: DataFrame, by: list[str] = HANDLER
) -> DataFrame:
    """Cut ranges at every source horizon strictly inside them.

    ``horizons`` has ``earliest_height`` and ``disabled``; disabled sources and horizons at or
    below 1 cut nothing. One range receives at most one piece per distinct horizon.
    """
    cuts = (
        horizons.where(~F.col("disabled") & (F.col("earliest_height") > 1))
        .select(F.col("earliest_height").alias("from_height"))
        .distinct()
        .withColumn("to_height", F.col("from_height"))
    )
    inside = range_overlap_join(ranges, cuts, []).where(
        F.col("r_from") > F.col("from_height")
    )
    keys = [*by, "from_height", "to_height"]
    points = ranges.select(*keys, F.col("from_height").alias("_piece")).unionByName(
        inside.select(*keys, F.col("r_from").alias("_piece"))
    )
    following = F.lead("_piece").over(Window.partitionBy(*keys).orderBy("_piece"))
    return points.withColumn("_end", F.coalesce(following - 1, F.col("to_height"))).select(
        *by, F.col("_piece").alias("from_height"), F.col("_end").alias("to_height")
    )


def chunk_ranges(ranges: DataFrame, size: int) -> DataFrame:
    """Cut ranges bottom-up into batches of at most ``size`` heights.

    Two explodes keep arrays short even for a range of a billion heights, and the shuffle in
    between spreads one huge range over the cluster.
    """
    coarse = ranges.withColumn(
        "_block", F.explode(F.sequence("from_height", "to_height", F.lit(size * _FAN).cast("bigint")))
    ).repartition("_block")
    stop = F.least(F.col("_block") + size * _FAN - 1, F.col("to_height"))
    fine = coarse.withColumn(
        "_lo", F.explode(F.sequence(F.col("_block"), stop, F.lit(size).cast("bigint")))
    )
    return fine.withColumns(
        {"to_height": F.least(F.col("_lo") + size - 1, F.col("to_height")), "from_height": F.col("_lo")}
    ).drop("_lo", "_block")


def expand_ranges(ranges: DataFrame) -> DataFrame:
    """One row per height of each range."""
    return chunk_ranges(ranges, 1).withColumnRenamed("from_height", "height").drop("to_height")


def subtract_points(
    ranges: DataFrame, points: DataFrame, by: list[str] = HANDLER, width: int = HEIGHT_BUCKET
) -> DataFrame:
    """Ranges minus single heights, range by range.

    Distinct points are numbered per key. The numbers at a range's two ends name the gaps between
    points that it touches, so its pieces come from an equi join on the gap's number.
    """
    whole, keys = _keyed(ranges.where("to_height >= from_height").select(*by, "from_height", "to_height"), by)
    single, _ = _keyed(points.select(*by, F.col("height").alias("at")), by)
    whole = whole.distinct()
    ends = whole.select("*", F.explode(F.array("from_height", "to_height")).alias("at"))
    is_point = lambda n: F.lit(n).cast("bigint").alias("_point")
    positions = (
        single.select(*keys, "at", is_point(1))
        .unionByName(ends.select(*keys, "at", is_point(0)))
        .groupBy(*keys, "at")
        .agg(F.max("_point").alias("_point"))
    )
    ranked = running_sum(positions, keys, F.col("at"), ["at"], "_point", "_rank", width)
    # gap n lies between point n and point n + 1; the outermost ones have one end
    none = F.lit(None).cast("bigint")
    sides = F.array(
        F.struct(F.col("_rank").alias("_gap"), (F.col("at") + 1).alias("_lo"), none.alias("_hi")),
        F.struct((F.col("_rank") - 1).alias("_gap"), none.alias("_lo"), (F.col("at") - 1).alias("_hi")),
    )
    gaps = (
        ranked.where("_point = 1")
        .select(*keys, F.inline(sides))
        .groupBy(*keys, "_gap")
        .agg(F.max("_lo").alias("_lo"), F.max("_hi").alias("_hi"))
    )
    touched = (
        ends.join(ranked.drop("_point"), [*keys, "at"])
        .groupBy(*keys, F.col("from_height").alias("_start"), F.col("to_height").alias("_end"))
        .agg(F.min("_rank").alias("from_height"), F.max("_rank").alias("to_height"))
    )
    return (
        expand_ranges(touched)
        .withColumnRenamed("height", "_gap")
        .join(gaps, [*keys, "_gap"], "left")
        # greatest and least skip the missing end
        .select(*by, F.greatest("_start", "_lo").alias("from_height"), F.least("_end", "_hi").alias("to_height"))
        .where("from_height <= to_height")
    )


def coverage_ratio(
    ranges: DataFrame, windows: DataFrame, by: list[str] = HANDLER, width: int = HEIGHT_BUCKET
) -> DataFrame:
    """Share of each key's window that its ranges cover; an empty window is 0.

    Ranges are merged first, so overlaps do not count twice.
    """
    lo = F.greatest("from_height", "start_height")
    hi = F.least("to_height", "end_height")
    covered = (
        merge_ranges(ranges, by, width)
        .join(F.broadcast(windows), list(by))
        .groupBy(*by)
        .agg(F.sum(F.greatest(hi - lo + 1, F.lit(0).cast("bigint"))).alias("covered"))
    )
    length = F.col("end_height") - F.col("start_height") + 1
    share = F.when(length > 0, F.coalesce(F.col("covered"), F.lit(0)) / length).otherwise(F.lit(0.0))
    return windows.join(covered, list(by), "left").select(
        *by, "start_height", "end_height", share.cast("double").alias("ratio")
    )


def points_to_islands(
    points: DataFrame, by: list[str] = HANDLER, width: int = HEIGHT_BUCKET
) -> DataFrame:
    """Consecutive heights as ranges: ``height - row_number`` is constant inside an island."""
    df, keys = _keyed(points.select(*by, "height").distinct(), by)
    numbered = row_numbers(df, keys, F.col("height"), ["height"], "_rn", width)
    return (
        numbered.groupBy(*keys, (F.col("height") - F.col("_rn")).alias("_island"))
        .agg(F.min("height").alias("from_height"), F.max("height").alias("to_height"))
        .select(*by, "from_height", "to_height")
    )


def ranges_by_handler(ranges: DataFrame, handler: str | None = None) -> DataFrame:
    """Stored ranges of all handlers or one, in order."""
    df = ranges if handler is None else ranges.where(F.col("handler") == handler)
    return df.orderBy("handler", "from_height")


def prune_outside_window(
    ranges: DataFrame, failures: DataFrame, windows: DataFrame, by: list[str] = HANDLER
) -> tuple[DataFrame, DataFrame]:
    """Drop ranges wholly outside each key's window (straddlers stay whole) and outside failures.

    Keys without a window are kept as they are.
    """
    outside_range = (F.col("to_height") < F.col("start_height")) | (
        F.col("from_height") > F.col("end_height")
    )
    outside_point = ~F.col("height").between(F.col("start_height"), F.col("end_height"))
    keep = lambda df, outside: (
        df.join(F.broadcast(windows.select(*by, "start_height", "end_height")), list(by), "left")
        .where(F.col("start_height").isNull() | ~outside)
        .drop("start_height", "end_height")
    )
    return keep(ranges, outside_range), keep(failures, outside_point)
