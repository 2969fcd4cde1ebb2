"""Mixing sources to target weights by Pfair scheduling.

Each source is a stream of blocks of about equal size. With target units u out of Q, block j of a
source is released at floor(j Q / u) and due at ceil((j + 1) Q / u); the earliest deadline among the
released blocks goes first. So at every slot each source is less than one block from its share.

All blocks of a period of Q slots start and end without lag, so one period is computed and repeated:
a document finds its slot from its block number alone, in parallel. When a source can't fill another
period, that period stops at the slot where the first source runs dry; the others go on from there in a new
period, with their weights in proportion. So all targets hold up to the first source's end. No document is
dropped or repeated.

Edge cases: null or unlisted sources share the weight ``"*"``; without one, they get the smallest unit.
Null and empty texts have size 0 and stay. Ties and repeated rows are kept, in an order fixed by their
columns. No documents give no rows. Columns of the input named as the added ones are replaced.
"""

from __future__ import annotations

import heapq

from pyspark.sql import DataFrame, Window as W, functions as F

from chainloom.llm.common import stored

REST = "*"


def period(units: list[int]) -> list[int]:
    """The source of each of sum(units) slots: earliest deadline first among released blocks."""
    q = sum(units)
    waiting = [(0, -(-q // u), i, 0) for i, u in enumerate(units) if u]  # release, deadline, source, block
    heapq.heapify(waiting)
    ready: list[tuple[int, int, int]] = []
    out = []
    for slot in range(q):
        while waiting and waiting[0][0] <= slot:
            _, due, i, j = heapq.heappop(waiting)
            heapq.heappush(ready, (due, i, j))
        _, i, j = heapq.heappop(ready)
        out.append(i)
        j += 1
        if j < units[i]:
            heapq.heappush(waiting, (j * q // units[i], -(-(j + 1) * q // units[i]), i, j))
    return out


def whole_units(weights: dict[str, float], resolution: int) -> dict[str, int]:
    """Weights as whole units of about 1/resolution, one at least."""
    total = sum(weights.values())
    return {k: max(1, round(v / total * resolution)) for k, v in weights.items() if v > 0}


def timetable(blocks: dict[str, int], units: dict[str, int]) -> list[tuple]:
    """Rows (group, first_block, last_block, per_period, first_slot, period, offsets) for all blocks."""
    left = {g: n for g, n in blocks.items() if n > 0}
    done = dict.fromkeys(left, 0)
    slot, rows = 0, []

    def lay(names: list[str], order: list[int], times: int) -> None:
        nonlocal slot
        for i, g in enumerate(names):
            at = [t for t, s in enumerate(order) if s == i]
            if at:
                rows.append((g, done[g], done[g] + times * len(at) - 1, len(at), slot, len(order), at))
                done[g] += times * len(at)
                left[g] -= times * len(at)
        slot += times * len(order)

    while left:
        names = sorted(left)
        order = period([units[g] for g in names])
        times = min(left[g] // units[g] for g in names)
        if times:
            lay(names, order, times)
        if all(left.values()):
            # a source can't fill the next period: up to the last block of the first one that runs dry
            given = [0] * len(names)
            for t, i in enumerate(order, 1):
                given[i] += 1
                if given[i] == left[names[i]]:
                    break
            lay(names, order[:t], 1)
        left = {g: n for g, n in left.items() if n}
    return rows


def mix_sources(
    docs: DataFrame,
    weights: dict[str, float],
    *,
    block_size: int = 100_000,
    resolution: int = 1000,
    bucket_rows: int = 5_000,
    seed: int = 7,
    size: str = "char_length(text)",
    tie: str = "text",
) -> DataFrame:
    """The documents with ``mix_group, block, slot, seq``; (slot, seq) is the order of the mix.

    ``block_size`` is in units of ``size``; a document longer than a block takes the place of several.
    ``weights`` is a setting: the time table it leads to is bounded by it, not by the data. A source's
    documents are shuffled by a hash and numbered in buckets of about ``bucket_rows``, so a source may
    hold any share of the rows; bucket totals, a row per bucket, carry the sizes across.
    """
    units = whole_units(weights, resolution)
    units.setdefault(REST, 1)
    named = [g for g in units if g != REST]
    group = F.when(F.col("source").isin(named), F.col("source")).otherwise(F.lit(REST))
    marked = docs.drop("mix_group", "block", "slot", "seq").withColumns(
        {"mix_group": group, "_size": F.coalesce(F.expr(size), F.lit(0)).cast("bigint"), "_h": F.xxhash64(F.lit(seed), "doc_id")}
    )
    total = marked.count()
    n = max(1, -(-total // bucket_rows))
    marked = marked.withColumn("_bucket", F.pmod(F.shiftrightunsigned("_h", 33), F.lit(n)))
    sums = stored(marked.groupBy("mix_group", "_bucket").agg(F.sum("_size").alias("_sum")), "mix-sizes")
    before = W.partitionBy("mix_group").orderBy("_bucket").rowsBetween(W.unboundedPreceding, -1)
    carry = sums.select("mix_group", "_bucket", F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_carry"))
    sizes = {r[0]: r[1] for r in sums.groupBy("mix_group").agg(F.sum("_sum")).collect()}  # one row per weight
    blocks = {g: max(1, -(-s // block_size)) for g, s in sizes.items()}
    kind = (
        "mix_group string, first_block bigint, last_block bigint, per_period bigint, first_slot bigint, "
        "period bigint, offsets array<bigint>"
    )
    times = docs.sparkSession.createDataFrame(timetable(blocks, units), kind)
    inside = W.partitionBy("mix_group", "_bucket").orderBy("_h", "doc_id", *([tie] if tie else []))
    at = F.col("block") - F.col("first_block")
    return (
        marked.withColumn("_run", F.sum("_size").over(inside.rowsBetween(W.unboundedPreceding, -1)))
        .withColumn("_row", F.row_number().over(inside))
        .join(carry, ["mix_group", "_bucket"])
        .withColumn("_from", F.coalesce("_run", F.lit(0)) + F.col("_carry"))
        # an empty document behind the last block belongs to it
        .join(
            F.broadcast(docs.sparkSession.createDataFrame([(g, b - 1) for g, b in blocks.items()], "mix_group string, _last bigint")),
            "mix_group",
        )
        .withColumn("block", F.least(F.expr(f"_from div {block_size}"), "_last"))
        .join(F.broadcast(times), "mix_group")
        .where("block between first_block and last_block")
        .withColumn("slot", F.col("first_slot") + F.expr("((block - first_block) div per_period) * period") + F.get("offsets", (at % F.col("per_period")).cast("int")))
        .withColumn("seq", F.struct("_bucket", "_row"))
        .withColumn("seq", F.col("seq._bucket") * F.lit(2**32) + F.col("seq._row"))
        .drop(
            "_size", "_h", "_bucket", "_run", "_row", "_carry", "_from", "_last", "first_block", "last_block",
            "per_period", "first_slot", "period", "offsets",
        )
    )
