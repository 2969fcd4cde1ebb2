"""Line dedup: a suffix array over line-ID sequences, by distributed prefix doubling.

Every line gets an id; round k ranks all blocks of 2**k lines by sorting the pairs of ranks of their
halves. A rank that several starts share is a longest-common-prefix interval of 2**k lines or more; only
those go into the next round, so the table shrinks to the repeated runs and the rounds end with the longest
of them. Any repeated run is the union of two blocks of one round, so the blocks that also start earlier
cover exactly the later copies of all maximal repeated runs.

A run counts when it has ``min_lines`` lines (a power of two) or is one line of ``min_chars`` characters. Later
copies are deleted, also within one document; the first copy of every line stays. Order: doc_id, then text.

Edge cases: null text has no lines and stays null; an empty text is one empty line; rows that repeat in doc_id and
text count as one document and get the same result; a null doc_id comes first. A text that loses all lines
becomes empty. Empty tables give no rows. ``n_lines`` and ``n_removed`` of the input are replaced.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window as W, functions as F

from chainloom.llm.common import stored

_PLACE = ("_doc", "_text", "_pos")
_NO_ID = -(2**63)


def _ranked(rows: DataFrame, keys: list[str], purpose: str) -> DataFrame:
    """Ranks, in sorted order, of the keys that several places share, with their first place."""
    shared = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"), F.min(F.struct(*_PLACE)).alias("_first")).where("_n > 1")
    # the id grows with the sort order; stored, because a second run could number otherwise
    return stored(shared.orderBy(*keys).withColumn("_rank", F.monotonically_increasing_id()), purpose)


def repeated_blocks(lines: DataFrame, purpose: str = "lines"):
    """Yields (number of lines, places) per round: rank and whether the block starts earlier too.

    ``lines``: _doc, _text, _pos (place), _a, _b (line id) and _long.
    """
    names = _ranked(lines, ["_a", "_b"], f"{purpose}-ids")
    level = (
        lines.join(names, ["_a", "_b"])
        .select(*_PLACE, "_long", "_rank", (F.struct(*_PLACE) != F.col("_first")).alias("_later"))
        .distinct()
    )
    size = 1
    while True:
        level = stored(level, f"{purpose}-{size}")
        if level.isEmpty():
            return
        yield size, level
        ahead = level.select("_doc", "_text", (F.col("_pos") - size).alias("_pos"), F.col("_rank").alias("_next"))
        pairs = level.join(ahead, list(_PLACE)).select(*_PLACE, "_long", F.col("_rank").alias("_half"), "_next")
        names = _ranked(pairs, ["_half", "_next"], f"{purpose}-names-{size}")
        level = pairs.join(names, ["_half", "_next"]).select(
            *_PLACE, "_long", "_rank", (F.struct(*_PLACE) != F.col("_first")).alias("_later")
        )
        size *= 2


def dedup_lines(docs: DataFrame, *, min_lines: int = 2, min_chars: int = 20) -> DataFrame:
    """The documents with later copies of repeated line runs deleted, ``n_lines`` and ``n_removed``."""
    docs = docs.drop("n_lines", "n_removed")
    place = {"_doc": F.coalesce("doc_id", F.lit(_NO_ID)), "_text": F.xxhash64("text")}
    lines = (
        docs.where("text is not null")
        .select(*[c.alias(n) for n, c in place.items()], F.posexplode(F.split("text", "\n")).alias("_pos", "_line"))
        .select(
            *_PLACE,
            F.xxhash64("_line").alias("_a"),
            F.xxhash64(F.lit(1), "_line").alias("_b"),
            (F.char_length("_line") >= min_chars).alias("_long"),
        )
    )
    spans, every = None, None
    for size, level in repeated_blocks(lines):
        if size == 1:
            every = level.select(*_PLACE, F.lit(0).alias("_len"))
            hits = level.where("_later and _long") if min_lines > 1 else level.where("_later")
        elif size < min_lines:
            continue
        else:
            hits = level.where("_later")
        hits = hits.select(*_PLACE, F.lit(size).alias("_len"))
        spans = hits if spans is None else spans.unionByName(hits)
    lines_of = F.split("text", "\n")
    counted = docs.withColumn("n_lines", F.when(F.col("text").isNull(), 0).otherwise(F.size(lines_of)).cast("bigint"))
    if spans is None:
        return counted.withColumn("n_removed", F.lit(0).cast("bigint"))
    # a removed line is itself a repeated line, so the places of round 0 are all that can be covered
    reach = W.partitionBy("_doc", "_text").orderBy("_pos").rowsBetween(W.unboundedPreceding, 0)
    gone = (
        spans.unionByName(every)
        .groupBy(*_PLACE)
        .agg(F.max("_len").alias("_len"))
        .withColumn("_end", F.max(F.col("_pos") + F.col("_len")).over(reach))
        .where("_end > _pos")
        .groupBy("_doc", "_text")
        .agg(F.collect_list("_pos").alias("_gone"))  # at most the lines of one document
    )
    kept = F.array_except(F.sequence(F.lit(0), F.size(lines_of) - 1), F.col("_gone"))
    text = F.array_join(F.transform(kept, lambda i: F.get(lines_of, i)), "\n")
    return (
        counted.withColumns(place)
        .join(gone, ["_doc", "_text"], "left")
        .withColumn("text", F.when(F.col("_gone").isNull(), F.col("text")).otherwise(text))
        .withColumn("n_removed", F.coalesce(F.size("_gone"), F.lit(0)).cast("bigint"))
        .withColumn("n_removed", F.greatest("n_removed", F.lit(0)))
        .select(*docs.columns, "n_lines", "n_removed")
    )
