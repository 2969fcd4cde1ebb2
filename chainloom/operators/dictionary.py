"""Dictionary encoding: text values to dense integer ids."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chainloom.operators.prefix import row_numbers

# new values are numbered in the order of their MD5, whose first 12 bits cut them into even
# buckets whatever prefix the values share
_SLICES = 1 << 12


def _slice(value: Column) -> Column:
    return F.conv(F.substring(F.md5(value.cast("binary")), 1, 3), 16, 10).cast("bigint")


def dict_encode(values: DataFrame, known: DataFrame, column: str = "value") -> DataFrame:
    """Extended dictionary: known ids stay, unseen values get the next ids.

    ``values`` holds one text column (repeats and NULLs allowed), ``known`` is ``(id, value)``.
    Only the new distinct values are numbered, never the facts.
    """
    fresh = (
        values.select(F.col(column).alias("value"))
        .where(F.col("value").isNotNull())
        .distinct()
        .join(known.select("value"), "value", "left_anti")
    )
    numbered = row_numbers(
        fresh, [], _slice(F.col("value")), [F.md5(F.col("value").cast("binary")), "value"], "_rn", 1
    )
    top = known.agg(F.coalesce(F.max("id"), F.lit(0))).scalar()
    added = numbered.select((F.col("_rn") + top).cast("int").alias("id"), "value")
    return known.select(F.col("id").cast("int").alias("id"), "value").unionByName(added)


def dict_lookup(facts: DataFrame, dictionary: DataFrame, text: str, out: str) -> DataFrame:
    """Replace a text column by its id. The join strategy is left to run-time sizes."""
    ids = dictionary.select(F.col("id").alias(out), F.col("value").alias(text))
    return facts.join(ids, text).drop(text)


def dict_decode(facts: DataFrame, dictionary: DataFrame, id_column: str, out: str) -> DataFrame:
    """Replace an id column by its text; unknown ids drop out as in an inner join."""
    texts = dictionary.select(F.col("id").alias(id_column), F.col("value").alias(out))
    return facts.join(texts, id_column).drop(id_column)


def dict_snapshot(dictionary: DataFrame) -> DataFrame:
    """All ``(id, value)`` pairs in id order."""
    return dictionary.select("id", "value").orderBy("id")
