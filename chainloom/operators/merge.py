"""Keyed merges: first wins, insert-only, upsert, delete, reference checks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def first_per_key(df: DataFrame, key: list[str], order: list[Column | str]) -> DataFrame:
    """First row of each key in a total order.

    ``row_number() = 1`` lets Spark keep one row per key and task before the shuffle, so a key
    with many copies does not meet in one place.
    """
    w = Window.partitionBy(*key).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")


def insert_only_merge(
    stored: DataFrame, new: DataFrame, key: list[str], order: list[Column | str]
) -> DataFrame:
    """Rows of ``new`` to append: first per key, and none whose key is stored already."""
    return first_per_key(new, key, order).join(stored.select(*key), key, "left_anti")


def upsert(stored: DataFrame, new: DataFrame, key: list[str]) -> DataFrame:
    """Insert or replace by key; ``new`` has one row per key and wins."""
    kept = stored.join(new.select(*key), key, "left_anti")
    return kept.unionByName(new, allowMissingColumns=True)


def delete_keys(stored: DataFrame, keys: DataFrame, key: list[str]) -> DataFrame:
    """Rows whose key is not listed."""
    return stored.join(keys.select(*key), key, "left_anti")


def orphans(child: DataFrame, parent: DataFrame, on: list[tuple[str, str]]) -> DataFrame:
    """Rows of ``child`` whose reference is missing; NULL references are allowed."""
    present = F.lit(True)
    renamed = parent.select(*[F.col(p).alias(c) for c, p in on]).distinct()
    for c, _ in on:
        present = present & F.col(c).isNotNull()
    return child.where(present).join(renamed, [c for c, _ in on], "left_anti")


def cascade_delete(child: DataFrame, parent_after: DataFrame, on: list[tuple[str, str]]) -> DataFrame:
    """Rows of ``child`` whose parent still exists."""
    renamed = parent_after.select(*[F.col(p).alias(c) for c, p in on]).distinct()
    return child.join(renamed, [c for c, _ in on], "left_semi")


def key_violations(df: DataFrame, key: list[str]) -> DataFrame:
    """Keys stored more than once."""
    return df.groupBy(*key).agg(F.count(F.lit(1)).alias("copies")).where("copies > 1")
