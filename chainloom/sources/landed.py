"""Landed block files in height buckets, so a few heights read a few folders."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chainloom import schemas

BUCKET = "height_bucket"


class LandedBlocks:
    """A folder of landed blocks (of any shape with a ``height``), partitioned by height bucket."""

    def __init__(self, spark: SparkSession, path: str, width: int, schema: str = schemas.LANDED_BLOCKS):
        self.spark, self.path, self.width, self.schema = spark, path, width, schema

    def _bucket(self, height: str):
        return F.floor(F.col(height) / self.width).cast("bigint")

    def land(self, raw: DataFrame) -> None:
        """Add blocks; a bucket's rows meet in its folder, however many batches bring them."""
        placed = raw.withColumn(BUCKET, self._bucket("height"))
        placed.hint("rebalance", F.col(BUCKET)).write.mode("append").partitionBy(BUCKET).parquet(self.path)

    def read(self) -> DataFrame:
        return self.spark.read.schema(f"{self.schema}, {BUCKET} bigint").parquet(self.path)

    def at_heights(self, heights: DataFrame) -> DataFrame:
        """Blocks at the listed heights. The join is on the partition column too, so Spark can skip other buckets."""
        wanted = heights.select("height").distinct().withColumn(BUCKET, self._bucket("height"))
        return self.read().join(wanted, [BUCKET, "height"], "left_semi").drop(BUCKET)

    def in_ranges(self, ranges: DataFrame) -> DataFrame:
        """Blocks inside disjoint ranges ``from_height, to_height``.

        A range is repeated per bucket it touches and joined on the bucket, so the plan prunes folders by the buckets
        of the ranges when it runs.
        """
        touched = ranges.select("from_height", "to_height").withColumn(
            BUCKET, F.explode(F.sequence(self._bucket("from_height"), self._bucket("to_height")))
        )
        inside = F.col("height").between(F.col("from_height"), F.col("to_height"))
        return self.read().join(touched, BUCKET).where(inside).drop(BUCKET, "from_height", "to_height")
