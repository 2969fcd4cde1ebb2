"""Registry of runnable queries and their SQL counterparts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chainloom.session import configure

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None, digits: int = 6) -> Callable[[Query], Query]:
    """Register a query; its result is brought to plain column types."""

    def register(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} registered twice")

        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            configure(spark)
            return plain(fn(spark, sf_dir), digits)

        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def plain(df: DataFrame, digits: int = 6) -> DataFrame:
    """Whole numbers as BIGINT, fractions rounded to ``digits``, dates, times and bytes as text."""

    def cast(field: T.StructField):
        c, t = F.col(f"`{field.name}`"), field.dataType
        if isinstance(t, (T.ByteType, T.ShortType, T.IntegerType)):
            c = c.cast("bigint")
        elif isinstance(t, T.DecimalType) and t.scale == 0:
            c = c.cast("string")
        elif isinstance(t, (T.FloatType, T.DoubleType, T.DecimalType)):
            c = F.round(c.cast("double"), digits)
        elif isinstance(t, T.DateType):
            c = F.date_format(c, "yyyy-MM-dd")
        elif isinstance(t, (T.TimestampType, T.TimestampNTZType)):
            c = F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS")
        elif isinstance(t, T.BinaryType):
            c = F.hex(c)
        return c.alias(field.name)

    return df.select(*[cast(f) for f in df.schema.fields])
