"""The reference tables of every operator, derived from the given tables.

Each Spark function here has an SQL text next to it that derives the same rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chainloom import schemas
from chainloom.catalog.registry import table
from chainloom.constants import RELAY_EVENT_TYPE
from chainloom.operators.dictionary import dict_encode, dict_lookup
from chainloom.plans.ingest import FACT_COLUMNS
from chainloom.session import shared_dir

# Height buckets of a few thousand make the small test tables span several of them.
WIDTH = 4096
# a landed file holds about this many blocks, of 2 KB of text each
BLOCKS_PER_FILE = 100_000


def events(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "events").select(
        "event_id",
        F.col("ts").cast("timestamp").alias("ts"),
        "user_id",
        "event_type",
        "value",
        F.regexp_extract("props", "[0-9]+", 0).cast("int").alias("k"),
    )


EVENTS_SQL = """
ev AS (
  SELECT event_id, ts, user_id, event_type, value,
         CAST(regexp_extract(props, '[0-9]+') AS INTEGER) AS k
  FROM events
)"""


def relay_facts(spark: SparkSession, sf: str) -> DataFrame:
    """Text-keyed facts, one per event; some have no timestamp and some no QoS value."""
    k = F.col("k")
    part = lambda a, b: a.cast("double") / F.lit(float(b))
    return events(spark, sf).select(
        F.col("event_id").alias("block_height"),
        F.sha2(F.col("event_id").cast("string"), 256).alias("tx_hash"),
        F.lit(0).alias("event_idx"),
        (k % 4).alias("record_idx"),
        F.when(k != 97, F.col("ts")).alias("timestamp"),
        F.concat(F.lit("u"), F.col("user_id").cast("string")).alias("provider"),
        F.col("event_type").alias("chain"),
        F.floor("value").cast("bigint").alias("cu"),
        k.alias("relay_number"),
        F.when(k % 7 != 0, part(k, 99)).alias("qos_avail"),
        part(k % 5, 4).alias("qos_latency"),
        F.when(k % 10 != 0, part(k, 100)).alias("qos_sync"),
        part(k, 120).alias("ex_qos_avail"),
        F.when(k % 9 != 0, F.lit(0.5)).alias("ex_qos_latency"),
        F.when(k % 6 != 0, part(99 - k, 100)).alias("ex_qos_sync"),
    )


FACTS_SQL = (
    EVENTS_SQL
    + """,
fact AS (
  SELECT event_id AS block_height, sha256(CAST(event_id AS VARCHAR)) AS tx_hash,
         k % 4 AS record_idx, CASE WHEN k <> 97 THEN ts END AS timestamp,
         'u' || user_id AS provider, event_type AS chain,
         CAST(floor(value) AS BIGINT) AS cu, k AS relay_number,
         CASE WHEN k % 7 <> 0 THEN k / CAST(99 AS DOUBLE) END AS qos_avail,
         (k % 5) / CAST(4 AS DOUBLE) AS qos_latency,
         CASE WHEN k % 10 <> 0 THEN k / CAST(100 AS DOUBLE) END AS qos_sync,
         k / CAST(120 AS DOUBLE) AS ex_qos_avail,
         CASE WHEN k % 9 <> 0 THEN CAST(0.5 AS DOUBLE) END AS ex_qos_latency,
         CASE WHEN k % 6 <> 0 THEN (99 - k) / CAST(100 AS DOUBLE) END AS ex_qos_sync
  FROM ev
)"""
)


def empty_dictionary(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], schemas.DICTIONARY)


def star(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Id-keyed facts and the provider and chain dictionaries."""
    facts = relay_facts(spark, sf)
    providers = dict_encode(facts, empty_dictionary(spark), "provider")
    chains = dict_encode(facts, empty_dictionary(spark), "chain")
    coded = dict_lookup(dict_lookup(facts, providers, "provider", "provider_id"), chains, "chain", "chain_id")
    return coded.select(*FACT_COLUMNS), providers, chains


# --- heights ----------------------------------------------------------------------------------


def ranges(spark: SparkSession, sf: str) -> DataFrame:
    """Overlapping, unordered height ranges of 42 handlers."""
    handler = F.concat_ws("-", "l_returnflag", "l_linestatus", F.col("l_linenumber").cast("string"))
    return table(spark, sf, "lineitem").select(
        handler.alias("handler"),
        F.col("l_orderkey").alias("from_height"),
        (F.col("l_orderkey") + F.col("l_linenumber")).alias("to_height"),
    )


RANGES_SQL = """
rng AS (
  SELECT l_returnflag || '-' || l_linestatus || '-' || l_linenumber AS handler,
         l_orderkey AS f, l_orderkey + l_linenumber AS t
  FROM lineitem
), win AS (SELECT CAST(0 AS BIGINT) AS lo, max(o_orderkey) AS hi FROM orders)"""


def windows(spark: SparkSession, sf: str) -> DataFrame:
    """``[0, highest order key]`` per handler."""
    top = table(spark, sf, "orders").agg(F.max("o_orderkey")).scalar()
    return (
        ranges(spark, sf)
        .select("handler")
        .distinct()
        .select("handler", F.lit(0).cast("bigint").alias("start_height"), top.alias("end_height"))
    )


def failed_points(spark: SparkSession, sf: str) -> DataFrame:
    """Failed heights per handler, a little beyond its ranges."""
    handler = F.concat_ws("-", "l_returnflag", "l_linestatus", F.col("l_linenumber").cast("string"))
    return (
        table(spark, sf, "lineitem")
        .where("l_quantity < 10")
        .select(handler.alias("handler"), (F.col("l_orderkey") + 10 + F.col("l_linenumber")).alias("height"))
        .distinct()
    )


POINTS_SQL = """
pts AS (
  SELECT DISTINCT l_returnflag || '-' || l_linestatus || '-' || l_linenumber AS handler,
         l_orderkey + 10 + l_linenumber AS height
  FROM lineitem WHERE l_quantity < 10
)"""


def merged_sql(source: str) -> str:
    """Merged ranges of a CTE ``(handler, f, t)``.

    Starts are made unique first: equal rows could be ordered differently by the two windows.
    """
    return f"""
  SELECT handler, min(f) AS f, max(t) AS t
  FROM (SELECT *, sum(opens) OVER (PARTITION BY handler ORDER BY f, t ROWS UNBOUNDED PRECEDING) AS g
        FROM (SELECT *, CASE WHEN f <= 1 + max(t) OVER (PARTITION BY handler ORDER BY f, t
                                  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
                             THEN 0 ELSE 1 END AS opens
              FROM (SELECT handler, f, max(t) AS t FROM {source} GROUP BY handler, f)))
  GROUP BY handler, g"""


def gaps_sql(source: str) -> str:
    """Gaps of a CTE ``(handler, f, t)`` in the window of CTE ``win``."""
    return f"""
  SELECT handler, gf AS f, gt AS t FROM (
    SELECT handler,
           greatest(coalesce(max(t) OVER (PARTITION BY handler ORDER BY f, t
                             ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), lo - 1), lo - 1) + 1 AS gf,
           f - 1 AS gt
    FROM {source}, win WHERE t >= lo AND f <= hi
    UNION ALL
    SELECT handler, max(t) + 1, max(hi) FROM {source}, win WHERE t >= lo AND f <= hi GROUP BY handler
  ) WHERE gf <= gt"""


# --- landed blocks ----------------------------------------------------------------------------


def _attr(name: str, n: Column, value: Column) -> Column:
    return F.struct(
        F.concat(F.lit(f"{name}."), n.cast("string")).alias("key"), value.alias("value")
    )


def _relay_event() -> Column:
    """One relay event: record k % 4, and a second record without CU for every third k."""
    k, n = F.col("k"), F.col("k") % 4
    text = lambda c: c.cast("string")
    frac = lambda a, b: F.concat(text(a), F.lit(f"/{b}"))
    blank = F.lit("")
    main = [
        _attr("provider", n, F.concat(F.lit("u"), text(F.col("user_id")))),
        _attr("chainID", n, F.col("event_type")),
        _attr("CU", n, text(F.floor("value").cast("bigint"))),
        _attr("relayNumber", n, text(k)),
        _attr("QoSSync", n, F.when(k % 10 == 0, blank).otherwise(frac(k, 100))),
        _attr("QoSAvailability", n, F.when(k % 7 == 0, frac(k, 0)).otherwise(frac(k, 99))),
        _attr("QoSLatency", n, frac(k % 5, 4)),
        _attr("ExcellenceQoSSync", n, F.when(k % 6 == 0, F.lit(" 0.5 ")).otherwise(frac(99 - k, 100))),
        _attr("ExcellenceQoSAvailability", n, frac(k, 120)),
        _attr("ExcellenceQoSLatency", n, F.when(k % 9 == 0, F.lit("1.5d")).otherwise(F.lit("0.5"))),
    ]
    second = [
        _attr("provider", n + 4, F.lit("nobody")),
        _attr("chainID", n + 4, F.col("event_type")),
    ]
    attributes = F.when(k % 3 == 0, F.array(*main, *second)).otherwise(F.array(*main))
    return F.struct(F.lit(RELAY_EVENT_TYPE).alias("type"), attributes.alias("attributes"))


def _plain_event(kind: str) -> Column:
    """An event with a repeated key: the last value counts."""
    twice = F.array(
        F.struct(F.lit("note").alias("key"), F.lit("first").alias("value")),
        F.struct(F.lit("note").alias("key"), F.col("k").cast("string").alias("value")),
    )
    return F.struct(F.lit(kind).alias("type"), twice.alias("attributes"))


_LANDED: dict[tuple[str, str], str] = {}


def landed_blocks(spark: SparkSession, sf: str) -> DataFrame:
    """The blocks below as landed files, written once per application and table folder."""
    key = (spark.sparkContext.applicationId, sf)
    if key not in _LANDED:
        path = shared_dir(spark, "landed")
        build_blocks(spark, sf, files=landed_files(spark, sf)).write.parquet(path)
        _LANDED[key] = path
    return spark.read.schema(schemas.LANDED_BLOCKS).parquet(_LANDED[key])


def landed_files(spark: SparkSession, sf: str) -> int:
    """Landed files grow in number, not in size."""
    return max(2 * spark.sparkContext.defaultParallelism, -(-table(spark, sf, "events").count() // BLOCKS_PER_FILE))


def landed_folder(spark: SparkSession, sf: str) -> tuple[str, int]:
    """Folder of the landed files and how many there are."""
    files = len(landed_blocks(spark, sf).inputFiles())
    return _LANDED[(spark.sparkContext.applicationId, sf)], files


def build_blocks(spark: SparkSession, sf: str, broken: bool = True, files: int | None = None, also: tuple[str, ...] = ()) -> DataFrame:
    """One landed block per event: height is the event id.

    Per block: a begin event, a relay and a transfer event in transaction 0, a message in
    transaction 1, which has no raw bytes for every fifth k, and an end event. k = 13 has bad
    base64, k = 17 bad JSON, unless ``broken`` is off. Events are dealt out to ``files`` before their texts are
    made, which are many times as large. ``also`` names further event columns to keep.
    """
    k = F.col("k")
    bad = lambda n: (k == n) & F.lit(broken)
    raw = lambda p: F.base64(F.concat(F.lit(p), F.col("event_id").cast("string")).cast("binary"))
    txs = F.when(bad(13), F.array(F.lit("***"))).when(k % 5 == 0, F.array(raw("tx-"))).otherwise(
        F.array(raw("tx-"), raw("tx2-"))
    )
    time = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")
    block = F.struct(
        F.struct(
            F.struct(F.col("event_id").cast("string").alias("height"), time.alias("time")).alias("header"),
            F.struct(txs.alias("txs")).alias("data"),
        ).alias("block")
    )
    results = F.struct(
        F.array(
            F.struct(F.array(_relay_event(), _plain_event("transfer")).alias("events")),
            F.struct(F.array(_plain_event("message")).alias("events")),
        ).alias("txs_results"),
        F.array(_plain_event("begin")).alias("begin_block_events"),
        F.array(_plain_event("end")).alias("end_block_events"),
    )
    body = F.to_json(results)
    rows = events(spark, sf)
    return (rows.repartition(files, "event_id") if files else rows).select(
        F.col("event_id").alias("height"),
        F.to_json(block).alias("block_json"),
        F.when(bad(17), F.concat(F.lit("{bad"), body)).otherwise(body).alias("results_json"),
        *also,
    )


# rows of the facts that landed_blocks carries
LANDED_FACTS_SQL = (
    EVENTS_SQL
    + """,
landed AS (
  SELECT event_id AS block_height, upper(sha256('tx-' || event_id)) AS tx_hash,
         CAST(1 AS BIGINT) AS event_idx, CAST(k % 4 AS BIGINT) AS record_idx, ts,
         'u' || user_id AS provider, event_type AS chain,
         CAST(floor(value) AS BIGINT) AS cu, CAST(k AS BIGINT) AS relay_number,
         CASE WHEN k % 7 <> 0 THEN CAST(CAST(k / CAST(99 AS DOUBLE) AS REAL) AS DOUBLE) END AS qos_avail,
         CAST(CAST((k % 5) / CAST(4 AS DOUBLE) AS REAL) AS DOUBLE) AS qos_latency,
         CASE WHEN k % 10 <> 0 THEN CAST(CAST(k / CAST(100 AS DOUBLE) AS REAL) AS DOUBLE) END AS qos_sync,
         CAST(CAST(k / CAST(120 AS DOUBLE) AS REAL) AS DOUBLE) AS ex_qos_avail,
         CASE WHEN k % 9 <> 0 THEN CAST(0.5 AS DOUBLE) END AS ex_qos_latency,
         CASE WHEN k % 6 <> 0 THEN CAST(CAST((99 - k) / CAST(100 AS DOUBLE) AS REAL) AS DOUBLE) END AS ex_qos_sync
  FROM ev WHERE k NOT IN (13, 17)
)"""
)
