"""Rollup, dictionary and read-side queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from chainloom.catalog import standins as s
from chainloom.catalog.registry import query, table
from chainloom.functions.times import format_ddmmyyyy, utc_date
from chainloom.operators import dictionary as d
from chainloom.operators import reads, rollup

_USABLE = "qos_sync > 0 AND qos_avail > 0 AND qos_latency > 0 AND cu > 0"
_EX_USABLE = "ex_qos_sync > 0 AND ex_qos_avail > 0 AND ex_qos_latency > 0 AND cu > 0"


def _daily_sql(where: str = "TRUE", digits: int | None = 6, fact: str = "fact") -> str:
    num = lambda e: f"round({e}, {digits})" if digits is not None else e
    parts = ["CAST(sum(cu) AS BIGINT) AS cu", "CAST(sum(relay_number) AS BIGINT) AS relays"]
    for p, usable in (("qos", _USABLE), ("ex_qos", _EX_USABLE)):
        for m in ("sync", "avail", "latency"):
            parts.append(f"{num(f'sum({p}_{m} * relay_number)')} AS {p}_{m}_w")
            parts.append(f"{num(f'sum(CASE WHEN {usable} THEN {p}_{m} END)')} AS {p}_{m}_sum")
        parts.append(f"CAST(sum(CASE WHEN {p}_sync IS NOT NULL THEN relay_number ELSE 0 END) AS BIGINT) AS {p}_weight")
        parts.append(f"count(CASE WHEN {usable} THEN 1 END) AS {p}_count")
    parts.append(f"CAST(sum(CASE WHEN {_USABLE} THEN cu ELSE 0 END) AS BIGINT) AS qos_cu")
    return f"""SELECT CAST(CAST(timestamp AS DATE) AS VARCHAR) AS date, chain AS chain_id, provider, {', '.join(parts)}
FROM {fact} WHERE timestamp IS NOT NULL AND {where} GROUP BY 1, 2, 3"""


DAILY_SQL = f"WITH {s.FACTS_SQL} {_daily_sql()}"
_DAILY_CTE = f"WITH {s.FACTS_SQL}, daily AS ({_daily_sql(digits=None)})"


def _avg_sql(by: str, weighted: bool) -> str:
    cols = []
    for p in ("qos", "ex_qos"):
        sfx, base = ("w", f"{p}_weight") if weighted else ("sum", f"{p}_count")
        cols += [
            f"round(sum({p}_{m}_{sfx}) / nullif(CAST(sum({base}) AS DOUBLE), 0), 9) AS {p}_{m}_avg"
            for m in ("sync", "avail", "latency")
        ]
    return f"{_DAILY_CTE} SELECT {by}, {', '.join(cols)} FROM daily GROUP BY {by}"


@query("relay_daily", DAILY_SQL)
def relay_daily(spark, sf):
    return rollup.relay_daily(*s.star(spark, sf))


# averages of two-digit values can end in an exact 5 at the seventh digit
@query("qos_weighted_avg", _avg_sql("chain_id", True), digits=9)
def qos_weighted_avg(spark, sf):
    return rollup.qos_averages(rollup.relay_daily(*s.star(spark, sf)), ["chain_id"], True)


@query("qos_unweighted_avg", _avg_sql("provider", False), digits=9)
def qos_unweighted_avg(spark, sf):
    return rollup.qos_averages(rollup.relay_daily(*s.star(spark, sf)), ["provider"], False)


@query("rollup_increment", DAILY_SQL)
def rollup_increment(spark, sf):
    """A stored rollup of the low heights plus the delta of the high ones."""
    facts, providers, chains = s.star(spark, sf)
    half = facts.agg((F.max("block_height") / 2).cast("bigint")).scalar()
    low = rollup.relay_daily(facts.where(F.col("block_height") <= half), providers, chains)
    high = rollup.relay_daily(facts.where(F.col("block_height") > half), providers, chains)
    return rollup.add_rollups(low, high)


@query(
    "connection_aggregates",
    f"""{_DAILY_CTE} SELECT CAST(sum(cu) AS BIGINT) AS sum_cu, CAST(sum(relays) AS BIGINT) AS sum_relays,
       max(date) AS max_date, count(DISTINCT provider) AS distinct_count_provider
FROM daily WHERE date >= '2024-01-10' AND chain_id IN ('view', 'click')""",
)
def connection_aggregates(spark, sf):
    daily = rollup.relay_daily(*s.star(spark, sf)).withColumn("date", F.col("date").cast("string"))
    rows = reads.filter_connection(
        daily, {"date": {"greater_than_or_equal_to": "2024-01-10"}, "chain_id": {"in": ["view", "click"]}}
    )
    return reads.connection_aggregates(
        rows, {"sum": ["cu", "relays"], "max": ["date"], "distinct_count": ["provider"]}
    )


@query(
    "grouped_aggregates",
    f"""{_DAILY_CTE} SELECT chain_id, CAST(sum(cu) AS BIGINT) AS sum_cu, CAST(sum(relays) AS BIGINT) AS sum_relays,
       round(avg(qos_sync_w), 6) AS average_qos_sync_w
FROM daily GROUP BY chain_id""",
)
def grouped_aggregates(spark, sf):
    daily = rollup.relay_daily(*s.star(spark, sf))
    return reads.grouped_aggregates(daily, ["chain_id"], {"sum": ["cu", "relays"], "average": ["qos_sync_w"]})


@query(
    "filter_connection",
    f"""WITH {s.FACTS_SQL} SELECT block_height, provider, chain, cu, round(qos_sync, 6) AS qos_sync FROM fact
WHERE (cu >= 100 AND cu < 200 AND chain <> 'error') AND (qos_sync IS NULL OR provider LIKE 'u1%')
  AND NOT (relay_number IN (1, 2, 3))""",
)
def filter_connection(spark, sf):
    rows = reads.filter_connection(
        s.relay_facts(spark, sf),
        {
            "cu": {"greater_than_or_equal_to": 100, "less_than": 200},
            "chain": {"not_equal_to": "error"},
            "or": [{"qos_sync": {"is_null": True}}, {"provider": {"starts_with": "u1"}}],
            "not": {"relay_number": {"in": [1, 2, 3]}},
        },
    )
    return rows.select("block_height", "provider", "chain", "cu", "qos_sync")


@query(
    "page_connection",
    f"""{_DAILY_CTE} SELECT date, chain_id, provider, cu FROM daily
ORDER BY cu DESC, date, chain_id, provider LIMIT 25 OFFSET 10""",
)
def page_connection(spark, sf):
    daily = rollup.relay_daily(*s.star(spark, sf)).select("date", "chain_id", "provider", "cu")
    order = [("cu", "desc"), ("date", "asc"), ("chain_id", "asc"), ("provider", "asc")]
    return reads.page_connection(daily, order, first=25, offset=10)


@query("not_null_ts_filter", f"WITH {s.FACTS_SQL} SELECT count(*) AS rows FROM fact WHERE timestamp IS NOT NULL")
def not_null_ts_filter(spark, sf):
    return s.relay_facts(spark, sf).where(F.col("timestamp").isNotNull()).agg(F.count(F.lit(1)).alias("rows"))


@query(
    "fact_dim_join",
    f"WITH {s.FACTS_SQL} SELECT block_height, provider, chain, cu FROM fact",
)
def fact_dim_join(spark, sf):
    return rollup.fact_dim_join(*s.star(spark, sf)).select("block_height", "provider", "chain", "cu")


@query(
    "utc_date",
    """SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS day, strftime(ts, '%d-%m-%Y') AS text, count(*) AS n
FROM events GROUP BY 1, 2""",
)
def utc_day(spark, sf):
    e = s.events(spark, sf)
    return e.groupBy(utc_date(F.col("ts")).alias("day"), format_ddmmyyyy(F.col("ts")).alias("text")).agg(
        F.count(F.lit(1)).alias("n")
    )


# --- dictionaries -----------------------------------------------------------------------------

_DICT_SQL = """
known AS (SELECT CAST(s_suppkey + 1 AS BIGINT) AS id, s_name AS value FROM supplier WHERE s_suppkey * 2 < (SELECT count(*) FROM supplier)),
fresh AS (
  SELECT DISTINCT s_name AS value FROM lineitem JOIN supplier ON l_suppkey = s_suppkey
  WHERE s_name NOT IN (SELECT value FROM known)
),
dict AS (
  SELECT id, value FROM known
  UNION ALL
  SELECT (SELECT max(id) FROM known) + row_number() OVER (ORDER BY md5(value), value), value FROM fresh
)"""


def _dictionary(spark, sf):
    """The lower half of the suppliers is known; the supplier names of all lines are encoded."""
    supplier = table(spark, sf, "supplier")
    count = supplier.agg(F.count(F.lit(1))).scalar()
    known = supplier.where(F.col("s_suppkey") * 2 < count).select(
        (F.col("s_suppkey") + 1).cast("int").alias("id"), F.col("s_name").alias("value")
    )
    used = table(spark, sf, "lineitem").select("l_suppkey").distinct()
    names = used.join(supplier, F.col("l_suppkey") == F.col("s_suppkey")).select("s_name")
    return names, d.dict_encode(names, known, "s_name")


@query("dict_encode", f"WITH {_DICT_SQL} SELECT CAST(id AS BIGINT) AS id, value FROM dict")
def dict_encode(spark, sf):
    return _dictionary(spark, sf)[1]


@query(
    "dict_lookup",
    f"""WITH {_DICT_SQL} SELECT CAST(id AS BIGINT) AS supplier_id, count(*) AS n, round(sum(l_quantity), 6) AS quantity
FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN dict ON value = s_name GROUP BY id""",
)
def dict_lookup(spark, sf):
    _, dictionary = _dictionary(spark, sf)
    supplier = table(spark, sf, "supplier").select(F.col("s_suppkey").alias("l_suppkey"), "s_name")
    lines = table(spark, sf, "lineitem").groupBy("l_suppkey").agg(
        F.count(F.lit(1)).alias("n"), F.sum("l_quantity").alias("quantity")
    )
    coded = d.dict_lookup(lines.join(supplier, "l_suppkey"), dictionary, "s_name", "supplier_id")
    return coded.select("supplier_id", "n", "quantity")


@query(
    "dict_decode",
    f"WITH {s.FACTS_SQL} SELECT provider, count(*) AS n FROM fact GROUP BY provider",
)
def dict_decode(spark, sf):
    facts, providers, _ = s.star(spark, sf)
    counts = facts.groupBy("provider_id").agg(F.count(F.lit(1)).alias("n"))
    return d.dict_decode(counts, providers, "provider_id", "provider")


@query("dict_snapshot", f"WITH {_DICT_SQL} SELECT CAST(id AS BIGINT) AS id, value FROM dict ORDER BY id")
def dict_snapshot(spark, sf):
    return d.dict_snapshot(_dictionary(spark, sf)[1])


@query(
    "distinct_union_of_values",
    """SELECT DISTINCT value FROM (
  SELECT s_name AS value FROM supplier UNION SELECT n_name FROM nation UNION SELECT p_brand FROM part)""",
)
def distinct_union_of_values(spark, sf):
    one = lambda t, c: table(spark, sf, t).select(F.col(c).alias("value"))
    return one("supplier", "s_name").unionByName(one("nation", "n_name")).unionByName(one("part", "p_brand")).distinct()
