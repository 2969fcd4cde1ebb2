"""Snapshot, reward, price and supply queries."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from chainloom import schemas
from chainloom.catalog import standins as s
from chainloom.catalog.registry import query, table
from chainloom.functions.times import expected_slots as slots_of
from chainloom.operators import asof
from chainloom.operators import snapshots as sn
from chainloom.plans import prices as price_plan
from chainloom.plans.rewards import rewards_snapshot as rewards_plan
from chainloom.plans.snapshots import RewardsSnapshotter, SupplySnapshotter, run_snapshots
from chainloom.session import shared_dir
from chainloom.sinks.tables import VersionedTable, refresh_view
from chainloom.sources import responses as rs
from chainloom.sources.blocks import block_headers as headers_of

_FMT = "'%Y-%m-%d %H:%M:%S.%f'"

# --- slots ------------------------------------------------------------------------------------


def _slots(spark, sf):
    """Monthly slots from the 31st of the first month at 15:00, after a floor of ninety days."""
    first = F.trunc(F.min(F.col("o_orderdate").cast("timestamp")), "MM").cast("timestamp")
    genesis = first + F.expr("INTERVAL '30 15' DAY TO HOUR")
    chains = (
        table(spark, sf, "orders")
        .agg(genesis.alias("genesis"), F.max(F.col("o_orderdate").cast("timestamp")).alias("now"))
        .withColumn("earliest", F.col("genesis") + F.expr("INTERVAL 90 DAYS"))
    )
    return slots_of(chains).select("slot", "slot_date")


_SLOTS_SQL = """
g AS (SELECT date_trunc('month', min(o_orderdate)) AS first, max(o_orderdate) AS now FROM orders),
c AS (SELECT first + to_months(CAST(n AS INTEGER)) + INTERVAL 30 DAYS + INTERVAL 15 HOURS AS slot, now, first
      FROM g, generate_series(1, 2000) AS s(n)),
slots AS (SELECT slot, CAST(CAST(slot AS DATE) AS VARCHAR) AS slot_date FROM c
          WHERE slot <= now AND slot >= first + INTERVAL 120 DAYS + INTERVAL 15 HOURS)"""


@query("expected_slots", f"WITH {_SLOTS_SQL} SELECT strftime(slot, {_FMT}) AS slot, slot_date FROM slots")
def expected_slots(spark, sf):
    return _slots(spark, sf)


def _order_snapshots(spark, sf):
    """Days with an urgent order are covered, days of low priority only failed, others partial."""
    urgent = F.bool_or(F.col("o_orderpriority") == "1-URGENT")
    low = F.bool_and(F.col("o_orderpriority") == "5-LOW")
    return table(spark, sf, "orders").groupBy(F.to_date("o_orderdate").alias("snapshot_date")).agg(
        F.when(urgent, "ok").when(low, "failed").otherwise("partial").alias("status"),
        F.max("o_orderkey").alias("block_height"),
        F.when(low, F.lit("low only")).alias("error"),
    )


_SNAPS_SQL = """
snaps AS (SELECT CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS slot_date,
  CASE WHEN bool_or(o_orderpriority = '1-URGENT') THEN 'ok' WHEN bool_and(o_orderpriority = '5-LOW') THEN 'failed' ELSE 'partial' END AS status,
  max(o_orderkey) AS block_height, CASE WHEN bool_and(o_orderpriority = '5-LOW') THEN 'low only' END AS error
  FROM orders GROUP BY 1)"""


@query(
    "slots_due",
    f"""WITH {_SLOTS_SQL}, {_SNAPS_SQL} SELECT slot_date, strftime(slot, {_FMT}) AS slot FROM slots
WHERE slot_date NOT IN (SELECT slot_date FROM snaps WHERE status IN ('ok', 'failed'))""",
)
def slots_due(spark, sf):
    return sn.slots_due(_slots(spark, sf), _order_snapshots(spark, sf))


@query(
    "date_difference",
    f"""WITH {_SLOTS_SQL}, {_SNAPS_SQL} SELECT slot_date FROM slots EXCEPT SELECT slot_date FROM snaps WHERE status = 'ok'""",
)
def date_difference(spark, sf):
    done = _order_snapshots(spark, sf).where("status = 'ok'").select(F.col("snapshot_date").alias("slot_date"))
    return _slots(spark, sf).select("slot_date").subtract(done)


@query(
    "snapshot_status",
    f"""WITH {_SLOTS_SQL}, {_SNAPS_SQL}
SELECT slot_date, CASE WHEN status IS NULL THEN 'missing' WHEN status = 'ok' THEN 'covered' ELSE 'failed' END AS state,
  CASE WHEN status = 'failed' THEN coalesce(error, '') WHEN status IS NOT NULL AND status <> 'ok' THEN 'status=' || status || ' ' || coalesce(error, '') END AS error,
  block_height FROM slots LEFT JOIN snaps USING (slot_date)""",
)
def snapshot_status(spark, sf):
    return sn.snapshot_status(_slots(spark, sf), _order_snapshots(spark, sf))


@query(
    "nearest_asof",
    f"""WITH b AS (SELECT min(ts) AS lo, max(ts) AS hi FROM events),
slots AS (SELECT unnest(generate_series(lo - INTERVAL 1 DAY, hi + INTERVAL 1 DAY, INTERVAL 7 HOUR)) AS slot FROM b),
h AS (SELECT event_id AS height, ts FROM events WHERE event_id >= 1),
n AS (SELECT slot, max(ts) FILTER (WHERE ts <= slot) AS tb, arg_max(height, ts) FILTER (WHERE ts <= slot) AS hb,
             min(ts) FILTER (WHERE ts > slot) AS ta, arg_min(height, ts) FILTER (WHERE ts > slot) AS ha
      FROM slots, h GROUP BY slot)
SELECT strftime(slot, {_FMT}) AS slot,
  CASE WHEN tb IS NULL THEN ha WHEN ta IS NULL THEN hb WHEN epoch_us(slot) - epoch_us(tb) <= epoch_us(ta) - epoch_us(slot) THEN hb ELSE ha END AS block_height,
  strftime(CASE WHEN tb IS NULL THEN ta WHEN ta IS NULL THEN tb WHEN epoch_us(slot) - epoch_us(tb) <= epoch_us(ta) - epoch_us(slot) THEN tb ELSE ta END, {_FMT}) AS block_time
FROM n""",
)
def nearest_asof(spark, sf):
    e = s.events(spark, sf)
    day = F.expr("INTERVAL 1 DAY")
    slots = e.agg(F.min("ts").alias("lo"), F.max("ts").alias("hi")).select(
        F.explode(F.sequence(F.col("lo") - day, F.col("hi") + day, F.expr("INTERVAL 7 HOURS"))).alias("slot")
    )
    return asof.nearest_asof(slots, e.select(F.col("event_id").alias("height"), F.col("ts").alias("time")))


@query("block_headers", f"SELECT event_id AS height, strftime(ts, {_FMT}) AS time FROM events")
def block_headers(spark, sf):
    return headers_of(s.landed_blocks(spark, sf))


# --- rewards ----------------------------------------------------------------------------------


def _lines(spark, sf):
    """Lines with supplier, nation and brand; the ship month is the snapshot height."""
    brand = F.regexp_extract("p_brand", "[0-9]+", 0).cast("int")
    ship = F.col("l_shipdate")
    return (
        table(spark, sf, "lineitem")
        .join(table(spark, sf, "supplier"), F.col("l_suppkey") == F.col("s_suppkey"))
        .join(table(spark, sf, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
        .join(table(spark, sf, "part"), F.col("l_partkey") == F.col("p_partkey"))
        .select(
            (F.year(ship) * 12 + F.month(ship)).cast("bigint").alias("m"),
            "l_suppkey", "s_name", "s_nationkey", "n_name", "p_brand", brand.alias("b"),
            F.col("l_linenumber").alias("ln"),
            F.col("l_quantity").cast("int").alias("q"),
            F.round(F.col("l_extendedprice") * 100).cast("bigint").alias("cents"),
            (F.col("l_orderkey") * 10000000000 + F.col("l_partkey") * 10 + F.col("l_linenumber")).alias("pos"),
        )
    )


_LINES_SQL = """
ln0 AS (SELECT CAST(year(l_shipdate) * 12 + month(l_shipdate) AS BIGINT) AS m, l_suppkey, s_name, s_nationkey, n_name, p_brand,
  CAST(regexp_extract(p_brand, '[0-9]+') AS INTEGER) AS b, l_linenumber AS ln, CAST(l_quantity AS INTEGER) AS q,
  CAST(round(l_extendedprice * 100) AS BIGINT) AS cents, l_orderkey * 10000000000 + l_partkey * 10 + l_linenumber AS pos
  FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey JOIN part ON l_partkey = p_partkey),
meta AS (SELECT DISTINCT b, 'brand-' || b AS base_denom, CASE WHEN b % 2 = 0 THEN 1000000 ELSE 100000000 END AS factor,
  CASE WHEN b % 5 <> 4 THEN 'coin-' || b END AS cgid, b = 11 AS suppress
  FROM (SELECT CAST(regexp_extract(p_brand, '[0-9]+') AS INTEGER) AS b FROM part) WHERE b % 7 <> 6)"""


def _month_date(m):
    return F.make_date(F.floor((m - 1) / 12).cast("int"), ((m - 1) % 12 + 1).cast("int"), F.lit(17))


_MONTH_SQL = "CAST(make_date(CAST((m - 1) // 12 AS INTEGER), CAST((m - 1) % 12 + 1 AS INTEGER), 17) AS VARCHAR)"


def _denoms(spark, sf):
    brand = F.regexp_extract("p_brand", "[0-9]+", 0).cast("int")
    return table(spark, sf, "part").select(brand.alias("id"), F.col("p_brand").alias("value")).distinct()


def _metadata(spark, sf):
    b = F.col("id")
    return _denoms(spark, sf).where(b % 7 != 6).select(
        b.alias("denom_id"),
        F.concat(F.lit("brand-"), b.cast("string")).alias("base_denom"),
        F.when(b % 2 == 0, 1000000).otherwise(100000000).cast("decimal(38,0)").alias("factor"),
        F.when(b % 5 != 4, F.concat(F.lit("coin-"), b.cast("string"))).alias("coingecko_id"),
        (b == 11).alias("suppress"),
    )


def _source_denom(b, brand):
    return F.when(b % 3 == 0, F.concat(F.lit("ibc/H"), b.cast("string"))).otherwise(brand)


def _rewards(spark, sf):
    return _lines(spark, sf).select(
        F.col("m").alias("block_height"),
        F.col("l_suppkey").cast("int").alias("provider_id"),
        F.col("s_nationkey").cast("int").alias("spec_id"),
        (F.col("ln") % 4).cast("smallint").alias("source_kind"),
        F.col("b").alias("denom_id"),
        _source_denom(F.col("b"), F.col("p_brand")).alias("source_denom"),
        (F.col("cents") * 10000).cast("decimal(38,0)").alias("amount"),
    )


def _targets(spark, sf):
    """One target per ship month."""
    ship = F.col("l_shipdate")
    months = table(spark, sf, "lineitem").select((F.year(ship) * 12 + F.month(ship)).cast("bigint").alias("m")).distinct()
    date = _month_date(F.col("m"))
    slot = date.cast("timestamp") + F.expr("INTERVAL 15 HOURS")
    return months.select(
        F.col("m").alias("block_height"), date.alias("snapshot_date"), slot.alias("block_time"), slot.alias("slot")
    )


def _snapshots(spark, sf):
    return _targets(spark, sf).withColumn("status", F.when(F.col("block_height") % 6 == 5, "failed").otherwise("ok"))


def _prices(spark, sf):
    m, b = F.col("m"), F.col("b")
    return _lines(spark, sf).select("m", "b").distinct().where(b % 5 != 4).select(
        _month_date(m).alias("snapshot_date"),
        b.alias("denom_id"),
        ((m * 7 + b) % 1000).cast("decimal(10,0)").cast("decimal(38,18)").alias("_p"),
    ).select("snapshot_date", "denom_id", (F.col("_p") * F.lit("0.01").cast("decimal(3,2)")).cast("decimal(38,18)").alias("price_usd"))


_PRICED_SQL = f"""WITH {_LINES_SQL}, priced AS (
SELECT {_MONTH_SQL} AS snapshot_date, m AS block_height, s_name AS provider, n_name AS spec, CAST(ln % 4 AS BIGINT) AS source_kind,
  CASE WHEN ln0.b % 3 = 0 THEN 'ibc/H' || ln0.b ELSE p_brand END AS source_denom, p_brand AS resolved_denom, base_denom AS display_denom,
  CAST(cents * 10000 AS VARCHAR) AS raw_amount, round(cents * 10000 / CAST(factor AS DOUBLE), 6) AS display_amount,
  CASE WHEN ln0.b % 5 <> 4 THEN round((m * 7 + ln0.b) % 1000 / CAST(100 AS DOUBLE), 6) END AS price_usd,
  CASE WHEN ln0.b % 5 <> 4 THEN round(cents * 10000 / CAST(factor AS DOUBLE) * ((m * 7 + ln0.b) % 1000) / 100, 6) END AS value_usd
FROM ln0 LEFT JOIN meta ON meta.b = ln0.b WHERE m % 6 <> 5 AND NOT coalesce(suppress, false))"""


def _priced(spark, sf, tail=None):
    supplier = table(spark, sf, "supplier").select(F.col("s_suppkey").cast("int").alias("id"), F.col("s_name").alias("value"))
    nation = table(spark, sf, "nation").select(F.col("n_nationkey").alias("id"), F.col("n_name").alias("value"))
    rewards = _rewards(spark, sf)
    if tail:
        text = F.concat((F.col("amount") / 10000).cast("bigint").cast("string"), F.lit(tail))
        rewards = rewards.withColumn("amount_text", text).withColumn("amount", F.col("amount_text").try_cast("decimal(38,0)"))
    return sn.priced_rewards(
        rewards, _snapshots(spark, sf), supplier, nation,
        _denoms(spark, sf), _metadata(spark, sf), _prices(spark, sf),
    )


@query("priced_rewards", f"{_PRICED_SQL} SELECT * FROM priced")
def priced_rewards(spark, sf):
    return _priced(spark, sf).drop("block_time", "raw_text", "display_text", "value_text")


#: Digits behind the amounts of the exact queries; with them amounts have up to 40.
_TAIL = "7".rjust(32, "0")


@query(
    "priced_rewards_exact",
    f"""WITH {_LINES_SQL}, big AS (SELECT m AS block_height, s_name AS provider, n_name AS spec, CAST(ln % 4 AS BIGINT) AS source_kind,
  CASE WHEN ln0.b % 3 = 0 THEN 'ibc/H' || ln0.b ELSE p_brand END AS source_denom, CAST(cents AS VARCHAR) || '{_TAIL}' AS raw_text,
  CASE WHEN factor IS NOT NULL THEN length(CAST(factor AS BIGINT)::VARCHAR) - 1 END AS fd, CASE WHEN ln0.b % 5 <> 4 THEN (m * 7 + ln0.b) % 1000 END AS p, cents
  FROM ln0 LEFT JOIN meta ON meta.b = ln0.b WHERE m % 6 <> 5 AND NOT coalesce(suppress, false)),
mul AS (SELECT *, CAST(cents * p AS VARCHAR) || lpad(CAST(7 * p AS VARCHAR), 32, '0') AS product FROM big)
SELECT block_height, provider, spec, source_kind, source_denom, raw_text,
  CASE WHEN fd IS NOT NULL THEN left(raw_text, length(raw_text) - fd) || '.' || rpad(right(raw_text, fd), 18, '0') END AS display_text,
  CASE WHEN fd IS NULL OR p IS NULL THEN NULL WHEN p = 0 THEN '0.000000000000'
       ELSE left(product, length(product) - fd - 2) || '.' || rpad(right(product, fd + 2), 12, '0') END AS value_text FROM mul""",
)
def priced_rewards_exact(spark, sf):
    """Amounts of up to 40 digits, shown and valued to the last place."""
    columns = ["block_height", "provider", "spec", "source_kind", "source_denom", "raw_text", "display_text", "value_text"]
    return _priced(spark, sf, _TAIL).select(*columns)


@query(
    "display_amount",
    f"{_PRICED_SQL} SELECT resolved_denom, round(sum(display_amount), 4) AS amount, round(sum(value_usd), 4) AS value FROM priced GROUP BY 1",
)
def display_amount(spark, sf):
    return _priced(spark, sf).groupBy("resolved_denom").agg(
        F.round(F.sum("display_amount").cast("double"), 4).alias("amount"),
        F.round(F.sum("value_usd").cast("double"), 4).alias("value"),
    )


@query(
    "price_view_filter",
    f"WITH {_LINES_SQL} SELECT m AS block_height, count(*) AS rows FROM ln0 LEFT JOIN meta ON meta.b = ln0.b WHERE m % 6 <> 5 AND NOT coalesce(suppress, false) GROUP BY m",
)
def price_view_filter(spark, sf):
    return _priced(spark, sf).groupBy("block_height").agg(F.count(F.lit(1)).alias("rows"))


@query(
    "denoms_at_height",
    f"WITH {_LINES_SQL} SELECT DISTINCT m AS block_height, CAST(ln0.b AS BIGINT) AS denom_id, cgid AS coingecko_id FROM ln0 JOIN meta ON meta.b = ln0.b WHERE cgid IS NOT NULL AND NOT suppress",
)
def denoms_at_height(spark, sf):
    return sn.denoms_at_heights(_rewards(spark, sf), _metadata(spark, sf))


@query(
    "load_bearing_first",
    f"""WITH {_LINES_SQL}, d AS (SELECT DISTINCT m, ln0.b, cgid FROM ln0 JOIN meta ON meta.b = ln0.b WHERE cgid IS NOT NULL AND NOT suppress)
SELECT m AS block_height, CAST(b AS BIGINT) AS denom_id, cgid AS coingecko_id,
  row_number() OVER (PARTITION BY m ORDER BY CASE WHEN cgid = 'coin-8' THEN 0 ELSE 1 END, b) AS place FROM d""",
)
def load_bearing_first(spark, sf):
    """The fetch order of every height; the place in the order is read off the ordered rows."""
    denoms = sn.denoms_at_heights(_rewards(spark, sf), _metadata(spark, sf))
    ordered = sn.load_bearing_first(denoms, by=["block_height"], native="coin-8")
    order = Window.partitionBy("block_height").orderBy("_at")
    return ordered.withColumn("_at", F.monotonically_increasing_id()).withColumn("place", F.row_number().over(order)).drop("_at")


# --- stored responses -------------------------------------------------------------------------


def _responses(spark, sf, tail=""):
    """One stored rewards response per line.

    The quantity picks what went wrong: rate limits (many in every seventh month), pruned
    replicas, blank bodies, refusals, totals only, fractions, unknown traces, garbage amounts.
    """
    q, m, b, ln = F.col("q"), F.col("m"), F.col("b"), F.col("ln")
    status = F.when(((m % 7 == 0) & (q <= 15)) | (q == 1), 429).when(q == 2, 503).otherwise(200)
    denom = (
        F.when((m % 31 == 0) & (q == 9), F.lit("ibc/ERR"))
        .when(b == 21, F.lit("ibc/"))
        .otherwise(_source_denom(b, F.col("p_brand")))
    )
    amount = (
        F.when((m % 29 == 0) & (q == 8), F.lit("1.5"))
        .when((m % 37 == 0) & (q == 10), F.lit("abc.0"))
        .otherwise(F.concat(F.col("cents").cast("string"), F.lit(f"{tail}.000")))
    )
    coin = lambda d, a: F.struct(d.alias("denom"), a.alias("amount"))
    coins = F.when(
        ln % 2 == 0, F.array(coin(denom, amount), coin(F.lit("unative"), q.cast("string")))
    ).otherwise(F.array(coin(denom, amount)))
    label = F.when(ln % 4 == 0, "Boost: ").when(ln % 4 == 1, "Pools: ").when(ln % 4 == 2, "Subscription: ").otherwise("")
    info = F.to_json(F.struct(F.array(F.struct(F.concat(label, F.col("n_name")).alias("source"), coins.alias("amount"))).alias("info")))
    total = F.to_json(F.struct(coins.alias("total")))
    body = (
        F.when(q == 3, F.lit('{"success":false,"message":"Version Mismatch at height"}'))
        .when(q == 4, F.lit('{"success":false,"message":"provider not staked"}'))
        .when(q == 5, F.lit("  "))
        .when(q == 6, F.lit('{"info":[],"total":[]}'))
        .when(q == 7, total)
        .otherwise(info)
    )
    return _lines(spark, sf).select(
        m.alias("height"), F.col("s_name").alias("provider"), F.col("pos").alias("position"),
        status.alias("http_status"), body.alias("body"),
    )


_RESULTS_SQL = (
    _LINES_SQL
    + """,
den AS (SELECT *, CASE WHEN m % 31 = 0 AND q = 9 THEN 'ibc/ERR' WHEN b = 21 THEN 'ibc/' WHEN b % 3 = 0 THEN 'ibc/H' || b ELSE p_brand END AS source_denom,
  CASE WHEN m % 29 = 0 AND q = 8 THEN '1.5' WHEN m % 37 = 0 AND q = 10 THEN 'abc' ELSE CAST(cents AS VARCHAR) END AS amount_text FROM ln0),
res AS (SELECT *,
  CASE WHEN (m % 7 = 0 AND q <= 15) OR q = 1 THEN 'failed' WHEN q IN (2, 3, 5) THEN 'state_pruned' WHEN q = 4 THEN 'no_rewards'
       WHEN amount_text = '1.5' THEN 'failed' ELSE 'fetched' END AS outcome,
  CASE WHEN (m % 7 = 0 AND q <= 15) OR q = 1 THEN 'http 429' WHEN q = 2 THEN 'http 503' WHEN q = 3 THEN 'Version Mismatch at height'
       WHEN q = 4 THEN 'provider not staked' WHEN q = 5 THEN 'empty body'
       WHEN amount_text = '1.5' THEN 'non-integer amount "1.5" (denom=' || source_denom || ')' END AS reason FROM den),
gate AS (SELECT m, count(*) AS total, count(*) FILTER (WHERE outcome = 'failed') AS failed, count(*) FILTER (WHERE outcome = 'fetched') AS fetched,
  count(*) FILTER (WHERE outcome = 'fetched' AND q <> 6) AS provider_count, arg_min(reason, pos) FILTER (WHERE outcome = 'failed') AS first_reason
  FROM res GROUP BY m),
g2 AS (SELECT *, CASE WHEN failed * 5 > total THEN 'failed' ELSE 'ok' END AS status,
  CASE WHEN failed * 5 > total THEN failed || '/' || total || ' providers failed to fetch: ' || first_reason END AS error FROM gate)"""
)


@query(
    "rewards_responses",
    f"WITH {_RESULTS_SQL} SELECT outcome, reason, count(*) AS n FROM res GROUP BY 1, 2",
)
def rewards_responses(spark, sf):
    return rs.reward_results(_responses(spark, sf)).groupBy("outcome", "reason").agg(F.count(F.lit(1)).alias("n"))


@query(
    "parse_rewards",
    f"""WITH {_RESULTS_SQL}, am AS (
  SELECT *, CASE WHEN q = 7 THEN 3 WHEN ln % 4 = 3 THEN 2 ELSE ln % 4 END AS kind, CASE WHEN q = 7 THEN '' ELSE n_name END AS spec FROM res WHERE outcome = 'fetched' AND q <> 6)
SELECT CAST(kind AS BIGINT) AS source_kind, spec, source_denom, count(*) AS n FROM (
  SELECT kind, spec, source_denom FROM am UNION ALL SELECT kind, spec, 'unative' FROM am WHERE ln % 2 = 0) GROUP BY 1, 2, 3""",
)
def parse_rewards(spark, sf):
    amounts = rs.reward_amounts(rs.reward_results(_responses(spark, sf)))
    return amounts.groupBy("source_kind", "spec", "source_denom").agg(F.count(F.lit(1)).alias("n"))


@query(
    "outcome_counts",
    f"""WITH {_RESULTS_SQL} SELECT m AS height, count(*) FILTER (WHERE outcome = 'fetched') AS fetched, count(*) FILTER (WHERE outcome = 'no_rewards') AS no_rewards,
  count(*) FILTER (WHERE outcome = 'state_pruned') AS state_pruned, count(*) FILTER (WHERE outcome = 'failed') AS failed, count(*) AS total FROM res GROUP BY m""",
)
def outcome_counts(spark, sf):
    return sn.outcome_counts(rs.reward_results(_responses(spark, sf)), ["height"])


@query("snapshot_gate", f"WITH {_RESULTS_SQL} SELECT m AS height, status, error, failed, total, fetched FROM g2")
def snapshot_gate(spark, sf):
    return sn.snapshot_gate(rs.reward_results(_responses(spark, sf)), ["height"])


@query("provider_count", f"WITH {_RESULTS_SQL} SELECT m AS height, provider_count FROM gate")
def provider_count(spark, sf):
    return sn.provider_count(rs.reward_results(_responses(spark, sf)), ["height"])


def _traces(spark, sf):
    """Stored traces per brand: one brand's trace is unknown, one service error is stored."""
    b = F.col("id")
    brands = _denoms(spark, sf).where(b % 3 == 0)
    known = brands.select(
        F.concat(F.lit("H"), b.cast("string")).alias("hash"),
        F.when(b == 24, 404).otherwise(200).alias("http_status"),
        F.to_json(F.struct(F.struct(F.concat(F.lit(" "), F.col("value")).alias("base_denom")).alias("denom_trace"))).alias("body"),
    )
    broken = brands.agg(F.min("id").alias("id")).select(
        F.lit("ERR").alias("hash"), F.lit(500).alias("http_status"), F.lit("").alias("body")
    )
    return rs.denom_traces(known.unionByName(broken))


@query(
    "denom_traces",
    """SELECT 'H' || b AS hash, CASE WHEN b <> 24 THEN p_brand END AS base_denom, CAST(NULL AS VARCHAR) AS error
FROM (SELECT DISTINCT p_brand, CAST(regexp_extract(p_brand, '[0-9]+') AS INTEGER) AS b FROM part) WHERE b % 3 = 0
UNION ALL SELECT 'ERR', NULL, 'http 500'""",
)
def denom_traces(spark, sf):
    return _traces(spark, sf)


def _amounts(spark, sf):
    return _lines(spark, sf).select(
        F.col("pos"), _source_denom(F.col("b"), F.col("p_brand")).alias("source_denom")
    )


@query(
    "resolve_denoms",
    f"""WITH {_LINES_SQL}, a AS (SELECT b, p_brand, CASE WHEN b % 3 = 0 THEN 'ibc/H' || b ELSE p_brand END AS source_denom FROM ln0)
SELECT source_denom, CASE WHEN b <> 24 THEN p_brand END AS resolved_denom, count(*) AS n FROM a GROUP BY 1, 2""",
)
def resolve_denoms(spark, sf):
    resolved = sn.resolve_denoms(_amounts(spark, sf), _traces(spark, sf))
    return resolved.groupBy("source_denom", "resolved_denom").agg(F.count(F.lit(1)).alias("n"))


@query(
    "drop_suppressed",
    f"""WITH {_LINES_SQL}, a AS (SELECT CASE WHEN b % 3 = 0 THEN 'ibc/H' || b ELSE p_brand END AS source_denom FROM ln0)
SELECT source_denom, count(*) AS n FROM a WHERE source_denom <> 'Brand#11' GROUP BY 1""",
)
def drop_suppressed(spark, sf):
    kept = sn.drop_suppressed(_amounts(spark, sf), _metadata(spark, sf), _denoms(spark, sf))
    return kept.groupBy("source_denom").agg(F.count(F.lit(1)).alias("n"))


def _rewards_plan(spark, sf, tail=""):
    supplier = table(spark, sf, "supplier").select(F.col("s_suppkey").cast("int").alias("id"), F.col("s_name").alias("value"))
    return rewards_plan(
        _targets(spark, sf), _responses(spark, sf, tail), _metadata(spark, sf), _denoms(spark, sf),
        supplier, s.empty_dictionary(spark), _traces(spark, sf),
    )


_VERDICT_SQL = (
    _RESULTS_SQL
    + """,
live AS (SELECT res.* FROM res JOIN g2 USING (m) WHERE g2.status = 'ok' AND outcome = 'fetched' AND q <> 6 AND source_denom <> 'Brand#11'),
brk AS (SELECT m, bool_or(source_denom = 'ibc/ERR') AS unresolved,
  bool_or(amount_text = 'abc' AND source_denom NOT IN ('ibc/', 'ibc/H24', 'ibc/ERR')) AS garbage FROM live GROUP BY m),
verdict AS (SELECT g2.m, CASE WHEN g2.status = 'failed' OR coalesce(unresolved, false) THEN 'failed' ELSE 'ok' END AS status, fetched, provider_count,
  coalesce(error, CASE WHEN unresolved THEN 'resolve denoms: resolve ibc ibc/ERR: http 500' END) AS error, coalesce(garbage, false) AS garbage
  FROM g2 LEFT JOIN brk USING (m)),
snaps AS (SELECT * FROM verdict WHERE status = 'failed' OR NOT garbage)"""
)


@query(
    "rewards_snapshot",
    f"""WITH {_VERDICT_SQL} SELECT m AS block_height, {_MONTH_SQL} AS snapshot_date,
  CASE WHEN status = 'failed' THEN fetched ELSE provider_count END AS provider_count, status, error FROM snaps""",
)
def rewards_snapshot(spark, sf):
    return _rewards_plan(spark, sf)["snapshots"].drop("block_time")


_REWARD_ROWS_SQL = f"""WITH {_VERDICT_SQL},
am AS (SELECT m, s_name, CASE WHEN q = 7 THEN 3 WHEN ln % 4 = 3 THEN 2 ELSE ln % 4 END AS kind, CASE WHEN q = 7 THEN '' ELSE n_name END AS spec,
   source_denom, p_brand, amount_text, pos, q, ln FROM live),
rows_ AS (SELECT m, s_name, kind, spec, source_denom, CASE WHEN source_denom IN ('ibc/', 'ibc/H24') THEN NULL ELSE p_brand END AS resolved, amount_text, pos, 0 AS ap FROM am
  UNION ALL SELECT res.m, s_name, CASE WHEN q = 7 THEN 3 WHEN ln % 4 = 3 THEN 2 ELSE ln % 4 END, CASE WHEN q = 7 THEN '' ELSE n_name END,
            'unative', 'unative', CAST(q AS VARCHAR), pos, 1 FROM res JOIN g2 USING (m) WHERE g2.status = 'ok' AND outcome = 'fetched' AND q <> 6 AND ln % 2 = 0),
num AS (SELECT r.*, row_number() OVER (PARTITION BY r.m, s_name, kind, spec, source_denom, resolved ORDER BY pos, ap, CAST(amount_text AS BIGINT)) AS rn
  FROM rows_ r JOIN snaps ON snaps.m = r.m AND snaps.status = 'ok' WHERE resolved IS NOT NULL)
"""


@query(
    "rewards_snapshot_rows",
    f"""{_REWARD_ROWS_SQL} SELECT m AS block_height, s_name AS provider, spec, CAST(kind AS BIGINT) AS source_kind, source_denom, resolved AS resolved_denom, amount_text AS amount FROM num WHERE rn = 1""",
)
def rewards_snapshot_rows(spark, sf):
    return _named_rewards(_rewards_plan(spark, sf)).drop("amount_text")


@query(
    "rewards_rows_exact",
    f"""{_REWARD_ROWS_SQL} SELECT m AS block_height, s_name AS provider, spec, CAST(kind AS BIGINT) AS source_kind, source_denom, resolved AS resolved_denom,
  amount_text || CASE WHEN source_denom = 'unative' THEN '' ELSE '{_TAIL}' END AS amount_text FROM num WHERE rn = 1""",
)
def rewards_rows_exact(spark, sf):
    """Responses whose amounts have up to 40 digits."""
    return _named_rewards(_rewards_plan(spark, sf, _TAIL)).drop("amount")


def _named_rewards(out):
    text = lambda d, key, name: out[d].select(F.col("id").alias(key), F.col("value").alias(name))
    return (
        out["rewards"]
        .join(text("providers", "provider_id", "provider"), "provider_id")
        .join(text("specs", "spec_id", "spec"), "spec_id")
        .join(text("denoms", "denom_id", "resolved_denom"), "denom_id")
        .drop("provider_id", "spec_id", "denom_id")
    )


# --- prices -----------------------------------------------------------------------------------


def _price_responses(spark, sf):
    m, b = F.col("m"), F.col("b")
    slot = (m + b) % 10
    number = F.concat(F.lit("0."), F.lpad(((m * 7 + b) % 1000).cast("string"), 3, "0"))
    usd = F.when((m % 41 == 0) & (b == 2), F.lit("1.5e-7")).otherwise(number)
    body = (
        F.when(slot == 3, F.lit(" "))
        .when(slot == 4, F.lit("{}"))
        .when(slot == 5, F.lit('{"market_data":{"current_price":{"eur":1}}}'))
        .otherwise(F.concat(F.lit('{"market_data":{"current_price":{"usd":'), usd, F.lit("}}}")))
    )
    return _lines(spark, sf).select("m", "b").distinct().select(
        _month_date(m).alias("snapshot_date"),
        F.concat(F.lit("coin-"), b.cast("string")).alias("coingecko_id"),
        F.when(slot == 1, 429).when(slot == 2, 404).otherwise(200).alias("http_status"),
        body.alias("body"),
    )


_PRICE_SQL = (
    _LINES_SQL
    + """,
want AS (SELECT DISTINCT m, ln0.b, cgid FROM ln0 JOIN meta ON meta.b = ln0.b WHERE cgid IS NOT NULL AND NOT suppress),
got AS (SELECT *, (m + b) % 10 = 1 AS failed, (m + b) % 10 NOT IN (1, 2, 3, 4, 5) AND m % 41 = 0 AND b = 2 AS unreadable,
  CASE WHEN (m + b) % 10 IN (2, 3, 4, 5) THEN 0 ELSE ((m * 7 + b) % 1000) / CAST(1000 AS DOUBLE) END AS price FROM want),
per AS (SELECT m, bool_or(failed AND cgid = 'coin-1') AS native_failed, count(*) FILTER (WHERE unreadable) AS bad, count(*) FILTER (WHERE NOT failed) AS n FROM got GROUP BY m),
snap AS (SELECT ln.m, coalesce(native_failed, false) AS native_failed, coalesce(n, 0) AS n FROM (SELECT DISTINCT m FROM ln0) ln LEFT JOIN per USING (m)
  WHERE coalesce(native_failed, false) OR coalesce(bad, 0) = 0)"""
)


def _price_plan(spark, sf):
    return price_plan.price_snapshot(
        _targets(spark, sf).drop("block_time"), _rewards(spark, sf), _metadata(spark, sf), _price_responses(spark, sf), native="coin-1"
    )


@query(
    "price_snapshot",
    f"""WITH {_PRICE_SQL} SELECT {_MONTH_SQL} AS snapshot_date, {_MONTH_SQL} || ' 15:00:00.000000' AS block_time,
  CASE WHEN native_failed THEN 0 ELSE n END AS denom_count, CASE WHEN native_failed THEN 'failed' ELSE 'ok' END AS status,
  CASE WHEN native_failed THEN 'LAVA price fetch failed: rate limited' END AS error FROM snap""",
)
def price_snapshot(spark, sf):
    return _price_plan(spark, sf)["snapshots"]


@query(
    "price_snapshot_rows",
    f"""WITH {_PRICE_SQL} SELECT {_MONTH_SQL} AS snapshot_date, CAST(b AS BIGINT) AS denom_id, cgid AS coingecko_id, round(price, 6) AS price_usd
FROM got JOIN snap USING (m) WHERE NOT native_failed AND NOT failed""",
)
def price_snapshot_rows(spark, sf):
    return _price_plan(spark, sf)["prices"]


@query(
    "price_responses",
    f"""WITH {_LINES_SQL} SELECT {_MONTH_SQL} AS snapshot_date, 'coin-' || b AS coingecko_id, CASE WHEN (m + b) % 10 = 1 THEN 'rate limited' END AS error,
  CASE WHEN (m + b) % 10 = 1 THEN NULL WHEN (m + b) % 10 IN (2, 3, 4, 5) THEN '0' WHEN m % 41 = 0 AND b = 2 THEN '1.5e-7'
       ELSE '0.' || lpad(CAST((m * 7 + b) % 1000 AS VARCHAR), 3, '0') END AS price_text
FROM (SELECT DISTINCT m, b FROM ln0)""",
)
def price_responses(spark, sf):
    return rs.price_results(_price_responses(spark, sf))


# --- supply -----------------------------------------------------------------------------------


def _supply_responses(spark, sf, tail=""):
    """Monthly supply falling by the order totals of the month; some answers are broken."""
    date = F.col("o_orderdate")
    monthly = table(spark, sf, "orders").groupBy((F.year(date) * 12 + F.month(date)).cast("bigint").alias("m")).agg(
        F.sum(F.round(F.col("o_totalprice") * 100).cast("bigint")).alias("cents")
    )
    m, text = F.col("m"), F.concat((F.lit(10**17).cast("bigint") - F.col("cents")).cast("string"), F.lit(tail))
    coin = lambda d, a: F.struct(F.lit(d).alias("denom"), a.cast("string").alias("amount"))
    coins = (
        F.when(m % 11 == 3, F.array(coin("uatom", F.lit(5)), coin("uosmo", F.lit(6))))
        .when(m % 13 == 5, F.array(coin("ulava", F.lit("12.5"))))
        .when(m % 4 == 1, F.array(coin("ulava", F.lit(1)), coin("ulava", text)))
        .otherwise(F.array(coin("uatom", F.lit(5)), coin("ulava", text)))
    )
    slot = _month_date(m).cast("timestamp") + F.expr("INTERVAL 15 HOURS")
    return monthly.select(
        _month_date(m).alias("snapshot_date"),
        m.alias("block_height"),
        slot.alias("block_time"),
        F.when(m % 17 == 2, 500).otherwise(200).alias("http_status"),
        F.to_json(F.struct(coins.alias("supply"))).alias("body"),
    )


_SUPPLY_SQL = f"""
mo AS (SELECT CAST(year(o_orderdate) * 12 + month(o_orderdate) AS BIGINT) AS m, CAST(sum(CAST(round(o_totalprice * 100) AS BIGINT)) AS BIGINT) AS cents FROM orders GROUP BY 1),
sup AS (SELECT m, {_MONTH_SQL} AS snapshot_date, 100000000000000000 - cents AS supply,
  CASE WHEN m % 17 = 2 THEN 'fetch supply: http 500' WHEN m % 11 = 3 THEN 'ulava missing from supply response (denoms=2)' WHEN m % 13 = 5 THEN 'parse ulava amount "12.5"' END AS error FROM mo)"""


@query(
    "supply_snapshot",
    f"""WITH {_SUPPLY_SQL} SELECT snapshot_date, m AS block_height, snapshot_date || ' 15:00:00.000000' AS block_time,
  CAST(CASE WHEN error IS NULL THEN supply ELSE 0 END AS VARCHAR) AS total_supply, CASE WHEN error IS NULL THEN 'ok' ELSE 'failed' END AS status, error FROM sup""",
)
def supply_snapshot(spark, sf):
    return price_plan.supply_snapshot(_supply_responses(spark, sf)).drop("supply_text")


@query(
    "supply_exact",
    f"""WITH {_SUPPLY_SQL}, big AS (SELECT snapshot_date, supply, supply - lag(supply) OVER (ORDER BY snapshot_date) AS grown FROM sup WHERE error IS NULL)
SELECT snapshot_date, CAST(supply AS VARCHAR) || '{"9" * 23}' AS total_supply,
  CASE WHEN grown IS NULL THEN NULL WHEN grown = 0 THEN '0' ELSE CAST(-grown AS VARCHAR) || '{"0" * 23}' END AS burned FROM big""",
)
def supply_exact(spark, sf):
    """Supplies of 40 digits and what was burned between them."""
    return sn.supply_burn(price_plan.supply_snapshot(_supply_responses(spark, sf, "9" * 23))).drop("previous_supply")


@query(
    "supply_burn",
    f"""WITH {_SUPPLY_SQL} SELECT snapshot_date, CAST(supply AS VARCHAR) AS total_supply, CAST(lag(supply) OVER (ORDER BY snapshot_date) AS VARCHAR) AS previous_supply,
  CAST(lag(supply) OVER (ORDER BY snapshot_date) - supply AS VARCHAR) AS burned FROM sup WHERE error IS NULL""",
)
def supply_burn(spark, sf):
    return sn.supply_burn(price_plan.supply_snapshot(_supply_responses(spark, sf)))


@query(
    "supply_lookup",
    f"WITH {_SUPPLY_SQL} SELECT coalesce(error, 'ok') AS verdict, count(*) AS n FROM sup GROUP BY 1",
)
def supply_lookup(spark, sf):
    found = rs.supply_results(_supply_responses(spark, sf))
    return found.groupBy(F.coalesce("error", F.lit("ok")).alias("verdict")).agg(F.count(F.lit(1)).alias("n"))


# --- stored snapshots -------------------------------------------------------------------------


@query(
    "stored_snapshots",
    f"""{_REWARD_ROWS_SQL}, {_SUPPLY_SQL.strip()},
kept AS (SELECT m, count(*) AS n, count(*) FILTER (WHERE resolved <> 'Brand#11') AS shown FROM num WHERE rn = 1 GROUP BY m)
SELECT 'rewards' AS name, {_MONTH_SQL} AS snapshot_date, status, CAST(coalesce(n, 0) AS VARCHAR) AS rows FROM snaps LEFT JOIN kept USING (m)
UNION ALL SELECT 'due', {_MONTH_SQL}, NULL, NULL FROM verdict WHERE m NOT IN (SELECT m FROM snaps)
UNION ALL SELECT 'view', {_MONTH_SQL}, NULL, CAST(shown AS VARCHAR) FROM kept
UNION ALL SELECT 'supply', snapshot_date, CASE WHEN error IS NULL THEN 'ok' ELSE 'failed' END, CASE WHEN error IS NULL THEN CAST(supply AS VARCHAR) ELSE '0' END FROM sup""",
)
def stored_snapshots(spark, sf):
    """Due dates, their blocks, snapshots and a priced view are stored; a second run adds nothing to what is there."""
    root = shared_dir(spark, "snapshots")
    metadata = lambda denoms: _metadata_of(denoms, _metadata(spark, sf), _denoms(spark, sf))
    rewards = RewardsSnapshotter(spark, root, _responses(spark, sf), _traces(spark, sf), metadata)
    rewards.dictionaries["denoms"].replace(_denoms(spark, sf))
    supply = SupplySnapshotter(spark, root, _supply_responses(spark, sf))
    view = VersionedTable(spark, f"{root}/priced", "snapshot_date date, raw_text string, resolved_denom string")

    def priced():
        named = {n: d.read() for n, d in rewards.dictionaries.items()}
        rows = sn.priced_rewards(
            rewards.store.read("rewards"), rewards.store.read("snapshots"), named["providers"], named["specs"], named["denoms"],
            metadata(named["denoms"]), spark.createDataFrame([], schemas.PRICES),
        )
        return rows.select("snapshot_date", "raw_text", "resolved_denom")

    now = F.lit("2024-03-01").cast("timestamp")
    for snapshotter, targets in ((rewards, _targets(spark, sf)), (supply, _supply_responses(spark, sf).withColumn("slot", F.col("block_time")))):
        slots = targets.select("slot", F.col("snapshot_date").alias("slot_date"))
        headers = targets.select(F.col("block_height").alias("height"), (F.col("slot") + F.expr("INTERVAL 1 HOUR")).alias("time"))
        for _ in range(2):
            run_snapshots([snapshotter], slots, headers, now, [lambda: refresh_view(view, priced)])
        if snapshotter is rewards:
            due = slots.select("slot_date").subtract(rewards.store.taken().select("snapshot_date"))
    none = F.lit(None).cast("string")
    counts = rewards.store.read("rewards").groupBy("block_height").agg(F.count(F.lit(1)).alias("n"))
    taken = rewards.store.taken().join(counts, "block_height", "left")
    return (
        taken.select(F.lit("rewards").alias("name"), "snapshot_date", "status", F.coalesce("n", F.lit(0)).cast("string").alias("rows"))
        .unionByName(due.select(F.lit("due").alias("name"), F.col("slot_date").alias("snapshot_date"), none.alias("status"), none.alias("rows")))
        .unionByName(view.read().groupBy("snapshot_date").agg(F.count(F.lit(1)).cast("string").alias("rows")).select(F.lit("view").alias("name"), "snapshot_date", none.alias("status"), "rows"))
        .unionByName(supply.store.taken().select(F.lit("supply").alias("name"), "snapshot_date", "status", F.col("supply_text").alias("rows")))
    )


def _metadata_of(denoms, metadata, known):
    """The overlay of the known denoms under the ids of a grown dictionary."""
    by_name = metadata.join(known.withColumnsRenamed({"id": "denom_id"}), "denom_id").drop("denom_id")
    return by_name.join(denoms.withColumnsRenamed({"id": "denom_id"}), "value").drop("value")
