"""Failure ledger, run ledger, overlay and keyed-merge queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from chainloom import schemas
from chainloom.catalog import standins as s
from chainloom.catalog.registry import query, table
from chainloom.constants import DENOM_SEED, SUPPRESSED_TEST_DENOM
from chainloom.operators import ledger, merge
from chainloom.operators import snapshots as sn

_CAP = 3
_MID = "2024-01-16 00:00:00"
_T1, _T2 = "2024-02-01 00:00:00", "2024-03-01 00:00:00"


def _failures(spark, sf):
    """Error events as failures of five handlers over two hundred heights."""
    return (
        s.events(spark, sf)
        .where("event_type = 'error'")
        .select(
            F.concat(F.lit("h"), (F.col("user_id") % 5).cast("string")).alias("handler"),
            (F.col("event_id") % 200).alias("height"),
            F.concat(F.lit("error "), F.col("event_id").cast("string")).alias("reason"),
            F.col("event_id").alias("seq"),
            "ts",
            "k",
        )
    )


_FAIL_SQL = (
    s.EVENTS_SQL
    + f""",
fl AS (SELECT 'h' || (user_id % 5) AS handler, event_id % 200 AS height, 'error ' || event_id AS reason, event_id AS seq, ts, k,
              ts < TIMESTAMP '{_MID}' AS early
       FROM ev WHERE event_type = 'error'),
n AS (SELECT handler, height, count(*) FILTER (WHERE early) AS n1, count(*) FILTER (WHERE NOT early) AS n2,
             arg_max(reason, seq) AS last_reason, arg_max(reason, seq) FILTER (WHERE early) AS reason1
      FROM fl GROUP BY handler, height),
led1 AS (SELECT handler, height, reason1 AS reason, n1 AS retries, (n1 > 1 AND n1 >= {_CAP}) AS permanent FROM n WHERE n1 > 0)"""
)


def _now(text):
    return F.lit(text).cast("timestamp")


def _ledger1(spark, sf):
    empty = spark.createDataFrame([], schemas.FAILURES)
    return ledger.record_failures(empty, _failures(spark, sf).where(F.col("ts") < _now(_MID)), _now(_T1), _CAP)


@query(
    "record_failure",
    f"""WITH {_FAIL_SQL} SELECT handler, height, last_reason AS reason, n1 + n2 AS retries,
  ((n1 > 1 AND n1 >= {_CAP}) OR (n2 > 0 AND (n1 > 0 OR n2 > 1) AND n1 + n2 >= {_CAP})) AS permanent,
  CASE WHEN n1 > 0 THEN '{_T1}.000000' ELSE '{_T2}.000000' END AS first_seen_at,
  CASE WHEN n2 > 0 THEN '{_T2}.000000' ELSE '{_T1}.000000' END AS last_seen_at,
  CASE WHEN n1 > 1 AND n1 >= {_CAP} THEN '{_T1}.000000'
       WHEN n2 > 0 AND (n1 > 0 OR n2 > 1) AND n1 + n2 >= {_CAP} THEN '{_T2}.000000' END AS max_retries_reached_at,
  false AS in_retry FROM n""",
)
def record_failure(spark, sf):
    late = _failures(spark, sf).where(F.col("ts") >= _now(_MID))
    return ledger.record_failures(_ledger1(spark, sf), late, _now(_T2), _CAP)


@query(
    "record_permanent",
    f"""WITH {_FAIL_SQL}, p AS (SELECT handler, height, arg_max(reason, seq) AS r FROM fl WHERE NOT early AND k < 10 GROUP BY 1, 2)
SELECT coalesce(led1.handler, p.handler) AS handler, coalesce(led1.height, p.height) AS height,
  coalesce(r, reason) AS reason, coalesce(retries, 1) AS retries, (r IS NOT NULL OR permanent) AS permanent,
  CASE WHEN permanent THEN '{_T1}.000000' WHEN r IS NOT NULL THEN '{_T2}.000000' END AS max_retries_reached_at
FROM led1 FULL JOIN p ON p.handler = led1.handler AND p.height = led1.height""",
)
def record_permanent(spark, sf):
    fatal = _failures(spark, sf).where((F.col("ts") >= _now(_MID)) & (F.col("k") < 10))
    out = ledger.record_permanent(_ledger1(spark, sf), fatal, _now(_T2))
    return out.select("handler", "height", "reason", "retries", "permanent", "max_retries_reached_at")


_POPPED = """popped AS (SELECT handler, height FROM (SELECT *, row_number() OVER (PARTITION BY handler ORDER BY height DESC) AS rn
  FROM led1 WHERE NOT permanent) WHERE rn <= 10)"""


@query("pop_failures", f"WITH {_FAIL_SQL}, {_POPPED} SELECT handler, height FROM popped")
def pop_failures(spark, sf):
    return ledger.pop_failures(_ledger1(spark, sf), 10)[0]


@query(
    "failure_counts",
    f"""WITH {_FAIL_SQL}, {_POPPED}
SELECT handler, count(*) FILTER (WHERE NOT permanent AND popped.height IS NULL) AS retrying,
       count(*) FILTER (WHERE permanent) AS permanent, coalesce(max(retries), 0) AS max_retries
FROM led1 LEFT JOIN popped USING (handler, height) GROUP BY handler""",
)
def failure_counts(spark, sf):
    return ledger.failure_counts(ledger.pop_failures(_ledger1(spark, sf), 10)[1])


@query(
    "delete_where_in",
    f"WITH {_FAIL_SQL}, {_POPPED} SELECT handler, height, reason FROM led1 WHERE (handler, height) NOT IN (SELECT handler, height FROM popped)",
)
def delete_where_in(spark, sf):
    stored = _ledger1(spark, sf)
    popped, _ = ledger.pop_failures(stored, 10)
    return merge.delete_keys(stored, popped, ["handler", "height"]).select("handler", "height", "reason")


# --- runs -------------------------------------------------------------------------------------


def _runs(spark, sf):
    """One run per day of events; open when the day has an odd number of signups."""
    day = F.to_date("ts")
    rows = s.events(spark, sf).groupBy(day.alias("day")).agg(
        F.min("ts").alias("started_at"),
        F.max("ts").alias("last_heartbeat"),
        F.count(F.lit(1)).alias("rows_written"),
        F.count_if(F.col("event_type") == "signup").alias("signups"),
    )
    closed = F.col("signups") % 2 == 0
    return rows.select(
        F.date_format("day", "yyyyMMdd").cast("bigint").alias("id"),
        "started_at",
        "last_heartbeat",
        F.when(closed, F.col("last_heartbeat") + F.expr("INTERVAL 5 SECONDS")).alias("ended_at"),
        (F.col("rows_written") * 2).alias("blocks_indexed"),
        "rows_written",
        F.when(closed, F.lit("completed")).alias("end_reason"),
    )


_FMT = "'%Y-%m-%d %H:%M:%S.%f'"
_RUNS_SQL = """
d AS (SELECT CAST(ts AS DATE) AS day, min(ts) AS started_at, max(ts) AS beat, count(*) AS n,
             count(*) FILTER (WHERE event_type = 'signup') AS signups FROM events GROUP BY 1),
runs AS (SELECT CAST(strftime(day, '%Y%m%d') AS BIGINT) AS id, started_at, beat AS last_heartbeat,
                CASE WHEN signups % 2 = 0 THEN beat + INTERVAL 5 SECONDS END AS ended_at, n * 2 AS blocks_indexed, n AS rows_written,
                CASE WHEN signups % 2 = 0 THEN 'completed' END AS end_reason FROM d)"""


def _runs_out(source: str) -> str:
    return f"""SELECT id, strftime(started_at, {_FMT}) AS started_at, strftime(last_heartbeat, {_FMT}) AS last_heartbeat,
  strftime(ended_at, {_FMT}) AS ended_at, blocks_indexed, rows_written, end_reason FROM {source}"""


@query(
    "start_run",
    f"""WITH {_RUNS_SQL}, after AS (
  SELECT id, started_at, last_heartbeat, coalesce(ended_at, last_heartbeat) AS ended_at, blocks_indexed, rows_written,
         coalesce(end_reason, 'interrupted') AS end_reason FROM runs
  UNION ALL SELECT 20990101, TIMESTAMP '2099-01-01 00:00:00', TIMESTAMP '2099-01-01 00:00:00', NULL, 0, 0, NULL)
{_runs_out('after')}""",
)
def start_run(spark, sf):
    return ledger.start_run(_runs(spark, sf), 20990101, _now("2099-01-01 00:00:00"))


@query(
    "heartbeat",
    f"""WITH {_RUNS_SQL}, m AS (SELECT CAST(strftime(CAST(ts AS DATE), '%Y%m%d') AS BIGINT) AS id, count(*) AS b,
  CAST(sum(event_id % 7) AS BIGINT) AS r, max(ts + INTERVAL 1 SECOND) AS c FROM events WHERE CAST(strftime(CAST(ts AS DATE), '%d') AS INTEGER) % 3 <> 0 GROUP BY 1),
after AS (SELECT runs.id, started_at, greatest(last_heartbeat, c) AS last_heartbeat, ended_at,
   coalesce(b, blocks_indexed) AS blocks_indexed, coalesce(r, rows_written) AS rows_written, end_reason
   FROM runs LEFT JOIN m ON m.id = runs.id)
{_runs_out('after')}""",
)
def heartbeat(spark, sf):
    """Batches of all events; every third day has none, and the heart beats twice."""
    manifest = (
        s.events(spark, sf)
        .where("day(ts) % 3 <> 0")
        .select(
            F.date_format("ts", "yyyyMMdd").cast("bigint").alias("run_id"),
            F.lit(1).cast("bigint").alias("blocks"),
            (F.col("event_id") % 7).alias("rows"),
            (F.col("ts") + F.expr("INTERVAL 1 SECOND")).alias("committed_at"),
        )
    )
    return ledger.heartbeat(ledger.heartbeat(_runs(spark, sf), manifest), manifest)


@query(
    "end_run",
    f"""WITH {_RUNS_SQL}, after AS (SELECT id, started_at, last_heartbeat,
  CASE WHEN id % 2 = 0 THEN coalesce(ended_at, TIMESTAMP '2099-01-01 00:00:00') ELSE ended_at END AS ended_at, blocks_indexed, rows_written,
  CASE WHEN id % 2 = 0 THEN coalesce(end_reason, 'stopped') ELSE end_reason END AS end_reason FROM runs)
{_runs_out('after')}""",
)
def end_run(spark, sf):
    runs = _runs(spark, sf)
    return ledger.end_run(runs, runs.where("id % 2 = 0"), F.lit("stopped"), _now("2099-01-01 00:00:00"))


@query(
    "run_totals",
    f"""WITH {_RUNS_SQL} SELECT CAST(sum(blocks_indexed) AS BIGINT) AS total_blocks, CAST(sum(rows_written) AS BIGINT) AS total_rows,
  round(sum((epoch_us(coalesce(ended_at, last_heartbeat)) - epoch_us(started_at)) / 1e6), 6) AS total_seconds,
  strftime(min(started_at), {_FMT}) AS first_started_at, count(*) AS total_runs FROM runs""",
)
def run_totals(spark, sf):
    return ledger.run_totals(_runs(spark, sf))


@query(
    "recent_runs",
    f"""WITH {_RUNS_SQL}, top AS (SELECT * FROM runs ORDER BY started_at DESC LIMIT 10)
SELECT id, strftime(started_at, {_FMT}) AS started_at, strftime(last_heartbeat, {_FMT}) AS last_heartbeat,
  strftime(ended_at, {_FMT}) AS ended_at, blocks_indexed, rows_written, coalesce(end_reason, '') AS end_reason,
  round((epoch_us(coalesce(ended_at, last_heartbeat)) - epoch_us(started_at)) / 1e6, 6) AS duration_sec FROM top""",
)
def recent_runs(spark, sf):
    return ledger.recent_runs(_runs(spark, sf), 10)


# --- denom overlay ----------------------------------------------------------------------------


def _overlay(spark, sf):
    """Stored overlay: brand n stands for known denom n, with an edit on some of them."""
    n = F.regexp_extract("p_brand", "[0-9]+", 0).cast("int")
    names = F.array(*[F.lit(r) for r, _, _, _ in DENOM_SEED])
    brands = table(spark, sf, "part").select(n.alias("n")).distinct()
    stored = brands.where("n <= 24").select(
        F.col("n").alias("id"), F.element_at(names, F.col("n")).alias("value"), "n"
    )
    denoms = stored.select("id", "value")
    overlay = stored.select(
        F.col("id").alias("denom_id"),
        F.concat(F.lit("edited-"), F.col("value")).alias("base_denom"),
        F.lit(7).cast("decimal(38,0)").alias("factor"),
        F.when(F.col("n") % 2 == 0, F.lit("own-id")).alias("coingecko_id"),
        (F.col("n") % 5 == 0).alias("suppress"),
    )
    # the highest brands have a dictionary entry but no overlay row yet
    return denoms, overlay.where("denom_id <= 20")


_SEED_VALUES = ", ".join(
    f"({i}, '{r}', '{b}', '{f}', '{c}')" for i, (r, b, f, c) in enumerate(DENOM_SEED, 1)
)
_OVERLAY_SQL = f"""
seed(n, raw, base, factor, cgid) AS (VALUES {_SEED_VALUES}),
br AS (SELECT DISTINCT CAST(regexp_extract(p_brand, '[0-9]+') AS INTEGER) AS n FROM part),
denoms AS (SELECT seed.n AS id, raw AS value FROM seed JOIN br ON br.n = seed.n),
fresh AS (SELECT raw AS value FROM seed WHERE raw NOT IN (SELECT value FROM denoms) UNION ALL SELECT '{SUPPRESSED_TEST_DENOM[0]}'),
dict AS (SELECT id, value FROM denoms UNION ALL
         SELECT (SELECT max(id) FROM denoms) + row_number() OVER (ORDER BY md5(value), value), value FROM fresh),
ov AS (SELECT id AS denom_id, 'edited-' || value AS base_denom, '7' AS factor,
              CASE WHEN id % 2 = 0 THEN 'own-id' END AS coingecko_id, id % 5 = 0 AS suppress FROM denoms WHERE id <= 20)"""


@query(
    "seed_denom_metadata",
    f"""WITH {_OVERLAY_SQL}
SELECT dict.value AS denom, CAST(dict.id AS BIGINT) AS denom_id, coalesce(ov.base_denom, base, 'test') AS base_denom,
  coalesce(ov.factor, seed.factor, '1') AS factor, coalesce(coingecko_id, cgid) AS coingecko_id,
  coalesce(suppress, dict.value = '{SUPPRESSED_TEST_DENOM[0]}') AS suppress
FROM dict LEFT JOIN seed ON seed.raw = dict.value LEFT JOIN ov ON ov.denom_id = dict.id""",
)
def seed_denom_metadata(spark, sf):
    dictionary, overlay = ledger.seed_denom_metadata(spark, *_overlay(spark, sf))
    return overlay.join(dictionary.select(F.col("id").alias("denom_id"), F.col("value").alias("denom")), "denom_id")


@query(
    "seed_denom_metadata_overwrite",
    f"""WITH {_OVERLAY_SQL}
SELECT dict.value AS denom, CAST(dict.id AS BIGINT) AS denom_id, coalesce(base, 'test') AS base_denom,
  coalesce(seed.factor, '1') AS factor, cgid AS coingecko_id,
  coalesce(suppress, dict.value = '{SUPPRESSED_TEST_DENOM[0]}') AS suppress
FROM dict LEFT JOIN seed ON seed.raw = dict.value LEFT JOIN ov ON ov.denom_id = dict.id""",
)
def seed_denom_metadata_overwrite(spark, sf):
    dictionary, overlay = ledger.seed_denom_metadata(spark, *_overlay(spark, sf), keep_edits=False)
    return overlay.join(dictionary.select(F.col("id").alias("denom_id"), F.col("value").alias("denom")), "denom_id")


@query(
    "overlay_update",
    f"""WITH {_OVERLAY_SQL}
SELECT CAST(denom_id AS BIGINT) AS denom_id, base_denom, factor,
  CASE WHEN denom_id % 3 = 0 THEN 'new-token' ELSE coingecko_id END AS coingecko_id,
  CASE WHEN denom_id % 4 = 0 THEN true ELSE suppress END AS suppress FROM ov""",
)
def overlay_update(spark, sf):
    denoms, overlay = _overlay(spark, sf)
    edits = denoms.select(
        F.col("value").alias("denom"),
        F.when(F.col("id") % 3 == 0, F.lit("new-token")).alias("coingecko_id"),
        F.when(F.col("id") % 4 == 0, F.lit(True)).alias("suppress"),
    )
    return ledger.overlay_update(overlay, denoms, edits)


# --- keyed merges -----------------------------------------------------------------------------

_LINE = ["l_orderkey", "l_linenumber"]
_LINE_ORDER = [
    "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag",
    "l_linestatus", "l_shipdate",
]
_LINE_OUT = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity"]
_FIRST_LINES = f"""first_lines AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY {', '.join(_LINE_ORDER)}) AS rn
  FROM lineitem) WHERE rn = 1)"""
_LINE_COLS = "l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, l_partkey, l_suppkey, l_quantity"


@query("first_wins_dedup", f"WITH {_FIRST_LINES} SELECT {_LINE_COLS} FROM first_lines")
def first_wins_dedup(spark, sf):
    return merge.first_per_key(table(spark, sf, "lineitem"), _LINE, _LINE_ORDER).select(*_LINE_OUT)


@query(
    "insert_only_merge",
    f"""WITH first_old AS (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem WHERE l_returnflag = 'R'),
n AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY {', '.join(_LINE_ORDER)}) AS rn
      FROM lineitem WHERE l_returnflag <> 'R')
SELECT {_LINE_COLS} FROM n WHERE rn = 1 AND (l_orderkey, l_linenumber) NOT IN (SELECT l_orderkey, l_linenumber FROM first_old)""",
)
def insert_only_merge(spark, sf):
    """Returned lines are stored already; the others arrive."""
    lines = table(spark, sf, "lineitem")
    stored, new = lines.where("l_returnflag = 'R'"), lines.where("l_returnflag <> 'R'")
    return merge.insert_only_merge(stored, new, _LINE, _LINE_ORDER).select(*_LINE_OUT)


@query(
    "upsert_snapshot",
    """WITH m AS (SELECT strftime(o_orderdate, '%Y-%m-01') AS snapshot_date, count(*) AS orders, round(sum(o_totalprice), 2) AS total,
  count(*) FILTER (WHERE o_orderpriority = '1-URGENT') AS urgent FROM orders GROUP BY 1)
SELECT snapshot_date, CASE WHEN urgent % 2 = 0 THEN -1 ELSE orders END AS orders, total FROM m""",
)
def upsert_snapshot(spark, sf):
    """Monthly snapshots; those of months with an even number of urgent orders are written again."""
    month = F.date_format("o_orderdate", "yyyy-MM-01")
    stored = table(spark, sf, "orders").groupBy(month.alias("snapshot_date")).agg(
        F.count(F.lit(1)).alias("orders"),
        F.round(F.sum("o_totalprice"), 2).alias("total"),
        F.count_if(F.col("o_orderpriority") == "1-URGENT").alias("urgent"),
    )
    again = stored.where("urgent % 2 = 0").withColumn("orders", F.lit(-1).cast("bigint"))
    return merge.upsert(stored.where("urgent % 3 <> 0"), again.unionByName(stored.where("urgent % 2 <> 0 AND urgent % 3 = 0")), ["snapshot_date"]).drop("urgent")


@query(
    "fk_check",
    """SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal >= 0)""",
)
def fk_check(spark, sf):
    """Orders whose customer is not among those in credit."""
    parents = table(spark, sf, "customer").where("c_acctbal >= 0")
    return merge.orphans(table(spark, sf, "orders"), parents, [("o_custkey", "c_custkey")]).select(
        "o_orderkey", "o_custkey"
    )


@query(
    "cascade_delete",
    "SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_acctbal >= 0)",
)
def cascade_delete(spark, sf):
    parents = table(spark, sf, "customer").where("c_acctbal >= 0")
    return merge.cascade_delete(table(spark, sf, "orders"), parents, [("o_custkey", "c_custkey")]).select(
        "o_orderkey", "o_custkey"
    )


@query(
    "key_violations",
    "SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, count(*) AS copies FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1",
)
def key_violations(spark, sf):
    return merge.key_violations(table(spark, sf, "lineitem"), _LINE)


@query(
    "active_price_denoms",
    f"WITH {_OVERLAY_SQL} SELECT CAST(denom_id AS BIGINT) AS denom_id, coingecko_id FROM ov WHERE coingecko_id IS NOT NULL AND NOT suppress ORDER BY denom_id",
)
def active_price_denoms(spark, sf):
    return sn.active_price_denoms(_overlay(spark, sf)[1])
