"""Parsers and classifiers over texts made from the events table."""

from __future__ import annotations

from pyspark.sql import functions as F

from chainloom.catalog import standins as s
from chainloom.catalog.registry import query
from chainloom.constants import RETRYABLE_NETWORK_TEXT
from chainloom.functions import classify, numbers, payloads, texts, times


def _cases(name: str, cases: list[tuple[str, str, str, str]], fn):
    """Register a parser over texts that case ``k % n`` builds.

    A case is (Spark expression, SQL expression, expected SQL, note). ``{k}`` is the text of k.
    """
    n = len(cases)
    when = lambda i: " ".join(f"WHEN {j} THEN {c[i]}" for j, c in enumerate(cases))
    sql = f"WITH {s.EVENTS_SQL} SELECT event_id, CASE k % {n} {when(2)} END AS out FROM ev"

    @query(name, sql)
    def run(spark, sf):
        text = F.expr(f"CASE k % {n} {when(0)} END")
        rows = s.events(spark, sf).withColumn("text", text)
        return rows.select("event_id", fn(F.col("text")).alias("out"))

    return run


def _same(expr: str, expected: str) -> tuple[str, str, str, str]:
    return (expr, expr, expected, "")


_K = "CAST(k AS STRING)"
_KS = "CAST(k AS VARCHAR)"

_cases(
    "parse_int_or_null",
    [
        _same(_K, "CAST(k AS BIGINT)"),
        _same(f"concat('+', {_K})", "CAST(k AS BIGINT)"),
        _same(f"concat('-00', {_K})", "CAST(-k AS BIGINT)"),
        _same(f"concat(' ', {_K})", "NULL"),
        _same(f"concat({_K}, '.0')", "NULL"),
        _same("'9223372036854775808'", "NULL"),
        _same("''", "NULL"),
    ],
    numbers.parse_int_or_null,
)
_cases(
    "parse_int_or_zero",
    [_same(_K, "CAST(k AS BIGINT)"), _same(f"concat({_K}, 'x')", "CAST(0 AS BIGINT)"), _same("''", "CAST(0 AS BIGINT)")],
    numbers.parse_int_or_zero,
)
_cases(
    "parse_fraction",
    [
        _same(f"concat({_K}, '/128')", "CAST(k AS DOUBLE) / 128"),
        _same(f"concat({_K}, '/0')", "NULL"),
        _same(f"concat({_K}, '.5')", "CAST(k AS DOUBLE) + 0.5"),
        _same(f"concat(' ', {_K})", "NULL"),
        _same(f"concat({_K}, 'd')", "NULL"),
        _same("'1e400'", "NULL"),
        _same(f"concat({_K}, '/2/3')", "NULL"),
        _same(f"concat({_K}, 'e1')", "CAST(k AS DOUBLE) * 10"),
        _same("''", "NULL"),
        _same("'0x1p3'", "CAST(8 AS DOUBLE)"),
    ],
    numbers.parse_fraction,
)
_cases(
    "clean_integer",
    [
        _same(_K, _KS),
        _same(f"concat('-', {_K}, '.000')", f"'-' || {_KS}"),
        _same(f"concat({_K}, '.10')", "NULL"),
        _same("'.0'", "'0'"),
        _same("'-.00'", "'0'"),
        _same("'-'", "NULL"),
        _same("''", "NULL"),
        _same(f"concat('a', {_K}, '.0')", f"'a' || {_KS}"),
        _same(f"concat({_K}, '.0.0')", "NULL"),
    ],
    numbers.clean_integer,
)
_cases(
    "parse_decimal",
    [
        _same(f"concat(' ', {_K}, ' ')", "CAST(k AS DOUBLE)"),
        _same(f"concat('.', {_K})", f"CAST('0.' || {_KS} AS DOUBLE)"),
        _same(f"concat('-', {_K}, '.25')", "-CAST(k AS DOUBLE) - 0.25"),
        _same(f"concat({_K}, 'e4')", "NULL"),
        _same("''", "CAST(0 AS DOUBLE)"),
        _same("'garbage'", "NULL"),
    ],
    numbers.parse_price,
)
_cases(
    "parse_source",
    [
        _same(f"concat('Boost: ETH', {_K})", f"'0|ETH' || {_KS}"),
        _same(f"concat('Pools: ', {_K})", f"'1|' || {_KS}"),
        _same(f"concat('Subscription: a: ', {_K})", f"'2|a: ' || {_KS}"),
        _same(f"concat('Other: ', {_K})", f"'2|' || {_KS}"),
        _same(f"concat('Boost:', {_K})", f"'2|Boost:' || {_KS}"),
    ],
    lambda t: F.concat_ws("|", payloads.parse_source(t)["source_kind"].cast("string"), payloads.parse_source(t)["spec"]),
)
_cases(
    "classify_message",
    [
        _same(f"concat('VERSION does not EXIST ', {_K})", "'retry'"),
        _same(f"concat('no commit info found at ', {_K})", "'retry'"),
        _same(f"concat('method not implemented ', {_K})", "'retry'"),
        _same(f"concat('provider ', {_K}, ' not staked')", "'no_rewards'"),
        _same("CAST(NULL AS STRING)", "'no_rewards'"),
    ],
    classify.classify_message,
)
_cases(
    "classify_fetch_error",
    [
        _same("'no_source_covers'", "true"),
        _same("'height_pruned'", "true"),
        _same("'rate_limited'", "false"),
        _same("'cancelled'", "false"),
        _same("CAST(NULL AS STRING)", "false"),
    ],
    classify.classify_fetch_error,
)
_cases(
    "is_retryable_net_error",
    [(f"concat('read: ', '{t}', {_K})",) * 2 + ("true", "") for t in RETRYABLE_NETWORK_TEXT]
    + [_same(f"concat('bad request ', {_K})", "false")],
    classify.is_retryable_net_error,
)
_cases(
    "redact_userinfo",
    [
        _same(f"concat('https://u', {_K}, ':pw@host/p')", f"'https://u' || {_KS} || ':***@host/p'"),
        _same(f"concat('http://u', {_K}, ':p@w@host:80')", f"'http://u' || {_KS} || ':***@host:80'"),
        _same(f"concat('https://u', {_K}, '@host')", f"'https://u' || {_KS} || '@host'"),
        _same(f"concat('https://host:8080/a?b=c:', {_K}, '@d')", f"'https://host:8080/a?b=c:' || {_KS} || '@d'"),
    ],
    texts.redact_userinfo,
)
_cases(
    "retry_after_seconds",
    [
        _same(_K, "CAST(k AS DOUBLE)"),
        _same(f"concat('-1', {_K})", "CAST(0 AS DOUBLE)"),
        _same("'Mon, 01 Jan 2024 00:01:30 GMT'", "CAST(90 AS DOUBLE)"),
        _same("'Monday, 01-Jan-24 00:00:10 GMT'", "CAST(10 AS DOUBLE)"),
        _same("'Mon Jan  1 00:00:05 2024'", "CAST(5 AS DOUBLE)"),
        _same("'Sun, 31 Dec 2023 00:00:00 GMT'", "CAST(0 AS DOUBLE)"),
        _same("'soon'", "CAST(0 AS DOUBLE)"),
    ],
    lambda t: times.retry_after_seconds(t, F.lit("2024-01-01 00:00:00").cast("timestamp")),
)


@query(
    "classify_http_status",
    f"""WITH {s.EVENTS_SQL}, c AS (SELECT event_id, 190 + k * 4 AS status FROM ev)
SELECT event_id, CASE WHEN status BETWEEN 200 AND 299 THEN 'ok' WHEN status = 429 THEN 'rate_limited' WHEN status BETWEEN 500 AND 599 THEN 'server_error' ELSE 'terminal' END AS out,
  CASE WHEN status IN (400, 404) THEN 'height_pruned' END AS lcd,
  CASE WHEN status BETWEEN 200 AND 299 THEN 'ok' WHEN status IN (404, 500, 501, 502, 503, 504) THEN 'state_pruned' ELSE 'failed' END AS rewards FROM c""",
)
def classify_http_status(spark, sf):
    status = 190 + F.col("k") * 4
    return s.events(spark, sf).select(
        "event_id",
        classify.classify_http_status(status).alias("out"),
        classify.classify_lcd_status(status).alias("lcd"),
        classify.classify_http_rewards(status).alias("rewards"),
    )


@query(
    "safe_reason",
    f"""WITH {s.EVENTS_SQL} SELECT event_id, CASE k % 5 WHEN 0 THEN 'height ' || event_id || ' pruned (http 404)' WHEN 1 THEN 'http ' || (400 + k)
  WHEN 2 THEN 'no endpoint covers heights ' || event_id || '-' || (event_id + k) WHEN 3 THEN repeat('x', 250) || '…' ELSE 'short ' || k END AS reason FROM ev""",
)
def safe_reason(spark, sf):
    k, h = F.col("k"), F.col("event_id")
    kind = F.when(k % 5 == 0, "height_pruned").when(k % 5 == 1, "http_status").when(k % 5 == 2, "no_source_covers").otherwise("other")
    status = F.when(k % 5 == 0, 404).otherwise(400 + k)
    message = F.when(k % 5 == 3, F.repeat(F.lit("x"), 251 + k)).otherwise(F.concat(F.lit("short "), k.cast("string")))
    return s.events(spark, sf).select("event_id", texts.safe_reason(kind, h, status, h, h + k, message).alias("reason"))


@query(
    "tx_hash_bytes",
    f"""WITH {s.EVENTS_SQL} SELECT event_id, CASE k % 3 WHEN 0 THEN repeat('FF', 24) || lpad(printf('%X', event_id), 16, '0') WHEN 1 THEN upper(sha256(CAST(event_id AS VARCHAR))) END AS bytes FROM ev""",
)
def tx_hash_bytes(spark, sf):
    text = F.when(F.col("k") % 3 == 0, "").when(F.col("k") % 3 == 1, F.sha2(F.col("event_id").cast("string"), 256)).otherwise("abc")
    return s.events(spark, sf).select("event_id", texts.tx_hash_bytes(text, F.col("event_id")).alias("bytes"))


@query(
    "format_ddmmyyyy",
    "SELECT DISTINCT strftime(o_orderdate, '%d-%m-%Y') AS day FROM orders",
)
def format_ddmmyyyy(spark, sf):
    from chainloom.catalog.registry import table

    return table(spark, sf, "orders").select(times.format_ddmmyyyy(F.col("o_orderdate")).alias("day")).distinct()
