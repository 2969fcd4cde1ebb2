"""Request-log metrics."""

from __future__ import annotations

from pyspark.sql import functions as F

from chainloom.catalog import standins as s
from chainloom.catalog.registry import query
from chainloom.operators import telemetry as tm


def _log(spark, sf):
    """Events as requests: their type is the source, their value the latency in ms."""
    return s.events(spark, sf).select(
        F.col("event_type").alias("source"),
        F.col("ts").alias("at"),
        F.col("event_id").alias("request_id"),
        F.col("value").alias("latency_ms"),
        (F.col("k") < 3).alias("failed"),
        "k",
    )


@query(
    "latency_quantiles",
    f"""WITH {s.EVENTS_SQL}, r AS (SELECT event_type AS source, value AS v, row_number() OVER (PARTITION BY event_type ORDER BY ts DESC, event_id DESC) AS rn FROM ev),
o AS (SELECT source, v, row_number() OVER (PARTITION BY source ORDER BY v) - 1 AS i, count(*) OVER (PARTITION BY source) AS n FROM r WHERE rn <= 512)
SELECT source, max(n) AS samples, round(max(v) FILTER (WHERE i = least(n * 50 // 100, n - 1)), 6) AS p50,
  round(max(v) FILTER (WHERE i = least(n * 95 // 100, n - 1)), 6) AS p95, round(max(v) FILTER (WHERE i = least(n * 99 // 100, n - 1)), 6) AS p99 FROM o GROUP BY source""",
)
def latency_quantiles(spark, sf):
    return tm.latency_quantiles(_log(spark, sf))


@query(
    "error_rate",
    f"""WITH {s.EVENTS_SQL} SELECT event_type AS source, count(*) AS total, count(*) FILTER (WHERE k < 3) AS errors,
  round(count(*) FILTER (WHERE k < 3) / CAST(count(*) AS DOUBLE), 6) AS error_rate FROM ev GROUP BY 1""",
)
def error_rate(spark, sf):
    return tm.error_rate(_log(spark, sf))


# rates use a window of ten minutes here, since the log has one request in about four minutes
_WINDOW = 600


@query(
    "rolling_rate",
    f"""WITH {s.EVENTS_SQL}, c AS (SELECT event_type AS source, event_id, epoch_us(ts) AS us,
  sum(k) OVER (PARTITION BY event_type ORDER BY event_id ROWS UNBOUNDED PRECEDING) AS total FROM ev),
f AS (SELECT source, min(us) AS us0, arg_min(total, us) AS total0 FROM c GROUP BY source),
a AS (SELECT c.*, max(us) OVER w AS us1, max(total) OVER w AS total1 FROM c
  WINDOW w AS (PARTITION BY source ORDER BY us RANGE BETWEEN UNBOUNDED PRECEDING AND {_WINDOW * 1_000_000 + 1} PRECEDING))
SELECT source, event_id AS request_id, CASE WHEN us > coalesce(us1, us0)
  THEN round((total - coalesce(total1, total0)) / ((us - coalesce(us1, us0)) / 1e6), 6) ELSE 0 END AS rate FROM a JOIN f USING (source)""",
)
def rolling_rate(spark, sf):
    """Cumulative counter per source: the running sum of k."""
    log = _log(spark, sf).withColumn("k", F.col("k").cast("bigint"))
    counted = tm.running_sum(log, ["source"], F.col("request_id"), ["request_id"], "k", "total", s.WIDTH)
    return tm.rolling_rate(counted, _WINDOW).select("source", "request_id", "rate")


@query(
    "rolling_rps",
    f"""WITH {s.EVENTS_SQL}, c AS (SELECT event_type AS source, event_id, epoch_us(ts) AS us FROM ev),
a AS (SELECT *, count(*) OVER w AS n, min(us) OVER w AS lo FROM c
  WINDOW w AS (PARTITION BY source ORDER BY us RANGE BETWEEN {_WINDOW * 1_000_000} PRECEDING AND CURRENT ROW))
SELECT source, event_id AS request_id, n AS requests, round(n / greatest((us - lo) / 1e6, 0.25), 6) AS rps FROM a""",
)
def rolling_rps(spark, sf):
    return tm.rolling_rps(_log(spark, sf), _WINDOW).select("source", "request_id", "requests", "rps")


# a request lasts value x 10 seconds here, so that requests overlap
@query(
    "peak_in_flight",
    f"""WITH {s.EVENTS_SQL}, e AS (SELECT event_type AS source, epoch_us(ts) AS t, 1 AS step FROM ev
  UNION ALL SELECT event_type, epoch_us(ts) + CAST(round(value * 10000 * 1000) AS BIGINT), -1 FROM ev),
m AS (SELECT source, t, sum(step) AS step FROM e GROUP BY 1, 2)
SELECT source, CAST(max(o) AS BIGINT) AS peak FROM (SELECT source, sum(step) OVER (PARTITION BY source ORDER BY t) AS o FROM m) GROUP BY source""",
)
def peak_in_flight(spark, sf):
    return tm.peak_in_flight(_log(spark, sf).withColumn("latency_ms", F.col("latency_ms") * 10000))
