"""Interval queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from chainloom.catalog import standins as s
from chainloom.catalog.registry import query, table
from chainloom.operators import intervals as iv
from chainloom.operators import ledger
from chainloom.plans import coverage
from chainloom.session import cut

W = s.WIDTH
_OUT = "handler, f AS from_height, t AS to_height"
_CTE = f"WITH {s.RANGES_SQL}"
_MERGED = f"merged AS ({s.merged_sql('rng')})"
_GAPS = f"gaps AS ({s.gaps_sql('rng')})"
# gaps of any handler, merged over handlers
_UNION = f"""{_GAPS}, one AS (SELECT 'all' AS handler, f, t FROM gaps), ugaps AS ({s.merged_sql('one')})"""


@query("merge_ranges", f"{_CTE}, {_MERGED} SELECT {_OUT} FROM merged")
def merge_ranges(spark, sf):
    return iv.merge_ranges(s.ranges(spark, sf), width=W)


@query(
    "compact_ranges",
    f"""{_CTE}, {_MERGED} SELECT handler, b AS rows_before, a AS rows_after, b - a AS rows_saved
FROM (SELECT handler, count(*) AS b FROM rng GROUP BY handler)
JOIN (SELECT handler, count(*) AS a FROM merged GROUP BY handler) USING (handler)""",
)
def compact_ranges(spark, sf):
    return iv.compact_ranges(s.ranges(spark, sf), width=W)[1]


@query("record_range", f"{_CTE} SELECT handler, f AS from_height, max(t) AS to_height FROM rng GROUP BY handler, f")
def record_range(spark, sf):
    r = s.ranges(spark, sf)
    half = r.agg((F.max("from_height") / 2).cast("bigint")).scalar()
    return iv.record_range(r.where(F.col("from_height") < half), r.where(F.col("from_height") >= half))


@query("range_gaps", f"{_CTE}, {_GAPS} SELECT {_OUT} FROM gaps")
def range_gaps(spark, sf):
    return iv.range_gaps(s.ranges(spark, sf), s.windows(spark, sf), width=W)


@query("union_gaps", f"{_CTE}, {_UNION} SELECT f AS from_height, t AS to_height FROM ugaps")
def union_gaps(spark, sf):
    return iv.union_gaps(s.ranges(spark, sf), s.windows(spark, sf), width=W)


# interval sets joined over all handlers are dense, so set union is also shown on coverage
@query(
    "interval_union",
    f"""{_CTE}, one AS (SELECT 'all' AS handler, f, t FROM rng), u AS ({s.merged_sql('one')})
SELECT f AS from_height, t AS to_height FROM u""",
)
def interval_union(spark, sf):
    return iv.merge_ranges(s.ranges(spark, sf), [], W)


def _horizons(spark, sf):
    """Sources that begin at thirds of the height axis, and a disabled one in the middle."""
    top = F.max("o_orderkey")
    third = lambda n: F.floor(top * n / 3).cast("bigint")
    row = lambda h, off: F.struct(h.alias("earliest_height"), F.lit(off).alias("disabled"))
    rows = F.array(row(third(1), False), row(third(2), False), row(F.floor(top / 2).cast("bigint"), True), row(F.lit(1).cast("bigint"), False))
    return table(spark, sf, "orders").agg(rows.alias("_h")).select(F.inline("_h"))


@query(
    "split_ranges_at",
    f"""{_CTE}, {_GAPS},
hor AS (SELECT CAST(floor(hi * 1 / 3) AS BIGINT) AS h FROM win UNION SELECT CAST(floor(hi * 2 / 3) AS BIGINT) FROM win),
cuts AS (SELECT handler, f, t, f AS p FROM gaps
         UNION SELECT handler, f, t, h FROM gaps, hor WHERE h > f AND h <= t)
SELECT handler, p AS from_height,
       coalesce(lead(p) OVER (PARTITION BY handler, f, t ORDER BY p) - 1, t) AS to_height FROM cuts""",
)
def split_ranges_at(spark, sf):
    gaps = iv.range_gaps(s.ranges(spark, sf), s.windows(spark, sf), width=W)
    return iv.split_ranges_at(gaps, _horizons(spark, sf))


@query(
    "chunk_ranges",
    f"""{_CTE}, {_GAPS},
b AS (SELECT handler, t, unnest(generate_series(f, t, 50)) AS x FROM gaps)
SELECT handler, x AS from_height, least(x + 49, t) AS to_height FROM b""",
)
def chunk_ranges(spark, sf):
    gaps = iv.range_gaps(s.ranges(spark, sf), s.windows(spark, sf), width=W)
    return iv.chunk_ranges(gaps, 50).select("handler", "from_height", "to_height")


@query(
    "expand_range",
    f"""{_CTE}, {_MERGED}, x AS (SELECT handler, unnest(generate_series(f, t)) AS h FROM merged)
SELECT handler, count(*) AS heights, CAST(sum(h) AS BIGINT) AS height_sum, count(DISTINCT h) AS distinct_heights
FROM x GROUP BY handler""",
)
def expand_range(spark, sf):
    heights = iv.expand_ranges(iv.merge_ranges(s.ranges(spark, sf), width=W))
    return heights.groupBy("handler").agg(
        F.count(F.lit(1)).alias("heights"), F.sum("height").alias("height_sum"), F.count_distinct("height").alias("distinct_heights")
    )


_WITHOUT_POINTS = f"""{s.POINTS_SQL}, both_ AS (SELECT * FROM rng UNION ALL SELECT handler, height, height FROM pts),
left_over AS ({s.gaps_sql('both_')})"""


@query("subtract_points", f"{_CTE}, {_WITHOUT_POINTS} SELECT {_OUT} FROM left_over")
def subtract_points(spark, sf):
    gaps = cut(iv.range_gaps(s.ranges(spark, sf), s.windows(spark, sf), width=W), "gaps")
    return iv.subtract_points(gaps, s.failed_points(spark, sf), width=W)


@query("coverage_gaps", f"{_CTE}, {_WITHOUT_POINTS} SELECT {_OUT} FROM left_over")
def coverage_gaps(spark, sf):
    return coverage.coverage_gaps(s.ranges(spark, sf), s.failed_points(spark, sf), s.windows(spark, sf), W)


@query(
    "interval_difference",
    f"{_CTE}, {_GAPS} SELECT handler, count(*) AS gaps, CAST(sum(t - f + 1) AS BIGINT) AS heights FROM gaps GROUP BY handler",
)
def interval_difference(spark, sf):
    gaps = iv.range_gaps(s.ranges(spark, sf), s.windows(spark, sf), width=W)
    return gaps.groupBy("handler").agg(
        F.count(F.lit(1)).alias("gaps"), F.sum(F.col("to_height") - F.col("from_height") + 1).alias("heights")
    )


_RATIO = """SELECT handler, round(sum(greatest(least(t, hi) - greatest(f, lo) + 1, 0)) / CAST(max(hi - lo + 1) AS DOUBLE), 6) AS ratio
FROM merged, win GROUP BY handler"""


@query("coverage_ratio", f"{_CTE}, {_MERGED} {_RATIO}")
def coverage_ratio(spark, sf):
    return iv.coverage_ratio(s.ranges(spark, sf), s.windows(spark, sf), width=W).select("handler", "ratio")


def _islands(source: str) -> str:
    return f"""SELECT handler, min(height) AS f, max(height) AS t
FROM (SELECT handler, height, height - row_number() OVER (PARTITION BY handler ORDER BY height) AS g FROM {source})
GROUP BY handler, g"""


@query(
    "coverage_report",
    f"""{_CTE}, {s.POINTS_SQL}, {_MERGED}, isl AS ({_islands('pts')}),
both_ AS (SELECT * FROM rng UNION ALL SELECT handler, height, height FROM pts), left_over AS ({s.gaps_sql('both_')}),
cov AS (SELECT handler, count(*) AS ranges, min(f) AS covered_start, max(t) AS covered_end,
          round(100 * (sum(greatest(least(t, hi) - greatest(f, lo) + 1, 0)) / CAST(max(hi - lo + 1) AS DOUBLE)), 6) AS window_pct,
          round(100 * (sum(greatest(least(t, 1000) - greatest(f, 1) + 1, 0)) / CAST(1000 AS DOUBLE)), 6) AS chain_pct
        FROM merged, win GROUP BY handler),
g AS (SELECT handler, count(*) AS gaps, CAST(sum(t - f + 1) AS BIGINT) AS gap_heights FROM left_over GROUP BY handler),
f AS (SELECT handler, count(*) FILTER (WHERE height % 3 <> 0) AS retrying, count(*) FILTER (WHERE height % 3 = 0) AS permanent,
        CAST(1 + max(height % 4) AS BIGINT) AS max_retries FROM pts GROUP BY handler),
fr AS (SELECT handler, count(*) AS failed_ranges FROM isl GROUP BY handler),
o AS (SELECT p.handler, count(*) AS open_failures FROM pts p
      WHERE NOT EXISTS (SELECT 1 FROM merged m WHERE m.handler = p.handler AND p.height BETWEEN m.f AND m.t) GROUP BY p.handler)
SELECT cov.handler, ranges, covered_start, covered_end, window_pct, chain_pct, coalesce(gaps, 0) AS gaps,
       coalesce(gap_heights, 0) AS gap_heights, coalesce(retrying, 0) AS retrying, coalesce(permanent, 0) AS permanent,
       coalesce(max_retries, 0) AS max_retries, coalesce(failed_ranges, 0) AS failed_ranges, coalesce(open_failures, 0) AS open_failures
FROM cov LEFT JOIN g USING (handler) LEFT JOIN f USING (handler) LEFT JOIN fr USING (handler) LEFT JOIN o USING (handler)""",
)
def coverage_report(spark, sf):
    failures = s.failed_points(spark, sf).select(
        "handler",
        "height",
        (F.col("height") % 3 == 0).alias("permanent"),
        F.lit(False).alias("in_retry"),
        (1 + F.col("height") % 4).cast("int").alias("retries"),
    )
    return coverage.coverage_report(s.ranges(spark, sf), failures, s.windows(spark, sf), 1, 1000, W)


def _order_points(spark, sf):
    return table(spark, sf, "lineitem").select(
        F.col("l_returnflag").alias("handler"), F.col("l_orderkey").alias("height")
    )


_ORDER_POINTS = "op AS (SELECT DISTINCT l_returnflag AS handler, l_orderkey AS height FROM lineitem)"
_ISLAND_SQL = f"WITH {_ORDER_POINTS}, isl AS ({_islands('op')}) SELECT {_OUT} FROM isl"


@query("points_to_islands", _ISLAND_SQL)
def points_to_islands(spark, sf):
    return iv.points_to_islands(_order_points(spark, sf), width=W)


@query(
    "islands_row_number",
    f"WITH {_ORDER_POINTS} SELECT handler, height, row_number() OVER (PARTITION BY handler ORDER BY height) AS rn FROM op",
)
def islands_row_number(spark, sf):
    from chainloom.operators.prefix import row_numbers

    points = _order_points(spark, sf).distinct()
    return row_numbers(points, ["handler"], F.col("height"), ["height"], "rn", W)


@query(
    "range_running_max",
    f"""{_CTE} SELECT handler, f AS from_height, t AS to_height,
  max(t) OVER (PARTITION BY handler ORDER BY f ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach
FROM (SELECT handler, f, max(t) AS t FROM rng GROUP BY handler, f)""",
)
def range_running_max(spark, sf):
    from chainloom.operators.prefix import max_before

    starts = s.ranges(spark, sf).groupBy("handler", "from_height").agg(F.max("to_height").alias("to_height"))
    return max_before(starts, ["handler"], "from_height", "to_height", "reach", W).drop("_bucket")


@query("failure_ranges", f"WITH {s.POINTS_SQL}, isl AS ({_islands('pts')}) SELECT {_OUT} FROM isl")
def failure_ranges(spark, sf):
    return ledger.failure_ranges(s.failed_points(spark, sf))


@query("ranges_by_handler", f"{_CTE} SELECT {_OUT} FROM rng ORDER BY handler, f")
def ranges_by_handler(spark, sf):
    return iv.ranges_by_handler(s.ranges(spark, sf))


@query(
    "prune_outside_window",
    f"""{_CTE}, {s.POINTS_SQL}, half AS (SELECT CAST(floor(hi / 4) AS BIGINT) AS a, CAST(floor(hi * 3 / 4) AS BIGINT) AS b FROM win)
SELECT 'range' AS kind, handler, f AS from_height, t AS to_height FROM rng, half WHERE t >= a AND f <= b
UNION ALL SELECT 'failure', handler, height, height FROM pts, half WHERE height BETWEEN a AND b""",
)
def prune_outside_window(spark, sf):
    quarter = F.floor(F.col("end_height") / 4).cast("bigint")
    three = F.floor(F.col("end_height") * 3 / 4).cast("bigint")
    middle = s.windows(spark, sf).select("handler", quarter.alias("start_height"), three.alias("end_height"))
    kept, failed = iv.prune_outside_window(s.ranges(spark, sf), s.failed_points(spark, sf), middle)
    points = failed.select("handler", F.col("height").alias("from_height"), F.col("height").alias("to_height"))
    return kept.withColumn("kind", F.lit("range")).unionByName(points.withColumn("kind", F.lit("failure")))


@query(
    "failure_heights",
    f"WITH {s.POINTS_SQL} SELECT height FROM pts WHERE handler = 'R-F-3' AND height BETWEEN 100 AND 100000 ORDER BY height",
)
def failure_heights(spark, sf):
    return ledger.failure_heights(s.failed_points(spark, sf), "R-F-3", 100, 100000)


def _requests(spark, sf):
    """One requested range per order; every eleventh is empty (its end lies before its start)."""
    key = F.col("o_orderkey")
    pick = lambda values, c: F.element_at(F.array(*[F.lit(v) for v in values]), (c + 1).cast("int"))
    handler = F.concat_ws(
        "-", pick("ANR", F.col("o_custkey") % 3), pick("FO", F.col("o_custkey") % 2), (key % 7 + 1).cast("string")
    )
    end = F.when(key % 11 == 0, key - 1).otherwise(key + F.col("o_custkey") % 6)
    return table(spark, sf, "orders").select(handler.alias("handler"), key.alias("from_height"), end.alias("to_height"))


_REQUESTS = """req AS (
  SELECT substr('ANR', CAST(o_custkey % 3 + 1 AS INTEGER), 1) || '-' || substr('FO', CAST(o_custkey % 2 + 1 AS INTEGER), 1) || '-' || (o_orderkey % 7 + 1) AS handler,
         o_orderkey AS a, CASE WHEN o_orderkey % 11 = 0 THEN o_orderkey - 1 ELSE o_orderkey + o_custkey % 6 END AS b
  FROM orders)"""


@query(
    "handler_needs_range",
    f"""{_CTE}, {_MERGED}, {_REQUESTS}
SELECT req.handler, a AS from_height, b AS to_height,
       (b >= a AND coalesce(sum(CASE WHEN t IS NOT NULL THEN least(t, b) - greatest(f, a) + 1 END), 0) < b - a + 1) AS needs
FROM req LEFT JOIN merged ON merged.handler = req.handler AND f <= b AND t >= a AND b >= a
GROUP BY req.handler, a, b""",
)
def handler_needs_range(spark, sf):
    return iv.needs_range(s.ranges(spark, sf), _requests(spark, sf), width=W)


@query(
    "range_overlap_join",
    f"""{_CTE}, {_REQUESTS}
SELECT req.handler, a AS from_height, b AS to_height, f AS r_from, t AS r_to
FROM req JOIN rng ON rng.handler = req.handler AND f <= b AND t >= a WHERE b >= a""",
)
def range_overlap_join(spark, sf):
    wanted = _requests(spark, sf).where("to_height >= from_height")
    return iv.range_overlap_join(wanted, s.ranges(spark, sf), salts=2)


@query(
    "fail_range",
    """WITH rng AS (SELECT l_returnflag AS handler, l_orderkey AS f, l_orderkey AS t FROM lineitem),
win AS (SELECT CAST(0 AS BIGINT) AS lo, max(o_orderkey) AS hi FROM orders), """
    + _UNION
    + """, h AS (SELECT unnest(generate_series(f, t)) AS height FROM ugaps)
SELECT x.handler, height, 'no source' AS reason FROM h, (SELECT DISTINCT l_returnflag AS handler FROM lineitem) x""",
)
def fail_range(spark, sf):
    points = _order_points(spark, sf)
    ranges = points.select("handler", F.col("height").alias("from_height"), F.col("height").alias("to_height"))
    handlers = points.select("handler").distinct()
    top = table(spark, sf, "orders").agg(F.max("o_orderkey")).scalar()
    windows = handlers.select("handler", F.lit(0).cast("bigint").alias("start_height"), top.alias("end_height"))
    missing = iv.union_gaps(ranges, windows, width=W)
    return ledger.fail_range(missing, handlers, F.lit("no source")).drop("seq")
