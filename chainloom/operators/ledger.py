"""Failure ledger, run ledger and denom overlay as whole-batch merges.

Ledgers are keyed tables; each function takes the stored rows and returns the new rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from chainloom.constants import DENOM_SEED, SUPPRESSED_TEST_DENOM
from chainloom.operators.dictionary import dict_encode
from chainloom.operators.intervals import expand_ranges, points_to_islands, range_overlap_join
from chainloom.operators.merge import delete_keys

FAILURE_KEY = ["handler", "height"]


def record_failures(
    ledger: DataFrame, failures: DataFrame, now: Column, max_retries: int = 0
) -> DataFrame:
    """Fold a batch of transient failures into the ledger.

    ``failures`` is ``(handler, height, reason, seq)``; several failures of one height in one
    batch count as several retries and the last reason (by ``seq``) stays. A row that already
    exists (or comes up again inside the batch) turns permanent when its retries reach the cap;
    the first insert never does. Popped rows come back with their counter.
    """
    fresh = failures.groupBy(*FAILURE_KEY).agg(
        F.count(F.lit(1)).cast("int").alias("_n"), F.max_by("reason", "seq").alias("_reason")
    )
    joined = ledger.join(fresh, FAILURE_KEY, "full_outer")
    hit = F.col("_n").isNotNull()
    known = F.col("retries").isNotNull()
    retries = F.coalesce(F.col("retries"), F.lit(0)) + F.coalesce(F.col("_n"), F.lit(0))
    updated = known | (F.col("_n") > 1)
    capped = hit & updated & F.lit(max_retries > 0) & (retries >= max_retries)
    return joined.select(
        *FAILURE_KEY,
        F.when(hit, F.col("_reason")).otherwise(F.col("reason")).alias("reason"),
        retries.cast("int").alias("retries"),
        (capped | F.coalesce(F.col("permanent"), F.lit(False))).alias("permanent"),
        F.coalesce(F.col("first_seen_at"), now).alias("first_seen_at"),
        F.when(hit, now).otherwise(F.col("last_seen_at")).alias("last_seen_at"),
        F.when(capped, F.coalesce(F.col("max_retries_reached_at"), now))
        .otherwise(F.col("max_retries_reached_at"))
        .alias("max_retries_reached_at"),
        F.when(hit, F.lit(False)).otherwise(F.col("in_retry")).alias("in_retry"),
    )


def record_permanent(ledger: DataFrame, failures: DataFrame, now: Column) -> DataFrame:
    """Fold failures that no retry can fix; retries of a known row stay as they are."""
    fresh = failures.groupBy(*FAILURE_KEY).agg(F.max_by("reason", "seq").alias("_reason"), F.lit(True).alias("_hit"))
    joined = ledger.join(fresh, FAILURE_KEY, "full_outer")
    hit = F.coalesce(F.col("_hit"), F.lit(False))
    return joined.select(
        *FAILURE_KEY,
        F.when(hit, F.col("_reason")).otherwise(F.col("reason")).alias("reason"),
        F.coalesce(F.col("retries"), F.lit(1)).alias("retries"),
        (hit | F.coalesce(F.col("permanent"), F.lit(False))).alias("permanent"),
        F.coalesce(F.col("first_seen_at"), now).alias("first_seen_at"),
        F.when(hit, now).otherwise(F.col("last_seen_at")).alias("last_seen_at"),
        F.when(hit, F.coalesce(F.col("max_retries_reached_at"), now))
        .otherwise(F.col("max_retries_reached_at"))
        .alias("max_retries_reached_at"),
        F.when(hit, F.lit(False)).otherwise(F.col("in_retry")).alias("in_retry"),
    )


def fold_failures(log: DataFrame, covered: DataFrame, claimed: DataFrame) -> DataFrame:
    """The ledger as it follows from what was committed; nothing is updated in place.

    ``log`` is ``(handler, height, reason, permanent, max_retries, seq, at)``, ``covered`` the committed ranges
    ``(handler, from_height, to_height, seq)``, ``claimed`` the heights ``(handler, height)`` of open retries. A range
    committed after a failure recovers its heights; later failures start anew. The rules are those of
    :func:`record_failures` and :func:`record_permanent` applied in the order of ``seq``.
    """
    points = log.select("handler", "height").distinct().select(
        "handler", F.col("height").alias("from_height"), F.col("height").alias("to_height")
    )
    recovered = (
        range_overlap_join(points, covered.select("handler", "from_height", "to_height", F.col("seq").alias("_done")))
        .groupBy("handler", F.col("from_height").alias("height"))
        .agg(F.max("_done").alias("_done"))
    )
    standing = log.join(recovered, FAILURE_KEY, "left").where(F.col("_done").isNull() | (F.col("seq") > F.col("_done")))
    so_far = Window.partitionBy(*FAILURE_KEY).orderBy("seq")  # one row per failure of one height
    counts = ~F.col("permanent") | F.col("_first")  # a permanent failure is a try only where it is the first
    tries = standing.withColumn("_first", F.row_number().over(so_far) == 1).withColumn("_n", F.count_if(counts).over(so_far)).withColumn(
        "_final", F.col("permanent") | ((F.col("max_retries") > 0) & (F.col("_n") > 1) & (F.col("_n") >= F.col("max_retries")))
    )
    return (
        tries.groupBy(*FAILURE_KEY)
        .agg(
            F.max_by("reason", "seq").alias("reason"),
            F.max("_n").cast("int").alias("retries"),
            F.bool_or("_final").alias("permanent"),
            F.min_by("at", "seq").alias("first_seen_at"),
            F.max_by("at", "seq").alias("last_seen_at"),
            F.min_by("at", F.when(F.col("_final"), F.col("seq"))).alias("max_retries_reached_at"),
        )
        .join(claimed.distinct().withColumn("_claimed", F.lit(True)), FAILURE_KEY, "left")
        .withColumn("in_retry", F.coalesce("_claimed", F.lit(False)))
        .drop("_claimed")
    )


def fail_range(ranges: DataFrame, handlers: DataFrame, reason: Column) -> DataFrame:
    """One failure per handler and height of the failed ranges, ready to record.

    Every handler of the (code-sized) handler list is written into one array and unrolled next
    to each height.
    """
    names = handlers.agg(F.sort_array(F.collect_set("handler"))).scalar()
    return (
        expand_ranges(ranges.select("from_height", "to_height"))
        .select("height", F.explode(names).alias("handler"))
        .select("handler", "height", reason.alias("reason"), F.lit(0).cast("bigint").alias("seq"))
    )


def pop_failures(ledger: DataFrame, limit: int) -> tuple[DataFrame, DataFrame]:
    """Highest ``limit`` retryable heights per handler, and the ledger with them marked in retry.

    Marked rows keep their counter, so a failing retry continues it and a cap is reached.
    """
    waiting = ledger.where(~F.col("permanent") & ~F.col("in_retry"))
    if limit <= 0:
        return waiting.limit(0).select(*FAILURE_KEY), ledger
    w = Window.partitionBy("handler").orderBy(F.col("height").desc())
    popped = (
        waiting.select(*FAILURE_KEY)
        .withColumn("_rn", F.row_number().over(w))
        .where(F.col("_rn") <= limit)
        .drop("_rn")
    )
    marked = (
        ledger.join(popped.withColumn("_popped", F.lit(True)), FAILURE_KEY, "left")
        .withColumn("in_retry", F.col("in_retry") | F.coalesce(F.col("_popped"), F.lit(False)))
        .select(*ledger.columns)
    )
    return popped, marked


def clear_recovered(ledger: DataFrame, done: DataFrame) -> DataFrame:
    """Drop entries whose height was covered by a later success."""
    return delete_keys(ledger, done, FAILURE_KEY)


def failure_counts(ledger: DataFrame) -> DataFrame:
    """Per handler: waiting and permanent rows, and the highest retry count."""
    return ledger.groupBy("handler").agg(
        F.count_if(~F.col("permanent") & ~F.col("in_retry")).alias("retrying"),
        F.count_if(F.col("permanent")).alias("permanent"),
        F.coalesce(F.max("retries"), F.lit(0)).alias("max_retries"),
    )


def failure_heights(ledger: DataFrame, handler: str, start: int, end: int) -> DataFrame:
    """Failed heights of one handler in a window, ascending."""
    return (
        ledger.where((F.col("handler") == handler) & F.col("height").between(start, end))
        .select("height")
        .orderBy("height")
    )


def failure_ranges(ledger: DataFrame) -> DataFrame:
    """Failed heights as ranges per handler."""
    return points_to_islands(ledger)


# --- run ledger -------------------------------------------------------------------------------


def start_run(runs: DataFrame, run_id: int, now: Column) -> DataFrame:
    """Close every open run at its last heartbeat and append a new one."""
    was_open = F.col("ended_at").isNull()
    closed = runs.withColumns(
        {
            "ended_at": F.when(was_open, F.col("last_heartbeat")).otherwise(F.col("ended_at")),
            "end_reason": F.when(was_open, "interrupted").otherwise(F.col("end_reason")),
        }
    )
    spark = runs.sparkSession
    opened = spark.range(1).select(
        F.lit(run_id).cast("bigint").alias("id"),
        now.alias("started_at"),
        now.alias("last_heartbeat"),
        F.lit(None).cast("timestamp").alias("ended_at"),
        F.lit(0).cast("bigint").alias("blocks_indexed"),
        F.lit(0).cast("bigint").alias("rows_written"),
        F.lit(None).cast("string").alias("end_reason"),
    )
    return closed.unionByName(opened)


def heartbeat(runs: DataFrame, manifest: DataFrame) -> DataFrame:
    """Blocks, rows and last sign of life of runs, summed from the batch manifest.

    ``manifest`` has ``run_id, blocks, rows, committed_at``. Totals are derived, not added to: a run with batches takes
    their sums, so a second heartbeat changes nothing; a run without any keeps what is stored.
    """
    totals = manifest.groupBy(F.col("run_id").alias("id")).agg(
        F.sum("blocks").alias("_blocks"), F.sum("rows").alias("_rows"), F.max("committed_at").alias("_beat")
    )
    return (
        runs.join(totals, "id", "left")
        .withColumns(
            {
                "blocks_indexed": F.coalesce("_blocks", "blocks_indexed"),
                "rows_written": F.coalesce("_rows", "rows_written"),
                "last_heartbeat": F.greatest("last_heartbeat", "_beat"),
            }
        )
        .select(*runs.columns)
    )


def runs_from_manifest(spans: DataFrame, manifest: DataFrame) -> DataFrame:
    """Runs with totals and last sign of life derived from the committed batches that name them.

    ``spans`` holds starts and ends only, so no stored sum can drift or be added twice. A run that a later one
    found open is closed at its last sign of life.
    """
    totals = manifest.where("handler is null and run_id is not null").groupBy(F.col("run_id").alias("id")).agg(
        F.sum("blocks").alias("blocks_indexed"), F.sum("rows").alias("rows_written"), F.max("committed_at").alias("_beat")
    )
    newest = spans.agg(F.max("id")).scalar()
    left_open = F.col("ended_at").isNull() & (F.col("id") < newest)
    beat = F.coalesce(F.greatest("started_at", "_beat"), "started_at")
    return spans.join(totals, "id", "left").select(
        "id",
        "started_at",
        beat.alias("last_heartbeat"),
        F.when(left_open, beat).otherwise(F.col("ended_at")).alias("ended_at"),
        F.coalesce("blocks_indexed", F.lit(0)).cast("bigint").alias("blocks_indexed"),
        F.coalesce("rows_written", F.lit(0)).cast("bigint").alias("rows_written"),
        F.when(left_open, "interrupted").otherwise(F.col("end_reason")).alias("end_reason"),
    )


def end_run(runs: DataFrame, ids: DataFrame, reason: Column, now: Column) -> DataFrame:
    """Close the listed runs; the first end and reason stay."""
    listed = runs.join(ids.select("id").distinct().withColumn("_end", F.lit(True)), "id", "left")
    return listed.withColumns(
        {
            "ended_at": F.when(F.col("_end"), F.coalesce("ended_at", now)).otherwise(F.col("ended_at")),
            "end_reason": F.when(F.col("_end"), F.coalesce("end_reason", reason)).otherwise(F.col("end_reason")),
        }
    ).select(*runs.columns)


def _duration() -> Column:
    end = F.coalesce("ended_at", "last_heartbeat")
    return (F.unix_micros(end) - F.unix_micros("started_at")) / F.lit(1e6)


def run_totals(runs: DataFrame) -> DataFrame:
    """Blocks, rows, seconds, first start and number of all runs."""
    return runs.agg(
        F.coalesce(F.sum("blocks_indexed"), F.lit(0)).alias("total_blocks"),
        F.coalesce(F.sum("rows_written"), F.lit(0)).alias("total_rows"),
        F.coalesce(F.sum(_duration()), F.lit(0.0)).alias("total_seconds"),
        F.min("started_at").alias("first_started_at"),
        F.count(F.lit(1)).alias("total_runs"),
    )


def recent_runs(runs: DataFrame, limit: int) -> DataFrame:
    """Newest runs first with their duration."""
    return (
        runs.withColumn("duration_sec", _duration())
        .withColumn("end_reason", F.coalesce("end_reason", F.lit("")))
        .orderBy(F.col("started_at").desc(), F.col("id").desc())
        .limit(limit)
    )


# --- denom overlay ----------------------------------------------------------------------------


def seed_rows(spark: SparkSession) -> DataFrame:
    """The known denoms and the suppressed test denom as rows."""
    rows = [(r, b, f, c, False, True) for r, b, f, c in DENOM_SEED]
    rows.append((*SUPPRESSED_TEST_DENOM, None, True, False))
    return spark.createDataFrame(
        [(r, b, str(f), c, s, o) for r, b, f, c, s, o in rows],
        "denom string, base_denom string, factor string, coingecko_id string, suppress boolean, refresh boolean",
    ).withColumn("factor", F.col("factor").cast("decimal(38,0)"))


def seed_denom_metadata(
    spark: SparkSession, denoms: DataFrame, metadata: DataFrame, keep_edits: bool = True
) -> tuple[DataFrame, DataFrame]:
    """Dictionary and overlay with the known denoms merged in; safe to run on every start.

    ``keep_edits`` fills only missing fields, so an operator's changes survive a restart; with
    ``False`` display name, factor and price id of known denoms are written again. ``suppress``
    of a stored row and a stored test denom are never touched.
    """
    seed = seed_rows(spark)
    # about 25 rows written in code
    seeded = F.broadcast(seed)
    dictionary = dict_encode(seed, denoms, "denom")
    with_ids = dictionary.withColumnRenamed("value", "denom").join(seeded, "denom").select(
        F.col("id").alias("denom_id"),
        F.col("base_denom").alias("_base"),
        F.col("factor").alias("_factor"),
        F.col("coingecko_id").alias("_cgid"),
        F.col("suppress").alias("_suppress"),
        "refresh",
    )
    joined = metadata.join(with_ids, "denom_id", "full_outer")
    overwrite = F.coalesce(F.col("refresh"), F.lit(False)) & F.lit(not keep_edits)
    fresh = F.col("suppress").isNull()

    def merged(stored: str, seeded_name: str) -> Column:
        fill = fresh | F.coalesce(F.col("refresh"), F.lit(False))
        return F.when(overwrite, F.col(seeded_name)).otherwise(
            F.coalesce(F.col(stored), F.when(fill, F.col(seeded_name)))
        )

    overlay = joined.select(
        "denom_id",
        merged("base_denom", "_base").alias("base_denom"),
        merged("factor", "_factor").cast("decimal(38,0)").alias("factor"),
        merged("coingecko_id", "_cgid").alias("coingecko_id"),
        F.coalesce("suppress", "_suppress").alias("suppress"),
    )
    return dictionary, overlay


def overlay_update(metadata: DataFrame, denoms: DataFrame, edits: DataFrame) -> DataFrame:
    """Operator edits by raw denom: non-NULL ``coingecko_id`` / ``suppress`` replace the stored ones."""
    keyed = edits.join(denoms.withColumnRenamed("value", "denom"), "denom").select(
        F.col("id").alias("denom_id"),
        F.col("coingecko_id").alias("_cgid"),
        F.col("suppress").alias("_suppress"),
    )
    return metadata.join(keyed, "denom_id", "left").select(
        "denom_id",
        "base_denom",
        "factor",
        F.coalesce("_cgid", "coingecko_id").alias("coingecko_id"),
        F.coalesce("_suppress", "suppress").alias("suppress"),
    )
