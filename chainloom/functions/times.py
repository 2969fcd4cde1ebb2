"""Calendar rules. ``now`` is always an argument, never the clock."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def utc_date(ts: Column) -> Column:
    """Calendar day of a timestamp; the session zone is UTC."""
    return F.to_date(ts)


def format_ddmmyyyy(ts: Column) -> Column:
    return F.date_format(ts, "dd-MM-yyyy")


def add_months_overflow(ts: Column, months: Column) -> Column:
    """Month arithmetic that rolls a missing day over into the next month.

    31 January plus one month is 2 or 3 March, where ``add_months`` would clamp to February.
    """
    first = F.add_months(F.trunc(F.to_date(ts), "MM"), months)
    day = F.date_add(first, F.dayofmonth(ts) - 1)
    within_day = F.unix_micros(ts) - F.unix_micros(F.date_trunc("DAY", ts))
    return F.timestamp_micros(F.unix_micros(day.cast("timestamp")) + within_day)


def expected_slots(chains: DataFrame) -> DataFrame:
    """Monthly slots: genesis + n months for n >= 1, not after ``now``, not before ``earliest``.

    ``chains`` has one row per chain with ``genesis, earliest, now``; a NULL genesis gives no
    slot. Adds ``slot`` and ``slot_date``. The number of months bounds the rows.
    """
    # one month more than the calendar difference covers every day of month
    reach = F.ceil(F.months_between("now", "genesis", False)) + 1
    candidates = (
        chains.where(F.col("genesis").isNotNull())
        .withColumn("n", F.explode(F.sequence(F.lit(1), F.greatest(reach, F.lit(1)).cast("int"))))
        .withColumn("slot", add_months_overflow(F.col("genesis"), F.col("n")))
    )
    return (
        candidates.where((F.col("slot") <= F.col("now")) & (F.col("slot") >= F.col("earliest")))
        .withColumn("slot_date", utc_date(F.col("slot")))
        .drop("n")
    )


def retry_after_seconds(header: Column, now: Column) -> Column:
    """Seconds to wait: integer text, or an HTTP date minus ``now``; else 0."""
    seconds = F.when(header.rlike(r"^[+-]?[0-9]+\z"), header.try_cast("bigint"))
    # weekday names are for readers only; the rest fixes the moment
    imf = F.regexp_extract(header, r"^[A-Za-z]{3}, (\d{2} [A-Za-z]{3} \d{4} \d{2}:\d{2}:\d{2}) GMT\z", 1)
    old = F.regexp_extract(header, r"^[A-Za-z]+, (\d{2}-[A-Za-z]{3}-\d{2} \d{2}:\d{2}:\d{2}) GMT\z", 1)
    ansi = F.regexp_replace(
        F.regexp_extract(
            header, r"^[A-Za-z]{3} ([A-Za-z]{3} [ \d]\d \d{2}:\d{2}:\d{2} \d{4})\z", 1
        ),
        "  ",
        " 0",
    )
    when = F.coalesce(
        F.try_to_timestamp(F.nullif(imf, F.lit("")), F.lit("dd MMM yyyy HH:mm:ss")),
        F.try_to_timestamp(F.nullif(old, F.lit("")), F.lit("dd-MMM-yy HH:mm:ss")),
        F.try_to_timestamp(F.nullif(ansi, F.lit("")), F.lit("MMM dd HH:mm:ss yyyy")),
    )
    wait = (F.unix_micros(when) - F.unix_micros(now)) / F.lit(1e6)
    return F.coalesce(
        F.when(seconds >= 0, seconds.cast("double")),
        F.when(wait > 0, wait),
        F.lit(0.0),
    )
