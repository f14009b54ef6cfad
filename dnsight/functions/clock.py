"""Event time and minute expressions on TIMESTAMP_NTZ columns that hold UTC.

Nothing here depends on the session time zone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MINUTE = "1 minute"


def minute_bucket(time: str = "dt") -> Column:
    """Start of the minute as a grouping column.

    Tumbling windows compile to integer arithmetic, the cheapest minute floor there is. Spark drops
    rows without a time here, which is what a minute table wants.
    """
    return F.window(time, MINUTE)["start"]


def minute_floor(time: Column | str) -> Column:
    """Start of the minute; a missing time stays null and the row is kept."""
    time = F.col(time) if isinstance(time, str) else time
    return time - F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.extract(F.lit("SECOND"), time))


def minute_ceil(time: Column | str) -> Column:
    time = F.col(time) if isinstance(time, str) else time
    floor = minute_floor(time)
    return F.when(floor == time, floor).otherwise(plus_minutes(floor, 1))


def plus_minutes(time: Column, minutes: int) -> Column:
    return time + F.expr(f"INTERVAL '{minutes}' MINUTE")


def seconds_between(start: Column | str, end: Column | str) -> Column:
    """Seconds as double; plain interval arithmetic, so no time zone is involved."""
    start = F.col(start) if isinstance(start, str) else start
    end = F.col(end) if isinstance(end, str) else end
    return (end - start).cast("interval second").cast("decimal(20,6)").cast("double")


def hhmm(time: Column | str) -> Column:
    return F.date_format(time, "HH:mm")


def iso_text(time: Column | str) -> Column:
    return F.date_format(time, "yyyy-MM-dd'T'HH:mm:ss")


def from_epoch(seconds: Column | str) -> Column:
    """Epoch seconds (double, microsecond precision) as UTC wall time."""
    seconds = F.col(seconds) if isinstance(seconds, str) else seconds
    micros = F.floor(seconds * F.lit(1_000_000.0) + F.lit(0.5))
    return F.timestamp_add(
        "MICROSECOND", micros, F.expr("TIMESTAMP_NTZ '1970-01-01 00:00:00'")
    )


def from_iso(text: Column | str) -> Column:
    """ISO-8601 text as UTC wall time; no offset means UTC, unreadable text gives null."""
    text = F.col(text) if isinstance(text, str) else text
    text = text.cast("string")
    has_zone = text.rlike(r"(?i)(z|[+-]\d{2}(:?\d{2})?)\s*$") & text.contains(":")
    instant = F.when(has_zone, text).try_cast("timestamp")
    zoned = F.timestamp_add(
        "MICROSECOND", F.unix_micros(instant), F.expr("TIMESTAMP_NTZ '1970-01-01 00:00:00'")
    )
    return F.when(has_zone, zoned).otherwise(text.try_cast("timestamp_ntz"))


def with_event_time(df: DataFrame, name: str = "dt") -> DataFrame:
    """Add the event time: from ``ts`` when the table has it, else from ``ts_iso``."""
    if "ts" in df.columns:
        return df.withColumn(name, from_epoch("ts"))
    if "ts_iso" in df.columns:
        return df.withColumn(name, from_iso("ts_iso"))
    raise ValueError("the packet table needs a ts or a ts_iso column")
