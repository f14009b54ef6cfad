"""Per-minute load, error and truncation tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dnsight.functions import clock
from dnsight.functions import predicates as P
from dnsight.functions.measures import count_rows, count_where, first_max, percent
from dnsight.operators.shared import one_row, one_value

COUNTS = ["packets", "queries", "responses", "nx", "udp_resp", "udp_tc", "tcp_packets"]

# Steady-state rules: "drop_edges" leaves out the first and last minute when there are more than
# two, "full_minutes" keeps the minutes that lie wholly inside the record, None keeps all.
STEADY_RULES = ("drop_edges", "full_minutes", None)


def minute_counts(
    packets: DataFrame, any_direction: bool = False, weight: str | None = None
) -> DataFrame:
    """Counts per non-empty minute, in one pass."""
    minutes = (
        packets if "minute" in packets.columns
        else packets.withColumn("minute", clock.minute_bucket("dt"))
    )
    aggregates = [
        count_rows(weight).alias("packets"),
        count_where(P.is_query(), weight).alias("queries"),
        count_where(P.is_response(), weight).alias("responses"),
        count_where(P.is_nxdomain(any_direction), weight).alias("nx"),
        count_where(P.is_udp_response(), weight).alias("udp_resp"),
        count_where(P.is_truncated_udp(), weight).alias("udp_tc"),
        count_where(F.col("proto") == "tcp", weight).alias("tcp_packets"),
    ]
    if "frame_len" in minutes.columns:
        aggregates.append(F.sum("frame_len").alias("frame_bytes"))
    return minutes.groupBy("minute").agg(*aggregates)


def steady_window(packets: DataFrame, steady: str | None = "drop_edges") -> DataFrame:
    """One row: first_minute, last_minute, n_minutes of the steady part of the record.

    The steady minutes are a contiguous range, so membership is a range test on the event time.
    """
    if steady not in STEADY_RULES:
        raise ValueError(f"unknown steady rule {steady!r}")
    edges = packets.agg(F.min("dt").alias("lo"), F.max("dt").alias("hi"))
    first, last = clock.minute_floor("lo"), clock.minute_floor("hi")
    if steady == "drop_edges":
        has_inner = last > clock.plus_minutes(first, 1)
        bounds = edges.select(
            F.when(has_inner, clock.plus_minutes(first, 1)).otherwise(first).alias("first_minute"),
            F.when(has_inner, clock.plus_minutes(last, -1)).otherwise(last).alias("last_minute"),
        )
    elif steady == "full_minutes":
        bounds = edges.select(
            clock.minute_ceil("lo").alias("first_minute"),
            clock.plus_minutes(last, -1).alias("last_minute"),
        )
    else:
        bounds = edges.select(first.alias("first_minute"), last.alias("last_minute"))
    seconds = clock.seconds_between("first_minute", "last_minute")
    minutes = F.round(seconds / 60).cast("bigint") + 1
    return bounds.withColumn("n_minutes", F.greatest(minutes, F.lit(0).cast("bigint")))


def calendar(window: DataFrame) -> DataFrame:
    """Every minute from first_minute to last_minute; days first, so no array gets long."""
    day = F.expr("INTERVAL '1' DAY")
    days = window.where("first_minute <= last_minute").select(
        "first_minute",
        "last_minute",
        F.explode(
            F.sequence(
                F.col("first_minute"),
                F.col("last_minute"),
                day,
            )
        ).alias("start"),
    )
    until = F.least(F.col("last_minute"), clock.plus_minutes(F.col("start"), 24 * 60 - 1))
    return days.select(
        F.explode(F.sequence(F.col("start"), until, F.expr("INTERVAL '1' MINUTE"))).alias("minute")
    )


def in_window(window: DataFrame, time: str = "dt") -> Column:
    """Event time inside the minutes of a ``steady_window`` row."""
    first = one_value(window, "first_minute")
    last = one_value(window, "last_minute")
    return (F.col(time) >= first) & (F.col(time) < clock.plus_minutes(last, 1))


def fill_minutes(counts: DataFrame, window: DataFrame, columns: list[str]) -> DataFrame:
    """Dense minutes: left join on the calendar, zero where nothing was counted."""
    joined = calendar(window).join(counts, "minute", "left")
    return joined.select("minute", *[F.coalesce(F.col(c), F.lit(0)).alias(c) for c in columns])


def minute_metrics(
    packets: DataFrame,
    steady: str | None = "drop_edges",
    empty_rate: float | None = 0.0,
    any_direction: bool = False,
    weight: str | None = None,
) -> DataFrame:
    """Dense minute table with NXDOMAIN rate and truncation ratio.

    A minute without packets has count 0 and rate ``empty_rate``.
    """
    columns = ["packets", "queries", "responses", "nx", "udp_resp", "udp_tc"]
    dense = fill_minutes(
        minute_counts(packets, any_direction, weight), steady_window(packets, steady), columns
    )
    return dense.select(
        "minute",
        *columns,
        percent("nx", "responses", empty_rate).alias("nx_rate"),
        percent("udp_tc", "udp_resp", empty_rate).alias("tc_ratio"),
    ).orderBy("minute")


def minute_metrics_extended(packets: DataFrame, steady: str | None = "full_minutes") -> DataFrame:
    """Minute table with TCP share and throughput; rates of an empty minute are null."""
    columns = [*COUNTS, "frame_bytes"]
    dense = fill_minutes(minute_counts(packets), steady_window(packets, steady), columns)
    return dense.select(
        "minute",
        *COUNTS,
        percent("nx", "responses").alias("nx_rate"),
        percent("udp_tc", "udp_resp").alias("tc_ratio"),
        percent("tcp_packets", "packets").alias("tcp_ratio"),
        (F.col("frame_bytes") / F.lit(1048576.0)).alias("throughput_mib"),
    ).orderBy("minute")


def minute_summary(metrics: DataFrame) -> DataFrame:
    """One row about a minute table: size, peaks (earliest minute wins), overall rates, median.

    ``tc_ratio_peak_minute`` and ``nx_rate_peak_minute`` use the ratio instead of the count.
    """
    peak = one_value(metrics.agg(first_max("packets", "minute").alias("peak_minute")), "peak_minute")
    nx_rate = F.coalesce(F.col("nx_rate"), F.lit(-1.0))
    tc_ratio = F.coalesce(F.col("tc_ratio"), F.lit(-1.0))
    others = F.when(F.col("minute") != peak, F.col("packets"))
    return metrics.agg(
        F.count(F.lit(1)).alias("n_minutes"),
        first_max("packets", "minute").alias("peak_minute"),
        first_max("nx", "minute").alias("nx_peak_minute"),
        first_max("udp_tc", "minute").alias("tc_peak_minute"),
        first_max(nx_rate, F.col("minute")).alias("nx_rate_peak_minute"),
        first_max(tc_ratio, F.col("minute")).alias("tc_ratio_peak_minute"),
        percent(F.sum("nx"), F.sum("responses"), 0.0).alias("nx_rate_global"),
        percent(F.sum("udp_tc"), F.sum("udp_resp"), 0.0).alias("tc_ratio_avg"),
        F.coalesce(F.median(others), F.median("packets")).alias("median_other"),
    )


def minute_statistics(metrics: DataFrame, columns: list[str]) -> DataFrame:
    """count, mean, std, min, quartiles and max of minute columns, one row per column."""
    pairs = [
        F.struct(F.lit(c).alias("metric"), F.col(c).cast("double").alias("value")) for c in columns
    ]
    long = metrics.select(F.explode(F.array(*pairs)).alias("p")).select("p.metric", "p.value")
    quartiles = F.percentile("value", F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75)))
    stats = long.groupBy("metric").agg(
        F.count("value").alias("count"),
        F.avg("value").alias("mean"),
        F.stddev_samp("value").alias("std"),
        F.min("value").alias("min"),
        quartiles.alias("q"),
        F.max("value").alias("max"),
    )
    return stats.select(
        "metric", "count", "mean", "std", "min",
        F.col("q")[0].alias("p25"), F.col("q")[1].alias("p50"), F.col("q")[2].alias("p75"), "max",
    )


def nx_rates(packets: DataFrame, steady: str | None = "full_minutes") -> DataFrame:
    """NXDOMAIN rate per steady minute beside the overall rate, and both as "one in N"."""
    metrics = minute_metrics(packets, steady, empty_rate=None)
    overall = one_row(
        packets.agg(
            percent(count_where(P.is_nxdomain()), count_where(P.is_response())).alias("nx_rate")
        )
    )
    truncation = one_row(
        metrics.agg(percent(F.sum("udp_tc"), F.sum("udp_resp")).alias("tc_ratio"))
    )
    return metrics.select(
        "minute",
        "nx",
        "responses",
        "nx_rate",
        overall["nx_rate"].alias("nx_rate_global"),
        (F.col("nx_rate") - overall["nx_rate"]).alias("nx_rate_difference"),
        F.coalesce(F.lit(100.0) / F.nullif(overall["nx_rate"], F.lit(0.0)), F.lit(0.0)).alias(
            "nx_one_in"
        ),
        F.coalesce(F.lit(100.0) / F.nullif(truncation["tc_ratio"], F.lit(0.0)), F.lit(0.0)).alias(
            "tc_one_in"
        ),
    )
