"""One scan of the packets by grouping sets, from which the sections of the report are cut.

One set counts by minute and header values, the other by minute and client network. Both are as small
as the minutes, header values and networks are; packets are read once and not expanded by more.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dnsight.functions import address, clock
from dnsight.functions import predicates as P
from dnsight.functions.measures import count_rows
from dnsight.operators.concentration import pareto_of_top, series_of_counts
from dnsight.operators.priority import profile_of_minutes
from dnsight.operators.shared import one_value

HEADER = ["minute", "qr", "proto", "tc", "rcode", "qtype_name"]
SOURCE = ["minute", "qr", "nx", "prefix"]


def packet_cube(packets: DataFrame) -> DataFrame:
    """Counts n with first and last event time per HEADER and per SOURCE values; `set` tells which.

    The client is the source of a query and the destination of a response. ``prefix`` is null for
    messages without a client address.
    """
    client = F.when(P.is_query(), F.col("src_ip")).when(P.is_response(), F.col("dst_ip"))
    rows = packets.select(
        clock.minute_floor("dt").alias("minute"), *HEADER[1:], P.is_nxdomain().alias("nx"),
        F.when(client.isNotNull(), address.network_prefix(client)).alias("prefix"), "dt",
    )
    keys = [*HEADER, "nx", "prefix"]
    cube = rows.groupingSets([HEADER, SOURCE], *keys).agg(
        F.count(F.lit(1)).alias("n"), F.min("dt").alias("dt"), F.max("dt").alias("last_dt"),
        F.when(F.grouping("prefix") == 1, "header").otherwise("source").alias("set"),
    )
    return cube.select("set", *keys, "n", "dt", "last_dt")


def header_counts(cube: DataFrame) -> DataFrame:
    """What ``traffic.traffic_rollup`` gives."""
    return cube.where(F.col("set") == "header").select(*HEADER, "n", "dt", "last_dt")


def source_counts(cube: DataFrame, window: DataFrame | None = None) -> DataFrame:
    """n per minute, direction, NXDOMAIN and known client network, in the minutes of a window."""
    rows = cube.where((F.col("set") == "source") & F.col("prefix").isNotNull())
    if window is not None:
        first, last = one_value(window, "first_minute"), one_value(window, "last_minute")
        rows = rows.where(F.col("minute").between(first, last))
    return rows.select(*SOURCE, "n")


def _sum_where(condition: Column, name: str) -> Column:
    return F.coalesce(F.sum(F.when(condition, F.col("n"))), F.lit(0)).alias(name)


def source_profile(cube: DataFrame, window: DataFrame) -> DataFrame:
    """What ``priority.source_profile`` gives."""
    sources = source_counts(cube, window)
    per_minute = sources.groupBy("prefix", "minute").agg(
        _sum_where(P.is_query(), "query"), _sum_where(P.is_response(), "responses"),
        _sum_where(P.is_response() & F.col("nx"), "nxdomain"),
    )
    total = one_value(sources.where(P.is_query()).agg(F.sum("n").alias("t")), "t")
    return profile_of_minutes(per_minute, total)


def pareto_top(cube: DataFrame, top: int = 10) -> DataFrame:
    """What ``concentration.pareto_top`` gives."""
    counts = source_counts(cube).where(P.is_query()).groupBy("prefix").agg(F.sum("n").alias("total_query"))
    counts = counts.orderBy(F.desc("total_query"), F.asc("prefix")).limit(top)
    total = header_counts(cube).where(P.is_query()).agg(count_rows("n").alias("t"))
    return pareto_of_top(counts, one_value(total, "t"))


def top_series(cube: DataFrame, window: DataFrame, top: int = 3) -> DataFrame:
    """What ``concentration.top_series`` gives."""
    counts = source_counts(cube, window).where(P.is_query()).groupBy("minute", "prefix").agg(F.sum("n").alias("queries"))
    return series_of_counts(counts, window, top)
