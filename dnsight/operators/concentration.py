"""Who sends the queries: prefix rankings, drill-down into the largest source, share over time."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dnsight.functions import address, clock, names
from dnsight.functions import predicates as P
from dnsight.functions.measures import count_rows, count_where, first_max, percent
from dnsight.operators.shared import (
    one_value, ranked_running_total, running_totals, top_counts, with_rank,
)
from dnsight.operators.temporal import calendar, in_window, minute_metrics, steady_window

SOURCE = "src_ip"


def query_prefixes(packets: DataFrame) -> DataFrame:
    """Queries with a source address, and the network prefix of it.

    The missing addresses are left out by a test of the address itself. The prefix is then never
    null, so no null test on it is pushed down and it is computed once per row.
    """
    rows = packets.where(P.is_query() & F.col(SOURCE).isNotNull())
    return rows.withColumn("prefix", address.network_prefix(SOURCE))


def total_queries(packets: DataFrame) -> Column:
    """All queries, with or without a source, as a scalar; reads the direction column only."""
    return one_value(packets.where(P.is_query()).agg(count_rows().alias("t")), "t")


def pareto_top(packets: DataFrame, top: int = 10) -> DataFrame:
    """Largest source prefixes with share of all queries, running share and label S1, S2, ...

    The running sum is formed after the limit, over ``top`` rows.
    """
    counts = top_counts(query_prefixes(packets), "prefix", top, "total_query")
    return pareto_of_top(counts, total_queries(packets))


def pareto_of_top(counts: DataFrame, total: Column) -> DataFrame:
    """As ``pareto_top``, from the already limited counts (prefix, total_query)."""
    ranked = with_rank(counts, F.desc("total_query"), F.asc("prefix"))
    share = ranked.withColumn("share_pct", percent("total_query", total))
    running = Window.orderBy("rank").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return share.select(
        "rank",
        "prefix",
        F.concat(F.lit("S"), "rank").alias("label"),
        "total_query",
        "share_pct",
        F.sum("share_pct").over(running).alias("cumulative_pct"),
    )


def ranking_tiers(counts: DataFrame, key: str, value: str) -> tuple[DataFrame, list]:
    """Order of a full ranking (value descending, key ascending) split into four tiers.

    Magnitude (at most 63), value, key stem up to the second separator, key. The stem keeps the
    text order, and one stem holds at most 65,536 IPv6 or 256 IPv4 networks, so even a value that
    a third of all prefixes share is spread over many small groups.
    """
    stem = F.coalesce(
        F.nullif(F.regexp_extract(key, r"^([^:.]*[:.][^:.]*[:.])", 1), F.lit("")), F.col(key)
    )
    tiered = counts.withColumns(
        {"magnitude": F.length(F.bin(F.col(value))), "stem": stem}
    )
    return tiered, [("magnitude", "desc"), (value, "desc"), ("stem", "asc"), (key, "asc")]


def _pareto_columns(
    ranked: DataFrame, key: str, value: str, rank: Column, before: Column, total: Column
) -> DataFrame:
    running = F.round(percent(before + F.col(value), total), 3)
    return ranked.select(
        rank.cast("bigint").alias("prefix_rank"),
        key,
        value,
        F.round(percent(value, total), 3).alias("share_pct"),
        running.alias("cumulative_share_pct"),
    ).withColumn("is_pareto_top_80", F.col("cumulative_share_pct") <= 80.0)


def pareto_full(counts: DataFrame, key: str = "prefix", value: str = "query_count") -> DataFrame:
    """Complete ranking of network prefixes: rank, share, running share, top-80 flag.

    No window holds the whole ranking: see ``running_totals``.
    """
    known = counts.where(F.col(key).isNotNull())
    total = one_value(known.agg(F.sum(value).alias("t")), "t")
    tiered, tiers = ranking_tiers(known, key, value)
    ranked = running_totals(tiered.withColumn("rows", F.lit(1)), tiers, ["rows", value])
    return _pareto_columns(
        ranked, key, value, F.col("before_rows") + 1, F.col(f"before_{value}"), total
    )


def pareto_full_any_key(
    counts: DataFrame, key: str, value: str = "query_count", partitions: int | None = None
) -> DataFrame:
    """As ``pareto_full`` for keys of any shape, such as names; stages the sorted counts."""
    known = counts.where(F.col(key).isNotNull())
    ranked = ranked_running_total(known, value, F.desc(value), F.asc(key), partitions=partitions)
    total = one_value(ranked.agg(F.sum(value).alias("t")), "t")
    return _pareto_columns(ranked, key, value, F.col("position"), F.col("before"), total)


def prefix_counts(packets: DataFrame) -> DataFrame:
    """Queries per source prefix."""
    return query_prefixes(packets).groupBy("prefix").agg(count_rows().alias("query_count"))


def top_by_pattern(packets: DataFrame, top: int = 10) -> DataFrame:
    """Largest sources by the address pattern (see ``prefix_by_pattern`` for what it matches)."""
    rows = packets.where(P.is_query() & F.col(SOURCE).isNotNull()).select(
        address.prefix_by_pattern(SOURCE).alias("prefix_48")
    )
    return top_counts(rows, "prefix_48", top, "query_count")


def source_summary(packets: DataFrame, top: int = 10) -> DataFrame:
    """Distinct query sources and prefixes, and the share of the largest prefixes.

    Addresses are counted once and then rolled up to prefixes, so there is one shuffle of
    pre-aggregated addresses instead of two distinct counts over the packets.
    """
    per_ip = packets.where(P.is_query() & F.col(SOURCE).isNotNull()).groupBy(SOURCE).agg(
        count_rows().alias("n")
    )
    per_prefix = per_ip.groupBy(address.network_prefix_or_text(SOURCE).alias("prefix")).agg(
        F.sum("n").alias("n"), count_rows().alias("addresses")
    )
    largest = per_prefix.orderBy(F.desc("n"), F.asc("prefix")).limit(top)
    top_sum = one_value(largest.agg(F.sum("n").alias("t")), "t")
    return per_prefix.agg(
        F.coalesce(F.sum("addresses"), F.lit(0)).alias("distinct_addresses"),
        count_rows().alias("distinct_prefixes"),
    ).withColumn("top_share_pct", percent(top_sum, total_queries(packets)))


# --- largest source ------------------------------------------------------------------------------


def top_prefix(packets: DataFrame) -> DataFrame:
    """One row: the prefix with the most queries."""
    return top_counts(query_prefixes(packets), "prefix", 1, "queries")


def _top_source_queries(packets: DataFrame) -> DataFrame:
    top = one_value(top_prefix(packets), "prefix")
    return query_prefixes(packets).where(F.col("prefix") == top).drop("prefix")


def top_source_domains(packets: DataFrame, limit: int = 5) -> DataFrame:
    """Most queried names of the largest source, share of its queries."""
    rows = _top_source_queries(packets).withColumn("domain", names.normalised("qname"))
    total = one_value(top_prefix(packets), "queries")
    return top_counts(rows, "domain", limit).withColumn("pct", percent("count", total))


def top_source_types(packets: DataFrame, limit: int = 5) -> DataFrame:
    """Most queried record types of the largest source, share of its queries."""
    total = one_value(top_prefix(packets), "queries")
    return top_counts(_top_source_queries(packets), "qtype_name", limit).withColumn(
        "pct", percent("count", total)
    )


def top_source_summary(packets: DataFrame) -> DataFrame:
    """One row about the largest source: volume, share, cd share, share of its three top names."""
    rows = _top_source_queries(packets)
    top3 = one_value(
        top_source_domains(packets, 3).agg(F.sum("count").alias("t")), "t"
    )
    counts = rows.agg(
        count_rows().alias("queries"), count_where(F.col("cd") == 1).alias("cd")
    )
    return counts.select(
        one_value(top_prefix(packets), "prefix").alias("prefix"),
        "queries",
        percent("queries", total_queries(packets)).alias("share_pct"),
        percent("cd", "queries").alias("cd_pct"),
        percent(top3, F.col("queries"), 0.0).alias("top3_domain_pct"),
    )


def dominant_domain_source(packets: DataFrame) -> DataFrame:
    """How much of the most queried name comes from the largest source."""
    named = packets.where(P.is_query() & F.col("qname").isNotNull()).withColumn(
        "domain", names.normalised("qname")
    )
    top = top_counts(named, "domain", 1, "queries")
    prefix = one_value(top_prefix(packets), "prefix")
    from_top = F.coalesce(
        F.col(SOURCE).isNotNull() & (address.network_prefix(SOURCE) == prefix), F.lit(False)
    )
    picked = named.where(F.col("domain") == one_value(top, "domain")).agg(
        count_where(from_top).alias("n")
    )
    return top.select(
        "domain", "queries", one_value(picked, "n").alias("queries_from_top"),
    ).withColumn("share_pct", percent("queries_from_top", "queries", 0.0))


# --- sources over time ---------------------------------------------------------------------------


def minute_source_counts(packets: DataFrame, steady: str | None = "drop_edges") -> DataFrame:
    """Steady-state queries per minute and source prefix."""
    window = steady_window(packets, steady)
    rows = query_prefixes(packets).where(in_window(window))
    rows = rows.withColumn("minute", clock.minute_bucket("dt"))
    return rows.groupBy("minute", "prefix").agg(count_rows().alias("queries"))


def top_share_per_minute(packets: DataFrame, steady: str | None = "drop_edges") -> DataFrame:
    """Share of the overall largest prefix in every steady minute; null where there is no query."""
    window = steady_window(packets, steady)
    top = one_value(top_prefix(packets), "prefix")
    rows = packets.where(P.is_query() & in_window(window))
    rows = rows.withColumn("minute", clock.minute_bucket("dt"))
    from_top = F.col(SOURCE).isNotNull() & (address.network_prefix(SOURCE) == top)
    counts = rows.groupBy("minute").agg(
        count_rows().alias("queries"), count_where(from_top).alias("top_queries")
    )
    joined = calendar(window).join(counts, "minute", "left")
    return joined.select(
        "minute",
        F.coalesce("queries", F.lit(0)).alias("queries"),
        F.coalesce("top_queries", F.lit(0)).alias("top_queries"),
        percent("top_queries", "queries").alias("share_pct"),
    )


def top_share_summary(shares: DataFrame) -> DataFrame:
    """Minimum, median and maximum of the minute shares, and the minutes above one half."""
    return shares.agg(
        F.min("share_pct").alias("min_pct"),
        F.median("share_pct").alias("median_pct"),
        F.max("share_pct").alias("max_pct"),
        count_where(F.col("share_pct") > 50).alias("minutes_above_half"),
    )


def peak_minute(packets: DataFrame, steady: str | None = "drop_edges") -> DataFrame:
    """One row: the steady minute with the most packets."""
    metrics = minute_metrics(packets, steady)
    return metrics.agg(first_max("packets", "minute").alias("peak_minute"))


def at_peak(packets: DataFrame, steady: str | None = "drop_edges") -> DataFrame:
    """Packets of the peak minute; the half-open time range reaches the Parquet scan."""
    peak = one_value(peak_minute(packets, steady), "peak_minute")
    return packets.where((F.col("dt") >= peak) & (F.col("dt") < clock.plus_minutes(peak, 1)))


def peak_sources(
    packets: DataFrame, limit: int = 3, steady: str | None = "drop_edges"
) -> DataFrame:
    """Largest query sources of the peak minute."""
    return top_counts(query_prefixes(at_peak(packets, steady)), "prefix", limit, "queries")


def peak_types(packets: DataFrame, limit: int = 3, steady: str | None = "drop_edges") -> DataFrame:
    """Most queried record types of the peak minute."""
    rows = at_peak(packets, steady).where(P.is_query())
    return top_counts(rows, "qtype_name", limit, "queries")


def peak_profile(packets: DataFrame, steady: str | None = "drop_edges") -> DataFrame:
    """One row about the peak minute, compared with the other minutes and the whole record."""
    metrics = minute_metrics(packets, steady)
    peak = one_value(peak_minute(packets, steady), "peak_minute")
    others = metrics.agg(
        F.coalesce(
            F.median(F.when(F.col("minute") != peak, F.col("packets"))), F.median("packets")
        ).alias("m")
    )
    top = top_prefix(packets)
    prefix = one_value(top, "prefix")
    from_top = F.col(SOURCE).isNotNull() & (address.network_prefix(SOURCE) == prefix)
    counts = at_peak(packets, steady).agg(
        count_rows().alias("packets"),
        count_where(P.is_query()).alias("queries"),
        count_where(P.is_response()).alias("responses"),
        count_where(P.is_nxdomain()).alias("nx"),
        count_where(P.is_query() & from_top).alias("top_queries"),
    )
    return counts.select(
        peak.alias("peak_minute"),
        "packets",
        "queries",
        "responses",
        "nx",
        percent("nx", "responses", 0.0).alias("nx_rate"),
        (F.col("packets") / F.nullif(one_value(others, "m"), F.lit(0.0))).alias("ratio_to_median"),
        percent("top_queries", "queries", 0.0).alias("top_share_peak_pct"),
        percent(one_value(top, "queries"), total_queries(packets)).alias("top_share_overall_pct"),
    )


def top_series(
    packets: DataFrame, top: int = 3, steady: str | None = "drop_edges"
) -> DataFrame:
    """Queries per steady minute of the largest prefixes, long form, zero where none came."""
    return series_of_counts(minute_source_counts(packets, steady), steady_window(packets, steady), top)


def series_of_counts(counts: DataFrame, window: DataFrame, top: int = 3) -> DataFrame:
    """As ``top_series``, from the queries per minute and prefix of the window."""
    totals = counts.groupBy("prefix").agg(F.sum("queries").alias("total"))
    largest = with_rank(
        totals.orderBy(F.desc("total"), F.asc("prefix")).limit(top),
        F.desc("total"), F.asc("prefix"),
    ).select("rank", "prefix")
    # `top` rows beside every minute of the calendar: both sides bounded by the parameters.
    wanted = calendar(window).withColumn("rank", F.explode(F.sequence(F.lit(1), F.lit(top))))
    wanted = wanted.join(F.broadcast(largest), "rank", "inner")
    return wanted.join(counts, ["minute", "prefix"], "left").select(
        "minute", "rank", "prefix", F.coalesce("queries", F.lit(0)).alias("queries")
    )


def top_series_wide(series: DataFrame, top: int = 3) -> DataFrame:
    """One column per rank (s1, s2, ...); the ranks are known, so the pivot needs no extra job."""
    return series.groupBy("minute").agg(
        *[
            F.coalesce(F.sum(F.when(F.col("rank") == r, F.col("queries"))), F.lit(0)).alias(f"s{r}")
            for r in range(1, top + 1)
        ]
    )


def series_peaks(series: DataFrame) -> DataFrame:
    """Peak minute and peak count of every series; the earliest minute wins a tie."""
    return series.groupBy("rank", "prefix").agg(
        first_max("queries", "minute").alias("peak_minute"),
        F.max("queries").alias("peak_queries"),
    )
