"""Exact decomposition of an NXDOMAIN peak by host, record type or registrable domain."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dnsight.functions import clock, names
from dnsight.functions import predicates as P
from dnsight.functions.measures import count_rows, count_where, first_max, percent
from dnsight.operators.shared import one_row, one_value, with_rank
from dnsight.operators.suffix import SuffixTable, with_registrable
from dnsight.operators.temporal import minute_metrics
from dnsight.sources.storage import stage


def spike_window(
    packets: DataFrame,
    steady: str | None = "drop_edges",
    peak: str | datetime = "packets",
    weight: str | None = None,
) -> DataFrame:
    """One row: steady bounds, number of steady minutes, peak minute, and number of other minutes.

    Packets are read once, for counts per minute; bounds and peak come from these, and both are staged,
    as the window is used several times. Counts that are there already are given with their ``weight``.
    ``peak`` is "packets", "nx" or a minute. The minutes come from the calendar, so minutes without
    NXDOMAIN count for the baseline. ``n_other`` is null when there is no baseline: fewer than two
    minutes, or a peak outside of them.
    """
    if peak not in ("packets", "nx") and not isinstance(peak, datetime):
        raise ValueError(f"unknown peak {peak!r}")
    if weight is None:
        keys = ["qr", "proto", "tc", "rcode"]
        rows = packets.select(clock.minute_floor("dt").alias("minute"), *keys, "dt")
        packets, weight = stage(rows.groupBy("minute", *keys).agg(count_rows().alias("n"), F.min("dt").alias("dt"))), "n"
    metrics = minute_metrics(packets, steady, weight=weight)
    if isinstance(peak, datetime):
        minute = F.lit(peak.replace(second=0, microsecond=0)).cast("timestamp_ntz")
    else:
        minute = first_max(peak, "minute")
    bounds = metrics.agg(
        F.min("minute").alias("first_minute"),
        F.max("minute").alias("last_minute"),
        F.count(F.lit(1)).alias("n_minutes"),
        minute.alias("peak_minute"),
    )
    usable = (F.col("n_minutes") >= 2) & F.col("peak_minute").between(
        F.col("first_minute"), F.col("last_minute")
    )
    return stage(bounds.withColumn("n_other", F.when(usable, F.col("n_minutes") - 1)))


def nx_in_window(
    packets: DataFrame, window: DataFrame, any_direction: bool = False
) -> DataFrame:
    """NXDOMAIN responses of the window with the flag ``at_peak``; none if it has no baseline."""
    usable = F.col("n_other").isNotNull()
    w = one_row(
        window.select(
            F.when(usable, F.col("first_minute")).alias("start"),
            clock.plus_minutes(F.col("last_minute"), 1).alias("end"),
            F.col("peak_minute").alias("peak"),
            clock.plus_minutes(F.col("peak_minute"), 1).alias("peak_end"),
        )
    )
    dt = F.col("dt")
    rows = packets.where(P.is_nxdomain(any_direction) & (dt >= w["start"]) & (dt < w["end"]))
    return rows.withColumn("at_peak", (dt >= w["peak"]) & (dt < w["peak_end"]))


def nx_counts(packets: DataFrame, window: DataFrame) -> DataFrame:
    """NXDOMAIN counts per host, record type and name, at the peak and in the other minutes.

    One scan and one shuffle give all dimensions; missing keys are kept as null. Everything else in
    this module is derived from this table, which has one row per distinct key.
    """
    keys = F.array(
        *[
            F.struct(F.lit(d).alias("dimension"), k.cast("string").alias("key"))
            for d, k in (
                ("host", F.col("dst_ip")),
                ("qtype", F.col("qtype_name")),
                ("name", names.normalised("qname")),
            )
        ]
    )
    rows = nx_in_window(packets, window).select("at_peak", F.inline(keys))
    return rows.groupBy("dimension", "key").agg(
        count_where(F.col("at_peak")).alias("peak_count"),
        count_where(~F.col("at_peak")).alias("other_count"),
    )


def _deltas(counts: DataFrame, window: DataFrame, key: str) -> DataFrame:
    """counts(key, peak_count, other_count) -> delta against the mean of the other minutes."""
    baseline = F.col("other_count") / one_value(window, "n_other")
    return counts.select(F.col(key).alias("group"), "peak_count", baseline.alias("baseline")).where(
        F.col("baseline").isNotNull()
    ).withColumn("delta", F.col("peak_count") - F.col("baseline"))


def spike_delta(
    counts: DataFrame, window: DataFrame, dimension: str = "host", keep_null: bool = False
) -> DataFrame:
    """Peak count minus baseline per host or record type, negative deltas kept.

    One conditional aggregation gave both sides, so groups that occur on one side only need no
    join. Rows without a key are left out unless ``keep_null`` is set.
    """
    part = counts.where(F.col("dimension") == dimension)
    if not keep_null:
        part = part.where(F.col("key").isNotNull())
    return _deltas(part, window, "key")


def spike_delta_domain(counts: DataFrame, window: DataFrame, rules: DataFrame | SuffixTable) -> DataFrame:
    """As ``spike_delta`` by registrable domain of the names."""
    per_name = counts.where((F.col("dimension") == "name") & F.col("key").isNotNull()).select(
        F.col("key").alias("name"), "peak_count", "other_count"
    )
    per_domain = with_registrable(per_name, rules).groupBy("registrable").agg(
        F.sum("peak_count").alias("peak_count"), F.sum("other_count").alias("other_count")
    )
    return _deltas(per_domain, window, "registrable")


def spike_deltas(counts: DataFrame, window: DataFrame, rules: DataFrame | SuffixTable) -> DataFrame:
    """All three decompositions with their dimension name."""
    parts = {
        "host": spike_delta(counts, window, "host"),
        "qtype": spike_delta(counts, window, "qtype"),
        "domain": spike_delta_domain(counts, window, rules),
    }
    result = None
    for name, part in parts.items():
        part = part.select(F.lit(name).alias("dimension"), *part.columns)
        result = part if result is None else result.unionByName(part)
    return result


def _net(counts: DataFrame, window: DataFrame) -> DataFrame:
    """One row: peak, baseline and net increase over all NXDOMAIN, with or without a host."""
    totals = counts.where(F.col("dimension") == "host").agg(
        F.coalesce(F.sum("peak_count"), F.lit(0)).alias("peak_nx"),
        F.coalesce(F.sum("other_count"), F.lit(0)).alias("other_nx"),
        F.max(one_value(window, "n_other")).alias("n_other"),
    )
    baseline = F.coalesce(F.col("other_nx") / F.col("n_other"), F.lit(0.0))
    return totals.select(
        "peak_nx",
        baseline.alias("baseline_per_minute"),
        F.coalesce("n_other", F.lit(0)).alias("n_other_minutes"),
    ).withColumn("net_delta", F.col("peak_nx") - F.col("baseline_per_minute"))


def spike_summary(
    counts: DataFrame,
    window: DataFrame,
    dimension: str = "host",
    empty_share: float | None = 0.0,
) -> DataFrame:
    """Peak, baseline, net increase, and the share of the two largest groups in it.

    Zeros when there are fewer than two steady minutes. ``empty_share`` is the share when there is
    no net increase.
    """
    deltas = spike_delta(counts, window, dimension)
    top2 = deltas.orderBy(F.desc("delta"), F.asc("group")).limit(2).agg(F.sum("delta").alias("t"))
    share = F.when(
        F.col("net_delta") > 0,
        percent(F.coalesce(one_value(top2, "t"), F.lit(0.0)), F.col("net_delta")),
    )
    if empty_share is not None:
        share = share.otherwise(F.lit(float(empty_share)))
    return _net(counts, window).select(
        "peak_nx", "baseline_per_minute", "net_delta", share.alias("top2_share_net_pct"),
        "n_other_minutes",
    )


def spike_reconciliation(counts: DataFrame, window: DataFrame, dimension: str = "host") -> DataFrame:
    """Sum of the deltas beside the net increase, number of negative deltas, and the verdict."""
    sums = spike_delta(counts, window, dimension).agg(
        count_where(F.col("delta") < 0).alias("n_negative"),
        F.coalesce(F.sum("delta"), F.lit(0.0)).alias("sum_delta"),
    ).withColumn("net_delta", one_value(_net(counts, window), "net_delta"))
    tolerance = F.lit(1e-8) + F.lit(1e-10) * F.abs("net_delta")
    return sums.withColumn(
        "reconciled", F.abs(F.col("sum_delta") - F.col("net_delta")) <= tolerance
    )


def top_deltas(deltas: DataFrame, limit: int, letter: str) -> DataFrame:
    """Largest deltas with their labels (H1, H2, ... or R1, R2, ...)."""
    order = [F.desc("delta"), F.asc("group")]
    ranked = with_rank(deltas.orderBy(*order).limit(limit), *order)
    return ranked.withColumn("label", F.concat(F.lit(letter), F.col("rank").cast("string")))


def nx_coverage(counts: DataFrame, dimension: str = "host") -> DataFrame:
    """Share of the NXDOMAIN responses of the window that the 5 and 10 largest hosts hold."""
    part = counts.where(F.col("dimension") == dimension).select(
        "key", (F.col("peak_count") + F.col("other_count")).alias("n")
    )
    order = [F.desc("n"), F.asc("key")]
    top = with_rank(part.where(F.col("key").isNotNull()).orderBy(*order).limit(10), *order)
    total = one_value(part.agg(F.sum("n").alias("t")), "t")
    return top.agg(
        F.coalesce(F.sum(F.when(F.col("rank") <= 5, F.col("n"))), F.lit(0)).alias("n5"),
        F.coalesce(F.sum("n"), F.lit(0)).alias("n10"),
    ).select(
        percent("n5", total, 0.0).alias("cov5"), percent("n10", total, 0.0).alias("cov10")
    )
