"""Which sources need attention: load and error priorities, bubble set, labels."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dnsight.functions import address, clock
from dnsight.functions import predicates as P
from dnsight.functions.measures import count_rows, count_where, percent
from dnsight.operators.shared import one_value, ranked_running_total, with_rank
from dnsight.operators.temporal import in_window, steady_window


def source_profile(packets: DataFrame, steady: str | None = "drop_edges") -> DataFrame:
    """Steady-state profile per prefix: queries it sent, minutes it was active, responses it got.

    The client is the source of a query and the destination of a response, so one conditional
    column gives the prefix of both and a single aggregation replaces the outer join of two
    tables. Counting (prefix, minute) first keeps the distinct minutes free of skew.
    """
    window = steady_window(packets, steady)
    has_client = (P.is_query() & F.col("src_ip").isNotNull()) | (
        P.is_response() & F.col("dst_ip").isNotNull()
    )
    client = F.when(P.is_query(), F.col("src_ip")).otherwise(F.col("dst_ip"))
    rows = packets.where(in_window(window) & has_client).withColumns(
        {"prefix": address.network_prefix(client), "minute": clock.minute_bucket("dt")}
    )
    per_minute = rows.groupBy("prefix", "minute").agg(
        count_where(P.is_query()).alias("query"),
        count_where(P.is_response()).alias("responses"),
        count_where(P.is_nxdomain()).alias("nxdomain"),
    )
    total = one_value(
        packets.where(in_window(window) & P.is_query() & F.col("src_ip").isNotNull()).agg(
            count_rows().alias("t")
        ),
        "t",
    )
    return profile_of_minutes(per_minute, total)


def profile_of_minutes(per_minute: DataFrame, total: Column) -> DataFrame:
    """Profile per prefix from its counts (query, responses, nxdomain) per minute, and all queries."""
    profile = per_minute.groupBy("prefix").agg(
        F.sum("query").alias("query"),
        count_where(F.col("query") > 0).alias("active_minutes"),
        F.sum("responses").alias("responses"),
        F.sum("nxdomain").alias("nxdomain"),
    )
    return profile.withColumns(
        {
            "nx_rate_pct": percent("nxdomain", "responses"),
            "share_pct": percent("query", total),
        }
    )


def profile_coverage(profile: DataFrame) -> DataFrame:
    """Prefixes seen on one side only, and the two volume totals for reconciliation."""
    return profile.agg(
        count_rows().alias("prefixes"),
        count_where((F.col("query") == 0) & (F.col("responses") > 0)).alias("only_responses"),
        count_where((F.col("responses") == 0) & (F.col("query") > 0)).alias("only_queries"),
        F.sum("query").alias("queries"),
        F.sum("responses").alias("responses"),
    )


def _top(profile: DataFrame, limit: int, *order: Column) -> DataFrame:
    return with_rank(profile.orderBy(*order).limit(limit), *order)


def load_priority(
    profile: DataFrame,
    limit: int = 10,
    large_volume: int = 40_000,
    require_queries: bool = False,
) -> DataFrame:
    """Prefixes with the most queries, ties by activity; the reason follows the volume."""
    rows = profile.where(F.col("query") > 0) if require_queries else profile
    top = _top(rows, limit, F.desc("query"), F.desc("active_minutes"), F.asc("prefix"))
    always = "active almost all the time"
    reason = F.when(F.col("query") >= large_volume, f"largest volume; {always}").otherwise(always)
    return top.withColumn("reason", reason)


def nx_priority(
    profile: DataFrame,
    limit: int = 10,
    min_responses: int = 1000,
    very_high: float = 75.0,
    high: float = 25.0,
) -> DataFrame:
    """Prefixes with the most NXDOMAIN responses; the reason follows the rate."""
    rows = profile.where(F.col("responses") >= min_responses)
    top = _top(rows, limit, F.desc("nxdomain"), F.desc("nx_rate_pct"), F.asc("prefix"))
    reason = (
        F.when(F.col("nx_rate_pct") >= very_high, "largest NX volume; high NX rate")
        .when(F.col("nx_rate_pct") >= high, "high NX rate")
        .otherwise("watch the ratio")
    )
    return top.withColumn("reason", reason)


def _joined_reasons(*reasons: Column, fallback: str) -> Column:
    return F.coalesce(F.nullif(F.concat_ws("; ", *reasons), F.lit("")), F.lit(fallback))


def load_priority_by_rank(
    profile: DataFrame, n_minutes: Column, limit: int = 10, top_ranks: int = 3, slack: int = 3
) -> DataFrame:
    """Second rule set: reasons from the rank and from the active minutes of the window."""
    rows = profile.where(F.col("query") > 0)
    top = _top(rows, limit, F.desc("query"), F.asc("prefix"))
    return top.withColumn(
        "reason",
        _joined_reasons(
            F.when(F.col("rank") <= top_ranks, "largest volume"),
            F.when(F.col("active_minutes") >= n_minutes - slack, "active almost all the time"),
            fallback="routine monitoring",
        ),
    )


def nx_priority_by_rank(
    profile: DataFrame,
    limit: int = 10,
    top_ranks: int = 3,
    min_responses: int = 500,
    high: float = 25.0,
) -> DataFrame:
    """Second rule set: reasons from the rank and from the NXDOMAIN rate."""
    rows = profile.where(F.col("responses") >= min_responses)
    top = _top(rows, limit, F.desc("nxdomain"), F.asc("prefix"))
    return top.withColumn(
        "reason",
        _joined_reasons(
            F.when(F.col("rank") <= top_ranks, "largest NX volume"),
            F.when(F.col("nx_rate_pct") >= high, "high NX rate"),
            fallback="watch the ratio",
        ),
    )


def bubble_set(profile: DataFrame, limit: int = 10, high: float = 25.0) -> DataFrame:
    """Top prefixes by queries and by NXDOMAIN, each once, in that order.

    ``plottable`` needs a query volume and a rate; ``position`` counts the plottable ones.
    """
    by_query = _top(profile, limit, F.desc("query"), F.asc("prefix"))
    by_nx = _top(profile, limit, F.desc("nxdomain"), F.asc("prefix"))
    both = by_query.unionByName(by_nx.withColumn("rank", F.col("rank") + limit))
    values = [c for c in profile.columns if c != "prefix"]
    merged = both.groupBy("prefix").agg(
        F.min("rank").alias("rank"), *[F.first(c).alias(c) for c in values]
    )
    plottable = (F.col("query") > 0) & F.col("nx_rate_pct").isNotNull()
    flagged = merged.withColumn("plottable", plottable).withColumn(
        "high_nx", F.coalesce(F.col("nx_rate_pct") >= high, F.lit(False))
    )
    return with_rank(flagged, F.desc("plottable"), F.asc("rank"), name="position")


def bubble_labels(bubbles: DataFrame, first: int = 4) -> DataFrame:
    """Plottable bubbles with the flag whether the chart writes their label."""
    return bubbles.where("plottable").withColumn(
        "labelled", (F.col("position") <= first) | F.col("high_nx")
    )


def bubble_label_summary(labels: DataFrame) -> DataFrame:
    """Labelled count, and range and medians of the bubbles without a label."""
    rest = ~F.col("labelled")
    return labels.agg(
        count_where(F.col("labelled")).alias("n_labelled"),
        count_where(rest).alias("n_rest"),
        F.min(F.when(rest, F.col("nx_rate_pct"))).alias("min_nx_rate"),
        F.max(F.when(rest, F.col("nx_rate_pct"))).alias("max_nx_rate"),
        F.median(F.when(rest, F.col("nx_rate_pct"))).alias("median_nx_rate"),
        F.median(F.when(rest, F.col("query"))).alias("median_query"),
    )


# --- labels --------------------------------------------------------------------------------------


def extend_labels(labels: DataFrame, prefixes: DataFrame) -> DataFrame:
    """Keep the known labels; number new prefixes in text order after the highest known number.

    ``labels`` has prefix and label (S1, S2, ...), ``prefixes`` has prefix. The new ones are numbered
    range by range, so there may be any number of them.
    """
    highest = one_value(
        labels.agg(
            F.coalesce(F.max(F.expr("try_cast(substring(label, 2) as bigint)")), F.lit(0)).alias("n")
        ),
        "n",
    )
    new = prefixes.select("prefix").distinct().join(labels, "prefix", "left_anti")
    numbered = ranked_running_total(new.withColumn("one", F.lit(1)), "one", F.asc("prefix")).select(
        "prefix", F.concat(F.lit("S"), (F.col("position") + highest).cast("string")).alias("label")
    )
    return labels.select("prefix", "label").unionByName(numbered)


def label_or_text(df: DataFrame, labels: DataFrame, column: str = "prefix") -> DataFrame:
    """Add ``label``: the known label of the prefix, else the prefix itself."""
    known = labels.select(F.col("prefix").alias(column), F.col("label").alias("known_label"))
    return df.join(known, column, "left").withColumn(
        "label", F.coalesce("known_label", column)
    ).drop("known_label")
