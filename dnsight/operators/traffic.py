"""Message composition, header flags, code matrices, truncation and overview tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dnsight.functions import clock, names
from dnsight.functions import predicates as P
from dnsight.functions.measures import count_rows, count_where, percent
from dnsight.operators.shared import collapse_tail, one_value, top_counts
from dnsight.schema import RCODE_NAMES


def kpis(packets: DataFrame, any_direction: bool = True, weight: str | None = None) -> DataFrame:
    """Six conditional counts of the whole table, one pass."""
    return packets.agg(
        count_rows(weight).alias("total_packets"),
        count_where(P.is_query(), weight).alias("total_queries"),
        count_where(P.is_response(), weight).alias("total_responses"),
        count_where(P.is_nxdomain(any_direction), weight).alias("total_nxdomain"),
        count_where(P.is_udp_response(), weight).alias("udp_responses"),
        count_where(P.is_truncated_udp(), weight).alias("udp_truncated"),
    )


def count_by(packets: DataFrame, *keys: str) -> DataFrame:
    """Rows per key; a null key stays a group."""
    return packets.groupBy(*keys).agg(F.count(F.lit(1)).alias("count"))


def traffic_rollup(packets: DataFrame) -> DataFrame:
    """Counts per minute and header combination.

    Its size depends on the minutes and header values only, not on the packets. The operators with
    a ``weight`` parameter give the same answer from it (``weight="n"``) without a second scan.
    """
    keys = ["minute", "qr", "proto", "tc", "rcode", "qtype_name"]
    rows = packets.withColumn("minute", clock.minute_floor("dt"))
    return rows.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"), F.min("dt").alias("dt"), F.max("dt").alias("last_dt")
    )


# --- code matrices -------------------------------------------------------------------------------


def protocol_matrix(
    packets: DataFrame,
    top: int | None = None,
    min_responses: int = 0,
    keep_null_code: bool = True,
    digits: int | None = None,
    weight: str | None = None,
) -> DataFrame:
    """Responses per record type and response code with the share inside the type, long form.

    ``top`` keeps the most frequent types, ``min_responses`` the types with enough responses.
    """
    rows = packets.where(P.is_response() & F.col("qtype_name").isNotNull())
    if not keep_null_code:
        rows = rows.where(F.col("rcode").isNotNull())
    counts = rows.groupBy("qtype_name", F.col("rcode").cast("int").alias("response_code")).agg(
        count_rows(weight).alias("response_count")
    )
    total = F.sum("response_count").over(Window.partitionBy("qtype_name"))
    share = percent("response_count", "qtype_total")
    result = counts.withColumn("qtype_total", total).withColumn(
        "row_percentage", F.round(share, digits) if digits is not None else share
    )
    if min_responses:
        result = result.where(F.col("qtype_total") >= min_responses)
    if top is not None:
        kept = (
            rows.groupBy("qtype_name").agg(count_rows(weight).alias("t"))
            .orderBy(F.desc("t"), F.asc("qtype_name")).limit(top).select("qtype_name")
        )
        result = result.join(kept, "qtype_name", "left_semi")
    return result


def protocol_matrix_wide(
    packets: DataFrame, top: int = 5, codes: list[int] | None = None, weight: str | None = None
) -> DataFrame:
    """One row per frequent record type, one percentage column per response code.

    The code list is known beforehand, so no job is needed to find the columns; codes outside the
    list are summed in ``other_code``.
    """
    codes = list(RCODE_NAMES) if codes is None else codes
    long = protocol_matrix(packets, top=top, keep_null_code=False, weight=weight)
    shares = [
        F.coalesce(
            F.sum(F.when(F.col("response_code") == c, F.col("row_percentage"))), F.lit(0.0)
        ).alias(RCODE_NAMES.get(c, f"CODE_{c}"))
        for c in codes
    ]
    rest = F.coalesce(
        F.sum(F.when(~F.col("response_code").isin(codes), F.col("row_percentage"))), F.lit(0.0)
    )
    return long.groupBy("qtype_name").agg(
        F.sum("response_count").alias("responses"), *shares, rest.alias("other_code")
    )


def top_nxdomain_type(packets: DataFrame, top: int = 5) -> DataFrame:
    """Record type with the highest NXDOMAIN share among the most frequent types."""
    matrix = protocol_matrix(packets, top=top, keep_null_code=False)
    shares = matrix.groupBy("qtype_name").agg(
        F.coalesce(
            F.sum(F.when(F.col("response_code") == 3, F.col("row_percentage"))), F.lit(0.0)
        ).alias("nx_pct")
    )
    return shares.orderBy(F.desc("nx_pct"), F.asc("qtype_name")).limit(1)


def truncation_by_qtype(
    packets: DataFrame,
    min_responses: int = 500,
    keep_null: bool = False,
    digits: int | None = None,
    weight: str | None = None,
) -> DataFrame:
    """Truncated share of the UDP responses per record type with enough responses."""
    rows = packets.where(P.is_udp_response())
    if not keep_null:
        rows = rows.where(F.col("qtype_name").isNotNull())
    counts = rows.groupBy("qtype_name").agg(
        count_rows(weight).alias("total_resp"),
        count_where(F.col("tc") == 1, weight).alias("tc_count"),
    )
    rate = percent("tc_count", "total_resp")
    return counts.where(F.col("total_resp") >= min_responses).withColumn(
        "tc_rate_pct", F.round(rate, digits) if digits is not None else rate
    ).orderBy(F.desc("tc_rate_pct"), F.asc("qtype_name"))


def qtype_composition(packets: DataFrame, keep: int = 5, weight: str | None = None) -> DataFrame:
    """Queries of the most frequent record types, and the rest as one row."""
    rows = packets.where(P.is_query() & F.col("qtype_name").isNotNull())
    counts = rows.groupBy("qtype_name").agg(count_rows(weight).alias("count"))
    return collapse_tail(counts, "qtype_name", keep)


def rcode_composition(packets: DataFrame, keep: int = 4, weight: str | None = None) -> DataFrame:
    """Responses of the most frequent response codes, and the rest as one row."""
    rows = packets.where(P.is_response() & F.col("rcode").isNotNull())
    counts = rows.groupBy("rcode").agg(count_rows(weight).alias("count"))
    parts = collapse_tail(counts, "rcode", keep)
    code = F.col("rcode").try_cast("int")
    return parts.select(
        F.coalesce(P.rcode_name(code), F.col("rcode")).alias("rcode_name"), "count", "rank"
    )


# --- flags ---------------------------------------------------------------------------------------


def _indicator_rows(packets: DataFrame, items: dict[str, tuple[Column, Column]]) -> DataFrame:
    """One row per named condition: count and share of its base condition, one pass."""
    aggregates = []
    for i, (part, base) in enumerate(items.values()):
        aggregates += [count_where(part).alias(f"n{i}"), count_where(base).alias(f"d{i}")]
    rows = [
        F.struct(
            F.lit(label).alias("indicator"),
            F.col(f"n{i}").alias("count"),
            percent(f"n{i}", f"d{i}", 0.0).alias("pct"),
        )
        for i, label in enumerate(items)
    ]
    totals = packets.agg(*aggregates)
    return totals.select(F.inline(F.array(*rows)))


def vantage_evidence(packets: DataFrame) -> DataFrame:
    """Header evidence for the position of the capture: flags, referral and NODATA shares."""
    q, r, empty = P.is_query(), P.is_response(), P.is_empty_answer()
    referral, nodata = empty & (F.col("aa") == 0), empty & (F.col("aa") == 1)
    return _indicator_rows(
        packets,
        {
            "queries rd=1": (q & (F.col("rd") == 1), q),
            "queries cd=1": (q & (F.col("cd") == 1), q),
            "edns queries do=1": (P.is_edns_query() & (F.col("do") == 1), P.is_edns_query()),
            "responses ra=1": (r & (F.col("ra") == 1), r),
            "responses ad=1": (r & (F.col("ad") == 1), r),
            "referral": (referral, r),
            "nodata": (nodata, r),
            "referral in empty answers": (referral, empty),
            "nodata in empty answers": (nodata, empty),
        },
    )


def query_flags(packets: DataFrame) -> DataFrame:
    q = P.is_query()
    return _indicator_rows(
        packets,
        {
            "rd=1": (q & (F.col("rd") == 1), q),
            "cd=1": (q & (F.col("cd") == 1), q),
            "qdcount>1": (q & (F.col("qdcount") > 1), q),
        },
    )


def response_flags(packets: DataFrame) -> DataFrame:
    r = P.is_response()
    return _indicator_rows(
        packets, {f"{c}=1": (r & (F.col(c) == 1), r) for c in ("tc", "aa", "ra", "ad")}
    )


def truncation_by_transport(packets: DataFrame) -> DataFrame:
    """Truncated responses per transport and the TCP share of all packets."""
    tcp = F.col("proto") == "tcp"
    return packets.agg(
        count_where(P.is_udp_response()).alias("udp_responses"),
        count_where(P.is_truncated_udp()).alias("tc_on_udp"),
        percent(count_where(P.is_truncated_udp()), count_where(P.is_udp_response())).alias(
            "tc_on_udp_pct"
        ),
        count_where(P.is_tcp_response() & (F.col("tc") == 1)).alias("tc_on_tcp"),
        count_where(tcp).alias("tcp_packets"),
        percent(count_where(tcp), count_rows()).alias("tcp_pct"),
    )


def section_counters(packets: DataFrame) -> DataFrame:
    """count, mean, std, max and non-zero share of the response section counters."""
    columns = ["ancount", "nscount", "arcount"]
    pairs = [
        F.struct(F.lit(c).alias("section"), F.col(c).cast("double").alias("value"))
        for c in columns
    ]
    long = packets.where(P.is_response()).select(F.inline(F.array(*pairs)))
    return long.groupBy("section").agg(
        F.count("value").alias("count"),
        F.avg("value").alias("mean"),
        F.stddev_samp("value").alias("std"),
        F.max("value").alias("max"),
        count_where(F.col("value") > 0).alias("nonzero"),
        percent(count_where(F.col("value") > 0), count_rows()).alias("nonzero_pct"),
    )


# --- frequency tables ----------------------------------------------------------------------------


def query_types(packets: DataFrame, limit: int = 10) -> DataFrame:
    """Most frequent record types of the queries, share of all queries."""
    queries = packets.where(P.is_query())
    total = one_value(queries.agg(count_rows().alias("t")), "t")
    top = top_counts(queries, "qtype_name", limit)
    return top.withColumn("pct", percent("count", total))


def response_codes(packets: DataFrame, limit: int = 8) -> DataFrame:
    """Most frequent response codes with name, share of all responses."""
    responses = packets.where(P.is_response())
    total = one_value(responses.agg(count_rows().alias("t")), "t")
    top = top_counts(responses, "rcode", limit)
    return top.select(
        "rcode", P.rcode_name("rcode").alias("rcode_name"), "count",
        percent("count", total).alias("pct"),
    )


def edns_sizes(packets: DataFrame, limit: int = 3) -> DataFrame:
    """Most frequent EDNS buffer sizes per direction; a missing size is a group of its own."""
    counts = packets.where(F.col("qr").isin(0, 1)).groupBy("qr", "edns_udpsize").agg(
        count_rows().alias("count")
    )
    direction = Window.partitionBy("qr")
    order = direction.orderBy(F.desc("count"), F.asc_nulls_first("edns_udpsize"))
    return (
        counts.withColumn("rank", F.row_number().over(order))
        .withColumn("pct", percent("count", F.sum("count").over(direction)))
        .where(F.col("rank") <= limit)
    )


def dominant_edns_size(packets: DataFrame) -> DataFrame:
    """Most frequent EDNS buffer size over all packets and its share of all packets."""
    total = one_value(packets.agg(count_rows().alias("t")), "t")
    top = top_counts(packets, "edns_udpsize", 1)
    return top.withColumn("pct", percent("count", total))


def truncated_types(packets: DataFrame, limit: int = 5) -> DataFrame:
    """Record types of the truncated UDP responses, share of all truncated ones."""
    rows = packets.where(P.is_truncated_udp())
    total = one_value(rows.agg(count_rows().alias("t")), "t")
    return top_counts(rows, "qtype_name", limit).withColumn("pct", percent("count", total))


def top_domain(packets: DataFrame) -> DataFrame:
    """Most frequent name over all packets and its share of all packets."""
    named = packets.select(names.normalised("qname").alias("domain"))
    total = one_value(packets.agg(count_rows().alias("t")), "t")
    return top_counts(named, "domain", 1, "volume").withColumn("share", percent("volume", total))


# --- overview ------------------------------------------------------------------------------------


def overview(packets: DataFrame) -> DataFrame:
    """One row: size, time range, name cardinality before and after normalisation, gaps.

    Two distinct counts in one aggregate would expand every row; counting the spellings per
    normalised name gives both from one shuffle of pre-aggregated names.
    """
    spellings = packets.groupBy("qname").agg(
        count_rows().alias("n"),
        count_where(P.is_query()).alias("queries"),
        count_where(P.is_response()).alias("responses"),
        F.min("dt").alias("lo"),
        F.max("dt").alias("hi"),
    )
    per_name = spellings.groupBy(names.normalised("qname").alias("name")).agg(
        F.count("qname").alias("variants"),
        *[F.sum(c).alias(c) for c in ("n", "queries", "responses")],
        F.min("lo").alias("lo"),
        F.max("hi").alias("hi"),
    )
    gap = F.sum("queries") - F.sum("responses")
    return per_name.agg(
        F.sum("n").alias("total_rows"),
        F.lit(len(packets.columns)).cast("bigint").alias("total_columns"),
        F.min("lo").alias("first_time"),
        F.max("hi").alias("last_time"),
        clock.seconds_between(F.min("lo"), F.max("hi")).alias("duration_s"),
        F.sum("variants").alias("raw_names"),
        F.count("name").alias("normalised_names"),
        (F.sum("variants") - F.count("name")).alias("case_reduction"),
        percent(F.sum("variants") - F.count("name"), F.sum("variants")).alias("reduction_pct"),
        F.coalesce(F.sum(F.when(F.col("name").isNull(), F.col("n"))), F.lit(0)).alias("null_names"),
        gap.alias("query_response_gap"),
        percent(gap, F.sum("queries")).alias("gap_pct"),
    )


def null_name_codes(packets: DataFrame) -> DataFrame:
    """Packets without a name by response code and direction."""
    return count_by(packets.where(F.col("qname").isNull()), "rcode", "qr")


def null_name_check(packets: DataFrame) -> DataFrame:
    """FORMERR packets without a name beside all FORMERR packets."""
    formerr = F.col("rcode") == 1
    return packets.agg(
        count_where(F.col("qname").isNull() & formerr).alias("formerr_without_name"),
        count_where(formerr).alias("formerr_total"),
    )


def case_variants(packets: DataFrame, min_variants: int = 2) -> DataFrame:
    """Names that occur in several spellings (mixed case queries)."""
    spellings = packets.where(F.col("qname").isNotNull()).groupBy("qname").agg(
        count_rows().alias("n")
    )
    per_name = spellings.groupBy(names.normalised("qname").alias("name")).agg(
        F.count("qname").alias("variants"), F.sum("n").alias("packets")
    )
    return per_name.where(F.col("variants") >= min_variants)


def spellings_of(packets: DataFrame, name: str) -> DataFrame:
    """All spellings of one normalised name."""
    return packets.where(names.normalised("qname") == name).select("qname").distinct()
