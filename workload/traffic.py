"""Checks of composition, flags, matrices and overview."""

from __future__ import annotations

from pyspark.sql import functions as F

from dnsight.functions import names
from dnsight.functions import predicates as P
from dnsight.operators import sketches, traffic
from dnsight.plans import incremental, marts, staging
from dnsight.schema import RCODE_NAMES
from dnsight.sources.storage import fresh_path
from workload import sqltext as S
from workload.minutes import rounded
from workload.packets import packets

_NAME = (
    "case rcode "
    + " ".join(f"when {k} then '{v}'" for k, v in RCODE_NAMES.items())
    + " else 'CODE_' || rcode end"
)


def _fct_temporal(spark, sf):
    return marts.temporal_mart(staging.staged(packets(spark, sf)))


_FCT_TEMPORAL_SQL = f"""
select minute packet_minute, count(*) total_packets, {S.n(S.Q)} total_queries,
  {S.n(S.R)} total_responses, {S.n('rcode = 3')} nxdomain_count,
  {S.pct(S.n('rcode = 3'), S.n(S.R), 2)} nxdomain_rate_pct, {S.n(S.UR)} udp_responses,
  {S.n(S.TC)} udp_truncated_count, {S.pct(S.n(S.TC), S.n(S.UR), 2)} udp_truncation_rate_pct
from packets group by 1"""


def _matrix_wide(spark, sf):
    wide = traffic.protocol_matrix_wide(packets(spark, sf))
    return rounded(wide, *RCODE_NAMES.values(), "other_code")


_TOP5 = (
    "top5 as (select qtype_name from packets where qr = 1 and rcode is not null"
    " group by 1 order by count(*) desc, 1 limit 5)"
)
_MATRIX_WIDE_SQL = (
    "select qtype_name, count(*) responses, "
    + ", ".join(
        f"coalesce({S.pct(S.n(f'rcode = {k}'), 'count(*)')}, 0) as {v}"
        for k, v in RCODE_NAMES.items()
    )
    + ", 0e0 as other_code from packets where qr = 1 and rcode is not null"
    " and qtype_name in (select qtype_name from top5) group by 1"
)


def _fct_matrix(spark, sf):
    rows = marts.protocol_mart(staging.staged(packets(spark, sf)))
    return rows.withColumn("response_code", F.col("response_code").cast("bigint"))


_FCT_MATRIX_SQL = """
select qtype_name, rcode::bigint response_code, response_count,
  round(100e0 * response_count / t, 2) row_percentage
from (select *, sum(response_count) over (partition by qtype_name) t
      from (select qtype_name, rcode, count(*) response_count from packets
            where qr = 1 and qtype_name is not null group by 1, 2)) where t >= 10"""


def _matrix_long(spark, sf):
    rows = traffic.protocol_matrix(packets(spark, sf), top=3, min_responses=10, digits=2)
    return rows.select(
        "qtype_name", F.col("response_code").cast("bigint").alias("response_code"),
        "response_count", "qtype_total", "row_percentage",
    )


_MATRIX_LONG_SQL = """
select qtype_name, rcode::bigint response_code, response_count, t::bigint qtype_total,
  round(100e0 * response_count / t, 2) row_percentage
from (select *, sum(response_count) over (partition by qtype_name) t
      from (select qtype_name, rcode, count(*) response_count from packets
            where qr = 1 and qtype_name is not null group by 1, 2))
where qtype_name in (select qtype_name from packets where qr = 1 group by 1
                     order by count(*) desc, 1 limit 3)"""


def _truncation(spark, sf):
    return rounded(traffic.truncation_by_qtype(packets(spark, sf), 100), "tc_rate_pct")


def _truncation_sql(digits):
    return (
        "select qtype_name, count(*) total_resp, count(*) filter (where tc = 1) tc_count,"
        f" {S.pct('count(*) filter (where tc = 1)', 'count(*)', digits)} tc_rate_pct"
        f" from packets where {S.UR} group by 1 having count(*) >= 100"
    )


def _truncation_rounded(spark, sf):
    return traffic.truncation_by_qtype(packets(spark, sf), 100, keep_null=True, digits=2)


def _vantage(spark, sf):
    return rounded(traffic.vantage_evidence(packets(spark, sf)), "pct")


_EMPTY = "(qr = 1 and rcode = 0 and ancount = 0 and nscount > 0)"


def _indicator_sql(items):
    return " union all ".join(
        f"select '{label}' indicator, {S.n(part)} count,"
        f" coalesce({S.pct(S.n(part), S.n(base))}, 0) pct from packets"
        for label, part, base in items
    )


_VANTAGE_SQL = _indicator_sql(
    [
        ("queries rd=1", "qr = 0 and rd = 1", S.Q),
        ("queries cd=1", "qr = 0 and cd = 1", S.Q),
        ("edns queries do=1", 'qr = 0 and edns = 1 and "do" = 1', "qr = 0 and edns = 1"),
        ("responses ra=1", "qr = 1 and ra = 1", S.R),
        ("responses ad=1", "qr = 1 and ad = 1", S.R),
        ("referral", f"{_EMPTY} and aa = 0", S.R),
        ("nodata", f"{_EMPTY} and aa = 1", S.R),
        ("referral in empty answers", f"{_EMPTY} and aa = 0", _EMPTY),
        ("nodata in empty answers", f"{_EMPTY} and aa = 1", _EMPTY),
    ]
)


def _overview(spark, sf):
    return rounded(
        traffic.overview(packets(spark, sf)), "duration_s", "reduction_pct", "gap_pct"
    )


_OVERVIEW_SQL = f"""
select count(*) total_rows, 33::bigint total_columns, min(dt) first_time, max(dt) last_time,
  round((epoch_us(max(dt)) - epoch_us(min(dt))) / 1e6, 6) duration_s,
  count(distinct qname) raw_names, count(distinct name) normalised_names,
  count(distinct qname) - count(distinct name) case_reduction,
  {S.pct('count(distinct qname) - count(distinct name)', 'count(distinct qname)')} reduction_pct,
  count(*) filter (where qname is null) null_names,
  {S.n(S.Q)} - {S.n(S.R)} query_response_gap,
  {S.pct(f'{S.n(S.Q)} - {S.n(S.R)}', S.n(S.Q))} gap_pct
from packets"""


def _null_names(spark, sf):
    rows = traffic.null_name_codes(packets(spark, sf))
    return rows.select(
        F.col("rcode").cast("bigint").alias("rcode"), F.col("qr").cast("bigint").alias("qr"),
        "count",
    )


def _null_check(spark, sf):
    return traffic.null_name_check(packets(spark, sf))


def _case_variants(spark, sf):
    return traffic.case_variants(packets(spark, sf))


def _spellings(spark, sf):
    return traffic.spellings_of(packets(spark, sf), "api.shop0.co.id")


def _transport(spark, sf):
    return rounded(
        traffic.truncation_by_transport(packets(spark, sf)), "tc_on_udp_pct", "tcp_pct"
    )


_TRANSPORT_SQL = f"""
select {S.n(S.UR)} udp_responses, {S.n(S.TC)} tc_on_udp, {S.pct(S.n(S.TC), S.n(S.UR))} tc_on_udp_pct,
  {S.n("qr = 1 and proto = 'tcp' and tc = 1")} tc_on_tcp, {S.n("proto = 'tcp'")} tcp_packets,
  {S.pct(S.n("proto = 'tcp'"), 'count(*)')} tcp_pct
from packets"""


def _edns(spark, sf):
    rows = rounded(traffic.edns_sizes(packets(spark, sf)), "pct")
    return rows.select(
        F.col("qr").cast("bigint").alias("qr"),
        F.col("edns_udpsize").cast("bigint").alias("edns_udpsize"), "count",
        F.col("rank").cast("bigint").alias("rank"), "pct",
    )


_EDNS_SQL = """
select qr::bigint qr, edns_udpsize::bigint edns_udpsize, count, rank, round(100e0*count/t, 6) pct
from (select *, row_number() over (partition by qr order by count desc, edns_udpsize nulls first) rank,
        sum(count) over (partition by qr) t
      from (select qr, edns_udpsize, count(*) count from packets group by 1, 2)) where rank <= 3"""


def _edns_top(spark, sf):
    rows = rounded(traffic.dominant_edns_size(packets(spark, sf)), "pct")
    return rows.withColumn("edns_udpsize", F.col("edns_udpsize").cast("bigint"))


def _truncated_types(spark, sf):
    return rounded(traffic.truncated_types(packets(spark, sf)), "pct")


def _qtypes(spark, sf):
    return rounded(traffic.query_types(packets(spark, sf)), "pct")


def _query_flags(spark, sf):
    return rounded(traffic.query_flags(packets(spark, sf)), "pct")


def _response_flags(spark, sf):
    return rounded(traffic.response_flags(packets(spark, sf)), "pct")


def _rcodes(spark, sf):
    rows = rounded(traffic.response_codes(packets(spark, sf)), "pct")
    return rows.withColumn("rcode", F.col("rcode").cast("bigint"))


def _rcode_names(spark, sf):
    rows = packets(spark, sf).select(
        F.col("event_id"), F.col("rcode").cast("bigint").alias("rcode"),
        P.rcode_name("rcode").alias("rcode_name"), P.message_type_name().alias("message_type"),
    )
    return rows


def _sections(spark, sf):
    return rounded(traffic.section_counters(packets(spark, sf)), "mean", "std", "nonzero_pct")


_SECTIONS_SQL = " union all ".join(
    f"select '{c}' section, count({c}) count, round(avg({c}), 6) mean,"
    f" round(stddev_samp({c}), 6) std, max({c})::double max, {S.n(c + ' > 0')} nonzero,"
    f" {S.pct(S.n(c + ' > 0'), 'count(*)')} nonzero_pct from packets where qr = 1"
    for c in ("ancount", "nscount", "arcount")
)


def _top_domain(spark, sf):
    return rounded(traffic.top_domain(packets(spark, sf)), "share")


def _qtype_mix(spark, sf):
    rows = traffic.qtype_composition(packets(spark, sf), keep=3)
    return rows.withColumn("rank", F.col("rank").cast("bigint"))


def _rcode_mix(spark, sf):
    rows = traffic.rcode_composition(packets(spark, sf), keep=3)
    return rows.withColumn("rank", F.col("rank").cast("bigint"))


def _mix_sql(inner: str, key: str) -> str:
    return (
        f"select case when rk <= 3 then {key} else 'other' end as {key}, sum(c)::bigint count,"
        " least(min(rk), 4)::bigint as rank from ("
        f"select *, row_number() over (order by c desc, ord) rk from ({inner})) group by 1"
    )


def _by_rcode(spark, sf):
    rows = traffic.count_by(packets(spark, sf), "rcode")
    return rows.withColumn("rcode", F.col("rcode").cast("bigint"))


def _top_nx_type(spark, sf):
    return rounded(traffic.top_nxdomain_type(packets(spark, sf)), "nx_pct")


def _rollup(spark, sf):
    rollup = traffic.traffic_rollup(packets(spark, sf))
    return traffic.kpis(rollup, weight="n").withColumn("rollup_rows", F.lit(True))


def _by_capture(spark, sf):
    """States of four captures, one of them loaded twice; only its own partition is written again."""
    path, rows = fresh_path(spark, "captures"), packets(spark, sf)
    for part in (0, 1, 2, 3, 1):
        incremental.load_capture(rows.where(F.col("event_id") % 4 == part), path, f"c{part}")
    return incremental.state(spark, path)


def _sketched(spark, sf):
    """Distinct names per direction beside their estimate from merged sketches, as whether it is near."""
    rows = packets(spark, sf)
    merged = sketches.estimates(sketches.merged(sketches.minute_sketches(rows), "qr"))
    near = F.abs(F.col("name_distinct") - F.col("names")) <= F.greatest(F.lit(1), 0.08 * F.col("names"))
    exact = rows.groupBy(F.col("qr").alias("direction")).agg(
        F.count_distinct(names.normalised("qname")).alias("names")
    )
    # Half of the frame lengths lie below the middle of their range, and so should the middle of the sketch.
    middle = F.abs(F.col("frame_len_values")[1] - (64 + 668)) <= 60
    return merged.join(exact, F.col("qr") == F.col("direction")).select(
        F.col("qr").cast("bigint").alias("qr"), "n", "names", near.alias("near"), middle.alias("middle_near")
    )


ENTRIES = {
    "k03_incremental": (lambda spark, sf: incremental.temporal_mart(_by_capture(spark, sf)), S.query(_FCT_TEMPORAL_SQL)),
    "k05_incremental": (
        lambda spark, sf: incremental.pareto_mart(_by_capture(spark, sf)),
        S.query(
            "select row_number() over (order by c desc, prefix) prefix_rank, prefix src_prefix, c query_count,"
            " round(100e0*c/t, 3) share_pct, round(100e0*sum(c) over (order by c desc, prefix)/t, 3) cumulative_share_pct,"
            " round(100e0*sum(c) over (order by c desc, prefix)/t, 3) <= 80 is_pareto_top_80"
            " from (select prefix, c, sum(c) over () t from (select coalesce(src_prefix, 'UNKNOWN') prefix, count(*) c"
            " from packets where qr = 0 group by 1))"
        ),
    ),
    "k07_incremental": (
        lambda spark, sf: incremental.protocol_mart(_by_capture(spark, sf)).withColumn(
            "response_code", F.col("response_code").cast("bigint")
        ),
        S.query(_FCT_MATRIX_SQL),
    ),
    "k22_sketched_names": (
        _sketched,
        S.query(
            "select qr::bigint qr, count(*) n, count(distinct name) names, true near, true middle_near from packets group by 1"
        ),
    ),
    "k03_fct_temporal": (_fct_temporal, S.query(_FCT_TEMPORAL_SQL)),
    "k06_matrix_wide": (_matrix_wide, S.query(_MATRIX_WIDE_SQL, _TOP5)),
    "k06_matrix_long": (_matrix_long, S.query(_MATRIX_LONG_SQL)),
    "k07_fct_matrix": (_fct_matrix, S.query(_FCT_MATRIX_SQL)),
    "k08_truncation": (_truncation, S.query(_truncation_sql(6))),
    "k09_truncation_rounded": (_truncation_rounded, S.query(_truncation_sql(2))),
    "k16_kpis_from_rollup": (
        _rollup,
        S.query(
            f"select count(*) total_packets, {S.n(S.Q)} total_queries, {S.n(S.R)} total_responses,"
            f" {S.n('rcode = 3')} total_nxdomain, {S.n(S.UR)} udp_responses,"
            f" {S.n(S.TC)} udp_truncated, true rollup_rows from packets"
        ),
    ),
    "k21_vantage": (_vantage, S.query(_VANTAGE_SQL)),
    "k22_overview": (_overview, S.query(_OVERVIEW_SQL)),
    "k23_null_names": (
        _null_names,
        S.query(
            "select rcode::bigint rcode, qr::bigint qr, count(*) count from packets"
            " where qname is null group by 1, 2"
        ),
    ),
    "q26_null_name_check": (
        _null_check,
        S.query(
            f"select {S.n('qname is null and rcode = 1')} formerr_without_name,"
            f" {S.n('rcode = 1')} formerr_total from packets"
        ),
    ),
    "k24_case_variants": (
        _case_variants,
        S.query(
            "select name, count(distinct qname) variants, count(*) packets from packets"
            " where qname is not null group by 1 having count(distinct qname) > 1"
        ),
    ),
    "k24_spellings": (
        _spellings,
        S.query("select distinct qname from packets where name = 'api.shop0.co.id'"),
    ),
    "k25_transport": (_transport, S.query(_TRANSPORT_SQL)),
    "k26_edns": (_edns, S.query(_EDNS_SQL)),
    "k71_edns_top": (
        _edns_top,
        S.query(
            "select edns_udpsize::bigint edns_udpsize, count(*) count,"
            " round(100e0*count(*)/(select count(*) from packets), 6) pct from packets"
            " where edns_udpsize is not null group by 1 order by count(*) desc, 1 limit 1"
        ),
    ),
    "k27_truncated_types": (
        _truncated_types,
        S.query(
            "select qtype_name, count(*) count,"
            f" round(100e0*count(*)/(select {S.n(S.TC)} from packets), 6) pct from packets"
            f" where {S.TC} group by 1 order by count(*) desc, 1 limit 5"
        ),
    ),
    "k28_qtypes": (
        _qtypes,
        S.query(
            "select qtype_name, count(*) count,"
            f" round(100e0*count(*)/(select {S.n(S.Q)} from packets), 6) pct from packets"
            " where qr = 0 group by 1 order by count(*) desc, 1 limit 10"
        ),
    ),
    "k29_query_flags": (
        _query_flags,
        S.query(
            _indicator_sql(
                [
                    ("rd=1", "qr = 0 and rd = 1", S.Q),
                    ("cd=1", "qr = 0 and cd = 1", S.Q),
                    ("qdcount>1", "qr = 0 and qdcount > 1", S.Q),
                ]
            )
        ),
    ),
    "k30_rcodes": (
        _rcodes,
        S.query(
            f"select rcode::bigint rcode, {_NAME} rcode_name, count(*) count,"
            f" round(100e0*count(*)/(select {S.n(S.R)} from packets), 6) pct from packets"
            " where qr = 1 and rcode is not null group by rcode order by count(*) desc, rcode limit 8"
        ),
    ),
    "p04_rcode_names": (
        _rcode_names,
        S.query(
            f"select event_id, rcode::bigint rcode, case when rcode is not null then {_NAME} end"
            " rcode_name, case when qr = 0 then 'QUERY' else 'RESPONSE' end message_type"
            " from packets"
        ),
    ),
    "k31_sections": (_sections, S.query(_SECTIONS_SQL)),
    "k32_response_flags": (
        _response_flags,
        S.query(
            _indicator_sql(
                [(f"{c}=1", f"qr = 1 and {c} = 1", S.R) for c in ("tc", "aa", "ra", "ad")]
            )
        ),
    ),
    "k50_top_domain": (
        _top_domain,
        S.query(
            "select name as domain, count(*) volume,"
            " round(100e0*count(*)/(select count(*) from packets), 6) share from packets"
            " where name is not null group by 1 order by count(*) desc, 1 limit 1"
        ),
    ),
    "k61_qtype_mix": (
        _qtype_mix,
        S.query(
            _mix_sql(
                "select qtype_name, qtype_name ord, count(*) c from packets"
                " where qr = 0 and qtype_name is not null group by 1, 2",
                "qtype_name",
            )
        ),
    ),
    "k61_rcode_mix": (
        _rcode_mix,
        S.query(
            _mix_sql(
                f"select {_NAME} rcode_name, rcode ord, count(*) c from packets"
                " where qr = 1 and rcode is not null group by rcode",
                "rcode_name",
            )
        ),
    ),
    "k62_by_rcode": (
        _by_rcode,
        S.query("select rcode::bigint rcode, count(*) count from packets group by 1"),
    ),
    "k64_top_nx_type": (
        _top_nx_type,
        S.query(
            f"select qtype_name, {S.pct(S.n('rcode = 3'), 'count(*)')} nx_pct from packets"
            " where qr = 1 and rcode is not null and qtype_name in (select qtype_name from top5)"
            " group by 1 order by 2 desc, 1 limit 1",
            _TOP5,
        ),
    ),
}
