"""The sections of the report, each against its own SQL."""

from __future__ import annotations

from functools import cache

from pyspark.sql import functions as F

from dnsight.plans import report
from dnsight.schema import RCODE_NAMES
from workload import sqltext as S
from workload.packets import packets
from workload.rules import suffix_table
from workload.spikes import _NX_ROWS, _OTHERS, _SUMMARY_SQL, _delta_sql
from workload.sources import _SERIES
from workload.storage import _KPI_SQL

MIN_RESPONSES, NX_MIN_RESPONSES = 100, 50


@cache
def _report(spark, sf) -> report.Report:
    """One report a session and data set; its sections are queries of their own."""
    return report.report_sections(
        packets(spark, sf), suffix_table(spark), min_responses=MIN_RESPONSES, nx_min_responses=NX_MIN_RESPONSES
    )


def _section(name):
    def run(spark, sf):
        rows = _report(spark, sf).sections[name].drop("position")
        kinds = dict(rows.dtypes)
        return rows.select(*[
            F.round(c, 6).alias(c) if kinds[c] == "double" else F.col(f"`{c}`").cast("bigint").alias(c)
            if kinds[c] in ("tinyint", "smallint", "int", "bigint") else F.col(f"`{c}`") for c in rows.columns
        ])

    return run


def _nested(spark, sf):
    return report.nested_report(_report(spark, sf))


def _nested_counts(spark, sf):
    """How many rows each list of the one-row report holds."""
    rows = _nested(spark, sf)
    lists = ("kpi", "pareto", "load_priority", "nx_priority", "matrix", "truncation", "temporal.minutes", "bubble.points")
    return rows.select(
        *[F.size(c).cast("bigint").alias(c.replace(".", "_")) for c in lists], F.col("meta.messages").cast("bigint").alias("messages")
    )


_HHMM = "strftime({0}, '%H:%M')"
_ISO = "strftime({0}, '%Y-%m-%dT%H:%M:%S')"
_META = f"""
select 'UTC' time_zone, {_ISO.format('min(dt)')} "from", {_ISO.format('max(dt)')} "to",
  (select count(*) from dense) steady_minutes, count(*) messages, {S.n(S.Q)} queries, {S.n(S.R)} responses from packets"""
_MINUTES = f"""
select {_HHMM.format('minute')} as time, {_ISO.format('minute')} time_iso, packets, nx, responses,
  coalesce({S.pct('nx', 'responses')}, 0) nx_rate, udp_resp, udp_tc, coalesce({S.pct('udp_tc', 'udp_resp')}, 0) tc_ratio from dense"""
_VALUES = f"""
select round(coalesce(median(packets) filter (where minute <> (select minute from peak)), median(packets)), 6)::double median_other,
  {S.pct('sum(nx)', 'sum(responses)')} nx_rate_global, {S.pct('sum(udp_tc)', 'sum(udp_resp)')} tc_ratio_avg from dense"""
_PEAKS = "select " + ", ".join(
    f"(select {_HHMM.format('minute')} from dense order by {c} desc, minute limit 1) as {name}"
    for name, c in (("load", "packets"), ("nx", "nx"), ("tc", "udp_tc"))
)
_PARETO = (
    "pareto as (select row_number() over (order by query_count desc, prefix) rk, prefix, query_count,"
    " 100e0*query_count/(select count(*) from packets where qr = 0) share from pc qualify rk <= 10)"
)
_LOAD = "load10 as (select *, row_number() over (order by query desc, active_minutes desc, prefix) rk from profile qualify rk <= 10)"
_ERRORS = (
    f"nx10 as (select *, row_number() over (order by nxdomain desc, nx_rate_pct desc, prefix) rk from profile"
    f" where responses >= {NX_MIN_RESPONSES} qualify rk <= 10)"
)
_BUBBLES = (
    "top_both as (select prefix, min(rk) rk from ("
    "(select prefix, row_number() over (order by query desc, prefix) rk from profile qualify rk <= 10) union all"
    " (select prefix, 10 + row_number() over (order by nxdomain desc, prefix) rk from profile qualify rk <= 20)) group by 1), "
    "bubble as (select profile.*, rk, query > 0 and nx_rate_pct is not null plottable, coalesce(nx_rate_pct >= 25, false) high_nx"
    " from profile join top_both using (prefix))"
)
_LABELS = (
    "shown as (select prefix from load10 union select prefix from nx10 union select prefix from bubble union select prefix from top3), "
    "labels as (select prefix, 'S' || rk as label from pareto union all select prefix,"
    " 'S' || ((select max(rk) from pareto) + row_number() over (order by prefix)) from shown"
    " where prefix not in (select prefix from pareto))"
)
_BASE = (
    S.MINUTES, S.PEAK, S.STEADY, S.PREFIX_COUNTS, S.TOP_PREFIX, S.PROFILE, _SERIES, _PARETO, _LOAD, _ERRORS, _BUBBLES, _LABELS,
)
_SIX = "round({0}, 6) {0}"
_SPIKE = (*(S.MINUTES, S.PEAK), _NX_ROWS)


def _top_deltas(key, limit, columns):
    return (
        f'select {columns} from (select *, row_number() over (order by raw desc, "group") rk from'
        f" (select *, peak_count - {_RAW_BASE} raw from ({_delta_sql(key, _OTHER_COUNT)}))) where rk <= {limit}"
    )


_OTHER_COUNT = "count(*) filter (where not at_peak) other_count,"
_RAW_BASE = f"1e0*other_count/{_OTHERS}"
_CODES = "case {key} " + " ".join(f"when '{k}' then '{v}'" for k, v in RCODE_NAMES.items()) + " when 'other' then 'other' else 'CODE_' || {key} end"


def _mix(where, key, keep):
    return (
        f"select case when rk <= {keep} then k else 'other' end as k, sum(c)::bigint count from (select {key}::varchar k, c,"
        f" row_number() over (order by c desc, {key}) rk from (select {key}, count(*) c from packets where {where}"
        f" and {key} is not null group by 1)) group by 1"
        # The rest is a row of its own, also when nothing is left for it.
        f" union all select 'other', 0 where (select count(distinct {key}) from packets where {where}) <= {keep}"
    )


_SQL = {
    "meta": S.query(_META, S.MINUTES),
    "kpi": S.query(_KPI_SQL, S.MINUTES, S.PREFIX_COUNTS, S.TOP_PREFIX),
    "temporal.minutes": S.query(_MINUTES, S.MINUTES),
    "temporal.values": S.query(_VALUES, S.MINUTES, S.PEAK),
    "temporal.peak": S.query(_PEAKS, S.MINUTES),
    "pareto": S.query(
        "select 'S' || rk as label, round(share, 6) share_pct, round(sum(share) over (order by rk), 6) cumulative_pct from pareto",
        S.PREFIX_COUNTS, _PARETO,
    ),
    "load_priority": S.query(
        f"select label, query, {_SIX.format('share_pct')}, active_minutes, case when query >= 40000 then 'largest volume; ' else '' end"
        " || 'active almost all the time' reason from load10 join labels using (prefix)", *_BASE,
    ),
    "nx_priority": S.query(
        f"select label, responses, nxdomain, {_SIX.format('nx_rate_pct')}, case when nx_rate_pct >= 75 then"
        " 'largest NX volume; high NX rate' when nx_rate_pct >= 25 then 'high NX rate' else 'watch the ratio' end reason"
        " from nx10 join labels using (prefix)", *_BASE,
    ),
    "bubble.points": S.query(
        f"select label, query, {_SIX.format('nx_rate_pct')}, responses, high_nx from bubble join labels using (prefix) where plottable",
        *_BASE,
    ),
    "bubble.not_plotted": S.query(
        f"select label, query, responses, nxdomain, {_SIX.format('nx_rate_pct')} from bubble join labels using (prefix)"
        " where not plottable", *_BASE,
    ),
    "small_multiples.series": S.query(
        f"select label, {_HHMM.format('minute')} peak, queries peak_queries from series join labels using (prefix)"
        " qualify row_number() over (partition by rk order by queries desc, minute) = 1", *_BASE,
    ),
    "small_multiples.minutes": S.query(
        f"select {_HHMM.format('minute')} as time, "
        + ", ".join(f"sum(queries) filter (where rk = {i})::bigint s{i}" for i in (1, 2, 3)) + " from series group by minute", *_BASE,
    ),
    "decomposition.summary": S.query(f"select * from ({_SUMMARY_SQL})", *_SPIKE),
    "decomposition.hosts": S.query(_top_deltas("dst_ip", 10, "'H' || rk as label, delta"), *_SPIKE),
    "decomposition.domains": S.query(_top_deltas("reg", 5, "'R' || rk as label, delta"), *_SPIKE),
    "decomposition.qtypes": S.query(_top_deltas("qtype_name", 3, '"group" as qtype, delta'), *_SPIKE),
    "decomposition.values": S.query(
        "select round(100e0*sum(c) filter (where rk <= 5)/sum(c), 6) cov5, round(100e0*sum(c) filter (where rk <= 10)/sum(c), 6) cov10,"
        f" (select round(sum(raw), 6) from ({_top_deltas('dst_ip', 2, 'raw')})) top2_delta"
        " from (select c, row_number() over (order by c desc, dst_ip) rk from (select dst_ip, count(*) c from nxr group by 1))", *_SPIKE,
    ),
    "truncation": S.query(
        f"select qtype_name, {S.pct('count(*) filter (where tc = 1)', 'count(*)')} tc_rate_pct, count(*) total_resp from packets"
        f" where {S.UR} and qtype_name is not null group by 1 having count(*) >= {MIN_RESPONSES}"
    ),
    "matrix": S.query(
        "select qtype_name, rcode::bigint response_code, count(*) response_count,"
        " round(100e0*count(*)/sum(count(*)) over (partition by qtype_name), 6) row_percentage from packets"
        " where qr = 1 and rcode is not null and qtype_name in (select qtype_name from packets where qr = 1 and rcode is not null"
        " and qtype_name is not null group by 1 order by count(*) desc, 1 limit 5) group by 1, 2"
    ),
    "composition.qtype": S.query(f"select k as qtype_name, count from ({_mix('qr = 0', 'qtype_name', 5)})"),
    "composition.rcode": S.query(f"select {_CODES.format(key='k')} as rcode_name, count from ({_mix('qr = 1', 'rcode', 4)})"),
}
_COUNTS_SQL = S.query(
    "select 5::bigint kpi, (select count(*) from pareto) pareto, (select count(*) from load10) load_priority,"
    " (select count(*) from nx10) nx_priority, (select count(*) from (select distinct qtype_name, rcode from packets"
    " where qr = 1 and rcode is not null and qtype_name is not null)) matrix,"
    f" (select count(*) from (select 1 from packets where {S.UR} and qtype_name is not null group by qtype_name"
    f" having count(*) >= {MIN_RESPONSES})) truncation, (select count(*) from dense) temporal_minutes,"
    " (select count(*) from bubble where plottable) bubble_points, (select count(*) from packets) messages", *_BASE,
)

ENTRIES = {
    "k20_report": (_nested_counts, _COUNTS_SQL),
    **{f"k20_{name.replace('.', '_')}": (_section(name), sql) for name, sql in _SQL.items()},
}
