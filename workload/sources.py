"""Checks of source concentration and priorities."""

from __future__ import annotations

from pyspark.sql import functions as F

from dnsight.functions import address, names
from dnsight.operators import concentration, priority, temporal
from dnsight.operators.shared import one_value
from dnsight.plans import marts, staging
from workload import sqltext as S
from workload.minutes import rounded
from workload.packets import packets


def _long(df, *columns):
    return df.withColumns({c: F.col(c).cast("bigint") for c in columns})


def _pareto_top(spark, sf):
    rows = rounded(concentration.pareto_top(packets(spark, sf)), "share_pct", "cumulative_pct")
    return _long(rows, "rank")


_TOTAL_Q = "(select count(*) from packets where qr = 0)"
_PARETO_TOP_SQL = f"""
select rk "rank", prefix, 'S' || rk as label, query_count total_query,
  round(100e0*query_count/{_TOTAL_Q}, 6) share_pct,
  round(100e0*sum(query_count) over (order by rk)/{_TOTAL_Q}, 6) cumulative_pct
from (select *, row_number() over (order by query_count desc, prefix) rk from pc) where rk <= 10"""


def _fct_pareto(spark, sf):
    return concentration.pareto_full(concentration.prefix_counts(packets(spark, sf)))


_FULL_SQL = """
select row_number() over (order by query_count desc, prefix) prefix_rank, prefix, query_count,
  round(100e0*query_count/t, 3) share_pct,
  round(100e0*sum(query_count) over (order by query_count desc, prefix
        rows between unbounded preceding and current row)/t, 3) cumulative_share_pct,
  round(100e0*sum(query_count) over (order by query_count desc, prefix
        rows between unbounded preceding and current row)/t, 3) <= 80.0 is_pareto_top_80
from (select *, sum(query_count) over () t from pc)"""


def _name_pareto(spark, sf):
    named = packets(spark, sf).where(F.col("qname").isNotNull())
    counts = named.groupBy(names.normalised("qname").alias("prefix")).agg(
        F.count(F.lit(1)).alias("query_count")
    )
    return concentration.pareto_full_any_key(counts, "prefix")


_NAME_COUNTS = (
    "pc as (select name as prefix, count(*) query_count from packets"
    " where name is not null group by 1)"
)


def _pareto_mart(spark, sf):
    return marts.pareto_mart(staging.staged(packets(spark, sf)))


_MART_COUNTS = (
    "pc as (select coalesce(src_prefix, 'UNKNOWN') as prefix, count(*) query_count"
    " from packets where qr = 0 group by 1)"
)


def _by_pattern(spark, sf):
    return concentration.top_by_pattern(packets(spark, sf))


_PATTERN_SQL = """
select regexp_extract(src_ip, '^([0-9a-fA-F:]+:[0-9a-fA-F:]+:[0-9a-fA-F:]+)', 1) prefix_48,
  count(*) query_count
from packets where qr = 0 and src_ip is not null group by 1 order by 2 desc, 1 limit 10"""


def _summary(spark, sf):
    return rounded(concentration.source_summary(packets(spark, sf)), "top_share_pct")


_SUMMARY_SQL = f"""
select count(distinct src_ip) distinct_addresses,
  count(distinct case when src_prefix = 'UNKNOWN' then src_ip else src_prefix end) distinct_prefixes,
  round(100e0*(select sum(c) from (select count(*) c from packets where qr = 0
     and src_prefix is not null group by src_prefix order by 1 desc limit 10))/{_TOTAL_Q}, 6)
     top_share_pct
from packets where qr = 0"""


def _drill_domains(spark, sf):
    return rounded(concentration.top_source_domains(packets(spark, sf)), "pct")


def _drill_types(spark, sf):
    return rounded(concentration.top_source_types(packets(spark, sf)), "pct")


def _drill_sql(column, alias):
    return (
        f"select {column} as {alias}, count(*) count,"
        " round(100e0*count(*)/(select query_count from top), 6) pct from packets"
        f" where qr = 0 and src_prefix = (select prefix from top) and {column} is not null"
        " group by 1 order by count(*) desc, 1 limit 5"
    )


def _drill_summary(spark, sf):
    rows = concentration.top_source_summary(packets(spark, sf))
    return rounded(rows, "share_pct", "cd_pct", "top3_domain_pct")


_DRILL_SUMMARY_SQL = f"""
select (select prefix from top) prefix, count(*) queries,
  round(100e0*count(*)/{_TOTAL_Q}, 6) share_pct, {S.pct(S.n('cd = 1'), 'count(*)')} cd_pct,
  round(100e0*(select sum(c) from (select count(*) c from packets where qr = 0
     and src_prefix = (select prefix from top) and name is not null
     group by name order by 1 desc limit 3))/count(*), 6) top3_domain_pct
from packets where qr = 0 and src_prefix = (select prefix from top)"""


def _dominant(spark, sf):
    return rounded(concentration.dominant_domain_source(packets(spark, sf)), "share_pct")


_DOMINANT_SQL = f"""
select name as domain, count(*) queries,
  {S.n('src_prefix = (select prefix from top)')} queries_from_top,
  {S.pct(S.n('src_prefix = (select prefix from top)'), 'count(*)')} share_pct
from packets where qr = 0 and name = (select name from packets where qr = 0 and name is not null
  group by 1 order by count(*) desc, 1 limit 1) group by 1"""


def _profile(spark, sf):
    rows = priority.source_profile(packets(spark, sf))
    return rounded(rows, "nx_rate_pct", "share_pct")


_PROFILE_COLUMNS = (
    "prefix, query, active_minutes, responses, nxdomain,"
    " round(nx_rate_pct, 6) nx_rate_pct, round(share_pct, 6) share_pct"
)


def _ranked(df):
    return _long(rounded(df, "nx_rate_pct", "share_pct"), "rank")


def _load(spark, sf):
    profile = priority.source_profile(packets(spark, sf))
    return _ranked(priority.load_priority(profile, large_volume=500))


def _nx(spark, sf):
    profile = priority.source_profile(packets(spark, sf))
    return _ranked(
        priority.nx_priority(profile, min_responses=50, very_high=14.0, high=11.0)
    )


def _load_by_rank(spark, sf):
    rows = packets(spark, sf)
    n_minutes = one_value(temporal.steady_window(rows), "n_minutes")
    return _ranked(
        priority.load_priority_by_rank(priority.source_profile(rows), n_minutes, limit=20)
    )


def _nx_by_rank(spark, sf):
    profile = priority.source_profile(packets(spark, sf))
    return _ranked(priority.nx_priority_by_rank(profile, min_responses=50, high=12.0))


def _priority_sql(where, order, limit, reason):
    return (
        f"select *, {reason} reason from (select {_PROFILE_COLUMNS},"
        f' row_number() over (order by {order}) "rank" from profile where {where})'
        f' where "rank" <= {limit}'
    )


_ALWAYS = "active almost all the time"


def _coverage(spark, sf):
    return priority.profile_coverage(priority.source_profile(packets(spark, sf)))


def _bubble(spark, sf):
    rows = priority.bubble_set(priority.source_profile(packets(spark, sf)), high=13.0)
    return _long(_ranked(rows), "position")


_BUBBLE = (
    "top_both as (select prefix, min(rk) rk from ("
    "(select prefix, row_number() over (order by query desc, prefix) rk from profile"
    " qualify rk <= 10) union all"
    " (select prefix, 10 + row_number() over (order by nxdomain desc, prefix) rk from profile"
    " qualify rk <= 20)) group by 1), "
    "bubble as (select profile.*, rk, query > 0 and nx_rate_pct is not null plottable,"
    " coalesce(nx_rate_pct >= 13, false) high_nx,"
    " row_number() over (order by (query > 0 and nx_rate_pct is not null) desc, rk) as pos"
    " from profile join top_both using (prefix))"
)


def _bubble_labels(spark, sf):
    profile = priority.source_profile(packets(spark, sf))
    labels = priority.bubble_labels(priority.bubble_set(profile, high=13.0))
    return rounded(
        priority.bubble_label_summary(labels),
        "min_nx_rate", "max_nx_rate", "median_nx_rate", "median_query",
    )


_LABELS_SQL = """
select count(*) filter (where l) n_labelled, count(*) filter (where not l) n_rest,
  round(min(nx_rate_pct) filter (where not l), 6) min_nx_rate,
  round(max(nx_rate_pct) filter (where not l), 6) max_nx_rate,
  round(median(nx_rate_pct) filter (where not l), 6) median_nx_rate,
  median(query) filter (where not l)::double median_query
from (select *, pos <= 4 or high_nx l from bubble where plottable)"""


def _label_map(spark, sf):
    rows = packets(spark, sf)
    top = concentration.pareto_top(rows).select("prefix", "label")
    every = priority.source_profile(rows).select("prefix")
    return priority.extend_labels(top, every)


_LABEL_MAP_SQL = """
select prefix, 'S' || rk as label from
  (select prefix, row_number() over (order by query_count desc, prefix) rk from pc) where rk <= 10
union all
select prefix, 'S' || (10 + row_number() over (order by prefix)) from profile where prefix not in
  (select prefix from (select prefix from pc order by query_count desc, prefix limit 10))"""


def _minute_sources(spark, sf):
    return concentration.minute_source_counts(packets(spark, sf))


def _share(spark, sf):
    return rounded(concentration.top_share_per_minute(packets(spark, sf)), "share_pct")


_SHARE = (
    "shares as (select cal.minute, coalesce(q, 0) queries, coalesce(t, 0) top_queries,"
    " 100e0*t/nullif(q, 0) share_pct from cal left join"
    f" (select minute, count(*) q, {S.n('src_prefix = (select prefix from top)')} t"
    " from steady where qr = 0 group by 1) c on cal.minute = c.minute)"
)


def _share_summary(spark, sf):
    shares = concentration.top_share_per_minute(packets(spark, sf))
    return rounded(concentration.top_share_summary(shares), "min_pct", "median_pct", "max_pct")


def _peak_source(spark, sf):
    return concentration.peak_sources(packets(spark, sf), 1)


def _peak_sources(spark, sf):
    return concentration.peak_sources(packets(spark, sf))


def _peak_types(spark, sf):
    return concentration.peak_types(packets(spark, sf))


def _peak_sql(column, alias, limit):
    return (
        f"select {column} as {alias}, count(*) queries from packets where qr = 0"
        f" and {column} is not null and minute = (select minute from peak)"
        f" group by 1 order by count(*) desc, 1 limit {limit}"
    )


def _series_long(spark, sf):
    return _long(concentration.top_series(packets(spark, sf)), "rank")


_SERIES = (
    "top3 as (select prefix, row_number() over (order by c desc, prefix) rk from"
    " (select src_prefix prefix, count(*) c from steady where qr = 0 and src_prefix is not null"
    " group by 1) qualify rk <= 3), "
    "series as (select cal.minute, rk, top3.prefix, coalesce(c, 0)::bigint queries from cal"
    " cross join top3 left join (select minute, src_prefix, count(*) c from steady where qr = 0"
    " group by 1, 2) m on m.minute = cal.minute and m.src_prefix = top3.prefix)"
)


def _series_wide(spark, sf):
    return concentration.top_series_wide(concentration.top_series(packets(spark, sf)))


def _series_peaks(spark, sf):
    return _long(concentration.series_peaks(concentration.top_series(packets(spark, sf))), "rank")


def _peak_profile(spark, sf):
    return rounded(
        concentration.peak_profile(packets(spark, sf)),
        "nx_rate", "ratio_to_median", "top_share_peak_pct", "top_share_overall_pct",
    )


_PEAK_PROFILE_SQL = f"""
select (select minute from peak) peak_minute, count(*) packets, {S.n(S.Q)} queries,
  {S.n(S.R)} responses, {S.n(S.NX)} nx, {S.pct(S.n(S.NX), S.n(S.R))} nx_rate,
  round(count(*) / (select median(packets) from dense
        where minute <> (select minute from peak)), 6) ratio_to_median,
  {S.pct(S.n('qr = 0 and src_prefix = (select prefix from top)'), S.n(S.Q))} top_share_peak_pct,
  round(100e0*(select query_count from top)/{_TOTAL_Q}, 6) top_share_overall_pct
from packets where minute = (select minute from peak)"""


def _prefixes(spark, sf):
    return packets(spark, sf).select(
        "event_id",
        "src_ip",
        address.network_prefix("src_ip").alias("prefix"),
        address.network_prefix_or_text("src_ip").alias("prefix_or_text"),
        address.prefix_by_pattern("src_ip", 6).alias("pattern_v6"),
        address.prefix_by_pattern("src_ip", 4).alias("pattern_v4"),
    )


_PREFIXES_SQL = r"""
select event_id, src_ip, coalesce(src_prefix, 'UNKNOWN') prefix,
  case when src_prefix = 'UNKNOWN' then src_ip else src_prefix end prefix_or_text,
  regexp_extract(src_ip, '^([0-9a-fA-F:]+:[0-9a-fA-F:]+:[0-9a-fA-F:]+)', 1) pattern_v6,
  regexp_extract(src_ip, '^([0-9]+\.[0-9]+\.[0-9]+)', 1) pattern_v4
from packets"""


def _staging(spark, sf):
    rows = staging.staged(packets(spark, sf))
    numbers = [c for c, t in rows.dtypes if t == "int"]
    return _long(rows, *numbers)


_STAGING_SQL = (
    "select dt packet_timestamp, minute packet_minute, lower(proto) protocol, src_ip, dst_ip, "
    + ", ".join(f"{source}::bigint as {name}" for name, source in staging._INTEGERS.items())
    + ", case when qr = 0 then 'QUERY' else 'RESPONSE' end message_type_name, qname, qtype_name,"
    " coalesce(src_prefix, 'UNKNOWN') src_prefix from packets"
)


def _staging_pattern(spark, sf):
    rows = staging.staged(packets(spark, sf), parsed_prefix=False)
    return rows.groupBy("src_prefix").agg(F.count(F.lit(1)).alias("count"))


_STAGING_PATTERN_SQL = r"""
select case when ip_ver = 6 and src_ip is not null
            then regexp_extract(src_ip, '^([0-9a-fA-F:]+:[0-9a-fA-F:]+:[0-9a-fA-F:]+)', 1)
            when ip_ver = 4 and src_ip is not null
            then regexp_extract(src_ip, '^([0-9]+\.[0-9]+\.[0-9]+)', 1)
            else 'UNKNOWN' end src_prefix, count(*) count from packets group by 1"""

_PROF = (S.DROP_EDGES, S.STEADY, S.PROFILE)
_TOP = (S.PREFIX_COUNTS, S.TOP_PREFIX)

ENTRIES = {
    "k04_pareto_top": (_pareto_top, S.query(_PARETO_TOP_SQL, S.PREFIX_COUNTS)),
    "k05_fct_pareto": (_fct_pareto, S.query(_FULL_SQL, S.PREFIX_COUNTS)),
    "k05_pareto_mart": (
        _pareto_mart,
        S.query(
            f"select * exclude (prefix), prefix as src_prefix from ({_FULL_SQL})", _MART_COUNTS
        ),
    ),
    "k05_pareto_names": (_name_pareto, S.query(_FULL_SQL, _NAME_COUNTS)),
    "k13_profile": (_profile, S.query(f"select {_PROFILE_COLUMNS} from profile", *_PROF)),
    "k13_load": (
        _load,
        S.query(
            _priority_sql(
                "true", "query desc, active_minutes desc, prefix", 10,
                f"case when query >= 500 then 'largest volume; {_ALWAYS}' else '{_ALWAYS}' end",
            ),
            *_PROF,
        ),
    ),
    "k13_nx": (
        _nx,
        S.query(
            _priority_sql(
                "responses >= 50", "nxdomain desc, profile.nx_rate_pct desc, prefix", 10,
                "case when nx_rate_pct >= 14 then 'largest NX volume; high NX rate'"
                " when nx_rate_pct >= 11 then 'high NX rate' else 'watch the ratio' end",
            ),
            *_PROF,
        ),
    ),
    "k14_load_by_rank": (
        _load_by_rank,
        S.query(
            _priority_sql(
                "query > 0", "query desc, prefix", 20,
                "coalesce(nullif(concat_ws('; ', case when \"rank\" <= 3 then 'largest volume' end,"
                " case when active_minutes >= (select date_diff('minute', a, b) + 1 - 3 from w)"
                f" then '{_ALWAYS}' end), ''), 'routine monitoring')",
            ),
            *_PROF,
        ),
    ),
    "k14_nx_by_rank": (
        _nx_by_rank,
        S.query(
            _priority_sql(
                "responses >= 50", "nxdomain desc, prefix", 10,
                "coalesce(nullif(concat_ws('; ', case when \"rank\" <= 3 then 'largest NX volume'"
                " end, case when nx_rate_pct >= 12 then 'high NX rate' end), ''),"
                " 'watch the ratio')",
            ),
            *_PROF,
        ),
    ),
    "k18_prefix_pattern": (_by_pattern, S.query(_PATTERN_SQL)),
    "k33_sources": (_summary, S.query(_SUMMARY_SQL)),
    "k34_drill_domains": (_drill_domains, S.query(_drill_sql("name", "domain"), *_TOP)),
    "k34_drill_types": (_drill_types, S.query(_drill_sql("qtype_name", "qtype_name"), *_TOP)),
    "k34_drill_summary": (_drill_summary, S.query(_DRILL_SUMMARY_SQL, *_TOP)),
    "k35_dominant": (_dominant, S.query(_DOMINANT_SQL, *_TOP)),
    "k52_minute_sources": (
        _minute_sources,
        S.query(
            "select minute, src_prefix prefix, count(*) queries from steady where qr = 0"
            " and src_prefix is not null group by 1, 2",
            S.DROP_EDGES, S.STEADY,
        ),
    ),
    "k52_share_per_minute": (
        _share,
        S.query(
            "select minute, queries, top_queries, round(share_pct, 6) share_pct from shares",
            S.DROP_EDGES, S.CALENDAR, S.STEADY, *_TOP, _SHARE,
        ),
    ),
    "k52_summary": (
        _share_summary,
        S.query(
            "select round(min(share_pct), 6) min_pct, round(median(share_pct), 6) median_pct,"
            " round(max(share_pct), 6) max_pct, count(*) filter (where share_pct > 50)"
            " minutes_above_half from shares",
            S.DROP_EDGES, S.CALENDAR, S.STEADY, *_TOP, _SHARE,
        ),
    ),
    "k53_peak_source": (
        _peak_source, S.query(_peak_sql("src_prefix", "prefix", 1), S.MINUTES, S.PEAK),
    ),
    "k54_bubble": (
        _bubble,
        S.query(
            f"select {_PROFILE_COLUMNS}, rk as \"rank\", pos as position, plottable, high_nx"
            " from bubble",
            *_PROF, _BUBBLE,
        ),
    ),
    "k55_series_long": (
        _series_long,
        S.query(
            'select minute, rk as "rank", prefix, queries from series',
            S.DROP_EDGES, S.CALENDAR, S.STEADY, _SERIES,
        ),
    ),
    "k55_series": (
        _series_wide,
        S.query(
            "select minute, "
            + ", ".join(f"sum(queries) filter (where rk = {i})::bigint s{i}" for i in (1, 2, 3))
            + " from series group by 1",
            S.DROP_EDGES, S.CALENDAR, S.STEADY, _SERIES,
        ),
    ),
    "k55_peaks": (
        _series_peaks,
        S.query(
            'select rk as "rank", prefix, minute peak_minute, queries peak_queries from series'
            " qualify row_number() over (partition by rk order by queries desc, minute) = 1",
            S.DROP_EDGES, S.CALENDAR, S.STEADY, _SERIES,
        ),
    ),
    "k56_peak_profile": (
        _peak_profile, S.query(_PEAK_PROFILE_SQL, S.MINUTES, S.PEAK, *_TOP),
    ),
    "k56_peak_types": (
        _peak_types, S.query(_peak_sql("qtype_name", "qtype_name", 3), S.MINUTES, S.PEAK),
    ),
    "k56_peak_sources": (
        _peak_sources, S.query(_peak_sql("src_prefix", "prefix", 3), S.MINUTES, S.PEAK),
    ),
    "k68_coverage": (
        _coverage,
        S.query(
            "select count(*) prefixes, count(*) filter (where query = 0 and responses > 0)"
            " only_responses, count(*) filter (where responses = 0 and query > 0) only_queries,"
            " sum(query)::bigint queries, sum(responses)::bigint responses from profile",
            *_PROF,
        ),
    ),
    "k70_labels": (_bubble_labels, S.query(_LABELS_SQL, *_PROF, _BUBBLE)),
    "p01_staging": (_staging, S.query(_STAGING_SQL)),
    "p01_staging_pattern": (_staging_pattern, S.query(_STAGING_PATTERN_SQL)),
    "p18_label_map": (_label_map, S.query(_LABEL_MAP_SQL, S.PREFIX_COUNTS, *_PROF)),
    "x01_prefix": (_prefixes, S.query(_PREFIXES_SQL)),
}
