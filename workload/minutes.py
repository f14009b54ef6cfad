"""Checks of the minute tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from dnsight.operators import temporal, traffic
from workload import sqltext as S
from workload.packets import SPARSE, packets, sparse_packets

_BASE = ["minute", "packets", "queries", "responses", "nx", "udp_resp", "udp_tc"]


def rounded(df, *columns, digits=6):
    return df.withColumns({c: F.round(c, digits) for c in columns})


def _minutes(spark, sf):
    return rounded(temporal.minute_metrics(packets(spark, sf)), "nx_rate", "tc_ratio")


def _minutes_sparse(spark, sf):
    return rounded(temporal.minute_metrics(sparse_packets(spark, sf)), "nx_rate", "tc_ratio")


def _minutes_all(spark, sf):
    rows = temporal.minute_metrics(packets(spark, sf), steady=None, empty_rate=None)
    return rounded(rows, "nx_rate", "tc_ratio")


def _any_direction(spark, sf):
    """NXDOMAIN by the code alone; some queries carry it, too."""
    code = F.when(F.expr("qr = 0 and event_id % 10 = 0"), F.lit(3)).otherwise(F.col("rcode"))
    rows = packets(spark, sf).withColumn("rcode", code)
    return rounded(temporal.minute_metrics(rows, any_direction=True), "nx_rate", "tc_ratio")


def _metrics_sql(empty: str = "0") -> str:
    return (
        f"select {', '.join(_BASE)}, coalesce({S.pct('nx', 'responses')}, {empty}) nx_rate,"
        f" coalesce({S.pct('udp_tc', 'udp_resp')}, {empty}) tc_ratio from dense"
    )


def _meta(spark, sf):
    summary = temporal.minute_summary(temporal.minute_metrics(packets(spark, sf)))
    return rounded(summary, "nx_rate_global", "tc_ratio_avg", "median_other")


_META_SQL = f"""
select count(*) n_minutes,
  (select minute from dense order by packets desc, minute limit 1) peak_minute,
  (select minute from dense order by nx desc, minute limit 1) nx_peak_minute,
  (select minute from dense order by udp_tc desc, minute limit 1) tc_peak_minute,
  (select minute from dense order by 1e0*nx/responses desc, minute limit 1) nx_rate_peak_minute,
  (select minute from dense order by 1e0*udp_tc/udp_resp desc, minute limit 1) tc_ratio_peak_minute,
  {S.pct('sum(nx)', 'sum(responses)')} nx_rate_global,
  {S.pct('sum(udp_tc)', 'sum(udp_resp)')} tc_ratio_avg,
  (select median(packets) from dense where minute <> (select minute from peak))::double median_other
from dense"""


def _extended(spark, sf):
    rows = temporal.minute_metrics_extended(packets(spark, sf))
    return rounded(rows, "nx_rate", "tc_ratio", "tcp_ratio", "throughput_mib")


def _extended_sparse(spark, sf):
    rows = temporal.minute_metrics_extended(sparse_packets(spark, sf))
    return rounded(rows, "nx_rate", "tc_ratio", "tcp_ratio", "throughput_mib")


_EXTENDED_SQL = (
    f"select {', '.join(_BASE)}, tcp_packets, {S.pct('nx', 'responses')} nx_rate,"
    f" {S.pct('udp_tc', 'udp_resp')} tc_ratio, {S.pct('tcp_packets', 'packets')} tcp_ratio,"
    " round(frame_bytes / 1048576e0, 6) throughput_mib from dense"
)


def _kpis(spark, sf):
    return traffic.kpis(packets(spark, sf))


def _minute_counts(spark, sf):
    rows = temporal.minute_counts(packets(spark, sf), any_direction=True)
    return rows.select(*_BASE)


def _rates(spark, sf):
    return rounded(
        temporal.nx_rates(packets(spark, sf)),
        "nx_rate", "nx_rate_global", "nx_rate_difference", "nx_one_in", "tc_one_in",
    )


_RATES_SQL = f"""
select minute, nx, responses, round(rate, 6) nx_rate, round(g, 6) nx_rate_global,
  round(rate - g, 6) nx_rate_difference, round(100e0 / g, 6) nx_one_in,
  round(100e0 / t, 6) tc_one_in
from (select *, 100e0*nx/responses rate,
        (select 100e0*{S.n(S.NX)}/{S.n(S.R)} from packets) g,
        (select 100e0*sum(udp_tc)/sum(udp_resp) from dense) t from dense)"""

_STATS = ["packets", "tcp_ratio", "nx_rate", "tc_ratio", "throughput_mib"]


def _statistics(spark, sf):
    stats = temporal.minute_statistics(
        temporal.minute_metrics_extended(packets(spark, sf)), _STATS
    )
    return rounded(stats, "mean", "std", "min", "p25", "p50", "p75", "max")


_LONG = {
    "packets": "packets::double",
    "tcp_ratio": "100e0*tcp_packets/nullif(packets, 0)",
    "nx_rate": "100e0*nx/nullif(responses, 0)",
    "tc_ratio": "100e0*udp_tc/nullif(udp_resp, 0)",
    "throughput_mib": "frame_bytes/1048576e0",
}
_STATS_SQL = (
    "select metric, count(v) count, round(avg(v), 6) mean, round(stddev_samp(v), 6) std,"
    " round(min(v), 6) min, round(quantile_cont(v, 0.25), 6) p25,"
    " round(quantile_cont(v, 0.5), 6) p50, round(quantile_cont(v, 0.75), 6) p75,"
    " round(max(v), 6) max from ("
    + " union all ".join(f"select '{k}' metric, {e} v from dense" for k, e in _LONG.items())
    + ") group by metric"
)


def _calendar(spark, sf):
    window = temporal.steady_window(sparse_packets(spark, sf), "full_minutes")
    return temporal.calendar(window)


def _window(spark, sf):
    rows = packets(spark, sf)
    result = None
    for rule in temporal.STEADY_RULES:
        part = temporal.steady_window(rows, rule).withColumn("rule", F.lit(rule or "all"))
        result = part if result is None else result.unionByName(part)
    return result


_WINDOW_SQL = " union all ".join(
    f"select '{rule}' as rule, a first_minute, b last_minute,"
    f" (date_diff('minute', a, b) + 1)::bigint n_minutes from {name}"
    for rule, name in (("drop_edges", "w1"), ("full_minutes", "w2"), ("all", "w3"))
)
_WINDOW_CTES = ", ".join(
    [S.EDGES]
    + [
        rule.replace(S.EDGES + ", ", "").replace("w as", f"{name} as")
        for rule, name in ((S.DROP_EDGES, "w1"), (S.FULL_MINUTES, "w2"), (S.ALL_MINUTES, "w3"))
    ]
)

ENTRIES = {
    "k01_minute_metrics": (_minutes, S.query(_metrics_sql(), S.MINUTES)),
    "k01_any_direction": (
        _any_direction,
        S.query(
            _metrics_sql(),
            S.MINUTES.replace(f"{S.n(S.NX)} nx", f"{S.n('rcode = 3 or qr = 0 and event_id % 10 = 0')} nx"),
        ),
    ),
    "k01_minute_metrics_sparse": (
        _minutes_sparse, S.query(_metrics_sql(), S.MINUTES, slow=SPARSE),
    ),
    "k01_minute_metrics_all": (_minutes_all, S.query(_metrics_sql("null"), S.MINUTES_ALL)),
    "k01_meta": (_meta, S.query(_META_SQL, S.MINUTES, S.PEAK)),
    "k02_minute_metrics_ext": (_extended, S.query(_EXTENDED_SQL, S.MINUTES_FULL)),
    "k02_minute_metrics_ext_sparse": (
        _extended_sparse, S.query(_EXTENDED_SQL, S.MINUTES_FULL, slow=SPARSE),
    ),
    "k16_kpis": (
        _kpis,
        S.query(
            f"select count(*) total_packets, {S.n(S.Q)} total_queries, {S.n(S.R)} total_responses,"
            f" {S.n('rcode = 3')} total_nxdomain, {S.n(S.UR)} udp_responses,"
            f" {S.n(S.TC)} udp_truncated from packets"
        ),
    ),
    "k17_minute_counts": (
        _minute_counts,
        S.query(
            f"select minute, count(*) packets, {S.n(S.Q)} queries, {S.n(S.R)} responses,"
            f" {S.n('rcode = 3')} nx, {S.n(S.UR)} udp_resp, {S.n(S.TC)} udp_tc"
            " from packets group by 1"
        ),
    ),
    "k63_rates": (_rates, S.query(_RATES_SQL, S.MINUTES_FULL)),
    "k66_minute_stats": (_statistics, S.query(_STATS_SQL, S.MINUTES_FULL)),
    "k67_calendar": (
        _calendar, S.query("select minute from cal", S.FULL_MINUTES, S.CALENDAR, slow=SPARSE),
    ),
    "k67_steady_window": (_window, S.query(_WINDOW_SQL, _WINDOW_CTES)),
}
