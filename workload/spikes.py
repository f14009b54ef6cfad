"""Checks of the spike decomposition."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from dnsight.operators import guards, spikes
from dnsight.operators.shared import one_row
from workload import sqltext as S
from workload.minutes import rounded
from workload.packets import packets
from workload.rules import registered, suffix_table


def _both(spark, sf, peak="packets", steady="drop_edges"):
    rows = packets(spark, sf)
    window = spikes.spike_window(rows, steady, peak)
    return spikes.nx_counts(rows, window), window


def _deltas(df):
    return rounded(df, "baseline", "delta")


def _host(spark, sf):
    return _deltas(spikes.spike_delta(*_both(spark, sf)))


def _host_nx_peak(spark, sf):
    return _deltas(spikes.spike_delta(*_both(spark, sf, "nx")))


def _qtype(spark, sf):
    return _deltas(spikes.spike_delta(*_both(spark, sf), "qtype"))


def _domain(spark, sf):
    return _deltas(spikes.spike_delta_domain(*_both(spark, sf, "nx"), suffix_table(spark)))


def _all(spark, sf):
    both = _both(spark, sf, "nx", "full_minutes")
    return _deltas(spikes.spike_deltas(*both, suffix_table(spark)))


_NX_ROWS = (
    registered("packets")
    + ", nxr as (select packets.*, minute = (select minute from peak) at_peak, registrable as reg"
    " from w, packets left join registered on registered.name = packets.name"
    " where qr = 1 and rcode = 3 and minute between a and b)"
)
_OTHERS = "(select date_diff('minute', a, b) from w)"


def _delta_sql(key, extra=""):
    return (
        f'select {extra} {key} as "group", count(*) filter (where at_peak) peak_count,'
        f" round(1e0*count(*) filter (where not at_peak)/{_OTHERS}, 6) baseline,"
        f" round(count(*) filter (where at_peak) - 1e0*count(*) filter (where not at_peak)"
        f"/{_OTHERS}, 6) delta from nxr where {key} is not null group by {key}"
    )


def _summary(spark, sf):
    return rounded(
        spikes.spike_summary(*_both(spark, sf, "nx")),
        "baseline_per_minute", "net_delta", "top2_share_net_pct",
    )


_SUMMARY_SQL = f"""
with d as ({_delta_sql('dst_ip')}),
t as (select count(*) filter (where at_peak) p, 1e0*count(*) filter (where not at_peak)/{_OTHERS} b
      from nxr)
select p peak_nx, round(b, 6) baseline_per_minute, round(p - b, 6) net_delta,
  case when p - b > 0 then round(100e0*(select sum(x) from (
      select count(*) filter (where at_peak) - 1e0*count(*) filter (where not at_peak)/{_OTHERS} x
      from nxr group by dst_ip order by 1 desc limit 2))/(p - b), 6) else 0e0 end top2_share_net_pct,
  {_OTHERS}::bigint n_other_minutes
from t"""


def _negative(spark, sf):
    return rounded(
        spikes.spike_reconciliation(*_both(spark, sf, "nx")), "sum_delta", "net_delta"
    )


_NEGATIVE_SQL = f"""
select count(*) filter (where delta < 0) n_negative,
  round((select count(*) filter (where at_peak)
         - 1e0*count(*) filter (where not at_peak)/{_OTHERS} from nxr), 6) sum_delta,
  round((select count(*) filter (where at_peak)
         - 1e0*count(*) filter (where not at_peak)/{_OTHERS} from nxr), 6) net_delta,
  true reconciled
from ({_delta_sql('dst_ip')})"""


def _coverage(spark, sf):
    counts, _ = _both(spark, sf)
    return rounded(spikes.nx_coverage(counts), "cov5", "cov10")


_COVERAGE_SQL = """
select round(100e0*sum(c) filter (where rk <= 5)/sum(c), 6) cov5,
  round(100e0*sum(c) filter (where rk <= 10)/sum(c), 6) cov10
from (select c, row_number() over (order by c desc, dst_ip) rk
      from (select dst_ip, count(*) c from nxr group by 1))"""


def _top2(spark, sf):
    top = spikes.top_deltas(spikes.spike_delta(*_both(spark, sf, "nx")), 2, "H")
    return _deltas(top).withColumn("rank", F.col("rank").cast("bigint"))


_TOP2_SQL = (
    f"select *, 'H' || \"rank\" as label from (select *, row_number() over"
    f' (order by delta desc, "group") "rank" from ({_delta_sql("dst_ip")})) where "rank" <= 2'
)

_FIRST_MINUTE = datetime(2026, 8, 19, 8, 1)


def _no_surge(spark, sf):
    """A minute with few errors as the peak: no net increase, so no share of it."""
    rows = packets(spark, sf)
    window = spikes.spike_window(rows, peak=_FIRST_MINUTE)
    summary = spikes.spike_summary(spikes.nx_counts(rows, window), window, empty_share=None)
    return rounded(summary, "baseline_per_minute", "net_delta", "top2_share_net_pct")


def _summary_null(spark, sf):
    summary = spikes.spike_summary(*_both(spark, sf, "nx"), empty_share=None)
    return rounded(summary, "baseline_per_minute", "net_delta", "top2_share_net_pct")


def _one_minute(spark, sf):
    """Packets of one minute: nothing to compare with, so no deltas and a summary of zeros, beside all NXDOMAIN."""
    rows = packets(spark, sf).where(F.col("dt") < F.lit(_FIRST_MINUTE).cast("timestamp_ntz"))
    window = spikes.spike_window(rows)
    counts = spikes.nx_counts(rows, window)
    found = one_row(rows.agg(F.count_if(F.expr("qr = 1 and rcode = 3")).alias("n")))
    return spikes.spike_summary(counts, window).withColumns({
        "n_deltas": one_row(spikes.spike_delta(counts, window).agg(F.count(F.lit(1)).alias("n")))["n"], "nx_rows": found["n"],
        "n_other_minutes": F.col("n_other_minutes").cast("bigint"),
    })


def _strict(spark, sf):
    return _deltas(guards.strict_spike_delta(*_both(spark, sf, "nx")))


def _strict_guard(spark, sf):
    rows = guards.spike_guard(*_both(spark, sf, "nx"))
    return rounded(rows, "sum_delta", "net_delta")


_STRICT_SQL = f"""
select {_OTHERS} + 1 n_minutes, (select minute from peak) between a and b peak_inside,
  (select count(*) from nxr where dst_ip is null) without_group,
  (select round(sum(delta), 6) from (select count(*) filter (where at_peak) - 1e0*count(*) filter (where not at_peak)/{_OTHERS} delta
     from nxr where dst_ip is not null group by dst_ip)) sum_delta,
  (select round(count(*) filter (where at_peak) - 1e0*count(*) filter (where not at_peak)/{_OTHERS}, 6) from nxr) net_delta,
  true reconciled
from w"""

_PACKET_PEAK = (S.MINUTES, S.PEAK, _NX_ROWS)
_ERROR_PEAK = (S.MINUTES, S.NX_PEAK, _NX_ROWS)
_FIRST_PEAK = f"peak as (select timestamp '{_FIRST_MINUTE}' as minute)"
_ERROR_PEAK_FULL = (S.MINUTES_FULL, S.NX_PEAK, _NX_ROWS)

ENTRIES = {
    "k10_delta_host": (_host, S.query(_delta_sql("dst_ip"), *_PACKET_PEAK)),
    "k10_delta_host_nx_peak": (_host_nx_peak, S.query(_delta_sql("dst_ip"), *_ERROR_PEAK)),
    "k10_delta_qtype": (_qtype, S.query(_delta_sql("qtype_name"), *_PACKET_PEAK)),
    "k10_delta_domain": (_domain, S.query(_delta_sql("reg"), *_ERROR_PEAK)),
    "k10_summary": (_summary, S.query(f"select * from ({_SUMMARY_SQL})", *_ERROR_PEAK)),
    "k11_summary": (_summary_null, S.query(f"select * from ({_SUMMARY_SQL.replace('else 0e0', 'else null')})", *_ERROR_PEAK)),
    "k11_no_surge": (
        _no_surge, S.query(f"select * from ({_SUMMARY_SQL.replace('else 0e0', 'else null')})", S.MINUTES, _FIRST_PEAK, _NX_ROWS),
    ),
    "q21_strict_delta": (_strict, S.query(_delta_sql("dst_ip"), *_ERROR_PEAK)),
    "q22_strict_guard": (_strict_guard, S.query(_STRICT_SQL, *_ERROR_PEAK)),
    "q25_one_minute": (
        _one_minute,
        S.query(
            "select 0::bigint peak_nx, 0e0 baseline_per_minute, 0::bigint n_other_minutes, 0e0 net_delta, 0e0 top2_share_net_pct,"
            " 0::bigint n_deltas, count(*) filter (where qr = 1 and rcode = 3) nx_rows from packets"
            " where dt < timestamp '2026-08-19 08:01:00'"
        ),
    ),
    "k12_delta_all": (
        _all,
        S.query(
            " union all ".join(
                _delta_sql(key, f"'{name}' dimension,")
                for name, key in (("host", "dst_ip"), ("qtype", "qtype_name"), ("domain", "reg"))
            ),
            *_ERROR_PEAK_FULL,
        ),
    ),
    "k57_coverage": (_coverage, S.query(_COVERAGE_SQL, *_PACKET_PEAK)),
    "k59_negative": (_negative, S.query(_NEGATIVE_SQL, *_ERROR_PEAK)),
    "k65_top2": (_top2, S.query(_TOP2_SQL, *_ERROR_PEAK)),
}
