"""Checks of contracts, column tests and reconciliations."""

from __future__ import annotations

from pyspark.sql import functions as F

from dnsight.operators import concentration, priority, quality, spikes, temporal
from dnsight.plans import checked, marts, staging
from workload import sqltext as S
from workload.packets import (
    dirty_packets, duck_dirty_cte, duck_repeated_cte, packets, repeated_packets,
)

_RULES = {
    "qr": ("isin", "coalesce(qr in (0, 1), false)"),
    "proto": ("isin", "coalesce(proto in ('udp', 'tcp'), false)"),
    "rcode": ("in_range", "rcode is null or rcode between 0 and 23"),
    "qdcount": ("in_range", "coalesce(qdcount between 0 and 20, false)"),
    "frame_len": ("greater_than", "coalesce(frame_len > 0, false)"),
    "dns_len": ("greater_than_or_equal_to", "coalesce(dns_len >= 0, false)"),
    "tc": ("isin", "coalesce(tc in (0, 1), false)"),
}
_FAILURES = "failures as (" + " union all ".join(
    f"select event_id, '{c}' as \"column\", '{check}' as \"check\", {c}::varchar failure_case"
    f" from dirty where not ({passes})"
    for c, (check, passes) in _RULES.items()
) + ")"


def _failures(spark, sf):
    return quality.contract_failures(dirty_packets(spark, sf), "event_id")


def _summary(spark, sf):
    return quality.contract_summary(dirty_packets(spark, sf))


def _summary_clean(spark, sf):
    return quality.contract_summary(packets(spark, sf))


def _with_text_time(rows):
    text = F.concat(F.date_format("dt", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("Z"))
    return rows.withColumn(
        "ts_iso", F.when(F.col("event_type") == "error", "not a time").otherwise(text)
    )


def _fail_fast(spark, sf):
    return quality.fail_fast_checks(_with_text_time(dirty_packets(spark, sf)))


_FAIL_FAST_SQL = " union all ".join(
    f"select '{name}' as \"check\", count(*) filter (where {condition}) failures from dirty"
    for name, condition in (
        ("qr outside 0, 1", "not coalesce(qr in (0, 1), false)"),
        ("tc outside 0, 1", "not coalesce(tc in (0, 1), false)"),
        ("proto outside udp, tcp", "not coalesce(proto in ('udp', 'tcp'), false)"),
        ("response without rcode", "qr = 1 and rcode is null"),
        ("query without src_ip", "qr = 0 and src_ip is null"),
        ("response without dst_ip", "qr = 1 and dst_ip is null"),
        ("unreadable time", "event_type = 'error'"),
    )
) + " union all select 'empty table', (count(*) = 0)::bigint from dirty"


def _required(spark, sf):
    rows = packets(spark, sf)
    missing = quality.missing_columns(rows)
    present = rows.agg(F.count(F.lit(1)).alias("rows"))
    return present.select("rows", missing.agg(
        F.array_join(F.array_sort(F.collect_list("column")), ",").alias("m")
    ).select("m").scalar().alias("missing"))


def _marts(spark, sf, source=packets):
    stg = staging.staged(source(spark, sf))
    return stg, marts.temporal_mart(stg), marts.pareto_mart(stg), marts.protocol_mart(stg)


def _not_null(spark, sf):
    stg, temporal_mart, pareto, _ = _marts(spark, sf, dirty_packets)
    return marts.not_null_tests(stg, temporal_mart, pareto)


_NOT_NULL_SQL = """
select 'staging' model, 'packet_timestamp' as "column", count(*) filter (where dt is null) failures
  from dirty
union all select 'staging', 'message_type', count(*) filter (where qr is null) from dirty
union all select 'staging', 'protocol', count(*) filter (where proto is null) from dirty
union all select 'staging', 'response_code', count(*) filter (where qr = 1 and rcode is null) from dirty
union all select 'temporal', 'packet_minute', count(*) filter (where minute is null) from dirty
union all select 'temporal', 'total_packets', 0
union all select 'pareto', 'prefix_rank', 0
union all select 'pareto', 'src_prefix', 0"""


def _unique(spark, sf):
    rows = packets(spark, sf)
    return quality.unique(rows, "qname")


def _accepted(spark, sf):
    rows = dirty_packets(spark, sf)
    parts = [
        quality.accepted_values(rows, c, values).withColumn("column", F.lit(c))
        for c, values in (("qr", [0, 1]), ("proto", ["udp", "tcp"]), ("tc", [0, 1]))
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


_ACCEPTED_SQL = " union all ".join(
    f"select {c}::varchar as value, count(*) n, '{c}' as \"column\" from dirty"
    f" where {c} not in ({values}) group by {c}"
    for c, values in (("qr", "0, 1"), ("proto", "'udp', 'tcp'"), ("tc", "0, 1"))
)


def _totals(spark, sf):
    stg, temporal_mart, _, _ = _marts(spark, sf)
    return quality.total_mismatch(stg, temporal_mart)


def _pareto_valid(spark, sf):
    return quality.pareto_first_rank(_marts(spark, sf)[2])


def _matrix_valid(spark, sf):
    # A band that no row sum lies in shows the sums themselves.
    return quality.matrix_row_sums(_marts(spark, sf)[3], 200.0, 201.0)


_MATRIX_SQL = """
select qtype_name, round(sum(row_percentage), 1) total_share from (
  select qtype_name, round(100e0*c/sum(c) over (partition by qtype_name), 2) row_percentage
  from (select qtype_name, rcode, count(*) c from packets
        where qr = 1 and qtype_name is not null group by 1, 2)) group by 1"""


def _not_empty(spark, sf):
    return quality.not_empty(staging.staged(packets(spark, sf)))


def _data_tests(spark, sf):
    stg = staging.staged(dirty_packets(spark, sf))
    return marts.data_tests(stg, *marts.build_marts(stg))


_DATA_TESTS_SQL = f"""
select concat_ws(' ', 'not_null', model, "column") test, failures from ({_NOT_NULL_SQL})
union all select 'unique temporal packet_minute', 0
union all select 'unique pareto prefix_rank', 0
union all select 'accepted_values staging message_type',
  count(distinct qr) filter (where qr not in (0, 1)) from dirty
union all select 'accepted_values staging protocol',
  count(distinct proto) filter (where proto not in ('udp', 'tcp')) from dirty
union all select 'temporal total equals staging total', 0
union all select 'first pareto share in range', 0
union all select 'matrix rows add up to 100', 0
union all select 'staging has rows', 0"""


def _guard(spark, sf):
    rows = packets(spark, sf)
    window = spikes.spike_window(rows)
    return quality.window_guard(window, spikes.nx_in_window(rows, window), "qname")


_GUARD_SQL = """
select date_diff('minute', a, b) >= 1 enough_minutes, true peak_inside,
  (select count(*) from steady where qr = 1 and rcode = 3 and qname is null) rows_without_group
from w"""


def _profile(spark, sf):
    rows = packets(spark, sf)
    inside = temporal.in_window(temporal.steady_window(rows))
    return quality.profile_reconciliation(priority.source_profile(rows), rows, inside)


_PROFILE_SQL = """
select count(*) filter (where qr = 0) queries,
  count(*) filter (where qr = 0 and src_ip is null) queries_without_source,
  count(*) filter (where qr = 1) responses,
  count(*) filter (where qr = 1 and dst_ip is null) responses_without_host,
  count(*) filter (where qr = 1 and rcode is null) responses_without_rcode,
  (select sum(query)::bigint from profile) profile_queries,
  (select sum(responses)::bigint from profile) profile_responses, true reconciled
from steady"""


def _labels(spark, sf):
    rows = packets(spark, sf)
    top = concentration.pareto_top(rows).select("prefix", "label")
    every = priority.source_profile(rows).select("prefix")
    return quality.label_checks(priority.extend_labels(top, every))


def _duplicates(spark, sf):
    return quality.duplicate_audit(repeated_packets(spark, sf))


_KEY = "ts, src_ip, src_port, dst_ip, dst_port, dns_id, qname, qr"
_DUPLICATES_SQL = f"""
select (select sum(c - 1)::bigint from
          (select count(*) c from repeated group by event_id, frame_len, {_KEY})) exact,
  (select sum(c - 1)::bigint from (select count(*) c from repeated group by {_KEY})) by_key"""

def _checked(spark, sf):
    return checked.build_checked_marts(dirty_packets(spark, sf))


_BY_RULE_SQL = " union all ".join(
    f"select '{c}' as \"column\", '{check}' as \"check\", count(*) filter (where not ({passes})) failures from dirty"
    for c, (check, passes) in _RULES.items()
)


def _pareto_broken(spark, sf):
    """Ranking whose first share has a wrong sign, one with a share beyond one hundred, and the right one."""
    pareto = _marts(spark, sf)[2]
    share = F.col("cumulative_share_pct")
    parts = [("right", share), ("negative", -share), ("beyond", share + 100.0)]
    found = [
        quality.pareto_first_rank(pareto.withColumn("cumulative_share_pct", F.round(value, 3))).select(
            F.lit(name).alias("case"), "src_prefix", "cumulative_share_pct"
        )
        for name, value in parts
    ]
    return found[0].unionByName(found[1]).unionByName(found[2])


_PARETO_BROKEN_SQL = """
select k as "case", prefix as src_prefix, round(case k when 'negative' then -s else s + 100 end, 3) cumulative_share_pct
from (select prefix, round(100e0*query_count/(select count(*) from packets where qr = 0), 3) s from top), (values ('negative'), ('beyond')) t(k)"""


def _not_empty_cases(spark, sf):
    stg = staging.staged(packets(spark, sf))
    parts = [("all", stg), ("none", stg.where("qname = 'no such name'")), ("errors", stg.where("response_code = 3"))]
    found = [quality.not_empty(rows).select(F.lit(name).alias("case"), "failed") for name, rows in parts]
    return found[0].unionByName(found[1]).unionByName(found[2])


_NOT_EMPTY_SQL = " union all ".join(
    f"select '{name}' as \"case\", 1 as failed from (select count(*) c from packets where {where}) where c = 0"
    for name, where in (("all", "true"), ("none", "qname = 'no such name'"), ("errors", "rcode = 3"))
)


def _labels_broken(spark, sf):
    """Labels by volume, of which some repeat and some are not labels."""
    rows = concentration.pareto_full(
        packets(spark, sf).where("qr = 0 and src_ip is not null").groupBy("src_ip").agg(F.count(F.lit(1)).alias("n")), "src_ip", "n"
    )
    rank = F.col("prefix_rank")
    label = F.when(rank % 7 == 0, F.concat(F.lit("X"), rank)).when(rank % 11 == 0, F.concat(F.lit("S0"), rank)).otherwise(
        F.concat(F.lit("S"), F.floor(rank / 2) + 1)
    )
    return quality.label_checks(rows.select(F.col("src_ip").alias("prefix"), label.alias("label")))


_LABELS_BROKEN_SQL = r"""
select count(*) - count(distinct label) duplicate_labels,
  count(*) filter (where not regexp_matches(label, '^S[1-9][0-9]*$')) malformed_labels
from (select case when rk % 7 = 0 then 'X' || rk when rk % 11 = 0 then 'S0' || rk else 'S' || (rk // 2 + 1) end as label
  from (select unnest(range(1, c + 1)) rk from (select count(distinct src_ip) c from packets where qr = 0)))"""

_DIRTY = duck_dirty_cte()

ENTRIES = {
    "q01_contract_failures": (
        _failures, S.query("select * from failures", _FAILURES, base=_DIRTY),
    ),
    "q01_summary": (
        _summary,
        S.query(
            "select 'FAILED' status, (select count(*) from dirty) validated_rows,"
            " (select count(*) from failures) n_failures",
            _FAILURES, base=_DIRTY,
        ),
    ),
    "q01_summary_clean": (
        _summary_clean,
        S.query("select 'PASSED' status, count(*) validated_rows, 0::bigint n_failures from packets"),
    ),
    "q09_required": (
        _required, S.query("select count(*) as rows, 'ts_iso' as missing from packets"),
    ),
    "q10_q13_fail_fast": (_fail_fast, S.query(_FAIL_FAST_SQL, base=_DIRTY)),
    "q14_not_null": (_not_null, S.query(_NOT_NULL_SQL, base=_DIRTY)),
    "q15_unique": (
        _unique,
        S.query(
            "select qname, count(*) n from packets where qname is not null group by 1"
            " having count(*) > 1"
        ),
    ),
    "q16_accepted": (_accepted, S.query(_ACCEPTED_SQL, base=_DIRTY)),
    "q17_totals": (
        _totals,
        S.query(
            "select count(*) stg_total, count(*) mart_total, count(*) = 0 failed from packets"
        ),
    ),
    "q18_pareto": (
        _pareto_valid,
        S.query(
            "select 1::bigint prefix_rank, ''::varchar src_prefix, 1::bigint query_count,"
            " 1e0 share_pct, 1e0 cumulative_share_pct, true is_pareto_top_80"
            " from (select count(*) filter (where qr = 0) c from packets) where c = 0"
        ),
    ),
    "q19_matrix": (_matrix_valid, S.query(_MATRIX_SQL)),
    "q20_not_empty": (
        _not_empty,
        S.query("select 1 failed from (select count(*) c from packets) where c = 0"),
    ),
    "q14_q20_data_tests": (_data_tests, S.query(_DATA_TESTS_SQL, base=_DIRTY)),
    "q14_q20_checked": (
        lambda spark, sf: _checked(spark, sf).tests, S.query(_DATA_TESTS_SQL, base=_DIRTY),
    ),
    "q01_checked_rules": (lambda spark, sf: _checked(spark, sf).contract, S.query(_BY_RULE_SQL, base=_DIRTY)),
    "q01_checked_summary": (
        lambda spark, sf: _checked(spark, sf).summary,
        S.query(
            "select 'FAILED' status, (select count(*) from dirty) validated_rows,"
            " (select count(*) from failures) n_failures",
            _FAILURES, base=_DIRTY,
        ),
    ),
    "q18_pareto_broken": (_pareto_broken, S.query(_PARETO_BROKEN_SQL, S.PREFIX_COUNTS, S.TOP_PREFIX)),
    "q20_not_empty_cases": (_not_empty_cases, S.query(_NOT_EMPTY_SQL)),
    "q24_labels_broken": (_labels_broken, S.query(_LABELS_BROKEN_SQL)),
    "q21_window_guard": (_guard, S.query(_GUARD_SQL, S.DROP_EDGES, S.STEADY)),
    "q23_profile": (_profile, S.query(_PROFILE_SQL, S.DROP_EDGES, S.STEADY, S.PROFILE)),
    "q24_labels": (
        _labels,
        S.query(
            "select 0::bigint duplicate_labels, 0::bigint malformed_labels from"
            " (select count(*) from packets)"
        ),
    ),
    "k51_duplicates": (_duplicates, S.query(_DUPLICATES_SQL, base=duck_repeated_cte())),
}
