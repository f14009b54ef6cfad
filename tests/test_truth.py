"""Results worked out by hand."""

from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from dnsight.operators import concentration, priority, quality, spikes, temporal, traffic
from dnsight.operators.suffix import default_rules, with_registrable
from dnsight.plans import marts, staging
from tests.helpers import START, frame, nx, query, response, rows_of, shared_fixture


def window_of(spark, minutes, peak):
    return spark.createDataFrame(
        [(START, START + timedelta(minutes=minutes - 1), minutes, START + timedelta(minutes=peak),
          minutes - 1 if minutes > 1 else None)],
        "first_minute timestamp_ntz, last_minute timestamp_ntz, n_minutes bigint,"
        " peak_minute timestamp_ntz, n_other bigint",
    )


def test_nx_rate_is_a_share_of_responses(spark):
    rows = [query()] * 60 + [response(rcode=3)] * 10 + [response()] * 30
    (found,) = rows_of(temporal.minute_metrics(frame(spark, rows)))
    assert (found["packets"], found["queries"], found["responses"], found["nx"]) == (100, 60, 40, 10)
    assert found["nx_rate"] == 25.0


def test_truncation_is_a_share_of_udp_responses(spark):
    rows = (
        [query()] * 30 + [response(proto="tcp")] * 20 + [response()] * 45 + [response(tc=1)] * 5
    )
    (found,) = rows_of(temporal.minute_metrics(frame(spark, rows)))
    assert (found["udp_resp"], found["udp_tc"], found["tc_ratio"]) == (50, 5, 10.0)


def test_empty_minutes_are_filled(spark):
    packets = frame(spark, [query(0), response(2)])
    dense = rows_of(temporal.minute_metrics(packets, steady=None))
    assert [r["packets"] for r in dense] == [1, 0, 1]
    assert (dense[1]["nx_rate"], dense[1]["tc_ratio"]) == (0.0, 0.0)
    strict = rows_of(temporal.minute_metrics(packets, steady=None, empty_rate=None))
    assert strict[1]["nx_rate"] is None


def test_steady_rules(spark):
    packets = frame(spark, [query(m, second=30) for m in range(4)])

    def minutes(rule):
        return [r["minute"].minute for r in rows_of(temporal.minute_metrics(packets, rule))]

    assert minutes("drop_edges") == [1, 2]
    assert minutes("full_minutes") == [1, 2]
    assert minutes(None) == [0, 1, 2, 3]
    two = frame(spark, [query(0), query(1)])
    assert temporal.minute_metrics(two, "drop_edges").count() == 2
    # A first packet exactly on the minute makes that minute a full one.
    assert temporal.minute_metrics(two, "full_minutes").count() == 1
    with pytest.raises(ValueError):
        temporal.steady_window(two, "other")


def test_empty_table(spark):
    empty = frame(spark, [])
    assert temporal.minute_metrics(empty).collect() == []
    (meta,) = rows_of(temporal.minute_summary(temporal.minute_metrics(empty)))
    assert meta["n_minutes"] == 0 and meta["peak_minute"] is None
    assert rows_of(concentration.pareto_top(empty)) == []
    assert rows_of(quality.not_empty(empty)) == [{"failed": 1}]


def summary_of(spark, packets, window):
    (found,) = rows_of(spikes.spike_summary(spikes.nx_counts(packets, window), window))
    return found


def deltas_of(packets, window, dimension="host"):
    rows = spikes.spike_delta(spikes.nx_counts(packets, window), window, dimension)
    return {r["group"]: r["delta"] for r in rows_of(rows)}


def test_baseline_leaves_the_peak_out(spark):
    packets = frame(spark, nx(0, "h1", 2) + nx(1, "h1", 10) + nx(2, "h1", 4))
    found = summary_of(spark, packets, window_of(spark, 3, 1))
    assert (found["peak_nx"], found["baseline_per_minute"], found["net_delta"]) == (10, 3.0, 7.0)


def test_negative_deltas_are_kept(spark):
    packets = frame(
        spark,
        nx(0, "A", 1) + nx(0, "B", 3) + nx(0, "C", 2) + nx(1, "A", 5) + nx(1, "B", 1)
        + nx(1, "C", 4),
    )
    window = window_of(spark, 2, 1)
    assert deltas_of(packets, window) == {"A": 4.0, "B": -2.0, "C": 2.0}
    counts = spikes.nx_counts(packets, window)
    (check,) = rows_of(spikes.spike_reconciliation(counts, window))
    assert check == {"n_negative": 1, "sum_delta": 4.0, "net_delta": 4.0, "reconciled": True}


def test_no_surge_has_no_share(spark):
    packets = frame(spark, nx(0, "A", 2) + nx(1, "A", 1))
    window = window_of(spark, 2, 1)
    found = summary_of(spark, packets, window)
    assert found["net_delta"] < 0 and found["top2_share_net_pct"] == 0.0
    counts = spikes.nx_counts(packets, window)
    (other,) = rows_of(spikes.spike_summary(counts, window, empty_share=None))
    assert other["top2_share_net_pct"] is None


def test_burst(spark):
    packets = frame(spark, nx(0, "A", 2) + nx(0, "B", 1) + nx(1, "A", 4) + nx(1, "B", 1))
    window = window_of(spark, 2, 1)
    found = summary_of(spark, packets, window)
    assert (found["peak_nx"], found["baseline_per_minute"], found["net_delta"]) == (5, 3.0, 2.0)
    assert deltas_of(packets, window)["A"] == 2.0


def test_minutes_without_errors_count_for_the_baseline(spark):
    packets = frame(spark, nx(0, "A", 3) + nx(3, "A", 6) + [query(m) for m in range(4)])
    window = spikes.spike_window(packets, steady=None, peak="nx")
    found = summary_of(spark, packets, window)
    assert (found["n_other_minutes"], found["baseline_per_minute"]) == (3, 1.0)


def test_one_minute_gives_an_empty_decomposition(spark):
    packets = frame(spark, nx(0, "A", 3))
    window = spikes.spike_window(packets)
    assert deltas_of(packets, window) == {}
    assert summary_of(spark, packets, window) == {
        "peak_nx": 0, "baseline_per_minute": 0.0, "net_delta": 0.0, "top2_share_net_pct": 0.0,
        "n_other_minutes": 0,
    }


def test_peak_by_name_or_moment(spark):
    packets = frame(spark, [query(1)] * 5 + nx(2, "A", 2) + [query(0), query(3)])
    assert rows_of(spikes.spike_window(packets))[0]["peak_minute"] == START + timedelta(minutes=1)
    by_nx = rows_of(spikes.spike_window(packets, peak="nx"))[0]
    assert by_nx["peak_minute"] == START + timedelta(minutes=2)
    moment = START + timedelta(minutes=2, seconds=7)
    fixed = rows_of(spikes.spike_window(packets, peak=moment))[0]
    assert fixed["peak_minute"] == START + timedelta(minutes=2) and fixed["n_other"] == 1
    outside = spikes.spike_window(packets, peak=START + timedelta(minutes=9))
    assert rows_of(outside)[0]["n_other"] is None
    with pytest.raises(ValueError):
        spikes.spike_window(packets, peak="other")


def test_shared_fixture(spark):
    packets = shared_fixture(spark)
    (kpis,) = rows_of(traffic.kpis(packets))
    assert kpis == {
        "total_packets": 120, "total_queries": 60, "total_responses": 60, "total_nxdomain": 0,
        "udp_responses": 48, "udp_truncated": 0,
    }
    minutes = rows_of(temporal.minute_metrics(packets))
    assert [(r["packets"], r["queries"], r["responses"]) for r in minutes] == [(60, 30, 30)] * 2
    (top,) = rows_of(concentration.pareto_top(packets))
    assert (top["prefix"], top["label"], top["share_pct"]) == ("2001:db8:1111::/48", "S1", 100.0)
    matrix = rows_of(traffic.protocol_matrix(packets))
    assert {r["qtype_name"]: r["response_count"] for r in matrix} == {"A": 20, "AAAA": 20, "ANY": 20}
    assert {r["row_percentage"] for r in matrix} == {100.0}
    assert traffic.truncation_by_qtype(packets, min_responses=500).collect() == []
    assert traffic.truncation_by_qtype(packets, min_responses=10).count() == 3


def test_data_tests_pass_on_clean_data(spark):
    stg = staging.staged(shared_fixture(spark).withColumns(
        {c: F.lit(1).cast("tinyint") for c in ("ip_ver", "opcode", "aa", "rd", "ra", "edns")}
    ).withColumns(
        {c: F.lit(1) for c in ("src_port", "dst_port", "dns_id", "ancount", "qtype",
                               "edns_udpsize")}
    ))
    assert len(stg.columns) == 27
    tests = marts.data_tests(
        stg, marts.temporal_mart(stg), marts.pareto_mart(stg), marts.protocol_mart(stg)
    )
    found = rows_of(tests)
    assert len(found) == 16 and all(r["failures"] == 0 for r in found)


@pytest.mark.parametrize(
    "broken, column",
    [
        ({"qr": 2}, "qr"), ({"qr": 99}, "qr"), ({"proto": "icmp"}, "proto"),
        ({"rcode": 99}, "rcode"), ({"frame_len": 0}, "frame_len"),
        ({"frame_len": -50}, "frame_len"), ({"qdcount": 50}, "qdcount"), ({"tc": 7}, "tc"),
        ({"dns_len": -1}, "dns_len"), ({"tc": None}, "tc"), ({"proto": None}, "proto"),
    ],
)
def test_contract(spark, broken, column):
    packets = frame(spark, [query(), response(), query(**broken)])
    assert [r["column"] for r in rows_of(quality.contract_failures(packets))] == [column]
    (summary,) = rows_of(quality.contract_summary(packets))
    assert summary == {"status": "FAILED", "validated_rows": 3, "n_failures": 1}


def test_contract_passes_and_accepts_texts(spark):
    packets = frame(spark, [query(), response()])
    (summary,) = rows_of(quality.contract_summary(packets))
    assert summary == {"status": "PASSED", "validated_rows": 2, "n_failures": 0}
    texts = packets.withColumn("qr", F.when(F.col("qr") == 0, "0").otherwise("x"))
    assert rows_of(quality.contract_failures(texts)) == [
        {"column": "qr", "check": "isin", "failure_case": "x"}
    ]
    (sample,) = rows_of(quality.contract_summary(packets, sample_size=1))
    assert sample["validated_rows"] == 1


def test_require_clean(spark):
    packets = frame(spark, [query(src_ip=None), response()])
    checks = quality.fail_fast_checks(packets, time_text=None)
    with pytest.raises(ValueError, match="query without src_ip: 1"):
        quality.require_clean(checks)
    quality.require_clean(quality.fail_fast_checks(frame(spark, [query()]), time_text=None))
    missing = [r["column"] for r in rows_of(quality.missing_columns(packets))]
    assert missing == ["ts_iso"]


def test_registrable_domains(spark):
    cases = {
        "api.google.com": "google.com", "sub.service.co.id": "service.co.id", "": "UNKNOWN",
        "localhost": "localhost", "a.b.example.id": "example.id", "co.id": "co.id",
        "x.co.uk": "x.co.uk", "www.ck": "www.ck", "a.www.ck": "www.ck", "a.b.c.ck": "b.c.ck",
        "c.ck": "c.ck", "ck": "ck", "q.unknowntld": "q.unknowntld",
        "a.b.q.unknowntld": "q.unknowntld", "com": "com",
    }
    names = spark.createDataFrame([(n, len(n)) for n in cases], "name string, size int")
    found = rows_of(with_registrable(names, default_rules(spark)))
    assert {r["name"]: r["registrable"] for r in found} == cases
    assert all(r["size"] == len(r["name"]) for r in found)


def test_priority_counts_both_directions(spark):
    packets = frame(
        spark,
        [query(m) for m in (0, 1, 1, 2)] + [response(1), response(1, rcode=3)]
        + [query(1, src_ip="10.0.0.1")] + [response(2, dst_ip="bad")],
    )
    profile = priority.source_profile(packets, steady=None)
    found = {r["prefix"]: r for r in rows_of(profile)}
    client = found["2001:db8:1111::/48"]
    assert (client["query"], client["active_minutes"], client["responses"], client["nxdomain"]) == (
        4, 3, 2, 1,
    )
    assert client["nx_rate_pct"] == 50.0 and client["share_pct"] == 80.0
    assert found["10.0.0.0/24"]["nx_rate_pct"] is None
    assert found["UNKNOWN"]["responses"] == 1
    (coverage,) = rows_of(priority.profile_coverage(profile))
    assert (coverage["only_responses"], coverage["only_queries"]) == (1, 1)


def test_labels(spark):
    known = spark.createDataFrame([("b", "S1"), ("z", "S3")], "prefix string, label string")
    new = spark.createDataFrame([("c",), ("a",), ("b",), ("c",)], "prefix string")
    labels = priority.extend_labels(known, new)
    assert {r["prefix"]: r["label"] for r in rows_of(labels)} == {
        "b": "S1", "z": "S3", "a": "S4", "c": "S5",
    }
    assert rows_of(quality.label_checks(labels)) == [
        {"duplicate_labels": 0, "malformed_labels": 0}
    ]
    bad = spark.createDataFrame([("a", "S1"), ("b", "S1"), ("c", "S0")], "prefix string, label string")
    assert rows_of(quality.label_checks(bad)) == [{"duplicate_labels": 1, "malformed_labels": 1}]
    named = priority.label_or_text(spark.createDataFrame([("b",), ("q",)], "prefix string"), labels)
    assert {r["prefix"]: r["label"] for r in rows_of(named)} == {"b": "S1", "q": "q"}


def test_duplicates(spark):
    one, two = query(0), query(1)
    changed = query(1, frame_len=7)
    packets = frame(spark, [one, one, one, two, changed, response(3)])
    found = rows_of(quality.duplicate_audit(packets, ["dt", "src_ip", "qname", "qr"]))
    assert found == [{"exact": 2, "by_key": 3}]
