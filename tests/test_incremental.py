"""Marts by capture, and mergeable sketches, against one pass over all packets."""

import os

import pytest
from pyspark.sql import functions as F

from dnsight.operators import shared, sketches
from dnsight.plans import incremental, marts, staging
from tests.conftest import SF_SMALL
from workload.packets import dirty_packets, packets


def same(a, b):
    assert a.columns == b.columns and sorted(map(str, a.collect())) == sorted(map(str, b.collect()))


@pytest.mark.parametrize("source", [packets, dirty_packets])
def test_two_halves_equal_one_load(spark, folder, source):
    rows, path = source(spark, SF_SMALL), os.path.join(folder, "state")
    incremental.load_capture(rows.where("event_id % 2 = 0 or event_id % 7 = 0"), path, "a")
    incremental.load_capture(rows.where("event_id % 2 = 1 and event_id % 7 > 0"), path, "b")
    # A second load of a capture replaces the first.
    incremental.load_capture(rows.where("false"), path, "c")
    before = {name: os.path.getmtime(os.path.join(path, "capture=b", name)) for name in os.listdir(os.path.join(path, "capture=b"))}
    incremental.load_capture(rows.where("event_id % 2 = 0"), path, "a")
    incremental.load_capture(rows.where("event_id % 2 = 1 and event_id % 7 = 0"), path, "c")
    assert before == {name: os.path.getmtime(os.path.join(path, "capture=b", name)) for name in before}
    states, stg = incremental.state(spark, path), staging.staged(rows)
    same(incremental.temporal_mart(states), marts.temporal_mart(stg))
    same(incremental.pareto_mart(states), marts.pareto_mart(stg))
    same(incremental.protocol_mart(states), marts.protocol_mart(stg))


def test_merged_sketches_are_near_the_exact_values(spark):
    rows = packets(spark, "/root/testdata/sf0.01")
    parts = sketches.minute_sketches(rows)
    found = {r["qr"]: r for r in sketches.estimates(sketches.merged(parts, "qr")).collect()}
    twice = sketches.merged(sketches.merged(parts, "qr", F.minute("minute") % 3), "qr")
    for row in sketches.estimates(twice).collect():
        assert row["n"] == found[row["qr"]]["n"]
        assert row["name_distinct"] == pytest.approx(found[row["qr"]]["name_distinct"], rel=0.03)
    for qr, row in found.items():
        own = rows.where(F.col("qr") == qr)
        exact = own.agg(
            F.count_distinct(F.lower(F.rtrim("qname", F.lit(".")))).alias("name"), F.count_distinct("src_ip").alias("src_ip"),
            F.count_distinct("dst_ip").alias("dst_ip"), F.count(F.lit(1)).alias("n"),
        ).first()
        assert row["n"] == exact["n"]
        for column in ("name", "src_ip", "dst_ip"):
            assert abs(row[f"{column}_distinct"] - exact[column]) <= max(1, 0.06 * exact[column])
        values = sorted(r[0] for r in own.select("frame_len").collect())
        for point, value in zip((0.25, 0.5, 0.75, 0.99), row["frame_len_values"]):
            low, high = (sum(v < value for v in values) / len(values), sum(v <= value for v in values) / len(values))
            assert low - 0.04 <= point <= high + 0.04


def test_member_filter_lets_all_members_through(spark):
    rows = spark.range(20_000).withColumn("h", F.xxhash64("id"))
    members = rows.where("id % 1000 = 7").select("h")
    kept = shared.may_be_member(rows, "h", members)
    assert kept.columns == rows.columns
    ids = {r["id"] for r in kept.collect()}
    assert ids >= set(range(7, 20_000, 1000)) and len(ids) < 60
    assert shared.may_be_member(rows, "h", members.where("false")).count() == 0
