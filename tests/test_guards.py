"""Queries that fail where their preconditions do not hold."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from dnsight.operators import guards, priority, quality, spikes, temporal
from tests.helpers import frame, nx, query, rows_of
from tests.conftest import SF_SMALL
from workload.packets import packets

A, B = "2001:db8:1111::1", "2001:db8:2222::1"


def surge(spark, extra=()):
    return frame(spark, [*nx(0, A, 2), *nx(0, B), *nx(1, A, 6), *nx(2, A, 1), query(3), *extra])


def decomposed(rows, dimension="host", **options):
    window = spikes.spike_window(rows, steady=None, **options)
    return guards.strict_spike_delta(spikes.nx_counts(rows, window), window, dimension), window


def test_exact_decomposition_passes(spark):
    rows = surge(spark)
    strict, window = decomposed(rows, peak="nx")
    plain = spikes.spike_delta(spikes.nx_counts(rows, window), window)
    assert sorted(map(str, rows_of(strict))) == sorted(map(str, rows_of(plain))) and strict.count() == 2


@pytest.mark.parametrize(("make", "options", "message"), [
    (lambda s: frame(s, nx(0, A, 3)), {}, "two minutes"),
    (surge, {"peak": datetime(2026, 8, 19, 9)}, "not a minute"),
    (lambda s: surge(s, nx(1, None, 2)), {"peak": "nx"}, "without a host"),
])
def test_broken_preconditions_stop_the_query(spark, make, options, message):
    strict, _ = decomposed(make(spark), **options)
    with pytest.raises(Exception, match=message):
        strict.collect()


def test_missing_group_matters_to_its_dimension_only(spark):
    strict, _ = decomposed(surge(spark, nx(1, None, 2)), "qtype", peak="nx")
    assert strict.count() == 1


@pytest.mark.parametrize("rows", [0, 3])
def test_first_failed_check_is_named(spark, rows):
    guard = spark.createDataFrame([(True, False, None)], "a boolean, b boolean, c boolean")
    checks = {"a fails": F.col("a"), "b fails": F.col("b"), "c fails": F.col("c")}
    df = spark.range(rows)
    for action in (lambda d: d.collect(), lambda d: d.count()):
        with pytest.raises(Exception, match="b fails"):
            action(guards.require(df, guard, checks))
        with pytest.raises(Exception, match="c fails"):
            action(guards.require(df, guard, {"c fails": F.col("c")}))
    assert guards.require(df, guard, {"a fails": F.col("a")}).count() == rows


def test_profile_and_labels(spark):
    rows = packets(spark, SF_SMALL)
    inside = temporal.in_window(temporal.steady_window(rows))
    profile = priority.source_profile(rows)
    checked = quality.profile_reconciliation(profile, rows, inside)
    assert guards.strict_profile(profile, checked).count() == profile.count()
    lost = profile.where("prefix <> 'UNKNOWN'").orderBy(F.desc("query")).limit(1)
    with pytest.raises(Exception, match="reconcile"):
        guards.strict_profile(lost, quality.profile_reconciliation(lost, rows, inside)).collect()
    labels = spark.createDataFrame([("a", "S1"), ("b", "S2")], "prefix string, label string")
    assert guards.strict_labels(labels).count() == 2
    for bad, message in (("S2", "twice"), ("S02", "malformed"), (None, "twice|malformed")):
        with pytest.raises(Exception, match=message):
            guards.strict_labels(labels.union(spark.createDataFrame([("c", bad)], "prefix string, label string"))).collect()


def test_checks_are_in_the_plan(spark):
    strict, _ = decomposed(surge(spark), peak="nx")
    assert "raise_error" in strict._jdf.queryExecution().optimizedPlan().toString()
