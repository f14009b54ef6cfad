"""Operators against brute force, invariants, and independence of the partitioning."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from dnsight.operators import concentration, lexical, priority, shared, spikes, temporal, traffic
from dnsight.operators.suffix import default_rules
from tests.conftest import SF_SMALL
from tests.helpers import rows_of
from workload.packets import packets


def names_frame(spark, count=400, seed=3):
    rng = random.Random(seed)
    letters = "abcdefgh0123456789-_"
    names = {
        ".".join(
            "".join(rng.choice(letters) for _ in range(rng.randint(1, 12)))
            for _ in range(rng.randint(1, 5))
        )
        for _ in range(count)
    }
    return spark.createDataFrame([(n,) for n in sorted(names)], "domain string"), sorted(names)


def brute_running(rows):
    total, out = 0, {}
    for position, (key, value) in enumerate(sorted(rows, key=lambda r: (-r[1], r[0])), 1):
        out[key] = (position, total + value)
        total += value
    return out


def test_running_totals_over_tiers(spark):
    rng = random.Random(1)
    rows = [(f"10.{i % 40}.{i}.0/24", rng.choice([1, 1, 1, 2, 3, 17, 900])) for i in range(600)]
    rows += [(f"2001:db8:{i:x}::/48", rng.choice([1, 2, 900])) for i in range(300)]
    rows += [("UNKNOWN", 1), ("2001::/48", 1), ("::/48", 1)]
    counts = spark.createDataFrame(rows, "prefix string, query_count bigint")
    total, expected = sum(v for _, v in rows), brute_running(rows)
    for ranked in (
        concentration.pareto_full(counts),
        concentration.pareto_full_any_key(counts, "prefix", partitions=5),
    ):
        found = rows_of(ranked)
        assert len(found) == len(rows)
        for r in found:
            position, running = expected[r["prefix"]]
            assert r["prefix_rank"] == position
            assert r["cumulative_share_pct"] == pytest.approx(100 * running / total, abs=1e-3)
            assert r["is_pareto_top_80"] == (r["cumulative_share_pct"] <= 80)


def test_value_distribution_quantiles_and_describe(spark):
    domains, texts = names_frame(spark)
    features = lexical.name_features(domains)
    distribution = lexical.value_distribution(features, lexical.FEATURES)
    local = features.toPandas()
    quantiles = {r["feature"]: r for r in rows_of(lexical.quantiles(distribution))}
    for r in rows_of(lexical.describe(distribution)):
        column = local[r["feature"]].astype(float)
        assert r["count"] == len(texts)
        assert r["mean"] == pytest.approx(column.mean())
        assert r["std"] == pytest.approx(column.std())
        assert (r["min"], r["max"]) == (column.min(), column.max())
        for name, p in (("p25", 0.25), ("p50", 0.5), ("p75", 0.75)):
            assert r[name] == pytest.approx(np.quantile(column, p))
        for name, p in lexical.QUANTILES.items():
            assert quantiles[r["feature"]][name] == pytest.approx(np.quantile(column, p))


def test_spearman(spark):
    domains, _ = names_frame(spark)
    features = lexical.name_features(domains)
    distribution = lexical.value_distribution(features, lexical.FEATURES)
    found = {
        (r["feature_a"], r["feature_b"]): r["rho"]
        for r in rows_of(lexical.spearman(features, distribution))
    }
    ranks = features.toPandas()[lexical.FEATURES].astype(float).rank(method="average")
    for pair, rho in found.items():
        assert rho == pytest.approx(np.corrcoef(ranks[pair[0]], ranks[pair[1]])[0, 1])
    assert len(found) == 25


def test_candidates_by_expression_and_by_table_agree(spark):
    rows = packets(spark, SF_SMALL)
    features = lexical.name_features(lexical.distinct_names(rows))
    table = {r["domain"] for r in rows_of(lexical.candidates(features).where("is_selected_charset"))}
    limits = shared.one_row(lexical.thresholds(features))
    picked = features.where(lexical.is_candidate(F.col("domain"), limits))
    assert {r["domain"] for r in rows_of(picked)} == table and table


def test_histogram(spark):
    domains, texts = names_frame(spark)
    lengths = [len(t) for t in texts]
    counts, edges = np.histogram(lengths, bins=60)
    found = sorted(rows_of(lexical.length_histogram(lexical.name_features(domains))),
                   key=lambda r: r["bin"])
    assert [r["count"] for r in found] == counts.tolist()
    assert [r["from_len"] for r in found] == pytest.approx(edges[:-1].tolist())
    same = spark.createDataFrame([("abc",), ("abd",)], "domain string")
    found = rows_of(lexical.length_histogram(lexical.name_features(same), bins=4))
    assert sum(r["count"] for r in found) == 2
    assert sorted(r["bin"] for r in found if r["count"]) == [3]


def test_collapse_tail(spark):
    counts = spark.createDataFrame([("a", 5), ("b", 5), ("c", 1), ("d", 2)], "k string, count bigint")
    found = {r["k"]: (r["rank"], r["count"]) for r in rows_of(shared.collapse_tail(counts, "k", 2))}
    assert found == {"a": (1, 5), "b": (2, 5), "other": (3, 3)}


def test_sample_is_repeatable(spark):
    domains, _ = names_frame(spark)
    features = lexical.name_features(domains)
    one = [r["domain"] for r in rows_of(lexical.seeded_sample(features.repartition(7)))]
    two = [r["domain"] for r in rows_of(lexical.seeded_sample(features.coalesce(1)))]
    other = [r["domain"] for r in rows_of(lexical.seeded_sample(features, seed=1))]
    assert one == two and len(one) == 10 and one != other


def test_bubble_set(spark):
    rows = [(f"p{i:02}", 100 - i, 1, i, i, 100.0 if i else None, 1.0) for i in range(30)]
    rows.append(("q", 0, 0, 50, 50, 100.0, 0.0))
    profile = spark.createDataFrame(
        rows,
        "prefix string, query bigint, active_minutes bigint, responses bigint, nxdomain bigint,"
        " nx_rate_pct double, share_pct double",
    )
    found = {r["prefix"]: r for r in rows_of(priority.bubble_set(profile))}
    assert len(found) == 20
    assert not found["p00"]["plottable"] and not found["q"]["plottable"]
    assert found["p01"]["position"] == 1
    labels = priority.bubble_labels(priority.bubble_set(profile, high=101.0))
    assert sum(r["labelled"] for r in rows_of(labels)) == 4


def test_invariants(spark):
    rows = packets(spark, SF_SMALL)
    total = rows.count()
    minutes = temporal.minute_metrics(rows, steady=None).agg(
        F.sum("packets").alias("p"), F.sum("queries").alias("q"), F.sum("responses").alias("r")
    ).first()
    assert minutes["p"] == total == minutes["q"] + minutes["r"]
    pareto = concentration.pareto_full(concentration.prefix_counts(rows))
    assert pareto.agg(F.max("cumulative_share_pct")).first()[0] == 100.0
    sums = traffic.protocol_matrix(rows).groupBy("qtype_name").agg(F.sum("row_percentage").alias("s"))
    assert all(math.isclose(r["s"], 100.0) for r in rows_of(sums))
    window = spikes.spike_window(rows, peak="nx")
    counts = spikes.nx_counts(rows, window)
    assert rows_of(spikes.spike_reconciliation(counts, window))[0]["reconciled"]
    domains = spikes.spike_delta_domain(counts, window, default_rules(spark))
    assert domains.count() > 0


def test_rollup_gives_the_same_answers(spark):
    rows = packets(spark, SF_SMALL)
    rollup = traffic.traffic_rollup(rows)
    for direct, from_rollup in (
        (traffic.kpis(rows), traffic.kpis(rollup, weight="n")),
        (temporal.minute_metrics(rows), temporal.minute_metrics(rollup, weight="n")),
        (
            temporal.minute_metrics(rows, "full_minutes"),
            temporal.minute_metrics(rollup, "full_minutes", weight="n"),
        ),
        (traffic.protocol_matrix(rows, top=3), traffic.protocol_matrix(rollup, top=3, weight="n")),
        (
            traffic.truncation_by_qtype(rows, 10),
            traffic.truncation_by_qtype(rollup, 10, weight="n"),
        ),
        (traffic.qtype_composition(rows, 2), traffic.qtype_composition(rollup, 2, weight="n")),
        (traffic.rcode_composition(rows, 2), traffic.rcode_composition(rollup, 2, weight="n")),
    ):
        assert sorted(map(str, rows_of(direct))) == sorted(map(str, rows_of(from_rollup)))


@pytest.mark.parametrize(
    "operator",
    [
        temporal.minute_metrics,
        concentration.pareto_top,
        lambda p: concentration.pareto_full(concentration.prefix_counts(p)),
        priority.source_profile,
        lambda p: spikes.spike_delta(
            spikes.nx_counts(p, spikes.spike_window(p)), spikes.spike_window(p)
        ),
        lambda p: lexical.quantiles(
            lexical.value_distribution(
                lexical.name_features(lexical.distinct_names(p)), lexical.FEATURES
            )
        ),
        traffic.overview,
    ],
)
def test_partitioning_has_no_effect(spark, operator):
    rows = packets(spark, SF_SMALL)
    one = sorted(map(str, rows_of(operator(rows.coalesce(1)))))
    seven = sorted(map(str, rows_of(operator(rows.repartition(7)))))
    assert one == seven and one
