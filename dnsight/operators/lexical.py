"""Lexical profile of distinct names: features, exact percentiles, rank correlation, candidates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dnsight.functions import names
from dnsight.functions import predicates as P
from dnsight.functions.measures import count_rows, count_where, percent
from dnsight.operators.shared import one_row, one_value, running_totals, top_counts, with_rank
from dnsight.operators.suffix import SuffixTable, with_registrable

FEATURES = ["qname_len", "num_labels", "longest_label_len", "digit_ratio", "entropy"]
QUANTILES = {"p50": 0.5, "p75": 0.75, "p90": 0.9, "p95": 0.95, "p99": 0.99, "p999": 0.999}


def distinct_names(packets: DataFrame) -> DataFrame:
    return packets.where(F.col("qname").isNotNull()).select(
        names.normalised("qname").alias("domain")
    ).distinct()


def name_features(domains: DataFrame) -> DataFrame:
    """Feature columns per distinct name, all native expressions."""
    d = F.col("domain")
    return domains.select(
        "domain",
        F.length(d).alias("qname_len"),
        names.label_count(d).alias("num_labels"),
        names.longest_label(d).alias("longest_label_len"),
        names.digit_count(d).alias("digit_count"),
        names.digit_ratio(d).alias("digit_ratio"),
        names.entropy(d).alias("entropy"),
        names.top_level(d).alias("tld"),
        names.has_escape(d).alias("has_escape"),
        names.has_escape(d, strict=True).alias("has_escape_strict"),
        names.foreign_characters(d).alias("foreign_char_count"),
        names.in_selected_charset(d).alias("is_selected_charset"),
    )


def escape_summary(features: DataFrame) -> DataFrame:
    return features.agg(
        count_rows().alias("names"),
        count_where(F.col("has_escape")).alias("loose"),
        count_where(F.col("has_escape_strict")).alias("strict"),
        percent(count_where(F.col("has_escape")), count_rows()).alias("loose_pct"),
        F.max("qname_len").alias("longest_name"),
    )


def top_level_domains(features: DataFrame, limit: int = 5) -> DataFrame:
    total = one_value(features.agg(count_rows().alias("t")), "t")
    return top_counts(features, "tld", limit).withColumn("pct", percent("count", total))


# --- exact order statistics ----------------------------------------------------------------------


def value_distribution(features: DataFrame, columns: Sequence[str]) -> DataFrame:
    """feature, value, n, before_n: how often each value occurs and how many values are smaller.

    Exact quantiles and ranks follow from it. The table has one row per distinct value, not per
    name, and its running count is formed in buckets of a thousandth.
    """
    pairs = [
        F.struct(F.lit(c).alias("feature"), F.col(c).cast("double").alias("value"))
        for c in columns
    ]
    long = features.select(F.inline(F.array(*pairs))).where(F.col("value").isNotNull())
    counts = long.groupBy("feature", "value").agg(count_rows().alias("n"))
    tiered = counts.withColumn("bucket", F.floor(F.col("value") * 1000))
    ranked = running_totals(
        tiered, [("bucket", "asc"), ("value", "asc")], ["n"], within=["feature"]
    )
    return ranked.select("feature", "value", "n", "before_n")


def _with_totals(distribution: DataFrame) -> DataFrame:
    totals = distribution.groupBy("feature").agg(F.sum("n").alias("total"))
    # One row per feature name, so its size does not depend on the data.
    return distribution.join(F.broadcast(totals), "feature")


def _quantile(p: float, only: Column | None = None) -> Column:
    """Linear interpolation between the two values around position p * (total - 1)."""
    position = F.lit(p) * (F.col("total") - 1)
    low, high = F.floor(position), F.ceil(position)

    def value_at(rank: Column) -> Column:
        here = (F.col("before_n") <= rank) & (rank < F.col("before_n") + F.col("n"))
        return F.max(F.when(here if only is None else only & here, F.col("value")))

    share = F.max(position - low if only is None else F.when(only, position - low))
    return value_at(low) + (value_at(high) - value_at(low)) * share


def quantiles(distribution: DataFrame, points: dict[str, float] | None = None) -> DataFrame:
    """Exact quantiles per feature, one column per point."""
    points = QUANTILES if points is None else points
    return _with_totals(distribution).groupBy("feature").agg(
        *[_quantile(p).alias(name) for name, p in points.items()]
    )


def describe(distribution: DataFrame) -> DataFrame:
    """count, mean, std, min, quartiles and max per feature, from the value table alone."""
    n, v = F.col("n"), F.col("value")
    mean = F.sum(v * n) / F.sum("n")
    # Squares are taken about the mean: those of large, close values would cancel out.
    means = distribution.groupBy("feature").agg(mean.alias("centre"))
    away = v - F.col("centre")
    spread = F.sum(away * away * n) - F.sum(away * n) * F.sum(away * n) / F.sum("n")
    # One row per feature.
    centred = _with_totals(distribution).join(F.broadcast(means), "feature")
    return centred.groupBy("feature").agg(
        F.sum("n").alias("count"),
        mean.alias("mean"),
        F.sqrt(F.greatest(spread, F.lit(0.0)) / F.nullif(F.sum("n") - 1, F.lit(0))).alias("std"),
        F.min("value").alias("min"),
        _quantile(0.25).alias("p25"),
        _quantile(0.5).alias("p50"),
        _quantile(0.75).alias("p75"),
        F.max("value").alias("max"),
    )


def thresholds(features: DataFrame) -> DataFrame:
    """One row of empirical limits: name length P95 and P99.9, label P99.9, entropy P99."""
    wanted = {
        "p999_len": ("qname_len", 0.999),
        "p999_label": ("longest_label_len", 0.999),
        "p99_entropy": ("entropy", 0.99),
        "p95_len": ("qname_len", 0.95),
    }
    distribution = value_distribution(features, ["qname_len", "longest_label_len", "entropy"])
    return _with_totals(distribution).agg(
        *[_quantile(p, F.col("feature") == f).alias(c) for c, (f, p) in wanted.items()]
    )


def length_histogram(features: DataFrame, bins: int = 60) -> DataFrame:
    """Equal-width bins of the name length, the last one closed on the right, empty bins kept."""
    lengths = features.groupBy(F.col("qname_len").alias("len")).agg(count_rows().alias("n"))
    edges = one_row(lengths.agg(F.min("len").alias("lo"), F.max("len").alias("hi")))
    # A single length gets the range one half to each side of it.
    lo = F.when(edges["lo"] == edges["hi"], edges["lo"] - 0.5).otherwise(edges["lo"])
    hi = F.when(edges["lo"] == edges["hi"], edges["hi"] + 0.5).otherwise(edges["hi"])
    position = (F.col("len") - lo) * bins / (hi - lo)
    binned = lengths.groupBy(
        F.least(F.floor(position) + 1, F.lit(bins)).cast("int").alias("bin")
    ).agg(F.sum("n").alias("count"))
    spark = features.sparkSession
    every = spark.range(1, bins + 1).select(F.col("id").cast("int").alias("bin"))
    return every.join(binned, "bin", "left").select(
        "bin",
        (lo + (F.col("bin") - 1) * (hi - lo) / bins).cast("double").alias("from_len"),
        (lo + F.col("bin") * (hi - lo) / bins).cast("double").alias("to_len"),
        F.coalesce("count", F.lit(0)).alias("count"),
    )


def spearman(
    features: DataFrame, distribution: DataFrame, columns: Sequence[str] = tuple(FEATURES)
) -> DataFrame:
    """Rank correlation of every pair of features.

    Average ranks belong to values, not to rows: the value table (``value_distribution`` of the
    same features, best staged) gives each value its rank, and the rows look their ranks up.
    Spark broadcasts the tables that are small enough. Pearson on the ranks is one aggregation.
    """
    rows = features.select(*[F.col(c).cast("double").alias(c) for c in columns])
    for c in columns:
        ranks = distribution.where(F.col("feature") == c).select(
            F.col("value").alias(c),
            (F.col("before_n") + (F.col("n") + 1) / 2).alias(f"rank_{c}"),
        )
        rows = rows.join(ranks, c, "inner").drop(c)
    pairs = [(a, b) for i, a in enumerate(columns) for b in columns[i + 1:]]
    correlations = rows.agg(
        *[F.corr(f"rank_{a}", f"rank_{b}").alias(f"{a}|{b}") for a, b in pairs]
    )

    def cell(a: str, b: str) -> Column:
        if a == b:
            return F.lit(1.0)
        return F.col(f"`{a}|{b}`" if (a, b) in pairs else f"`{b}|{a}`")

    cells = [
        F.struct(
            F.lit(a).alias("feature_a"), F.lit(b).alias("feature_b"), cell(a, b).alias("rho")
        )
        for a in columns
        for b in columns
    ]
    return correlations.select(F.inline(F.array(*cells)))


# --- candidates ----------------------------------------------------------------------------------


def is_candidate(name: Column, limits: Column) -> Column:
    """Long name of unusually high entropy inside the selected characters.

    A function of the name and two limits, so packets are tested directly and no join with the
    list of candidates is needed. The cheap tests come first; entropy is computed for few rows.
    """
    return F.coalesce(
        (F.length(name) >= limits["p95_len"])
        & names.in_selected_charset(name)
        & (names.entropy(name) >= limits["p99_entropy"]),
        F.lit(False),
    )


def candidates(features: DataFrame) -> DataFrame:
    """Names with entropy from P99 and length from P95 upwards, whatever their characters."""
    limits = one_row(thresholds(features))
    return features.where(
        (F.col("qname_len") >= limits["p95_len"]) & (F.col("entropy") >= limits["p99_entropy"])
    )


def charset_split(found: DataFrame) -> DataFrame:
    valid = F.col("is_selected_charset")
    return found.agg(
        count_rows().alias("candidates"),
        count_where(valid).alias("in_charset"),
        count_where(~valid).alias("outside_charset"),
        percent(count_where(~valid), count_rows()).alias("outside_pct"),
    )


def parent_domains(found: DataFrame, limit: int = 5) -> DataFrame:
    """Two-label parents of the candidates inside the selected characters."""
    valid = found.where("is_selected_charset")
    total = one_value(valid.agg(count_rows().alias("t")), "t")
    parents = valid.select(names.last_two_labels("domain").alias("parent"))
    return top_counts(parents, "parent", limit).withColumn("pct", percent("count", total))


def candidate_registrables(found: DataFrame, rules: DataFrame | SuffixTable) -> DataFrame:
    """Candidates inside the selected characters with their registrable domain."""
    return with_registrable(found.where("is_selected_charset").select("domain"), rules, "domain")


def registrable_top(registered: DataFrame, limit: int = 5) -> DataFrame:
    total = one_value(registered.agg(count_rows().alias("t")), "t")
    return top_counts(registered, "registrable", limit).withColumn("pct", percent("count", total))


def registrable_structure(registered: DataFrame) -> DataFrame:
    """One row: candidates, registrable domains, nested and direct names, top shares."""
    counts = registered.groupBy("registrable").agg(
        count_rows().alias("n"),
        count_where(F.col("domain") != F.col("registrable")).alias("nested"),
    )
    order = [F.desc("n"), F.asc("registrable")]
    top = with_rank(counts.orderBy(*order).limit(5), *order).agg(
        F.sum(F.when(F.col("rank") == 1, F.col("n"))).alias("top1"), F.sum("n").alias("top5")
    )
    shares = one_row(top)
    sums = counts.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("candidates"),
        count_rows().alias("registrables"),
        F.coalesce(F.sum("nested"), F.lit(0)).alias("nested"),
    )
    return sums.select(
        "candidates",
        "registrables",
        "nested",
        (F.col("candidates") - F.col("nested")).alias("direct"),
        percent(shares["top1"], F.col("candidates"), 0.0).alias("top1_pct"),
        percent(shares["top5"], F.col("candidates"), 0.0).alias("top5_pct"),
    )


def audit_examples(found: DataFrame, per_class: int = 3) -> DataFrame:
    """First names of each character class with the reason they are listed."""
    columns = ["domain", "qname_len", "entropy"]

    def part(condition: Column, reason: str) -> DataFrame:
        picked = found.where(condition).orderBy("domain").limit(per_class)
        return picked.select(*columns, F.lit(reason).alias("reason"))

    valid = F.col("is_selected_charset")
    return part(valid, "selected characters only").unionByName(
        part(~valid, "characters outside the selection")
    )


def seeded_sample(found: DataFrame, size: int = 10, seed: int = 42) -> DataFrame:
    """Repeatable random choice: the smallest seeded hashes, whatever the partitioning."""
    key = F.md5(F.concat(F.lit(f"{seed}:"), F.col("domain")))
    return found.where("is_selected_charset").select("domain").orderBy(key, "domain").limit(size)


def candidate_query_counts(packets: DataFrame, limits: DataFrame) -> DataFrame:
    """Queries per source and candidate name; the other names of a source share a null name.

    One scan tests every name once; sources and candidate names are both summed up from here.
    """
    name = names.normalised("qname")
    candidate = F.when(is_candidate(name, one_row(limits)), name)
    return packets.where(P.is_query()).groupBy("src_ip", candidate.alias("candidate")).agg(
        count_rows().alias("n")
    )


def candidate_sources(counts: DataFrame) -> DataFrame:
    """Sources of the candidate queries beside the sources of all queries, one row.

    ``counts`` comes from ``candidate_query_counts``, best staged.
    """
    is_found = F.col("candidate").isNotNull()
    per_source = counts.groupBy("src_ip").agg(
        F.sum("n").alias("n"),
        F.coalesce(F.sum(F.when(is_found, F.col("n"))), F.lit(0)).alias("c"),
    )
    known = per_source.where(F.col("src_ip").isNotNull())

    def largest(column: str) -> Column:
        top = known.orderBy(F.desc(column), F.asc("src_ip")).limit(5)
        return one_value(top.agg(F.sum(column).alias("t")), "t")

    per_name = counts.where(is_found).groupBy("candidate").agg(F.sum("n").alias("n"))
    seen = one_row(
        per_name.agg(
            count_rows().alias("names"), count_where(F.col("n") == 1).alias("once")
        )
    )
    has_source = F.col("src_ip").isNotNull()
    sums = per_source.agg(
        F.coalesce(F.sum("c"), F.lit(0)).alias("candidate_queries"),
        F.coalesce(F.sum("n"), F.lit(0)).alias("queries"),
        F.coalesce(F.sum(F.when(has_source, F.col("c"))), F.lit(0)).alias("c_known"),
        F.coalesce(F.sum(F.when(has_source, F.col("n"))), F.lit(0)).alias("n_known"),
        count_where(has_source & (F.col("c") > 0)).alias("candidate_sources"),
        count_where(has_source).alias("sources"),
    )
    return sums.select(
        "candidate_queries",
        percent("candidate_queries", "queries", 0.0).alias("candidate_pct"),
        "candidate_sources",
        percent(largest("c"), F.col("c_known"), 0.0).alias("candidate_top5_pct"),
        "sources",
        percent(largest("n"), F.col("n_known"), 0.0).alias("top5_pct"),
        seen["names"].alias("candidate_names"),
        seen["once"].alias("names_seen_once"),
    )


def candidate_nx_share(packets: DataFrame, limits: DataFrame) -> DataFrame:
    """Candidate share of the NXDOMAIN responses per host and, with host null, overall."""
    name = names.normalised("qname")
    rows = packets.where(P.is_nxdomain()).select(
        "dst_ip", is_candidate(name, one_row(limits)).alias("candidate")
    )
    per_host = rows.groupBy("dst_ip").agg(
        count_rows().alias("nxdomain"), count_where(F.col("candidate")).alias("candidate_nx")
    )
    overall = per_host.agg(
        F.coalesce(F.sum("nxdomain"), F.lit(0)).alias("nxdomain"),
        F.coalesce(F.sum("candidate_nx"), F.lit(0)).alias("candidate_nx"),
    ).select(F.lit(None).cast("string").alias("dst_ip"), "nxdomain", "candidate_nx")
    both = overall.withColumn("scope", F.lit("all")).unionByName(
        per_host.withColumn("scope", F.lit("host"))
    )
    return both.select(
        "scope", "dst_ip", "nxdomain", "candidate_nx",
        percent("candidate_nx", "nxdomain", 0.0).alias("candidate_pct"),
    )


def host_audit(packets: DataFrame, limits: DataFrame, min_responses: int = 500) -> DataFrame:
    """Receiving hosts: responses, NXDOMAIN, distinct names, rates, candidate share.

    (host, name) is counted first: that gives the distinct names without an expanding distinct
    aggregate, tests every name once per host, and keeps a hot host from overloading one task.
    """
    name = names.normalised("qname")
    pairs = packets.where(P.is_response() & F.col("dst_ip").isNotNull()).groupBy(
        "dst_ip", name.alias("name")
    ).agg(count_rows().alias("responses"), count_where(F.col("rcode") == 3).alias("nx"))
    flagged = pairs.withColumn(
        "candidate_nx",
        F.when((F.col("nx") > 0) & is_candidate(F.col("name"), one_row(limits)), F.col("nx"))
        .otherwise(0),
    )
    hosts = flagged.groupBy("dst_ip").agg(
        F.sum("responses").alias("responses"),
        F.sum("nx").alias("nxdomain"),
        F.count("name").alias("unique_qname"),
        F.sum("candidate_nx").alias("candidate_nx"),
    )
    return hosts.where(F.col("responses") >= min_responses).select(
        "dst_ip", "responses", "nxdomain", "unique_qname",
        percent("nxdomain", "responses").alias("nx_rate_pct"),
        percent("candidate_nx", "nxdomain", 0.0).alias("candidate_pct"),
    )


def bridge_test(hosts: DataFrame, min_pct: float = 10.0, top: int = 5) -> DataFrame:
    """Hosts whose errors are mostly candidates, and the rate range of the largest hosts."""
    largest = hosts.orderBy(F.desc("nxdomain"), F.asc("dst_ip")).limit(top)
    rates = one_row(largest.agg(F.min("nx_rate_pct").alias("lo"), F.max("nx_rate_pct").alias("hi")))
    bridge = F.col("candidate_pct") >= min_pct
    return hosts.agg(
        count_where(bridge).alias("n_bridge"),
        F.coalesce(F.max(F.when(bridge, F.col("candidate_pct"))), F.lit(0.0)).alias("max_pct"),
    ).select(
        "n_bridge", "max_pct",
        rates["lo"].alias("top_nx_rate_min"), rates["hi"].alias("top_nx_rate_max"),
    )
