"""Checks of the lexical operators."""

from __future__ import annotations

from functools import partial

from pyspark.sql import functions as F

from dnsight.functions import names
from dnsight.operators import lexical
from dnsight.operators.suffix import compile_rules, with_registrable
from dnsight.sources.storage import stage
from workload import sqltext as S
from workload.minutes import rounded
from workload.packets import duck_wild_cte, packets, stored, wild_packets
from workload.rules import registered, suffix_rules, suffix_table

_INTS = ["qname_len", "num_labels", "longest_label_len", "digit_count", "foreign_char_count"]


def _computed_features(spark, sf, source=packets):
    return lexical.name_features(lexical.distinct_names(source(spark, sf)))


def _features(spark, sf, source=packets):
    """Feature table, stored once: most of these operators go over it two or three times."""
    return stored(spark, f"names of {source.__name__}", sf, lambda: _computed_features(spark, sf, source))


def _long(df, *columns):
    return df.withColumns({c: F.col(c).cast("bigint") for c in columns})


def _table(spark, sf):
    return _long(_computed_features(spark, sf), *_INTS)


_TABLE_SQL = "select * from feat"


def _describe(spark, sf):
    stats = lexical.describe(lexical.value_distribution(_features(spark, sf), lexical.FEATURES))
    return rounded(stats, "mean", "std", "min", "p25", "p50", "p75", "max")


_DESCRIBE_SQL = " union all ".join(
    f"select '{f}' feature, count({f}) count, round(avg({f}), 6) mean,"
    f" round(stddev_samp({f}), 6) std, min({f})::double min,"
    f" round(quantile_cont({f}::double, 0.25), 6) p25,"
    f" round(quantile_cont({f}::double, 0.5), 6) p50,"
    f" round(quantile_cont({f}::double, 0.75), 6) p75, max({f})::double max from feat"
    for f in lexical.FEATURES
)


def _tld(spark, sf):
    return rounded(lexical.top_level_domains(_features(spark, sf)), "pct")


def _percentiles(spark, sf):
    points = lexical.quantiles(
        lexical.value_distribution(
            _features(spark, sf), ["qname_len", "longest_label_len", "entropy"]
        )
    )
    return rounded(points, *lexical.QUANTILES)


_PERCENTILES_SQL = " union all ".join(
    f"select '{f}' feature, "
    + ", ".join(
        f"round(quantile_cont({f}::double, {p}), 6) {name}"
        for name, p in lexical.QUANTILES.items()
    )
    + " from feat"
    for f in ("qname_len", "longest_label_len", "entropy")
)


def _thresholds(spark, sf):
    limits = lexical.thresholds(_features(spark, sf))
    return rounded(limits, "p999_len", "p999_label", "p99_entropy", "p95_len")


def _spearman(spark, sf):
    features = _features(spark, sf)
    distribution = stage(lexical.value_distribution(features, lexical.FEATURES))
    return rounded(lexical.spearman(features, distribution), "rho")


_RANKS = "ranks as (select " + ", ".join(
    f"rank() over (order by {f}) + (count(*) over (partition by {f}) - 1) / 2e0 r_{f}"
    for f in lexical.FEATURES
) + " from feat)"
_SPEARMAN_SQL = " union all ".join(
    f"select '{a}' feature_a, '{b}' feature_b, "
    + ("1e0 rho" if a == b else f"round(corr(r_{a}, r_{b}), 6) rho from ranks")
    for a in lexical.FEATURES
    for b in lexical.FEATURES
)


def _candidates(spark, sf, source=packets):
    return _long(lexical.candidates(_features(spark, sf, source)), *_INTS)


def _charset(spark, sf, source=packets):
    return rounded(lexical.charset_split(lexical.candidates(_features(spark, sf, source))), "outside_pct")


def _parents(spark, sf, source=packets):
    return rounded(lexical.parent_domains(lexical.candidates(_features(spark, sf, source))), "pct")


def _registered(spark, sf, source=packets):
    found = lexical.candidates(_features(spark, sf, source))
    return lexical.candidate_registrables(found, suffix_table(spark))


def _registrable_top(spark, sf, source=packets):
    return rounded(lexical.registrable_top(_registered(spark, sf, source)), "pct")


def _registrable_structure(spark, sf, source=packets):
    return rounded(
        lexical.registrable_structure(_registered(spark, sf, source)), "top1_pct", "top5_pct"
    )


_REG = (
    f"{registered('(select domain as name from valid)')},"
    " reg as (select name as domain, registrable from registered)"
)
_STRUCTURE_SQL = """
select count(*) candidates, count(distinct registrable) registrables,
  count(*) filter (where domain <> registrable) nested,
  count(*) filter (where domain = registrable) direct,
  coalesce(round(100e0*(select max(c) from (select count(*) c from reg group by registrable))
    /nullif(count(*), 0), 6), 0) top1_pct,
  coalesce(round(100e0*(select sum(c) from (select count(*) c from reg group by registrable
    order by 1 desc limit 5))/nullif(count(*), 0), 6), 0) top5_pct
from reg"""


def _audit(spark, sf, source=packets):
    rows = lexical.audit_examples(lexical.candidates(_features(spark, sf, source)))
    return _long(rows, "qname_len")


_AUDIT_SQL = """
(select domain, qname_len, entropy, 'selected characters only' reason from cand
 where is_selected_charset order by domain limit 3)
union all
(select domain, qname_len, entropy, 'characters outside the selection' reason from cand
 where not is_selected_charset order by domain limit 3)"""


def _sample(spark, sf, source=packets):
    return lexical.seeded_sample(lexical.candidates(_features(spark, sf, source)))


def _limits(spark, sf, source=packets):
    return lexical.thresholds(_features(spark, sf, source))


def _sources(spark, sf, source=packets):
    counts = stage(lexical.candidate_query_counts(source(spark, sf), _limits(spark, sf, source)))
    rows = lexical.candidate_sources(counts)
    return rounded(rows, "candidate_pct", "candidate_top5_pct", "top5_pct")


_CQ = "cq as (select * from packets where qr = 0 and name in (select domain from valid))"
_SOURCES_SQL = """
select (select count(*) from cq) candidate_queries,
  round(100e0*(select count(*) from cq)/count(*), 6) candidate_pct,
  (select count(distinct src_ip) from cq) candidate_sources,
  coalesce(round(100e0*(select sum(c) from (select count(*) c from cq where src_ip is not null
    group by src_ip order by 1 desc limit 5))/nullif((select count(src_ip) from cq), 0), 6), 0)
    candidate_top5_pct,
  count(distinct src_ip) sources,
  round(100e0*(select sum(c) from (select count(*) c from packets where qr = 0
    and src_ip is not null group by src_ip order by 1 desc limit 5))/count(src_ip), 6) top5_pct,
  (select count(distinct name) from cq) candidate_names,
  (select count(*) from (select name from cq group by 1 having count(*) = 1)) names_seen_once
from packets where qr = 0"""


def _nx_share(spark, sf, source=packets):
    rows = lexical.candidate_nx_share(source(spark, sf), _limits(spark, sf, source))
    return rounded(rows, "candidate_pct")


_NX_FLAG = (
    "nf as (select dst_ip, coalesce(name in (select domain from valid), false) c from packets"
    " where qr = 1 and rcode = 3)"
)
_NX_SHARE_SQL = """
select 'all' scope, null::varchar dst_ip, count(*) nxdomain, count(*) filter (where c) candidate_nx,
  round(100e0*count(*) filter (where c)/count(*), 6) candidate_pct from nf
union all
select 'host', dst_ip, count(*), count(*) filter (where c),
  round(100e0*count(*) filter (where c)/count(*), 6) from nf group by dst_ip"""


def _hosts(spark, sf, source=packets):
    return lexical.host_audit(source(spark, sf), _limits(spark, sf, source), min_responses=6)


def _host_audit(spark, sf):
    return rounded(_hosts(spark, sf), "nx_rate_pct", "candidate_pct")


_HOSTS = """hosts as (select dst_ip, count(*) responses, count(*) filter (where rcode = 3) nxdomain,
  count(distinct name) unique_qname,
  100e0*count(*) filter (where rcode = 3)/count(*) nx_rate_pct,
  coalesce(100e0*count(*) filter (where rcode = 3 and name in (select domain from valid))
    /nullif(count(*) filter (where rcode = 3), 0), 0) candidate_pct
from packets where qr = 1 and dst_ip is not null group by 1 having count(*) >= 6)"""


def _bridge(spark, sf, source=packets):
    return rounded(
        lexical.bridge_test(_hosts(spark, sf, source)), "max_pct", "top_nx_rate_min", "top_nx_rate_max"
    )


_BRIDGE_SQL = """
select count(*) filter (where candidate_pct >= 10) n_bridge,
  coalesce(round(max(candidate_pct) filter (where candidate_pct >= 10), 6), 0) max_pct,
  (select round(min(nx_rate_pct), 6) from (select * from hosts order by nxdomain desc, dst_ip
    limit 5)) top_nx_rate_min,
  (select round(max(nx_rate_pct), 6) from (select * from hosts order by nxdomain desc, dst_ip
    limit 5)) top_nx_rate_max
from hosts"""


def _histogram(spark, sf):
    rows = lexical.length_histogram(_features(spark, sf))
    return _long(rounded(rows, "from_len", "to_len"), "bin")


_HISTOGRAM_SQL = """
select b bin, round(lo + (b - 1)*(hi - lo)/60e0, 6) from_len, round(lo + b*(hi - lo)/60e0, 6) to_len,
  (select count(*) from feat where least((qname_len - lo)*60//(hi - lo) + 1, 60) = b) count
from (select unnest(range(1, 61)) b), (select min(qname_len) lo, max(qname_len) hi from feat)"""


def _escapes(spark, sf):
    rows = lexical.escape_summary(_features(spark, sf))
    return _long(rounded(rows, "loose_pct"), "longest_name")


# Names under every kind of derived rule, by event.
_NAMES_UNDER_RULES = (
    "concat(case when event_id % 2 = 0 then 'Host.' else '' end, case event_id % 6 when 0 then 'a.' when 1 then '' else 'b.c.' end,"
    " case event_id % 5 when 0 then concat('r', {k} - {k} % 3) when 1 then concat('e', {k} - {k} % 3 + 2, '.w', {k} - {k} % 3 + 1)"
    " when 2 then concat('u', user_id, '.w', {k} - {k} % 3 + 1) when 3 then concat('w', {k} - {k} % 3 + 1) else concat('v', {k}, '.zz') end, '.id.')"
).format(k="(event_id * 7 % 6000)")


def _more_names(spark, sf):
    """Distinct names of the packets, and names derived from the events."""
    events = spark.read.parquet(f"{sf}/events.parquet")
    under = events.select(names.normalised(F.expr(_NAMES_UNDER_RULES)).alias("domain"))
    return lexical.distinct_names(packets(spark, sf)).unionByName(under).distinct()


def _registrable(spark, sf):
    return with_registrable(_more_names(spark, sf), suffix_table(spark), "domain")


def _registrable_joined(spark, sf):
    """The same by the join that larger rule tables take."""
    return with_registrable(_more_names(spark, sf), compile_rules(suffix_rules(spark), most_rules=100), "domain")


_REGISTRABLE = S.query(
    "select name as domain, registrable from registered",
    f"more as (select name from packets union all select lower(rtrim({_NAMES_UNDER_RULES}, '.')) from events)",
    registered("more"),
)


def _entropy(spark, sf):
    return packets(spark, sf).select(
        "event_id",
        names.normalised("qname").alias("name"),
        names.entropy(names.normalised("qname")).alias("entropy"),
        names.last_two_labels(names.normalised("qname")).alias("parent"),
    )


_ENTROPY_SQL = (
    "select event_id, name, entropy, case when num_labels >= 2 then"
    " list_extract(string_split(name, '.'), -2) || '.' ||"
    " list_extract(string_split(name, '.'), -1) else name end parent"
    " from packets left join feat on name = domain"
)

_CANDIDATE_QUERIES = {
    "k41_candidates": (_candidates, ("select * from cand", S.CANDIDATES)),
    "k41_charset": (
        _charset,
        (
            "select count(*) candidates, count(*) filter (where is_selected_charset) in_charset,"
            " count(*) filter (where not is_selected_charset) outside_charset,"
            " round(100e0*count(*) filter (where not is_selected_charset)/nullif(count(*), 0), 6)"
            " outside_pct from cand",
            S.CANDIDATES,
        ),
    ),
    "k42_parents": (
        _parents,
        (
            "select regexp_extract(domain, '([^.]+\\.[^.]+|[^.]+)$') parent, count(*) count,"
            " round(100e0*count(*)/(select count(*) from valid), 6) pct from valid"
            " group by 1 order by count(*) desc, 1 limit 5",
            S.CANDIDATES,
        ),
    ),
    "k43_registrable": (
        _registrable_top,
        (
            "select registrable, count(*) count,"
            " round(100e0*count(*)/(select count(*) from reg), 6) pct from reg"
            " group by 1 order by count(*) desc, 1 limit 5",
            S.CANDIDATES, _REG,
        ),
    ),
    "k43_structure": (_registrable_structure, (_STRUCTURE_SQL, S.CANDIDATES, _REG)),
    "k44_audit": (_audit, (_AUDIT_SQL, S.CANDIDATES)),
    "k45_sources": (_sources, (_SOURCES_SQL, S.CANDIDATES, _CQ)),
    "k46_sample": (
        _sample,
        (
            "select domain from valid order by md5('42:' || domain), domain limit 10",
            S.CANDIDATES,
        ),
    ),
    "k47_nx_share": (_nx_share, (_NX_SHARE_SQL, S.CANDIDATES, _NX_FLAG)),
    "k49_bridge": (_bridge, (_BRIDGE_SQL, S.CANDIDATES, _HOSTS)),
}

ENTRIES = {
    **{key: (run, S.query(*parts)) for key, (run, parts) in _CANDIDATE_QUERIES.items()},
    # The derived names have few unusual ones among them; these packets have many.
    **{
        f"{key}_wild": (partial(run, source=wild_packets), S.query(*parts, base=duck_wild_cte()))
        for key, (run, parts) in _CANDIDATE_QUERIES.items()
    },
    "k36_lexical": (_table, S.query(_TABLE_SQL, S.FEATURES)),
    "k37_describe": (_describe, S.query(_DESCRIBE_SQL, S.FEATURES)),
    "k38_tld": (
        _tld,
        S.query(
            "select tld, count(*) count, round(100e0*count(*)/(select count(*) from feat), 6) pct"
            " from feat group by 1 order by count(*) desc, 1 limit 5",
            S.FEATURES,
        ),
    ),
    "k39_percentiles": (_percentiles, S.query(_PERCENTILES_SQL, S.FEATURES)),
    "k39_thresholds": (
        _thresholds,
        S.query(
            "select round(quantile_cont(qname_len::double, 0.999), 6) p999_len,"
            " round(quantile_cont(longest_label_len::double, 0.999), 6) p999_label,"
            " round(quantile_cont(entropy, 0.99), 6) p99_entropy,"
            " round(quantile_cont(qname_len::double, 0.95), 6) p95_len from feat",
            S.FEATURES,
        ),
    ),
    "k40_spearman": (_spearman, S.query(_SPEARMAN_SQL, S.FEATURES, _RANKS)),
    "k48_host_audit": (
        _host_audit,
        S.query(
            "select dst_ip, responses, nxdomain, unique_qname, round(nx_rate_pct, 6) nx_rate_pct,"
            " round(candidate_pct, 6) candidate_pct from hosts",
            S.CANDIDATES, _HOSTS,
        ),
    ),
    "k60_histogram": (_histogram, S.query(_HISTOGRAM_SQL, S.FEATURES)),
    "k69_escapes": (
        _escapes,
        S.query(
            "select count(*) names, count(*) filter (where has_escape) loose,"
            " count(*) filter (where has_escape_strict) strict,"
            " round(100e0*count(*) filter (where has_escape)/count(*), 6) loose_pct,"
            " max(qname_len) longest_name from feat",
            S.FEATURES,
        ),
    ),
    "x08_registrable": (_registrable, _REGISTRABLE),
    "x08_registrable_joined": (_registrable_joined, _REGISTRABLE),
    "x09_entropy": (_entropy, S.query(_ENTROPY_SQL, S.FEATURES)),
}
