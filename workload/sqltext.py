"""Pieces of oracle SQL that several checks share."""

from __future__ import annotations

from workload.packets import CAPTURE, duck_cte

Q = "qr = 0"
R = "qr = 1"
NX = "(qr = 1 and rcode = 3)"
UR = "(qr = 1 and proto = 'udp')"
TC = "(qr = 1 and proto = 'udp' and tc = 1)"


def n(condition: str) -> str:
    return f"count(*) filter (where {condition})"


def pct(part: str, whole: str, digits: int = 6) -> str:
    return f"round(100e0 * ({part}) / nullif({whole}, 0), {digits})"


def query(body: str, *ctes: str, slow: int = CAPTURE, base: str | None = None) -> str:
    parts = [duck_cte(slow) if base is None else base, *ctes]
    return f"with {', '.join(parts)} {body}"


EDGES = "edges as (select min(dt) lo, max(dt) hi, min(minute) lom, max(minute) him from packets)"
# Steady minutes a..b under the three rules.
DROP_EDGES = (
    f"{EDGES}, w as (select"
    " case when him > lom + interval 1 minute then lom + interval 1 minute else lom end a,"
    " case when him > lom + interval 1 minute then him - interval 1 minute else him end b"
    " from edges)"
)
FULL_MINUTES = (
    f"{EDGES}, w as (select"
    " case when lo = lom then lo else lom + interval 1 minute end a,"
    " him - interval 1 minute b from edges)"
)
ALL_MINUTES = f"{EDGES}, w as (select lom a, him b from edges)"

CALENDAR = "cal as (select unnest(generate_series(a, b, interval 1 minute)) as minute from w)"
COUNTS = (
    "counts as (select minute, count(*) packets, "
    f"{n(Q)} queries, {n(R)} responses, {n(NX)} nx, {n(UR)} udp_resp, {n(TC)} udp_tc, "
    f"{n('proto = ' + chr(39) + 'tcp' + chr(39))} tcp_packets, sum(frame_len)::bigint frame_bytes "
    "from packets group by 1)"
)
DENSE = (
    "dense as (select cal.minute, "
    + ", ".join(
        f"coalesce({c}, 0)::bigint as {c}"
        for c in (
            "packets", "queries", "responses", "nx", "udp_resp", "udp_tc", "tcp_packets",
            "frame_bytes",
        )
    )
    + " from cal left join counts on cal.minute = counts.minute)"
)
MINUTES = f"{DROP_EDGES}, {CALENDAR}, {COUNTS}, {DENSE}"
MINUTES_FULL = f"{FULL_MINUTES}, {CALENDAR}, {COUNTS}, {DENSE}"
MINUTES_ALL = f"{ALL_MINUTES}, {CALENDAR}, {COUNTS}, {DENSE}"
PEAK = "peak as (select minute from dense order by packets desc, minute limit 1)"
NX_PEAK = "peak as (select minute from dense order by nx desc, minute limit 1)"
STEADY = "steady as (select packets.* from packets, w where packets.minute between a and b)"

PREFIX_COUNTS = (
    "pc as (select src_prefix as prefix, count(*) as query_count from packets"
    " where qr = 0 and src_prefix is not null group by 1)"
)
TOP_PREFIX = (
    "top as (select prefix, query_count from pc order by query_count desc, prefix limit 1)"
)

PROFILE = (
    "q as (select src_prefix prefix, count(*) query, count(distinct minute) active_minutes"
    " from steady where qr = 0 and src_prefix is not null group by 1), "
    "r as (select dst_prefix prefix, count(*) responses,"
    " count(*) filter (where rcode = 3) nxdomain from steady where qr = 1 group by 1), "
    "prof as (select coalesce(q.prefix, r.prefix) prefix, coalesce(query, 0) query,"
    " coalesce(active_minutes, 0) active_minutes, coalesce(responses, 0) responses,"
    " coalesce(nxdomain, 0) nxdomain from q full outer join r on q.prefix = r.prefix), "
    "profile as (select *, 100e0 * nxdomain / nullif(responses, 0) nx_rate_pct,"
    " 100e0 * query / (select sum(query) from prof) share_pct from prof)"
)

# Distinct names with their features.
NAMES = "names as (select distinct name as domain from packets where name is not null)"
FEATURES = (
    NAMES
    + ", ent as (select domain, round(-sum(p * log2(p)), 6) entropy from ("
    "select domain, count(*)::double / length(domain) p from ("
    "select domain, unnest(string_split(domain, '')) ch from names) group by domain, ch)"
    " group by domain)"
    ", lab as (select domain, max(length(l)) longest_label_len, count(*) num_labels from ("
    "select domain, unnest(string_split(domain, '.')) l from names) group by domain)"
    ", feat as (select names.domain, length(names.domain) qname_len, num_labels,"
    " longest_label_len, length(regexp_replace(names.domain, '[^0-9]', '', 'g')) digit_count,"
    " round(length(regexp_replace(names.domain, '[^0-9]', '', 'g'))::double"
    " / length(names.domain), 6) digit_ratio, entropy,"
    " case when names.domain like '%.%' then list_last(string_split(names.domain, '.'))"
    " else 'none' end tld,"
    r" regexp_matches(names.domain, '\\[0-9]{3}') has_escape,"
    r" regexp_matches(names.domain, '\\[0-7]{3}') has_escape_strict,"
    " length(regexp_replace(names.domain, '[a-z0-9._-]', '', 'g')) foreign_char_count,"
    " not regexp_matches(names.domain, '[^a-z0-9._-]') is_selected_charset"
    " from names join ent using (domain) join lab using (domain))"
)
LIMITS = (
    f"{FEATURES}, lim as (select quantile_cont(entropy, 0.99) p99_entropy,"
    " quantile_cont(qname_len::double, 0.95) p95_len from feat)"
)
CANDIDATES = (
    f"{LIMITS}, cand as (select feat.* from feat, lim"
    " where entropy >= p99_entropy and qname_len >= p95_len)"
    ", valid as (select * from cand where is_selected_charset)"
)
