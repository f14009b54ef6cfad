"""Checks of readers, writers and the report: tables go through the shared folder and back."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dnsight.functions import clock
from dnsight.operators import temporal
from dnsight.plans import report
from dnsight.sources import quarantine, readers, writers
from dnsight.sources.storage import fresh_path
from workload import sqltext as S
from workload.packets import COLUMNS, SPARSE, packets, sparse_packets

_TEXTS = ["event_type", "proto", "src_ip", "dst_ip", "qname", "qtype_name"]
_READ_BACK = [c for c in COLUMNS if c not in _TEXTS + ["dt", "ts"]]


def _columns(df, *more):
    """All columns that the packets have, whole numbers in one width."""
    return df.select(
        *[F.col(f"`{c}`") for c in ("dt", "ts", *_TEXTS, *more)], *[F.col(f"`{c}`").cast("bigint").alias(c) for c in _READ_BACK]
    )


_COLUMNS_SQL = (
    "select dt, ts, " + ", ".join(_TEXTS) + ", " + ", ".join(f'"{c}"::bigint as "{c}"' for c in _READ_BACK) + " from packets"
)


def _iso(column="dt"):
    return F.concat(F.date_format(column, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("Z"))


def _write_csv(df, spark, name):
    path = fresh_path(spark, name)
    df.write.option("header", True).option("quote", '"').option("escape", '"').csv(path)
    return path


def _csv_typed(spark, sf):
    path = _write_csv(packets(spark, sf).drop("dt"), spark, "typed")
    return _columns(readers.read_csv(spark, path))


def _csv_literals(spark, sf):
    rows = packets(spark, sf).drop("dt").withColumn(
        "qname",
        F.expr(
            "case qtype_name when 'TXT' then 'nan' when 'NS' then 'NULL' when 'A' then null"
            " else qname end"
        ),
    )
    return _columns(readers.read_packets(spark, _write_csv(rows, spark, "literals")))


def _csv_iso(spark, sf):
    rows = packets(spark, sf).withColumn("ts_iso", _iso()).drop("dt", "ts")
    read = readers.read_csv(spark, _write_csv(rows, spark, "iso"))
    # The file has no epoch seconds; they are those of the event time.
    seconds = F.expr("timestampdiff(MICROSECOND, timestamp_ntz'1970-01-01 00:00:00', dt)") / 1e6
    return _columns(read.withColumn("ts", seconds))


def _mixed_headers(spark, sf):
    """Files whose headers have other columns in another order."""
    rows = packets(spark, sf).drop("dt")
    folder = fresh_path(spark, "mixed")
    parts = [
        rows, rows.select(*[f"`{c}`" for c in reversed(rows.columns)]),
        rows.drop("edns_udpsize", "cd").withColumn("note", F.lit("a, \"b\"")),
    ]
    for k, part in enumerate(parts):
        part.where(F.col("event_id") % 3 == k).write.option("header", True).option("escape", '"').csv(f"{folder}/{k}")
    return _columns(quarantine.load_csv(spark, folder).good, "note")


_MIXED_SQL = (
    "select * replace (case when event_id % 3 = 2 then null else edns_udpsize end as edns_udpsize,"
    " case when event_id % 3 = 2 then null else cd end as cd),"
    f" case when event_id % 3 = 2 then 'a, \"b\"' end as note from ({_COLUMNS_SQL})"
)

# Which records get which unreadable texts.
_SPOILED = {"qr": ("event_id%601=0", "two"), "src_port": ("event_id%607=0", "99999999999"), "ts": ("event_id%613=0", "never")}


def _spoiled(spark, sf):
    rows = packets(spark, sf).drop("dt")
    texts = {
        c: F.expr(f"case when {when} then '{text}' else cast({c} as string) end") for c, (when, text) in _SPOILED.items()
    }
    return quarantine.load_csv(spark, _write_csv(rows.withColumns(texts), spark, "spoiled"))


def _bad_values(spark, sf):
    """Every fault beside its record's id, and every good row without one."""
    load = _spoiled(spark, sf)
    faults = load.rejected.select(
        F.split("record", ",")[0].cast("bigint").alias("event_id"), "column", "text", "reason", (F.col("line") > 1).alias("placed")
    )
    none = [F.lit(None).cast("string").alias(c) for c in ("column", "text", "reason")]
    return faults.unionByName(load.good.select(F.col("event_id").cast("bigint"), *none, F.lit(True).alias("placed")))


_FAULTS_SQL = " union all ".join(
    f"select event_id::bigint as event_id, '{c}' as \"column\", '{text}' as text,"
    f" 'not a {kind}' as reason, true as placed from packets where {when}"
    for (c, (when, text)), kind in zip(_SPOILED.items(), ("tinyint", "int", "double"))
)
_GOOD = "not (" + " or ".join(when for when, _ in _SPOILED.values()) + ")"
_BAD_SQL = (
    f"{_FAULTS_SQL} union all select event_id::bigint, null, null, null, true from packets where {_GOOD}"
)
_LOAD_COUNTS_SQL = (
    f"select count(*) as records, count(*) filter (where {_GOOD}) as good, count(*) filter (where not {_GOOD}) as rejected,"
    f" (select count(*) from ({_FAULTS_SQL})) as faults from packets"
)


def _csv_inferred(spark, sf):
    rows = packets(spark, sf).drop("dt")
    inferred = readers.read_csv_inferred(spark, _write_csv(rows, spark, "inferred"))
    return _columns(clock.with_event_time(inferred))


def _parquet(spark, sf):
    path = fresh_path(spark, "packets") + ".parquet"
    writers.write_parquet(packets(spark, sf), path)
    return _columns(readers.read_packets(spark, path))


def _converted(spark, sf):
    source = _write_csv(packets(spark, sf).drop("dt"), spark, "raw")
    path = fresh_path(spark, "converted") + ".parquet"
    writers.csv_to_parquet(spark, source, path)
    return _columns(readers.read_packets(spark, path))


def _sizes(spark, sf):
    source = _write_csv(packets(spark, sf).drop("dt"), spark, "raw")
    path = fresh_path(spark, "sized") + ".parquet"
    return writers.csv_to_parquet(spark, source, path, infer=True).drop("output_path")


def _json(spark, sf):
    metrics = temporal.minute_metrics(sparse_packets(spark, sf), empty_rate=None)
    gaps = metrics.withColumn(
        "nx_rate", F.coalesce(F.round("nx_rate", 6), F.lit(float("nan")))
    ).select("minute", "packets", "nx_rate")
    path = fresh_path(spark, "minutes")
    writers.write_json(gaps, path)
    return spark.read.schema("minute string, packets bigint, nx_rate double").json(path)


def _statistics(spark, sf):
    return readers.load_statistics(packets(spark, sf))


def _limited(spark, sf):
    """Row counts of limited scans of both formats; which rows they are is not fixed."""
    rows = packets(spark, sf)
    path = fresh_path(spark, "limited") + ".parquet"
    writers.write_parquet(rows, path)
    sources = {"csv": _write_csv(rows.drop("dt"), spark, "limited"), "parquet": path}
    counts = [
        readers.read_packets(spark, where, fmt, limit=n).agg(F.count(F.lit(1)).alias("n")).select(
            F.lit(fmt).alias("format"), F.lit(n).cast("bigint").alias("limit"), "n"
        )
        for fmt, where in sources.items() for n in (1, 500, 10**9)
    ]
    return reduce(DataFrame.unionByName, counts)


_LIMITED_SQL = "select f as format, l::bigint as \"limit\", least(l, (select count(*) from packets)) as n from (values ('csv'), ('parquet')) a(f), (values (1), (500), (1000000000)) b(l)"


def _published(spark, sf):
    """The minute table as a view and as a table of its own, and an existing copy that is kept."""
    counts = temporal.minute_counts(packets(spark, sf)).select("minute", "packets", "queries")
    writers.publish(counts, "dnsight_minutes_view")
    path = fresh_path(spark, "kept")
    writers.write_parquet(counts.where("packets > 0"), path, mode="ignore")
    writers.write_parquet(counts.where("packets < 0"), path, mode="ignore")
    return spark.table("dnsight_minutes_view").withColumn("kind", F.lit("view")).unionByName(
        spark.read.parquet(path).withColumn("kind", F.lit("kept"))
    )


_PUBLISHED_SQL = (
    "select minute, packets, queries, kind from (select minute, count(*) packets, count(*) filter (where qr = 0) queries"
    " from packets group by 1), (values ('view'), ('kept')) t(kind)"
)


def _footers(spark, sf):
    """Rows and the range of two columns of a stored copy, from its footers."""
    path = fresh_path(spark, "footers") + ".parquet"
    writers.write_parquet(packets(spark, sf), path)
    return readers.footer_statistics(spark, path, ("event_id", "ts"))


def _bucketed(spark, sf):
    """Messages per host, and hosts that ask and answer, from two tables that need no shuffle."""
    rows = packets(spark, sf)
    sides = [
        writers.write_bucketed(
            rows.where(f"qr = {qr} and {key} is not null").select(F.col(key).alias("host"), "rcode"),
            f"dnsight_{key}", "host", 8, fresh_path(spark, "bucketed"),
        ).groupBy("host").agg(F.count(F.lit(1)).alias(name))
        for qr, key, name in ((0, "src_ip", "queries"), (1, "dst_ip", "responses"))
    ]
    return sides[0].join(sides[1].hint("merge"), "host")


_BUCKETED_SQL = (
    "select q.host, queries, responses from (select src_ip as host, count(*) queries from packets where qr = 0 group by 1) q"
    " join (select dst_ip as host, count(*) responses from packets where qr = 1 group by 1) r on q.host = r.host"
)


def _kpi_cards(spark, sf):
    return report.kpi_cards(packets(spark, sf))


_KPI_SQL = f"""
select 'messages' title, format('{{:,}}', count(*)) as value, 'full record' as scope from packets
union all select 'messages per second',
  format('{{:,}}', round(count(*) / ((epoch_us(max(dt)) - epoch_us(min(dt)))/1e6))::bigint),
  'full record' from packets
union all select 'nxdomain', printf('%.2f%%', 100e0*{S.n(S.NX)}/{S.n(S.R)}), 'full record'
  from packets
union all select 'udp truncation', printf('%.2f%%', 100e0*sum(udp_tc)/sum(udp_resp)),
  count(*) || ' steady minutes' from dense
union all select 'share of S1', printf('%.1f%%', 100e0*(select query_count from top)
  /(select count(*) from packets where qr = 0)), 'full record'"""


ENTRIES = {
    "s01_csv_typed": (_csv_typed, S.query(_COLUMNS_SQL)),
    "s01_mixed_headers": (_mixed_headers, S.query(_MIXED_SQL)),
    "s01_bad_values": (_bad_values, S.query(_BAD_SQL)),
    "s01_load_counts": (lambda spark, sf: _spoiled(spark, sf).counts, S.query(_LOAD_COUNTS_SQL)),
    "s02_csv_literals": (
        _csv_literals,
        S.query(
            "select * replace (case qtype_name when 'TXT' then 'nan' when 'NS' then 'NULL' when 'A' then null"
            f" else qname end as qname) from ({_COLUMNS_SQL})"
        ),
    ),
    "s03_limited": (_limited, S.query(_LIMITED_SQL)),
    "s11_s16_published": (_published, S.query(_PUBLISHED_SQL)),
    "s14_footers": (
        _footers,
        S.query(
            'select count(*) as "rows", min(event_id) min_event_id, max(event_id) max_event_id, min(ts) min_ts, max(ts) max_ts'
            " from packets"
        ),
    ),
    "s11_bucketed": (_bucketed, S.query(_BUCKETED_SQL)),
    "s05_csv_iso": (_csv_iso, S.query(_COLUMNS_SQL)),
    "s06_csv_inferred": (_csv_inferred, S.query(_COLUMNS_SQL)),
    "s07_parquet_zstd": (_parquet, S.query(_COLUMNS_SQL)),
    "s07_csv_to_parquet": (_converted, S.query(_COLUMNS_SQL)),
    "s08_sizes": (_sizes, None),
    "s12_json": (
        _json,
        S.query(
            "select strftime(minute, '%Y-%m-%dT%H:%M:%S') as minute, packets,"
            f" {S.pct('nx', 'responses')} nx_rate from dense",
            S.MINUTES, slow=SPARSE,
        ),
    ),
    "s14_stats": (
        _statistics, S.query('select count(*) as "rows", 33::bigint as "columns" from packets'),
    ),
    "k19_kpi_cards": (_kpi_cards, S.query(_KPI_SQL, S.MINUTES, S.PREFIX_COUNTS, S.TOP_PREFIX)),
}
