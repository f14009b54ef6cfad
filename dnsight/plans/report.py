"""Key figures, and the report: its sections as tables, as files, and as one nested row."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dnsight.functions import clock
from dnsight.functions.measures import (
    grouped_number, millions_text, percent, percent_text,
)
from dnsight.operators import concentration, priority, rollup, spikes, temporal, traffic
from dnsight.operators.shared import one_row, one_value, with_rank
from dnsight.operators.suffix import SuffixTable
from dnsight.sources.storage import stage
from dnsight.sources.writers import json_safe


def kpi_cards(
    packets: DataFrame, steady: str | None = "drop_edges", rollup: DataFrame | None = None,
    pareto: DataFrame | None = None, minutes: DataFrame | None = None,
) -> DataFrame:
    """Five headline figures as text: volume, rate, NXDOMAIN, truncation, share of S1.

    What is known already can be given: the header counts, the ranking, the summary of the minutes.
    """
    counted, weight = (packets, None) if rollup is None else (rollup, "n")
    totals = traffic.kpis(counted, any_direction=False, weight=weight)
    span = packets.agg(
        clock.seconds_between(F.min("dt"), F.max("dt")).alias("seconds")
    ) if rollup is None else rollup.agg(
        clock.seconds_between(F.min("dt"), F.max("last_dt")).alias("seconds")
    )
    if minutes is None:
        minutes = temporal.minute_summary(temporal.minute_metrics(counted, steady, weight=weight))
    summary = one_row(minutes.select("tc_ratio_avg", "n_minutes"))
    pareto = concentration.pareto_top(packets) if pareto is None else pareto
    first = one_value(pareto.where(F.col("rank") == 1), "share_pct")
    seconds = F.greatest(F.coalesce(one_value(span, "seconds"), F.lit(0.0)), F.lit(1.0))
    cards = [
        ("messages", millions_text("total_packets"), F.lit("full record")),
        ("messages per second", grouped_number(F.col("total_packets") / seconds),
         F.lit("full record")),
        ("nxdomain", percent_text(percent("total_nxdomain", "total_responses", 0.0)),
         F.lit("full record")),
        ("udp truncation", percent_text(summary["tc_ratio_avg"]),
         F.concat(summary["n_minutes"].cast("string"), F.lit(" steady minutes"))),
        ("share of S1", percent_text(F.coalesce(first, F.lit(0.0)), 1), F.lit("full record")),
    ]
    rows = [
        F.struct(F.lit(t).alias("title"), v.alias("value"), s.alias("scope")) for t, v, s in cards
    ]
    return totals.select(F.inline(F.array(*rows)))


@dataclass(frozen=True)
class Report:
    """The sections of a report: flat tables, in the order of `position`.

    A name with a dot is a part of the section before it; the sections in ONE_ROW have one row.
    """

    sections: dict[str, DataFrame]


#: Sections that are one row, not a list; the columns of `x.values` belong to the section x itself.
ONE_ROW = ("meta", "temporal.values", "temporal.peak", "decomposition.values", "decomposition.summary")


def report_sections(
    packets: DataFrame,
    rules: DataFrame | SuffixTable,
    steady: str | None = "drop_edges",
    min_responses: int = 500,
    nx_min_responses: int = 1000,
) -> Report:
    """All sections as tables of their own.

    The packets are read twice: once for the cube, from which all but one section is cut, and once
    for the NXDOMAIN responses of the window that the cube gives. Both are stored in the shared
    folder, as are the few small tables that several sections use. Every list is bounded by a limit or
    the minutes, and the lists stay tables.
    """
    cube = stage(rollup.packet_cube(packets))
    header = rollup.header_counts(cube)
    window = stage(spikes.spike_window(header, steady, weight="n"))
    minutes = stage(temporal.steady_window(header, steady))
    counts = stage(spikes.nx_counts(packets, window))
    metrics = stage(temporal.minute_metrics(header, steady, weight="n"))
    profile = stage(rollup.source_profile(cube, minutes))
    pareto = stage(rollup.pareto_top(cube))
    series = stage(rollup.top_series(cube, minutes))
    bubbles = stage(priority.bubble_set(profile))
    load = stage(priority.load_priority(profile))
    errors = stage(priority.nx_priority(profile, min_responses=nx_min_responses))
    shown = bubbles.select("prefix")
    for part in (load, errors, series):
        shown = shown.unionByName(part.select("prefix"))
    labels = stage(priority.extend_labels(pareto.select("prefix", "label"), shown))

    load, errors, points = (priority.label_or_text(t, labels) for t in (load, errors, bubbles))
    peaks = priority.label_or_text(concentration.series_peaks(series), labels)
    hosts = stage(spikes.top_deltas(spikes.spike_delta(counts, window, "host"), 10, "H"))
    domains = spikes.top_deltas(spikes.spike_delta_domain(counts, window, rules), 5, "R")
    types = spikes.top_deltas(spikes.spike_delta(counts, window, "qtype"), 3, "T")
    matrix = traffic.protocol_matrix(header, top=5, keep_null_code=False, weight="n")
    truncation = traffic.truncation_by_qtype(header, min_responses, weight="n")
    summary = stage(temporal.minute_summary(metrics))
    totals = traffic.kpis(header, any_direction=False, weight="n")
    span = one_row(header.agg(F.min("dt").alias("lo"), F.max("last_dt").alias("hi")))

    def listed(df: DataFrame, position: str, *columns: Column | str) -> DataFrame:
        return df.select(F.col(position).alias("position"), *columns)

    return Report({
        "meta": totals.select(
            F.lit("UTC").alias("time_zone"), clock.iso_text(span["lo"]).alias("from"), clock.iso_text(span["hi"]).alias("to"),
            one_value(summary, "n_minutes").alias("steady_minutes"), F.col("total_packets").alias("messages"),
            F.col("total_queries").alias("queries"), F.col("total_responses").alias("responses"),
        ),
        "kpi": listed(kpi_cards(packets, steady, header, pareto, summary), "title", "title", "value", "scope"),
        "temporal.minutes": listed(
            metrics, "minute", clock.hhmm("minute").alias("time"), clock.iso_text("minute").alias("time_iso"),
            "packets", "nx", "responses", "nx_rate", "udp_resp", "udp_tc", "tc_ratio",
        ),
        "temporal.values": summary.select("median_other", "nx_rate_global", "tc_ratio_avg"),
        "temporal.peak": summary.select(
            clock.hhmm("peak_minute").alias("load"), clock.hhmm("nx_peak_minute").alias("nx"),
            clock.hhmm("tc_peak_minute").alias("tc"),
        ),
        "pareto": listed(pareto, "rank", "label", "share_pct", "cumulative_pct"),
        "load_priority": listed(load, "rank", "label", "query", "share_pct", "active_minutes", "reason"),
        "nx_priority": listed(errors, "rank", "label", "responses", "nxdomain", "nx_rate_pct", "reason"),
        "bubble.points": listed(
            points.where("plottable"), "position", "label", "query", "nx_rate_pct", "responses", "high_nx"
        ),
        "bubble.not_plotted": listed(
            points.where("not plottable"), "position", "label", "query", "responses", "nxdomain", "nx_rate_pct"
        ),
        "small_multiples.series": listed(peaks, "rank", "label", clock.hhmm("peak_minute").alias("peak"), "peak_queries"),
        "small_multiples.minutes": listed(
            concentration.top_series_wide(series), "minute", clock.hhmm("minute").alias("time"), "s1", "s2", "s3"
        ),
        "decomposition.summary": spikes.spike_summary(counts, window),
        "decomposition.hosts": listed(hosts, "rank", "label", "delta"),
        "decomposition.domains": listed(domains, "rank", "label", "delta"),
        "decomposition.qtypes": listed(types, "rank", F.col("group").alias("qtype"), "delta"),
        "decomposition.values": spikes.nx_coverage(counts).withColumn(
            "top2_delta", one_value(hosts.agg(F.sum(F.when(F.col("rank") <= 2, F.col("delta"))).alias("t")), "t")
        ),
        "truncation": listed(
            with_rank(truncation, F.desc("tc_rate_pct"), F.asc("qtype_name")), "rank", "qtype_name", "tc_rate_pct", "total_resp"
        ),
        "matrix": listed(
            matrix.withColumn("key", F.struct("qtype_name", "response_code")), "key",
            "qtype_name", "response_code", "response_count", "row_percentage",
        ),
        "composition.qtype": listed(traffic.qtype_composition(header, weight="n"), "rank", "qtype_name", "count"),
        "composition.rcode": listed(traffic.rcode_composition(header, weight="n"), "rank", "rcode_name", "count"),
    })


def write_sections(report: Report, path: str, mode: str = "error") -> None:
    """Every section as JSON lines in a folder of its own; nothing goes through the driver or one task."""
    for name, rows in report.sections.items():
        json_safe(rows.drop("position")).write.mode(mode).option("ignoreNullFields", False).json(f"{path}/{name}")


def _as_text(name: str, rows: DataFrame) -> DataFrame:
    """One row: the section's name, and its rows in order as the text of a JSON array."""
    safe = json_safe(rows)
    position = F.col("position") if "position" in safe.columns else F.lit(0).alias("position")
    item = F.struct(position, F.to_json(F.struct(*[c for c in safe.columns if c != "position"])).alias("row"))
    texts = F.transform(F.array_sort(F.collect_list(item)), lambda r: r["row"])
    return safe.agg(F.format_string("[%s]", F.array_join(texts, ",")).alias("rows")).select(F.lit(name).alias("section"), "rows")


def nested_report(report: Report) -> DataFrame:
    """All sections as one row of nested columns: one document, for reports that are read as a whole.

    One aggregation makes a text of every section, and another one puts the texts together.
    """
    parts = [_as_text(name, rows) for name, rows in report.sections.items()]
    texts = reduce(DataFrame.unionByName, parts).agg(F.map_from_entries(F.collect_list(F.struct("section", "rows"))).alias("m"))
    tree = {}
    for name, rows in report.sections.items():
        kind = json_safe(rows.drop("position")).schema
        value = F.from_json(F.col("m")[name], T.ArrayType(kind))
        if name in ONE_ROW:
            value = value[0]
        top, _, part = name.partition(".")
        if not part:
            tree[top] = value
        elif part == "values":
            tree.setdefault(top, {}).update({c: value[c] for c in kind.names})
        else:
            tree.setdefault(top, {})[part] = value
    return texts.select(*[
        (F.struct(*[v.alias(k) for k, v in parts.items()]) if isinstance(parts, dict) else parts).alias(top)
        for top, parts in tree.items()
    ])


def build_report(
    packets: DataFrame,
    rules: DataFrame | SuffixTable,
    steady: str | None = "drop_edges",
    min_responses: int = 500,
    nx_min_responses: int = 1000,
) -> DataFrame:
    """The sections of ``report_sections`` as one row of nested columns."""
    return nested_report(report_sections(packets, rules, steady, min_responses, nx_min_responses))
