"""From a packet file to the JSON report in one call."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from dnsight.operators import quality
from dnsight.operators.suffix import SuffixTable
from dnsight.plans.report import build_report
from dnsight.sources.readers import read_packets
from dnsight.sources.writers import write_json


def analyse(
    spark: SparkSession,
    input_path: str,
    output_path: str,
    rules: DataFrame | SuffixTable,
    fmt: str | None = None,
    limit: int | None = None,
    validate: bool = False,
    mode: str = "error",
    steady: str | None = "drop_edges",
    min_responses: int = 500,
) -> DataFrame | None:
    """Read packets, build the report and write it as JSON.

    ``rules`` are the public suffix rules (``suffix.read_rules``). With ``limit`` only that many rows
    are read; such a sample may want ``steady=None`` and a lower ``min_responses``. ``validate``
    returns the contract summary; like the report itself it covers every row that was read, and
    findings do not stop the report.
    """
    packets = read_packets(spark, input_path, fmt, limit)
    report = build_report(packets, rules, steady=steady, min_responses=min_responses)
    write_json(report, output_path, mode)
    return quality.contract_summary(packets) if validate else None
