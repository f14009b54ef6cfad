"""The three marts on the staged table, and their data tests."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from dnsight.functions.measures import count_rows, count_where, percent
from dnsight.operators import quality
from dnsight.operators.concentration import pareto_full
from dnsight.sources.storage import stage


def temporal_mart(stg: DataFrame) -> DataFrame:
    """Counts and rounded rates per minute; empty minutes are left out."""
    nx = F.col("response_code") == 3
    udp = (F.col("protocol") == "udp") & (F.col("message_type") == 1)
    return stg.groupBy("packet_minute").agg(
        count_rows().alias("total_packets"),
        count_where(F.col("message_type") == 0).alias("total_queries"),
        count_where(F.col("message_type") == 1).alias("total_responses"),
        count_where(nx).alias("nxdomain_count"),
        F.round(percent(count_where(nx), count_where(F.col("message_type") == 1)), 2).alias(
            "nxdomain_rate_pct"
        ),
        count_where(udp).alias("udp_responses"),
        count_where(udp & (F.col("is_truncated") == 1)).alias("udp_truncated_count"),
        F.round(
            percent(count_where(udp & (F.col("is_truncated") == 1)), count_where(udp)), 2
        ).alias("udp_truncation_rate_pct"),
    ).orderBy("packet_minute")


def pareto_mart(stg: DataFrame) -> DataFrame:
    """Ranking of all query prefixes."""
    queries = stg.where((F.col("message_type") == 0) & F.col("src_prefix").isNotNull())
    counts = queries.groupBy("src_prefix").agg(count_rows().alias("query_count"))
    return pareto_full(counts, "src_prefix", "query_count")


def protocol_mart(stg: DataFrame, min_responses: int = 10) -> DataFrame:
    """Responses per record type and code with the share inside the type."""
    responses = stg.where((F.col("message_type") == 1) & F.col("qtype_name").isNotNull())
    counts = responses.groupBy("qtype_name", "response_code").agg(
        count_rows().alias("response_count")
    )
    total = F.sum("response_count").over(Window.partitionBy("qtype_name"))
    return (
        counts.withColumn("qtype_total", total)
        .where(F.col("qtype_total") >= min_responses)
        .orderBy(
            F.desc("qtype_total"), F.asc("qtype_name"),
            F.desc("response_count"), F.asc("response_code"),
        )
        .select(
            "qtype_name", "response_code", "response_count",
            F.round(percent("response_count", "qtype_total"), 2).alias("row_percentage"),
        )
    )


def build_marts(stg: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Compute the temporal, Pareto and protocol marts now, as stored tables.

    Tests and reports on the marts then read these small tables and not the packets.
    """
    return stage(temporal_mart(stg)), stage(pareto_mart(stg)), stage(protocol_mart(stg))


def not_null_tests(stg: DataFrame, temporal: DataFrame, pareto: DataFrame) -> DataFrame:
    """Failing rows of the eight not-null tests, counted per test; one pass per table."""

    def failures(df: DataFrame, model: str, tests: dict) -> DataFrame:
        totals = df.agg(
            *[
                count_where(F.col(c).isNull() if w is None else F.col(c).isNull() & w).alias(c)
                for c, w in tests.items()
            ]
        )
        rows = [
            F.struct(
                F.lit(model).alias("model"), F.lit(c).alias("column"), F.col(c).alias("failures")
            )
            for c in tests
        ]
        return totals.select(F.inline(F.array(*rows)))

    staging_tests = {
        "packet_timestamp": None,
        "message_type": None,
        "protocol": None,
        "response_code": F.col("message_type") == 1,
    }
    return (
        failures(stg, "staging", staging_tests)
        .unionByName(failures(temporal, "temporal", {"packet_minute": None, "total_packets": None}))
        .unionByName(failures(pareto, "pareto", {"prefix_rank": None, "src_prefix": None}))
    )


def data_tests(
    stg: DataFrame, temporal: DataFrame, pareto: DataFrame, matrix: DataFrame
) -> DataFrame:
    """All data tests of the marts with the number of failing rows; zero means passed.

    The marts are used by several tests each, so pass stored ones (``build_marts``).
    """

    def counted(name: str, rows: DataFrame) -> DataFrame:
        return rows.agg(count_rows().alias("failures")).select(F.lit(name).alias("test"), "failures")

    nulls = not_null_tests(stg, temporal, pareto).select(
        F.concat_ws(" ", F.lit("not_null"), "model", "column").alias("test"), "failures"
    )
    parts = [
        counted("unique temporal packet_minute", quality.unique(temporal, "packet_minute")),
        counted("unique pareto prefix_rank", quality.unique(pareto, "prefix_rank")),
        counted(
            "accepted_values staging message_type",
            quality.accepted_values(stg, "message_type", [0, 1]),
        ),
        counted(
            "accepted_values staging protocol",
            quality.accepted_values(stg, "protocol", ["udp", "tcp"]),
        ),
        counted(
            "temporal total equals staging total",
            quality.total_mismatch(stg, temporal).where("failed"),
        ),
        counted("first pareto share in range", quality.pareto_first_rank(pareto)),
        counted("matrix rows add up to 100", quality.matrix_row_sums(matrix)),
        counted("staging has rows", quality.not_empty(stg)),
    ]
    result = nulls
    for part in parts:
        result = result.unionByName(part)
    return result
