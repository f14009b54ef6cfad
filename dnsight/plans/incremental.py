"""Marts that are kept up to date capture by capture.

What is stored of a capture is a state that adds up (counts per minute and header values, and per minute
and client network), in a partition of its own. Loading a capture reads that capture only and
replaces its partition; the marts are views over all states, with rates and ranks formed last.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dnsight.functions.address import UNKNOWN
from dnsight.functions.measures import count_rows, count_where, percent
from dnsight.operators import rollup
from dnsight.operators.concentration import pareto_full
from dnsight.operators.traffic import protocol_matrix


def load_capture(packets: DataFrame, path: str, capture: str) -> None:
    """Store the state of one capture; loading it again replaces it, others are not touched."""
    state = rollup.packet_cube(packets).withColumn("capture", F.lit(capture))
    state.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("capture").parquet(path)


def state(spark: SparkSession, path: str) -> DataFrame:
    """The states of all captures."""
    return spark.read.option("basePath", path).parquet(path)


def temporal_mart(states: DataFrame) -> DataFrame:
    """What ``marts.temporal_mart`` gives for all captures together."""
    rows = rollup.header_counts(states).withColumn("proto", F.lower("proto"))
    nx, response = F.col("rcode") == 3, F.col("qr") == 1
    udp = (F.col("proto") == "udp") & response
    tc = udp & (F.col("tc") == 1)
    return rows.groupBy(F.col("minute").alias("packet_minute")).agg(
        count_rows("n").alias("total_packets"),
        count_where(F.col("qr") == 0, "n").alias("total_queries"),
        count_where(response, "n").alias("total_responses"),
        count_where(nx, "n").alias("nxdomain_count"),
        F.round(percent(count_where(nx, "n"), count_where(response, "n")), 2).alias("nxdomain_rate_pct"),
        count_where(udp, "n").alias("udp_responses"),
        count_where(tc, "n").alias("udp_truncated_count"),
        F.round(percent(count_where(tc, "n"), count_where(udp, "n")), 2).alias("udp_truncation_rate_pct"),
    ).orderBy("packet_minute")


def pareto_mart(states: DataFrame) -> DataFrame:
    """What ``marts.pareto_mart`` gives for all captures together."""
    rows = states.where((F.col("set") == "source") & (F.col("qr") == 0))
    counts = rows.groupBy(F.coalesce("prefix", F.lit(UNKNOWN)).alias("src_prefix")).agg(F.sum("n").alias("query_count"))
    return pareto_full(counts, "src_prefix", "query_count")


def protocol_mart(states: DataFrame, min_responses: int = 10) -> DataFrame:
    """What ``marts.protocol_mart`` gives for all captures together."""
    matrix = protocol_matrix(rollup.header_counts(states), min_responses=min_responses, digits=2, weight="n")
    return matrix.orderBy(
        F.desc("qtype_total"), F.asc("qtype_name"), F.desc("response_count"), F.asc("response_code")
    ).select("qtype_name", "response_code", "response_count", "row_percentage")
