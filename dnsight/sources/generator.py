"""Synthetic packets for trials: seeded, any number of rows, the same on any partitioning."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dnsight.functions.clock import with_event_time
from dnsight.sources.writers import write_parquet

# Fixed values of the sample: capture start (epoch), client networks, shares per thousand.
CAPTURE_START = 1787126400
NETWORKS = [
    ("2001:db8:aaaa", 500), ("2001:db8:bbbb", 250), ("2001:db8:cccc", 150), ("2001:db8:dddd", 100),
]
RECORD_TYPES = [((1, "A"), 700), ((28, "AAAA"), 250), ((255, "ANY"), 50)]
RESPONSE_CODES = [(0, 880), (3, 100), (2, 20)]


def _draw(seed: int, topic: str, size: int) -> Column:
    """Repeatable number below ``size`` per row and topic."""
    return F.pmod(F.xxhash64("id", F.lit(seed), F.lit(topic)), F.lit(size))


def _choose(draw: Column, options: list[tuple]) -> Column:
    """Weighted choice: ``draw`` in 0..999, options as (value, share per thousand)."""
    result, limit = None, 0
    for value, share in options:
        limit += share
        condition = draw < limit
        result = F.when(condition, value) if result is None else result.when(condition, value)
    return result


def sample_packets(spark: SparkSession, n_rows: int = 2000, seed: int = 42) -> DataFrame:
    ids = spark.range(n_rows)
    draws = ids.select(
        "id",
        (F.lit(CAPTURE_START) + _draw(seed, "time", 1800)).cast("double").alias("ts"),
        _choose(_draw(seed, "net", 1000), NETWORKS).alias("net"),
        (F.lit(1) + _draw(seed, "host", 9998)).alias("host"),
        (F.lit(1) + _draw(seed, "server", 9)).alias("server"),
        _choose(_draw(seed, "type", 1000), [(t[0], s) for t, s in RECORD_TYPES]).alias("qtype"),
        _choose(_draw(seed, "type", 1000), [(t[1], s) for t, s in RECORD_TYPES]).alias(
            "qtype_name"
        ),
        _draw(seed, "direction", 2).cast("tinyint").alias("qr"),
        _choose(_draw(seed, "code", 1000), RESPONSE_CODES).alias("code"),
        F.when(_draw(seed, "proto", 100) < 95, "udp").otherwise("tcp").alias("proto"),
        (F.lit(64) + _draw(seed, "length", 1336)).alias("frame_len"),
        (F.lit(1024) + _draw(seed, "port", 64511)).cast("int").alias("src_port"),
        (F.lit(1) + _draw(seed, "dns_id", 65534)).cast("int").alias("dns_id"),
        _draw(seed, "cut", 100).alias("cut"),
    )
    response = F.col("qr") == 1
    rcode = F.when(response, F.col("code")).cast("smallint")
    truncated = (
        response & (F.col("proto") == "udp") & (F.col("frame_len") > 1232) & (F.col("cut") < 60)
    )
    answered = F.coalesce(rcode == 0, F.lit(False))
    flag = {c: F.lit(v).cast("tinyint") for c, v in
            (("opcode", 0), ("aa", 0), ("rd", 1), ("ra", 1), ("ad", 0), ("cd", 0), ("edns", 1),
             ("do", 0), ("ip_ver", 6))}
    rows = draws.select(
        "ts",
        flag["ip_ver"].alias("ip_ver"),
        "proto",
        F.concat("net", F.lit(":"), F.lower(F.hex("host")), F.lit("::1")).alias("src_ip"),
        F.concat(F.lit("2001:db8:ffff::"), F.lower(F.hex("server"))).alias("dst_ip"),
        "src_port",
        F.lit(53).alias("dst_port"),
        "frame_len",
        F.greatest(F.col("frame_len") - 40, F.lit(20)).alias("dns_len"),
        "dns_id",
        "qr",
        *[flag[c].alias(c) for c in ("opcode", "aa")],
        F.when(truncated, 1).otherwise(0).cast("tinyint").alias("tc"),
        *[flag[c].alias(c) for c in ("rd", "ra", "ad", "cd")],
        rcode.alias("rcode"),
        F.lit(1).alias("qdcount"),
        F.when(response & answered, 1).otherwise(0).alias("ancount"),
        F.lit(0).alias("nscount"),
        F.lit(1).alias("arcount"),
        F.when(answered, "example.com.").otherwise(
            F.concat(F.lit("nonexistent-"), F.col("id").cast("string"), F.lit(".example.com."))
        ).alias("qname"),
        "qtype",
        "qtype_name",
        F.lit(1).alias("qclass"),
        flag["edns"].alias("edns"),
        F.lit(1232).alias("edns_udpsize"),
        flag["do"].alias("do"),
    )
    return with_event_time(rows)


def write_sample(
    spark: SparkSession, path: str, n_rows: int = 2000, force: bool = False, seed: int = 42
) -> None:
    """Write a sample; an existing one stays unless ``force`` is set."""
    write_parquet(
        sample_packets(spark, n_rows, seed).drop("dt"), path,
        mode="overwrite" if force else "ignore",
    )
