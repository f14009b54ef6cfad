"""Staged packet table: renamed, typed columns."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dnsight.functions import address, clock
from dnsight.functions import predicates as P

# Integer columns of the staged table and their source columns.
_INTEGERS = {
    "ip_version": "ip_ver",
    "src_port": "src_port",
    "dst_port": "dst_port",
    "frame_length_bytes": "frame_len",
    "dns_length_bytes": "dns_len",
    "transaction_id": "dns_id",
    "message_type": "qr",
    "opcode": "opcode",
    "is_authoritative": "aa",
    "is_truncated": "tc",
    "is_recursion_desired": "rd",
    "is_recursion_available": "ra",
    "response_code": "rcode",
    "question_count": "qdcount",
    "answer_count": "ancount",
    "qtype": "qtype",
    "is_edns_supported": "edns",
    "edns_buffer_size": "edns_udpsize",
}


def staged(packets: DataFrame, parsed_prefix: bool = True) -> DataFrame:
    """27 staged columns.

    ``src_prefix`` is the network of the source address; with ``parsed_prefix=False`` it is what
    the address pattern matches, which for IPv6 is not a /48.
    """
    if parsed_prefix:
        prefix = address.network_prefix("src_ip")
    else:
        prefix = address.staged_prefix_by_pattern("src_ip", "ip_ver")
    return packets.select(
        F.col("dt").alias("packet_timestamp"),
        clock.minute_floor("dt").alias("packet_minute"),
        F.lower(F.col("proto").cast("string")).alias("protocol"),
        "src_ip",
        "dst_ip",
        *[F.col(source).cast("int").alias(name) for name, source in _INTEGERS.items()],
        P.message_type_name().alias("message_type_name"),
        "qname",
        F.col("qtype_name").cast("string").alias("qtype_name"),
        prefix.alias("src_prefix"),
    )
