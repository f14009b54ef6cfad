"""Row predicates on the packet table. A null input is never true."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from dnsight.schema import RCODE_NAMES


def is_query() -> Column:
    return F.col("qr") == 0


def is_response() -> Column:
    return F.col("qr") == 1


def is_udp_response() -> Column:
    return is_response() & (F.col("proto") == "udp")


def is_tcp_response() -> Column:
    return is_response() & (F.col("proto") == "tcp")


def is_truncated_udp() -> Column:
    return is_udp_response() & (F.col("tc") == 1)


def is_nxdomain(any_direction: bool = False) -> Column:
    """NXDOMAIN message. By default only responses count; the SQL marts test the code alone."""
    code = F.col("rcode") == 3
    return code if any_direction else is_response() & code


def is_edns_query() -> Column:
    return is_query() & (F.col("edns") == 1)


def is_empty_answer() -> Column:
    """NOERROR response without answers but with an authority section."""
    return (
        is_response()
        & (F.col("rcode") == 0)
        & (F.col("ancount") == 0)
        & (F.col("nscount") > 0)
    )


def message_type_name() -> Column:
    return F.when(is_query(), "QUERY").otherwise("RESPONSE")


def rcode_name(code: Column | str) -> Column:
    """Response code text, ``CODE_n`` for a code without a name, null for null."""
    code = F.col(code) if isinstance(code, str) else code
    pairs = [F.lit(v) for item in RCODE_NAMES.items() for v in item]
    known = F.create_map(*pairs)[code.cast("int")]
    return F.when(code.isNotNull(), F.coalesce(known, F.concat(F.lit("CODE_"), code.cast("string"))))
