"""Network prefixes of address texts, without a UDF."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

UNKNOWN = "UNKNOWN"

_OCTET = r"(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
_V4 = rf"{_OCTET}(?:\.{_OCTET}){{3}}"
_H = "[0-9a-fA-F]{1,4}"
_ZONE = r"(?:%[^%/]+)?"
# Eight groups, where a dotted tail stands for two; \z instead of $, which forgives a final newline.
_FULL = rf"\A(?:{_H}:){{6}}(?:{_H}:{_H}|{_V4}){_ZONE}\z"
# At most seven groups around one "::".
_SHORT = (
    rf"\A(?!(?:(?:\A|::?){_H}(?=[:%]|\z)){{8}})(?!(?:(?:\A|::?){_H}(?=:)){{6,}}::?{_OCTET}\.)"
    rf"(?:{_H}(?::{_H})*)?::(?:(?:{_H}:)*(?:{_H}|{_V4}))?{_ZONE}\z"
)
# The usual form: hex groups only, at most seven around "::"; possessive, so it never backtracks.
_USUAL = rf"\A(?:{_H}(?::{_H})*+)?+::(?:{_H}(?::{_H})*+)?+\z"
# The most frequent form: three leading groups without leading zeros, then anything valid.
_CLEAN = (
    rf"\A(?=(?:[1-9a-fA-F][0-9a-fA-F]{{0,3}}:){{3}})"
    rf"(?:{_H}(?::{_H})*+::(?:{_H}(?::{_H})*+)?+|(?:{_H}:){{7}}{_H})\z"
)
_THREE_GROUPS = rf"\A{_H}:{_H}:{_H}:"
_HEAD = r"\A0*([0-9a-fA-F]+):0*([0-9a-fA-F]+):0*([0-9a-fA-F]+):.*\z"
_ZERO_TAIL = r"\A0(?::0)*\z|(?::0)+\z"

# The address patterns of the SQL staging model. The class contains the separator, so
# on a plain IPv6 text the first pattern matches the whole address and not a /48.
_PATTERN_V6 = "^([0-9a-fA-F:]+:[0-9a-fA-F:]+:[0-9a-fA-F:]+)"
_PATTERN_V4 = r"^([0-9]+\.[0-9]+\.[0-9]+)"


def _expanded(ip: Column) -> Column:
    """Valid text with its '::' written out as zero groups."""
    bare = F.substring_index(ip, "%", 1)
    groups = F.regexp_count(bare, F.lit("[^:]+")) + bare.contains(".").cast("int")
    zeros = F.concat(F.lit(":"), F.repeat(F.lit("0:"), F.lit(8) - groups))
    return F.ltrim(F.replace(bare, F.lit("::"), zeros), F.lit(":"))


def _prefix_v6(ip: Column) -> Column:
    # Up to seven colons mean at most seven groups around "::", or eight without; an address with
    # eight colons is left to the exact pattern.
    colons = F.length(ip) - F.length(F.replace(ip, F.lit(":"), F.lit("")))
    clean = (colons <= 7) & ip.rlike(_CLEAN)
    usual = (colons <= 7) & ip.rlike(_USUAL)
    valid = F.when(ip.contains("::"), usual | ip.rlike(_SHORT)).otherwise(ip.rlike(_FULL))
    body = F.when(ip.rlike(_THREE_GROUPS), ip).otherwise(_expanded(ip))
    head = F.regexp_replace(F.regexp_replace(body, _HEAD, "$1:$2:$3"), _ZERO_TAIL, "")
    whole = F.when(clean, F.substring_index(ip, ":", 3)).when(valid, head)
    return F.concat(F.lower(whole), F.lit("::/48"))


def _parsed_prefix(ip: Column) -> Column:
    return F.when(
        ip.contains(":"), _prefix_v6(ip)
    ).when(
        ip.rlike(rf"\A{_V4}\z"), F.concat(F.substring_index(ip, ".", 3), F.lit(".0/24"))
    )


def network_prefix(ip: Column | str) -> Column:
    """/48 of an IPv6 text, /24 of an IPv4 text, ``UNKNOWN`` for anything else and for null."""
    ip = F.col(ip) if isinstance(ip, str) else ip
    return F.coalesce(_parsed_prefix(ip), F.lit(UNKNOWN))


def network_prefix_or_null(ip: Column | str) -> Column:
    """As ``network_prefix``, but a missing address stays null."""
    ip = F.col(ip) if isinstance(ip, str) else ip
    return F.when(ip.isNotNull(), network_prefix(ip))


def network_prefix_or_text(ip: Column | str) -> Column:
    """As ``network_prefix``, but a text that is no address is returned as it is."""
    ip = F.col(ip) if isinstance(ip, str) else ip
    return F.coalesce(_parsed_prefix(ip), ip)


def prefix_by_pattern(ip: Column | str, version: int = 6) -> Column:
    """Text that the address pattern matches, '' when it does not match."""
    return F.regexp_extract(ip, _PATTERN_V6 if version == 6 else _PATTERN_V4, 1)


def staged_prefix_by_pattern(ip: Column | str, ip_ver: Column | str) -> Column:
    """Pattern prefix chosen by the IP version column, as the staging model has it."""
    ip = F.col(ip) if isinstance(ip, str) else ip
    ip_ver = F.col(ip_ver) if isinstance(ip_ver, str) else ip_ver
    return (
        F.when((ip_ver == 6) & ip.isNotNull(), prefix_by_pattern(ip, 6))
        .when((ip_ver == 4) & ip.isNotNull(), prefix_by_pattern(ip, 4))
        .otherwise(UNKNOWN)
    )
