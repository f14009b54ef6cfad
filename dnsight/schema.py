"""Packet table schema and the fixed protocol values."""

from __future__ import annotations

from pyspark.sql import types as T

# One row per DNS message, 34 documented columns. Spark has no unsigned types, so
# the 16-bit fields are held as int and the 32-bit lengths as bigint.
PACKET_SCHEMA = T.StructType(
    [
        T.StructField("ts", T.DoubleType()),
        T.StructField("ts_iso", T.StringType()),
        T.StructField("ip_ver", T.ByteType()),
        T.StructField("proto", T.StringType()),
        T.StructField("src_ip", T.StringType()),
        T.StructField("src_port", T.IntegerType()),
        T.StructField("dst_ip", T.StringType()),
        T.StructField("dst_port", T.IntegerType()),
        T.StructField("frame_len", T.LongType()),
        T.StructField("dns_len", T.LongType()),
        T.StructField("dns_id", T.IntegerType()),
        T.StructField("qr", T.ByteType()),
        T.StructField("opcode", T.ByteType()),
        T.StructField("aa", T.ByteType()),
        T.StructField("tc", T.ByteType()),
        T.StructField("rd", T.ByteType()),
        T.StructField("ra", T.ByteType()),
        T.StructField("ad", T.ByteType()),
        T.StructField("cd", T.ByteType()),
        T.StructField("rcode", T.ShortType()),
        T.StructField("qdcount", T.IntegerType()),
        T.StructField("ancount", T.IntegerType()),
        T.StructField("nscount", T.IntegerType()),
        T.StructField("arcount", T.IntegerType()),
        T.StructField("qname", T.StringType()),
        T.StructField("qtype", T.IntegerType()),
        T.StructField("qtype_name", T.StringType()),
        T.StructField("qclass", T.IntegerType()),
        T.StructField("edns", T.ByteType()),
        T.StructField("edns_udpsize", T.IntegerType()),
        T.StructField("do", T.ByteType()),
        T.StructField("ecs", T.StringType()),
        T.StructField("ecs_scope", T.ShortType()),
        T.StructField("answers", T.StringType()),
    ]
)

# DNS response codes.
RCODE_NAMES = {
    0: "NOERROR",
    1: "FORMERR",
    2: "SERVFAIL",
    3: "NXDOMAIN",
    4: "NOTIMP",
    5: "REFUSED",
    6: "YXDOMAIN",
    7: "YXRRSET",
    8: "NXRRSET",
    9: "NOTAUTH",
    10: "NOTZONE",
    16: "BADVERS",
    17: "BADKEY",
    18: "BADTIME",
    19: "BADMODE",
    20: "BADNAME",
    21: "BADALG",
    22: "BADTRUNC",
    23: "BADCOOKIE",
}

# Recommended EDNS buffer, and the columns that identify one transaction message.
EDNS_RECOMMENDED_UDP_SIZE = 1232
TRANSACTION_KEY = ["ts", "src_ip", "src_port", "dst_ip", "dst_port", "dns_id", "qname", "qr"]
REQUIRED_COLUMNS = [
    "ts_iso", "qr", "rcode", "proto", "tc", "qname", "src_ip", "dst_ip", "frame_len", "qtype_name",
]
