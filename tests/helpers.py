"""Small packet frames for tests."""

from datetime import datetime, timedelta

START = datetime(2026, 8, 19, 8)
SCHEMA = (
    "dt timestamp_ntz, src_ip string, dst_ip string, proto string, frame_len bigint,"
    " dns_len bigint, qdcount int, qr tinyint, qtype_name string, rcode smallint, qname string,"
    " tc tinyint, cd tinyint"
)
CLIENT, SERVER = "2001:db8:1111::1", "2001:db8:ffff::53"


def packet(minute=0, second=0, **values):
    qr = values.get("qr", 0)
    row = {
        "dt": START + timedelta(minutes=minute, seconds=second),
        "src_ip": CLIENT if qr == 0 else SERVER,
        "dst_ip": SERVER if qr == 0 else CLIENT,
        "proto": "udp",
        "frame_len": 100,
        "dns_len": 60,
        "qdcount": 1,
        "qr": 0,
        "qtype_name": "A",
        "rcode": 0 if qr == 1 else None,
        "qname": "api.example.com.",
        "tc": 0,
        "cd": 0,
    }
    return tuple({**row, **values}.values())


def query(minute=0, **values):
    return packet(minute, **{"qr": 0, **values})


def response(minute=0, **values):
    return packet(minute, **{"qr": 1, "rcode": 0, **values})


def nx(minute, host, count=1, **values):
    return [response(minute, rcode=3, dst_ip=host, **values)] * count


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def rows_of(df):
    return [r.asDict() for r in df.collect()]


def shared_fixture(spark):
    """120 packets, one per second: even rows are queries, odd rows are responses."""
    rows = []
    for i in range(120):
        qr = i % 2
        name = f"nx-host-{i}.invalid." if i % 4 == 0 else "api.example.com."
        proto = "tcp" if i % 5 == 0 else "udp"
        rows.append(
            packet(
                0, i, qr=qr,
                src_ip="2001:db8:1111:0000::1" if i % 2 == 0 else "2001:db8:2222:0000::2",
                dst_ip="2001:db8:aaaa:0000::10" if i % 3 == 0 else "2001:db8:bbbb:0000::20",
                proto=proto, frame_len=64 + i, dns_len=24 + i,
                qtype_name=["A", "AAAA", "ANY"][i % 3],
                rcode=None if qr == 0 else 3 if "invalid" in name else 0,
                qname=name, tc=1 if qr and proto == "udp" and i % 10 == 0 else 0,
            )
        )
    return frame(spark, rows)
