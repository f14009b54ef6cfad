"""Column expressions against known values and against the standard library."""

import ipaddress
import math
import random
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from dnsight.functions import address, clock, measures, names
from dnsight.functions import predicates as P


def values(spark, inputs, expression, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(inputs)], f"i int, x {kind}")
    return [r[0] for r in df.orderBy("i").select(expression(F.col("x"))).collect()]


def expected_prefix(text):
    try:
        ip = ipaddress.ip_address(text)
    except ValueError:
        return "UNKNOWN"
    size = 48 if ip.version == 6 else 24
    return str(ipaddress.ip_network(f"{ip}/{size}", strict=False))


def test_prefix_known_cases(spark):
    cases = {
        "2001:db8:abcd:12::1": "2001:db8:abcd::/48",
        "2001:DB8:0:1::1": "2001:db8::/48",
        "2001:0:1::9": "2001:0:1::/48",
        "::1": "::/48",
        "0:0:1::2": "0:0:1::/48",
        "fe80::1%eth0": "fe80::/48",
        "192.0.2.77": "192.0.2.0/24",
        "192.0.2.300": "UNKNOWN",
        "1.2.3": "UNKNOWN",
        "a::b::c": "UNKNOWN",
        "12345::1": "UNKNOWN",
        "": "UNKNOWN",
        None: "UNKNOWN",
    }
    assert values(spark, list(cases), address.network_prefix) == list(cases.values())


def _random_texts(count, seed=7):
    rng = random.Random(seed)
    pieces = ["0", "00", "0000", "1", "db8", "0db8", "DB8", "ffff", "2001", "abcde", "g", ""]
    texts = []
    for _ in range(count):
        groups = [rng.choice(pieces[:9]) for _ in range(rng.randint(0, 9))]
        kind = rng.randrange(9)
        if kind == 0:
            text = str(ipaddress.IPv6Address(rng.getrandbits(128)))
        elif kind == 1:
            text = ipaddress.IPv6Address(rng.getrandbits(128)).exploded.upper()
        elif kind == 2:
            text = str(ipaddress.IPv6Address(rng.getrandbits(rng.choice([16, 60, 90, 100]))))
        elif kind == 3:
            text = ".".join(str(rng.choice([0, 1, 9, 10, 99, 199, 249, 255, 256, "01"]))
                            for _ in range(rng.choice([3, 4, 4, 4, 5])))
        elif kind == 4:
            cut = rng.randint(0, len(groups))
            text = ":".join(groups[:cut]) + "::" + ":".join(groups[cut:])
        elif kind == 5:
            cut = rng.randint(0, len(groups))
            text = ":".join(groups[:cut]) + "::" + ":".join(groups[cut:] + ["1.2.3.4"])
        elif kind == 6:
            text = ":".join(groups + rng.choice([[], ["1.2.3.4"], ["1.2.3.400"]]))
        elif kind == 7:
            text = ":".join(rng.choice(pieces) for _ in range(rng.randint(6, 9)))
        else:
            text = str(ipaddress.IPv6Address(rng.getrandbits(128))) + rng.choice(
                ["%eth0", "%", "%a%b", "\n", " ", "/48", "%a/b", "%a:b"]
            )
        texts.append(text)
    return texts


def test_prefix_agrees_with_the_standard_library(spark):
    texts = sorted(set(_random_texts(20000)))
    found = values(spark, texts, address.network_prefix)
    wrong = [(t, f, expected_prefix(t)) for t, f in zip(texts, found) if f != expected_prefix(t)]
    assert wrong == []


def test_prefix_variants(spark):
    assert values(spark, ["bad-ip", None, "10.1.2.3"], address.network_prefix_or_text) == [
        "bad-ip", None, "10.1.2.0/24",
    ]
    assert values(spark, ["bad-ip", None], address.network_prefix_or_null) == ["UNKNOWN", None]
    # The pattern class contains the separator, so it takes the whole IPv6 text.
    assert values(spark, ["2001:db8:1::5", "10.1.2.3"], address.prefix_by_pattern) == [
        "2001:db8:1::5", "",
    ]


def entropy_of(text):
    return -sum(
        text.count(c) / len(text) * math.log2(text.count(c) / len(text)) for c in set(text)
    ) if text else 0.0


def test_entropy(spark):
    texts = ["", "aaaa", "abcd", "aab.c1", "x\\032y", "ünïcode", "a|b|(c)[d]$^*"]
    found = values(spark, texts, names.entropy)
    assert found == [pytest.approx(entropy_of(t), abs=1e-6) for t in texts]
    assert found[3] == 2.251629
    assert values(spark, [None], names.entropy) == [None]


def test_name_expressions(spark):
    texts = ["API.Shop3.CO.ID.", "localhost.", "", "a..b", None]
    assert values(spark, texts, names.normalised) == [
        "api.shop3.co.id", "localhost", "", "a..b", None,
    ]
    clean = ["api.shop3.co.id", "localhost", "", "a-9_b.x1"]
    assert values(spark, clean, names.label_count) == [4, 1, 1, 2]
    assert values(spark, clean, names.longest_label) == [5, 9, 0, 5]
    assert values(spark, clean, names.digit_count) == [1, 0, 0, 2]
    assert values(spark, clean, names.digit_ratio) == [0.066667, 0.0, None, 0.25]
    assert values(spark, clean, names.top_level) == ["id", "none", "none", "x1"]
    assert values(spark, clean, names.last_two_labels) == ["co.id", "localhost", "", "a-9_b.x1"]
    odd = ["a b", "x\\032y", "x\\199y", "ok.id"]
    assert values(spark, odd, names.foreign_characters) == [1, 1, 1, 0]
    assert values(spark, odd, names.in_selected_charset) == [False, False, False, True]
    assert values(spark, odd, names.has_escape) == [False, True, True, False]
    assert values(spark, odd, lambda c: names.has_escape(c, strict=True)) == [
        False, True, False, False,
    ]


def test_clock(spark):
    moments = [datetime(2026, 8, 19, 8, 0, 59, 999999), datetime(2026, 8, 19, 8, 1), None]
    assert values(spark, moments, clock.minute_floor, "timestamp_ntz") == [
        datetime(2026, 8, 19, 8, 0), datetime(2026, 8, 19, 8, 1), None,
    ]
    assert values(spark, moments, clock.minute_ceil, "timestamp_ntz") == [
        datetime(2026, 8, 19, 8, 1), datetime(2026, 8, 19, 8, 1), None,
    ]
    assert values(spark, [1787126400.415818, 0.0, -1.5], clock.from_epoch, "double") == [
        datetime(2026, 8, 19, 8, 0, 0, 415818), datetime(1970, 1, 1),
        datetime(1969, 12, 31, 23, 59, 58, 500000),
    ]
    texts = [
        "2026-08-19T08:00:00Z", "2026-08-19T08:00:00.5", "2026-08-19T15:00:00+07:00",
        "2026-08-19 08:00:00", "2026-08-19", "no time", "", None,
    ]
    eight = datetime(2026, 8, 19, 8)
    assert values(spark, texts, clock.from_iso) == [
        eight, eight.replace(microsecond=500000), eight, eight, datetime(2026, 8, 19),
        None, None, None,
    ]


@pytest.mark.parametrize("zone", ["Asia/Jakarta", "America/New_York"])
def test_clock_ignores_the_session_zone(spark, zone):
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        # 02:30 on this day does not exist in New York.
        missing = datetime(2026, 3, 8, 2, 30, 30)
        assert values(spark, [missing], clock.minute_floor, "timestamp_ntz") == [
            missing.replace(second=0)
        ]
        assert values(spark, ["2026-03-08T02:30:30Z"], clock.from_iso) == [missing]
        assert values(spark, [1772937030.0], clock.from_epoch, "double") == [missing]
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_event_time_needs_a_time_column(spark):
    with pytest.raises(ValueError):
        clock.with_event_time(spark.range(1))


def test_measures(spark):
    df = spark.createDataFrame([(3, 4), (1, 0), (None, 5)], "a int, b int")
    found = [r[0] for r in df.select(measures.percent("a", "b")).collect()]
    assert found == [75.0, None, None]
    assert [r[0] for r in df.select(measures.percent("a", "b", 0.0)).collect()] == [75.0, 0.0, 0.0]
    assert values(spark, [11_712_623, 1234], measures.millions_text, "bigint") == [
        "11.7 M", "1,234",
    ]
    assert values(spark, [12.345, None], measures.percent_text, "double") == ["12.35%", None]


def test_rcode_names(spark):
    assert values(spark, [0, 3, 23, 11, None], P.rcode_name, "int") == [
        "NOERROR", "NXDOMAIN", "BADCOOKIE", "CODE_11", None,
    ]
