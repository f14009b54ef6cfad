"""Loads of CSV files with differing headers and bad records."""

import os

import pytest

from dnsight.sources import quarantine
from tests.helpers import rows_of


def write(folder, name, text):
    path = os.path.join(folder, name)
    with open(path, "w", encoding="utf-8", newline="") as file:
        file.write(text)
    return path


def faults(load):
    return sorted((os.path.basename(r["file"]), r["line"], r["column"], r["text"], r["reason"]) for r in rows_of(load.rejected))


def test_columns_are_bound_by_each_files_header(spark, folder):
    write(folder, "a.csv", "ts,qname,qr\n1,a.id.,0\n2,b.id.,1\n")
    write(folder, "b.csv", "qr,extra,ts,qname\n1,x,3,c.id.\n")
    write(folder, "c.csv", "ts,qr\n4,0\n")
    load = quarantine.load_csv(spark, folder)
    found = sorted((r["ts"], r["qname"], r["qr"], r["extra"]) for r in rows_of(load.good))
    assert found == [(1.0, "a.id.", 0, None), (2.0, "b.id.", 1, None), (3.0, "c.id.", 1, "x"), (4.0, None, 0, None)]
    assert dict(load.good.dtypes)["qr"] == "tinyint" and dict(load.good.dtypes)["dt"] == "timestamp_ntz"
    assert faults(load) == []


def test_bad_records_are_set_aside_with_their_faults(spark, folder):
    write(folder, "a.csv", (
        "ts,qname,qr,src_port\n"
        "1,nan,0,53\n"
        "2,NULL,oops,70000000000\n"
        "\n"
        "x,a.id.,1,1\n"
        "4,b.id.\n"
        "5,c.id.,1,1,9\n"
        "ts,qname,qr,src_port\n"
        ",d.id.,1,\n"
        '7,"e,""id""",1,"12"\r\n'
        "8,,,\n"
    ))
    load = quarantine.load_csv(spark, folder)
    assert faults(load) == [
        ("a.csv", 3, "qr", "oops", "not a tinyint"), ("a.csv", 3, "src_port", "70000000000", "not a int"),
        ("a.csv", 5, "ts", "x", "not a double"), ("a.csv", 6, "", "4,b.id.", "wrong number of fields"),
        ("a.csv", 7, "", "5,c.id.,1,1,9", "wrong number of fields"), ("a.csv", 9, "ts", None, "no event time"),
    ]
    found = {r["ts"]: (r["qname"], r["qr"], r["src_port"]) for r in rows_of(load.good)}
    assert found == {1.0: ("nan", 0, 53), 7.0: ('e,"id"', 1, 12), 8.0: (None, None, None)}
    assert rows_of(load.counts) == [{"records": 8, "good": 3, "rejected": 5, "faults": 6}]
    assert {r["record"] for r in rows_of(load.rejected)} >= {"2,NULL,oops,70000000000", "x,a.id.,1,1"}
    untimed = quarantine.load_csv(spark, folder, need_time=False)
    assert rows_of(untimed.counts)[0]["good"] == 4


def test_line_numbers_of_files_in_many_splits(spark, folder):
    lines = [f"{k},a{k}.id.,{'bad' if k % 997 == 0 else k % 2}" for k in range(1, 20_001)]
    write(folder, "a.csv", "ts,qname,qr\n" + "\n".join(lines) + "\n")
    write(folder, "b.csv", "ts,qname,qr\n" + "\n".join(lines[:3000]) + "\n")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        load = quarantine.load_csv(spark, folder)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    expected = [(name, k + 1) for name, count in (("a.csv", 20_000), ("b.csv", 3000)) for k in range(997, count + 1, 997)]
    assert [f[:2] for f in faults(load)] == sorted(expected)
    assert rows_of(load.counts)[0] == {"records": 23_000, "good": 23_000 - len(expected), "rejected": len(expected), "faults": len(expected)}


def test_odd_files(spark, folder):
    write(folder, "only header.csv", "ts,qname\n")
    write(folder, "empty.csv", "")
    write(folder, "_ignored.csv", "nothing")
    write(folder, "a [1] {b}*.csv", "ts,qname\n1,a.id.\n")
    load = quarantine.load_csv(spark, folder)
    assert rows_of(load.counts) == [{"records": 1, "good": 1, "rejected": 0, "faults": 0}]
    with pytest.raises(ValueError, match="twice"):
        quarantine.load_csv(spark, write(folder, "twice.csv", "ts,ts\n1,2\n"))
    with pytest.raises(ValueError, match="needs a ts"):
        quarantine.load_csv(spark, write(folder, "no_time.csv", "qname\na\n"))


def test_iso_times(spark, folder):
    load = quarantine.load_csv(spark, write(folder, "a.csv", "ts_iso,qr\n2026-08-19T08:00:00Z,1\nsoon,1\n"))
    assert rows_of(load.good)[0]["dt"].isoformat() == "2026-08-19T08:00:00"
    assert faults(load) == [("a.csv", 3, "ts_iso", "soon", "no event time")]
