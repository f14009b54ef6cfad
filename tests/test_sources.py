"""Readers, writers, generator and report."""

import json
import os
import time
from datetime import datetime

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from dnsight.operators.suffix import default_rules, read_rules
from dnsight.plans import flow, report
from dnsight.sources import generator, readers, storage, writers
from tests.conftest import SF_SMALL
from tests.helpers import rows_of, shared_fixture
from workload.packets import packets


def write(folder, name, text):
    path = os.path.join(folder, name)
    with open(path, "w") as file:
        file.write(text)
    return path


def test_csv_columns_are_matched_by_name(spark, folder):
    path = write(folder, "a.csv", "qname,extra,qr,ts\na.id.,7,1,1787126400.5\n")
    df = readers.read_csv(spark, path)
    assert dict(df.dtypes) == {
        "qname": "string", "extra": "string", "qr": "tinyint", "ts": "double",
        "dt": "timestamp_ntz",
    }
    assert df.first()["dt"] == datetime(2026, 8, 19, 8, 0, 0, 500000)


def test_csv_literals_and_limit(spark, folder):
    path = write(folder, "a.csv", "ts,qname,rcode\n0,nan,3\n1,NULL,\n2,,0\n3,\"\",0\n")
    df = readers.read_packets(spark, path)
    assert [r["qname"] for r in df.orderBy("ts").collect()] == ["nan", "NULL", None, None]
    assert [r["rcode"] for r in df.orderBy("ts").collect()] == [3, None, 0, 0]
    assert readers.read_packets(spark, path, limit=2).count() == 2


def test_short_rows_are_padded(spark, folder):
    path = write(folder, "a.csv", "ts,qname,rcode\n0,a.id.,3\n1,b.id.\n")
    found = [r["rcode"] for r in readers.read_csv_inferred(spark, path).orderBy("ts").collect()]
    assert found == [3, None]


def test_wrong_values(spark, folder):
    path = write(folder, "a.csv", "ts,qr\n0,1\n1,oops\n")
    found = readers.read_csv(spark, path, mode="PERMISSIVE").orderBy("ts").collect()
    assert [r["qr"] for r in found] == [1, None]
    for df in (readers.read_csv(spark, path), readers.read_packets(spark, path)):
        with pytest.raises(Exception, match="FAILFAST|MALFORMED"):
            df.collect()


def test_reader_errors(spark, folder):
    with pytest.raises(AnalysisException):
        readers.read_packets(spark, os.path.join(folder, "missing.csv"))
    with pytest.raises(ValueError):
        readers.read_packets(spark, folder, fmt="xml")
    with pytest.raises(ValueError):
        readers.read_csv(spark, write(folder, "b.csv", "qname\na\n"))


def test_csv_to_parquet(spark, folder):
    lines = "".join(f"{1787126400 + i},10.0.0.{i % 9},a{i % 5}.id.,{i % 2}\n" for i in range(5000))
    source = write(folder, "a.csv", "ts,src_ip,qname,qr\n" + lines)
    target = os.path.join(folder, "a.parquet")
    (sizes,) = rows_of(writers.csv_to_parquet(spark, source, target))
    assert sizes["raw_size_mb"] == pytest.approx(os.path.getsize(source) / 2**20)
    assert 0 < sizes["parquet_size_mb"] < sizes["raw_size_mb"]
    assert sizes["compression_ratio_pct"] > 50
    back = readers.read_packets(spark, target)
    assert rows_of(readers.load_statistics(back)) == [{"rows": 5000, "columns": 5}]
    assert any("zstd" in name for name in os.listdir(target))
    with pytest.raises(AnalysisException):
        writers.write_parquet(back, target)
    writers.write_parquet(back.limit(1), target, mode="ignore")
    assert spark.read.parquet(target).count() == 5000


def test_json_safe(spark, folder):
    df = spark.sql(
        "select named_struct('a', double('nan'), 'b', array(double('inf'), 1.5D, null)) s,"
        " timestamp_ntz'2026-08-19 08:00:00' t, cast(null as double) n"
    )
    path = os.path.join(folder, "report")
    writers.write_json(df, path)
    (name,) = [n for n in os.listdir(path) if n.endswith(".json")]
    with open(os.path.join(path, name)) as file:
        assert json.loads(file.read()) == {
            "s": {"a": None, "b": [None, 1.5, None]}, "t": "2026-08-19T08:00:00", "n": None,
        }


def test_publish(spark):
    writers.publish(spark.range(3), "three_rows")
    assert spark.sql("select count(*) from three_rows").first()[0] == 3


def test_stage_keeps_rows_and_types(spark):
    df = shared_fixture(spark)
    staged = storage.stage(df)
    assert staged.dtypes == df.dtypes
    assert sorted(map(str, staged.collect())) == sorted(map(str, df.collect()))


def test_scratch_tables_are_removed(spark):
    made = []

    def table(n):
        df = storage.stage(spark.range(n))
        made.append(df.inputFiles()[0].removeprefix("file://").rsplit("/", 1)[0])
        return df

    with storage.scratch(spark) as keep:
        table(3)
        with storage.scratch(spark) as keep_inside:
            inner = keep_inside(table(4).where("id > 1"))
            outer = keep(table(5))
        assert inner.count() == 2 and [os.path.exists(p) for p in made] == [True, False, False]
        kept = keep(inner)
    with pytest.raises(ValueError), storage.scratch(spark):
        table(6)
        raise ValueError
    assert not any(os.path.exists(p) for p in made)
    assert kept.count() == 2 and outer.count() == 5
    table(7)
    assert os.path.exists(made[-1])


def test_footer_statistics(spark, folder):
    rows, path = packets(spark, SF_SMALL), os.path.join(folder, "a.parquet")
    writers.write_parquet(rows, path)
    before = {k: spark.conf.get(k) for k in readers._FOOTERS}
    (found,) = rows_of(readers.footer_statistics(spark, path, ("ts", "frame_len")))
    expected = rows.agg(F.count(F.lit(1)).alias("rows"), *[f(c).alias(f"{f.__name__}_{c}") for c in ("ts", "frame_len") for f in (F.min, F.max)]).first()
    assert found == expected.asDict()
    with pytest.raises(ValueError, match="qname"):
        readers.footer_statistics(spark, path, ("qname",))
    assert {k: spark.conf.get(k) for k in readers._FOOTERS} == before


def test_bucketed_tables_need_no_exchange(spark, folder):
    rows = packets(spark, SF_SMALL).where("src_ip is not null")
    tables = [writers.write_bucketed(rows, f"bucketed_{k}", "src_ip", 4, os.path.join(folder, str(k))) for k in range(2)]
    counts = [t.groupBy("src_ip").agg(F.count(F.lit(1)).alias(f"n{k}")) for k, t in enumerate(tables)]
    joined = counts[0].join(counts[1].hint("merge"), "src_ip")
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "SortMergeJoin" in plan
    assert {r["src_ip"]: r["n0"] for r in rows_of(joined)} == {r["src_ip"]: r["count"] for r in rows_of(rows.groupBy("src_ip").count())}
    files = [f for f in os.listdir(os.path.join(folder, "0")) if f.endswith(".parquet")]
    assert len(files) <= 4


def test_generator(spark, folder):
    rows = generator.sample_packets(spark, 4000)
    again = generator.sample_packets(spark.newSession(), 4000).repartition(3)
    assert rows.exceptAll(again).count() == 0
    other = generator.sample_packets(spark, 4000, seed=1)
    assert rows.exceptAll(other).count() > 0
    assert len(rows.columns) == 31
    found = rows.agg(
        F.count_if(F.expr("qr = 0 and rcode is not null")).alias("bad_queries"),
        F.count_if(F.expr("qr = 1 and rcode is null")).alias("bad_responses"),
        F.avg(F.expr("cast(src_ip like '2001:db8:aaaa:%' as int)")).alias("first_net"),
        F.avg(F.expr("cast(proto = 'udp' as int)")).alias("udp"),
        F.count_if(F.expr("tc = 1")).alias("tc"),
        F.count_if(F.expr("tc = 1 and (qr = 0 or proto = 'tcp' or frame_len <= 1232)")).alias("bad_tc"),
        F.min("ts").alias("lo"), F.max("ts").alias("hi"),
    ).first()
    assert (found["bad_queries"], found["bad_responses"], found["bad_tc"]) == (0, 0, 0)
    assert 0.46 < found["first_net"] < 0.54 and 0.93 < found["udp"] < 0.97 and found["tc"] > 0
    assert generator.CAPTURE_START <= found["lo"] <= found["hi"] < generator.CAPTURE_START + 1800
    path = os.path.join(folder, "sample.parquet")
    generator.write_sample(spark, path, 10)
    generator.write_sample(spark, path, 20)
    assert spark.read.parquet(path).count() == 10
    generator.write_sample(spark, path, 20, force=True)
    assert spark.read.parquet(path).count() == 20


def test_suffix_list_file(spark, folder):
    path = write(folder, "list.dat", "// comment\n\ncom\n*.ck\n!www.ck\nco.id  // note\n")
    assert {(r["rule"], r["kind"]) for r in rows_of(read_rules(spark, path))} == {
        ("com", "exact"), ("*.ck", "wildcard"), ("www.ck", "exception"), ("co.id", "exact"),
    }


def test_report(spark, folder):
    rows = packets(spark, SF_SMALL)
    path = os.path.join(folder, "report")
    writers.write_json(
        report.build_report(rows, default_rules(spark), min_responses=10, nx_min_responses=5), path
    )
    (name,) = [n for n in os.listdir(path) if n.endswith(".json")]
    with open(os.path.join(path, name)) as file:
        text = file.read()
    assert "NaN" not in text and "Infinity" not in text
    found = json.loads(text)
    assert set(found) == {
        "meta", "kpi", "temporal", "pareto", "load_priority", "nx_priority", "bubble",
        "small_multiples", "decomposition", "truncation", "matrix", "composition",
    }
    assert found["meta"]["messages"] == 1000 and found["meta"]["steady_minutes"] == 28
    assert len(found["temporal"]["minutes"]) == 28
    assert [p["label"] for p in found["pareto"]] == [f"S{i}" for i in range(1, 11)]
    for section in ("load_priority", "nx_priority"):
        assert all(r["label"].startswith("S") for r in found[section]) and found[section]
    assert "2001:" not in text and "/48" not in text
    hosts = found["decomposition"]["hosts"]
    assert [h["label"] for h in hosts] == [f"H{i}" for i in range(1, len(hosts) + 1)]
    assert sum(c["count"] for c in found["composition"]["qtype"]) == found["meta"]["queries"]


def test_analyse_a_csv_file(spark, folder):
    source = os.path.join(folder, "in.csv")
    sample = generator.sample_packets(spark, 3000).drop("dt")
    sample.write.option("header", True).csv(source)
    target = os.path.join(folder, "out")
    summary = flow.analyse(spark, source, target, default_rules(spark), fmt="csv", validate=True)
    assert rows_of(summary) == [{"status": "PASSED", "validated_rows": 3000, "n_failures": 0}]
    (found,) = rows_of(spark.read.json(target))
    assert found["meta"]["messages"] == 3000 and found["meta"]["steady_minutes"] == 28
    flow.analyse(
        spark, source, target, default_rules(spark), fmt="csv", limit=500, mode="overwrite",
        steady=None, min_responses=10,
    )
    (found,) = rows_of(spark.read.json(target))
    assert found["meta"]["messages"] == 500
    assert found["pareto"][0]["label"] == "S1"


def test_staging_removes_what_it_shuffled(spark):
    disk = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    files = lambda: {f.name() for f in map(disk.getAllBlocks().apply, range(disk.getAllBlocks().size())) if f.isShuffle()}
    table = spark.range(0, 20000, 1, 4).select(F.xxhash64("id").alias("key")).groupBy("key").count()
    before = files()
    setting = spark.conf.get(storage.CLEANUP)
    staged = storage.stage(table)
    until = time.time() + 20
    while files() - before and time.time() < until:
        time.sleep(0.2)
    assert not files() - before
    assert spark.conf.get(storage.CLEANUP) == setting
    assert staged.count() == table.count() == 20000
