"""The report's single scan against the operators that read the packets, and its sections as files."""

import json
import os

import pytest
from pyspark.sql import functions as F

from dnsight.operators import concentration, priority, rollup, temporal, traffic
from dnsight.plans import report
from tests.conftest import SF_SMALL
from tests.helpers import nx, query, response, frame, rows_of
from workload.packets import packets
from workload.rules import suffix_table


@pytest.fixture(scope="module", params=["derived", "odd"])
def rows(request, spark):
    if request.param == "derived":
        return packets(spark, SF_SMALL)
    return frame(spark, [
        query(0), query(1), query(1, src_ip=None), query(3, src_ip="bad"), *nx(3, "2001:db8:1111::1", 3), *nx(2, None),
        response(2, proto="tcp"), query(2, qr=None), query(4, rcode=3), response(5, qtype_name=None),
    ])


def values(df):
    rows = [tuple(round(v, 9) if isinstance(v, float) else v for _, v in sorted(r.asDict().items())) for r in df.collect()]
    return sorted(rows, key=str)


def same(a, b):
    assert values(a) == values(b)


@pytest.mark.parametrize("steady", temporal.STEADY_RULES)
def test_cube_gives_what_the_operators_give(rows, steady):
    cube = rollup.packet_cube(rows).cache()
    window = temporal.steady_window(rows, steady)
    same(rollup.header_counts(cube), traffic.traffic_rollup(rows))
    same(rollup.source_profile(cube, window), priority.source_profile(rows, steady))
    same(rollup.pareto_top(cube), concentration.pareto_top(rows))
    same(rollup.top_series(cube, window), concentration.top_series(rows, steady=steady))


def test_no_packets(spark):
    cube = rollup.packet_cube(frame(spark, []))
    window = temporal.steady_window(frame(spark, []))
    assert rollup.source_profile(cube, window).count() == 0 and rollup.pareto_top(cube).count() == 0


def test_sections_as_files(spark, folder):
    made = report.report_sections(packets(spark, SF_SMALL), suffix_table(spark), min_responses=10, nx_min_responses=5)
    path = os.path.join(folder, "sections")
    report.write_sections(made, path)
    nested = rows_of(report.nested_report(made))[0]
    for name, rows in made.sections.items():
        lines = [line for f in sorted(os.listdir(f"{path}/{name}")) if f.endswith(".json") for line in open(f"{path}/{name}/{f}")]
        top, _, part = name.partition(".")
        found = nested[top] if not part or part == "values" else nested[top][part]
        if name not in report.ONE_ROW:
            assert len(lines) == rows.count() == len(found)
        elif part != "values":
            assert [json.loads(line) for line in lines] == [json.loads(json.dumps(found.asDict()))]
    assert [m["time"] for m in nested["temporal"]["minutes"]] == sorted(m["time"] for m in nested["temporal"]["minutes"])
    assert nested["temporal"]["nx_rate_global"] > 0 and nested["decomposition"]["cov10"] >= nested["decomposition"]["cov5"]


def test_packets_are_read_twice(spark):
    """The cube and the NXDOMAIN counts; counted by an accumulator in a column that both read."""
    reads = spark.sparkContext.accumulator(0)

    @F.udf("int")
    def counted(value):
        reads.add(1)
        return value

    table = packets(spark, SF_SMALL)
    total = table.count()
    watched = table.withColumn("qr", counted("qr").cast("tinyint"))
    report.nested_report(report.report_sections(watched, suffix_table(spark), min_responses=10, nx_min_responses=5)).collect()
    assert total <= reads.value <= 3 * total
