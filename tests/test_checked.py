"""Marts that are tested while they are written."""

import pytest
from pyspark.sql import functions as F

from dnsight.operators import quality
from dnsight.plans import checked, marts, staging
from tests.conftest import SF_SMALL
from tests.helpers import rows_of
from workload.packets import dirty_packets, packets


def both(rows):
    """The tests made on the way, and those made afterwards."""
    made = checked.build_checked_marts(rows)
    stg = staging.staged(rows)
    after = marts.data_tests(stg, *marts.build_marts(stg))
    return made, {r["test"]: r["failures"] for r in rows_of(made.tests)}, {r["test"]: r["failures"] for r in rows_of(after)}


@pytest.mark.parametrize("spoil", ["clean", "dirty", "no_time", "empty"])
def test_same_findings_as_afterwards(spark, spoil):
    rows = {
        "clean": lambda: packets(spark, SF_SMALL), "dirty": lambda: dirty_packets(spark, SF_SMALL),
        "no_time": lambda: packets(spark, SF_SMALL).withColumn("dt", F.when(F.expr("event_id % 10 > 0"), F.col("dt"))),
        "empty": lambda: packets(spark, SF_SMALL).where("false"),
    }[spoil]()
    made, found, expected = both(rows)
    assert found == expected and len(found) == 16
    assert rows_of(made.summary) == rows_of(quality.contract_summary(rows))
    by_rule = {r["column"]: r["n"] for r in rows_of(quality.contract_failures(rows).groupBy("column").agg(F.count(F.lit(1)).alias("n")))}
    assert {r["column"]: r["failures"] for r in rows_of(made.contract) if r["failures"]} == by_rule
    assert made.staging.count() == rows.count()
    if spoil == "clean":
        assert made.require() is made and not any(found.values())
    else:
        assert any(found.values())
        with pytest.raises(ValueError, match="staging"):
            made.require()


def test_packets_are_read_once(spark):
    reads = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def counted(value):
        reads.add(1)
        return value

    rows = packets(spark, SF_SMALL)
    checked.build_checked_marts(rows.withColumn("qname", counted("qname")))
    assert reads.value <= rows.count()
