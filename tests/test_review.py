"""Cases on which earlier versions gave wrong results."""

import os

import pytest

from dnsight.operators import lexical, priority
from dnsight.sources import readers, writers
from tests.helpers import rows_of


def _folder(folder, *texts):
    path = os.path.join(folder, "raw")
    os.makedirs(path)
    for k, text in enumerate(texts):
        with open(os.path.join(path, f"{k}.csv"), "w") as file:
            file.write(text)
    return path


def test_files_with_other_column_order_are_refused(spark, folder):
    path = _folder(folder, "qr,rcode\n1,3\n", "rcode,qr\n3,1\n")
    with pytest.raises(Exception):
        readers.scan_csv(spark, path).collect()


def test_bad_values_stop_a_conversion(spark, folder):
    path = _folder(folder, "qr,rcode\n1,3\nxyz,3\n")
    with pytest.raises(Exception):
        writers.csv_to_parquet(spark, path, os.path.join(folder, "out.parquet"))


def test_std_of_large_close_values(spark):
    values = spark.createDataFrame([(1e8 + k,) for k in range(3)], "length double")
    row = rows_of(lexical.describe(lexical.value_distribution(values, ["length"])))[0]
    assert row["std"] == pytest.approx(1.0)


def test_malformed_labels_do_not_stop_numbering(spark):
    labels = spark.createDataFrame([("a", "S2x"), ("b", "S99999999999")], "prefix string, label string")
    prefixes = spark.createDataFrame([("a",), ("c",)], "prefix string")
    found = {r["prefix"]: r["label"] for r in rows_of(priority.extend_labels(labels, prefixes))}
    assert found == {"a": "S2x", "b": "S99999999999", "c": "S100000000000"}
