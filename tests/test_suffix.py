"""Suffix lookups against brute force, by a small list and by a complete public one."""

import glob
import os
import random
import zipfile

import pyspark
import pytest

from dnsight.operators import suffix
from tests.helpers import rows_of

SMALL = [
    "com", "co.uk", "uk", "*.ck", "!www.ck", "*.b.jp", "b.jp", "!x.b.jp", "jp", "a.b.c.d.e", "*.only", "only",
]


def brute_force(name, rules):
    """Registrable domain by the text of the public list's algorithm."""
    if not name:
        return "UNKNOWN"
    labels, best, exception = name.split("."), 1, None
    for k in range(1, len(labels) + 1):
        tail = ".".join(labels[-k:])
        if "!" + tail in rules:
            exception = k - 1
        if tail in rules:
            best = max(best, k)
        if "*." + tail in rules and k + 1 <= len(labels):
            best = max(best, k + 1)
    size = best if exception is None else exception
    return ".".join(labels[-size - 1:]) if len(labels) > size else name


def listed(spark, folder, lines):
    path = os.path.join(folder, "list.dat")
    with open(path, "w", encoding="utf-8") as file:
        file.write("// a comment\n\n" + "\n".join(lines) + "\n")
    return suffix.read_rules(spark, path)


def checked(spark, names, rules, lines):
    frame = spark.createDataFrame([(n, k) for k, n in enumerate(names)], "name string, payload long")
    found = rows_of(suffix.with_registrable(frame, rules))
    assert sorted(r["payload"] for r in found) == list(range(len(names)))
    lines = set(lines)
    for r in found:
        assert r["registrable"] == brute_force(r["name"], lines), r


def made_names(lines, count):
    random.seed(17)
    names = ["", None, "a", "a..b", ".", "com", "www.ck", "x.www.ck", "ck", "q.ck", "y.x.b.jp", "y.z.b.jp", "z.only", "x" * 300]
    for _ in range(count):
        rule = random.choice(lines).lstrip("!").replace("*.", random.choice(["", "n.", "x."]))
        names.append(random.choice(["", "a.", "a.b.", "www.", "x.y.z."]) + rule)
    return names


def test_lookups_and_join_equal_brute_force(spark, folder):
    rules, names = listed(spark, folder, SMALL), made_names(SMALL, 200)
    table = suffix.compile_rules(rules)
    assert table.buckets is not None and table.longest == 5
    checked(spark, names, table, SMALL)
    checked(spark, names, rules, SMALL)
    # Rules beyond a bound are joined; distinct names are what the join takes.
    joined = suffix.compile_rules(rules, most_bytes=10)
    assert joined.buckets is None
    checked(spark, sorted({n for n in names if n}), joined, SMALL)


def test_no_rules(spark, folder):
    checked(spark, ["a.b.c", "a", "", None], listed(spark, folder, []), [])


def test_lookups_neither_shuffle_nor_add_rows(spark, folder):
    table = suffix.compile_rules(listed(spark, folder, SMALL))
    names = spark.createDataFrame([("a.co.uk",)], "name string")
    plan = suffix.with_registrable(names, table)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Generate" not in plan and "Join" not in plan


def test_a_complete_public_list(spark, folder):
    """The list that comes with one of Spark's own libraries."""
    for jar in sorted(glob.glob(os.path.join(os.path.dirname(pyspark.__file__), "jars", "httpclient-4*.jar"))):
        text = zipfile.ZipFile(jar).read("mozilla/public-suffix-list.txt").decode()
        break
    else:
        pytest.skip("this Spark comes without the list")
    lines = [x for x in (line.split()[0] for line in text.splitlines() if line.strip()) if not x.startswith("//")]
    table = suffix.compile_rules(listed(spark, folder, lines))
    assert table.buckets is not None and len(lines) > 5000
    checked(spark, made_names(lines, 3000), table, lines)
