"""A suffix list of several thousand rules as a file in the public format, and the same rules in SQL."""

from __future__ import annotations

from functools import cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dnsight.operators.suffix import SuffixTable, compile_rules, read_rules
from dnsight.sources.storage import fresh_path

#: Rules that the names of the packets meet, besides COUNT derived ones.
PLAIN = [
    "com", "org", "net", "id", "co.id", "ac.id", "go.id", "uk", "co.uk", "*.ck", "!www.ck",
    "*.example.id", "!x3.example.id", "shop7.co.id", "*.shop9.co.id",
]
COUNT = 6000
#: Rule k: an exact one, a wildcard, and an exception to that wildcard, in turn.
_DERIVED = (
    "case {k} % 3 when 0 then concat('r', {k}, '.id') when 1 then concat('*.w', {k}, '.id')"
    " else concat('!e', {k}, '.w', {k} - 1, '.id') end"
)


def suffix_rules(spark: SparkSession) -> DataFrame:
    """The list, written as a file once a session and read from it."""
    return read_rules(spark, _file(spark))


def suffix_table(spark: SparkSession) -> SuffixTable:
    return _compiled(spark)


@cache
def _file(spark: SparkSession) -> str:
    path = fresh_path(spark, "suffixes")
    heads = spark.createDataFrame([("// suffixes, one per line",), ("",), *[(r,) for r in PLAIN]], "value string")
    derived = spark.range(COUNT).select(F.expr(_DERIVED.format(k="id")).alias("value"))
    heads.unionByName(derived).write.text(path)
    return path


@cache
def _compiled(spark: SparkSession) -> SuffixTable:
    return compile_rules(suffix_rules(spark))


#: Rules (tail, extra) as a CTE: a wildcard takes one label more than its tail, an exception one less.
RULES = (
    "lines as (select unnest([" + ", ".join(f"'{r}'" for r in PLAIN) + "]) as line"
    f" union all select {_DERIVED.format(k='k')} from range({COUNT}) r(k)),"
    " rules as (select ltrim(line, '!*.') as tail,"
    " case when line like '*.%' then 1 when line like '!%' then -1 else 0 end as extra from lines)"
)


def registered(names: str) -> str:
    """CTEs that end in `registered` (name, registrable), for the column `name` of a table or query."""
    return (
        f"{RULES}, distinct_names as (select distinct name from {names} where name is not null),"
        " labelled as (select name, string_split(name, '.') as labels from distinct_names),"
        " tails as (select name, labels, k, array_to_string(labels[len(labels) - k + 1:], '.') as tail"
        " from (select *, unnest(range(1, len(labels) + 1)) as k from labelled)),"
        " suffixes as (select t.name, any_value(t.labels) as labels, coalesce(max(k - 1) filter (extra = -1),"
        " max(k + extra) filter (extra >= 0 and k + extra <= len(t.labels)), 1) as size"
        " from tails t left join rules on rules.tail = t.tail group by t.name),"
        " registered as (select name, case when name = '' then 'UNKNOWN' when len(labels) > size"
        " then array_to_string(labels[len(labels) - size:], '.') else name end as registrable from suffixes)"
    )
