"""Registrable domain of a name by public suffix rules, as lookups in a hash table or as a join."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dnsight.sources.storage import stage

UNKNOWN = "UNKNOWN"
#: Bounds of a rule table that goes to all tasks: rules, their bytes, and labels of a rule.
MOST_RULES, MOST_BYTES, MOST_LABELS = 100_000, 4 << 20, 8
#: Kinds of a tail, as bits.
EXACT, WILDCARD, EXCEPTION = 1, 2, 4
#: More than any number of labels.
OVER = 1000

# A small default rule table. Pass a full list as a DataFrame (rule, kind) instead.
DEFAULT_RULES = [
    ("com", "exact"),
    ("org", "exact"),
    ("net", "exact"),
    ("id", "exact"),
    ("co.id", "exact"),
    ("ac.id", "exact"),
    ("go.id", "exact"),
    ("or.id", "exact"),
    ("web.id", "exact"),
    ("uk", "exact"),
    ("co.uk", "exact"),
    ("jp", "exact"),
    ("*.ck", "wildcard"),
    ("www.ck", "exception"),
]


def default_rules(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(DEFAULT_RULES, "rule string, kind string")


def read_rules(spark: SparkSession, path: str) -> DataFrame:
    """Rules from a text file in the public suffix list format, one rule per line."""
    lines = spark.read.text(path).select(F.trim(F.split("value", r"\s")[0]).alias("line"))
    rules = lines.where((F.col("line") != "") & ~F.col("line").startswith("//"))
    return rules.select(
        F.regexp_replace("line", "^!", "").alias("rule"),
        F.when(F.col("line").startswith("!"), "exception")
        .when(F.col("line").startswith("*."), "wildcard")
        .otherwise("exact")
        .alias("kind"),
    )


def _matching(rules: DataFrame) -> DataFrame:
    """tail, extra: a wildcard takes one label more than its tail, an exception one less."""
    kind = F.col("kind")
    return rules.select(
        F.when(kind == "wildcard", F.regexp_replace("rule", r"^\*\.", "")).otherwise(F.col("rule")).alias("tail"),
        F.when(kind == "wildcard", 1).when(kind == "exception", -1).otherwise(0).alias("extra"),
    )


@dataclass(frozen=True)
class SuffixTable:
    """Suffix rules as a hash table in one row: `buckets[h]` maps the tails of hash h to their kinds.

    ``buckets`` is None where the rules are too many or too long for that; then names are joined with ``rules``.
    """

    rules: DataFrame
    longest: int = 0
    size: int = 0
    buckets: DataFrame | None = None


def compile_rules(rules: DataFrame, most_rules: int = MOST_RULES, most_bytes: int = MOST_BYTES) -> SuffixTable:
    """Check the size of the rules and lay them out as a hash table, if they are within the bounds.

    A tail may be an exact rule, the base of a wildcard and an exception at once, so its kinds are
    bits. The table has at least as many buckets as tails; a bucket is a map of the few tails in it.
    """
    tails = _matching(rules).groupBy("tail").agg(
        F.bit_or(F.when(F.col("extra") == 0, EXACT).when(F.col("extra") == 1, WILDCARD).otherwise(EXCEPTION)).alias("kinds")
    )
    found = tails.agg(
        F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(F.octet_length("tail")), F.lit(0)).alias("bytes"),
        F.coalesce(F.max(F.size(F.split("tail", r"\."))), F.lit(0)).alias("longest"),
    ).first()
    if found["n"] > most_rules or found["bytes"] > most_bytes or found["longest"] > MOST_LABELS:
        return SuffixTable(rules)
    size = 1 << max(found["n"], 1).bit_length()
    bucket = F.pmod(F.xxhash64("tail"), F.lit(size)).alias("bucket")
    entries = tails.groupBy(bucket).agg(F.collect_list(F.struct("tail", "kinds")).alias("entries"))
    every = rules.sparkSession.range(size).withColumnRenamed("id", "bucket").join(entries, "bucket", "left")
    in_order = F.array_sort(F.collect_list(F.struct("bucket", "entries")))
    buckets = stage(every.agg(F.transform(in_order, lambda b: F.map_from_entries(b["entries"])).alias("buckets")))
    return SuffixTable(rules, found["longest"], size, buckets)


def _suffix_size(names: DataFrame, name: str, table: SuffixTable) -> DataFrame:
    """Add `__size`: labels of each name's suffix, by a lookup for each of its right-hand tails."""
    buckets, labels = table.buckets.select("buckets").scalar(), F.col("__labels")

    def kinds(k: int) -> Column:
        tail = F.when(labels >= k, F.substring_index(name, ".", -k))
        bucket = F.get(buckets, F.pmod(F.xxhash64(tail), F.lit(table.size)).cast("int"))
        return F.coalesce(F.try_element_at(bucket, tail), F.lit(0))

    def size(k: int) -> Column:
        has = lambda kind: F.col(f"__{k}").bitwiseAND(F.lit(kind)) > 0
        # An exception beats all; of rules, the longest wins.
        return F.when(has(EXCEPTION), k - 1 + OVER).when(has(WILDCARD) & (labels > k), k + 1).when(has(EXACT), k)

    steps = range(1, table.longest + 1)
    best = F.greatest(F.lit(0), F.lit(0), *[size(k) for k in steps])
    return names.withColumns({f"__{k}": kinds(k) for k in steps}).withColumn(
        "__size", F.when(best >= OVER, best - OVER).when(best > 0, best).otherwise(1)
    )


def _registrable(name: str, labels: Column, size: str) -> Column:
    """The suffix and one label more, by the columns of the name and of the suffix's number of labels."""
    text = F.col(name)
    return (
        F.when(text.isNull() | (text == ""), UNKNOWN)
        .when(labels > F.col(size), F.expr(f"substring_index(`{name}`, '.', -(`{size}` + 1))"))
        .otherwise(text)
    )


def with_registrable(names: DataFrame, rules: DataFrame | SuffixTable, name: str = "name") -> DataFrame:
    """Add ``registrable`` to a frame of names with any payload columns; the rows stay where they are.

    The longest rule that matches a right-hand tail of the name wins; an exception beats all, and the
    default rule is the last label. A name that is itself a suffix stays as it is; an empty or missing
    name gives ``UNKNOWN``. Rules within the bounds of ``compile_rules`` are a value of the plan, which
    each name looks its tails up in: no row is added and none is shuffled. Larger rule tables are joined.
    """
    table = rules if isinstance(rules, SuffixTable) else compile_rules(rules)
    if table.buckets is None:
        return _joined_registrable(names, table.rules, name)
    labels = F.size(F.split(F.col(name), r"\."))
    sized = _suffix_size(names.withColumn("__labels", labels), name, table)
    return sized.withColumn("registrable", _registrable(name, F.col("__labels"), "__size")).select(*names.columns, "registrable")


def _joined_registrable(names: DataFrame, rules: DataFrame, name: str) -> DataFrame:
    """As ``with_registrable``, for distinct names and rules of any size.

    Every name is expanded to as many right-hand tails as the longest rule has labels, and the tails
    are joined to the rules.
    """
    matching = _matching(rules)
    longest = matching.agg(F.max(F.size(F.split("tail", r"\."))).alias("n")).select("n").scalar()
    payload = [c for c in names.columns if c != name]
    labels = F.size(F.split(F.col(name), r"\."))
    tails = names.withColumn("__labels", labels).withColumn(
        "k", F.explode_outer(F.sequence(F.lit(1), F.least(F.col("__labels"), longest)))
    )
    tails = tails.withColumn(
        "tail", F.when(F.col("k") == F.col("__labels"), F.col(name)).otherwise(
            F.expr(f"substring_index(`{name}`, '.', -k)")
        )
    )
    hits = tails.join(matching, "tail", "left")
    suffix = F.col("k") + F.col("extra")
    best = hits.groupBy(name, "__labels", *payload).agg(
        F.max(F.when(F.col("extra") == -1, suffix)).alias("exception"),
        F.max(F.when((F.col("extra") >= 0) & (suffix <= F.col("__labels")), suffix)).alias("rule"),
    )
    sized = best.withColumn("__size", F.coalesce("exception", "rule", F.lit(1)))
    return sized.select(name, *payload, _registrable(name, F.col("__labels"), "__size").alias("registrable"))
