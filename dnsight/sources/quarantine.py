"""Typed CSV load that sets bad records aside and says where and why.

Every file's columns are bound by the names in its own header, so files of one load may differ in the
columns they have and in their order. A record is good if it has as many fields as its header, all of its
values convert, and its event time is readable; otherwise all its faults are listed. The text is read
once: records are parsed and converted where they are read and stored, and everything else, line
numbers included, comes from that stored table.
"""

from __future__ import annotations

from collections import defaultdict
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dnsight.functions.clock import with_event_time
from dnsight.schema import PACKET_SCHEMA
from dnsight.sources.storage import stage

_KNOWN = {f.name: f for f in PACKET_SCHEMA.fields}
_OPTIONS = {"mode": "PERMISSIVE", "nullValue": "", "quote": '"', "escape": '"', "columnNameOfCorruptRecord": "_faulty"}
#: Headers that are read at a time.
_AT_ONCE = 16


@dataclass(frozen=True)
class Load:
    """The good rows, and one row per fault: file, line (from 1), column, text, reason, record."""

    good: DataFrame
    rejected: DataFrame
    #: One row: records, good, rejected (records) and faults.
    counts: DataFrame


def _files(spark: SparkSession, path: str) -> list[str]:
    """The data files under a path; their contents are not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).select("path")
    return sorted(r["path"] for r in files.collect() if not r["path"].rsplit("/", 1)[-1].startswith(("_", ".")))


def _headers(spark: SparkSession, files: list[str]) -> dict[tuple[str, ...], list[str]]:
    """Files by their column names; of each file only the first line is read. Empty files have none."""

    def header(file: str) -> tuple[str, ...]:
        lines = spark.read.text(_literal(file)).limit(1).collect()
        if not lines:
            return ()
        text = lines[0][0]
        most = _strings(text.count(",") + 1)
        fields = spark.range(1).select(F.from_csv(F.lit(text), most, {"quote": '"', "escape": '"'})).first()[0]
        return tuple(f for f in fields if f is not None)

    grouped = defaultdict(list)
    with ThreadPoolExecutor(_AT_ONCE) as pool:
        for file, names in zip(files, pool.map(header, files)):
            if names:
                grouped[names].append(file)
    return dict(grouped)


def _strings(count: int) -> str:
    return ", ".join(f"c{k} string" for k in range(count))


def _literal(file: str) -> str:
    """A file's path for a reader: characters that readers take as patterns stand for themselves."""
    return "".join(f"\\{c}" if c in "{}[]*?\\" else c for c in file)


def _fault(column: str, text: Column, reason: str) -> Column:
    return F.struct(F.lit(column).alias("column"), text.cast("string").alias("text"), F.lit(reason).alias("reason"))


def _parsed(spark: SparkSession, names: tuple[str, ...], files: list[str], need_time: bool) -> DataFrame:
    """All lines of files with one header: typed columns, `__faults`, and where each line stands."""
    if len(set(names)) < len(names):
        raise ValueError(f"a header names a column twice: {', '.join(names)}")
    lines = spark.read.text([_literal(f) for f in files]).select(
        "value", F.monotonically_increasing_id().alias("__id"),
        F.col("_metadata.file_path").alias("__file"), F.col("_metadata.file_block_start").alias("__block"),
    )
    rows = lines.withColumn("__f", F.from_csv("value", f"{_strings(len(names))}, _faulty string", _OPTIONS))
    texts = {n: F.col(f"__f.c{k}") for k, n in enumerate(names)}
    # A line that repeats the header is no record, nor is an empty one.
    header = reduce(lambda a, b: a & b, [t.eqNullSafe(F.lit(n)) for n, t in texts.items()])
    rows = rows.withColumn("__record", ~(header | (F.trim("value") == "")))
    typed = {n: t.try_cast(_KNOWN[n].dataType) if n in _KNOWN else t for n, t in texts.items()}
    rows = rows.withColumns({f"__v_{k}": c for k, c in enumerate(typed.values())})
    faults = [F.when(F.col("__f._faulty").isNotNull(), _fault("", F.col("value"), "wrong number of fields"))]
    for k, (name, text) in enumerate(texts.items()):
        kind = _KNOWN[name].dataType if name in _KNOWN else T.StringType()
        if not isinstance(kind, T.StringType):
            bad = text.isNotNull() & F.col(f"__v_{k}").isNull()
            faults.append(F.when(bad, _fault(name, text, f"not a {kind.simpleString()}")))
    out = rows.select(
        "__id", "__file", "__block", "__record", "value",
        F.array_compact(F.array(*faults)).alias("__faults"),
        *[F.col(f"__v_{k}").alias(n) for k, n in enumerate(names)],
    )
    out = with_event_time(out)
    if need_time:
        source = "ts" if "ts" in names else "ts_iso"
        late = F.when(F.col("dt").isNull() & (F.size("__faults") == 0), _fault(source, F.col(source), "no event time"))
        out = out.withColumn("__faults", F.array_compact(F.concat("__faults", F.array(late))))
    # The text of good records is in their columns.
    good = ~F.col("__record") | (F.size("__faults") == 0)
    return out.withColumn("value", F.when(~good, F.col("value")))


def load_csv(spark: SparkSession, path: str, need_time: bool = True) -> Load:
    """Load a CSV file or folder now: columns by name per file, bad records apart.

    Files without a column have nulls there. A record takes one line; a quoted line break makes two
    faulty ones. With ``need_time`` a record without a readable event time is bad, as the minute
    tables would leave it out. Lines that are empty or repeat their file's header are no records.
    """
    grouped = _headers(spark, _files(spark, path))
    if not grouped:
        raise ValueError(f"no CSV data under {path}")
    parts = [_parsed(spark, names, files, need_time) for names, files in sorted(grouped.items())]
    # One stored table per header, for each has its own columns.
    stored = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), [stage(p) for p in parts])
    faulty = F.col("__record") & (F.size("__faults") > 0)
    names = [c for c in stored.columns if not c.startswith("__") and c not in ("value", "dt")]
    good = stored.where(F.col("__record") & (F.size("__faults") == 0)).select(*names, "dt")
    # Lines of a block have successive numbers in the task that read it.
    blocks = stored.groupBy("__file", "__block").agg(F.min("__id").alias("first"), F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("__file").orderBy("__block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0)))
    line = F.col("before") + F.col("__id") - F.col("first") + 1
    rejected = (
        stored.where(faulty).select("__file", "__block", "__id", "value", F.explode("__faults").alias("fault"))
        .join(blocks, ["__file", "__block"])
        .select(F.col("__file").alias("file"), line.alias("line"), "fault.*", F.col("value").alias("record"))
    )
    counts = stored.agg(
        F.count_if("__record").alias("records"), F.count_if(F.col("__record") & (F.size("__faults") == 0)).alias("good"),
        F.count_if(faulty).alias("rejected"),
        F.coalesce(F.sum(F.when(faulty, F.size("__faults"))), F.lit(0)).alias("faults"),
    )
    return Load(good, rejected, counts)
