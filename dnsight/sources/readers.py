"""Packet table readers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dnsight.functions.clock import with_event_time
from dnsight.schema import PACKET_SCHEMA


def _csv(spark: SparkSession):
    # Only an empty field is missing; texts such as "nan" or "NULL" are names and stay.
    return spark.read.option("header", True).option("nullValue", "").option("quote", '"').option(
        "escape", '"'
    )


def header_schema(spark: SparkSession, path: str) -> T.StructType:
    """Types for the columns of a CSV header, by name; unknown columns are text.

    Spark applies a given schema by position, so the header decides the order.
    """
    known = {f.name: f for f in PACKET_SCHEMA.fields}
    columns = _csv(spark).csv(path).columns
    return T.StructType([known.get(c, T.StructField(c, T.StringType())) for c in columns])


def scan_csv(spark: SparkSession, path: str, mode: str = "FAILFAST") -> DataFrame:
    """Typed CSV scan in one pass; a record of another length or with a value of another type is refused.

    ``mode="PERMISSIVE"`` makes such values null instead; ``quarantine.load_csv`` sets such records aside.
    Every file's header has to have the same columns in the same order; others are refused.
    """
    reader = _csv(spark).option("mode", mode).option("enforceSchema", False)
    return reader.schema(header_schema(spark, path)).csv(path)


def read_csv(
    spark: SparkSession, path: str, limit: int | None = None, mode: str = "FAILFAST"
) -> DataFrame:
    """Typed CSV scan with event time ``dt``; ``limit`` reads that many rows only."""
    rows = scan_csv(spark, path, mode)
    if limit is not None:
        rows = rows.limit(limit)
    return with_event_time(rows)


def read_csv_inferred(spark: SparkSession, path: str) -> DataFrame:
    """CSV scan with inferred types; short rows are padded with nulls."""
    return _csv(spark).option("inferSchema", True).option("mode", "PERMISSIVE").csv(path)


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    rows = spark.read.parquet(path)
    return rows if "dt" in rows.columns else with_event_time(rows)


def read_packets(
    spark: SparkSession, path: str, fmt: str | None = None, limit: int | None = None
) -> DataFrame:
    """Reader by format, which is taken from the path when not given."""
    fmt = fmt or ("parquet" if path.rstrip("/").lower().endswith(".parquet") else "csv")
    if fmt == "csv":
        return read_csv(spark, path, limit)
    if fmt != "parquet":
        raise ValueError(f"unknown format {fmt!r}")
    rows = read_parquet(spark, path)
    return rows if limit is None else rows.limit(limit)


def load_statistics(df: DataFrame) -> DataFrame:
    """One row: number of rows and of columns."""
    return df.agg(
        F.count(F.lit(1)).alias("rows"), F.lit(len(df.columns)).cast("bigint").alias("columns")
    )


def stored_bytes(spark: SparkSession, path: str) -> DataFrame:
    """One row: files and bytes of the data files under a path; file contents are not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    data = files.where(~F.element_at(F.split("path", "/"), -1).rlike("^[._]"))
    return data.agg(
        F.count(F.lit(1)).alias("files"), F.coalesce(F.sum("length"), F.lit(0)).alias("bytes")
    )


#: Settings under which the file source answers counts and ranges from the footers of Parquet files.
_FOOTERS = {"spark.sql.sources.useV1SourceList": "", "spark.sql.parquet.aggregatePushdown": "true"}


def footer_statistics(spark: SparkSession, path: str, columns: tuple[str, ...] = ("ts",)) -> DataFrame:
    """One row: number of rows, least and largest value of number and date columns, from Parquet footers.

    No row group is read. It runs when called, under settings that are put back afterwards. A column
    of another type is refused, as its range would have to be read.
    """
    before = {k: spark.conf.get(k) for k in _FOOTERS}
    try:
        for key, value in _FOOTERS.items():
            spark.conf.set(key, value)
        ranges = [f(F.col(c)).alias(f"{n}_{c}") for c in columns for n, f in (("min", F.min), ("max", F.max))]
        found = spark.read.parquet(path).agg(F.count(F.lit(1)).alias("rows"), *ranges)
        plan = found._jdf.queryExecution().optimizedPlan().toString()
        if "RelationV2[count(*)" not in plan:
            raise ValueError(f"no ranges of {', '.join(columns)} in the footers")
        return spark.createDataFrame(found.collect(), found.schema)
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
