"""Table and report writers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dnsight.functions.clock import iso_text
from dnsight.functions.measures import percent
from dnsight.operators.shared import one_row
from dnsight.sources.readers import read_csv_inferred, scan_csv, stored_bytes


def write_parquet(
    df: DataFrame,
    path: str,
    compression: str = "zstd",
    mode: str = "error",
    partition_by: Sequence[str] = (),
) -> None:
    """Parquet copy; ``mode="ignore"`` keeps an existing one."""
    writer = df.write.mode(mode).option("compression", compression)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def csv_to_parquet(
    spark: SparkSession,
    csv_path: str,
    parquet_path: str,
    compression: str = "zstd",
    mode: str = "error",
    partition_by: Sequence[str] = (),
    infer: bool = False,
) -> DataFrame:
    """Convert a CSV file or folder and return the size report.

    The packet columns have known types, so the text is read once, and a value of another type stops
    the conversion. ``infer`` finds the types of foreign tables, at the price of a second pass.
    """
    rows = read_csv_inferred(spark, csv_path) if infer else scan_csv(spark, csv_path)
    write_parquet(rows, parquet_path, compression, mode, partition_by)
    return size_report(spark, csv_path, parquet_path)


def size_report(spark: SparkSession, raw_path: str, parquet_path: str) -> DataFrame:
    """One row: stored size of both copies in MiB and the saving in percent."""
    raw, packed = one_row(stored_bytes(spark, raw_path)), stored_bytes(spark, parquet_path)
    mib = F.lit(1048576.0)
    return packed.select(
        (raw["bytes"] / mib).alias("raw_size_mb"),
        (F.col("bytes") / mib).alias("parquet_size_mb"),
        (F.lit(100.0) - percent(F.col("bytes"), raw["bytes"])).alias("compression_ratio_pct"),
        F.lit(parquet_path).alias("output_path"),
    )


def _safe(value: Column, kind: T.DataType) -> Column:
    if isinstance(kind, (T.DoubleType, T.FloatType)):
        finite = ~F.isnan(value) & (F.abs(value) != F.lit(float("inf")))
        return F.when(finite, value)
    if isinstance(kind, (T.TimestampNTZType, T.TimestampType)):
        return iso_text(value)
    if isinstance(kind, T.StructType):
        fields = [_safe(value[f.name], f.dataType).alias(f.name) for f in kind.fields]
        return F.when(value.isNotNull(), F.struct(*fields))
    if isinstance(kind, T.ArrayType):
        return F.transform(value, lambda v: _safe(v, kind.elementType))
    return value


def json_safe(df: DataFrame) -> DataFrame:
    """NaN and infinity become null, times become ISO text, at every depth."""
    return df.select(
        *[_safe(F.col(f"`{f.name}`"), f.dataType).alias(f.name) for f in df.schema.fields]
    )


def write_json(df: DataFrame, path: str, mode: str = "error") -> None:
    """JSON lines, one file per partition (so one for a one-row report); null fields are written."""
    json_safe(df).write.mode(mode).option("ignoreNullFields", False).json(path)


def write_bucketed(df: DataFrame, name: str, key: str, buckets: int, path: str, mode: str = "overwrite") -> DataFrame:
    """A table bucketed and sorted by ``key`` at ``path``, and the way to read it.

    Grouping by the key, windows over it and joins of equally bucketed tables on it need no shuffle.
    Rows are dealt by the key first, so a bucket is one file and not one for every task.
    """
    dealt = df.repartition(buckets, key)
    dealt.write.mode(mode).option("path", path).bucketBy(buckets, key).sortBy(key).saveAsTable(name)
    return df.sparkSession.table(name)


def publish(df: DataFrame, name: str, as_table: bool = False, mode: str = "overwrite") -> None:
    """Materialise as a temporary view, or as a table."""
    if as_table:
        df.write.mode(mode).saveAsTable(name)
    else:
        df.createOrReplaceTempView(name)
