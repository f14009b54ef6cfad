"""Building blocks that several operators use."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dnsight.sources.storage import stage


def one_row(df: DataFrame) -> Column:
    """A one-row frame as a struct value.

    It becomes a scalar subquery: Spark runs it once, checks that it has at most one row, and puts
    the value into the plan. No cross join and no collect is needed for totals and thresholds.
    """
    return df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns])).scalar()


def one_value(df: DataFrame, column: str) -> Column:
    """One column of a one-row frame; in this form a comparison is also pushed into Parquet scans."""
    return df.select(column).scalar()


def top_counts(
    df: DataFrame, key: str, limit: int, name: str = "count", keep_null: bool = False
) -> DataFrame:
    """The ``limit`` most frequent keys, ties in key order."""
    rows = df if keep_null else df.where(F.col(key).isNotNull())
    counts = rows.groupBy(key).agg(F.count(F.lit(1)).alias(name))
    return counts.orderBy(F.desc(name), F.asc(key)).limit(limit)


def with_rank(df: DataFrame, *order: Column, name: str = "rank") -> DataFrame:
    """Number the rows of an already limited frame."""
    return df.withColumn(name, F.row_number().over(Window.orderBy(*order)))


#: Bits of a member filter (8 MB): it lets a share of members / FILTER_BITS of the other rows through.
FILTER_BITS = 1 << 26


def may_be_member(df: DataFrame, column: str, members: DataFrame) -> DataFrame:
    """The rows whose 64-bit hash in ``column`` may be one of the members' (same column); no member is lost.

    The filter is a bitmap of fixed size that an aggregate builds, so it can be sent to all tasks
    however many members there are, and a join with them moves little more than their rows.
    """

    def place(hashed: DataFrame) -> Column:
        return F.pmod(hashed[column], F.lit(FILTER_BITS)) + 1

    bits = members.groupBy(F.bitmap_bucket_number(place(members)).alias("__bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(place(members))).alias("__bits")
    )
    marked = df.withColumns({
        "__bucket": F.bitmap_bucket_number(place(df)), "__bit": F.bitmap_bit_position(place(df)).cast("int"),
    })
    # One row of 4 KB for each of FILTER_BITS / 32768 buckets at most.
    joined = marked.join(F.broadcast(bits), "__bucket")
    byte = F.conv(F.hex(F.substring("__bits", F.expr("__bit div 8 + 1").cast("int"), F.lit(1))), 16, 10).cast("int")
    return joined.where(byte.bitwiseAND(F.expr("shiftleft(1, cast(__bit % 8 as int))")) > 0).select(*df.columns)


def running_totals(
    df: DataFrame,
    tiers: Sequence[tuple[str, str]],
    totals: Sequence[str],
    within: Sequence[str] = (),
) -> DataFrame:
    """Add ``before_<total>``: the sum over all rows that come earlier in the order of ``tiers``.

    ``tiers`` is a list of (column, "asc" | "desc") from coarse to fine; together with ``within``
    they identify a row. A plain window over the whole order would sort everything in one task.
    Here each tier is summed up, the running sum is formed inside one parent group only, and the
    offset of the parent is added, so a window never holds more than the children of one group.
    """
    columns = [c for c, _ in tiers]
    df = df.withColumns({f"total_{t}": F.col(t) for t in totals})
    bases = None
    for depth, (column, direction) in enumerate(tiers):
        parents = [*within, *columns[:depth]]
        keys = [*parents, column]
        last = depth == len(tiers) - 1
        if last:
            level = df
        else:
            level = df.groupBy(*keys).agg(
                *[F.sum(f"total_{t}").alias(f"total_{t}") for t in totals]
            )
        order = F.asc(column) if direction == "asc" else F.desc(column)
        window = Window.partitionBy(*parents) if parents else Window.partitionBy()
        window = window.orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
        local = [
            F.coalesce(F.sum(f"total_{t}").over(window), F.lit(0)).alias(f"before_{t}")
            for t in totals
        ]
        columns_left = [c for c in df.columns if c not in {f"total_{t}" for t in totals}]
        kept = [F.col(c) for c in (columns_left if last else keys)]
        level = level.select(*kept, *local)
        if bases is not None:
            level = level.join(bases, parents, "inner")
            level = level.select(
                *kept,
                *[
                    (F.col(f"before_{t}") + F.col(f"base_{t}")).alias(f"before_{t}")
                    for t in totals
                ],
            )
        if last:
            return level
        bases = level.select(*keys, *[F.col(f"before_{t}").alias(f"base_{t}") for t in totals])
    raise ValueError("tiers must not be empty")


def ranked_running_total(
    df: DataFrame, value: str, *order: Column, partitions: int | None = None
) -> DataFrame:
    """Add ``position`` (from 1) and ``before``, the sum of ``value`` over all earlier rows.

    For any total order, also of free text. The rows are range-partitioned by the order, which
    splits a hot value by the later keys, and staged, so that their places are fixed. Only one sum
    per range is then carried over from range to range.
    """
    spark = df.sparkSession
    ranges = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    placed = df.repartitionByRange(ranges, *order).sortWithinPartitions(*order)
    placed = stage(
        placed.withColumns(
            {"part": F.spark_partition_id(), "place": F.monotonically_increasing_id()}
        )
    )
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    sums = placed.groupBy("part").agg(F.count(F.lit(1)).alias("n"), F.sum(value).alias("s"))
    bases = sums.select(
        "part",
        F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("base_n"),
        F.coalesce(F.sum("s").over(earlier), F.lit(0)).alias("base_s"),
    )
    inside = Window.partitionBy("part").orderBy("place")
    before = F.sum(value).over(inside.rowsBetween(Window.unboundedPreceding, -1))
    # One row per range: its number is the parameter above.
    return placed.join(F.broadcast(bases), "part").select(
        *df.columns,
        (F.col("base_n") + F.row_number().over(inside)).alias("position"),
        (F.col("base_s") + F.coalesce(before, F.lit(0))).alias("before"),
    )


def collapse_tail(
    counts: DataFrame, key: str, keep: int, value: str = "count", other: str = "other"
) -> DataFrame:
    """The ``keep`` largest groups, and one row for the sum of all the rest.

    The rest is the total minus the kept groups, so no window has to rank every group.
    """
    top = counts.orderBy(F.desc(value), F.asc(key)).limit(keep)
    top = with_rank(top, F.desc(value), F.asc(key))
    total = one_value(counts.agg(F.sum(value).alias("t")), "t")
    rest = top.agg(F.sum(value).alias("kept")).select(
        F.lit(other).alias(key),
        (F.coalesce(total, F.lit(0)) - F.coalesce(F.col("kept"), F.lit(0))).alias(value),
        F.lit(keep + 1).alias("rank"),
    )
    named = top.select(F.col(key).cast("string").alias(key), value, "rank")
    return named.unionByName(rest)
