"""Mergeable distinct counts and quantiles: stored per minute once, merged over any minutes later.

The exact operators stay the default. A distinct count of sketches is off by about 1.04 / sqrt(2 ** LG_NODES),
1.6 %, as its standard error; a quantile's rank by about 1.3 % with K of 200. Groups that are smaller than
a sketch are exact. Merging reads the sketches only, never the packets.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dnsight.functions import clock, names
from dnsight.functions.measures import count_rows

#: Registers of a distinct count as a power of two, and size of a quantile sketch.
LG_NODES, K = 12, 200
#: Columns whose quantiles are kept.
MEASURES = ["frame_len", "dns_len"]


def minute_sketches(packets: DataFrame, measures: list[str] = MEASURES) -> DataFrame:
    """Per minute and direction: n, sketches of the distinct names, sources and hosts, and of the measures."""
    rows = packets.withColumn("minute", clock.minute_floor("dt"))
    distinct = {"name": names.normalised("qname"), "src_ip": F.col("src_ip"), "dst_ip": F.col("dst_ip")}
    return rows.groupBy("minute", "qr").agg(
        count_rows().alias("n"),
        *[F.hll_sketch_agg(c, LG_NODES).alias(f"{n}_distinct") for n, c in distinct.items()],
        *[F.kll_sketch_agg_double(F.col(m).cast("double"), K).alias(f"{m}_values") for m in measures],
    )


def merged(sketches: DataFrame, *keys: str | Column) -> DataFrame:
    """The sketches of each group, merged; without keys those of all rows. It can be merged again."""
    kinds = [c for c in sketches.columns if c.endswith(("_distinct", "_values"))]
    return sketches.groupBy(*keys).agg(
        F.sum("n").alias("n"),
        *[(F.hll_union_agg(c) if c.endswith("_distinct") else F.kll_merge_agg_double(c)).alias(c) for c in kinds],
    )


def estimates(sketches: DataFrame, points: tuple[float, ...] = (0.25, 0.5, 0.75, 0.99)) -> DataFrame:
    """The sketches read out: a number for each distinct count, an array at `points` for each measure."""
    return sketches.select(*[
        F.hll_sketch_estimate(c).alias(c) if c.endswith("_distinct")
        else F.kll_sketch_get_quantile_double(c, F.array(*map(F.lit, points))).alias(c) if c.endswith("_values") else F.col(c)
        for c in sketches.columns
    ])
