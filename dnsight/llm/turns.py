"""Turns of conversations in order, numbered, with running totals.

A conversation may hold a large share of all rows, so none of this needs one in a single task: rows are
numbered and summed up in blocks of up to BLOCK turn numbers, and the blocks' totals are carried on.

Defined cases: a null turn comes first; turns of one number are ordered by role, then text; null role
or text is empty; rows without an id are a conversation of their own; repeated rows are turns each.
Rows of one conversation that share one turn number, or have none, are one block.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BLOCK = 1024


def running(
    rows: DataFrame, block: Column, order: list[Column], totals: dict[str, tuple[Callable, Column]],
    joined: Callable[[Column, Column], Column] = lambda a, b: a + b,
) -> DataFrame:
    """The rows with, per name of `totals`, its aggregate over all earlier rows of the conversation.

    `block` must not fall in the order of the rows; `joined` puts two aggregates together, 0 is that of no row.
    """
    rows = rows.withColumn("__block", block)
    inside = Window.partitionBy("conv_id", "__block").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    before = Window.partitionBy("conv_id").orderBy("__block").rowsBetween(Window.unboundedPreceding, -1)
    none = F.lit(0).cast("long")
    within = rows.select("*", *[F.coalesce(f(c).over(inside), none).alias(f"__in_{n}") for n, (f, c) in totals.items()])
    blocks = rows.groupBy("conv_id", "__block").agg(*[f(c).alias(n) for n, (f, c) in totals.items()])
    carried = blocks.select(
        F.col("conv_id").alias("__conv"), F.col("__block").alias("__at"),
        *[F.coalesce(f(F.col(n)).over(before), none).alias(f"__to_{n}") for n, (f, _) in totals.items()],
    )
    both = within.join(carried, F.col("conv_id").eqNullSafe(F.col("__conv")) & (F.col("__block") == F.col("__at")))
    kept = [c for c in rows.columns if c != "__block"]
    return both.select(*kept, *[joined(F.col(f"__to_{n}"), F.col(f"__in_{n}")).alias(n) for n in totals])


def in_order(conversations: DataFrame, totals: dict[str, tuple[Callable, Column]] | None = None) -> DataFrame:
    """conv_id, role, text, place (from 0) and running `totals` of every turn."""
    rows = conversations.select(
        "conv_id", "turn", *[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("role", "text")]
    )
    # Turns without a number are before all blocks of numbers.
    block = F.coalesce(F.expr(f"cast(turn as long) div {BLOCK}"), F.lit(-(2**62)))
    order = [F.col("turn").asc_nulls_first(), F.col("role"), F.col("text")]
    counted = {"place": (F.sum, F.lit(1).cast("long"))} | (totals or {})
    return running(rows, block, order, counted).drop("turn")
