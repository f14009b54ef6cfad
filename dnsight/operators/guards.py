"""Preconditions that stop a query: they are part of its plan and are checked before its rows are made."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dnsight.functions.measures import count_where
from dnsight.operators import spikes
from dnsight.operators.shared import one_row, one_value


def require(df: DataFrame, guard: DataFrame, checks: dict[str, Column]) -> DataFrame:
    """The rows of ``df``; its query fails with the message of the first check that ``guard`` does not pass.

    ``guard`` has one row, and a check is a condition on that; null does not pass. The row is a scalar
    subquery of a filter, which Spark evaluates before the filtered rows, and, because a plan that
    turns out to have no rows at run time loses its filters, also a branch of its own that adds no row.
    """
    verdict = F.lit(True)
    for message, holds in reversed(checks.items()):
        verdict = F.when(F.coalesce(holds, F.lit(False)), verdict).otherwise(F.raise_error(F.lit(message)).cast("boolean"))
    passed = guard.select(verdict.alias("passed"))
    nothing = passed.where("not passed").select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in df.schema])
    return df.where(one_value(passed, "passed")).unionByName(nothing)


def spike_guard(counts: DataFrame, window: DataFrame, dimension: str = "host") -> DataFrame:
    """One row about a decomposition: its window, NXDOMAIN responses without a group, and its reconciliation.

    Everything comes from the counts of ``spikes.nx_counts`` and the window, not from the packets.
    """
    none = (F.col("dimension") == dimension) & F.col("key").isNull()
    found = counts.agg(
        F.coalesce(F.sum(F.when(none, F.col("peak_count") + F.col("other_count"))), F.lit(0)).alias("without_group")
    )
    w = one_row(window.select("n_minutes", "first_minute", "last_minute", "peak_minute"))
    sums = one_row(spikes.spike_reconciliation(counts, window, dimension))
    return found.select(
        w["n_minutes"].alias("n_minutes"),
        w["peak_minute"].between(w["first_minute"], w["last_minute"]).alias("peak_inside"),
        "without_group", sums["sum_delta"].alias("sum_delta"), sums["net_delta"].alias("net_delta"),
        sums["reconciled"].alias("reconciled"),
    )


def strict_spike_delta(counts: DataFrame, window: DataFrame, dimension: str = "host") -> DataFrame:
    """As ``spikes.spike_delta``, but the query fails where the decomposition would not be exact.

    That is: fewer than two steady minutes, a peak outside of them, a response without a group, or
    deltas that do not add up to the net increase.
    """
    return require(spikes.spike_delta(counts, window, dimension), spike_guard(counts, window, dimension), {
        "the window needs two minutes or more": F.col("n_minutes") >= 2,
        "the peak is not a minute of the window": F.col("peak_inside"),
        f"NXDOMAIN responses without a {dimension}": F.col("without_group") == 0,
        "the deltas do not add up to the net increase": F.col("reconciled"),
    })


def strict_profile(profile: DataFrame, reconciliation: DataFrame) -> DataFrame:
    """The source profile; the query fails where it does not account for all queries and responses."""
    return require(profile, reconciliation, {"the source profile does not reconcile": F.col("reconciled")})


def strict_labels(labels: DataFrame) -> DataFrame:
    """The label map; the query fails if a label is used twice or is not S and a number."""
    found = labels.agg(
        (F.count(F.lit(1)) - F.count_distinct("label")).alias("twice"),
        count_where(~F.coalesce(F.col("label").rlike(r"\AS[1-9][0-9]*\z"), F.lit(False))).alias("malformed"),
    )
    return require(labels, found, {"a label is used twice": F.col("twice") == 0, "a label is malformed": F.col("malformed") == 0})
