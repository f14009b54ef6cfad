"""Contracts, column tests and reconciliations. A check returns its failing rows or its counts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dnsight.functions import clock
from dnsight.functions import predicates as P
from dnsight.functions.measures import count_rows, count_where
from dnsight.operators.shared import may_be_member, one_row, one_value
from dnsight.schema import REQUIRED_COLUMNS, TRANSACTION_KEY
from dnsight.sources.storage import stage

# The packet contract as (column, type, check, lower or allowed, upper, nullable).
CONTRACT = [
    ("qr", "int", "isin", [0, 1], None, False),
    ("proto", "string", "isin", ["udp", "tcp"], None, False),
    ("rcode", "int", "in_range", 0, 23, True),
    ("qdcount", "int", "in_range", 0, 20, False),
    ("frame_len", "int", "greater_than", 0, None, False),
    ("dns_len", "int", "greater_than_or_equal_to", 0, None, False),
    ("tc", "int", "isin", [0, 1], None, False),
]


def _passes(value: Column, check: str, low, high) -> Column:
    if check == "isin":
        return value.isin(low)
    if check == "in_range":
        return value.between(low, high)
    if check == "greater_than":
        return value > low
    return value >= low


def _broken_rules(contract: Sequence[tuple]) -> Column:
    """Array with one entry per broken rule of a row."""
    failures = []
    for column, kind, check, low, high, nullable in contract:
        raw = F.col(column)
        value = raw.try_cast(kind)
        bad = ~F.coalesce(_passes(value, check, low, high), F.lit(False))
        if nullable:
            bad = bad & raw.isNotNull()
        failures.append(
            F.when(
                bad,
                F.struct(
                    F.lit(column).alias("column"),
                    F.lit(check).alias("check"),
                    raw.cast("string").alias("failure_case"),
                ),
            )
        )
    return F.array_compact(F.array(*failures))


def contract_failures(
    packets: DataFrame, row_key: str | None = None, contract: Sequence[tuple] = tuple(CONTRACT)
) -> DataFrame:
    """One row per broken rule: column, check, failure case and the key of the row.

    All rules are tested in one pass. Values are converted first; a value that cannot be converted
    and a missing value fail, unless the rule allows null.
    """
    keyed = [F.col(row_key)] if row_key else []
    broken = packets.select(*keyed, _broken_rules(contract).alias("f"))
    return broken.where(F.size("f") > 0).select(*keyed, F.inline("f"))


def contract_summary(
    packets: DataFrame,
    sample_size: int | None = None,
    contract: Sequence[tuple] = tuple(CONTRACT),
) -> DataFrame:
    """One row: status, validated rows, failures. The whole table unless a sample size is given."""
    rows = packets if sample_size is None else packets.limit(sample_size)
    counts = rows.select(F.size(_broken_rules(contract)).alias("n")).agg(
        count_rows().alias("validated_rows"),
        F.coalesce(F.sum("n"), F.lit(0)).alias("n_failures"),
    )
    status = F.when(F.col("n_failures") == 0, "PASSED").otherwise("FAILED")
    return counts.select(status.alias("status"), "validated_rows", "n_failures")


def missing_columns(df: DataFrame, required: Sequence[str] = tuple(REQUIRED_COLUMNS)) -> DataFrame:
    """Names of required columns that the table does not have."""
    missing = sorted(set(required) - set(df.columns))
    return df.sparkSession.createDataFrame([(c,) for c in missing], "column string")


def fail_fast_checks(packets: DataFrame, time_text: str | None = "ts_iso") -> DataFrame:
    """Counts of everything that must not occur before an analysis, one row per check."""
    r = P.is_response()

    def outside(column: str, allowed: list) -> Column:
        return count_where(~F.coalesce(F.col(column).isin(allowed), F.lit(False)))

    checks = {
        "empty table": F.when(count_rows() == 0, 1).otherwise(0).cast("bigint"),
        "qr outside 0, 1": outside("qr", [0, 1]),
        "tc outside 0, 1": outside("tc", [0, 1]),
        "proto outside udp, tcp": outside("proto", ["udp", "tcp"]),
        "response without rcode": count_where(r & F.col("rcode").isNull()),
        "query without src_ip": count_where(P.is_query() & F.col("src_ip").isNull()),
        "response without dst_ip": count_where(r & F.col("dst_ip").isNull()),
    }
    if time_text is not None:
        checks["unreadable time"] = count_where(clock.from_iso(time_text).isNull())
    totals = packets.agg(*[c.alias(f"c{i}") for i, c in enumerate(checks.values())])
    rows = [
        F.struct(F.lit(name).alias("check"), F.col(f"c{i}").alias("failures"))
        for i, name in enumerate(checks)
    ]
    return totals.select(F.inline(F.array(*rows)))


def require_clean(checks: DataFrame) -> None:
    """Run the checks now and raise on the first finding; a handful of rows reach the driver."""
    failed = checks.where(F.col("failures") > 0).collect()
    if failed:
        raise ValueError("; ".join(f"{r['check']}: {r['failures']}" for r in failed))


# --- column tests --------------------------------------------------------------------------------


def not_null(df: DataFrame, column: str, where: Column | None = None) -> DataFrame:
    """Rows without a value."""
    rows = df if where is None else df.where(where)
    return rows.where(F.col(column).isNull())


def unique(df: DataFrame, column: str) -> DataFrame:
    """Values that occur more than once."""
    counts = df.where(F.col(column).isNotNull()).groupBy(column).agg(count_rows().alias("n"))
    return counts.where(F.col("n") > 1)


def accepted_values(df: DataFrame, column: str, values: list) -> DataFrame:
    """Values outside the list with their frequency."""
    rows = df.where(F.col(column).isNotNull() & ~F.col(column).isin(values))
    return rows.groupBy(F.col(column).cast("string").alias("value")).agg(count_rows().alias("n"))


def total_mismatch(staged: DataFrame, temporal: DataFrame) -> DataFrame:
    """Totals of staging and minute table; ``failed`` if they differ or the table is empty."""
    mart = temporal.agg(F.coalesce(F.sum("total_packets"), F.lit(0)).alias("m"))
    return staged.agg(count_rows().alias("stg_total")).withColumn(
        "mart_total", one_value(mart, "m")
    ).withColumn(
        "failed", (F.col("stg_total") != F.col("mart_total")) | (F.col("stg_total") == 0)
    )


def pareto_first_rank(pareto: DataFrame) -> DataFrame:
    """First rank with a running share outside (0, 100]."""
    share = F.col("cumulative_share_pct")
    return pareto.where((F.col("prefix_rank") == 1) & ((share <= 0.0) | (share > 100.0)))


def matrix_row_sums(matrix: DataFrame, low: float = 99.0, high: float = 101.0) -> DataFrame:
    """Record types whose percentages do not add up to about one hundred."""
    sums = matrix.groupBy("qtype_name").agg(
        F.round(F.sum("row_percentage"), 1).alias("total_share")
    )
    return sums.where(~F.col("total_share").between(low, high))


def not_empty(df: DataFrame) -> DataFrame:
    """One row if the table is empty; reads at most one row of it."""
    return df.limit(1).agg(count_rows().alias("n")).where(F.col("n") == 0).select(
        F.lit(1).alias("failed")
    )


def window_guard(window: DataFrame, nx_rows: DataFrame, group: str) -> DataFrame:
    """Preconditions of a decomposition: enough minutes, peak among them, no group missing."""
    missing = one_value(nx_rows.agg(count_where(F.col(group).isNull()).alias("n")), "n")
    inside = F.col("peak_minute").between(F.col("first_minute"), F.col("last_minute"))
    return window.select(
        (F.col("n_minutes") >= 2).alias("enough_minutes"),
        F.coalesce(inside, F.lit(False)).alias("peak_inside"),
        missing.alias("rows_without_group"),
    )


def profile_reconciliation(profile: DataFrame, packets: DataFrame, inside: Column) -> DataFrame:
    """Queries and responses in the source profile beside those of the packets."""
    rows = packets.where(inside)
    sums = rows.agg(
        count_where(P.is_query()).alias("queries"),
        count_where(P.is_query() & F.col("src_ip").isNull()).alias("queries_without_source"),
        count_where(P.is_response()).alias("responses"),
        count_where(P.is_response() & F.col("dst_ip").isNull()).alias("responses_without_host"),
        count_where(P.is_response() & F.col("rcode").isNull()).alias("responses_without_rcode"),
    )
    totals = one_row(
        profile.agg(F.sum("query").alias("query"), F.sum("responses").alias("responses"))
    )
    return sums.withColumns(
        {"profile_queries": totals["query"], "profile_responses": totals["responses"]}
    ).withColumn(
        "reconciled",
        (F.col("queries") - F.col("queries_without_source") == F.col("profile_queries"))
        & (F.col("responses") - F.col("responses_without_host") == F.col("profile_responses")),
    )


def label_checks(labels: DataFrame) -> DataFrame:
    """Duplicate and malformed labels of a label map."""
    return labels.agg(
        (count_rows() - F.count_distinct("label")).alias("duplicate_labels"),
        count_where(~F.col("label").rlike(r"\AS[1-9][0-9]*\z")).alias("malformed_labels"),
    )


# --- duplicates ----------------------------------------------------------------------------------


def duplicate_audit(
    packets: DataFrame, key: Sequence[str] = tuple(TRANSACTION_KEY)
) -> DataFrame:
    """Surplus rows: exact copies, and repetitions of the transaction key.

    Exact copies share their key and rows with equal keys share its hash. So the first step counts
    8-byte hashes, pre-aggregated, and only rows whose hash repeats are grouped by their real
    values. The list of repeated hashes is stored first, so the join with it is planned by its true
    size; and a filter of fixed size keeps the wide rows that occur once from it, so they are not
    shuffled either when that list is too large to be sent to all tasks.
    """
    hashed = packets.withColumn("key_hash", F.xxhash64(*[F.col(c) for c in key]))
    repeated = stage(
        hashed.groupBy("key_hash").agg(count_rows().alias("n")).where(F.col("n") > 1)
        .select("key_hash")
    )
    suspects = may_be_member(hashed, "key_hash", repeated).join(repeated, "key_hash", "left_semi").drop("key_hash")
    exact = suspects.groupBy(*packets.columns).agg(count_rows().alias("n"))
    per_key = exact.groupBy(*key).agg(
        F.sum("n").alias("n"), F.sum(F.col("n") - 1).alias("copies")
    )
    return per_key.agg(
        F.coalesce(F.sum("copies"), F.lit(0)).alias("exact"),
        F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("by_key"),
    )
