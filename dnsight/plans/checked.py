"""Staging and marts that are tested while they are written.

What a test has to count over the packets is observed on the rows as they are written, so the packets are
read once and no test reads them again. The observed rows are those of the last stage of each job,
whose tasks count once even if executors are lost.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from dnsight.functions.measures import count_rows, count_where
from dnsight.operators import quality
from dnsight.plans import marts
from dnsight.plans.staging import staged
from dnsight.sources.storage import stage

#: Accepted values of staging columns.
ACCEPTED = {"message_type": [0, 1], "protocol": ["udp", "tcp"]}


@dataclass(frozen=True)
class CheckedMarts:
    """Stored staging and marts, and what was found while they were stored."""

    staging: DataFrame
    temporal: DataFrame
    pareto: DataFrame
    matrix: DataFrame
    #: test, failures of the 16 data tests; zero means passed.
    tests: DataFrame
    #: column, check, failures of the contract, and the summary that ``contract_summary`` gives.
    contract: DataFrame
    summary: DataFrame

    def require(self) -> CheckedMarts:
        """Raise if a data test found anything."""
        failed = [f"{r['test']}: {r['failures']}" for r in self.tests.where("failures > 0").collect()]
        if failed:
            raise ValueError("; ".join(failed))
        return self


def _stored(df: DataFrame, metrics: dict[str, Column]) -> tuple[DataFrame, dict[str, int]]:
    """Store a table; its metrics come from the same job."""
    observation = Observation()
    return stage(df.observe(observation, *[m.alias(name) for name, m in metrics.items()])), observation.get


def _missing(column: str, where: Column | None = None) -> Column:
    missing = F.col(column).isNull()
    return count_where(missing if where is None else missing & where)


def build_checked_marts(packets: DataFrame, contract: Sequence[tuple] = tuple(quality.CONTRACT)) -> CheckedMarts:
    """Store staging and the three marts, and test the packets, staging and marts on the way.

    Only a test that needs the values themselves looks again, at a stored table: repeated keys and
    row sums at a mart, and refused values, when there are any, at one column of staging.
    """
    broken = quality._broken_rules(contract)
    names = [(column, check) for column, _, check, *_ in contract]
    rules = {
        f"rule {k}": count_where(F.array_contains(F.transform("__broken", lambda b: b["column"]), column))
        for k, (column, _) in enumerate(names)
    }
    checked = packets.withColumn("__broken", broken)
    contract_seen = Observation()
    checked = checked.observe(
        contract_seen, count_rows().alias("rows"), F.coalesce(F.sum(F.size("__broken")), F.lit(0)).alias("failures"),
        *[m.alias(name) for name, m in rules.items()],
    ).drop("__broken")
    refused = {c: count_where(F.col(c).isNotNull() & ~F.col(c).isin(values)) for c, values in ACCEPTED.items()}
    stg, seen = _stored(staged(checked), {
        "rows": count_rows(), "packet_timestamp": _missing("packet_timestamp"), "message_type": _missing("message_type"),
        "protocol": _missing("protocol"), "response_code": _missing("response_code", F.col("message_type") == 1),
        **{f"refused {c}": m for c, m in refused.items()},
    })
    temporal, minutes = _stored(marts.temporal_mart(stg), {
        "packet_minute": _missing("packet_minute"), "total_packets": _missing("total_packets"),
        "sum": F.coalesce(F.sum("total_packets"), F.lit(0)),
    })
    share = F.col("cumulative_share_pct")
    pareto, ranks = _stored(marts.pareto_mart(stg), {
        "prefix_rank": _missing("prefix_rank"), "src_prefix": _missing("src_prefix"),
        "first": count_where((F.col("prefix_rank") == 1) & ((share <= 0.0) | (share > 100.0))),
    })
    matrix = stage(marts.protocol_mart(stg))

    def values_refused(column: str) -> int:
        if not seen[f"refused {column}"]:
            return 0
        return quality.accepted_values(stg, column, ACCEPTED[column]).count()

    mismatch = seen["rows"] != minutes["sum"] or seen["rows"] == 0
    tests = [
        *[(f"not_null staging {c}", seen[c]) for c in ("packet_timestamp", "message_type", "protocol", "response_code")],
        *[(f"not_null temporal {c}", minutes[c]) for c in ("packet_minute", "total_packets")],
        *[(f"not_null pareto {c}", ranks[c]) for c in ("prefix_rank", "src_prefix")],
        ("unique temporal packet_minute", quality.unique(temporal, "packet_minute").count()),
        ("unique pareto prefix_rank", quality.unique(pareto, "prefix_rank").count()),
        *[(f"accepted_values staging {c}", values_refused(c)) for c in ACCEPTED],
        ("temporal total equals staging total", int(mismatch)),
        ("first pareto share in range", ranks["first"]),
        ("matrix rows add up to 100", quality.matrix_row_sums(matrix).count()),
        ("staging has rows", int(seen["rows"] == 0)),
    ]
    spark, found = packets.sparkSession, contract_seen.get
    status = "FAILED" if found["failures"] else "PASSED"
    return CheckedMarts(
        stg, temporal, pareto, matrix,
        spark.createDataFrame(tests, "test string, failures bigint"),
        spark.createDataFrame([(*n, found[f"rule {k}"]) for k, n in enumerate(names)], "column string, check string, failures bigint"),
        spark.createDataFrame([(status, found["rows"], found["failures"])], "status string, validated_rows bigint, n_failures bigint"),
    )
