"""Merging findings into the exception table: refresh, suppress or create.

Everything is keyed on (exception_type, issue_key): a deduplication key contains both, so whoever
owns a key has the same issue. One aggregation per issue replaces per-finding lookups.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidewatch.functions.text import id_key, key_id, quoted, sha256
from tidewatch.schema import ACTIVE_STATUSES, EXCEPTION_HISTORY, EXCEPTION_STATE
from tidewatch.settings import instant_sql, parked

ISSUE = ("exception_type", "issue_key")
ISSUE_HASH = f"xxhash64({', '.join(ISSUE)})"
#: Fields a recurring finding refreshes on its active exception.
REFRESHED = (
    "severity", "expected_resolution", "business_impact", "revenue_at_risk", "orders_affected",
    "root_cause", "recommended_action", "confidence", "source_warehouse_id", "source_product_id",
)
DETECTION_ACTOR = "exception-engine"


@dataclass(frozen=True)
class Merge:
    """Result of one detection run; `touched` are the issues whose exceptions are new or say something else now, `kept`
    the written frames that the others read."""

    state: DataFrame
    new_history: DataFrame
    outcomes: DataFrame
    touched: DataFrame
    kept: tuple[DataFrame, ...] = ()

    def counters(self) -> DataFrame:
        """One row: findings seen, created, updated, skipped and persisted."""
        totals = {"findings": "detections", "created": "created", "updated": "updated", "skipped": "skipped"}
        return self.outcomes.agg(
            *[F.expr(f"coalesce(sum({name}), 0L) AS {shown}") for name, shown in totals.items()]
        ).selectExpr("*", "created + updated AS persisted")


def _empty(spark: SparkSession, schema: StructType) -> DataFrame:
    """No rows by its plan: joins with it are left out, and the other side is not dealt to meet it."""
    return spark.range(1).where("false").select(*(F.lit(None).cast(field.dataType).alias(field.name) for field in schema))


def empty_state(spark: SparkSession) -> DataFrame:
    return _empty(spark, EXCEPTION_STATE)


def empty_history(spark: SparkSession) -> DataFrame:
    return _empty(spark, EXCEPTION_HISTORY)


IS_ACTIVE = f"status IN ({', '.join(quoted(status) for status in ACTIVE_STATUSES)})"


def _issues(findings: DataFrame, state: DataFrame) -> DataFrame:
    """One row per issue of the run: the outcome counts, the values to store and the keys.

    Several findings of one issue (two order namespaces sharing an id) are taken unsuppressed ones
    first, then in key order: without an active exception the first unsuppressed one is created
    and the others refresh it; when all are suppressed, all are skipped.

    Ids and keys have the form of `id_key`; `other_key` is the key to store where that is not `first_free`.
    """
    findings = findings.withColumn("deduplication_key", F.expr(id_key("deduplication_key")))
    suppressing = state.where(f"NOT {IS_ACTIVE}").selectExpr(f"{id_key('deduplication_key')} AS deduplication_key").distinct()
    active = state.where(IS_ACTIVE).selectExpr(
        f"{ISSUE_HASH} AS issue_hash", *ISSUE, f"{id_key('exception_id')} AS active_id", f"{id_key('deduplication_key')} AS active_key", f"struct({', '.join(REFRESHED)}) AS before"
    )
    judged = findings.join(suppressing.selectExpr("deduplication_key", "true AS held"), "deduplication_key", "left")
    stored = judged.selectExpr(
        *[name for name in findings.columns if name != "revenue_at_risk"],
        "CAST(round(revenue_at_risk, 2) AS DECIMAL(14,2)) AS revenue_at_risk",
        "coalesce(held, false) AS held",
        "CASE WHEN held IS NULL THEN deduplication_key END AS free_key",
    )
    latest = f"struct({', '.join(('rule_ordinal', 'entity_type', 'entity_id', *REFRESHED))})"
    per_issue = stored.groupBy(F.expr(ISSUE_HASH).alias("issue_hash"), *ISSUE).agg(
        F.expr("count(1) AS findings"),
        F.expr(f"max_by({latest}, struct(held, deduplication_key)) AS latest"),
        F.expr("min(free_key) AS first_free"),
        F.expr("max(free_key) AS last_free"),
    )
    same = " AND ".join(["kept_key <=> active_key", *(f"latest.{name} <=> before.{name}" for name in REFRESHED)])
    return (
        per_issue.join(active, ["issue_hash", *ISSUE], "left")
        .selectExpr(
            "*",
            "coalesce(last_free, active_key) AS kept_key",
            "CAST(active_id IS NULL AND first_free IS NOT NULL AS INT) AS created",
            "CASE WHEN active_id IS NULL AND first_free IS NULL THEN findings ELSE 0L END AS skipped",
        )
        .selectExpr("*", "findings - created - skipped AS updated", f"active_id IS NOT NULL AND NOT ({same}) AS altered")
        .withColumn("other_key", F.expr("nullif(kept_key, first_free)"))
        .drop("before", "issue_hash", "last_free", "active_key", "kept_key")
    )


def merge_findings(
    findings: DataFrame,
    state: DataFrame,
    as_of: datetime,
    *,
    dataset_version_id: int,
    run_sequence: int,
    durable: bool = True,
) -> Merge:
    """Merge one run's findings into the exception table of one dataset.

    An active exception of the same issue is refreshed and keeps status and detection time; a
    finding whose key a resolved or dismissed exception holds is skipped; any other is created.
    Exceptions that are not found again stay untouched. `state` may be only a part that has all exceptions
    of the findings' issues. `durable` checkpoints the per-issue frame, because state, history and counters
    all read it.
    """
    issues = _issues(findings, state)
    if durable:
        issues = parked(issues)

    fields = EXCEPTION_STATE.fieldNames()
    refresh = issues.where("active_id IS NOT NULL").selectExpr("active_id AS exception_id", "latest", "coalesce(other_key, first_free) AS kept_key")
    refreshed = {name: f"latest.{name}" for name in REFRESHED} | {"deduplication_key": "kept_key"}
    keys = ("exception_id", "deduplication_key")
    kept = state.withColumns({name: F.expr(id_key(name)) for name in keys}).join(refresh, "exception_id", "left").selectExpr(
        *[
            f"CASE WHEN latest IS NOT NULL THEN {refreshed[name]} ELSE {name} END AS {name}"
            if name in refreshed
            else name
            for name in fields
        ]
    ).withColumns({name: F.expr(key_id(name)) for name in keys})

    fresh_values = {
        "exception_id": sha256(f"concat_ws('|', '{dataset_version_id}', '{run_sequence}', {key_id('first_free')})"),
        "deduplication_key": key_id("coalesce(other_key, first_free)"),
        "exception_type": "exception_type",
        "issue_key": "issue_key",
        "status": "'OPEN'",
        "detected_at": instant_sql(as_of),
        "resolved_at": "CAST(NULL AS TIMESTAMP)",
        "run_sequence": str(run_sequence),
    }
    fresh = issues.where("created = 1").selectExpr(
        *[f"{fresh_values.get(name, f'latest.{name}')} AS {name}" for name in fields]
    )
    opened = fresh.selectExpr(
        "exception_id",
        "CAST(NULL AS STRING) AS from_status",
        "'OPEN' AS to_status",
        "detected_at AS changed_at",
        f"'{DETECTION_ACTOR}' AS actor",
        "CAST(NULL AS STRING) AS transition_reason",
        "0L AS entry",
    )
    outcomes = issues.select(*ISSUE, "findings", "created", "updated", "skipped")
    touched = issues.where("created = 1 OR altered").select(*ISSUE)
    return Merge(kept.unionByName(fresh), opened, outcomes, touched, (issues,) if durable else ())
