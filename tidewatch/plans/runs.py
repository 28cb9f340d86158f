"""Two detection runs over the star-schema tables, with lifecycle requests in between."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.operators import rules
from tidewatch.operators.lifecycle import Transitions, apply_transitions
from tidewatch.operators.state import Merge, empty_state, merge_findings
from tidewatch.plans import starmap
from tidewatch.settings import RuleSettings, instant_lit, parked, released

SETTINGS = RuleSettings(as_of=starmap.AS_OF)
DATASET = 1
SECOND_AS_OF = datetime(1998, 7, 11, tzinfo=timezone.utc)
REVIEWED_AT = datetime(1998, 7, 2, 9, 30, tzinfo=timezone.utc)


def first_findings(spark: SparkSession, folder: str) -> DataFrame:
    return rules.all_findings(starmap.tables(spark, folder), starmap.AS_OF, SETTINGS)


def first_run(spark: SparkSession, folder: str) -> Merge:
    return merge_findings(
        first_findings(spark, folder), empty_state(spark), starmap.AS_OF,
        dataset_version_id=DATASET, run_sequence=1,
    )


def review_requests(state: DataFrame) -> DataFrame:
    """Lifecycle requests, legal and not, chosen by the first digit of each exception's key."""

    def ask(target: str, actor: str = "planner", reason: str | None = None) -> Column:
        return F.struct(
            F.lit(target).alias("to_status"), F.lit(actor).alias("actor"),
            F.lit(reason).cast("string").alias("reason"),
        )

    # The requests per first key digit.
    scripts = {
        "0": [ask("ACKNOWLEDGED", " ana "), ask("IN_PROGRESS"), ask("RESOLVED", reason=" restocked ")],
        "1": [ask("DISMISSED", reason="known issue")],
        "2": [ask("RESOLVED", reason="too early"), ask("ACKNOWLEDGED")],
        "3": [ask("ACKNOWLEDGED", "  "), ask("DISMISSED", reason="  ")],
        "4": [
            ask("ACKNOWLEDGED"), ask("ACKNOWLEDGED"), ask("IN_PROGRESS"),
            ask("DISMISSED", reason="duplicate"), ask("RESOLVED", reason="late"),
        ],
        "5": [ask("ACKNOWLEDGED")],
    }
    digit = F.substring("deduplication_key", 1, 1)
    script = F.lit(None)
    for mark, requests in scripts.items():
        script = F.when(digit == mark, F.array(*requests)).otherwise(script)
    target = F.when(digit == "5", F.concat(F.lit("unknown-"), "exception_id")).otherwise(F.col("exception_id"))
    return (
        state.where(digit.isin(*scripts))
        .select(target.alias("exception_id"), F.posexplode(script).alias("position", "request"))
        .select(
            "exception_id",
            (F.col("position") + 1).cast("long").alias("sequence"),
            "request.*",
            instant_lit(REVIEWED_AT).alias("changed_at"),
        )
    )


def review(spark: SparkSession, folder: str) -> Transitions:
    return review_of(first_run(spark, folder))


def review_of(first: Merge) -> Transitions:
    return apply_transitions(first.state, review_requests(first.state))


def later_items(items: DataFrame) -> DataFrame:
    """Order lines some days later: one more unit shipped on part of the orders."""
    number = F.substring("source_order_id", 2, 20).cast("long")
    shipped = F.least(F.col("ordered_quantity"), F.col("fulfilled_quantity") + 1).cast("decimal(18,3)")
    return items.withColumn(
        "fulfilled_quantity", F.when(number % 11 == 0, shipped).otherwise(F.col("fulfilled_quantity"))
    )


def second_findings(spark: SparkSession, folder: str) -> DataFrame:
    tables = starmap.tables(spark, folder)
    tables["order_items"] = later_items(tables["order_items"])
    return rules.all_findings(tables, SECOND_AS_OF, SETTINGS)


def second_run(spark: SparkSession, folder: str) -> Merge:
    first = first_run(spark, folder)
    reviewed = review_of(first)
    state = parked(reviewed.state)
    released(*first.kept, *reviewed.kept)
    return merge_findings(second_findings(spark, folder), state, SECOND_AS_OF, dataset_version_id=DATASET, run_sequence=2)
