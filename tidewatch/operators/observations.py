"""Immutable order observations: assessment of raw rows and replay-safe staging."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.functions.text import (
    iso_micros,
    json_object,
    parse_decimal,
    parse_instant,
    plain_decimal_text,
    python_literal,
    quoted,
    sha256,
    stripped,
    trimmed,
)
from tidewatch.functions.unicode import composed
from tidewatch.schema import ORDER_STATUSES
from tidewatch.settings import parked

# Source spellings of an order status.
STATUS_ALIASES = {
    "DELIVERED": "FULFILLED",
    "COMPLETE": "FULFILLED",
    "COMPLETED": "FULFILLED",
    "CANCELED": "CANCELLED",
    "CANCELLED": "CANCELLED",
    "OPEN": "OPEN",
    "PENDING": "OPEN",
}
# Source columns that may carry one fact.
ALIASES = {
    "source_order_id": ("source_order_id", "order_id"),
    "total_amount": ("total_amount", "amount", "order_total"),
    "currency": ("currency", "order_currency"),
    "warehouse": ("source_warehouse_id", "warehouse_id", "warehouse"),
    "ordered_at": ("ordered_at", "order_purchase_timestamp", "order_date"),
    "promised_at": ("promised_at", "order_estimated_delivery_date"),
    "fulfilled_at": ("fulfilled_at", "order_delivered_customer_date"),
}
FACTS = (
    "source_order_id", "order_number", "status", "region", "source_warehouse_id", "ordered_at",
    "promised_at", "fulfilled_at", "total_amount", "currency",
)
_TIMES = ("ordered_at", "promised_at", "fulfilled_at")
#: What can be wrong with a row, in the order it is told.
INVALID_REASONS = (
    "CONFLICTING_SOURCE_ORDER_ID", "CONFLICTING_TOTAL_AMOUNT", "CONFLICTING_CURRENCY", "CONFLICTING_WAREHOUSE",
    "NEGATIVE_TOTAL_AMOUNT", "MALFORMED_TOTAL_AMOUNT",
    *(f"{fault}_{name.upper()}" for name in _TIMES for fault in ("CONFLICTING", "MALFORMED")),
    "MISSING_SOURCE_NAMESPACE", "MISSING_SOURCE_ORDER_ID", "MALFORMED_STATUS", "MALFORMED_CURRENCY", "CONFLICTING_TIMESTAMPS",
)
CAPABILITIES = ("WAREHOUSE_CONTEXT_UNAVAILABLE", "WAREHOUSE_OBSERVED", "WAREHOUSE_VALIDATED", "WAREHOUSE_UNKNOWN")
#: Text facts whose spelling is normalised; amounts and times are parsed instead.
_COMPOSED = (
    "source_namespace", "source_version", "order_number", "status", "order_status", "region",
    "customer_state", *ALIASES["source_order_id"], *ALIASES["currency"], *ALIASES["warehouse"],
)


@dataclass(frozen=True)
class Staged:
    """Observations to add, receipts to add, and rows refused for lack of an identity."""

    observations: DataFrame
    receipts: DataFrame
    refused: DataFrame


def _chosen(present: set[str], fact: str) -> tuple[str, str]:
    """Value of the first filled alias and whether the filled ones differ. Differing ones are
    carried as the list of (name, value) pairs, written out."""
    names = [name for name in ALIASES[fact] if name in present]
    if not names:
        return "CAST(NULL AS STRING)", "false"
    value = f"coalesce({', '.join(f'CASE WHEN {trimmed(n)} IS NOT NULL THEN {n} END' for n in names)})"
    if len(names) == 1:
        return value, "false"
    texts = ", ".join(trimmed(name) for name in names)
    differ = f"size(array_distinct(array_compact(array({texts})))) > 1"
    pairs = ", ".join(
        f"CASE WHEN {trimmed(n)} IS NOT NULL THEN concat('(\\'{n}\\', ', {python_literal(n)}, ')') END" for n in names
    )
    listed = f"concat('[', array_join(array_compact(array({pairs})), ', '), ']')"
    return f"CASE WHEN {differ} THEN {listed} ELSE {value} END", differ


def _either(present: set[str], *names: str) -> str:
    filled = [f"nullif({name}, '')" for name in names if name in present]
    return f"coalesce({', '.join(filled)}, CAST(NULL AS STRING))" if filled else "CAST(NULL AS STRING)"


def _reasons(*cases: tuple[str, str]) -> str:
    listed = ", ".join(f"CASE WHEN {test} THEN {reason} END" for test, reason in cases)
    return f"array_distinct(array_compact(array({listed})))"


def assess(raw: DataFrame, known_warehouses: DataFrame | None = None) -> DataFrame:
    """Normalise raw text rows and assess what each can support.

    `raw` has `source_namespace`, `source_version`, `batch_id`, `sequence` and source columns under
    any of their aliases. Without a warehouse registry a filled warehouse is only observed.
    """
    present = set(raw.columns)
    spelled = raw.withColumns({name: composed(F.col(name)) for name in _COMPOSED if name in present})
    picked, differs = {}, {}
    for fact in ALIASES:
        picked[fact], differs[fact] = _chosen(present, fact)
    version = "source_version" if "source_version" in present else "CAST(NULL AS STRING)"
    batch = trimmed("batch_id") if "batch_id" in present else "CAST(NULL AS STRING)"
    gathered = spelled.selectExpr(
        "sequence",
        f"coalesce({batch}, '') AS batch_id",
        f"coalesce({trimmed('source_namespace')}, '') AS source_namespace",
        f"{version} AS source_version",
        f"{trimmed(_either(present, 'order_number'))} AS order_number",
        f"upper({trimmed(_either(present, 'status', 'order_status'))}) AS status_text",
        f"{trimmed(_either(present, 'region', 'customer_state'))} AS region",
        *[f"{sql} AS raw_{fact}" for fact, sql in picked.items()],
        *[f"{sql} AS differs_{fact}" for fact, sql in differs.items()],
    )
    aliases = " ".join(f"WHEN '{old}' THEN '{new}'" for old, new in STATUS_ALIASES.items())
    amount = parse_decimal(stripped("raw_total_amount"))
    parsed = gathered.selectExpr(
        "*",
        f"{trimmed('raw_source_order_id')} AS source_order_id",
        f"{trimmed('raw_warehouse')} AS source_warehouse_id",
        f"CASE status_text {aliases} ELSE status_text END AS status",
        f"upper({trimmed('raw_currency')}) AS currency",
        f"{amount} AS parsed_amount",
        *[f"{parse_instant(stripped(f'raw_{name}'))} AS {name}" for name in _TIMES],
    ).selectExpr("*", "CASE WHEN parsed_amount >= 0 THEN parsed_amount END AS total_amount")

    domain = ", ".join(quoted(status) for status in ORDER_STATUSES)
    invalid = [
        ("differs_source_order_id", "'CONFLICTING_SOURCE_ORDER_ID'"),
        ("differs_total_amount", "'CONFLICTING_TOTAL_AMOUNT'"),
        ("differs_currency", "'CONFLICTING_CURRENCY'"),
        ("differs_warehouse", "'CONFLICTING_WAREHOUSE'"),
        ("parsed_amount < 0", "'NEGATIVE_TOTAL_AMOUNT'"),
        ("raw_total_amount IS NOT NULL AND parsed_amount IS NULL", "'MALFORMED_TOTAL_AMOUNT'"),
    ]
    for name in _TIMES:
        invalid.append((f"differs_{name}", f"'CONFLICTING_{name.upper()}'"))
        invalid.append((f"raw_{name} IS NOT NULL AND {name} IS NULL", f"'MALFORMED_{name.upper()}'"))
    invalid += [
        ("source_namespace = ''", "'MISSING_SOURCE_NAMESPACE'"),
        ("source_order_id IS NULL", "'MISSING_SOURCE_ORDER_ID'"),
        (f"status NOT IN ({domain})", "'MALFORMED_STATUS'"),
        ("NOT currency RLIKE '^[A-Z]{3}$'", "'MALFORMED_CURRENCY'"),
        ("fulfilled_at < ordered_at", "'CONFLICTING_TIMESTAMPS'"),
    ]
    if known_warehouses is None:
        placed = parsed.selectExpr("*", "CAST(NULL AS BOOLEAN) AS registered")
        filled = "'WAREHOUSE_OBSERVED'"
    else:
        registry = known_warehouses.selectExpr(f"{known_warehouses.columns[0]} AS source_warehouse_id", "true AS registered")
        placed = parsed.join(registry, "source_warehouse_id", "left")
        filled = "CASE WHEN registered THEN 'WAREHOUSE_VALIDATED' ELSE 'WAREHOUSE_UNKNOWN' END"
    facts = placed.selectExpr(
        "sequence", "batch_id", "source_namespace", "source_version", *FACTS, f"{_reasons(*invalid)} AS invalid_reasons",
        f"CASE WHEN source_warehouse_id IS NULL THEN 'WAREHOUSE_CONTEXT_UNAVAILABLE' ELSE {filled} END AS warehouse_capability",
    )
    return _weighed(facts)


def _weighed(facts: DataFrame) -> DataFrame:
    """Rows of facts, their faults and what is known of their warehouse, with all that follows from these."""
    context = [
        ("warehouse_capability = 'WAREHOUSE_UNKNOWN'", "'UNKNOWN_WAREHOUSE'"),
        ("total_amount IS NULL", "'MISSING_TOTAL_AMOUNT'"),
        ("currency IS NULL", "'MISSING_CURRENCY'"),
        ("total_amount IS NOT NULL AND currency IS NULL", "'AMOUNT_WITHOUT_CURRENCY'"),
        ("order_number IS NULL", "'MISSING_ORDER_NUMBER'"),
        ("status IS NULL", "'MISSING_STATUS'"),
        ("region IS NULL", "'MISSING_REGION'"),
        ("ordered_at IS NULL", "'MISSING_ORDERED_AT'"),
        ("promised_at IS NULL", "'MISSING_PROMISED_AT'"),
    ]
    canonical = {name: name for name in FACTS} | {name: iso_micros(name) for name in _TIMES}
    canonical["total_amount"] = plain_decimal_text("total_amount")
    return (
        facts.selectExpr(
            *[name for name in facts.columns if name not in ("invalid_reasons", "warehouse_capability")],
            "invalid_reasons",
            f"{_reasons(*context)} AS context_reasons",
            "warehouse_capability",
            "total_amount IS NOT NULL AND currency IS NOT NULL AS financial",
            "ordered_at IS NOT NULL AND promised_at IS NOT NULL AS timing",
            f"{json_object(canonical, keep_nulls=True)} AS source_facts",
        )
        .selectExpr(
            "*",
            f"{sha256('source_facts')} AS source_row_hash",
            "CASE WHEN size(invalid_reasons) > 0 THEN 'REJECTED_INVALID' WHEN size(context_reasons) > 0 "
            "THEN 'CONTEXT_INCOMPLETE' ELSE 'NORMALIZED' END AS assessment",
            "CASE WHEN size(invalid_reasons) > 0 THEN 'REJECTED_INVALID' ELSE 'SOURCE_VALID' END AS source_status",
        )
        .selectExpr(
            "*",
            "assessment = 'NORMALIZED' AS promotion_eligible",
            # A missing version stays null inside the array: it is not an empty version.
            f"{sha256('to_json(array(source_namespace, source_order_id, source_version, source_row_hash))')} AS replay_digest",
        )
    )


def _marks() -> str:
    """Faults and warehouse capability as one number, which an aggregation by hashing can hold."""
    faults = " + ".join(f"IF(array_contains(invalid_reasons, '{reason}'), {len(CAPABILITIES) << n}L, 0L)" for n, reason in enumerate(INVALID_REASONS))
    known = " ".join(f"WHEN '{name}' THEN {n}L" for n, name in enumerate(CAPABILITIES))
    return f"IF(size(invalid_reasons) > 0, {faults}, 0L) + CASE warehouse_capability {known} END"


def _marked(marks: str) -> list[str]:
    """The two columns that `_marks` holds."""
    faults = ", ".join(f"IF({marks} & {len(CAPABILITIES) << n} <> 0, '{reason}', NULL)" for n, reason in enumerate(INVALID_REASONS))
    known = " ".join(f"WHEN {n} THEN '{name}'" for n, name in enumerate(CAPABILITIES))
    return [
        f"IF({marks} >= {len(CAPABILITIES)}, array_compact(array({faults})), CAST(array() AS ARRAY<STRING>)) AS invalid_reasons",
        f"CASE {marks} & {len(CAPABILITIES) - 1} {known} END AS warehouse_capability",
    ]


def stage(assessed: DataFrame, stored: DataFrame | None = None, stored_receipts: DataFrame | None = None, *, durable: bool = False) -> Staged:
    """Evidence to add for assessed rows. Rows with one replay digest are one observation, the
    first in sequence; each batch that delivered it leaves one receipt. Invalid rows are kept as
    rejected evidence, rows without namespace or order id are refused.

    The digest is one of namespace, version and facts, so rows are grouped by these themselves, and all that
    follows from them is told again afterwards. `durable` keeps the grouped rows, for evidence that is read more than once.
    """
    lacking = "source_namespace = '' OR source_order_id IS NULL"
    refused = assessed.where(lacking).selectExpr("sequence", "batch_id", "invalid_reasons")
    named = assessed.where(f"NOT ({lacking})")
    told = ("source_namespace", "source_version", *FACTS)
    first = named.groupBy(*told).agg(F.expr("min(sequence) AS sequence"), F.expr(f"min_by({_marks()}, sequence) AS marks"))
    if durable:
        first = parked(first)
    fresh = _weighed(first.selectExpr("sequence", *told, *_marked("marks")))
    receipts = named.selectExpr("unhex(replay_digest) AS digest", "batch_id").distinct().selectExpr("lower(hex(digest)) AS observation_id", "batch_id")
    if stored is not None:
        fresh = fresh.join(stored.selectExpr("observation_id AS replay_digest"), "replay_digest", "left_anti")
    if stored_receipts is not None:
        receipts = receipts.join(stored_receipts, ["observation_id", "batch_id"], "left_anti")
    domain = ", ".join(quoted(status) for status in ORDER_STATUSES)
    observations = fresh.selectExpr(
        "replay_digest AS observation_id", "source_namespace", "source_order_id", "source_version",
        "source_row_hash", "source_facts", "order_number",
        f"CASE WHEN status IN ({domain}) THEN status END AS order_status",
        "region", "source_warehouse_id", "ordered_at", "promised_at", "fulfilled_at",
        "CAST(round(total_amount, 2) AS DECIMAL(14,2)) AS total_amount", "currency",
        "assessment AS status", "source_status", "warehouse_capability", "financial", "timing",
        "CASE WHEN size(invalid_reasons) > 0 THEN invalid_reasons ELSE context_reasons END AS reasons",
        "false AS promoted", "CAST(NULL AS STRING) AS superseded_by", "sequence",
    )
    return Staged(observations, receipts, refused)


def identities(observations: DataFrame) -> DataFrame:
    return observations.select("source_namespace", "source_order_id").distinct()
