"""Constraint and append-only audits: frames that are empty when all is well.

Every table is read once. A row tells for each constraint it takes part in which key it holds, and whether
as the row that owns the key or as one that refers to it; rows that break a check tell that. One aggregation
over these tagged rows of all tables then finds keys with several owners, keys that are referred to and have
no owner, and broken checks.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.functions.text import id_key, key_id, quoted

Tables = Mapping[str, DataFrame]

# Constraints of the stored tables.
UNIQUE = {
    "products": (("source_product_id",), ("sku",)),
    "warehouses": (("source_warehouse_id",), ("code",)),
    "suppliers": (("source_supplier_id",), ("code",)),
    "inventory": (("source_product_id", "source_warehouse_id"),),
    "inventory_movements": (("source_movement_id",),),
    "orders": (("source_order_id",), ("order_number",)),
    "order_items": (("source_order_item_id",), ("source_order_id", "line_number")),
    "purchase_orders": (("source_purchase_order_id",), ("po_number",)),
    "purchase_order_items": (("source_purchase_order_item_id",),),
    "shipments": (("source_shipment_id",), ("tracking_id",)),
    "exceptions": (("exception_id",), ("deduplication_key",)),
    "exception_history": (("exception_id", "entry"),),
    "source_order_identities": (("source_namespace", "source_order_id"),),
    "order_observations": (("observation_id",),),
    "order_observation_receipts": (("observation_id", "batch_id"),),
    "promoted_orders": (("source_namespace", "source_order_id"), ("source_namespace", "order_number")),
    "dataset_versions": (("dataset_version_id",), ("identity_hash",), ("dataset_key", "manifest_identity", "seed", "as_of", "generator_revision")),
}
#: Keys that are unique among some rows only: columns, the condition, and how it is told.
UNIQUE_WHILE = {
    "exceptions": ((("exception_type", "issue_key"), "status IN ('OPEN', 'ACKNOWLEDGED', 'IN_PROGRESS')", "while active"),),
}
CHECKS = {
    "products": ("unit_price >= 0",),
    "inventory": ("on_hand >= 0", "reserved >= 0"),
    "inventory_movements": ("quantity > 0",),
    "orders": ("total_amount >= 0", "fulfilled_at >= ordered_at"),
    "order_items": (
        "ordered_quantity > 0", "fulfilled_quantity >= 0", "fulfilled_quantity <= ordered_quantity", "unit_price >= 0",
    ),
    "purchase_orders": ("received_at >= ordered_at",),
    "purchase_order_items": (
        "ordered_quantity > 0", "received_quantity >= 0", "received_quantity <= ordered_quantity", "unit_cost >= 0",
    ),
    "shipments": ("delivered_at >= shipped_at",),
    "exceptions": (
        "revenue_at_risk >= 0", "orders_affected >= 0", "confidence >= 0 AND confidence <= 1",
        "status IN ('OPEN', 'ACKNOWLEDGED', 'IN_PROGRESS', 'RESOLVED', 'DISMISSED')",
    ),
    "order_observations": ("total_amount >= 0", "fulfilled_at >= ordered_at"),
    "promoted_orders": ("total_amount >= 0", "fulfilled_at >= ordered_at"),
    "dataset_versions": ("status IN ('STAGED', 'READY', 'ACTIVE', 'RETIRED')",),
}
REFERENCES = {
    "inventory": {"source_product_id": "products", "source_warehouse_id": "warehouses"},
    "inventory_movements": {"source_product_id": "products", "source_warehouse_id": "warehouses"},
    "orders": {"source_warehouse_id": "warehouses"},
    "order_items": {"source_order_id": "orders", "source_product_id": "products"},
    "purchase_orders": {"source_supplier_id": "suppliers", "source_warehouse_id": "warehouses"},
    "purchase_order_items": {"source_purchase_order_id": "purchase_orders", "source_product_id": "products"},
    "shipments": {"source_order_id": "orders"},
    "exceptions": {"source_warehouse_id": "warehouses", "source_product_id": "products"},
    "exception_history": {"exception_id": "exceptions"},
    "order_observations": {"source_namespace, source_order_id": "source_order_identities", "superseded_by": "order_observations"},
    "order_observation_receipts": {"observation_id": "order_observations"},
    "promoted_orders": {"source_namespace, source_order_id": "source_order_identities", "current_observation": "order_observations"},
}
#: The ten operational tables, and those of exceptions, observations and versions.
OPERATIONAL = (
    "products", "warehouses", "suppliers", "inventory", "inventory_movements", "orders", "order_items", "purchase_orders",
    "purchase_order_items", "shipments",
)
RECORDED = tuple(name for name in UNIQUE if name not in OPERATIONAL)


#: Constraints by their place in the audit: table, kind and how it is told.
Constraints = dict[tuple[str, str, str], int]


def _cell(constraint: int, columns: tuple[str, ...], slot: int) -> str:
    """A tagged row: a key of a constraint, and who speaks of it. Null parts make no key."""
    first, *others = (f"CAST({column} AS STRING)" for column in columns)
    more = f"array({', '.join(others)})" if others else "CAST(NULL AS ARRAY<STRING>)"
    here = " AND ".join(f"{column} IS NOT NULL" for column in columns)
    return f"IF({here}, struct({constraint} AS constraint, {first} AS key, {more} AS more, {slot} AS slot), NULL)"


#: The slot of rows that own a key; the references to a table follow.
OWN = 0


def _tagged(
    rows: DataFrame, table: str, relations: dict[str, list[tuple[str, tuple[str, ...]]]], audited: bool, numbers: Constraints
) -> DataFrame:
    """What the rows of one table say about keys and checks, from one scan."""

    def cell(owner: str, kind: str, told: str, columns: tuple[str, ...], slot: int = OWN) -> str:
        return _cell(numbers.setdefault((owner, kind, told), len(numbers)), columns, slot)

    cells = []
    for place, columns in enumerate(UNIQUE[table]):
        if audited or (table in relations and place == 0):
            cells.append(cell(table, "UNIQUE", ", ".join(columns), columns))
    if audited:
        for columns, condition, when in UNIQUE_WHILE.get(table, ()):
            cells.append(f"IF({condition}, {cell(table, 'UNIQUE', f'{", ".join(columns)} {when}', columns)}, NULL)")
        for check in CHECKS.get(table, ()):
            cells.append(f"IF(NOT ({check}), {cell(table, 'CHECK', check, UNIQUE[table][0])}, NULL)")
        for parent, children in relations.items():
            for slot, (child, columns) in enumerate(children, OWN + 1):
                if child == table:
                    cells.append(cell(parent, "UNIQUE", ", ".join(UNIQUE[parent][0]), columns, slot))
    # Cells that say nothing are dropped after they are laid out: higher-order functions are not compiled.
    return rows.selectExpr(f"inline(array({', '.join(cells)}))").where("constraint IS NOT NULL")


def audit_tables(tables: Tables, names: tuple[str, ...] = OPERATIONAL) -> DataFrame:
    """Every constraint violation of the named tables: table_name, kind, violated, row_key, rows.

    A value that many rows hold is one partial count per task. References are checked where the parent is
    among `tables`. A check that several rows of one key break is told once for each.
    """
    relations: dict[str, list[tuple[str, tuple[str, ...]]]] = {}
    for name in names:
        for columns, parent in REFERENCES.get(name, {}).items():
            if parent in tables:
                relations.setdefault(parent, []).append((name, tuple(columns.split(", "))))
    numbers: Constraints = {}
    tagged = reduce(
        DataFrame.unionByName,
        [_tagged(tables[name], name, relations, name in names, numbers) for name in UNIQUE if name in names or name in relations],
    )
    # Digests are dealt out in half their bytes.
    tagged = tagged.selectExpr("constraint", f"{id_key('key')} AS key", "more", "slot")
    slots = 1 + max(map(len, relations.values()), default=0)
    counted = tagged.groupBy("constraint", "key", "more").agg(*(F.expr(f"count_if(slot = {slot}) AS c{slot}") for slot in range(slots)))

    def fault(table: str, kind: str, told: str, rows: str) -> str:
        return f"struct({quoted(table)} AS table_name, {quoted(kind)} AS kind, {quoted(told)} AS violated, row_key, {rows} AS rows)"

    own = f"c{OWN}"
    checks, faults = [], []
    for (table, kind, told), number in numbers.items():
        here = f"constraint = {number}"
        if kind == "CHECK":
            checks.append(f"WHEN {here} THEN transform(sequence(1L, {own}), i -> {fault(table, kind, told, '1L')})")
        elif table in names:
            faults.append(f"IF({here} AND {own} > 1, {fault(table, kind, told, own)}, NULL)")
        if told == ", ".join(UNIQUE[table][0]) and kind == "UNIQUE":
            for slot, (child, columns) in enumerate(relations.get(table, ()), OWN + 1):
                told_reference = fault(child, "REFERENCE", f"{', '.join(columns)} -> {table}", f"c{slot}")
                faults.append(f"IF({here} AND {own} = 0 AND c{slot} > 0, {told_reference}, NULL)")
    broken = [str(number) for (_, kind, _), number in numbers.items() if kind == "CHECK"]
    found = counted.where(f"{own} <> 1{f' OR constraint IN ({", ".join(broken)})' if broken else ''}").selectExpr(
        "*", f"{key_id('key')} AS first"
    ).selectExpr("*", "IF(more IS NULL, first, concat(first, ':', array_join(more, ':'))) AS row_key")
    told_once = f"array_compact(array({', '.join(faults)}))"
    return found.selectExpr(f"inline({f'CASE {" ".join(checks)} ELSE {told_once} END' if checks else told_once})")


def active_issue_violations(state: DataFrame) -> DataFrame:
    """Issues with more than one active exception, and keys held twice."""
    return audit_tables({"exceptions": state}, ("exceptions",)).where("kind = 'UNIQUE'")


def append_only_violations(before: DataFrame, after: DataFrame, evidence: list[str]) -> DataFrame:
    """Evidence rows of an earlier version that are missing or changed in a later one, counted
    with their multiplicity."""
    return before.select(*evidence).exceptAll(after.select(*evidence))
