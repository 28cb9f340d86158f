"""Declared table contracts: enums, artifact columns and typed schemas."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

QUANTITY = T.DecimalType(18, 3)
MONEY = T.DecimalType(14, 2)
CONFIDENCE = T.DecimalType(5, 4)
#: Precision at which raw amounts are validated, before they are rounded on write.
WIDE = T.DecimalType(38, 10)

# Domain vocabularies.
EXCEPTION_TYPES = (
    "SLA_BREACH_RISK",
    "INVENTORY_SHORTAGE",
    "STOCKOUT_RISK",
    "INVENTORY_MISMATCH",
    "SUPPLIER_DELAY",
    "SHIPMENT_DELAY",
)
SEVERITIES = ("CRITICAL", "HIGH", "MEDIUM", "LOW")
EXCEPTION_STATUSES = ("OPEN", "ACKNOWLEDGED", "IN_PROGRESS", "RESOLVED", "DISMISSED")
ACTIVE_STATUSES = ("OPEN", "ACKNOWLEDGED", "IN_PROGRESS")
ORDER_STATUSES = ("OPEN", "FULFILLED", "CANCELLED")
PURCHASE_ORDER_STATUSES = ("OPEN", "PARTIALLY_RECEIVED", "RECEIVED", "CANCELLED")
SHIPMENT_STATUSES = ("CREATED", "IN_TRANSIT", "DELIVERED", "EXCEPTION")
INBOUND_MOVEMENTS = ("RECEIPT", "ADJUSTMENT_IN", "TRANSFER_IN")
OUTBOUND_MOVEMENTS = ("SHIPMENT", "ADJUSTMENT_OUT", "TRANSFER_OUT")
NEUTRAL_MOVEMENTS = ("RESERVATION", "RELEASE")
MOVEMENT_TYPES = (
    "RECEIPT",
    "SHIPMENT",
    "ADJUSTMENT_IN",
    "ADJUSTMENT_OUT",
    "RESERVATION",
    "RELEASE",
    "TRANSFER_IN",
    "TRANSFER_OUT",
)
DATASET_STATUSES = ("STAGED", "READY", "ACTIVE", "RETIRED")


@dataclass(frozen=True)
class Rule:
    """What one text column of a source artifact must hold."""

    kind: str = "text"
    required: bool = True
    domain: tuple[str, ...] = ()
    parent: str | None = None

    @property
    def typed(self) -> bool:
        return self.kind != "text"

    @property
    def decimal(self) -> bool:
        return self.kind in ("money", "positive", "nonnegative")


@dataclass(frozen=True)
class Artifact:
    """One source file of a bundle and the table it loads."""

    name: str
    table: str
    key: str | None
    columns: dict[str, Rule]
    not_above: tuple[tuple[str, str, str], ...] = ()
    not_before: tuple[tuple[str, str], ...] = ()

    @property
    def header(self) -> tuple[str, ...]:
        return tuple(self.columns)

    @property
    def identity(self) -> tuple[str, ...]:
        """Columns that identify a stored row within a dataset."""
        return (self.key,) if self.key else ("source_product_id", "source_warehouse_id")

    def stored_type(self, column: str) -> T.DataType:
        kind = self.columns[column].kind
        return {
            "text": T.StringType(),
            "money": MONEY,
            "positive": QUANTITY,
            "nonnegative": QUANTITY,
            "timestamp": T.TimestampType(),
            "int": T.IntegerType(),
            "bool": T.BooleanType(),
        }[kind]

    def stored_schema(self) -> T.StructType:
        return T.StructType([T.StructField(c, self.stored_type(c)) for c in self.columns])


_TEXT = Rule()
_OPTIONAL = Rule(required=False)
_MONEY = Rule("money")
_POSITIVE = Rule("positive")
_NONNEGATIVE = Rule("nonnegative")
_TIME = Rule("timestamp")
_OPTIONAL_TIME = Rule("timestamp", required=False)


def _ref(parent: str) -> Rule:
    return Rule(parent=parent)


#: Artifacts in dependency order: parents always come before their children.
# The contract of the artifacts (columns, kinds, enums, relations).
ARTIFACTS: tuple[Artifact, ...] = (
    Artifact(
        "oms/products.csv", "products", "source_product_id",
        {
            "source_product_id": _TEXT, "sku": _TEXT, "name": _TEXT, "description": _OPTIONAL,
            "unit_price": _MONEY, "active": Rule("bool"),
        },
    ),
    Artifact(
        "wms/warehouses.csv", "warehouses", "source_warehouse_id",
        {"source_warehouse_id": _TEXT, "code": _TEXT, "name": _TEXT, "region": _TEXT, "timezone": _TEXT},
    ),
    Artifact(
        "erp/suppliers.csv", "suppliers", "source_supplier_id",
        {
            "source_supplier_id": _TEXT, "code": _TEXT, "name": _TEXT, "region": _TEXT,
            "active": Rule("bool"),
        },
    ),
    Artifact(
        "oms/orders.csv", "orders", "source_order_id",
        {
            "source_order_id": _TEXT, "order_number": _TEXT, "status": Rule(domain=ORDER_STATUSES),
            "region": _TEXT, "source_warehouse_id": _ref("warehouses"), "ordered_at": _TIME,
            "promised_at": _TIME, "fulfilled_at": _OPTIONAL_TIME, "total_amount": _MONEY,
            "currency": _TEXT,
        },
        not_before=(("fulfilled_at", "ordered_at"),),
    ),
    Artifact(
        "oms/order_items.csv", "order_items", "source_order_item_id",
        {
            "source_order_item_id": _TEXT, "source_order_id": _ref("orders"),
            "source_product_id": _ref("products"), "line_number": Rule("int"),
            "ordered_quantity": _POSITIVE, "fulfilled_quantity": _NONNEGATIVE, "unit_price": _MONEY,
        },
        not_above=(
            ("fulfilled_quantity", "ordered_quantity", "fulfilled quantity exceeds ordered quantity"),
        ),
    ),
    Artifact(
        "erp/purchase_orders.csv", "purchase_orders", "source_purchase_order_id",
        {
            "source_purchase_order_id": _TEXT, "po_number": _TEXT,
            "source_supplier_id": _ref("suppliers"), "source_warehouse_id": _ref("warehouses"),
            "status": Rule(domain=PURCHASE_ORDER_STATUSES), "ordered_at": _TIME,
            "expected_delivery_at": _TIME, "received_at": _OPTIONAL_TIME,
        },
        not_before=(("received_at", "ordered_at"),),
    ),
    Artifact(
        "erp/purchase_order_items.csv", "purchase_order_items", "source_purchase_order_item_id",
        {
            "source_purchase_order_item_id": _TEXT,
            "source_purchase_order_id": _ref("purchase_orders"),
            "source_product_id": _ref("products"), "ordered_quantity": _POSITIVE,
            "received_quantity": _NONNEGATIVE, "unit_cost": _MONEY,
        },
        not_above=(
            ("received_quantity", "ordered_quantity", "received quantity exceeds ordered quantity"),
        ),
    ),
    Artifact(
        "wms/inventory.csv", "inventory", None,
        {
            "source_product_id": _ref("products"), "source_warehouse_id": _ref("warehouses"),
            "on_hand": _NONNEGATIVE, "reserved": _NONNEGATIVE, "observed_at": _TIME,
        },
        not_above=(("reserved", "on_hand", "reserved exceeds on-hand inventory"),),
    ),
    Artifact(
        "wms/inventory_movements.csv", "inventory_movements", "source_movement_id",
        {
            "source_movement_id": _TEXT, "source_product_id": _ref("products"),
            "source_warehouse_id": _ref("warehouses"), "movement_type": Rule(domain=MOVEMENT_TYPES),
            "quantity": _POSITIVE, "occurred_at": _TIME, "reference_type": _OPTIONAL,
            "reference_id": _OPTIONAL,
        },
    ),
    Artifact(
        "carrier/shipments.csv", "shipments", "source_shipment_id",
        {
            "source_shipment_id": _TEXT, "source_order_id": _ref("orders"), "carrier": _TEXT,
            "tracking_id": _TEXT, "status": Rule(domain=SHIPMENT_STATUSES),
            "shipped_at": _OPTIONAL_TIME, "eta": _TIME, "delivered_at": _OPTIONAL_TIME,
        },
        not_before=(("delivered_at", "shipped_at"),),
    ),
)
BY_NAME = {artifact.name: artifact for artifact in ARTIFACTS}
BY_TABLE = {artifact.table: artifact for artifact in ARTIFACTS}
#: Tables whose accepted keys other artifacts refer to.
PARENT_TABLES = ("products", "warehouses", "suppliers", "orders", "purchase_orders")

EXCEPTION_STATE = T.StructType(
    [
        T.StructField("exception_id", T.StringType()),
        T.StructField("deduplication_key", T.StringType()),
        T.StructField("exception_type", T.StringType()),
        T.StructField("issue_key", T.StringType()),
        T.StructField("entity_type", T.StringType()),
        T.StructField("entity_id", T.StringType()),
        T.StructField("severity", T.StringType()),
        T.StructField("status", T.StringType()),
        T.StructField("detected_at", T.TimestampType()),
        T.StructField("expected_resolution", T.TimestampType()),
        T.StructField("business_impact", T.StringType()),
        T.StructField("revenue_at_risk", MONEY),
        T.StructField("orders_affected", T.IntegerType()),
        T.StructField("root_cause", T.StringType()),
        T.StructField("recommended_action", T.StringType()),
        T.StructField("confidence", CONFIDENCE),
        T.StructField("source_warehouse_id", T.StringType()),
        T.StructField("source_product_id", T.StringType()),
        T.StructField("resolved_at", T.TimestampType()),
        T.StructField("run_sequence", T.IntegerType()),
        T.StructField("rule_ordinal", T.IntegerType()),
    ]
)
#: Exceptions counted by what the summary and the facets ask for.
COUNT_CUBE = T.StructType(
    [
        T.StructField("status", T.StringType()),
        T.StructField("exception_type", T.StringType()),
        T.StructField("severity", T.StringType()),
        T.StructField("detected_at", T.TimestampType()),
        T.StructField("exceptions", T.LongType()),
        T.StructField("revenue_at_risk", T.DecimalType(24, 2)),
    ]
)
EXCEPTION_HISTORY = T.StructType(
    [
        T.StructField("exception_id", T.StringType()),
        T.StructField("from_status", T.StringType()),
        T.StructField("to_status", T.StringType()),
        T.StructField("changed_at", T.TimestampType()),
        T.StructField("actor", T.StringType()),
        T.StructField("transition_reason", T.StringType()),
        T.StructField("entry", T.LongType()),
    ]
)
DATASET_VERSIONS = T.StructType(
    [
        T.StructField("dataset_version_id", T.LongType()),
        T.StructField("dataset_key", T.StringType()),
        T.StructField("identity_hash", T.StringType()),
        T.StructField("manifest_identity", T.StringType()),
        T.StructField("content_hash", T.StringType()),
        T.StructField("seed", T.LongType()),
        T.StructField("as_of", T.TimestampType()),
        T.StructField("generator_revision", T.StringType()),
        T.StructField("status", T.StringType()),
        T.StructField("changed_step", T.LongType()),
    ]
)
