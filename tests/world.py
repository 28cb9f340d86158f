"""A small operational world in which each rule fires exactly once."""

from __future__ import annotations

from datetime import datetime, timedelta, timezone
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession

from tidewatch.schema import BY_TABLE

AS_OF = datetime(2025, 1, 15, 12, tzinfo=timezone.utc)


def at(**delta: float) -> datetime:
    return (AS_OF + timedelta(**delta)).replace(tzinfo=None)


def table(spark: SparkSession, name: str, rows: list[dict]) -> DataFrame:
    schema = BY_TABLE[name].stored_schema()
    return spark.createDataFrame([tuple(row.get(f.name) for f in schema) for row in rows], schema)


def rows() -> dict[str, list[dict]]:
    d = Decimal
    return {
        "products": [
            dict(source_product_id="P1", sku="S1", name="One", unit_price=d("10.00"), active=True),
            dict(source_product_id="P2", sku="S2", name="Two", unit_price=d("20.00"), active=True),
        ],
        "warehouses": [dict(source_warehouse_id="W1", code="C1", name="Main", region="North", timezone="UTC")],
        "suppliers": [dict(source_supplier_id="SUP1", code="SC1", name="Acme", region="North", active=True)],
        "orders": [
            dict(source_order_id="O1", order_number="N1", status="OPEN", region="North", source_warehouse_id="W1",
                 ordered_at=at(days=-2), promised_at=at(hours=-1), total_amount=d("100.00"), currency="USD")
        ],
        "order_items": [
            dict(source_order_item_id="I1", source_order_id="O1", source_product_id="P1", line_number=1,
                 ordered_quantity=d("10.000"), fulfilled_quantity=d("0.000"), unit_price=d("10.00"))
        ],
        "inventory": [
            dict(source_product_id="P1", source_warehouse_id="W1", on_hand=d("2.000"), reserved=d("0.000"), observed_at=at(hours=-2))
        ],
        "inventory_movements": [
            dict(source_movement_id="M1", source_product_id="P1", source_warehouse_id="W1", movement_type="RECEIPT",
                 quantity=d("8.000"), occurred_at=at(days=-1))
        ],
        "purchase_orders": [
            dict(source_purchase_order_id="PO1", po_number="PN1", source_supplier_id="SUP1", source_warehouse_id="W1",
                 status="OPEN", ordered_at=at(days=-5), expected_delivery_at=at(days=-1))
        ],
        "purchase_order_items": [
            dict(source_purchase_order_item_id="PI1", source_purchase_order_id="PO1", source_product_id="P2",
                 ordered_quantity=d("5.000"), received_quantity=d("0.000"), unit_cost=d("3.00"))
        ],
        "shipments": [
            dict(source_shipment_id="S1", source_order_id="O1", carrier="SEA", tracking_id="T1", status="IN_TRANSIT",
                 shipped_at=at(days=-1), eta=at(hours=-1))
        ],
    }


def tables(spark: SparkSession, **changes: list[dict]) -> dict[str, DataFrame]:
    return {name: table(spark, name, content) for name, content in (rows() | changes).items()}


def changed(name: str, **values: object) -> dict[str, list[dict]]:
    """The world's rows of one table, the first with new values."""
    content = rows()[name]
    return {name: [content[0] | values, *content[1:]]}
