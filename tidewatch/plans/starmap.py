"""Operational tables derived from the star-schema test data.

Each table is a projection (or one aggregation) of a source table, so filters and column pruning
reach the Parquet scan.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession

AS_OF = datetime(1998, 7, 1, tzinfo=timezone.utc)
#: Shared SQL fragments.
ORDER_STATUS = (
    "CASE WHEN o_orderstatus = 'F' THEN 'FULFILLED' "
    "WHEN o_orderstatus = 'P' AND o_orderkey % 10 = 0 THEN 'CANCELLED' ELSE 'OPEN' END"
)
PLACED = "CAST(o_orderdate AS TIMESTAMP)"
PROMISED = f"{PLACED} + make_dt_interval(CAST(20 + o_orderkey % 60 AS INT))"
FULFILLED = f"CASE WHEN o_orderstatus = 'F' THEN {PLACED} + make_dt_interval(CAST(10 + o_orderkey % 80 AS INT)) END"
QUANTITY = "CAST(l_quantity AS DECIMAL(18,3))"
DONE = "l_linestatus = 'F'"


def read(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def products(spark: SparkSession, folder: str) -> DataFrame:
    return read(spark, folder, "part").selectExpr(
        "concat('P', p_partkey) AS source_product_id",
        "concat('SKU-', p_partkey) AS sku",
        "p_name AS name",
        "CAST(NULL AS STRING) AS description",
        "CAST(p_retailprice AS DECIMAL(14,2)) AS unit_price",
        "true AS active",
    )


def warehouses(spark: SparkSession, folder: str) -> DataFrame:
    nation, region = read(spark, folder, "nation"), read(spark, folder, "region")
    return nation.join(region, nation["n_regionkey"] == region["r_regionkey"]).selectExpr(
        "concat('W', n_nationkey) AS source_warehouse_id",
        "concat('WH-', n_nationkey) AS code",
        "n_name AS name",
        "r_name AS region",
        "'UTC' AS timezone",
    )


def suppliers(spark: SparkSession, folder: str) -> DataFrame:
    return read(spark, folder, "supplier").selectExpr(
        "concat('SUP', s_suppkey) AS source_supplier_id",
        "concat('SC-', s_suppkey) AS code",
        "s_name AS name",
        "concat('REGION_', s_nationkey % 5) AS region",
        "true AS active",
    )


def orders(spark: SparkSession, folder: str) -> DataFrame:
    return read(spark, folder, "orders").selectExpr(
        "concat('O', o_orderkey) AS source_order_id",
        "concat('ORD-', o_orderkey) AS order_number",
        f"{ORDER_STATUS} AS status",
        "concat('REGION_', o_custkey % 25 % 5) AS region",
        "concat('W', o_custkey % 25) AS source_warehouse_id",
        f"{PLACED} AS ordered_at",
        f"{PROMISED} AS promised_at",
        f"{FULFILLED} AS fulfilled_at",
        "CAST(o_totalprice AS DECIMAL(14,2)) AS total_amount",
        "'USD' AS currency",
    )


def order_items(spark: SparkSession, folder: str) -> DataFrame:
    return read(spark, folder, "lineitem").selectExpr(
        "concat('I', l_orderkey, '-', l_linenumber) AS source_order_item_id",
        "concat('O', l_orderkey) AS source_order_id",
        "concat('P', l_partkey) AS source_product_id",
        "l_linenumber AS line_number",
        f"{QUANTITY} AS ordered_quantity",
        f"CASE WHEN {DONE} THEN {QUANTITY} WHEN l_returnflag = 'N' THEN CAST(floor(l_quantity / 2) AS DECIMAL(18,3)) "
        "ELSE CAST(0 AS DECIMAL(18,3)) END AS fulfilled_quantity",
        # The price modulo 40, in whole cents: a remainder of decimals costs several times the scan.
        "CAST(CAST(round(l_extendedprice * 100) AS BIGINT) % 4000 / 100.0D AS DECIMAL(14,2)) AS unit_price",
    )


def inventory_movements(spark: SparkSession, folder: str) -> DataFrame:
    return read(spark, folder, "lineitem").selectExpr(
        "concat('M', l_orderkey, '-', l_linenumber, '-', l_partkey) AS source_movement_id",
        "concat('P', l_partkey) AS source_product_id",
        "concat('W', l_suppkey % 25) AS source_warehouse_id",
        "CASE l_linenumber WHEN 4 THEN 'SHIPMENT' WHEN 5 THEN 'RESERVATION' WHEN 6 THEN 'TRANSFER_IN' "
        "WHEN 7 THEN 'ADJUSTMENT_OUT' ELSE 'RECEIPT' END AS movement_type",
        f"{QUANTITY} AS quantity",
        "CAST(l_shipdate AS TIMESTAMP) AS occurred_at",
        "'ORDER' AS reference_type",
        "concat('O', l_orderkey) AS reference_id",
    )


def inventory(spark: SparkSession, folder: str) -> DataFrame:
    """One snapshot per product and warehouse: receipts on hand, reservations held."""
    return (
        inventory_movements(spark, folder)
        .selectExpr(
            "source_product_id",
            "source_warehouse_id",
            "CASE WHEN movement_type = 'RECEIPT' THEN quantity ELSE CAST(0 AS DECIMAL(18,3)) END AS received",
            "CASE WHEN movement_type = 'RESERVATION' THEN quantity ELSE CAST(0 AS DECIMAL(18,3)) END AS held",
            "occurred_at",
        )
        .groupBy("source_product_id", "source_warehouse_id")
        .agg({"received": "sum", "held": "sum", "occurred_at": "max"})
        .selectExpr(
            "source_product_id",
            "source_warehouse_id",
            "CAST(`sum(received)` AS DECIMAL(18,3)) AS on_hand",
            "CAST(`sum(held)` AS DECIMAL(18,3)) AS reserved",
            "least(`max(occurred_at)`, TIMESTAMP '1998-07-01 00:00:00+00:00') AS observed_at",
        )
    )


def purchase_orders(spark: SparkSession, folder: str) -> DataFrame:
    """One purchase order per supplier and month of shipping."""
    start = "CAST(month AS TIMESTAMP)"
    return (
        read(spark, folder, "lineitem")
        .selectExpr("l_suppkey", "trunc(l_shipdate, 'month') AS month", f"CAST({DONE} AS INT) AS done", f"CAST({DONE} AS INT) AS any_done")
        .groupBy("l_suppkey", "month")
        .agg({"done": "min", "any_done": "max"})
        .selectExpr(
            "concat('PO', l_suppkey, '-', date_format(month, 'yyyyMM')) AS source_purchase_order_id",
            "concat('PON-', l_suppkey, '-', date_format(month, 'yyyyMM')) AS po_number",
            "concat('SUP', l_suppkey) AS source_supplier_id",
            "concat('W', l_suppkey % 25) AS source_warehouse_id",
            "CASE WHEN l_suppkey % 10 = 0 THEN 'CANCELLED' WHEN `min(done)` = 1 THEN 'RECEIVED' "
            "WHEN `max(any_done)` = 1 THEN 'PARTIALLY_RECEIVED' ELSE 'OPEN' END AS status",
            f"{start} AS ordered_at",
            f"{start} + INTERVAL '45' DAY AS expected_delivery_at",
            f"CASE WHEN l_suppkey % 10 <> 0 AND `min(done)` = 1 THEN {start} + INTERVAL '40' DAY END AS received_at",
        )
    )


def purchase_order_items(spark: SparkSession, folder: str) -> DataFrame:
    return read(spark, folder, "lineitem").selectExpr(
        "concat('POI', l_orderkey, '-', l_linenumber, '-', l_partkey) AS source_purchase_order_item_id",
        "concat('PO', l_suppkey, '-', date_format(l_shipdate, 'yyyyMM')) AS source_purchase_order_id",
        "concat('P', l_partkey) AS source_product_id",
        f"{QUANTITY} AS ordered_quantity",
        f"CASE WHEN {DONE} THEN {QUANTITY} ELSE CAST(0 AS DECIMAL(18,3)) END AS received_quantity",
        "CAST(CAST(round(l_extendedprice * 100) AS BIGINT) % 2500 / 100.0D AS DECIMAL(14,2)) AS unit_cost",
    )


def shipments(spark: SparkSession, folder: str) -> DataFrame:
    """One shipment per order."""
    return (
        read(spark, folder, "orders")
        .selectExpr(
            "concat('S', o_orderkey) AS source_shipment_id",
            "concat('O', o_orderkey) AS source_order_id",
            "CASE o_orderkey % 4 WHEN 0 THEN 'SEA' WHEN 1 THEN 'AIR' WHEN 2 THEN 'RAIL' ELSE 'ROAD' END AS carrier",
            "concat('TRK-', o_orderkey) AS tracking_id",
            "CASE WHEN o_orderstatus = 'F' THEN 'DELIVERED' WHEN o_orderkey % 8 = 0 THEN 'EXCEPTION' "
            "ELSE 'IN_TRANSIT' END AS status",
            f"{PLACED} + INTERVAL '2' DAY AS shipped_at",
            f"{PROMISED} AS eta",
            f"{FULFILLED} AS delivered_at",
        )
    )


BUILDERS: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "products": products,
    "warehouses": warehouses,
    "suppliers": suppliers,
    "orders": orders,
    "order_items": order_items,
    "inventory": inventory,
    "inventory_movements": inventory_movements,
    "purchase_orders": purchase_orders,
    "purchase_order_items": purchase_order_items,
    "shipments": shipments,
}


class StarTables(dict[str, DataFrame]):
    """The tables by name, each defined when it is first asked for."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        super().__init__()
        self._source = (spark, folder)

    def __missing__(self, name: str) -> DataFrame:
        self[name] = BUILDERS[name](*self._source)
        return self[name]

    def __contains__(self, name: object) -> bool:
        """Whether there is such a table, asked for before or not."""
        return name in BUILDERS or super().__contains__(name)


def tables(spark: SparkSession, folder: str) -> StarTables:
    return StarTables(spark, folder)
