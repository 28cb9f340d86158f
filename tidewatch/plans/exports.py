"""External-looking order exports and dataset versions derived from the star-schema tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.operators.versions import Control, with_identity
from tidewatch.plans.starmap import read
from tidewatch.schema import DATASET_VERSIONS


def olist_tables(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    orders = read(spark, folder, "orders").selectExpr(
        "o_orderkey + 2 AS row_number",
        "concat('E', o_orderkey) AS order_id",
        "concat('C', o_custkey) AS customer_id",
        "CASE WHEN o_orderstatus = 'F' THEN 'Delivered' WHEN o_orderkey % 10 = 0 THEN 'canceled' ELSE 'shipped' END AS order_status",
        "date_format(o_orderdate, 'yyyy-MM-dd HH:mm:ss') AS order_purchase_timestamp",
        "CASE WHEN o_orderkey % 31 = 0 THEN 'soon' ELSE date_format(o_orderdate + INTERVAL '40' DAY, 'yyyy-MM-dd') END AS order_estimated_delivery_date",
        "CASE WHEN o_orderstatus = 'F' THEN date_format(o_orderdate + make_dt_interval(CAST(10 + o_orderkey % 80 AS INT)), 'yyyy-MM-dd HH:mm:ss') END AS order_delivered_customer_date",
    )
    payments = read(spark, folder, "lineitem").selectExpr(
        "l_orderkey * 10 + l_linenumber + 2 AS row_number",
        "concat('E', l_orderkey) AS order_id",
        "CASE WHEN l_linenumber = 7 THEN 'n/a' ELSE CAST(CAST(l_extendedprice AS DECIMAL(14,2)) AS STRING) END AS payment_value",
    )
    customer, nation = read(spark, folder, "customer"), read(spark, folder, "nation")
    homes = customer.join(nation, customer["c_nationkey"] == nation["n_nationkey"])
    customers = homes.selectExpr("c_custkey + 2 AS row_number", "concat('C', c_custkey) AS customer_id", "concat(' ', n_name) AS customer_state")
    again = homes.where("c_custkey % 10 = 0").selectExpr(
        "c_custkey + 1000000000 AS row_number", "concat('C', c_custkey) AS customer_id", "'LATE' AS customer_state"
    )
    return {"orders": orders, "payments": payments, "customers": customers.unionByName(again)}


def dataco_tables(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    lines, orders = read(spark, folder, "lineitem"), read(spark, folder, "orders")
    rows = lines.join(orders, lines["l_orderkey"] == orders["o_orderkey"]).selectExpr(
        "l_orderkey * 10 + l_linenumber + 2 AS row_number",
        "CASE WHEN l_orderkey % 41 = 0 THEN ' ' ELSE concat('D', l_orderkey) END AS `Order Id`",
        "CASE WHEN o_orderstatus = 'F' THEN 'COMPLETE' WHEN o_orderkey % 10 = 0 THEN 'SUSPECTED_CANCELED' ELSE 'PENDING' END AS `Order Status`",
        "CASE WHEN l_linenumber = 3 THEN 'Delivered late' ELSE 'Shipping on time' END AS `Delivery Status`",
        "concat('Region ', o_custkey % 7) AS `Order Region`",
        "date_format(o_orderdate, 'M/d/yyyy H:mm') AS `order date (DateOrders)`",
        "CASE WHEN l_linenumber % 2 = 0 THEN CAST(CAST(l_extendedprice AS DECIMAL(14,2)) AS STRING) ELSE '' END AS `Order Item Total`",
        "CAST(CAST(l_quantity AS DECIMAL(18,3)) AS STRING) AS Sales",
    )
    return {"orders": rows}


def monthly_versions(spark: SparkSession, folder: str) -> Control:
    """One READY dataset version per month of orders, its content hash taken from the month."""
    months = (
        read(spark, folder, "orders")
        .groupBy(F.expr("trunc(o_orderdate, 'month')").alias("month"))
        .agg(F.expr("count(1) AS orders"), F.expr("CAST(sum(CAST(o_totalprice AS DECIMAL(14,2))) AS DECIMAL(38,2)) AS total"))
    )
    rows = months.selectExpr(
        "CAST(date_format(month, 'yyyyMM') AS BIGINT) AS dataset_version_id",
        "concat('D', month(month) % 2) AS dataset_key",
        "concat('m', date_format(month, 'yyyyMM')) AS manifest_identity",
        "sha2(concat(orders, '|', total), 256) AS content_hash",
        "orders AS seed", "CAST(month AS TIMESTAMP) AS as_of", "'r1' AS generator_revision", "'READY' AS status", "0L AS changed_step",
    )
    return Control(with_identity(rows).select(*DATASET_VERSIONS.fieldNames()))
