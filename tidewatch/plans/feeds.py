"""Raw order observations derived from the star-schema orders, with faults planted by key."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidewatch.functions.text import iso_offset
from tidewatch.plans import starmap


def raw_observations(spark: SparkSession, folder: str) -> DataFrame:
    """Every order once; a second revision of some, changed content under the same version for
    others, exact replays in another batch, and rows that lack or garble facts."""
    orders = starmap.orders(spark, folder)
    base = orders.selectExpr(
        "CAST(substr(source_order_id, 2) AS BIGINT) AS k", "source_order_id AS order_id", "order_number",
        "CASE status WHEN 'FULFILLED' THEN 'delivered' WHEN 'CANCELLED' THEN ' canceled ' ELSE 'open' END AS order_status",
        "region", "source_warehouse_id AS warehouse_id",
        f"{iso_offset('ordered_at')} AS ordered_at", f"{iso_offset('promised_at')} AS promised_at",
        f"{iso_offset('fulfilled_at')} AS fulfilled_at", "total_amount", "'usd' AS currency",
    )

    def rows(kind: int, keep: str, version: str, amount: str, batch: str) -> DataFrame:
        return base.where(keep).selectExpr(
            f"k * 10 + {kind} AS sequence", f"'{batch}' AS batch_id", "concat('ns', k % 3) AS source_namespace",
            f"{version} AS source_version", "order_id", "order_number", "order_status", "region",
            "CASE WHEN k % 17 = 0 THEN 'W404' WHEN k % 23 = 0 THEN ' ' ELSE warehouse_id END AS warehouse_id",
            "CASE WHEN k % 29 = 0 THEN substr(ordered_at, 1, 19) ELSE ordered_at END AS ordered_at",
            "promised_at", "fulfilled_at",
            f"CASE WHEN k % 19 = 0 THEN 'abc' WHEN k % 37 = 0 THEN '-5' ELSE CAST({amount} AS STRING) END AS total_amount",
            "CASE WHEN k % 13 = 0 THEN NULL ELSE currency END AS currency",
        )

    version = "CASE WHEN k % 2 = 0 THEN '1' END"
    parts = [
        rows(0, "true", version, "total_amount", "b1"),
        rows(1, "k % 5 = 0", "'2'", "total_amount + 10", "b2"),
        rows(2, "k % 7 = 0", version, "total_amount + 20", "b2"),
        rows(3, "k % 11 = 0", version, "total_amount", "b3"),
    ]
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result


def number_claims(spark: SparkSession, folder: str) -> DataFrame:
    """For every order four observations: a second revision, an older one under another number, another
    order that takes that number, and one that claims the number the first holds."""
    base = starmap.orders(spark, folder).selectExpr("CAST(substr(source_order_id, 2) AS BIGINT) AS k", "*")

    def rows(kind: int, order: str, version: str, number: str) -> DataFrame:
        return base.selectExpr(
            f"k * 10 + {kind} AS sequence", "'b1' AS batch_id", "'numbers' AS source_namespace", f"'{version}' AS source_version",
            f"concat('{order}', k) AS order_id", f"concat('{number}', k) AS order_number", "'open' AS order_status", "region",
            "source_warehouse_id AS warehouse_id", f"{iso_offset('ordered_at')} AS ordered_at", f"{iso_offset('promised_at')} AS promised_at",
            "CAST(NULL AS STRING) AS fulfilled_at", "CAST(total_amount AS STRING) AS total_amount", "'usd' AS currency",
        )

    parts = rows(1, "A", "2", "N"), rows(2, "A", "1", "X"), rows(3, "B", "1", "X"), rows(4, "C", "1", "N")
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(parts[3])


#: kind -> remainder of the order's key by 5, whose observation it is, its version, its number, what is added to the amount.
HELD_KINDS = {
    1: (0, "H", "4", "N", 0), 2: (1, "H", "4", "N", 5), 3: (2, "E", "1", "N", 0), 4: (2, "H", "5", "M", 5), 5: (2, "T", "1", "N", 0),
    6: (3, "H", "3", "N", 5), 7: (4, "H", "5", "N", 5), 8: (4, "H", "4", "N", 0), 9: (4, "H", "x", "N", 7),
}


def held_orders(spark: SparkSession, folder: str) -> DataFrame:
    """Every order as version 4 under its number, as an earlier batch left it."""
    return starmap.orders(spark, folder).selectExpr(
        "'held' AS source_namespace", "concat('H', substr(source_order_id, 2)) AS source_order_id", "concat('N', substr(source_order_id, 2)) AS order_number",
        "'OPEN' AS order_status", "region", "source_warehouse_id", "ordered_at", "promised_at", "CAST(NULL AS TIMESTAMP) AS fulfilled_at",
        "CAST(total_amount AS DECIMAL(14,2)) AS total_amount", "'USD' AS currency", "'4' AS projected_version",
        "concat('before-', substr(source_order_id, 2)) AS current_observation",
    )


def meeting_held_orders(spark: SparkSession, folder: str) -> DataFrame:
    """Observations of the held orders: the same again, the same version with other content, a newer one that gives
    up its number between one order that claims it too early and one that claims it later, an older one, a newer
    one before the held version again and a version that has no order.
    """
    base = starmap.orders(spark, folder).selectExpr("CAST(substr(source_order_id, 2) AS BIGINT) AS k", "*")
    result = None
    for kind, (remainder, order, version, number, more) in HELD_KINDS.items():
        rows = base.where(f"k % 5 = {remainder}").selectExpr(
            f"k * 10 + {kind} AS sequence", "'b2' AS batch_id", "'held' AS source_namespace", f"'{version}' AS source_version",
            f"concat('{order}', k) AS order_id", f"concat('{number}', k) AS order_number", "'open' AS order_status", "region",
            "source_warehouse_id AS warehouse_id", f"{iso_offset('ordered_at')} AS ordered_at", f"{iso_offset('promised_at')} AS promised_at",
            "CAST(NULL AS STRING) AS fulfilled_at", f"CAST(total_amount + {more} AS STRING) AS total_amount", "'usd' AS currency",
        )
        result = rows if result is None else result.unionByName(rows)
    return result


def no_orders(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(
        [],
        "source_namespace STRING, source_order_id STRING, order_number STRING, order_status STRING, region STRING, "
        "source_warehouse_id STRING, ordered_at TIMESTAMP, promised_at TIMESTAMP, fulfilled_at TIMESTAMP, "
        "total_amount DECIMAL(14,2), currency STRING, projected_version STRING, current_observation STRING",
    )
