"""SQL twins of the validation, loading and audit jobs."""

from __future__ import annotations

from oracle.base import iso

ITEM = "'oms/order_items.csv' AS artifact, row_number, source_id"
ORDER = "'oms/orders.csv' AS artifact, k + 2 AS row_number, 'O' || k AS source_id"

PARTS = {
    "raw_order": """
        SELECT o_orderkey AS k, k % 103 = 0 AS naive, k % 127 = 0 AS infinite, k % 113 = 0 AS bad_status,
               k % 131 = 0 AS bad_place, k % 137 = 0 AND o_orderstatus = 'F' AS early FROM orders""",
    "good_order": "SELECT k FROM raw_order WHERE NOT (naive OR infinite OR bad_status OR bad_place OR early)",
    "order_rejections": f"""
        SELECT {ORDER}, 'NAIVE_TIMESTAMP' AS error_code, 'ordered_at' AS field, 'timestamp must include a timezone' AS message
        FROM raw_order WHERE naive
        UNION ALL SELECT {ORDER}, 'TYPE', 'ordered_at', 'must be a finite decimal' FROM raw_order WHERE infinite AND NOT naive
        UNION ALL SELECT {ORDER}, 'ENUM', 'status', 'unsupported value ''UNKNOWN''' FROM raw_order WHERE bad_status AND NOT naive AND NOT infinite
        UNION ALL SELECT {ORDER}, 'PARENT_SOURCE_ID', 'source_warehouse_id', 'unknown warehouses source ID W99'
        FROM raw_order WHERE bad_place AND NOT naive AND NOT infinite
        UNION ALL SELECT {ORDER}, 'TIMESTAMP_ORDER', 'fulfilled_at', 'fulfilled_at precedes ordered_at'
        FROM raw_order WHERE early AND NOT naive AND NOT infinite""",
    "raw_item": """
        SELECT l_orderkey * 10000000000 + CAST(line_number AS BIGINT) * 1000000000
                 + CAST(substr(source_product_id, 2) AS BIGINT) + copy * 500000000 AS row_number,
               source_order_item_id AS source_id, source_order_id, source_product_id, line_number, ordered_quantity,
               fulfilled_quantity, unit_price, l_orderkey % 97 = 0 AS blank,
               l_orderkey % 101 = 0 AND NOT l_orderkey % 97 = 0 AS negative,
               l_orderkey % 107 = 0 AS bad_product, l_orderkey % 139 = 0 AS bad_line, g.k IS NULL AS orphan
        FROM (SELECT *, 0 AS copy FROM t_items UNION ALL SELECT *, 1 FROM t_items WHERE l_orderkey % 13 = 0) i
        LEFT JOIN good_order g ON g.k = i.l_orderkey""",
    "good_item": """
        SELECT *, first_value(struct_pack(n := row_number, p := source_product_id, q := ordered_quantity, f := fulfilled_quantity, u := unit_price))
                    OVER (PARTITION BY source_id ORDER BY row_number) AS head
        FROM raw_item WHERE NOT (blank OR negative OR bad_product OR bad_line OR orphan)""",
    "decided_item": """
        SELECT *, CASE WHEN row_number = head.n THEN 'accepted'
                       WHEN source_product_id = head.p AND ordered_quantity = head.q AND fulfilled_quantity = head.f
                            AND unit_price = head.u THEN 'identical' ELSE 'conflict' END AS verdict
        FROM good_item""",
    "item_rejections": f"""
        SELECT {ITEM}, 'REQUIRED' AS error_code, 'ordered_quantity' AS field, 'required field is blank' AS message FROM raw_item WHERE blank
        UNION ALL SELECT {ITEM}, 'TYPE', 'line_number', 'invalid literal for int() with base 10: ''x1''' FROM raw_item WHERE bad_line
        UNION ALL SELECT {ITEM}, 'PARENT_SOURCE_ID', 'source_order_id', 'unknown orders source ID ' || source_order_id
        FROM raw_item WHERE orphan AND NOT bad_line
        UNION ALL SELECT {ITEM}, 'PARENT_SOURCE_ID', 'source_product_id', 'unknown products source ID P-none'
        FROM raw_item WHERE bad_product AND NOT bad_line
        UNION ALL SELECT {ITEM}, 'POSITIVE_QUANTITY', 'ordered_quantity', 'quantity must be positive'
        FROM raw_item WHERE negative AND NOT bad_line
        UNION ALL SELECT {ITEM}, 'QUANTITY_BOUNDS', 'fulfilled_quantity', 'fulfilled quantity exceeds ordered quantity'
        FROM raw_item WHERE negative AND NOT bad_line
        UNION ALL SELECT {ITEM}, 'DUPLICATE_CONFLICT', 'source_order_item_id', 'duplicate source ID has conflicting values'
        FROM decided_item WHERE verdict = 'conflict'""",
    "rejected": "SELECT * FROM order_rejections UNION ALL SELECT * FROM item_rejections",
    "order_outcome": """
        SELECT source_order_id, CASE WHEN o_orderkey % 4 = 3 THEN 'inserted' WHEN o_orderkey % 5 = 0 THEN 'SOURCE_ID_CONFLICT'
               ELSE 'skipped' END AS outcome FROM t_orders""",
    "numbered_stock": "SELECT *, CAST(substr(source_product_id, 2) AS BIGINT) AS k FROM t_inventory",
}


#: The columns of two artifacts.
_CONTRACT = {
    "oms/orders.csv": "source_order_id order_number status region source_warehouse_id ordered_at promised_at fulfilled_at total_amount currency",
    "wms/warehouses.csv": "source_warehouse_id code name region timezone",
}


def _listed() -> str:
    return ", ".join(f"('{artifact}', '{name}')" for artifact, names in _CONTRACT.items() for name in names.split())


def _twice(table: str, view: str, key: str, columns: str) -> str:
    return (
        f"SELECT '{table}' AS table_name, 'UNIQUE' AS kind, '{columns}' AS violated, {key} AS row_key, count(*) AS rows "
        f"FROM {view} GROUP BY {key} HAVING count(*) > 1"
    )


def _orphans(table: str, view: str, column: str, parent: str, parents: str, key: str) -> str:
    return (
        f"SELECT '{table}', 'REFERENCE', '{column} -> {parent}', {column}, count(*) FROM {view} "
        f"WHERE {column} NOT IN (SELECT {key} FROM {parents}) GROUP BY {column}"
    )


AUDIT = " UNION ALL ".join(
    [
        _twice("order_items", "t_items", "source_order_item_id", "source_order_item_id"),
        _twice("order_items", "t_items", "source_order_id || ':' || line_number", "source_order_id, line_number"),
        _twice("inventory_movements", "t_movements", "source_movement_id", "source_movement_id"),
        _twice("purchase_order_items", "t_purchase_order_items", "source_purchase_order_item_id", "source_purchase_order_item_id"),
        "SELECT 'shipments', 'CHECK', 'delivered_at >= shipped_at', source_shipment_id, 1 FROM t_shipments WHERE delivered_at < shipped_at",
        "SELECT 'orders', 'CHECK', 'fulfilled_at >= ordered_at', source_order_id, 1 FROM t_orders WHERE fulfilled_at < ordered_at",
        _orphans("order_items", "t_items", "source_product_id", "products", "t_products", "source_product_id"),
        _orphans("order_items", "t_items", "source_order_id", "orders", "t_orders", "source_order_id"),
        _orphans("purchase_orders", "t_purchase_orders", "source_supplier_id", "suppliers", "t_suppliers", "source_supplier_id"),
        _orphans("orders", "t_orders", "source_warehouse_id", "warehouses", "t_warehouses", "source_warehouse_id"),
        _orphans("inventory", "t_inventory", "source_product_id", "products", "t_products", "source_product_id"),
        _orphans("inventory", "t_inventory", "source_warehouse_id", "warehouses", "t_warehouses", "source_warehouse_id"),
        _orphans("inventory_movements", "t_movements", "source_product_id", "products", "t_products", "source_product_id"),
        _orphans("inventory_movements", "t_movements", "source_warehouse_id", "warehouses", "t_warehouses", "source_warehouse_id"),
        _orphans("purchase_orders", "t_purchase_orders", "source_warehouse_id", "warehouses", "t_warehouses", "source_warehouse_id"),
        _orphans(
            "purchase_order_items", "t_purchase_order_items", "source_purchase_order_id", "purchase_orders", "t_purchase_orders",
            "source_purchase_order_id",
        ),
        _orphans("purchase_order_items", "t_purchase_order_items", "source_product_id", "products", "t_products", "source_product_id"),
        _orphans("shipments", "t_shipments", "source_order_id", "orders", "t_orders", "source_order_id"),
    ]
)

FINALS = {
    "validate_rejections": "SELECT * FROM rejected",
    "validate_summary": """
        SELECT 'oms/products.csv' AS artifact, (SELECT count(*) FROM part) AS rows_read, (SELECT count(*) FROM part) AS accepted,
               CAST(0 AS BIGINT) AS rejected, CAST(0 AS BIGINT) AS duplicate_identical
        UNION ALL SELECT 'wms/warehouses.csv', (SELECT count(*) FROM nation), (SELECT count(*) FROM nation), 0, 0
        UNION ALL SELECT 'oms/orders.csv', (SELECT count(*) FROM raw_order), (SELECT count(*) FROM good_order),
                         (SELECT count(*) FROM order_rejections), 0
        UNION ALL SELECT 'oms/order_items.csv', (SELECT count(*) FROM raw_item), (SELECT count(*) FROM decided_item WHERE verdict = 'accepted'),
                         (SELECT count(*) FROM item_rejections), (SELECT count(*) FROM decided_item WHERE verdict = 'identical')""",
    "duplicate_conflicts": """
        SELECT 'wms/inventory_movements.csv' AS artifact, o_orderkey * 2 + 3 AS row_number, 'M' || o_orderkey AS source_id,
               'DUPLICATE_CONFLICT' AS error_code, 'source_movement_id' AS field, 'duplicate source ID has conflicting values' AS message
        FROM orders WHERE o_orderkey % 7 = 0""",
    "duplicate_counts": """
        SELECT count(*) + count(*) FILTER (o_orderkey % 7 < 2) AS rows_read, count(*) AS accepted,
               count(*) FILTER (o_orderkey % 7 = 1) AS duplicate_identical FROM orders""",
    "header_differences": f"""
        SELECT artifact, CAST(1 AS BIGINT) AS row_number, CAST(NULL AS VARCHAR) AS source_id,
               CASE WHEN d.name IS NULL THEN 'UNKNOWN_COLUMN' ELSE 'MISSING_COLUMN' END AS error_code, coalesce(d.name, s.name) AS field,
               CASE WHEN d.name IS NULL THEN 'column ''' || s.name || ''' is not declared for this artifact'
                    ELSE 'required contract column ''' || d.name || ''' is missing' END AS message
        FROM (SELECT * FROM (VALUES {_listed()}) AS v(artifact, name)) d
        FULL JOIN (SELECT CASE table_name WHEN 'orders' THEN 'oms/orders.csv' ELSE 'wms/warehouses.csv' END AS artifact, column_name AS name
                   FROM information_schema.columns WHERE table_name IN ('orders', 'nation')) s USING (artifact, name)
        WHERE d.name IS NULL OR s.name IS NULL""",
    "validated_items": """
        SELECT source_id AS source_order_item_id, source_order_id, source_product_id, line_number, ordered_quantity,
               fulfilled_quantity, unit_price FROM decided_item WHERE verdict = 'accepted'""",
    "preflight_outcomes": "SELECT * FROM order_outcome",
    "preflight_conflicts": """
        SELECT 'oms/orders.csv' AS artifact, CAST(1 AS BIGINT) AS row_number, source_order_id AS source_id, outcome AS error_code,
               'source_order_id' AS field, 'same source ID has conflicting persisted values' AS message
        FROM order_outcome WHERE outcome = 'SOURCE_ID_CONFLICT'""",
    "inventory_freshness": """
        SELECT source_product_id, source_warehouse_id,
               CASE WHEN k % 7 = 0 THEN 'inserted' WHEN k % 3 = 2 THEN 'updated' WHEN k % 3 = 0 THEN 'STALE_INVENTORY'
                    WHEN k % 5 = 0 THEN 'INVENTORY_CONFLICT' ELSE 'skipped' END AS outcome
        FROM numbered_stock""",
    "inventory_after_load": f"""
        SELECT source_product_id, source_warehouse_id,
               CAST(CASE WHEN k % 6 = 0 OR k % 4 = 0 THEN on_hand + 1 ELSE on_hand END AS DECIMAL(18,3)) AS on_hand,
               {iso('CASE WHEN k % 4 = 0 THEN observed_at + INTERVAL 1 DAY ELSE observed_at END', 'Z')} AS observed_at
        FROM numbered_stock""",
    "constraint_audit": AUDIT,
    "ingest_counters": """
        SELECT attempt, artifact, CAST(42 AS BIGINT) AS seed, '1998-07-01T00:00:00+00:00' AS as_of, attempt <> 'miscounted' AS committed, n AS rows_read, n AS accepted,
               CAST(attempt = 'miscounted' AND artifact = 'erp/suppliers.csv' AS BIGINT) AS rejected, CASE WHEN attempt = 'loaded' THEN n ELSE 0 END AS inserted,
               CAST(0 AS BIGINT) AS updated, CAST(0 AS BIGINT) AS skipped, CAST(0 AS BIGINT) AS conflicted, CASE WHEN attempt <> 'miscounted' THEN n ELSE 0 END AS final_count
        FROM (VALUES ('miscounted'), ('loaded')) AS a(attempt), (
            WITH o AS (SELECT * FROM t_orders WHERE (fulfilled_at IS NULL OR fulfilled_at >= ordered_at)
                                                AND source_warehouse_id IN (SELECT source_warehouse_id FROM t_warehouses)),
                 po AS (SELECT * FROM t_purchase_orders WHERE source_supplier_id IN (SELECT source_supplier_id FROM t_suppliers)),
                 p AS (SELECT source_product_id FROM t_products), w AS (SELECT source_warehouse_id FROM t_warehouses)
            SELECT 'oms/products.csv' AS artifact, count(*) AS n FROM t_products
            UNION ALL SELECT 'wms/warehouses.csv', count(*) FROM t_warehouses
            UNION ALL SELECT 'erp/suppliers.csv', count(*) FROM t_suppliers
            UNION ALL SELECT 'oms/orders.csv', count(*) FROM o
            UNION ALL SELECT 'oms/order_items.csv', count(*) FROM (SELECT source_order_id, any_value(source_product_id) AS product FROM t_items
                             GROUP BY source_order_id, line_number HAVING count(*) = 1)
                      WHERE source_order_id IN (SELECT source_order_id FROM o) AND product IN (FROM p)
            UNION ALL SELECT 'wms/inventory.csv', count(*) FROM t_inventory WHERE reserved <= on_hand AND source_product_id IN (FROM p) AND source_warehouse_id IN (FROM w)
            UNION ALL SELECT 'wms/inventory_movements.csv', count(*) FROM (SELECT any_value(source_product_id) AS product, any_value(source_warehouse_id) AS place
                             FROM t_movements GROUP BY source_movement_id HAVING count(*) = 1) WHERE product IN (FROM p) AND place IN (FROM w)
            UNION ALL SELECT 'erp/purchase_orders.csv', count(*) FROM po
            UNION ALL SELECT 'erp/purchase_order_items.csv', count(*) FROM (SELECT any_value(source_product_id) AS product, any_value(source_purchase_order_id) AS parent
                             FROM t_purchase_order_items GROUP BY source_purchase_order_item_id HAVING count(*) = 1)
                      WHERE product IN (FROM p) AND parent IN (SELECT source_purchase_order_id FROM po)
            UNION ALL SELECT 'carrier/shipments.csv', count(*) FROM t_shipments
                      WHERE (delivered_at IS NULL OR delivered_at >= shipped_at) AND source_order_id IN (SELECT source_order_id FROM o)) AS c""",
    "constraint_audit_state": """
        SELECT * FROM (WITH s AS (SELECT *, substr(deduplication_key, 1, 1) AS digit FROM first_state)
        SELECT 'exceptions' AS table_name, 'CHECK' AS kind, 'orders_affected >= 0' AS violated, id AS row_key, CAST(1 AS BIGINT) AS rows FROM s WHERE digit = '1'
        UNION ALL SELECT 'exceptions', 'CHECK', 'status IN (''OPEN'', ''ACKNOWLEDGED'', ''IN_PROGRESS'', ''RESOLVED'', ''DISMISSED'')', id, 1 FROM s WHERE digit = '2'
        UNION ALL SELECT 'exceptions', 'UNIQUE', 'deduplication_key', deduplication_key, 2 FROM s WHERE digit = '0'
        UNION ALL SELECT 'exceptions', 'UNIQUE', 'exception_type, issue_key while active', exception_type || ':' || issue_key, 2 FROM s WHERE digit = '0'
        UNION ALL SELECT 'exceptions', 'REFERENCE', 'source_warehouse_id -> warehouses', 'gone-' || source_warehouse_id, count(*) FROM s
                  WHERE digit = '4' AND source_warehouse_id IS NOT NULL GROUP BY source_warehouse_id
        UNION ALL SELECT 'exceptions', 'REFERENCE', 'source_product_id -> products', source_product_id, count(*) + count(*) FILTER (digit = '0') FROM s
                  WHERE source_product_id NOT IN (SELECT 'P' || p_partkey FROM part) GROUP BY source_product_id
        UNION ALL SELECT 'exception_history', 'REFERENCE', 'exception_id -> exceptions', 'gone-' || id, 1 FROM s WHERE id LIKE '3%'
        UNION ALL SELECT 'order_observations', 'CHECK', 'total_amount >= 0', '', 1 FROM orders, (VALUES (1), (2), (3), (4)) AS v(kind)
                  WHERE (o_orderkey * 10 + kind) % 70 = 1 AND o_totalprice > 0
        UNION ALL SELECT 'order_observations', 'UNIQUE', 'observation_id', '', 2 FROM orders, (VALUES (1), (2), (3), (4)) AS v(kind) WHERE (o_orderkey * 10 + kind) % 110 = 2
        UNION ALL SELECT 'order_observations', 'REFERENCE', 'superseded_by -> order_observations', 'nothing', count(*)
                  FROM orders, (VALUES (1), (2), (3), (4)) AS v(kind) WHERE (o_orderkey * 10 + kind) % 130 = 3 HAVING count(*) > 0
        UNION ALL SELECT 'order_observations', 'REFERENCE', 'source_namespace, source_order_id -> source_order_identities', 'numbers:A' || o_orderkey,
                  2 + CAST((o_orderkey * 10 + 2) % 110 = 2 AS BIGINT) FROM orders WHERE o_orderkey % 100 = 0 AND o_orderkey > 0
        UNION ALL SELECT 'promoted_orders', 'UNIQUE', 'source_namespace, order_number', 'held:same', count(*) FROM orders WHERE o_orderkey % 10 = 7 HAVING count(*) > 1
        UNION ALL SELECT DISTINCT 'dataset_versions', 'CHECK', 'status IN (''STAGED'', ''READY'', ''ACTIVE'', ''RETIRED'')', strftime(o_orderdate, '%Y%m'), CAST(1 AS BIGINT)
                  FROM orders WHERE month(o_orderdate) = 5
        UNION ALL SELECT 'promoted_orders', 'REFERENCE', 'current_observation -> order_observations', 'before-' || o_orderkey, 1 FROM orders
        UNION ALL SELECT 'promoted_orders', 'REFERENCE', 'source_namespace, source_order_id -> source_order_identities', 'held:H' || o_orderkey, 1 FROM orders)""",
    "append_only_audit": """
        SELECT exception_id, to_status, actor FROM history WHERE entry = 0 AND (exception_id LIKE 'a%' OR exception_id LIKE 'b%')""",
}
