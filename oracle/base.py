"""ANSI SQL building blocks: the operational tables and the six rules, for DuckDB."""

from __future__ import annotations

import re

AS_OF = "TIMESTAMP '1998-07-01 00:00:00'"


def iso(ts: str, zone: str = "+00:00") -> str:
    return f"strftime({ts}, '%Y-%m-%dT%H:%M:%S') || '{zone}'"


def fact(number: str) -> str:
    return f"CASE WHEN {number} = 0 THEN '0' ELSE CAST({number} AS VARCHAR) END"


TABLES = {
    "t_products": """
        SELECT 'P' || p_partkey AS source_product_id, 'SKU-' || p_partkey AS sku, p_name AS name,
               CAST(p_retailprice AS DECIMAL(14,2)) AS unit_price
        FROM part""",
    "t_warehouses": """
        SELECT 'W' || n_nationkey AS source_warehouse_id, 'WH-' || n_nationkey AS code,
               n_name AS name, r_name AS region
        FROM nation JOIN region ON n_regionkey = r_regionkey""",
    "t_suppliers": """
        SELECT 'SUP' || s_suppkey AS source_supplier_id, 'SC-' || s_suppkey AS code, s_name AS name
        FROM supplier""",
    "t_orders": """
        SELECT o_orderkey, 'O' || o_orderkey AS source_order_id, 'ORD-' || o_orderkey AS order_number,
               CASE WHEN o_orderstatus = 'F' THEN 'FULFILLED'
                    WHEN o_orderstatus = 'P' AND o_orderkey % 10 = 0 THEN 'CANCELLED'
                    ELSE 'OPEN' END AS status,
               'REGION_' || (o_custkey % 25 % 5) AS region,
               'W' || (o_custkey % 25) AS source_warehouse_id,
               o_orderdate AS ordered_at,
               o_orderdate + to_days(CAST(20 + o_orderkey % 60 AS INTEGER)) AS promised_at,
               CASE WHEN o_orderstatus = 'F'
                    THEN o_orderdate + to_days(CAST(10 + o_orderkey % 80 AS INTEGER)) END AS fulfilled_at,
               CAST(o_totalprice AS DECIMAL(14,2)) AS total_amount, 'USD' AS currency
        FROM orders""",
    "t_items": """
        SELECT l_orderkey, 'I' || l_orderkey || '-' || l_linenumber AS source_order_item_id,
               'O' || l_orderkey AS source_order_id, 'P' || l_partkey AS source_product_id,
               l_linenumber AS line_number,
               CAST(l_quantity AS DECIMAL(18,3)) AS ordered_quantity,
               CASE WHEN l_linestatus = 'F' THEN CAST(l_quantity AS DECIMAL(18,3))
                    WHEN l_returnflag = 'N' THEN CAST(floor(l_quantity / 2) AS DECIMAL(18,3))
                    ELSE CAST(0 AS DECIMAL(18,3)) END AS fulfilled_quantity,
               CAST(CAST(l_extendedprice AS DECIMAL(14,2)) % 40 AS DECIMAL(14,2)) AS unit_price
        FROM lineitem""",
    "t_movements": """
        SELECT 'M' || l_orderkey || '-' || l_linenumber || '-' || l_partkey AS source_movement_id,
               'P' || l_partkey AS source_product_id, 'W' || (l_suppkey % 25) AS source_warehouse_id,
               CASE l_linenumber WHEN 4 THEN 'SHIPMENT' WHEN 5 THEN 'RESERVATION'
                    WHEN 6 THEN 'TRANSFER_IN' WHEN 7 THEN 'ADJUSTMENT_OUT' ELSE 'RECEIPT' END AS movement_type,
               CAST(l_quantity AS DECIMAL(18,3)) AS quantity, l_shipdate AS occurred_at
        FROM lineitem""",
    "t_inventory": f"""
        SELECT source_product_id, source_warehouse_id,
               CAST(sum(CASE WHEN movement_type = 'RECEIPT' THEN quantity ELSE 0 END) AS DECIMAL(18,3)) AS on_hand,
               CAST(sum(CASE WHEN movement_type = 'RESERVATION' THEN quantity ELSE 0 END) AS DECIMAL(18,3)) AS reserved,
               least(max(occurred_at), {AS_OF}) AS observed_at
        FROM t_movements GROUP BY 1, 2""",
    "t_purchase_orders": """
        SELECT 'PO' || l_suppkey || '-' || strftime(month, '%Y%m') AS source_purchase_order_id,
               'PON-' || l_suppkey || '-' || strftime(month, '%Y%m') AS po_number,
               'SUP' || l_suppkey AS source_supplier_id, 'W' || (l_suppkey % 25) AS source_warehouse_id,
               CASE WHEN l_suppkey % 10 = 0 THEN 'CANCELLED' WHEN all_done THEN 'RECEIVED'
                    WHEN some_done THEN 'PARTIALLY_RECEIVED' ELSE 'OPEN' END AS status,
               month AS ordered_at, month + to_days(45) AS expected_delivery_at,
               CASE WHEN l_suppkey % 10 <> 0 AND all_done THEN month + to_days(40) END AS received_at
        FROM (SELECT l_suppkey, CAST(date_trunc('month', l_shipdate) AS TIMESTAMP) AS month,
                     bool_and(l_linestatus = 'F') AS all_done, bool_or(l_linestatus = 'F') AS some_done
              FROM lineitem GROUP BY 1, 2)""",
    "t_purchase_order_items": """
        SELECT 'POI' || l_orderkey || '-' || l_linenumber || '-' || l_partkey AS source_purchase_order_item_id,
               'PO' || l_suppkey || '-' || strftime(l_shipdate, '%Y%m') AS source_purchase_order_id,
               'P' || l_partkey AS source_product_id, CAST(l_quantity AS DECIMAL(18,3)) AS ordered_quantity,
               CASE WHEN l_linestatus = 'F' THEN CAST(l_quantity AS DECIMAL(18,3))
                    ELSE CAST(0 AS DECIMAL(18,3)) END AS received_quantity
        FROM lineitem""",
    "t_shipments": """
        SELECT o_orderkey, 'S' || o_orderkey AS source_shipment_id, 'O' || o_orderkey AS source_order_id,
               CASE o_orderkey % 4 WHEN 0 THEN 'SEA' WHEN 1 THEN 'AIR' WHEN 2 THEN 'RAIL' ELSE 'ROAD' END AS carrier,
               'TRK-' || o_orderkey AS tracking_id,
               CASE WHEN o_orderstatus = 'F' THEN 'DELIVERED' WHEN o_orderkey % 8 = 0 THEN 'EXCEPTION'
                    ELSE 'IN_TRANSIT' END AS status,
               o_orderdate + to_days(2) AS shipped_at,
               o_orderdate + to_days(CAST(20 + o_orderkey % 60 AS INTEGER)) AS eta,
               CASE WHEN o_orderstatus = 'F'
                    THEN o_orderdate + to_days(CAST(10 + o_orderkey % 80 AS INTEGER)) END AS delivered_at
        FROM orders""",
}


def rules(tag: str = "", as_of: str = AS_OF, items: str = "t_items") -> dict[str, str]:
    """The rule CTEs; `tag` names a second evaluation with its own instant or item table."""
    late = lambda due: (
        f"CAST(round_even(CAST(greatest(epoch_us({as_of}) - epoch_us({due}), 0) AS DECIMAL(20,0)) "
        f"/ 3600000000, 4) AS DECIMAL(20,4))"
    )
    return {
        f"demand{tag}": f"""
        SELECT i.source_product_id, o.source_warehouse_id,
               CAST(sum(ordered_quantity - fulfilled_quantity) AS DECIMAL(38,3)) AS demand,
               CAST(sum((ordered_quantity - fulfilled_quantity) * unit_price) AS DECIMAL(38,5)) AS revenue,
               count(DISTINCT i.source_order_id) AS orders
        FROM {items} i JOIN t_orders o ON i.source_order_id = o.source_order_id
        WHERE o.status = 'OPEN' AND o.ordered_at <= {as_of} AND ordered_quantity - fulfilled_quantity > 0
        GROUP BY 1, 2""",
        f"snapshots{tag}": f"""
        SELECT source_product_id, source_warehouse_id, on_hand, reserved, observed_at
        FROM t_inventory WHERE observed_at <= {as_of}""",
        f"rebuilt{tag}": f"""
        SELECT s.source_product_id, s.source_warehouse_id, s.on_hand, s.observed_at,
               CAST(coalesce(sum(CASE WHEN m.movement_type IN ('RECEIPT', 'ADJUSTMENT_IN', 'TRANSFER_IN') THEN m.quantity
                             WHEN m.movement_type IN ('SHIPMENT', 'ADJUSTMENT_OUT', 'TRANSFER_OUT') THEN -m.quantity
                             ELSE 0 END), 0) AS DECIMAL(38,3)) AS reconstructed
        FROM snapshots{tag} s LEFT JOIN t_movements m
          ON m.source_product_id = s.source_product_id AND m.source_warehouse_id = s.source_warehouse_id
         AND m.occurred_at <= s.observed_at
        GROUP BY 1, 2, 3, 4""",
        f"sla{tag}": f"""
        SELECT 1 AS rule_ordinal, 'SLA_BREACH_RISK' AS exception_type, 'ORDER:' || o.source_order_id AS issue_key,
               'ORDER' AS entity_type, o.source_order_id AS entity_id, o.promised_at AS expected_resolution,
               CAST(sum(ordered_quantity - fulfilled_quantity) AS VARCHAR) || ' units remain unfulfilled on order '
                 || o.source_order_id AS business_impact,
               CAST(sum((ordered_quantity - fulfilled_quantity) * unit_price) AS DECIMAL(38,5)) AS revenue_at_risk,
               1 AS orders_affected,
               'Order promised at ' || {iso('o.promised_at')} || CASE WHEN o.promised_at <= {as_of}
                 THEN ' is overdue' ELSE ' is inside the SLA risk window' END AS root_cause,
               'Prioritize fulfillment and confirm a revised customer commitment' AS recommended_action,
               {late('o.promised_at')} AS overdue_hours, o.source_warehouse_id,
               CAST(NULL AS VARCHAR) AS source_product_id,
               '{{"order":"' || o.source_order_id || '","ordered_at":"' || {iso('o.ordered_at')}
                 || '","promised_at":"' || {iso('o.promised_at')} || '","remaining":"'
                 || CAST(sum(ordered_quantity - fulfilled_quantity) AS VARCHAR) || '","revenue":"'
                 || {fact('CAST(sum((ordered_quantity - fulfilled_quantity) * unit_price) AS DECIMAL(38,5))')}
                 || '","status":"' || o.status || '"}}' AS source_facts
        FROM t_orders o JOIN {items} i ON i.source_order_id = o.source_order_id
        WHERE o.status = 'OPEN' AND o.ordered_at <= {as_of} AND o.promised_at <= {as_of} + INTERVAL 4 HOUR
          AND ordered_quantity - fulfilled_quantity > 0
        GROUP BY o.source_order_id, o.promised_at, o.ordered_at, o.status, o.source_warehouse_id""",
        f"places{tag}": f"""
        SELECT d.*, CAST(s.on_hand - s.reserved AS DECIMAL(38,3)) AS available,
               d.source_product_id || ':' || d.source_warehouse_id AS place
        FROM demand{tag} d JOIN snapshots{tag} s USING (source_product_id, source_warehouse_id)""",
        f"short{tag}": f"""
        SELECT 2 AS rule_ordinal, 'INVENTORY_SHORTAGE' AS exception_type, 'PRODUCT_WAREHOUSE:' || place AS issue_key,
               'PRODUCT_WAREHOUSE' AS entity_type, place AS entity_id, CAST(NULL AS TIMESTAMP) AS expected_resolution,
               CAST(demand - available AS VARCHAR) || ' units cannot be covered at the assigned warehouse' AS business_impact,
               revenue AS revenue_at_risk, CAST(orders AS INTEGER) AS orders_affected,
               'Open demand ' || {fact('demand')} || ' exceeds available inventory ' || {fact('available')} AS root_cause,
               'Replenish inventory or rebalance demand to another warehouse' AS recommended_action,
               CAST(0 AS DECIMAL(20,4)) AS overdue_hours, source_warehouse_id, source_product_id,
               '{{"available":"' || {fact('available')} || '","demand":"' || {fact('demand')} || '","orders":"' || orders
                 || '","product":"' || source_product_id || '","warehouse":"' || source_warehouse_id || '"}}' AS source_facts
        FROM places{tag} WHERE demand > available""",
        f"stockout{tag}": f"""
        SELECT 3 AS rule_ordinal, 'STOCKOUT_RISK' AS exception_type, 'PRODUCT_WAREHOUSE:' || place AS issue_key,
               'PRODUCT_WAREHOUSE' AS entity_type, place AS entity_id, CAST(NULL AS TIMESTAMP) AS expected_resolution,
               'Projected inventory buffer is ' || CAST(available - demand AS VARCHAR) || ' units' AS business_impact,
               revenue AS revenue_at_risk, CAST(orders AS INTEGER) AS orders_affected,
               'Projected available inventory after open demand is ' || CAST(available - demand AS VARCHAR)
                 || ', below safety stock 20' AS root_cause,
               'Expedite replenishment and protect the configured safety-stock buffer' AS recommended_action,
               CAST(0 AS DECIMAL(20,4)) AS overdue_hours, source_warehouse_id, source_product_id,
               '{{"available":"' || {fact('available')} || '","demand":"' || {fact('demand')} || '","orders":"' || orders
                 || '","product":"' || source_product_id || '","safety_stock":"20","warehouse":"'
                 || source_warehouse_id || '"}}' AS source_facts
        FROM places{tag} WHERE available - demand < 20""",
        f"mismatch{tag}": f"""
        SELECT 4 AS rule_ordinal, 'INVENTORY_MISMATCH' AS exception_type,
               'PRODUCT_WAREHOUSE:' || source_product_id || ':' || source_warehouse_id AS issue_key,
               'PRODUCT_WAREHOUSE' AS entity_type, source_product_id || ':' || source_warehouse_id AS entity_id,
               CAST(NULL AS TIMESTAMP) AS expected_resolution,
               'Persisted inventory does not reconcile to movement history' AS business_impact,
               CAST(0 AS DECIMAL(38,5)) AS revenue_at_risk, 0 AS orders_affected,
               'Snapshot on-hand ' || {fact('on_hand')} || ' differs from reconstructed ' || {fact('reconstructed')}
                 || ' by ' || CAST(abs(on_hand - reconstructed) AS VARCHAR) AS root_cause,
               'Reconcile the inventory snapshot and audit movement history' AS recommended_action,
               CAST(0 AS DECIMAL(20,4)) AS overdue_hours, source_warehouse_id, source_product_id,
               '{{"difference":"' || CAST(abs(on_hand - reconstructed) AS VARCHAR) || '","observed_at":"'
                 || {iso('observed_at')} || '","on_hand":"' || {fact('on_hand')} || '","product":"' || source_product_id
                 || '","reconstructed":"' || {fact('reconstructed')} || '","tolerance":"5","warehouse":"'
                 || source_warehouse_id || '"}}' AS source_facts
        FROM rebuilt{tag} WHERE abs(on_hand - reconstructed) > 5""",
        f"supplier_late{tag}": f"""
        SELECT 5 AS rule_ordinal, 'SUPPLIER_DELAY' AS exception_type, 'PO:' || p.source_purchase_order_id AS issue_key,
               'PURCHASE_ORDER' AS entity_type, p.source_purchase_order_id AS entity_id,
               p.expected_delivery_at AS expected_resolution,
               CAST(sum(ordered_quantity - received_quantity) AS VARCHAR)
                 || ' units remain due on overdue purchase order ' || p.source_purchase_order_id AS business_impact,
               CAST(0 AS DECIMAL(38,5)) AS revenue_at_risk, 0 AS orders_affected,
               'Purchase order expected on ' || {iso('p.expected_delivery_at')}
                 || ' remains partially or wholly unreceived' AS root_cause,
               'Contact the supplier and obtain a recovery date or alternate supply' AS recommended_action,
               {late('p.expected_delivery_at')} AS overdue_hours, p.source_warehouse_id,
               CAST(NULL AS VARCHAR) AS source_product_id,
               '{{"expected_delivery_at":"' || {iso('p.expected_delivery_at')} || '","purchase_order":"'
                 || p.source_purchase_order_id || '","remaining":"'
                 || CAST(sum(ordered_quantity - received_quantity) AS VARCHAR) || '","status":"' || p.status || '"}}' AS source_facts
        FROM t_purchase_orders p JOIN t_purchase_order_items i USING (source_purchase_order_id)
        WHERE p.status IN ('OPEN', 'PARTIALLY_RECEIVED') AND p.ordered_at <= {as_of} AND p.expected_delivery_at < {as_of}
          AND received_quantity < ordered_quantity
        GROUP BY p.source_purchase_order_id, p.expected_delivery_at, p.source_warehouse_id, p.status""",
        f"shipment_late{tag}": f"""
        SELECT 6 AS rule_ordinal, 'SHIPMENT_DELAY' AS exception_type, 'SHIPMENT:' || s.source_shipment_id AS issue_key,
               'SHIPMENT' AS entity_type, s.source_shipment_id AS entity_id, s.eta AS expected_resolution,
               'Shipment ' || s.source_shipment_id || ' is overdue for order ' || o.source_order_id AS business_impact,
               CAST(coalesce(v.value, 0) AS DECIMAL(38,5)) AS revenue_at_risk, 1 AS orders_affected,
               'Shipment ETA ' || {iso('s.eta')} || ' passed while status is ' || s.status AS root_cause,
               'Trace the shipment with the carrier and communicate a revised ETA' AS recommended_action,
               CAST(0 AS DECIMAL(20,4)) AS overdue_hours, o.source_warehouse_id,
               CAST(NULL AS VARCHAR) AS source_product_id,
               '{{"eta":"' || {iso('s.eta')} || '","order":"' || o.source_order_id || '","revenue":"'
                 || {fact('CAST(coalesce(v.value, 0) AS DECIMAL(38,5))')} || '","shipment":"' || s.source_shipment_id
                 || '","status":"' || s.status || '"}}' AS source_facts
        FROM t_shipments s JOIN t_orders o ON o.source_order_id = s.source_order_id
        LEFT JOIN (SELECT source_order_id, sum((ordered_quantity - fulfilled_quantity) * unit_price) AS value
                   FROM {items} GROUP BY 1) v ON v.source_order_id = o.source_order_id
        WHERE s.status <> 'DELIVERED' AND s.eta < {as_of}""",
        f"raw_findings{tag}": " UNION ALL ".join(
            f"SELECT * FROM {name}{tag}"
            for name in ("sla", "short", "stockout", "mismatch", "supplier_late", "shipment_late")
        ),
        f"findings{tag}": f"""
        SELECT *, sha256(source_facts) AS fingerprint,
               sha256(exception_type || '|' || issue_key || '|' || sha256(source_facts)) AS deduplication_key,
               CASE WHEN revenue_at_risk >= 10000 OR orders_affected >= 50 OR overdue_hours >= 48 THEN 'CRITICAL'
                    WHEN revenue_at_risk >= 5000 OR orders_affected >= 20 OR overdue_hours >= 24 THEN 'HIGH'
                    WHEN revenue_at_risk >= 1000 OR orders_affected >= 5 OR overdue_hours >= 4 THEN 'MEDIUM'
                    ELSE 'LOW' END AS severity
        FROM raw_findings{tag}""",
    }


def with_parts(parts: dict[str, str], final: str) -> str:
    """A query over named parts, keeping only the parts it reaches; what several places read is computed once."""
    names = list(parts)
    needed: set[str] = set()

    def visit(sql: str) -> None:
        words = set("".join(c if c.isalnum() or c == "_" else " " for c in sql).split())
        for name in names:
            if name in words and name not in needed:
                needed.add(name)
                visit(parts[name])

    visit(final)
    texts = [parts[name] for name in names if name in needed] + [final]
    uses = {name: sum(len(re.findall(rf"\b{name}\b", text)) for text in texts) for name in needed}
    kept = {name: "MATERIALIZED " if uses[name] > 1 else "" for name in needed}
    chosen = [f"{name} AS {kept[name]}({parts[name].strip()})" for name in names if name in needed]
    return (f"WITH {', '.join(chosen)} " if chosen else "") + final.strip()
