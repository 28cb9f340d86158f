"""SQL twins of the registered queries."""

from __future__ import annotations

from oracle import intake, observed, outside
from oracle.base import AS_OF, TABLES, iso, rules, with_parts

SECOND = "TIMESTAMP '1998-07-11 00:00:00'"
REVIEWED = "1998-07-02T09:30:00Z"

#: Lifecycle requests per first key digit and what must become of each.
REVIEW = """
    SELECT * FROM (VALUES
      ('0', 1, 'ACKNOWLEDGED', 'ana', NULL, 'OPEN', TRUE, NULL),
      ('0', 2, 'IN_PROGRESS', 'planner', NULL, 'ACKNOWLEDGED', TRUE, NULL),
      ('0', 3, 'RESOLVED', 'planner', 'restocked', 'IN_PROGRESS', TRUE, NULL),
      ('1', 1, 'DISMISSED', 'planner', 'known issue', 'OPEN', TRUE, NULL),
      ('2', 1, 'RESOLVED', 'planner', 'too early', 'OPEN', FALSE, 'ILLEGAL_TRANSITION'),
      ('2', 2, 'ACKNOWLEDGED', 'planner', NULL, 'OPEN', TRUE, NULL),
      ('3', 1, 'ACKNOWLEDGED', '', NULL, 'OPEN', FALSE, 'INVALID_ACTOR'),
      ('3', 2, 'DISMISSED', 'planner', '', 'OPEN', FALSE, 'REASON_REQUIRED'),
      ('4', 1, 'ACKNOWLEDGED', 'planner', NULL, 'OPEN', TRUE, NULL),
      ('4', 2, 'ACKNOWLEDGED', 'planner', NULL, 'ACKNOWLEDGED', FALSE, 'ILLEGAL_TRANSITION'),
      ('4', 3, 'IN_PROGRESS', 'planner', NULL, 'ACKNOWLEDGED', TRUE, NULL),
      ('4', 4, 'DISMISSED', 'planner', 'duplicate', 'IN_PROGRESS', TRUE, NULL),
      ('4', 5, 'RESOLVED', 'planner', 'late', 'DISMISSED', FALSE, 'ILLEGAL_TRANSITION'),
      ('5', 1, 'ACKNOWLEDGED', 'planner', NULL, NULL, FALSE, 'NOT_FOUND')
    ) AS script(digit, sequence, to_status, actor, reason, from_status, accepted, rejection)"""

PARTS = {
    **TABLES,
    **rules(),
    "t_items2": """
        SELECT * REPLACE (CASE WHEN l_orderkey % 11 = 0
                   THEN CAST(least(ordered_quantity, fulfilled_quantity + 1) AS DECIMAL(18,3))
                   ELSE fulfilled_quantity END AS fulfilled_quantity)
        FROM t_items""",
    **rules("_b", SECOND, "t_items2"),
    "script": REVIEW,
    "first_state": f"""
        SELECT sha256('1|1|' || deduplication_key) AS id, deduplication_key, exception_type, issue_key, entity_type,
               entity_id, severity, 'OPEN' AS status, {AS_OF} AS detected_at, expected_resolution, business_impact,
               CAST(round(revenue_at_risk, 2) AS DECIMAL(14,2)) AS revenue_at_risk,
               CAST(orders_affected AS INTEGER) AS orders_affected, root_cause, recommended_action,
               source_warehouse_id, source_product_id, CAST(NULL AS TIMESTAMP) AS resolved_at,
               1 AS run_sequence, rule_ordinal
        FROM findings""",
    "reviewed": """
        SELECT * REPLACE (CASE WHEN deduplication_key LIKE '0%' THEN 'RESOLVED'
                               WHEN deduplication_key LIKE '1%' OR deduplication_key LIKE '4%' THEN 'DISMISSED'
                               WHEN deduplication_key LIKE '2%' THEN 'ACKNOWLEDGED' ELSE 'OPEN' END AS status,
                          CASE WHEN deduplication_key LIKE '0%' THEN TIMESTAMP '1998-07-02 09:30:00' END AS resolved_at)
        FROM first_state""",
    "judged": """
        SELECT CASE WHEN digit = '5' THEN 'unknown-' || id ELSE id END AS exception_id,
               CAST(sequence AS BIGINT) AS sequence, from_status, to_status, actor, reason, accepted, rejection,
               CASE rejection WHEN 'INVALID_ACTOR' THEN 'actor must be nonblank'
                    WHEN 'REASON_REQUIRED' THEN 'reason is required when resolving or dismissing an exception'
                    WHEN 'NOT_FOUND' THEN 'exception unknown-' || id || ' does not exist'
                    WHEN 'ILLEGAL_TRANSITION' THEN from_status || ' cannot transition to ' || to_status END AS message
        FROM first_state JOIN script ON substr(deduplication_key, 1, 1) = digit""",
    "history": """
        SELECT id AS exception_id, CAST(NULL AS VARCHAR) AS from_status, 'OPEN' AS to_status, '1998-07-01T00:00:00Z' AS changed_at,
               'exception-engine' AS actor, CAST(NULL AS VARCHAR) AS transition_reason, CAST(0 AS BIGINT) AS entry
        FROM first_state
        UNION ALL
        SELECT exception_id, from_status, to_status, '1998-07-02T09:30:00Z', actor, reason, sequence
        FROM judged WHERE accepted""",
    "active": """
        SELECT id, exception_type, issue_key FROM reviewed WHERE status IN ('OPEN', 'ACKNOWLEDGED', 'IN_PROGRESS')""",
    "settled": """
        SELECT DISTINCT deduplication_key FROM reviewed WHERE status IN ('RESOLVED', 'DISMISSED')""",
    "rerun": """
        SELECT f.*, a.id AS active_id, t.deduplication_key IS NOT NULL AS held
        FROM findings_b f LEFT JOIN active a ON a.exception_type = f.exception_type AND a.issue_key = f.issue_key
        LEFT JOIN settled t ON t.deduplication_key = f.deduplication_key""",
    "outcomes": """
        SELECT exception_type, issue_key, CAST(1 AS BIGINT) AS findings,
               CAST(active_id IS NULL AND NOT held AS INTEGER) AS created,
               CAST(active_id IS NOT NULL AS BIGINT) AS updated,
               CAST(active_id IS NULL AND held AS BIGINT) AS skipped
        FROM rerun""",
    "second_state": f"""
        SELECT r.id, CASE WHEN f.active_id IS NOT NULL AND NOT f.held THEN f.deduplication_key ELSE r.deduplication_key END AS deduplication_key,
               r.exception_type, r.issue_key, r.entity_id, coalesce(f.severity, r.severity) AS severity, r.status, r.detected_at,
               coalesce(f.business_impact, r.business_impact) AS business_impact,
               coalesce(CAST(round(f.revenue_at_risk, 2) AS DECIMAL(14,2)), r.revenue_at_risk) AS revenue_at_risk,
               CAST(coalesce(f.orders_affected, r.orders_affected) AS INTEGER) AS orders_affected,
               coalesce(f.root_cause, r.root_cause) AS root_cause, r.resolved_at, r.run_sequence, r.rule_ordinal
        FROM reviewed r LEFT JOIN rerun f ON f.active_id = r.id
        UNION ALL
        SELECT sha256('1|2|' || deduplication_key), deduplication_key, exception_type, issue_key, entity_id, severity, 'OPEN',
               {SECOND}, business_impact, CAST(round(revenue_at_risk, 2) AS DECIMAL(14,2)), CAST(orders_affected AS INTEGER),
               root_cause, CAST(NULL AS TIMESTAMP), 2, rule_ordinal
        FROM rerun WHERE active_id IS NULL AND NOT held""",
    "wire": f"""
        SELECT id, exception_type, issue_key, entity_type, entity_id, severity, status,
               {iso('detected_at', 'Z')} AS detected_at, {iso('expected_resolution', 'Z')} AS expected_resolution,
               business_impact, CAST(revenue_at_risk AS VARCHAR) AS revenue_at_risk, orders_affected, root_cause,
               recommended_action, '1.0000' AS confidence, source_warehouse_id, source_product_id,
               {iso('resolved_at', 'Z')} AS resolved_at, run_sequence, rule_ordinal
        FROM reviewed""",
    "due": """
        SELECT p.*, CAST(coalesce((SELECT sum(ordered_quantity - received_quantity) FROM t_purchase_order_items i
                                   WHERE i.source_purchase_order_id = p.source_purchase_order_id), 0) AS DECIMAL(38,3)) AS remaining
        FROM t_purchase_orders p""",
    "po_wire": f"""
        SELECT source_purchase_order_id, po_number, source_supplier_id, s.name AS supplier_name, source_warehouse_id, status,
               {iso('ordered_at', 'Z')} AS ordered_at, {iso('expected_delivery_at', 'Z')} AS expected_delivery_at,
               {iso('received_at', 'Z')} AS received_at, CAST(remaining AS VARCHAR) AS remaining_quantity,
               ordered_at AS o_at, expected_delivery_at AS e_at, remaining
        FROM due JOIN t_suppliers s USING (source_supplier_id)""",
    "order_wire": f"""
        SELECT source_order_id, order_number, status, region, source_warehouse_id, {iso('ordered_at', 'Z')} AS ordered_at,
               {iso('promised_at', 'Z')} AS promised_at, {iso('fulfilled_at', 'Z')} AS fulfilled_at,
               CAST(total_amount AS VARCHAR) AS total_amount, currency
        FROM t_orders""",
    "kpi": f"""
        SELECT '1998-07-01T00:00:00Z' AS as_of, o.*, e.* FROM
          (SELECT count(*) AS orders_processed, count(*) FILTER (status = 'OPEN') AS open_orders,
                  count(*) FILTER (status = 'FULFILLED' AND fulfilled_at <= {AS_OF}) AS fulfilled_orders,
                  count(*) FILTER (status = 'CANCELLED') AS cancelled_orders,
                  CAST(CAST(round_even(CAST(count(*) FILTER (status = 'FULFILLED' AND fulfilled_at <= {AS_OF} AND fulfilled_at <= promised_at)
                       AS DECIMAL(20,0)) * 100 / nullif(count(*) FILTER (status = 'FULFILLED' AND fulfilled_at <= {AS_OF}), 0), 2)
                       AS DECIMAL(5,2)) AS VARCHAR) AS sla_performance_pct
           FROM t_orders WHERE ordered_at <= {AS_OF}) o,
          (SELECT count(*) AS open_exceptions, count(*) FILTER (severity = 'CRITICAL') AS critical_exceptions,
                  CAST(CAST(coalesce(sum(revenue_at_risk), 0) AS DECIMAL(38,2)) AS VARCHAR) AS revenue_at_risk,
                  count(*) FILTER (exception_type = 'STOCKOUT_RISK') AS stockout_risks,
                  count(*) FILTER (exception_type = 'SUPPLIER_DELAY') AS supplier_delays,
                  count(*) FILTER (exception_type = 'SHIPMENT_DELAY') AS shipment_delays
           FROM reviewed WHERE status IN ('OPEN', 'ACKNOWLEDGED', 'IN_PROGRESS') AND detected_at <= {AS_OF}) e""",
    "detail_page": """
        SELECT * FROM order_wire WHERE status = 'OPEN' AND source_warehouse_id = 'W4' ORDER BY source_order_id LIMIT 100""",
    "domain": """
        SELECT 'status' AS dimension, unnest(['OPEN', 'ACKNOWLEDGED', 'IN_PROGRESS', 'RESOLVED', 'DISMISSED']) AS value
        UNION ALL SELECT 'exception_type', unnest(['SLA_BREACH_RISK', 'INVENTORY_SHORTAGE', 'STOCKOUT_RISK',
                                                   'INVENTORY_MISMATCH', 'SUPPLIER_DELAY', 'SHIPMENT_DELAY'])
        UNION ALL SELECT 'severity', unnest(['CRITICAL', 'HIGH', 'MEDIUM', 'LOW'])""",
    "faceted": """
        SELECT 'status' AS dimension, status AS value FROM reviewed
        WHERE severity IN ('CRITICAL', 'LOW') AND exception_type IN ('SLA_BREACH_RISK', 'STOCKOUT_RISK')
        UNION ALL SELECT 'exception_type', exception_type FROM reviewed WHERE severity IN ('CRITICAL', 'LOW') AND status = 'OPEN'
        UNION ALL SELECT 'severity', severity FROM reviewed
        WHERE status = 'OPEN' AND exception_type IN ('SLA_BREACH_RISK', 'STOCKOUT_RISK')""",
}


def label(column: str) -> str:
    words = f"lower(replace({column}, '_', ' '))"
    return (
        f"CASE WHEN {words} LIKE 'sla %' THEN 'SLA ' || substr({words}, 5) "
        f"ELSE upper(substr({words}, 1, 1)) || substr({words}, 2) END"
    )


def minute(ts: str) -> str:
    return f"coalesce(strftime({ts}, '%Y-%m-%d %H:%M UTC'), '—')"


STATE_COLUMNS = f"""id, deduplication_key, exception_type, issue_key, entity_id, severity, status,
    {iso('detected_at', 'Z')} AS detected_at, business_impact, revenue_at_risk, orders_affected, root_cause,
    {iso('resolved_at', 'Z')} AS resolved_at, run_sequence, rule_ordinal"""
PO_COLUMNS = """source_purchase_order_id, po_number, source_supplier_id, supplier_name, source_warehouse_id, status,
    ordered_at, expected_delivery_at, received_at, remaining_quantity"""
PLACE = "source_product_id, source_warehouse_id"

FINDING = f"""SELECT rule_ordinal, exception_type, issue_key, entity_type, entity_id, severity,
    {iso('expected_resolution', 'Z')} AS expected_resolution, business_impact, revenue_at_risk, orders_affected,
    root_cause, recommended_action, overdue_hours, source_warehouse_id, source_product_id, source_facts,
    fingerprint, deduplication_key FROM findings"""

FINALS = {
    "rule_sla_breach": f"{FINDING} WHERE rule_ordinal = 1",
    "rule_inventory_shortage": f"{FINDING} WHERE rule_ordinal = 2",
    "rule_stockout": f"{FINDING} WHERE rule_ordinal = 3",
    "rule_inventory_mismatch": f"{FINDING} WHERE rule_ordinal = 4",
    "rule_supplier_delay": f"{FINDING} WHERE rule_ordinal = 5",
    "rule_shipment_delay": f"{FINDING} WHERE rule_ordinal = 6",
    "detect_all": FINDING,
    "open_demand": "SELECT * FROM demand",
    "latest_snapshot": f"""
        SELECT {PLACE}, on_hand, reserved, {iso('observed_at', 'Z')} AS observed_at FROM (
          SELECT *, row_number() OVER (PARTITION BY {PLACE} ORDER BY observed_at DESC, sequence DESC) AS position FROM (
            SELECT {PLACE}, on_hand, reserved, observed_at, 1 AS sequence FROM t_inventory
            UNION ALL SELECT {PLACE}, CAST(on_hand + 1 AS DECIMAL(18,3)), reserved, observed_at - INTERVAL 1 DAY, 3 FROM t_inventory
            UNION ALL SELECT {PLACE}, CAST(on_hand - 1 AS DECIMAL(18,3)), reserved, observed_at, 2 FROM t_inventory WHERE on_hand > 50)
          WHERE observed_at <= {AS_OF})
        WHERE position = 1""",
    "movement_reconstruction": f"SELECT {PLACE}, on_hand, reconstructed FROM rebuilt",
    "severity_by_type": """SELECT exception_type, severity, count(*) AS findings,
        CAST(sum(revenue_at_risk) AS DECIMAL(38,5)) AS revenue FROM findings GROUP BY 1, 2""",
    "persist_first_run": f"SELECT {STATE_COLUMNS} FROM first_state",
    "persist_rerun_state": f"SELECT {STATE_COLUMNS} FROM second_state",
    "persist_rerun_outcomes": "SELECT * FROM outcomes",
    "run_counters": """
        SELECT CAST(sum(findings) AS BIGINT) AS detections, CAST(sum(created) AS BIGINT) AS created,
               CAST(sum(updated) AS BIGINT) AS updated, CAST(sum(skipped) AS BIGINT) AS skipped,
               CAST(sum(created) + sum(updated) AS BIGINT) AS persisted FROM outcomes""",
    "lifecycle_transitions": "SELECT * FROM judged",
    "lifecycle_sample": """
        SELECT id AS exception_id, CAST(sequence AS BIGINT) AS sequence, from_status, to_status, 'bootstrap' AS actor, reason,
               TRUE AS accepted, CAST(NULL AS VARCHAR) AS rejection, CAST(NULL AS VARCHAR) AS message
        FROM (SELECT id, exception_type, row_number() OVER (PARTITION BY exception_type
                ORDER BY issue_key, entity_type, entity_id, deduplication_key) AS position FROM first_state)
        JOIN (VALUES ('STOCKOUT_RISK', 1, 'OPEN', 'ACKNOWLEDGED', NULL), ('INVENTORY_MISMATCH', 1, 'OPEN', 'ACKNOWLEDGED', NULL),
                     ('INVENTORY_MISMATCH', 2, 'ACKNOWLEDGED', 'IN_PROGRESS', NULL), ('SUPPLIER_DELAY', 1, 'OPEN', 'ACKNOWLEDGED', NULL),
                     ('SUPPLIER_DELAY', 2, 'ACKNOWLEDGED', 'IN_PROGRESS', NULL),
                     ('SUPPLIER_DELAY', 3, 'IN_PROGRESS', 'RESOLVED', 'deterministic lifecycle sample'),
                     ('SHIPMENT_DELAY', 1, 'OPEN', 'DISMISSED', 'deterministic lifecycle sample'))
             AS walk(kind, sequence, from_status, to_status, reason) ON kind = exception_type
        WHERE position = 1""",
    "history_log": "SELECT exception_id || '-' || entry AS id, * FROM history",
    "kpi_summary": "SELECT * FROM kpi",
    "kpi_display": """
        SELECT label, value FROM kpi, LATERAL (VALUES
          ('Orders processed', CAST(orders_processed AS VARCHAR)),
          ('SLA performance', coalesce(sla_performance_pct || '%', '—')),
          ('Active exceptions', CAST(open_exceptions AS VARCHAR)),
          ('Critical exceptions', CAST(critical_exceptions AS VARCHAR)),
          ('Revenue at risk', '$' || format('{:,.2f}', CAST(revenue_at_risk AS DOUBLE))),
          ('Stockout risks', CAST(stockout_risks AS VARCHAR)), ('Supplier delays', CAST(supplier_delays AS VARCHAR)),
          ('Shipment delays', CAST(shipment_delays AS VARCHAR))) AS card(label, value)""",
    "exception_queue_page": """
        SELECT * FROM wire WHERE exception_type IN ('STOCKOUT_RISK', 'SLA_BREACH_RISK') AND severity IN ('CRITICAL', 'MEDIUM')
          AND status = 'OPEN' ORDER BY run_sequence, rule_ordinal, entity_id, id LIMIT 100 OFFSET 200""",
    "exception_queue_total": """
        SELECT count(*) AS total FROM reviewed WHERE entity_type = 'PRODUCT_WAREHOUSE' AND source_warehouse_id = 'W3'
          AND status IN ('OPEN', 'DISMISSED')""",
    "exception_facets": """
        SELECT d.dimension, d.value, count(f.value) AS count FROM domain d LEFT JOIN faceted f USING (dimension, value)
        GROUP BY d.dimension, d.value""",
    "exception_detail": f"""
        SELECT r.id, r.status, {iso('r.resolved_at', 'Z')} AS resolved_at, '1.0000' AS confidence,
               (SELECT string_agg(coalesce(from_status, 'NEW') || '>' || to_status, ';' ORDER BY entry)
                FROM history h WHERE h.exception_id = r.id) AS walk
        FROM reviewed r""",
    "orders_page": """
        SELECT * FROM order_wire WHERE status IN ('OPEN', 'FULFILLED') AND region = 'REGION_2'
          AND ordered_at >= '1996-01-01' AND ordered_at <= '1998-01-01T00:00:00Z' ORDER BY source_order_id LIMIT 50 OFFSET 50""",
    "order_lookup": """
        SELECT source_order_id, order_number, o.status, line_number, 'SKU-' || substr(i.source_product_id, 2) AS sku,
               CAST(ordered_quantity AS VARCHAR) AS ordered_quantity
        FROM t_orders o JOIN t_items i USING (source_order_id) WHERE source_order_id = 'O7'""",
    "orders_page_after_key": """
        SELECT * FROM order_wire WHERE source_warehouse_id = 'W7' AND source_order_id > 'O5' ORDER BY source_order_id LIMIT 25""",
    "order_lines": """
        SELECT source_order_id, line_number, source_product_id, p.sku, CAST(ordered_quantity AS VARCHAR) AS ordered_quantity,
               CAST(fulfilled_quantity AS VARCHAR) AS fulfilled_quantity, CAST(i.unit_price AS VARCHAR) AS unit_price
        FROM t_items i JOIN t_orders o USING (source_order_id) JOIN t_products p USING (source_product_id)
        WHERE o.status = 'CANCELLED'""",
    "order_detail": """
        SELECT source_order_id, 'item' AS part, i.line_number || '/SKU-' || substr(i.source_product_id, 2) AS child,
               CAST(i.ordered_quantity AS VARCHAR) AS content
        FROM detail_page JOIN t_items i USING (source_order_id)
        UNION ALL
        SELECT source_order_id, 'shipment', source_shipment_id, s.carrier || '/' || s.status FROM detail_page JOIN t_shipments s USING (source_order_id)
        UNION ALL
        SELECT source_order_id, 'order', order_number, status || '/' || total_amount FROM detail_page""",
    "inventory_list": f"""
        SELECT source_product_id, source_warehouse_id, sku, name AS product_name, CAST(on_hand AS VARCHAR) AS on_hand,
               CAST(reserved AS VARCHAR) AS reserved, CAST(on_hand - reserved AS VARCHAR) AS available,
               {iso('observed_at', 'Z')} AS observed_at
        FROM t_inventory JOIN t_products USING (source_product_id)
        WHERE on_hand - reserved <= -5 AND observed_at BETWEEN '1996-06-01' AND '1998-06-30'""",
    "inventory_by_sku": f"""
        SELECT source_product_id, source_warehouse_id, sku, name AS product_name, CAST(on_hand AS VARCHAR) AS on_hand,
               CAST(reserved AS VARCHAR) AS reserved, CAST(on_hand - reserved AS VARCHAR) AS available,
               {iso('observed_at', 'Z')} AS observed_at
        FROM t_inventory JOIN t_products USING (source_product_id) WHERE sku = 'SKU-7'
        ORDER BY source_product_id, source_warehouse_id LIMIT 20""",
    "purchase_orders_remaining": f"""
        SELECT {PO_COLUMNS} FROM po_wire WHERE status IN ('OPEN', 'PARTIALLY_RECEIVED') AND o_at >= '1997-01-01'
          AND e_at <= '1999-01-01' AND remaining BETWEEN 40 AND 180.5""",
    "supplier_context": f"SELECT {PO_COLUMNS} FROM po_wire WHERE source_supplier_id = 'SUP7'",
    "shipments_list": f"""
        SELECT source_shipment_id, source_order_id, source_warehouse_id, carrier, tracking_id, s.status,
               {iso('shipped_at', 'Z')} AS shipped_at, {iso('eta', 'Z')} AS eta, {iso('delivered_at', 'Z')} AS delivered_at
        FROM t_shipments s JOIN t_orders o USING (source_order_id)
        WHERE s.status IN ('IN_TRANSIT', 'EXCEPTION') AND carrier = 'SEA' AND eta BETWEEN '1997-01-01' AND '1998-07-01'""",
    "queue_export": f"""
        SELECT id AS exception_id, {label('exception_type')} AS exception_type, {label('severity')} AS severity,
               {label('status')} AS status, entity_type, entity_id, business_impact,
               '$' || format('{{:,.2f}}', CAST(revenue_at_risk AS DOUBLE)) AS revenue_at_risk, orders_affected,
               {minute('detected_at')} AS detected_at, recommended_action
        FROM reviewed""",
    "purchase_order_display": f"""
        SELECT source_purchase_order_id AS purchase_order_id, po_number, source_supplier_id AS supplier_id,
               supplier_name AS supplier, source_warehouse_id AS warehouse_id, {label('status')} AS status,
               {minute('o_at')} AS ordered_at, {minute('e_at')} AS expected_delivery,
               CASE WHEN received_at IS NULL THEN '—' ELSE replace(substr(received_at, 1, 16), 'T', ' ') || ' UTC' END AS received_at,
               remaining_quantity
        FROM po_wire""",
    "fingerprints": "SELECT exception_type, issue_key, fingerprint, deduplication_key FROM findings",
}


def sql() -> dict[str, str]:
    parts, finals = dict(PARTS), dict(FINALS)
    for module in (intake, observed, outside):
        parts |= module.PARTS
        finals |= module.FINALS
    return {key: with_parts(parts, final) for key, final in finals.items()}
