"""SQL twins of the dataset-version and external jobs."""

from __future__ import annotations

from oracle.base import AS_OF, iso

KPI_NULLS = ", ".join(
    f"CAST(NULL AS BIGINT) AS {name}"
    for name in ("open_exceptions", "critical_exceptions", "revenue_at_risk", "stockout_risks", "supplier_delays", "shipment_delays")
)
IDENTITY = (
    "sha256('{\"as_of\":\"' || strftime(as_of, '%Y-%m-%dT%H:%M:%SZ') || '\",\"content_hash\":\"' || content_hash || '\",\"dataset_key\":\"' "
    "|| dataset_key || '\",\"generator_revision\":\"r1\",\"manifest_identity\":\"' || manifest_identity || '\",\"seed\":' || seed || '}')"
)
ORDER_TEXT = "source_order_id, order_number, status, region, ordered_at, promised_at, fulfilled_at, total_amount"


def _percent(on_time: str, rated: str) -> str:
    return f"CAST(CAST(round_even(CAST({on_time} AS DECIMAL(20,0)) * 100 / nullif({rated}, 0), 2) AS DECIMAL(5,2)) AS VARCHAR)"


PARTS = {
    "versions": """
        SELECT CAST(strftime(month, '%Y%m') AS BIGINT) AS id, 'D' || (month(month) % 2) AS dataset_key, 'm' || strftime(month, '%Y%m') AS manifest_identity,
               sha256(count(*) || '|' || CAST(sum(CAST(o_totalprice AS DECIMAL(14,2))) AS DECIMAL(38,2))) AS content_hash, count(*) AS seed, month AS as_of
        FROM (SELECT *, CAST(date_trunc('month', o_orderdate) AS TIMESTAMP) AS month FROM orders) GROUP BY month""",
    "candidates": """
        SELECT id, dataset_key, CASE WHEN id % 3 = 2 THEN manifest_identity || 'x' ELSE manifest_identity END AS manifest_identity,
               CASE WHEN id % 3 = 1 THEN 'other' ELSE content_hash END AS content_hash, seed, as_of FROM versions""",
    "olist": f"""
        SELECT o_orderkey AS k, 'E' || o_orderkey AS source_order_id, 'E' || o_orderkey AS order_number,
               CASE WHEN o_orderstatus = 'F' THEN 'FULFILLED' WHEN o_orderkey % 10 = 0 THEN 'CANCELLED' ELSE 'OPEN' END AS status,
               CASE WHEN c_custkey IS NULL THEN NULL WHEN c_custkey % 10 = 0 THEN 'LATE' ELSE n_name END AS region,
               {iso('o_orderdate')} AS ordered_at,
               CASE WHEN o_orderkey % 31 <> 0 THEN {iso('o_orderdate + to_days(40)')} END AS promised_at,
               CASE WHEN o_orderstatus = 'F' THEN {iso('o_orderdate + to_days(CAST(10 + o_orderkey % 80 AS INTEGER))')} END AS fulfilled_at,
               CAST(CAST(paid AS DECIMAL(38,2)) AS VARCHAR) AS total_amount,
               o_orderdate AS placed, o_orderdate + to_days(40) AS due, o_orderdate + to_days(CAST(10 + o_orderkey % 80 AS INTEGER)) AS arrived
        FROM orders LEFT JOIN customer ON c_custkey = o_custkey LEFT JOIN nation ON n_nationkey = c_nationkey
        LEFT JOIN (SELECT l_orderkey, sum(CAST(l_extendedprice AS DECIMAL(14,2))) AS paid FROM lineitem WHERE l_linenumber <> 7 GROUP BY 1)
          ON l_orderkey = o_orderkey""",
    "dataco": f"""
        SELECT 'D' || o_orderkey AS source_order_id, 'D' || o_orderkey AS order_number,
               CASE WHEN o_orderstatus = 'F' THEN 'FULFILLED' WHEN o_orderkey % 10 = 0 THEN 'CANCELLED'
                    WHEN min(l_linenumber) = 3 THEN 'FULFILLED' ELSE 'OPEN' END AS status,
               'Region ' || (o_custkey % 7) AS region, {iso('o_orderdate')} AS ordered_at, CAST(NULL AS VARCHAR) AS promised_at,
               CAST(NULL AS VARCHAR) AS fulfilled_at,
               CAST(CAST(round_even(sum(CASE WHEN l_linenumber % 2 = 0 THEN CAST(l_extendedprice AS DECIMAL(14,2))
                                             ELSE CAST(l_quantity AS DECIMAL(18,3)) END), 2) AS DECIMAL(38,2)) AS VARCHAR) AS total_amount,
               o_orderdate AS placed
        FROM lineitem JOIN orders ON o_orderkey = l_orderkey WHERE l_orderkey % 41 <> 0
        GROUP BY o_orderkey, o_orderstatus, o_custkey, o_orderdate""",
    # Lines with a blank order id count as one more order, by its first line.
    "unnamed": """
        SELECT CASE WHEN o_orderstatus = 'F' THEN 'FULFILLED' WHEN o_orderkey % 10 = 0 THEN 'CANCELLED'
                    WHEN l_linenumber = 3 THEN 'FULFILLED' ELSE 'OPEN' END AS status, o_orderdate AS placed
        FROM lineitem JOIN orders ON o_orderkey = l_orderkey WHERE l_orderkey % 41 = 0 ORDER BY l_orderkey, l_linenumber LIMIT 1""",
}


def _steps(cases: dict[int, tuple[str, int]], active: int) -> str:
    status = " ".join(f"WHEN {key} THEN '{state}'" for key, (state, _) in cases.items())
    step = " ".join(f"WHEN {key} THEN {number}" for key, (_, number) in cases.items())
    return (
        f"SELECT id AS dataset_version_id, CASE id {status} ELSE 'READY' END AS status, CAST(CASE id {step} ELSE 0 END AS BIGINT) AS changed_step, "
        f"CAST({active} AS BIGINT) AS active_id FROM versions"
    )


FINALS = {
    "dataset_ensure": f"""
        SELECT dataset_key, manifest_identity, seed, CASE id % 3 WHEN 0 THEN 'existing' WHEN 1 THEN 'conflict' ELSE 'created' END AS outcome,
               {IDENTITY} AS identity_hash
        FROM candidates""",
    "dataset_activate": _steps({199601: ("RETIRED", 2), 199602: ("RETIRED", 3), 199603: ("ACTIVE", 3)}, 199603),
    "dataset_rollback": _steps({199601: ("ACTIVE", 5), 199602: ("READY", 5), 199603: ("READY", 4)}, 199601),
    "dataset_scope": """
        SELECT source_order_id, CAST(199602 AS BIGINT) AS dataset_version_id FROM t_orders WHERE strftime(ordered_at, '%Y%m') = '199602'""",
    "dataset_backfill": """
        SELECT CASE WHEN o_orderkey % 3 = 0 THEN CAST(1 AS BIGINT) ELSE CAST(200000 + o_orderkey % 3 AS BIGINT) END AS dataset_version_id, count(*) AS orders
        FROM orders GROUP BY 1""",
    "external_payment_orders": f"SELECT {ORDER_TEXT} FROM olist",
    "external_line_rollup": f"SELECT {ORDER_TEXT} FROM dataco",
    "external_rejections": """
        SELECT 'oms/orders.csv' AS artifact, k + 2 AS row_number, source_order_id AS source_id, fault.error_code, fault.field, fault.message
        FROM olist, LATERAL (SELECT * FROM (VALUES
            ('REQUIRED', 'region', 'required field is blank', region IS NULL),
            ('REQUIRED', 'source_warehouse_id', 'required field is blank', TRUE),
            ('REQUIRED', 'promised_at', 'required field is blank', promised_at IS NULL),
            ('REQUIRED', 'total_amount', 'required field is blank', total_amount IS NULL),
            ('REQUIRED', 'currency', 'required field is blank', TRUE)) AS v(error_code, field, message, hit) WHERE hit) AS fault""",
    "external_counts": """
        SELECT (SELECT count(*) FROM orders) AS source_line_rows, (SELECT count(*) FROM olist) AS adapted_orders, CAST(0 AS BIGINT) AS accepted_orders,
               (SELECT count(*) FROM olist) AS rejected_orders,
               (SELECT CAST(sum(2 + CAST(region IS NULL AS INT) + CAST(promised_at IS NULL AS INT) + CAST(total_amount IS NULL AS INT)) AS BIGINT) FROM olist) AS rejection_errors,
               CAST(0 AS BIGINT) AS duplicate_identical""",
    "independent_kpi": f"""
        SELECT '1998-07-01T00:00:00Z' AS as_of, count(*) AS orders_processed, count(*) FILTER (status = 'OPEN') AS open_orders,
               count(*) FILTER (status = 'FULFILLED' AND arrived <= {AS_OF}) AS fulfilled_orders,
               count(*) FILTER (status = 'CANCELLED') AS cancelled_orders,
               {_percent(f"count(*) FILTER (status = 'FULFILLED' AND arrived <= {AS_OF} AND promised_at IS NOT NULL AND arrived <= due)",
                         f"count(*) FILTER (status = 'FULFILLED' AND arrived <= {AS_OF} AND promised_at IS NOT NULL)")} AS sla_performance_pct,
               {KPI_NULLS}
        FROM olist WHERE placed <= {AS_OF}""",
    "independent_kpi_lines": f"""
        SELECT '1998-07-01T00:00:00Z' AS as_of, count(*) AS orders_processed, count(*) FILTER (status = 'OPEN') AS open_orders,
               CAST(0 AS BIGINT) AS fulfilled_orders, count(*) FILTER (status = 'CANCELLED') AS cancelled_orders,
               CAST(NULL AS VARCHAR) AS sla_performance_pct, {KPI_NULLS}
        FROM (SELECT status, placed FROM dataco UNION ALL SELECT status, placed FROM unnamed) WHERE placed <= {AS_OF}""",
    "coherence": """
        SELECT 'MISMATCH' AS overall, field, expected, observed, CASE WHEN expected = observed THEN 'PASS' ELSE 'MISMATCH' END AS status,
               CASE WHEN expected = observed THEN 'independent value equals supplied local queue count' ELSE 'values differ' END AS reason
        FROM (SELECT field, expected, expected + CASE WHEN field = 'supplier_delays' THEN 1 ELSE 0 END AS observed
              FROM kpi, LATERAL (VALUES ('open_exceptions', open_exceptions), ('critical_exceptions', critical_exceptions),
                                        ('stockout_risks', stockout_risks), ('supplier_delays', supplier_delays),
                                        ('shipment_delays', shipment_delays)) AS cell(field, expected))""",
}
