"""SQL twins of the observation jobs."""

from __future__ import annotations

from oracle.base import iso


def _json(text: str) -> str:
    return f"CASE WHEN {text} IS NULL THEN 'null' ELSE '\"' || {text} || '\"' END"


def _micros(ts: str) -> str:
    return f"strftime({ts}, '%Y-%m-%dT%H:%M:%S.%fZ')"


FACTS = " || ',' || ".join(
    f"'\"{name}\":' || {_json(value)}"
    for name, value in (
        ("currency", "currency"), ("fulfilled_at", _micros("fulfilled_at")), ("order_number", "order_number"),
        ("ordered_at", _micros("ordered_at")), ("promised_at", _micros("promised_at")), ("region", "region"),
        ("source_order_id", "source_order_id"), ("source_warehouse_id", "source_warehouse_id"), ("status", "status"),
        ("total_amount", "plain_amount"),
    )
)

PARTS = {
    "feed_rows": """
        SELECT *, 0 AS kind, CASE WHEN o_orderkey % 2 = 0 THEN '1' END AS source_version, 0 AS extra, 'b1' AS batch_id FROM t_orders
        UNION ALL SELECT *, 1, '2', 10, 'b2' FROM t_orders WHERE o_orderkey % 5 = 0
        UNION ALL SELECT *, 2, CASE WHEN o_orderkey % 2 = 0 THEN '1' END, 20, 'b2' FROM t_orders WHERE o_orderkey % 7 = 0
        UNION ALL SELECT *, 3, CASE WHEN o_orderkey % 2 = 0 THEN '1' END, 0, 'b3' FROM t_orders WHERE o_orderkey % 11 = 0""",
    "feed": """
        SELECT o_orderkey AS k, o_orderkey * 10 + kind AS sequence, batch_id, 'ns' || (o_orderkey % 3) AS source_namespace, source_version,
               source_order_id, order_number, status, region,
               CASE WHEN o_orderkey % 17 = 0 THEN 'W404' WHEN o_orderkey % 23 = 0 THEN NULL ELSE source_warehouse_id END AS source_warehouse_id,
               CASE WHEN o_orderkey % 29 <> 0 THEN ordered_at END AS ordered_at, promised_at, fulfilled_at,
               CASE WHEN o_orderkey % 19 <> 0 AND o_orderkey % 37 <> 0 THEN CAST(total_amount + extra AS DECIMAL(14,2)) END AS total_amount,
               CASE WHEN o_orderkey % 13 <> 0 THEN 'USD' END AS currency
        FROM feed_rows""",
    "feed_facts": f"""
        SELECT *, '{{' || {FACTS} || '}}' AS source_facts FROM
          (SELECT *, regexp_replace(CAST(total_amount AS VARCHAR), '\\.?0+$', '') AS plain_amount FROM feed)""",
    "assessed": f"""
        SELECT *, sha256(source_facts) AS source_row_hash,
               list_filter([CASE WHEN k % 37 = 0 AND k % 19 <> 0 THEN 'NEGATIVE_TOTAL_AMOUNT' END,
                            CASE WHEN k % 19 = 0 THEN 'MALFORMED_TOTAL_AMOUNT' END,
                            CASE WHEN k % 29 = 0 THEN 'MALFORMED_ORDERED_AT' END], lambda x: x IS NOT NULL) AS invalid,
               list_filter([CASE WHEN total_amount IS NULL THEN 'MISSING_TOTAL_AMOUNT' END, CASE WHEN currency IS NULL THEN 'MISSING_CURRENCY' END,
                            CASE WHEN total_amount IS NOT NULL AND currency IS NULL THEN 'AMOUNT_WITHOUT_CURRENCY' END,
                            CASE WHEN ordered_at IS NULL THEN 'MISSING_ORDERED_AT' END], lambda x: x IS NOT NULL) AS context,
               sha256('["' || source_namespace || '","' || source_order_id || '",' || {_json('source_version')} || ',"'
                      || sha256(source_facts) || '"]') AS digest
        FROM feed_facts""",
    "rated": """
        SELECT *, CASE WHEN len(invalid) > 0 THEN 'REJECTED_INVALID' WHEN len(context) > 0 THEN 'CONTEXT_INCOMPLETE' ELSE 'NORMALIZED' END AS assessment
        FROM assessed""",
    "evidence": "SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY digest ORDER BY sequence) AS place FROM rated) WHERE place = 1",
    "weighed": """
        SELECT e.*, coalesce(source_version, '-') AS version_key, w.source_warehouse_id IS NOT NULL AS placed,
               min(source_row_hash) OVER same_version <> max(source_row_hash) OVER same_version AS clashing,
               min(coalesce(source_version, '-')) OVER same_order <> max(coalesce(source_version, '-')) OVER same_order AS several
        FROM evidence e LEFT JOIN t_warehouses w USING (source_warehouse_id)
        WINDOW same_version AS (PARTITION BY source_namespace, source_order_id, source_version),
               same_order AS (PARTITION BY source_namespace, source_order_id)""",
    "triaged": """
        SELECT *, CASE WHEN assessment = 'REJECTED_INVALID' THEN 'KEEP'
                       WHEN clashing AND source_version IS NULL THEN 'UNVERSIONED_CONTENT_CONFLICT'
                       WHEN clashing THEN 'SOURCE_VERSION_CONTENT_CONFLICT'
                       WHEN NOT placed AND source_warehouse_id IS NULL THEN 'MISSING_WAREHOUSE'
                       WHEN NOT placed THEN 'UNKNOWN_WAREHOUSE'
                       WHEN assessment <> 'NORMALIZED' THEN 'INCOMPLETE' ELSE 'COMPARE' END AS decision
        FROM weighed""",
    "unordered": """
        SELECT *, CASE WHEN decision <> 'COMPARE' THEN decision
                       WHEN source_version IS NOT NULL AND several THEN 'SOURCE_VERSION_ORDER_UNPROVEN' ELSE 'ACCEPT' END AS result
        FROM triaged""",
    "ranked": """
        SELECT *, CASE WHEN decision <> 'COMPARE' THEN decision WHEN sequence = first_sequence THEN 'ACCEPT'
                       WHEN first_version IS NULL OR source_version IS NULL OR CAST(source_version AS INTEGER) = top
                       THEN 'SOURCE_VERSION_ORDER_UNPROVEN'
                       WHEN CAST(source_version AS INTEGER) > top THEN 'ACCEPT' ELSE 'STALE_SOURCE_VERSION' END AS result
        FROM (SELECT *, min(sequence) FILTER (decision = 'COMPARE') OVER whole AS first_sequence,
                     first_value(source_version) OVER (PARTITION BY source_namespace, source_order_id, decision ORDER BY sequence) AS first_version,
                     max(CAST(source_version AS INTEGER)) OVER (PARTITION BY source_namespace, source_order_id, decision ORDER BY sequence
                                                                ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS top
              FROM triaged WINDOW whole AS (PARTITION BY source_namespace, source_order_id))""",
}


def _promoted(source: str) -> str:
    return f"""
        SELECT digest AS observation_id, sequence,
               CASE WHEN result = 'KEEP' THEN assessment WHEN result = 'ACCEPT' THEN 'PROMOTED'
                    WHEN result IN ('INCOMPLETE', 'MISSING_WAREHOUSE', 'UNKNOWN_WAREHOUSE') THEN 'CONTEXT_INCOMPLETE'
                    ELSE 'CONFLICT_BLOCKED' END AS status,
               array_to_string(CASE WHEN result = 'KEEP' THEN invalid WHEN result = 'ACCEPT' THEN [] WHEN result = 'INCOMPLETE' THEN context
                    ELSE list_append(context, result) END, ',') AS reasons,
               CASE WHEN result = 'KEEP' OR clashing THEN CASE WHEN source_warehouse_id IS NULL THEN 'WAREHOUSE_CONTEXT_UNAVAILABLE' ELSE 'WAREHOUSE_OBSERVED' END
                    WHEN result = 'MISSING_WAREHOUSE' THEN 'WAREHOUSE_CONTEXT_UNAVAILABLE'
                    WHEN result = 'UNKNOWN_WAREHOUSE' THEN 'WAREHOUSE_UNKNOWN' ELSE 'WAREHOUSE_VALIDATED' END AS warehouse_capability,
               result = 'ACCEPT' AS promoted,
               CASE WHEN result = 'ACCEPT' THEN lead(digest) OVER (PARTITION BY source_namespace, source_order_id, result ORDER BY sequence) END AS superseded_by
        FROM {source}"""


FINALS = {
    "observation_assess": f"""
        SELECT sequence, batch_id, source_namespace, source_version, source_order_id, order_number, status, region, source_warehouse_id,
               {iso('ordered_at', 'Z')} AS ordered_at, plain_amount AS total_amount, currency, array_to_string(invalid, ',') AS invalid_reasons,
               array_to_string(list_concat(CASE WHEN source_warehouse_id = 'W404' THEN ['UNKNOWN_WAREHOUSE'] ELSE [] END, context), ',') AS context_reasons,
               CASE WHEN source_warehouse_id IS NULL THEN 'WAREHOUSE_CONTEXT_UNAVAILABLE' WHEN source_warehouse_id = 'W404' THEN 'WAREHOUSE_UNKNOWN'
                    ELSE 'WAREHOUSE_VALIDATED' END AS warehouse_capability,
               total_amount IS NOT NULL AND currency IS NOT NULL AS financial, ordered_at IS NOT NULL AND promised_at IS NOT NULL AS timing,
               source_facts, source_row_hash, digest AS replay_digest,
               CASE WHEN len(invalid) = 0 AND source_warehouse_id = 'W404' THEN 'CONTEXT_INCOMPLETE' ELSE assessment END AS assessment,
               assessment = 'NORMALIZED' AND source_warehouse_id IS DISTINCT FROM 'W404' AS promotion_eligible
        FROM rated""",
    "observation_stage": """
        SELECT digest AS observation_id, sequence, source_row_hash, assessment AS status, total_amount,
               array_to_string(CASE WHEN len(invalid) > 0 THEN invalid ELSE context END, ',') AS reasons FROM evidence""",
    "observation_receipts": "SELECT DISTINCT digest AS observation_id, batch_id FROM rated",
    "observation_promote": _promoted("unordered"),
    "observation_promote_ranked": _promoted("ranked"),
    "observation_promote_compared": _promoted("ranked"),
    "promotion_numbers": """
        SELECT source || o_orderkey AS source_order_id, o_orderkey * 10 + kind AS sequence, status, reasons, status = 'PROMOTED' AS promoted
        FROM orders, (VALUES ('A', 1, 'PROMOTED', ''), ('A', 2, 'CONFLICT_BLOCKED', 'STALE_SOURCE_VERSION'), ('B', 3, 'PROMOTED', ''),
                             ('C', 4, 'REJECTED_INVALID', 'OPERATIONAL_ORDER_CONFLICT')) AS v(source, kind, status, reasons)""",
    "observation_promote_held": """
        SELECT source || o_orderkey AS source_order_id, o_orderkey * 10 + kind AS sequence, number || o_orderkey AS order_number, status, reasons,
               status = 'PROMOTED' AS promoted
        FROM orders JOIN (VALUES (0, 1, 'H', 'N', 'PROMOTED', ''), (1, 2, 'H', 'N', 'CONFLICT_BLOCKED', 'SOURCE_VERSION_CONTENT_CONFLICT'),
                                 (2, 3, 'E', 'N', 'REJECTED_INVALID', 'OPERATIONAL_ORDER_CONFLICT'), (2, 4, 'H', 'M', 'PROMOTED', ''),
                                 (2, 5, 'T', 'N', 'PROMOTED', ''), (3, 6, 'H', 'N', 'CONFLICT_BLOCKED', 'STALE_SOURCE_VERSION'),
                                 (4, 7, 'H', 'N', 'PROMOTED', ''), (4, 8, 'H', 'N', 'CONFLICT_BLOCKED', 'STALE_SOURCE_VERSION'),
                                 (4, 9, 'H', 'N', 'CONFLICT_BLOCKED', 'SOURCE_VERSION_ORDER_UNPROVEN'))
             AS v(remainder, kind, source, number, status, reasons) ON o_orderkey % 5 = remainder""",
    "promoted_held_orders": """
        SELECT source || o_orderkey AS source_order_id, number || o_orderkey AS order_number, version AS projected_version,
               CAST(total_amount + more AS DECIMAL(14,2)) AS total_amount, untouched
        FROM t_orders JOIN (VALUES (0, 'H', 'N', '4', 0, false), (1, 'H', 'N', '4', 0, true), (2, 'H', 'M', '5', 5, false), (2, 'T', 'N', '1', 0, false),
                                   (3, 'H', 'N', '4', 0, true), (4, 'H', 'N', '5', 5, false))
             AS v(remainder, source, number, version, more, untouched) ON o_orderkey % 5 = remainder""",
    "promoted_orders": f"""
        SELECT source_namespace, source_order_id, order_number, status AS order_status, {iso('ordered_at', 'Z')} AS ordered_at, total_amount,
               source_version AS projected_version, digest AS current_observation
        FROM ranked WHERE result = 'ACCEPT'
        QUALIFY row_number() OVER (PARTITION BY source_namespace, source_order_id ORDER BY sequence DESC) = 1""",
}
