"""The six exception rules and the shared frames they read.

Every rule takes the operational tables (a mapping of table name to DataFrame on source keys) and
returns findings. Foreign keys are proven at load time, so a rule joins a dimension only when it
needs one of its columns; product and warehouse ids already travel on the fact rows.

A rule by itself reads the tables it needs. All rules together share two frames that are written once:
sums per order and per product and warehouse from one pass over orders and their lines, and the stock.
So a detection reads each of the seven tables once.
"""

from __future__ import annotations

from collections.abc import Mapping
from datetime import datetime
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.functions.severity import severity
from tidewatch.functions.text import ascii_json, fact_text, iso_offset, json_object, quoted, sha256
from tidewatch.schema import EXCEPTION_TYPES, INBOUND_MOVEMENTS, OUTBOUND_MOVEMENTS
from tidewatch.settings import RuleSettings, instant_sql
from tidewatch.settings import parked as cut_lineage  # the name under which written frames are watched

Tables = Mapping[str, DataFrame]
PLACE = ("source_product_id", "source_warehouse_id")
PLACE_ID = "concat(source_product_id, ':', source_warehouse_id)"
REMAINING = "(ordered_quantity - fulfilled_quantity)"

FINDING_COLUMNS = (
    "rule_ordinal", "exception_type", "issue_key", "entity_type", "entity_id", "severity",
    "expected_resolution", "business_impact", "revenue_at_risk", "orders_affected", "root_cause",
    "recommended_action", "confidence", "overdue_hours", "source_warehouse_id",
    "source_product_id", "source_facts", "fingerprint", "deduplication_key",
)


def overdue_hours(as_of: datetime, due: str) -> str:
    """Hours past due, never negative, four places with ties to even."""
    late = f"greatest(unix_micros({instant_sql(as_of)}) - unix_micros({due}), 0)"
    return f"bround(CAST({late} AS DECIMAL(20,0)) / CAST(3600000000 AS DECIMAL(10,0)), 4)"


def text_of(number: str) -> str:
    return f"CAST({number} AS STRING)"


def _finding(
    rows: DataFrame,
    settings: RuleSettings,
    *,
    kind: str,
    issue_key: str,
    entity_type: str,
    entity_id: str,
    impact: str,
    cause: str,
    action: str,
    facts: str,
    resolution: str = "NULL",
    revenue: str = "0",
    orders: str = "0",
    overdue: str = "0",
    product: str = "NULL",
) -> DataFrame:
    """Lay the parts of a rule out as a finding and derive severity, fingerprint and key."""
    ordinals = " ".join(f"WHEN '{name}' THEN {place}" for place, name in enumerate(EXCEPTION_TYPES, 1))
    laid_out = rows.selectExpr(
        f"CASE {kind} {ordinals} END AS rule_ordinal",
        f"{kind} AS exception_type",
        f"{issue_key} AS issue_key",
        f"'{entity_type}' AS entity_type",
        f"{entity_id} AS entity_id",
        f"CAST({resolution} AS TIMESTAMP) AS expected_resolution",
        f"{impact} AS business_impact",
        f"CAST({revenue} AS DECIMAL(38,5)) AS revenue_at_risk",
        f"CAST({orders} AS INT) AS orders_affected",
        f"{cause} AS root_cause",
        f"{action} AS recommended_action",
        "CAST(1 AS DECIMAL(5,4)) AS confidence",
        f"CAST({overdue} AS DECIMAL(20,4)) AS overdue_hours",
        "source_warehouse_id",
        f"CAST({product} AS STRING) AS source_product_id",
        f"{facts} AS fact_json",
    )
    key = sha256("concat_ws('|', exception_type, issue_key, fingerprint)")
    return (
        laid_out.selectExpr("*", f"{ascii_json('fact_json')} AS source_facts")
        .selectExpr(
            "*",
            f"{sha256('source_facts')} AS fingerprint",
            f"{severity(settings, 'revenue_at_risk', 'orders_affected', 'overdue_hours')} AS severity",
        )
        .selectExpr(*[name for name in FINDING_COLUMNS[:-1]], f"{key} AS deduplication_key")
    )


# Shared frames ---------------------------------------------------------------


def open_lines_per_order(items: DataFrame) -> DataFrame:
    """Unfulfilled quantity and revenue per order. Aggregated before any join, so an order with
    very many lines is combined on the map side."""
    return (
        items.where(f"{REMAINING} > 0")
        .groupBy("source_order_id")
        .agg(
            F.expr(f"sum({REMAINING}) AS remaining"),
            F.expr(f"sum({REMAINING} * unit_price) AS revenue"),
        )
    )


def open_orders(orders: DataFrame, as_of: datetime) -> DataFrame:
    return orders.where(f"status = 'OPEN' AND ordered_at <= {instant_sql(as_of)}")


def open_demand(tables: Tables, as_of: datetime) -> DataFrame:
    """Open demand per product and warehouse: quantity, revenue and number of orders.

    Lines are first combined per order and product: the count of orders then needs no distinct
    aggregate, and a hot product is spread over its orders before its final sum.
    """
    lines = (
        tables["order_items"]
        .where(f"{REMAINING} > 0")
        .groupBy("source_order_id", "source_product_id")
        .agg(
            F.expr(f"sum({REMAINING}) AS quantity"),
            F.expr(f"sum({REMAINING} * unit_price) AS revenue"),
        )
    )
    orders = open_orders(tables["orders"], as_of).select("source_order_id", "source_warehouse_id")
    return (
        lines.join(orders, "source_order_id")
        .groupBy(*PLACE)
        .agg(
            F.expr("CAST(sum(quantity) AS DECIMAL(38,3)) AS demand"),
            F.expr("CAST(sum(revenue) AS DECIMAL(38,5)) AS revenue"),
            F.expr("count(1) AS orders"),
        )
    )


def order_facts(tables: Tables, as_of: datetime) -> DataFrame:
    """Tagged rows from one pass over orders and lines.

    `ORDER` rows: every order with the quantity and revenue of its open lines (null without one) and the value
    of all its lines. `PLACE` rows: the open demand per product and warehouse. Lines are combined per order
    and product first; a row of the join then counts for its order and, if that is open, for its place, and
    both sums are one aggregation.
    """
    is_open = f"{REMAINING} > 0"
    lines = tables["order_items"].groupBy("source_order_id", "source_product_id").agg(
        F.expr(f"sum({REMAINING}) FILTER (WHERE {is_open}) AS quantity"),
        F.expr(f"sum({REMAINING} * unit_price) FILTER (WHERE {is_open}) AS revenue"),
        F.expr(f"sum({REMAINING} * unit_price) AS value"),
    )
    columns = ("source_order_id", "source_warehouse_id", "status", "ordered_at", "promised_at")
    met = tables["orders"].select(*columns).join(lines, "source_order_id", "left")
    demanded = f"status = 'OPEN' AND ordered_at <= {instant_sql(as_of)} AND quantity IS NOT NULL"
    keys = ("fact", "source_order_id", "source_product_id", "source_warehouse_id", "status", "ordered_at", "promised_at")
    sums = ("quantity", "revenue", "value")
    order_row = ", ".join([
        "'ORDER' AS fact", "source_order_id", "CAST(NULL AS STRING) AS source_product_id", "source_warehouse_id", "status", "ordered_at", "promised_at", *sums,
    ])
    place_row = ", ".join([
        "'PLACE' AS fact", "CAST(NULL AS STRING) AS source_order_id", "source_product_id", "source_warehouse_id", "CAST(NULL AS STRING) AS status",
        "CAST(NULL AS TIMESTAMP) AS ordered_at", "CAST(NULL AS TIMESTAMP) AS promised_at", "quantity", "revenue", "CAST(NULL AS DECIMAL(38,5)) AS value",
    ])
    tagged = met.selectExpr(f"inline(array_compact(array(struct({order_row}), IF({demanded}, struct({place_row}), NULL))))")
    return tagged.groupBy(*keys).agg(*(F.sum(name).alias(name) for name in sums), F.count("*").alias("orders"))


def stock_rows(inventory: DataFrame, as_of: datetime) -> DataFrame:
    """Snapshots up to the instant; `tie`, if the table has a sequence, tells two of one time apart, see `latest_snapshots`."""
    tie = ["snapshot_sequence AS tie"] if "snapshot_sequence" in inventory.columns else []
    return inventory.where(f"observed_at <= {instant_sql(as_of)}").selectExpr(*PLACE, "observed_at", "on_hand", "reserved", *tie)


def latest_snapshots(inventory: DataFrame, as_of: datetime) -> DataFrame:
    """Newest snapshot per product and warehouse at or before the instant; of two at the same
    time the later row (`snapshot_sequence`, when the table has one) wins."""
    return _latest(stock_rows(inventory, as_of))


def _latest(stock: DataFrame) -> DataFrame:
    if "tie" in stock.columns:
        newest = "max_by(struct(observed_at, on_hand, reserved), struct(observed_at, tie)) AS snapshot"
        return stock.groupBy(*PLACE).agg(F.expr(newest)).select(*PLACE, "snapshot.*")
    # Plain values are aggregated by hashing, structs by sorting. Both columns follow the same comparisons, so they are of one row.
    return stock.groupBy(*PLACE).agg(
        F.expr("max(observed_at) AS observed_at"), F.expr("max_by(on_hand, observed_at) AS on_hand"), F.expr("max_by(reserved, observed_at) AS reserved")
    )


def _names(values: tuple[str, ...]) -> str:
    return ", ".join(quoted(value) for value in values)


SIGNED_QUANTITY = (
    f"CASE WHEN movement_type IN ({_names(INBOUND_MOVEMENTS)}) THEN quantity "
    f"WHEN movement_type IN ({_names(OUTBOUND_MOVEMENTS)}) THEN -quantity ELSE CAST(0 AS DECIMAL(18,3)) END"
)


def reconstructed_on_hand(snapshots: DataFrame, movements: DataFrame) -> DataFrame:
    """On-hand quantity rebuilt from the movements up to each snapshot's own time.

    Movements are shuffled once, as the left side of an inner join, which Spark may split when one
    product-warehouse holds most movements. Sums per instant would hardly be fewer than the movements.
    """
    signed = movements.selectExpr(*PLACE, "occurred_at", f"{SIGNED_QUANTITY} AS moved")
    rebuilt = (
        signed.join(snapshots.select(*PLACE, "observed_at"), list(PLACE))
        .where("occurred_at <= observed_at")
        .groupBy(*PLACE)
        .agg(F.expr("CAST(sum(moved) AS DECIMAL(38,3)) AS moved"))
    )
    return snapshots.join(rebuilt, list(PLACE), "left").selectExpr(
        *snapshots.columns, "coalesce(moved, CAST(0 AS DECIMAL(38,3))) AS reconstructed"
    )


# Rules -----------------------------------------------------------------------


def sla_breach_risk(tables: Tables, as_of: datetime, settings: RuleSettings) -> DataFrame:
    """Open orders with unfulfilled lines, due now or within the risk window (inclusive)."""
    due = open_orders(tables["orders"], as_of).where(_due_soon(as_of, settings))
    return _sla_findings(due.join(open_lines_per_order(tables["order_items"]), "source_order_id"), as_of, settings)


def _due_soon(as_of: datetime, settings: RuleSettings) -> str:
    return f"promised_at <= {instant_sql(as_of)} + make_dt_interval(0, {settings.sla_risk_window_hours})"


def _sla_findings(rows: DataFrame, as_of: datetime, settings: RuleSettings) -> DataFrame:
    now = instant_sql(as_of)
    return _finding(
        rows,
        settings,
        kind="'SLA_BREACH_RISK'",
        issue_key="concat('ORDER:', source_order_id)",
        entity_type="ORDER",
        entity_id="source_order_id",
        resolution="promised_at",
        impact=f"concat({text_of('remaining')}, ' units remain unfulfilled on order ', source_order_id)",
        cause=(
            f"concat('Order promised at ', {iso_offset('promised_at')}, CASE WHEN promised_at <= {now} "
            "THEN ' is overdue' ELSE ' is inside the SLA risk window' END)"
        ),
        action="'Prioritize fulfillment and confirm a revised customer commitment'",
        revenue="revenue",
        orders="1",
        overdue=overdue_hours(as_of, "promised_at"),
        facts=json_object(
            {
                "order": "source_order_id",
                "status": "status",
                "ordered_at": iso_offset("ordered_at"),
                "promised_at": iso_offset("promised_at"),
                "remaining": text_of("remaining"),
                "revenue": fact_text("revenue"),
            }
        ),
    )


DEMAND_KINDS = ("INVENTORY_SHORTAGE", "STOCKOUT_RISK")


def demand_risks(
    tables: Tables,
    as_of: datetime,
    settings: RuleSettings,
    kinds: tuple[str, ...] = DEMAND_KINDS,
) -> DataFrame:
    """Shortage and stockout findings from one pass over demand and stock.

    A place fires as a shortage when demand exceeds what is available, and as a stockout risk when
    what would be left falls below the safety stock. A place without a snapshot never fires.
    """
    return _demand_findings(open_demand(tables, as_of), stock_rows(tables["inventory"], as_of), settings, kinds)


def _demand_findings(demands: DataFrame, stock: DataFrame, settings: RuleSettings, kinds: tuple[str, ...]) -> DataFrame:
    stock = stock.selectExpr(*PLACE, "on_hand - reserved AS available")
    buffer = "0" if settings.safety_stock == 0 else str(settings.safety_stock)
    tests = {
        "INVENTORY_SHORTAGE": "demand > available",
        "STOCKOUT_RISK": f"available - demand < CAST('{buffer}' AS DECIMAL(38,3))",
    }
    fired = ", ".join(f"CASE WHEN {tests[kind]} THEN '{kind}' END" for kind in kinds)
    rows = demands.join(stock, list(PLACE)).selectExpr(
        "*", f"explode(array_compact(array({fired}))) AS kind"
    )
    demand, available = fact_text("demand"), fact_text("available")
    gap, left = text_of("demand - available"), text_of("available - demand")
    short = "kind = 'INVENTORY_SHORTAGE'"
    facts = {
        "product": "source_product_id",
        "warehouse": "source_warehouse_id",
        "demand": demand,
        "available": available,
        "orders": text_of("orders"),
        # Null, and so left out, for a shortage: a changed buffer must not change its fingerprint.
        "safety_stock": f"CASE WHEN {short} THEN NULL ELSE '{buffer}' END",
    }
    return _finding(
        rows, settings,
        kind="kind",
        issue_key=f"concat('PRODUCT_WAREHOUSE:', {PLACE_ID})",
        entity_type="PRODUCT_WAREHOUSE",
        entity_id=PLACE_ID,
        impact=(
            f"CASE WHEN {short} THEN concat({gap}, ' units cannot be covered at the assigned warehouse') "
            f"ELSE concat('Projected inventory buffer is ', {left}, ' units') END"
        ),
        cause=(
            f"CASE WHEN {short} THEN concat('Open demand ', {demand}, ' exceeds available inventory ', {available}) "
            f"ELSE concat('Projected available inventory after open demand is ', {left}, ', below safety stock {buffer}') END"
        ),
        action=(
            f"CASE WHEN {short} THEN 'Replenish inventory or rebalance demand to another warehouse' "
            "ELSE 'Expedite replenishment and protect the configured safety-stock buffer' END"
        ),
        revenue="revenue",
        orders="orders",
        product="source_product_id",
        facts=json_object(facts),
    )


def inventory_shortage(tables: Tables, as_of: datetime, settings: RuleSettings) -> DataFrame:
    return demand_risks(tables, as_of, settings, ("INVENTORY_SHORTAGE",))


def stockout_risk(tables: Tables, as_of: datetime, settings: RuleSettings) -> DataFrame:
    return demand_risks(tables, as_of, settings, ("STOCKOUT_RISK",))


def inventory_mismatch(tables: Tables, as_of: datetime, settings: RuleSettings) -> DataFrame:
    """Latest snapshots whose on-hand quantity differs from the movement history by more than the
    tolerance."""
    return _mismatch_findings(stock_rows(tables["inventory"], as_of), tables["inventory_movements"], settings)


def _mismatch_findings(stock: DataFrame, movements: DataFrame, settings: RuleSettings) -> DataFrame:
    tolerance = settings.inventory_mismatch_tolerance
    shown = "0" if tolerance == 0 else str(tolerance)
    rebuilt = reconstructed_on_hand(_latest(stock), movements)
    rows = rebuilt.selectExpr("*", "abs(on_hand - reconstructed) AS difference").where(
        f"difference > CAST('{shown}' AS DECIMAL(38,3))"
    )
    return _finding(
        rows, settings,
        kind="'INVENTORY_MISMATCH'",
        issue_key=f"concat('PRODUCT_WAREHOUSE:', {PLACE_ID})",
        entity_type="PRODUCT_WAREHOUSE",
        entity_id=PLACE_ID,
        impact="'Persisted inventory does not reconcile to movement history'",
        cause=(
            f"concat('Snapshot on-hand ', {fact_text('on_hand')}, ' differs from reconstructed ', "
            f"{fact_text('reconstructed')}, ' by ', {text_of('difference')})"
        ),
        action="'Reconcile the inventory snapshot and audit movement history'",
        product="source_product_id",
        facts=json_object(
            {
                "product": "source_product_id",
                "warehouse": "source_warehouse_id",
                "observed_at": iso_offset("observed_at"),
                "on_hand": fact_text("on_hand"),
                "reconstructed": fact_text("reconstructed"),
                "difference": text_of("difference"),
                "tolerance": quoted(shown),
            }
        ),
    )


def supplier_delay(tables: Tables, as_of: datetime, settings: RuleSettings) -> DataFrame:
    """Overdue purchase orders with quantity still to be received."""
    now = instant_sql(as_of)
    late = tables["purchase_orders"].where(
        f"status IN ('OPEN', 'PARTIALLY_RECEIVED') AND ordered_at <= {now} AND expected_delivery_at < {now}"
    )
    due = (
        tables["purchase_order_items"]
        .where("received_quantity < ordered_quantity")
        .groupBy("source_purchase_order_id")
        .agg(F.expr("sum(ordered_quantity - received_quantity) AS remaining"))
    )
    expected = iso_offset("expected_delivery_at")
    return _finding(
        late.join(due, "source_purchase_order_id"),
        settings,
        kind="'SUPPLIER_DELAY'",
        issue_key="concat('PO:', source_purchase_order_id)",
        entity_type="PURCHASE_ORDER",
        entity_id="source_purchase_order_id",
        resolution="expected_delivery_at",
        impact=(
            f"concat({text_of('remaining')}, ' units remain due on overdue purchase order ', source_purchase_order_id)"
        ),
        cause=f"concat('Purchase order expected on ', {expected}, ' remains partially or wholly unreceived')",
        action="'Contact the supplier and obtain a recovery date or alternate supply'",
        overdue=overdue_hours(as_of, "expected_delivery_at"),
        facts=json_object(
            {
                "purchase_order": "source_purchase_order_id",
                "status": "status",
                "expected_delivery_at": expected,
                "remaining": text_of("remaining"),
            }
        ),
    )


def shipment_delay(tables: Tables, as_of: datetime, settings: RuleSettings) -> DataFrame:
    """Undelivered shipments past their ETA. Revenue counts every line of the order, also lines
    that are fulfilled; lateness is not a severity metric of this rule."""
    value = (
        tables["order_items"]
        .groupBy("source_order_id")
        .agg(F.expr(f"sum({REMAINING} * unit_price) AS value"))
    )
    homes = tables["orders"].select("source_order_id", "source_warehouse_id")
    return _shipment_findings(tables["shipments"], homes.join(value, "source_order_id", "left"), as_of, settings)


def _shipment_findings(shipments: DataFrame, orders: DataFrame, as_of: datetime, settings: RuleSettings) -> DataFrame:
    late = shipments.where(f"status <> 'DELIVERED' AND eta < {instant_sql(as_of)}")
    rows = late.join(orders, "source_order_id").selectExpr("*", "coalesce(value, CAST(0 AS DECIMAL(38,5))) AS revenue")
    return _finding(
        rows, settings,
        kind="'SHIPMENT_DELAY'",
        issue_key="concat('SHIPMENT:', source_shipment_id)",
        entity_type="SHIPMENT",
        entity_id="source_shipment_id",
        resolution="eta",
        impact="concat('Shipment ', source_shipment_id, ' is overdue for order ', source_order_id)",
        cause=f"concat('Shipment ETA ', {iso_offset('eta')}, ' passed while status is ', status)",
        action="'Trace the shipment with the carrier and communicate a revised ETA'",
        revenue="revenue",
        orders="1",
        facts=json_object(
            {
                "shipment": "source_shipment_id",
                "status": "status",
                "eta": iso_offset("eta"),
                "order": "source_order_id",
                "revenue": fact_text("revenue"),
            }
        ),
    )


def all_findings(tables: Tables, as_of: datetime, settings: RuleSettings) -> DataFrame:
    """Findings of all six rules; `rule_ordinal` keeps their fixed order.

    The frames several rules read are checkpointed, so every table is read once.
    """
    facts = cut_lineage(order_facts(tables, as_of))
    stock = cut_lineage(stock_rows(tables["inventory"], as_of))
    orders = facts.where("fact = 'ORDER'")
    due = open_orders(orders, as_of).where(f"quantity IS NOT NULL AND {_due_soon(as_of, settings)}")
    demands = facts.where("fact = 'PLACE'").selectExpr(
        *PLACE, "CAST(quantity AS DECIMAL(38,3)) AS demand", "CAST(revenue AS DECIMAL(38,5)) AS revenue", "orders"
    )
    found = [
        _sla_findings(due.withColumnRenamed("quantity", "remaining"), as_of, settings),
        _demand_findings(demands, stock, settings, DEMAND_KINDS),
        _mismatch_findings(stock, tables["inventory_movements"], settings),
        supplier_delay(tables, as_of, settings),
        _shipment_findings(tables["shipments"], orders.select("source_order_id", "source_warehouse_id", "value"), as_of, settings),
    ]
    return reduce(DataFrame.unionByName, found)


def in_rule_order(findings: DataFrame) -> DataFrame:
    """Total order of a finding list: rule, then the entity's source keys. For sinks only."""
    placed = "CASE WHEN entity_type = 'PRODUCT_WAREHOUSE' THEN {} END"
    return findings.orderBy(
        "rule_ordinal",
        F.expr(placed.format("source_product_id")),
        F.expr(placed.format("source_warehouse_id")),
        "entity_id",
    )
