"""Read queries: filtered pages, wire projections, details, facets and exports."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from datetime import datetime
from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewatch.functions.text import (
    currency_label,
    enum_label,
    fixed_text,
    id_key,
    iso_z,
    key_id,
    money_text,
    quantity_text,
    timestamp_label,
)
from tidewatch.schema import EXCEPTION_STATUSES, EXCEPTION_TYPES, SEVERITIES
from tidewatch.settings import instant_lit, parked, utc_instant

Tables = Mapping[str, DataFrame]
PAGE_SIZE_LIMIT = 100
DEFAULT_PAGE_SIZE = 25
#: Rows up to which Spark's top-k holds what comes before a page; it has to fit in a task.
TOP_ROWS = 10_000

# Columns and headings of the exported tables.
QUEUE_COLUMNS = {
    "id": "Exception ID",
    "exception_type": "Exception type",
    "severity": "Severity",
    "status": "Status",
    "entity_type": "Entity type",
    "entity_id": "Entity ID",
    "business_impact": "Business impact",
    "revenue_at_risk": "Revenue at risk",
    "orders_affected": "Orders affected",
    "detected_at": "Detected at",
    "recommended_action": "Recommended action",
}
HISTORY_COLUMNS = {
    "id": "History ID",
    "from_status": "Previous status",
    "to_status": "New status",
    "changed_at": "Changed at",
    "actor": "Changed by",
    "transition_reason": "Reason",
}
PURCHASE_ORDER_COLUMNS = {
    "source_purchase_order_id": "Purchase order ID",
    "po_number": "PO number",
    "source_supplier_id": "Supplier ID",
    "supplier_name": "Supplier",
    "source_warehouse_id": "Warehouse ID",
    "status": "Status",
    "ordered_at": "Ordered at",
    "expected_delivery_at": "Expected delivery",
    "received_at": "Received at",
    "remaining_quantity": "Remaining quantity",
}
FACETS = {
    "status": EXCEPTION_STATUSES,
    "exception_type": EXCEPTION_TYPES,
    "severity": SEVERITIES,
}


# Filters ---------------------------------------------------------------------


def one_of(column: str, values: Iterable[str] | None) -> Column:
    """Any of the values; no values means no filter."""
    chosen = list(values or ())
    return F.col(column).isin(*chosen) if chosen else F.lit(True)


def equals(column: str, value: str | None) -> Column:
    return F.lit(True) if value is None else F.col(column) == value


def within(column: str, start: datetime | str | None = None, end: datetime | str | None = None) -> Column:
    """Inclusive time range; bounds without a timezone are refused."""
    keep = F.lit(True)
    if start is not None:
        keep = keep & (F.col(column) >= instant_lit(start))
    if end is not None:
        keep = keep & (F.col(column) <= instant_lit(end))
    return keep


def bounded(column: str, low: Decimal | None = None, high: Decimal | None = None) -> Column:
    keep = F.lit(True)
    if low is not None:
        keep = keep & (F.col(column) >= F.lit(Decimal(low)))
    if high is not None:
        keep = keep & (F.col(column) <= F.lit(Decimal(high)))
    return keep


def nonblank_filters(**values: str | Iterable[str] | None) -> dict[str, object]:
    """Drop blank texts and empty lists, trim the rest."""
    kept: dict[str, object] = {}
    for name, value in values.items():
        if isinstance(value, str):
            if value.strip():
                kept[name] = value.strip()
        elif value:
            kept[name] = list(value)
    return kept


# Pages -----------------------------------------------------------------------


def check_page(number: int, size: int) -> None:
    if number < 1 or not 1 <= size <= PAGE_SIZE_LIMIT:
        raise ValueError(f"page starts at 1 and holds 1 to {PAGE_SIZE_LIMIT} rows")


def page(
    rows: DataFrame,
    keys: tuple[str, ...],
    number: int = 1,
    size: int = DEFAULT_PAGE_SIZE,
    *,
    after: tuple | None = None,
) -> DataFrame:
    """One page in stable key order, however deep.

    A page near the start is a top-k. A deeper one is found by counting: rows are dealt out by key
    ranges, the ranges' row counts add up to where each range starts, and only the ranges that overlap
    the page are numbered. `after`, the last key of the page before, needs no counting at all.
    """
    check_page(number, size)
    if after is not None:
        here = F.struct(*[F.col(key) for key in keys])
        there = F.struct(*[F.lit(value).alias(key) for key, value in zip(keys, after, strict=True)])
        return rows.where(here > there).orderBy(*keys).limit(size)
    skipped = (number - 1) * size
    if skipped + size <= TOP_ROWS:
        return rows.orderBy(*keys).offset(skipped).limit(size)
    dealt = parked(rows.repartitionByRange(*keys).withColumn("_range", F.spark_partition_id()))
    earlier = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)  # one row per range
    counts = dealt.groupBy("_range").count().withColumn("_start", F.coalesce(F.sum("count").over(earlier), F.lit(0)))
    near = counts.where((F.col("_start") < skipped + size) & (F.col("_start") + F.col("count") > skipped))
    place = F.col("_start") + F.row_number().over(Window.partitionBy("_range").orderBy(*keys))
    numbered = dealt.join(near.select("_range", "_start"), "_range").withColumn("_place", place)
    return numbered.where((F.col("_place") > skipped) & (F.col("_place") <= skipped + size)).orderBy(*keys).select(*rows.columns)


def page_total(rows: DataFrame) -> DataFrame:
    return rows.agg(F.count(F.lit(1)).alias("total"))


# Orders ----------------------------------------------------------------------


def orders_where(
    orders: DataFrame,
    *,
    statuses: Iterable[str] | None = None,
    region: str | None = None,
    warehouse_id: str | None = None,
    ordered_from: datetime | str | None = None,
    ordered_to: datetime | str | None = None,
    date_from: datetime | str | None = None,
    date_to: datetime | str | None = None,
) -> DataFrame:
    return orders.where(
        one_of("status", statuses)
        & equals("region", region)
        & equals("source_warehouse_id", warehouse_id)
        & within("ordered_at", ordered_from or date_from, ordered_to or date_to)
    )


def order_wire(orders: DataFrame) -> DataFrame:
    return orders.select(
        "source_order_id", "order_number", "status", "region", "source_warehouse_id",
        F.expr(iso_z("ordered_at")).alias("ordered_at"),
        F.expr(iso_z("promised_at")).alias("promised_at"),
        F.expr(iso_z("fulfilled_at")).alias("fulfilled_at"),
        F.expr(money_text("total_amount")).alias("total_amount"),
        "currency",
    )


def order_lines_wire(chosen: DataFrame, items: DataFrame, products: DataFrame) -> DataFrame:
    """Lines of the chosen orders, one row each, with the product's SKU."""
    lines = items.join(chosen.select("source_order_id"), "source_order_id", "left_semi")
    return lines.join(products.select("source_product_id", "sku"), "source_product_id").select(
        "source_order_id", "line_number", "source_product_id", "sku",
        F.expr(quantity_text("ordered_quantity")).alias("ordered_quantity"),
        F.expr(quantity_text("fulfilled_quantity")).alias("fulfilled_quantity"),
        F.expr(money_text("unit_price")).alias("unit_price"),
    )


def order_shipments_wire(chosen: DataFrame, shipments: DataFrame) -> DataFrame:
    sent = shipments.join(chosen.select("source_order_id"), "source_order_id", "left_semi")
    return sent.select(
        "source_order_id", "source_shipment_id", "carrier", "tracking_id", "status",
        *[F.expr(iso_z(name)).alias(name) for name in ("shipped_at", "eta", "delivered_at")],
    )


def order_detail(tables: Tables, source_order_id: str) -> dict[str, DataFrame]:
    """One order as three frames: the order, its lines and its shipments."""
    chosen = tables["orders"].where(F.col("source_order_id") == source_order_id)
    return {
        "order": order_wire(chosen),
        "items": order_lines_wire(chosen, tables["order_items"], tables["products"]),
        "shipments": order_shipments_wire(chosen, tables["shipments"]),
    }


# Inventory, purchase orders, shipments ----------------------------------------


def inventory_where(
    tables: Tables,
    *,
    product_id: str | None = None,
    warehouse_id: str | None = None,
    sku: str | None = None,
    available_max: Decimal | None = None,
    observed_from: datetime | str | None = None,
    observed_to: datetime | str | None = None,
) -> DataFrame:
    rows = tables["inventory"].withColumn("available", F.col("on_hand") - F.col("reserved")).where(
        equals("source_product_id", product_id)
        & equals("source_warehouse_id", warehouse_id)
        & bounded("available", high=available_max)
        & within("observed_at", observed_from, observed_to)
    )
    if sku is not None:
        named = tables["products"].where(F.col("sku") == sku).select("source_product_id")
        rows = rows.join(named, "source_product_id", "left_semi")
    return rows


def inventory_wire(rows: DataFrame, products: DataFrame) -> DataFrame:
    names = products.select("source_product_id", "sku", F.col("name").alias("product_name"))
    return rows.join(names, "source_product_id").select(
        "source_product_id", "source_warehouse_id", "sku", "product_name",
        *[F.expr(quantity_text(name)).alias(name) for name in ("on_hand", "reserved", "available")],
        F.expr(iso_z("observed_at")).alias("observed_at"),
    )


def purchase_orders_where(
    tables: Tables,
    *,
    statuses: Iterable[str] | None = None,
    supplier_id: str | None = None,
    warehouse_id: str | None = None,
    expected_from: datetime | str | None = None,
    expected_to: datetime | str | None = None,
    ordered_from: datetime | str | None = None,
    ordered_to: datetime | str | None = None,
    date_from: datetime | str | None = None,
    date_to: datetime | str | None = None,
    remaining_min: Decimal | None = None,
    remaining_max: Decimal | None = None,
    remaining_quantity_min: Decimal | None = None,
    remaining_quantity_max: Decimal | None = None,
) -> DataFrame:
    """Purchase orders with their remaining quantity, summed per order before the join."""
    due = (
        tables["purchase_order_items"]
        .groupBy("source_purchase_order_id")
        .agg(
            F.sum(F.col("ordered_quantity") - F.coalesce("received_quantity", F.lit(0))).alias("due")
        )
    )
    low = remaining_min if remaining_min is not None else remaining_quantity_min
    high = remaining_max if remaining_max is not None else remaining_quantity_max
    return (
        tables["purchase_orders"]
        .where(
            one_of("status", statuses)
            & equals("source_supplier_id", supplier_id)
            & equals("source_warehouse_id", warehouse_id)
            & within("expected_delivery_at", expected_from, expected_to)
            & within("ordered_at", ordered_from or date_from, ordered_to or date_to)
        )
        .join(due, "source_purchase_order_id", "left")
        .withColumn("remaining_quantity", F.coalesce("due", F.lit(0).cast("decimal(38,3)")))
        .drop("due")
        .where(bounded("remaining_quantity", low, high))
    )


def purchase_order_wire(rows: DataFrame, suppliers: DataFrame) -> DataFrame:
    names = suppliers.select("source_supplier_id", F.col("name").alias("supplier_name"))
    return rows.join(names, "source_supplier_id").select(
        "source_purchase_order_id", "po_number", "source_supplier_id", "supplier_name",
        "source_warehouse_id", "status",
        *[F.expr(iso_z(name)).alias(name) for name in ("ordered_at", "expected_delivery_at", "received_at")],
        F.expr(quantity_text("remaining_quantity")).alias("remaining_quantity"),
    )


def supplier_context(tables: Tables, supplier_id: str = "", warehouse_id: str = "") -> DataFrame:
    """Every purchase order of a supplier (and warehouse); blank texts filter nothing."""
    chosen = nonblank_filters(supplier_id=supplier_id, warehouse_id=warehouse_id)
    return purchase_order_wire(purchase_orders_where(tables, **chosen), tables["suppliers"])


def shipments_where(
    tables: Tables,
    *,
    statuses: Iterable[str] | None = None,
    carrier: str | None = None,
    order_id: str | None = None,
    warehouse_id: str | None = None,
    eta_from: datetime | str | None = None,
    eta_to: datetime | str | None = None,
) -> DataFrame:
    """Shipments with the warehouse of their order."""
    rows = tables["shipments"].where(
        one_of("status", statuses)
        & equals("carrier", carrier)
        & equals("source_order_id", order_id)
        & within("eta", eta_from, eta_to)
    )
    homes = tables["orders"].where(equals("source_warehouse_id", warehouse_id))
    return rows.join(homes.select("source_order_id", "source_warehouse_id"), "source_order_id")


def shipment_wire(rows: DataFrame) -> DataFrame:
    return rows.select(
        "source_shipment_id", "source_order_id", "source_warehouse_id", "carrier", "tracking_id", "status",
        *[F.expr(iso_z(name)).alias(name) for name in ("shipped_at", "eta", "delivered_at")],
    )


# Exceptions ------------------------------------------------------------------


def queue_anchor(
    detected_to: datetime | str | None, as_of: datetime | str | None, default_as_of: datetime
) -> datetime:
    """Latest detection time a queue may show: never later than its evaluation instant."""
    anchor = utc_instant(as_of if as_of is not None else default_as_of)
    return anchor if detected_to is None else min(utc_instant(detected_to), anchor)


def _queue_base(
    state: DataFrame,
    *,
    entity: str | None = None,
    entity_type: str | None = None,
    entity_id: str | None = None,
    product_id: str | None = None,
    warehouse_id: str | None = None,
    detected_from: datetime | str | None = None,
    detected_to: datetime | str | None = None,
) -> DataFrame:
    named = {"entity_id": entity_id, "source_product_id": product_id, "source_warehouse_id": warehouse_id}
    rows = state.where(within("detected_at", detected_from, detected_to))
    for name, value in [("entity_type", entity), ("entity_type", entity_type), *named.items()]:
        if value is not None:
            rows = rows.where(equals(name, value))
    return rows


def exceptions_where(
    state: DataFrame,
    *,
    types: Iterable[str] | None = None,
    exception_types: Iterable[str] | None = None,
    severities: Iterable[str] | None = None,
    statuses: Iterable[str] | None = None,
    **others,
) -> DataFrame:
    """Exception queue; `types` and `exception_types` name the same filter and add up."""
    return _queue_base(state, **others).where(
        one_of("exception_type", [*(exception_types or ()), *(types or ())])
        & one_of("severity", severities)
        & one_of("status", statuses)
    )


#: Order of creation: run, rule, then entity.
QUEUE_ORDER = ("run_sequence", "rule_ordinal", "entity_id", "id")


def exception_wire(state: DataFrame) -> DataFrame:
    return state.select(
        F.col("exception_id").alias("id"),
        "exception_type", "issue_key", "entity_type", "entity_id", "severity", "status",
        F.expr(iso_z("detected_at")).alias("detected_at"),
        F.expr(iso_z("expected_resolution")).alias("expected_resolution"),
        "business_impact",
        F.expr(money_text("revenue_at_risk")).alias("revenue_at_risk"),
        "orders_affected", "root_cause", "recommended_action",
        F.expr(fixed_text("confidence", 4)).alias("confidence"),
        "source_warehouse_id", "source_product_id",
        F.expr(iso_z("resolved_at")).alias("resolved_at"),
        "run_sequence", "rule_ordinal",
    )


def history_wire(history: DataFrame) -> DataFrame:
    return history.select(
        F.concat_ws("-", "exception_id", "entry").alias("id"),
        "exception_id", "from_status", "to_status",
        F.expr(iso_z("changed_at")).alias("changed_at"),
        "actor", "transition_reason", "entry",
    )


def exceptions_with_history(state: DataFrame, history: DataFrame) -> DataFrame:
    """Exceptions with their history, oldest entry first. The status graph bounds a history to a
    handful of entries per exception, so the array stays small."""
    told = ("from_status", "to_status", "actor", "transition_reason")
    entries = history_wire(history).groupBy(F.expr(id_key("exception_id")).alias("id")).agg(F.sort_array(F.collect_list(F.struct("changed_at", "entry", *told))).alias("entries"))
    rows = exception_wire(state)
    met = rows.withColumn("id", F.expr(id_key("id"))).join(entries, "id", "left").withColumn("id", F.expr(key_id("id")))
    # An entry's own id follows from the exception's.
    whole = ", ".join(f"h.{name} AS {name}" for name in told)
    shown = f"transform(entries, h -> struct(h.changed_at AS changed_at, h.entry AS entry, concat_ws('-', id, h.entry) AS id, {whole}))"
    return met.select(*rows.columns, F.expr(shown).alias("history"))


def exception_detail(state: DataFrame, history: DataFrame, exception_id: str) -> DataFrame:
    match = F.col("exception_id") == exception_id
    return exceptions_with_history(state.where(match), history.where(match))


def facet_counts(
    state: DataFrame,
    *,
    statuses: Iterable[str] | None = None,
    exception_types: Iterable[str] | None = None,
    severities: Iterable[str] | None = None,
    **others,
) -> DataFrame:
    """Counts per facet value, each dimension ignoring its own filter; all values appear.

    One aggregate over one scan computes every value. `state` may be exceptions that are counted already
    (`kpi.count_cube`); of the other filters, these know the range of detection only.
    """
    each = F.col("exceptions") if "exceptions" in state.columns else F.lit(1)
    chosen = {"status": statuses, "exception_type": exception_types, "severity": severities}
    sums, cells = [], []
    for dimension, values in FACETS.items():
        keep = F.lit(True)
        for other, picked in chosen.items():
            if other != dimension:
                keep = keep & one_of(other, picked)
        for value in values:
            name = f"{dimension}__{value}"
            sums.append(F.coalesce(F.sum(F.when(keep & (F.col(dimension) == value), each)), F.lit(0)).cast("long").alias(name))
            cells.append(
                f"struct('{dimension}' AS dimension, '{value}' AS value, {name} AS count)"
            )
    return _queue_base(state, **others).agg(*sums).selectExpr(f"inline(array({', '.join(cells)}))")


# Exports ---------------------------------------------------------------------


def queue_rows(state: DataFrame) -> DataFrame:
    """The flat columns of the queue export."""
    return exception_wire(state).select(*QUEUE_COLUMNS)


def shown_queue(rows: DataFrame) -> DataFrame:
    def cell(name: str) -> Column:
        if name in ("exception_type", "severity", "status"):
            return F.expr(enum_label(name))
        if name == "revenue_at_risk":
            return F.expr(currency_label(name))
        return F.expr(timestamp_label(name)) if name == "detected_at" else F.col(name)

    return rows.select(*[cell(name).alias(label) for name, label in QUEUE_COLUMNS.items()])


def shown_history(rows: DataFrame) -> DataFrame:
    def cell(name: str) -> Column:
        if name in ("from_status", "to_status"):
            return F.expr(enum_label(name))
        return F.expr(timestamp_label(name)) if name == "changed_at" else F.col(name)

    return rows.select(*[cell(name).alias(label) for name, label in HISTORY_COLUMNS.items()])


def shown_purchase_orders(rows: DataFrame) -> DataFrame:
    def cell(name: str) -> Column:
        if name == "status":
            return F.expr(enum_label(name))
        return F.expr(timestamp_label(name)) if name.endswith("_at") else F.col(name)

    return rows.select(*[cell(name).alias(label) for name, label in PURCHASE_ORDER_COLUMNS.items()])
