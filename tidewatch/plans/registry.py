"""Registered queries: one callable (session, data folder) -> DataFrame per operator."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from decimal import Decimal

from tidewatch.functions.text import iso_z, plain_decimal_text
from tidewatch.operators import (
    audit,
    external,
    kpi,
    lifecycle,
    observations,
    preflight,
    promotion,
    reads,
    rules,
    validate,
    versions,
)
from tidewatch.plans import exports, feeds, intake, loads, runs, starmap
from tidewatch.schema import BY_TABLE
from tidewatch.settings import RuleSettings, configure, parked

Query = Callable[[SparkSession, str], DataFrame]
SETTINGS = RuleSettings(as_of=starmap.AS_OF)
AS_OF = starmap.AS_OF

_QUERIES: dict[str, Query] = {}


def query(build: Query) -> Query:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        return build(configure(spark), folder)

    _QUERIES[build.__name__] = run
    return run


def _flat(findings: DataFrame) -> DataFrame:
    """Findings with their instant as text, so results compare across engines."""
    return findings.withColumn("expected_resolution", F.expr(iso_z("expected_resolution"))).drop("confidence")


@query
def rule_sla_breach(spark: SparkSession, folder: str) -> DataFrame:
    return _flat(rules.sla_breach_risk(starmap.tables(spark, folder), AS_OF, SETTINGS))


@query
def rule_inventory_shortage(spark: SparkSession, folder: str) -> DataFrame:
    return _flat(rules.inventory_shortage(starmap.tables(spark, folder), AS_OF, SETTINGS))


@query
def rule_stockout(spark: SparkSession, folder: str) -> DataFrame:
    return _flat(rules.stockout_risk(starmap.tables(spark, folder), AS_OF, SETTINGS))


@query
def rule_inventory_mismatch(spark: SparkSession, folder: str) -> DataFrame:
    return _flat(rules.inventory_mismatch(starmap.tables(spark, folder), AS_OF, SETTINGS))


@query
def rule_supplier_delay(spark: SparkSession, folder: str) -> DataFrame:
    return _flat(rules.supplier_delay(starmap.tables(spark, folder), AS_OF, SETTINGS))


@query
def rule_shipment_delay(spark: SparkSession, folder: str) -> DataFrame:
    return _flat(rules.shipment_delay(starmap.tables(spark, folder), AS_OF, SETTINGS))


def _findings(spark: SparkSession, folder: str) -> DataFrame:
    return rules.all_findings(starmap.tables(spark, folder), AS_OF, SETTINGS)


@query
def detect_all(spark: SparkSession, folder: str) -> DataFrame:
    return _flat(_findings(spark, folder))


@query
def open_demand(spark: SparkSession, folder: str) -> DataFrame:
    return rules.open_demand(starmap.tables(spark, folder), AS_OF)


@query
def latest_snapshot(spark: SparkSession, folder: str) -> DataFrame:
    """Newest of three snapshots per place: the current one, one a day older, and a same-time
    recount that only its later sequence number puts first."""
    stock = starmap.inventory(spark, folder)
    generations = [
        stock.withColumn("snapshot_sequence", F.lit(1)),
        stock.withColumn("observed_at", F.col("observed_at") - F.make_dt_interval(days=F.lit(1)))
        .withColumn("on_hand", (F.col("on_hand") + 1).cast("decimal(18,3)"))
        .withColumn("snapshot_sequence", F.lit(3)),
        stock.where(F.col("on_hand") > 50)
        .withColumn("on_hand", (F.col("on_hand") - 1).cast("decimal(18,3)"))
        .withColumn("snapshot_sequence", F.lit(2)),
    ]
    history = generations[0].unionByName(generations[1]).unionByName(generations[2])
    return rules.latest_snapshots(history, AS_OF).withColumn("observed_at", F.expr(iso_z("observed_at")))


@query
def movement_reconstruction(spark: SparkSession, folder: str) -> DataFrame:
    tables = starmap.tables(spark, folder)
    rebuilt = rules.reconstructed_on_hand(
        rules.latest_snapshots(tables["inventory"], AS_OF), tables["inventory_movements"]
    )
    return rebuilt.select(*rules.PLACE, "on_hand", "reconstructed")


@query
def severity_by_type(spark: SparkSession, folder: str) -> DataFrame:
    return (
        _findings(spark, folder)
        .groupBy("exception_type", "severity")
        .agg(F.count(F.lit(1)).alias("findings"), F.sum("revenue_at_risk").cast("decimal(38,5)").alias("revenue"))
    )


@query
def fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    return _findings(spark, folder).select("exception_type", "issue_key", "fingerprint", "deduplication_key")


# State and lifecycle ---------------------------------------------------------


def _stored(state: DataFrame) -> DataFrame:
    return state.select(
        F.col("exception_id").alias("id"), "deduplication_key", "exception_type", "issue_key", "entity_id",
        "severity", "status", F.expr(iso_z("detected_at")).alias("detected_at"), "business_impact",
        "revenue_at_risk", "orders_affected", "root_cause", F.expr(iso_z("resolved_at")).alias("resolved_at"),
        "run_sequence", "rule_ordinal",
    )


@query
def persist_first_run(spark: SparkSession, folder: str) -> DataFrame:
    return _stored(runs.first_run(spark, folder).state)


@query
def persist_rerun_state(spark: SparkSession, folder: str) -> DataFrame:
    return _stored(runs.second_run(spark, folder).state)


@query
def persist_rerun_outcomes(spark: SparkSession, folder: str) -> DataFrame:
    return runs.second_run(spark, folder).outcomes


@query
def run_counters(spark: SparkSession, folder: str) -> DataFrame:
    return runs.second_run(spark, folder).counters()


@query
def lifecycle_transitions(spark: SparkSession, folder: str) -> DataFrame:
    return runs.review(spark, folder).requests.drop("changed_at")


@query
def lifecycle_sample(spark: SparkSession, folder: str) -> DataFrame:
    state = runs.first_run(spark, folder).state
    walked = lifecycle.apply_transitions(state, lifecycle.sample_requests(state, runs.REVIEWED_AT))
    return walked.requests.drop("changed_at")


@query
def history_log(spark: SparkSession, folder: str) -> DataFrame:
    first = runs.first_run(spark, folder)
    reviewed = runs.review_of(first)
    return reads.history_wire(first.new_history.unionByName(reviewed.new_history))


# Read queries ----------------------------------------------------------------


def _reviewed(spark: SparkSession, folder: str) -> DataFrame:
    return runs.review(spark, folder).state


@query
def kpi_summary(spark: SparkSession, folder: str) -> DataFrame:
    return kpi.summary(starmap.orders(spark, folder), _reviewed(spark, folder), AS_OF)


@query
def kpi_display(spark: SparkSession, folder: str) -> DataFrame:
    return kpi.shown_summary(kpi.summary(starmap.orders(spark, folder), _reviewed(spark, folder), AS_OF))


@query
def exception_queue_page(spark: SparkSession, folder: str) -> DataFrame:
    """Third page of open stockout and SLA findings up to the evaluation instant."""
    anchor = reads.queue_anchor("1999-01-01T00:00:00Z", AS_OF, SETTINGS.as_of)
    queue = reads.exceptions_where(
        _reviewed(spark, folder),
        types=["STOCKOUT_RISK"], exception_types=["SLA_BREACH_RISK"],
        severities=["CRITICAL", "MEDIUM"], statuses=["OPEN"], detected_to=anchor,
    )
    return reads.page(reads.exception_wire(queue), reads.QUEUE_ORDER, number=3, size=100)


@query
def exception_queue_total(spark: SparkSession, folder: str) -> DataFrame:
    queue = reads.exceptions_where(
        _reviewed(spark, folder), entity="PRODUCT_WAREHOUSE", warehouse_id="W3", statuses=["OPEN", "DISMISSED"],
    )
    return reads.page_total(queue)


@query
def exception_facets(spark: SparkSession, folder: str) -> DataFrame:
    return reads.facet_counts(
        _reviewed(spark, folder), statuses=["OPEN"], severities=["CRITICAL", "LOW"],
        exception_types=["SLA_BREACH_RISK", "STOCKOUT_RISK"], detected_to=AS_OF,
    )


@query
def exception_detail(spark: SparkSession, folder: str) -> DataFrame:
    """Every exception with its ordered history, the history flattened to one text."""
    first = runs.first_run(spark, folder)
    reviewed = runs.review_of(first)
    history = first.new_history.unionByName(reviewed.new_history)
    rows = reads.exceptions_with_history(reviewed.state, history)
    steps = F.transform("history", lambda h: F.concat_ws(">", F.coalesce(h["from_status"], F.lit("NEW")), h["to_status"]))
    return rows.select("id", "status", "resolved_at", "confidence", F.array_join(steps, ";").alias("walk"))


@query
def orders_page(spark: SparkSession, folder: str) -> DataFrame:
    orders = reads.orders_where(
        starmap.orders(spark, folder), statuses=["OPEN", "FULFILLED"], region="REGION_2",
        ordered_from="1996-01-01T00:00:00Z", ordered_to="1998-01-01T00:00:00+00:00",
    )
    return reads.page(reads.order_wire(orders), ("source_order_id",), number=2, size=50)


@query
def orders_page_after_key(spark: SparkSession, folder: str) -> DataFrame:
    orders = reads.orders_where(starmap.orders(spark, folder), warehouse_id="W7")
    return reads.page(reads.order_wire(orders), ("source_order_id",), size=25, after=("O5",))


@query
def order_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Lines of every cancelled order, as its detail view shows them."""
    tables = starmap.tables(spark, folder)
    chosen = reads.orders_where(tables["orders"], statuses=["CANCELLED"])
    return reads.order_lines_wire(chosen, tables["order_items"], tables["products"])


@query
def order_detail(spark: SparkSession, folder: str) -> DataFrame:
    """A page of orders, their lines and their shipments, one flat row for each."""
    tables = starmap.tables(spark, folder)
    matching = reads.orders_where(tables["orders"], statuses=["OPEN"], warehouse_id="W4")
    chosen = parked(reads.page(matching, ("source_order_id",), size=100))
    lines = reads.order_lines_wire(chosen, tables["order_items"], tables["products"])
    sent = reads.order_shipments_wire(chosen, tables["shipments"])
    return (
        reads.order_wire(chosen)
        .selectExpr("source_order_id", "'order' AS part", "order_number AS child", "concat(status, '/', total_amount) AS content")
        .unionByName(lines.selectExpr("source_order_id", "'item' AS part", "concat(line_number, '/', sku) AS child", "ordered_quantity AS content"))
        .unionByName(sent.selectExpr("source_order_id", "'shipment' AS part", "source_shipment_id AS child", "concat(carrier, '/', status) AS content"))
    )


@query
def order_lookup(spark: SparkSession, folder: str) -> DataFrame:
    """One order with its lines."""
    found = reads.order_detail(starmap.tables(spark, folder), "O7")
    return found["order"].join(found["items"], "source_order_id").select("source_order_id", "order_number", "status", "line_number", "sku", "ordered_quantity")


@query
def inventory_list(spark: SparkSession, folder: str) -> DataFrame:
    tables = starmap.tables(spark, folder)
    rows = reads.inventory_where(
        tables, available_max=Decimal("-5"), observed_from="1996-06-01T00:00:00Z", observed_to="1998-06-30T00:00:00Z"
    )
    return reads.inventory_wire(rows, tables["products"])


@query
def inventory_by_sku(spark: SparkSession, folder: str) -> DataFrame:
    tables = starmap.tables(spark, folder)
    wire = reads.inventory_wire(reads.inventory_where(tables, sku="SKU-7"), tables["products"])
    return reads.page(wire, ("source_product_id", "source_warehouse_id"), size=20)


@query
def purchase_orders_remaining(spark: SparkSession, folder: str) -> DataFrame:
    tables = starmap.tables(spark, folder)
    rows = reads.purchase_orders_where(
        tables, statuses=["OPEN", "PARTIALLY_RECEIVED"], date_from="1997-01-01T00:00:00Z",
        expected_to="1999-01-01T00:00:00Z", remaining_min=Decimal("40"), remaining_quantity_max=Decimal("180.5"),
    )
    return reads.purchase_order_wire(rows, tables["suppliers"])


@query
def supplier_context(spark: SparkSession, folder: str) -> DataFrame:
    return reads.supplier_context(starmap.tables(spark, folder), supplier_id=" SUP7 ", warehouse_id=" ")


@query
def shipments_list(spark: SparkSession, folder: str) -> DataFrame:
    rows = reads.shipments_where(
        starmap.tables(spark, folder), statuses=["IN_TRANSIT", "EXCEPTION"], carrier="SEA",
        eta_from="1997-01-01T00:00:00Z", eta_to="1998-07-01T00:00:00Z",
    )
    return reads.shipment_wire(rows)


@query
def queue_export(spark: SparkSession, folder: str) -> DataFrame:
    """Display form of every queue row."""
    shown = reads.shown_queue(reads.queue_rows(_reviewed(spark, folder)))
    return shown.toDF(*[name.lower().replace(" ", "_") for name in shown.columns])


@query
def purchase_order_display(spark: SparkSession, folder: str) -> DataFrame:
    tables = starmap.tables(spark, folder)
    shown = reads.shown_purchase_orders(
        reads.purchase_order_wire(reads.purchase_orders_where(tables), tables["suppliers"])
    )
    return shown.toDF(*[name.lower().replace(" ", "_") for name in shown.columns])


# Validation and loading ------------------------------------------------------


@query
def validate_rejections(spark: SparkSession, folder: str) -> DataFrame:
    return validate.validate_bundle(spark, intake.raw_bundle(spark, folder))[1]


@query
def validate_summary(spark: SparkSession, folder: str) -> DataFrame:
    raw = intake.raw_bundle(spark, folder)
    return validate.summarise(*validate.validate_bundle(spark, raw))


@query
def duplicate_conflicts(spark: SparkSession, folder: str) -> DataFrame:
    """Movements with one id that differ by less than a millisecond."""
    return validate.validate_rows(intake.raw_receipts(spark, folder), "wms/inventory_movements.csv").rejections


@query
def duplicate_counts(spark: SparkSession, folder: str) -> DataFrame:
    return validate.validate_rows(intake.raw_receipts(spark, folder), "wms/inventory_movements.csv").counts


@query
def header_differences(spark: SparkSession, folder: str) -> DataFrame:
    """Headers of files that hold the test tables, against the contracts of the artifacts they stand for."""
    names = {"oms/orders.csv": "orders", "wms/warehouses.csv": "nation"}
    return validate.header_faults(spark, {artifact: tuple(starmap.read(spark, folder, table).columns) for artifact, table in names.items()})


@query
def validated_items(spark: SparkSession, folder: str) -> DataFrame:
    """Accepted order lines in stored form."""
    results, _ = validate.validate_bundle(spark, intake.raw_bundle(spark, folder))
    return preflight.stored_form(results["oms/order_items.csv"].rows, BY_TABLE["order_items"])


def _incoming_orders(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """Stored orders, and a later delivery: changed, equal and new ones."""
    rows = starmap.orders(spark, folder)
    number = "CAST(substr(source_order_id, 2) AS BIGINT)"
    stored = rows.where(f"{number} % 4 <> 3")
    changed = rows.selectExpr(
        *[name for name in rows.columns if name != "total_amount"],
        f"CAST(CASE WHEN {number} % 5 = 0 THEN total_amount + 1 ELSE total_amount END AS DECIMAL(14,2)) AS total_amount",
    ).select(*rows.columns)
    return stored, changed


@query
def preflight_outcomes(spark: SparkSession, folder: str) -> DataFrame:
    stored, incoming = _incoming_orders(spark, folder)
    return preflight.preflight(incoming, stored, BY_TABLE["orders"]).select("source_order_id", "outcome")


@query
def preflight_conflicts(spark: SparkSession, folder: str) -> DataFrame:
    stored, incoming = _incoming_orders(spark, folder)
    orders = BY_TABLE["orders"]
    return preflight.conflicts(preflight.preflight(incoming, stored, orders), orders)


@query
def inventory_freshness(spark: SparkSession, folder: str) -> DataFrame:
    stored = starmap.inventory(spark, folder)
    number = "CAST(substr(source_product_id, 2) AS BIGINT)"
    incoming = stored.selectExpr(
        "source_product_id", "source_warehouse_id",
        f"CAST(CASE WHEN {number} % 5 = 0 THEN on_hand + 1 ELSE on_hand END AS DECIMAL(18,3)) AS on_hand", "reserved",
        f"observed_at + make_dt_interval(CAST({number} % 3 - 1 AS INT)) AS observed_at",
    )
    held = stored.where(f"{number} % 7 <> 0")
    checked = preflight.preflight(incoming, held, BY_TABLE["inventory"])
    return checked.select("source_product_id", "source_warehouse_id", "outcome")


@query
def inventory_after_load(spark: SparkSession, folder: str) -> DataFrame:
    stored = starmap.inventory(spark, folder)
    number = "CAST(substr(source_product_id, 2) AS BIGINT)"
    incoming = stored.where(f"{number} % 2 = 0").selectExpr(
        "source_product_id", "source_warehouse_id", "CAST(on_hand + 1 AS DECIMAL(18,3)) AS on_hand", "reserved",
        f"CASE WHEN {number} % 4 = 0 THEN observed_at + INTERVAL '1' DAY ELSE observed_at END AS observed_at",
    )
    held = stored.where(f"{number} % 6 <> 0")
    checked = preflight.preflight(incoming, held, BY_TABLE["inventory"])
    after = preflight.apply_rows(checked, held, BY_TABLE["inventory"])
    return after.selectExpr("source_product_id", "source_warehouse_id", "on_hand", f"{iso_z('observed_at')} AS observed_at")


@query
def ingest_counters(spark: SparkSession, folder: str) -> DataFrame:
    """What loads of a whole bundle count: refused for a wrong manifest, and loaded."""
    return loads.counted_loads(spark, folder)


@query
def constraint_audit(spark: SparkSession, folder: str) -> DataFrame:
    """Violations in all ten tables; the line keys of the source clash."""
    return audit.audit_tables(starmap.tables(spark, folder))


@query
def constraint_audit_state(spark: SparkSession, folder: str) -> DataFrame:
    """Violations planted among exceptions, their history, observations, identities, receipts, promoted orders and versions."""
    first = runs.first_run(spark, folder)
    digit = "substr(deduplication_key, 1, 1)"
    changed = {
        "orders_affected": f"CAST(IF({digit} = '1', -1, orders_affected) AS INT)", "status": f"IF({digit} = '2', 'PAUSED', status)",
        "source_warehouse_id": f"IF({digit} = '4', concat('gone-', source_warehouse_id), source_warehouse_id)",
    }
    state = first.state.selectExpr(*(f"{changed.get(name, name)} AS {name}" for name in first.state.columns))
    twice = state.where(f"{digit} = '0'").withColumn("exception_id", F.concat(F.lit("again-"), "exception_id"))
    history = first.new_history.withColumn("exception_id", F.expr("IF(exception_id LIKE '3%', concat('gone-', exception_id), exception_id)"))
    staged = observations.stage(observations.assess(feeds.number_claims(spark, folder)), durable=True)
    evidence = staged.observations.withColumn("total_amount", F.expr("IF(sequence % 70 = 1, -total_amount, total_amount)"))
    evidence = evidence.unionByName(evidence.where("sequence % 110 = 2")).withColumn("superseded_by", F.expr("IF(sequence % 130 = 3, 'nothing', superseded_by)"))
    control = exports.monthly_versions(spark, folder)
    tables = {
        "products": starmap.products(spark, folder), "warehouses": starmap.warehouses(spark, folder),
        "exceptions": state.unionByName(twice), "exception_history": history, "order_observations": evidence,
        "source_order_identities": observations.identities(staged.observations).where("NOT source_order_id LIKE 'A%00'"),
        "order_observation_receipts": staged.receipts,
        "promoted_orders": feeds.held_orders(spark, folder).withColumn("order_number", F.expr("IF(source_order_id LIKE '%7', 'same', order_number)")),
        "dataset_versions": control.versions.withColumn("status", F.expr("IF(dataset_version_id % 100 = 5, 'LOST', status)")),
    }
    # The ids of observations are digests, which the twin does not spell out.
    return audit.audit_tables(tables, audit.RECORDED).selectExpr(
        "table_name", "kind", "violated", "IF(table_name = 'order_observations' AND kind <> 'REFERENCE', '', row_key) AS row_key", "rows"
    )


@query
def append_only_audit(spark: SparkSession, folder: str) -> DataFrame:
    """History rows that a later version lost or changed: planted ones, so the audit has work."""
    history = runs.first_run(spark, folder).new_history
    tampered = history.where("exception_id NOT LIKE 'a%'").selectExpr(
        "exception_id", "to_status", "CASE WHEN exception_id LIKE 'b%' THEN 'someone' ELSE actor END AS actor"
    )
    return audit.append_only_violations(history, tampered, ["exception_id", "to_status", "actor"])


# Order observations ----------------------------------------------------------


@query
def observation_assess(spark: SparkSession, folder: str) -> DataFrame:
    assessed = observations.assess(feeds.raw_observations(spark, folder), starmap.warehouses(spark, folder))
    return assessed.selectExpr(
        "sequence", "batch_id", "source_namespace", "source_version", "source_order_id", "order_number", "status",
        "region", "source_warehouse_id", f"{iso_z('ordered_at')} AS ordered_at",
        f"{plain_decimal_text('total_amount')} AS total_amount", "currency",
        "array_join(invalid_reasons, ',') AS invalid_reasons", "array_join(context_reasons, ',') AS context_reasons",
        "warehouse_capability", "financial", "timing", "source_facts", "source_row_hash", "replay_digest", "assessment",
        "promotion_eligible",
    )


def _staged(spark: SparkSession, folder: str) -> observations.Staged:
    return observations.stage(observations.assess(feeds.raw_observations(spark, folder)))


@query
def observation_stage(spark: SparkSession, folder: str) -> DataFrame:
    return _staged(spark, folder).observations.selectExpr(
        "observation_id", "sequence", "source_row_hash", "status", "total_amount", "array_join(reasons, ',') AS reasons"
    )


@query
def observation_receipts(spark: SparkSession, folder: str) -> DataFrame:
    return _staged(spark, folder).receipts


def _promotion(spark: SparkSession, folder: str, **ordering: object) -> promotion.Promotion:
    evidence = observations.stage(observations.assess(feeds.raw_observations(spark, folder)), durable=True).observations
    return promotion.promote(evidence, feeds.no_orders(spark), starmap.warehouses(spark, folder), **ordering)


def _promoted(after: DataFrame) -> DataFrame:
    return after.selectExpr(
        "observation_id", "sequence", "status", "array_join(reasons, ',') AS reasons", "warehouse_capability",
        "promoted", "superseded_by",
    )


VERSION_RANK = "CAST(source_version AS INT)"


@query
def observation_promote(spark: SparkSession, folder: str) -> DataFrame:
    return _promoted(_promotion(spark, folder).observations)


@query
def observation_promote_ranked(spark: SparkSession, folder: str) -> DataFrame:
    return _promoted(_promotion(spark, folder, version_rank=VERSION_RANK).observations)


@query
def observation_promote_compared(spark: SparkSession, folder: str) -> DataFrame:
    """The same revisions ordered by a Python comparator."""

    def newer(current: str | None, incoming: str | None) -> object:
        if current is None or incoming is None or int(current) == int(incoming):
            return "UNORDERED"
        return int(incoming) > int(current)

    return _promoted(_promotion(spark, folder, comparator=newer).observations)


@query
def promotion_numbers(spark: SparkSession, folder: str) -> DataFrame:
    """A revision that never becomes an order takes no order number away; one that does, does."""
    evidence = observations.stage(observations.assess(feeds.number_claims(spark, folder)), durable=True).observations
    after = promotion.promote(evidence, feeds.no_orders(spark), starmap.warehouses(spark, folder), version_rank=VERSION_RANK)
    return after.observations.selectExpr("source_order_id", "sequence", "status", "array_join(reasons, ',') AS reasons", "promoted")


def _promoted_held(spark: SparkSession, folder: str) -> promotion.Promotion:
    evidence = observations.stage(observations.assess(feeds.meeting_held_orders(spark, folder)), durable=True).observations
    rank = "try_cast(source_version AS INT)"
    return promotion.promote(evidence, feeds.held_orders(spark, folder), starmap.warehouses(spark, folder), version_rank=rank)


@query
def observation_promote_held(spark: SparkSession, folder: str) -> DataFrame:
    """Observations that meet stored orders: confirmed, in conflict, newer, stale, unproven, and numbers that change hands."""
    return _promoted_held(spark, folder).observations.selectExpr(
        "source_order_id", "sequence", "order_number", "status", "array_join(reasons, ',') AS reasons", "promoted"
    )


@query
def promoted_held_orders(spark: SparkSession, folder: str) -> DataFrame:
    """The orders after that batch, and whether an observation of it changed or confirmed them."""
    return _promoted_held(spark, folder).orders.selectExpr(
        "source_order_id", "order_number", "projected_version", "total_amount", "startswith(current_observation, 'before-') AS untouched"
    )


@query
def promoted_orders(spark: SparkSession, folder: str) -> DataFrame:
    orders = _promotion(spark, folder, version_rank=VERSION_RANK).orders
    return orders.selectExpr(
        "source_namespace", "source_order_id", "order_number", "order_status", f"{iso_z('ordered_at')} AS ordered_at",
        "total_amount", "projected_version", "current_observation",
    )


# Dataset versions ------------------------------------------------------------


@query
def dataset_ensure(spark: SparkSession, folder: str) -> DataFrame:
    """Monthly versions offered again: unchanged, with other content, and under a new manifest."""
    known = exports.monthly_versions(spark, folder).versions
    offered = known.selectExpr(
        "dataset_key",
        "CASE WHEN dataset_version_id % 3 = 2 THEN concat(manifest_identity, 'x') ELSE manifest_identity END AS manifest_identity",
        "CASE WHEN dataset_version_id % 3 = 1 THEN 'other' ELSE content_hash END AS content_hash",
        "seed", "as_of", "generator_revision",
    )
    return versions.ensure_outcomes(known, offered).select("dataset_key", "manifest_identity", "seed", "outcome", "identity_hash")


def _activated(spark: SparkSession, folder: str) -> versions.Control:
    control = exports.monthly_versions(spark, folder)
    for step, month in enumerate((199601, 199602, 199603), 1):
        control = versions.activate(control, month, step)
    return control


def _control_rows(control: versions.Control) -> DataFrame:
    return control.versions.selectExpr(
        "dataset_version_id", "status", "changed_step", f"CAST({control.active_id} AS BIGINT) AS active_id"
    )


@query
def dataset_activate(spark: SparkSession, folder: str) -> DataFrame:
    return _control_rows(_activated(spark, folder))


@query
def dataset_rollback(spark: SparkSession, folder: str) -> DataFrame:
    """Two rollbacks in a row walk back through the activations."""
    control = versions.rollback(_activated(spark, folder), step=4)
    return _control_rows(versions.rollback(control, step=5))


@query
def dataset_scope(spark: SparkSession, folder: str) -> DataFrame:
    """Orders of the dataset readers are pointed at after a rollback."""
    control = versions.rollback(_activated(spark, folder), step=4)
    orders = starmap.orders(spark, folder).selectExpr(
        "source_order_id", "CAST(date_format(ordered_at, 'yyyyMM') AS BIGINT) AS dataset_version_id"
    )
    return versions.scoped(orders, versions.scope_id(control, None))


@query
def dataset_backfill(spark: SparkSession, folder: str) -> DataFrame:
    orders = starmap.read(spark, folder, "orders").selectExpr(
        "o_orderkey", "CASE WHEN o_orderkey % 3 <> 0 THEN 200000 + o_orderkey % 3 END AS dataset_version_id"
    )
    _, tables = versions.backfill(versions.no_versions(spark), {"orders": orders}, step=1)
    return tables["orders"].groupBy("dataset_version_id").agg(F.expr("count(1) AS orders"))


# External datasets -----------------------------------------------------------

_ADAPTED = ("source_order_id", "order_number", "status", "region", "ordered_at", "promised_at", "fulfilled_at", "total_amount")


@query
def external_payment_orders(spark: SparkSession, folder: str) -> DataFrame:
    return external.adapt_olist(exports.olist_tables(spark, folder)).select(*_ADAPTED)


@query
def external_line_rollup(spark: SparkSession, folder: str) -> DataFrame:
    return external.adapt_dataco(exports.dataco_tables(spark, folder)).select(*_ADAPTED)


@query
def external_rejections(spark: SparkSession, folder: str) -> DataFrame:
    return external.validate_adapted(external.adapt_olist(exports.olist_tables(spark, folder))).rejections


@query
def external_counts(spark: SparkSession, folder: str) -> DataFrame:
    tables = exports.olist_tables(spark, folder)
    adapted = parked(external.adapt_olist(tables))
    return external.evidence_counts(adapted, tables["orders"], external.validate_adapted(adapted))


@query
def independent_kpi(spark: SparkSession, folder: str) -> DataFrame:
    return external.independent_kpis("olist", exports.olist_tables(spark, folder)["orders"], AS_OF)


@query
def independent_kpi_lines(spark: SparkSession, folder: str) -> DataFrame:
    return external.independent_kpis("dataco", exports.dataco_tables(spark, folder)["orders"], AS_OF)


@query
def coherence(spark: SparkSession, folder: str) -> DataFrame:
    """Stored figures against queue counts of which one is off by one."""
    figures = parked(kpi.summary(starmap.orders(spark, folder), _reviewed(spark, folder), AS_OF))
    counts = figures.withColumn("supplier_delays", F.col("supplier_delays") + 1)
    return external.coherence(figures, counts)


def registered() -> dict[str, Query]:
    return dict(_QUERIES)


flagship = detect_all
