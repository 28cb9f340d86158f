from datetime import timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tests import world
from tidewatch.operators import rules
from tidewatch.settings import Ladder, RuleSettings, cut_lineage

SETTINGS = RuleSettings(inventory_mismatch_tolerance=Decimal("1"), as_of=world.AS_OF)


def found(rule, tables, settings=SETTINGS):
    return {row["entity_id"]: row for row in rule(tables, world.AS_OF, settings).collect()}


def test_every_rule_fires_once(spark):
    rows = rules.in_rule_order(rules.all_findings(world.tables(spark), world.AS_OF, SETTINGS)).collect()
    assert [(r["exception_type"], r["entity_id"]) for r in rows] == [
        ("SLA_BREACH_RISK", "O1"), ("INVENTORY_SHORTAGE", "P1:W1"), ("STOCKOUT_RISK", "P1:W1"),
        ("INVENTORY_MISMATCH", "P1:W1"), ("SUPPLIER_DELAY", "PO1"), ("SHIPMENT_DELAY", "S1"),
    ]
    assert rows[0]["source_facts"] == (
        '{"order":"O1","ordered_at":"2025-01-13T12:00:00+00:00","promised_at":"2025-01-15T11:00:00+00:00",'
        '"remaining":"10.000","revenue":"100.00000","status":"OPEN"}'
    )
    assert rows[0]["business_impact"] == "10.000 units remain unfulfilled on order O1"
    assert rows[0]["overdue_hours"] == Decimal("1.0000") and rows[0]["severity"] == "LOW"
    assert rows[1]["source_facts"] == '{"available":"2.000","demand":"10.000","orders":"1","product":"P1","warehouse":"W1"}'
    assert '"safety_stock":"20"' in rows[2]["source_facts"]
    assert rows[3]["root_cause"] == "Snapshot on-hand 2.000 differs from reconstructed 8.000 by 6.000"
    assert rows[4]["overdue_hours"] == Decimal("24.0000") and rows[4]["severity"] == "HIGH"
    assert rows[5]["overdue_hours"] == 0 and rows[5]["revenue_at_risk"] == Decimal("100")


@pytest.mark.parametrize(
    ("offset", "overdue"),
    [(timedelta(hours=4), "0.0000"), (timedelta(hours=4, microseconds=1), None), (timedelta(microseconds=-1), "0.0000"),
     (timedelta(microseconds=-180000), "0.0000"), (timedelta(microseconds=-540000), "0.0002")],
)
def test_sla_window_is_inclusive_and_lateness_rounds_to_even(spark, offset, overdue):
    tables = world.tables(spark, **world.changed("orders", promised_at=(world.AS_OF + offset).replace(tzinfo=None)))
    rows = found(rules.sla_breach_risk, tables)
    assert (str(rows["O1"]["overdue_hours"]) if rows else None) == overdue


def test_fraction_of_a_second_shows_only_when_present(spark):
    tables = world.tables(spark, **world.changed("orders", promised_at=world.at(microseconds=-1)))
    assert "2025-01-15T11:59:59.999999+00:00 is overdue" in found(rules.sla_breach_risk, tables)["O1"]["root_cause"]


def test_equal_demand_and_stock_fires_nothing(spark):
    tables = world.tables(spark, **world.changed("inventory", on_hand=Decimal("10.000")))
    assert not found(rules.demand_risks, tables, RuleSettings(safety_stock=Decimal("0")))


def test_zero_prints_bare(spark):
    tables = world.tables(spark, **world.changed("inventory", on_hand=Decimal("0.000")))
    row = found(rules.inventory_shortage, tables)["P1:W1"]
    assert row["root_cause"] == "Open demand 10.000 exceeds available inventory 0"


def test_product_without_snapshot_never_fires(spark):
    assert not found(rules.demand_risks, world.tables(spark, inventory=[]))


@pytest.mark.parametrize(("tolerance", "fires"), [("6", False), ("5.999", True)])
def test_mismatch_tolerance_is_inclusive(spark, tolerance, fires):
    rows = found(rules.inventory_mismatch, world.tables(spark), RuleSettings(inventory_mismatch_tolerance=Decimal(tolerance)))
    assert bool(rows) is fires


def test_mismatch_ignores_movements_after_the_snapshot(spark):
    move = world.rows()["inventory_movements"][0]
    later = move | {"source_movement_id": "M2", "occurred_at": world.at(hours=-1)}
    out = move | {"source_movement_id": "M3", "movement_type": "TRANSFER_OUT", "quantity": Decimal("6")}
    held = move | {"source_movement_id": "M4", "movement_type": "RESERVATION", "quantity": Decimal("50")}
    assert not found(rules.inventory_mismatch, world.tables(spark, inventory_movements=[move, later, out, held]))


@pytest.mark.parametrize(
    ("values", "fires"),
    [({"status": "RECEIVED"}, False), ({"status": "CANCELLED"}, False), ({"status": "PARTIALLY_RECEIVED"}, True),
     ({"expected_delivery_at": world.at()}, False)],
)
def test_supplier_delay_boundaries(spark, values, fires):
    assert bool(found(rules.supplier_delay, world.tables(spark, **world.changed("purchase_orders", **values)))) is fires


@pytest.mark.parametrize("values", [{"eta": world.at()}, {"status": "DELIVERED"}])
def test_shipment_silent(spark, values):
    assert not found(rules.shipment_delay, world.tables(spark, **world.changed("shipments", **values)))


def test_shipment_of_order_without_lines(spark):
    row = found(rules.shipment_delay, world.tables(spark, order_items=[]))["S1"]
    assert '"revenue":"0"' in row["source_facts"]


def test_facts_escape_non_ascii_like_compact_json(spark):
    import hashlib
    import json

    name = 'Ø"😀\\'
    item = world.rows()["order_items"][0] | {"source_order_id": name}
    order = world.rows()["orders"][0] | {"source_order_id": name}
    row = found(rules.sla_breach_risk, world.tables(spark, orders=[order], order_items=[item]))[name]
    facts = json.loads(row["source_facts"])
    assert row["source_facts"] == json.dumps(facts, ensure_ascii=True, sort_keys=True, separators=(",", ":"))
    assert facts["order"] == name
    assert row["fingerprint"] == hashlib.sha256(row["source_facts"].encode()).hexdigest()


def test_fingerprint_does_not_depend_on_the_instant(spark):
    tables = world.tables(spark)
    now = rules.all_findings(tables, world.AS_OF, SETTINGS)
    later = rules.all_findings(tables, world.AS_OF + timedelta(hours=1), SETTINGS)
    keys = [sorted(r["deduplication_key"] for r in rows.collect()) for rows in (now, later)]
    assert keys[0] == keys[1]


def test_latest_snapshot_wins_ties_by_sequence(spark):
    rows = spark.createDataFrame(
        [("P1", "W1", Decimal(n), Decimal(0), world.at(hours=-h), s) for n, h, s in ((1, 2, 1), (2, 1, 1), (3, 1, 2), (4, -1, 9))],
        "source_product_id string, source_warehouse_id string, on_hand decimal(18,3), reserved decimal(18,3), observed_at timestamp, snapshot_sequence int",
    )
    assert [r["on_hand"] for r in rules.latest_snapshots(rows, world.AS_OF).collect()] == [Decimal(3)]


def test_settings_are_checked():
    with pytest.raises(ValueError):
        Ladder(1, 2, 3)
    with pytest.raises(ValueError):
        RuleSettings(sla_risk_window_hours=0)
    with pytest.raises(ValueError):
        RuleSettings(as_of=world.AS_OF.replace(tzinfo=None))


def test_all_rules_read_each_table_once(spark, tmp_path, monkeypatch):
    """Scans of every plan a detection runs, those of its written frames included; and the same findings as rule by rule."""
    for name, table in world.tables(spark).items():
        table.write.parquet(f"{tmp_path}/{name}")
    tables = {name: spark.read.schema(table.schema).parquet(f"{tmp_path}/{name}") for name, table in world.tables(spark).items()}
    plans = []

    def scans(frame):
        plans.append(frame._jdf.queryExecution().executedPlan().toString().count("FileScan parquet"))
        return frame

    monkeypatch.setattr(rules, "cut_lineage", lambda frame: cut_lineage(scans(frame)))
    together = scans(rules.all_findings(tables, world.AS_OF, SETTINGS))
    assert sum(plans) == 7
    alone = [rule(tables, world.AS_OF, SETTINGS) for rule in (rules.sla_breach_risk, rules.demand_risks, rules.inventory_mismatch, rules.supplier_delay, rules.shipment_delay)]
    want = sorted(str(r) for frame in alone for r in frame.collect())
    assert sorted(str(r) for r in together.collect()) == want and len(want) == 6


def test_facts_of_orders_with_open_closed_and_no_lines(spark):
    d = Decimal
    order, line = world.rows()["orders"][0], world.rows()["order_items"][0]
    orders = [order | {"source_order_id": f"O{n}", "order_number": f"N{n}"} for n in range(4)] + [order | {"source_order_id": "O9", "order_number": "N9", "status": "CANCELLED"}]
    lines = [(0, "P1", 10, 0), (0, "P1", 4, 1), (0, "P2", 5, 5), (1, "P2", 3, 3), (2, "P1", 7, 2), (9, "P1", 8, 0), (3, "P2", 2, 4)]
    items = [
        line | {"source_order_item_id": f"I{n}", "source_order_id": f"O{o}", "source_product_id": p, "line_number": n, "ordered_quantity": d(a), "fulfilled_quantity": d(b)}
        for n, (o, p, a, b) in enumerate(lines)
    ]
    rows = rules.order_facts(world.tables(spark, orders=orders, order_items=items), world.AS_OF).collect()
    found = {r["source_order_id"]: (r["quantity"], r["revenue"], r["value"]) for r in rows if r["fact"] == "ORDER"}
    assert found == {"O0": (13, 130, 130), "O1": (None, None, 0), "O2": (5, 50, 50), "O3": (None, None, -20), "O9": (8, 80, 80)}
    places = {(r["source_product_id"], r["source_warehouse_id"]): (r["quantity"], r["revenue"], r["orders"]) for r in rows if r["fact"] == "PLACE"}
    assert places == {("P1", "W1"): (18, 180, 2)}


def test_newest_snapshots_without_a_sequence_are_found_by_hashing(spark):
    """Without a sequence no rows are sorted for the newest snapshot, and it is the one that a sequence of equal numbers gives."""
    tables = world.tables(spark)
    newest = rules.latest_snapshots(tables["inventory"].drop("snapshot_sequence"), world.AS_OF)
    plan = newest._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan and "HashAggregate" in plan
    again = tables["inventory"].drop("snapshot_sequence").withColumn("snapshot_sequence", F.lit(1))
    want = rules.latest_snapshots(again, world.AS_OF)
    assert sorted(map(str, newest.select(*want.columns).collect())) == sorted(map(str, want.collect())) and newest.count()
