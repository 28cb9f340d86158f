from datetime import timedelta
from decimal import Decimal

from tests import world
from tidewatch.operators import rules
from tidewatch.operators.audit import active_issue_violations, append_only_violations, audit_tables
from tidewatch.operators.lifecycle import apply_transitions, sample_requests
from tidewatch.operators.state import empty_state, merge_findings
from tidewatch.settings import RuleSettings

SETTINGS = RuleSettings(inventory_mismatch_tolerance=Decimal("1"))
LATER = world.AS_OF + timedelta(hours=2)


def run(spark, state, sequence, as_of=world.AS_OF, **changes):
    found = rules.all_findings(world.tables(spark, **changes), as_of, SETTINGS)
    return merge_findings(found, state, as_of, dataset_version_id=1, run_sequence=sequence)


def counts(merge):
    row = merge.counters().first()
    return row["created"], row["updated"], row["skipped"]


def ask(spark, *rows):
    return spark.createDataFrame(
        [(*row, world.at(hours=1)) for row in rows],
        "exception_id string, sequence long, to_status string, actor string, reason string, changed_at timestamp",
    )


def one(state, kind="SLA_BREACH_RISK"):
    return [r for r in state.collect() if r["exception_type"] == kind]


def test_rerun_updates_and_adds_no_history(spark):
    first = run(spark, empty_state(spark), 1)
    assert counts(first) == (6, 0, 0)
    assert first.new_history.count() == 6
    again = run(spark, first.state, 2)
    assert counts(again) == (0, 6, 0)
    assert again.new_history.count() == 0
    assert sorted(map(str, again.state.collect())) == sorted(map(str, first.state.collect()))
    assert active_issue_violations(again.state).count() == 0


def test_resolved_facts_are_suppressed_until_they_change(spark):
    first = run(spark, empty_state(spark), 1)
    target = one(first.state)[0]["exception_id"]
    closed = apply_transitions(first.state, ask(spark, (target, 1, "DISMISSED", "ana", "known")))
    assert counts(run(spark, closed.state, 2)) == (0, 5, 1)
    changed = run(spark, closed.state, 3, **world.changed("order_items", fulfilled_quantity=Decimal("1")))
    assert changed.counters().first()["created"] == 1
    assert {r["status"] for r in one(changed.state)} == {"DISMISSED", "OPEN"}


def test_drifted_key_suppresses_the_latest_facts(spark):
    first = run(spark, empty_state(spark), 1)
    change = world.changed("order_items", fulfilled_quantity=Decimal("1"))
    drifted = run(spark, first.state, 2, as_of=LATER, **change)
    before, after = one(first.state)[0], one(drifted.state)[0]
    assert before["exception_id"] == after["exception_id"] and before["deduplication_key"] != after["deduplication_key"]
    assert after["detected_at"] == before["detected_at"]
    closed = apply_transitions(drifted.state, ask(spark, (after["exception_id"], 1, "DISMISSED", "ana", "done")))
    assert run(spark, closed.state, 3, **change).counters().first()["skipped"] == 1
    reverted = run(spark, closed.state, 4)
    assert len({r["exception_id"] for r in one(reverted.state)}) == 2


def test_key_of_a_closed_exception_is_not_taken_over(spark):
    first = run(spark, empty_state(spark), 1)
    original = one(first.state)[0]
    closed = apply_transitions(first.state, ask(spark, (original["exception_id"], 1, "DISMISSED", "ana", "done")))
    change = world.changed("order_items", fulfilled_quantity=Decimal("1"))
    second = run(spark, closed.state, 2, **change)
    back = run(spark, second.state, 3)
    active = [r for r in one(back.state) if r["status"] == "OPEN"][0]
    assert active["deduplication_key"] != original["deduplication_key"]
    assert active["business_impact"].startswith("10.000 units")
    assert back.counters().first()["updated"] == 6


def test_vanished_findings_stay_untouched(spark):
    first = run(spark, empty_state(spark), 1)
    quiet = run(spark, first.state, 2, orders=[], shipments=[], purchase_orders=[], inventory=[])
    assert counts(quiet) == (0, 0, 0)
    assert sorted(map(str, quiet.state.collect())) == sorted(map(str, first.state.collect()))


def test_repeats_of_one_issue_create_once(spark):
    order = world.rows()["orders"][0]
    twin = order | {"promised_at": world.at(hours=-3)}
    merge = run(spark, empty_state(spark), 1, orders=[order, twin], shipments=[])
    outcome = {r["issue_key"]: r for r in merge.outcomes.collect()}["ORDER:O1"]
    assert (outcome["findings"], outcome["created"], outcome["updated"]) == (2, 1, 1)
    assert len(one(merge.state)) == 1 and merge.new_history.where("exception_id = '%s'" % one(merge.state)[0]["exception_id"]).count() == 1


def test_walk_and_faults(spark):
    state = run(spark, empty_state(spark), 1).state
    key = one(state)[0]["exception_id"]
    applied = apply_transitions(
        state,
        ask(
            spark,
            (key, 1, "RESOLVED", "ana", "too soon"), (key, 2, "ACKNOWLEDGED", " ", None), (key, 3, "ACKNOWLEDGED", " ana ", None),
            (key, 4, "IN_PROGRESS", "x" * 101, None), (key, 5, "IN_PROGRESS", "bo", None), (key, 6, "RESOLVED", "bo", " "),
            (key, 7, "RESOLVED", "bo", "fixed"), (key, 8, "DISMISSED", "bo", "late"), ("none", 1, "ACKNOWLEDGED", "bo", None),
            (key, 9, "PAUSED", "bo", None),
        ),
    )
    verdicts = {(r["exception_id"] == key, r["sequence"]): r["rejection"] for r in applied.requests.collect()}
    assert verdicts == {
        (True, 1): "ILLEGAL_TRANSITION", (True, 2): "INVALID_ACTOR", (True, 3): None, (True, 4): "INVALID_ACTOR", (True, 5): None,
        (True, 6): "REASON_REQUIRED", (True, 7): None, (True, 8): "ILLEGAL_TRANSITION", (False, 1): "NOT_FOUND", (True, 9): "INVALID_STATUS",
    }
    after = one(applied.state)[0]
    assert after["status"] == "RESOLVED" and after["resolved_at"] == world.at(hours=1)
    assert [(r["from_status"], r["to_status"], r["actor"]) for r in applied.new_history.orderBy("entry").collect()] == [
        ("OPEN", "ACKNOWLEDGED", "ana"), ("ACKNOWLEDGED", "IN_PROGRESS", "bo"), ("IN_PROGRESS", "RESOLVED", "bo"),
    ]


def test_sample_walks_only_open_representatives(spark):
    state = run(spark, empty_state(spark), 1).state
    walked = apply_transitions(state, sample_requests(state, world.AS_OF))
    assert {r["exception_type"]: r["status"] for r in walked.state.collect()} == {
        "SLA_BREACH_RISK": "OPEN", "INVENTORY_SHORTAGE": "OPEN", "STOCKOUT_RISK": "ACKNOWLEDGED",
        "INVENTORY_MISMATCH": "IN_PROGRESS", "SUPPLIER_DELAY": "RESOLVED", "SHIPMENT_DELAY": "DISMISSED",
    }
    assert sample_requests(walked.state, world.AS_OF).count() == 0


def test_history_audit_notices_changes(spark):
    history = run(spark, empty_state(spark), 1).new_history
    columns = ["exception_id", "to_status", "actor"]
    assert append_only_violations(history, history.unionByName(history), columns).count() == 0
    assert append_only_violations(history, history.where("exception_id > '8'"), columns).count() == history.where("exception_id <= '8'").count()


def test_audit_of_keys_references_and_checks(spark):
    rows = {
        "products": [("P1", "S1", 1), ("P1", "S2", 2), ("P2", None, -3), ("P2", None, -3), ("P3", "S1", 4)],
        "order_observations": [("a", "ns", "O1", None, 5), ("b", "ns", "O2", "a", -1), ("b", "ns", "O2", "zz", -1), ("c", "n", "sO1", "a", 0), ("d", None, "O9", None, 0)],
        "source_order_identities": [("ns", "O1"), ("ns", "O2"), ("ns", "O2")],
        "order_observation_receipts": [("a", "b1"), ("a", "b1"), ("gone", "b1"), ("gone", "b2")],
    }
    shapes = {
        "products": "source_product_id string, sku string, unit_price int",
        "order_observations": "observation_id string, source_namespace string, source_order_id string, superseded_by string, total_amount int",
        "source_order_identities": "source_namespace string, source_order_id string", "order_observation_receipts": "observation_id string, batch_id string",
    }
    tables = {name: spark.createDataFrame(content, shapes[name]) for name, content in rows.items()}
    dated = tables["order_observations"].selectExpr("*", "timestamp'2025-01-01' AS ordered_at", "CAST(NULL AS TIMESTAMP) AS fulfilled_at")
    tables["order_observations"] = dated
    names = ("products", "order_observations", "order_observation_receipts")
    found = sorted((r["table_name"], r["kind"], r["violated"], r["row_key"], r["rows"]) for r in audit_tables(tables, names).collect())
    assert found == sorted([
        ("products", "UNIQUE", "source_product_id", "P1", 2), ("products", "UNIQUE", "source_product_id", "P2", 2), ("products", "UNIQUE", "sku", "S1", 2),
        ("products", "CHECK", "unit_price >= 0", "P2", 1), ("products", "CHECK", "unit_price >= 0", "P2", 1),
        ("order_observations", "UNIQUE", "observation_id", "b", 2),
        ("order_observations", "CHECK", "total_amount >= 0", "b", 1), ("order_observations", "CHECK", "total_amount >= 0", "b", 1),
        ("order_observations", "REFERENCE", "superseded_by -> order_observations", "zz", 1),
        ("order_observations", "REFERENCE", "source_namespace, source_order_id -> source_order_identities", "n:sO1", 1),
        ("order_observation_receipts", "UNIQUE", "observation_id, batch_id", "a:b1", 2),
        ("order_observation_receipts", "REFERENCE", "observation_id -> order_observations", "gone", 2),
    ])
    empty = {name: table.limit(0) for name, table in tables.items()}
    assert audit_tables(empty, names).isEmpty()
    plan = audit_tables(tables, names)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Aggregate [") == 1


def test_the_first_run_is_not_dealt_to_meet_no_exceptions(spark):
    from tidewatch.operators.state import empty_history, empty_state
    from tidewatch.schema import EXCEPTION_HISTORY, EXCEPTION_STATE

    for empty, schema in ((empty_state(spark), EXCEPTION_STATE), (empty_history(spark), EXCEPTION_HISTORY)):
        assert [(f.name, f.dataType) for f in empty.schema] == [(f.name, f.dataType) for f in schema] and empty.count() == 0
        met = spark.range(10).selectExpr("CAST(id AS STRING) AS exception_id").join(empty, "exception_id", "left")
        assert "Join" not in met._jdf.queryExecution().optimizedPlan().toString()


def test_the_audit_query_checks_references_of_the_source_tables(spark, tmp_path):
    """Lines name a product, an order, a warehouse and a supplier that no row owns."""
    from tidewatch.plans.registry import registered

    day = "TIMESTAMP '1997-01-05 00:00:00'"
    content = {
        "region": "0L AS r_regionkey, 'R' AS r_name",
        "nation": "1L AS n_nationkey, 'N' AS n_name, 0L AS n_regionkey",
        "customer": "1L AS c_custkey",
        "supplier": "1L AS s_suppkey, 'S' AS s_name, 1L AS s_nationkey, 0.0D AS s_acctbal",
        "part": "1L AS p_partkey, 'P' AS p_name, 2.5D AS p_retailprice",
        "orders": f"7L AS o_orderkey, 1L AS o_custkey, 'O' AS o_orderstatus, 10.0D AS o_totalprice, {day} AS o_orderdate",
        "lineitem": f"explode(array(named_struct('o', 7L, 'p', 9L, 's', 1L, 'n', 1), named_struct('o', 8L, 'p', 1L, 's', 2L, 'n', 2))) AS l, {day} AS l_shipdate",
    }
    for name, columns in content.items():
        rows = spark.range(1).selectExpr(*columns.split(", ")) if name not in ("lineitem", "orders") else spark.sql(f"SELECT {columns}")
        if name == "lineitem":
            rows = rows.selectExpr(
                "l.o AS l_orderkey", "l.p AS l_partkey", "l.s AS l_suppkey", "l.n AS l_linenumber", "3.0D AS l_quantity", "5.0D AS l_extendedprice",
                "0.0D AS l_discount", "0.0D AS l_tax", "'N' AS l_returnflag", "'O' AS l_linestatus", "l_shipdate",
            )
        rows.write.parquet(f"{tmp_path}/{name}.parquet")
    found = registered()["constraint_audit"](spark, str(tmp_path)).collect()
    assert {r["kind"] for r in found} == {"REFERENCE"}
    assert sorted((r["table_name"], r["violated"], r["row_key"], r["rows"]) for r in found) == [
        ("inventory", "source_product_id -> products", "P9", 1),
        ("inventory", "source_warehouse_id -> warehouses", "W2", 1),
        ("inventory_movements", "source_product_id -> products", "P9", 1),
        ("inventory_movements", "source_warehouse_id -> warehouses", "W2", 1),
        ("order_items", "source_order_id -> orders", "O8", 1),
        ("order_items", "source_product_id -> products", "P9", 1),
        ("purchase_order_items", "source_product_id -> products", "P9", 1),
        ("purchase_orders", "source_supplier_id -> suppliers", "SUP2", 1),
        ("purchase_orders", "source_warehouse_id -> warehouses", "W2", 1),
    ]


def test_digests_of_runs_are_moved_in_half_their_bytes(spark):
    """Ids and keys in hexadecimal digits go through no shuffle of a rerun and its history, and of a key only one copy is kept."""
    from tidewatch.operators.reads import exceptions_with_history
    from tidewatch.operators.state import _issues

    first = run(spark, empty_state(spark), 1)
    stored = first.state.where("true")
    review = apply_transitions(stored, ask(spark, (one(first.state)[0]["exception_id"], 1, "DISMISSED", "ana", "known")))
    issues = _issues(rules.all_findings(world.tables(spark), world.AS_OF, SETTINGS), review.state)
    assert {name for name, kind in issues.dtypes if kind == "binary"} == {"first_free", "other_key", "active_id"}
    again = run(spark, review.state, 2)
    assert sorted(r["deduplication_key"] for r in again.state.collect()) == sorted(r["deduplication_key"] for r in first.state.collect())
    assert counts(again) == (0, 5, 1)
    rows = exceptions_with_history(again.state, first.new_history.unionByName(review.new_history)).collect()
    assert all(h["id"] == f"{r['id']}-{h['entry']}" for r in rows for h in r["history"])
    assert sorted(len(r["history"]) for r in rows) == [1, 1, 1, 1, 1, 2]
