import hashlib
import json
import random

import pytest
from pyspark.sql import functions as F

from tidewatch.operators import observations, promotion
from tidewatch.operators.connected import connected
from tidewatch.plans.feeds import no_orders

ROW = {
    "source_namespace": "shop", "source_version": None, "batch_id": "b1", "source_order_id": "O1", "order_number": "N1", "status": "open",
    "region": "R", "source_warehouse_id": "W1", "ordered_at": "2025-01-15T13:00:00+01:00", "promised_at": "2025-01-16T12:00:00Z",
    "fulfilled_at": None, "total_amount": "10.50", "currency": "usd",
}


def feed(spark, *changes, extra=()):
    names = [*ROW, *extra]
    rows = [(n, *[(ROW | change).get(name) for name in names]) for n, change in enumerate(changes, 1)]
    return spark.createDataFrame(rows, ", ".join(["sequence long", *[f"{name} string" for name in names]]))


def warehouses(spark, *names):
    return spark.createDataFrame([(name,) for name in names], "source_warehouse_id string")


def statuses(rows):
    return {r["sequence"]: (r["status"], r["reasons"]) for r in rows.collect()}


def test_hashes_equal_the_canonical_json(spark):
    row = observations.assess(feed(spark, {})).first()
    facts = {
        "source_order_id": "O1", "order_number": "N1", "status": "OPEN", "region": "R", "source_warehouse_id": "W1",
        "ordered_at": "2025-01-15T12:00:00.000000Z", "promised_at": "2025-01-16T12:00:00.000000Z", "fulfilled_at": None,
        "total_amount": "10.5", "currency": "USD",
    }
    text = json.dumps(facts, ensure_ascii=False, sort_keys=True, separators=(",", ":"))
    digest = hashlib.sha256(text.encode()).hexdigest()
    replay = json.dumps(["shop", "O1", None, digest], separators=(",", ":"))
    assert row["source_facts"] == text and row["source_row_hash"] == digest
    assert row["replay_digest"] == hashlib.sha256(replay.encode()).hexdigest()
    assert (row["assessment"], row["warehouse_capability"], row["promotion_eligible"]) == ("NORMALIZED", "WAREHOUSE_OBSERVED", True)


def test_replay_identity_is_structured(spark):
    rows = observations.assess(
        feed(
            spark, {"source_namespace": "a|b", "source_order_id": "c"}, {"source_namespace": "a", "source_order_id": "b|c"},
            {"source_version": ""}, {"source_version": None}, {"region": "Café"}, {"region": "Café"}, {"total_amount": "10.5000"},
        )
    ).orderBy("sequence").collect()
    digests = [r["replay_digest"] for r in rows]
    assert digests[0] != digests[1] and digests[2] != digests[3]
    assert digests[4] == digests[5] and digests[6] == digests[3]


def test_reasons(spark):
    rows = observations.assess(
        feed(
            spark, {"order_id": "O2"}, {"total_amount": "-1", "amount": "-1"}, {"total_amount": "1", "amount": "2"}, {"currency": "us"},
            {"status": "lost"}, {"ordered_at": "2025-01-15"}, {"fulfilled_at": "2025-01-01T00:00:00Z"}, {"source_namespace": " "},
            {"source_order_id": " "}, {"currency": None}, {"source_warehouse_id": "W2"}, {"total_amount": None, "promised_at": "", "region": None},
            extra=("order_id", "amount"),
        ),
        warehouses(spark, "W1"),
    ).orderBy("sequence").collect()
    assert [r["invalid_reasons"] for r in rows] == [
        ["CONFLICTING_SOURCE_ORDER_ID"], ["NEGATIVE_TOTAL_AMOUNT"], ["CONFLICTING_TOTAL_AMOUNT", "MALFORMED_TOTAL_AMOUNT"],
        ["MALFORMED_CURRENCY"], ["MALFORMED_STATUS"], ["MALFORMED_ORDERED_AT"], ["CONFLICTING_TIMESTAMPS"],
        ["MISSING_SOURCE_NAMESPACE"], ["MISSING_SOURCE_ORDER_ID"], [], [], [],
    ]
    assert rows[0]["source_order_id"] == "[('source_order_id', 'O1'), ('order_id', 'O2')]"
    assert rows[9]["context_reasons"] == ["MISSING_CURRENCY", "AMOUNT_WITHOUT_CURRENCY"]
    assert rows[10]["context_reasons"] == ["UNKNOWN_WAREHOUSE"] and rows[10]["warehouse_capability"] == "WAREHOUSE_UNKNOWN"
    assert rows[11]["context_reasons"] == ["MISSING_TOTAL_AMOUNT", "MISSING_REGION", "MISSING_PROMISED_AT"]
    assert rows[0]["warehouse_capability"] == "WAREHOUSE_VALIDATED" and not any(r["promotion_eligible"] for r in rows)


def test_staging_is_replay_safe(spark):
    assessed = observations.assess(feed(spark, {}, {"batch_id": "b2"}, {"batch_id": "b1"}, {"total_amount": "x"}, {"source_order_id": None}))
    first = observations.stage(assessed)
    assert (first.observations.count(), first.receipts.count(), first.refused.count()) == (2, 3, 1)
    again = observations.stage(assessed, first.observations, first.receipts)
    assert (again.observations.count(), again.receipts.count()) == (0, 0)
    assert statuses(first.observations)[4][0] == "REJECTED_INVALID"


def staged(spark, *changes):
    return observations.stage(observations.assess(feed(spark, *changes))).observations


@pytest.mark.parametrize("how", ["rank", "comparator"])
def test_version_gate(spark, how):
    rows = staged(
        spark, {"source_version": "1"}, {"source_version": "3", "total_amount": "12"}, {"source_version": "2", "total_amount": "11"},
        {"source_version": "x", "total_amount": "13"}, {"source_version": "4", "total_amount": "14"},
    )

    def newer(current, incoming):
        return int(incoming) > int(current)

    ordering = {"version_rank": "try_cast(source_version AS INT)"} if how == "rank" else {"comparator": newer}
    done = promotion.promote(rows, no_orders(spark), warehouses(spark, "W1"), **ordering)
    assert statuses(done.observations) == {
        1: ("PROMOTED", []), 2: ("PROMOTED", []), 3: ("CONFLICT_BLOCKED", ["STALE_SOURCE_VERSION"]),
        4: ("CONFLICT_BLOCKED", ["SOURCE_VERSION_ORDER_UNPROVEN"]), 5: ("PROMOTED", []),
    }
    ids = {r["sequence"]: (r["observation_id"], r["superseded_by"]) for r in done.observations.collect()}
    assert ids[1][1] == ids[2][0] and ids[2][1] == ids[5][0] and ids[5][1] is None
    order = done.orders.collect()
    assert [(str(o["total_amount"]), o["projected_version"], o["current_observation"]) for o in order] == [("14.00", "4", ids[5][0])]


def test_later_batch_meets_the_stored_order(spark):
    held = observations.assess(feed(spark, {"source_version": "4"})).selectExpr(
        "source_namespace", "source_order_id", "order_number", "status AS order_status", "region", "source_warehouse_id", "ordered_at",
        "promised_at", "fulfilled_at", "CAST(total_amount AS DECIMAL(14,2)) AS total_amount", "currency",
        "'4' AS projected_version", "'before' AS current_observation",
    )
    more = staged(spark, {"source_version": "5", "total_amount": "15"}, {"source_version": "2", "total_amount": "9"}, {"source_version": "4"})
    done = promotion.promote(more, held, warehouses(spark, "W1"), version_rank="CAST(source_version AS INT)")
    # Once version 5 is the order's, version 4 is old; before that it confirms what there is.
    assert {n: r for n, (_, r) in statuses(done.observations).items()} == {1: [], 2: ["STALE_SOURCE_VERSION"], 3: ["STALE_SOURCE_VERSION"]}
    first = staged(spark, {"source_version": "4"}, {"source_version": "5", "total_amount": "15"})
    done = promotion.promote(first, held, warehouses(spark, "W1"), version_rank="CAST(source_version AS INT)")
    rows = {r["sequence"]: r for r in done.observations.collect()}
    assert [rows[n]["status"] for n in (1, 2)] == ["PROMOTED"] * 2 and rows[1]["superseded_by"] == rows[2]["observation_id"]


def test_conflicts_block_both_sides_and_unordered_versions_stay_unproven(spark):
    rows = staged(
        spark, {}, {"total_amount": "11"}, {"source_order_id": "O2", "order_number": "N2", "source_version": "1"},
        {"source_order_id": "O2", "order_number": "N2", "source_version": "2", "total_amount": "11"},
        {"source_order_id": "O3", "order_number": "N3", "source_warehouse_id": "W9"},
        {"source_order_id": "O4", "order_number": "N3b"}, {"source_order_id": "O5", "order_number": "N3b"},
        {"source_order_id": "O6", "order_number": "N6", "source_warehouse_id": None},
        {"source_order_id": "O7", "order_number": "N7", "currency": None},
    )
    done = promotion.promote(rows, no_orders(spark), warehouses(spark, "W1"))
    assert statuses(done.observations) == {
        1: ("CONFLICT_BLOCKED", ["UNVERSIONED_CONTENT_CONFLICT"]), 2: ("CONFLICT_BLOCKED", ["UNVERSIONED_CONTENT_CONFLICT"]),
        3: ("CONFLICT_BLOCKED", ["SOURCE_VERSION_ORDER_UNPROVEN"]), 4: ("CONFLICT_BLOCKED", ["SOURCE_VERSION_ORDER_UNPROVEN"]),
        5: ("CONTEXT_INCOMPLETE", ["UNKNOWN_WAREHOUSE"]), 6: ("PROMOTED", []), 7: ("REJECTED_INVALID", ["OPERATIONAL_ORDER_CONFLICT"]),
        8: ("CONTEXT_INCOMPLETE", ["MISSING_WAREHOUSE"]), 9: ("CONTEXT_INCOMPLETE", ["MISSING_CURRENCY", "AMOUNT_WITHOUT_CURRENCY"]),
    }
    # The warehouse becomes known: the waiting observation is promoted, settled ones stay.
    retry = promotion.promote(done.observations, done.orders, warehouses(spark, "W1", "W9"))
    assert statuses(retry.observations)[5] == ("PROMOTED", []) and retry.orders.count() == 2
    assert statuses(retry.observations)[7][0] == "REJECTED_INVALID"


def serial(cases, held, newer):
    """Statuses when observations are promoted one after the other."""
    orders = dict(held)  # order -> (version, number, amount)
    owner = {number: order for order, (_, number, _) in held.items()}
    clashing = {}
    for _, order, version, number, amount in cases:
        clashing.setdefault((order, version), set()).add((number, amount))
    out = {}
    for sequence, order, version, number, amount in cases:
        if len(clashing[order, version]) > 1:
            out[sequence] = "SOURCE_VERSION_CONTENT_CONFLICT"
            continue
        current = orders.get(order)
        if current is not None and current[0] == version:
            out[sequence] = "" if current == (version, number, amount) else "SOURCE_VERSION_CONTENT_CONFLICT"
            continue
        if current is not None and newer(current[0], version) is not True:
            out[sequence] = "STALE_SOURCE_VERSION" if newer(current[0], version) is False else "SOURCE_VERSION_ORDER_UNPROVEN"
            continue
        if owner.get(number, order) != order:
            out[sequence] = "OPERATIONAL_ORDER_CONFLICT"
            continue
        if current is not None:
            owner.pop(current[1])
        owner[number] = order
        orders[order] = (version, number, amount)
        out[sequence] = ""
    return out, orders


def stored_orders(spark, held):
    rows = [{"source_order_id": order, "source_version": version, "order_number": number, "total_amount": amount} for order, (version, number, amount) in held.items()]
    if not rows:
        return no_orders(spark)
    return observations.assess(feed(spark, *rows)).selectExpr(
        "source_namespace", "source_order_id", "order_number", "status AS order_status", "region", "source_warehouse_id", "ordered_at",
        "promised_at", "fulfilled_at", "CAST(total_amount AS DECIMAL(14,2)) AS total_amount", "currency",
        "source_version AS projected_version", "concat('before', source_order_id) AS current_observation",
    )


@pytest.mark.parametrize("how", ["rank", "comparator"])
def test_numbers_change_hands_as_in_a_serial_pass(spark, how):
    def newer(current, incoming):
        if "x" in (current, incoming) or int(current) == int(incoming):
            return "UNORDERED"
        return int(incoming) > int(current)

    draw = random.Random(how)
    cases, held = [], {}
    for group in range(40):  # orders of a group contend for its few numbers
        orders = [f"O{group}-{k}" for k in range(draw.randrange(1, 5))]
        numbers = [f"N{group}-{k}" for k in range(draw.randrange(2, 5))]
        free = list(numbers)
        for order in orders:
            if draw.random() < 0.5 and free:
                held[order] = (str(draw.randrange(1, 4)), free.pop(draw.randrange(len(free))), "10.00")
        for _ in range(draw.randrange(1, 9)):
            order = draw.choice(orders)
            same = order in held and draw.random() < 0.3
            cases.append((order, *(held[order] if same else (draw.choice("12345x"), draw.choice(numbers), draw.choice(["10.00", "11.00"])))))
    cases = list(dict.fromkeys(cases))  # a replay is the same observation
    draw.shuffle(cases)
    cases = [(n, *case) for n, case in enumerate(cases, 1)]
    want, after = serial(cases, held, newer)
    rows = staged(spark, *({"source_order_id": o, "source_version": v, "order_number": n, "total_amount": a} for _, o, v, n, a in cases))
    ordering = {"version_rank": "try_cast(source_version AS INT)"} if how == "rank" else {"comparator": newer}
    done = promotion.promote(rows, stored_orders(spark, held), warehouses(spark, "W1"), **ordering)
    got = {r["sequence"]: ",".join(r["reasons"]) for r in done.observations.collect()}
    assert got == want and len(set(want.values())) == 5
    orders = {r["source_order_id"]: (r["projected_version"], r["order_number"], str(r["total_amount"])) for r in done.orders.collect()}
    assert orders == after
    owners = [r["order_number"] for r in done.orders.collect()]
    assert len(owners) == len(set(owners))


def test_connected_sets(spark):
    draw = random.Random(2)
    edges = [(f"c{i:03}", f"c{i + 1:03}") for i in range(70)] + [("hub", f"s{i}") for i in range(40)]
    edges += [(f"r{draw.randrange(60)}", f"r{draw.randrange(60)}") for _ in range(45)] + [("same", "same")]
    root = {node: node for edge in edges for node in edge}
    for _ in root:
        for a, b in edges:
            root[a] = root[b] = min(root[a], root[b])
    got = {r["node"]: r["root"] for r in connected(spark.createDataFrame(edges, "a string, b string")).collect()}
    assert got == {node: low for node, low in root.items() if any(node in edge and edge[0] != edge[1] for edge in edges)}


def test_running_maximum_over_buckets(spark):
    rows = spark.range(0, 40).selectExpr("'k' AS k", "id AS sequence", "(id * 7) % 40 AS v")
    got = {r["sequence"]: r["before"] for r in promotion.running_max(rows, ("k",), "sequence", "v", bucket=5).collect()}
    values = [(n * 7) % 40 for n in range(40)]
    assert got == {n: max(values[:n]) if n else None for n in range(40)}


def test_successors_over_buckets(spark):
    rows = spark.range(0, 40, 3).select(F.lit("k").alias("k"), F.col("id").alias("sequence"), F.col("id").cast("string").alias("observation_id"))
    got = {r["sequence"]: r["successor"] for r in promotion.next_in_sequence(rows, ("k",), bucket=10).collect()}
    assert got == {n: str(n + 3) if n + 3 < 40 else None for n in range(0, 40, 3)}


def test_comparator_outcomes():
    compare = promotion.version_outcome(lambda c, i: {"t": True, "f": False, "s": "SAME", "n": None}[i])
    assert [compare("c", x) for x in "tfsn?"] == ["INCOMING_NEWER", "CURRENT_NEWER", "SAME", "UNORDERED", "UNORDERED"]
