"""What frames that are written once take on disk."""

from __future__ import annotations

from pathlib import Path

from tidewatch.functions.text import id_key, key_id
from tidewatch.operators import observations, promotion
from tidewatch.plans import feeds
from tidewatch.settings import shared_folder


def _size(spark) -> int:
    return sum(p.stat().st_size for p in Path(shared_folder(spark)).rglob("*") if p.is_file())


def test_promotion_keeps_a_fraction_of_its_rows_on_disk(spark):
    rows = 5000
    raw = spark.range(rows).selectExpr(
        "id AS sequence", "'b' AS batch_id", "'n' AS source_namespace", "'1' AS source_version", "concat('o', id) AS order_id",
        "concat('N', id) AS order_number", "'open' AS order_status", "'R' AS region", "'W1' AS warehouse_id",
        "'2025-01-01T00:00:00Z' AS ordered_at", "'2025-01-02T00:00:00Z' AS promised_at", "CAST(NULL AS STRING) AS fulfilled_at",
        "'5' AS total_amount", "'usd' AS currency",
    )
    places = spark.createDataFrame([("W1",)], "source_warehouse_id STRING")
    evidence = observations.stage(observations.assess(raw)).observations
    before = _size(spark)
    after = promotion.promote(evidence, feeds.no_orders(spark), places, version_rank="CAST(source_version AS INT)")
    assert after.observations.where("promoted").count() == rows
    taken = (_size(spark) - before) // rows
    assert taken < 300, taken


def test_a_parked_frame_has_the_same_rows(spark):
    from tidewatch.settings import parked

    frame = spark.sql(
        "SELECT * FROM VALUES (1, TIMESTAMP '0001-01-01 00:00:00.000001', named_struct('a', CAST(1.5 AS DECIMAL(38,10)))), "
        "(2, TIMESTAMP '9999-12-31 23:59:59.999999', NULL), (NULL, NULL, named_struct('a', NULL)) AS t(k, at, held)"
    )
    shown = ("k", "CAST(at AS STRING)", "held")
    assert sorted(map(str, parked(frame).selectExpr(*shown).collect())) == sorted(map(str, frame.selectExpr(*shown).collect()))
    assert parked(frame.where("k > 5")).dtypes == frame.dtypes


def test_what_promotion_leaves_on_disk_has_no_texts_of_its_rows(spark):
    """Frames of the way to a verdict are removed, and those that stay hold keys and results, however long the other columns are."""
    rows = 4000
    evidence = spark.range(rows).selectExpr(
        "sha2(CAST(id AS STRING), 256) AS observation_id", "id AS sequence", "'n' AS source_namespace", "concat('o', id) AS source_order_id",
        "'1' AS source_version", "sha2(concat('h', id), 256) AS source_row_hash", "sha2(concat('f', id), 512) AS source_facts",
        # Each two orders claim one number.
        "concat('N', id div 2) AS order_number", "'OPEN' AS order_status", "'R' AS region", "'W1' AS source_warehouse_id",
        "TIMESTAMP '2025-01-01' AS ordered_at", "TIMESTAMP '2025-01-02' AS promised_at", "CAST(NULL AS TIMESTAMP) AS fulfilled_at",
        "CAST(5 AS DECIMAL(14,2)) AS total_amount", "'USD' AS currency", "'NORMALIZED' AS status", "'WAREHOUSE_OBSERVED' AS warehouse_capability",
        "CAST(array() AS ARRAY<STRING>) AS reasons", "false AS promoted", "CAST(NULL AS STRING) AS superseded_by",
    )
    places = spark.createDataFrame([("W1",)], "source_warehouse_id STRING")
    before = _size(spark)
    after = promotion.promote(evidence, feeds.no_orders(spark), places, version_rank="CAST(source_version AS INT)")
    assert after.observations.where("promoted").count() == rows // 2 and after.orders.count() == rows // 2
    assert after.observations.select("observation_id", "source_facts").exceptAll(evidence.select("observation_id", "source_facts")).isEmpty()
    taken = (_size(spark) - before) // rows
    assert taken < 130, taken


def test_staging_moves_no_digests(spark):
    raw = spark.range(10).selectExpr("id AS sequence", "'b' AS batch_id", "'n' AS source_namespace", "'1' AS source_version", "concat('o', id % 3) AS order_id", "'x' AS amount")
    staged = observations.stage(observations.assess(raw)).observations
    dealt = [line for line in staged._jdf.queryExecution().executedPlan().toString().splitlines() if "Exchange hashpartitioning" in line]
    assert len(dealt) == 1 and "source_facts" not in dealt[0] and "sha2" not in dealt[0] and "replay_digest" not in dealt[0]
    kept = observations.stage(observations.assess(raw), durable=True).observations
    shown = sorted(map(str, staged.collect()))
    assert sorted(map(str, kept.collect())) == shown and len(shown) == 3
    assert {tuple(r["reasons"]) for r in kept.collect()} == {("MALFORMED_TOTAL_AMOUNT",)}


def test_keys_of_ids_are_as_many_as_ids(spark):
    digest = "ab" * 32
    ids = [digest, digest.upper(), digest[:62], digest[:63], digest + "ab", "g" * 64, "", "before-7", "é" * 16, "é" * 64, "x" * 32, "\0", "\0" * 33 + "x" * 32, "\0" * 31]
    rows = spark.createDataFrame([(i,) for i in ids], "i STRING").selectExpr("i", f"{id_key('i')} AS k").selectExpr("*", f"{key_id('k')} AS back")
    found = rows.collect()
    assert [r["back"] for r in found] == ids and len({bytes(r["k"]) for r in found}) == len(ids)
    assert len(found[0]["k"]) == 32


def test_every_fault_and_capability_is_staged(spark):
    reasons = ", ".join(f"'{reason}'" for reason in observations.INVALID_REASONS)
    rows = spark.sql(f"SELECT array({reasons}) AS invalid_reasons, explode(array('{"', '".join(observations.CAPABILITIES)}')) AS warehouse_capability")
    found = rows.selectExpr("invalid_reasons AS r", "warehouse_capability AS c", f"{observations._marks()} AS m").selectExpr("r", "c", *observations._marked("m")).collect()
    assert len(found) == 4 and all((r["r"], r["c"]) == (r["invalid_reasons"], r["warehouse_capability"]) for r in found)
