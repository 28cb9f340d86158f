"""Projections over every row must be compiled: no higher-order functions, and expressions of few calls."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidewatch.functions.text import parse_instant
from tidewatch.operators.audit import _tagged
from tidewatch.operators.external import adapt_olist
from tidewatch.operators.validate import _judged
from tidewatch.schema import BY_NAME


def plan(frame) -> str:
    return frame._jdf.queryExecution().optimizedPlan().toString()


def test_audit_lays_out_cells_without_lambdas(spark):
    rows = spark.createDataFrame([("P1", "S1", -1), ("P1", None, 2)], "source_product_id STRING, sku STRING, unit_price INT")
    tagged = _tagged(rows, "products", {}, True, {})
    assert "lambda" not in plan(tagged)
    cells = [tuple(row) for row in tagged.select("constraint", "key").orderBy("constraint", "key").collect()]
    assert cells == [(0, "P1"), (0, "P1"), (1, "S1"), (2, "P1")]


def test_faults_are_found_without_lambdas(spark):
    artifact = BY_NAME["wms/warehouses.csv"]
    rows = spark.createDataFrame([(2, *["x"] * len(artifact.columns)), (3, *[" "] * len(artifact.columns))], ["row_number", *artifact.columns])
    judged = _judged(rows, artifact, None)
    assert "lambda" not in plan(judged)
    assert [len(row.faults) > 0 for row in judged.orderBy("row_number").collect()] == [False, True]


def test_an_instant_takes_few_patterns():
    assert parse_instant("t", assume_utc=True).count("regexp_") <= 6


def test_spellings_of_instants(spark):
    texts = {
        "2025-01-15": "2025-01-15 00:00:00.000000", "20250115": "2025-01-15 00:00:00.000000",
        "2025-01-15T07": "2025-01-15 07:00:00.000000", "2025-01-15 07:08": "2025-01-15 07:08:00.000000",
        "20250115T070809": "2025-01-15 07:08:09.000000", "2025-01-15 07:08:09,1234567": "2025-01-15 07:08:09.123456",
        "2025-01-15 07:08:09.5": "2025-01-15 07:08:09.500000", "2025-01-15T07:08:09Z": "2025-01-15 07:08:09.000000",
        "2025-01-15T07:08+02": "2025-01-15 05:08:00.000000", "2025-01-15T07:08:09.25+0530": "2025-01-15 01:38:09.250000",
        "2025-01-15T07-01:30": "2025-01-15 08:30:00.000000", "2025-02-30": None, "2025-01-15T25:00:00": None, "soon": None, "": None,
    }
    rows = spark.createDataFrame([(text,) for text in texts], "t STRING")
    shown = "date_format({}, 'yyyy-MM-dd HH:mm:ss.SSSSSS')"
    found = rows.select("t", F.expr(shown.format(parse_instant("t", assume_utc=True))).alias("at")).collect()
    assert {row.t: row["at"] for row in found} == texts
    strict = rows.select("t", F.expr(parse_instant("t")).isNotNull().alias("given")).collect()
    assert {row.t for row in strict if row.given} == {text for text, at in texts.items() if at and ("Z" in text or text[13:14] in "+-" and text[13:14] or "+" in text)}


def test_adapted_instants_are_parsed_once(spark):
    tables = {
        "orders": spark.createDataFrame(
            [(2, "E1", "C1", "Delivered", "1997-03-04 05:06:07", "1997-04-01", " 4/5/1997 6:07 ")],
            "row_number LONG, order_id STRING, customer_id STRING, order_status STRING, order_purchase_timestamp STRING, "
            "order_estimated_delivery_date STRING, order_delivered_customer_date STRING",
        ),
        "payments": spark.createDataFrame([(2, "E1", "1.5")], "row_number LONG, order_id STRING, payment_value STRING"),
        "customers": spark.createDataFrame([(2, "C1", "SP")], "row_number LONG, customer_id STRING, customer_state STRING"),
    }
    adapted = adapt_olist(tables)
    assert plan(adapted).count("regexp_") <= 18
    assert adapted.select("ordered_at", "promised_at", "fulfilled_at").first() == (
        "1997-03-04T05:06:07+00:00", "1997-04-01T00:00:00+00:00", "1997-04-05T06:07:00+00:00",
    )
