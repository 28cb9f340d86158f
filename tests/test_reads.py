import pytest
from pyspark.sql import functions as F

from tidewatch.functions import text
from tidewatch.operators import reads


def show(spark, sql):
    return spark.range(1).select(F.expr(sql)).first()[0]


@pytest.mark.parametrize(
    ("sql", "expected"),
    [
        (text.enum_label("'SLA_BREACH_RISK'"), "SLA breach risk"), (text.enum_label("'IN_PROGRESS'"), "In progress"),
        (text.enum_label("CAST(NULL AS STRING)"), "—"), (text.currency_label("'1234567.50'"), "$1,234,567.50"),
        (text.currency_label("'n/a'"), "n/a"), (text.timestamp_label("'2025-01-15T13:00:00+01:00'"), "2025-01-15 12:00 UTC"),
        (text.timestamp_label("'2025-01-15'"), "2025-01-15"), (text.confidence_label("'0.9000'"), "90%"),
        (text.confidence_label("'0.1255'"), "12.6%"), (text.confidence_label("'0.1225'"), "12.2%"), (text.kpi_label("'98.5'", "percent"), "98.5%"),
        (text.plain_decimal_text("CAST(100 AS DECIMAL(38,10))"), "100"), (text.fact_text("CAST(0 AS DECIMAL(38,5))"), "0"),
    ],
)
def test_formats(spark, sql, expected):
    assert show(spark, sql) == expected


def test_pages(spark):
    rows = spark.range(1, 12).selectExpr("id AS k", "id % 2 AS odd")
    assert [r["k"] for r in reads.page(rows, ("k",), 2, 4).collect()] == [5, 6, 7, 8]
    assert [r["k"] for r in reads.page(rows, ("k",), size=3, after=(8,)).collect()] == [9, 10, 11]
    assert reads.page_total(rows).first()["total"] == 11
    for number, size in ((0, 1), (1, 0), (1, 101)):
        with pytest.raises(ValueError):
            reads.page(rows, ("k",), number, size)


def test_filters():
    assert reads.nonblank_filters(a=" x ", b="  ", c=[], d=("y",)) == {"a": "x", "d": ["y"]}
    with pytest.raises(ValueError):
        reads.queue_anchor(None, "2025-01-15T12:00:00", None)
    early = reads.queue_anchor("2025-01-14T00:00:00Z", None, reads.utc_instant("2025-01-15T12:00:00Z"))
    assert early == reads.utc_instant("2025-01-14T00:00:00Z")


def test_pages_of_any_depth(spark):
    rows = spark.range(0, 120_000, 1, 7).selectExpr("(id * 7919) % 120000 AS k", "concat('r', id) AS label")
    assert [r["k"] for r in reads.page(rows, ("k",), 1101, 100).collect()] == list(range(110_000, 110_100))
    assert reads.page(rows, ("k",), 1201, 100).count() == 0


def test_every_query_has_a_twin():
    from oracle.queries import sql
    from tidewatch.plans.registry import registered

    assert set(registered()) == set(sql())
