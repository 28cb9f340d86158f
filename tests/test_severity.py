import pytest
from pyspark.sql import functions as F

from tidewatch.functions.severity import interval_hours, severity
from tidewatch.settings import Ladder, RuleSettings

SETTINGS = RuleSettings(revenue=Ladder(1000, 500, 100), orders=Ladder(50, 20, 5), overdue_hours=Ladder(48, 24, 4))


@pytest.mark.parametrize(
    ("revenue", "orders", "overdue", "expected"),
    [("100", "20", "0", "HIGH"), ("0", "0", "48", "CRITICAL"), ("99.99", "4", "3.9999", "LOW"), ("100", "0", "0", "MEDIUM"),
     ("NULL", "NULL", "24", "HIGH"), ("1000", "NULL", "NULL", "CRITICAL"), ("NULL", "NULL", "NULL", "LOW")],
)
def test_highest_rank_wins(spark, revenue, orders, overdue, expected):
    assert spark.range(1).select(F.expr(severity(SETTINGS, revenue, orders, overdue))).first()[0] == expected


def test_lateness_as_interval(spark):
    hours = spark.range(1).select(F.expr(interval_hours("make_dt_interval(2, 0, 30)"))).first()[0]
    assert float(hours) == 48.5
