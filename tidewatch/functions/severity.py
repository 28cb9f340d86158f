"""Severity of a finding from its three metrics, as a Spark SQL fragment."""

from __future__ import annotations

from tidewatch.settings import RuleSettings


def severity(
    settings: RuleSettings,
    revenue: str | None = None,
    orders: str | None = None,
    overdue_hours: str | None = None,
) -> str:
    """Highest rank any metric reaches; thresholds are inclusive, a missing metric is ignored."""
    metrics = [
        (metric, ladder)
        for metric, ladder in (
            (revenue, settings.revenue),
            (orders, settings.orders),
            (overdue_hours, settings.overdue_hours),
        )
        if metric is not None
    ]

    def reached(rank: str) -> str:
        return " OR ".join(f"coalesce({metric} >= {getattr(ladder, rank)}, false)" for metric, ladder in metrics)

    if not metrics:
        return "'LOW'"
    ranks = " ".join(f"WHEN {reached(rank)} THEN '{rank.upper()}'" for rank in ("critical", "high", "medium"))
    return f"CASE {ranks} ELSE 'LOW' END"


def interval_hours(interval: str) -> str:
    """Hours of a day-time interval, for lateness given as a duration."""
    micros = f"unix_micros(timestamp_micros(0) + {interval})"
    return f"CAST({micros} AS DECIMAL(20,0)) / CAST(3600000000 AS DECIMAL(10,0))"
