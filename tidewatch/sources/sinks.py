"""File sinks of summaries, exports and evidence."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tidewatch.operators.reads import queue_rows


def write_csv(rows: DataFrame, path: str) -> None:
    """All rows as CSV with a header, nulls as empty fields."""
    rows.write.mode("overwrite").option("header", True).option("escape", '"').option("emptyValue", "").csv(path)


def write_json(rows: DataFrame, path: str) -> None:
    """One JSON object per row; nulls are written, so every object has every field."""
    rows.write.mode("overwrite").option("ignoreNullFields", False).json(path)


def export_queue(state: DataFrame, path: str) -> None:
    """Every row of a filtered queue in the eleven export columns."""
    write_csv(queue_rows(state), path)
