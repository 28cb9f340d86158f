"""Small helpers the text operators share."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

#: Java pattern of one white-space character as the operators define it: space and U+0009 to U+000D.
SPACE = r"[ \x09-\x0D]"
#: A character of a word: any other.
WORD = r"[^ \x09-\x0D]"
#: The white-space characters as a Spark SQL literal.
SPACE_CHARS = r"' \u0009\u000A\u000B\u000C\u000D'"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def literal(text: str) -> str:
    """A Spark SQL string literal; backslashes and quotes stand for themselves."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def bind(value: str, name: str, body: str) -> str:
    """SQL `body` in which `name` stands for `value`, evaluated once for the row."""
    return f"transform(array({value}), {name} -> {body})[0]"


def text_settings(spark: SparkSession) -> SparkSession:
    """Batches of few rows for Python workers: a row may hold a very long text."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "500")
    return spark
