"""The corpus pipeline: documents go through five stages, each written and read again before the next."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.llm import leaks, pieces, privacy, quality, simhash
from tidewatch.llm.common import table, text_settings
from tidewatch.settings import configure, shared_folder

#: Model file of the vocabulary.
MODEL = "/opt/tokenizers/piece_bpe_32k.model"

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def _ready(spark: SparkSession) -> SparkSession:
    return text_settings(configure(spark))


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass, without their failing lines."""
    _ready(spark)
    return quality.clean(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    _ready(spark)
    return simhash.deduplicate(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without passages of the benchmark."""
    _ready(spark)
    return leaks.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data replaced by its kind, and the terms that give it away generalised or removed."""
    _ready(spark)
    return privacy.sanitise(docs)


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, the ids of the text and their number."""
    _ready(spark)
    return pieces.encode(docs, pieces.Vocabulary.load(MODEL)).select("doc_id", "ids", F.expr("CAST(size(ids) AS BIGINT) AS n_ids"))


STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("personal_data", personal_data),
    ("encoding", encoding),
]

#: Alignment and segmentation cannot be said in SQL; the stages are tested against plain Python.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents. What stages hand on is kept in the shared folder."""
    folder = f"{shared_folder(_ready(spark))}/pipeline-{uuid.uuid4().hex}"
    docs = table(spark, sf_dir, "documents")
    for number, (name, stage) in enumerate(STAGES):
        out = f"{folder}/{number}-{name}"
        stage(spark, docs, sf_dir).write.parquet(out)
        docs = spark.read.parquet(out)
    return docs
