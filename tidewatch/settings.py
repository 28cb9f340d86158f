"""Rule thresholds, the evaluation instant, and the session settings the jobs rely on."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from datetime import datetime, timezone
from decimal import Decimal
from typing import TypeVar

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


Item = TypeVar("Item")
Result = TypeVar("Result")


def utc_instant(value: datetime | str) -> datetime:
    """Return an aware UTC instant; an instant without an offset is refused."""
    if isinstance(value, str):
        value = datetime.fromisoformat(value.replace("Z", "+00:00"))
    if value.tzinfo is None or value.utcoffset() is None:
        raise ValueError("an instant needs a timezone")
    return value.astimezone(timezone.utc)


def instant_lit(value: datetime | str) -> Column:
    """UTC instant as a timestamp literal that does not depend on the Python host's zone."""
    return F.expr(instant_sql(value))


def instant_sql(value: datetime | str) -> str:
    return f"TIMESTAMP '{utc_instant(value).strftime('%Y-%m-%d %H:%M:%S.%f')}+00:00'"


@dataclass(frozen=True)
class Ladder:
    """Inclusive thresholds of one severity metric."""

    critical: Decimal | int
    high: Decimal | int
    medium: Decimal | int

    def __post_init__(self) -> None:
        if min(self.critical, self.high, self.medium) < 0:
            raise ValueError("severity thresholds must not be negative")
        if not self.medium <= self.high <= self.critical:
            raise ValueError("severity thresholds must rise from medium to critical")


@dataclass(frozen=True)
class RuleSettings:
    sla_risk_window_hours: int = 4
    safety_stock: Decimal = Decimal("20")
    inventory_mismatch_tolerance: Decimal = Decimal("5")
    as_of: datetime = datetime(2025, 1, 15, 12, tzinfo=timezone.utc)
    revenue: Ladder = field(default_factory=lambda: Ladder(Decimal(10000), Decimal(5000), Decimal(1000)))
    orders: Ladder = field(default_factory=lambda: Ladder(50, 20, 5))
    overdue_hours: Ladder = field(default_factory=lambda: Ladder(48, 24, 4))

    def __post_init__(self) -> None:
        if self.sla_risk_window_hours <= 0:
            raise ValueError("the SLA risk window must be positive")
        if self.safety_stock < 0 or self.inventory_mismatch_tolerance < 0:
            raise ValueError("safety stock and tolerance must not be negative")
        object.__setattr__(self, "as_of", utc_instant(self.as_of))


def configure(spark: SparkSession) -> SparkSession:
    """Runtime settings every job assumes.

    Skewed joins are always split, even where the split costs one more shuffle: a hot product,
    order or source id must not end up in a single task.
    """
    for key, value in {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.ansi.enabled": "true",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        # The virtual machine never compiles methods of more than 8,000 bytes of code: wide projections are
        # better left out of a fused stage, where Spark deals them to small methods.
        "spark.sql.codegen.hugeMethodLimit": "8000",
        # A frame that is written once needs its shuffles no more; without this they stay until the driver collects garbage.
        "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
    }.items():
        spark.conf.set(key, value)
    return spark


def side_by_side(work: Callable[[Item], Result], items: Iterable[Item]) -> list[Result]:
    """Results of independent pieces of work whose Spark jobs run at the same time, in the order of the items."""
    items = list(items)
    with ThreadPoolExecutor(max_workers=min(len(items), 8) or 1) as pool:
        return list(pool.map(work, items))


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors share, as `spark.checkpoint.dir` or `setCheckpointDir` names it."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return folder.rstrip("/")


def cut_lineage(df: DataFrame) -> DataFrame:
    """Checkpoint a frame that several sinks or later steps read, in the shared folder.

    The copy outlives its executors, so a lost one costs no recompute. Without a shared folder this
    raises; there is no other way to go on.
    """
    context = df.sparkSession.sparkContext
    folder = shared_folder(df.sparkSession)
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(folder)
    return df.checkpoint(eager=True)


def parked(df: DataFrame) -> DataFrame:
    """Write a frame that several sinks or later steps read to the shared folder, and read it from there.

    Like `cut_lineage`, for frames of many columns: the copy is compressed Parquet, a fraction of the rows'
    size on disk, and each reader takes only the columns and rows it needs.
    """
    path = f"{shared_folder(df.sparkSession)}/parked-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    copy = df.sparkSession.read.schema(df.schema).parquet(path)
    copy.parked_at = path
    return copy


def released(*copies: DataFrame) -> None:
    """Remove the files of frames as `parked` returned them, when every frame that read them is written itself."""
    for copy in copies:
        context = copy.sparkSession.sparkContext
        path = context._jvm.org.apache.hadoop.fs.Path(copy.parked_at)
        path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)
