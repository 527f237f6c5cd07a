"""Session settings and the shared folder that staged tables live in."""

from __future__ import annotations

import os
import tempfile
import uuid
from functools import cache

from pyspark.sql import DataFrame, SparkSession

# Runtime settings the plans rely on. All of them leave results alone.
#  - AQE re-plans joins from measured sizes, splits skewed join partitions and
#    coalesces small ones. The forced variant also splits a skewed join in the
#    middle of a chain of joins on one key, at the price of a shuffle that is
#    added only when the skew is there.
ADAPTIVE_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}


def tune(spark: SparkSession) -> SparkSession:
    """Apply the adaptive settings to a running session."""
    for key, value in ADAPTIVE_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "matchledger") -> SparkSession:
    """A local session for tests and the bench; on a cluster bring your own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", os.environ.get("MATCHLEDGER_DRIVER_MEMORY", "8g"))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    )
    for key, value in ADAPTIVE_SETTINGS.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by `spark.checkpoint.dir`.

    Only a local session may fall back to a temporary folder of its own.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    master = spark.sparkContext.master
    if master != "local" and not master.startswith("local["):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    return _local_fallback()


@cache
def _local_fallback() -> str:
    return "file://" + tempfile.mkdtemp(prefix="matchledger-")


class Workspace:
    """A database in the shared folder for staged frames and demo tables.

    Staging a frame as a table gives it a result that survives lost executors
    (unlike a cache), evaluates it once, and gives later joins its true size.
    """

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.database = f"matchledger_{uuid.uuid4().hex[:12]}"
        spark.sql(
            f"CREATE DATABASE {self.database} LOCATION '{shared_folder(spark)}/{self.database}'"
        )

    def table(self, name: str) -> str:
        return f"{self.database}.{name}"

    def stage(self, df: DataFrame, label: str) -> tuple[str, DataFrame]:
        name = self.table(f"{label}_{uuid.uuid4().hex[:8]}")
        df.write.format("parquet").saveAsTable(name)
        return name, self.spark.table(name)

    def release(self, *names: str) -> None:
        for name in names:
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")

    def drop(self) -> None:
        """Remove the database with every table still in it."""
        self.spark.sql(f"DROP DATABASE IF EXISTS {self.database} CASCADE")
