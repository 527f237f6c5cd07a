"""What the operators share: reading a test table, staged tables, and word hashing."""

from __future__ import annotations

import shutil
import tempfile
import uuid
from pathlib import Path

import numpy as np
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from matchledger.session import shared_folder, tune


_PACKAGE = Path(__file__).resolve().parents[1]
_shipped: set[str] = set()


def prepare(spark: SparkSession) -> SparkSession:
    """Adaptive settings, modest Arrow batches, and this package for the executors' Python.

    Texts may be long, so a batch holds a thousand rows rather than ten thousand.
    """
    tune(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")
    application = spark.sparkContext.applicationId
    if application not in _shipped and _PACKAGE.is_dir():
        folder = tempfile.mkdtemp(prefix="matchledger-")
        with tempfile.TemporaryDirectory() as plain:
            shutil.copytree(_PACKAGE, f"{plain}/{_PACKAGE.name}", ignore=shutil.ignore_patterns("__pycache__"))
            archive = shutil.make_archive(f"{folder}/{_PACKAGE.name}", "zip", plain)
        spark.sparkContext.addPyFile(archive)
        _shipped.add(application)
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{sf_dir}/{name}.parquet")


class Scratch:
    """Tables staged in the folder that all executors share.

    A staged table is computed once, has a known size, and cuts the lineage: a
    lost executor costs only the tasks it ran. `release` removes a table once its last
    reader has been staged itself. Results that are read lazily need the rest until they
    have been written; `drop` removes it then, and the end of the application does at last.
    """

    def __init__(self, spark: SparkSession):
        self.spark = prepare(spark)
        self.folder = f"{shared_folder(spark)}/matchledger_llm_{uuid.uuid4().hex[:12]}"
        self._paths: dict[int, tuple[DataFrame, str]] = {}
        files, folder = self._files(self.folder)
        files.mkdirs(folder)
        files.deleteOnExit(folder)

    def _files(self, path: str):
        path = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return path.getFileSystem(self.spark._jsc.hadoopConfiguration()), path

    def path(self, label: str) -> str:
        return f"{self.folder}/{label}_{uuid.uuid4().hex[:8]}"

    def stage(self, df: DataFrame, label: str) -> DataFrame:
        path = self.path(label)
        df.write.parquet(path)
        staged = self.spark.read.schema(df.schema).parquet(path)
        self._paths[id(staged)] = (staged, path)
        return staged

    def release(self, *staged: DataFrame) -> None:
        """Remove staged tables that nothing will read again; other frames are left alone.

        What Spark shuffled for them goes when the driver's JVM collects garbage, which it is asked to do.
        """
        for df in staged:
            _, path = self._paths.pop(id(df), (None, None))
            if path:
                files, place = self._files(path)
                files.delete(place, True)
        self.spark._jvm.System.gc()

    def drop(self) -> None:
        files, folder = self._files(self.folder)
        files.delete(folder, True)
        self._paths.clear()


ROW, TAG = "_row", "_tag"
#: Bits of a row's place in its file; the bits above number the file.
FILE_BITS = 40
#: Names of more files than these are not sent to every task.
BROADCAST_FILES = 50_000


def tagged(df: DataFrame, *columns: str) -> DataFrame:
    """The named columns and `_tag`, a number of the row that tells apart rows equal throughout.

    The number holds for one job: how a scan is split, and with it the number, goes by the cores
    that are there when it starts. What is read more than once needs `tagged_rows`.
    """
    return df.select(*columns, F.monotonically_increasing_id().alias(TAG))


def _is_scan(df: DataFrame) -> bool:
    """Whether each row of `df` is one row of its files: a scan, and columns or filters over it."""
    plan = df._jdf.queryExecution().analyzed()
    while plan.nodeName() in ("Project", "Filter", "SubqueryAlias"):
        plan = plan.children().head()
    return plan.nodeName() == "LogicalRelation"


def _by_place(df: DataFrame) -> DataFrame | None:
    """Whole rows with their `_file` and their place `_at` in it, None where files do not tell."""
    if not _is_scan(df):
        return None
    place = df.metadataColumn("_metadata")
    try:
        return df.select(
            F.struct("*").alias(ROW), place.getField("file_path").alias("_file"), place.getField("row_index").alias("_at")
        )
    except AnalysisException:  # a format that does not number its rows
        return None


def tagged_rows(df: DataFrame, scratch: Scratch) -> DataFrame:
    """Whole rows as one struct beside `_tag`, so that no column name can clash.

    Any later job that reads the result again gets the same numbers, however it splits the
    files: of a stored table, a row's number is made from its file's place among the sorted
    paths and its own place in the file; anything else is staged once with its numbers.
    """
    rows = _by_place(df)
    if rows is None:
        return scratch.stage(df.select(F.struct("*").alias(ROW), F.monotonically_increasing_id().alias(TAG)), "rows")
    paths = sorted(r[0] for r in rows.select("_file").distinct().collect())
    files = scratch.spark.createDataFrame(list(enumerate(paths)), "_k long, _file string")
    if len(paths) <= BROADCAST_FILES:
        files = F.broadcast(files)
    return rows.join(files, "_file").select(ROW, F.shiftleft("_k", FILE_BITS).bitwiseOR(F.col("_at")).alias(TAG))


def utf8(column: str):
    """The bytes of a text, empty for NULL."""
    return F.coalesce(F.col(column), F.lit("")).cast("binary")


# 64-bit arithmetic on arrays, modulo 2 ** 64 ------------------------------------

_ODD = np.uint64(0x9E3779B97F4A7C15)
_ODD_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 2**64))


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit numbers (the finaliser of SplitMix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class RunHashes:
    """Hashes of any run of consecutive words, from one hash for each word.

    With prefix sums of word hash times a power of an odd number, the hash of a
    run is a difference of two sums times the power's inverse.
    """

    def __init__(self, words: np.ndarray):
        n = len(words)
        powers = np.full(n, _ODD)
        inverses = np.full(n, _ODD_INVERSE)
        if n:
            powers[0] = inverses[0] = np.uint64(1)
        np.cumprod(powers, out=powers)
        self._inverses = np.cumprod(inverses)
        self._sums = np.zeros(n + 1, np.uint64)
        np.cumsum(words * powers, out=self._sums[1:])

    def __call__(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Hashes of the runs [start, end); each run has a word at least."""
        return mixed((self._sums[ends] - self._sums[starts]) * self._inverses[starts])
