"""Session set-up and the shared folder that staged tables live in."""

from __future__ import annotations

import math
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

MEBIBYTE = 1024 * 1024
PARTITION_BYTES = 128 * MEBIBYTE
LARGEST_SPLIT_BYTES = 1024 * MEBIBYTE
MOST_SCAN_TASKS = 100_000


def sizing(input_bytes: int, cores: int, shuffled_bytes: int | None = None) -> dict[str, str]:
    """Scan and shuffle settings for an input of known size.

    Shuffle partitions are near 128 MB of ``shuffled_bytes``, which is the whole
    input unless a job is known to shuffle less, so sort tasks stay small at any
    size. Very large inputs get larger splits, which keeps the number of shuffle
    blocks down from the map side. AQE merges partitions that turn out small.
    """
    split = max(PARTITION_BYTES, min(LARGEST_SPLIT_BYTES, input_bytes // MOST_SCAN_TASKS))
    moved = input_bytes if shuffled_bytes is None else shuffled_bytes
    partitions = math.ceil(moved / PARTITION_BYTES)
    return {
        "spark.sql.shuffle.partitions": str(max(cores, partitions)),
        "spark.sql.files.maxPartitionBytes": str(split),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(PARTITION_BYTES),
    }


def build_session(app: str = "tidemark", master: str | None = None, **conf: str) -> SparkSession:
    """A UTC session with AQE and skew handling; ANSI mode stays on."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        # Rows with file contents are large; a batch for Python stays bounded.
        "spark.sql.execution.arrow.maxBytesPerBatch": str(64 * MEBIBYTE),
        "spark.ui.enabled": "false",
    }
    settings.update(conf)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


_local_folders: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a local session may go without the setting; it then gets a temporary
    folder of its own.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    if context.applicationId not in _local_folders:
        _local_folders[context.applicationId] = tempfile.mkdtemp(prefix="tidemark-")
    return _local_folders[context.applicationId]


_scope: ContextVar[str | None] = ContextVar("_scope", default=None)


def new_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder; nothing is created yet."""
    return f"{_scope.get() or shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


@contextmanager
def staging(spark: SparkSession) -> Iterator[str]:
    """Removes at its end what the calling thread has staged inside.

    Frames built inside read staged tables, so results have to be stored or
    collected before the end. Tables staged without such a block stay.
    """
    folder = new_path(spark, "staging")
    token = _scope.set(folder)
    try:
        yield folder
    finally:
        _scope.reset(token)
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as parquet to the shared folder and read it back.

    This cuts the lineage: later plans read files, so a lost executor costs a
    re-read and never a second, possibly different, run of the plan above.
    """
    spark = df.sparkSession
    path = new_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Let Python workers import this package, wherever the session was started.

    The archive is made on the driver, and Spark copies it to the executors.
    """
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    package = Path(__file__).parent
    stem = Path(tempfile.mkdtemp(prefix="tidemark-package-")) / package.name
    archive = shutil.make_archive(str(stem), "zip", package.parent, package.name)
    context.addPyFile(archive)
    _shipped.add(context.applicationId)
