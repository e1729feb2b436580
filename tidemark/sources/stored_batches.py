"""A stream over numbered batches in stored files; its offset is the last batch number read.

Rows of numbered batches are stored as parquet, some batches to a folder. The
stream plans the folders of the numbers that are due and reads their files in
tasks, as Arrow batches. The order follows from the numbers alone, not from
names or times of files.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyarrow import dataset, fs
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

# Spark plans a Python stream in a process that has none of the files added to
# the session, so the classes below travel with their code.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

FORMAT = "tidemark_stored_batches"
NUMBERS = "tidemark_batch_numbers"
FOLDER = "replay_folder"
_NUMBERS_PER_TASK = 10_000
_SCHEMES = {"s3a": "s3", "s3n": "s3"}


def opened(uri: str) -> tuple[fs.FileSystem, str]:
    """File system and path of a URI; ValueError or OSError where Arrow has no way to it."""
    scheme, separator, rest = uri.partition("://")
    if not separator:
        scheme, separator, rest = uri.partition(":")
        if not separator or uri.startswith("/"):
            return fs.LocalFileSystem(), uri
    if scheme == "file":
        return fs.LocalFileSystem(), "/" + rest.lstrip("/")
    return fs.FileSystem.from_uri(f"{_SCHEMES.get(scheme, scheme)}://{rest}")


class _Numbers(InputPartition):
    def __init__(self, first: int, last: int) -> None:
        self.first, self.last = first, last


class _File(InputPartition):
    def __init__(self, name: str, first: int, last: int) -> None:
        self.name, self.first, self.last = name, first, last


class _NumberReader(DataSourceStreamReader):
    """Gives out ``per_trigger`` numbers at a time, up to ``last``.

    The place reached is what Spark hands back: the end of the batch it plans,
    or, after a restart, the last offset of the checkpoint.
    """

    def __init__(self, options: dict[str, str]) -> None:
        first, last, per_trigger = (int(options[k]) for k in ("first", "last", "per_trigger"))
        self.before, self.last, self.per_trigger = first - 1, last, per_trigger
        self.reached = self.before

    def initialOffset(self) -> dict:
        return {"batch": self.before}

    def latestOffset(self) -> dict:
        return {"batch": max(self.reached, min(self.reached + self.per_trigger, self.last))}

    def partitions(self, start: dict, end: dict) -> Sequence[InputPartition]:
        self.reached = max(self.reached, end["batch"])
        return self.due(start["batch"] + 1, end["batch"])

    def due(self, first: int, last: int) -> list[InputPartition]:
        firsts = range(first, last + 1, _NUMBERS_PER_TASK)
        return [_Numbers(k, min(k + _NUMBERS_PER_TASK - 1, last)) for k in firsts]

    def read(self, partition: _Numbers) -> Iterator[tuple[int]]:
        return ((number,) for number in range(partition.first, partition.last + 1))

    def commit(self, end: dict) -> None:
        pass


class _FileReader(_NumberReader):
    def __init__(self, options: dict[str, str], schema: StructType) -> None:
        super().__init__(options)
        self.path, self.column = options["path"], options["column"]
        self.per_folder, self.schema = int(options["per_folder"]), schema

    def due(self, first: int, last: int) -> list[InputPartition]:
        system, root = opened(self.path)
        found: list[InputPartition] = []
        for folder in range((first - 1) // self.per_folder, (last - 1) // self.per_folder + 1):
            wanted = fs.FileSelector(f"{root}/{FOLDER}={folder}", allow_not_found=True)
            names = sorted(f.path for f in system.get_file_info(wanted) if f.is_file)
            found += [_File(n, first, last) for n in names if n.endswith(".parquet")]
        return found

    def read(self, partition: _File) -> Iterator[pa.RecordBatch]:
        system, _ = opened(self.path)
        target = to_arrow_schema(self.schema)
        number = dataset.field(self.column)
        rows = dataset.dataset([partition.name], filesystem=system, format="parquet").to_batches(
            columns=target.names, filter=(number >= partition.first) & (number <= partition.last)
        )
        for batch in rows:
            if batch.num_rows:
                yield from pa.Table.from_batches([batch]).cast(target).to_batches()


class BatchNumbers(DataSource):
    @classmethod
    def name(cls) -> str:
        return NUMBERS

    def schema(self) -> str:
        return "batch int"

    def streamReader(self, schema: StructType) -> DataSourceStreamReader:
        return _NumberReader(self.options)


class StoredBatches(DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def streamReader(self, schema: StructType) -> DataSourceStreamReader:
        return _FileReader(self.options, schema)


def batch_numbers(spark: SparkSession, first: int, last: int, per_trigger: int = 1) -> DataFrame:
    """Stream of the numbers ``first`` to ``last`` alone, ``per_trigger`` in each micro-batch."""
    spark.dataSource.register(BatchNumbers)
    reader = spark.readStream.format(NUMBERS)
    return reader.options(first=first, last=last, per_trigger=per_trigger).load()


def stored_batches(
    spark: SparkSession,
    path: str,
    schema: StructType,
    column: str,
    first: int,
    last: int,
    per_folder: int,
    per_trigger: int = 1,
) -> DataFrame:
    """Stream over the rows of batches ``first`` to ``last`` in the folders under ``path``.

    Batch n lies in the folder numbered (n - 1) div ``per_folder``. A query that
    is started again on its checkpoint goes on after the last batch it has
    taken. Run it on a timer: for a single pass over what is there, Spark asks a
    Python source for one micro-batch only.
    """
    spark.dataSource.register(StoredBatches)
    reader = spark.readStream.format(FORMAT).schema(schema)
    return reader.options(
        path=path, column=column, first=first, last=last, per_folder=per_folder,
        per_trigger=per_trigger,
    ).load()
