"""Stream sinks. Each query gets its own checkpoint folder."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.readwriter import DataStreamWriter


def _start(writer: DataStreamWriter, every: str | None) -> StreamingQuery:
    """Run on a timer, or once over what is there when ``every`` is None."""
    if every:
        return writer.trigger(processingTime=every).start()
    return writer.trigger(availableNow=True).start()


def to_console(
    df: DataFrame,
    checkpoint: str,
    every: str | None = None,
    mode: str = "append",
    rows: int = 20,
) -> StreamingQuery:
    writer = (
        df.writeStream.format("console")
        .outputMode(mode)
        .option("truncate", False)
        .option("numRows", rows)
        .option("checkpointLocation", checkpoint)
    )
    return _start(writer, every)


def to_files(
    df: DataFrame, path: str, checkpoint: str, kind: str = "json", every: str | None = None
) -> StreamingQuery:
    writer = (
        df.writeStream.format(kind)
        .outputMode("append")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
    )
    return _start(writer, every)


def to_memory(
    df: DataFrame, name: str, every: str | None = None, mode: str = "append"
) -> StreamingQuery:
    """In-memory table on the driver: for looking at small streams only."""
    return _start(df.writeStream.format("memory").queryName(name).outputMode(mode), every)


def to_batches(
    df: DataFrame,
    write: Callable[[DataFrame, int], None],
    checkpoint: str,
    every: str | None = None,
    mode: str = "append",
) -> StreamingQuery:
    writer = (
        df.writeStream.foreachBatch(write)
        .outputMode(mode)
        .option("checkpointLocation", checkpoint)
    )
    return _start(writer, every)


def batch_folder(path: str, batch_id: int) -> str:
    return f"{path}/batch_id={batch_id}"


def replace_batch(batch: DataFrame, path: str, batch_id: int, kind: str = "parquet") -> None:
    """Write one micro-batch; a repeat of the same batch replaces it."""
    batch.write.mode("overwrite").format(kind).save(batch_folder(path, batch_id))


def fan_out(
    outputs: Mapping[str, Callable[[DataFrame], DataFrame]], path: str
) -> Callable[[DataFrame, int], None]:
    """A batch writer that computes the batch once and stores several views of it."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            for name, view in outputs.items():
                replace_batch(view(batch), f"{path}/{name}", batch_id)
        finally:
            batch.unpersist()

    return write
