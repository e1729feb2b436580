"""State of a running query in a few numbers."""

from __future__ import annotations

import threading
from collections import defaultdict
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.listener import StreamingQueryListener

TOTALS = (
    "query_id string, run_id string, name string, batches bigint, input_rows bigint,"
    " late_rows bigint, state_rows bigint, last_batch_id bigint, watermark timestamp,"
    " first_progress timestamp, last_progress timestamp, ended boolean, error string"
)


def _time(text: str | None) -> datetime | None:
    return datetime.fromisoformat(text.replace("Z", "+00:00")) if text else None


class QueryTotals(StreamingQueryListener):
    """Adds up the progress of every query of a session from when it is registered.

    Spark keeps only the last progress entries of a query; the totals here
    cover all of them, in one small record per run of a query. Register it with
    ``spark.streams.addListener``.
    """

    def __init__(self) -> None:
        self._totals: dict[str, dict] = defaultdict(
            lambda: {"batches": 0, "input_rows": 0, "late_rows": 0}
        )
        self._runs: dict[str, dict] = {}
        self._changed = threading.Condition()

    def onQueryStarted(self, event) -> None:
        with self._changed:
            self._run(event.id, event.runId)["name"] = event.name

    def _run(self, query_id, run_id) -> dict:
        return self._runs.setdefault(
            str(run_id),
            {"query_id": str(query_id), "run_id": str(run_id), "name": None, "batches": 0,
             "input_rows": 0, "late_rows": 0, "state_rows": 0, "ended": False},
        )

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        late = sum(s.numRowsDroppedByWatermark for s in progress.stateOperators)
        with self._changed:
            run = self._run(progress.id, progress.runId)
            for record in (self._totals[str(progress.id)], run):
                record["batches"] += 1
                record["input_rows"] += progress.numInputRows
                record["late_rows"] += late
            run["state_rows"] = sum(s.numRowsTotal for s in progress.stateOperators)
            run["last_batch_id"] = progress.batchId
            run["watermark"] = _time(dict(progress.eventTime).get("watermark"))
            run["last_progress"] = _time(progress.timestamp)
            run.setdefault("first_progress", run["last_progress"])

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        with self._changed:
            run = self._run(event.id, event.runId)
            run["ended"], run["error"] = True, event.exception
            self._changed.notify_all()

    def of(self, query: StreamingQuery) -> dict[str, int]:
        return dict(self._totals[str(query.id)])

    def wait(self, query: StreamingQuery, seconds: float = 30) -> bool:
        """True once all that an ended query has reported is counted; reports come some time after."""
        run_id = str(query.runId)
        with self._changed:
            return self._changed.wait_for(
                lambda: self._runs.get(run_id, {}).get("ended", False), seconds
            )

    def table(self, spark: SparkSession) -> DataFrame:
        """One row per run of a query."""
        names = [part.split()[0] for part in TOTALS.split(", ")]
        with self._changed:
            rows = [tuple(run.get(name) for name in names) for run in self._runs.values()]
        return spark.createDataFrame(rows, TOTALS)


def store_totals(totals: QueryTotals, spark: SparkSession, path: str) -> None:
    """Writes the totals to a folder for each run, so storing them again replaces them."""
    rows = totals.table(spark)
    (
        rows.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("run_id")
        .parquet(path)
    )


def stored_totals(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(TOTALS).parquet(path)


def query_status(query: StreamingQuery, totals: QueryTotals | None = None) -> dict:
    """Name, activity, rows read and rows dropped as late.

    With ``totals`` over the whole life of the query, else over the progress
    entries that Spark still keeps (``spark.sql.streaming.numRecentProgressUpdates``).
    """
    state = {"name": query.name, "active": query.isActive}
    if totals is not None:
        return state | totals.of(query)
    progress = query.recentProgress
    states = [state for entry in progress for state in entry["stateOperators"]]
    return state | {
        "batches": len({entry["batchId"] for entry in progress}),
        "input_rows": sum(entry["numInputRows"] for entry in progress),
        "late_rows": sum(state["numRowsDroppedByWatermark"] for state in states),
    }
