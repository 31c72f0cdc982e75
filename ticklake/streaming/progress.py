"""What a stream's micro-batches cost, as a table: rows, durations, and the lag behind the trigger."""

from __future__ import annotations

import json
import logging
import threading

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQueryListener

log = logging.getLogger(__name__)

SCHEMA = (
    "query string, run string, batch_id bigint, started string, rows bigint, rows_per_second double, batch_ms bigint, "
    "trigger_ms bigint, lag_ms bigint, state_rows bigint, sources string"
)


def progress_row(told: dict, trigger_ms: int | None) -> tuple:
    """A row of the table from a progress report; the lag is what a batch takes beyond its trigger interval."""
    took = told.get("durationMs", {}).get("triggerExecution", 0)
    states = [state.get("numRowsTotal", 0) for state in told.get("stateOperators", [])]
    return (
        told.get("name") or told["id"],
        told["runId"],
        told["batchId"],
        told["timestamp"],
        told["numInputRows"],
        float(told.get("processedRowsPerSecond") or 0.0),
        took,
        trigger_ms,
        None if trigger_ms is None else max(0, took - trigger_ms),
        sum(states) if states else None,
        json.dumps([source.get("endOffset") for source in told.get("sources", [])]),
    )


class ProgressTable(StreamingQueryListener):
    """Stores the progress of all queries of a session below ``path``.

    Reports are gathered and written ``every`` so many, when a query ends, and by ``flush``: a batch of
    a second is not slowed by a write of its own. A failed write is logged and tried again with the next.
    """

    def __init__(self, spark: SparkSession, path: str, trigger_ms: int | None = None, every: int = 60) -> None:
        self.spark, self.path, self.trigger_ms, self.every = spark, path, trigger_ms, every
        self._held: list[tuple] = []
        self._lock = threading.Lock()

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        with self._lock:
            self._held.append(progress_row(json.loads(event.progress.json), self.trigger_ms))
            due = len(self._held) >= self.every
        if due:
            self.flush()

    def onQueryTerminated(self, event) -> None:
        self.flush()

    def flush(self) -> None:
        with self._lock:
            rows, self._held = self._held, []
        if not rows:
            return
        try:
            self.spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(self.path)
        except Exception:
            log.exception("%s progress reports wait for the next write", len(rows))
            with self._lock:
                self._held = rows + self._held

    def read(self) -> DataFrame:
        return self.spark.read.schema(SCHEMA).parquet(self.path)
