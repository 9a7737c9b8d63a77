"""Progress of running streams, seen by a listener."""

from __future__ import annotations

import threading
from collections import deque

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQueryListener

from .keyed import OUTCOME

#: Batches that are remembered, the latest ones.
REMEMBERED = 10_000
PROGRESS = (
    "query string, batch_id bigint, packets bigint, arrived bigint, rows bigint, late bigint, rejected bigint,"
    " state_updates bigint, state_rows bigint, watermark string, millis bigint"
)


class Progress(StreamingQueryListener):
    """Collects a row for each batch: what came in, what was observed on the way, what the state store did."""

    def __init__(self):
        self.rows: deque[tuple] = deque(maxlen=REMEMBERED)
        self.ended: dict[str, threading.Event] = {}

    def onQueryStarted(self, event) -> None:
        self._end(str(event.runId))

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = event.progress
        seen = p.observedMetrics.get(OUTCOME)
        counts = [int(getattr(seen, name)) if seen is not None else None for name in ("arrived", "rows", "late", "rejected")]
        updates, held = (sum(getattr(s, n) for s in p.stateOperators) for n in ("numRowsUpdated", "numRowsTotal"))
        watermark = (p.eventTime or {}).get("watermark")
        self.rows.append((str(p.id), p.batchId, p.numInputRows, *counts, updates, held, watermark, p.batchDuration))

    def onQueryTerminated(self, event) -> None:
        self._end(str(event.runId)).set()

    def wait(self, run_id: str, seconds: float = 60.0) -> bool:
        """Wait until all that is known of a run has come; the listener is told after the run has gone on."""
        return self._end(str(run_id)).wait(seconds)

    def frame(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(list(self.rows), PROGRESS)

    def _end(self, run_id: str) -> threading.Event:
        return self.ended.setdefault(run_id, threading.Event())
