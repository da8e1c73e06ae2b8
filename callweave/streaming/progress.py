"""Throughput of running streams."""

from __future__ import annotations

from collections import deque
from datetime import datetime, timezone

from pyspark.sql.streaming import StreamingQueryListener


class ThroughputLog(StreamingQueryListener):
    """Totals and errors per stream, and a record per recent micro-batch.

    Add with ``spark.streams.addListener`` before the streams start. Totals count every batch
    reported, however few of them Spark or ``entries`` (the last ``keep``) still hold."""

    def __init__(self, keep: int = 1000) -> None:
        self.records: dict[str, int] = {}
        self.errors: dict[str, int] = {}
        self.started: dict[str, datetime] = {}
        self.ended: set[str] = set()
        self.entries: deque[dict] = deque(maxlen=keep)
        self._names: dict[str, str] = {}

    def onQueryStarted(self, event) -> None:
        name = event.name or str(event.id)
        self._names[str(event.id)] = name
        self.records.setdefault(name, 0)
        self.errors.setdefault(name, 0)
        self.ended.discard(name)
        self.started[name] = datetime.now(timezone.utc)

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        name = progress.name or str(progress.id)
        self.records[name] = self.records.get(name, 0) + progress.numInputRows
        self.entries.append(
            {
                "timestamp": progress.timestamp,
                "topic": name,
                "batch_id": progress.batchId,
                "records": self.records[name],
                "batch_size": progress.numInputRows,
                "records_per_second": round(progress.processedRowsPerSecond or 0.0, 2),
                "elapsed_seconds": round((progress.durationMs or {}).get("triggerExecution", 0) / 1000, 2),
            }
        )

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        name = self._names.get(str(event.id), str(event.id))
        if event.exception:
            self.errors[name] = self.errors.get(name, 0) + 1
        self.ended.add(name)  # after its last progress: events of a stream come in order
