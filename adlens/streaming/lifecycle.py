"""The life of a streaming query (ST-2, ST-7): events, compaction while idle, graceful stop.

A query without new data runs no batch, so a sink that compacts after its batches never
does in a quiet hour. A listener counts what Spark reports: batches with rows, batches
without, idle triggers. The control loop beside the query (not the listener, whose events
queue up behind each other) compacts when enough of them have passed since something was
written, and stops the query after its running batch when a stop file appears.
"""

from __future__ import annotations

import threading

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQueryListener

from adlens.sources import files
from adlens.streaming import deal_stream


class QueryEvents(StreamingQueryListener):
    """Counts of one query's events: ``batches`` with input, ``empty`` batches, ``idle`` triggers."""

    def __init__(self):
        self.batches = self.empty = self.idle = 0
        self.since, self.wrote = 0, False  # events since the last compaction; was anything written?
        self.query_id: str | None = None
        self.error: str | None = None
        self.lock = threading.Lock()

    def _mine(self, event) -> bool:
        return self.query_id is not None and str(event.id) == self.query_id

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        if self.query_id is not None and str(event.progress.id) == self.query_id:
            with self.lock:
                self.since += 1
                if event.progress.numInputRows:
                    self.batches += 1
                    self.wrote = True
                else:
                    self.empty += 1

    def onQueryIdle(self, event) -> None:
        if self._mine(event):
            with self.lock:
                self.idle += 1
                self.since += 1

    def onQueryTerminated(self, event) -> None:
        if self._mine(event):
            self.error = event.exception

    def due(self, every: int) -> bool:
        """Have ``every`` events passed, and was something written? Counts anew after a yes."""
        with self.lock:
            yes = self.wrote and self.since >= every
            if yes:
                self.since, self.wrote = 0, False
            return yes


def exists(path: str) -> bool:
    from pyarrow import fs as pafs
    fs, leaf = files.filesystem(path)
    return fs.get_file_info(leaf).type != pafs.FileType.NotFound


def run_until_stopped(spark: SparkSession, query, stop_file: str | None = None, totals_path: str | None = None, compact_every: int = 1000,
                      poll_s: float = 5.0) -> QueryEvents:
    """Wait for ``query``; meanwhile compact ``totals_path`` every ``compact_every`` events, idle ones
    included, and stop the query gracefully once ``stop_file`` exists. An error of the query
    is raised, as by ``awaitTermination``."""
    events = QueryEvents()
    events.query_id = str(query.id)
    spark.streams.addListener(events)
    try:
        while not query.awaitTermination(poll_s):
            if totals_path and events.due(compact_every):
                deal_stream.compact_totals(spark, totals_path)
            if stop_file and exists(stop_file):
                deal_stream.stop_gracefully(query)
    finally:
        spark.streams.removeListener(events)
    return events
