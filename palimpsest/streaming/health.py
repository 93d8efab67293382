"""Stalled streams."""

from __future__ import annotations

import time

from pyspark.sql.streaming import StreamingQueryListener

STALL_TOLERANCE_SECONDS = 300


class StallListener(StreamingQueryListener):
    """Remembers when each query last finished a new batch, or said that there was nothing to do.

    A repeated report of the same batch is no progress. A stream without messages reports that it
    is idle and is not stalled.
    """

    def __init__(self, tolerance: float = STALL_TOLERANCE_SECONDS, clock=time.time) -> None:
        self.tolerance, self.clock = tolerance, clock
        self.seen: dict[str, tuple[int, float]] = {}

    def onQueryStarted(self, event) -> None:
        self.seen[str(event.runId)] = (-1, self.clock())

    def onQueryProgress(self, event) -> None:
        self.record(str(event.progress.runId), event.progress.batchId)

    def onQueryIdle(self, event) -> None:
        run = str(event.runId)
        batch, _ = self.seen.get(run, (-1, 0.0))
        self.seen[run] = (batch, self.clock())

    def onQueryTerminated(self, event) -> None:
        self.seen.pop(str(event.runId), None)

    def record(self, run: str, batch: int) -> None:
        if run not in self.seen or self.seen[run][0] != batch:
            self.seen[run] = (batch, self.clock())

    def healthy(self, run: str) -> bool:
        if run not in self.seen:
            return False
        return self.clock() - self.seen[run][1] <= self.tolerance
