"""Independent streaming queries: one that fails is started again, the others run on.

A listener hears of every query that ends; the supervisor's own loop (never the
listener's thread) starts a failed one again from its checkpoint, after a pause
that doubles with each failure in a row.  A query that has completed a batch since
its last start has recovered: its pause and count begin anew.  A query
that ends without an error (``availableNow``, or ``stop()``) is done.
"""

from __future__ import annotations

import queue
import time
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener


class GaveUp(RuntimeError):
    """A query failed too often in a row."""


@dataclass
class Watched:
    """One query: how to start it, its run, and what has gone wrong."""

    name: str
    begin: Callable[[], StreamingQuery]
    query: StreamingQuery | None = None
    failures: int = 0                    # in a row
    due: float | None = None             # when it starts again
    done: bool = False
    errors: list[str] = field(default_factory=list)


class _Ears(StreamingQueryListener):
    """Puts what it hears into a queue."""

    def __init__(self, heard: queue.Queue):
        self.heard = heard

    def onQueryStarted(self, event) -> None:  # noqa: N802
        pass

    def onQueryProgress(self, event) -> None:  # noqa: N802
        self.heard.put((str(event.progress.runId), "progress", None))

    def onQueryIdle(self, event) -> None:  # noqa: N802
        pass

    def onQueryTerminated(self, event) -> None:  # noqa: N802
        self.heard.put((str(event.runId), "ended", event.exception))


class Supervisor:
    """Runs named queries until all are done, or one has failed ``max_failures`` times in a row."""

    def __init__(self, spark: SparkSession, starters: dict[str, Callable[[], StreamingQuery]],
                 first_pause: float = 1.0, longest_pause: float = 300.0, max_failures: int = 8):
        self.spark = spark
        self.watched = [Watched(name, begin) for name, begin in starters.items()]
        self.first_pause, self.longest_pause, self.max_failures = first_pause, longest_pause, max_failures
        self.heard: queue.Queue = queue.Queue()
        self.runs: dict[str, Watched] = {}
        self.stopping = False

    def pause(self, failures: int) -> float:
        return min(self.longest_pause, self.first_pause * 2 ** (failures - 1))

    def _failed(self, w: Watched, why: str) -> None:
        w.failures += 1
        w.errors.append(why)
        if w.failures >= self.max_failures:
            raise GaveUp(f"{w.name} failed {w.failures} times in a row: {why[:500]}")
        w.due = time.monotonic() + self.pause(w.failures)

    def _begin(self, w: Watched) -> None:
        w.due = None
        try:
            w.query = w.begin()
        except Exception as e:  # a source or sink that is away: as a failure of the run
            self._failed(w, str(e))
            return
        self.runs[str(w.query.runId)] = w

    def _hear(self, run: str, what: str, error: str | None) -> None:
        w = self.runs.get(run)
        if w is None:
            return                       # a query of somebody else, or of a run already replaced
        if what == "progress":
            w.failures = 0
            return
        del self.runs[run]
        if error is None:
            w.done = True
        else:
            self._failed(w, str(error))

    def run(self, poll: float = 0.2) -> None:
        """Start all and block; on giving up the other queries are stopped and ``GaveUp`` is raised."""
        ears = _Ears(self.heard)
        self.spark.streams.addListener(ears)
        try:
            for w in self.watched:
                self._begin(w)
            while not self.stopping and not all(w.done for w in self.watched):
                try:
                    self._hear(*self.heard.get(timeout=poll))
                except queue.Empty:
                    pass
                for w in self.watched:
                    if w.due is not None and time.monotonic() >= w.due:
                        self._begin(w)
        finally:
            self.spark.streams.removeListener(ears)
            for w in self.watched:
                if w.query is not None and w.query.isActive:
                    w.query.stop()

    def stop(self) -> None:
        """End ``run`` from another thread."""
        self.stopping = True
