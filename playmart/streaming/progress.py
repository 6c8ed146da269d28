"""Per-query stream progress, from Spark's own progress events.

A ``StreamingQueryListener`` that keeps, per query name, the input rows and
the time spent in micro-batches.  Only the small progress records reach the
driver (the engine sends them there anyway); no data does.
"""

from __future__ import annotations

import threading
from collections import defaultdict

from pyspark.sql.streaming import StreamingQueryListener


class ProgressLog(StreamingQueryListener):
    def __init__(self):
        super().__init__()
        self._lock = threading.Lock()
        self.rows = defaultdict(int)
        self.batches = defaultdict(int)
        self.batch_ms = defaultdict(int)
        self.observed = defaultdict(lambda: defaultdict(int))

    def onQueryStarted(self, event):
        pass

    def onQueryProgress(self, event):
        p = event.progress
        name = p.name or str(p.id)
        with self._lock:
            self.rows[name] += int(p.numInputRows or 0)
            self.batches[name] += 1
            self.batch_ms[name] += int((p.durationMs or {}).get("triggerExecution", 0))
            for row in (p.observedMetrics or {}).values():
                for k, v in row.asDict().items():
                    if isinstance(v, int):
                        self.observed[name][k] += v

    def onQueryIdle(self, event):
        pass

    def onQueryTerminated(self, event):
        pass

    def summary(self) -> dict:
        """name -> {rows, batches, batch_sec, rows_per_sec} (time inside batches)."""
        with self._lock:
            out = {}
            for name in sorted(self.rows):
                sec = self.batch_ms[name] / 1000.0
                out[name] = {"rows": self.rows[name], "batches": self.batches[name],
                             "batch_sec": round(sec, 3),
                             "rows_per_sec": round(self.rows[name] / sec, 1) if sec else None}
                if self.observed.get(name):
                    out[name]["observed"] = dict(self.observed[name])
            return out
