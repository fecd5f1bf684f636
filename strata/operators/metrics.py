"""Counts of a load taken while it is written (C5, F6): no second pass over what was written.

Batch writes carry an observation; streams carry a named one, which a listener adds up over the micro-batches.
"""

from __future__ import annotations

import threading
import uuid

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener


def counts(columns: list[str]) -> list[Column]:
    """Rows, and nulls of each column."""
    return [F.count(F.lit(1)).alias("rows"), *[F.count_if(F.col(c).isNull()).alias(c) for c in columns]]


def observed(df: DataFrame, columns: list[str]) -> tuple[DataFrame, Observation]:
    """``df`` with the counts of ``columns``, known after the first action on it (``Observation.get``)."""
    seen = Observation(f"load-{uuid.uuid4().hex[:8]}")
    return df.observe(seen, *counts(columns)), seen


class StreamCounts(StreamingQueryListener):
    """Counts that streams observe under ``name``, by query; a micro-batch counts once however often it is reported."""

    def __init__(self, name: str):
        self.name, self._batches, self._ended = name, {}, {}

    def onQueryStarted(self, event):
        pass

    def onQueryIdle(self, event):
        pass

    def onQueryProgress(self, event):
        row = event.progress.observedMetrics.get(self.name)
        if row is not None:
            self._batches.setdefault(str(event.progress.runId), {})[event.progress.batchId] = row.asDict()

    def onQueryTerminated(self, event):
        self._ended.setdefault(str(event.runId), threading.Event()).set()

    def totals(self, query: StreamingQuery, timeout_s: int = 120) -> dict[str, int]:
        """The sums over the micro-batches of a query that has ended."""
        if not self._ended.setdefault(str(query.runId), threading.Event()).wait(timeout_s):
            raise TimeoutError(f"no end of query {query.runId} was reported")
        out: dict[str, int] = {}
        for row in self._batches.get(str(query.runId), {}).values():
            for k, v in row.items():
                out[k] = out.get(k, 0) + v
        return out
