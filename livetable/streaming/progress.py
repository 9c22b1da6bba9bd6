"""What every query of a session did: rows, drops and failures, over whole runs.

``StreamingQuery.recentProgress`` keeps the last hundred micro-batches, so sums over it miss
what longer runs lost.  :class:`ProgressLog` is a listener that adds up each micro-batch as
Spark reports it, for all queries started while it is registered: one row for each run,
whatever the number of micro-batches.

Spark delivers reports after the fact, in order; a run's end is the last of them.
:meth:`ProgressLog.totals` therefore waits for the end of a run that has stopped, and gives
the sums so far for one that has not.
"""

from __future__ import annotations

import threading
import time
from dataclasses import asdict, dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

WAIT_SECONDS = 60

SCHEMA = ("run string, name string, batches long, rows_in long, rows_dropped long, "
          "ended boolean, failure string")


@dataclass
class Totals:
    """``batches``: micro-batches that read rows; ``rows_dropped``: rows that stateful
    operators refused as late; ``failure``: what ended the run, if an error did."""
    run: str
    name: str | None = None
    batches: int = 0
    rows_in: int = 0
    rows_dropped: int = 0
    ended: bool = False
    failure: str | None = None


class ProgressLog(StreamingQueryListener):
    """``with ProgressLog(spark) as log: ...`` registers the listener for the block."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self._runs: dict[str, Totals] = {}
        self._changed = threading.Condition()

    def __enter__(self) -> ProgressLog:
        self.spark.streams.addListener(self)
        return self

    def __exit__(self, *_) -> None:
        self.spark.streams.removeListener(self)

    def _run(self, run: object) -> Totals:
        return self._runs.setdefault(str(run), Totals(str(run)))

    def onQueryStarted(self, event) -> None:
        with self._changed:
            self._run(event.runId).name = event.name

    def onQueryProgress(self, event) -> None:
        p = event.progress
        with self._changed:
            t = self._run(p.runId)
            t.batches += p.numInputRows > 0
            t.rows_in += max(0, p.numInputRows)
            t.rows_dropped += sum(op.numRowsDroppedByWatermark for op in p.stateOperators)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        with self._changed:
            t = self._run(event.runId)
            t.ended, t.failure = True, event.exception
            self._changed.notify_all()

    def totals(self, query: StreamingQuery, wait_seconds: float = WAIT_SECONDS) -> Totals:
        """The sums of one run; complete if it has stopped."""
        limit = time.monotonic() + wait_seconds
        with self._changed:
            while not query.isActive and not self._run(query.runId).ended:
                if not self._changed.wait(max(0.0, limit - time.monotonic())) and time.monotonic() >= limit:
                    raise TimeoutError(f"no report of the end of run {query.runId} in {wait_seconds} s")
            return Totals(**asdict(self._run(query.runId)))

    def table(self) -> DataFrame:
        """One row for each run seen."""
        with self._changed:
            rows = [tuple(asdict(t).values()) for t in self._runs.values()]
        return self.spark.createDataFrame(rows, SCHEMA)
