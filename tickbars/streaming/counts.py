"""Counts of accepted and refused ticks, taken in the pass that makes the candles."""

from __future__ import annotations

from collections import Counter
from threading import Lock

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

from tickbars.operators.quality import REASON, TICK_REASONS

METRIC = "ticks"
ACCEPTED = "accepted"


def counted_ticks(ticks: DataFrame) -> DataFrame:
    """The checked ticks, with a metric of each micro-batch: accepted ones, and refused ones by reason."""
    refused = [F.count_if(F.col(REASON) == reason).alias(reason) for reason in TICK_REASONS]
    return ticks.observe(METRIC, F.count_if(F.col(REASON).isNull()).alias(ACCEPTED), *refused)


class TickCounts(StreamingQueryListener):
    """Totals over the micro-batches of all candle streams of a session, for `spark.streams.addListener`.

    Counts are a metric, not a table: a micro-batch that is run again after a failure counts again.
    """

    def __init__(self):
        self._lock, self._totals = Lock(), Counter()

    def totals(self) -> dict[str, int]:
        with self._lock:
            return dict(self._totals)

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        seen = event.progress.observedMetrics.get(METRIC)
        if seen is not None:
            with self._lock:
                self._totals.update({name: n for name, n in seen.asDict().items() if n})
