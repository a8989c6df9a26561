"""How many rows each topic had in each batch of a stream, from the stream's own metrics."""

from __future__ import annotations

import threading
import time
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

_NAME = "fleetgrid_loads"
_OTHERS = "other topics"
COUNTS_SCHEMA = "query string, batch bigint, topic string, n bigint"


def observe_loads(stream: DataFrame, topics: Iterable[str]) -> DataFrame:
    """The stream, with counts of its rows by topic as an observed metric. Rows of other
    topics, and of none, are counted together."""
    topics = list(topics)
    topic = F.col("topic")
    known = F.coalesce(topic.isin(topics), F.lit(False))
    counts = [F.count_if(topic == x).alias(f"topic {x}") for x in topics]
    return stream.observe(_NAME, *counts, F.count_if(~known).alias(_OTHERS))


class LoadCounts(StreamingQueryListener):
    """Collects the counts of every batch, for as long as it is registered.

        counts = LoadCounts(spark)
        query = fg.ingest(...)
        counts.rows()              # (query id, batch, topic, rows), also while it runs
        counts.close()

    Spark reports a batch when it has ended, a little later; `wait` waits for the reports of
    a query that has ended. A batch that failed is reported when its retry has succeeded.
    Topics without rows in a batch have no row.
    """

    def __init__(self, spark: SparkSession):
        self._spark, self._changed = spark, threading.Condition()
        self._counts: dict[tuple[str, int, str], int] = {}
        self._ended: set[str] = set()
        spark.streams.addListener(self)

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        row = progress.observedMetrics.get(_NAME)
        if row is None or not progress.numInputRows:
            return
        with self._changed:
            for name, n in row.asDict().items():
                if n:
                    key = (str(progress.id), progress.batchId, name.removeprefix("topic "))
                    self._counts[key] = n

    def onQueryTerminated(self, event) -> None:
        with self._changed:
            self._ended.add(str(event.runId))
            self._changed.notify_all()

    def wait(self, run_id: str, seconds: float = 30.0) -> bool:
        """Whether all reports of the run of a query have come."""
        until = time.monotonic() + seconds
        with self._changed:
            return self._changed.wait_for(
                lambda: str(run_id) in self._ended, max(0.0, until - time.monotonic())
            )

    def rows(self) -> list[tuple[str, int, str, int]]:
        with self._changed:
            return sorted((*key, n) for key, n in self._counts.items())

    def frame(self) -> DataFrame:
        """The counts so far as `query, batch, topic, n`."""
        return self._spark.createDataFrame(self.rows(), COUNTS_SCHEMA)

    def close(self) -> None:
        self._spark.streams.removeListener(self)
