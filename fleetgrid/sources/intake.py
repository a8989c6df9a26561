"""Landing files that no run has used yet, by the log of seen files of Spark's file stream.

    <log>/<n>/checkpoint         the stream's own log of the files it has seen
    <log>/<n>/rows/batch=<id>    rows of new files, until a run has used them
    <log>/<n>/ready/<id>         the rows of that batch are complete
    <log>/<n>/used/<id>          a run has published what it made of them

File names stay in Spark's log. A full rerun starts the next number <n>, and so forgets what
was seen.
"""

from __future__ import annotations

import contextlib
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from fleetgrid.sources.landing import marked_rows
from fleetgrid.store import Store

# The source would pass over files that are older than this against the newest one.
_ANY_AGE = "36500d"


@dataclass
class Intake:
    """Rows that are waiting to be used; `rows` is None without any."""

    rows: DataFrame | None
    _store: Store
    _root: str
    _batches: list[str]

    def used(self) -> None:
        """What was made of the rows is published: no run will get them again."""
        for name in self._batches:
            with contextlib.suppress(Exception):  # used before, and the rest was cut short
                self._store.create(f"{self._root}/used/{name}")
            self._store.delete(f"{self._root}/rows/batch={name}")


def take_new(
    spark: SparkSession,
    root: str,
    marker: str,
    schema: StructType,
    log: str,
    rerun: bool = False,
) -> Intake:
    """Reads the files below `root` that came since the last call with this `log` and whose
    path there contains `marker`, and gives their rows with those that no run has used yet.

    Files are read once. Rows stay below `log` until `used` is called, so that a run that
    was cut short, or has to wait for its other side, finds them again. With `rerun`, all
    files count as new. One call at a time works with a log.
    """
    store = Store(spark, log)
    numbers = [int(x) for x in store.folders(log) if x.isdigit()]
    number = max(numbers, default=1) + (1 if rerun and numbers else 0)
    own = f"{log.rstrip('/')}/{number:06}"

    def keep(batch: DataFrame, batch_id: int) -> None:
        ready = f"{own}/ready/{batch_id}"
        if not store.exists(ready):
            batch.write.mode("overwrite").parquet(f"{own}/rows/batch={batch_id}")
            store.create(ready)

    files = spark.readStream.schema(schema).option("header", True)
    files = files.option("recursiveFileLookup", True).option("maxFileAge", _ANY_AGE).csv(root)
    stream = marked_rows(spark, files, root, marker).writeStream.foreachBatch(keep)
    stream = stream.option("checkpointLocation", f"{own}/checkpoint")
    stream.trigger(availableNow=True).start().awaitTermination()

    used = store.names(f"{own}/used")
    waiting = [x for x in store.names(f"{own}/ready") if x not in used]
    rows = None
    if waiting:
        found = spark.read.schema(schema).parquet(*[f"{own}/rows/batch={x}" for x in waiting])
        rows = None if found.isEmpty() else found
    return Intake(rows, store, own, waiting)
