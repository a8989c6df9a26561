"""The stream: raw history per topic, and the latest batch of each known topic."""

import re
from collections.abc import Callable, Iterable, Mapping
from concurrent.futures import ThreadPoolExecutor
from datetime import datetime

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.util import inheritable_thread_target

from fleetgrid.functions.payloads import (
    CUSTOMER_TOPIC,
    DRIVER_TOPIC,
    TRIP_TOPIC,
    project_payload,
)
from fleetgrid.plans.batch import (
    CONGESTION_OUTPUT,
    DEMAND_SNAPSHOT,
    RATIO_OUTPUT,
    SUPPLY_SNAPSHOT,
    TRIPS_SNAPSHOT,
    write_congestion,
    write_ratio,
)
from fleetgrid.sinks.files import publish_csv
from fleetgrid.store import Store
from fleetgrid.streaming.counts import observe_loads
from fleetgrid.streaming.history import last_load, place_batch, publish_batch

SNAPSHOTS = {
    TRIP_TOPIC: TRIPS_SNAPSHOT,
    CUSTOMER_TOPIC: DEMAND_SNAPSHOT,
    DRIVER_TOPIC: SUPPLY_SNAPSHOT,
}


def parse_topic_tables(mapping: str) -> dict[str, str]:
    """`topic1|table1#topic2|table2` as a dict."""
    entries = [entry.split("|") for entry in mapping.split("#")]
    if any(len(entry) != 2 for entry in entries):
        raise ValueError(f"need topic|table entries, got {mapping!r}")
    if len(tables := dict(entries)) < len(entries):
        raise ValueError(f"a topic occurs twice: {mapping!r}")
    return tables


def history_rows(records: DataFrame, topic: str, loadtime: datetime | Column) -> DataFrame:
    """A topic's records as history keeps them: payload, offset text, load time."""
    return records.where(F.col("topic") == topic).select(*_history_columns(loadtime))


def _history_columns(loadtime: datetime | Column) -> list[Column]:
    if not isinstance(loadtime, Column):
        loadtime = F.lit(loadtime)
    return [
        F.col("payload"),
        F.col("offset").cast("string").alias("offset"),
        loadtime.cast("timestamp").alias("loadtime"),
    ]


def latest_batch(history: DataFrame) -> DataFrame:
    """The rows of a history table that came with its last load.

    Reads the whole table for the time of that load; `last_load` reads only its last day.
    """
    last = history.agg(F.max("loadtime"))
    return history.where(F.col("loadtime") == last.scalar())


def ingest(
    stream: DataFrame,
    topic_tables: Mapping[str, str] | str,
    history_root: str,
    snapshot_root: str,
    checkpoint: str,
    trigger: Mapping[str, object] | None = None,
    products_root: str | None = None,
    single_file: bool = False,
    *,
    ignore_topics: Iterable[str] = (),
    catalog_tables: Mapping[str, str] | None = None,
    concurrency: int = 6,
) -> StreamingQuery:
    """Archive a stream of (payload, offset, topic) records and keep snapshots.

    Every batch is written once, to one ORC directory per table, day, query and batch, so
    a batch that is retried replaces its own rows and no others: its load time comes from
    the checkpoint and does not change. Topics that had rows and have a known payload
    then publish a new version of their CSV snapshot. With `products_root` the products of
    those topics are refreshed in the same batch, from the history rows themselves.

    Up to `concurrency` snapshots and products are written at a time, each topic in a
    scheduler pool of its own name (which shares the cores fairly where the session's
    `spark.scheduler.mode` is FAIR). The batch ends with the last of them, and fails if any
    has failed. A topic's payloads are parsed once, for its snapshot and its products.

    The rows of each topic and batch are counted as they pass; see `LoadCounts`.

    `topic_tables` is a mapping or a text for `parse_topic_tables`. A record of a topic
    that is neither in it nor in `ignore_topics` fails the batch before anything is
    written. `catalog_tables` names a catalog table for each topic that SQL users read;
    it is created over the topic's history files, and each batch adds its partition.
    `trigger` takes the arguments of `DataStreamWriter.trigger`.

    A line break inside a value ends its row early in the CSV snapshot, as in any CSV
    that is read in parallel; history and products keep the value whole.
    """
    if isinstance(topic_tables, str):
        topic_tables = parse_topic_tables(topic_tables)
    _check_tables(topic_tables.values())
    catalog_tables = dict(catalog_tables or {})
    _check_topics(topic_tables, ignored := list(ignore_topics), catalog_tables)

    def load(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        # Batch numbers start over with a new checkpoint; the query id does not repeat.
        query_id = spark.sparkContext.getLocalProperty("sql.streaming.queryId")
        if not query_id:
            raise RuntimeError("the stream has no query id to name its batches by")
        name = f"{query_id}-{batch_id}"
        present, day = _archive(batch, name, topic_tables, ignored, history_root)
        for topic in present:
            if topic in catalog_tables:
                table = topic_tables[topic]
                publish_batch(spark, catalog_tables[topic], history_root, table, day, name)
        fresh = {}
        for topic in present:
            if topic in SNAPSHOTS:
                part = f"{history_root}/history={topic_tables[topic]}/load_date={day}/batch={name}"
                fresh[topic] = project_payload(spark.read.orc(part), topic)
        if products_root:  # else each is read once
            for rows in fresh.values():
                rows.persist(StorageLevel.DISK_ONLY)
        try:
            _side_by_side(
                spark, concurrency, [(t, _snapshot(rows, t)) for t, rows in fresh.items()]
            )
            if products_root:
                _side_by_side(spark, concurrency, _products(spark, fresh))
        finally:
            for rows in fresh.values():
                rows.unpersist()

    def _snapshot(rows: DataFrame, topic: str) -> Callable[[], object]:
        return lambda: publish_csv(rows, f"{snapshot_root}/{SNAPSHOTS[topic]}", single_file)

    def _products(
        spark: SparkSession, fresh: Mapping[str, DataFrame]
    ) -> list[tuple[str, Callable[[], object]]]:
        """The products of the topics in `fresh`. The other side of a ratio is what its
        topic loaded last; without any, there is no ratio yet."""

        def rows(topic: str) -> DataFrame | None:
            if topic in fresh:
                return _as_csv_reads(fresh[topic])
            table = topic_tables.get(topic)
            last = last_load(spark, history_root, table) if table else None
            return None if last is None else _as_csv_reads(project_payload(last, topic))

        def congestion() -> None:
            out = f"{products_root}/{CONGESTION_OUTPUT}"
            write_congestion(rows(TRIP_TOPIC), out, single_file)

        def ratio() -> None:
            demand, supply = rows(CUSTOMER_TOPIC), rows(DRIVER_TOPIC)
            if demand is not None and supply is not None:
                out = f"{products_root}/{RATIO_OUTPUT}"
                write_ratio(demand, supply, out, single_file=single_file)

        work = [(TRIP_TOPIC, congestion)] if TRIP_TOPIC in fresh else []
        if CUSTOMER_TOPIC in fresh or DRIVER_TOPIC in fresh:
            work.append((CUSTOMER_TOPIC, ratio))
        return work

    counted = observe_loads(stream, topic_tables)
    records = counted.withColumn("loadtime", F.current_timestamp())
    writer = records.writeStream.foreachBatch(load).option("checkpointLocation", checkpoint)
    return writer.trigger(**(trigger or {"processingTime": "60 seconds"})).start()


def _side_by_side(
    spark: SparkSession, concurrency: int, work: list[tuple[str, Callable[[], object]]]
) -> None:
    """Does all of `work`, each in the scheduler pool it names; raises the first error, but
    only when all have ended."""

    def one(pool: str, task: Callable[[], object]) -> None:
        spark.sparkContext.setLocalProperty("spark.scheduler.pool", pool)
        task()

    with ThreadPoolExecutor(max_workers=max(1, concurrency)) as threads:
        started = [threads.submit(inheritable_thread_target(spark)(one), *x) for x in work]
    for each in started:
        each.result()


def _as_csv_reads(rows: DataFrame) -> DataFrame:
    """Empty text as null: products mean the same rows, from history or from snapshots."""
    return rows.select(*[F.nullif(F.col(c), F.lit("")).alias(c) for c in rows.columns])


def _archive(
    batch: DataFrame,
    name: str,
    topic_tables: Mapping[str, str],
    ignored: list[str],
    history_root: str,
) -> tuple[list[str], str | None]:
    """Write a batch to the history of each topic; return the topics that had rows, and
    the day of the load.

    One pass without a shuffle or a sort: each task writes a file for each table that it has
    rows of, in a folder that readers do not see. From there a table's files are moved to
    their place; small ones, that is all a small table has, are written again as few.
    """
    spark = batch.sparkSession
    topic = F.col("topic")
    unknown = F.concat(F.lit("no history table for topic "), F.coalesce(topic, F.lit("null")))
    table = F.raise_error(unknown)
    for known, topic_table in topic_tables.items():
        table = F.when(topic == known, topic_table).otherwise(table)
    seen = Observation()
    rows = [F.count_if(topic == known).alias(f"topic_{i}") for i, known in enumerate(topic_tables)]
    incoming = f"{history_root}/_incoming/{name}"
    # A file for each table is open at once, else rows are sorted by table, on disk if they are
    # many. This is the stream's own session.
    spark.conf.set("spark.sql.maxConcurrentOutputFileWriters", len(topic_tables))
    (
        batch.where(~F.coalesce(topic.isin(ignored), F.lit(False)))
        .observe(seen, *rows, F.max(F.to_date("loadtime").cast("string")).alias("day"))
        .select(*_history_columns(F.col("loadtime")), table.alias("history"))
        .write.mode("overwrite")
        .partitionBy("history")
        .orc(incoming)
    )
    counts = seen.get
    present = [known for i, known in enumerate(topic_tables) if counts[f"topic_{i}"]]
    store = Store(spark, history_root)
    for known in present:
        written = f"history={topic_tables[known]}"
        place = f"{history_root}/{written}/load_date={counts['day']}/batch={name}"
        place_batch(spark, store, f"{incoming}/{written}", place)
    store.delete(incoming)
    return present, counts["day"]


def _check_tables(tables: Iterable[str]) -> None:
    """Table names become directories, one per topic."""
    names = list(tables)
    if not names or not all(re.fullmatch(r"\w+", name) for name in names):
        raise ValueError(f"need plain table names, got {names}")
    if len(set(names)) < len(names):
        raise ValueError(f"topics share a table: {names}")


def _check_topics(
    topic_tables: Mapping[str, str], ignored: list[str], catalog_tables: Mapping[str, str]
) -> None:
    if both := set(topic_tables) & set(ignored):
        raise ValueError(f"topics with a table cannot be ignored: {sorted(both)}")
    if missing := set(catalog_tables) - set(topic_tables):
        raise ValueError(f"topics of catalog tables have no history: {sorted(missing)}")
    if not all(name.strip() for name in catalog_tables.values()):
        raise ValueError("a catalog table has a blank name")
