"""Every registered query, by name."""

import contextlib
from collections.abc import Callable
from datetime import datetime, timezone
from functools import reduce

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import fleetgrid as fg
from fleetgrid import schemas
from fleetgrid.functions.payloads import CUSTOMER_TOPIC, DRIVER_TOPIC, TRIP_TOPIC, project_payload
from fleetgrid.plans import batch
from fleetgrid.sinks.files import write_csv
from fleetgrid.sources.landing import read_csv
from fleetgrid.sources.records import record_files
from fleetgrid.store import Store
from fleetgrid.streaming.ingest import SNAPSHOTS
from workload import inputs
from workload.messages import TOPIC_TABLES, WAVES, messages
from workload.scratch import file_state, scratch_dir

Query = Callable[[SparkSession, str], DataFrame]

LOAD_TIME = datetime(2024, 1, 3, tzinfo=timezone.utc)

CONGESTION_SCHEMA = (
    "geohash string, date date, hour_interval string, min_interval string, "
    "average_speed double, geohash_avg_speed double, congestion_status string"
)
RATIO_SCHEMA = (
    "geohash string, date date, hour_interval string, min_interval string, "
    "cust_demand_count bigint, cab_supply_count bigint, demand_supply_ratio double"
)


def rounded(df: DataFrame) -> DataFrame:
    """Doubles to six digits: the order of a floating sum shows in the last ones."""
    doubles = [name for name, kind in df.dtypes if kind == "double"]
    return df.withColumns({name: F.round(name, 6) for name in doubles})


def _on_trips(product: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: rounded(product(inputs.trips(spark, sf_dir)))


def _ratio(keep_supply_keys: bool) -> Query:
    return lambda spark, sf_dir: rounded(
        fg.demand_supply_ratio(
            inputs.demand(spark, sf_dir), inputs.supply(spark, sf_dir), keep_supply_keys
        )
    )


def _payload(topic: str) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        records = messages(spark, sf_dir).where(F.col("topic") == topic)
        return project_payload(records, topic)

    return query


def _per_table(part: Callable[[str, str], DataFrame]) -> DataFrame:
    """The result of `part(topic, table)` for every topic, with a `history` column."""
    parts = [
        part(topic, table).withColumn("history", F.lit(table))
        for topic, table in TOPIC_TABLES.items()
    ]
    return reduce(DataFrame.unionByName, parts)


def history(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = messages(spark, sf_dir)
    return _per_table(lambda topic, table: fg.history_rows(records, topic, LOAD_TIME))


def latest_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last load of every topic, with one load a day."""
    records = messages(spark, sf_dir)
    loaded = F.lit(LOAD_TIME) + F.make_interval(days=F.col("wave"))
    return _per_table(
        lambda topic, table: fg.latest_batch(fg.history_rows(records, topic, loaded))
    )


def csv_landing_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = scratch_dir(spark, "ratio")
    landing = f"{root}/landing"
    write_csv(inputs.demand(spark, sf_dir), f"{landing}/day1/{batch.DEMAND_MARKER}")
    write_csv(inputs.supply(spark, sf_dir), f"{landing}/day1/{batch.SUPPLY_MARKER}")
    fg.run_ratio(spark, landing, landing, f"{root}/out")
    return rounded(read_csv(spark, f"{root}/out", RATIO_SCHEMA))


def csv_landing_congestion(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = scratch_dir(spark, "congestion")
    write_csv(inputs.trips(spark, sf_dir), f"{root}/landing/{batch.TRIPS_MARKER}")
    fg.run_congestion(spark, f"{root}/landing", f"{root}/out")
    return rounded(read_csv(spark, f"{root}/out", CONGESTION_SCHEMA))


def csv_landing_mixed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both sides and a stranger in one folder, below a folder that is named like a side."""
    root = scratch_dir(spark, "mixed")
    landing = f"{root}/old {batch.SUPPLY_MARKER} and {batch.DEMAND_MARKER}/in"
    write_csv(inputs.demand(spark, sf_dir), f"{landing}/a/{batch.DEMAND_MARKER}")
    write_csv(inputs.supply(spark, sf_dir), f"{landing}/{batch.SUPPLY_MARKER}")
    write_csv(inputs.supply(spark, sf_dir), f"{landing}/a/other.csv")
    fg.run_ratio(spark, f"{landing}/./", f"{landing}/a/..", f"{root}/out")
    return rounded(read_csv(spark, f"{root}/out", RATIO_SCHEMA))


def csv_single_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = scratch_dir(spark, "single")
    write_csv(inputs.demand(spark, sf_dir), f"{root}/in/{batch.DEMAND_MARKER}")
    write_csv(inputs.supply(spark, sf_dir), f"{root}/in/{batch.SUPPLY_MARKER}", single_file=True)
    fg.run_ratio(spark, f"{root}/in", f"{root}/in", f"{root}/out", single_file=True)
    out = read_csv(spark, f"{root}/out", RATIO_SCHEMA)
    return rounded(out).withColumn("files", F.lit(len(out.inputFiles())))


def table_congestion(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two runs that append to one table."""
    root = scratch_dir(spark, "table")
    table = f"congestion_{root[-12:]}"
    write_csv(inputs.trips(spark, sf_dir), f"{root}/in/{batch.TRIPS_MARKER}")
    spark.sql(f"CREATE TABLE {table} ({CONGESTION_SCHEMA}) USING orc LOCATION '{root}/table'")
    for _ in range(2):
        fg.run_congestion(spark, f"{root}/in", "unused", table=table)
    spark.sql(f"DROP TABLE {table}")
    return rounded(spark.read.schema(CONGESTION_SCHEMA).orc(f"{root}/table"))


def table_congestion_retried(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two runs by key to one table, and the first of them again."""
    root = scratch_dir(spark, "runs")
    table = f"congestion_runs_{root[-12:]}"
    write_csv(inputs.trips(spark, sf_dir), f"{root}/in/{batch.TRIPS_MARKER}")
    spark.sql(
        f"CREATE TABLE {table} ({CONGESTION_SCHEMA}, run_key string) USING orc "
        f"PARTITIONED BY (run_key) LOCATION '{root}/table'"
    )
    for key in ("first", "second", "first"):
        fg.run_congestion(spark, f"{root}/in", "unused", table=table, run_key=key)
    spark.sql(f"DROP TABLE {table}")
    schema = f"{CONGESTION_SCHEMA}, run_key string"
    return rounded(spark.read.schema(schema).orc(f"{root}/table"))


def csv_landing_new_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A second run over a landing folder uses the files that came after the first one."""
    root = scratch_dir(spark, "new-files")
    landing, runs = f"{root}/landing", []
    for part in range(2):
        of_part = F.col("event_id") % 2 == part
        demand = inputs.demand(spark, sf_dir, keep=("event_id",)).where(of_part).drop("event_id")
        supply = inputs.supply(spark, sf_dir, keep=("event_id",)).where(of_part).drop("event_id")
        write_csv(demand, f"{landing}/{part}/{batch.DEMAND_MARKER}")
        write_csv(supply, f"{landing}/{part}/{batch.SUPPLY_MARKER}")
        runs.append(fg.run_ratio(spark, landing, landing, f"{root}/out", seen=f"{root}/seen"))
    again = fg.run_ratio(spark, landing, landing, f"{root}/out", seen=f"{root}/seen")
    counts = [F.lit(x["demand"] if x else 0).cast("long") for x in (*runs, again)]
    out = rounded(fg.read_csv(spark, f"{root}/out", RATIO_SCHEMA))
    names = ("first_run", "second_run", "third_run")
    return out.select("*", *[x.alias(name) for x, name in zip(counts, names, strict=True)])


def csv_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A product that was replaced, then one whose run failed: the replaced one is shown."""
    root = scratch_dir(spark, "versions")
    demand, supply = inputs.demand(spark, sf_dir), inputs.supply(spark, sf_dir)
    batch.write_ratio(supply.toDF(*demand.columns), supply, f"{root}/out")
    batch.write_ratio(demand, supply, f"{root}/out")
    broken = demand.withColumn("cust_datetime", F.raise_error(F.lit("cut short")))
    with contextlib.suppress(PySparkException):
        batch.write_ratio(broken, supply, f"{root}/out")
    return rounded(fg.read_csv(spark, f"{root}/out", RATIO_SCHEMA))


def run_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The row counts that both runs report."""
    root = scratch_dir(spark, "counts")
    write_csv(inputs.demand(spark, sf_dir), f"{root}/in/{batch.DEMAND_MARKER}")
    write_csv(inputs.supply(spark, sf_dir), f"{root}/in/{batch.SUPPLY_MARKER}")
    write_csv(inputs.trips(spark, sf_dir), f"{root}/in/{batch.TRIPS_MARKER}")
    ratio = fg.run_ratio(spark, f"{root}/in", f"{root}/in", f"{root}/ratio")
    congestion = fg.run_congestion(spark, f"{root}/in", f"{root}/congestion")
    counts = [("ratio", *x) for x in ratio.items()]
    counts += [("congestion", *x) for x in congestion.items()]
    return spark.createDataFrame(counts, "run string, counted string, n bigint")


def run_stream(spark: SparkSession, sf_dir: str) -> str:
    """Feed the messages to `ingest`, one wave and one restart at a time.

    Returns the folder that holds `history`, `snapshots` and `products`.
    """
    root = scratch_dir(spark, "stream")
    counts = fg.LoadCounts(spark)
    for wave in range(WAVES):
        arriving = messages(spark, sf_dir).where(F.col("wave") == wave).drop("wave")
        arriving.write.mode("append").option("compression", "zstd").parquet(f"{root}/inbox")
        stream = spark.readStream.schema(schemas.STREAM_RECORD).parquet(f"{root}/inbox")
        query = fg.ingest(
            stream,
            TOPIC_TABLES,
            f"{root}/history",
            f"{root}/snapshots",
            f"{root}/checkpoint",
            trigger={"availableNow": True},
            products_root=f"{root}/products",
        )
        query.awaitTermination()
        counts.wait(query.runId)
    counts.frame().write.parquet(f"{root}/counts")
    counts.close()
    return root


def stream_interval(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The history of all events, from a stream that runs by the clock, takes a few files at a
    time and has its tables in a text."""
    root = scratch_dir(spark, "interval")
    arriving = messages(spark, sf_dir).where(F.col("topic") != TRIP_TOPIC).drop("wave")
    arriving.write.option("compression", "zstd").parquet(f"{root}/inbox")
    query = fg.ingest(
        record_files(spark, f"{root}/inbox", max_files=4),
        "#".join(f"{topic}|{table}" for topic, table in TOPIC_TABLES.items()),
        f"{root}/history",
        f"{root}/snapshots",
        f"{root}/checkpoint",
        trigger={"processingTime": "1 second"},
    )
    try:
        query.processAllAvailable()
    finally:
        query.stop()
    tables = [table for topic, table in TOPIC_TABLES.items() if topic != TRIP_TOPIC]
    parts = [
        fg.read_history(spark, f"{root}/history", table).withColumn("history", F.lit(table))
        for table in tables
    ]
    return reduce(DataFrame.unionByName, parts).drop("loadtime")


_streamed: dict[tuple, str] = {}


def _after_stream(result: Query) -> Query:
    """A query on the folder of a finished stream, which queries of a session share as
    long as the tables stay as they are."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        tables = file_state(spark, f"{sf_dir}/lineitem.parquet", f"{sf_dir}/events.parquet")
        key = (spark.sparkContext.applicationId, tables)
        if key not in _streamed:
            _streamed[key] = run_stream(spark, sf_dir)
        return result(spark, _streamed[key])

    return query


def _stream_history(spark: SparkSession, root: str) -> DataFrame:
    parts = _per_table(lambda topic, table: fg.read_history(spark, f"{root}/history", table))
    return parts.drop("loadtime")


def _stream_compacted(spark: SparkSession, root: str) -> DataFrame:
    """The history of all topics, after its days were compacted; old files still lie there."""
    history = f"{root}/history"
    for table in TOPIC_TABLES.values():
        store = Store(spark, history)
        for day in store.folders(f"{history}/history={table}"):
            if day.startswith("load_date="):
                fg.compact_history(spark, history, table, day.removeprefix("load_date="))
    return _stream_history(spark, root)


def _stream_counts(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.parquet(f"{root}/counts").drop("query")


def _stream_snapshot(topic: str, schema) -> Query:
    return lambda spark, root: read_csv(spark, f"{root}/snapshots/{SNAPSHOTS[topic]}", schema)


def _stream_product(name: str, schema: str) -> Query:
    return lambda spark, root: rounded(read_csv(spark, f"{root}/products/{name}", schema))


BATCH_QUERIES: dict[str, Query] = {
    "traffic_congestion": _on_trips(fg.traffic_congestion),
    "cell_avg_speed": _on_trips(fg.cell_avg_speed),
    "global_avg_speed": _on_trips(fg.global_avg_speed),
    "trip_speeds": _on_trips(fg.trip_speeds),
    "trip_endpoints": _on_trips(fg.trip_endpoints),
    "trip_speeds_lenient": lambda spark, d: rounded(fg.trip_speeds(inputs.lenient_trips(spark, d))),
    "odd_text_slots": lambda spark, d: fg.cell_demand_counts(inputs.odd_demand(spark, d)),
    "cell_demand_counts": lambda spark, d: fg.cell_demand_counts(inputs.demand(spark, d)),
    "cell_supply_counts": lambda spark, d: fg.cell_supply_counts(inputs.supply(spark, d)),
    "demand_supply_ratio": _ratio(keep_supply_keys=False),
    "demand_supply_ratio_keyed": _ratio(keep_supply_keys=True),
    "history_rows": history,
    "latest_snapshot": latest_snapshot,
    "payload_trips": _payload(TRIP_TOPIC),
    "payload_customers": _payload(CUSTOMER_TOPIC),
    "payload_drivers": _payload(DRIVER_TOPIC),
}

FILE_QUERIES: dict[str, Query] = {
    "csv_landing_congestion": csv_landing_congestion,
    "csv_landing_ratio": csv_landing_ratio,
    "csv_landing_mixed": csv_landing_mixed,
    "csv_single_file": csv_single_file,
    "csv_landing_new_files": csv_landing_new_files,
    "csv_versions": csv_versions,
    "table_congestion": table_congestion,
    "table_congestion_retried": table_congestion_retried,
    "run_counts": run_counts,
}

STREAM_QUERIES: dict[str, Query] = {
    "stream_interval": stream_interval,
    "stream_history": _after_stream(_stream_history),
    "stream_history_compacted": _after_stream(_stream_compacted),
    "stream_counts": _after_stream(_stream_counts),
    "stream_snapshot_trips": _after_stream(_stream_snapshot(TRIP_TOPIC, schemas.TRIPS)),
    "stream_snapshot_customers": _after_stream(_stream_snapshot(CUSTOMER_TOPIC, schemas.DEMAND)),
    "stream_snapshot_drivers": _after_stream(_stream_snapshot(DRIVER_TOPIC, schemas.SUPPLY)),
    "stream_congestion": _after_stream(
        _stream_product(batch.CONGESTION_OUTPUT, CONGESTION_SCHEMA)
    ),
    "stream_ratio": _after_stream(_stream_product(batch.RATIO_OUTPUT, RATIO_SCHEMA)),
}

QUERIES = BATCH_QUERIES | FILE_QUERIES | STREAM_QUERIES
