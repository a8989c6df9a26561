import glob
import json
import os
import shutil
import threading
import time

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrameWriter

import fleetgrid as fg
from fleetgrid import schemas
from fleetgrid.functions.payloads import CUSTOMER_TOPIC, DRIVER_TOPIC, TOPIC_FIELDS, TRIP_TOPIC
from fleetgrid.plans import batch
from fleetgrid.sources.landing import read_csv, read_snapshot
from fleetgrid.sources.records import record_files
from fleetgrid.store import Store
from fleetgrid.streaming import history as history_module
from fleetgrid.streaming import ingest as ingest_module
from fleetgrid.streaming.ingest import parse_topic_tables
from tests import golden
from tests.golden import ordered, rows
from workload.catalog import CONGESTION_SCHEMA, RATIO_SCHEMA

TABLES = {TRIP_TOPIC: "trips_h", CUSTOMER_TOPIC: "cust_h", DRIVER_TOPIC: "cab_h", "other": "other_h"}


def message(topic, record, offset):
    fields = TOPIC_FIELDS[topic].values()
    present = {f: v for f, v in zip(fields, record) if v is not None}
    return (json.dumps(present), offset, topic)


class Stream:
    def __init__(self, spark, root):
        self.spark, self.root = spark, str(root)
        self.offset = 0

    def send(self, topic, records):
        """Messages of one wave; `load` takes all waves sent since the last load."""
        sent = []
        for record in records:
            sent.append(message(topic, record, self.offset))
            self.offset += 1
        self.send_raw(sent)
        return [(payload, str(offset)) for payload, offset, _ in sent]

    def send_raw(self, records):
        df = self.spark.createDataFrame(records, schemas.STREAM_RECORD)
        df.coalesce(1).write.mode("append").parquet(f"{self.root}/inbox")

    def load(self, checkpoint="checkpoint", **options):
        source = self.spark.readStream.schema(schemas.STREAM_RECORD).parquet(f"{self.root}/inbox")
        query = fg.ingest(
            source,
            TABLES,
            f"{self.root}/history",
            f"{self.root}/snapshots",
            f"{self.root}/{checkpoint}",
            trigger={"availableNow": True},
            ignore_topics=["known"],
            **options,
        )
        query.awaitTermination()
        return query

    def history(self, table):
        return fg.read_history(self.spark, f"{self.root}/history", table)

    def snapshot(self, name, schema):
        return read_snapshot(self.spark, f"{self.root}/snapshots/{name}", schema)


@pytest.fixture()
def stream(spark, tmp_path):
    return Stream(spark, tmp_path)


def test_history_and_snapshots_over_restarts(spark, stream):
    first = stream.send(CUSTOMER_TOPIC, golden.DEMAND[:3])
    cabs = stream.send(DRIVER_TOPIC, golden.SUPPLY)
    stream.send_raw([("raw", 100, "other"), ("left out", 101, "known"), (None, 102, "other")])
    stream.load()
    assert rows(stream.snapshot("DemandData", schemas.DEMAND)) == ordered(golden.DEMAND[:3])
    assert stream.snapshot("TrafficEstimator", schemas.TRIPS) is None

    # The second batch has no driver rows: that snapshot stays.
    second = stream.send(CUSTOMER_TOPIC, golden.DEMAND[3:])
    stream.send(TRIP_TOPIC, golden.TRIPS)
    stream.load()
    stream.load()  # nothing new

    assert rows(stream.history("cust_h").drop("loadtime")) == ordered(first + second)
    assert rows(stream.history("cab_h").drop("loadtime")) == ordered(cabs)
    assert rows(stream.history("other_h").drop("loadtime")) == ordered(
        [("raw", "100"), (None, "102")]
    )
    assert stream.history("cust_h").select("loadtime").distinct().count() == 2
    assert dict(stream.history("cust_h").dtypes) == {
        "payload": "string",
        "offset": "string",
        "loadtime": "timestamp",
    }
    assert rows(stream.snapshot("DemandData", schemas.DEMAND)) == ordered(golden.DEMAND[3:])
    null_for_empty = [tuple(v or None for v in row) for row in golden.SUPPLY]
    assert rows(stream.snapshot("SupplyData", schemas.SUPPLY)) == ordered(null_for_empty)
    assert rows(stream.snapshot("TrafficEstimator", schemas.TRIPS)) == ordered(golden.TRIPS)
    latest = fg.latest_batch(stream.history("cust_h")).drop("loadtime")
    assert rows(latest) == ordered(second)


def test_products_follow_the_snapshots(spark, stream):
    products = f"{stream.root}/products"
    stream.send(CUSTOMER_TOPIC, golden.DEMAND)
    stream.load(products_root=products)
    assert read_snapshot(spark, f"{products}/{batch.RATIO_OUTPUT}", RATIO_SCHEMA) is None
    stream.send(DRIVER_TOPIC, golden.SUPPLY)
    stream.send(TRIP_TOPIC, golden.TRIPS)
    stream.load(products_root=products)
    ratio = read_csv(spark, f"{products}/{batch.RATIO_OUTPUT}", RATIO_SCHEMA)
    assert rows(ratio) == ordered(golden.RATIO)
    congestion = read_csv(spark, f"{products}/{batch.CONGESTION_OUTPUT}", CONGESTION_SCHEMA)
    assert rows(congestion) == ordered(golden.CONGESTION)


def test_retried_batch_replaces_its_rows(spark, stream):
    sent = stream.send(CUSTOMER_TOPIC, golden.DEMAND)
    bad_root = f"{stream.root}/blocked"
    with open(bad_root, "w") as out:
        out.write("a file where the product directory should be")
    stream.send(DRIVER_TOPIC, golden.SUPPLY)
    with pytest.raises(Exception):
        stream.load(products_root=bad_root)
    # History was written before the failure; the restart runs the same batch again.
    stream.load()
    assert rows(stream.history("cust_h").drop("loadtime")) == ordered(sent)


def test_topics_without_a_table_fail_the_batch(spark, stream):
    stream.send(CUSTOMER_TOPIC, golden.DEMAND)
    stream.send_raw([("lost", 101, "unknown")])
    with pytest.raises(StreamingQueryException, match="no history table for topic unknown"):
        stream.load()
    assert not [x for x in glob.glob(f"{stream.root}/history/history=*")]
    with pytest.raises(StreamingQueryException, match="unknown"):  # nothing was passed over
        stream.load()


def test_only_products_that_moved_are_written(spark, stream):
    products = f"{stream.root}/products"
    stream.send(TRIP_TOPIC, golden.TRIPS)
    stream.send(DRIVER_TOPIC, golden.SUPPLY)
    stream.load(products_root=products)
    before = sorted(glob.glob(f"{products}/{batch.CONGESTION_OUTPUT}/*"))
    assert before and not glob.glob(f"{products}/{batch.RATIO_OUTPUT}/*")
    broken = ("a\nb", *golden.DEMAND[0][1:])  # one customer, two lines of CSV
    stream.send(CUSTOMER_TOPIC, [broken, *golden.DEMAND[1:]])
    stream.load(products_root=products)
    assert sorted(glob.glob(f"{products}/{batch.CONGESTION_OUTPUT}/*")) == before
    ratio = read_csv(spark, f"{products}/{batch.RATIO_OUTPUT}", RATIO_SCHEMA)
    assert rows(ratio) == ordered(golden.RATIO)


def test_last_load_reads_its_day_only(spark, stream):
    stream.send(CUSTOMER_TOPIC, golden.DEMAND[:2])
    stream.load()
    old = glob.glob(f"{stream.root}/history/history=cust_h/load_date=*")[0]
    os.rename(old, f"{os.path.dirname(old)}/load_date=2020-01-01")
    second = stream.send(CUSTOMER_TOPIC, golden.DEMAND[2:])
    stream.load()
    last = fg.last_load(spark, f"{stream.root}/history", "cust_h")
    assert rows(last.drop("loadtime")) == ordered(second)
    plan = last._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(load_date" in plan
    assert fg.last_load(spark, f"{stream.root}/history", "never") is None


def test_compaction_keeps_every_row(spark, stream, monkeypatch):
    sent = []
    for i in range(6):
        sent += stream.send(CUSTOMER_TOPIC, [golden.DEMAND[i]])
        stream.load(catalog_tables={CUSTOMER_TOPIC: "cust_catalog"})
    root = f"{stream.root}/history"
    try:
        files = glob.glob(f"{root}/history=cust_h/*/*/*.orc")
        assert len(files) == 6  # one a batch, however many tasks
        day = os.path.basename(os.path.dirname(os.path.dirname(files[0]))).removeprefix("load_date=")
        # cut short after the new batch is written and one old one removed
        folder = f"{root}/history=cust_h/load_date={day}"
        fg.read_history(spark, root, "cust_h").coalesce(1).write.orc(f"{folder}/_compacted")
        shutil.rmtree(sorted(glob.glob(f"{folder}/batch=*"))[0])
        fg.compact_history(spark, root, "cust_h", day, "cust_catalog")
        fg.compact_history(spark, root, "cust_h", day, "cust_catalog")
        assert rows(stream.history("cust_h").drop("loadtime")) == ordered(sent)
        catalog = spark.table("cust_catalog").select("payload", "offset")
        assert rows(catalog) == ordered(sent)
        sent += stream.send(CUSTOMER_TOPIC, golden.DEMAND[:1])
        stream.load(catalog_tables={CUSTOMER_TOPIC: "cust_catalog"})
        fg.compact_history(spark, root, "cust_h", day, "cust_catalog", grace_seconds=0)
        assert len(glob.glob(f"{folder}/*/*.orc")) == 1
        assert rows(stream.history("cust_h").drop("loadtime")) == ordered(sent)
        spark.catalog.refreshTable("cust_catalog")
        assert rows(spark.table("cust_catalog").select("payload", "offset")) == ordered(sent)
    finally:
        spark.sql("DROP TABLE IF EXISTS cust_catalog")


@pytest.mark.parametrize("small_file", [None, 1])
def test_history_is_written_without_a_shuffle(spark, stream, monkeypatch, small_file):
    """Small files are merged and others moved to their place; no row is shuffled for either."""
    if small_file:
        monkeypatch.setattr(history_module, "_SMALL_FILE", small_file)
    plans, orc = [], DataFrameWriter.orc

    def seen(self, path):
        plans.append(self._df._jdf.queryExecution().executedPlan().toString())
        return orc(self, path)

    monkeypatch.setattr(DataFrameWriter, "orc", seen)
    sent, cabs = [], stream.send(DRIVER_TOPIC, golden.SUPPLY)
    for i in range(3):
        sent += stream.send(CUSTOMER_TOPIC, [golden.DEMAND[i]] * 3)
    source = spark.readStream.schema(schemas.STREAM_RECORD).parquet(f"{stream.root}/inbox")
    with_files = spark.conf.get("spark.sql.files.openCostInBytes")
    spark.conf.set("spark.sql.files.openCostInBytes", str(1 << 30))  # a task for each file
    try:
        query = fg.ingest(source, TABLES, f"{stream.root}/history", f"{stream.root}/snapshots",
                          f"{stream.root}/checkpoint", trigger={"availableNow": True})
        query.awaitTermination()
    finally:
        spark.conf.set("spark.sql.files.openCostInBytes", with_files)
    root, (folder, (day,)) = f"{stream.root}/history", history_days(stream)
    files = glob.glob(f"{folder}/*/batch=*/*.orc")
    assert len(files) == (3 if small_file else 1)
    assert rows(stream.history("cust_h").drop("loadtime")) == ordered(sent)
    assert rows(stream.history("cab_h").drop("loadtime")) == ordered(cabs)
    fg.compact_history(spark, root, "cust_h", day, grace_seconds=0)
    assert len(glob.glob(f"{folder}/*/batch=*/*.orc")) == 1
    assert rows(stream.history("cust_h").drop("loadtime")) == ordered(sent)
    assert plans and not any("Exchange" in x for x in plans)
    assert not os.listdir(f"{root}/_incoming")
    # only the stream's own session opens several files at once
    assert spark.conf.get("spark.sql.maxConcurrentOutputFileWriters") == "0"


def test_catalog_tables_over_restarts_and_retries(spark, stream):
    tables = {CUSTOMER_TOPIC: "cust_sql", "other": "other_sql"}
    try:
        sent = stream.send(CUSTOMER_TOPIC, golden.DEMAND[:3])
        stream.send(TRIP_TOPIC, golden.TRIPS)
        with open(f"{stream.root}/blocked", "w") as out:
            out.write("a file where the product directory should be")
        with pytest.raises(StreamingQueryException):
            stream.load(products_root=f"{stream.root}/blocked", catalog_tables=tables)
        assert rows(spark.table("cust_sql").select("payload", "offset")) == ordered(sent)
        stream.load(catalog_tables=tables)  # the same batch again
        spark.catalog.refreshTable("cust_sql")
        assert rows(spark.table("cust_sql").select("payload", "offset")) == ordered(sent)
        sent += stream.send(CUSTOMER_TOPIC, golden.DEMAND[3:])
        stream.load(catalog_tables=tables)
        assert rows(spark.table("cust_sql").select("payload", "offset")) == ordered(sent)
        assert spark.table("cust_sql").select("batch").distinct().count() == 2
        assert not spark.catalog.tableExists("other_sql")
    finally:
        for table in tables.values():
            spark.sql(f"DROP TABLE IF EXISTS {table}")


def test_new_checkpoint_keeps_old_history(spark, stream):
    sent = stream.send(CUSTOMER_TOPIC, golden.DEMAND[:2])
    stream.load()
    stream.load(checkpoint="another")
    assert rows(stream.history("cust_h").drop("loadtime")) == ordered(sent * 2)


@pytest.mark.parametrize("tables", [{}, {"a": ""}, {"a": "x/y"}, {"a": "t", "b": "t"}])
def test_bad_topic_tables(spark, stream, tables):
    stream.send(CUSTOMER_TOPIC, golden.DEMAND[:1])
    source = spark.readStream.schema(schemas.STREAM_RECORD).parquet(f"{stream.root}/inbox")
    with pytest.raises(ValueError):
        fg.ingest(source, tables, "h", "s", "c")


@pytest.mark.parametrize(
    "options",
    [{"ignore_topics": ["a"]}, {"catalog_tables": {"b": "t"}}, {"catalog_tables": {"a": " "}}],
)
def test_bad_topics(spark, stream, options):
    stream.send(CUSTOMER_TOPIC, golden.DEMAND[:1])
    source = spark.readStream.schema(schemas.STREAM_RECORD).parquet(f"{stream.root}/inbox")
    with pytest.raises(ValueError):
        fg.ingest(source, "a|x", "h", "s", "c", **options)


def test_parse_topic_tables():
    assert parse_topic_tables("a|t1#b|t2") == {"a": "t1", "b": "t2"}
    for text in ("", "a", "a|b|c", "a|b#a|c"):
        with pytest.raises(ValueError):
            parse_topic_tables(text)


def counted(rows):
    return sorted((batch, topic, n) for _, batch, topic, n in rows)


def test_counts_by_topic_and_batch(spark, stream):
    counts = fg.LoadCounts(spark)
    try:
        stream.send(CUSTOMER_TOPIC, golden.DEMAND)
        stream.send_raw([("raw", 100, "other"), ("left out", 101, "known"), (None, 102, None)][:2])
        stream.load()
        stream.send(DRIVER_TOPIC, golden.SUPPLY)
        stream.send(CUSTOMER_TOPIC, golden.DEMAND[:2])
        query = stream.load()
        assert counts.wait(query.runId)
        want = [(0, CUSTOMER_TOPIC, len(golden.DEMAND)), (0, "other", 1), (0, "other topics", 1),
                (1, CUSTOMER_TOPIC, 2), (1, DRIVER_TOPIC, len(golden.SUPPLY))]
        assert counted(counts.rows()) == sorted(want)
        assert counted(map(tuple, counts.frame().collect())) == sorted(want)
    finally:
        counts.close()


def test_counts_can_be_read_while_the_stream_runs(spark, stream):
    counts = fg.LoadCounts(spark)
    os.makedirs(f"{stream.root}/inbox")
    source = spark.readStream.schema(schemas.STREAM_RECORD).parquet(f"{stream.root}/inbox")
    query = fg.ingest(source, TABLES, f"{stream.root}/history", f"{stream.root}/snapshots",
                      f"{stream.root}/checkpoint", trigger={"processingTime": "1 second"})
    try:
        for i in range(2):
            stream.send(CUSTOMER_TOPIC, golden.DEMAND[: i + 1])
            until = time.monotonic() + 60
            while len(counts.rows()) <= i and time.monotonic() < until:
                time.sleep(0.2)
        assert query.isActive
        assert counted(counts.rows()) == [(0, CUSTOMER_TOPIC, 1), (1, CUSTOMER_TOPIC, 2)]
    finally:
        query.stop()
        counts.close()


def test_topics_are_written_side_by_side(spark, stream, monkeypatch):
    """Each snapshot waits for the others to have begun: one after another they would not end."""
    together, pools = threading.Barrier(3, timeout=60), []
    written = ingest_module.publish_csv

    def publish(rows, path, *args):
        together.wait()
        pools.append(spark.sparkContext.getLocalProperty("spark.scheduler.pool"))
        return written(rows, path, *args)

    monkeypatch.setattr(ingest_module, "publish_csv", publish)
    for topic, records in ((CUSTOMER_TOPIC, golden.DEMAND), (DRIVER_TOPIC, golden.SUPPLY), (TRIP_TOPIC, golden.TRIPS)):
        stream.send(topic, records)
    stream.load()
    assert sorted(pools) == sorted([CUSTOMER_TOPIC, DRIVER_TOPIC, TRIP_TOPIC])
    assert rows(stream.snapshot("TrafficEstimator", schemas.TRIPS)) == ordered(golden.TRIPS)


def test_a_failing_topic_fails_the_batch(spark, stream, monkeypatch):
    written, done = ingest_module.publish_csv, []

    def publish(rows, path, *args):
        if path.endswith("SupplyData"):
            raise OSError("no room for cabs")
        done.append(written(rows, path, *args))

    stream.send(CUSTOMER_TOPIC, golden.DEMAND)
    stream.send(DRIVER_TOPIC, golden.SUPPLY)
    with monkeypatch.context() as patch:
        patch.setattr(ingest_module, "publish_csv", publish)
        with pytest.raises(StreamingQueryException, match="no room for cabs"):
            stream.load()
    assert len(done) == 1  # the other topic's work was not cut off
    stream.load()
    null_for_empty = [tuple(v or None for v in row) for row in golden.SUPPLY]
    assert rows(stream.snapshot("SupplyData", schemas.SUPPLY)) == ordered(null_for_empty)


def test_payloads_are_parsed_once(spark, stream, monkeypatch):
    """The products of a batch read what its snapshots have parsed."""
    plans = []
    produced = batch._produce

    def produce(inputs, product, *args):
        plans.extend(x._jdf.queryExecution().executedPlan().toString() for x in inputs.values())
        return produced(inputs, product, *args)

    monkeypatch.setattr(batch, "_produce", produce)
    for topic, records in ((CUSTOMER_TOPIC, golden.DEMAND), (DRIVER_TOPIC, golden.SUPPLY), (TRIP_TOPIC, golden.TRIPS)):
        stream.send(topic, records)
    stream.load(products_root=f"{stream.root}/products")
    assert len(plans) == 3 and all("InMemoryTableScan" in x for x in plans)
    assert not spark.sparkContext._jsc.getPersistentRDDs()  # released with the batch


def history_days(stream, table="cust_h"):
    folder = f"{stream.root}/history/history={table}"
    return folder, [x.removeprefix("load_date=") for x in os.listdir(folder) if x.startswith("load_date=")]


class Cut(Exception):
    pass


@pytest.mark.parametrize("step", ["write", "create", "delete", "done"])
def test_compaction_cut_short_at_any_step(spark, stream, monkeypatch, step):
    sent = []
    for i in range(3):
        sent += stream.send(CUSTOMER_TOPIC, [golden.DEMAND[i]])
        stream.load()
    root, (folder, (day,)) = f"{stream.root}/history", history_days(stream)
    create, delete = Store.create, Store.delete
    deleted = []

    def cut_create(self, path, lines=None):
        if step == "create" or (step == "done" and path.endswith(".done")):
            raise Cut
        create(self, path, lines)

    def cut_delete(self, path):
        if step == "delete" and deleted:
            raise Cut
        deleted.append(path)
        delete(self, path)

    with monkeypatch.context() as patch:
        patch.setattr(Store, "create", cut_create)
        patch.setattr(Store, "delete", cut_delete)
        if step == "write":
            patch.setattr(DataFrameWriter, "orc", lambda self, path: os.makedirs(path) or (_ for _ in ()).throw(Cut()))
        with pytest.raises(Cut):
            fg.compact_history(spark, root, "cust_h", day, grace_seconds=0)
    assert rows(stream.history("cust_h").drop("loadtime")) == ordered(sent)
    last = fg.last_load(spark, root, "cust_h").drop("loadtime")
    assert rows(last) == ordered(sent[-1:])
    for _ in range(2):
        fg.compact_history(spark, root, "cust_h", day, grace_seconds=0)
        assert rows(stream.history("cust_h").drop("loadtime")) == ordered(sent)
    assert len(glob.glob(f"{folder}/load_date={day}/batch=*")) == 1


def test_readers_during_compaction_see_every_row_once(spark, stream):
    sent, stop, counts, errors = [], threading.Event(), [], []
    for i in range(4):
        sent += stream.send(CUSTOMER_TOPIC, golden.DEMAND[: i + 1])
        stream.load()
    root, (folder, (day,)) = f"{stream.root}/history", history_days(stream)

    def read():
        while not stop.is_set():
            try:
                counts.append(rows(fg.read_history(spark, root, "cust_h").drop("loadtime")) == ordered(sent))
            except Exception as error:
                errors.append(error)

    reader = threading.Thread(target=read)
    reader.start()
    fg.compact_history(spark, root, "cust_h", day)
    time.sleep(1)
    fg.compact_history(spark, root, "cust_h", day)
    time.sleep(1)
    stop.set()
    reader.join()
    assert not errors and len(counts) > 2 and all(counts)
    assert len(glob.glob(f"{folder}/load_date={day}/batch=*")) == 5  # for those still reading
    fg.compact_history(spark, root, "cust_h", day, grace_seconds=0)
    assert len(glob.glob(f"{folder}/load_date={day}/batch=*")) == 1
    assert rows(stream.history("cust_h").drop("loadtime")) == ordered(sent)
    more = stream.send(CUSTOMER_TOPIC, golden.DEMAND[:1])
    stream.load()
    fg.compact_history(spark, root, "cust_h", day)
    fg.compact_history(spark, root, "cust_h", day, grace_seconds=0)
    assert rows(stream.history("cust_h").drop("loadtime")) == ordered(sent + more)
    assert len(glob.glob(f"{folder}/load_date={day}/batch=*")) == 1


@pytest.mark.parametrize("limit", ["files", "bytes"])
def test_a_backlog_arrives_in_bounded_batches(spark, stream, limit):
    sent = []
    for i in range(5):
        sent += stream.send(CUSTOMER_TOPIC, golden.DEMAND[:2])
    sizes = [os.path.getsize(x) for x in glob.glob(f"{stream.root}/inbox/*.parquet")]
    bound = {"max_files": 2} if limit == "files" else {"max_bytes": 2 * max(sizes)}
    counts = fg.LoadCounts(spark)
    try:
        source = record_files(spark, f"{stream.root}/inbox", **bound)
        query = fg.ingest(source, TABLES, f"{stream.root}/history", f"{stream.root}/snapshots",
                          f"{stream.root}/checkpoint", trigger={"availableNow": True})
        query.awaitTermination()
        assert counts.wait(query.runId)
        assert [n for _, _, _, n in counts.rows()] == [4, 4, 2]
    finally:
        counts.close()
    assert rows(stream.history("cust_h").drop("loadtime")) == ordered(sent)
    with pytest.raises(ValueError):
        record_files(spark, "x", max_files=1, max_bytes=1)
