"""History directories: `history=<table>/load_date=<day>/batch=<query and number>`.

A day is read without looking into any other. Old days are compacted to one batch: a folder
`batch=compacted-<id>` that counts only once there is a commit record of that id, which
names the batches it replaces:

    history=<table>/_compactions/<day>.<id>         the record: a replaced batch per line
    history=<table>/_compactions/<day>.<id>.done    the replaced batches are gone

The record is created last and at once. Readers take the records first and the files then,
so they see each row of a day once, before, during and after a compaction.
"""

from __future__ import annotations

import re
import time
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetgrid.store import Store

HISTORY_COLUMNS = ["payload", "offset", "loadtime"]
_SCHEMA = "payload string, offset string, loadtime timestamp"
_DAY = "load_date="
_BATCH = "batch="
_COMPACTED = "compacted-"
_RECORDS = "_compactions"
_DONE = ".done"

# Bytes. Files below the first, on average, are merged to such of about the second.
_SMALL_FILE = 1 << 20
_FILE = 8 << 20

# For so long replaced batches stay, for those who are still reading them.
GRACE_SECONDS = 3600.0


def read_history(spark: SparkSession, history_root: str, table: str) -> DataFrame:
    """All history of one table."""
    return _committed(spark, f"{history_root}/history={table}").select(HISTORY_COLUMNS)


def last_load(spark: SparkSession, history_root: str, table: str) -> DataFrame | None:
    """The rows of a table's last load, from its last day only; None without any."""
    root = f"{history_root}/history={table}"
    days = [x for x in Store(spark, root).folders(root) if x.startswith(_DAY)]
    if not days:
        return None
    day = max(days).removeprefix(_DAY)
    rows = _committed(spark, root, day).select(HISTORY_COLUMNS)
    return rows.where(F.col("loadtime") == rows.agg(F.max("loadtime")).scalar())


def _committed(spark: SparkSession, root: str, day: str | None = None) -> DataFrame:
    """The rows of the batches that count, of one day or of all."""
    hidden, valid = _records(Store(spark, root), root)  # before the files are listed
    rows = spark.read.schema(f"{_SCHEMA}, load_date date, batch string").orc(root)
    if day is not None:
        rows = rows.where(F.col("load_date") == F.lit(day).cast("date"))
        hidden, valid = ({day: x[day]} if day in x else {} for x in (hidden, valid))
    batch = F.col("batch")
    for of_day, batches in hidden.items():
        replaced = (F.col("load_date") == F.lit(of_day).cast("date")) & batch.isin(batches)
        rows = rows.where(~replaced)
    known = [x for batches in valid.values() for x in batches]
    return rows.where(~batch.startswith(_COMPACTED) | batch.isin(known))


def _records(store: Store, root: str) -> tuple[dict[str, list[str]], dict[str, list[str]]]:
    """By day: the batches that others replace, and the compacted ones that count.

    Only records whose batches are still there are read.
    """
    names = store.names(f"{root}/{_RECORDS}", folders=False)
    hidden: dict[str, list[str]] = {}
    valid: dict[str, list[str]] = {}
    for name in names:
        day, _, number = name.partition(".")
        if number.endswith((_DONE, ".tmp")):
            continue
        valid.setdefault(day, []).append(f"{_COMPACTED}{number}")
        if name + _DONE not in names:
            hidden.setdefault(day, []).extend(store.lines(f"{root}/{_RECORDS}/{name}"))
    return hidden, valid


def place_batch(spark: SparkSession, store: Store, written: str, place: str) -> None:
    """Make `place` the batch that is in folder `written`, in place of what a first try of it
    left there. Its files are moved, unless they are several and small: these are merged."""
    sizes = _data_files(store, written)
    if len(sizes) > max(1, sum(sizes) // _SMALL_FILE):
        _merge(spark, store, [written], place)
    else:
        store.delete(place)
        store.make(place.rpartition("/")[0])
        store.rename(written, place)


def _merge(spark: SparkSession, store: Store, folders: list[str], place: str) -> None:
    """The rows of all folders in `place`, in as many files as their size needs. No row is
    shuffled: a task reads whole files, or large parts of them, and writes one."""
    size = sum(x for folder in folders for x in _data_files(store, folder))
    rows = spark.read.schema(_SCHEMA).orc(folders)
    rows.coalesce(max(1, -(-size // _FILE))).write.mode("overwrite").orc(place)


def _data_files(store: Store, folder: str) -> list[int]:
    return [size for name, size in store.sizes(folder).items() if not name.startswith(("_", "."))]


def publish_batch(
    spark: SparkSession, name: str, history_root: str, table: str, day: str, batch: str
) -> None:
    """Show a batch in catalog table `name`, made over the history files of `table`.

    Nothing is copied; doing it again changes nothing. A session that has listed the
    table's files before sees replaced ones after REFRESH TABLE.
    """
    root = f"{history_root}/history={table}"
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} ({_SCHEMA}, load_date DATE, batch STRING) "
        f"USING orc PARTITIONED BY (load_date, batch) LOCATION '{_quoted(root)}'"
    )
    spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS {_partition(day, batch)}")


def compact_history(
    spark: SparkSession,
    history_root: str,
    table: str,
    day: str,
    catalog_table: str | None = None,
    grace_seconds: float = GRACE_SECONDS,
) -> None:
    """Rewrite the batches of a past day as one, of as many files as its size needs.

    For days that no batch will be written or retried for. `read_history` and `last_load` see every row once at any moment, also if this call is
    cut short at any point: the new batch counts from its commit record on, and the old ones
    count until then. A call removes old batches that were replaced at least `grace_seconds`
    ago, so that whoever reads them can finish; call it again for the rest. Only one call may
    work on a day at a time.

    A catalog table, and whoever reads the folders without the records, follows less
    strictly: partitions of `catalog_table` are dropped and added one after the other.
    """
    if not re.fullmatch(r"\d{4}-\d{2}-\d{2}", day):
        raise ValueError(f"need a day as yyyy-MM-dd, got {day!r}")
    root = f"{history_root}/history={table}"
    store = Store(spark, root)
    _adopt(store, root, day)
    hidden, valid = (x.get(day, []) for x in _records(store, root))
    batches = [x.removeprefix(_BATCH) for x in store.folders(f"{root}/{_DAY}{day}") if x.startswith(_BATCH)]
    old = [x for x in batches if x not in hidden and (x in valid or not x.startswith(_COMPACTED))]
    if len(old) > 1 or (old and old[0] not in valid):
        number = uuid.uuid4().hex
        folders = [f"{root}/{_DAY}{day}/{_BATCH}{x}" for x in old]
        _merge(spark, store, folders, f"{root}/{_DAY}{day}/{_BATCH}{_COMPACTED}{number}")
        store.create(f"{root}/{_RECORDS}/{day}.{number}", old)
    if catalog_table:
        _follow(spark, store, root, day, catalog_table)
    _remove_replaced(store, root, day, grace_seconds)


def _adopt(store: Store, root: str, day: str) -> None:
    """Finishes what an earlier version of this library left behind when it was cut short:
    a complete folder `_compacted` in place of batches that it had begun to remove."""
    folder = f"{root}/{_DAY}{day}"
    if not store.exists(f"{folder}/_compacted/_SUCCESS"):
        return
    number = uuid.uuid4().hex
    old = [x.removeprefix(_BATCH) for x in store.folders(folder) if x.startswith(_BATCH)]
    store.rename(f"{folder}/_compacted", f"{folder}/{_BATCH}{_COMPACTED}{number}")
    store.create(f"{root}/{_RECORDS}/{day}.{number}", old)


def _follow(spark: SparkSession, store: Store, root: str, day: str, catalog_table: str) -> None:
    hidden, valid = (x.get(day, []) for x in _records(store, root))
    gone = set(hidden)
    found = spark.sql(f"SHOW PARTITIONS {catalog_table} PARTITION (load_date = DATE'{day}')")
    for row in found.collect():
        batch = row[0].rpartition(f"{_BATCH}")[2]
        if batch in hidden or not store.exists(f"{root}/{_DAY}{day}/{_BATCH}{batch}"):
            gone.add(batch)
    for batch in sorted(gone):
        spark.sql(f"ALTER TABLE {catalog_table} DROP IF EXISTS {_partition(day, batch)}")
    for batch in set(valid) - gone:
        spark.sql(f"ALTER TABLE {catalog_table} ADD IF NOT EXISTS {_partition(day, batch)}")
    spark.catalog.refreshTable(catalog_table)


def _remove_replaced(store: Store, root: str, day: str, grace_seconds: float) -> None:
    """Removes what records of a day replace, and compacted batches without a record."""
    before = time.time() - grace_seconds
    folder = f"{root}/{_DAY}{day}"
    records = store.names(f"{root}/{_RECORDS}", folders=False)

    def finish(record: str) -> None:
        if not store.exists(record) or store.exists(record + _DONE):
            return
        for batch in store.lines(record):
            replaced = f"{root}/{_RECORDS}/{day}.{batch.removeprefix(_COMPACTED)}"
            if batch.startswith(_COMPACTED):  # what that one had replaced goes before it
                finish(replaced)
            store.delete(f"{folder}/{_BATCH}{batch}")
            if batch.startswith(_COMPACTED):
                store.delete(replaced)
                store.delete(replaced + _DONE)
        store.create(record + _DONE)

    for name, created in records.items():
        if name.startswith(f"{day}.") and not name.endswith((_DONE, ".tmp")) and created <= before:
            finish(f"{root}/{_RECORDS}/{name}")
    valid = _records(store, root)[1].get(day, [])
    for name, changed in store.names(folder, files=False).items():
        batch = name.removeprefix(_BATCH)
        if batch.startswith(_COMPACTED) and batch not in valid and changed <= before:
            store.delete(f"{folder}/{name}")


def _partition(day: str, batch: str) -> str:
    return f"PARTITION (load_date = DATE'{day}', batch = '{_quoted(batch)}')"


def _quoted(text: str) -> str:
    return text.replace("\\", "\\\\").replace("'", "\\'")
