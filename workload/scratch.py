"""Folders for the files that some queries write and read back."""

import atexit
import contextlib
import uuid

from pyspark.sql import SparkSession


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A new folder in the storage that the session shares with its executors.

    That is `spark.checkpoint.dir` or, without it, the warehouse. The folder is removed
    when the Python process ends.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        base = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_scratch"
    folder = f"{base.rstrip('/')}/fleetgrid/{name}-{uuid.uuid4().hex}"
    atexit.register(_remove, spark, folder)
    return folder


def file_state(spark: SparkSession, *paths: str) -> tuple:
    """When the files or folders at `paths` changed last, and their sizes."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    state = []
    for path in map(hadoop.Path, paths):
        store = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        status, size = store.getFileStatus(path), store.getContentSummary(path).getLength()
        state.append((path.toString(), status.getModificationTime(), size))
    return tuple(state)


def _remove(spark: SparkSession, folder: str) -> None:
    with contextlib.suppress(Exception):  # the session may have ended
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
        store = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        store.delete(path, True)
