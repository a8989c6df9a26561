"""What the operators share: tables, the shared scratch folder, text expressions."""

from __future__ import annotations

import atexit
import contextlib
import os
import shutil
import string
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SPACES = r"\x20\x09-\x0D"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ship_package(spark: SparkSession) -> None:
    """Gives the executors' Python this package, once for each Spark context."""
    context = spark.sparkContext
    if getattr(context, "_fleetgrid_shipped", False):
        return
    here = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    folder = tempfile.mkdtemp(prefix="fleetgrid-code-")  # executors fetch from it later
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    keep = shutil.ignore_patterns("__pycache__")
    shutil.copytree(here, f"{folder}/src/fleetgrid", ignore=keep)
    context.addPyFile(shutil.make_archive(f"{folder}/fleetgrid", "zip", f"{folder}/src"))
    context._fleetgrid_shipped = True


def shared_dir(spark: SparkSession) -> str:
    """A folder in the storage that driver and executors share: `spark.checkpoint.dir` or,
    where that is unset, the warehouse."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        base = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_scratch"
    return f"{base.rstrip('/')}/fleetgrid-llm"


class Scratch:
    """Tables that an operator writes and reads again, in the shared folder.

    They cut the lineage: what is lost with an executor is read again, not computed
    again. They are removed when the Python process ends; `drop` does so earlier.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
        atexit.register(self._remove, self.path)

    def table(self, name: str, df: DataFrame) -> DataFrame:
        path = f"{self.path}/{name}"
        df.write.option("compression", "zstd").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, name: str) -> None:
        self._remove(f"{self.path}/{name}")

    def _remove(self, path: str) -> None:
        with contextlib.suppress(Exception):  # the session may have ended
            context = self.spark.sparkContext
            at = context._jvm.org.apache.hadoop.fs.Path(path)
            at.getFileSystem(context._jsc.hadoopConfiguration()).delete(at, True)


def lower_ascii(text: Column) -> Column:
    """A-Z in lower case, all else as it is. Pure ASCII takes the faster way."""
    mapped = F.translate(text, string.ascii_uppercase, string.ascii_lowercase)
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(mapped)


def settled(column: Column) -> Column:
    """The column as it is, but computed once.

    Catalyst pushes a filter below the projection that computes its column, by writing
    the whole expression into the filter; for nested expressions this multiplies the
    work. It does not do so for what it takes for non-deterministic.
    """
    return F.when(F.spark_partition_id() >= 0, column)


def row_key(id_column: str = "doc_id") -> list[Column]:
    """Columns that tell documents apart: the id, and the text in case the id repeats."""
    return [F.col(id_column).alias("key_id"), F.xxhash64("text").alias("key_text")]


def boxed(docs: DataFrame, replaced: list[str]) -> tuple[list[str], list[Column]]:
    """A table whose columns may have any names, for work on its texts: the columns to
    keep, and the select list of `_row` (those but the text), `_text` and the row's key."""
    names = [c for c in docs.columns if c not in replaced]
    row = F.struct(*[c for c in names if c != "text"]).alias("_row")
    return names, [row, F.col("text").alias("_text"), *row_key()]


def unboxed(names: list[str]) -> list[Column]:
    """The columns of `boxed` again, in their order."""
    return [F.col("_text" if c == "text" else f"_row.`{c}`").alias(c) for c in names]


def same_key(left: DataFrame, right: DataFrame) -> Column:
    """`row_key` columns of both sides are equal, nulls included."""
    return left["key_id"].eqNullSafe(right["key_id"]) & (left["key_text"] == right["key_text"])
