"""CSV inputs: landing directories with mixed files, and snapshot directories."""

import re
from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from fleetgrid.sinks.versions import published_path

_STORE = r"^[A-Za-z][A-Za-z0-9+.-]*:(//[^/]*)?"


def read_csv(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """CSV with a header line. Columns are taken by position; empty fields are null.

    Of a path that was published, its current version."""
    path = published_path(spark, path) or path
    return spark.read.schema(schema).option("header", True).csv(path)


def read_landing(
    spark: SparkSession, root: str, marker: str, schema: StructType
) -> DataFrame | None:
    """All CSV files below `root` whose path there contains `marker`, as one DataFrame.

    None if there is no such file. The directory is listed once: the check reads the
    scan's own listing. Spark drops the other files while planning the scan, but tests the
    condition on every row again: there is none if all files are marked, and else a lookup.
    """
    folder = _folder(spark, root)
    files = spark.read.schema(schema).option("header", True).option("recursiveFileLookup", True)
    scan = files.csv(root)
    marked, others = [], []
    for path in scan.inputFiles():
        (marked if marker in _below(path, folder) else others).append(path)
    if not marked:
        return None
    return scan.where(F.col("_metadata.file_path").isin(_spellings(marked))) if others else scan


def marked_rows(spark: SparkSession, scan: DataFrame, root: str, marker: str) -> DataFrame:
    """Rows of a scan or stream of files below `root`, from those with `marker` in the path."""
    folder = _folder(spark, root)
    path = _decoded(F.col("_metadata.file_path"))
    below = F.when(F.startswith(path, F.lit(folder)), F.substring(path, len(folder) + 1, 1 << 30))
    return scan.where(below.contains(marker))


def _folder(spark: SparkSession, root: str) -> str:
    """The path of a directory as its store has it, absolute and with a slash at the end."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(root)
    store = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    resolved = store.getFileStatus(path).getPath().toUri().normalize().getPath()
    return resolved.rstrip("/") + "/"


def _spellings(urls: list[str]) -> list[str]:
    """The URLs as listings spell them (`file:///x`) and as the metadata of rows do (`file:/x`)."""
    return [*urls, *[re.sub(r"^([^:/]+:)///", r"\1/", x) for x in urls if ":///" in x]]


def _below(url: str, folder: str) -> str:
    """The part of a file's URL, as Spark spells it, after a folder."""
    path = unquote(re.sub(_STORE, "", url))
    return path[len(folder) :] if path.startswith(folder) else ""


def _decoded(url: Column) -> Column:
    """The path of a file's URL. A plus sign stands for itself in paths."""
    return F.url_decode(F.replace(F.regexp_replace(url, _STORE, ""), F.lit("+"), F.lit("%2B")))


def read_snapshot(spark: SparkSession, path: str, schema: StructType) -> DataFrame | None:
    """A snapshot directory, or None if it was never written."""
    try:
        return read_csv(spark, path, schema)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise
