"""Where results go: product CSV directories and tables."""

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from fleetgrid.sinks.versions import GRACE_SECONDS, publish
from fleetgrid.store import Store

# The partition column of tables that bear the retry of a run.
RUN_COLUMN = "run_key"


def write_csv(df: DataFrame, path: str, single_file: bool = False) -> None:
    """Replace `path` with CSV files that have a header line. Blanks are kept as they are.

    The old files go before the new ones come; `publish_csv` leaves no such gap.
    `single_file` funnels everything through one task; keep it for small results.
    """
    if single_file:
        df = df.repartition(1)
    (
        df.write.mode("overwrite")
        .option("header", True)
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )


def publish_csv(
    df: DataFrame, path: str, single_file: bool = False, grace_seconds: float = GRACE_SECONDS
) -> str:
    """Make `df` what `path` shows, as CSV files of `write_csv`, without a gap.

    Readers take the files through `read_csv` or `published_path` and always get one whole
    version. Returns the folder of the new one.
    """
    return publish(
        df.sparkSession, path, lambda folder: write_csv(df, folder, single_file), grace_seconds
    )


def append_table(
    df: DataFrame,
    table: str,
    mode: str = "append",
    fmt: str = "orc",
    run_key: str | None = None,
) -> bool:
    """Append rows to an existing table, column by column in order.

    Returns False if an argument is blank or there were no rows, and then leaves the
    table as it is, also with mode `overwrite`, which looks for a row first. Otherwise
    rows are counted while they are written. Errors are raised, so that the caller can
    retry.

    With a `run_key` the append bears a retry: the table has a last column `run_key`, by
    which it is partitioned, and the run's rows are its partition. Writing the same run
    again, whether it had failed or not, replaces that partition and no other; a run
    without rows has none. `recorded_runs` lists the keys. Needs mode `append`.
    """
    table, mode, fmt = table.strip(), mode.strip(), fmt.strip()
    if not (table and mode and fmt):
        return False
    if run_key is not None:
        if mode.lower() != "append":
            raise ValueError(f"a run is appended, not written with mode {mode!r}")
        return _write_run(df, table, run_key)
    if mode.lower() == "overwrite" and df.isEmpty():
        return False
    written = Observation()
    counted = df.observe(written, F.count(F.lit(1)).alias("rows"))
    counted.write.mode(mode).format(fmt).insertInto(table)
    return written.get["rows"] > 0


def _write_run(df: DataFrame, table: str, run_key: str) -> bool:
    """The new files stand aside until all are written; only then the old ones go."""
    spark = df.sparkSession
    if not run_key.strip():
        raise ValueError("the run has a blank key")
    columns = spark.catalog.listColumns(table)
    partitions = [x.name for x in columns if x.isPartition]
    if partitions != [RUN_COLUMN]:
        raise ValueError(f"{table} is partitioned by {partitions}, not by {RUN_COLUMN}")
    values = [x for x in columns if not x.isPartition]
    if len(values) != len(df.columns):
        raise ValueError(f"{table} has {len(values)} columns, the rows {len(df.columns)}")
    described = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").collect()
    about = {row["col_name"]: row["data_type"] for row in described}
    named = df.toDF(*[x.name for x in values])
    typed = [F.col(f"`{x.name}`").cast(x.dataType).alias(x.name) for x in values]
    written = Observation()
    rows = named.select(*typed, F.lit(run_key).alias(RUN_COLUMN))
    (
        rows.observe(written, F.count(F.lit(1)).alias("rows"))
        .write.format(about["Provider"])
        .mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(RUN_COLUMN)
        .save(about["Location"])
    )
    partition = f"PARTITION ({RUN_COLUMN} = '{_quoted(run_key)}')"
    if written.get["rows"]:
        spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS {partition}")
    elif run_key in recorded_runs(spark, table):
        described = spark.sql(f"DESCRIBE TABLE EXTENDED {table} {partition}").collect()
        old = next(row["data_type"] for row in described if row["col_name"] == "Location")
        spark.sql(f"ALTER TABLE {table} DROP IF EXISTS {partition}")
        Store(spark, old).delete(old)
    spark.catalog.refreshTable(table)
    return written.get["rows"] > 0


def recorded_runs(spark: SparkSession, table: str) -> list[str]:
    """Keys of the runs whose rows are in a table, in order."""
    rows = spark.sql(f"SHOW PARTITIONS {table}").select(
        F.url_decode(F.replace(F.substring_index("partition", "=", -1), F.lit("+"), F.lit("%2B")))
    )
    return sorted(row[0] for row in rows.collect())


def _quoted(text: str) -> str:
    return text.replace("\\", "\\\\").replace("'", "\\'")
