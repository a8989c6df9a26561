"""Files of (payload, offset, topic) records as a stream, admitted in batches of bounded size."""

from pyspark.sql import DataFrame, SparkSession

from fleetgrid import schemas


def record_files(
    spark: SparkSession,
    path: str,
    fmt: str = "parquet",
    max_files: int | None = None,
    max_bytes: int | None = None,
) -> DataFrame:
    """Streaming DataFrame for `ingest` over the files that arrive in a folder.

    A batch takes at most `max_files` files, or files of at most `max_bytes` together (and
    one at least), the oldest first; what is left waits for the next. Without either, a
    batch takes all that have arrived. A backlog thus never makes a batch larger than others.
    """
    if max_files is not None and max_bytes is not None:
        raise ValueError("a batch is bounded by files or by bytes, not both")
    reader = spark.readStream.schema(schemas.STREAM_RECORD).format(fmt)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    if max_bytes is not None:
        reader = reader.option("maxBytesPerTrigger", max_bytes)
    return reader.load(path)
