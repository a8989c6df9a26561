"""Kafka topics as a stream of (payload, offset, topic) records.

Needs the Spark Kafka connector on the classpath. Broker addresses and credentials
come from the caller.
"""

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession

_MAX_FETCH_BYTES = 15_000_000


def kafka_options(
    bootstrap_servers: str,
    topics: Iterable[str],
    starting_offsets: str = "latest",
    max_offsets_per_trigger: int | None = None,
    extra: Mapping[str, str] | None = None,
    *,
    max_rate_per_partition: int | None = None,
    partitions: int | None = None,
    interval_seconds: float | None = None,
) -> dict[str, str]:
    """Reader options. `max_offsets_per_trigger` bounds a batch over all partitions.

    `max_rate_per_partition` bounds the records of a second and partition instead, for topics
    that have `partitions` together and batches `interval_seconds` apart: the source shares
    a batch out among partitions by what each has waiting.

    `topics` are names, one by one; `parse_topic_tables` reads them from a single text.
    """
    if isinstance(topics, str):
        raise TypeError("topics must be a collection of names, not one text")
    options = {
        "kafka.bootstrap.servers": bootstrap_servers,
        "subscribe": ",".join(topics),
        "startingOffsets": starting_offsets,
        "kafka.max.partition.fetch.bytes": str(_MAX_FETCH_BYTES),
    }
    if max_rate_per_partition is not None:
        if max_offsets_per_trigger is not None:
            raise ValueError("a batch is bounded in total or by partition, not both")
        if not (partitions and interval_seconds):
            raise ValueError("a rate by partition needs partitions and interval_seconds")
        most = max_rate_per_partition * partitions * interval_seconds
        max_offsets_per_trigger = max(1, int(most))
    if max_offsets_per_trigger is not None:
        options["maxOffsetsPerTrigger"] = str(max_offsets_per_trigger)
    return options | dict(extra or {})


def kafka_source(spark: SparkSession, *args, **kwargs) -> DataFrame:
    """Streaming DataFrame for `ingest`; takes the arguments of `kafka_options`."""
    records = spark.readStream.format("kafka").options(**kafka_options(*args, **kwargs)).load()
    return records.selectExpr("CAST(value AS STRING) AS payload", "offset", "topic")
