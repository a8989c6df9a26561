"""The inputs as stream messages, in three waves."""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetgrid.functions.payloads import CUSTOMER_TOPIC, DRIVER_TOPIC, TOPIC_FIELDS, TRIP_TOPIC
from workload import inputs

ERROR_TOPIC = "appErrors"

TOPIC_TABLES = {
    TRIP_TOPIC: "trip_history",
    CUSTOMER_TOPIC: "customer_history",
    DRIVER_TOPIC: "driver_history",
    ERROR_TOPIC: "error_history",
}

WAVES = 3


def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every line item and event as `payload, offset, topic, wave`.

    Error events go to a topic that is archived but has no known payload. Driver
    messages stop after the second wave.
    """
    trips = inputs.trips(spark, sf_dir, keep=("l_orderkey", "l_linenumber"))
    order = F.col("l_orderkey")
    demand = inputs.demand(spark, sf_dir, keep=("event_id",))
    supply = inputs.supply(spark, sf_dir, keep=("event_id",))
    event = F.col("event_id")
    errors = inputs.events(spark, sf_dir, ["error"]).withColumn("payload", F.col("props"))
    return (
        _records(_json(trips, TRIP_TOPIC), TRIP_TOPIC, order * 10 + F.col("l_linenumber"), order)
        .unionByName(_records(_json(demand, CUSTOMER_TOPIC), CUSTOMER_TOPIC, event, event))
        .unionByName(_records(_json(supply, DRIVER_TOPIC), DRIVER_TOPIC, event, event, last=1))
        .unionByName(_records(errors, ERROR_TOPIC, event, event))
    )


def _json(df: DataFrame, topic: str) -> DataFrame:
    fields = TOPIC_FIELDS[topic].items()
    return df.withColumn("payload", F.to_json(F.struct(*[F.col(c).alias(f) for c, f in fields])))


def _records(
    df: DataFrame, topic: str, offset: Column, key: Column, last: int = WAVES - 1
) -> DataFrame:
    return df.select(
        "payload",
        offset.cast("bigint").alias("offset"),
        F.lit(topic).alias("topic"),
        F.least(key % WAVES, F.lit(last)).cast("int").alias("wave"),
    )
