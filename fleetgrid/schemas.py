"""Input schemas. Every CSV column is text; numbers and dates are read later."""

from pyspark.sql.types import LongType, StringType, StructField, StructType


def _text(*names: str) -> StructType:
    return StructType([StructField(name, StringType()) for name in names])


DEMAND = _text("cust_id", "cust_latitude", "cust_longitude", "cust_datetime")

SUPPLY = _text("cab_id", "cab_latitude", "cab_longitude", "cab_datetime")

TRIPS = _text(
    "trip_id",
    "pickup_datetime",
    "dropoff_datetime",
    "pickup_longitude",
    "pickup_latitude",
    "dropoff_longitude",
    "dropoff_latitude",
    "trip_distance",
)

STREAM_RECORD = StructType(
    [
        StructField("payload", StringType()),
        StructField("offset", LongType()),
        StructField("topic", StringType()),
    ]
)
