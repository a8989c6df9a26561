"""JSON payloads of the known topics, projected to the products' input columns."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetgrid import schemas

TRIP_TOPIC = "congestionEstimator"
CUSTOMER_TOPIC = "customerData"
DRIVER_TOPIC = "driverData"

# JSON field names as the producers spell them, by column.
_TRIP_FIELDS = {
    "trip_id": "VendorID",
    "pickup_datetime": "lpep_pickup_datetime",
    "dropoff_datetime": "Lpep_dropoff_datetime",
    "pickup_longitude": "Pickup_longitude",
    "pickup_latitude": "Pickup_latitude",
    "dropoff_longitude": "Dropoff_longitude",
    "dropoff_latitude": "Dropoff_latitude",
    "trip_distance": "Trip_distance",
}

TOPIC_FIELDS = {
    TRIP_TOPIC: _TRIP_FIELDS,
    CUSTOMER_TOPIC: {name: name for name in schemas.DEMAND.names},
    DRIVER_TOPIC: {name: name for name in schemas.SUPPLY.names},
}


def project_payload(records: DataFrame, topic: str) -> DataFrame:
    """Columns of a topic's payload; null where a field is missing or the JSON is broken.

    Field names are case-sensitive; of a repeated field the first value counts.
    `json_tuple` reads all fields in one pass but takes the last value, so payloads
    with a repeated key, and only those, are read field by field.
    """
    fields = TOPIC_FIELDS[topic]
    payload, repeated = F.col("payload"), F.col("repeated")
    keys = F.json_object_keys(payload)
    has_repeat = F.coalesce(F.size(keys) > F.size(F.array_distinct(keys)), F.lit(False))
    marked = records.select(payload, has_repeat.alias("repeated"))
    read = marked.select(
        payload,
        repeated,
        F.json_tuple(F.when(~repeated, payload), *fields.values()).alias(*fields),
    )
    return read.select(
        *[
            F.when(repeated, F.get_json_object(payload, f"$.{field}"))
            .otherwise(F.col(column))
            .alias(column)
            for column, field in fields.items()
        ]
    )
