"""The products' inputs, spelled out from the given tables.

The tables hold no coordinates, so each row's keys are turned into coordinate and
datetime text by integer arithmetic. `workload/oracles.py` states the same rules
in SQL.
"""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

DEMAND_EVENTS = ["view", "click"]
SUPPLY_EVENTS = ["purchase", "signup"]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _div(left: Column, right: int) -> Column:
    return F.call_function("div", left, F.lit(right))


def _padded(number: Column, width: int) -> Column:
    return F.lpad(number.cast("string"), width, "0")


def _datetime(month: str, second: Column) -> Column:
    """Second 0 is midnight on the first day of `month`."""
    midnight = F.lit(f"{month}-01 00:00:00").cast("timestamp_ntz")
    return (midnight + F.make_dt_interval(secs=second)).cast("string")


def _coordinate(whole: str, micro_degrees: Column) -> Column:
    return F.concat(F.lit(f"{whole}."), _padded(micro_degrees, 6))


def _sighting(prefix: str) -> list[Column]:
    event, user = F.col("event_id"), F.col("user_id")
    latitude = (
        F.when(event % 97 == 0, F.lit(None).cast("string"))
        .when(event % 101 == 0, "abc")
        .otherwise(_coordinate("1", 250000 + user * 37 % 5 * 9000))
    )
    return [
        event.cast("string").alias(f"{prefix}_id"),
        latitude.alias(f"{prefix}_latitude"),
        _coordinate("103", 600000 + user * 53 % 4 * 17000).alias(f"{prefix}_longitude"),
        _datetime("2024-01", event * 7919 % 172800).alias(f"{prefix}_datetime"),
    ]


def events(spark: SparkSession, sf_dir: str, types: list[str]) -> DataFrame:
    return _table(spark, sf_dir, "events").where(F.col("event_type").isin(types))


def demand(spark: SparkSession, sf_dir: str, keep: tuple[str, ...] = ()) -> DataFrame:
    """Customer requests: the browsing events. `keep` names table columns to keep."""
    return events(spark, sf_dir, DEMAND_EVENTS).select(*_sighting("cust"), *keep)


def supply(spark: SparkSession, sf_dir: str, keep: tuple[str, ...] = ()) -> DataFrame:
    """Available cabs: the purchase and signup events."""
    return events(spark, sf_dir, SUPPLY_EVENTS).select(*_sighting("cab"), *keep)


def trips(spark: SparkSession, sf_dir: str, keep: tuple[str, ...] = ()) -> DataFrame:
    """One trip per line item. `trip_id` is not unique."""
    order, line, part, supplier = (
        F.col(name) for name in ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    )
    start = (order * 7919 + line * 613 + 300) % 259200 + 300
    end = start + (part * 31 + supplier * 17) % 3600 - 120
    dropoff_latitude = F.when(order % 73 == 0, "abc").otherwise(
        _coordinate("40", 650000 + supplier * 29 % 8 * 7000)
    )
    distance = (
        F.when(order % 89 == 0, F.lit(None).cast("string"))
        .when(order % 83 == 0, "n/a")
        .otherwise(F.col("l_quantity").cast("int").cast("string"))
    )
    return _table(spark, sf_dir, "lineitem").select(
        supplier.cast("string").alias("trip_id"),
        _datetime("2015-09", start).alias("pickup_datetime"),
        F.when(order % 79 == 0, "oops")
        .otherwise(_datetime("2015-09", end))
        .alias("dropoff_datetime"),
        _coordinate("-73", 900000 + supplier * 53 % 8 * 11000).alias("pickup_longitude"),
        _coordinate("40", 650000 + part * 37 % 8 * 7000).alias("pickup_latitude"),
        _coordinate("-73", 900000 + part * 41 % 8 * 11000).alias("dropoff_longitude"),
        dropoff_latitude.alias("dropoff_latitude"),
        distance.alias("trip_distance"),
        *keep,
    )


def lenient_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The trips with their readable datetimes spelled with odd fields: seconds since the
    first of the month, months and days before their time, five-digit years."""
    order, line, part, supplier = (
        F.col(name) for name in ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    )
    start = (order * 7919 + line * 613 + 300) % 259200 + 300
    end = start + (part * 31 + supplier * 17) % 3600 - 120
    pickups = ["2015-9-1 0:0:", "2015-10--29 0:0:", "12015-9-1 0:0:", "2015-09-02 -24:00:"]
    dropoffs = ["2016--3-1 0:0:", "2015-8-32 0:0:", "12015-8-00032 0:0:", "2015-9-1 1:-60:"]
    kept = ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    df = trips(spark, sf_dir, keep=kept)

    def spelled(spellings: list[str], second: Column) -> Column:
        first = F.get(F.array(*map(F.lit, spellings)), (order % 4).cast("int"))
        return F.concat(first, second.cast("string"))

    return df.withColumns(
        {
            "pickup_datetime": spelled(pickups, start),
            "dropoff_datetime": F.when(order % 79 == 0, "oops").otherwise(spelled(dropoffs, end)),
        }
    ).drop(*kept)


def odd_demand(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Requests with datetimes that are unpadded, cut short or without a date."""
    event = F.col("event_id")
    second = event * 7919 % 172800
    day, rest = 1 + _div(second, 86400), second % 86400
    hour, minute = _div(rest, 3600), _div(rest, 60) % 60
    spelled = (
        F.when(event % 4 == 0, F.format_string("2024-1-%d %d:%d:%d", day, hour, minute, rest % 60))
        .when(event % 4 == 1, F.format_string("2024-01-0%dT%02d:%02d:00", day, hour, minute))
        .when(event % 4 == 2, F.format_string("2024-01-0%d %d:%d", day, hour, minute))
        .otherwise(F.format_string("%d:%02d", hour, minute))
    )
    df = demand(spark, sf_dir, keep=("event_id",))
    return df.withColumn("cust_datetime", spelled).drop("event_id")
