"""Trip speeds and the congestion status of each cell and ten-minute slot."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetgrid.functions.cells import cell_number, geohash
from fleetgrid.functions.numbers import number, with_numbers
from fleetgrid.functions.slots import clock, with_clocks, with_minutes
from fleetgrid.operators.slots import SLOT_KEYS, slot_labels, time_keys
from fleetgrid.schemas import TRIPS

_COORDINATES = ["pickup_latitude", "pickup_longitude", "dropoff_latitude", "dropoff_longitude"]
_DATETIMES = ["pickup_datetime", "dropoff_datetime"]


def _measured(trips: DataFrame) -> DataFrame:
    """Trips with both cells, whole minutes and a speed; unreadable ones only marked.

    Missing distance text is filtered where the scan can do it. What else makes a
    trip unusable is known only after reading its texts.
    """
    present = trips.where(F.col("trip_distance").isNotNull())
    read = with_clocks(with_numbers(present, *_COORDINATES, "trip_distance"), *_DATETIMES)
    timed = with_minutes(read, "minutes", *_DATETIMES)
    located = timed.withColumns({f"{end}_cell": _cell(end) for end in ("pickup", "dropoff")})
    return located.withColumns(
        {
            "usable": F.col("pickup_cell").isNotNull()
            & F.col("dropoff_cell").isNotNull()
            & F.col("minutes").isNotNull(),
            "speed": F.try_divide(number("trip_distance") * 60, F.col("minutes")),
        }
    )


def _cell(end: str) -> Column:
    return cell_number(number(f"{end}_latitude"), number(f"{end}_longitude"))


def _usable_only(measured: DataFrame, *rows: Column) -> DataFrame:
    """Each usable trip as the given struct rows; the others give none.

    Inlining a null array yields no rows. A filter would be pushed below the
    projections and read every text a second time.
    """
    return measured.select(F.inline(F.when(F.col("usable"), F.array(*rows))))


def trip_speeds(trips: DataFrame) -> DataFrame:
    """Usable trips with `geohash_pickup`, `geohash_dropoff`, `trip_time` and `speed`.

    Trips need two readable cells, two readable datetimes and some distance text.
    Speed is distance per hour; it is null for unreadable distances and for trips
    under a minute, and negative for trips that end before they start.
    """
    return _usable_only(
        _measured(trips),
        F.struct(
            *TRIPS.names,
            geohash(F.col("pickup_cell")).alias("geohash_pickup"),
            geohash(F.col("dropoff_cell")).alias("geohash_dropoff"),
            F.col("minutes").cast("string").alias("trip_time"),
            "speed",
        ),
    )


def global_avg_speed(trips: DataFrame) -> DataFrame:
    """One row: the mean speed over all usable trips."""
    speed = F.when(F.col("usable"), F.col("speed"))
    return _measured(trips).agg(F.avg(speed).alias("average_speed"))


def _endpoints(trips: DataFrame) -> DataFrame:
    """Two rows per usable trip, its pickup and its dropoff, from a single scan."""
    legs = _usable_only(_measured(trips), _endpoint("pickup"), _endpoint("dropoff"))
    return legs.select(
        "cell", *time_keys(F.col("datetime"), F.col("clock")), "speed", "datetime"
    )


def _endpoint(end: str) -> Column:
    return F.struct(
        F.col(f"{end}_cell").alias("cell"),
        F.col(f"{end}_datetime").alias("datetime"),
        clock(f"{end}_datetime").alias("clock"),
        "speed",
    )


def trip_endpoints(trips: DataFrame) -> DataFrame:
    """Every usable trip twice: at its pickup and at its dropoff cell and slot."""
    return _endpoints(trips).select(*slot_labels(), "datetime", "speed")


def _slot_speeds(trips: DataFrame) -> DataFrame:
    """Speed total and count per slot."""
    return (
        _endpoints(trips)
        .groupBy(*SLOT_KEYS)
        .agg(F.sum("speed").alias("speed_sum"), F.count("speed").alias("speed_count"))
    )


def cell_avg_speed(trips: DataFrame) -> DataFrame:
    """Mean speed per slot beside the mean speed over all trips.

    Every trip counts in exactly two slots, so the overall mean is also the mean
    over the slot totals. Both sides then need the same grouped rows: Spark reuses
    the one shuffle, and the trips are scanned once.
    """
    slots = _slot_speeds(trips)
    overall = slots.agg(F.try_divide(F.sum("speed_sum"), F.sum("speed_count")))
    return slots.select(
        *slot_labels(),
        overall.scalar().alias("average_speed"),
        F.try_divide("speed_sum", "speed_count").alias("geohash_avg_speed"),
    )


def traffic_congestion(
    trips: DataFrame, green_above: float = 5.0, red_below: float = 1.0
) -> DataFrame:
    """Status per slot: Green, Yellow or Red.

    Green is faster than the overall mean by more than `green_above`, Red slower by
    more than `red_below`; the rest, including slots without a speed, is Yellow.
    """
    slot, overall = F.col("geohash_avg_speed"), F.col("average_speed")
    status = (
        F.when(slot > overall + green_above, "Green")
        .when(slot < overall - red_below, "Red")
        .otherwise("Yellow")
    )
    return cell_avg_speed(trips).withColumn("congestion_status", status)
