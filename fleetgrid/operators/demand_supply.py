"""Customer requests against available cabs, per cell and ten-minute slot."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetgrid.functions.cells import cell_number
from fleetgrid.functions.numbers import number, with_numbers
from fleetgrid.functions.slots import clock, with_clocks
from fleetgrid.operators.slots import SLOT_KEYS, slot_labels, time_keys


def _sightings(df: DataFrame, prefix: str) -> DataFrame:
    """Slot key of every row; unreadable coordinates or datetimes give null keys."""
    lat, lon, datetime = (f"{prefix}_{part}" for part in ("latitude", "longitude", "datetime"))
    read = with_clocks(with_numbers(df.select(lat, lon, datetime), lat, lon), datetime)
    return read.select(
        cell_number(number(lat), number(lon)).alias("cell"),
        *time_keys(F.col(datetime), clock(datetime)),
    )


def cell_demand_counts(demand: DataFrame) -> DataFrame:
    """Requests per slot. Null cells form a group of their own."""
    return _counts(_sightings(demand, "cust"), "cust_demand_count")


def cell_supply_counts(supply: DataFrame) -> DataFrame:
    """Available cabs per slot. Null cells form a group of their own."""
    return _counts(_sightings(supply, "cab"), "cab_supply_count")


def _counts(sightings: DataFrame, name: str) -> DataFrame:
    counted = sightings.groupBy(*SLOT_KEYS).agg(F.count(F.lit(1)).alias(name))
    return counted.select(*slot_labels(), name)


def demand_supply_ratio(
    demand: DataFrame, supply: DataFrame, keep_supply_keys: bool = False
) -> DataFrame:
    """Requests, cabs and their ratio for every slot that has either.

    A side without rows in a slot has a null count and ratio. Slots with cabs but
    no requests lose their key columns unless `keep_supply_keys` is set; null keys
    match each other. Both sides are counted in one aggregation, which stands in
    for two counts and a null-safe full outer join at a quarter of the shuffles.
    """
    tagged = _sightings(demand, "cust").withColumn("is_demand", F.lit(True)).unionByName(
        _sightings(supply, "cab").withColumn("is_demand", F.lit(False))
    )
    counted = tagged.groupBy(*SLOT_KEYS).agg(
        _present(F.col("is_demand")).alias("cust_demand_count"),
        _present(~F.col("is_demand")).alias("cab_supply_count"),
    )
    if not keep_supply_keys:
        has_demand = F.col("cust_demand_count").isNotNull()
        counted = counted.withColumns({k: F.when(has_demand, F.col(k)) for k in SLOT_KEYS})
    return counted.select(
        *slot_labels(),
        "cust_demand_count",
        "cab_supply_count",
        (F.col("cust_demand_count") / F.col("cab_supply_count")).alias("demand_supply_ratio"),
    )


def _present(condition: Column) -> Column:
    return F.nullif(F.count_if(condition), F.lit(0))
