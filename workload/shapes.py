"""The products in the shape of the original jobs, for comparison.

Same expressions, but a count and the overall mean as separate actions, a union of
two branches, text keys, and a null-safe full outer join of two counts.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

import fleetgrid as fg

_KEYS = ["geohash", "date", "hour_interval", "min_interval"]


def congestion_by_union(trips: DataFrame) -> DataFrame:
    trips.count()
    speeds = fg.trip_speeds(trips)
    mean = speeds.agg(F.avg("speed")).first()[0]
    ends = [
        speeds.select(
            F.col(f"geohash_{end}").alias("geohash"),
            F.col(f"{end}_datetime").alias("datetime"),
            "speed",
            F.lit(mean).cast("double").alias("average_speed"),
        )
        for end in ("pickup", "dropoff")
    ]
    status = (
        F.when(F.col("geohash_avg_speed") > F.col("average_speed") + 5, "Green")
        .when(F.col("geohash_avg_speed") < F.col("average_speed") - 1, "Red")
        .otherwise("Yellow")
    )
    time = F.split_part("datetime", F.lit(" "), F.lit(2))
    hour = F.split_part(time, F.lit(":"), F.lit(1)).try_cast("int")
    minute = F.split_part(time, F.lit(":"), F.lit(2)).try_cast("int")
    minute = minute - minute % 10
    return (
        ends[0]
        .unionAll(ends[1])
        .withColumns(
            {
                "date": F.col("datetime").try_cast("date"),
                "hour_interval": F.concat(hour, F.lit("-"), hour + 1),
                "min_interval": F.concat(minute, F.lit("-"), minute + 10),
            }
        )
        .groupBy(*_KEYS, "average_speed")
        .agg(F.avg("speed").alias("geohash_avg_speed"))
        .withColumn("congestion_status", status)
    )


def ratio_by_join(demand: DataFrame, supply: DataFrame, keyed: bool = False) -> DataFrame:
    demand.count()
    supply.count()
    d, s = fg.cell_demand_counts(demand), fg.cell_supply_counts(supply)
    match = [d[k].eqNullSafe(s[k]) for k in _KEYS]
    return d.join(s, match, "full").select(
        *[F.coalesce(d[k], s[k]).alias(k) if keyed else d[k] for k in _KEYS],
        "cust_demand_count",
        "cab_supply_count",
        (F.col("cust_demand_count") / F.col("cab_supply_count")).alias("demand_supply_ratio"),
    )
