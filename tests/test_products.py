import pytest

from fleetgrid import (
    cell_demand_counts,
    cell_supply_counts,
    demand_supply_ratio,
    global_avg_speed,
    traffic_congestion,
    trip_endpoints,
    trip_speeds,
)
from fleetgrid import schemas
from tests import golden
from tests.golden import ordered, rows


@pytest.fixture(scope="module")
def trips(spark):
    return spark.createDataFrame(golden.TRIPS, schemas.TRIPS)


@pytest.fixture(scope="module")
def demand(spark):
    return spark.createDataFrame(golden.DEMAND, schemas.DEMAND)


@pytest.fixture(scope="module")
def supply(spark):
    return spark.createDataFrame(golden.SUPPLY, schemas.SUPPLY)


def test_trip_speeds(trips):
    out = trip_speeds(trips)
    assert out.columns == trips.columns + ["geohash_pickup", "geohash_dropoff", "trip_time", "speed"]
    assert {r.trip_id: (r.trip_time, r.speed) for r in out.collect()} == golden.SPEEDS


def test_global_avg_speed(trips):
    assert rows(global_avg_speed(trips)) == [(10.0,)]


def test_trip_endpoints_keep_both_ends_and_duplicates(trips):
    out = trip_endpoints(trips)
    assert out.count() == 2 * len(golden.SPEEDS)
    ends = [(r.geohash, r.hour_interval, r.min_interval) for r in out.collect() if r.speed == 30.0]
    assert sorted(ends) == [("dr5rs8", "0-1", "10-20"), ("dr5ru6", "23-24", "50-60")]


def test_traffic_congestion(trips):
    out = traffic_congestion(trips)
    assert dict(out.dtypes) == {
        "geohash": "string",
        "date": "date",
        "hour_interval": "string",
        "min_interval": "string",
        "average_speed": "double",
        "geohash_avg_speed": "double",
        "congestion_status": "string",
    }
    assert rows(out) == ordered(golden.CONGESTION)


def _round_trips(spark, *distances):
    """Ten-minute trips inside one cell each, one cell per distance."""
    data = [
        ("t", "2015-09-01 00:00:00", "2015-09-01 00:10:00", f"-73.{i}", "40.5", f"-73.{i}", "40.5", d)
        for i, d in enumerate(distances)
    ]
    return spark.createDataFrame(data, schemas.TRIPS)


def test_thresholds_are_strict(spark):
    # Speeds 15, 9, 6: the mean is 10, so +5 and -1 are met exactly.
    out = traffic_congestion(_round_trips(spark, "2.5", "1.5", "1.0"))
    status = {r.geohash_avg_speed: r.congestion_status for r in out.collect()}
    assert status == {15.0: "Yellow", 9.0: "Yellow", 6.0: "Red"}


def test_thresholds_are_parameters(spark):
    trips = _round_trips(spark, "2.5", "1.5", "1.0")
    out = traffic_congestion(trips, green_above=4.0, red_below=4.0)
    status = {r.geohash_avg_speed: r.congestion_status for r in out.collect()}
    assert status == {15.0: "Green", 9.0: "Yellow", 6.0: "Yellow"}


def test_empty_trips_give_empty_product(spark):
    assert traffic_congestion(spark.createDataFrame([], schemas.TRIPS)).collect() == []


def test_trips_without_any_speed_are_yellow(spark):
    out = traffic_congestion(_round_trips(spark, "n/a", "?")).collect()
    assert {(r.average_speed, r.geohash_avg_speed, r.congestion_status) for r in out} == {
        (None, None, "Yellow")
    }


def test_nan_and_infinite_distances(spark):
    out = trip_speeds(_round_trips(spark, "NaN", "Infinity", "nan", "inf", "1e999")).collect()
    assert sorted(str(r.speed) for r in out) == ["None", "None", "inf", "inf", "nan"]


def test_counts(demand, supply):
    out = cell_demand_counts(demand)
    expected = [(*r[:4], r[4]) for r in golden.RATIO_KEYED if r[4] is not None]
    assert rows(out) == ordered(expected)
    out = cell_supply_counts(supply)
    expected = [(*r[:4], r[5]) for r in golden.RATIO_KEYED if r[5] is not None]
    assert rows(out) == ordered(expected)


def test_ratio(demand, supply):
    out = demand_supply_ratio(demand, supply)
    assert dict(out.dtypes) == {
        "geohash": "string",
        "date": "date",
        "hour_interval": "string",
        "min_interval": "string",
        "cust_demand_count": "bigint",
        "cab_supply_count": "bigint",
        "demand_supply_ratio": "double",
    }
    assert rows(out) == ordered(golden.RATIO)


def test_ratio_keyed(demand, supply):
    assert rows(demand_supply_ratio(demand, supply, True)) == ordered(golden.RATIO_KEYED)


def test_ratio_with_one_empty_side(spark, demand, supply):
    none = spark.createDataFrame([], schemas.SUPPLY)
    out = demand_supply_ratio(demand, none).collect()
    assert sum(r.cust_demand_count for r in out) == len(golden.DEMAND)
    assert {(r.cab_supply_count, r.demand_supply_ratio) for r in out} == {(None, None)}
    none = spark.createDataFrame([], schemas.DEMAND)
    out = demand_supply_ratio(none, supply).collect()
    assert {(r.geohash, r.date, r.hour_interval, r.min_interval) for r in out} == {(None,) * 4}
