"""The physical plans are the ones the design relies on."""

import re

import pytest

import fleetgrid as fg
from fleetgrid import schemas
from fleetgrid.sinks.files import write_csv
from fleetgrid.sources.landing import read_csv
from tests import golden
from tests.golden import rows
from workload import inputs, shapes
from workload.catalog import rounded

SF = "/root/testdata/sf0.001"

# HotSpot leaves larger methods uncompiled.
HUGE_METHOD = 8000


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    """The derived inputs as parquet, so that plans show the products' own scans."""
    root = tmp_path_factory.mktemp("plans")
    frames = {}
    for name in ("trips", "demand", "supply"):
        getattr(inputs, name)(spark, SF).write.parquet(f"{root}/{name}")
        frames[name] = spark.read.parquet(f"{root}/{name}")
    write_csv(spark.createDataFrame(golden.TRIPS, schemas.TRIPS), f"{root}/csv")
    frames["csv_trips"] = read_csv(spark, f"{root}/csv", schemas.TRIPS)
    return frames


def explained(df, mode="simple"):
    modes = df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode
    return df._jdf.queryExecution().explainString(modes.fromString(mode))


def static_plan(spark, df, mode="simple"):
    """Plan without run-time re-planning, exchange reuse resolved."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        return explained(df.select("*"), mode)
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")


def executed(plan):
    """Operators that run: reused exchanges stand for work done once."""
    lines = [line for line in plan.splitlines() if "ReusedExchange" not in line]
    return "\n".join(lines)


@pytest.mark.parametrize("source", ["trips", "csv_trips"])
def test_congestion_scans_and_shuffles_once(spark, tables, source):
    plan = static_plan(spark, fg.traffic_congestion(tables[source]))
    assert plan.count("ReusedExchange") == 1
    assert executed(plan).count("FileScan") == 1
    assert executed(plan).count("Exchange hashpartitioning") == 1
    assert "Join" not in plan and "Cartesian" not in plan


def test_congestion_reuses_its_shuffle_at_run_time(tables):
    df = fg.traffic_congestion(tables["trips"])
    df.collect()
    final = explained(df)
    assert "ReusedExchange [cell" in final


def test_scan_reads_what_is_needed(spark, tables):
    plan = static_plan(spark, fg.traffic_congestion(tables["trips"]), "formatted")
    assert "PushedFilters: [IsNotNull(trip_distance)]" in plan
    columns = re.search(r"ReadSchema: (.*)", plan).group(1)
    for name in schemas.TRIPS.names:
        assert (name in columns) == (name != "trip_id")


@pytest.mark.parametrize("keyed", [False, True])
def test_ratio_has_one_exchange_and_no_join(spark, tables, keyed):
    plan = static_plan(spark, fg.demand_supply_ratio(tables["demand"], tables["supply"], keyed))
    assert plan.count("Exchange") == 1
    assert plan.count("FileScan") == 2
    assert "Join" not in plan


def products(tables):
    trips, demand, supply = tables["trips"], tables["demand"], tables["supply"]
    return {
        "congestion": fg.traffic_congestion(trips),
        "congestion_csv": fg.traffic_congestion(tables["csv_trips"]),
        "cell_avg_speed": fg.cell_avg_speed(trips),
        "global_avg_speed": fg.global_avg_speed(trips),
        "trip_speeds": fg.trip_speeds(trips),
        "trip_endpoints": fg.trip_endpoints(trips),
        "ratio": fg.demand_supply_ratio(demand, supply),
        "demand": fg.cell_demand_counts(demand),
        # Inputs that are computed themselves add to the fused code.
        "derived_congestion": fg.traffic_congestion(inputs.trips(demand.sparkSession, SF)),
        "derived_trip_speeds": fg.trip_speeds(inputs.trips(demand.sparkSession, SF)),
    }


def test_generated_methods_stay_compilable(spark, tables):
    for name, df in products(tables).items():
        sizes = re.findall(r"maxMethodCodeSize:\s*(\d+)", static_plan(spark, df, "codegen"))
        assert sizes and max(map(int, sizes)) < HUGE_METHOD, (name, sizes)


def test_no_python_in_plans(spark, tables):
    for name, df in products(tables).items():
        assert "Python" not in static_plan(spark, df) and "Pandas" not in static_plan(spark, df), name


def test_congestion_equals_union_shape(tables):
    ours = rounded(fg.traffic_congestion(tables["trips"]))
    shape = rounded(shapes.congestion_by_union(tables["trips"])).select(ours.columns)
    assert rows(ours) == rows(shape)


@pytest.mark.parametrize("keyed", [False, True])
def test_ratio_equals_join_shape(tables, keyed):
    ours = fg.demand_supply_ratio(tables["demand"], tables["supply"], keyed)
    shape = shapes.ratio_by_join(tables["demand"], tables["supply"], keyed)
    assert rows(ours) == rows(shape.select(ours.columns))
