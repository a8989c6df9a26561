"""Runs: read inputs, compute a product, write it."""

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from fleetgrid import schemas
from fleetgrid.operators.congestion import traffic_congestion
from fleetgrid.operators.demand_supply import demand_supply_ratio
from fleetgrid.sinks.files import append_table, publish_csv
from fleetgrid.sources.intake import take_new
from fleetgrid.sources.landing import read_landing, read_snapshot

# Names that mark the inputs, and the product directories.
TRIPS_MARKER = "TrafficCongestionEstimation.csv"
DEMAND_MARKER = "CustomerDemand.csv"
SUPPLY_MARKER = "CabSupply.csv"

TRIPS_SNAPSHOT = "TrafficEstimator"
DEMAND_SNAPSHOT = "DemandData"
SUPPLY_SNAPSHOT = "SupplyData"

CONGESTION_OUTPUT = "TrafficCongestionEstimatorMapview"
RATIO_OUTPUT = "DemandSupplyCalMapview"


def _rows() -> Column:
    return F.count(F.lit(1)).alias("rows")


def run_congestion(
    spark: SparkSession,
    in_path: str,
    out_path: str,
    *,
    single_file: bool = False,
    table: str | None = None,
    run_key: str | None = None,
    seen: str | None = None,
    rerun: bool = False,
) -> dict[str, int] | None:
    """Congestion from every trip file in a landing directory, as one run.

    Publishes a new version of `out_path` (read it with `read_csv` or `published_path`), or
    appends to `table` if one is named. A table that is partitioned by `run_key` takes the
    rows of a run with that key once, however often it is tried. Returns row counts, or
    None, leaving the output alone, if there is no trip file.

    With `seen`, a folder for the log of seen files, only rows of files that no earlier run
    with that log has used count, and a run without any returns None. A run that was cut
    short finds its rows again; with a `run_key`, try it again with the same key. `rerun`
    takes all files anew.
    """
    _check_table(table, run_key)
    if seen is not None:
        new = take_new(spark, in_path, TRIPS_MARKER, schemas.TRIPS, seen, rerun)
        if new.rows is None:
            return None
        counts = write_congestion(new.rows, out_path, single_file, table, run_key)
        new.used()
        return counts
    trips = read_landing(spark, in_path, TRIPS_MARKER, schemas.TRIPS)
    if trips is None:
        return None
    return write_congestion(trips, out_path, single_file, table, run_key)


def run_ratio(
    spark: SparkSession,
    demand_path: str,
    supply_path: str,
    out_path: str,
    *,
    keep_supply_keys: bool = False,
    single_file: bool = False,
    table: str | None = None,
    run_key: str | None = None,
    seen: str | None = None,
    rerun: bool = False,
) -> dict[str, int] | None:
    """Demand/supply ratio from landing directories; see `run_congestion`.

    Needs at least one file on each side. With `seen`, new rows of one side wait until there
    are new ones of the other.
    """
    _check_table(table, run_key)
    if seen is not None:
        new = take_new(spark, demand_path, DEMAND_MARKER, schemas.DEMAND, f"{seen}/demand", rerun)
        other = take_new(spark, supply_path, SUPPLY_MARKER, schemas.SUPPLY, f"{seen}/supply", rerun)
        if new.rows is None or other.rows is None:
            return None
        counts = write_ratio(
            new.rows, other.rows, out_path, keep_supply_keys, single_file, table, run_key
        )
        new.used()
        other.used()
        return counts
    demand = read_landing(spark, demand_path, DEMAND_MARKER, schemas.DEMAND)
    if demand is None:
        return None
    supply = read_landing(spark, supply_path, SUPPLY_MARKER, schemas.SUPPLY)
    if supply is None:
        return None
    return write_ratio(demand, supply, out_path, keep_supply_keys, single_file, table, run_key)


def run_micro_batch(
    spark: SparkSession,
    snapshot_root: str,
    out_root: str,
    *,
    keep_supply_keys: bool = False,
    single_file: bool = False,
) -> dict[str, dict[str, int]]:
    """Both products from the latest snapshots; row counts by output directory.

    A product whose snapshots are not all there yet is skipped.
    """
    demand = read_snapshot(spark, f"{snapshot_root}/{DEMAND_SNAPSHOT}", schemas.DEMAND)
    supply = read_snapshot(spark, f"{snapshot_root}/{SUPPLY_SNAPSHOT}", schemas.SUPPLY)
    trips = read_snapshot(spark, f"{snapshot_root}/{TRIPS_SNAPSHOT}", schemas.TRIPS)
    counts = {}
    if demand is not None and supply is not None:
        out = f"{out_root}/{RATIO_OUTPUT}"
        counts[RATIO_OUTPUT] = write_ratio(demand, supply, out, keep_supply_keys, single_file)
    if trips is not None:
        out = f"{out_root}/{CONGESTION_OUTPUT}"
        counts[CONGESTION_OUTPUT] = write_congestion(trips, out, single_file)
    return counts


def _check_table(table: str | None, run_key: str | None) -> None:
    if table is not None and not table.strip():
        raise ValueError("the table has a blank name")
    if run_key is not None and (table is None or not run_key.strip()):
        raise ValueError("a run key goes with a table and is not blank")


def write_congestion(
    trips: DataFrame,
    out_path: str,
    single_file: bool = False,
    table: str | None = None,
    run_key: str | None = None,
) -> dict[str, int]:
    """Congestion of `trips` to a CSV directory or a table, with row counts."""
    inputs = {"trips": trips}
    return _produce(inputs, traffic_congestion, out_path, single_file, table, run_key)


def write_ratio(
    demand: DataFrame,
    supply: DataFrame,
    out_path: str,
    keep_supply_keys: bool = False,
    single_file: bool = False,
    table: str | None = None,
    run_key: str | None = None,
) -> dict[str, int]:
    """The ratio of `demand` to `supply` to a CSV directory or a table, with row counts."""

    def product(demand: DataFrame, supply: DataFrame) -> DataFrame:
        return demand_supply_ratio(demand, supply, keep_supply_keys)

    inputs = {"demand": demand, "supply": supply}
    return _produce(inputs, product, out_path, single_file, table, run_key)


def _produce(
    inputs: dict[str, DataFrame],
    product: Callable[..., DataFrame],
    out_path: str,
    single_file: bool,
    table: str | None,
    run_key: str | None,
) -> dict[str, int]:
    """Write a product and count its inputs and output rows in the same pass."""
    seen = {name: Observation() for name in inputs}
    written = Observation()
    result = product(**{name: df.observe(seen[name], _rows()) for name, df in inputs.items()})
    result = result.observe(written, _rows())
    if table is not None:
        append_table(result, table, run_key=run_key)
    else:
        publish_csv(result, out_path, single_file)
    rows = written.get["rows"]
    # Spark may drop the branches of a result it finds to be empty, counters included.
    counts = {n: seen[n].get["rows"] if rows else df.count() for n, df in inputs.items()}
    return counts | {"rows": rows}
