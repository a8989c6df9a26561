"""Geo-temporal mobility analytics on PySpark.

Two products per geohash cell and ten-minute slot, traffic congestion and the
demand/supply ratio, plus the stream that feeds them.
"""

from fleetgrid.operators.congestion import (
    cell_avg_speed,
    global_avg_speed,
    traffic_congestion,
    trip_endpoints,
    trip_speeds,
)
from fleetgrid.operators.demand_supply import (
    cell_demand_counts,
    cell_supply_counts,
    demand_supply_ratio,
)
from fleetgrid.plans.batch import run_congestion, run_micro_batch, run_ratio
from fleetgrid.sinks.files import publish_csv, recorded_runs
from fleetgrid.sinks.versions import published_path
from fleetgrid.sources.landing import read_csv
from fleetgrid.streaming.counts import LoadCounts
from fleetgrid.streaming.history import compact_history, last_load, read_history
from fleetgrid.streaming.ingest import (
    history_rows,
    ingest,
    latest_batch,
    parse_topic_tables,
)

__all__ = [
    "LoadCounts",
    "cell_avg_speed",
    "cell_demand_counts",
    "cell_supply_counts",
    "compact_history",
    "demand_supply_ratio",
    "global_avg_speed",
    "history_rows",
    "ingest",
    "last_load",
    "latest_batch",
    "parse_topic_tables",
    "publish_csv",
    "published_path",
    "read_csv",
    "read_history",
    "recorded_runs",
    "run_congestion",
    "run_micro_batch",
    "run_ratio",
    "traffic_congestion",
    "trip_endpoints",
    "trip_speeds",
]
