import gzip
import os

import pytest

import fleetgrid as fg
from fleetgrid import schemas
from fleetgrid.plans import batch
from fleetgrid.sinks.files import append_table, write_csv
from fleetgrid.sources.kafka import kafka_options
from fleetgrid.sources.landing import read_csv, read_landing, read_snapshot
from tests import golden
from tests.golden import ordered, rows
from workload.catalog import CONGESTION_SCHEMA, RATIO_SCHEMA


def write_lines(path, schema, records):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as out:
        print(",".join(schema.names), file=out)
        for record in records:
            print(",".join("" if value is None else value for value in record), file=out)


@pytest.fixture()
def landing(tmp_path):
    root = str(tmp_path / "landing")
    half = len(golden.TRIPS) // 2
    write_lines(f"{root}/a/TrafficCongestionEstimation.csv", schemas.TRIPS, golden.TRIPS[:half])
    write_lines(
        f"{root}/b/2-TrafficCongestionEstimation.csv.part", schemas.TRIPS, golden.TRIPS[half:]
    )
    write_lines(f"{root}/CustomerDemand.csv/part-0.csv", schemas.DEMAND, golden.DEMAND)
    write_lines(f"{root}/c/xCabSupply.csv", schemas.SUPPLY, golden.SUPPLY)
    with open(f"{root}/broken.csv.gz", "w") as out:
        out.write("not gzip")
    return root


def test_csv_reading(spark, tmp_path):
    path = tmp_path / "d.csv"
    path.write_text('z,y,x,w\n1,"",\n2,,x, t \n3\n4,a,b,c,d\n')
    assert rows(read_csv(spark, str(path), schemas.DEMAND)) == ordered(
        [("1", None, None, None), ("2", None, "x", " t "), ("3", None, None, None), ("4", "a", "b", "c")]
    )


def test_csv_round_trip_keeps_blanks_and_quotes(spark, tmp_path):
    data = [("a,b", ' "q" ', None, " 2015-09-01 00:00:00"), ("x", "\\", "y", "z ")]
    df = spark.createDataFrame(data, schemas.DEMAND)
    write_csv(df, f"{tmp_path}/out", single_file=True)
    assert rows(read_csv(spark, f"{tmp_path}/out", schemas.DEMAND)) == ordered(data)
    assert len([f for f in os.listdir(tmp_path / "out") if f.endswith(".csv")]) == 1


def test_landing_takes_marked_files_only(spark, landing):
    df = read_landing(spark, landing, batch.TRIPS_MARKER, schemas.TRIPS)
    # The broken file would fail the scan if it were opened.
    assert df.count() == len(golden.TRIPS)
    assert read_landing(spark, landing, batch.SUPPLY_MARKER, schemas.SUPPLY) is not None
    assert read_landing(spark, landing, "landing", schemas.SUPPLY) is None


@pytest.mark.parametrize(
    "spelling",
    ["{0}/x", "file://{0}/x", "file:{0}/x/", "{0}/./x", "{0}/y/../x", "{0}//x", "relative"],
)
@pytest.mark.parametrize("parent", ["my CustomerDemand.csv inbox", "a+b%20CustomerDemand.csv"])
def test_landing_roots_however_spelled(spark, tmp_path, monkeypatch, parent, spelling):
    top = f"{tmp_path}/{parent}"
    for part in ("x/CustomerDemand.csv/x/part 1.csv", "x/x/CustomerDemand.csv+"):
        write_lines(f"{top}/{part}", schemas.DEMAND, golden.DEMAND)
    write_lines(f"{top}/x/CabSupply.csv", schemas.SUPPLY, golden.SUPPLY)
    write_lines(f"{top}/x/strange.csv", schemas.SUPPLY, golden.SUPPLY)
    os.makedirs(f"{top}/y")
    root = spelling.format(top)
    if spelling == "relative":
        root = os.path.relpath(f"{top}/x", spark._jvm.System.getProperty("user.dir"))
    demand = read_landing(spark, root, batch.DEMAND_MARKER, schemas.DEMAND)
    assert demand.count() == 2 * len(golden.DEMAND)
    supply = read_landing(spark, root, batch.SUPPLY_MARKER, schemas.SUPPLY)
    assert supply.count() == len(golden.SUPPLY)
    assert read_landing(spark, root, "inbox", schemas.SUPPLY) is None


@pytest.mark.parametrize("marked, others", [(2, 0), (2, 1), (1, 2)])
def test_landing_rows_are_not_matched_one_by_one(spark, tmp_path, marked, others):
    """The marker is looked for in the names of files, not in that of each row's file."""
    for i in range(marked):
        write_csv(spark.createDataFrame(golden.DEMAND, schemas.DEMAND), f"{tmp_path}/in/{i} +%/x {batch.DEMAND_MARKER}")
    for i in range(others):
        write_csv(spark.createDataFrame(golden.SUPPLY, schemas.SUPPLY).coalesce(1), f"{tmp_path}/in/{i} +%/other")
    found = read_landing(spark, f"{tmp_path}/in", batch.DEMAND_MARKER, schemas.DEMAND)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "url_decode" not in plan.lower() and "UrlCodec" not in plan and "regexp" not in plan
    assert ("file_path" in plan) == (others > 0)
    assert rows(found) == ordered([tuple(v or None for v in row) for row in golden.DEMAND] * marked)


def test_unmarked_broken_file_is_really_broken(spark, landing):
    with pytest.raises(Exception):
        read_landing(spark, landing, "broken", schemas.TRIPS).collect()
    with gzip.open(f"{landing}/broken.csv.gz", "wt") as out:
        out.write("ok\n")
    assert read_landing(spark, landing, "broken", schemas.TRIPS).collect() == []


def test_run_congestion(spark, landing, tmp_path):
    out = f"{tmp_path}/out"
    counts = fg.run_congestion(spark, landing, out)
    assert counts == {"trips": len(golden.TRIPS), "rows": len(golden.CONGESTION)}
    assert rows(read_csv(spark, out, CONGESTION_SCHEMA)) == ordered(golden.CONGESTION)


def test_run_ratio(spark, landing, tmp_path):
    out = f"{tmp_path}/out"
    counts = fg.run_ratio(spark, landing, landing, out, single_file=True)
    assert counts == {"demand": 7, "supply": 6, "rows": 6}
    assert rows(read_csv(spark, out, RATIO_SCHEMA)) == ordered(golden.RATIO)
    fg.run_ratio(spark, landing, landing, out, keep_supply_keys=True)
    assert rows(read_csv(spark, out, RATIO_SCHEMA)) == ordered(golden.RATIO_KEYED)


def test_runs_without_input_leave_output_alone(spark, landing, tmp_path):
    out = f"{tmp_path}/out"
    fg.run_congestion(spark, landing, out)
    empty = tmp_path / "empty"
    empty.mkdir()
    assert fg.run_congestion(spark, str(empty), out) is None
    assert fg.run_ratio(spark, landing, str(empty), out) is None
    assert read_csv(spark, out, CONGESTION_SCHEMA).count() == len(golden.CONGESTION)


def test_run_with_header_only_file(spark, tmp_path):
    write_lines(f"{tmp_path}/in/TrafficCongestionEstimation.csv", schemas.TRIPS, [])
    counts = fg.run_congestion(spark, f"{tmp_path}/in", f"{tmp_path}/out")
    assert counts == {"trips": 0, "rows": 0}


def test_run_with_unusable_trips_only(spark, tmp_path):
    bad = [trip for trip in golden.TRIPS if trip[0] == "8"]
    write_lines(f"{tmp_path}/in/TrafficCongestionEstimation.csv", schemas.TRIPS, bad)
    counts = fg.run_congestion(spark, f"{tmp_path}/in", f"{tmp_path}/out")
    assert counts == {"trips": 1, "rows": 0}


def test_run_to_table(spark, landing, tmp_path):
    location = f"{tmp_path}/table"
    spark.sql(f"CREATE TABLE congestion_t ({CONGESTION_SCHEMA}) USING orc LOCATION '{location}'")
    try:
        for _ in range(2):
            fg.run_congestion(spark, landing, "unused", table="congestion_t")
        assert rows(spark.table("congestion_t")) == ordered(golden.CONGESTION * 2)
    finally:
        spark.sql("DROP TABLE congestion_t")


def test_append_table(spark, tmp_path):
    spark.sql(f"CREATE TABLE append_t (a string, b string) USING orc LOCATION '{tmp_path}/t'")
    try:
        df = spark.createDataFrame([("1", "2")], "b string, a string")
        assert append_table(df, " append_t ")
        assert rows(spark.table("append_t")) == [("1", "2")]
        assert not append_table(df.limit(0), "append_t")
        assert not append_table(df.limit(0), "append_t", mode="overwrite")
        assert not append_table(df, " ")
        assert not append_table(df, "append_t", mode="")
        assert not append_table(df, "append_t", fmt="")
        assert spark.table("append_t").count() == 1
        with pytest.raises(Exception):
            append_table(df, "no_such_table")
    finally:
        spark.sql("DROP TABLE append_t")


def test_run_micro_batch_skips_missing_snapshots(spark, tmp_path):
    root, out = f"{tmp_path}/snapshots", f"{tmp_path}/out"
    assert read_snapshot(spark, f"{root}/DemandData", schemas.DEMAND) is None
    assert fg.run_micro_batch(spark, root, out) == {}
    write_csv(spark.createDataFrame(golden.TRIPS, schemas.TRIPS), f"{root}/TrafficEstimator")
    write_csv(spark.createDataFrame(golden.DEMAND, schemas.DEMAND), f"{root}/DemandData")
    assert list(fg.run_micro_batch(spark, root, out)) == [batch.CONGESTION_OUTPUT]
    write_csv(spark.createDataFrame(golden.SUPPLY, schemas.SUPPLY), f"{root}/SupplyData")
    counts = fg.run_micro_batch(spark, root, out)
    assert counts[batch.RATIO_OUTPUT] == {"demand": 7, "supply": 6, "rows": 6}
    got = read_csv(spark, f"{out}/{batch.RATIO_OUTPUT}", RATIO_SCHEMA)
    assert rows(got) == ordered(golden.RATIO)


def test_kafka_options():
    options = kafka_options("host:9092", ["a", "b"], max_offsets_per_trigger=10, extra={"k": "v"})
    assert options == {
        "kafka.bootstrap.servers": "host:9092",
        "subscribe": "a,b",
        "startingOffsets": "latest",
        "kafka.max.partition.fetch.bytes": "15000000",
        "maxOffsetsPerTrigger": "10",
        "k": "v",
    }
    assert "maxOffsetsPerTrigger" not in kafka_options("h", ["a"])
    with pytest.raises(TypeError):
        kafka_options("h", "a,b")
    rate = kafka_options("h", ["a"], max_rate_per_partition=10_000, partitions=3, interval_seconds=60)
    assert rate["maxOffsetsPerTrigger"] == "1800000"
    for wrong in ({"max_offsets_per_trigger": 5}, {"partitions": None}, {"interval_seconds": None}):
        arguments = {"max_rate_per_partition": 1, "partitions": 3, "interval_seconds": 60} | wrong
        with pytest.raises(ValueError):
            kafka_options("h", ["a"], **arguments)


@pytest.mark.parametrize("table", ["", "  "])
def test_blank_tables_are_refused(spark, landing, table):
    with pytest.raises(ValueError):
        fg.run_congestion(spark, landing, "unused", table=table)
    with pytest.raises(ValueError):
        fg.run_ratio(spark, landing, landing, "unused", table=table)
