"""Replacing and appending while others read, and after a failure."""

import os
import threading

import pytest
from pyspark.sql import functions as F

import fleetgrid as fg
from fleetgrid import schemas
from fleetgrid.plans import batch
from fleetgrid.sinks import versions
from fleetgrid.sinks.files import append_table, publish_csv, write_csv
from fleetgrid.sources.landing import read_csv, read_snapshot
from tests import golden
from tests.golden import ordered, rows
from tests.test_files import landing, write_lines  # noqa: F401
from workload.catalog import CONGESTION_SCHEMA, RATIO_SCHEMA


def numbered(spark, number, n=60):
    return spark.range(n, numPartitions=3).select(F.lit(str(number)).alias("version"), "id")


def folders(path):
    return sorted(os.listdir(f"{path}/_versions"))


def test_readers_always_get_one_whole_version(spark, tmp_path):
    path, stop, seen, errors = f"{tmp_path}/out", threading.Event(), [], []
    publish_csv(numbered(spark, 0), path)

    def read():
        while not stop.is_set():
            try:
                found = read_csv(spark, path, "version string, id long").collect()
                seen.append((len(found), {r["version"] for r in found}))
            except Exception as error:
                errors.append(error)

    reader = threading.Thread(target=read)
    reader.start()
    for i in range(1, 9):
        publish_csv(numbered(spark, i), path)
    stop.set()
    reader.join()
    assert not errors and len(seen) > 3
    assert all(n == 60 and len(found) == 1 for n, found in seen)
    order = [int(next(iter(found))) for _, found in seen]
    assert order == sorted(order)


def test_failed_write_leaves_the_old_version(spark, tmp_path):
    path = f"{tmp_path}/out"
    first = publish_csv(numbered(spark, 1), path)
    bad = numbered(spark, 2).withColumn("id", F.when(F.col("id") < 50, F.col("id")).otherwise(F.raise_error(F.lit("no"))))
    with pytest.raises(Exception, match="no"):
        publish_csv(bad, path, grace_seconds=0)
    assert versions.published_path(spark, path) == first
    assert read_csv(spark, path, "version string, id long").count() == 60
    publish_csv(numbered(spark, 3), path, grace_seconds=0)
    assert len(folders(path)) == 1  # what failed is gone as well
    assert {r["version"] for r in read_csv(spark, path, "version string, id long").collect()} == {"3"}


def test_old_versions_go_after_a_while(spark, tmp_path):
    path = f"{tmp_path}/out"
    for i in range(4):
        publish_csv(numbered(spark, i), path)
    assert len(folders(path)) == 4
    publish_csv(numbered(spark, 4), path, grace_seconds=0)
    assert len(folders(path)) == 1 and len(os.listdir(f"{path}/_published")) <= 2


def test_plain_folders_are_still_read(spark, tmp_path):
    path = f"{tmp_path}/out"
    write_csv(numbered(spark, "plain"), path)
    assert versions.published_path(spark, path) is None
    assert read_snapshot(spark, path, "version string, id long").count() == 60
    publish_csv(numbered(spark, "new"), path)
    assert {r["version"] for r in read_csv(spark, path, "version string, id long").collect()} == {"new"}


def test_a_failed_run_leaves_the_product(spark, landing, tmp_path, monkeypatch):  # noqa: F811
    out = f"{tmp_path}/out"
    fg.run_congestion(spark, landing, out)
    monkeypatch.setattr(batch, "traffic_congestion", lambda trips: trips.select(F.raise_error(F.lit("cut short"))))
    with pytest.raises(Exception, match="cut short"):
        fg.run_congestion(spark, landing, out)
    assert rows(read_csv(spark, out, CONGESTION_SCHEMA)) == ordered(golden.CONGESTION)


@pytest.fixture()
def run_table(spark, tmp_path):
    spark.sql(
        f"CREATE TABLE runs_t ({CONGESTION_SCHEMA}, run_key string) USING orc "
        f"PARTITIONED BY (run_key) LOCATION '{tmp_path}/table'"
    )
    yield "runs_t"
    spark.sql("DROP TABLE runs_t")


def test_a_retried_run_has_its_rows_once(spark, landing, run_table):  # noqa: F811
    for key in ("day 1", "day's=2/+", "day 1", "day 1"):
        counts = fg.run_congestion(spark, landing, "unused", table=run_table, run_key=key)
        assert counts["rows"] == len(golden.CONGESTION)
    assert fg.recorded_runs(spark, run_table) == ["day 1", "day's=2/+"]
    found = spark.table(run_table)
    assert rows(found.drop("run_key")) == ordered(golden.CONGESTION * 2)
    assert rows(found.where("run_key = 'day 1'").drop("run_key")) == ordered(golden.CONGESTION)


def test_a_run_that_fails_adds_nothing(spark, run_table):
    one = spark.createDataFrame(golden.CONGESTION[:1], CONGESTION_SCHEMA)
    assert append_table(one, run_table, run_key="a")
    bad = one.withColumn("geohash", F.raise_error(F.lit("cut short")))
    with pytest.raises(Exception, match="cut short"):
        append_table(bad, run_table, run_key="b")
    with pytest.raises(Exception, match="cut short"):
        append_table(bad, run_table, run_key="a")
    assert rows(spark.table(run_table).drop("run_key")) == ordered(golden.CONGESTION[:1])
    assert not append_table(one.limit(0), run_table, run_key="a")  # the run has no rows now
    assert spark.table(run_table).count() == 0 and fg.recorded_runs(spark, run_table) == []


def test_run_keys_are_checked(spark, landing, run_table, tmp_path):  # noqa: F811
    one = spark.createDataFrame(golden.CONGESTION[:1], CONGESTION_SCHEMA)
    with pytest.raises(ValueError):
        append_table(one, run_table, run_key=" ")
    with pytest.raises(ValueError):
        append_table(one, run_table, mode="overwrite", run_key="a")
    with pytest.raises(ValueError):
        fg.run_congestion(spark, landing, f"{tmp_path}/x", run_key="a")
    spark.sql(f"CREATE TABLE plain_t ({CONGESTION_SCHEMA}) USING orc LOCATION '{tmp_path}/plain'")
    try:
        with pytest.raises(ValueError, match="not by run_key"):
            append_table(one, "plain_t", run_key="a")
    finally:
        spark.sql("DROP TABLE plain_t")


def test_runs_use_new_files_only(spark, tmp_path):
    root, out, seen = f"{tmp_path}/in", f"{tmp_path}/out", f"{tmp_path}/seen"
    write_lines(f"{root}/a/TrafficCongestionEstimation.csv", schemas.TRIPS, golden.TRIPS)
    with open(f"{root}/broken.csv.gz", "w") as stranger:
        stranger.write("not gzip")  # would fail the run if it were opened
    counts = fg.run_congestion(spark, root, out, seen=seen)
    assert counts == {"trips": len(golden.TRIPS), "rows": len(golden.CONGESTION)}
    first = versions.published_path(spark, out)
    assert fg.run_congestion(spark, root, out, seen=seen) is None  # nothing new
    assert versions.published_path(spark, out) == first
    write_lines(f"{root}/b/TrafficCongestionEstimation.csv.2", schemas.TRIPS, golden.TRIPS[:1])
    write_lines(f"{root}/b/other.csv", schemas.TRIPS, golden.TRIPS)
    os.utime(f"{root}/b/TrafficCongestionEstimation.csv.2", (1, 1))  # a very old file, new here
    assert fg.run_congestion(spark, root, out, seen=seen)["trips"] == 1
    assert fg.run_congestion(spark, root, out, seen=seen) is None
    counts = fg.run_congestion(spark, root, out, seen=seen, rerun=True)
    assert counts["trips"] == len(golden.TRIPS) + 1
    assert fg.run_congestion(spark, root, out, seen=seen) is None


def test_a_run_cut_short_finds_its_rows_again(spark, tmp_path, monkeypatch):
    root, out, seen = f"{tmp_path}/in", f"{tmp_path}/out", f"{tmp_path}/seen"
    write_lines(f"{root}/TrafficCongestionEstimation.csv", schemas.TRIPS, golden.TRIPS)
    with monkeypatch.context() as patch:
        patch.setattr(batch, "traffic_congestion", lambda trips: trips.select(F.raise_error(F.lit("cut short"))))
        with pytest.raises(Exception, match="cut short"):
            fg.run_congestion(spark, root, out, seen=seen)
    assert fg.run_congestion(spark, root, out, seen=seen)["trips"] == len(golden.TRIPS)
    assert rows(read_csv(spark, out, CONGESTION_SCHEMA)) == ordered(golden.CONGESTION)


def test_sides_of_a_ratio_wait_for_each_other(spark, tmp_path):
    root, out, seen = f"{tmp_path}/in", f"{tmp_path}/out", f"{tmp_path}/seen"
    write_lines(f"{root}/CustomerDemand.csv", schemas.DEMAND, golden.DEMAND)
    assert fg.run_ratio(spark, root, root, out, seen=seen) is None
    write_lines(f"{root}/CabSupply.csv", schemas.SUPPLY, golden.SUPPLY)
    counts = fg.run_ratio(spark, root, root, out, seen=seen)
    assert counts == {"demand": 7, "supply": 6, "rows": 6}
    assert rows(read_csv(spark, out, RATIO_SCHEMA)) == ordered(golden.RATIO)
    assert fg.run_ratio(spark, root, root, out, seen=seen) is None
