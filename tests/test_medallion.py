"""The whole flow over landing files, run twice: the second run must not double anything."""

import uuid

import pytest
from pyspark.sql import functions as F

from furrow.functions import rules
from furrow.operators import quality
from furrow.plans import medallion
from furrow.sources import sensor_views, shared


@pytest.fixture(scope="module")
def landing(spark):
    from conftest import TESTDATA

    sf = f"{TESTDATA}/sf0.001"
    keep = dict(header=True, ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)
    frames = {
        "sensor_readings": sensor_views.raw_readings(spark, sf),
        "sensor_master": sensor_views.sensor_registry(spark, sf).select(F.concat(F.lit("S"), "sensor_id").alias("sensor_id")),
        "farm_master": sensor_views.farms(spark, sf).withColumn("farm_id", F.concat(F.lit("F"), "farm_id")),
        "crop_master": spark.sql("SELECT 1 AS crop_id, 'oats' AS crop"),
    }
    paths = {}
    for name, frame in frames.items():
        paths[name] = shared.fresh_path(spark, f"landing-{name}")
        frame.write.options(**keep).csv(paths[name])
    return paths


def test_flow(spark, landing):
    lake = medallion.Lake(spark, shared.fresh_path(spark, "lake"), prefix=f"lake_{uuid.uuid4().hex[:8]}")
    counts = []
    for _ in range(2):
        medallion.ingest(lake, landing, {"sensor_readings": sensor_views.RAW_SCHEMA})
        checked = medallion.refine(lake).first()
        summary = quality.quality_summary(lake.read("silver", "checked_sensor")).first()
        assert checked.asDict() == summary.asDict() and checked.total_records == lake.read("bronze", "sensor_readings").count()
        counts.append((lake.read("silver", "valid_sensor").count(), lake.read("silver", "invalid_sensor").count()))
    raw = lake.read("bronze", "sensor_readings")
    assert counts[0] == counts[1] and sum(counts[0]) == raw.count() and min(counts[0]) > 0
    assert {"_ingestion_timestamp", "_source_file"} <= set(raw.columns)

    valid = lake.read("silver", "valid_sensor")
    assert valid.filter("NOT is_valid OR invalid_reason <> ''").isEmpty()
    assert valid.select("sensor_id", "farm_id", "timestamp").distinct().count() == valid.count()

    described = medallion.describe_readings(valid, lake.read("bronze", "farm_master"))
    assert described.count() == valid.count()
    assert {"farm_name", "farm__source_file", "daily_max", "3_reading_average", "sensor_health"} <= set(described.columns)

    census = {r.table_name: (r.record_count, r.error) for r in medallion.publish_marts(lake).collect()}
    assert set(census) == set(medallion.MARTS)
    assert all(count > 0 and error is None for count, error in census.values())

    assert medallion.publish_features(lake).count() == valid.count()
    path = shared.fresh_path(spark, "classifier")
    summary = medallion.train_irrigation(lake, path, numTrees=3).first()
    assert summary.total_records == valid.count() and summary.model_path == path and summary.feature_count == 19

    forecast = medallion.forecast_moisture(lake, numTrees=3)
    assert forecast.columns == [
        "farm_id", "reading_hour", "temperature", "humidity", "soil_moisture", "rainfall", "battery",
        "next_hour_soil_moisture", "predicted_next_hour_soil_moisture", "predicted_irrigation_required"]
    assert 0 < forecast.count() < valid.count()
    errors = lake.read("gold", "moisture_training_summary").first()
    assert errors.test_records == forecast.count() and errors.mae > 0
    assert lake.read("gold", "irrigation_importance").count() == 19


def test_inferred_types_and_a_corrected_registry(spark):
    """Whole-number master ids meet text ids; rows leave the quarantine once their sensor is registered."""
    lake = medallion.Lake(spark, shared.fresh_path(spark, "lake"), prefix=f"lake_{uuid.uuid4().hex[:8]}")
    rows = [(1, "101", "1", "p", "01-01-2024 10:00", 20.0, 50.0, 50.0, 0.0, 90.0),
            (2, "abc", "x", "p", "01-01-2024 11:00", 20.0, 50.0, 50.0, 0.0, 90.0),
            (3, "102", "1", "p", "01-01-2024 12:00", 20.0, 50.0, 50.0, 0.0, 90.0)]
    columns = [*rules.REQUIRED_FIELDS]
    paths = {name: shared.fresh_path(spark, name) for name in ("sensor_readings", "few", "all", "farm_master")}
    spark.createDataFrame(rows, columns).write.csv(paths["sensor_readings"], header=True)
    spark.createDataFrame([(101,)], "sensor_id int").write.csv(paths["few"], header=True)
    spark.createDataFrame([(101,), (102,)], "sensor_id int").write.csv(paths["all"], header=True)
    spark.createDataFrame([(1, "north")], "farm_id int, farm_name string").write.csv(paths["farm_master"], header=True)
    for master, valid in (("few", 1), ("all", 2)):
        medallion.ingest(lake, {name: paths[name] for name in ("sensor_readings", "farm_master")} | {"sensor_master": paths[master]})
        medallion.refine(lake)
        kept, rejected = lake.read("silver", "valid_sensor"), lake.read("silver", "invalid_sensor")
        assert (kept.count(), rejected.count()) == (valid, 3 - valid)
    described = medallion.describe_readings(kept, lake.read("bronze", "farm_master"))
    assert {r.farm_name for r in described.collect()} == {"north"}


def test_raw_is_scanned_once_and_the_quarantine_is_not_copied(spark, landing, monkeypatch):
    lake = medallion.Lake(spark, shared.fresh_path(spark, "lake"), prefix=f"lake_{uuid.uuid4().hex[:8]}")
    medallion.ingest(lake, landing, {"sensor_readings": sensor_views.RAW_SCHEMA})
    written = []
    replaced = medallion.tables._replaced

    def watched(df, table, *rest):
        written.append((table.rsplit(".", 1)[1], {path.split("/")[-3] for path in df.inputFiles()}))
        return replaced(df, table, *rest)

    monkeypatch.setattr(medallion.tables, "_replaced", watched)
    medallion.refine(lake)
    assert [name for name, _ in written] == ["checked_sensor", "valid_sensor"]
    assert "sensor_readings" in written[0][1] and "sensor_readings" not in written[1][1]
    checked, invalid = (set(lake.read("silver", name).inputFiles()) for name in ("checked_sensor", "invalid_sensor"))
    assert invalid and invalid < checked
    row = lake.read("silver", "invalid_sensor").first()
    assert row.quarantine_status == rules.QUARANTINED and row.quarantine_timestamp is not None and not row.is_valid


def test_no_invalid_rows(spark):
    lake = medallion.Lake(spark, shared.fresh_path(spark, "lake"), prefix=f"lake_{uuid.uuid4().hex[:8]}")
    rows = [(1, "101", "1", "p", "01-01-2024 10:00", 20.0, 50.0, 50.0, 0.0, 90.0)]
    paths = {name: shared.fresh_path(spark, name) for name in ("sensor_readings", "sensor_master")}
    spark.createDataFrame(rows, [*rules.REQUIRED_FIELDS]).write.csv(paths["sensor_readings"], header=True)
    spark.createDataFrame([(101,)], "sensor_id int").write.csv(paths["sensor_master"], header=True)
    medallion.ingest(lake, paths)
    assert medallion.refine(lake).first().asDict() == {"valid_records": 1, "invalid_records": 0, "total_records": 1}
    assert lake.read("silver", "invalid_sensor").count() == 0 and lake.read("silver", "valid_sensor").count() == 1


def test_only_new_files_are_read(spark):
    lake = medallion.Lake(spark, shared.fresh_path(spark, "lake"), prefix=f"lake_{uuid.uuid4().hex[:8]}")
    path = shared.fresh_path(spark, "arriving files")  # a name with a blank
    spark.sql("SELECT 1 AS id, 'a' AS name").coalesce(1).write.csv(path, header=True)
    assert medallion.ingest_new(lake, "things", path) == 1
    assert medallion.ingest_new(lake, "things", path) == 0
    spark.sql("SELECT 2 AS id, 'b' AS name").coalesce(1).write.mode("append").csv(path, header=True)
    for name in spark.table(lake.name("bronze", "things")).select("_source_file").distinct().collect():
        old = name[0].replace("file:", "").replace("%20", " ")
    with open(old, "w") as file:  # were it read again, its new row would appear
        file.write("id,name\n77,changed\n")
    assert medallion.ingest_new(lake, "things", path) == 1
    stored = lake.read("bronze", "things")
    assert sorted((r.id, r.name) for r in stored.collect()) == [(1, "a"), (2, "b")]
    assert stored.select("_source_file").distinct().count() == 2
