from __future__ import annotations

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tripmill import schema
from tripmill.plans import ingest
from tripmill.sources import store, synthetic, tables, trips, weather, zones


def test_date_columns():
    assert trips.date_column(["a", "pickup_datetime", "tpep_pickup_datetime"], "yellow_taxi_trips") == "tpep_pickup_datetime"
    assert trips.date_column(["Start_Date", "x"], "fhv_trips") == "Start_Date"
    assert trips.date_column(["a", "b"]) is None


def test_names_match_in_any_case(spark, tmp_path):
    for name in ("NY_2022.csv", "York.csv", "weather.txt", "other.csv"):
        (tmp_path / name).write_text("date,t\n2022-01-01,1\n")
    found = trips.file_paths(spark, str(tmp_path), weather.FILE_TOKENS, "csv")
    assert sorted(p.rsplit("/", 1)[-1] for p in found) == ["NY_2022.csv", "York.csv"]


def test_weather_skips_files_that_do_not_fit(spark, tmp_path):
    (tmp_path / "ny_a.csv").write_text("date,temp\n2021-12-31,1.5\n2022-01-01,2.5\n")
    (tmp_path / "ny_b.csv").write_text("temp,date\n3,2023-06-01\n")
    (tmp_path / "ny_c.csv").write_text("rain\n1\n")
    (tmp_path / "ny_d.csv").write_text("date,temp\n2023-01-01,warm\n")
    table, report = weather.load_weather(spark, str(tmp_path))
    status = {r.file: (r.status.split(":")[0], r.rows) for r in report.collect()}
    assert status == {"ny_a.csv": ("loaded", 2), "ny_b.csv": ("loaded", 1), "ny_c.csv": ("skipped", 0), "ny_d.csv": ("skipped", 0)}
    assert weather.weather_date_column(table) == "date"
    assert weather.weather_in_years(table, 2022, 2024).count() == 2


def test_weather_jobs_do_not_grow_with_the_files(spark, tmp_path):
    for i in range(12):
        (tmp_path / f"ny_{i:02d}.csv").write_text('date,temp,"wind, gusts"\n' + "".join(f"2022-01-{d:02d},{i if i else 0.5},{d}\n" for d in range(1, i + 2)))
    (tmp_path / "ny_99.csv").write_text("\n")
    (tmp_path / "ny_98.csv").write_text("a,A\n1,2\n")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        spark.sparkContext.setJobGroup("weather", "")
        table, report = weather.load_weather(spark, str(tmp_path))
        jobs = len(spark.sparkContext.statusTracker().getJobIdsForGroup("weather"))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert jobs <= 4  # one lists the files, one reads headers, one values
    assert table.dtypes == [("date", "date"), ("temp", "double"), ("wind, gusts", "int")]
    status = {r.file: (r.status, r.rows) for r in report.collect()}
    assert status.pop("ny_99.csv") == ("skipped: no columns", 0) and status.pop("ny_98.csv") == ("skipped: repeated columns", 0)
    assert status == {f"ny_{i:02d}.csv": ("loaded", i + 1) for i in range(12)}
    assert table.count() == sum(range(1, 13)) and table.agg(F.sum("temp")).first()[0] == 0.5 + sum(i * (i + 1) for i in range(1, 12))


def test_no_weather_files(spark, tmp_path):
    table, report = weather.load_weather(spark, str(tmp_path))
    assert table is None and report.count() == 0


@pytest.fixture
def trip_folder(spark, tmp_path):
    def write(kind, name, column, days, extra=None):
        df = spark.createDataFrame([(d, 10.0, 2.0) for d in days], f"{column} timestamp_ntz, fare_amount double, trip_distance double")
        if extra:
            df = df.withColumn(extra, F.lit(1))
        target = tmp_path / "parts" / f"{kind}_{name}"
        df.coalesce(1).write.parquet(str(target))
        part = next(target.glob("part-*.parquet"))
        (tmp_path / "trips").mkdir(exist_ok=True)
        (tmp_path / "trips" / f"{kind}_tripdata_{name}.parquet").write_bytes(part.read_bytes())

    day = datetime
    write("yellow", "old", "tpep_pickup_datetime", [day(2019, 1, 1), day(2020, 1, 1)])
    write("yellow", "edge", "tpep_pickup_datetime", [day(2021, 12, 31), day(2022, 1, 1), None])
    write("yellow", "new", "tpep_pickup_datetime", [day(2023, 1, 1)], "airport_fee")
    write("green", "new", "lpep_pickup_datetime", [day(2024, 3, 1)], "ehail_fee")
    write("fhvhv", "new", "pickup_datetime", [day(2023, 3, 1)])
    return str(tmp_path / "trips")


def test_files_outside_the_years_are_not_read(spark, trip_folder):
    yellow = trips.scan_years(spark, trip_folder, "yellow_taxi_trips", 2022, 2024)
    pushed = yellow._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [Or(IsNull(tpep_pickup_datetime)" in pushed
    assert yellow.count() == 3 and "airport_fee" in yellow.columns
    assert trips.scan_years(spark, trip_folder, "yellow_taxi_trips", 2030, 2031).where("tpep_pickup_datetime IS NOT NULL").count() == 0


def test_a_trip_requested_before_the_years_and_made_in_them(spark, tmp_path):
    rows = [(datetime(2021, 12, 31, 23, 55), datetime(2022, 1, 1, 0, 5))]
    df = spark.createDataFrame(rows, "request_datetime timestamp_ntz, pickup_datetime timestamp_ntz")
    df.coalesce(1).write.parquet(str(tmp_path / "fhvhv_tripdata_2021"))
    part = next((tmp_path / "fhvhv_tripdata_2021").glob("part-*.parquet"))
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "fhvhv_tripdata_2021.parquet").write_bytes(part.read_bytes())
    assert ingest.load_trips(spark, str(tmp_path / "in"), 2022, 2024)["hvfhv_trips"].count() == 1


def test_drifted_types_spaces_and_unreadable_files(spark, tmp_path):
    folder = tmp_path / "a b"
    folder.mkdir()
    for name, kind in (("yellow_tripdata one.parquet", "bigint"), ("yellow_tripdata_two.parquet", "double")):
        rows = spark.sql(f"SELECT TIMESTAMP_NTZ '2023-05-05' AS tpep_pickup_datetime, CAST(2 AS {kind}) AS passenger_count")
        rows.coalesce(1).write.parquet(str(tmp_path / name))
        (folder / name).write_bytes(next((tmp_path / name).glob("part-*.parquet")).read_bytes())
    loaded = ingest.load_trips(spark, str(folder), 2022, 2024)["yellow_taxi_trips"]
    assert dict(loaded.dtypes)["passenger_count"] == "double" and loaded.agg(F.sum("passenger_count")).first()[0] == 4.0
    (folder / "yellow_tripdata_bad.parquet").write_bytes(b"no parquet")
    loaded = ingest.load_trips(spark, str(folder), 2022, 2024)["yellow_taxi_trips"]
    assert loaded.count() == 2
    report = {r.file: r.status.split(":")[0] for r in trips.file_report(spark, str(folder), "yellow_taxi_trips").collect()}
    assert report == {"yellow_tripdata one.parquet": "loaded", "yellow_tripdata_two.parquet": "loaded", "yellow_tripdata_bad.parquet": "failed"}


def test_partition_columns_stay(spark, tmp_path):
    rows = spark.sql("SELECT TIMESTAMP_NTZ '2023-05-05' AS pickup_datetime, 1 AS x UNION ALL SELECT TIMESTAMP_NTZ '2020-05-05', 2")
    ingest.write_by_month({"yellow": rows}, str(tmp_path / "m"))
    found = trips.scan_years(spark, str(tmp_path / "m"), "part", 2022, 2024)
    assert found.select("x", "year", "month").collect() == [(1, 2023, 5)]
    assert "PartitionFilters: []" not in found._jdf.queryExecution().executedPlan().toString()


def test_text_dates_of_weather(spark):
    df = spark.createDataFrame([("2021-05-05 01:00:00", 1), ("2023-05-05", 2), ("unknown", 3), (None, 4)], "obs_date string, t int")
    assert sorted(r.t for r in weather.weather_in_years(df, 2022, 2024).collect()) == [2, 3, 4]
    with pytest.raises(ValueError, match="obs_date"):
        weather.weather_in_years(df.select(F.col("t").alias("obs_date")), 2022, 2024)


def test_lookup_column_rules():
    assert zones.lookup_columns(["service_zone", "Zone", "Borough", "LocationID"]) == {"Zone": "Zone", "Borough": "Borough", "LocationID": "LocationID"}
    assert zones.lookup_columns(["zoneArea", "the_borough", "place_id"]) == {"Zone": "zoneArea", "Borough": "the_borough", "LocationID": "place_id"}
    with pytest.raises(ValueError, match="Zone"):
        zones.lookup_columns(["a_zone", "b_zone"])


def test_ingest_tables_views_and_reports(spark, trip_folder, tmp_path):
    loaded = ingest.load_trips(spark, trip_folder, 2022, 2024)
    assert set(loaded) == {"yellow_taxi_trips", "green_taxi_trips", "hvfhv_trips"}
    assert {name: df.count() for name, df in loaded.items()} == {"yellow_taxi_trips": 3, "green_taxi_trips": 1, "hvfhv_trips": 1}
    views = ingest.create_views(loaded)
    assert list(views) == ["all_taxi_trips"]
    assert spark.table("all_taxi_trips").columns == ["fare_amount", "trip_distance"]
    quality, months = ingest.verify(loaded, 2022, 2024)
    assert quality.filter("metric = 'rows'").count() == 3 and set(months) == set(loaded)
    removed = {r.table: r.rows_removed for r in ingest.load_report({"yellow_taxi_trips": trips.scan_trips(spark, trip_folder, "yellow_taxi_trips")}, 2022, 2024).collect()}
    assert removed == {"yellow_taxi_trips": 3}
    ingest.write_by_month(loaded, str(tmp_path / "monthly"))
    assert spark.read.parquet(str(tmp_path / "monthly")).filter("year = 2023").count() == 2


def test_rows_of_files_without_dates_stay(spark):
    df = spark.sql("SELECT * FROM VALUES ('a', TIMESTAMP_NTZ '2000-01-01'), ('b', NULL), ('c', TIMESTAMP_NTZ '2022-05-05') AS t(file, d)")
    kept = trips.rows_of_overlapping_files(df, "d", "file", 2022, 2024)
    assert {r.file for r in kept.collect()} == {"b", "c"}
    assert trips.rows_of_overlapping_files(df, None, "file", 2022, 2024) is df


def test_zone_squares(spark, tmp_path):
    features = zones.zone_features(spark)
    rows = features.orderBy("properties.LocationID").collect()
    assert [r.properties.LocationID for r in rows] == list(range(1, 26))
    first, last = rows[0], rows[-1]
    assert (first.properties.Borough, last.properties.Zone) == ("Manhattan", "New Dorp")
    ring = first.geometry.coordinates[0]
    assert len(ring) == 5 and ring[0] == ring[4] == [-74.05, 40.6]
    assert last.geometry.coordinates[0][0] == pytest.approx([-74.05 + 0.2 + 0.01, 40.6 + 0.16 + 0.01])
    zones.write_features(features, str(tmp_path / "geo"))
    assert spark.read.json(str(tmp_path / "geo")).count() == 25
    zones.write_lookup(zones.feature_lookup(features), str(tmp_path / "lookup"))
    assert zones.read_lookup(spark, str(tmp_path / "lookup")).filter("LocationID = 15 and Zone = 'JFK Airport'").count() == 1


def test_lookup_from_other_columns(spark):
    assert zones.derive_lookup(spark.createDataFrame([("x",)], "name string")) is None
    row = zones.derive_lookup(spark.createDataFrame([("b",), ("a",)], "zone string")).orderBy("LocationID").first()
    assert tuple(row) == (1, "Unknown", "a")


def test_catalog_tables(spark):
    tables.create_trip_table(spark, "trip_table")
    rows = synthetic.synthetic_trips(synthetic.trip_ids(spark, 30))
    tables.insert_trips(rows.withColumn("passenger_count", F.col("passenger_count").cast("string")), "trip_table")
    assert spark.table("trip_table").count() == 30
    tables.insert_trips(spark.range(120_000).selectExpr("CAST(id AS INT) AS id"), "trip_table")
    assert spark.table("trip_table").count() == 120_030
    assert tables.get_data(spark, "trip_table").count() == 120_030
    assert tables.table_columns(spark, "trip_table", "no_such_table").count() == len(schema.TRIP_SCHEMA.fields)
    assert tables.get_sample(spark, "trip_table", 5).count() == 5
    assert tables.get_sample(spark, "no_such_table", 5).count() == 0
    with pytest.raises(ValueError):
        tables.get_data(spark, "no_such_table")
    tables.create_trip_table(spark, "trip_table")
    assert spark.table("trip_table").count() == 0
    tables.replace_table(rows.limit(3), "trip_table")
    assert spark.table("trip_table").count() == 3
    spark.sql("DROP TABLE trip_table")


def test_synthetic_trips_do_not_depend_on_partitions(spark):
    ids = synthetic.trip_ids(spark, 200)
    one = synthetic.synthetic_trips(ids.coalesce(1))
    assert one.exceptAll(synthetic.synthetic_trips(ids.repartition(7))).count() == 0
    ranges = one.agg(F.min("trip_distance"), F.max("trip_distance"), F.min("passenger_count"), F.max("passenger_count")).first()
    assert ranges[0] >= 0.5 and ranges[1] <= 20 and (ranges[2], ranges[3]) == (1, 6)
    assert set(schema.TRIP_SCHEMA.names) == set(one.columns)


def test_metadata_defaults(spark, tmp_path):
    path = str(tmp_path / "metadata")
    assert store.load_metadata(spark, path)["fare_categories"] == ["low", "medium", "high"]
    store.save_metadata(spark, path, {"fare_categories": ["low"]})
    assert store.load_metadata(spark, path) == {"fare_categories": ["low"]}
    assert store.load_model(spark, str(tmp_path / "none")) is None
