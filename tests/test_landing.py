"""Landing rules, sinks, streaming with restart, and the whole build."""

import json
from pathlib import Path
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from cyclograph import session
from cyclograph.plans import build, dashboards, marts, staging
from cyclograph.sources.versions import VersionedTable
from cyclograph.sources import fixtures, landing, sinks
from cyclograph.streaming import station_status as live

FOLDER = "/root/testdata/sf0.001"


# --- sources -----------------------------------------------------------------------


def test_month_selection():
    files = ["/in/202403-trips.csv", "/in/202401-trips.csv", "/in/readme-1.csv", "/in/20240-x.csv", "/in/k=202402-trips"]
    assert landing.select_months(files) == ["/in/202401-trips.csv", "/in/k=202402-trips", "/in/202403-trips.csv"]
    assert landing.select_months(files, month="202403") == ["/in/202403-trips.csv"]
    assert landing.select_months(files, first="202402", last="202403") == ["/in/k=202402-trips", "/in/202403-trips.csv"]
    assert landing.select_months(files, first="202404") == []


def test_trip_files(spark, tmp_path):
    header = "ride_id,rideable_type,started_at,ended_at,start_station_name,start_station_id,end_station_name,end_station_id,start_lat,start_lng,end_lat,end_lng,member_casual"
    (tmp_path / "202401-trips.csv").write_text(
        f"{header}\nr1,classic,2024-01-05 10:00:00,2024-01-05 10:09:30,A,007,B,x-1,41.9,-87.6,41.8,-87.7,member\n"
        "r2,electric,not a time,1/5/2024 9:05,,,,,,,,,casual\n"
    )
    (tmp_path / "202402-trips.csv").write_text(f"{header}\nr3,classic,2024-02-01 00:00:00.250,2024-02-01 00:01:00,,,,,,,,,member\n")
    paths = landing.select_months(landing.list_folder(spark, str(tmp_path)))
    rows = {r["ride_id"]: r for r in landing.read_trip_files(spark, paths).collect()}
    assert rows["r1"]["start_station_id"] == "007" and rows["r1"]["source_month"] == "202401"
    assert rows["r2"]["started_at"] is None and rows["r2"]["start_lat"] is None
    assert str(rows["r2"]["ended_at"]) == "2024-01-05 09:05:00"
    assert rows["r3"]["source_month"] == "202402" and rows["r3"]["started_at"].microsecond == 250000
    facts = marts.trip_facts(staging.stage_trips(landing.read_trip_files(spark, paths)))
    assert {r["ride_id"]: r["trip_duration_seconds"] for r in facts.collect()} == {"r1": 570, "r3": 59}


def test_incident_normalisation(spark):
    feed = spark.createDataFrame(
        [("1", "41.9", "TRUE", "x", "7"), ("2", "north", "maybe", "y", None)],
        "id string, latitude string, arrest string, location string, `:@computed_region_ab` string",
    )
    rows = landing.normalize_incidents(feed).collect()
    assert rows[0].asDict() == {"id": "1", "latitude": 41.9, "arrest": True}
    assert rows[1].asDict() == {"id": "2", "latitude": None, "arrest": None}


def test_feed_messages_keep_the_whole_entry(spark):
    feed = {"last_updated": 1, "data": {"stations": [{"station_id": "a", "extra": {"n": 1}}, {"station_id": ""}, {"n": 2}]}}
    bodies = spark.createDataFrame([(json.dumps(feed),), ("{broken",)], "value string")
    rows = landing.station_messages(bodies).collect()
    assert [(r["key"], json.loads(r["value"])) for r in rows] == [("a", {"station_id": "a", "extra": {"n": 1}})]


# --- cleaning ----------------------------------------------------------------------


def incidents(spark, rows):
    names = "unique_key string, updated_on timestamp, latitude double, longitude double, year bigint, case_number string"
    rest = {
        c: F.lit(None).cast("string")
        for c in ("date", "primary_type", "description", "location_description", "community_area", "district", "ward")
    }
    frame = spark.createDataFrame(rows, names).withColumns(rest)
    return frame.withColumns({"arrest": F.lit(True), "domestic": F.lit(False)})


def test_staging_filters_before_it_deduplicates(spark):
    from datetime import datetime as at

    rows = [
        ("1", at(2024, 1, 2), 45.0, -87.6, 2024, "newer, outside"),
        ("1", at(2024, 1, 1), 41.9, -87.6, 2024, "older, inside"),
        ("2", at(2024, 1, 1), None, None, 2024, "no position"),
        ("3", at(2024, 1, 1), 41.9, None, 2024, "half a position"),
        ("4", at(2024, 1, 1), 41.9, -87.6, 2017, "too early"),
        ("5", None, 41.9, -87.6, 2024, "never updated"),
        ("5", at(2024, 1, 1), 41.9, -87.6, 2024, "updated"),
        ("x", at(2024, 1, 1), 41.9, -87.6, 2024, "bad key"),
    ]
    staged = staging.stage_incidents(incidents(spark, rows))
    assert {r["case_number"] for r in staged.collect()} == {"older, inside", "no position", "updated", "bad key"}
    assert {r["crime_id"] for r in marts.incident_facts(staged).collect()} == {1, 2, 5}


def test_missing_ingest_time_wins(spark):
    raw = fixtures.raw_station_status(spark, FOLDER)
    staged = staging.stage_station_status(raw)
    again = staged.filter("kafka_offset % 21 = 0")
    assert again.filter("ingested_at IS NOT NULL").count() == 0
    assert again.filter("num_bikes_disabled <> 99").count() == 0
    assert staged.count() == raw.select("kafka_partition", "kafka_offset").distinct().count()


def test_composite_key_is_null_with_a_missing_part(spark):
    staged = spark.sql(
        "SELECT 1L AS crime_id, CAST(NULL AS TIMESTAMP) AS occurred_at, 1L AS community_area_id, 'A' AS primary_type,"
        " CAST(NULL AS STRING) AS description, true AS arrest, true AS domestic, 1D AS latitude, 1D AS longitude,"
        " 1L AS district_id, 1L AS ward_id, 2024L AS year"
    )
    assert marts.incident_facts(staged).first()["crime_type_key"] is None
    assert marts.incident_types(staged).count() == 0


# --- sinks -------------------------------------------------------------------------


def test_verified_write_is_idempotent(spark, tmp_path):
    path = str(tmp_path / "out")
    for n in (100, 50):
        assert sinks.write_files(spark.range(n), path, files=3) == n
        assert sinks.verify_written(spark, path, n)
    assert not sinks.verify_written(spark, path, 51)
    assert sinks.write_files(spark.range(10), path, files=None) == 10


def test_partitioned_write_prunes(spark, tmp_path):
    path = str(tmp_path / "mart")
    rows = spark.range(1000).select(F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") % 10).cast("int")).alias("day"), "id")
    sinks.write_partitioned(rows, path, "day", ["id"])
    read = spark.read.parquet(path).filter("day = DATE'2024-01-03'")
    assert read.count() == 100
    assert "PartitionFilters: [isnotnull(day#" in read._jdf.queryExecution().toString()
    assert len(list((tmp_path / "mart" / "day=2024-01-03").glob("*.parquet"))) == 1


def test_month_folders_prune_days(spark, tmp_path):
    """Only the wanted month's files are opened, and few files are written."""
    path = str(tmp_path / "mart")
    rows = spark.range(20_000).select(F.date_add(F.lit("2024-01-15").cast("date"), (F.col("id") % 300).cast("int")).alias("day"), "id")
    sinks.write_by_month(rows, path, "day", ["id"])
    assert sinks.read_by_month(spark, path, rows.schema, "day").exceptAll(rows).isEmpty()
    part = sinks.read_by_month(spark, path, rows.schema, "day", "2024-03-10", "2024-04-02")
    assert part.agg(F.min("day"), F.max("day"), F.countDistinct("day")).first()[2] == 24
    assert part.count() == rows.filter("day BETWEEN DATE'2024-03-10' AND DATE'2024-04-02'").count()
    opened = {r[0] for r in part.select(F.input_file_name()).distinct().collect()}
    assert {name.split("day_month=")[1].split("/")[0] for name in opened} == {"2024-03", "2024-04"}
    assert len(list((tmp_path / "mart").rglob("*.parquet"))) <= 2 * 11
    assert "PartitionFilters: [isnotnull(day_month#" in part._jdf.queryExecution().toString()
    moments = rows.withColumn("day", F.col("day").cast("timestamp") + F.expr("INTERVAL 20 HOURS"))
    sinks.write_by_month(moments, path + "2", "day")
    assert sinks.read_by_month(spark, path + "2", moments.schema, "day", last="2024-01-15").count() == rows.filter("day = DATE'2024-01-15'").count()


def test_batches_replay_and_compact(spark, tmp_path):
    """Over a hundred batches, most of them empty; replays do no harm, and the ledger outlives the sink."""
    path = str(tmp_path / "status")
    sink = sinks.BatchAppender(path, "at")
    rows = spark.range(40).selectExpr("id", "timestamp'2024-05-01' + make_interval(0, 0, 0, cast(id % 4 AS int)) AS at")
    for batch in range(110):
        sink(rows.filter(f"id DIV 10 = {batch}") if batch < 4 else rows.limit(0), batch)
    assert sinks.arrived_rows(spark, path) == 40 and live.has_new_data(spark, path, 0)
    sinks.BatchAppender(path, "at")(rows.filter("id DIV 10 = 3"), 3)
    assert not live.has_new_data(spark, path, 40)
    stored = lambda: sorted(r["id"] for r in sinks.status_table(spark, path).read().collect())
    assert stored() == list(range(40))
    assert sinks.compact(spark, path, "2024-05-04") == ["2024-05-01", "2024-05-02", "2024-05-03"]
    assert stored() == list(range(40)) and sinks.arrived_rows(spark, path) == 40
    assert sinks.compact(spark, path, "2024-05-04") == []
    table = sinks.status_table(spark, path)
    assert len(table.vacuum(1)) == 4 * 3 + 4 and stored() == list(range(40))
    assert len(list((tmp_path / "status").rglob("table_version=*"))) == 3 + 4
    assert not live.has_new_data(spark, str(tmp_path / "elsewhere"), 0)


def test_recording_results_replaces_an_invocation(spark, tmp_path):
    path = str(tmp_path / "results")

    def document(run, *statuses):
        results = [
            {"unique_id": f"test.shop.unique.a{i}.ff", "status": s, "failures": i, "execution_time": 0.5}
            for i, s in enumerate(statuses)
        ]
        results += [{"unique_id": "model.shop.x", "status": "success"}, {"unique_id": "test.shop.bare", "status": "pass"}]
        return json.dumps({"metadata": {"invocation_id": run, "generated_at": "2024-01-01T00:00:00Z"}, "results": results})

    def record(*documents):
        frame = spark.createDataFrame([(d,) for d in documents], "value string")
        sinks.record_results(sinks.test_results(frame), path)

    record(document("one", "pass", "fail"), document("two", "pass"), '{"metadata": {}, "results": []}')
    record(document("one", "warn"))
    table = sinks.results_table(spark, path)
    rows = table.read().collect()
    found = sorted((r["invocation_id"], r["test_name"], r["status"]) for r in rows)
    assert found == [
        ("one", "test.shop.bare", "pass"),
        ("one", "unique.a0", "warn"),
        ("two", "test.shop.bare", "pass"),
        ("two", "unique.a0", "pass"),
    ]
    outcome = dashboards.latest_test_outcomes(table.read()).first()
    assert tuple(outcome) == (3, 0, 1)
    assert tuple(dashboards.latest_test_outcomes(table.read().limit(0)).first()) == (0, 0, 0)


def test_partitioned_upsert(spark, tmp_path):
    path = str(tmp_path / "t")
    start = spark.createDataFrame([(1, "d1", "a", 1), (2, "d1", "b", 1), (3, "d2", "c", 1)], "k int, day string, v string, version int")
    table = VersionedTable(spark, path, ["day"])
    table.overwrite(start)
    untouched = sorted((tmp_path / "t" / "day=d2").iterdir())
    changes = spark.createDataFrame([(1, "d1", "A", 2), (4, "d3", "D", 1)], start.schema)
    sinks.upsert_partitions(spark, path, changes, ["k", "day"], "version", "day")
    rows = table.read()
    assert sorted((r["k"], r["v"]) for r in rows.collect()) == [(1, "A"), (2, "b"), (3, "c"), (4, "D")]
    assert sorted((tmp_path / "t" / "day=d2").iterdir()) == untouched
    with pytest.raises(ValueError):
        sinks.upsert_partitions(spark, path, changes, ["k"], "version", "day")


# --- streaming ---------------------------------------------------------------------


def test_stream_resumes_and_replays_safely(spark, tmp_path):
    source, target, offsets = (str(tmp_path / n) for n in ("in", "out", "offsets"))
    messages = fixtures.status_messages(fixtures.table(spark, FOLDER, "events"))
    first, second = messages.filter("offset < 400"), messages.filter("offset >= 400")
    first.coalesce(1).write.parquet(source)

    def drain():
        stream = live.file_source(spark, source, messages.schema)
        live.start(live.parse_messages(stream), sinks.BatchAppender(target), offsets, once=True).awaitTermination()

    drain()
    assert live.has_new_data(spark, target, 0)
    stored = lambda: sinks.status_table(spark, target).read()
    assert stored().count() == 400
    drain()
    assert not live.has_new_data(spark, target, 400)  # nothing new
    assert stored().count() == 400
    second.coalesce(1).write.mode("append").parquet(source)
    drain()
    assert stored().count() == messages.count()
    assert stored().select("batch_id").distinct().count() == 2

    # A batch delivered twice replaces itself.
    again = live.parse_messages(second)
    sinks.BatchAppender(target)(again, 1)
    assert stored().count() == messages.count()
    sinks.BatchAppender(target)(again.limit(0), 2)  # empty batches leave no trace
    assert stored().select("batch_id").distinct().count() == 2


def test_parse_and_staleness(spark):
    body = '{"station_id": "s1", "num_bikes_available": 3, "is_renting": 0, "is_returning": 1, "last_reported": %d}'
    rows = [
        (body % 1_700_000_000, 0),
        (body % 1_699_996_401, 1),
        (body % 1_699_996_400, 2),  # exactly one hour old
        (body % 86400, 3),
        ("{broken", 4),
        ('{"station_id": "s2"}', 5),
    ]
    records = spark.createDataFrame(rows, "value string, offset bigint").select(
        F.col("value").cast("binary"), F.lit(0).alias("partition"), "offset", F.current_timestamp().alias("timestamp")
    )
    parsed = live.parse_messages(records)
    by_offset = {r["kafka_offset"]: r for r in parsed.collect()}
    assert (by_offset[0]["is_renting"], by_offset[0]["is_returning"], by_offset[0]["is_installed"]) == (False, True, None)
    assert by_offset[4]["station_id"] is None and by_offset[5]["num_scooters_available"] is None
    fresh = live.drop_stale(parsed, now=F.timestamp_seconds(F.lit(1_700_000_000)))
    assert sorted(r["kafka_offset"] for r in fresh.collect()) == [0, 1]


# --- session and build -------------------------------------------------------------


def stub(**settings):
    """Just the parts of a session that the folder rule looks at."""
    conf = SimpleNamespace(get=lambda key, default=None: settings.get(key, default))
    return SimpleNamespace(conf=conf, sparkContext=SimpleNamespace(applicationId="app-1"))


def test_shared_folder_follows_the_session():
    cluster = stub(**{"spark.checkpoint.dir": "hdfs:///shared/"})
    assert session.shared_folder(cluster) == "hdfs:///shared"
    plain = stub(**{"spark.sql.warehouse.dir": "hdfs:///warehouse/"})
    assert session.shared_folder(plain) == "hdfs:///warehouse/_work/app-1"


def test_nothing_remains_after_a_run(spark):
    with session.work(spark):
        stored = session.materialize(spark.range(5), "run-test")
        folder = Path(stored.inputFiles()[0].removeprefix("file://")).parent
        assert stored.count() == 5 and folder.exists()
    assert not folder.exists()


def test_build_and_contracts(spark, tmp_path):
    """The whole model, with the contracts it should and should not meet."""
    landed = build.Landed(
        incidents=fixtures.landed_incidents(spark, FOLDER),
        trips=fixtures.landed_trips(spark, FOLDER),
        areas=fixtures.area_seed(spark, FOLDER),
        station_status=fixtures.raw_station_status(spark, FOLDER),
    )
    model = build.ModelBuild(spark, str(tmp_path), first_year=1996, trained_before="2000-01-01")
    tables = model.run(landed)
    assert tables["predictions"].count() + tables["training"].count() == tables["station_day"].count()
    direct = marts.station_day(
        marts.trip_facts(staging.stage_trips(landed.trips)),
        marts.stations(staging.stage_trips(landed.trips)),
        marts.incident_facts(staging.stage_incidents(landed.incidents, 1996)),
    )
    assert direct.exceptAll(tables["station_day"].select(*direct.columns)).count() == 0
    outcomes = {r["test_name"]: r for r in model.check((1995, 2001)).collect()}
    assert outcomes["station_day.relationships_date_key"]["status"] == "pass"
    assert outcomes["dates.values_between_year"]["status"] == "pass"
    assert outcomes["incidents.relationships_crime_type_key"]["status"] == "pass"
    assert outcomes["incidents.not_null_crime_type_key"]["status"] == "fail"  # planted missing descriptions
    assert outcomes["station_reads.relationships_date_key"]["status"] == "fail"  # other years
    kept = sinks.results_table(spark, model.path("test_results", "observability")).read()
    assert kept.count() == len(outcomes)
