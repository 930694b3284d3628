"""The command line jobs."""

from pyspark.sql import functions as F

from cyclograph.__main__ import main
from cyclograph.sources import fixtures

FOLDER = "/root/testdata/sf0.001"


def test_clean_incidents(spark, tmp_path, capsys):
    source, target = str(tmp_path / "in"), str(tmp_path / "out")
    fixtures.landed_incidents(spark, FOLDER).withColumnRenamed("unique_key", "id").write.parquet(source)
    assert main(["clean-incidents", source, target]) == 0
    cleaned = spark.read.parquet(target)
    assert f"{cleaned.count()} rows written" in capsys.readouterr().out
    assert cleaned.count() == cleaned.select("id").distinct().count()
    assert {r[0] for r in cleaned.select("primary_type").distinct().collect()} == {"A", "N", "R"}
    assert main(["clean-incidents", source, target, "--files", "0"]) == 0


def test_load_trips_replaces_months(spark, tmp_path, capsys):
    folder, target = tmp_path / "in", str(tmp_path / "out")
    header = (
        "ride_id,rideable_type,started_at,ended_at,start_station_name,start_station_id,end_station_name,"
        "end_station_id,start_lat,start_lng,end_lat,end_lng,member_casual"
    )
    folder.mkdir()
    for month, n in (("202401", 2), ("202402", 3), ("202403", 1)):
        lines = [f"r{month}{i},classic,2024-01-05 10:00:00,2024-01-05 10:09:30,,,,,,,,,member" for i in range(n)]
        (folder / f"{month}-trips.csv").write_text("\n".join([header, *lines]) + "\n")
    assert main(["load-trips", str(folder), target, "--from", "202402", "--dry-run"]) == 0
    assert [line[-16:] for line in capsys.readouterr().out.splitlines()] == ["202402-trips.csv", "202403-trips.csv"]
    assert main(["load-trips", str(folder), target]) == 0
    assert main(["load-trips", str(folder), target, "--month", "202402"]) == 0
    loaded = spark.read.parquet(target).groupBy("source_month").agg(F.count("*").alias("n"))
    assert {str(r["source_month"]): r["n"] for r in loaded.collect()} == {"202401": 2, "202402": 3, "202403": 1}


def test_one_broken_month_does_not_stop_the_others(spark, tmp_path, capsys):
    folder, target = tmp_path / "in", str(tmp_path / "out")
    folder.mkdir()
    header = "ride_id,rideable_type,started_at,ended_at,start_station_name,start_station_id,end_station_name,end_station_id,start_lat,start_lng,end_lat,end_lng,member_casual"
    for month in ("202401", "202403"):
        (folder / f"{month}-trips.csv").write_text(f"{header}\nr{month},classic,2024-01-05 10:00:00,2024-01-05 10:09:30,,,,,,,,,member\n")
    (folder / "202402-trips.csv").write_bytes(b"ride_id\nx\n")
    assert main(["load-trips", str(folder), target]) == 1
    out = capsys.readouterr().out.splitlines()
    assert [line.split()[0] for line in out] == ["loaded", "FAIL", "loaded"]
    months = {str(r[0]) for r in spark.read.parquet(target).select("source_month").distinct().collect()}
    assert months == {"202401", "202403"}


def test_landing_to_model(spark, tmp_path):
    """Clean, then build from what was cleaned: the jobs chain without renaming anything by hand."""
    landed, cleaned, trips, areas = (str(tmp_path / n) for n in ("landed", "cleaned", "trips", "areas"))
    fixtures.landed_incidents(spark, FOLDER).withColumnRenamed("unique_key", "id").write.parquet(landed)
    fixtures.landed_trips(spark, FOLDER).write.parquet(trips)
    fixtures.area_seed(spark, FOLDER).write.csv(areas, header=True)
    assert main(["clean-incidents", landed, cleaned]) == 0
    assert main(["build", cleaned, trips, areas, str(tmp_path / "model"), "--first-year", "1996", "--trained-before", "2000-01-01"]) in (0, 1)
    assert spark.read.parquet(str(tmp_path / "model" / "mart" / "station_day")).count() > 1000
