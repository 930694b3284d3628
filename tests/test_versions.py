"""Versioned tables: readers between the steps, runs that break, writers that meet."""

import pytest
from pyspark.sql import functions as F

from cyclograph.sources import sinks
from cyclograph.sources.versions import LostRace, VersionedTable


@pytest.fixture
def table(spark, tmp_path):
    made = VersionedTable(spark, str(tmp_path / "t"), ["day"])
    made.overwrite(spark.range(30).selectExpr("id", "id % 3 AS day"))
    return made


def ids(df):
    return sorted(r["id"] for r in df.collect())


def test_names_and_empty_tables(spark, tmp_path):
    odd = spark.sql("SELECT explode(array('x y', 'p:q%', 'é', NULL, '7')) AS a, 1 AS b, map('k', 2) AS c")
    table = VersionedTable(spark, str(tmp_path / "odd"), ["a", "b"])
    manifest = table.overwrite(odd)
    assert manifest.written == {"write 1": 5} and len(manifest.parts) == 5
    assert table.read().dtypes == odd.dtypes and sorted(map(str, table.read().collect())) == sorted(map(str, odd.collect()))
    assert table.overwrite(odd.limit(0)).written == {} and table.read().count() == 0
    with pytest.raises(ValueError, match="never written"):
        VersionedTable(spark, str(tmp_path / "none")).read()


def test_replaced_and_emptied_partitions(spark, table):
    before = table.read()
    table.replace(spark.createDataFrame([(100, 1), (101, 5)], "id bigint, day bigint"), ["day=0"])
    assert ids(table.read()) == sorted([*range(2, 30, 3), 100, 101])
    assert ids(before) == list(range(30))  # a reader that began earlier
    assert table.current().written == {"write 1": 30, "write 2": 2}


def test_a_day_is_old_or_new_between_the_steps_of_a_compaction(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "s")
    rows = spark.range(20).selectExpr("id", "timestamp'2024-05-01' + make_interval(0, 0, 0, cast(id % 2 AS int)) AS at")
    for batch in range(4):
        sinks.BatchAppender(path, "at")(rows.filter(F.col("id") % 4 == batch), batch)
    seen = []
    for step in ("stage", "commit"):
        real = getattr(VersionedTable, step)

        def watched(self, *args, _real=real, **kwargs):
            seen.append(ids(sinks.status_table(spark, path).read()))
            out = _real(self, *args, **kwargs)
            seen.append(ids(sinks.status_table(spark, path).read()))
            return out

        monkeypatch.setattr(VersionedTable, step, watched)
    assert sinks.compact(spark, path, "2024-05-03") == ["2024-05-01", "2024-05-02"]
    assert seen == [list(range(20))] * 4


def test_a_failed_rename_changes_nothing(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "s")
    rows = spark.range(10).selectExpr("id", "timestamp'2024-05-01' AS at")
    for batch in range(2):
        sinks.BatchAppender(path, "at")(rows.filter(F.col("id") % 2 == batch), batch)
    real = VersionedTable._publish

    def failing(self, manifest):
        raise OSError("the store is away")

    monkeypatch.setattr(VersionedTable, "_publish", failing)
    with pytest.raises(OSError):
        sinks.compact(spark, path, "2024-05-02")
    assert ids(sinks.status_table(spark, path).read()) == list(range(10))
    monkeypatch.setattr(VersionedTable, "_publish", real)
    assert sinks.compact(spark, path, "2024-05-02") == ["2024-05-01"]
    assert ids(sinks.status_table(spark, path).read()) == list(range(10))


def test_an_upsert_cut_off_between_write_and_commit(spark, table, monkeypatch):
    changes = spark.createDataFrame([(1, 1), (500, 1)], "id bigint, day bigint")
    real = VersionedTable.commit

    def broken(self, *args, **kwargs):
        raise KeyboardInterrupt

    monkeypatch.setattr(VersionedTable, "commit", broken)
    with pytest.raises(KeyboardInterrupt):
        sinks.upsert_partitions(spark, table.path, changes, ["id", "day"], "id", "day")
    assert ids(table.read()) == list(range(30))
    monkeypatch.setattr(VersionedTable, "commit", real)
    sinks.upsert_partitions(spark, table.path, changes, ["id", "day"], "id", "day")
    assert ids(table.read()) == [*range(30), 500]


def test_only_one_of_two_writers_commits(spark, table):
    base = table.current()
    rows = table.read(base).withColumn("id", F.col("id") + 100)
    table.replace(rows.filter("day = 1"), base=base)
    with pytest.raises(LostRace):
        table.replace(rows.filter("day = 2"), base=base)
    assert table.current().number == 2 and table.read().count() == 30


def test_vacuum_leaves_what_recent_versions_name(spark, table, tmp_path):
    for k in range(3):
        table.replace(spark.createDataFrame([(k, 1)], "id bigint, day bigint"))
    unfinished = table.stage(spark.createDataFrame([(9, 9)], "id bigint, day bigint"), "cut off")
    older = table.history()[-2]
    assert len(table.vacuum(2)) == 2
    assert ids(table.read(older))[0] == 0 and (tmp_path / "t" / unfinished.folders[0]).exists()
    assert [m.number for m in table.history()] == [3, 4] and table.vacuum(2) == []


def test_recorded_results_rewrite_the_touched_days_only(spark, tmp_path):
    path = str(tmp_path / "r")
    rows = spark.range(40).selectExpr(
        "concat('run', id % 4) AS invocation_id", "id", "timestamp'2024-05-01' + make_interval(0, 0, 0, cast(id % 4 AS int)) AS at"
    )
    sinks.record_results(rows, path, day="at")
    before = set(sinks.results_table(spark, path).current().parts)
    gone = spark.createDataFrame([("run1",), ("run7",)], "invocation_id string")
    sinks.record_results(rows.filter("invocation_id = 'run0' AND id < 8"), path, gone, day="at")
    kept = sinks.results_table(spark, path).read()
    assert ids(kept) == sorted([0, 4, *range(2, 40, 4), *range(3, 40, 4)])
    after = set(sinks.results_table(spark, path).current().parts)
    assert len(after) == 3 and {f.split("/")[0] for f in before & after} == {"recorded_day=2024-05-03", "recorded_day=2024-05-04"}
