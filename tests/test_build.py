"""The model build: what a second run writes, and what a broken one leaves."""

import pytest
from pyspark.sql import functions as F

from cyclograph.plans import build
from cyclograph.sources import fixtures

FOLDER = "/root/testdata/sf0.001"
DATED = ("incidents", "trips", "station_day")


def landed(spark, incidents=None, trips=None):
    return build.Landed(
        incidents=fixtures.landed_incidents(spark, FOLDER) if incidents is None else incidents,
        trips=fixtures.landed_trips(spark, FOLDER) if trips is None else trips,
        areas=fixtures.area_seed(spark, FOLDER),
    )


def model_at(spark, path):
    return build.ModelBuild(spark, str(path), first_year=1996, trained_before="2000-01-01")


def folders(model, name):
    return {f.split("/")[0].split("=")[1]: f for f in model.table(name).current().parts}


def same(a, b):
    assert a.keys() == b.keys()
    for name in a:
        if name in ("weights", "evaluation", "predictions", "correlation"):  # sums of doubles
            assert a[name].count() == b[name].count()
        else:
            assert a[name].exceptAll(b[name].select(*a[name].columns)).isEmpty(), name
            assert a[name].count() == b[name].count()


@pytest.fixture(scope="module")
def first(spark, tmp_path_factory):
    model = model_at(spark, tmp_path_factory.mktemp("model") / "m")
    model.run(landed(spark))
    return model


def test_a_run_without_changes_writes_nothing(spark, first):
    before = {n: first.table(n).current() for n in DATED}
    again = model_at(spark, first.root)
    tables = again.run(landed(spark))
    assert again.rebuilt == {} and {n: again.table(n).current() for n in DATED} == before
    same(tables, first.tables)


def test_one_changed_month_rewrites_its_folders_only(spark, tmp_path):
    model = model_at(spark, tmp_path / "m")
    model.run(landed(spark))
    before = {n: folders(model, n) for n in DATED}
    moment = F.col("date").cast("timestamp")
    hit = (F.date_format(moment, "yyyy-MM") == "1997-03") & F.col("latitude").isNotNull() & (F.col("year") >= 1996)
    changed = fixtures.landed_incidents(spark, FOLDER)
    changed = changed.withColumn("arrest", F.when(hit, ~F.col("arrest")).otherwise(F.col("arrest")))
    second = model_at(spark, model.root)
    tables = second.run(landed(spark, incidents=changed))
    assert second.rebuilt["incidents"] == {"1997-03"} == second.rebuilt["station_day"] == second.rebuilt["staging/incidents"]
    assert "trips" not in second.rebuilt and "areas" not in second.rebuilt
    after = {n: folders(second, n) for n in DATED}
    assert after["trips"] == before["trips"]
    for name in ("incidents", "station_day"):
        assert {m for m in after[name] if after[name][m] != before[name].get(m)} == {"1997-03"}
    fresh = model_at(spark, tmp_path / "fresh")
    same(tables, fresh.run(landed(spark, incidents=changed)))


def test_versions_that_move_between_months(spark, tmp_path):
    """The newest version of some records leaves its month, so an older one comes back elsewhere;
    new records come, whole months go."""
    model = model_at(spark, tmp_path / "m")
    model.run(landed(spark))
    rows = fixtures.landed_incidents(spark, FOLDER)
    month = F.date_format(F.col("date").cast("timestamp"), "yyyy-MM")
    moved = rows.filter(month != "1998-06").withColumn(
        "date", F.when(month == "1997-05", F.col("date").cast("timestamp") + F.expr("INTERVAL 40 DAYS")).otherwise(F.col("date").cast("timestamp"))
    )
    moved = moved.withColumn("date", F.col("date").cast(dict(rows.dtypes)["date"]))
    fewer = fixtures.landed_trips(spark, FOLDER).filter("started_at < '1998-01-01' OR started_at >= '1998-02-01'")
    second = model_at(spark, model.root)
    tables = second.run(landed(spark, moved, fewer))
    assert second.rebuilt["trips"] == {"1998-01"} or second.rebuilt["trips"] is None
    assert not {"1997-05", "1998-06"} & folders(second, "incidents").keys() and "1998-01" not in folders(second, "trips")
    fresh = model_at(spark, tmp_path / "fresh")
    same(tables, fresh.run(landed(spark, moved, fewer)))


def test_a_broken_run_is_built_anew(spark, tmp_path, monkeypatch):
    model = model_at(spark, tmp_path / "m")
    model.run(landed(spark))
    changed = fixtures.landed_incidents(spark, FOLDER).filter("year <> 1998")
    real = build.marts.incident_facts
    monkeypatch.setattr(build.marts, "incident_facts", lambda staged: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        model_at(spark, model.root).run(landed(spark, incidents=changed))
    assert model.table("incidents").read().count() == model.tables["incidents"].count()  # readers keep the old table
    monkeypatch.setattr(build.marts, "incident_facts", real)
    third = model_at(spark, model.root)
    third.run(landed(spark, incidents=changed))
    assert third.rebuilt["incidents"] is None
    assert third.tables["incidents"].filter("year = 1998").isEmpty()


def test_steps_wait_for_what_they_need():
    done = []
    steps = {n: (needs, lambda n=n: done.append(n)) for n, needs in {"c": ["a", "b"], "a": [], "b": ["a"], "d": ["c", "elsewhere"]}.items()}
    build.in_dependency_order(steps)
    assert done == ["a", "b", "c", "d"]
    with pytest.raises(ZeroDivisionError):
        build.in_dependency_order({"x": ((), lambda: 1 / 0), "y": (("x",), lambda: done.append("y"))})
    assert "y" not in done
