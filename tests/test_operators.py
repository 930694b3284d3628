"""Operators against brute force, including hot keys, ties and NULLs."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from cyclograph.functions import numeric, text
from cyclograph.functions.casts import guarded_cast
from cyclograph.functions.geo import EARTH_RADIUS_M
from cyclograph.operators import correlation, nearby, ordered, quantiles, ranges
from cyclograph.operators import regression as reg
from cyclograph.operators.dedup import keep_first, upsert
from cyclograph.quality.values import values_to_be_increasing


def distance(a, b):
    (lat1, lng1), (lat2, lng2) = a, b
    p, q = math.radians(lat1), math.radians(lat2)
    h = math.sin((q - p) / 2) ** 2 + math.cos(p) * math.cos(q) * math.sin(math.radians(lng2 - lng1) / 2) ** 2
    return 2 * EARTH_RADIUS_M * math.asin(min(1, math.sqrt(h)))


@pytest.mark.parametrize(
    "lat, lng, spread",
    [(41.88, -87.65, 0.02), (0.0, 10.0, 0.02), (-33.9, 151.2, 0.02), (60.0, 179.999, 0.02), (89.999, 0.0, 0.003), (-89.99, 50.0, 0.02)],
)
def test_distance_join_matches_brute_force(spark, lat, lng, spread):
    rng = random.Random(7)

    def somewhere():
        x = lng + rng.uniform(-spread, spread) / max(math.cos(math.radians(lat)), 1e-4)
        x = (x + 180) % 360 - 180
        return max(-90.0, min(90.0, lat + rng.uniform(-spread, spread))), x

    places = [(i, *somewhere()) for i in range(40)]
    points = [(i, *somewhere()) for i in range(400)]
    expected = {(p[0], q[0]) for p in places for q in points if distance(p[1:], q[1:]) <= 402}
    pairs = nearby.nearby_pairs(
        spark.createDataFrame(places, "place int, lat double, lng double"),
        spark.createDataFrame(points, "point int, lat double, lng double"),
    )
    rows = [(r["place"], r["point"]) for r in pairs.collect()]
    assert len(rows) == len(set(rows)) and set(rows) == expected and expected


def test_distance_join_with_one_hot_cell(spark):
    places = spark.createDataFrame([("a", 41.88, -87.65), ("b", 41.9, -87.65)], "station_id string, lat double, lng double")
    hot = spark.range(20_000).select(
        F.lit("2024-01-01").cast("date").alias("date_key"),
        (F.lit(41.88) + (F.col("id") % 1000) * 1e-7).alias("lat"),
        F.lit(-87.65).alias("lng"),
    )
    nothing = spark.createDataFrame([(None, 41.88, -87.65)], "date_key date, lat double, lng double")
    rows = nearby.nearby_counts(places, hot.unionByName(nothing), "station_id", "date_key").collect()
    assert [(r["station_id"], r["n"]) for r in rows] == [("a", 20_000)]


@pytest.mark.parametrize("lat, lng, radius", [(41.88, -87.65, 402.0), (-60.0, 179.999, 402.0), (79.9, 0.0, 9000.0), (85.0, 10.0, 402.0), (89.999, 0.0, 402.0), (10.0, 20.0, 30_000.0)])
def test_counts_by_cells_match_brute_force(spark, lat, lng, radius):
    rng = random.Random(11)
    spread = 2.2 * math.degrees(radius / EARTH_RADIUS_M)

    def somewhere():
        x = lng + rng.uniform(-spread, spread) / max(math.cos(math.radians(lat)), 1e-4)
        return max(-90.0, min(90.0, lat + rng.uniform(-spread, spread))), (x + 180) % 360 - 180

    places = [(i, *somewhere()) for i in range(12)]
    points = [(f"2024-01-0{1 + i % 2}", *somewhere()) for i in range(1500)]
    points += points[:40]
    expected = {}
    for p in places:
        for day, *at in points:
            if distance(p[1:], at) <= radius:
                expected[p[0], day] = expected.get((p[0], day), 0) + 1
    found = nearby.nearby_counts(
        spark.createDataFrame(places, "place int, lat double, lng double"),
        spark.createDataFrame(points, "day string, lat double, lng double"),
        "place", "day", radius,
    )
    rows = found.collect()
    assert {(r["place"], r["day"]): r["n"] for r in rows} == expected and len(rows) == len(expected)


def test_points_of_a_hot_cell_stay_out_of_the_join(spark):
    """Most points lie within one small cell: its places get one row a day from it, not one a point."""
    day = F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") % 2).cast("int")).alias("date_key")
    hot = spark.range(50_000).select(day, (F.lit(41.88) + F.col("id") * 1e-9).alias("lat"), (F.lit(-87.65) + F.col("id") * 1e-9).alias("lng"))
    elsewhere = spark.range(200).select(day, (F.lit(41.8) + F.col("id") * 1e-3).alias("lat"), F.lit(-87.65).alias("lng"))
    places = spark.range(30).select(F.col("id").alias("p"), (F.lit(41.88) + F.col("id") * 2e-5).alias("lat"), F.lit(-87.65).alias("lng"))
    inner, rim = nearby.matches(places, hot.unionAll(elsewhere), "p", "date_key")
    assert inner.count() + rim.count() < 5000
    counts = nearby.nearby_counts(places, hot, "p", "date_key")
    assert [tuple(r) for r in counts.groupBy("p").sum("n").orderBy("p").collect()] == [(p, 50_000) for p in range(30)]


def test_lookback_counts_earlier_days(spark):
    places = spark.createDataFrame([("a", 41.88, -87.65)], "station_id string, lat double, lng double")
    points = spark.sql(
        "SELECT d AS date_key, 41.88D AS lat, -87.65D AS lng FROM VALUES (DATE'2024-01-01'), (DATE'2024-01-02'), (DATE'2024-01-02') t(d)"
    )
    rows = nearby.nearby_counts(places, points, "station_id", "date_key", lookback_days=1).collect()
    assert {str(r["date_key"]): r["n"] for r in rows} == {"2024-01-01": 1, "2024-01-02": 3, "2024-01-03": 2}


@pytest.mark.parametrize("groups", [[], ["g"]])
def test_ordered_lag_matches_a_plain_window(spark, groups):
    # One group and one sort value hold most rows; values and groups may be NULL.
    rows = spark.range(5000).select(
        F.when(F.col("id") % 3 != 0, F.lit("hot")).when(F.col("id") % 5 == 0, None).otherwise(F.lit("cold")).alias("g"),
        F.when(F.col("id") % 2 == 0, F.lit(7)).otherwise(F.col("id") % 40).alias("s"),
        F.col("id").alias("tie"),
        F.when(F.col("id") % 11 == 0, None).otherwise(F.hash("id") % 100).alias("v"),
    ).repartition(8)
    window = Window.partitionBy(*groups).orderBy("s", "tie")
    expected = (
        rows.withColumn("before", F.lag("v").over(window)).filter("before IS NOT NULL AND NOT (v > before)")
    )
    found = values_to_be_increasing("v", "s", group_by=groups, tiebreak="tie")(rows)
    key = lambda df, b: sorted((r["tie"], r["v"], r[b]) for r in df.collect())
    assert key(found, ordered.PREVIOUS) == key(expected, "before")


def test_ordered_lag_has_no_unpartitioned_window(spark):
    rows = spark.range(100).select("id", (F.col("id") % 7).alias("v"))
    plan = values_to_be_increasing("v", "id")(rows)._jdf.queryExecution().toString()
    assert "SinglePartition" not in plan


@pytest.mark.parametrize("n", [0, 1, 19, 20, 21, 500])
def test_ranges_that_share_their_border_rows(spark, n):
    rows = spark.range(n).select((F.col("id") * 7 % 11).alias("a"), F.when(F.col("id") % 5 > 0, F.col("id")).alias("b"))
    placed = ranges.with_joined_ranges(rows, ["a", "b"], ranges=6).collect()
    own = [r for r in placed if r["__own"]]
    key = lambda r: (r["a"], r["b"] is not None, r["b"] or 0)
    assert sorted(map(key, own)) == sorted(map(key, rows.collect()))
    ends = {r["__range"]: max(key(x) for x in own if x["__range"] == r["__range"]) for r in own}
    begins = {r["__range"]: key(r) for r in placed if not r["__own"]}
    assert all(ends[k - 1] == v for k, v in begins.items()) and len(begins) == max(0, len({r["__range"] for r in placed}) - 1)
    if n == 500:
        assert len(ends) > 3


@pytest.mark.parametrize("reach", [1, 3, 40])
@pytest.mark.parametrize("groups", [[], ["g"]])
def test_ranges_with_the_rows_before_equal_a_plain_window(spark, groups, reach):
    rows = spark.range(400).select(
        F.when(F.col("id") % 4 > 0, F.lit("hot")).when(F.col("id") % 8 > 0, F.lit("cold")).alias("g"),
        F.when(F.col("id") != 77, F.col("id") * 37 % 401).alias("p"),
        (F.col("id") * F.col("id") % 13).alias("v"),
    )
    frame = lambda *by: Window.partitionBy(*by).orderBy("p").rowsBetween(-reach, -1)
    carried = ranges.with_rows_before(rows, [*groups, "p"], reach, ranges=8)
    assert carried.select("__range").distinct().count() > 4
    found = carried.withColumn("s", F.sum("v").over(frame("__range", *groups))).filter("__own").select("p", "v", "s")
    expected = rows.withColumn("s", F.sum("v").over(frame(*groups))).select("p", "v", "s")
    assert sorted(map(str, found.collect())) == sorted(map(str, expected.collect()))


@pytest.mark.parametrize("quantile", [0.0, 0.25, 0.5, 0.9, 1.0])
@pytest.mark.parametrize("groups", [[], ["g"]])
def test_quantile_routes_agree(spark, quantile, groups):
    rows = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, F.lit("a")).when(F.col("id") % 7 == 0, None).otherwise(F.lit("b")).alias("g"),
        F.when(F.col("id") % 4 == 0, F.lit(500.0)).when(F.col("id") % 13 == 0, None).otherwise(F.hash("id") % 1000).alias("v"),
    )
    expected = rows.groupBy(*groups).agg(F.percentile("v", F.lit(quantile)).alias("q"))
    found = quantiles.exact_quantile(rows, "v", quantile, groups)
    assert by_group(found) == by_group(expected)


def test_quantile_of_odd_values(spark):
    """Infinities, NaN, one huge group, a constant group, ties at the wanted ranks; no job before the read."""
    inf, nan = float("inf"), float("nan")
    odd = {"inf": [inf, inf, 1.0], "both": [-inf, inf, 0.0], "nan": [nan, 1.0, nan], "same": [2.5] * 9, "one": [7.0], "null": [None]}
    small = spark.createDataFrame([(g, v) for g, values in odd.items() for v in values], "g string, v double")
    rows = small.unionAll(spark.range(50_000).selectExpr("'huge' AS g", "cast(hash(id) AS double) / 7 AS v"))
    before = spark.sparkContext.statusTracker().getJobIdsForGroup(None)
    frames = [quantiles.exact_quantile(rows, "v", q, ["g"]) for q in (0.0, 0.3, 0.7, 1.0)]
    assert spark.sparkContext.statusTracker().getJobIdsForGroup(None) == before
    for q, found in zip((0.0, 0.3, 0.7, 1.0), frames):
        expected = rows.filter("v IS NOT NULL").groupBy("g").agg(F.percentile("v", F.lit(q)).alias("q"))
        assert repr(by_group(found)) == repr(by_group(expected))
    assert quantiles.exact_quantile(rows.limit(0), "v", 0.5).collect()[0][0] is None


def by_group(df):
    return sorted(((tuple(r)[:-1], round(r[-1], 9)) for r in df.collect()), key=repr)


def test_keep_first_trims_before_the_shuffle(spark):
    rows = spark.range(1000).select((F.col("id") % 3).alias("k"), "id")
    latest = keep_first(rows, ["k"], [F.desc("id")])
    assert sorted(r["id"] for r in latest.collect()) == [997, 998, 999]
    plan = latest._jdf.queryExecution().toString()
    assert plan.index("WindowGroupLimit") < plan.rindex("WindowGroupLimit")


def test_upsert_ignores_older_versions(spark):
    current = spark.createDataFrame([(1, "a", 1), (2, "b", 5)], "k int, v string, version int")
    changes = spark.createDataFrame([(1, "A", 1), (2, "old", 4), (3, "new", 1)], "k int, v string, version int")
    rows = upsert(current, changes, ["k"], "version").orderBy("k").collect()
    assert [(r["k"], r["v"]) for r in rows] == [(1, "A"), (2, "b"), (3, "new")]


def test_correlation_is_null_without_variance(spark):
    rows = spark.sql(
        "SELECT 's' AS station_id, date_add(DATE'2024-01-01', CAST(id AS INT)) AS date_key, id AS trip_count,"
        " 3 AS crime_count_within_quarter_mile FROM range(31)"
    )
    found = correlation.scoped_correlation(rows).collect()
    assert {r["scope"] for r in found} == {"overall", "per_station", "per_month"}
    assert all(r["correlation_coefficient"] is None for r in found)
    assert all(r["avg_trips"] is None for r in found if r["scope"] == "per_month")
    few = correlation.scoped_correlation(rows.limit(5)).collect()
    assert [r["scope"] for r in few] == ["overall"]


def test_correlation_matches_numpy(spark):
    rng = np.random.default_rng(3)
    x, y = rng.integers(0, 50, 500), rng.integers(0, 9, 500)
    rows = spark.createDataFrame([(int(a), int(b)) for a, b in zip(x, y)], "x int, y int")
    assert rows.agg(numeric.pearson("x", "y")).first()[0] == pytest.approx(np.corrcoef(x, y)[0, 1], abs=1e-12)


def test_regression_matches_dummy_variables(spark):
    rng = np.random.default_rng(5)
    n, stations = 600, 5
    station = rng.integers(0, stations, n)
    x = np.column_stack([rng.integers(0, 9, n), rng.integers(1, 8, n), rng.integers(1, 13, n)]).astype(float)
    y = 3 + x @ [1.5, -0.6, 0.8] + station * 2.0 + rng.normal(size=n)
    rows = [(float(y[i]), *map(float, x[i]), f"s{station[i]}") for i in range(n)]
    frame = spark.createDataFrame(rows, "trip_count double, crime_count_within_quarter_mile double, day_of_week double, month double, station_id string")
    model = reg.fit(frame)
    design = np.column_stack([x, np.eye(stations)[station]])
    solution = np.linalg.lstsq(design, y, rcond=None)[0]
    assert model.weights == pytest.approx(solution[:3], abs=1e-9)
    effects = {r["station_id"]: r["category_weight"] + model.intercept for r in model.effects.collect()}
    assert [effects[f"s{i}"] for i in range(stations)] == pytest.approx(solution[3:], abs=1e-9)

    unseen = frame.limit(1).withColumn("station_id", F.lit("elsewhere"))
    predicted = model.predict(unseen).first()
    assert predicted["seen_station"] is False
    metrics = reg.evaluate(model.predict(frame)).first()
    residual = y - design @ solution
    assert metrics["mean_squared_error"] == pytest.approx(float(np.mean(residual**2)))
    assert metrics["median_absolute_error"] == pytest.approx(float(np.median(np.abs(residual))))
    assert metrics["r2_score"] == pytest.approx(1 - residual.var() / y.var())
    assert {r["processed_input"] for r in model.weight_rows().collect()} == {*reg.FEATURES, "__INTERCEPT__", "station_id"}


def test_regression_with_categorical_month_and_singular_input(spark):
    frame = spark.sql(
        "SELECT CAST(10 * (id % 3) + id % 2 AS DOUBLE) AS trip_count, id % 5 AS crime_count_within_quarter_mile,"
        " id % 7 + 1 AS day_of_week, id % 3 + 1 AS month, CAST(id % 2 AS STRING) AS station_id FROM range(210)"
    )
    coded, names = reg.with_indicators(frame, "month", [1, 2, 3])
    model = reg.fit(coded, features=names)
    assert model.weights == pytest.approx([10.0, 20.0], abs=1e-9)
    with pytest.raises(ValueError, match="singular"):
        reg.fit(frame.withColumn("month", F.lit(4)))


def test_guarded_cast(spark):
    row = spark.range(1).select(
        guarded_cast(F.lit("12"), "int").alias("a"),
        guarded_cast(F.lit("x"), "int").alias("b"),
        guarded_cast(F.lit("2024-13-01"), "timestamp").alias("c"),
        guarded_cast(F.lit("yes?"), "bool").alias("d"),
    ).first()
    assert tuple(row) == (12, None, None, None)
    with pytest.raises(Exception):
        spark.range(1).select(guarded_cast(F.lit("x"), "int", strict=True)).collect()


def test_text_functions(spark):
    s = F.lit("one Two two TWO")
    row = spark.range(1).select(
        text.regex_position(s, "two").alias("a"),
        text.regex_position(s, "two", flags="i").alias("b"),
        text.regex_position(s, "two", occurrence=2, flags="i").alias("c"),
        text.regex_position(s, "two", position=6, flags="i").alias("d"),
        text.regex_position(s, "two", occurrence=4, flags="i").alias("e"),
        text.regex_position(F.lit(None).cast("string"), "x").alias("f"),
        text.composite_key(F.lit("a"), F.lit(None).cast("string")).alias("g"),
        text.key_part(F.lit("a|b"), 2).alias("h"),
        numeric.safe_log(F.lit(0)).alias("i"),
        numeric.remainder(F.lit(-7), 3).alias("j"),
        text.regex_position(F.lit("abc"), "x*").alias("k"),
    ).first()
    assert tuple(row) == (9, 5, 9, 9, 0, None, None, "b", 0.0, -1, 1)
    with pytest.raises(ValueError):
        text.regex_with_flags("a", "U")
    with pytest.warns(UserWarning):
        assert text.regex_with_flags("a", "cz") == "a"
    assert text.regex_with_flags("a", "i-s") == "(?i-s)a"


def test_uniform_random_is_repeatable(spark):
    draw = lambda: [r[0] for r in spark.range(100).select(numeric.uniform_random(9)).collect()]
    assert draw() == draw() and all(0 <= v < 1 for v in draw())
