"""Queries on joins, aggregates and dashboards (JN*, AG*, TK*, ST*, Q*)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cyclograph.functions import numeric, text
from cyclograph.operators.correlation import scoped_correlation
from cyclograph.operators.nearby import nearby_counts
from cyclograph.operators.quantiles import exact_quantile, quantile_over
from cyclograph.plans import dashboards, marts
from cyclograph.sources import fixtures
from cyclograph.workload.ctes import HAVERSINE
from cyclograph.workload.registry import Domain, register, rounded

DISTANCE = HAVERSINE.format(lat1="s.lat", lng1="s.lng", lat2="i.latitude", lng2="i.longitude")


@register("ag1_trips_per_station_day", "SELECT * FROM station_trips")
def trips_per_station_day(d: Domain) -> DataFrame:
    return marts.trips_per_station_day(d.trips)


@register(
    "jn1_nearby_incidents",
    f"""SELECT s.station_id, i.date_key, count(*) AS n FROM stations s JOIN incidents i
ON i.latitude IS NOT NULL AND i.longitude IS NOT NULL AND {DISTANCE} <= 900 GROUP BY ALL""",
)
def nearby_incidents(d: Domain) -> DataFrame:
    points = d.incidents.select("crime_id", "date_key", F.col("latitude").alias("lat"), F.col("longitude").alias("lng"))
    return nearby_counts(d.stations, points, "station_id", "date_key", 900.0)


@register(
    "jn1_nearby_with_lookback",
    f"""SELECT t.station_id, t.date_key, t.trip_count, count(i.date_key) AS crime_count_within_quarter_mile
FROM station_trips t LEFT JOIN stations s USING (station_id) LEFT JOIN incidents i
  ON i.date_key BETWEEN t.date_key - 1 AND t.date_key AND i.latitude IS NOT NULL AND i.longitude IS NOT NULL
  AND {DISTANCE} <= 402 GROUP BY ALL""",
)
def nearby_with_lookback(d: Domain) -> DataFrame:
    return marts.station_day(d.trips, d.stations, d.incidents, lookback_days=1)


@register("ag3_station_day", "SELECT * FROM station_day")
def station_day(d: Domain) -> DataFrame:
    return d.station_day


@register(
    "ag4_ag5_ag6_ag16_correlation",
    """WITH m AS (SELECT *, CAST(date_trunc('month', date_key) AS DATE) AS month FROM station_day),
p AS (SELECT 'overall' AS scope, NULL AS station_id, NULL::DATE AS month, corr(trip_count, crime_count_within_quarter_mile) AS c,
  count(*) AS n, avg(trip_count) AS t, avg(crime_count_within_quarter_mile) AS i FROM m
UNION ALL SELECT 'per_station', station_id, NULL, corr(trip_count, crime_count_within_quarter_mile), count(*),
  avg(trip_count), avg(crime_count_within_quarter_mile) FROM m GROUP BY station_id HAVING count(*) >= 30
UNION ALL SELECT 'per_month', NULL, month, corr(trip_count, crime_count_within_quarter_mile), count(*), NULL, NULL
  FROM m GROUP BY month HAVING count(*) >= 30)
SELECT scope, station_id, month, CASE WHEN isnan(c) THEN NULL ELSE round(c, 6) + 0 END AS correlation_coefficient,
  n AS observation_count, round(t, 6) AS avg_trips, round(i, 6) AS avg_crimes FROM p""",
)
def correlation(d: Domain) -> DataFrame:
    return scoped_correlation(d.station_day).withColumns(
        {c: rounded(c) for c in ("correlation_coefficient", "avg_trips", "avg_crimes")}
    )


@register("ag7_ag8_wn2_stations", "SELECT * FROM stations")
def stations(d: Domain) -> DataFrame:
    return d.stations


@register(
    "ag8_value_at_maximum",
    "SELECT user_id, arg_max(event_type, (value, event_id)) AS event_type, max(value) AS value FROM events GROUP BY ALL",
)
def value_at_maximum(d: Domain) -> DataFrame:
    return d.table("events").groupBy("user_id").agg(
        F.max_by("event_type", F.struct("value", "event_id")).alias("event_type"), F.max("value").alias("value")
    )


@register(
    "ag12_ag13_exact_quantiles",
    """SELECT l_returnflag, l_linestatus, round(quantile_cont(l_extendedprice, 0.9), 4) AS p90 FROM lineitem GROUP BY ALL
UNION ALL SELECT NULL, NULL, round(quantile_cont(l_extendedprice, 0.5), 4) FROM lineitem""",
)
def exact_quantiles(d: Domain) -> DataFrame:
    lines, keys = d.table("lineitem"), ["l_returnflag", "l_linestatus"]
    grouped = exact_quantile(lines, "l_extendedprice", 0.9, keys)
    median = exact_quantile(lines, "l_extendedprice", 0.5).select(*[F.lit(None).alias(k) for k in keys], "quantile_value")
    return grouped.unionByName(median).select(*keys, rounded("quantile_value", 4).alias("p90"))


@register(
    "ag12_sorted_range_quantile",
    "SELECT o_orderstatus, round(quantile_cont(o_totalprice, 0.37), 4) AS q FROM orders GROUP BY ALL",
)
def sorted_range_quantile(d: Domain) -> DataFrame:
    """The same answer by the route taken for groups with too many values for one task."""
    found = exact_quantile(d.table("orders"), "o_totalprice", 0.37, ["o_orderstatus"])
    return found.select("o_orderstatus", rounded("quantile_value", 4).alias("q"))


@register(
    "wn14_quantile_over_partition",
    """SELECT o_orderkey, round(quantile_cont(o_totalprice, 0.25) OVER (PARTITION BY o_orderpriority), 4) AS q
FROM orders""",
)
def quantile_window(d: Domain) -> DataFrame:
    placed = quantile_over(d.table("orders"), "o_totalprice", 0.25, ["o_orderpriority"], "q")
    return placed.select("o_orderkey", rounded("q", 4).alias("q"))


@register(
    "ag14_ag15_distinct_and_stdev",
    """SELECT event_type, count(DISTINCT user_id) AS users, round(stddev_samp(value), 6) AS deviation FROM events GROUP BY ALL""",
)
def distinct_and_stdev(d: Domain) -> DataFrame:
    return d.table("events").groupBy("event_type").agg(
        F.count_distinct("user_id").alias("users"), rounded(F.stddev_samp("value")).alias("deviation")
    )


@register(
    "sf_scalar_functions",
    """SELECT o_orderkey, upper(trim(p)) AS normal, o_orderstatus || '|' || nullif(p, ' 5-low ') AS key, split_part(o_orderpriority, '-', 2) AS part,
  round(coalesce(ln(nullif(o_orderkey % 4, 0)), 0), 6) AS log, md5(CAST(o_custkey AS VARCHAR)) AS digest, (o_orderkey - 50) % 7 AS remainder,
  length(o_orderpriority) AS size, greatest(o_orderkey, o_custkey) AS larger, least(o_orderkey, o_custkey) AS smaller,
  CASE WHEN regexp_matches(o_orderpriority, '(?i)[a-m]') THEN length(regexp_extract(o_orderpriority, '^(.*?)(?i:[a-m])', 1)) + 1 ELSE 0 END AS first_letter
FROM (SELECT *, concat(' ', lower(o_orderpriority), ' ') AS p FROM orders)""",
    ints="size first_letter",
)
def scalar_functions(d: Domain) -> DataFrame:
    padded = d.table("orders").withColumn("p", F.concat(F.lit(" "), F.lower("o_orderpriority"), F.lit(" ")))
    return padded.select(
        "o_orderkey",
        text.normalized("p").alias("normal"),
        text.composite_key("o_orderstatus", F.nullif("p", F.lit(" 5-low "))).alias("key"),
        text.key_part("o_orderpriority", 2, "-").alias("part"),
        rounded(numeric.safe_log(F.col("o_orderkey") % 4)).alias("log"),
        text.digest("o_custkey").alias("digest"),
        numeric.remainder(F.col("o_orderkey") - 50, 7).alias("remainder"),
        F.char_length("o_orderpriority").alias("size"),
        F.greatest("o_orderkey", "o_custkey").alias("larger"),
        F.least("o_orderkey", "o_custkey").alias("smaller"),
        text.regex_position("o_orderpriority", "[A-M]", flags="i").alias("first_letter"),
    )


@register(
    "st2_st3_replicated_unpivot",
    """SELECT f.factor, u.name, CAST(sum(u.v) AS BIGINT) AS total FROM (
  SELECT 'l_partkey' AS name, l_partkey AS v FROM lineitem UNION ALL SELECT 'l_suppkey', l_suppkey FROM lineitem) u
CROSS JOIN (VALUES (1), (2)) f(factor) GROUP BY ALL""",
)
def replicated_unpivot(d: Domain) -> DataFrame:
    """Two copies of every row and two columns turned into rows, in one pass over the table."""
    lines = d.table("lineitem").select("l_partkey", "l_suppkey")
    copies = lines.withColumn("factor", F.explode(F.array(F.lit(1), F.lit(2))))
    long = copies.unpivot(["factor"], ["l_partkey", "l_suppkey"], "name", "v")
    return long.groupBy("factor", "name").agg(F.sum("v").alias("total"))


@register(
    "jn10_areas_without_incidents",
    """SELECT community_area_id, community_area_name FROM areas WHERE community_area_id NOT IN (
  SELECT community_area_id FROM incidents WHERE community_area_id IS NOT NULL)""",
)
def areas_without_incidents(d: Domain) -> DataFrame:
    known = d.incidents.select("community_area_id").distinct()
    return d.areas.join(known, "community_area_id", "left_anti")


@register(
    "q1_jn5_tk1_top_areas",
    """SELECT community_area_name, count(*) AS crime_count FROM incidents JOIN areas USING (community_area_id)
WHERE community_area_id <> 0 GROUP BY ALL ORDER BY crime_count DESC, community_area_name LIMIT 15""",
)
def top_areas(d: Domain) -> DataFrame:
    return dashboards.top_areas(d.incidents, d.areas)


@register(
    "q2_tk2_sf3_top_types",
    """SELECT split_part(crime_type_key, '|', 1) AS primary_type, count(*) AS crime_count FROM incidents
GROUP BY ALL ORDER BY crime_count DESC, primary_type NULLS FIRST LIMIT 10""",
)
def top_types(d: Domain) -> DataFrame:
    return dashboards.top_types(d.incidents)


@register(
    "q3_trips_by_hour",
    "SELECT hour(started_at) AS hour_of_day, count(*) AS trip_count FROM trips GROUP BY ALL",
    ints="hour_of_day",
)
def trips_by_hour(d: Domain) -> DataFrame:
    return dashboards.trips_by_hour(d.trips)


@register(
    "q4_jn6_tk3_busy_station_hours",
    """WITH busy AS (SELECT start_station_id AS station_id FROM trips GROUP BY ALL
  ORDER BY count(*) DESC, station_id NULLS LAST LIMIT 20)
SELECT hour(started_at) AS hour_of_day, start_station_id AS station_id, count(*) AS trip_count FROM trips
WHERE start_station_id IN (SELECT station_id FROM busy) GROUP BY ALL""",
    ints="hour_of_day",
)
def busy_station_hours(d: Domain) -> DataFrame:
    return dashboards.busy_station_hours(d.trips)


@register(
    "q5_jn7_monthly_series",
    """WITH c AS (SELECT date_trunc('month', occurred_at) AS time, count(*) AS n FROM incidents GROUP BY ALL),
t AS (SELECT date_trunc('month', started_at) AS time, count(*) AS n FROM trips GROUP BY ALL)
SELECT CAST(c.time AS TIMESTAMP) AS time, c.n AS monthly_crime_count, coalesce(t.n, 0) AS monthly_trip_count
FROM c LEFT JOIN t ON c.time = t.time""",
)
def monthly_series(d: Domain) -> DataFrame:
    return dashboards.monthly_series(d.incidents, d.trips)


@register(
    "q6_sf4_incidents_by_weekday_hour",
    """SELECT hour(occurred_at) AS hour_of_day, dayofweek(occurred_at) AS day_of_week, count(*) AS crime_count
FROM incidents GROUP BY ALL""",
    ints="hour_of_day day_of_week",
)
def weekday_hours(d: Domain) -> DataFrame:
    return dashboards.incidents_by_weekday_hour(d.incidents)


@register(
    "q7_tk5_recent_scatter",
    """SELECT trip_count, crime_count_within_quarter_mile FROM station_day
WHERE date_key >= (SELECT CAST(max(started_at) AS DATE) - 30 FROM landed_trips)
ORDER BY trip_count DESC, crime_count_within_quarter_mile DESC, station_id, date_key LIMIT 5000""",
)
def recent_scatter(d: Domain) -> DataFrame:
    return dashboards.recent_scatter(d.station_day, d.latest(d.landed_trips, "started_at"))


@register(
    "q8_overall_correlation",
    "SELECT round(corr(trip_count, crime_count_within_quarter_mile), 6) + 0 AS correlation_coefficient FROM station_day",
)
def overall_correlation(d: Domain) -> DataFrame:
    found = dashboards.overall_correlation(scoped_correlation(d.station_day))
    return found.select(rounded("correlation_coefficient").alias("correlation_coefficient"))


@register(
    "q9_row_counts",
    """SELECT 'raw_incidents' AS table_name, count(*) AS row_count FROM landed_incidents
UNION ALL SELECT 'incidents', count(*) FROM incidents UNION ALL SELECT 'raw_trips', count(*) FROM landed_trips
UNION ALL SELECT 'station_day', count(*) FROM station_day""",
)
def row_counts(d: Domain) -> DataFrame:
    return dashboards.row_counts(
        raw_incidents=d.landed_incidents, incidents=d.incidents, raw_trips=d.landed_trips, station_day=d.station_day
    )


@register(
    "q10_tk4_hourly_trips",
    """SELECT CAST(date_trunc('hour', started_at) AS TIMESTAMP) AS time, count(*) AS trips_ingested FROM trips
GROUP BY ALL ORDER BY time DESC LIMIT 168""",
)
def hourly_trips(d: Domain) -> DataFrame:
    return dashboards.hourly_trips(d.trips)


@register(
    "q11_sf7_freshness",
    """SELECT s AS seconds_since_last_trip, CASE WHEN s >= 900 THEN 'bad' WHEN s >= 300 THEN 'warn' ELSE 'ok' END AS level
FROM (SELECT CAST(epoch((SELECT max(ended_at) FROM trips)) - epoch(max(started_at)) AS BIGINT) AS s FROM trips) x""",
)
def freshness(d: Domain) -> DataFrame:
    return dashboards.freshness(d.trips, d.latest(d.trips, "ended_at"))


@register("q12_latest_incident", "SELECT max(occurred_at) AS latest_crime_time FROM incidents")
def latest_incident(d: Domain) -> DataFrame:
    return dashboards.latest_incident(d.incidents)


@register(
    "q13_ag10_jn12_latest_test_outcomes",
    """WITH r AS (SELECT date_trunc('day', ts) AS generated_at, event_type FROM events)
SELECT count(*) FILTER (WHERE event_type = 'click') AS passing, count(*) FILTER (WHERE event_type = 'error') AS failing,
  count(*) FILTER (WHERE event_type NOT IN ('click', 'error')) AS warnings FROM r
WHERE generated_at = (SELECT max(generated_at) FROM r)""",
)
def latest_test_outcomes(d: Domain) -> DataFrame:
    status = F.when(F.col("event_type") == "click", "pass").when(F.col("event_type") == "error", "fail").otherwise("warn")
    results = d.table("events").select(F.date_trunc("day", "ts").alias("generated_at"), status.alias("status"))
    return dashboards.latest_test_outcomes(results)


def _now(d: Domain):
    return d.latest(d.table("events"), "ts")


@register(
    "q14_failed_tasks",
    """SELECT count(*) AS failed_tasks FROM run_log WHERE state IN ('failed', 'upstream_failed')
AND start_date > (SELECT max(ts) FROM events) - INTERVAL 7 DAY""",
)
def failed_tasks(d: Domain) -> DataFrame:
    return dashboards.failed_tasks(fixtures.run_log(d.spark, d.folder), _now(d))


@register(
    "q15_runs_by_state",
    """SELECT state, count(*) AS run_count FROM run_log
WHERE start_date > (SELECT max(ts) FROM events) - INTERVAL 7 DAY GROUP BY ALL""",
)
def runs_by_state(d: Domain) -> DataFrame:
    return dashboards.runs_by_state(fixtures.run_log(d.spark, d.folder), _now(d))


@register(
    "q16_sf23_recent_task_runs",
    """SELECT dag_id, task_id, run_id, state, start_date, end_date, CAST(epoch(end_date - start_date) AS DOUBLE) AS duration_seconds
FROM run_log WHERE start_date > (SELECT max(ts) FROM events) - INTERVAL 2 DAY
ORDER BY start_date DESC, dag_id, task_id, run_id LIMIT 50""",
)
def recent_task_runs(d: Domain) -> DataFrame:
    return dashboards.recent_task_runs(fixtures.run_log(d.spark, d.folder), _now(d))


@register(
    "q17_tk6_average_bikes",
    """SELECT station_id, count(*) AS polls, round(avg(num_bikes_available), 2) AS avg_bikes_available,
  round(avg(total_vehicles_available), 2) AS avg_total_vehicles
FROM reads GROUP BY ALL ORDER BY avg_bikes_available DESC NULLS LAST, station_id LIMIT 5""",
)
def average_bikes(d: Domain) -> DataFrame:
    return dashboards.average_bikes(d.reads)


@register(
    "q18_flag_combinations",
    "SELECT is_installed, is_renting, is_returning, count(*) AS n FROM raw_status GROUP BY ALL",
)
def flag_combinations(d: Domain) -> DataFrame:
    flags = {c: F.col(c).cast("boolean") for c in ("is_installed", "is_renting", "is_returning")}
    return dashboards.flag_combinations(d.raw_status.withColumns(flags))


@register(
    "q18_rows_per_minute",
    "SELECT CAST(date_trunc('minute', ingested_at) AS TIMESTAMP) AS minute, count(*) AS n FROM raw_status GROUP BY ALL",
)
def rows_per_minute(d: Domain) -> DataFrame:
    return dashboards.rows_per_minute(d.raw_status)


@register(
    "q19_jn8_ag11_area_months",
    """WITH c AS (SELECT community_area_id, CAST(date_trunc('month', occurred_at) AS TIMESTAMP) AS month, count(*) AS crime_count,
  CAST(sum(CASE WHEN primary_type IN (' a ', ' r ') THEN 1 ELSE 0 END) AS BIGINT) AS violent_crime_count FROM incidents GROUP BY ALL),
s AS (SELECT CAST(station_id AS BIGINT) % 78 AS community_area_id, CAST(date_trunc('month', reported_at - INTERVAL 8500 DAY) AS TIMESTAMP) AS month,
  avg(num_bikes_available) AS b, count(*) AS poll_count FROM reads GROUP BY ALL)
SELECT community_area_id, month, crime_count, violent_crime_count, round(b, 6) AS avg_bikes_available, poll_count
FROM c FULL JOIN s USING (community_area_id, month)""",
)
def area_months(d: Domain) -> DataFrame:
    reads = d.reads.withColumn("reported_at", F.expr("reported_at - INTERVAL 8500 DAYS"))
    placed = d.reads.select("station_id", F.expr("CAST(station_id AS BIGINT) % 78").alias("community_area_id")).distinct()
    joined = dashboards.area_months(d.incidents, reads, placed, (" a ", " r "))
    return joined.withColumn("avg_bikes_available", rounded("avg_bikes_available"))


@register("sf17_random_range", "SELECT count(*) AS n, true AS in_range, true AS spread FROM lineitem")
def random_range(d: Domain) -> DataFrame:
    """A property of the random numbers: from 0 to below 1, one for each row, about evenly."""
    drawn = d.table("lineitem").select(numeric.uniform_random(7).alias("u"))
    return drawn.agg(
        F.count("u").alias("n"),
        ((F.min("u") >= 0) & (F.max("u") < 1)).alias("in_range"),
        (F.avg("u").between(0.4, 0.6) & (F.approx_count_distinct("u") > 0.5 * F.count("u"))).alias("spread"),
    )
