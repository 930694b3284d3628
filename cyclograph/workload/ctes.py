"""Shared SQL table expressions: the test tables as domain tables, staged and modelled."""

from __future__ import annotations

import re

HAVERSINE = (
    "2 * 6371010.0::DOUBLE * asin(sqrt(least(1.0::DOUBLE, pow(sin(radians({lat2} - {lat1}) / 2), 2)"
    " + cos(radians({lat1})) * cos(radians({lat2})) * pow(sin(radians({lng2} - {lng1}) / 2), 2))))"
)

CTES = {
    "landed_trips": """
SELECT CAST(o_orderkey AS VARCHAR) AS ride_id,
  CASE WHEN o_orderstatus = 'F' THEN 'electric_bike' ELSE 'classic_bike' END AS rideable_type,
  o_orderdate + to_seconds(o_orderkey * 37 % 86400) AS started_at,
  o_orderdate + to_seconds(o_orderkey * 37 % 86400 + 60 + o_orderkey % 5400) AS ended_at,
  CASE WHEN o_orderkey % 50 <> 0 THEN concat('Station ', k, CASE WHEN o_orderkey % 9 = 0 THEN ' *' ELSE '' END) END AS start_station_name,
  CASE WHEN o_orderkey % 50 <> 0 THEN CAST(k AS VARCHAR) END AS start_station_id,
  concat('Station ', (k + 7) % 24) AS end_station_name,
  CAST((k + 7) % 24 AS VARCHAR) AS end_station_id,
  CASE WHEN o_orderkey % 61 = 0 THEN NULL WHEN o_orderkey % 67 = 0 THEN 0.0::DOUBLE
    WHEN o_orderkey % 5 = 0 THEN 41.88::DOUBLE + ((k * 37) % 97) / 2500.0::DOUBLE + 0.0001::DOUBLE
    ELSE 41.88::DOUBLE + ((k * 37) % 97) / 2500.0::DOUBLE END AS start_lat,
  CASE WHEN o_orderkey % 71 = 0 THEN NULL ELSE -87.65::DOUBLE + ((k * 53) % 89) / 2500.0::DOUBLE END AS start_lng,
  41.88::DOUBLE + (((k + 7) % 24 * 37) % 97) / 2500.0::DOUBLE AS end_lat,
  -87.65::DOUBLE + (((k + 7) % 24 * 53) % 89) / 2500.0::DOUBLE AS end_lng,
  CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'member' ELSE 'casual' END AS member_casual,
  strftime(o_orderdate, '%Y%m') AS source_month
FROM (SELECT *, o_custkey % 24 AS k FROM orders)""",
    "landed_incidents": """
SELECT CASE WHEN l_partkey % 211 = 0 THEN concat('X', l_orderkey * 10 + l_linenumber)
    ELSE CAST(l_orderkey * 10 + l_linenumber AS VARCHAR) END AS unique_key,
  concat(lpad(CAST(l_partkey AS VARCHAR), 12, '0'), lpad(CAST(l_suppkey AS VARCHAR), 12, '0')) AS case_number,
  l_shipdate + to_seconds((l_orderkey * 7919 + l_linenumber * 31) % 86400) AS date,
  concat(' ', lower(l_returnflag), ' ') AS primary_type,
  CASE WHEN l_partkey % 97 = 0 THEN NULL ELSE l_linestatus END AS description,
  CASE WHEN l_suppkey % 2 = 0 THEN 'STREET' ELSE 'PARK' END AS location_description,
  l_linenumber % 2 = 0 AS arrest, l_suppkey % 3 = 0 AS domestic,
  CASE WHEN l_partkey % 89 = 0 THEN 'unknown' ELSE CAST(l_suppkey % 78 AS VARCHAR) END AS community_area,
  CAST(l_suppkey % 25 AS VARCHAR) AS district, CAST(l_partkey % 50 AS VARCHAR) AS ward,
  CASE WHEN l_linenumber = 7 THEN NULL WHEN l_partkey % 101 = 0 THEN 45.0::DOUBLE
    ELSE 41.88::DOUBLE + ((l_partkey * 7919) % 1000) / 25000.0::DOUBLE END AS latitude,
  CASE WHEN l_linenumber = 7 OR l_partkey % 103 = 0 THEN NULL
    ELSE -87.65::DOUBLE + ((l_partkey * 104729 + l_suppkey * 31) % 1000) / 25000.0::DOUBLE END AS longitude,
  CAST(year(l_shipdate) AS BIGINT) AS year, l_shipdate AS updated_on
FROM lineitem""",
    "clean_incidents": """
SELECT try_cast(unique_key AS BIGINT) AS id, date, upper(trim(primary_type)) AS primary_type, description,
  try_cast(community_area AS INT) AS community_area, latitude, longitude, updated_on
FROM landed_incidents WHERE try_cast(unique_key AS BIGINT) IS NOT NULL
QUALIFY row_number() OVER (PARTITION BY try_cast(unique_key AS BIGINT)
  ORDER BY updated_on DESC NULLS LAST, date DESC NULLS LAST, case_number DESC) = 1""",
    "staged_incidents": """
SELECT try_cast(unique_key AS BIGINT) AS crime_id, case_number, date AS occurred_at, primary_type, description,
  location_description, arrest, domestic, try_cast(community_area AS BIGINT) AS community_area_id,
  try_cast(district AS BIGINT) AS district_id, try_cast(ward AS BIGINT) AS ward_id, latitude, longitude, year,
  updated_on AS updated_at
FROM landed_incidents
WHERE year >= 1996 AND (latitude IS NULL OR (latitude BETWEEN 41.64 AND 42.03 AND longitude BETWEEN -87.95 AND -87.52))
QUALIFY row_number() OVER (PARTITION BY unique_key ORDER BY updated_on DESC NULLS LAST, case_number DESC) = 1""",
    "incidents": """
SELECT crime_id, occurred_at, CAST(occurred_at AS DATE) AS date_key, community_area_id, primary_type,
  primary_type || '|' || description AS crime_type_key, arrest, domestic, latitude, longitude, district_id, ward_id, year
FROM staged_incidents WHERE crime_id IS NOT NULL""",
    "staged_trips": """
SELECT * FROM landed_trips WHERE ride_id IS NOT NULL AND started_at IS NOT NULL
  AND (start_lat IS NULL OR (start_lat BETWEEN 41.0 AND 42.5 AND start_lng BETWEEN -88.5 AND -87.0))""",
    "trips": """
SELECT *, CAST(started_at AS DATE) AS date_key,
  CAST(epoch(ended_at) - epoch(started_at) AS BIGINT) AS trip_duration_seconds FROM staged_trips""",
    "stations": """
SELECT station_id, station_name, lat, lng FROM (
  SELECT start_station_id AS station_id, start_station_name AS station_name, start_lat AS lat, start_lng AS lng, count(*) AS n
  FROM staged_trips WHERE start_station_id IS NOT NULL AND start_lat IS NOT NULL AND start_lng IS NOT NULL GROUP BY ALL)
QUALIFY row_number() OVER (PARTITION BY station_id ORDER BY n DESC, lat, lng, station_name) = 1""",
    "station_trips": """
SELECT start_station_id AS station_id, CAST(started_at AS DATE) AS date_key, count(*) AS trip_count
FROM trips WHERE start_station_id IS NOT NULL GROUP BY ALL""",
    "station_day": f"""
SELECT t.station_id, t.date_key, t.trip_count, coalesce(c.n, 0) AS crime_count_within_quarter_mile
FROM station_trips t LEFT JOIN (
  SELECT s.station_id, i.date_key, count(*) AS n FROM stations s JOIN incidents i
    ON i.latitude IS NOT NULL AND i.longitude IS NOT NULL
    AND {HAVERSINE.format(lat1='s.lat', lng1='s.lng', lat2='i.latitude', lng2='i.longitude')} <= 402
  GROUP BY ALL) c ON t.station_id = c.station_id AND t.date_key = c.date_key""",
    "first_status": """
SELECT CASE WHEN event_id % 97 = 0 THEN NULL ELSE CAST(user_id AS VARCHAR) END AS station_id,
  CASE WHEN event_id % 101 = 0 THEN NULL ELSE CAST(floor(value) AS INT) END AS num_bikes_available,
  CAST(event_id % 3 AS INT) AS num_bikes_disabled,
  CAST(json_extract_string(props, '$.k') AS INT) AS num_docks_available, CAST(event_id % 2 AS INT) AS num_docks_disabled,
  true AS is_installed, event_id % 5 <> 0 AS is_renting, event_id % 7 <> 0 AS is_returning,
  date_trunc('second', ts) - to_seconds(CASE WHEN event_id % 11 = 0 THEN 7200 ELSE 0 END) AS reported_at,
  concat('L', user_id) AS legacy_id, CAST(event_id % 13 AS INT) AS num_ebikes_available,
  false AS eightd_has_available_keys,
  CASE WHEN event_id % 4 = 0 THEN CAST(event_id % 6 AS INT) END AS num_scooters_available,
  CAST(NULL AS INT) AS num_scooters_unavailable, CAST(event_id % 3 AS INT) AS kafka_partition,
  event_id AS kafka_offset, ts AS kafka_timestamp, ts + INTERVAL 5 SECOND AS ingested_at FROM events""",
    "raw_status": """
SELECT * FROM first_status UNION ALL
SELECT * REPLACE (99 AS num_bikes_disabled,
  CASE WHEN kafka_offset % 21 = 0 THEN NULL ELSE ingested_at + INTERVAL 60 SECOND END AS ingested_at)
FROM first_status WHERE kafka_offset % 7 = 0""",
    "staged_status": """
SELECT * FROM raw_status
QUALIFY row_number() OVER (PARTITION BY kafka_partition, kafka_offset ORDER BY ingested_at DESC NULLS FIRST) = 1""",
    "reads": """
SELECT station_id, reported_at, CAST(reported_at AS DATE) AS date_key, ingested_at, num_bikes_available, num_bikes_disabled,
  num_docks_available, num_docks_disabled, num_ebikes_available, num_scooters_available, num_scooters_unavailable,
  is_installed, is_renting, is_returning, eightd_has_available_keys,
  num_bikes_available + num_ebikes_available + coalesce(num_scooters_available, 0) AS total_vehicles_available,
  num_docks_available AS total_docks_available, kafka_partition, kafka_offset, kafka_timestamp
FROM staged_status WHERE station_id IS NOT NULL AND reported_at IS NOT NULL""",
    "areas": "SELECT s_suppkey AS community_area_id, s_name AS community_area_name FROM supplier",
    "run_log": """
SELECT concat('job_', user_id % 5) AS dag_id, concat('task_', user_id % 11) AS task_id, CAST(event_id AS VARCHAR) AS run_id,
  CASE WHEN event_type = 'error' THEN 'failed' ELSE 'success' END AS state, ts AS start_date,
  ts + to_seconds(CAST(floor(value) AS INT)) AS end_date FROM events""",
    "days": """
SELECT CAST(d AS DATE) AS date_day FROM (SELECT unnest(generate_series(min(o_orderdate), max(o_orderdate) - INTERVAL 1 DAY,
  INTERVAL 1 DAY)) AS d FROM orders)""",
    "training": """
SELECT trip_count, crime_count_within_quarter_mile, dayofweek(date_key) + 1 AS day_of_week, month(date_key) AS month,
  station_id, date_key FROM station_day""",
}


def expand(sql: str) -> str:
    """Prefix a statement with the table expressions it uses, in dependency order."""
    needed: list[str] = []

    def visit(text: str) -> None:
        for word in re.findall(r"\b[a-z_]+\b", text):
            if word in CTES and word not in needed and _used_as_table(word, text):
                visit(CTES[word])
                if word not in needed:
                    needed.append(word)

    visit(sql)
    if not needed:
        return sql
    expressions = ",\n".join(f"{name} AS ({CTES[name]})" for name in needed)
    body = sql.strip()
    if body[:5].upper() == "WITH ":
        return f"WITH {expressions},\n{body[5:]}"
    return f"WITH {expressions}\n{body}"


def _used_as_table(word: str, text: str) -> bool:
    return re.search(rf"(?:\bFROM|\bJOIN|,)\s+{word}\b", text) is not None
