"""Regression queries (ML1-ML5)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cyclograph.operators import regression as reg
from cyclograph.plans.build import Landed, ModelBuild
from cyclograph.session import materialize, new_folder
from cyclograph.sources import fixtures
from cyclograph.workload.registry import FIRST_YEAR, SPLIT_DATE, Domain, register, rounded

# Within-station moments, Cramer's rule for the three weights, station effects.
FIT_SQL = f"""
WITH split AS (SELECT trip_count::DOUBLE AS y, crime_count_within_quarter_mile::DOUBLE AS a, day_of_week::DOUBLE AS b, month::DOUBLE AS c,
    station_id, date_key, ('0x' || substr(md5(station_id || '|' || CAST(date_key AS VARCHAR)), 1, 6))::INT % 100 < 80 AS fitted
  FROM training WHERE date_key < DATE '{SPLIT_DATE}'),
s AS (SELECT station_id, count(*) AS n, avg(y) AS my, avg(a) AS ma, avg(b) AS mb, avg(c) AS mc,
    count(*) * covar_pop(a, a) AS aa, count(*) * covar_pop(a, b) AS ab, count(*) * covar_pop(a, c) AS ac,
    count(*) * covar_pop(b, b) AS bb, count(*) * covar_pop(b, c) AS bc, count(*) * covar_pop(c, c) AS cc,
    count(*) * covar_pop(a, y) AS ay, count(*) * covar_pop(b, y) AS by_, count(*) * covar_pop(c, y) AS cy
  FROM split WHERE fitted GROUP BY station_id),
g AS (SELECT sum(n * my) / sum(n) AS my, sum(n * ma) / sum(n) AS ma, sum(n * mb) / sum(n) AS mb, sum(n * mc) / sum(n) AS mc,
    sum(aa) AS aa, sum(ab) AS ab, sum(ac) AS ac, sum(bb) AS bb, sum(bc) AS bc, sum(cc) AS cc,
    sum(ay) AS ay, sum(by_) AS by_, sum(cy) AS cy FROM s),
e AS (SELECT *, aa * (bb * cc - bc * bc) - ab * (ab * cc - bc * ac) + ac * (ab * bc - bb * ac) AS det FROM g),
w AS (SELECT *, (ay * (bb * cc - bc * bc) - ab * (by_ * cc - bc * cy) + ac * (by_ * bc - bb * cy)) / det AS wa,
    (aa * (by_ * cc - cy * bc) - ay * (ab * cc - bc * ac) + ac * (ab * cy - by_ * ac)) / det AS wb,
    (aa * (bb * cy - bc * by_) - ab * (ab * cy - by_ * ac) + ay * (ab * bc - bb * ac)) / det AS wc FROM e),
m AS (SELECT wa, wb, wc, my - wa * ma - wb * mb - wc * mc AS w0 FROM w),
fx AS (SELECT s.station_id, s.my - m.wa * s.ma - m.wb * s.mb - m.wc * s.mc - m.w0 AS effect FROM s, m)
"""


def _fitted(d: Domain) -> tuple[reg.FixedEffectModel, DataFrame, DataFrame]:
    """Model, hold-out rows, later rows. The station-day mart is a table: it is built once."""
    mart = materialize(d.station_day, "station-day")
    rows = reg.training_rows(mart, before=SPLIT_DATE)
    chosen = reg.in_training_split("station_id", "date_key")
    return reg.fit(rows.filter(chosen)), rows.filter(~chosen), reg.training_rows(mart, since=SPLIT_DATE)


@register("ml1_training_rows", f"SELECT * FROM training WHERE date_key < DATE '{SPLIT_DATE}'", ints="day_of_week month")
def training_rows(d: Domain) -> DataFrame:
    return reg.training_rows(d.station_day, before=SPLIT_DATE)


@register(
    "ml2_ml4_weights",
    FIT_SQL
    + """SELECT processed_input, category, round(weight, 6) + 0 AS weight FROM (
SELECT 'crime_count_within_quarter_mile' AS processed_input, NULL AS category, wa AS weight FROM m
UNION ALL SELECT 'day_of_week', NULL, wb FROM m UNION ALL SELECT 'month', NULL, wc FROM m
UNION ALL SELECT '__INTERCEPT__', NULL, w0 FROM m UNION ALL SELECT 'station_id', station_id, effect FROM fx)""",
)
def weights(d: Domain) -> DataFrame:
    model, _, _ = _fitted(d)
    return model.weight_rows().withColumn("weight", rounded("weight"))


@register(
    "ml3_evaluation",
    FIT_SQL
    + """, p AS (SELECT y, m.w0 + m.wa * a + m.wb * b + m.wc * c + coalesce(effect, 0) AS p
  FROM split LEFT JOIN fx USING (station_id), m WHERE NOT fitted)
SELECT round(avg(abs(y - p)), 6) + 0 AS mean_absolute_error, round(avg((y - p) * (y - p)), 6) + 0 AS mean_squared_error,
  round(avg(pow(ln(1 + y) - ln(1 + greatest(p, 0)), 2)), 6) + 0 AS mean_squared_log_error,
  round(quantile_cont(abs(y - p), 0.5), 6) + 0 AS median_absolute_error,
  round(1 - sum((y - p) * (y - p)) / (count(*) * var_pop(y)), 6) + 0 AS r2_score,
  round(1 - var_pop(y - p) / var_pop(y), 6) + 0 AS explained_variance FROM p""",
)
def evaluation(d: Domain) -> DataFrame:
    model, held_out, _ = _fitted(d)
    metrics = reg.evaluate(model.predict(held_out))
    return metrics.select(*[rounded(c).alias(c) for c in metrics.columns])


@register(
    "ml5_predictions",
    FIT_SQL
    + f"""SELECT t.station_id, t.date_key, t.trip_count, t.crime_count_within_quarter_mile,
  round(m.w0 + m.wa * t.crime_count_within_quarter_mile + m.wb * t.day_of_week + m.wc * t.month + coalesce(effect, 0), 6) + 0 AS predicted_trip_count,
  effect IS NOT NULL AS seen_station
FROM training t LEFT JOIN fx ON t.station_id = fx.station_id, m WHERE t.date_key >= DATE '{SPLIT_DATE}'""",
)
def predictions(d: Domain) -> DataFrame:
    model, _, later = _fitted(d)
    return model.predict(later).select(
        "station_id",
        "date_key",
        "trip_count",
        reg.FEATURES[0],
        rounded("predicted_trip_count").alias("predicted_trip_count"),
        F.col("seen_station"),
    )


def _built(d: Domain) -> ModelBuild:
    """The whole model, from the landed tables to the predictions, stored table by table."""
    model = ModelBuild(d.spark, new_folder(d.spark, "model"), FIRST_YEAR, SPLIT_DATE)
    model.run(Landed(d.landed_incidents, d.landed_trips, fixtures.area_seed(d.spark, d.folder)))
    return model


@register(
    "snk5_stored_station_day",
    "SELECT * FROM station_day WHERE date_key BETWEEN DATE '1997-05-20' AND DATE '1999-02-10'",
)
def stored_station_day(d: Domain) -> DataFrame:
    """A range of days of the mart as the model build stored it."""
    return _built(d).days("station_day", "1997-05-20", "1999-02-10")


def _contract_sql() -> str:
    """One row for each contract: how many rows, or keys, break it."""

    def where(name: str, table: str, condition: str) -> str:
        return f"SELECT '{table}.{name}' AS test_name, count(*) AS failures FROM {table} WHERE {condition}"

    def nulls(table: str, *columns: str) -> list[str]:
        return [where(f"not_null_{c}", table, f"{c} IS NULL") for c in columns]

    def outside(table: str, column: str, low: str, high: str) -> str:
        return where(f"values_between_{column}", table, f"{column} NOT BETWEEN {low} AND {high}")

    def repeated(table: str, column: str) -> str:
        keys = f"SELECT {column} FROM {table} WHERE {column} IS NOT NULL GROUP BY {column} HAVING count(*) > 1"
        return f"SELECT '{table}.unique_{column}' AS test_name, count(*) AS failures FROM ({keys})"

    def orphans(table: str, column: str, parent: str, condition: str = "true") -> str:
        return where(f"relationships_{column}", table, f"{column} IS NOT NULL AND {condition} AND {column} NOT IN ({parent})")

    days = """SELECT CAST(unnest(generate_series(CAST(least(i.a, t.a) AS DATE), CAST(greatest(i.b, t.b) AS DATE), INTERVAL 1 DAY)) AS DATE)
  FROM (SELECT min(occurred_at) AS a, max(occurred_at) AS b FROM staged_incidents) i, (SELECT min(started_at) AS a, max(started_at) AS b FROM trips) t"""
    types = """SELECT primary_type || '|' || description FROM staged_incidents
WHERE primary_type IS NOT NULL AND description IS NOT NULL"""
    label, features = reg.LABEL, reg.FEATURES
    built = f"""{FIT_SQL}, dates AS (SELECT date_key, year(date_key) AS year, month(date_key) AS month FROM ({days}) AS d(date_key)),
incident_types AS (SELECT DISTINCT primary_type || '|' || description AS crime_type_key, primary_type, description FROM staged_incidents
  WHERE primary_type IS NOT NULL AND description IS NOT NULL),
correlation AS (SELECT 'overall' AS scope, count(*) AS observation_count FROM station_day
  UNION ALL SELECT 'per_station', count(*) FROM station_day GROUP BY station_id HAVING count(*) >= 30
  UNION ALL SELECT 'per_month', count(*) FROM station_day GROUP BY date_trunc('month', date_key) HAVING count(*) >= 30),
weights AS (SELECT unnest(['{features[0]}', 'day_of_week', 'month', '__INTERCEPT__']) AS processed_input FROM m
  UNION ALL SELECT 'station_id' FROM fx),
predictions AS (SELECT t.station_id, t.date_key, t.trip_count,
    m.w0 + m.wa * t.{features[0]} + m.wb * t.day_of_week + m.wc * t.month + coalesce(effect, 0) AS predicted_trip_count
  FROM training t LEFT JOIN fx ON t.station_id = fx.station_id, m WHERE t.date_key >= DATE '{SPLIT_DATE}')"""
    parts = [
        repeated("dates", "date_key"),
        *nulls("dates", "date_key", "year", "month"),
        outside("dates", "year", str(FIRST_YEAR), str(FIRST_YEAR + 5)),
        outside("dates", "month", "1", "12"),
        repeated("incident_types", "crime_type_key"),
        *nulls("incident_types", "crime_type_key", "primary_type"),
        repeated("stations", "station_id"),
        *nulls("stations", "station_id", "station_name", "lat", "lng"),
        outside("stations", "lat", "41.0", "42.5"),
        outside("stations", "lng", "-88.5", "-87.0"),
        *nulls("correlation", "scope", "observation_count"),
        where("accepted_values_scope", "correlation", "scope NOT IN ('overall', 'per_station', 'per_month')"),
        *nulls("weights", "processed_input"),
        *nulls("predictions", "station_id", "date_key", label, f"predicted_{label}"),
        repeated("areas", "community_area_id"),
        *nulls("areas", "community_area_id", "community_area_name"),
        outside("areas", "community_area_id", "1", "77"),
        repeated("incidents", "crime_id"),
        *nulls("incidents", "crime_id", "date_key", "crime_type_key"),
        orphans("incidents", "date_key", days),
        orphans("incidents", "community_area_id", "SELECT community_area_id FROM areas", "community_area_id <> 0"),
        orphans("incidents", "crime_type_key", types),
        outside("incidents", "latitude", "41.64", "42.03"),
        outside("incidents", "longitude", "-87.95", "-87.52"),
        *nulls("trips", "ride_id", "started_at", "date_key"),
        orphans("trips", "date_key", days),
        *nulls("station_day", "station_id", "date_key", "trip_count", features[0]),
        orphans("station_day", "date_key", days),
        outside("station_day", "trip_count", "0", "10000"),
        *[x.replace("FROM training WHERE", f"FROM training WHERE date_key < DATE '{SPLIT_DATE}' AND") for x in nulls("training", label, *features, "station_id")],
        *[
            outside("training", c, low, high).replace("FROM training WHERE", f"FROM training WHERE date_key < DATE '{SPLIT_DATE}' AND")
            for c, low, high in ((label, "0", "10000"), ("day_of_week", "1", "7"), ("month", "1", "12"))
        ],
    ]
    union = " UNION ALL ".join(parts)
    return f"{built} SELECT test_name, CASE WHEN failures = 0 THEN 'pass' ELSE 'fail' END AS status, failures FROM ({union})"


@register("dq_contract_outcomes", _contract_sql())
def contract_outcomes(d: Domain) -> DataFrame:
    """What the contracts of all tables of the model build found."""
    found = _built(d).check((FIRST_YEAR, FIRST_YEAR + 5))
    return found.select("test_name", "status", F.col("failures").cast("bigint").alias("failures"))
