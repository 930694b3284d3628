"""Calendar queries (CAL*, WN8-WN12, JN4, JN11), over the span and dates of the test tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cyclograph.functions import calendar as cal
from cyclograph.plans import calendar_tables as tables
from cyclograph.workload.registry import Domain, register

DIMENSION_SQL = """
SELECT date_day, date_day - 1 AS prior_date_day, date_day + 1 AS next_date_day, p AS prior_year_date_day,
  y AS prior_year_over_year_date_day, dayofweek(date_day) + 1 AS day_of_week, isodow(date_day) AS day_of_week_iso,
  dayname(date_day) AS day_of_week_name, strftime(date_day, '%a') AS day_of_week_name_short,
  day(date_day) AS day_of_month, dayofyear(date_day) AS day_of_year,
  date_day - CAST(dayofweek(date_day) AS INT) AS week_start_date, date_day - CAST(dayofweek(date_day) AS INT) + 6 AS week_end_date,
  y - CAST(dayofweek(y) AS INT) AS prior_year_week_start_date, y - CAST(dayofweek(y) AS INT) + 6 AS prior_year_week_end_date,
  CAST(ceil(dayofyear(date_day) / 7) AS INT) AS week_of_year,
  CAST(date_trunc('week', date_day) AS DATE) AS iso_week_start_date, CAST(date_trunc('week', date_day) AS DATE) + 6 AS iso_week_end_date,
  CAST(date_trunc('week', y) AS DATE) AS prior_year_iso_week_start_date, CAST(date_trunc('week', y) AS DATE) + 6 AS prior_year_iso_week_end_date,
  week(date_day) AS iso_week_of_year, strftime(date_day, '%G-W%V') AS iso_year_week,
  CAST(ceil(dayofyear(y) / 7) AS INT) AS prior_year_week_of_year, week(y) AS prior_year_iso_week_of_year,
  month(date_day) AS month_of_year, monthname(date_day) AS month_name, strftime(date_day, '%b') AS month_name_short,
  CAST(date_trunc('month', date_day) AS DATE) AS month_start_date, last_day(date_day) AS month_end_date,
  CAST(date_trunc('month', p) AS DATE) AS prior_year_month_start_date, last_day(p) AS prior_year_month_end_date,
  quarter(date_day) AS quarter_of_year, CAST(date_trunc('quarter', date_day) AS DATE) AS quarter_start_date,
  CAST(date_trunc('quarter', date_day) + INTERVAL 3 MONTH - INTERVAL 1 DAY AS DATE) AS quarter_end_date,
  year(date_day) AS year_number, CAST(date_trunc('year', date_day) AS DATE) AS year_start_date,
  CAST(date_trunc('year', date_day) + INTERVAL 1 YEAR - INTERVAL 1 DAY AS DATE) AS year_end_date
FROM (SELECT date_day, CAST(date_day - INTERVAL 1 YEAR AS DATE) AS p, date_day - 364 AS y FROM days)"""

# The fiscal rules in SQL; {month} is the last month, {start} the weekday weeks start on.
FISCAL_SQL = f"""
WITH dim AS ({DIMENSION_SQL}),
month_ends AS (SELECT DISTINCT year_number - 1 AS fy, month_end_date FROM dim WHERE month_of_year = {{month}}),
weeks AS (SELECT year_number, month_of_year, date_day AS week_start_date, date_day + 6 AS week_end_date FROM dim WHERE day_of_week = {{start}}),
closest AS (SELECT w.year_number - 1 AS fy, w.week_end_date, rank() OVER (PARTITION BY w.year_number - 1
    ORDER BY abs(w.week_end_date - m.month_end_date)) AS r
  FROM weeks w JOIN month_ends m ON m.fy = w.year_number - 1 WHERE w.month_of_year = {{month}}),
years AS (SELECT fy, lag(week_end_date) OVER (ORDER BY week_end_date) + 1 AS s, week_end_date AS e FROM closest WHERE r = 1),
dated AS (SELECT d.date_day, y.fy AS fiscal_year_number, y.s AS fiscal_year_start_date, y.e AS fiscal_year_end_date,
    w.week_start_date, w.week_end_date, dense_rank() OVER (PARTITION BY y.fy ORDER BY w.week_start_date) AS fiscal_week_of_year
  FROM dim d JOIN years y ON d.date_day BETWEEN y.s AND y.e JOIN weeks w ON d.date_day BETWEEN w.week_start_date AND w.week_end_date)
"""


def _days(d: Domain) -> DataFrame:
    limits = tables.bounds_of((d.table("orders"), "o_orderdate"))
    return tables.date_spine(limits).select(F.to_date("date_day").alias("date_day"))


@register("cal30_date_dimension", DIMENSION_SQL, ints="day_of_week day_of_week_iso day_of_month day_of_year iso_week_of_year prior_year_iso_week_of_year month_of_year quarter_of_year year_number")
def date_dimension(d: Domain) -> DataFrame:
    return tables.date_dimension(_days(d))


@register(
    "cal3_cal4_cal16_cal18_localized_names",
    """SELECT o_orderkey,
  ['maandag','dinsdag','woensdag','donderdag','vrijdag','zaterdag','zondag'][isodow(o_orderdate)] AS day_nl,
  ['Mo','Di','Mi','Do','Fr','Sa','So'][isodow(o_orderdate)] AS day_short_de,
  ['mån','tis','ons','tor','fre','lör','sön'][isodow(o_orderdate)] AS day_short_sv,
  ['maanantai','tiistai','keskiviikko','torstai','perjantai','lauantai','sunnuntai'][isodow(o_orderdate)] AS day_fi,
  ['styczeń','luty','marzec','kwiecień','maj','czerwiec','lipiec','sierpień','wrzesień','październik','listopad','grudzień'][month(o_orderdate)] AS month_pl,
  ['led','úno','bře','dub','kvě','čer','čvc','srp','zář','říj','lis','pro'][month(o_orderdate)] AS month_short_cs,
  ['janv','févr','mars','avr','mai','juin','juil','août','sept','oct','nov','déc'][month(o_orderdate)] AS month_short_fr
FROM orders""",
)
def localized_names(d: Domain) -> DataFrame:
    day = F.col("o_orderdate")
    return d.table("orders").select(
        "o_orderkey",
        cal.day_name(day, short=False, language="nl").alias("day_nl"),
        cal.day_name(day, language="de").alias("day_short_de"),
        cal.day_name(day, language="sv").alias("day_short_sv"),
        cal.day_name(day, short=False, language="fi").alias("day_fi"),
        cal.month_name(day, short=False, language="pl").alias("month_pl"),
        cal.month_name(day, language="cs").alias("month_short_cs"),
        cal.month_name(day, language="fr").alias("month_short_fr"),
    )


@register(
    "cal20_to_cal27_relative_dates",
    """SELECT o_orderkey, t - 1 AS yesterday, t + 1 AS tomorrow, t - 3 AS three_days_ago, t + 10 AS ten_days_away,
  CAST(date_trunc('week', t - 14) AS DATE) AS two_weeks_ago, CAST(date_trunc('week', t + 7) AS DATE) AS next_week,
  CAST(date_trunc('month', t - INTERVAL 5 MONTH) AS DATE) AS five_months_ago,
  CAST(date_trunc('month', t + INTERVAL 1 MONTH) AS DATE) AS next_month,
  strftime(t - INTERVAL 1 MONTH, '%b') AS last_month_name, strftime(t + INTERVAL 1 MONTH, '%B') AS next_month_name,
  month(t - INTERVAL 1 MONTH) AS last_month_number, month(t + INTERVAL 1 MONTH) AS next_month_number
FROM (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS t FROM orders)""",
    ints="last_month_number next_month_number",
)
def relative_dates(d: Domain) -> DataFrame:
    """Every order date once as the present."""
    at = {"as_of": F.col("o_orderdate")}
    return d.table("orders").select(
        "o_orderkey",
        cal.yesterday(**at).alias("yesterday"),
        cal.tomorrow(**at).alias("tomorrow"),
        cal.n_days_ago(3, **at).alias("three_days_ago"),
        cal.n_days_away(10, **at).alias("ten_days_away"),
        cal.n_weeks_ago(2, **at).alias("two_weeks_ago"),
        cal.next_week(**at).alias("next_week"),
        cal.n_months_ago(5, **at).alias("five_months_ago"),
        cal.next_month(**at).alias("next_month"),
        cal.last_month_name(**at).alias("last_month_name"),
        cal.next_month_name(short=False, **at).alias("next_month_name"),
        cal.last_month_number(**at).alias("last_month_number"),
        cal.next_month_number(**at).alias("next_month_number"),
    )


@register(
    "cal28_periods_since",
    """SELECT event_id, m::DATE - ts::DATE AS days, CAST((date_trunc('week', m)::DATE - date_trunc('week', ts)::DATE) / 7 AS BIGINT) AS weeks,
  (year(m) - year(ts)) * 12 + month(m) - month(ts) AS months, (year(m) - year(ts)) * 4 + quarter(m) - quarter(ts) AS quarters,
  year(m) - year(ts) AS years, CAST(floor(epoch(m) / 3600) - floor(epoch(ts) / 3600) AS BIGINT) AS hours,
  CAST(floor(epoch(m) / 60) - floor(epoch(ts) / 60) AS BIGINT) AS minutes
FROM (SELECT event_id, ts, ts + to_hours(event_id % 20000) AS m FROM events)""",
)
def periods_since(d: Domain) -> DataFrame:
    later = F.expr("CAST(ts + make_dt_interval(0, event_id % 20000) AS TIMESTAMP)")
    parts = ["day", "week", "month", "quarter", "year", "hour", "minute"]
    moment = F.col("ts").cast("timestamp")
    return d.table("events").select(
        "event_id", *[cal.periods_since(moment, p, as_of=later).alias(f"{p}s") for p in parts]
    )


@register(
    "cal1_cal2_cal8_cal9_cal29_times",
    """SELECT event_id, timezone('America/Los_Angeles', timezone('UTC', ts)) AS los_angeles,
  CAST(floor(epoch(ts)) AS BIGINT) AS unix_time, date_trunc('second', ts) AS from_seconds,
  date_trunc('millisecond', ts) AS from_millis, CAST(date_trunc('day', ts + INTERVAL 12 HOUR) AS TIMESTAMP) AS rounded,
  minute(ts) AS minute, CAST(ts AS DATE) AS built
FROM events""",
    ints="minute",
)
def times(d: Domain) -> DataFrame:
    moment = F.col("ts").cast("timestamp")
    return d.table("events").select(
        "event_id",
        cal.convert_timezone("ts", "America/Los_Angeles").alias("los_angeles"),
        cal.to_unix("ts").alias("unix_time"),
        cal.from_unix(cal.to_unix("ts")).alias("from_seconds"),
        cal.from_unix(F.unix_millis(moment), "milliseconds").alias("from_millis"),
        cal.round_to_day(moment).alias("rounded"),
        cal.date_part("minute", "ts").alias("minute"),
        F.make_date(F.year("ts"), F.month("ts"), F.dayofmonth("ts")).alias("built"),
    )


@register(
    "cal35_month_and_hour_spines",
    """SELECT 'month' AS part, CAST(unnest(generate_series(a, a + to_months(CAST((year(b) - year(a)) * 12 + month(b) - month(a) - 1 AS INT)), INTERVAL 1 MONTH)) AS TIMESTAMP) AS moment
FROM (SELECT date_trunc('month', min(o_orderdate)) AS a, max(o_orderdate) AS b FROM orders)
UNION ALL
SELECT 'hour', CAST(unnest(generate_series(a, date_trunc('hour', b) - INTERVAL 1 HOUR, INTERVAL 1 HOUR)) AS TIMESTAMP)
FROM (SELECT date_trunc('hour', min(ts)) AS a, max(ts) AS b FROM events)""",
)
def spines(d: Domain) -> DataFrame:
    orders = d.table("orders").select(cal.truncate("o_orderdate", "month").alias("m"), F.col("o_orderdate").cast("timestamp").alias("t"))
    events = d.table("events").select(cal.truncate("ts", "hour").alias("m"), F.col("ts").cast("timestamp").alias("t"))

    def spine(df: DataFrame, part: str) -> DataFrame:
        limits = df.agg(F.min("m").alias("start"), F.max("t").alias("end"))
        return tables.date_spine(limits, part).select(F.lit(part).alias("part"), F.col(f"date_{part}").alias("moment"))

    return spine(orders, "month").unionByName(spine(events, "hour"))


@register(
    "cal19_cal31_last_days",
    """SELECT d AS date_day, count(event_id) AS n FROM (
  SELECT CAST(unnest(generate_series(date_trunc('day', max(ts)) - INTERVAL 9 DAY, date_trunc('day', max(ts)) + INTERVAL 3 DAY, INTERVAL 1 DAY)) AS TIMESTAMP) AS d FROM events)
LEFT JOIN events ON CAST(ts AS DATE) = CAST(d AS DATE) GROUP BY ALL""",
)
def last_days(d: Domain) -> DataFrame:
    """Events per day of the twelve days up to three days after the last event, empty days included."""
    events = d.table("events")
    as_of = d.latest(events, "ts") + F.expr("INTERVAL 3 DAYS")
    days = tables.base_dates(d.spark, n_parts=12, as_of=as_of)
    counts = events.groupBy(cal.truncate("ts", "day").alias("date_day")).agg(F.count(F.lit(1)).alias("n"))
    return days.join(counts, "date_day", "left").select("date_day", F.coalesce("n", F.lit(0)).alias("n"))


@register(
    "cal37_ag9_jn4_project_dates",
    """SELECT d AS date_key, year(d) AS year, month(d) AS month, day(d) AS day, dayofweek(d) + 1 AS day_of_week, dayname(d) AS day_name,
  monthname(d) AS month_name, CAST(date_trunc('month', d) AS DATE) AS month_start, CAST(date_trunc('quarter', d) AS DATE) AS quarter_start
FROM (SELECT CAST(unnest(generate_series(CAST(min(a) AS DATE), CAST(max(b) AS DATE), INTERVAL 1 DAY)) AS DATE) AS d FROM (
  SELECT min(occurred_at) AS a, max(occurred_at) AS b FROM staged_incidents
  UNION ALL SELECT min(started_at), max(started_at) FROM staged_trips))""",
    ints="year month day day_of_week",
)
def project_dates(d: Domain) -> DataFrame:
    limits = tables.bounds_of((d.staged_incidents, "occurred_at"), (d.staged_trips, "started_at"))
    return tables.project_dates(limits)


@register(
    "cal32_wn8_wn9_wn10_fiscal_year_dates",
    FISCAL_SQL.format(month=12, start=1) + "SELECT * FROM dated",
    ints="fiscal_year_number fiscal_week_of_year",
)
def fiscal_year_dates(d: Domain) -> DataFrame:
    return tables.fiscal_year_dates(tables.date_dimension(_days(d)))


@register(
    "cal33_wn11_fiscal_periods",
    FISCAL_SQL.format(month=1, start=2)
    + """, p AS (SELECT *, CAST(least(floor((fiscal_week_of_year - 1) / 13), 3) AS INT) AS q,
  CASE WHEN fiscal_week_of_year = 53 THEN 3 WHEN (fiscal_week_of_year - 1) % 13 <= 3 THEN 1
    WHEN (fiscal_week_of_year - 1) % 13 <= 8 THEN 2 ELSE 3 END AS pq FROM dated)
SELECT date_day, fiscal_year_number, week_start_date, week_end_date, fiscal_week_of_year,
  dense_rank() OVER (PARTITION BY q * 3 + pq ORDER BY fiscal_week_of_year) AS fiscal_week_of_period,
  q * 3 + pq AS fiscal_period_number, q + 1 AS fiscal_quarter_number, pq AS fiscal_period_of_quarter FROM p""",
    ints="fiscal_year_number fiscal_week_of_year fiscal_week_of_period",
)
def fiscal_periods(d: Domain) -> DataFrame:
    return tables.fiscal_periods(tables.date_dimension(_days(d)), year_end_month=1, week_start_day=2)


@register(
    "jn11_trips_per_fiscal_period",
    FISCAL_SQL.format(month=12, start=1)
    + """SELECT fiscal_year_number, fiscal_week_of_year, count(*) AS trip_count
FROM trips JOIN dated ON trips.date_key = dated.date_day GROUP BY ALL""",
    ints="fiscal_year_number fiscal_week_of_year",
)
def trips_per_fiscal_week(d: Domain) -> DataFrame:
    fiscal = tables.fiscal_year_dates(tables.date_dimension(_days(d))).withColumnRenamed("date_day", "date_key")
    # Count per day first: the calendar then meets one row per day.
    daily = d.trips.groupBy("date_key").agg(F.count(F.lit(1)).alias("n"))
    return daily.join(fiscal, "date_key").groupBy("fiscal_year_number", "fiscal_week_of_year").agg(
        F.sum("n").alias("trip_count")
    )


@register(
    "cal34_cal36_numbered_literals",
    """SELECT generated_number, MAKE_DATE(1992, 2, 29) AS d, MAKE_TIMESTAMP(1992, 2, 29, 6, 30, 15.0) AS t,
  count(o_orderkey) AS n FROM (SELECT unnest(generate_series(1, 60)) AS generated_number) s
LEFT JOIN orders ON o_orderdate = MAKE_DATE(1992, 2, 29) + CAST(generated_number AS INT) GROUP BY ALL""",
)
def numbered_literals(d: Domain) -> DataFrame:
    """Orders on each of the 60 days after a literal day."""
    day = cal.date_literal(1992, 2, 29)
    numbers = tables.number_series(d.spark, 60).withColumn("o_orderdate", F.date_add(day, F.col("generated_number").cast("int")))
    orders = d.table("orders").select(F.to_date("o_orderdate").alias("o_orderdate"), "o_orderkey")
    counted = numbers.join(orders, "o_orderdate", "left").groupBy("generated_number").agg(F.count("o_orderkey").alias("n"))
    return counted.select("generated_number", day.alias("d"), cal.datetime_literal(1992, 2, 29, 6, 30, 15).alias("t"), "n")
