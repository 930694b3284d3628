"""Golden calendar rows and the date helpers."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from cyclograph.functions import calendar as cal
from cyclograph.plans import calendar_tables as tables

D = dt.date

# Expected rows for two dates.
GOLDEN = {
    D(2020, 11, 29): {
        "prior_date_day": D(2020, 11, 28),
        "next_date_day": D(2020, 11, 30),
        "day_of_week_name": "Sunday",
        "day_of_week_name_short": "Sun",
        "day_of_week_name_nl": "zondag",
        "day_of_week_name_short_de": "So",
        "day_of_month": 29,
        "day_of_week": 1,
        "day_of_week_iso": 7,
        "day_of_year": 334,
        "week_start_date": D(2020, 11, 29),
        "week_end_date": D(2020, 12, 5),
        "week_of_year": 48,
        "iso_week_start_date": D(2020, 11, 23),
        "iso_week_end_date": D(2020, 11, 29),
        "iso_week_of_year": 48,
        "iso_year_week": "2020-W48",
        "month_of_year": 11,
        "month_name": "November",
        "month_name_short": "Nov",
        "month_name_nl": "november",
        "month_name_short_de": "Nov",
    },
    D(2020, 12, 1): {
        "prior_date_day": D(2020, 11, 30),
        "next_date_day": D(2020, 12, 2),
        "day_of_week_name": "Tuesday",
        "day_of_week_name_short": "Tue",
        "day_of_week_name_nl": "dinsdag",
        "day_of_week_name_short_de": "Di",
        "day_of_month": 1,
        "day_of_week": 3,
        "day_of_week_iso": 2,
        "day_of_year": 336,
        "week_start_date": D(2020, 11, 29),
        "week_end_date": D(2020, 12, 5),
        "week_of_year": 48,
        "iso_week_start_date": D(2020, 11, 30),
        "iso_week_end_date": D(2020, 12, 6),
        "iso_week_of_year": 49,
        "iso_year_week": "2020-W49",
        "month_of_year": 12,
        "month_name": "December",
        "month_name_short": "Dec",
        "month_name_nl": "december",
        "month_name_short_de": "Dez",
    },
}

# Fixed values: (Monday long, Monday short, Wednesday short, March long, June short, October short).
NAMES = {
    "en": ("Monday", "Mon", "Wed", "March", "Jun", "Oct"),
    "nl": ("maandag", "ma", "wo", "maart", "jun", "okt"),
    "de": ("Montag", "Mo", "Mi", "März", "Jun", "Okt"),
    "fr": ("lundi", "lun", "mer", "mars", "juin", "oct"),
    "es": ("lunes", "lun", "mié", "marzo", "jun", "oct"),
    "it": ("lunedì", "lun", "mer", "marzo", "giu", "ott"),
    "pt": ("segunda-feira", "seg", "qua", "março", "jun", "out"),
    "pl": ("poniedziałek", "pon", "śr", "marzec", "cze", "paź"),
    "da": ("mandag", "man", "ons", "marts", "jun", "okt"),
    "sv": ("måndag", "mån", "ons", "mars", "jun", "okt"),
    "tr": ("Pazartesi", "Pzt", "Çar", "Mart", "Haz", "Eki"),
    "cs": ("pondělí", "po", "st", "březen", "čer", "říj"),
    "fi": ("maanantai", "ma", "ke", "maaliskuu", "kesä", "loka"),
}


def one(spark, **columns):
    return spark.range(1).select(*[c.alias(n) for n, c in columns.items()]).first().asDict()


def test_golden_rows(spark):
    spine = tables.date_spine(tables.bounds(spark, "2015-01-01", "2022-12-31"))
    rows = tables.date_dimension(spine, ["nl", "de"]).filter(F.col("date_day").isin(list(GOLDEN)))
    found = {r["date_day"]: r.asDict() for r in rows.collect()}
    for day, expected in GOLDEN.items():
        assert {k: found[day][k] for k in expected} == expected
    assert len(tables.date_dimension(spine).columns) == 37


def test_quarter_year_and_prior_year_ends(spark):
    day = tables.date_dimension(spark.sql("SELECT DATE'2020-02-29' AS date_day")).first()
    assert (day["quarter_start_date"], day["quarter_end_date"]) == (D(2020, 1, 1), D(2020, 3, 31))
    assert (day["year_end_date"], day["month_end_date"]) == (D(2020, 12, 31), D(2020, 2, 29))
    assert (day["prior_year_date_day"], day["prior_year_month_end_date"]) == (D(2019, 2, 28), D(2019, 2, 28))
    assert day["prior_year_over_year_date_day"] == D(2019, 3, 2)


@pytest.mark.parametrize("language", cal.LANGUAGES)
def test_localized_names(spark, language):
    day = lambda text: F.lit(text).cast("date")
    row = one(
        spark,
        a=cal.day_name(day("2024-01-01"), short=False, language=language),
        b=cal.day_name(day("2024-01-01"), language=language),
        c=cal.day_name(day("2024-01-03"), language=language),
        d=cal.month_name(day("2024-03-05"), short=False, language=language),
        e=cal.month_name(day("2024-06-05"), language=language),
        f=cal.month_name(day("2024-10-05"), language=language),
    )
    assert tuple(row.values()) == NAMES[language]


def test_unknown_language_is_refused():
    with pytest.raises(ValueError):
        cal.day_name("d", language="xx")


@pytest.mark.parametrize(
    "day, week",
    [("2021-01-01", "2020-W53"), ("2018-12-31", "2019-W01"), ("2016-01-03", "2015-W53"), ("2024-12-30", "2025-W01")],
)
def test_iso_year_week(spark, day, week):
    assert one(spark, w=cal.iso_year_week(F.lit(day).cast("date")))["w"] == week


def test_epochs_zones_and_rounding(spark):
    moment = cal.from_unix(F.lit(1623076520))
    row = one(
        spark,
        utc=moment.cast("timestamp_ntz"),
        la=cal.convert_timezone(moment, "America/Los_Angeles"),
        back=cal.to_unix(moment),
        ms=cal.from_unix(F.lit(1623076520123), "milliseconds").cast("timestamp_ntz"),
        us=cal.from_unix(F.lit(1623076520123456), "microseconds").cast("timestamp_ntz"),
        ns=cal.from_unix(F.lit(1623076520123456789), "nanoseconds").cast("timestamp_ntz"),
        rounded=cal.round_to_day(moment).cast("date"),
        rounded_la=cal.round_to_day(cal.convert_timezone(moment, "America/Los_Angeles")).cast("date"),
        literal=cal.datetime_literal(2021, 6, 7, 14, 35, 20),
        zoned=cal.datetime_literal(2021, 6, 7, 7, 35, 20, "America/Los_Angeles").cast("timestamp_ntz"),
        date=cal.date_literal(2021, 6, 7),
    )
    assert row["utc"] == row["literal"] == row["zoned"] == dt.datetime(2021, 6, 7, 14, 35, 20)
    assert row["la"] == dt.datetime(2021, 6, 7, 7, 35, 20)
    assert row["back"] == 1623076520
    assert row["ms"].microsecond == 123000 and row["us"].microsecond == row["ns"].microsecond == 123456
    assert (row["rounded"], row["rounded_la"]) == (D(2021, 6, 8), D(2021, 6, 7))
    assert row["date"] == D(2021, 6, 7)
    with pytest.raises(ValueError):
        cal.from_unix(F.lit(1), "fortnights")


def test_relative_to_now(spark):
    at = {"as_of": F.lit("2024-03-31 23:30:00").cast("timestamp")}
    row = one(
        spark,
        today=cal.today(**at),
        tokyo=cal.today("Asia/Tokyo", **at),
        yesterday=cal.yesterday(**at),
        tomorrow=cal.tomorrow(**at),
        other=cal.tomorrow(F.lit("2024-02-28").cast("date")),
        last_week=cal.last_week(**at),
        weeks=cal.n_weeks_away(2, **at),
        last_month=cal.last_month(**at),
        next_month=cal.next_month(**at),
        name=cal.last_month_name(**at),
        number=cal.next_month_number(**at),
        days=cal.n_days_away(3, **at),
    )
    assert row == {
        "today": D(2024, 3, 31),
        "tokyo": D(2024, 4, 1),
        "yesterday": D(2024, 3, 30),
        "tomorrow": D(2024, 4, 1),
        "other": D(2024, 2, 29),
        "last_week": D(2024, 3, 18),
        "weeks": D(2024, 4, 8),
        "last_month": D(2024, 2, 1),
        "next_month": D(2024, 4, 1),
        "name": "Feb",
        "number": 4,
        "days": D(2024, 4, 3),
    }


def test_periods_count_boundaries(spark):
    start, end = F.lit("2024-01-31 23:59:00").cast("timestamp"), F.lit("2024-02-01 00:01:00").cast("timestamp")
    parts = ("day", "week", "month", "quarter", "year", "hour", "minute", "second")
    row = one(spark, **{p: cal.periods_since(start, p, as_of=end) for p in parts})
    assert row == dict(day=1, week=0, month=1, quarter=0, year=0, hour=1, minute=2, second=120)


def test_spine_counts_boundaries_and_excludes_the_end(spark):
    def spine(start, end, part):
        return [r[0] for r in tables.date_spine(tables.bounds(spark, start, end), part).orderBy(f"date_{part}").collect()]

    assert len(spine("2020-01-01", "2020-01-04", "day")) == 3
    assert len(spine("2020-01-15", "2020-02-20", "month")) == 1
    assert spine("2020-01-31", "2020-04-01", "month")[1].date() == D(2020, 2, 29)
    assert len(spine("2020-01-01 05:00:00", "2020-01-01 09:30:00", "hour")) == 4
    assert spine("2020-01-01", "2020-01-01", "day") == []


def test_base_dates_and_series(spark):
    as_of = F.lit("2024-03-31 12:00:00").cast("timestamp")
    days = [r[0].date() for r in tables.base_dates(spark, n_parts=3, as_of=as_of).collect()]
    assert sorted(days) == [D(2024, 3, 28), D(2024, 3, 29), D(2024, 3, 30), D(2024, 3, 31)]
    with pytest.raises(ValueError):
        tables.base_dates(spark)
    assert [r[0] for r in tables.number_series(spark, 3).collect()] == [1, 2, 3]
    with pytest.raises(ValueError):
        tables.number_series(spark, 0)


def test_fiscal_calendar_ending_in_january(spark):
    spine = tables.date_spine(tables.bounds(spark, "2015-01-01", "2022-12-31"))
    dates = tables.date_dimension(spine)
    rows = {r["date_day"]: r for r in tables.fiscal_periods(dates, 1, 1, 1).collect()}
    # The Saturday closest to 31 January 2020 is 1 February.
    assert rows[D(2020, 2, 1)]["fiscal_year_number"] + 1 == rows[D(2020, 2, 2)]["fiscal_year_number"]
    first = rows[D(2020, 2, 2)]
    assert (first["fiscal_week_of_year"], first["fiscal_period_number"], first["fiscal_quarter_number"]) == (1, 1, 1)
    assert rows[D(2020, 3, 1)]["fiscal_period_number"] == 2  # 4 weeks, then 5, then 4
    assert rows[D(2020, 4, 5)]["fiscal_period_number"] == 3
    assert rows[D(2020, 5, 3)]["fiscal_quarter_number"] == 2
    long_years = {r["fiscal_year_number"] for r in rows.values() if r["fiscal_week_of_year"] == 53}
    for row in rows.values():
        if row["fiscal_week_of_year"] == 53:
            assert (row["fiscal_period_number"], row["fiscal_period_of_quarter"]) == (12, 3)
    assert long_years
