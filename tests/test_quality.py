"""Each check with input that passes, input that fails, and NULLs."""

import pytest
from pyspark.sql import functions as F

from cyclograph import quality as q
from cyclograph.quality import suite


@pytest.fixture(scope="module")
def table(spark):
    # The rows that the expected outcomes below refer to.
    return spark.createDataFrame(
        [
            (1, "2020-10-21", 0.0, 1.0, "a", "b", None, None, 2, -2),
            (2, "2020-10-22", 1.0, 0.0, "b", "ab", None, None, 4, -4),
            (3, "2020-10-23", 0.5, 0.5, "c", "abc", None, None, 6, -6),
            (4, "2020-10-23", 0.5, 0.5, "c", "abcd", None, None, 8, -8),
        ],
        "idx int, date_col string, col_numeric_a double, col_numeric_b double, col_string_a string,"
        " col_string_b string, col_null string, col_null_2 string, twice int, minus_twice int",
    ).withColumn("total", F.lit("1.0").cast("decimal(3,1)"))


@pytest.fixture(scope="module")
def texts(spark):
    return spark.createDataFrame(
        [("ab@mail.com", "12345"), ("cd@mail.com", "54321"), ("ef@post.net", "99999"), ("gh@post.net", "10101")],
        "email string, postal string",
    )


@pytest.fixture(scope="module")
def holes(spark):
    """A column with a NULL in it."""
    return spark.createDataFrame([(1, "a", 1.0), (2, None, None), (3, "b", 3.0)], "k int, s string, v double")


PASSING = [
    lambda t: q.expression_is_true("col_numeric_a + col_numeric_b = 1"),
    lambda t: q.expression_is_true("count(*)", test_condition="> 0", group_by=["date_col"]),
    lambda t: q.expression_is_true("idx", test_condition="> 1", row_condition="idx > 1"),
    lambda t: q.expression_between("sum(col_numeric_a)", 2, 2),
    lambda t: q.equal_expression("sum(col_numeric_a)", compare_expression="sum(col_numeric_b)"),
    lambda t: q.equal_expression("count(*)", t, group_by=["date_col"]),
    lambda t: q.equal_expression("sum(idx)", compare_expression="sum(idx) + 1", tolerance=1),
    lambda t: q.equal_expression("sum(idx)", compare_expression="sum(idx) + 1", tolerance_percent=0.1),
    lambda t: q.distinct_count_to_equal("date_col", 3),
    lambda t: q.distinct_count_to_be_greater_than("date_col", 2),
    lambda t: q.distinct_count_to_be_less_than("date_col", 4),
    lambda t: q.distinct_count_to_equal_other_table("date_col"),
    lambda t: q.distinct_values_to_be_in_set("col_string_a", ["a", "b", "c", "d"]),
    lambda t: q.distinct_values_to_contain_set("col_string_a", ["a", "c"]),
    lambda t: q.distinct_values_to_equal_set("col_string_a", ["a", "b", "c", "c"]),
    lambda t: q.column_max_to_be_between("idx", 4, 4),
    lambda t: q.column_min_to_be_between("idx", 0, 1),
    lambda t: q.column_mean_to_be_between("col_numeric_a", 0.5, 0.5),
    lambda t: q.column_median_to_be_between("col_numeric_a", 0.5, 0.5),
    lambda t: q.column_quantile_values_to_be_between("idx", 0.25, 1.75, 1.75),
    lambda t: q.column_quantile_values_to_be_between("idx", 0.5, 2, 3, approximate=True),
    lambda t: q.column_stdev_to_be_between("col_numeric_a", 0, 1, strictly=True),
    lambda t: q.column_stdev_to_be_between("idx", 5, 6, row_condition="idx = 1"),  # NULL for one value
    lambda t: q.column_sum_to_be_between("idx", 10, 10),
    lambda t: q.column_sum_to_be_between("idx", max_value=7, group_by=["date_col"]),
    lambda t: q.column_unique_value_count_to_be_between("col_string_a", 3, 3),
    lambda t: q.column_proportion_of_unique_values_to_be_between("idx", 1, 1),
    lambda t: q.column_proportion_of_unique_values_to_be_between("col_null", 1, 1),
    lambda t: q.column_most_common_value_to_be_in_set("col_string_a", ["c"], 1),
    lambda t: q.column_most_common_value_to_be_in_set("col_numeric_a", [0.5], 1, data_type="decimal(3,1)"),
    lambda t: q.column_most_common_value_to_be_in_set("col_null", ["x"], 1),
    lambda t: q.column_most_common_value_to_be_in_set("col_string_a", ["x"], 9),  # no such rank
    lambda t: q.values_to_be_between("col_numeric_a", 0, 1),
    lambda t: q.values_to_be_between("col_null", "a", "b"),
    lambda t: q.values_to_be_increasing("idx"),
    lambda t: q.values_to_be_increasing("date_col", strictly=False, tiebreak="idx"),
    lambda t: q.values_to_be_increasing("twice", "idx", step=2),
    lambda t: q.values_to_be_decreasing("minus_twice", "idx", step=2),
    lambda t: q.values_to_be_decreasing("idx", "minus_twice", group_by=["date_col"], row_condition="idx < 3"),
    lambda t: q.values_to_be_in_set("col_string_a", ["a", "b", "c"]),
    lambda t: q.values_to_not_be_in_set("col_string_a", ["x"]),
    lambda t: q.values_to_not_be_in_set("col_null", ["x"]),
    lambda t: q.values_to_be_in_type_list("idx", ["INT", "bigint"]),
    lambda t: q.values_to_be_of_type("date_col", "String"),
    lambda t: q.values_to_be_of_type("no_such_column", "int"),
    lambda t: q.values_to_be_null("col_null"),
    lambda t: q.values_to_not_be_null("idx"),
    lambda t: q.values_to_be_unique("idx"),
    lambda t: q.values_to_be_unique("col_null"),
    lambda t: q.values_to_have_consistent_casing("col_string_a"),
    lambda t: q.pair_values_A_to_be_greater_than_B("twice", "idx"),
    lambda t: q.pair_values_A_to_be_greater_than_B("col_numeric_a", "col_numeric_a", or_equal=True),
    lambda t: q.pair_values_A_to_be_greater_than_B("col_null", "idx"),
    lambda t: q.pair_values_to_be_equal("col_numeric_a", "col_numeric_a"),
    lambda t: q.pair_values_to_be_in_set("col_numeric_a", "col_numeric_b", [(0, 1), (1, 0), (0.5, 0.5)]),
    lambda t: q.compound_columns_to_be_unique(["date_col", "col_string_b"]),
    lambda t: q.compound_columns_to_be_unique(["date_col", "col_null"], "any_value_is_missing"),
    lambda t: q.compound_columns_to_be_unique(["col_null", "col_null_2"]),
    lambda t: q.multicolumn_sum_to_equal(["col_numeric_a", "col_numeric_b"], 4),
    lambda t: q.multicolumn_sum_to_equal(["col_numeric_a", "col_numeric_b"], "total"),
    lambda t: q.multicolumn_sum_to_equal(["idx"], 10.5, tolerance=0.5),
    lambda t: q.select_column_values_to_be_unique_within_record(["col_string_a", "col_string_b"]),
    lambda t: q.select_column_values_to_be_unique_within_record(["idx", "col_null"], "any_value_is_missing"),
    lambda t: q.value_lengths_to_be_between("col_string_b", 1, 4),
    lambda t: q.value_lengths_to_equal("col_string_a", 1),
    lambda t: q.value_lengths_to_equal("col_null", 1),
    lambda t: q.within_n_stdevs("idx", ["date_col"], 6),
    lambda t: q.within_n_stdevs("idx"),
    lambda t: q.column_to_exist("IDX", 1),
    lambda t: q.column_to_exist("date_col", 0),
    lambda t: q.table_column_count_to_be_between(1, 11),
    lambda t: q.table_column_count_to_be_between(0, 11),
    lambda t: q.table_column_count_to_equal(11),
    lambda t: q.table_column_count_to_equal_other_table(t),
    lambda t: q.table_columns_to_contain_set(["idx", "DATE_COL"]),
    lambda t: q.table_columns_to_not_contain_set(["other"]),
    lambda t: q.table_columns_to_match_set(t.columns[::-1]),
    lambda t: q.table_columns_to_match_ordered_list(t.columns),
    lambda t: q.table_row_count_to_be_between(1, 4),
    lambda t: q.table_row_count_to_be_between(max_value=2, group_by=["date_col"]),
    lambda t: q.table_row_count_to_equal(4),
    lambda t: q.table_row_count_to_equal(2, row_condition="idx > 2"),
    lambda t: q.table_row_count_to_equal_other_table(t),
    lambda t: q.table_row_count_to_equal_other_table(t.unionAll(t), 0.5),
    lambda t: q.table_row_count_to_equal_other_table_times_factor(t.filter("idx < 3"), 2),
    lambda t: q.table_aggregation_to_equal_other_table("sum(idx)", t),
    lambda t: q.unique("idx"),
    lambda t: q.not_null("idx"),
    lambda t: q.accepted_values("col_string_a", ["a", "b", "c"]),
    lambda t: q.relationships("idx", t, "idx"),
    lambda t: q.relationships("col_null", t, "col_string_a"),
]

FAILING = [
    (lambda t: q.expression_is_true("idx > 1"), 1),
    (lambda t: q.expression_is_true("count(*) = 1", group_by=["date_col"]), 1),
    (lambda t: q.expression_between("idx", 2, 3, strictly=True), 4),
    (lambda t: q.equal_expression("sum(idx)", compare_expression="sum(twice)"), 1),
    (lambda t: q.equal_expression("count(*)", t.filter("idx < 3"), group_by=["date_col"]), 1),
    (lambda t: q.equal_expression("count(*)", t, group_by=["col_null"]), 2),  # NULL groups never match
    (lambda t: q.distinct_count_to_equal("date_col", 4), 1),
    (lambda t: q.distinct_count_to_be_greater_than("date_col", 3), 1),
    (lambda t: q.distinct_count_to_be_less_than("date_col", 3), 1),
    (lambda t: q.distinct_count_to_equal_other_table("date_col", t, "idx"), 1),
    (lambda t: q.distinct_values_to_be_in_set("col_string_a", ["a", "b"]), 1),
    (lambda t: q.distinct_values_to_be_in_set("col_null", ["a"]), 1),  # NULL fails
    (lambda t: q.distinct_values_to_contain_set("col_string_a", ["a", "x", "x"]), 1),
    (lambda t: q.distinct_values_to_equal_set("col_string_a", ["a", "b", "x"]), 2),
    (lambda t: q.distinct_values_to_equal_set("col_null", ["a"]), 2),
    (lambda t: q.column_max_to_be_between("idx", 0, 3), 1),
    (lambda t: q.column_min_to_be_between("idx", 2), 1),
    (lambda t: q.column_mean_to_be_between("idx", 0, 1, group_by=["date_col"]), 2),
    (lambda t: q.column_median_to_be_between("idx", 3, 4), 1),
    (lambda t: q.column_quantile_values_to_be_between("idx", 0.25, 2), 1),
    (lambda t: q.column_stdev_to_be_between("idx", 0, 1), 1),
    (lambda t: q.column_sum_to_be_between("idx", 10, 11, strictly=True), 1),
    (lambda t: q.column_unique_value_count_to_be_between("col_string_a", 4), 1),
    (lambda t: q.column_proportion_of_unique_values_to_be_between("col_string_a", 0.8), 1),
    (lambda t: q.column_most_common_value_to_be_in_set("col_string_a", ["a"], 1), 1),
    (lambda t: q.values_to_be_between("idx", 2, 4, strictly=True), 3),
    (lambda t: q.values_to_be_increasing("date_col", tiebreak="idx"), 1),
    (lambda t: q.values_to_be_increasing("idx", step=2), 3),
    (lambda t: q.values_to_be_decreasing("idx"), 3),
    (lambda t: q.values_to_be_in_set("col_string_a", ["a", "b"]), 2),
    (lambda t: q.values_to_be_in_set("col_null", ["a"]), 4),  # NULL fails
    (lambda t: q.values_to_not_be_in_set("col_string_a", ["c", "c"]), 2),
    (lambda t: q.values_to_be_in_type_list("idx", ["string"]), 1),
    (lambda t: q.values_to_be_of_type("date_col", "date"), 1),
    (lambda t: q.values_to_be_null("idx"), 4),
    (lambda t: q.values_to_not_be_null("col_null"), 4),
    (lambda t: q.values_to_be_unique("date_col"), 1),
    (lambda t: q.pair_values_A_to_be_greater_than_B("col_numeric_a", "col_numeric_b"), 3),
    (lambda t: q.pair_values_to_be_equal("col_numeric_a", "col_numeric_b"), 2),
    (lambda t: q.pair_values_to_be_in_set("col_numeric_a", "col_numeric_b", [(0, 1), (1, 0)]), 2),
    (lambda t: q.compound_columns_to_be_unique(["date_col", "col_null"]), 1),
    (lambda t: q.multicolumn_sum_to_equal(["idx"], "twice"), 1),
    (lambda t: q.multicolumn_sum_to_equal(["col_numeric_a"], 1, group_by=["date_col"]), 1),
    (lambda t: q.select_column_values_to_be_unique_within_record(["idx", "col_null"]), 4),
    (lambda t: q.select_column_values_to_be_unique_within_record(["idx", "twice", "idx"]), 4),
    (lambda t: q.value_lengths_to_be_between("col_string_b", 2, 3), 2),
    (lambda t: q.value_lengths_to_equal("col_string_b", 1), 3),
    (lambda t: q.within_n_stdevs("idx", ["date_col"], 1), 1),
    (lambda t: q.column_to_exist("nope"), 1),
    (lambda t: q.column_to_exist("idx", 2), 1),
    (lambda t: q.table_column_count_to_be_between(12, 20), 1),
    (lambda t: q.table_column_count_to_equal(10), 1),
    (lambda t: q.table_column_count_to_equal_other_table(t.drop("idx")), 1),
    (lambda t: q.table_columns_to_contain_set(["idx", "nope"]), 1),
    (lambda t: q.table_columns_to_not_contain_set(["IDX"]), 1),
    (lambda t: q.table_columns_to_match_set(["idx", "nope"]), 11),
    (lambda t: q.table_columns_to_match_ordered_list(t.columns[1::-1] + t.columns[2:]), 4),
    (lambda t: q.table_row_count_to_be_between(5), 1),
    (lambda t: q.table_row_count_to_equal(1, group_by=["date_col"]), 1),
    (lambda t: q.table_row_count_to_equal_other_table(t.filter("idx = 1")), 1),
    (lambda t: q.table_row_count_to_equal_other_table_times_factor(t, 2), 1),
    (lambda t: q.table_aggregation_to_equal_other_table("sum(idx)", t.filter("idx < 4")), 1),
    (lambda t: q.unique("date_col"), 1),
    (lambda t: q.not_null("col_null"), 4),
    (lambda t: q.accepted_values("col_string_a", ["a"]), 2),
    (lambda t: q.relationships("idx", t.filter("idx < 3"), "idx"), 2),
]


@pytest.mark.parametrize("build", PASSING)
def test_passes(table, build):
    check = build(table)
    assert check(table).count() == 0
    assert suite.outcomes(table, [check]).first()["status"] == "pass"


@pytest.mark.parametrize("build, n", FAILING)
def test_fails(table, build, n):
    check = build(table)
    assert check(table).count() == n
    outcome = suite.outcomes(table, [check]).first()
    assert (outcome["status"], outcome["failures"]) == ("fail", n)


def test_text_patterns(texts):
    def n(check):
        return check(texts).count()

    assert n(q.match_regex("email", "@[^.]*")) == 0
    assert n(q.match_regex("email", "&[^.]*")) == 4
    assert n(q.match_regex("email", "[A-Z]", flags="i")) == 0
    assert n(q.match_regex("email", "(?i)[A-Z]", flags="i")) == 0
    assert n(q.match_regex("email", "[A-Z]")) == 4
    assert n(q.not_match_regex("email", "&[^.]*")) == 0
    assert n(q.not_match_regex("email", "[a-z]")) == 4
    assert n(q.match_regex_list("email", ["@[^.]*", "&[^.]*"])) == 0
    assert n(q.match_regex_list("email", ["@[^.]*", "&[^.]*"], match_on="all")) == 4
    assert n(q.not_match_regex_list("email", ["@[^.]*", "&[^.]*"])) == 0
    assert n(q.not_match_regex_list("email", ["@[^.]*", "@[^.]*"])) == 4
    assert n(q.not_match_regex_list("email", ["@[^.]*", "&[^.]*"], match_on="all")) == 4
    assert n(q.match_like_pattern("email", "%@%")) == 0
    assert n(q.match_like_pattern("email", "%&%")) == 4
    assert n(q.match_like_pattern_list("email", ["%@%", "%&%"])) == 0
    assert n(q.match_like_pattern_list("email", ["%@%", "%&%"], match_on="all")) == 4
    assert n(q.not_match_like_pattern("email", "%@%")) == 4
    assert n(q.not_match_like_pattern_list("email", ["%@%", "%&%"])) == 0
    assert n(q.not_match_like_pattern_list("email", ["%@%", "%&%"], match_on="all")) == 4
    assert n(q.match_regex("postal", r"^\d{5}", is_raw=True)) == 0
    assert n(q.match_regex("postal", r"^\d{55}", is_raw=True)) == 4
    with pytest.raises(ValueError):
        q.match_regex_list("email", ["a"], match_on="some")


def test_null_text_passes(holes):
    for check in (
        q.match_regex("s", "^[ab]$"),
        q.match_like_pattern("s", "_"),
        q.not_match_regex("s", "x"),
        q.not_match_like_pattern("s", "x"),
        q.value_lengths_to_be_between("s", 1, 1),
    ):
        assert check(holes).count() == 0


def test_null_in_value_checks(holes):
    assert q.values_to_be_in_set("s", ["a", "b"])(holes).select("k").collect() == [(2,)]
    assert q.values_to_not_be_in_set("s", ["a"])(holes).select("k").collect() == [(1,)]
    assert q.distinct_values_to_be_in_set("s", ["a", "b"])(holes).count() == 1
    assert q.values_to_have_consistent_casing("s")(holes).count() == 1  # summary form counts the NULL
    assert q.values_to_have_consistent_casing("s", True)(holes).count() == 0
    # The NULL in between hides its neighbours from each other.
    assert q.values_to_be_decreasing("v", "k")(holes).count() == 0
    assert q.values_to_be_increasing("v", "k")(holes).count() == 0
    assert q.pair_values_to_be_in_set("s", "k", [("a", 1)])(holes).select("k").collect() == [(2,), (3,)]


def test_casing(spark):
    mixed = spark.createDataFrame([("Ab",), ("aB",), ("c",)], "s string")
    assert q.values_to_have_consistent_casing("s")(mixed).first().asDict() == {
        "set_count": 3,
        "set_count_case_insensitive": 2,
    }
    assert q.values_to_have_consistent_casing("s", True)(mixed).collect() == [("ab", 2)]


def test_arguments_are_checked():
    with pytest.raises(ValueError):
        q.expression_between("x")
    with pytest.raises(ValueError):
        q.values_to_be_between("x")
    with pytest.raises(ValueError):
        q.table_column_count_to_be_between()
    with pytest.raises(ValueError):
        q.compound_columns_to_be_unique([])
    with pytest.raises(ValueError):
        q.compound_columns_to_be_unique(["a"], "sometimes")
    with pytest.raises(ValueError):
        q.pair_values_to_be_in_set("a", "b", [(1, 2, 3)])


def test_zero_reference_passes_a_relative_tolerance(spark):
    zero = spark.createDataFrame([(0,)], "n int")
    five = spark.createDataFrame([(5,)], "n int")
    assert q.equal_expression("sum(n)", five, tolerance_percent=0.1)(zero).count() == 0
    assert q.equal_expression("sum(n)", five)(zero).count() == 1


# --- time --------------------------------------------------------------------------

NOW = "2024-03-31 12:00:00"


@pytest.fixture(scope="module")
def series(spark):
    """A year of days with an arithmetic value and one spike six days before 'now'."""
    return spark.sql(
        """SELECT CAST(date_sub(DATE'2024-03-31', CAST(id AS INT)) AS TIMESTAMP) AS at,
                  CASE WHEN id = 6 THEN 100000.0 ELSE 50 + (id * id * 31) % 13 END AS v, id % 2 AS g FROM range(366)"""
    )


def now():
    return F.lit(NOW).cast("timestamp")


def test_moving_deviation(series):
    options = {"sigma_threshold": 6, "as_of": now()}
    spikes = q.within_n_moving_stdevs("v", "at", **options)(series).collect()
    assert [str(r["metric_period"])[:10] for r in spikes] == ["2024-03-25"]
    assert q.within_n_moving_stdevs("v", "at", test_periods=3, **options)(series).count() == 0
    level = q.within_n_moving_stdevs("v", "cast(at as timestamp)", take_diffs=False, take_logs=False, **options)
    assert level(series).count() == 1
    grouped = q.within_n_moving_stdevs("v", "at", group_by=["g"], **options)(series)
    assert {r["g"] for r in grouped.collect()} == {0}
    flat = series.withColumn("v", F.lit(1))
    assert q.within_n_moving_stdevs("v", "at", **options)(flat).count() == 0  # no deviation passes


def test_deviation_between_groups(series):
    check = q.within_n_stdevs("v", ["to_date(at)"], 6)
    assert check(series).count() == 1


def test_every_period_has_data(series, spark):
    every_day = q.row_values_to_have_data_for_every_n_datepart
    assert every_day("at")(series).count() == 0
    gap = series.filter("to_date(at) NOT IN ('2024-02-01', '2024-02-04')")
    assert sorted(str(r["date_day"])[:10] for r in every_day("at")(gap).collect()) == ["2024-02-01", "2024-02-04"]
    assert every_day("at", exclusion_condition="date_day <> '2024-02-01'")(gap).count() == 1
    assert every_day("at", test_start_date="2024-02-02", test_end_date="2024-02-05")(gap).count() == 1
    assert every_day("at", test_start_date="2024-03-30", test_end_date="2024-04-03")(gap).count() == 2
    assert every_day("at", test_end_date="2024-04-02")(gap).count() == 3
    assert every_day("at", row_condition="to_date(at) >= '2024-02-02'")(gap).count() == 1
    assert every_day("at", interval=7)(gap).count() == 0
    hours = spark.sql("SELECT timestampadd(HOUR, CAST(id AS INT), TIMESTAMP'2024-01-01 05:00:00') AS at FROM range(0, 48)")
    # Hourly spines run from midnight of the first day to midnight of the last one.
    assert every_day("at", "hour")(hours).count() == 5


def test_recency(series):
    recent = q.row_values_to_have_recent_data
    assert recent("at", "day", 1, as_of=now())(series).count() == 0
    assert recent("at", "hour", 6, as_of=now())(series).count() == 1
    assert recent("at", "day", 1, row_condition="1 = 2", as_of=now())(series).count() == 1  # no rows fail
    late = F.lit("2024-03-01").cast("timestamp")
    assert recent("at", "day", 1, as_of=late)(series).count() == 0  # later rows do not count
    grouped = q.grouped_row_values_to_have_recent_data
    assert [r["g"] for r in grouped(["g"], "at", "hour", 20, as_of=now())(series).collect()] == [1]
    assert grouped(["g"], "at", "hour", 20, row_condition="g = 0", as_of=now())(series).count() == 0


# --- suites ------------------------------------------------------------------------


def test_suite_uses_one_scan_for_fusible_checks(table):
    checks = [
        q.values_to_be_between("idx", 2, 3),
        q.column_max_to_be_between("idx", 0, 3),
        q.column_mean_to_be_between("idx", 3.5, 3.5, row_condition="idx > 2"),
        q.table_row_count_to_equal(2, row_condition="idx > 2"),
        q.match_regex("col_string_a", "^[ab]$").configured(severity="warn"),
    ]
    outcomes = suite.outcomes(table, checks)
    found = {r["test_name"]: (r["status"], r["failures"]) for r in outcomes.collect()}
    assert list(found.values()) == [("fail", 2), ("fail", 1), ("pass", 0), ("pass", 0), ("warn", 2)]
    assert outcomes._jdf.queryExecution().optimizedPlan().toString().count("LogicalRDD") == 1


def test_thresholds(table):
    check = q.values_to_be_between("idx", 2, 3)
    status = lambda **options: suite.outcomes(table, [check.configured(**options)]).first()["status"]
    assert status(error_if="> 2") == "warn"
    assert status(error_if="> 2", warn_if="> 3") == "pass"
    assert status(error_if="= 0", warn_if="< 4") == "warn"
    assert status(severity="warn") == "warn"


def test_timed_run(table):
    rows = suite.run(table, [q.unique("idx"), q.not_null("idx"), q.not_null("col_null")]).collect()
    assert {r["test_name"]: r["status"] for r in rows} == {
        "not_null_idx": "pass",
        "not_null_col_null": "fail",
        "unique_idx": "pass",
    }
    assert all(r["execution_time"] > 0 for r in rows)
