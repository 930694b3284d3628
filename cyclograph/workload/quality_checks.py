"""Data-quality queries (DQ*): the bad rows of each check, on whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cyclograph import quality as q
from cyclograph.quality import suite
from cyclograph.workload.registry import Domain, register, rounded


def check(name: str, sql: str, table: str, *columns: str | tuple[str, int], ints: str = ""):
    """Register ``check(table)`` reduced to the given columns (all of them by default).

    A pair names a column and the digits it is rounded to.
    """

    def wrap(build):
        def query(d: Domain) -> DataFrame:
            bad = build(d)(d.table(table))
            shown = [c if isinstance(c, str) else rounded(*c).alias(c[0]) for c in columns]
            return bad.select(*shown) if shown else bad

        register(name, sql, ints)(query)
        return build

    return wrap


# --- generic -----------------------------------------------------------------------


@check(
    "dq1_expression_is_true",
    """SELECT l_returnflag, sum(l_quantity) > 500000 AS expression FROM lineitem WHERE l_tax > 0
GROUP BY ALL HAVING NOT (sum(l_quantity) > 500000)""",
    "lineitem",
)
def _(d):
    return q.expression_is_true("sum(l_quantity) > 500000", group_by=["l_returnflag"], row_condition="l_tax > 0")


@check(
    "dq2_expression_between",
    "SELECT o_custkey, false AS expression FROM orders GROUP BY ALL HAVING NOT (count(*) > 3 AND count(*) < 20)",
    "orders",
)
def _(d):
    return q.expression_between("count(*)", 3, 20, group_by=["o_custkey"], strictly=True)


@check(
    "dq3_jn9_equal_expression",
    """WITH a AS (SELECT l_suppkey AS k, count(*) AS e FROM lineitem WHERE l_suppkey IS NOT NULL GROUP BY ALL),
b AS (SELECT o_custkey AS k, count(*) AS e FROM orders GROUP BY ALL)
SELECT col_1, expression, compare_expression, expression_difference, round(p, 6) AS expression_difference_percent FROM (
  SELECT coalesce(a.k, b.k) AS col_1, a.e AS expression, b.e AS compare_expression,
    abs(coalesce(a.e, 0) - coalesce(b.e, 0)) AS expression_difference,
    abs(coalesce(a.e, 0) - coalesce(b.e, 0)) / nullif(a.e * 1.0::DOUBLE, 0) AS p
  FROM a FULL JOIN b ON a.k = b.k) WHERE expression_difference > 5""",
    "lineitem",
    "col_1",
    "expression",
    "compare_expression",
    "expression_difference",
    ("expression_difference_percent", 6),
)
def _(d):
    return q.equal_expression(
        "count(*)", d.table("orders"), group_by=["l_suppkey"], compare_group_by=["o_custkey"], tolerance=5
    )


# --- aggregates --------------------------------------------------------------------


@check(
    "dq10_distinct_count_greater_than",
    "SELECT user_id, count(DISTINCT event_type) AS expression FROM events GROUP BY ALL HAVING NOT count(DISTINCT event_type) > 5",
    "events",
)
def _(d):
    return q.distinct_count_to_be_greater_than("event_type", 5, group_by=["user_id"])


@check(
    "dq11_distinct_count_less_than",
    "SELECT count(DISTINCT l_partkey) AS expression FROM lineitem HAVING NOT count(DISTINCT l_partkey) < 10",
    "lineitem",
)
def _(d):
    return q.distinct_count_to_be_less_than("l_partkey", 10)


@check(
    "dq12_distinct_count_equal",
    "SELECT lang, count(DISTINCT source) AS expression FROM documents GROUP BY ALL HAVING count(DISTINCT source) <> 3",
    "documents",
)
def _(d):
    return q.distinct_count_to_equal("source", 3, group_by=["lang"])


@check(
    "dq13_distinct_count_equal_other_table",
    """SELECT a.n AS expression, b.n AS compare_expression, abs(a.n - b.n) AS expression_difference
FROM (SELECT count(DISTINCT l_orderkey) AS n FROM lineitem) a, (SELECT count(DISTINCT o_orderkey) AS n FROM orders) b WHERE a.n <> b.n""",
    "lineitem",
    "expression",
    "compare_expression",
    "expression_difference",
)
def _(d):
    return q.distinct_count_to_equal_other_table("l_orderkey", d.table("orders"), "o_orderkey")


@check(
    "dq14_dq98_distinct_values_in_set",
    "SELECT DISTINCT event_type AS value_field FROM events WHERE event_type NOT IN ('click', 'error')",
    "events",
)
def _(d):
    return q.distinct_values_to_be_in_set("event_type", ["click", "error"])


@check(
    "dq15_distinct_values_contain_set",
    """SELECT v AS value_field FROM (VALUES ('A'), ('R'), ('Z')) t(v)
WHERE v NOT IN (SELECT l_returnflag FROM lineitem WHERE l_returnflag IS NOT NULL)""",
    "lineitem",
)
def _(d):
    return q.distinct_values_to_contain_set("l_returnflag", ["A", "R", "Z", "Z"])


@check(
    "dq16_distinct_values_equal_set",
    """SELECT v.column_value, s.value_field FROM (SELECT DISTINCT l_returnflag AS column_value FROM lineitem) v
FULL JOIN (VALUES ('A'), ('R'), ('Z')) s(value_field) ON v.column_value = s.value_field
WHERE v.column_value IS NULL OR s.value_field IS NULL""",
    "lineitem",
)
def _(d):
    return q.distinct_values_to_equal_set("l_returnflag", ["A", "R", "Z"])


@check(
    "dq17_max_between",
    "SELECT l_suppkey, max(l_quantity) AS expression FROM lineitem WHERE l_tax > 0.01 GROUP BY ALL HAVING NOT max(l_quantity) BETWEEN 1 AND 49",
    "lineitem",
)
def _(d):
    return q.column_max_to_be_between("l_quantity", 1, 49, group_by=["l_suppkey"], row_condition="l_tax > 0.01")


@check(
    "dq18_min_between",
    "SELECT l_partkey, min(l_quantity) AS expression FROM lineitem GROUP BY ALL HAVING NOT min(l_quantity) > 1",
    "lineitem",
)
def _(d):
    return q.column_min_to_be_between("l_quantity", 1, group_by=["l_partkey"], strictly=True)


@check(
    "dq19_mean_between",
    """SELECT l_partkey, round(avg(l_quantity), 6) AS expression FROM lineitem GROUP BY ALL
HAVING NOT (avg(l_quantity) >= 20.001 AND avg(l_quantity) <= 30.001)""",
    "lineitem",
    "l_partkey",
    ("expression", 6),
)
def _(d):
    return q.column_mean_to_be_between("l_quantity", 20.001, 30.001, group_by=["l_partkey"])


@check(
    "dq20_median_between",
    """SELECT l_suppkey, round(quantile_cont(l_quantity, 0.5), 6) AS expression FROM lineitem GROUP BY ALL
HAVING NOT quantile_cont(l_quantity, 0.5) <= 25""",
    "lineitem",
    "l_suppkey",
    ("expression", 6),
)
def _(d):
    return q.column_median_to_be_between("l_quantity", max_value=25, group_by=["l_suppkey"])


@check(
    "dq21_quantile_between",
    """SELECT o_orderstatus, round(quantile_cont(o_totalprice, 0.95), 4) AS expression FROM orders GROUP BY ALL
HAVING NOT quantile_cont(o_totalprice, 0.95) < 100""",
    "orders",
    "o_orderstatus",
    ("expression", 4),
)
def _(d):
    return q.column_quantile_values_to_be_between("o_totalprice", 0.95, max_value=100, group_by=["o_orderstatus"], strictly=True)


@check(
    "dq22_stdev_between",
    """SELECT user_id, round(stddev_samp(value), 6) AS expression FROM events GROUP BY ALL
HAVING NOT stddev_samp(value) BETWEEN 0 AND 20.0001""",
    "events",
    "user_id",
    ("expression", 6),
)
def _(d):
    return q.column_stdev_to_be_between("value", 0, 20.0001, group_by=["user_id"])


@check(
    "dq23_sum_between",
    "SELECT l_suppkey, sum(l_quantity) AS expression FROM lineitem GROUP BY ALL HAVING NOT sum(l_quantity) >= 15000",
    "lineitem",
)
def _(d):
    return q.column_sum_to_be_between("l_quantity", 15000, group_by=["l_suppkey"])


@check(
    "dq24_unique_value_count_between",
    "SELECT l_suppkey, count(DISTINCT l_partkey) AS expression FROM lineitem GROUP BY ALL HAVING NOT count(DISTINCT l_partkey) BETWEEN 1 AND 100",
    "lineitem",
)
def _(d):
    return q.column_unique_value_count_to_be_between("l_partkey", 1, 100, group_by=["l_suppkey"])


@check(
    "dq25_proportion_of_unique_values_between",
    """SELECT l_suppkey, round(count(DISTINCT l_partkey) / count(l_partkey), 6) AS expression FROM lineitem GROUP BY ALL
HAVING NOT count(DISTINCT l_partkey) / count(l_partkey) >= 0.87001""",
    "lineitem",
    "l_suppkey",
    ("expression", 6),
)
def _(d):
    return q.column_proportion_of_unique_values_to_be_between("l_partkey", 0.87001, group_by=["l_suppkey"])


@check(
    "dq26_wn3_most_common_value_in_set",
    """SELECT value_field FROM (SELECT value_field, row_number() OVER (ORDER BY n DESC, value_field NULLS LAST) AS r
FROM (SELECT l_partkey AS value_field, count(*) AS n FROM lineitem GROUP BY ALL)) WHERE r = 3 AND value_field NOT IN (-1)""",
    "lineitem",
)
def _(d):
    return q.column_most_common_value_to_be_in_set("l_partkey", [-1], 3)


# --- values ------------------------------------------------------------------------


@check(
    "dq30_values_between",
    "SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem WHERE NOT (l_quantity >= 3 AND l_quantity <= 48) AND l_returnflag = 'N'",
    "lineitem",
    "l_orderkey",
    "l_linenumber",
    "l_quantity",
)
def _(d):
    return q.values_to_be_between("l_quantity", 3, 48, row_condition="l_returnflag = 'N'")


_LAG = "SELECT ts, event_id, value, value_field_lag FROM (SELECT *, lag(value) OVER ({over} ORDER BY ts, event_id) AS value_field_lag FROM events) WHERE value_field_lag IS NOT NULL AND NOT ({fine})"


@check(
    "dq31_wn4_values_increasing",
    _LAG.format(over="", fine="value > value_field_lag"),
    "events",
    "ts",
    "event_id",
    "value",
    "value_field_lag",
)
def _(d):
    return q.values_to_be_increasing("value", "ts", tiebreak="event_id")


@check(
    "dq31_values_increasing_by_step",
    """SELECT event_id, value_field_lag FROM (SELECT event_id, lag(event_id) OVER (PARTITION BY event_type ORDER BY event_id) AS value_field_lag
FROM events) WHERE value_field_lag IS NOT NULL AND NOT (event_id >= value_field_lag AND event_id - value_field_lag = 1)""",
    "events",
    "event_id",
    "value_field_lag",
)
def _(d):
    return q.values_to_be_increasing("event_id", strictly=False, step=1, group_by=["event_type"])


@check(
    "dq32_values_decreasing",
    _LAG.format(over="PARTITION BY user_id", fine="value < value_field_lag"),
    "events",
    "ts",
    "event_id",
    "value",
    "value_field_lag",
)
def _(d):
    return q.values_to_be_decreasing("value", "ts", group_by=["user_id"], tiebreak="event_id")


@check(
    "dq33_values_in_set",
    "SELECT o_orderkey, o_orderpriority FROM orders WHERE o_orderpriority IS NULL OR o_orderpriority NOT IN ('1-URGENT', '2-HIGH', '5-LOW')",
    "orders",
    "o_orderkey",
    "o_orderpriority",
)
def _(d):
    return q.values_to_be_in_set("o_orderpriority", ["1-URGENT", "2-HIGH", "5-LOW"])


@check(
    "dq34_values_not_in_set",
    "SELECT o_orderkey, o_orderpriority FROM orders WHERE o_orderpriority IN ('1-URGENT', '2-HIGH')",
    "orders",
    "o_orderkey",
    "o_orderpriority",
)
def _(d):
    return q.values_to_not_be_in_set("o_orderpriority", ["1-URGENT", "2-HIGH", "2-HIGH"])


@register(
    "dq37_dq38_null_values",
    """SELECT ride_id, 'station missing' AS problem FROM landed_trips WHERE start_station_id IS NULL
UNION ALL SELECT ride_id, 'position present' FROM landed_trips WHERE start_lat IS NOT NULL AND start_station_id IS NULL""",
)
def _(d: Domain) -> DataFrame:
    missing = q.values_to_not_be_null("start_station_id")(d.landed_trips)
    present = q.values_to_be_null("start_lat", row_condition="start_station_id IS NULL")(d.landed_trips)
    return missing.select("ride_id", F.lit("station missing").alias("problem")).unionByName(
        present.select("ride_id", F.lit("position present").alias("problem"))
    )


@check(
    "dq39_dq95_values_unique",
    "SELECT l_orderkey, count(*) AS n_records FROM lineitem WHERE l_orderkey IS NOT NULL GROUP BY ALL HAVING count(*) > 1",
    "lineitem",
)
def _(d):
    return q.values_to_be_unique("l_orderkey")


@register(
    "dq40_consistent_casing",
    """WITH w AS (SELECT CASE WHEN o_orderkey % 3 = 0 THEN lower(o_orderpriority) ELSE o_orderpriority END AS v FROM orders)
SELECT lower(v) AS inconsistent_columns, count(DISTINCT v) AS set_count_case_insensitive, (SELECT count(DISTINCT v) FROM w) AS set_count
FROM w GROUP BY ALL HAVING count(DISTINCT v) > 1""",
)
def _(d: Domain) -> DataFrame:
    mixed = d.table("orders").select(
        F.expr("CASE WHEN o_orderkey % 3 = 0 THEN lower(o_orderpriority) ELSE o_orderpriority END").alias("v")
    )
    listed = q.values_to_have_consistent_casing("v", display_inconsistent_columns=True)(mixed)
    summary = q.values_to_have_consistent_casing("v")(mixed).select("set_count")
    return listed.withColumn("set_count", summary.scalar())


# --- several columns ---------------------------------------------------------------


@check(
    "dq50_pair_greater",
    "SELECT l_orderkey, l_linenumber FROM lineitem WHERE NOT (l_partkey >= l_orderkey)",
    "lineitem",
    "l_orderkey",
    "l_linenumber",
)
def _(d):
    return q.pair_values_A_to_be_greater_than_B("l_partkey", "l_orderkey", or_equal=True)


@register(
    "dq51_compound_unique",
    """SELECT start_station_id, start_lat, count(*) AS n_records FROM landed_trips
WHERE NOT (start_station_id IS NULL AND start_lat IS NULL) GROUP BY ALL HAVING count(*) > 1""",
)
def _(d: Domain) -> DataFrame:
    return q.compound_columns_to_be_unique(["start_station_id", "start_lat"])(d.landed_trips)


@register(
    "dq52_pair_equal",
    "SELECT ride_id FROM landed_trips WHERE NOT (start_station_id = end_station_id)",
)
def _(d: Domain) -> DataFrame:
    return q.pair_values_to_be_equal("start_station_id", "end_station_id")(d.landed_trips).select("ride_id")


@check(
    "dq53_pair_in_set",
    """SELECT l_orderkey, l_linenumber FROM lineitem
WHERE NOT ((l_returnflag = 'A' AND l_linestatus = 'F') OR (l_returnflag = 'N' AND l_linestatus = 'O'))""",
    "lineitem",
    "l_orderkey",
    "l_linenumber",
)
def _(d):
    return q.pair_values_to_be_in_set("l_returnflag", "l_linestatus", [("A", "F"), ("N", "O")])


@check(
    "dq54_multicolumn_sum",
    """SELECT l_suppkey, false AS expression FROM lineitem GROUP BY ALL
HAVING NOT (sum(l_partkey) + sum(l_linenumber) = sum(l_orderkey))""",
    "lineitem",
)
def _(d):
    return q.multicolumn_sum_to_equal(["l_partkey", "l_linenumber"], "l_orderkey", group_by=["l_suppkey"])


@register(
    "dq55_unique_within_record",
    """SELECT ride_id FROM (SELECT ride_id, start_station_id, end_station_id, member_casual,
  len(list_distinct([start_station_id, end_station_id, member_casual])) AS n FROM landed_trips)
WHERE NOT (start_station_id IS NULL AND end_station_id IS NULL AND member_casual IS NULL) AND n < 3""",
)
def _(d: Domain) -> DataFrame:
    columns = ["start_station_id", "end_station_id", "member_casual"]
    return q.select_column_values_to_be_unique_within_record(columns)(d.landed_trips).select("ride_id")


# --- text --------------------------------------------------------------------------


@check(
    "dq60_value_lengths_between",
    "SELECT doc_id FROM documents WHERE NOT length(text) BETWEEN 100 AND 2000",
    "documents",
    "doc_id",
)
def _(d):
    return q.value_lengths_to_be_between("text", 100, 2000)


@check("dq61_value_lengths_equal", "SELECT p_partkey FROM part WHERE length(p_brand) <> 8", "part", "p_partkey")
def _(d):
    return q.value_lengths_to_equal("p_brand", 8)


@check("dq62_match_like", "SELECT doc_id FROM documents WHERE text NOT LIKE '%the%'", "documents", "doc_id")
def _(d):
    return q.match_like_pattern("text", "%the%")


@check(
    "dq63_match_like_list",
    "SELECT conv_id, turn FROM conversations WHERE NOT (text LIKE '%er%' AND text LIKE '%on%')",
    "conversations",
    "conv_id",
    "turn",
)
def _(d):
    return q.match_like_pattern_list("text", ["%er%", "%on%"], match_on="all")


@check("dq64_not_match_like", "SELECT page_id FROM pages WHERE html LIKE '%<script>%'", "pages", "page_id")
def _(d):
    return q.not_match_like_pattern("html", "%<script>%")


@check(
    "dq65_not_match_like_list",
    "SELECT doc_id FROM documents WHERE NOT (text NOT LIKE '%the%' OR text NOT LIKE '%an%')",
    "documents",
    "doc_id",
)
def _(d):
    return q.not_match_like_pattern_list("text", ["%the%", "%an%"])


@check(
    "dq66_sf18_match_regex",
    "SELECT doc_id FROM documents WHERE NOT regexp_matches(text, '(?i)\\bTHE\\b')",
    "documents",
    "doc_id",
)
def _(d):
    return q.match_regex("text", r"\bTHE\b", flags="i")


@check(
    "dq67_match_regex_list",
    "SELECT doc_id FROM documents WHERE NOT (regexp_matches(text, '[0-9]{3}') OR regexp_matches(text, '^[A-E]'))",
    "documents",
    "doc_id",
)
def _(d):
    return q.match_regex_list("text", ["[0-9]{3}", "^[A-E]"])


@check(
    "dq68_not_match_regex",
    "SELECT doc_id FROM documents WHERE regexp_matches(text, '[a-z]+ [A-Z]')",
    "documents",
    "doc_id",
)
def _(d):
    return q.not_match_regex("text", "[a-z]+ [A-Z]")


@check(
    "dq69_not_match_regex_list",
    "SELECT p_partkey FROM part WHERE regexp_matches(p_name, 'ring') OR regexp_matches(p_name, '^s')",
    "part",
    "p_partkey",
)
def _(d):
    return q.not_match_regex_list("p_name", ["ring", "^s"], match_on="all")


# --- distribution and time ---------------------------------------------------------


@check(
    "dq70_wn7_within_n_stdevs",
    """SELECT user_id, round(value, 4) AS value, round((value - a) / s, 6) AS value_sigma FROM (
  SELECT *, avg(value) OVER () AS a, stddev_samp(value) OVER () AS s FROM (SELECT user_id, sum(value) AS value FROM events GROUP BY ALL))
WHERE abs((value - a) / nullif(s, 0)) > 1.5""",
    "events",
    "user_id",
    ("value", 4),
    ("value_sigma", 6),
)
def _(d):
    return q.within_n_stdevs("value", ["user_id"], 1.5)


@check(
    "dq71_wn5_wn6_within_n_moving_stdevs",
    """WITH g AS (SELECT CAST(date_trunc('day', ts) AS TIMESTAMP) AS metric_period, event_type, sum(value) AS agg FROM events GROUP BY ALL),
p AS (SELECT *, lag(agg, 1) OVER (PARTITION BY event_type ORDER BY metric_period) AS prior FROM g),
t AS (SELECT *, coalesce(ln(nullif(agg, 0)), 0) - coalesce(ln(nullif(prior, 0)), 0) AS test FROM p),
m AS (SELECT *, avg(test) OVER w AS a, stddev_samp(test) OVER w AS s FROM t
  WINDOW w AS (PARTITION BY event_type ORDER BY metric_period ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING))
SELECT event_type, metric_period, round(test, 6) AS metric_test_value, round((test - a) / nullif(s, 0), 4) AS metric_test_sigma FROM m
WHERE metric_period >= TIMESTAMP '2024-01-16' AND metric_period < TIMESTAMP '2024-01-30'
  AND NOT ((test - a) / nullif(s, 0) >= -1 AND (test - a) / nullif(s, 0) <= 1)""",
    "events",
    "event_type",
    "metric_period",
    ("metric_test_value", 6),
    ("metric_test_sigma", 4),
)
def _(d):
    as_of = F.lit("2024-01-30 12:00:00").cast("timestamp")
    return q.within_n_moving_stdevs("value", "ts", ["event_type"], sigma_threshold=1, as_of=as_of)


@register(
    "wn5_wn6_moving_statistics",
    """WITH g AS (SELECT CAST(date_trunc('day', ts) AS TIMESTAMP) AS metric_period, sum(value) AS agg FROM events GROUP BY ALL)
SELECT metric_period, round(agg - a, 4) AS metric_test_delta FROM (
  SELECT *, avg(agg) OVER (ORDER BY metric_period ROWS BETWEEN 5 PRECEDING AND 1 PRECEDING) AS a,
    stddev_samp(agg) OVER (ORDER BY metric_period ROWS BETWEEN 5 PRECEDING AND 1 PRECEDING) AS s FROM g)
WHERE metric_period < TIMESTAMP '2024-01-30' AND metric_period >= TIMESTAMP '2024-01-02'
  AND NOT ((agg - a) / nullif(s, 0) BETWEEN -0.5 AND 0.75)""",
)
def _(d: Domain) -> DataFrame:
    moving = q.within_n_moving_stdevs(
        "value",
        "ts",
        trend_periods=5,
        test_periods=28,
        sigma_threshold_upper=0.75,
        sigma_threshold_lower=-0.5,
        take_diffs=False,
        take_logs=False,
        as_of=F.lit("2024-01-30 12:00:00").cast("timestamp"),
    )
    return moving(d.table("events")).select("metric_period", rounded("metric_test_delta", 4).alias("metric_test_delta"))


@register(
    "dq72_data_for_every_hour",
    """SELECT CAST(h AS TIMESTAMP) AS date_hour, true AS is_missing, 0::BIGINT AS row_cnt FROM (
  SELECT unnest(generate_series(min(s)::TIMESTAMP, max(s)::TIMESTAMP - INTERVAL 1 HOUR, INTERVAL 1 HOUR)) AS h FROM (
    SELECT CAST(started_at AS DATE) AS s FROM trips))
WHERE h NOT IN (SELECT date_trunc('hour', started_at) FROM trips) AND dayofweek(h) <> 0""",
)
def _(d: Domain) -> DataFrame:
    return q.row_values_to_have_data_for_every_n_datepart(
        "started_at", "hour", exclusion_condition="dayofweek(date_hour) <> 1"
    )(d.trips)


@register(
    "dq72_data_for_every_six_hours",
    """WITH b AS (SELECT min(CAST(started_at AS DATE))::TIMESTAMP AS a, max(CAST(started_at AS DATE))::TIMESTAMP AS z
  FROM trips WHERE member_casual = 'member')
SELECT CAST(h AS TIMESTAMP) AS date_hour, true AS is_missing, 0::BIGINT AS row_cnt
FROM (SELECT unnest(generate_series(a, z - INTERVAL 1 HOUR, INTERVAL 6 HOUR)) AS h FROM b)
WHERE h NOT IN (SELECT time_bucket(INTERVAL 6 HOUR, started_at, a) FROM trips, b WHERE member_casual = 'member')""",
)
def _(d: Domain) -> DataFrame:
    return q.row_values_to_have_data_for_every_n_datepart(
        "started_at", "hour", interval=6, row_condition="member_casual = 'member'"
    )(d.trips)


@check(
    "dq73_recent_data",
    """SELECT max(ts) AS max_timestamp FROM events WHERE ts <= TIMESTAMP '2024-01-20' AND event_type = 'error'
HAVING coalesce(max(ts), TIMESTAMP '1970-01-01') < TIMESTAMP '2024-01-20' - INTERVAL 1 MINUTE""",
    "events",
)
def _(d):
    return q.row_values_to_have_recent_data(
        "ts", "minute", 1, row_condition="event_type = 'error'", as_of=F.lit("2024-01-20").cast("timestamp")
    )


@check(
    "dq74_grouped_recent_data",
    """SELECT user_id, max(ts) AS latest_timestamp_column FROM events WHERE ts <= TIMESTAMP '2024-01-20' GROUP BY ALL
HAVING max(ts) < TIMESTAMP '2024-01-20' - INTERVAL 12 HOUR""",
    "events",
)
def _(d):
    return q.grouped_row_values_to_have_recent_data(
        ["user_id"], "ts", "hour", 12, as_of=F.lit("2024-01-20").cast("timestamp")
    )


# --- table shape -------------------------------------------------------------------


@check(
    "dq88_row_count_between",
    "SELECT l_orderkey, count(*) AS expression FROM lineitem GROUP BY ALL HAVING NOT count(*) BETWEEN 2 AND 8",
    "lineitem",
)
def _(d):
    return q.table_row_count_to_be_between(2, 8, group_by=["l_orderkey"])


@check(
    "dq89_row_count_equal",
    "SELECT conv_id, count(*) AS expression FROM conversations GROUP BY ALL HAVING count(*) <> 2",
    "conversations",
)
def _(d):
    return q.table_row_count_to_equal(2, group_by=["conv_id"])


@check(
    "dq90_dq91_row_count_equal_other_table",
    """SELECT a.n AS expression, b.n * 3 AS compare_expression, abs(a.n - b.n * 3) AS expression_difference
FROM (SELECT count(*) AS n FROM lineitem) a, (SELECT count(*) AS n FROM orders) b WHERE a.n <> b.n * 3""",
    "lineitem",
    "expression",
    "compare_expression",
    "expression_difference",
)
def _(d):
    return q.table_row_count_to_equal_other_table_times_factor(d.table("orders"), 3)


@check(
    "dq92_aggregation_equal_other_table",
    """SELECT a.k AS col_1, round(a.e, 2) AS expression, b.e AS compare_expression FROM
(SELECT year(l_shipdate) AS k, sum(l_quantity) AS e FROM lineitem GROUP BY ALL) a
JOIN (SELECT year(o_orderdate) AS k, count(*) * 100.0::DOUBLE AS e FROM orders GROUP BY ALL) b ON a.k = b.k
WHERE abs(a.e - b.e) / a.e > 0.01""",
    "lineitem",
    "col_1",
    ("expression", 2),
    "compare_expression",
    ints="col_1",
)
def _(d):
    return q.table_aggregation_to_equal_other_table(
        "sum(l_quantity)",
        d.table("orders"),
        "count(*) * 100.0D",
        group_by=[F.year("l_shipdate")],
        compare_group_by=[F.year("o_orderdate")],
        tolerance_percent=0.01,
    )


@register(
    "dq97_relationships",
    """SELECT community_area_id AS value_field, count(*) AS n_records FROM incidents
WHERE community_area_id <> 0 AND community_area_id NOT IN (SELECT n_nationkey FROM nation) GROUP BY ALL""",
)
def _(d: Domain) -> DataFrame:
    check_parents = q.relationships(
        "community_area_id", d.table("nation"), "n_nationkey", row_condition="community_area_id <> 0"
    )
    return check_parents(d.incidents)


# --- suites ------------------------------------------------------------------------


@register(
    "dq_suite_one_pass",
    """WITH c AS (SELECT count(*) AS n, count(*) FILTER (WHERE NOT l_quantity BETWEEN 2 AND 49) AS q,
    count(*) FILTER (WHERE l_partkey IS NULL) AS p, count(*) FILTER (WHERE NOT regexp_matches(l_returnflag, '^[AR]')) AS r,
    CASE WHEN max(l_discount) > 0.05 THEN 1 ELSE 0 END AS m FROM lineitem)
SELECT 'values_between_l_quantity' AS test_name, CASE WHEN q > 0 THEN 'fail' ELSE 'pass' END AS status, q AS failures FROM c
UNION ALL SELECT 'values_not_null_l_partkey', CASE WHEN p > 0 THEN 'fail' ELSE 'pass' END, p FROM c
UNION ALL SELECT 'match_regex_l_returnflag', CASE WHEN r > 0 THEN 'warn' ELSE 'pass' END, r FROM c
UNION ALL SELECT 'max_between_l_discount', CASE WHEN m > 0 THEN 'fail' ELSE 'pass' END, m FROM c
UNION ALL SELECT 'row_count_between', CASE WHEN n < 1 THEN 'fail' ELSE 'pass' END, CASE WHEN n < 1 THEN 1 ELSE 0 END FROM c""",
)
def _(d: Domain) -> DataFrame:
    checks = [
        q.values_to_be_between("l_quantity", 2, 49),
        q.values_to_not_be_null("l_partkey"),
        q.match_regex("l_returnflag", "^[AR]").configured(severity="warn"),
        q.column_max_to_be_between("l_discount", 0, 0.05),
        q.table_row_count_to_be_between(1),
    ]
    return suite.outcomes(d.table("lineitem"), checks)


@register(
    "dq_suite_with_shape",
    """WITH dup AS (SELECT o_custkey FROM orders GROUP BY ALL HAVING count(*) > 1)
SELECT 'columns_match_ordered_list' AS test_name, 'pass' AS status, 0::BIGINT AS failures
UNION ALL SELECT 'columns_contain_set', 'fail', 1 UNION ALL SELECT 'columns_not_contain_set', 'fail', 1
UNION ALL SELECT 'columns_match_set', 'fail', 6 UNION ALL SELECT 'column_exists_o_orderdate', 'pass', 0
UNION ALL SELECT 'column_count_between', 'pass', 0 UNION ALL SELECT 'column_count_equal', 'fail', 1
UNION ALL SELECT 'column_count_equal_other_table', 'fail', 1 UNION ALL SELECT 'values_in_type_list_o_custkey', 'pass', 0
UNION ALL SELECT 'values_of_type_o_custkey', 'fail', 1
UNION ALL SELECT 'unique_o_custkey', CASE WHEN count(*) > 100000000 THEN 'fail' ELSE 'warn' END, count(*) FROM dup
UNION ALL SELECT 'not_null_o_custkey', 'pass', count(*) FILTER (WHERE o_custkey IS NULL) FROM orders""",
)
def _(d: Domain) -> DataFrame:
    orders = d.table("orders")
    checks = [
        q.table_columns_to_match_ordered_list(orders.columns),
        q.table_columns_to_contain_set(["o_orderkey", "o_comment"]),
        q.table_columns_to_not_contain_set(["o_orderkey", "o_comment"]),
        q.table_columns_to_match_set(["o_orderkey", "o_comment"]),
        q.column_to_exist("o_orderdate", column_index=5),
        q.table_column_count_to_be_between(1, 10),
        q.table_column_count_to_equal(7),
        q.table_column_count_to_equal_other_table(d.table("lineitem")),
        q.values_to_be_in_type_list("o_custkey", ["bigint", "int"]),
        q.values_to_be_of_type("o_custkey", "string"),
        q.unique("o_custkey").configured(error_if="> 100000000"),
        q.not_null("o_custkey"),
    ]
    return suite.outcomes(orders, checks)


@register(
    "wn13_running_sums",
    """SELECT event_id, event_type, CAST(sum(event_id % 10) OVER (PARTITION BY event_type, user_id ORDER BY CAST(ts AS DATE)) AS BIGINT) AS rising,
  CAST(sum(event_id % 10) OVER (PARTITION BY event_type, user_id ORDER BY CAST(ts AS DATE) DESC) AS BIGINT) AS falling FROM events""",
)
def _(d: Domain) -> DataFrame:
    """Running sums whose peers share a value: per day first, so that a busy group
    enters the window with one row per day, then joined back."""
    events = d.table("events").select("event_id", "event_type", "user_id", F.to_date("ts").alias("day"))
    keys = ["event_type", "user_id"]
    daily = events.groupBy(*keys, "day").agg(F.sum(F.expr("event_id % 10")).alias("s"))
    by_day = Window.partitionBy(*keys).orderBy("day")
    running = daily.select(
        *keys,
        "day",
        F.sum("s").over(by_day).alias("rising"),
        F.sum("s").over(Window.partitionBy(*keys).orderBy(F.desc("day"))).alias("falling"),
    )
    return events.join(running, [*keys, "day"]).select("event_id", "event_type", "rising", "falling")


# --- SQL fragments as groups -------------------------------------------------------


@check(
    "dq20_median_per_expression",
    """SELECT l_suppkey % 3 AS "l_suppkey % 3", round(quantile_cont(l_quantity, 0.5), 6) AS expression FROM lineitem
GROUP BY ALL HAVING NOT quantile_cont(l_quantity, 0.5) <= 5""",
    "lineitem",
    "l_suppkey % 3",
    ("expression", 6),
)
def _(d):
    return q.column_median_to_be_between("l_quantity", max_value=5, group_by=["l_suppkey % 3"])


@check(
    "dq21_quantile_per_expression",
    """SELECT upper(o_orderstatus) AS "upper(o_orderstatus)", round(quantile_cont(o_totalprice / 10, 0.9), 4) AS expression
FROM orders GROUP BY ALL HAVING NOT quantile_cont(o_totalprice / 10, 0.9) < 10""",
    "orders",
    "upper(o_orderstatus)",
    ("expression", 4),
)
def _(d):
    return q.column_quantile_values_to_be_between("o_totalprice / 10", 0.9, max_value=10, group_by=["upper(o_orderstatus)"], strictly=True)


_LAG_BY = """SELECT user_id % 4 AS "user_id % 4", event_id, -value AS "-value", value_field_lag FROM (
SELECT *, lag(-value) OVER (PARTITION BY user_id % 4 ORDER BY ts, event_id) AS value_field_lag FROM events)
WHERE value_field_lag IS NOT NULL AND NOT ({fine})"""


@check("dq31_increasing_per_expression", _LAG_BY.format(fine="-value > value_field_lag"), "events", "user_id % 4", "event_id", "-value", "value_field_lag")
def _(d):
    return q.values_to_be_increasing("-value", "ts", group_by=["user_id % 4"], tiebreak="event_id")


@check("dq32_decreasing_per_expression", _LAG_BY.format(fine="-value < value_field_lag"), "events", "user_id % 4", "event_id", "-value", "value_field_lag")
def _(d):
    return q.values_to_be_decreasing("-value", "ts", group_by=["user_id % 4"], tiebreak="event_id")


@check(
    "dq71_moving_stdevs_per_expression",
    """WITH g AS (SELECT CAST(date_trunc('day', ts) AS TIMESTAMP) AS metric_period, user_id % 2 AS k, sum(value) AS agg FROM events GROUP BY ALL),
m AS (SELECT *, avg(agg) OVER w AS a, stddev_samp(agg) OVER w AS s FROM g
  WINDOW w AS (PARTITION BY k ORDER BY metric_period ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING))
SELECT k AS "user_id % 2", metric_period, round((agg - a) / nullif(s, 0), 4) AS metric_test_sigma FROM m
WHERE metric_period >= TIMESTAMP '2024-01-16' AND metric_period < TIMESTAMP '2024-01-30' AND NOT (agg - a) / nullif(s, 0) BETWEEN -1 AND 1""",
    "events",
    "user_id % 2",
    "metric_period",
    ("metric_test_sigma", 4),
)
def _(d):
    as_of = F.lit("2024-01-30 12:00:00").cast("timestamp")
    return q.within_n_moving_stdevs("value", "ts", ["user_id % 2"], sigma_threshold=1, take_diffs=False, take_logs=False, as_of=as_of)
