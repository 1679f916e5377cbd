"""Data-quality checks over the given tables, with arguments for which rows do fail."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import checks, neighbours
from .inputs import table
from .registry import query

# A column that is NULL for every tenth part, and '' or blank for some others.
PARTS = """(SELECT *, CASE WHEN p_partkey % 10 = 0 THEN NULL WHEN p_partkey % 10 = 1 THEN '' WHEN p_partkey % 10 = 2 THEN '  '
  ELSE p_name END AS note, CASE WHEN p_partkey % 4 = 0 THEN NULL ELSE p_size END AS measured FROM part)"""


def _parts(spark, sf):
    rest = F.col("p_partkey") % 10
    note = F.when(rest == 0, None).when(rest == 1, "").when(rest == 2, "  ").otherwise(F.col("p_name"))
    measured = F.when(F.col("p_partkey") % 4 != 0, F.col("p_size"))
    return table(spark, sf, "part").withColumns({"note": note, "measured": measured})


@query("dq_not_null", f"SELECT p_partkey, note FROM {PARTS} WHERE note IS NULL")
def dq_not_null(spark, sf):
    return checks.not_null(_parts(spark, sf).select("p_partkey", "note"), "note")


@query("dq_unique", "SELECT l_orderkey AS unique_field, count(*) AS n_records FROM lineitem GROUP BY l_orderkey HAVING count(*) > 1")
def dq_unique(spark, sf):
    return checks.unique(table(spark, sf, "lineitem"), "l_orderkey")


@query("dq_accepted_values", """SELECT p_type AS value_field, count(*) AS n_records FROM part
WHERE p_type NOT IN ('ECONOMY', 'SMALL', 'LARGE') GROUP BY p_type""")
def dq_accepted_values(spark, sf):
    return checks.accepted_values(table(spark, sf, "part"), "p_type", ["ECONOMY", "SMALL", "LARGE"])


@query("dq_accepted_range", "SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem WHERE l_quantity < 3 OR l_quantity > 45")
def dq_accepted_range(spark, sf):
    rows = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity")
    return checks.accepted_range(rows, "l_quantity", 3, 45)


@query("dq_accepted_range_exclusive", f"SELECT p_partkey, measured, p_size FROM {PARTS} WHERE NOT measured > 3 OR NOT measured < p_size")
def dq_accepted_range_exclusive(spark, sf):
    """Limits left out, one of them a column; a missing value passes."""
    rows = _parts(spark, sf).select("p_partkey", "measured", "p_size")
    return checks.accepted_range(rows, "measured", 3, "p_size", inclusive=False)


@query("dq_at_least_one", f"SELECT p_name, p_brand, count(measured) AS filler_column FROM {PARTS} GROUP BY ALL HAVING count(measured) = 0")
def dq_at_least_one(spark, sf):
    return checks.at_least_one(_parts(spark, sf), "measured", ["p_name", "p_brand"])


@query("dq_cardinality_equality", """WITH a AS (SELECT o_orderpriority, count(*) AS num_rows FROM orders GROUP BY ALL),
b AS (SELECT o_orderpriority, count(*) AS num_rows FROM orders WHERE o_orderkey % 10 <> 0 GROUP BY ALL)
(SELECT * FROM a EXCEPT SELECT * FROM b) UNION ALL (SELECT * FROM b EXCEPT SELECT * FROM a)""")
def dq_cardinality_equality(spark, sf):
    orders = table(spark, sf, "orders")
    return checks.cardinality_equality(orders, "o_orderpriority", orders.where("o_orderkey % 10 <> 0"), "o_orderpriority")


def _grouped_counts(name_a, name_b, last):
    return f"""SELECT a.k AS o_orderpriority_a, b.k AS o_orderpriority_b, {name_a}, {name_b}, {last}
FROM (SELECT o_orderpriority AS k, count(*) AS {name_a} FROM orders WHERE o_orderpriority <> '5-LOW' GROUP BY ALL) a
FULL JOIN (SELECT o_orderpriority AS k, count(*) AS {name_b} FROM orders WHERE o_orderkey % 10 <> 0 GROUP BY ALL) b ON a.k = b.k"""


def _order_sides(spark, sf):
    orders = table(spark, sf, "orders")
    return orders.where("o_orderpriority <> '5-LOW'"), orders.where("o_orderkey % 10 <> 0")


@query("dq_equal_rowcount", _grouped_counts("count_a", "count_b", "abs(count_a - count_b) AS diff_count"))
def dq_equal_rowcount(spark, sf):
    return checks.equal_rowcount(*_order_sides(spark, sf), ["o_orderpriority"])


@query("dq_equal_rowcount_total", """SELECT a AS count_a, b AS count_b, abs(a - b) AS diff_count
FROM (SELECT count(*) FILTER (o_orderpriority <> '5-LOW') AS a, count(*) FILTER (o_orderkey % 10 <> 0) AS b FROM orders)""")
def dq_equal_rowcount_total(spark, sf):
    return checks.equal_rowcount(*_order_sides(spark, sf))


DELTA = """CAST(CASE WHEN count_our_model > count_comparison_model THEN count_our_model - count_comparison_model
  WHEN count_our_model = count_comparison_model THEN 1 ELSE 0 END AS BIGINT) AS row_count_delta"""


@query("dq_fewer_rows_than", _grouped_counts("count_our_model", "count_comparison_model", DELTA))
def dq_fewer_rows_than(spark, sf):
    return checks.fewer_rows_than(*_order_sides(spark, sf), ["o_orderpriority"])


@query("dq_equality", """WITH a AS (SELECT o_custkey, o_orderpriority FROM orders WHERE o_orderpriority <> '5-LOW'),
b AS (SELECT o_custkey, o_orderpriority FROM orders WHERE o_orderkey % 10 <> 0)
SELECT 'a_minus_b' AS which_diff, * FROM (SELECT * FROM a EXCEPT SELECT * FROM b)
UNION ALL SELECT 'b_minus_a', * FROM (SELECT * FROM b EXCEPT SELECT * FROM a)""")
def dq_equality(spark, sf):
    return checks.equality(*_order_sides(spark, sf), ["o_custkey", "o_orderpriority"])


@query("dq_equality_multiset", """WITH a AS (SELECT o_custkey, o_orderpriority FROM orders WHERE o_orderpriority <> '5-LOW'),
b AS (SELECT o_custkey, o_orderpriority FROM orders WHERE o_orderkey % 10 <> 0)
SELECT 'a_minus_b' AS which_diff, * FROM (SELECT * FROM a EXCEPT ALL SELECT * FROM b)
UNION ALL SELECT 'b_minus_a', * FROM (SELECT * FROM b EXCEPT ALL SELECT * FROM a)""")
def dq_equality_multiset(spark, sf):
    return checks.equality(*_order_sides(spark, sf), ["o_custkey", "o_orderpriority"], multiset=True)


@query("dq_expression_is_true", "SELECT l_orderkey, l_linenumber, l_quantity, l_discount FROM lineitem WHERE NOT (l_quantity * l_discount < 4)")
def dq_expression_is_true(spark, sf):
    rows = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_discount")
    return checks.expression_is_true(rows, "* l_discount < 4", column="l_quantity")


RANGES = "(SELECT o_custkey, o_orderdate AS lo, o_orderdate + INTERVAL 30 DAY AS hi FROM orders)"


def _ranges_sql(gap_name, gap, zero_name, zero, partitioned=True):
    over = f"OVER ({'PARTITION BY o_custkey ' if partitioned else ''}ORDER BY lo, hi)"
    return f"""SELECT * FROM (SELECT {"o_custkey AS partition_by_col, " if partitioned else ""}lo AS lower_bound, hi AS upper_bound, nxt AS next_lower_bound, last AS is_last_record,
  coalesce(lo {zero} hi, false) AS lower_bound_{zero_name}_upper_bound,
  coalesce(hi {gap} nxt, last, false) AS upper_bound_{gap_name}_next_lower_bound
FROM (SELECT *, lead(lo) {over} AS nxt, lead(1) {over} IS NULL AS last FROM {RANGES}))
WHERE NOT (lower_bound_{zero_name}_upper_bound AND upper_bound_{gap_name}_next_lower_bound)"""


def _ranges(spark, sf):
    ends = F.col("o_orderdate") + F.expr("interval 30 day")
    return table(spark, sf, "orders").select("o_custkey", F.col("o_orderdate").alias("lo"), ends.alias("hi"))


# Days repeat among a customer's orders. Where the last range has copies, "last" is taken from
# the same order as "next", so that exactly one copy, the one with no next range, is last.
@query("dq_mutually_exclusive_ranges", _ranges_sql("less_than_or_equal_to", "<=", "less_than", "<"))
def dq_mutually_exclusive_ranges(spark, sf):
    return checks.mutually_exclusive_ranges(_ranges(spark, sf), "lo", "hi", "o_custkey")


@query("dq_mutually_exclusive_ranges_no_gaps", _ranges_sql("equal_to", "=", "less_than_or_equal_to", "<="))
def dq_mutually_exclusive_ranges_no_gaps(spark, sf):
    return checks.mutually_exclusive_ranges(
        _ranges(spark, sf), "lo", "hi", "o_custkey", gaps="not_allowed", zero_length_range_allowed=True
    )


@query("dq_mutually_exclusive_ranges_gaps", _ranges_sql("less_than", "<", "less_than", "<"))
def dq_mutually_exclusive_ranges_gaps(spark, sf):
    return checks.mutually_exclusive_ranges(_ranges(spark, sf), "lo", "hi", "o_custkey", gaps="required")


@query("dq_mutually_exclusive_ranges_whole", _ranges_sql("less_than_or_equal_to", "<=", "less_than", "<", False))
def dq_mutually_exclusive_ranges_whole(spark, sf):
    """The whole table as one group."""
    return checks.mutually_exclusive_ranges(_ranges(spark, sf), "lo", "hi")


@query("win_lead", """SELECT o_custkey, lo, lead(lo) OVER (PARTITION BY o_custkey ORDER BY lo) AS next_lo
FROM (SELECT DISTINCT o_custkey, o_orderdate AS lo FROM orders)""")
def win_lead(spark, sf):
    starts = _ranges(spark, sf).select("o_custkey", "lo").distinct()
    return neighbours.link_values(starts, ["o_custkey"], "lo", following="next_lo")


@query("win_lag", """SELECT user_id, event_id, lag(event_id) OVER (PARTITION BY user_id ORDER BY event_id) AS before FROM events""")
def win_lag(spark, sf):
    rows = table(spark, sf, "events").select("user_id", "event_id").distinct()
    return neighbours.link_values(rows, ["user_id"], "event_id", previous="before")


@query("dq_sequential_values", """SELECT * FROM (SELECT user_id, event_id, lag(event_id) OVER (PARTITION BY user_id ORDER BY event_id) AS previous_event_id
FROM events) WHERE NOT (event_id = previous_event_id + 1)""")
def dq_sequential_values(spark, sf):
    return checks.sequential_values(table(spark, sf, "events"), "event_id", group_by=["user_id"])


@query("dq_sequential_values_whole", """SELECT * FROM (SELECT l_orderkey, lag(l_orderkey) OVER (ORDER BY l_orderkey) AS previous_l_orderkey
FROM lineitem) WHERE NOT (l_orderkey = previous_l_orderkey + 1)""")
def dq_sequential_values_whole(spark, sf):
    """One group of all rows, with many repeats."""
    return checks.sequential_values(table(spark, sf, "lineitem"), "l_orderkey")


@query("dq_sequential_values_days", """SELECT * FROM (SELECT user_id, day, lag(day) OVER (PARTITION BY user_id ORDER BY day) AS previous_day
FROM (SELECT DISTINCT user_id, date_trunc('day', ts) AS day FROM events))
WHERE NOT (day = previous_day + INTERVAL 1 DAY)""")
def dq_sequential_values_days(spark, sf):
    days = table(spark, sf, "events").select("user_id", F.to_date("ts").cast("timestamp_ntz").alias("day")).distinct()
    return checks.sequential_values(days, "day", 1, "day", group_by=["user_id"])


@query("dq_not_accepted_values", "SELECT DISTINCT p_brand AS value_field FROM part WHERE p_brand IN ('Brand#1', 'Brand#2', 'none')")
def dq_not_accepted_values(spark, sf):
    return checks.not_accepted_values(table(spark, sf, "part"), "p_brand", ["Brand#1", "Brand#2", "none"])


@query("dq_not_constant", """SELECT l_orderkey, count(DISTINCT l_returnflag) AS filler_column FROM lineitem
GROUP BY l_orderkey HAVING count(DISTINCT l_returnflag) = 1""")
def dq_not_constant(spark, sf):
    return checks.not_constant(table(spark, sf, "lineitem"), "l_returnflag", ["l_orderkey"])


@query("dq_not_empty_string", f"SELECT trim(note) AS note FROM {PARTS} WHERE trim(note) = ''")
def dq_not_empty_string(spark, sf):
    return checks.not_empty_string(_parts(spark, sf), "note")


@query("dq_not_null_proportion", f"""SELECT p_brand, count(measured) / count(*) AS not_null_proportion FROM {PARTS}
GROUP BY p_brand HAVING NOT count(measured) / count(*) BETWEEN 0.7 AND 0.8""")
def dq_not_null_proportion(spark, sf):
    return checks.not_null_proportion(_parts(spark, sf), "measured", 0.7, 0.8, ["p_brand"])


LATE = "TIMESTAMP '2024-01-30 12:00:00'"


@query("dq_recency", f"""SELECT user_id, max(ts) AS most_recent, {LATE} - INTERVAL 1 HOUR AS threshold FROM events
GROUP BY user_id HAVING max(ts) < {LATE} - INTERVAL 1 HOUR""")
def dq_recency(spark, sf):
    return checks.recency(table(spark, sf, "events"), "ts", "hour", 1, "2024-01-30 12:00:00", group_by=["user_id"])


@query("dq_recency_days", f"""SELECT user_id, CAST(max(ts) AS DATE) AS most_recent, CAST({LATE} - INTERVAL 1 DAY AS DATE) AS threshold FROM events
GROUP BY user_id HAVING CAST(max(ts) AS DATE) < CAST({LATE} - INTERVAL 1 DAY AS DATE)""")
def dq_recency_days(spark, sf):
    return checks.recency(
        table(spark, sf, "events"), "ts", "day", 1, "2024-01-30 12:00:00", ignore_time=True, group_by=["user_id"]
    )


@query("dq_relationships_where", """SELECT o_custkey AS id, CAST(NULL AS BIGINT) AS right_id FROM orders
WHERE o_orderstatus = 'F' AND o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_custkey % 7 <> 0)""")
def dq_relationships_where(spark, sf):
    return checks.relationships_where(
        table(spark, sf, "orders"), "o_custkey", table(spark, sf, "customer"), "c_custkey",
        from_condition="o_orderstatus = 'F'", to_condition="c_custkey % 7 <> 0",
    )


@query("dq_unique_combination", "SELECT l_orderkey, l_linenumber FROM lineitem GROUP BY ALL HAVING count(*) > 1")
def dq_unique_combination(spark, sf):
    return checks.unique_combination(table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


@query("dq_assert_equal_columns", "SELECT doc_id, quality, toxic FROM labels WHERE quality <> toxic")
def dq_assert_equal_columns(spark, sf):
    return checks.assert_equal_columns(table(spark, sf, "labels").select("doc_id", "quality", "toxic"), "quality", "toxic")


SUMMARY = "SELECT '{name}' AS check_name, failures, CASE WHEN {error} THEN 'error' WHEN {warn} THEN 'warn' ELSE 'pass' END AS status FROM ({count})"


def _filled(columns, table_name, side):
    """SQL for the columns that only one side has, with their filled rows."""
    names = {"relation": "'{0}' AS relation_column, CAST(NULL AS VARCHAR) AS input_column", "input": "NULL, '{0}'"}[side]
    return " UNION ALL ".join(f"SELECT {names.format(c)}, count({c}) AS n_filled FROM {table_name}" for c in columns)


@query("dq_columns_match_set", _filled(["quality", "toxic"], "labels", "relation") + " UNION ALL " + _filled(["text", "lang", "source", "n_chars"], "documents", "input"))
def dq_columns_match_set(spark, sf):
    """Columns that only one of two tables has, with the rows that fill them."""
    return checks.columns_match(table(spark, sf, "labels"), table(spark, sf, "documents"))


@query("dq_severity", " UNION ALL ".join([
    SUMMARY.format(name="range", error="failures > 1000000000", warn="failures <> 0",
                   count="SELECT count(*) AS failures FROM lineitem WHERE l_quantity > 45"),
    SUMMARY.format(name="not_null", error="failures <> 0", warn="failures <> 0",
                   count="SELECT count(*) AS failures FROM lineitem WHERE l_quantity IS NULL"),
    SUMMARY.format(name="equal_rowcount", error="failures > 10", warn="failures <> 0",
                   count="SELECT count(*) FILTER (o_orderkey % 10 = 0) AS failures FROM orders"),
]))
def dq_severity(spark, sf):
    lines, orders = table(spark, sf, "lineitem"), table(spark, sf, "orders")
    counted = checks.equal_rowcount(orders, orders.where("o_orderkey % 10 <> 0"))
    return (
        checks.summary(checks.accepted_range(lines, "l_quantity", max_value=45), "range", error_if="> 1000000000")
        .unionAll(checks.summary(checks.not_null(lines, "l_quantity"), "not_null"))
        .unionAll(checks.summary(counted, "equal_rowcount", error_if="> 10"))
    )


@query("test_where", f"SELECT p_partkey, note FROM {PARTS} WHERE p_size > 25 AND note IS NULL")
def test_where(spark, sf):
    return checks.not_null(_parts(spark, sf).where("p_size > 25").select("p_partkey", "note"), "note")
