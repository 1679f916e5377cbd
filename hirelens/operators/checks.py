"""Data-quality checks. Each returns the rows that fail; an empty result passes.

Any check can be limited to some rows by filtering the table first: ``not_null(df.where(...), c)``.
:func:`summary` turns failing rows into one row with the count and a status.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.scalars import col
from .neighbours import _keyed, link_values, repeat_rows
from .reshape import orphan_rows

def n_rows() -> Column:
    return F.count(F.lit(1))


def _bound(v) -> Column:
    """A limit given as a Column, a column's name or a plain value."""
    return v if isinstance(v, Column) else F.col(v) if isinstance(v, str) else F.lit(v)


# --- one column, row by row ---------------------------------------------------------------


def not_null(df: DataFrame, column: str) -> DataFrame:
    return df.where(F.col(column).isNull())


def accepted_values(df: DataFrame, column: str, values: Iterable) -> DataFrame:
    """Values outside the list, with their number of rows. NULL passes."""
    counted = df.groupBy(F.col(column).alias("value_field")).agg(n_rows().alias("n_records"))
    return counted.where(~F.col("value_field").isin(list(values)))


def not_accepted_values(df: DataFrame, column: str, values: Iterable) -> DataFrame:
    """Values of the banned list that occur."""
    return df.where(F.col(column).isin(list(values))).select(F.col(column).alias("value_field")).distinct()


def accepted_range(df: DataFrame, column: str, min_value=None, max_value=None, inclusive: bool = True) -> DataFrame:
    """Values outside [min, max] or (min, max). NULL passes, also as a limit."""
    c, fails = F.col(column), F.lit(False)
    if min_value is not None:
        low = _bound(min_value)
        fails = fails | ~(c >= low if inclusive else c > low)
    if max_value is not None:
        high = _bound(max_value)
        fails = fails | ~(c <= high if inclusive else c < high)
    return df.where(fails)


def expression_is_true(df: DataFrame, expression: str, column: str | None = None) -> DataFrame:
    """Rows for which an SQL condition is false; with a column it stands in front. NULL passes."""
    return df.where(f"NOT ({column or ''} {expression})")


def not_empty_string(df: DataFrame, column: str, trim_whitespace: bool = True) -> DataFrame:
    text = F.trim(F.col(column)) if trim_whitespace else F.col(column)
    return df.select(text.alias(column)).where(F.col(column) == "")


def assert_equal_columns(df: DataFrame, actual: str, expected: str) -> DataFrame:
    """Rows in which two columns differ. NULL passes."""
    return df.where(F.col(actual) != F.col(expected))


# --- groups -------------------------------------------------------------------------------


def unique(df: DataFrame, column: str) -> DataFrame:
    """Repeated values of a column with their number of rows. NULL passes."""
    rows = df.where(F.col(column).isNotNull())
    return rows.groupBy(F.col(column).alias("unique_field")).agg(n_rows().alias("n_records")).where("n_records > 1")


def unique_combination(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Repeated combinations of columns; NULLs count as equal."""
    return df.groupBy(*columns).agg(n_rows().alias("__n")).where("__n > 1").drop("__n")


def at_least_one(df: DataFrame, column: str, group_by: Sequence[str] = ()) -> DataFrame:
    """Groups (or the whole table) in which the column is never filled."""
    filled = df.groupBy(*group_by).agg(F.count(column).alias("filler_column"))
    return filled.where(F.col("filler_column") == 0)


def not_constant(df: DataFrame, column: str, group_by: Sequence[str] = ()) -> DataFrame:
    """Groups (or the whole table) with exactly one distinct value. NULL is no value."""
    # One value means that the least and the greatest are the same, which needs no distinct.
    ends = df.groupBy(*group_by).agg(F.min(column).alias("__low"), F.max(column).alias("__high"))
    return ends.where(F.col("__low") == F.col("__high")).select(
        *group_by, F.lit(1).cast("bigint").alias("filler_column")
    )


def not_null_proportion(
    df: DataFrame, column: str, at_least: float, at_most: float = 1.0, group_by: Sequence[str] = ()
) -> DataFrame:
    """Groups whose share of filled rows is outside [at_least, at_most]. An empty table has no share and passes."""
    share = F.try_divide(F.count(column), n_rows()).alias("not_null_proportion")
    return df.groupBy(*group_by).agg(share).where(~F.col("not_null_proportion").between(at_least, at_most))


def recency(
    df: DataFrame,
    field: str,
    datepart: str,
    interval: int,
    as_of: str | Column,
    ignore_time: bool = False,
    group_by: Sequence[str] = (),
) -> DataFrame:
    """Groups whose latest moment is older than ``interval`` dateparts before ``as_of``."""
    kind = "date" if ignore_time else df.schema[field].dataType
    now = F.lit(as_of).cast("timestamp_ntz") if isinstance(as_of, str) else as_of
    threshold = F.timestamp_add(datepart, F.lit(-interval), now).cast(kind)
    latest = df.groupBy(*group_by).agg(F.max(field).cast(kind).alias("most_recent"))
    return latest.withColumn("threshold", threshold).where(F.col("most_recent") < F.col("threshold"))


# --- order within groups --------------------------------------------------------------------


def sequential_values(
    df: DataFrame,
    column: str,
    interval: int = 1,
    datepart: str | None = None,
    group_by: Sequence[str] = (),
    slices: int | None = None,
) -> DataFrame:
    """Rows that are not one step after the previous value of their group.

    The first row of a group passes. Equal values are counted first: the previous value of
    a repeat is the value itself.
    """
    before = f"previous_{column}"
    values = df.where(F.col(column).isNotNull()).groupBy(*group_by, column).agg(n_rows().alias("__n"))
    linked = link_values(values, group_by, column, previous=before, slices=slices)

    def off(previous: str) -> Column:
        if datepart:
            step = F.timestamp_add(datepart, F.lit(interval), F.col(previous))
            return F.col(column).cast("timestamp_ntz") != step.cast("timestamp_ntz")
        return F.col(column) != F.col(previous) + interval

    # Per value: the step into it fails once, the steps between its repeats n - 1 times.
    cases = F.array(
        F.struct(F.col(before).alias("__p"), F.when(off(before), 1).otherwise(0).cast("bigint").alias("__times")),
        F.struct(F.col(column).alias("__p"), F.when(off(column), F.col("__n") - 1).otherwise(0).alias("__times")),
    )
    failing = linked.select(*group_by, column, F.inline(cases)).where(F.col("__times") > 0)
    return repeat_rows(failing.withColumnRenamed("__p", before), "__times")


def mutually_exclusive_ranges(
    df: DataFrame,
    lower: str,
    upper: str,
    partition_by: str | None = None,
    gaps: str = "allowed",
    zero_length_range_allowed: bool = False,
    slices: int | None = None,
) -> DataFrame:
    """Ranges that are empty, without limits, or meet the next range of their group wrongly.

    ``gaps`` is 'allowed', 'not_allowed' or 'required'. Ranges are ordered by both bounds, and
    the last one of a group has nothing to meet. Only the largest upper bound of a lower bound
    meets another lower bound, so the order within one lower bound is not needed.
    """
    meets = {
        "allowed": ("less_than_or_equal_to", lambda a, b: a <= b),
        "not_allowed": ("equal_to", lambda a, b: a == b),
        "required": ("less_than", lambda a, b: a < b),
    }
    if gaps not in meets:
        raise ValueError(f"gaps must be one of {sorted(meets)}, not {gaps!r}")
    gap_word, gap_ok = meets[gaps]
    zero_word = "less_than_or_equal_to" if zero_length_range_allowed else "less_than"
    in_order, in_line = f"lower_bound_{zero_word}_upper_bound", f"upper_bound_{gap_word}_next_lower_bound"

    group = ["partition_by_col"] if partition_by else []
    named = df.select(
        *([F.col(partition_by).alias("partition_by_col")] if partition_by else []),
        F.col(lower).alias("lower_bound"),
        F.col(upper).alias("upper_bound"),
    )
    ranges = named.groupBy(*group, "lower_bound", "upper_bound").agg(n_rows().alias("__n"))
    # NULL sorts first, below every value, both as a lower and as an upper bound.
    starts = ranges.groupBy(*group, "lower_bound").agg(F.max("upper_bound").alias("__widest"))
    chain = link_values(starts, group, "lower_bound", following="__next", slices=slices)
    chain, same_start = _keyed(chain, [*group, "lower_bound"])
    rows = ranges.join(chain, same_start).select(*ranges.columns, "__widest", "__next")
    low, high = F.col("lower_bound"), F.col("upper_bound")
    widest = high.eqNullSafe(F.col("__widest"))
    # One copy of the widest range meets the next start; every other copy meets its own start.
    cases = F.array(
        F.struct(F.col("__next").alias("next_lower_bound"), F.when(widest, 1).otherwise(0).cast("bigint").alias("n"),
                 F.col("__next").isNull().alias("is_last_record")),
        F.struct(low.alias("next_lower_bound"), (F.col("__n") - F.when(widest, 1).otherwise(0)).alias("n"),
                 F.lit(False).alias("is_last_record")),
    )
    met = rows.select(*group, "lower_bound", "upper_bound", F.inline(cases)).where("n > 0")
    zero_ok = low <= high if zero_length_range_allowed else low < high
    judged = met.select(
        *group,
        "lower_bound",
        "upper_bound",
        "next_lower_bound",
        "is_last_record",
        F.coalesce(zero_ok, F.lit(False)).alias(in_order),
        F.coalesce(gap_ok(high, F.col("next_lower_bound")), F.col("is_last_record"), F.lit(False)).alias(in_line),
        "n",
    )
    return repeat_rows(judged.where(~(F.col(in_order) & F.col(in_line))), "n")


# --- two tables -----------------------------------------------------------------------------


def _both(a: DataFrame, b: DataFrame, columns_a: Sequence[str], columns_b: Sequence[str]) -> DataFrame:
    """Number of rows of each table per combination of values; NULLs count as equal."""
    sides = a.select(*columns_a, F.lit(1).alias("in_a"), F.lit(0).alias("in_b")).unionAll(
        b.select(*columns_b, F.lit(0).alias("in_a"), F.lit(1).alias("in_b"))
    )
    return sides.groupBy(*columns_a).agg(F.sum("in_a").alias("rows_a"), F.sum("in_b").alias("rows_b"))


def equality(a: DataFrame, b: DataFrame, columns: Sequence[str] | None = None, multiset: bool = False) -> DataFrame:
    """Rows in only one of the tables, with the side as ``which_diff``.

    Rows are compared as sets, or with ``multiset`` each as often as it occurs more on its side.
    """
    columns = list(columns or a.columns)
    counts = _both(a, b, columns, columns)
    diff = F.col("rows_a") - F.col("rows_b")
    side = F.when(diff > 0, "a_minus_b").otherwise("b_minus_a").alias("which_diff")
    if multiset:
        return repeat_rows(counts.where(diff != 0).select(side, *columns, F.abs(diff).alias("__n")), "__n")
    return counts.where((F.col("rows_a") == 0) | (F.col("rows_b") == 0)).select(side, *columns)


def cardinality_equality(a: DataFrame, column: str, b: DataFrame, field: str) -> DataFrame:
    """Values whose number of rows differs, once for each table they occur in."""
    counts = _both(a, b, [column], [field]).where("rows_a <> rows_b")
    sides = F.explode(F.array("rows_a", "rows_b")).alias("num_rows")
    return counts.select(column, sides).where("num_rows > 0")


def _paired_counts(a: DataFrame, b: DataFrame, group_by: Sequence[str], count_a: str, count_b: str) -> DataFrame:
    """Row counts per group side by side; a group with a NULL in it has no partner."""
    if not group_by:
        totals = a.select(F.lit(1).alias("a"), F.lit(0).alias("b")).unionAll(b.select(F.lit(0), F.lit(1)))
        sums = [F.coalesce(F.sum(c), F.lit(0)).alias(n) for c, n in (("a", count_a), ("b", count_b))]
        return totals.agg(*sums)
    left = a.groupBy(*[F.col(c).alias(f"{c}_a") for c in group_by]).agg(n_rows().alias(count_a))
    right = b.groupBy(*[F.col(c).alias(f"{c}_b") for c in group_by]).agg(n_rows().alias(count_b))
    names = [f"{c}_{side}" for c in group_by for side in "ab"]
    return left.join(right, [F.col(f"{c}_a") == F.col(f"{c}_b") for c in group_by], "full").select(*names, count_a, count_b)


def equal_rowcount(a: DataFrame, b: DataFrame, group_by: Sequence[str] = ()) -> DataFrame:
    """Row counts of both tables with their difference. Failures: sum of ``diff_count``.

    A group missing in one table has no difference.
    """
    counts = _paired_counts(a, b, group_by, "count_a", "count_b")
    return counts.withColumn("diff_count", F.abs(F.col("count_a") - F.col("count_b")))


def fewer_rows_than(a: DataFrame, b: DataFrame, group_by: Sequence[str] = ()) -> DataFrame:
    """Row counts with the excess of the first table. Failures: sum of ``row_count_delta``.

    Equal counts make 1; a group missing in one table makes 0.
    """
    ours, theirs = F.col("count_our_model"), F.col("count_comparison_model")
    counts = _paired_counts(a, b, group_by, "count_our_model", "count_comparison_model")
    delta = F.when(ours > theirs, ours - theirs).when(ours == theirs, 1).otherwise(0).cast("bigint")
    return counts.withColumn("row_count_delta", delta)


def relationships_where(
    df: DataFrame,
    column: str,
    to: DataFrame,
    field: str,
    from_condition: str | Column | None = None,
    to_condition: str | Column | None = None,
) -> DataFrame:
    """References without a row in the other table, both sides filtered first."""
    rows = df if from_condition is None else df.where(from_condition)
    known = to if to_condition is None else to.where(to_condition)
    orphans = orphan_rows(rows, column, known, field)
    kind = to.schema[field].dataType
    return orphans.select(F.col(column).alias("id"), F.lit(None).cast(kind).alias("right_id"))


def filled_rows(df: DataFrame) -> DataFrame:
    """(column_name, n_filled): a table's columns as rows, in small letters, each with the number of rows that have a value in it."""
    if not df.columns:
        return df.sparkSession.createDataFrame([], "column_name string, n_filled bigint")
    counts = df.agg(*[F.count(F.col(f"`{c}`")).alias(str(k)) for k, c in enumerate(df.columns)])
    named = [F.struct(F.lit(c.lower()).alias("column_name"), F.col(str(k)).alias("n_filled")) for k, c in enumerate(df.columns)]
    return counts.select(F.inline(F.array(*named)))


def columns_match(df: DataFrame, other: DataFrame) -> DataFrame:
    """Columns that only one of two tables has, whatever their case, with the rows that fill them."""
    found = filled_rows(df).withColumnRenamed("column_name", "relation_column")
    wanted = filled_rows(other).withColumnsRenamed({"column_name": "input_column", "n_filled": "__filled"})
    paired = found.join(wanted, F.col("relation_column") == F.col("input_column"), "full")
    lone = paired.where(F.col("relation_column").isNull() | F.col("input_column").isNull())
    return lone.select("relation_column", "input_column", F.coalesce("n_filled", "__filled").alias("n_filled"))


def columns_match_set(df: DataFrame, expected: Sequence[str]) -> DataFrame:
    """Column names found but not expected, or expected but not found, whatever their case."""
    spark = df.sparkSession
    wanted = spark.createDataFrame([], T.StructType([T.StructField(c, T.StringType()) for c in dict.fromkeys(c.lower() for c in expected)]))
    return columns_match(df.limit(0), wanted).drop("n_filled")


# --- result -----------------------------------------------------------------------------------

# Failure counts of the checks whose failing rows do not simply count.
FAIL_CALC = {
    "equal_rowcount": lambda: F.sum(F.coalesce(F.col("diff_count"), F.lit(0))),
    "fewer_rows_than": lambda: F.sum(F.coalesce(F.col("row_count_delta"), F.lit(0))),
    "equality": lambda: n_rows()
    + F.abs(F.count_if(F.col("which_diff") == "a_minus_b") - F.count_if(F.col("which_diff") == "b_minus_a")),
}


def summary(
    failing: DataFrame, name: str, fail_calc: Column | None = None, error_if: str = "<> 0", warn_if: str = "<> 0"
) -> DataFrame:
    """One row (check_name, failures, status) with status 'pass', 'warn' or 'error'.

    ``error_if`` and ``warn_if`` are comparisons put behind the number of failures.
    """
    calc = fail_calc if fail_calc is not None else FAIL_CALC.get(name, n_rows)()
    counted = failing.agg(F.coalesce(calc, F.lit(0)).cast("bigint").alias("failures"))
    status = F.when(F.expr(f"failures {error_if}"), "error").when(F.expr(f"failures {warn_if}"), "warn").otherwise("pass")
    return counted.select(F.lit(name).alias("check_name"), "failures", status.alias("status"))
