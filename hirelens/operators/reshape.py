"""Table operators: column selection, unions, pivots, deduplication, row generators."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.scalars import blank_to_null, col
from .types import superset, widened

# Fixed value: the name that stored unions have for the source of a row.
SOURCE_COLUMN = "_dbt_source_relation"


def slug(text: str) -> str:
    """Text as a plain column name: lower case, '_' for blanks and dashes."""
    text = re.sub(r"[ -]+", "_", text.lower())
    text = re.sub(r"[^a-z0-9_]+", "", text)
    return f"_{text}" if text[:1].isdigit() else text


def _lower(names) -> set[str]:
    return {n.lower() for n in names or ()}


def other_columns(df: DataFrame, excluded: Sequence[str] = ()) -> list[str]:
    """Column names that are not excluded, whatever their case."""
    drop = _lower(excluded)
    return [c for c in df.columns if c.lower() not in drop]


def star_except(df: DataFrame, excluded: Sequence[str] = (), prefix: str = "", suffix: str = "") -> DataFrame:
    """All columns but the excluded ones, renamed with a prefix and suffix."""
    return df.select([F.col(f"`{c}`").alias(f"{prefix}{c}{suffix}") for c in other_columns(df, excluded)])


def _map_columns(df: DataFrame, wanted, change) -> DataFrame:
    return df.select([change(F.col(f.name), f).alias(f.name) if wanted(f.dataType) else F.col(f.name) for f in df.schema])


def nullcheck_table(df: DataFrame) -> DataFrame:
    """'' becomes NULL in every text column."""
    return _map_columns(df, lambda t: isinstance(t, T.StringType), lambda c, _: blank_to_null(c))


def null_empty_complex(df: DataFrame) -> DataFrame:
    """Empty lists and maps become NULL."""
    return _map_columns(df, lambda t: isinstance(t, (T.ArrayType, T.MapType)), lambda c, _: F.when(F.size(c) > 0, c))


def flatten_struct(df: DataFrame, struct: str, prefix: str) -> DataFrame:
    """Fields of a struct column as columns of their own, the struct dropped."""
    fields = df.schema[struct].dataType.names
    kept = [F.col(c) for c in df.columns if c != struct]
    return df.select(*kept, *[F.col(struct)[f].alias(f"{prefix}{f}") for f in fields])


def union_relations(
    tables: Mapping[str, DataFrame],
    column_override: Mapping[str, str] | None = None,
    include: Sequence[str] = (),
    exclude: Sequence[str] = (),
    source_column: str | None = SOURCE_COLUMN,
    where: str | Column | None = None,
) -> DataFrame:
    """Union of tables with unlike columns, in the order they are first seen.

    Columns are matched by name, whatever its case. A column takes the superset of its types in all tables (see
    :func:`hirelens.operators.types.superset`), or the type in ``column_override``; where a table lacks it the value is NULL.
    """
    if include and exclude:
        raise ValueError("give include or exclude, not both")
    keep, drop = _lower(include), _lower(exclude)
    seen: dict[str, list[T.StructField]] = {}
    for df in tables.values():
        for field in df.schema:
            name = field.name.lower()
            if name not in drop and (not keep or name in keep):
                seen.setdefault(name, []).append(field)
    if not seen:
        raise ValueError(f"no columns to union for {', '.join(tables)}")
    override = {c.lower(): kind for c, kind in (column_override or {}).items()}

    def aligned(name: str, df: DataFrame) -> DataFrame:
        rows = df if where is None else df.where(where)
        source = [F.lit(name).alias(source_column)] if source_column else []
        own = {f.name.lower(): f for f in df.schema}
        columns = []
        for key, fields in seen.items():
            has = own.get(key)
            value = F.lit(None) if has is None else F.col(f"`{has.name}`")
            if key in override:
                value = value.cast(override[key])
            else:
                value = widened(value, T.NullType() if has is None else has.dataType, wanted[key])
            columns.append(value.alias(fields[0].name))
        return rows.select(*source, *columns)

    wanted = {key: superset([f.dataType for f in fields]) for key, fields in seen.items() if key not in override}
    return reduce(DataFrame.unionAll, [aligned(n, df) for n, df in tables.items()])


def frequency(
    df: DataFrame,
    column: str,
    where: str | Column | None = None,
    order_by: Sequence[Column] | None = None,
    max_records: int | None = None,
) -> DataFrame:
    """Values of a column with their counts, most frequent first, then by value."""
    rows = df if where is None else df.where(where)
    counted = rows.groupBy(F.col(column).alias("value")).agg(F.count(F.lit(1)).alias("n"))
    ordered = counted.orderBy(*(order_by or [F.desc("n"), F.asc_nulls_last("value")]))
    return ordered if max_records is None else ordered.limit(max_records)


def column_values(df: DataFrame, column: str, default: list | None = None, **options) -> list:
    """The values of :func:`frequency` as a list, for use as pivot headings; ``default`` if none.

    Headings are part of a schema and so live on the driver. For values as rows take :func:`frequency`.
    """
    values = [r["value"] for r in frequency(df, column, **options).select("value").collect()]
    return values or list(default or [])


def pivot(
    df: DataFrame,
    by: Sequence[str],
    column: str,
    values: Sequence | None = None,
    agg: str = "sum",
    cmp: str = "=",
    then_value: Column | str | int = 1,
    else_value: Column | str | int | None = 0,
    prefix: str = "",
    suffix: str = "",
    slug_names: bool = False,
    distinct: bool = False,
) -> DataFrame:
    """One column per value: the aggregate of ``then_value`` where the comparison holds."""
    compare = {
        "=": lambda c, v: c == v,
        "<>": lambda c, v: c != v,
        "!=": lambda c, v: c != v,
        "<": lambda c, v: c < v,
        "<=": lambda c, v: c <= v,
        ">": lambda c, v: c > v,
        ">=": lambda c, v: c >= v,
        "ilike": lambda c, v: c.ilike(v),
        "like": lambda c, v: c.like(v),
    }[cmp.lower()]

    def literal(v) -> Column:
        return F.expr(v) if isinstance(v, str) else v if isinstance(v, Column) else F.lit(v)

    def heading(value) -> str:
        name = f"{prefix}{value}{suffix}"
        return slug(name) if slug_names else name

    # min and max of distinct values are those of all values.
    on_distinct = {"count": F.countDistinct, "sum": F.sum_distinct}
    aggregate = distinct and on_distinct.get(agg) or (lambda c: F.call_function(agg, c))
    if values is None:
        values = column_values(df, column)
    aggregates = [
        aggregate(F.when(compare(F.col(column), F.lit(v)), literal(then_value)).otherwise(literal(else_value))).alias(
            heading(v)
        )
        for v in values
    ]
    return df.groupBy(*by).agg(*aggregates)


def crosstab_sum(df: DataFrame, row: str, column: str, value: str, columns: Sequence[str] | None = None) -> DataFrame:
    """Sums of ``value`` by row and column, 0 where there is none."""
    grouped = df.where(F.col(row).isNotNull()).groupBy(row)
    spread = grouped.pivot(column, columns) if columns else grouped.pivot(column)
    return spread.agg(F.sum(value)).na.fill(0)


def unpivot(
    df: DataFrame,
    cast_to: str = "string",
    exclude: Sequence[str] = (),
    remove: Sequence[str] = (),
    field_name: str = "field_name",
    value_name: str = "value",
) -> DataFrame:
    """Columns to rows; ``exclude`` columns are kept beside each, ``remove`` columns left out."""
    names = other_columns(df, [*exclude, *remove])

    def value(name: str) -> Column:
        c = F.col(name)
        return (c.cast("string") if df.schema[name].dataType == T.BooleanType() else c).cast(cast_to).alias(name)

    return df.select(*exclude, *[value(n) for n in names]).unpivot(list(exclude), names, field_name, value_name)


def deduplicate(df: DataFrame, partition_by: Sequence[str | Column], order_by: Sequence[Column]) -> DataFrame:
    """The first row per key in the given order; NULL keys form a group."""
    position = F.row_number().over(Window.partitionBy(*partition_by).orderBy(*order_by))
    return df.withColumn("__position", position).where(F.col("__position") == 1).drop("__position")


def top_k(df: DataFrame, k: int, *order_by: Column) -> DataFrame:
    """The first k rows in an order; give enough columns to make the order full."""
    return df.orderBy(*order_by).limit(k)


def group_by_first(df: DataFrame, n: int, *aggregates: Column) -> DataFrame:
    """Aggregates grouped by the first n columns."""
    return df.groupBy(*df.columns[:n]).agg(*aggregates)


def explode_items(df: DataFrame, array: str, item: str) -> DataFrame:
    """One row per array element; rows with a NULL or empty array vanish."""
    return df.select(*[c for c in df.columns if c != array], F.explode(array).alias(item))


def generate_series(spark: SparkSession, upper: int) -> DataFrame:
    """The numbers 1 to ``upper``."""
    if upper <= 0:
        raise ValueError("upper bound must be positive")
    return spark.range(1, upper + 1).select(F.col("id").alias("generated_number"))


def date_spine(spark: SparkSession, datepart: str, start: str, end: str) -> DataFrame:
    """Dates or timestamps from start, one per datepart, the end left out."""
    kind = "timestamp_ntz" if datepart.lower() in ("hour", "minute", "second") else "date"
    first, last = F.lit(start).cast("timestamp_ntz"), F.lit(end).cast("timestamp_ntz")
    # The number of period starts between the two, so that a last part period adds no row.
    periods = F.timestamp_diff(datepart, F.date_trunc(datepart, first), F.date_trunc(datepart, last))
    moment = F.timestamp_add(datepart, F.col("generated_number").cast("int") - 1, first)
    return (
        generate_series(spark, spark.range(1).select(periods).first()[0])
        .select(moment.alias("__moment"))
        .where(F.col("__moment") <= last)
        .select(F.col("__moment").cast(kind).alias(f"date_{datepart}"))
    )


def anti_join_seen(
    new: DataFrame, seen: DataFrame, new_id: Column, seen_id: Column, keep_null_ids: bool
) -> DataFrame:
    """Rows whose id is not among the stored ones.

    A NULL or '' id is never stored. It is dropped or kept as ``keep_null_ids`` says.
    """
    stored = seen.select(blank_to_null(seen_id).alias("__seen")).where(F.col("__seen").isNotNull()).distinct()
    rows = new.withColumn("__id", blank_to_null(new_id))
    # Rows without an id go past the join, where they would all meet in one task.
    fresh = rows.where(F.col("__id").isNotNull()).join(stored, F.col("__id") == F.col("__seen"), "left_anti")
    if keep_null_ids:
        fresh = fresh.unionAll(rows.where(F.col("__id").isNull()))
    return fresh.drop("__id")


def orphan_rows(df: DataFrame, column: str, to: DataFrame, field: str) -> DataFrame:
    """Rows whose non-null reference has no row in the other table."""
    known = to.select(F.col(field).alias("__known")).where(F.col("__known").isNotNull()).distinct()
    return df.where(F.col(column).isNotNull()).join(known, F.col(column) == F.col("__known"), "left_anti")
