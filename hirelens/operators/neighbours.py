"""Previous and next value within groups of any size.

A plain ``lag`` sorts each group in one task, so one large group holds up the job. Here the
distinct values are range-partitioned by group and value, which deals every group, however its
values crowd, over as many tasks as its share of the rows asks for. Each slice is ordered by
itself, and the slices' end values are linked afterwards. Values only have to be orderable. The
slices are written once, since their cuts come from a sample; the result does not depend on them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import written

COPIES_PER_STEP = 100_000

_SLICE, _LOW, _HIGH = "__slice", "__low", "__high"


def _keyed(df: DataFrame, columns: Sequence[str]) -> tuple[DataFrame, Column]:
    """The table with its key columns renamed, and their NULL-safe equality to the old names."""
    condition = F.lit(True)
    for name in columns:
        df = df.withColumnRenamed(name, f"__key_{name}")
        condition = condition & F.col(name).eqNullSafe(F.col(f"__key_{name}"))
    return df, condition


def link_values(
    distinct: DataFrame,
    group: Sequence[str],
    value: str,
    previous: str | None = None,
    following: str | None = None,
    slices: int | None = None,
) -> DataFrame:
    """Add the previous and/or following value to the distinct values of groups.

    NULL is the smallest value. With no group columns the whole input is one group. ``slices`` is the
    number of range partitions, by default that of the session's shuffles.
    """
    order = [*group, value]
    ranged = distinct.repartitionByRange(slices, *order) if slices else distinct.repartitionByRange(*order)
    sliced = written(ranged.withColumn(_SLICE, F.spark_partition_id()), "slices")
    within = Window.partitionBy(*group, _SLICE).orderBy(value)
    across = Window.partitionBy(*group).orderBy(_SLICE)
    ends = sliced.groupBy(*group, _SLICE).agg(F.min(value).alias(_LOW), F.max(value).alias(_HIGH))
    out, added = sliced, []
    if previous:
        out = out.withColumn(previous, F.lag(value).over(within))
        ends = ends.withColumn("__before", F.lag(_HIGH).over(across))
        added.append((previous, "__before"))
    if following:
        out = out.withColumn(following, F.lead(value).over(within))
        ends = ends.withColumn("__after", F.lead(_LOW).over(across))
        added.append((following, "__after"))
    ends, same_slice = _keyed(ends, [*group, _SLICE])
    return out.join(ends, same_slice, "left").select(
        *distinct.columns, *[F.coalesce(F.col(name), F.col(end)).alias(name) for name, end in added]
    )


def repeat_rows(df: DataFrame, times: str) -> DataFrame:
    """Each row ``times`` times; long runs are spread over tasks step by step."""
    n, step = F.col(times), "__step"
    steps = df.withColumn(step, F.explode(F.sequence(F.lit(0), F.floor((n - 1) / COPIES_PER_STEP))))
    spread = steps.repartition(step, *[c for c in df.columns if c != times])
    left = F.least(n - F.col(step) * COPIES_PER_STEP, F.lit(COPIES_PER_STEP)).cast("int")
    return spread.withColumn(step, F.explode(F.sequence(F.lit(1), left))).drop(step, times)
