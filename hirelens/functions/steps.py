"""Columns that are computed once, whatever is built on them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def computed_once(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """Add columns that are costly to compute and used in several places.

    A plain ``withColumn`` is merged into what follows: a filter on it moves below it and takes
    a copy of the whole expression along, and so does each use of a struct's field. A generator
    of one row is a step the optimizer leaves in place.
    """
    return df.select("*", F.inline(F.array(F.struct(*[c.alias(n) for n, c in columns.items()]))))
