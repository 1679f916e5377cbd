"""Scalar functions over Columns: keys, safe arithmetic, dates, buckets, distance."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Stored keys and distances depend on them.
NULL_KEY_TEXT = "_dbt_utils_surrogate_key_null_"
EARTH_RADIUS_MILES = 3961
KM_PER_MILE = 1.60934
ACTIVE_DAYS = 60


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def surrogate_key(*fields, nulls_as_empty: bool = False) -> Column:
    """md5 of the fields' texts joined by '-'. NULL differs from '' unless told otherwise."""
    missing = F.lit("" if nulls_as_empty else NULL_KEY_TEXT)
    return F.md5(F.concat_ws("-", *[F.coalesce(col(f).cast("string"), missing) for f in fields]))


def safe_add(*fields) -> Column:
    """Sum in which NULL counts as 0."""
    return reduce(lambda a, b: a + b, [F.coalesce(col(f), F.lit(0)) for f in fields])


def safe_subtract(*fields) -> Column:
    """First field minus the others; NULL counts as 0."""
    return reduce(lambda a, b: a - b, [F.coalesce(col(f), F.lit(0)) for f in fields])


def safe_divide(numerator, denominator) -> Column:
    """Quotient, NULL where the denominator is 0 or NULL."""
    return col(numerator) / F.nullif(col(denominator), F.lit(0))


def blank_to_null(c) -> Column:
    """'' becomes NULL."""
    return F.nullif(col(c), F.lit(""))


def first_filled(*fields) -> Column:
    """First text that is neither NULL nor ''."""
    return F.coalesce(*[blank_to_null(f) for f in fields])


def first_nonzero(*fields) -> Column:
    """First number that is neither NULL nor 0."""
    return F.coalesce(*[F.nullif(col(f), F.lit(0.0)) for f in fields])


def job_ref() -> Column:
    """The id a posting is known by: the source's id, else the older one."""
    return F.coalesce(F.col("source_job_id"), F.col("job_id"))


def date_key(c) -> Column:
    """A date as the integer yyyymmdd."""
    return F.date_format(col(c), "yyyyMMdd").cast("bigint")


def iso_date(c) -> Column:
    """The date an ISO text starts with, NULL where there is none."""
    return F.substring(col(c), 1, 10).try_cast("date")


def is_active(posted_at, expires_at, as_of) -> Column:
    """False once expired or older than the time to live; unreadable dates do not expire."""
    today = F.lit(as_of).cast("date")
    return (
        F.when(iso_date(expires_at) < today, False)
        .when(iso_date(posted_at) < F.date_sub(today, ACTIVE_DAYS), False)
        .otherwise(True)
    )


def days_between(start, end) -> Column:
    """Whole days from start to end, at least 1 where it would be 0."""
    days = F.timestamp_diff("DAY", col(start), col(end)).cast("bigint")
    return F.when(days == 0, F.lit(1).cast("bigint")).otherwise(days)


def width_bucket(value, low, high, buckets: int) -> Column:
    """Histogram bucket: 0 below ``low``, ``buckets`` + 1 from ``high`` on."""
    return F.width_bucket(col(value).cast("double"), F.lit(float(low)), F.lit(float(high)), F.lit(buckets).cast("bigint"))


def width_bucket_formula(value, low, high, buckets: int) -> Column:
    """Bucket by rounding up, one more where the value is a multiple of the bucket size.

    Kept beside :func:`width_bucket` for tables that hold its numbers. The two differ
    outside the range and where ``low`` is not a multiple of the bucket size.
    """
    value = col(value)
    size = (high - low) / buckets
    exact = "decimal(38,9)"
    on_edge = value.try_cast(exact) % F.lit(size).cast(exact) == 0
    raised = F.least(F.ceil((value - F.lit(low)) / F.lit(size)), F.lit(buckets + 1).cast("bigint"))
    return F.when(on_edge, 1).otherwise(0).cast("bigint") + raised


def haversine(lat1, lon1, lat2, lon2, unit: str = "mi") -> Column:
    """Great-circle distance between two points given in degrees."""
    if unit not in ("mi", "km"):
        raise ValueError(f"unit must be 'mi' or 'km', not {unit!r}")
    lat1, lon1, lat2, lon2 = (F.radians(col(c)) for c in (lat1, lon1, lat2, lon2))
    half_chord = F.pow(F.sin((lat2 - lat1) / 2), F.lit(2)) + F.cos(lat1) * F.cos(lat2) * F.pow(
        F.sin((lon2 - lon1) / 2), F.lit(2)
    )
    miles = F.asin(F.sqrt(half_chord)) * (2 * EARTH_RADIUS_MILES)
    return miles if unit == "mi" else miles * KM_PER_MILE


def round_half_even(c, places: int = 0) -> Column:
    """Rounding that takes ties to the even digit."""
    return F.bround(col(c), places)
