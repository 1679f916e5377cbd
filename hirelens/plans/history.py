"""Histories: the versions of rows over time, from deliveries that each hold all rows of their day.

A version is a key's values with the time of the delivery that first had them and, once a delivery has other values or
lacks the key, the time of that one (``valid_from``, ``valid_to``). Deliveries may come late and more than once; the
history is the one of all deliveries in the order of their times.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..sources import table_log

FROM, TO = "valid_from", "valid_to"
OPEN, CLOSED = "open", "closed"


def _values(df: DataFrame, keys: Sequence[str], more: Sequence[str] = ()) -> list[str]:
    return [c for c in df.columns if c not in {*keys, *more, FROM, TO}]


def distinct_keys(delivery: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row for each key: of several the one whose values are least. Null keys are keys like any other."""
    values = _values(delivery, keys)
    if not values:
        return delivery.select(*keys).distinct()
    least = F.min(F.struct(*values)).alias("__least")
    return delivery.groupBy(*keys).agg(least).select(*keys, "__least.*").select(delivery.columns)


def build(deliveries: DataFrame, keys: Sequence[str], at: str = "delivered_at") -> DataFrame:
    """The history of all deliveries, told apart by the column ``at``. Nothing is assumed of the rows' order.

    Rows are shuffled by key once, for a key's repeats, its row in each delivery and its versions.
    """
    values = _values(deliveries, keys, [at])
    # One row for each delivery, so that a delivery that lacks a key is known.
    times = deliveries.select(at).distinct()
    in_time = Window.orderBy(at)
    times = times.select(at, F.row_number().over(in_time).alias("__number"), F.lead(at).over(in_time).alias("__next"))
    by = deliveries.select(*keys, at, *values).repartition(*[F.col(k) for k in keys])
    rows = distinct_keys(by, [*keys, at]).join(F.broadcast(times), at)
    by_key = Window.partitionBy(*keys).orderBy("__number")
    state = F.struct(*values) if values else F.lit(True)
    goes_on = (F.lag("__number").over(by_key) == F.col("__number") - 1) & F.lag(state).over(by_key).eqNullSafe(state)
    rows = rows.withColumn("__new", (~F.coalesce(goes_on, F.lit(False))).cast("int"))
    rows = rows.withColumn("__version", F.sum("__new").over(by_key))
    last = F.max(F.struct("__number", "__next")).alias("__last")
    made = rows.groupBy(*keys, "__version").agg(F.min(at).alias(FROM), last, *[F.first(c).alias(c) for c in values])
    return made.select(*keys, *values, FROM, F.col("__last.__next").alias(TO))


def merge(
    history: DataFrame, delivery: DataFrame, keys: Sequence[str], at: Column, following: Column | None = None, buckets: int | None = None
) -> DataFrame:
    """``history`` with one more delivery, made at ``at``.

    ``following`` is the time of the next later delivery that the history already has, if this one is late. Versions that
    hold at both times and the rows delivered meet by key in one shuffle; all other versions pass as they are. If the
    history lies in so many ``buckets`` by the keys, its rows stay where they are and only those delivered are shuffled.
    """
    values = _values(history, keys)
    at = at.cast(history.schema[FROM].dataType)
    later = (F.lit(None) if following is None else following).cast(history.schema[FROM].dataType)
    # A version of this very time is there only if the delivery is merged again.
    holds = (F.col(FROM) <= at) & (F.col(TO).isNull() | (F.col(TO) > at))
    starts = F.coalesce(F.col(FROM) == later, F.lit(False))
    state = F.struct(*[F.col(c) for c in values], F.lit(True).alias("__there"))
    version = F.struct(state.alias("state"), FROM, TO)
    touched = history.where(holds | starts).select(*keys, *values, FROM, TO)
    sent = delivery.select(*keys, *values)
    sent = sent.repartition(buckets, *[F.col(k) for k in keys]) if buckets else sent
    # Rows delivered are known by a missing start. Versions are made structs only where rows have met: Spark does not see
    # the buckets of a union behind new columns.
    nothing = {c: F.lit(None).cast(history.schema[c].dataType) for c in (FROM, TO)}
    sides = {"old": F.when(holds, version), "next": F.when(starts, version), "new": F.when(F.col(FROM).isNull(), state)}
    # Each key has one version at a time; of its rows in a delivery the least counts, as in distinct_keys.
    met = touched.unionAll(sent.withColumns(nothing)).groupBy(*keys).agg(*[F.min(c).alias(name) for name, c in sides.items()])

    def piece(state: Column, start: Column, end: Column) -> Column:
        return F.struct(state.alias("state"), start.alias(FROM), end.alias(TO))

    old, upcoming, now = F.col("old"), F.col("next"), F.col("new")
    unchanged = old.isNotNull() & now.isNotNull() & old["state"].eqNullSafe(now)
    # The old version holds again from the following delivery on, if it held beyond it.
    back = later.isNotNull() & (old[TO].isNull() | (old[TO] > later))
    joins_next = upcoming.isNotNull() & now.isNotNull() & upcoming["state"].eqNullSafe(now)
    pieces = F.array(
        F.when(unchanged, old).when(old.isNotNull(), piece(old["state"], old[FROM], at)),
        F.when(~unchanged & now.isNotNull() & ~joins_next, piece(now, at, later)),
        F.when(~unchanged & old.isNotNull() & back, piece(old["state"], later, old[TO])),
        F.when(joins_next & ~unchanged, piece(now, at, upcoming[TO])).otherwise(upcoming),
    )
    changed = met.select(*keys, F.explode(F.filter(pieces, lambda p: p.isNotNull())).alias("p"))
    changed = changed.select(*keys, *[F.col("p.state")[c].alias(c) for c in values], F.col(f"p.{FROM}").alias(FROM), F.col(f"p.{TO}").alias(TO))
    return history.where(~(holds | starts)).select(changed.columns).unionByName(changed).select(history.columns)


def deliver(spark: SparkSession, path: str, delivery: DataFrame, keys: Sequence[str], at, kind: str = "date") -> bool:
    """Merge a delivery into the history stored at ``path``; False if one of that time is in it already.

    Versions lie in buckets by key, as many as there are shuffle partitions at the first delivery, so that later ones move
    only their own rows. Open and closed versions lie apart: a delivery that is not late reads and writes the open ones and what it closes.
    History and log of deliveries are tables of versions, so a delivery is merged whole or not at all; if it got into the
    history but not into the log, merging it again changes nothing.
    """
    rows, log = f"{path.rstrip('/')}/history", f"{path.rstrip('/')}/deliveries"
    time = F.lit(at).cast(kind)
    following = None
    buckets = (int(spark.conf.get("spark.sql.shuffle.partitions")), keys)
    if table_log.versions(spark, log):
        delivered = F.col("delivered_at")
        found = table_log.read(spark, log).agg(F.max(delivered == time), F.min(F.when(delivered > time, delivered))).first()
        if found[0]:
            return False
        following = None if found[1] is None else F.lit(found[1])
    if table_log.versions(spark, rows):
        known = table_log.read(spark, rows, tag=None if following is not None else OPEN)
        # The rows of a history without buckets are shuffled once, and lie in buckets from then on.
        lie_in = table_log.buckets_of(spark, rows)
        buckets = lie_in or buckets
        now = merge(known, delivery, keys, time, following, lie_in and lie_in[0])
    else:
        by = delivery.repartition(buckets[0], *[F.col(k) for k in keys])
        now = distinct_keys(by, keys).withColumns({FROM: time, TO: F.lit(None).cast(kind)})
    state = F.when(F.col(TO).isNull(), OPEN).otherwise(CLOSED)
    table_log.rebuild(now.withColumn("__state", state), rows, "__state", keep=[] if following is not None else [CLOSED], buckets=buckets)
    table_log.append(spark.range(1).select(time.alias("delivered_at")), log)
    return True


def stored(spark: SparkSession, path: str, open_only: bool = False) -> DataFrame:
    """The history at a path as of its last delivery, or its open versions."""
    return table_log.read(spark, f"{path.rstrip('/')}/history", tag=OPEN if open_only else None)
