"""An index of the ids a table has, in buckets with a Bloom filter each, for loads that add what is not there yet.

A load asks the filters first. Ids that no filter knows are new without a look at the stored ids; the others are
compared with the stored ids of their own buckets, and no other bucket is read. The filters are bitmaps, so those of a
load are merged into the stored ones. An overfull filter costs reads but never an id.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.scalars import blank_to_null
from ..operators.reshape import anti_join_seen
from ..session import written
from . import table_log

BUCKETS = 64
BITS = 32768  # fixed by Spark's bitmap functions
HASHES = 4
BITS_OF_ID = 10  # with four hashes about one new id in a hundred is looked up in vain


def _place(ident: Column, of: int, seed: int) -> Column:
    return F.pmod(F.xxhash64(ident, F.lit(seed)), F.lit(of))


def _sizes(spark: SparkSession, path: str) -> tuple[int, int]:
    said = table_log.read(spark, f"{path}/sizes").first()
    return said.buckets, said.blocks


def create(spark: SparkSession, path: str, expected: int, buckets: int = BUCKETS) -> None:
    """An empty index, its filters sized for the number of ids expected in it; more are held as rightly, with more reads."""
    blocks = max(1, math.ceil(expected * BITS_OF_ID / (buckets * BITS)))
    table_log.rebuild(spark.createDataFrame([(buckets, blocks)], "buckets int, blocks int"), f"{path}/sizes")


def _filters(spark: SparkSession, path: str) -> DataFrame:
    where = f"{path}/filters"
    if not table_log.versions(spark, where):
        return spark.createDataFrame([], "bucket bigint, block bigint, bits binary")
    return table_log.read(spark, where)


def extend(ids: DataFrame, column: str, path: str) -> None:
    """Put the ids of a column into the index; NULL and blank ids, and those that are there already, may be among them.

    The filters are complete before the ids are, so that a load that fails between them loses none.
    """
    spark = ids.sparkSession
    buckets, blocks = _sizes(spark, path)
    ident = blank_to_null(F.col(f"`{column}`").cast("string"))
    once = ids.select(ident.alias("id")).where("id IS NOT NULL").distinct()
    rows = written(once.withColumns({"bucket": _place(F.col("id"), buckets, 0), "block": _place(F.col("id"), blocks, 1)}), "ids")
    bits = F.array(*[_place(F.col("id"), BITS, 2 + k) for k in range(HASHES)])
    made = rows.select("bucket", "block", F.explode(bits).alias("bit")).groupBy("bucket", "block")
    both = _filters(spark, path).unionByName(made.agg(F.bitmap_construct_agg("bit").alias("bits")))
    table_log.rebuild(both.groupBy("bucket", "block").agg(F.bitmap_or_agg("bits").alias("bits")), f"{path}/filters")
    table_log.append(rows.select("id", "bucket").repartition("bucket"), f"{path}/ids", tag="bucket")


def _stored(spark: SparkSession, path: str, buckets: list[str]) -> DataFrame:
    where = f"{path}/ids"
    if not table_log.versions(spark, where):
        return spark.createDataFrame([], "id string")
    return table_log.read(spark, where, tag=buckets)


def candidates(rows: DataFrame, column: str, path: str) -> DataFrame:
    """``rows`` with ``__id``, its ``__bucket``, and ``__maybe``: whether the filters know the id."""
    spark = rows.sparkSession
    buckets, blocks = _sizes(spark, path)
    ident = F.col("__id")
    # Rows without an id get buckets that no filter has, one for each task's rows, so that they don't meet in one task.
    nowhere = F.lit(-1) - F.spark_partition_id()
    placed = rows.withColumn("__id", blank_to_null(F.col(f"`{column}`").cast("string"))).withColumns(
        {"__bucket": F.when(ident.isNull(), nowhere).otherwise(_place(ident, buckets, 0)), "__block": F.coalesce(_place(ident, blocks, 1), F.lit(0))}
    )
    known = _filters(spark, path).select(*[F.col(c).alias(f"__{c}") for c in ("bucket", "block", "bits")])
    found = placed.join(known, ["__bucket", "__block"], "left")
    maybe = F.col("__bits").isNotNull()
    for k in range(HASHES):
        bit = _place(ident, BITS, 2 + k)
        byte = F.conv(F.hex(F.substring("__bits", (F.floor(bit / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
        maybe = maybe & (F.call_function("bit_get", byte, (bit % 8).cast("int")) == 1)
    return found.select(*[f"`{c}`" for c in rows.columns], "__id", "__bucket", F.coalesce(maybe, F.lit(False)).alias("__maybe"))


def touched(found: DataFrame) -> list[str]:
    """The buckets whose stored ids have to be read; at most as many as the index has."""
    return sorted(str(r[0]) for r in found.where("__maybe").select("__bucket").distinct().collect())


def unseen(rows: DataFrame, column: str, path: str, keep_null_ids: bool = True) -> DataFrame:
    """The rows whose id is not in the index, repeated ones too; those without an id stay if ``keep_null_ids``."""
    found = written(candidates(rows, column, path), "candidates")
    if not keep_null_ids:
        found = found.where("__id IS NOT NULL")
    new, asked = found.where("NOT __maybe"), found.where("__maybe")
    stored = _stored(rows.sparkSession, path, touched(found))
    left = anti_join_seen(asked, stored.withColumnRenamed("id", "__seen"), F.col("__id"), F.col("__seen"), keep_null_ids=False)
    return new.drop("__id").unionByName(left).drop("__bucket", "__maybe")


def compact(spark: SparkSession, path: str) -> None:
    """Bring the files of all loads together, one folder for each bucket."""
    buckets, _ = _sizes(spark, path)
    if table_log.versions(spark, f"{path}/ids"):
        ids = table_log.read(spark, f"{path}/ids").withColumn("bucket", _place(F.col("id"), buckets, 0))
        table_log.rebuild(ids.repartition("bucket"), f"{path}/ids", tag="bucket")
