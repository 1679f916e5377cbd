"""Reading landed files and named tables."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.reshape import union_relations
from . import array_ranges

# What delivery and `write_json_arrays` call their files.
JSON_FILES = "*.{json,txt}"
END_MARK = "end of the file"
NO_ARRAY, NO_OBJECT = "no JSON array", "no JSON object"
# Files of more bytes are read in ranges by many tasks.
WHOLE_BELOW = 64 << 20


def _array_files(spark: SparkSession, path: str, name_glob: str, path_part: str | None, whole_below: int) -> DataFrame:
    """(path, items) of the smaller files below a path; items is NULL where a file is not exactly one JSON array."""
    files = spark.read.text(path, wholetext=True, recursiveFileLookup=True, pathGlobFilter=name_glob)
    files = files.where(F.col("_metadata.file_size") <= whole_below).select(F.col("_metadata.file_path").alias("path"), "value")
    if path_part:
        files = files.where(F.col("path").contains(path_part))
    # The parser stops at the end of a value. With a mark behind the array, text that goes on breaks the list.
    marked = F.from_json(F.concat(F.lit("["), "value", F.lit(f',["{END_MARK}"]]')), "array<array<variant>>")
    parsed = files.withColumn("__parts", F.when(F.col("value").rlike(r"^\s*\["), marked))
    ends = F.try_variant_get(F.get(F.get("__parts", F.lit(1)), F.lit(0)), "$", "string") == END_MARK
    whole = F.coalesce((F.size("__parts") == 2) & ends, F.lit(False))
    return parsed.select("path", F.when(whole, F.get("__parts", F.lit(0))).alias("items"))


def _is_object(item) -> Column:
    return F.coalesce(F.schema_of_variant(item).startswith("OBJECT"), F.lit(False))


def scan_json(
    spark: SparkSession, path: str, schema: T.StructType, name_glob: str = JSON_FILES, path_part: str | None = None,
    whole_below: int = WHOLE_BELOW, **options,
) -> DataFrame:
    """Objects of all JSON array files below a path.

    A file that is not exactly one array is left out, and so is an item that is no object;
    :func:`scan_rejects` lists both. A value that does not fit its type is NULL. ``name_glob``
    chooses by file name, ``path_part`` by text anywhere in the path. A file of up to
    ``whole_below`` bytes is parsed as one value, a larger one is read in ranges by many tasks, see
    :mod:`hirelens.sources.array_ranges`; the rows are the same.
    """
    items = _array_files(spark, path, name_glob, path_part, whole_below).select(F.explode("items").alias("item")).where(_is_object("item")).select(F.to_json("item").alias("item"))
    if _has_larger(spark, path, name_glob, path_part, whole_below):
        more, _ = array_ranges.read_ranges(spark, path, name_glob, path_part, whole_below, **options)
        items = items.unionAll(more.where("object").select("item"))
    typed = F.from_json("item", schema, {"mode": "PERMISSIVE"})
    return items.select(typed.alias("row")).select("row.*")


def _has_larger(spark: SparkSession, path: str, name_glob: str, path_part: str | None, size: int) -> bool:
    return not array_ranges.large_files(spark, path, name_glob, path_part, size).isEmpty()


def scan_rejects(
    spark: SparkSession, path: str, name_glob: str = JSON_FILES, path_part: str | None = None, whole_below: int = WHOLE_BELOW, **options
) -> DataFrame:
    """What :func:`scan_json` leaves out: (path, position of the item or NULL for a whole file, reason).

    A file without any text has nothing to lose and is not listed.
    """
    files = _array_files(spark, path, name_glob, path_part, whole_below)
    listed = files.select("path", F.col("items").isNull().alias("broken"), F.posexplode_outer("items").alias("position", "item"))
    odd = listed.where(F.col("broken") | (F.col("position").isNotNull() & ~_is_object("item")))
    odd = odd.select("path", F.col("position").cast("long").alias("position"), F.when(F.col("broken"), NO_ARRAY).otherwise(NO_OBJECT).alias("reason"))
    if _has_larger(spark, path, name_glob, path_part, whole_below):
        items, broken = array_ranges.read_ranges(spark, path, name_glob, path_part, whole_below, numbered=True, **options)
        odd = odd.unionAll(items.where("NOT object").select("path", "position", F.lit(NO_OBJECT)))
        odd = odd.unionAll(broken.select("path", F.lit(None).cast("long"), F.lit(NO_ARRAY)))
    return odd


def scan_named(spark: SparkSession, path: str, schema: T.StructType, part: str = "silver_enriched_", **options) -> DataFrame:
    """:func:`scan_json` of the files with ``part`` in their path."""
    return scan_json(spark, path, schema, path_part=part, **options)


def scan_json_lines(spark: SparkSession, path: str, schema: T.StructType, path_part: str | None = None) -> DataFrame:
    """Rows of files with one JSON object a line, which several tasks can read."""
    rows = spark.read.schema(schema).json(path, recursiveFileLookup=True)
    return rows.where(F.col("_metadata.file_path").contains(path_part)) if path_part else rows


def scan_table(spark: SparkSession, name: str) -> DataFrame:
    """A named table or view, or the parquet files at a path."""
    return spark.read.parquet(name) if "/" in name else spark.table(name)


def _like(name: str, pattern: str) -> bool:
    # SQL LIKE without case: % any text, _ any character.
    return re.fullmatch("".join({"%": ".*", "_": "."}.get(ch, re.escape(ch)) for ch in pattern), name, re.I | re.S) is not None


def tables_by_pattern(spark: SparkSession, schema_pattern: str, table_pattern: str, exclude: str = "") -> list[str]:
    """Full names of the tables and views that match, in order of name.

    Temporary views belong to no schema and match any schema pattern.
    """
    found = set()
    schemas = [d.name for d in spark.catalog.listDatabases() if _like(d.name, schema_pattern)]
    for schema in schemas or [None]:
        for table in spark.catalog.listTables(schema):
            if table.isTemporary or schema:
                if _like(table.name, table_pattern) and not _like(table.name, exclude):
                    found.add(table.name if table.isTemporary else f"{schema}.{table.name}")
    return sorted(found)


def tables_by_prefix(spark: SparkSession, schema: str, prefix: str, exclude: str = "") -> list[str]:
    """Full names of the tables and views of a schema whose name begins with a prefix."""
    return tables_by_pattern(spark, schema, f"{prefix}%", exclude)


def union_matching_tables(
    spark: SparkSession, table_pattern: str, schema_pattern: str = "%", exclude: str = "", **options
) -> DataFrame:
    """Union of all tables and views whose name matches, named in full, see :func:`union_relations`."""
    names = tables_by_pattern(spark, schema_pattern, table_pattern, exclude)
    return union_relations({name: spark.table(name) for name in names}, **options)
