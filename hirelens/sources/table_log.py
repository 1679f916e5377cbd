"""Tables as a log of versions: each version names the folders of its files and their schema.

A version's files are complete before its entry is made, in one step that fails if the number is taken. Readers take the
highest entry, so they never see a table half rebuilt, and a rebuild that fails leaves the rows as they were.
Schemas come from the log; no file's footer is read for them. Rows may lie in buckets by key, so that a later shuffle by
this key moves only the rows that join them.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ..operators.reshape import union_relations

LOG = "_versions"
DIGITS = 12


class VersionTaken(RuntimeError):
    """Another writer made the next version first."""


def _folder(spark: SparkSession, path: str):
    hadoop = spark._jvm.org.apache.hadoop.fs.Path
    where = hadoop(f"{path.rstrip('/')}/{LOG}")
    return hadoop, where, where.getFileSystem(spark._jsc.hadoopConfiguration())


def versions(spark: SparkSession, path: str) -> list[int]:
    """The numbers of the versions of a table, in order."""
    _, where, files = _folder(spark, path)
    if not files.exists(where):
        return []
    names = [f.getPath().getName() for f in files.listStatus(where)]
    return sorted(int(n.removesuffix(".json")) for n in names if n.endswith(".json"))


def entry(spark: SparkSession, path: str, version: int) -> dict:
    """What a version says: its folders, each with the schema of its files."""
    hadoop, where, files = _folder(spark, path)
    stream = files.open(hadoop(where, f"{version:0{DIGITS}d}.json"))
    try:
        return json.loads(bytes(stream.readAllBytes()))
    finally:
        stream.close()


def _commit(spark: SparkSession, path: str, version: int, content: dict) -> None:
    hadoop, where, files = _folder(spark, path)
    files.mkdirs(where)
    # The entry is written aside; giving it its name is the one step that makes the version.
    aside, final = hadoop(where, f".{uuid.uuid4().hex}"), hadoop(where, f"{version:0{DIGITS}d}.json")
    stream = files.create(aside, False)
    stream.write(bytearray(json.dumps(content).encode("utf-8")))
    stream.close()
    if files.exists(final) or not files.rename(aside, final):
        files.delete(aside, False)
        raise VersionTaken(f"version {version} of {path} is there already")


def _write(df: DataFrame, path: str, tag: str | None = None, buckets: tuple[int, Sequence[str]] | None = None) -> list[dict]:
    """The parts written: one folder, or with ``tag`` one for each value of that column, which itself is not written."""
    spark, name = df.sparkSession, f"files-{uuid.uuid4().hex}"
    schema = json.loads(df.drop(tag).schema.json() if tag else df.schema.json())
    folder, part = f"{path.rstrip('/')}/{name}", {"schema": schema}
    writer = df.write.format("parquet").option("compression", "zstd")
    writer = writer.partitionBy(tag) if tag else writer
    if buckets is None:
        writer.save(folder)
    else:
        count, keys = buckets
        made = _table_name()
        writer.bucketBy(count, *keys).option("path", folder).saveAsTable(made)
        spark.sql(f"DROP TABLE {made}")  # the files stay
        part["buckets"] = {"count": count, "keys": [*keys]}
    if tag is None:
        return [{"folder": name, **part}]
    hadoop, _, files = _folder(spark, path)
    made = sorted(f.getPath().getName() for f in files.listStatus(hadoop(folder)) if f.isDirectory())
    return [{"folder": f"{name}/{m}", **part, "tag": m.partition("=")[2]} for m in made]


def _table_name() -> str:
    return f"hirelens_{uuid.uuid4().hex}"


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _read_buckets(spark: SparkSession, folder: str, schema: T.StructType, count: int, keys: Sequence[str]) -> DataFrame:
    """The rows of a folder of which Spark knows that they lie in buckets; only a table can say so."""
    types = spark._jvm.org.apache.spark.sql.types.DataType
    columns = ", ".join(f"{_quoted(f.name)} {types.fromJson(f.dataType.json()).sql()}" for f in schema.fields)
    name, by, place = _table_name(), ", ".join(map(_quoted, keys)), folder.replace("\\", "\\\\").replace("'", "\\'")
    spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet CLUSTERED BY ({by}) INTO {count} BUCKETS LOCATION '{place}'")
    try:
        return spark.table(name)
    finally:
        spark.sql(f"DROP TABLE {name}")


def buckets_of(spark: SparkSession, path: str) -> tuple[int, list[str]] | None:
    """The number and keys of the buckets in which all rows of the latest version lie, if they do."""
    known = {json.dumps(p.get("buckets")) for p in entry(spark, path, versions(spark, path)[-1])["parts"]}
    said = json.loads(known.pop()) if len(known) == 1 else None
    return (said["count"], said["keys"]) if said else None


def _next(spark: SparkSession, path: str) -> tuple[int, list[dict]]:
    before = versions(spark, path)
    return (before[-1] + 1, entry(spark, path, before[-1])["parts"]) if before else (1, [])


def rebuild(
    df: DataFrame, path: str, tag: str | None = None, keep: Sequence[str] = (), buckets: tuple[int, Sequence[str]] | None = None
) -> int:
    """A new version with the rows of ``df``; its number. ``df`` may read the table itself.

    With ``tag``, the name of a column, rows lie in parts by its value. Parts of the version before with a tag in
    ``keep`` stay beside them without being read. With ``buckets``, a number and columns, each part lies in so many
    buckets by these; tasks should hold one bucket each, since each task writes a file for each bucket it has.
    """
    number, parts = _next(df.sparkSession, path)
    kept = [p for p in parts if p.get("tag") in set(keep)]
    schema = json.loads(df.drop(tag).schema.json() if tag else df.schema.json())
    _commit(df.sparkSession, path, number, {"schema": schema, "parts": [*kept, *_write(df, path, tag, buckets)]})
    return number


def append(df: DataFrame, path: str, tag: str | None = None) -> int:
    """A new version with the rows so far and those of ``df``, which may have other columns or types; ``tag`` as in :func:`rebuild`."""
    number, parts = _next(df.sparkSession, path)
    schema = json.loads(df.drop(tag).schema.json() if tag else df.schema.json())
    _commit(df.sparkSession, path, number, {"schema": schema, "parts": [*parts, *_write(df, path, tag)]})
    return number


def read(spark: SparkSession, path: str, version: int | None = None, tag: str | Sequence[str] | None = None) -> DataFrame:
    """The rows of a version, the latest if none is named, under the superset of its parts' schemas; of one tag or several only, if given."""
    known = versions(spark, path)
    if not known or (version is not None and version not in known):
        raise ValueError(f"no version {'' if version is None else version} of a table at {path}")
    said = entry(spark, path, known[-1] if version is None else version)
    same: dict[str, list[dict]] = {}
    tags = {tag} if isinstance(tag, str) else None if tag is None else set(tag)
    for part in said["parts"]:
        if tags is None or part.get("tag") in tags:
            same.setdefault(json.dumps(part["schema"]), []).append(part)
    if not same:
        return spark.createDataFrame([], T.StructType.fromJson(said["schema"]))

    def rows(schema: T.StructType, parts: list[dict]) -> DataFrame:
        plain = [f"{path.rstrip('/')}/{p['folder']}" for p in parts if "buckets" not in p]
        made = [spark.read.schema(schema).parquet(*plain)] if plain else []
        made += [_read_buckets(spark, f"{path.rstrip('/')}/{p['folder']}", schema, **p["buckets"]) for p in parts if "buckets" in p]
        return reduce(DataFrame.unionAll, made)

    groups = {str(k): rows(T.StructType.fromJson(json.loads(schema)), parts) for k, (schema, parts) in enumerate(same.items())}
    return groups["0"] if len(groups) == 1 else union_relations(groups, source_column=None)


def schema_log(spark: SparkSession, path: str) -> list[tuple[int, T.StructType]]:
    """(version, schema) of the versions that changed the table's schema."""
    out: list[tuple[int, T.StructType]] = []
    for number in versions(spark, path):
        schema = read(spark, path, number).schema
        if not out or out[-1][1] != schema:
            out.append((number, schema))
    return out
