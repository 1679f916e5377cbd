"""Shared helpers: tables, result columns computed from texts in Arrow batches, written cuts of the lineage."""

from __future__ import annotations

import atexit
import gc
import os
import shutil
import tempfile
from collections.abc import Callable, Iterable, Iterator, Sequence
from contextlib import contextmanager
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ..session import scratch_path, tune

CHUNK_BYTES = 1 << 20
# Rows that cross to Python at once; texts may be long, so fewer than Spark's default.
RECORDS_PER_BATCH = "1000"

_shipped: set[str] = set()

Work = Callable[[pa.Array], Sequence[pa.Array]]


def prepare(spark: SparkSession) -> SparkSession:
    """The session with the library's settings, where it has not set them itself."""
    tune(spark)
    if "spark.sql.execution.arrow.maxRecordsPerBatch" not in spark.conf.getAll:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", RECORDS_PER_BATCH)
    _ship(spark)
    return spark


def _ship(spark: SparkSession) -> None:
    """Send the package to the Python workers, once for a context, unless their PYTHONPATH names its folder."""
    package = Path(__file__).resolve().parent.parent
    named = [os.path.abspath(p) for p in os.environ.get("PYTHONPATH", "").split(os.pathsep) if p]
    context = spark.sparkContext
    if str(package.parent) in named or context.applicationId in _shipped:
        return
    _shipped.add(context.applicationId)
    folder = tempfile.mkdtemp(prefix="hirelens-code-")  # executors fetch from it as long as the driver lives
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    context.addPyFile(shutil.make_archive(f"{folder}/{package.name}", "zip", package.parent, package.name))


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read again: a cut of the lineage that survives lost executors."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def schema_of(fields: str | T.StructType) -> T.StructType:
    return T.StructType.fromDDL(fields) if isinstance(fields, str) else fields


def texts_of(array: pa.Array) -> pa.Array:
    """A text column as plain strings without nulls: null counts as the empty text."""
    if isinstance(array, pa.ChunkedArray):
        array = array.combine_chunks()
    if not pa.types.is_string(array.type):
        array = array.cast(pa.string())
    return pc.fill_null(array, "")


def slices(batch: pa.RecordBatch, column: str, limit: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """Pieces of a batch with about ``limit`` bytes of text each, one row at least."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    ends, start = np.cumsum(sizes, dtype=np.int64), 0
    while start < len(sizes):
        done = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, done + limit, "right")))
        yield batch.slice(start, stop - start)
        start = stop


class Remembered:
    """Results by text, up to about ``limit`` bytes in all.

    Two tables: what is used goes into the young one, and when that holds half the limit it becomes the old one
    and the old one goes. What comes up again so stays; forgetting changes no result.
    """

    # About what Python needs for a text, its result and their places in a table, beside the letters and items.
    EACH = 250

    def __init__(self, limit: int = 64 << 20):
        self.half = limit // 2
        self.clear()

    def clear(self) -> None:
        self.young: dict = {}
        self.old: dict = {}
        self.size = 0

    def missing(self, keys: Iterable[str]) -> list[str]:
        """The keys without a result. All others are in ``young`` until the next call."""
        if self.size > self.half:
            self.old, self.young, self.size = self.young, {}, 0
        new = [k for k in keys if k not in self.young]
        if not self.old:
            return new
        still = []
        for k in new:
            value = self.old.pop(k, None)
            if value is None:
                still.append(k)
            else:
                self.put(k, value)
        return still

    def put(self, key: str, value, size: int = 0) -> None:
        self.young[key] = value
        self.size += self.EACH + 2 * len(key) + size


def map_texts(
    df: DataFrame, column: str, fields: str, make: Callable[[], Work], keep: Sequence[str] | None = None
) -> DataFrame:
    """``df`` with the columns ``fields`` computed from the texts in ``column``.

    ``make`` is called once in a task and gives the function from an array of texts (never null) to
    one array per field; if it has an attribute ``close``, that is called at the task's end. Columns of ``df`` stay (those in ``keep``, if given); one that has the name
    of a result, in any case of letters, is replaced by it.
    """
    prepare(df.sparkSession)
    results = schema_of(fields)
    taken = {f.name.lower() for f in results}
    wanted = None if keep is None else {c.lower() for c in keep}
    kept = [f for f in df.schema if f.name.lower() not in taken and (wanted is None or f.name.lower() in wanted)]
    names = [f.name for f in kept]
    text = next(f.name for f in df.schema if f.name.lower() == column.lower())
    df = df.select(*[quoted(n) for n in dict.fromkeys([*names, text])])
    place = df.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = None
        try:
            for batch in batches:
                for part in slices(batch, text):
                    work = work or make()
                    made = work(texts_of(part.column(place)))
                    yield pa.RecordBatch.from_arrays(
                        [part.column(n) for n in names] + list(made), names + [f.name for f in results]
                    )
        finally:
            getattr(work, "close", int)()

    return df.mapInArrow(run, T.StructType([*kept, *results]))


@contextmanager
def uncollected():
    """Without passes over large tables of remembered texts in search of cycles, which they cannot have."""
    on = gc.isenabled()
    gc.disable()
    try:
        yield
    finally:
        if on:
            gc.enable()


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"
