"""Writing runs, tables, views and dead letters."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

ROWS_PER_FILE = 10_000


def write_json_arrays(df: DataFrame, path: str, rows_per_file: int = ROWS_PER_FILE) -> None:
    """Rows as files that hold one JSON array each, of at most ``rows_per_file`` rows."""
    write_arrays(df.select(F.to_json(F.struct(*df.columns)).alias("value")), path, rows_per_file)


def write_arrays(items: DataFrame, path: str, rows_per_file: int = ROWS_PER_FILE) -> None:
    """JSON texts in the column ``value`` as files that hold one array each."""

    def arrays(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[str] = []
        for batch in batches:
            held.extend(batch.column(0).to_pylist())
            while len(held) >= rows_per_file:
                yield pa.RecordBatch.from_pydict({"value": ["[" + ",".join(held[:rows_per_file]) + "]"]})
                del held[:rows_per_file]
        if held:
            yield pa.RecordBatch.from_pydict({"value": ["[" + ",".join(held) + "]"]})

    # One line per array and one line per file.
    items.mapInArrow(arrays, "value string").write.option("maxRecordsPerFile", 1).text(path)


def write_json_lines(df: DataFrame, path: str) -> None:
    """Rows as files with one JSON object a line."""
    df.write.json(path)


def write_run_partition(df: DataFrame, path: str, run_date, run_id: str) -> None:
    """A run's rows below its date and id; writing the same run again replaces it.

    Where the date is a Column, rows of a date are brought together so that a date does not
    get a file from every task; dates with many rows are split again.
    """
    dated = df.withColumns({"run_date": run_date if isinstance(run_date, Column) else F.lit(run_date), "run_id": F.lit(run_id)})
    if isinstance(run_date, Column):
        dated = dated.hint("rebalance", "run_date")
    (
        dated.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("run_date", "run_id")
        .parquet(path)
    )


def append_evolving(df: DataFrame, path: str) -> None:
    """Append rows; columns the table lacks are added, read with :func:`read_evolving`."""
    df.write.mode("append").parquet(path)


def read_evolving(spark: SparkSession, path: str) -> DataFrame:
    """All rows of a table whose files have different columns."""
    return spark.read.option("mergeSchema", "true").parquet(path)


def write_table(df: DataFrame, name: str, path: str | None = None) -> None:
    """Rebuild a table. With a path its files lie there instead of in the warehouse folder."""
    writer = df.write.mode("overwrite").format("parquet")
    (writer.option("path", path) if path else writer).saveAsTable(name)


def create_view(df: DataFrame, name: str) -> None:
    """A lazy view, replaced if it exists."""
    df.createOrReplaceTempView(name)


def write_by_outcome(df: DataFrame, good: Column, path: str, partition_by: tuple[str, ...] = ()) -> None:
    """Good rows below ``outcome=good``, all others below ``outcome=dead_letter``.

    One pass over the rows, so an enrichment in front runs once. NULL counts as not good. Partitions
    that are written again are replaced, so with the run among ``partition_by`` a run can be repeated.
    """
    outcome = F.when(F.coalesce(good, F.lit(False)), "good").otherwise("dead_letter")
    df.withColumn("outcome", outcome).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(
        "outcome", *partition_by
    ).parquet(path)


def append_run_log(row: DataFrame, path: str) -> None:
    """Append a run's row to the run log."""
    row.coalesce(1).write.mode("append").json(path)
