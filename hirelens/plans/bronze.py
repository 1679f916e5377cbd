"""First layer: delivered postings under canonical names, each kept once."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import first_filled
from ..operators.reshape import anti_join_seen, deduplicate
from ..schemas import RAW_JSON_NAMES, RAW_NAMES


def stored_id(df: DataFrame) -> Column:
    """Id of a stored posting, under its present or its older name."""
    return first_filled(*[c for c in ("source_job_id", "job_id") if c in df.columns])


def normalize_postings(
    raw: DataFrame, source_api, pipeline_run_id, ingestion_date, search_query, created_at, source_system="jsearch_api"
) -> DataFrame:
    """Delivered postings under the 24 canonical names, the run's values added.

    The run's values are plain values or Columns of ``raw``.
    """
    run = {
        "source_api": source_api,
        "medallion_audit_created_at": created_at,
        "pipeline_run_id": pipeline_run_id,
        "source_system": source_system,
        "ingestion_date": ingestion_date,
        "search_query": search_query,
    }

    def json_text(name: str) -> Column:
        # A struct of NULLs is the empty object of the delivered text.
        text = F.to_json(F.col(name))
        return F.when(text != "{}", text)

    return raw.select(
        *[F.col(name).alias(out) for out, name in RAW_NAMES.items()],
        *[json_text(name).alias(out) for out, name in RAW_JSON_NAMES.items()],
        *[(v if isinstance(v, Column) else F.lit(v)).alias(name) for name, v in run.items()],
    )


def new_arrivals(arrivals: DataFrame, stored: DataFrame, arrival_order: list[Column], id_column: str) -> DataFrame:
    """Arrivals with an id that is not stored yet, the first of each id."""
    unseen = anti_join_seen(arrivals, stored, F.col(id_column), stored_id(stored), keep_null_ids=False)
    return deduplicate(unseen, [id_column], arrival_order)


def ingest_bronze(arrivals: DataFrame, stored: DataFrame, arrival_order: list[Column], **run) -> DataFrame:
    """New arrivals in canonical form. ``arrival_order`` says which of two copies came first."""
    return normalize_postings(new_arrivals(arrivals, stored, arrival_order, "job_id"), **run)
