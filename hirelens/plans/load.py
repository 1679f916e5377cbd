"""Third step: good enriched rows, flat, into the warehouse table; and the run log."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import blank_to_null
from ..operators.reshape import anti_join_seen, deduplicate, flatten_struct, null_empty_complex
from ..schemas import RUN_LOG
from .bronze import stored_id


def quality_filter(silver: DataFrame, audit: str = "silver_medallion_audit") -> DataFrame:
    """Rows whose audit has a confidence and no reason of failure."""
    fields = silver.schema[audit].dataType.names
    good = blank_to_null(F.col(audit)["enrichment_confidence"]).isNotNull()
    if "failure_reason" in fields:
        good = good & blank_to_null(F.col(audit)["failure_reason"]).isNull()
    return silver.where(good)


def load_rows(silver: DataFrame, loaded: DataFrame | None = None) -> DataFrame:
    """Good rows with the audit as ``audit_*`` columns and empty lists as NULL, each once.

    Rows whose id is in ``loaded`` already are left out, so that a second run adds nothing. A row
    without an id is known by a hash of all its columns, where ``loaded`` has these. Of several
    rows with one id the one enriched last stays.
    """
    flat = null_empty_complex(flatten_struct(quality_filter(silver), "silver_medallion_audit", "audit_"))

    def key(df: DataFrame) -> Column:
        known = F.concat(F.lit("id:"), blank_to_null(stored_id(df)))
        if not set(flat.columns) <= set(df.columns):
            return known
        return F.coalesce(known, F.concat(F.lit("row:"), F.md5(F.to_json(F.struct(*flat.columns)))))

    last = [F.desc(c) for c in flat.columns if c == "audit_enriched_at"]
    once = deduplicate(flat, [key(flat)], [*last, F.to_json(F.struct(*flat.columns))])
    return once if loaded is None else anti_join_seen(once, loaded, key(once), key(loaded), keep_null_ids=False)


def run_metrics(
    counts: DataFrame,
    run_id,
    run_date: str,
    dag_trigger_time: str,
    dry_run: bool,
    ended_at: str | None,
    failed_step: str | None = None,
) -> DataFrame:
    """One run-log row from per-row flags.

    ``counts`` has one row per posting of the run with the 0/1 columns ``fetched``, ``new``,
    ``enriched``, ``failed``, ``dead_letter`` and ``written``. The status is
    RUNNING without an end, FAILED where a step is named that failed, else PARTIAL if any posting failed.
    """
    totals = counts.agg(
        *[
            F.coalesce(F.sum(c), F.lit(0)).cast("bigint").alias(c)
            for c in ("fetched", "new", "enriched", "failed", "dead_letter", "written")
        ]
    )
    status = F.when(F.col("failed") == 0, "SUCCESS").otherwise("PARTIAL")
    if failed_step or ended_at is None:
        status = F.lit("FAILED" if failed_step else "RUNNING")
    started, ended = (F.lit(t).cast("timestamp") for t in (dag_trigger_time, ended_at))
    values: dict[str, Column] = {
        "run_id": F.lit(run_id),
        "run_date": F.lit(run_date),
        "dag_trigger_time": F.lit(dag_trigger_time),
        "dry_run_mode": F.lit(dry_run),
        "jobs_fetched_total": F.col("fetched"),
        "jobs_after_dedup": F.col("new"),
        # The number of new postings, as the run log has always counted requests.
        "api_requests_used": F.col("new"),
        "jobs_enriched_success": F.col("enriched"),
        "jobs_enriched_failed": F.col("failed"),
        "gemini_calls_made": F.col("enriched") + F.col("failed"),
        "dead_letter_count": F.col("dead_letter"),
        "jobs_written_to_bq": F.col("written"),
        "run_duration_seconds": (F.unix_micros(ended) - F.unix_micros(started)) / 1e6,
        "status": status,
        "failed_step": F.lit(failed_step),
    }
    return totals.select(*[values[f.name].cast(f.dataType).alias(f.name) for f in RUN_LOG])
