"""Fixed schemas of the pipeline's records."""

from __future__ import annotations

from pyspark.sql import types as T


def _fields(*pairs):
    return T.StructType([T.StructField(n, t, True) for n, t in pairs])


S, D, B, L = T.StringType(), T.DoubleType(), T.BooleanType(), T.LongType()

# A posting as delivered by the posting service.
RAW_POSTING = _fields(
    ("job_id", S),
    ("employer_name", S),
    ("employer_company_type", S),
    ("job_title", S),
    ("job_description", S),
    ("job_city", S),
    ("job_state", S),
    ("job_country", S),
    ("job_is_remote", B),
    ("job_employment_type", S),
    ("job_posted_at_datetime_utc", S),
    ("job_offer_expiration_datetime_utc", S),
    ("job_min_salary", D),
    ("job_max_salary", D),
    ("job_salary_currency", S),
    ("job_salary_period", S),
    ("job_required_experience", _fields(("required_experience_in_months", D), ("experience_mentioned", B))),
    (
        "job_required_education",
        _fields(("postgraduate_degree", B), ("bachelors_degree", B), ("professional_certification", B)),
    ),
)

# Canonical name -> name in the delivered posting.
RAW_NAMES = {
    "source_job_id": "job_id",
    "company_name": "employer_name",
    "company_sector": "employer_company_type",
    "job_title": "job_title",
    "job_description_raw": "job_description",
    "city": "job_city",
    "state": "job_state",
    "country": "job_country",
    "is_remote_flag": "job_is_remote",
    "employment_type": "job_employment_type",
    "posted_at": "job_posted_at_datetime_utc",
    "expires_at": "job_offer_expiration_datetime_utc",
    "salary_min_raw": "job_min_salary",
    "salary_max_raw": "job_max_salary",
    "salary_currency": "job_salary_currency",
    "salary_period": "job_salary_period",
}
# Nested parts kept as JSON text.
RAW_JSON_NAMES = {
    "experience_obj": "job_required_experience",
    "education_obj": "job_required_education",
}

BRONZE = _fields(
    *[(n, {"is_remote_flag": B, "salary_min_raw": D, "salary_max_raw": D}.get(n, S)) for n in RAW_NAMES],
    *[(n, S) for n in RAW_JSON_NAMES],
    ("source_api", S),
    ("medallion_audit_created_at", S),
    ("pipeline_run_id", S),
    ("source_system", S),
    ("ingestion_date", S),
    ("search_query", S),
)

ENRICHMENT = _fields(
    ("skills", T.ArrayType(S)),
    ("seniority_level", S),
    ("tech_stack_category", S),
    ("work_mode_override", S),
    ("salary_min_lpa", D),
    ("salary_max_lpa", D),
    ("experience_years_min", D),
    ("experience_years_max", D),
)

AUDIT = _fields(
    ("enriched_at", S),
    ("pipeline_run_id", S),
    ("gemini_model_used", S),
    ("enrichment_confidence", S),
    ("failure_reason", S),
    ("failed_at", S),
)

SILVER = _fields(
    ("source_job_id", S),
    ("company_name", S),
    ("company_sector", S),
    ("job_title", S),
    ("city", S),
    ("state", S),
    ("country", S),
    ("employment_type", S),
    ("posted_at", S),
    ("expires_at", S),
    ("salary_min_raw", D),
    ("salary_max_raw", D),
    ("salary_currency", S),
    ("salary_period", S),
    ("source_api", S),
    ("experience_years", D),
    ("degree_requirement", S),
    ("skills", T.ArrayType(S)),
    ("seniority_level", S),
    ("tech_stack_category", S),
    ("salary_min_lpa", D),
    ("salary_max_lpa", D),
    ("work_mode", S),
    ("silver_medallion_audit", AUDIT),
)

# Column -> (source column, type) of the typed staging view; ``skills`` is passed through.
STAGING = {
    "job_id": ("job_id", "string"),
    "source_job_id": ("source_job_id", "string"),
    "company_name": ("company_name", "string"),
    "company_sector": ("company_sector", "string"),
    "job_title": ("job_title", "string"),
    "city": ("city", "string"),
    "state": ("state", "string"),
    "country": ("country", "string"),
    "employment_type": ("employment_type", "string"),
    "posted_at": ("posted_at", "string"),
    "expires_at": ("expires_at", "string"),
    "work_mode": ("work_mode", "string"),
    "degree_requirement": ("degree_requirement", "string"),
    "experience_years": ("experience_years", "double"),
    "tech_stack_category": ("tech_stack_category", "string"),
    "seniority_level": ("seniority_level", "string"),
    "salary_min_lpa": ("salary_min_lpa", "double"),
    "salary_max_lpa": ("salary_max_lpa", "double"),
    "enriched_at": ("audit_enriched_at", "timestamp_ntz"),
    "pipeline_run_id": ("audit_pipeline_run_id", "string"),
    "source_api": ("source_api", "string"),
    "enrichment_confidence": ("audit_enrichment_confidence", "string"),
}

RUN_LOG = _fields(
    ("run_id", S),
    ("run_date", S),
    ("dag_trigger_time", S),
    ("dry_run_mode", B),
    ("jobs_fetched_total", L),
    ("jobs_after_dedup", L),
    ("api_requests_used", L),
    ("jobs_enriched_success", L),
    ("jobs_enriched_failed", L),
    ("gemini_calls_made", L),
    ("dead_letter_count", L),
    ("jobs_written_to_bq", L),
    ("run_duration_seconds", D),
    ("status", S),
    ("failed_step", S),
)
