"""Second layer: postings with parsed fields and checked model output."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import blank_to_null, first_filled, first_nonzero
from ..functions.semistructured import with_education, with_experience, with_validated
from ..functions.text import enrichment_prompt, extract_city, normalize_skills, salary_hint_text, strip, with_salary
from ..operators.reshape import anti_join_seen, deduplicate
from .bronze import stored_id

# Fixed values.
MISSING_DESCRIPTION = "missing_job_description"
ENRICHMENT_FAILED = "gemini_enrichment_failed"
CONFIDENCE = "high"
DEFAULT_API = "JSEARCH_PRIMARY"

# Silver column -> names it is read from, the first filled one winning.
FALLBACKS = {
    "source_job_id": ("source_job_id", "job_id"),
    "company_name": ("company_name", "employer_name"),
    "company_sector": ("company_sector", "employer_company_type"),
    "job_title": ("job_title",),
    "city": ("city", "job_city"),
    "state": ("state", "job_state"),
    "country": ("country", "job_country"),
    "employment_type": ("employment_type", "job_employment_type"),
    "posted_at": ("posted_at", "job_posted_at_datetime_utc"),
    "expires_at": ("expires_at", "job_offer_expiration_datetime_utc"),
    "salary_currency": ("salary_currency", "job_salary_currency"),
    "salary_period": ("salary_period", "job_salary_period"),
}
NUMBER_FALLBACKS = {
    "salary_min_raw": ("salary_min_raw", "job_min_salary"),
    "salary_max_raw": ("salary_max_raw", "job_max_salary"),
}
DESCRIPTION = ("job_description_raw", "job_description")


def _present(df: DataFrame, names) -> list[str]:
    return [n for n in names if n in df.columns]


def _text(df: DataFrame, names) -> Column:
    found = _present(df, names)
    return first_filled(*found) if found else F.lit(None).cast("string")


def _number(df: DataFrame, names) -> Column:
    found = _present(df, names)
    return first_nonzero(*found) if found else F.lit(None).cast("double")


def _base_columns(df: DataFrame) -> dict[str, Column]:
    columns = {out: _text(df, names) for out, names in FALLBACKS.items()}
    if "job_title" in df.columns:
        # The title has one name only, so a blank one stays blank.
        columns["job_title"] = F.col("job_title")
    for out, names in NUMBER_FALLBACKS.items():
        columns[out] = _number(df, names)
    api = F.col("source_api") if "source_api" in df.columns else F.lit(None).cast("string")
    columns["source_api"] = F.coalesce(api, F.lit(DEFAULT_API))
    return columns


def fallback_columns(df: DataFrame) -> DataFrame:
    """Silver base columns from their newer or older names; '' and 0 count as missing."""
    return df.select(*[c.alias(name) for name, c in _base_columns(df).items()])


def pending(bronze: DataFrame, silver: DataFrame, dedupe_by: list[Column] | None = None) -> DataFrame:
    """Stored postings that are not enriched yet; those without an id always are pending.

    ``dedupe_by`` gives an order by which only the first posting of an id is kept.
    """
    rows = anti_join_seen(bronze, silver, stored_id(bronze), stored_id(silver), keep_null_ids=True)
    if dedupe_by is None:
        return rows
    # Postings without an id are different postings, so each gets a key of its own.
    own = F.when(stored_id(bronze).isNull(), F.monotonically_increasing_id())
    return deduplicate(rows.withColumn("__own", own), [stored_id(bronze), F.col("__own")], dedupe_by).drop("__own")


def with_description(df: DataFrame) -> DataFrame:
    """Add ``description`` and, where there is none, the ``failure_reason``."""
    text = _text(df, DESCRIPTION)
    reason = F.when(text.isNull(), MISSING_DESCRIPTION)
    return df.withColumn("description", text).withColumn("failure_reason", reason)


def failed_rows(df: DataFrame, pipeline_run_id: str, failed_at: str) -> DataFrame:
    """Rows with a reason to fail, in their first-layer form with an audit of the failure."""
    audit = F.struct(
        F.col("failure_reason"), F.lit(pipeline_run_id).alias("pipeline_run_id"), F.lit(failed_at).alias("failed_at")
    )
    failed = df.where(F.col("failure_reason").isNotNull()).withColumn("silver_medallion_audit", audit)
    return failed.drop("description", "failure_reason")


def with_salary_hint(df: DataFrame) -> DataFrame:
    """Salary found in the description: put in front of it and in place of the raw salary."""
    df = with_salary(df, "description", "__low", "__high")
    low, high = F.col("__low"), F.col("__high")
    found = (low != 0) | (high != 0)
    numbers = {
        out: F.when(found, pay).otherwise(_number(df, NUMBER_FALLBACKS[out]))
        for out, pay in (("salary_min_raw", low), ("salary_max_raw", high))
    }
    hinted = salary_hint_text(F.col("description"), low, high)
    return df.withColumns({**numbers, "description": hinted}).drop("__low", "__high")


def work_mode_merge(override, is_remote) -> Column:
    """The model's work mode, else the delivered flag, else 'Unknown'."""
    flag = F.col(is_remote) if isinstance(is_remote, str) else is_remote
    return F.coalesce(blank_to_null(override), F.when(flag, "Remote").when(~flag, "Onsite"), F.lit("Unknown"))


def enrich(
    df: DataFrame,
    respond: Callable[[list[str]], list[str | Exception | None]],
    prompt: Column | None = None,
    batch_rows: int = 10,
    response: str = "response",
) -> DataFrame:
    """Add the ``response`` a user's function gives to each row's prompt, and ``<response>_error``.

    The function gets up to ``batch_rows`` prompts at a time and returns as many responses; for a
    prompt that failed it returns the exception. If it raises, or returns another number, all
    prompts of the batch failed; none is sent again. Blank descriptions are not sent. Only
    prompts and answers pass through Python.
    """
    prompt = enrichment_prompt("description") if prompt is None else prompt
    asked = F.when(strip("description") != "", prompt)

    def answer(prompts: list[str]) -> list[str | Exception | None]:
        try:
            answers = list(respond(prompts))
        except Exception as error:
            return [error] * len(prompts)
        if len(answers) != len(prompts):
            return [ValueError(f"{len(answers)} responses to {len(prompts)} prompts")] * len(prompts)
        return answers

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for sent in batches:
            prompts = sent.tolist()
            asked_rows = [k for k, p in enumerate(prompts) if p is not None]
            responses: list[str | None] = [None] * len(prompts)
            errors: list[str | None] = [None] * len(prompts)
            for start in range(0, len(asked_rows), batch_rows):
                part = asked_rows[start : start + batch_rows]
                for k, got in zip(part, answer([prompts[k] for k in part])):
                    if isinstance(got, Exception):
                        errors[k] = str(got) or type(got).__name__
                    else:
                        responses[k] = got
            yield pd.DataFrame({"response": responses, "error": errors}, dtype=object)

    # A call costs money and need not repeat itself, so the optimizer may neither copy nor move it.
    ask = F.pandas_udf(run, "response string, error string").asNondeterministic()
    told = df.withColumn("__told", ask(asked))
    answers = {response: F.col("__told.response"), f"{response}_error": F.col("__told.error")}
    return told.withColumns(answers).drop("__told")


def dead_letters(df: DataFrame, response: str = "response", checked: str = "enriched") -> DataFrame:
    """Responses that could not be read, or the error of calls that failed, with the posting they belong to."""
    error = [F.col(f"{response}_error")] if f"{response}_error" in df.columns else []
    bad = df.where(F.col(checked)["status"].isin("invalid", "failed"))
    return bad.select(stored_id(df).alias("job_id"), F.coalesce(F.col(response), *error).alias("raw_response"))


def with_enrichment_failure(df: DataFrame, checked: str = "enriched") -> DataFrame:
    """``failure_reason`` also where the model's call failed or its response could not be read."""
    bad = F.col(checked)["status"].isin("invalid", "failed")
    return df.withColumn("failure_reason", F.coalesce("failure_reason", F.when(bad, ENRICHMENT_FAILED)))


def build_silver(
    df: DataFrame, pipeline_run_id: str, enriched_at, model: str, response: str = "response", defaults: bool = False
) -> DataFrame:
    """Silver rows from pending postings with a ``description`` and a model's ``response``.

    ``enrichment_status`` tells rows with an unreadable or missing response from good ones;
    they are kept with the fields left empty. With ``defaults`` a missing seniority and stack
    become 'Unknown' and 'Other'.
    """
    rows = with_experience(df, "experience_obj", "experience_years")
    rows = with_education(rows, "education_obj", "degree_requirement")
    rows = with_validated(rows, response, "enriched", f"{response}_error" if f"{response}_error" in df.columns else None)
    ai = F.col("enriched")
    location = [F.col("job_location")] if "job_location" in df.columns else []
    base = _base_columns(df)
    base["city"] = F.coalesce(base["city"], extract_city(F.concat_ws(" ", *location, "description")))
    seniority, stack = ai["seniority_level"], ai["tech_stack_category"]
    if defaults:
        seniority, stack = F.coalesce(seniority, F.lit("Unknown")), F.coalesce(stack, F.lit("Other"))
    audit = F.struct(
        (enriched_at if isinstance(enriched_at, Column) else F.lit(enriched_at)).alias("enriched_at"),
        F.lit(pipeline_run_id).alias("pipeline_run_id"),
        F.lit(model).alias("gemini_model_used"),
        F.lit(CONFIDENCE).alias("enrichment_confidence"),
    )
    return rows.select(
        *[c.alias(name) for name, c in base.items()],
        "experience_years",
        "degree_requirement",
        normalize_skills(ai["skills"]).alias("skills"),
        seniority.alias("seniority_level"),
        stack.alias("tech_stack_category"),
        ai["salary_min_lpa"].alias("salary_min_lpa"),
        ai["salary_max_lpa"].alias("salary_max_lpa"),
        work_mode_merge(ai["work_mode_override"], "is_remote_flag").alias("work_mode"),
        audit.alias("silver_medallion_audit"),
        ai["status"].alias("enrichment_status"),
    )
