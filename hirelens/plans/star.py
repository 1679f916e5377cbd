"""Star schema over the typed posting view.

Functions that need skills take ``skill_rows``: posting columns with one ``skill`` per row, as
:func:`skill_rows` makes them from the list column.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import date_key, is_active, job_ref, surrogate_key
from ..functions.text import clean_skill
from ..operators.reshape import explode_items
from ..schemas import STAGING

COMPANY = ("company_name",)
LOCATION = ("city", "state", "country")
ROLE = ("job_title", "seniority_level", "tech_stack_category")
JOB_ATTRIBUTES = (
    "job_title", "employment_type", "experience_years", "degree_requirement", "work_mode", "posted_at", "expires_at",
)


def has_id() -> Column:
    return F.col("source_job_id").isNotNull() | F.col("job_id").isNotNull()


def stg_job_postings(source: DataFrame) -> DataFrame:
    """The loaded postings with fixed names and types; rows without any id are left out.

    Text that does not fit its type becomes NULL.
    """
    known = {c.lower() for c in source.columns}

    def typed(name: str, kind: str) -> Column:
        c = F.col(name) if name.lower() in known else F.lit(None).cast("string")
        return c.try_cast(kind)

    columns = {out: typed(name, kind).alias(out) for out, (name, kind) in STAGING.items()}
    rows = source.select(*columns.values(), *(["skills"] if "skills" in known else []))
    return rows.where(has_id())


def skill_rows(postings: DataFrame, array: str = "skills") -> DataFrame:
    """One row per posting and listed skill."""
    return explode_items(postings, array, "skill")


def dim_company(stg: DataFrame) -> DataFrame:
    return (
        stg.where(F.col("company_name").isNotNull())
        .groupBy("company_name")
        .agg(
            F.max("company_sector").alias("company_sector"),
            F.min("enriched_at").alias("first_seen_date"),
            F.max("enriched_at").alias("last_seen_date"),
            F.countDistinct(job_ref()).alias("total_jobs_posted"),
        )
        .select(
            surrogate_key(*COMPANY).alias("company_key"),
            "company_name",
            "company_sector",
            "first_seen_date",
            "last_seen_date",
            "total_jobs_posted",
        )
    )


def dim_locations(stg: DataFrame) -> DataFrame:
    places = stg.where(F.col("city").isNotNull()).select(*LOCATION).distinct()
    return places.select(surrogate_key(*LOCATION).alias("location_key"), *LOCATION)


def dim_role(stg: DataFrame) -> DataFrame:
    roles = stg.where(F.col("job_title").isNotNull()).groupBy(*ROLE).agg(F.min("enriched_at").alias("first_seen_at"))
    return roles.select(
        surrogate_key(*ROLE).alias("role_id"),
        F.col("job_title").alias("role_name"),
        "seniority_level",
        "tech_stack_category",
        "first_seen_at",
    )


def _named_skills(rows: DataFrame) -> DataFrame:
    return rows.withColumn("skill_name", clean_skill("skill")).where(F.col("skill_name") != "")


def dim_skill(rows: DataFrame) -> DataFrame:
    per_skill = (
        _named_skills(rows)
        .groupBy("skill_name")
        .agg(F.min("enriched_at").alias("first_seen_date"), F.countDistinct(job_ref()).alias("total_demand_count"))
    )
    return per_skill.select(
        surrogate_key("skill_name").alias("skill_id"), "skill_name", "first_seen_date", "total_demand_count"
    )


def dim_job(stg: DataFrame, as_of: str) -> DataFrame:
    """One row per job and version of its attributes, with a flag for jobs open on ``as_of``."""
    versions = (
        stg.where(has_id())
        .groupBy("source_job_id", "job_id", *JOB_ATTRIBUTES)
        .agg(F.min("enriched_at").alias("created_at"))
    )
    return versions.select(
        surrogate_key("source_job_id", "job_id").alias("job_key"),
        job_ref().alias("source_job_id"),
        *JOB_ATTRIBUTES,
        is_active("posted_at", "expires_at", as_of).alias("is_active"),
        "created_at",
    )


def dim_date(stg: DataFrame) -> DataFrame:
    day = F.col("date_day")
    days = stg.where(F.col("enriched_at").isNotNull()).select(F.to_date("enriched_at").alias("date_day")).distinct()
    return days.select(
        date_key(day).alias("date_key"),
        "date_day",
        F.year(day).alias("year"),
        F.month(day).alias("month"),
        F.dayofmonth(day).alias("day"),
        F.dayofweek(day).alias("day_of_week"),
    )


def fact_job_postings(stg: DataFrame) -> DataFrame:
    """One row per posting with its keys and measures, and its skills where the view has them."""
    skills = [F.col("skills").alias("skills_array")] if "skills" in stg.columns else []
    return stg.where(has_id()).select(
        job_ref().alias("job_id"),
        surrogate_key(*COMPANY).alias("company_key"),
        surrogate_key(*LOCATION).alias("location_key"),
        surrogate_key(*ROLE).alias("role_key"),
        date_key("enriched_at").alias("date_key"),
        "seniority_level",
        "work_mode",
        "experience_years",
        "salary_min_lpa",
        "salary_max_lpa",
        *skills,
        F.col("enriched_at").alias("created_at"),
        "pipeline_run_id",
        "source_api",
        "enrichment_confidence",
    )


def fact_job_skills(rows: DataFrame, jobs: DataFrame, dedupe: bool = False) -> DataFrame:
    """One row per job, skill and version of the job, with the job's flag.

    Repeats of a skill within a job stay. With ``dedupe`` there is one row per job and skill,
    active if any version of the job is, so that the key is unique.
    """
    named = _named_skills(rows).select(job_ref().alias("job_id"), "skill_name")
    versions = jobs.select("source_job_id", "is_active")
    if dedupe:
        named = named.distinct()
        versions = versions.groupBy("source_job_id").agg(F.bool_or("is_active").alias("is_active"))
    joined = named.join(versions, F.col("job_id") == F.col("source_job_id"))
    return joined.select(
        surrogate_key("job_id", "skill_name").alias("job_skill_key"),
        "job_id",
        surrogate_key("skill_name").alias("skill_id"),
        "is_active",
    )
