"""Marts and saved views over the star schema, and the dashboard's last steps over those.

A job has one row per version in ``dim_job`` and may have several in the posting fact. The
marts never form all pairs of the two: counts of distinct jobs need only that an active
version exists, and sums are weighted by the number of active versions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalars import days_between, safe_divide
from ..functions.text import clean_skill
from ..operators.reshape import crosstab_sum, deduplicate, top_k
from ..session import written

TOP_COMPANIES, TOP_SKILLS, TOP_VIEW_SKILLS = 50, 20, 50
QUOTES = "\"'"


def active_jobs(jobs: DataFrame) -> DataFrame:
    """Job ids with an active version, and the number of those."""
    active = jobs.where("is_active").where(F.col("source_job_id").isNotNull())
    return active.groupBy(F.col("source_job_id").alias("active_id")).agg(F.count(F.lit(1)).alias("versions"))


def of_active_jobs(rows: DataFrame, jobs: DataFrame) -> DataFrame:
    """Rows whose ``job_id`` has an active version."""
    active = jobs.where("is_active").select(F.col("source_job_id").alias("active_id"))
    return rows.join(active, F.col("job_id") == F.col("active_id"), "left_semi")


# --- marts --------------------------------------------------------------------------------


def mart_company_hiring(
    facts: DataFrame, companies: DataFrame, jobs: DataFrame, fact_skills: DataFrame, top: int = TOP_COMPANIES
) -> DataFrame:
    """The companies with most active postings. ``fact_skills`` has company_key and skill, over
    all postings."""
    weight, years = F.col("versions"), F.col("experience_years")
    per_company = (
        facts.join(active_jobs(jobs), F.col("job_id") == F.col("active_id"))
        .groupBy("company_key")
        .agg(
            F.countDistinct("job_id").alias("total_postings"),
            safe_divide(F.sum(years * weight), F.sum(F.when(years.isNotNull(), weight))).alias("avg_experience_years"),
            (F.sum(F.when(F.col("work_mode") == "Remote", weight).otherwise(0)) / F.sum(weight)).alias("remote_pct"),
        )
    )
    named = per_company.join(companies.select("company_key", "company_name", "company_sector"), "company_key")
    # At most ``top`` rows, written since they both choose the skills to count and take the result.
    leaders = written(top_k(named, top, F.desc("total_postings"), F.asc("company_name")), "leaders")
    # The ranking of skills is only needed for the leaders, of which there are at most ``top``.
    keys = leaders.select("company_key")
    counted = (
        fact_skills.select("company_key", clean_skill("skill", QUOTES, trim=False).alias("top_skill"))
        .where(F.col("top_skill") != "")
        .join(keys, "company_key", "left_semi")
        .groupBy("company_key", "top_skill")
        .agg(F.count(F.lit(1)).alias("skill_count"))
    )
    favourite = deduplicate(counted, ["company_key"], [F.desc("skill_count"), F.asc("top_skill")])
    return leaders.join(favourite, "company_key", "left").select(
        "company_name", "company_sector", "total_postings", "top_skill", "avg_experience_years", "remote_pct"
    )


def mart_remote_split(facts: DataFrame, roles: DataFrame, jobs: DataFrame) -> DataFrame:
    """Active jobs per work mode and stack, with their share of the stack."""
    stacks = roles.where(F.col("tech_stack_category").isNotNull()).select("role_id", "tech_stack_category")
    counted = (
        of_active_jobs(facts.where(F.col("work_mode").isNotNull()), jobs)
        .join(stacks, F.col("role_key") == F.col("role_id"))
        .groupBy("work_mode", "tech_stack_category")
        .agg(F.countDistinct("job_id").alias("job_count"))
    )
    total = F.sum("job_count").over(Window.partitionBy("tech_stack_category"))
    return counted.withColumn("pct_of_total", safe_divide(F.col("job_count").cast("double"), total)).orderBy(
        "tech_stack_category", F.desc("job_count"), "work_mode"
    )


def mart_seniority_demand(facts: DataFrame, locations: DataFrame, roles: DataFrame, jobs: DataFrame) -> DataFrame:
    """Active jobs per seniority, city and stack."""
    levels = roles.where(F.col("seniority_level").isNotNull() & F.col("tech_stack_category").isNotNull())
    cities = locations.where(F.col("city").isNotNull())
    return (
        of_active_jobs(facts.select("job_id", "role_key", "location_key"), jobs)
        .join(levels.select("role_id", "seniority_level", "tech_stack_category"), F.col("role_key") == F.col("role_id"))
        .join(cities.select("location_key", "city"), "location_key")
        .groupBy("seniority_level", "city", "tech_stack_category")
        .agg(F.countDistinct("job_id").alias("job_count"))
        .orderBy(F.desc("job_count"), "seniority_level", "city", "tech_stack_category")
    )


def job_skills(fact_skills: DataFrame, jobs: DataFrame) -> DataFrame:
    """Distinct (job_id, skill) of active jobs.

    Repeats go before the rows meet by job, so that a job with very many rows brings only its
    different skills. The ids joined to are unique, so this is a filter; written as a semi-join
    it would be moved below the distinct again.
    """
    named = fact_skills.select("job_id", clean_skill("skill", QUOTES).alias("skill")).where(F.col("skill") != "")
    active = active_jobs(jobs).select("active_id")
    return named.distinct().join(active, F.col("job_id") == F.col("active_id")).select("job_id", "skill")


def frequent_job_skills(fact_skills: DataFrame, jobs: DataFrame, top: int = TOP_SKILLS) -> DataFrame:
    """:func:`job_skills` of the most frequent skills, so at most ``top`` rows per job."""
    pairs = job_skills(fact_skills, jobs)
    counted = pairs.groupBy("skill").agg(F.count(F.lit(1)).alias("freq"))
    frequent = top_k(counted, top, F.desc("freq"), F.asc("skill")).select("skill")
    # An inner join on unique skills stays above the distinct, whose shuffle is then used twice.
    return pairs.join(frequent, "skill")


def mart_skill_cooccurrence(fact_skills: DataFrame, jobs: DataFrame, top: int = TOP_SKILLS) -> DataFrame:
    """Number of active jobs that list both of two frequent skills."""
    rows = frequent_job_skills(fact_skills, jobs, top)
    # A job holds at most ``top`` skills here, so its list is short and its pairs are few.
    per_job = rows.groupBy("job_id").agg(F.sort_array(F.collect_set("skill")).alias("skills"))
    pairs = per_job.select(F.posexplode("skills").alias("i", "skill_a"), "skills").select(
        "skill_a", F.explode(F.expr("slice(skills, i + 2, size(skills))")).alias("skill_b")
    )
    return (
        pairs.groupBy("skill_a", "skill_b")
        .agg(F.count(F.lit(1)).alias("co_occurrence_count"))
        .orderBy(F.desc("co_occurrence_count"), "skill_a", "skill_b")
    )


# --- saved views ----------------------------------------------------------------------------


def current_rows(history: DataFrame) -> DataFrame:
    """History rows that are still open."""
    return history.where(F.col("valid_to").isNull())


def vw_skill_demand(history: DataFrame, top: int = TOP_VIEW_SKILLS) -> DataFrame:
    counted = (
        current_rows(history)
        .groupBy("skill_name")
        .agg(
            F.count("job_skill_key").alias("demand_count"),
            F.min("valid_from").alias("first_seen"),
            F.max("valid_from").alias("last_seen"),
        )
    )
    return top_k(counted, top, F.desc("demand_count"), F.asc("skill_name"))


def vw_salary_by_role(facts: DataFrame, roles: DataFrame) -> DataFrame:
    """Mean salary and number of postings per stack; facts are summed per role before the join."""
    low, high = F.col("salary_min_lpa"), F.col("salary_max_lpa")
    per_role = facts.groupBy("role_key").agg(
        F.sum(low).alias("low"),
        F.count(low).alias("n_low"),
        F.sum(high).alias("high"),
        F.count(high).alias("n_high"),
        F.count("job_id").alias("n"),
    )
    stacks = roles.select("role_id", F.col("tech_stack_category").alias("role_category"))
    return (
        per_role.join(stacks, F.col("role_key") == F.col("role_id"))
        .groupBy("role_category")
        .agg(
            safe_divide(F.sum("low"), F.sum("n_low")).alias("avg_min_salary_lpa"),
            safe_divide(F.sum("high"), F.sum("n_high")).alias("avg_max_salary_lpa"),
            F.sum("n").alias("total_jobs"),
        )
        .orderBy(F.desc("total_jobs"), "role_category")
    )


def vw_jobs_by_city(facts: DataFrame, locations: DataFrame, history: DataFrame) -> DataFrame:
    """Distinct jobs and top skill per city and state."""
    places = locations.select("location_key", "city", "state")
    placed = facts.groupBy("location_key", "job_id").agg(F.count(F.lit(1)).alias("rows"))
    listed = current_rows(history).groupBy("job_id", "skill_name").agg(F.count("job_skill_key").alias("listings"))
    # Rows of a job times its listings, without forming the pairs.
    counted = (
        placed.join(listed, "job_id")
        .groupBy("location_key", "skill_name")
        .agg(F.sum(F.col("rows") * F.col("listings")).alias("skill_count"))
    )
    favourite = deduplicate(counted, ["location_key"], [F.desc("skill_count"), F.asc("skill_name")])
    jobs = (
        placed.join(places, "location_key")
        .groupBy("city", "state")
        .agg(F.countDistinct("job_id").alias("job_count"))
    )
    tops = (
        places.join(favourite, "location_key", "left").groupBy("city", "state").agg(F.max("skill_name").alias("top_skill"))
    )
    tops = tops.withColumnsRenamed({"city": "__city", "state": "__state"})
    same_city = F.col("city").eqNullSafe(F.col("__city")) & F.col("state").eqNullSafe(F.col("__state"))
    return (
        jobs.join(tops, same_city)
        .select("city", "state", "job_count", "top_skill")
        .orderBy(F.desc("job_count"), "city", "state")
    )


# --- dashboard steps --------------------------------------------------------------------------


def skill_leaders(demand: DataFrame, n: int = 20) -> DataFrame:
    return top_k(demand, n, F.desc("demand_count"), F.asc("skill_name"))


def skill_lifespan(demand: DataFrame) -> DataFrame:
    """Days between first and last sight of each skill in the view, at least 1."""
    return demand.withColumn("days_active", days_between("first_seen", "last_seen"))


def salary_spread(salaries: DataFrame) -> DataFrame:
    return salaries.withColumn("salary_spread", F.col("avg_max_salary_lpa") - F.col("avg_min_salary_lpa"))


def company_kpis(hiring: DataFrame) -> DataFrame:
    """Number of companies, mean remote share and most frequent top skill of the hiring mart.

    The mart has at most 50 rows, all of them the head of its own order.
    """
    return hiring.agg(
        F.count(F.lit(1)).alias("companies"),
        F.avg("remote_pct").alias("avg_remote_pct"),
        F.mode("top_skill", True).alias("most_sought_skill"),
    )


def seniority_totals(demand: DataFrame) -> DataFrame:
    named = demand.where(F.col("seniority_level").isNotNull())
    return named.groupBy("seniority_level").agg(F.sum("job_count").alias("job_count"))


def stack_heatmap(demand: DataFrame, levels: list[str] | None = None) -> DataFrame:
    return crosstab_sum(demand, "tech_stack_category", "seniority_level", "job_count", levels)
