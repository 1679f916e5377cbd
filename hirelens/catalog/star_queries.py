"""Star schema, marts, views and dashboard steps over the posting view."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import scalars, text
from ..operators import reshape
from ..plans import marts, star
from .inputs import (
    ACTIVE_SQL,
    AS_OF,
    JOB_SQL,
    fact_skills,
    key_sql,
    lists_as_text,
    posting_skills,
    postings,
    skill_history,
    stored_postings,
    texts_sql,
    with_ctes,
)
from .registry import query

LEVELS = ["Junior", "Lead", "Mid", "Principal", "Senior"]


def _jobs(spark, sf):
    return star.dim_job(postings(spark, sf, lines=False), AS_OF)


# --- dimensions and facts -------------------------------------------------------------------

STAGED = """SELECT job_id, source_job_id, company_name, company_sector, job_title, city, state, country, employment_type,
  posted_at, expires_at, work_mode, degree_requirement, experience_years, tech_stack_category, seniority_level,
  salary_min_lpa, salary_max_lpa, skills, enriched_at, pipeline_run_id, source_api, enrichment_confidence FROM postings"""


def _loaded(spark, sf):
    """The posting view as loaded: audit columns under their long names, numbers as text."""
    rows = postings(spark, sf, skills=True)
    names = {"enriched_at", "pipeline_run_id", "enrichment_confidence"}
    rows = rows.withColumnsRenamed({n: f"audit_{n}" for n in names})
    return rows.withColumn("experience_years", F.col("experience_years").cast("string"))


@query("stg_job_postings", texts_sql(with_ctes("postings", STAGED), "skills"))
def stg_job_postings(spark, sf):
    return lists_as_text(star.stg_job_postings(_loaded(spark, sf)))


@query(
    "staging_projection",
    texts_sql(with_ctes(
        "postings",
        """SELECT job_id, source_job_id, posted_at, CAST(NULL AS DOUBLE) AS experience_years, salary_min_lpa, skills,
  enriched_at FROM postings WHERE source_job_id IS NOT NULL""",
    ), "skills"),
)
def staging_projection(spark, sf):
    """Dirty input: unreadable numbers become NULL and rows without any id are left out."""
    rows = _loaded(spark, sf).withColumns({"job_id": F.lit(None).cast("string"), "experience_years": F.lit("many")})
    return lists_as_text(star.stg_job_postings(rows)).select(
        "job_id", "source_job_id", "posted_at", "experience_years", "salary_min_lpa", "skills", "enriched_at"
    )


@query("dim_company", with_ctes("company", "SELECT * FROM company"))
def dim_company(spark, sf):
    return star.dim_company(postings(spark, sf, lines=False))


@query("dim_locations", with_ctes("place", "SELECT * FROM place"))
def dim_locations(spark, sf):
    return star.dim_locations(postings(spark, sf, lines=False))


@query("dim_role", with_ctes("role", "SELECT * FROM role"))
def dim_role(spark, sf):
    return star.dim_role(postings(spark, sf))


@query(
    "dim_skill",
    with_ctes(
        "listed",
        f"""SELECT {key_sql("skill_name")} AS skill_id, skill_name, min(enriched_at) AS first_seen_date,
  count(DISTINCT job) AS total_demand_count
FROM (SELECT trim(replace(skill, '"', '')) AS skill_name, {JOB_SQL} AS job, enriched_at FROM listed)
WHERE skill_name <> '' GROUP BY skill_name""",
    ),
)
def dim_skill(spark, sf):
    return star.dim_skill(posting_skills(spark, sf))


@query("dim_job", with_ctes("job", "SELECT * FROM job"))
def dim_job(spark, sf):
    return _jobs(spark, sf)


@query(
    "dim_date",
    with_ctes(
        "postings",
        """SELECT CAST(strftime(d, '%Y%m%d') AS BIGINT) AS date_key, d AS date_day, CAST(year(d) AS INTEGER) AS year,
  CAST(month(d) AS INTEGER) AS month, CAST(day(d) AS INTEGER) AS day, CAST(dayofweek(d) + 1 AS INTEGER) AS day_of_week
FROM (SELECT DISTINCT CAST(enriched_at AS DATE) AS d FROM postings WHERE enriched_at IS NOT NULL)""",
    ),
)
def dim_date(spark, sf):
    return star.dim_date(postings(spark, sf, lines=False))


@query("fact_job_postings", texts_sql(with_ctes("fact", "SELECT * FROM fact"), "skills_array"))
def fact_job_postings(spark, sf):
    return lists_as_text(star.fact_job_postings(postings(spark, sf, skills=True)))


FACT_SKILLS = f"""SELECT {key_sql("job", "skill_name")} AS job_skill_key, job AS job_id,
  {key_sql("skill_name")} AS skill_id, is_active
FROM named JOIN job ON named.job = job.source_job_id"""
NAMED = f"""SELECT {JOB_SQL} AS job, trim(replace(skill, '"', '')) AS skill_name FROM listed
WHERE trim(replace(skill, '"', '')) <> ''"""


@query("fact_job_skills", with_ctes(("listed", "job"), FACT_SKILLS, named=NAMED))
def fact_job_skills(spark, sf):
    return star.fact_job_skills(posting_skills(spark, sf), _jobs(spark, sf))


@query("fact_job_skills_unique", with_ctes(("listed", "job"), "SELECT DISTINCT * FROM (" + FACT_SKILLS + ")", named=NAMED))
def fact_job_skills_unique(spark, sf):
    return star.fact_job_skills(posting_skills(spark, sf), _jobs(spark, sf), dedupe=True)


# --- marts ----------------------------------------------------------------------------------


@query("mart_company_hiring", with_ctes("hiring", "SELECT * FROM hiring"))
def mart_company_hiring(spark, sf):
    stg = stored_postings(spark, sf, lines=False)
    return marts.mart_company_hiring(
        star.fact_job_postings(stg), star.dim_company(stg), star.dim_job(stg, AS_OF), fact_skills(spark, sf, stg)
    )


@query(
    "mart_remote_split",
    with_ctes(
        ("fact", "role", "job"),
        """SELECT work_mode, tech_stack_category, job_count,
  CAST(job_count AS DOUBLE) / sum(job_count) OVER (PARTITION BY tech_stack_category) AS pct_of_total FROM counts""",
        counts="""SELECT f.work_mode, r.tech_stack_category, count(DISTINCT f.job_id) AS job_count
FROM fact f JOIN role r ON f.role_key = r.role_id WHERE f.job_id IN (SELECT source_job_id FROM job WHERE is_active)
  AND f.work_mode IS NOT NULL AND r.tech_stack_category IS NOT NULL GROUP BY ALL""",
    ),
)
def mart_remote_split(spark, sf):
    stg = stored_postings(spark, sf)
    return marts.mart_remote_split(star.fact_job_postings(stg), star.dim_role(stg), star.dim_job(stg, AS_OF))


@query("mart_seniority_demand", with_ctes("seniority", "SELECT * FROM seniority"))
def mart_seniority_demand(spark, sf):
    stg = stored_postings(spark, sf)
    return marts.mart_seniority_demand(
        star.fact_job_postings(stg), star.dim_locations(stg), star.dim_role(stg), star.dim_job(stg, AS_OF)
    )


PAIRS = """SELECT a.skill AS skill_a, b.skill AS skill_b, count(DISTINCT a.job_id) AS co_occurrence_count
FROM frequent a JOIN frequent b ON a.job_id = b.job_id AND a.skill < b.skill GROUP BY a.skill, b.skill"""


@query("mart_skill_cooccurrence", with_ctes("frequent", PAIRS))
def mart_skill_cooccurrence(spark, sf):
    return marts.mart_skill_cooccurrence(fact_skills(spark, sf), _jobs(spark, sf))


@query("join_self_lt", with_ctes("frequent", PAIRS))
def join_self_lt(spark, sf):
    """The pairs of frequent skills as a self-join; a job has at most 20 rows to pair."""
    rows = marts.frequent_job_skills(fact_skills(spark, sf), _jobs(spark, sf))
    a = rows.select(F.col("job_id").alias("job_a"), F.col("skill").alias("skill_a"))
    b = rows.select(F.col("job_id").alias("job_b"), F.col("skill").alias("skill_b"))
    pairs = a.join(b, (F.col("job_a") == F.col("job_b")) & (F.col("skill_a") < F.col("skill_b")))
    return pairs.groupBy("skill_a", "skill_b").agg(F.countDistinct("job_a").alias("co_occurrence_count"))


# --- views and dashboard ----------------------------------------------------------------------


@query("vw_skill_demand", with_ctes("demand", "SELECT * FROM demand"))
def vw_skill_demand(spark, sf):
    return marts.vw_skill_demand(skill_history(spark, sf))


@query("vw_salary_by_role", with_ctes("salary", "SELECT * FROM salary"))
def vw_salary_by_role(spark, sf):
    stg = stored_postings(spark, sf)
    return marts.vw_salary_by_role(star.fact_job_postings(stg), star.dim_role(stg))


@query(
    "vw_jobs_by_city",
    with_ctes(
        ("fact", "place", "skill_history"),
        """SELECT p.city, p.state, count(DISTINCT f.job_id) AS job_count, max(t.skill_name) AS top_skill
FROM fact f JOIN place p USING (location_key)
LEFT JOIN (SELECT location_key, skill_name FROM city_skill
           QUALIFY row_number() OVER (PARTITION BY location_key ORDER BY n DESC, skill_name) = 1) t USING (location_key)
GROUP BY p.city, p.state""",
        city_skill="""SELECT location_key, skill_name, count(*) AS n
FROM fact JOIN place USING (location_key) JOIN skill_history h ON fact.job_id = h.job_id
WHERE valid_to IS NULL GROUP BY ALL""",
    ),
)
def vw_jobs_by_city(spark, sf):
    stg = stored_postings(spark, sf, lines=False)
    return marts.vw_jobs_by_city(star.fact_job_postings(stg), star.dim_locations(stg), skill_history(spark, sf, stg))


@query("dash_skill_leaders", with_ctes("demand", "SELECT * FROM demand ORDER BY demand_count DESC, skill_name LIMIT 20"))
def dash_skill_leaders(spark, sf):
    return marts.skill_leaders(marts.vw_skill_demand(skill_history(spark, sf)))


@query(
    "dash_skill_lifespan",
    with_ctes(
        "demand",
        """SELECT *, CASE WHEN d = 0 THEN 1 ELSE d END AS days_active FROM
(SELECT *, date_sub('day', first_seen, last_seen) AS d FROM demand)""",
    ).replace("SELECT *, CASE", "SELECT * EXCLUDE (d), CASE"),
)
def dash_skill_lifespan(spark, sf):
    return marts.skill_lifespan(marts.vw_skill_demand(skill_history(spark, sf)))


@query("datediff_days", with_ctes("postings", f"""SELECT {JOB_SQL} AS job_id, CASE WHEN d = 0 THEN 1 ELSE d END AS days
FROM (SELECT *, date_sub('day', TIMESTAMP '2001-06-01', enriched_at) AS d FROM postings)"""))
def datediff_days(spark, sf):
    days = scalars.days_between(F.lit(AS_OF).cast("timestamp_ntz"), "enriched_at")
    return postings(spark, sf, lines=False).select(scalars.job_ref().alias("job_id"), days.alias("days"))


@query(
    "dash_salary_spread",
    with_ctes("salary", "SELECT *, avg_max_salary_lpa - avg_min_salary_lpa AS salary_spread FROM salary"),
)
def dash_salary_spread(spark, sf):
    return marts.salary_spread(vw_salary_by_role(spark, sf))


@query(
    "dash_company_kpis",
    with_ctes(
        "hiring",
        """SELECT count(*) AS companies, round(avg(remote_pct), 6) AS avg_remote_pct,
  (SELECT top_skill FROM hiring WHERE top_skill IS NOT NULL GROUP BY top_skill ORDER BY count(*) DESC, top_skill LIMIT 1)
    AS most_sought_skill FROM hiring""",
    ),
)
def dash_company_kpis(spark, sf):
    # Rounded, as a mean of fractions depends on the order of adding in its last digit.
    return marts.company_kpis(mart_company_hiring(spark, sf)).withColumn("avg_remote_pct", F.round("avg_remote_pct", 6))


@query(
    "dash_seniority_totals",
    with_ctes(
        "seniority", "SELECT seniority_level, CAST(sum(job_count) AS BIGINT) AS job_count FROM seniority GROUP BY ALL"
    ),
)
def dash_seniority_totals(spark, sf):
    return marts.seniority_totals(mart_seniority_demand(spark, sf))


HEATMAP = "SELECT tech_stack_category, " + ", ".join(
    f"CAST(coalesce(sum(job_count) FILTER (seniority_level = '{v}'), 0) AS BIGINT) AS \"{v}\"" for v in LEVELS
)


@query("dash_stack_heatmap", with_ctes("seniority", HEATMAP + " FROM seniority GROUP BY tech_stack_category"))
def dash_stack_heatmap(spark, sf):
    return marts.stack_heatmap(mart_seniority_demand(spark, sf), LEVELS)


# --- functions on postings --------------------------------------------------------------------


@query("is_active", with_ctes("postings", f"SELECT {JOB_SQL} AS job_id, posted_at, expires_at, {ACTIVE_SQL} AS is_active FROM postings"))
def is_active(spark, sf):
    flag = scalars.is_active("posted_at", "expires_at", AS_OF).alias("is_active")
    return postings(spark, sf, lines=False).select(scalars.job_ref().alias("job_id"), "posted_at", "expires_at", flag)


@query("safe_cast_date", with_ctes("postings", f"""SELECT {JOB_SQL} AS job_id, try_cast(substr(expires_at, 1, 10) AS DATE) AS closes,
  CAST(try_cast(substr(posted_at, 1, 10) AS DATE) - INTERVAL 60 DAY AS DATE) AS horizon FROM postings"""))
def safe_cast_date(spark, sf):
    return postings(spark, sf, lines=False).select(
        scalars.job_ref().alias("job_id"),
        scalars.iso_date("expires_at").alias("closes"),
        F.date_sub(scalars.iso_date("posted_at"), scalars.ACTIVE_DAYS).alias("horizon"),
    )


@query("surrogate_key", with_ctes("postings", f"""SELECT {key_sql("source_job_id", "job_id")} AS job_key,
  {key_sql("city", "state", "country")} AS location_key, {key_sql("company_name")} AS company_key,
  md5(coalesce(company_name, '') || '-' || coalesce(city, '')) AS blank_key FROM postings"""))
def surrogate_key(spark, sf):
    return postings(spark, sf, lines=False).select(
        scalars.surrogate_key("source_job_id", "job_id").alias("job_key"),
        scalars.surrogate_key("city", "state", "country").alias("location_key"),
        scalars.surrogate_key("company_name").alias("company_key"),
        scalars.surrogate_key("company_name", "city", nulls_as_empty=True).alias("blank_key"),
    )


@query("date_key", with_ctes("postings", f"SELECT {JOB_SQL} AS job_id, CAST(strftime(enriched_at, '%Y%m%d') AS BIGINT) AS date_key FROM postings"))
def date_key(spark, sf):
    return postings(spark, sf, lines=False).select(
        scalars.job_ref().alias("job_id"), scalars.date_key("enriched_at").alias("date_key")
    )


@query("date_parts", with_ctes("postings", """SELECT CAST(year(enriched_at) AS INTEGER) AS year, CAST(month(enriched_at) AS INTEGER) AS month,
  CAST(day(enriched_at) AS INTEGER) AS day, CAST(dayofweek(enriched_at) + 1 AS INTEGER) AS day_of_week, count(*) AS n
FROM postings GROUP BY ALL"""))
def date_parts(spark, sf):
    at = F.col("enriched_at")
    parts = [F.year(at).alias("year"), F.month(at).alias("month"), F.dayofmonth(at).alias("day"), F.dayofweek(at).alias("day_of_week")]
    return postings(spark, sf, lines=False).groupBy(*parts).agg(F.count(F.lit(1)).alias("n"))


@query("coalesce_nullif_case", with_ctes("postings", f"""SELECT {JOB_SQL} AS job_id, nullif(work_mode, 'Hybrid') AS fixed_mode,
  CASE WHEN experience_years >= 5 THEN 'high' WHEN experience_years >= 0 THEN 'low' END AS band,
  CAST(experience_years AS VARCHAR) IS NULL AS unknown, CAST(enriched_at AS DATE) AS enriched_on FROM postings"""))
def coalesce_nullif_case(spark, sf):
    years = F.col("experience_years")
    return postings(spark, sf, lines=False).select(
        scalars.job_ref().alias("job_id"),
        F.nullif("work_mode", F.lit("Hybrid")).alias("fixed_mode"),
        F.when(years >= 5, "high").when(years >= 0, "low").alias("band"),
        years.cast("string").isNull().alias("unknown"),
        F.to_date("enriched_at").alias("enriched_on"),
    )


@query("str_clean_skill", with_ctes("listed", f"""SELECT {JOB_SQL} AS job_id, trim(replace(s, '"', '')) AS plain, replace(replace(s, '"', ''), '''', '') AS untrimmed
FROM (SELECT *, ' "' || skill || '''s" ' AS s FROM listed)"""))
def str_clean_skill(spark, sf):
    rows = posting_skills(spark, sf).withColumn("s", F.concat(F.lit(' "'), "skill", F.lit("'s\" ")))
    return rows.select(
        scalars.job_ref().alias("job_id"),
        text.clean_skill("s").alias("plain"),
        text.clean_skill("s", marts.QUOTES, trim=False).alias("untrimmed"),
    )


@query("join_lateral_unnest", with_ctes("listed", f"SELECT {JOB_SQL} AS job_id, skill FROM listed"))
def join_lateral_unnest(spark, sf):
    return star.skill_rows(postings(spark, sf, skills=True)).select(scalars.job_ref().alias("job_id"), "skill")


@query("current_rows", with_ctes("skill_history", "SELECT * FROM skill_history WHERE valid_to IS NULL"))
def current_rows(spark, sf):
    return marts.current_rows(skill_history(spark, sf))


# --- aggregates on postings -------------------------------------------------------------------


@query("agg_min_max", with_ctes("postings", """SELECT company_name, max(company_sector) AS sector, min(enriched_at) AS first_seen,
  max(enriched_at) AS last_seen, min(job_title) AS first_title FROM postings GROUP BY company_name"""))
def agg_min_max(spark, sf):
    return postings(spark, sf, lines=False).groupBy("company_name").agg(
        F.max("company_sector").alias("sector"),
        F.min("enriched_at").alias("first_seen"),
        F.max("enriched_at").alias("last_seen"),
        F.min("job_title").alias("first_title"),
    )


@query("agg_count", with_ctes("postings", """SELECT city, count(*) AS n, count(company_name) AS named, count(source_job_id) AS with_id
FROM postings GROUP BY city"""))
def agg_count(spark, sf):
    return postings(spark, sf, lines=False).groupBy("city").agg(
        F.count(F.lit(1)).alias("n"), F.count("company_name").alias("named"), F.count("source_job_id").alias("with_id")
    )


@query("agg_count_distinct", with_ctes("postings", f"""SELECT state, count(DISTINCT {JOB_SQL}) AS jobs, count(DISTINCT company_name) AS companies
FROM postings GROUP BY state"""))
def agg_count_distinct(spark, sf):
    return postings(spark, sf, lines=False).groupBy("state").agg(
        F.countDistinct(scalars.job_ref()).alias("jobs"), F.countDistinct("company_name").alias("companies")
    )


@query("agg_sum", with_ctes("postings", """SELECT seniority_level, sum(salary_min_lpa) AS low, sum(salary_max_lpa) AS high,
  sum(experience_years) AS years FROM postings GROUP BY seniority_level"""))
def agg_sum(spark, sf):
    return postings(spark, sf).groupBy("seniority_level").agg(
        F.sum("salary_min_lpa").alias("low"), F.sum("salary_max_lpa").alias("high"), F.sum("experience_years").alias("years")
    )


@query("agg_avg", with_ctes("postings", """SELECT seniority_level, avg(experience_years) AS years, avg(salary_min_lpa) AS low
FROM postings GROUP BY seniority_level"""))
def agg_avg(spark, sf):
    return postings(spark, sf).groupBy("seniority_level").agg(
        F.avg("experience_years").alias("years"), F.avg("salary_min_lpa").alias("low")
    )


@query("agg_conditional_ratio", with_ctes("postings", """SELECT company_name, count(*) FILTER (work_mode = 'Remote') / count(*) AS remote_pct
FROM postings GROUP BY company_name"""))
def agg_conditional_ratio(spark, sf):
    remote = scalars.safe_divide(F.count_if(F.col("work_mode") == "Remote"), F.count(F.lit(1)))
    return postings(spark, sf, lines=False).groupBy("company_name").agg(remote.alias("remote_pct"))


@query("agg_ratio_to_total", with_ctes("postings", """SELECT state, work_mode, n, n / sum(n) OVER (PARTITION BY state) AS share
FROM (SELECT state, work_mode, count(*) AS n FROM postings GROUP BY ALL)"""))
def agg_ratio_to_total(spark, sf):
    counted = postings(spark, sf, lines=False).groupBy("state", "work_mode").agg(F.count(F.lit(1)).alias("n"))
    total = F.sum("n").over(marts.Window.partitionBy("state"))
    return counted.withColumn("share", scalars.safe_divide("n", total))


@query("agg_having", with_ctes("postings", "SELECT company_name, count(*) AS n FROM postings GROUP BY company_name HAVING count(*) > 12"))
def agg_having(spark, sf):
    counted = postings(spark, sf, lines=False).groupBy("company_name").agg(F.count(F.lit(1)).alias("n"))
    return counted.where("n > 12")


@query("agg_distinct", with_ctes("postings", "SELECT DISTINCT city, state, country, work_mode FROM postings"))
def agg_distinct(spark, sf):
    return postings(spark, sf, lines=False).select("city", "state", "country", "work_mode").distinct()


@query("agg_wide_group", with_ctes("postings", """SELECT source_job_id, job_id, job_title, employment_type, experience_years, degree_requirement,
  work_mode, posted_at, expires_at, min(enriched_at) AS created_at FROM postings GROUP BY ALL"""))
def agg_wide_group(spark, sf):
    columns = ["source_job_id", "job_id", *star.JOB_ATTRIBUTES]
    return postings(spark, sf, lines=False).groupBy(*columns).agg(F.min("enriched_at").alias("created_at"))


@query("agg_mode", with_ctes("listed", "SELECT skill, count(*) AS n FROM listed GROUP BY skill ORDER BY n DESC, skill LIMIT 1"))
def agg_mode(spark, sf):
    """The most frequent skill of all; counted first, so that no task holds all values."""
    counted = posting_skills(spark, sf).groupBy("skill").agg(F.count(F.lit(1)).alias("n"))
    return reshape.top_k(counted, 1, F.desc("n"), F.asc("skill"))


CROSS = "SELECT city, " + ", ".join(
    f"CAST(coalesce(sum(n) FILTER (work_mode = '{v}'), 0) AS BIGINT) AS \"{v}\"" for v in ("Hybrid", "Onsite", "Remote")
)


@query("agg_crosstab", with_ctes("postings", CROSS + " FROM (SELECT city, work_mode, count(*) AS n FROM postings WHERE city IS NOT NULL GROUP BY ALL) GROUP BY city"))
def agg_crosstab(spark, sf):
    counted = postings(spark, sf, lines=False).groupBy("city", "work_mode").agg(F.count(F.lit(1)).alias("n"))
    return reshape.crosstab_sum(counted, "city", "work_mode", "n", ["Hybrid", "Onsite", "Remote"])


@query("win_top1_per_group", with_ctes("listed", """SELECT company_name, skill, n FROM (SELECT company_name, skill, count(*) AS n FROM listed GROUP BY ALL)
QUALIFY row_number() OVER (PARTITION BY company_name ORDER BY n DESC, skill) = 1"""))
def win_top1_per_group(spark, sf):
    counted = posting_skills(spark, sf).groupBy("company_name", "skill").agg(F.count(F.lit(1)).alias("n"))
    return reshape.deduplicate(counted, ["company_name"], [F.desc("n"), F.asc("skill")])


@query("topk", with_ctes("postings", """SELECT company_name, count(*) AS n FROM postings GROUP BY company_name
ORDER BY n DESC, company_name NULLS LAST LIMIT 50"""))
def topk(spark, sf):
    counted = postings(spark, sf, lines=False).groupBy("company_name").agg(F.count(F.lit(1)).alias("n"))
    return reshape.top_k(counted, 50, F.desc("n"), F.asc_nulls_last("company_name"))


@query("order_multi", with_ctes("postings", "SELECT state, city, work_mode, count(*) AS n FROM postings GROUP BY ALL"))
def order_multi(spark, sf):
    counted = postings(spark, sf, lines=False).groupBy("state", "city", "work_mode").agg(F.count(F.lit(1)).alias("n"))
    return counted.orderBy("state", F.desc("n"), F.asc_nulls_last("city"), "work_mode")


@query("head_n", with_ctes("hiring", "SELECT company_name, total_postings FROM hiring ORDER BY total_postings DESC, company_name LIMIT 15"))
def head_n(spark, sf):
    hiring = mart_company_hiring(spark, sf).select("company_name", "total_postings")
    return reshape.top_k(hiring, 15, F.desc("total_postings"), F.asc("company_name"))
