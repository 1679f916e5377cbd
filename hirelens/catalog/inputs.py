"""Posting-shaped inputs over the given tables, in Spark and as SQL for the comparison."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.scalars import NULL_KEY_TEXT, job_ref, surrogate_key
from ..plans import star
from ..session import tune, written

AS_OF = "2001-06-01"
ISO = "yyyy-MM-dd'T'HH:mm:ss'Z'"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return tune(spark).read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


# --- postings -----------------------------------------------------------------------------

LINE_COLUMNS = ("tech_stack_category", "salary_min_lpa", "salary_max_lpa", "skills")
SENIORITY = {"1-URGENT": "Principal", "2-HIGH": "Lead", "3-MEDIUM": "Senior", "4-NOT SPECIFIED": "Mid"}


def _parts_of_orders(spark: SparkSession, folder: str) -> DataFrame:
    lines = table(spark, folder, "lineitem").select("l_orderkey", "l_partkey", "l_quantity")
    parts = table(spark, folder, "part").select("p_partkey", "p_name", "p_type")
    return lines.join(parts, F.col("l_partkey") == F.col("p_partkey"))


def _line_summary(spark: SparkSession, folder: str, lists: bool) -> DataFrame:
    lines = _parts_of_orders(spark, folder)
    measures = {
        "tech_stack_category": F.min("p_type"),
        "salary_min_lpa": F.min("l_quantity"),
        "salary_max_lpa": F.max("l_quantity"),
    }
    if not lists:
        return lines.groupBy("l_orderkey").agg(*[m.alias(n) for n, m in measures.items()])
    # Repeats are counted before the list is made; the list itself is the posting's own value.
    named = lines.groupBy("l_orderkey", "p_name").agg(
        F.count(F.lit(1)).cast("int").alias("times"),
        F.min("p_type").alias("p_type"),
        F.min("l_quantity").alias("low"),
        F.max("l_quantity").alias("high"),
    )
    listed = F.sort_array(F.collect_list(F.struct("p_name", "times")))
    return named.groupBy("l_orderkey").agg(
        F.min("p_type").alias("tech_stack_category"),
        F.min("low").alias("salary_min_lpa"),
        F.max("high").alias("salary_max_lpa"),
        F.flatten(F.transform(listed, lambda x: F.array_repeat(x["p_name"], x["times"]))).alias("skills"),
    )


def _posting_columns() -> dict[str, Column]:
    key = F.col("o_orderkey")
    closes = F.date_format(F.col("o_orderdate") + F.expr("interval 30 day"), ISO)
    level = F.lit("Junior")
    for priority, name in SENIORITY.items():
        level = F.when(F.col("o_orderpriority") == priority, name).otherwise(level)
    return {
        "source_job_id": F.when(key % 10 != 0, key.cast("string")),
        "job_id": F.when(key % 10 == 0, F.concat(F.lit("L"), key.cast("string"))),
        "company_name": F.when(F.col("o_custkey") % 50 != 0, F.col("c_name")),
        "company_sector": F.col("c_mktsegment"),
        "job_title": F.concat(F.lit("Engineer "), (key % 7).cast("string")),
        "city": F.when(F.col("n_nationkey") != 24, F.col("n_name")),
        "state": F.col("r_name"),
        "country": F.lit("IN"),
        "employment_type": F.concat(F.lit("type-"), (key % 3).cast("string")),
        "degree_requirement": F.concat(F.lit("degree-"), (key % 4).cast("string")),
        "work_mode": F.when(F.col("o_orderstatus") == "F", "Onsite").when(F.col("o_orderstatus") == "O", "Hybrid").otherwise("Remote"),
        "experience_years": F.when(key % 17 != 0, (key % 13).cast("double")),
        "tech_stack_category": F.col("tech_stack_category"),
        "seniority_level": level,
        "salary_min_lpa": F.col("salary_min_lpa"),
        "salary_max_lpa": F.col("salary_max_lpa"),
        "skills": F.col("skills"),
        "posted_at": F.date_format("o_orderdate", ISO),
        "expires_at": F.when(key % 5 == 0, None).when(key % 101 == 0, "soon").otherwise(closes),
        "enriched_at": F.col("o_orderdate") + F.expr("interval 1 day"),
        "pipeline_run_id": F.concat(F.lit("run-"), (key % 8).cast("string")),
        "source_api": F.concat(F.lit("api-"), (key % 2).cast("string")),
        "enrichment_confidence": F.lit("high"),
    }


def _orders(spark: SparkSession, folder: str) -> DataFrame:
    customer = table(spark, folder, "customer").select("c_custkey", "c_name", "c_mktsegment", "c_nationkey")
    nation, region = table(spark, folder, "nation"), table(spark, folder, "region")
    return (
        table(spark, folder, "orders")
        .join(customer, F.col("o_custkey") == F.col("c_custkey"))
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .join(region, F.col("n_regionkey") == F.col("r_regionkey"))
    )


def postings(spark: SparkSession, folder: str, lines: bool = True, skills: bool = False, key: bool = False) -> DataFrame:
    """One posting per order. Columns that come from the order's lines are NULL without ``lines``,
    the list of skills is there only with ``skills``, the order's key with ``key``."""
    columns = _posting_columns()
    rows = _orders(spark, folder)
    if lines or skills:
        summary = _line_summary(spark, folder, skills)
        rows = rows.join(summary, F.col("o_orderkey") == F.col("l_orderkey"), "left")
    else:
        columns.update(tech_stack_category=F.lit(None).cast("string"))
        columns.update({c: F.lit(None).cast("double") for c in ("salary_min_lpa", "salary_max_lpa")})
    if not skills:
        del columns["skills"]
    return rows.select(*[c.alias(name) for name, c in columns.items()], *(["o_orderkey"] if key else []))


def stored_postings(spark: SparkSession, folder: str, lines: bool = True) -> DataFrame:
    """:func:`postings` with the order's key, written once for the several tables of the star made from them."""
    return written(postings(spark, folder, lines, key=True), "postings")


def posting_skills(spark: SparkSession, folder: str, stored: DataFrame | None = None) -> DataFrame:
    """One row per posting and listed skill: what exploding the list gives, without making lists.

    With ``stored`` postings the lines are joined to those.
    """
    if stored is not None:
        lines = _parts_of_orders(spark, folder).select("l_orderkey", F.col("p_name").alias("skill"))
        return stored.join(lines, F.col("o_orderkey") == F.col("l_orderkey"))
    columns = _posting_columns()
    for name in LINE_COLUMNS:
        del columns[name]
    lines = _parts_of_orders(spark, folder)
    rows = _orders(spark, folder).join(lines, F.col("o_orderkey") == F.col("l_orderkey"))
    return rows.select(*[c.alias(name) for name, c in columns.items()], F.col("p_name").alias("skill"))


def fact_skills(spark: SparkSession, folder: str, stored: DataFrame | None = None) -> DataFrame:
    """Skills of the posting fact: (job_id, company_key, skill)."""
    return posting_skills(spark, folder, stored).select(
        job_ref().alias("job_id"), surrogate_key(*star.COMPANY).alias("company_key"), "skill"
    )


def skill_history(spark: SparkSession, folder: str, stored: DataFrame | None = None) -> DataFrame:
    """Skills of jobs over time; those of every ninth order are closed."""
    rows = posting_skills(spark, folder, stored)
    number = F.regexp_replace(job_ref(), "L", "").cast("bigint")
    return rows.select(
        surrogate_key(job_ref(), "skill").alias("job_skill_key"),
        job_ref().alias("job_id"),
        F.col("skill").alias("skill_name"),
        F.col("enriched_at").alias("valid_from"),
        F.when(number % 9 == 0, F.col("enriched_at")).alias("valid_to"),
    )


def lists_as_text(df: DataFrame) -> DataFrame:
    """List columns as texts joined by '|', so that results compare as plain values."""
    lists = [f.name for f in df.schema if isinstance(f.dataType, T.ArrayType)]
    return df.withColumns({c: F.array_join(c, "|") for c in lists})


# --- the same as SQL ------------------------------------------------------------------------


def key_sql(*columns: str) -> str:
    parts = [f"coalesce(CAST({c} AS VARCHAR), '{NULL_KEY_TEXT}')" for c in columns]
    return "md5(" + " || '-' || ".join(parts) + ")"


def texts_sql(sql: str, *columns: str) -> str:
    """A query with its list columns as :func:`lists_as_text` gives them."""
    changed = ", ".join(f"array_to_string({c}, '|') AS {c}" for c in columns)
    return f"SELECT * REPLACE ({changed}) FROM ({sql})"


ACTIVE_SQL = f"""CASE WHEN try_cast(substr(expires_at, 1, 10) AS DATE) < DATE '{AS_OF}' THEN false
     WHEN try_cast(substr(posted_at, 1, 10) AS DATE) < DATE '{AS_OF}' - INTERVAL 60 DAY THEN false ELSE true END"""
JOB_SQL = "coalesce(source_job_id, job_id)"

# Name -> (names it needs, query).
CTES: dict[str, tuple[tuple[str, ...], str]] = {
    "l": (
        (),
        """SELECT l_orderkey, list_sort(list(p_name)) AS skills, min(p_type) AS p_type,
       min(l_quantity) AS qmin, max(l_quantity) AS qmax
FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY l_orderkey""",
    ),
    "postings": (
        ("l",),
        """SELECT CASE WHEN o_orderkey % 10 = 0 THEN NULL ELSE CAST(o_orderkey AS VARCHAR) END AS source_job_id,
  CASE WHEN o_orderkey % 10 = 0 THEN 'L' || CAST(o_orderkey AS VARCHAR) END AS job_id,
  CASE WHEN o_custkey % 50 = 0 THEN NULL ELSE c_name END AS company_name, c_mktsegment AS company_sector,
  'Engineer ' || CAST(o_orderkey % 7 AS VARCHAR) AS job_title,
  CASE WHEN n_nationkey = 24 THEN NULL ELSE n_name END AS city, r_name AS state, 'IN' AS country,
  'type-' || CAST(o_orderkey % 3 AS VARCHAR) AS employment_type,
  'degree-' || CAST(o_orderkey % 4 AS VARCHAR) AS degree_requirement,
  CASE o_orderstatus WHEN 'F' THEN 'Onsite' WHEN 'O' THEN 'Hybrid' ELSE 'Remote' END AS work_mode,
  CASE WHEN o_orderkey % 17 = 0 THEN NULL ELSE CAST(o_orderkey % 13 AS DOUBLE) END AS experience_years,
  l.p_type AS tech_stack_category,
  CASE o_orderpriority WHEN '1-URGENT' THEN 'Principal' WHEN '2-HIGH' THEN 'Lead' WHEN '3-MEDIUM' THEN 'Senior'
       WHEN '4-NOT SPECIFIED' THEN 'Mid' ELSE 'Junior' END AS seniority_level,
  qmin AS salary_min_lpa, qmax AS salary_max_lpa, skills,
  strftime(o_orderdate, '%Y-%m-%dT%H:%M:%SZ') AS posted_at,
  CASE WHEN o_orderkey % 5 = 0 THEN NULL WHEN o_orderkey % 101 = 0 THEN 'soon'
       ELSE strftime(o_orderdate + INTERVAL 30 DAY, '%Y-%m-%dT%H:%M:%SZ') END AS expires_at,
  o_orderdate + INTERVAL 1 DAY AS enriched_at,
  'run-' || CAST(o_orderkey % 8 AS VARCHAR) AS pipeline_run_id,
  'api-' || CAST(o_orderkey % 2 AS VARCHAR) AS source_api, 'high' AS enrichment_confidence
FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
JOIN region ON n_regionkey = r_regionkey LEFT JOIN l ON l_orderkey = o_orderkey""",
    ),
    "listed": (("postings",), "SELECT * EXCLUDE (skills), unnest(skills) AS skill FROM postings"),
    "skill_history": (
        ("listed",),
        f"""SELECT {key_sql(JOB_SQL, "skill")} AS job_skill_key, {JOB_SQL} AS job_id, skill AS skill_name,
  enriched_at AS valid_from,
  CASE WHEN CAST(replace({JOB_SQL}, 'L', '') AS BIGINT) % 9 = 0 THEN enriched_at END AS valid_to FROM listed""",
    ),
    "company": (
        ("postings",),
        f"""SELECT {key_sql("company_name")} AS company_key, company_name, max(company_sector) AS company_sector,
  min(enriched_at) AS first_seen_date, max(enriched_at) AS last_seen_date,
  count(DISTINCT {JOB_SQL}) AS total_jobs_posted
FROM postings WHERE company_name IS NOT NULL GROUP BY company_name""",
    ),
    "place": (
        ("postings",),
        f"""SELECT {key_sql("city", "state", "country")} AS location_key, city, state, country
FROM (SELECT DISTINCT city, state, country FROM postings WHERE city IS NOT NULL)""",
    ),
    "role": (
        ("postings",),
        f"""SELECT {key_sql("job_title", "seniority_level", "tech_stack_category")} AS role_id,
  job_title AS role_name, seniority_level, tech_stack_category, min(enriched_at) AS first_seen_at
FROM postings WHERE job_title IS NOT NULL GROUP BY job_title, seniority_level, tech_stack_category""",
    ),
    "job": (
        ("postings",),
        f"""SELECT {key_sql("source_job_id", "job_id")} AS job_key, {JOB_SQL} AS source_job_id, job_title,
  employment_type, experience_years, degree_requirement, work_mode, posted_at, expires_at,
  {ACTIVE_SQL} AS is_active, min(enriched_at) AS created_at
FROM postings
GROUP BY postings.source_job_id, postings.job_id, job_title, employment_type, experience_years, degree_requirement,
  work_mode, posted_at, expires_at""",
    ),
    "fact": (
        ("postings",),
        f"""SELECT {JOB_SQL} AS job_id, {key_sql("company_name")} AS company_key,
  {key_sql("city", "state", "country")} AS location_key,
  {key_sql("job_title", "seniority_level", "tech_stack_category")} AS role_key,
  CAST(strftime(enriched_at, '%Y%m%d') AS BIGINT) AS date_key, seniority_level, work_mode, experience_years,
  salary_min_lpa, salary_max_lpa, skills AS skills_array, enriched_at AS created_at, pipeline_run_id, source_api,
  enrichment_confidence
FROM postings""",
    ),
    "job_skill": (
        ("fact", "job"),
        r"""SELECT DISTINCT job_id, trim(translate(s, '"''', '')) AS skill
FROM (SELECT job_id, unnest(skills_array) AS s FROM fact
      WHERE job_id IN (SELECT source_job_id FROM job WHERE is_active)) WHERE trim(translate(s, '"''', '')) <> ''""",
    ),
    "top_skill": (
        ("job_skill",),
        "SELECT skill, count(*) AS freq FROM job_skill GROUP BY skill ORDER BY freq DESC, skill LIMIT 20",
    ),
    "frequent": (("top_skill",), "SELECT job_id, skill FROM job_skill JOIN top_skill USING (skill)"),
    "hiring": (
        ("fact", "job", "company"),
        """SELECT company_name, company_sector, total_postings, top_skill, avg_experience_years, remote_pct
FROM (SELECT company_key, count(DISTINCT job_id) AS total_postings, avg(f.experience_years) AS avg_experience_years,
        count(*) FILTER (f.work_mode = 'Remote') / count(*) AS remote_pct
      FROM fact f JOIN job j ON f.job_id = j.source_job_id WHERE j.is_active GROUP BY company_key) a
JOIN company c USING (company_key)
LEFT JOIN (SELECT company_key, arg_max(s, (n, rn)) AS top_skill
      FROM (SELECT company_key, s, count(*) AS n, -rank() OVER (ORDER BY s) AS rn
            FROM (SELECT company_key, translate(unnest(skills_array), '"''', '') AS s FROM fact) WHERE s <> ''
            GROUP BY company_key, s) GROUP BY company_key) t USING (company_key)
ORDER BY total_postings DESC, company_name LIMIT 50""",
    ),
    "seniority": (
        ("fact", "place", "role", "job"),
        """SELECT r.seniority_level, p.city, r.tech_stack_category, count(DISTINCT f.job_id) AS job_count
FROM fact f JOIN place p USING (location_key) JOIN role r ON f.role_key = r.role_id
WHERE f.job_id IN (SELECT source_job_id FROM job WHERE is_active)
  AND r.seniority_level IS NOT NULL AND r.tech_stack_category IS NOT NULL GROUP BY ALL""",
    ),
    "demand": (
        ("skill_history",),
        """SELECT skill_name, count(job_skill_key) AS demand_count, min(valid_from) AS first_seen, max(valid_from) AS last_seen
FROM skill_history WHERE valid_to IS NULL GROUP BY skill_name ORDER BY demand_count DESC, skill_name LIMIT 50""",
    ),
    "salary": (
        ("fact", "role"),
        """SELECT tech_stack_category AS role_category, avg(salary_min_lpa) AS avg_min_salary_lpa,
  avg(salary_max_lpa) AS avg_max_salary_lpa, count(job_id) AS total_jobs
FROM fact JOIN role ON role_key = role_id GROUP BY tech_stack_category""",
    ),
}


def with_ctes(names: tuple[str, ...] | str, body: str, **extra: str) -> str:
    """A query in front of which stand the named CTEs, those they need, and ``extra`` ones."""
    wanted: list[str] = []

    def add(name: str) -> None:
        for needed in CTES[name][0]:
            add(needed)
        if name not in wanted:
            wanted.append(name)

    for name in (names,) if isinstance(names, str) else names:
        add(name)
    parts = [f"{n} AS ({CTES[n][1]})" for n in wanted] + [f"{n} AS ({q})" for n, q in extra.items()]
    return "WITH " + ",\n".join(parts) + "\n" + body
