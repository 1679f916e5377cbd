"""Text extraction, model responses, the three pipeline steps, files and sinks."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import scalars, semistructured, text
from ..operators import reshape
from ..plans import bronze, load, silver
from ..schemas import AUDIT, RUN_LOG, SILVER as SILVER_SCHEMA
from ..session import scratch_path, written
from ..sources import readers, writers
from . import record_sql as sql
from .inputs import lists_as_text, postings, table, texts_sql, with_ctes
from .record_inputs import BRONZE, SILVER, K, as_sql, records
from .registry import query

BRONZE_SQL, SILVER_SQL = as_sql(BRONZE), as_sql(SILVER)


def _bronze(spark, sf):
    return records(spark, sf, BRONZE)


# --- text -------------------------------------------------------------------------------------


@query("parse_experience", f"SELECT {K}, {sql.experience('experience_obj')} AS years FROM {BRONZE_SQL}")
def parse_experience(spark, sf):
    return semistructured.with_experience(_bronze(spark, sf).select(K, "experience_obj"), "experience_obj", "years").drop("experience_obj")


@query("parse_education", f"SELECT {K}, {sql.education('education_obj')} AS degree FROM {BRONZE_SQL}")
def parse_education(spark, sf):
    return semistructured.with_education(_bronze(spark, sf).select(K, "education_obj"), "education_obj", "degree").drop("education_obj")


@query("num_round_half_even", "SELECT p_partkey, round_even(p_size / 4, 1) AS quarter FROM part")
def num_round_half_even(spark, sf):
    return table(spark, sf, "part").select("p_partkey", scalars.round_half_even(F.col("p_size") / 4, 1).alias("quarter"))


LOW, HIGH = sql.salary("job_description_raw")


@query("extract_salary", f"SELECT {K}, {LOW} AS low, {HIGH} AS high FROM {BRONZE_SQL}")
def extract_salary(spark, sf):
    rows = _bronze(spark, sf).select(K, "job_description_raw")
    return text.with_salary(rows, "job_description_raw", "low", "high").select(K, "low", "high")


@query("salary_hint_text", f"SELECT {K}, {sql.hinted('job_description_raw')} AS described FROM {BRONZE_SQL}")
def salary_hint_text(spark, sf):
    rows = text.with_salary(_bronze(spark, sf).select(K, "job_description_raw"), "job_description_raw")
    return rows.select(K, text.salary_hint_text("job_description_raw", "salary_low", "salary_high").alias("described"))


@query("extract_city", f"SELECT {K}, {sql.city('job_description_raw')} AS city FROM {BRONZE_SQL}")
def extract_city(spark, sf):
    return _bronze(spark, sf).select(K, text.extract_city("job_description_raw").alias("city"))


BEFORE, AFTER = ("'" + p.replace("'", "''") + "'" for p in text.PROMPT.split("{description}"))


@query("enrichment_prompt", f"SELECT doc_id, md5({BEFORE} || text || {AFTER}) AS prompt_hash FROM documents")
def enrichment_prompt(spark, sf):
    return table(spark, sf, "documents").select("doc_id", F.md5(text.enrichment_prompt("text")).alias("prompt_hash"))


@query("clean_response", f"SELECT {K}, {sql.cleaned('response')} AS cleaned FROM {BRONZE_SQL}")
def clean_response(spark, sf):
    return _bronze(spark, sf).select(K, semistructured.clean_response("response").alias("cleaned"))


AI = ("status", "skills", "seniority_level", "tech_stack_category", "work_mode_override", "salary_min_lpa",
      "salary_max_lpa", "experience_years_min", "experience_years_max")


@query("validate_response", texts_sql(f"SELECT {K}, {', '.join(f'ai_{n} AS {n}' for n in AI)} FROM {sql.checked(BRONZE_SQL)}", "skills"))
def validate_response(spark, sf):
    rows = semistructured.with_validated(_bronze(spark, sf).select(K, "response"), "response", "checked")
    return lists_as_text(rows.select(K, "checked.*"))


SKILL_TEXT = f"""(SELECT {K}, unnest(['sql', ' PY SPARK ', 'node.js ' || o_orderstatus, 'data lake 2x', 'CI/CD', '', ' ']) AS raw FROM orders)"""


def _skill_texts(spark, sf):
    raw = F.array(F.lit("sql"), F.lit(" PY SPARK "), F.concat(F.lit("node.js "), "o_orderstatus"),
                  F.lit("data lake 2x"), F.lit("CI/CD"), F.lit(""), F.lit(" "))
    return table(spark, sf, "orders").select(K, F.explode(raw).alias("raw"))


@query("normalize_skill", f"SELECT {K}, raw, {sql.skill('raw')} AS skill FROM {SKILL_TEXT}")
def normalize_skill(spark, sf):
    return _skill_texts(spark, sf).select(K, "raw", text.normalize_skill("raw").alias("skill"))


@query("str_title_case", f"SELECT {K}, coalesce({sql.title('raw')}, '') AS titled FROM {SKILL_TEXT}")
def str_title_case(spark, sf):
    return _skill_texts(spark, sf).select(K, text.title_case("raw").alias("titled"))


def _answers(prompts):
    """A model's stand-in: names the skill the length of the prompt points to, and fails on some."""
    told = {0: RuntimeError("refused"), 3: "sorry"}
    return [told.get(len(p) % 10, '{"skills": ["s%d"]}' % (len(p) % 7)) for p in prompts]


@query("enrich_hook", texts_sql("""SELECT doc_id, CASE WHEN n % 10 = 0 THEN 'failed' WHEN n % 10 = 3 THEN 'invalid' ELSE 'ok' END AS status,
  CASE WHEN n % 10 = 0 THEN 'refused' WHEN n % 10 = 3 THEN 'sorry' END AS dead_letter, CASE WHEN n % 10 IN (0, 3) THEN [] ELSE ['s' || CAST(n % 7 AS VARCHAR)] END AS skills
FROM (SELECT doc_id, length(text) AS n FROM documents)""", "skills"))
def enrich_hook(spark, sf):
    rows = table(spark, sf, "documents").select("doc_id", F.col("text").alias("description"))
    answered = silver.enrich(rows, _answers, prompt=F.col("description"), batch_rows=10)
    checked = semistructured.with_validated(answered, "response", "checked", "response_error")
    letter = F.when(F.col("checked.status").isin("invalid", "failed"), F.coalesce("response", "response_error"))
    return lists_as_text(checked.select("doc_id", "checked.status", letter.alias("dead_letter"), "checked.skills"))


# --- first layer ------------------------------------------------------------------------------

RAW_COLUMNS = {
    "o_orderkey": K,
    "job_id": f"CASE WHEN {K} % 11 = 0 THEN NULL WHEN {K} % 13 = 0 THEN '' ELSE 'J' || CAST(({K} - {K} % 2) AS STRING) END",
    "employer_name": "'Employer ' || CAST(o_custkey AS STRING)",
    "employer_company_type": "o_orderpriority",
    "job_title": f"'Engineer ' || CAST({K} % 7 AS STRING)",
    "job_description": "'Text of ' || o_orderstatus",
    "job_city": "CAST(NULL AS STRING)",
    "job_state": "o_orderstatus",
    "job_country": "'IN'",
    "job_is_remote": f"{K} % 2 = 0",
    "job_employment_type": "'full'",
    "job_posted_at_datetime_utc": "CAST(CAST(o_orderdate AS DATE) AS STRING)",
    "job_offer_expiration_datetime_utc": "CAST(NULL AS STRING)",
    "job_min_salary": f"CAST({K} % 9 AS DOUBLE)",
    "job_max_salary": "CAST(NULL AS DOUBLE)",
    "job_salary_currency": "'INR'",
    "job_salary_period": "'YEAR'",
    "months": f"CASE WHEN {K} % 3 <> 0 THEN CAST({K} % 40 AS INT) END",
    "degree": f"CASE WHEN {K} % 4 <> 0 THEN {K} % 4 = 1 END",
}
RAW_SQL = "(SELECT " + ", ".join(f"{e} AS {n}" for n, e in RAW_COLUMNS.items()) + " FROM orders)"
RUN = {
    "pipeline_run_id": "run-1",
    "ingestion_date": "2001-06-01",
    "search_query": "data engineer",
    "created_at": "2001-06-01T00:30:00Z",
}


def _arrivals(spark, sf):
    rows = table(spark, sf, "orders").selectExpr(*[f"{e} AS {n}" for n, e in RAW_COLUMNS.items()])
    experience = F.struct(F.col("months").alias("required_experience_in_months"))
    education = F.struct(F.col("degree").alias("bachelors_degree"))
    return rows.withColumns({"job_required_experience": experience, "job_required_education": education})


NORMALIZED = """SELECT job_id AS source_job_id, employer_name AS company_name, employer_company_type AS company_sector, job_title,
  job_description AS job_description_raw, job_city AS city, job_state AS state, job_country AS country, job_is_remote AS is_remote_flag,
  job_employment_type AS employment_type, job_posted_at_datetime_utc AS posted_at, job_offer_expiration_datetime_utc AS expires_at,
  job_min_salary AS salary_min_raw, job_max_salary AS salary_max_raw, job_salary_currency AS salary_currency,
  job_salary_period AS salary_period, '{"required_experience_in_months":' || CAST(months AS VARCHAR) || '}' AS experience_obj,
  '{"bachelors_degree":' || CAST(degree AS VARCHAR) || '}' AS education_obj,
  CASE WHEN o_orderkey % 2 = 0 THEN 'JSEARCH_PRIMARY' ELSE 'JSEARCH_MEGA' END AS source_api,
  '2001-06-01T00:30:00Z' AS medallion_audit_created_at, 'run-1' AS pipeline_run_id, 'jsearch_api' AS source_system,
  '2001-06-01' AS ingestion_date, 'data engineer' AS search_query FROM """


def _host():
    return F.when(F.col(K) % 2 == 0, "JSEARCH_PRIMARY").otherwise("JSEARCH_MEGA")


@query("normalize_postings", NORMALIZED + RAW_SQL)
def normalize_postings(spark, sf):
    return bronze.normalize_postings(_arrivals(spark, sf), source_api=_host(), **RUN)


@query("ingest_bronze", NORMALIZED + f"""(SELECT * FROM {RAW_SQL} WHERE job_id <> '' AND job_id NOT IN (SELECT job_id FROM {RAW_SQL} WHERE o_orderkey % 5 = 0 AND job_id IS NOT NULL)
  QUALIFY row_number() OVER (PARTITION BY job_id ORDER BY o_orderkey % 6, o_orderkey % 2, o_orderkey) = 1)""")
def ingest_bronze(spark, sf):
    """Orders as arrivals, copies in pairs; every fifth order is stored already."""
    arrivals = _arrivals(spark, sf)
    stored = arrivals.where(f"{K} % 5 = 0").select(F.col("job_id").alias("source_job_id"))
    order = [F.col(K) % 6, F.col(K) % 2, F.col(K)]
    return bronze.ingest_bronze(arrivals, stored, order, source_api=_host(), **RUN)


# --- second layer -----------------------------------------------------------------------------


def _filled(*names):
    return "coalesce(" + ", ".join(f"nullif({n}, '')" for n in names) + ")"


BASE = f"""{_filled("source_job_id", "job_id")} AS source_job_id, {_filled("company_name", "employer_name")} AS company_name,
  {_filled("company_sector", "employer_company_type")} AS company_sector, job_title, {_filled("city", "job_city")} AS city,
  {_filled("state", "job_state")} AS state, nullif(country, '') AS country, nullif(employment_type, '') AS employment_type,
  nullif(posted_at, '') AS posted_at, nullif(expires_at, '') AS expires_at, nullif(salary_currency, '') AS salary_currency,
  nullif(salary_period, '') AS salary_period, coalesce(nullif(salary_min_raw, 0), nullif(job_min_salary, 0)) AS salary_min_raw,
  coalesce(nullif(salary_max_raw, 0), nullif(job_max_salary, 0)) AS salary_max_raw, coalesce(source_api, 'JSEARCH_PRIMARY') AS source_api"""


@query("fallback_columns", f"SELECT {BASE} FROM {BRONZE_SQL}")
def fallback_columns(spark, sf):
    return silver.fallback_columns(_bronze(spark, sf))


@query("missing_description_split", f"""SELECT {K}, {_filled("job_description_raw", "job_description")} AS description,
  CASE WHEN {_filled("job_description_raw", "job_description")} IS NULL THEN 'missing_job_description' END AS failure_reason FROM {BRONZE_SQL}""")
def missing_description_split(spark, sf):
    return silver.with_description(_bronze(spark, sf)).select(K, "description", "failure_reason")


MODE = """coalesce(nullif({0}, ''), CASE WHEN is_remote_flag THEN 'Remote' WHEN NOT is_remote_flag THEN 'Onsite' END, 'Unknown')"""


@query("work_mode_merge", f"SELECT {K}, {MODE.format('state')} AS work_mode FROM {BRONZE_SQL}")
def work_mode_merge(spark, sf):
    return _bronze(spark, sf).select(K, silver.work_mode_merge("state", "is_remote_flag").alias("work_mode"))


DESCRIBED = f"""(SELECT *, {_filled("job_description_raw", "job_description")} AS description FROM {BRONZE_SQL}
  WHERE {_filled("job_description_raw", "job_description")} IS NOT NULL)"""
D_LOW, D_HIGH = sql.salary("description")
HINTED = f"""(SELECT * EXCLUDE (description) REPLACE (
    CASE WHEN pay_low <> 0 OR pay_high <> 0 THEN pay_low ELSE salary_min_raw END AS salary_min_raw,
    CASE WHEN pay_low <> 0 OR pay_high <> 0 THEN pay_high ELSE salary_max_raw END AS salary_max_raw), description
  FROM (SELECT *, {D_LOW} AS pay_low, {D_HIGH} AS pay_high FROM {DESCRIBED}))"""


@query("build_silver", texts_sql(f"""SELECT {BASE.replace(_filled("city", "job_city") + " AS city", f"coalesce({_filled('city', 'job_city')}, {sql.city('description')}) AS city")},
  {sql.experience("experience_obj")} AS experience_years, {sql.education("education_obj")} AS degree_requirement,
  {sql.skills("ai_skills")} AS skills, ai_seniority_level AS seniority_level, ai_tech_stack_category AS tech_stack_category,
  ai_salary_min_lpa AS salary_min_lpa, ai_salary_max_lpa AS salary_max_lpa, {MODE.format("ai_work_mode_override")} AS work_mode,
  '2001-06-01' AS audit_enriched_at, 'run-1' AS audit_pipeline_run_id, 'model' AS audit_gemini_model_used,
  'high' AS audit_enrichment_confidence, ai_status AS enrichment_status
FROM {sql.checked(HINTED)}""", "skills"))
def build_silver(spark, sf):
    described = silver.with_description(_bronze(spark, sf)).where("failure_reason IS NULL")
    built = silver.build_silver(silver.with_salary_hint(described), "run-1", "2001-06-01", "model")
    return lists_as_text(reshape.flatten_struct(built, "silver_medallion_audit", "audit_"))


@query("dead_letters", f"""SELECT {_filled("source_job_id", "job_id")} AS job_id, response AS raw_response
FROM {sql.checked(BRONZE_SQL)} WHERE ai_status = 'invalid'""")
def dead_letters(spark, sf):
    return silver.dead_letters(semistructured.with_validated(_bronze(spark, sf), "response", "enriched"))


GOOD = "coalesce(failure_reason, '') = '' AND coalesce(enrichment_confidence, '') <> ''"
FAILURE = f"""CASE WHEN {_filled("job_description_raw", "job_description")} IS NULL THEN 'missing_job_description'
  WHEN ai_status = 'invalid' THEN 'gemini_enrichment_failed' END"""
STORED = _filled("source_job_id", "job_id")


@query("pending", f"""SELECT {K}, {STORED} AS id FROM {BRONZE_SQL} WHERE {STORED} IS NULL OR {STORED} NOT IN
  (SELECT source_job_id FROM {SILVER_SQL} WHERE source_job_id IS NOT NULL AND {GOOD})""")
def pending(spark, sf):
    """Postings whose id has no good row in the second layer."""
    bronze_rows = _bronze(spark, sf).select(K, "source_job_id", "job_id")
    todo = silver.pending(bronze_rows, load.quality_filter(_silver(spark, sf)).select("source_job_id"))
    return todo.select(K, bronze.stored_id(todo).alias("id"))


@query("failed_rows", f"""SELECT {K}, source_job_id, {FAILURE} AS failure_reason, 'run-1' AS pipeline_run_id, '2001-06-01' AS failed_at
FROM {sql.checked(BRONZE_SQL)} WHERE {FAILURE} IS NOT NULL""")
def failed_rows(spark, sf):
    """Postings without a description or with an unreadable response, with their reason."""
    checked = semistructured.with_validated(silver.with_description(_bronze(spark, sf)), "response", "enriched")
    failed = silver.failed_rows(silver.with_enrichment_failure(checked), "run-1", "2001-06-01")
    return failed.select(K, "source_job_id", "silver_medallion_audit.*")


# --- load -------------------------------------------------------------------------------------


def _silver(spark, sf):
    rows = records(spark, sf, SILVER)
    # Rows 2 of 4 have an empty list, rows 3 of 4 none.
    skills = F.when(F.col(K) % 4 == 2, F.array().cast("array<string>")).otherwise(F.split("skills_text", ","))
    audit = F.struct(
        "enriched_at",
        "pipeline_run_id",
        F.col("model").alias("gemini_model_used"),
        "enrichment_confidence",
        "failure_reason",
    )
    return rows.select("source_job_id", "company_name", "experience_years", skills.alias("skills"), audit.alias("silver_medallion_audit"))


FLAT = """source_job_id, company_name, experience_years, string_split(skills_text, ',') AS skills, enriched_at AS audit_enriched_at,
  pipeline_run_id AS audit_pipeline_run_id, model AS audit_gemini_model_used, enrichment_confidence AS audit_enrichment_confidence,
  failure_reason AS audit_failure_reason"""


@query("flatten_struct", texts_sql(f"SELECT {FLAT.replace('string_split', f'CASE WHEN {K} % 4 = 2 THEN [] ELSE string_split').replace(') AS skills', ') END AS skills')} FROM {SILVER_SQL}", "skills"))
def flatten_struct(spark, sf):
    return lists_as_text(reshape.flatten_struct(_silver(spark, sf), "silver_medallion_audit", "audit_"))


@query("null_empty_complex", texts_sql(f"SELECT source_job_id, string_split(skills_text, ',') AS skills FROM {SILVER_SQL}", "skills"))
def null_empty_complex(spark, sf):
    return lists_as_text(reshape.null_empty_complex(_silver(spark, sf).select("source_job_id", "skills")))


@query("quality_filter", f"SELECT source_job_id, company_name, experience_years FROM {SILVER_SQL} WHERE {GOOD}")
def quality_filter(spark, sf):
    return load.quality_filter(_silver(spark, sf)).select("source_job_id", "company_name", "experience_years")


@query("load_silver", texts_sql(f"SELECT DISTINCT {FLAT} FROM {SILVER_SQL} WHERE {GOOD} AND (source_job_id IS NULL OR o_orderkey % 5 <> 0)", "skills"))
def load_silver(spark, sf):
    """Files written, read back, and loaded behind rows that are in the table already; a second load adds nothing."""
    path = scratch_path(spark, "silver")
    writers.write_json_lines(_silver(spark, sf), f"{path}/silver_enriched_20010601_run1")
    schema = SILVER_SCHEMA.__class__(
        [f for f in SILVER_SCHEMA if f.name in ("source_job_id", "company_name", "experience_years", "skills")]
    ).add("silver_medallion_audit", AUDIT.__class__([f for f in AUDIT if f.name != "failed_at"]))
    rows = readers.scan_json_lines(spark, path, schema, "silver_enriched_")
    loaded = records(spark, sf, SILVER).where(f"{K} % 5 = 0").select("source_job_id")
    first = written(load.load_rows(rows, loaded), "loaded")
    behind = loaded.unionByName(first, allowMissingColumns=True)
    return lists_as_text(first.unionByName(load.load_rows(rows, behind)))


FETCHED = f"""SELECT 'run-1' AS run_id, '2001-06-01' AS run_date, '2001-06-01T00:30:00Z' AS dag_trigger_time, false AS dry_run_mode,
  count(*) AS jobs_fetched_total, count(*) FILTER (fresh) AS jobs_after_dedup, count(*) FILTER (fresh) AS api_requests_used,
  count(*) FILTER (fresh AND described) AS jobs_enriched_success, count(*) FILTER (fresh AND NOT described) AS jobs_enriched_failed,
  count(*) FILTER (fresh) AS gemini_calls_made, count(*) FILTER (fresh AND NOT described) AS dead_letter_count,
  count(*) FILTER (fresh AND described) AS jobs_written_to_bq, CAST(90 AS DOUBLE) AS run_duration_seconds,
  CASE WHEN count(*) FILTER (fresh AND NOT described) = 0 THEN 'SUCCESS' ELSE 'PARTIAL' END AS status, CAST(NULL AS VARCHAR) AS failed_step
FROM (SELECT {K} % 3 <> 0 AS fresh, {_filled("job_description_raw", "job_description")} IS NOT NULL AS described FROM {BRONZE_SQL})"""


def _run_counts(spark, sf):
    rows = silver.with_description(_bronze(spark, sf))
    fresh, described = F.col(K) % 3 != 0, F.col("failure_reason").isNull()
    flags = {"fetched": F.lit(True), "new": fresh, "enriched": fresh & described, "failed": fresh & ~described,
             "dead_letter": fresh & ~described, "written": fresh & described}
    return rows.select(*[c.cast("int").alias(n) for n, c in flags.items()])


def _run(spark, sf, ended_at="2001-06-01T00:31:30Z", **options):
    return load.run_metrics(_run_counts(spark, sf), "run-1", "2001-06-01", "2001-06-01T00:30:00Z", False, ended_at, **options)


@query("run_metrics", FETCHED)
def run_metrics(spark, sf):
    return _run(spark, sf)


FAILED = FETCHED.replace(FETCHED[FETCHED.index("CASE WHEN count(*)") : FETCHED.index(" AS failed_step")], "'FAILED' AS status, 'load_bq'")
RUNNING = FAILED.replace("'FAILED'", "'RUNNING'").replace("'load_bq'", "CAST(NULL AS VARCHAR)").replace("CAST(90 AS DOUBLE)", "CAST(NULL AS DOUBLE)")


@query("run_metrics_failed", FAILED)
def run_metrics_failed(spark, sf):
    """A run of which a step failed."""
    return _run(spark, sf, failed_step="load_bq")


@query("sink_run_log", f"{RUNNING} UNION ALL {FETCHED}")
def sink_run_log(spark, sf):
    """A run's row while it runs and at its end, appended to the run log."""
    path = scratch_path(spark, "run_log")
    for row in (_run(spark, sf, ended_at=None), _run(spark, sf)):
        writers.append_run_log(row, path)
    return readers.scan_json_lines(spark, path, RUN_LOG)


# --- files and tables -------------------------------------------------------------------------

PLAIN = "source_job_id, job_id, company_name, city, experience_years, skills, posted_at"
PLAIN_SQL = with_ctes("postings", f"SELECT {PLAIN} FROM postings")
FEW = ["source_job_id", "job_id", "company_name", "work_mode"]
FEW_SQL = "SELECT source_job_id, job_id, company_name, work_mode{more} FROM postings"


def _plain(spark, sf):
    return postings(spark, sf, skills=True).select(*PLAIN.split(", "))


def _few(spark, sf, *more):
    return postings(spark, sf, lines=False).select(*FEW, *more)


@query("scan_json", texts_sql(PLAIN_SQL, "skills"))
def scan_json(spark, sf):
    """Arrays of postings, beside files that are no arrays and are left out."""
    rows, path = _plain(spark, sf), scratch_path(spark, "landed")
    writers.write_json_arrays(rows, f"{path}/2001/06")
    writers.write_json_lines(rows.select("job_id", "company_name"), f"{path}/2001/07")
    return lists_as_text(readers.scan_json(spark, path, rows.schema))


@query("scan_json_ranges", texts_sql(PLAIN_SQL, "skills"))
def scan_json_ranges(spark, sf):
    """As scan_json, but each file is cut into ranges and chunks, whatever its size."""
    rows, path = _plain(spark, sf), scratch_path(spark, "landed")
    writers.write_json_arrays(rows, f"{path}/2001/06")
    writers.write_json_lines(rows.select("job_id", "company_name"), f"{path}/2001/07")
    return lists_as_text(readers.scan_json(spark, path, rows.schema, whole_below=0))


REJECTS_SQL = f"SELECT '{readers.NO_ARRAY}' AS reason, 1 AS n UNION ALL SELECT '{readers.NO_OBJECT}', count(*) FROM orders WHERE {K} % 7 = 0"


@query("scan_rejects", REJECTS_SQL)
def scan_rejects(spark, sf):
    """Every seventh item is a number or null, and one folder has lines in place of arrays, whose files count as one."""
    return _rejects(spark, sf)


@query("scan_rejects_ranges", REJECTS_SQL)
def scan_rejects_ranges(spark, sf):
    """As scan_rejects, with files read in ranges."""
    return _rejects(spark, sf, whole_below=0)


def _rejects(spark, sf, **options):
    path, rows = scratch_path(spark, "odd"), table(spark, sf, "orders").select(K)
    item = F.when(F.col(K) % 14 == 0, "null").when(F.col(K) % 7 == 0, "5").otherwise(F.to_json(F.struct(K)))
    writers.write_arrays(rows.select(item.alias("value")), f"{path}/arrays")
    writers.write_json_lines(rows, f"{path}/lines")
    counted = readers.scan_rejects(spark, path, **options).groupBy("reason").agg(F.count(F.lit(1)).alias("n"))
    n = F.when(F.col("reason") == readers.NO_ARRAY, F.least("n", F.lit(1))).otherwise(F.col("n"))
    return counted.select("reason", n.alias("n"))


@query("scan_named", texts_sql(with_ctes("postings", f"SELECT {PLAIN} FROM postings WHERE work_mode <> 'Remote'"), "skills"))
def scan_named(spark, sf):
    """Files of failed rows lie beside and are not read."""
    rows, path = postings(spark, sf, skills=True), scratch_path(spark, "named")
    names = PLAIN.split(", ")
    writers.write_json_arrays(rows.where("work_mode <> 'Remote'").select(*names), f"{path}/silver_enriched_1")
    writers.write_json_arrays(rows.where("work_mode = 'Remote'").select(*names), f"{path}/silver_failed_1")
    return lists_as_text(readers.scan_named(spark, path, rows.select(*names).schema))


@query("sink_run_partition", with_ctes("postings", FEW_SQL.format(more=", CAST(date_trunc('month', enriched_at) AS DATE) AS run_date, 'run-1' AS run_id")))
def sink_run_partition(spark, sf):
    """One partition per month; writing one year's months again changes nothing."""
    rows, path = _few(spark, sf, "enriched_at"), scratch_path(spark, "runs")
    month = F.trunc("enriched_at", "month")
    for part in (rows, rows.where(F.year("enriched_at") == 2000)):
        writers.write_run_partition(part, path, month, "run-1")
    return spark.read.parquet(path).drop("enriched_at")


@query("sink_append_evolve", with_ctes("postings", f"""SELECT source_job_id, job_id, company_name, work_mode,
  CASE WHEN work_mode = 'Remote' THEN city END AS city FROM postings"""))
def sink_append_evolve(spark, sf):
    path = scratch_path(spark, "evolving")
    writers.append_evolving(_few(spark, sf).where("work_mode <> 'Remote'"), path)
    writers.append_evolving(_few(spark, sf, "city").where("work_mode = 'Remote'"), path)
    return writers.read_evolving(spark, path)


@query("sink_table", with_ctes("postings", FEW_SQL.format(more="")))
def sink_table(spark, sf):
    path = scratch_path(spark, "table")
    name = "hirelens_" + path.rsplit("-", 1)[1]
    writers.write_table(_few(spark, sf).where("work_mode = 'Remote'"), name, path)
    writers.write_table(_few(spark, sf), name, path)
    rows = readers.scan_table(spark, name)
    spark.sql(f"DROP TABLE {name}")  # its files stay, and the rows with them
    return rows


@query("sink_view", with_ctes("postings", FEW_SQL.format(more="")))
def sink_view(spark, sf):
    writers.create_view(_few(spark, sf).where("work_mode = 'Remote'"), "hirelens_view")
    writers.create_view(_few(spark, sf), "hirelens_view")
    return readers.scan_table(spark, "hirelens_view")


@query("sink_dead_letter", f"""SELECT {K}, response, ai_status AS status, CASE WHEN ai_status = 'ok' THEN 'good' ELSE 'dead_letter' END AS outcome,
  CAST(substr(posted_at, 1, 4) AS INTEGER) AS posted_year FROM {sql.checked(BRONZE_SQL)}""")
def sink_dead_letter(spark, sf):
    """Outcomes by year; writing one year again changes nothing."""
    path = scratch_path(spark, "outcomes")
    rows = semistructured.with_validated(_bronze(spark, sf).select(K, "response", "posted_at"), "response", "checked")
    year = F.substring("posted_at", 1, 4).cast("int")
    rows = rows.select(K, "response", F.col("checked.status").alias("status"), year.alias("posted_year"))
    for part in (rows, rows.where("posted_year = 1998")):
        writers.write_by_outcome(part, F.col("status") == "ok", path, ("posted_year",))
    return spark.read.parquet(path)
