"""Pipeline records made from the orders: every kind of missing, odd and broken value by key.

Each column is one expression that Spark and DuckDB read alike, so that both see one input.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from .inputs import table

K, SIZE = "o_orderkey", "(o_custkey % 50 + 1)"


def text(expr: str) -> str:
    return f"CAST({expr} AS STRING)"


def cases(modulus: int, *values: str, otherwise: str = "NULL") -> str:
    """The n-th value where the key leaves the remainder n."""
    whens = " ".join(f"WHEN {n} THEN {v}" for n, v in enumerate(values))
    return f"CASE {K} % {modulus} {whens} ELSE {otherwise} END"


def filled(value: str, null: int | None = None, blank: int | None = None) -> str:
    """A value that is NULL or '' where the key is a multiple of the given numbers."""
    null_case = f"WHEN {K} % {null} = 0 THEN NULL " if null else ""
    blank_case = f"WHEN {K} % {blank} = 0 THEN '' " if blank else ""
    return f"CASE {null_case}{blank_case}ELSE {value} END"


S = text(SIZE)

EXPERIENCE = cases(
    16,
    "NULL",
    "'broken'",
    """'{"required_experience_in_months": null, "experience_mentioned": true}'""",
    """'{"experience_mentioned": false}'""",
    "''",
    """'{"required_experience_in_months": "12", "experience_mentioned": true}'""",
    "'[1]'",
    """'{"experience_mentioned": true}'""",
    otherwise=f"""'{{"required_experience_in_months": ' || {text(f"{SIZE} * 3")} || ', "experience_mentioned": true}}'""",
)
EDUCATION = cases(
    8,
    "NULL",
    "'broken'",
    """'{"postgraduate_degree": true, "bachelors_degree": true}'""",
    """'{"postgraduate_degree": false, "bachelors_degree": true}'""",
    """'{"professional_certification": true}'""",
    """'{"postgraduate_degree": "true"}'""",
    "'{}'",
    "''",
)
DESCRIPTION = cases(
    8,
    f"'Role with CTC ' || {S} || ' - ' || {text(SIZE + ' + 3')} || ' LPA in pune or DELHI'",
    f"'We pay ' || {S} || '.5 lakhs in Kochi'",
    f"'ctc ' || {S} || ' to ' || {text('o_custkey % 7')} || ', Bangalore'",
    f"'CTC ' || {text(SIZE + ' * 10')} || ', no unit'",
    "'Nothing named, Punekar and Mumbaikar'",
    f"{S} || ' LPA'",
    "'0 lpa, JAIPUR. Chennai'",
    "' '",
)
FENCE = "'```json' || chr(10)"
RESPONSE = cases(
    20,
    f"""'{{"skills": ["sql", " Power BI ", "node.js"], "seniority_level": "Mid", "salary_min_lpa": ' || {S} || '}}'""",
    f"""{FENCE} || '{{"skills": ["apache kafka", ""], "salary_max_lpa": 7.25}}' || chr(10) || '```'""",
    """'{"skills": ['""",
    "'[1, 2]'",
    """'{"skills": null}'""",
    """'{"skills": "sql"}'""",
    """'{"skills": ["sql", 1]}'""",
    """'{"skills": ["sql", null]}'""",
    """'{"skills": [], "seniority_level": "Lead"}'""",
    f"""'{{"salary_min_lpa": "' || {S} || '.5", "salary_max_lpa": null}}'""",
    """'{"salary_min_lpa": "many"}'""",
    """'{"skills": ["dbt"], "comment": {"a": [1]}, "work_mode_override": "Hybrid"}'""",
    "''",
    "NULL",
    """'{"seniority_level": 3}'""",
    """'{"tech_stack_category": null, "work_mode_override": "Remote"}'""",
    "'  '",
    f"""'{{"experience_years_min": ' || {S} || ', "experience_years_max": ' || {S} || '.25}}'""",
    """'  ```{"skills": ["ci/cd", "GO lang", "c++"]}```  '""",
    "'{}'",
)

BRONZE = {
    "source_job_id": filled(f"'J' || {text(K)}", null=29, blank=31),
    "job_id": filled(f"'old-' || {text(K)}", null=58),
    "company_name": filled(f"'Company ' || {text('o_custkey')}", blank=7),
    "employer_name": f"'Employer ' || {text('o_custkey')}",
    "company_sector": filled("o_orderpriority", null=5),
    "employer_company_type": filled("'sector'", blank=10),
    "job_title": filled(f"'Engineer ' || {text(K + ' % 7')}", blank=17),
    "job_description_raw": filled(DESCRIPTION, null=23, blank=19),
    "job_description": f"CASE WHEN {K} % 38 = 0 THEN 'older text, 9 lpa' END",
    "city": filled(f"'City ' || {text(K + ' % 10')}", null=3, blank=2),
    "job_city": f"CASE WHEN {K} % 9 = 0 THEN 'Old city' END",
    "state": filled("o_orderstatus", blank=4),
    "job_state": "'Old state'",
    "country": "'IN'",
    "is_remote_flag": cases(3, "NULL", "true", "false"),
    "employment_type": filled("'full'", null=6),
    "posted_at": text("CAST(o_orderdate AS DATE)"),
    "expires_at": filled(text("CAST(o_orderdate AS DATE)"), null=5, blank=8),
    "salary_min_raw": f"CAST(CASE WHEN {K} % 4 = 0 THEN 0 ELSE {SIZE} END AS DOUBLE)",
    "salary_max_raw": f"CAST(CASE WHEN {K} % 4 = 1 THEN NULL ELSE {SIZE} + 9 END AS DOUBLE)",
    "job_min_salary": f"CAST(CASE WHEN {K} % 8 <> 0 THEN {SIZE} + 100 END AS DOUBLE)",
    "job_max_salary": f"CAST({SIZE} + 200 AS DOUBLE)",
    "salary_currency": "'INR'",
    "salary_period": filled("'YEAR'", null=9),
    "experience_obj": EXPERIENCE,
    "education_obj": EDUCATION,
    "source_api": filled("'api'", null=12),
    "response": RESPONSE,
}

SILVER = {
    "source_job_id": filled(f"'J' || {text(K)}", null=29),
    "company_name": "o_orderpriority",
    "skills_text": cases(4, "'a,b'", "'c'"),
    "experience_years": f"CAST({SIZE} AS DOUBLE)",
    "enriched_at": text("CAST(o_orderdate AS DATE)"),
    "pipeline_run_id": f"'run-' || {text(K + ' % 8')}",
    "model": "'model'",
    "enrichment_confidence": filled("'high'", null=13, blank=11),
    "failure_reason": f"CASE WHEN {K} % 7 = 0 THEN 'missing' WHEN {K} % 7 = 1 THEN '' END",
}


def _select(columns: dict[str, str]) -> str:
    return ", ".join(f"{e} AS {n}" for n, e in columns.items())


def as_sql(columns: dict[str, str]) -> str:
    return f"(SELECT {K}, {_select(columns)} FROM orders)"


def records(spark: SparkSession, folder: str, columns: dict[str, str]) -> DataFrame:
    return table(spark, folder, "orders").selectExpr(K, *[f"{e} AS {n}" for n, e in columns.items()])
