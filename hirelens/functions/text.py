"""Text functions over Columns: cleaning, skills, and what a posting's free text tells."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .scalars import blank_to_null, col
from .steps import computed_once

# The cities looked for, in order.
CITIES = (
    "Bengaluru", "Bangalore", "Mumbai", "Delhi", "Hyderabad", "Pune", "Chennai", "Kolkata",
    "Gurugram", "Noida", "Ahmedabad", "Jaipur", "Bhopal", "Kochi", "Coimbatore",
)

# Lower-case skill text -> canonical name.
SKILL_NAMES = {
    "sql": "SQL",
    "etl": "ETL",
    "etl pipeline": "ETL",
    "pyspark": "PySpark",
    "py spark": "PySpark",
    "power bi": "Power BI",
    "powerbi": "Power BI",
    "ms power bi": "Power BI",
    "adf": "Azure Data Factory",
    "azure data factory": "Azure Data Factory",
    "azure databricks": "Azure Databricks",
    "databricks": "Databricks",
    "ci/cd": "CI/CD",
    "cicd": "CI/CD",
    "ml": "Machine Learning",
    "nlp": "NLP",
    "natural language processing": "NLP",
    "aws": "AWS",
    "gcp": "GCP",
    "google cloud": "GCP",
    "ms sql": "SQL Server",
    "sql server": "SQL Server",
    "mssql": "SQL Server",
    "snowflake": "Snowflake",
    "dbt": "dbt",
    "airflow": "Airflow",
    "apache airflow": "Airflow",
    "apache spark": "Spark",
    "spark": "Spark",
    "scala": "Scala",
    "kafka": "Kafka",
    "apache kafka": "Kafka",
    "delta lake": "Delta Lake",
    "data warehousing": "Data Warehousing",
    "data modeling": "Data Modeling",
    "data modelling": "Data Modeling",
}

# Amounts in lakhs per annum, with the unit behind or "ctc" in front.
# (?U) lets \d and \s cover all of Unicode.
SALARY_WITH_UNIT = r"(?iU)(?:ctc)?\s*(\d+(?:\.\d+)?)\s*(?:-|to)?\s*(\d+(?:\.\d+)?)?\s*(?:lpa|lakh|lakhs)"
SALARY_WITH_CTC = r"(?iU)ctc\s*(\d+(?:\.\d+)?)\s*(?:-|to)?\s*(\d+(?:\.\d+)?)?"
SALARY_NUMBER = r"(?U)(\d+(?:\.\d+)?)"
CTC_LOW, CTC_HIGH = 1, 200

_EDGE_SPACE = r"(?U)^\s+|\s+$"


def strip(c) -> Column:
    """Text without white space of any kind at its ends."""
    return F.regexp_replace(col(c), _EDGE_SPACE, "")


def title_case(c) -> Column:
    """Capital after every character that has no case, small letters elsewhere."""
    runs = F.regexp_extract_all(col(c), F.lit(r"([\p{Lu}\p{Ll}\p{Lt}]+|[^\p{Lu}\p{Ll}\p{Lt}]+)"), F.lit(1))
    return F.array_join(F.transform(runs, F.initcap), "")


def clean_skill(c, quotes: str = '"', trim: bool = True) -> Column:
    """A skill's text without quotation marks and outer blanks."""
    text = F.translate(col(c).cast("string"), quotes, "")
    return F.trim(text) if trim else text


def normalize_skill(c) -> Column:
    """Canonical name of a skill, else the text in title case; '' for blank and NULL."""
    names = F.create_map(*[F.lit(x) for pair in SKILL_NAMES.items() for x in pair])
    text = strip(c)
    return F.coalesce(names[F.lower(text)], title_case(text), F.lit(""))


def normalize_skills(c) -> Column:
    """Canonical names of a list of skills, without the blank ones."""
    return F.filter(F.transform(col(c), normalize_skill), lambda s: s != "")


def with_salary(df: DataFrame, description: str, low: str = "salary_low", high: str = "salary_high") -> DataFrame:
    """Add the lower and upper salary a text names, in lakhs; NULL where it names none.

    The columns are added in steps, so that a long text is searched once per pattern and the
    numbers come out of the short text found.
    """
    numbers, first, second = "__numbers", "__first", "__second"
    with_unit = blank_to_null(F.regexp_extract(description, SALARY_WITH_UNIT, 0))
    with_ctc = blank_to_null(F.regexp_extract(description, SALARY_WITH_CTC, 0))
    any_number = F.regexp_extract_all(F.coalesce(F.col("__unit"), with_ctc), F.lit(SALARY_NUMBER), F.lit(1))
    a, b = F.col(first), F.coalesce(F.col(second), F.col(first))
    trusted = F.col("__unit").isNotNull() | a.between(CTC_LOW, CTC_HIGH)
    steps = (
        df.withColumn("__unit", with_unit)
        .withColumn(numbers, any_number)
        .withColumns({first: F.get(numbers, F.lit(0)).try_cast("double"), second: F.get(numbers, F.lit(1)).try_cast("double")})
    )
    amounts = {low: F.when(trusted, F.least(a, b)), high: F.when(trusted, F.greatest(a, b))}
    return computed_once(steps, amounts).drop("__unit", numbers, first, second)


def decimal_text(c) -> Column:
    """A number as the shortest plain text with at least one decimal place."""
    text = col(c).cast("string")
    return F.when(F.contains(text, F.lit("E")), F.format_string("%.1f", col(c))).otherwise(text)


def salary_hint_text(description, low, high) -> Column:
    """The description with the salary found in it put in front; unchanged where none."""
    hint = F.concat(
        F.lit("Extracted Salary Hint: Min "),
        decimal_text(low),
        F.lit(" LPA, Max "),
        decimal_text(high),
        F.lit(" LPA\n\n"),
        col(description),
    )
    return F.when((col(low) != 0) | (col(high) != 0), hint).otherwise(col(description))


def extract_city(c) -> Column:
    """First known city named as a whole word, in title case; NULL where none."""
    pattern = r"(?iU)\b(" + "|".join(CITIES) + r")\b"
    return F.initcap(blank_to_null(F.regexp_extract(col(c), pattern, 1)))


def enrichment_prompt(description, template: str | None = None) -> Column:
    """The request for the enrichment model: template text around the description."""
    before, _, after = (template or PROMPT).partition("{description}")
    return F.concat(F.lit(before), col(description), F.lit(after))


PROMPT = """Read the job posting below and answer with one JSON object and nothing else.
Keys:
  skills: list of skill names found in the posting
  seniority_level: Junior, Mid, Senior, Lead or Principal
  tech_stack_category: Data Platform, MLOps, BI & Analytics, Data Science, Cloud Infrastructure or Other
  work_mode_override: Remote, Hybrid or Onsite if the posting says so, otherwise null
  salary_min_lpa, salary_max_lpa: salary in lakhs per annum if given, otherwise null
  experience_years_min, experience_years_max: years of experience if given, otherwise null

Posting:
{description}
"""
