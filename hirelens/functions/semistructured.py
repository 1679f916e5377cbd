"""Typed reading of JSON text: experience, education and model responses."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .scalars import col, round_half_even
from .steps import computed_once
from .text import strip

_NUMBER = r"^(BIGINT|DOUBLE|FLOAT|DECIMAL.*)$"
# Levels of education, highest first, by the flag that shows them.
EDUCATION_LEVELS = {
    "postgraduate_degree": "Postgraduate",
    "bachelors_degree": "Bachelors",
    "professional_certification": "Certification",
}
NO_EDUCATION = "Not Specified"
MENTIONED_ONLY = -1.0

END_MARK = "end of the text"

TEXT_FIELDS = ("seniority_level", "tech_stack_category", "work_mode_override")
NUMBER_FIELDS = ("salary_min_lpa", "salary_max_lpa", "experience_years_min", "experience_years_max")


def _parsed(text) -> Column:
    """An object's text as a JSON list of the object and an end mark; NULL where it is no object.

    The parser stops at the end of the first value; with the mark behind, text that goes on
    after the object either breaks the list or has no mark in second place. What does not start
    as an object is not given to the parser, for which a failure is the slowest case.
    """
    text = col(text)
    is_object = F.startswith(F.ltrim(text, F.lit(" \n\r\t")), F.lit("{"))
    return F.when(is_object, F.try_parse_json(F.concat(F.lit("["), text, F.lit(f',"{END_MARK}"]'))))


def _complete(doc: Column) -> Column:
    return F.coalesce(F.try_variant_get(doc, "$[1]", "string") == END_MARK, F.lit(False))


def _type(part: Column) -> Column:
    """Type name of a part; 'VOID' where it is null or absent."""
    return F.coalesce(F.schema_of_variant(part), F.lit("VOID"))


def _field(doc: Column, name: str, kind: str = "variant") -> Column:
    return F.try_variant_get(doc, f"$[0].{name}", kind)


def _is_true(doc: Column, name: str) -> Column:
    return (_type(_field(doc, name)) == "BOOLEAN") & _field(doc, name, "boolean")


def with_experience(df: DataFrame, column: str, out: str) -> DataFrame:
    """Add the years of experience in JSON text: months / 12 to one place, half to even.

    -1 means mentioned without a number. Anything unreadable is NULL.
    """
    name = f"__{out}_doc"
    doc = F.col(name)
    kind = _type(_field(doc, "required_experience_in_months"))
    months = _field(doc, "required_experience_in_months", "double")
    years = (
        F.when(~_complete(doc), F.lit(None).cast("double"))
        .when(kind.rlike(_NUMBER) | (kind == "BOOLEAN"), round_half_even(months / 12, 1))
        .when((kind == "VOID") & _is_true(doc, "experience_mentioned"), F.lit(MENTIONED_ONLY))
    )
    return computed_once(df.withColumn(name, _parsed(column)), {out: years}).drop(name)


def with_education(df: DataFrame, column: str, out: str) -> DataFrame:
    """Add the highest level of education flagged in JSON text."""
    name = f"__{out}_doc"
    doc, level = F.col(name), F.lit(NO_EDUCATION)
    for flag, title in reversed(EDUCATION_LEVELS.items()):
        level = F.when(_is_true(doc, flag), title).otherwise(level)
    degree = F.when(_complete(doc), level).otherwise(NO_EDUCATION)
    return computed_once(df.withColumn(name, _parsed(column)), {out: degree}).drop(name)


def clean_response(c) -> Column:
    """A model's response without code fences and outer white space."""
    text = F.regexp_replace(strip(c), r"^```json", "")
    text = F.regexp_replace(text, r"^```", "")
    return strip(F.regexp_replace(text, r"```$", ""))


# Numeric text: a decimal number, infinity or no number; casts alone would also take "12f" and "0x1p3".
NUMERIC_TEXT = r"(?i)^\s*[+-]?(?:(?:\d+\.?\d*|\.\d+)(?:e[+-]?\d+)?|inf(?:inity)?|nan)\s*$"


def with_validated(df: DataFrame, response: str, out: str, error: str | None = None) -> DataFrame:
    """Add a struct (status, and the enrichment fields) of a model's response.

    status is 'ok', 'empty' (no response), 'invalid', or 'failed' where the column ``error`` has
    the text of a failed call. Fields are empty unless 'ok'. The
    types are strict: skills must be a list of texts, optional texts must be texts, and
    optional numbers may also be numeric text or true/false. Unknown keys are ignored.

    The work is done in steps, each a column that several later ones use, so that a text is
    parsed and a field read once per row.
    """
    doc, parts, ok = f"__{out}_doc", f"__{out}_parts", f"__{out}_ok"
    read = {n: f"__{out}_{n}" for n in ("skills", *TEXT_FIELDS, *NUMBER_FIELDS)}
    kinds = "struct<" + ", ".join(f"{n}: variant" for n in read) + ">"
    part = {n: F.col(parts)[n] for n in read}
    value = {n: F.col(c) for n, c in read.items()}
    sql_type = {"skills": "array<string>"} | dict.fromkeys(TEXT_FIELDS, "string") | dict.fromkeys(NUMBER_FIELDS, "double")

    kind = _type(part["skills"])
    # A list of mixed kinds has the element type VARIANT, one with null items only VOID. Joining
    # leaves nulls out unless they get a text, so the two joins differ if there is one.
    no_nulls = F.array_join(value["skills"], ",", "null") == F.array_join(value["skills"], ",")
    only_texts = (kind == "ARRAY<STRING>") & no_nulls
    no_items = (kind == "ARRAY<VOID>") & (F.size(value["skills"]) == 0)
    checks = [F.col(parts).isNotNull(), part["skills"].isNull() | only_texts | no_items]
    checks += [_type(part[n]).isin("STRING", "VOID") for n in TEXT_FIELDS]
    # Lists and objects do not become numbers; null and absent are no numbers but allowed.
    checks += [value[n].isNotNull() | (_type(part[n]) == "VOID") for n in NUMBER_FIELDS]
    checks += [(_type(part[n]) != "STRING") | F.try_variant_get(part[n], "$", "string").rlike(NUMERIC_TEXT) for n in NUMBER_FIELDS]

    steps = (
        df.withColumn(doc, _parsed(clean_response(response)))
        .withColumn(parts, F.when(_complete(F.col(doc)), F.try_variant_get(doc, "$[0]", kinds)))
        .withColumns({c: F.try_variant_get(part[n], "$", sql_type[n]) for n, c in read.items()})
        .withColumn(ok, F.coalesce(reduce(lambda a, b: a & b, checks), F.lit(False)))
    )
    good = F.col(ok)
    failed = F.lit(False) if error is None else F.col(error).isNotNull()
    status = F.when(failed, "failed").when(F.coalesce(F.col(response), F.lit("")) == "", "empty").when(good, "ok").otherwise("invalid")
    skills = F.coalesce(F.when(good, value["skills"]), F.array().cast("array<string>")).alias("skills")
    fields = [F.when(good, value[n]).alias(n) for n in (*TEXT_FIELDS, *NUMBER_FIELDS)]
    result = F.struct(status.alias("status"), skills, *fields)
    return computed_once(steps, {out: result}).drop(doc, parts, ok, *read.values())
