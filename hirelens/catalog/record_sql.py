"""The text rules as DuckDB expressions, for comparison."""

from __future__ import annotations

from ..functions.text import CITIES, SKILL_NAMES

NUMBER = r"(\d+(?:\.\d+)?)"
UNIT = rf"(?i)(?:ctc)?\s*{NUMBER}\s*(?:-|to)?\s*{NUMBER}?\s*(?:lpa|lakh|lakhs)"
CTC = rf"(?i)ctc\s*{NUMBER}\s*(?:-|to)?\s*{NUMBER}?"


def experience(c: str) -> str:
    doc = f"CASE WHEN json_valid({c}) THEN CAST({c} AS JSON) END"
    months = f"json_type({doc}, '$.required_experience_in_months')"
    return f"""CASE WHEN coalesce(json_type({doc}), '') <> 'OBJECT' THEN NULL
  WHEN {months} IN ('UBIGINT', 'BIGINT', 'DOUBLE') THEN
    round_even(CAST(json_extract({doc}, '$.required_experience_in_months') AS DOUBLE) / 12, 1)
  WHEN coalesce({months}, 'NULL') = 'NULL' AND json_extract_string({doc}, '$.experience_mentioned') = 'true' THEN CAST(-1 AS DOUBLE) END"""


def education(c: str) -> str:
    doc = f"CASE WHEN json_valid({c}) THEN CAST({c} AS JSON) END"

    def flag(name):
        return f"(json_type({doc}, '$.{name}') = 'BOOLEAN' AND json_extract_string({doc}, '$.{name}') = 'true')"

    return f"""CASE WHEN {flag("postgraduate_degree")} THEN 'Postgraduate' WHEN {flag("bachelors_degree")} THEN 'Bachelors'
  WHEN {flag("professional_certification")} THEN 'Certification' ELSE 'Not Specified' END"""


def salary(c: str) -> tuple[str, str]:
    """Expressions for the lower and the upper amount."""

    def number(pattern, group):
        return f"try_cast(nullif(regexp_extract({c}, '{pattern}', {group}), '') AS DOUBLE)"

    a1, a2 = number(UNIT, 1), number(CTC, 1)
    b1, b2 = f"coalesce({number(UNIT, 2)}, {a1})", f"coalesce({number(CTC, 2)}, {a2})"
    return tuple(
        f"CASE WHEN {a1} IS NOT NULL THEN {f}({a1}, {b1}) WHEN {a2} BETWEEN 1 AND 200 THEN {f}({a2}, {b2}) END"
        for f in ("least", "greatest")
    )


def hinted(c: str) -> str:
    low, high = salary(c)
    return f"""CASE WHEN ({low}) <> 0 OR ({high}) <> 0 THEN 'Extracted Salary Hint: Min ' || CAST(({low}) AS VARCHAR)
  || ' LPA, Max ' || CAST(({high}) AS VARCHAR) || ' LPA' || chr(10) || chr(10) || {c} ELSE {c} END"""


def city(c: str) -> str:
    found = f"regexp_extract({c}, '(?i)\\b({'|'.join(CITIES)})\\b', 1)"
    return f"CASE WHEN {found} <> '' THEN upper(left({found}, 1)) || lower(substr({found}, 2)) END"


def strip(c: str) -> str:
    return f"regexp_replace({c}, '^\\s+|\\s+$', '', 'g')"


def title(c: str) -> str:
    return f"""list_aggregate(list_transform(regexp_extract_all({c}, '[A-Za-z]+|[^A-Za-z]+'),
  lambda w: upper(left(w, 1)) || lower(substr(w, 2))), 'string_agg', '')"""


def skill(c: str) -> str:
    names = "MAP {" + ", ".join(f"'{k}': '{v}'" for k, v in SKILL_NAMES.items()) + "}"
    return f"coalesce({names}[lower({strip(c)})], {title(strip(c))}, '')"


def skills(c: str) -> str:
    return f"list_filter(list_transform({c}, lambda s: {skill('s')}), lambda s: s <> '')"


def cleaned(c: str) -> str:
    return strip(f"regexp_replace(regexp_replace(regexp_replace({strip(c)}, '^```json', ''), '^```', ''), '```$', '')")


def checked(source: str, response: str = "response") -> str:
    """A query over ``source`` that adds the status and fields of a response."""
    texts = ("seniority_level", "tech_stack_category", "work_mode_override")
    numbers = ("salary_min_lpa", "salary_max_lpa", "experience_years_min", "experience_years_max")

    def type_of(name):
        return f"coalesce(json_type(doc, '$.{name}'), 'NULL')"

    def value(name):
        return f"try_cast(json_extract_string(doc, '$.{name}') AS DOUBLE)"

    tests = ["json_type(doc) = 'OBJECT'"]
    tests.append(
        """(json_type(doc, '$.skills') IS NULL OR (json_type(doc, '$.skills') = 'ARRAY'
      AND len(list_filter(json_extract(doc, '$.skills[*]'), lambda x: json_type(x) <> 'VARCHAR')) = 0))"""
    )
    tests += [f"{type_of(n)} IN ('VARCHAR', 'NULL')" for n in texts]
    tests += [
        f"({type_of(n)} IN ('UBIGINT', 'BIGINT', 'DOUBLE', 'NULL') OR ({type_of(n)} = 'VARCHAR' AND {value(n)} IS NOT NULL))"
        for n in numbers
    ]
    valid = " AND ".join(tests)
    fields = [f"CASE WHEN good THEN json_extract_string(doc, '$.{n}') END AS ai_{n}" for n in texts]
    fields += [f"CASE WHEN good THEN {value(n)} END AS ai_{n}" for n in numbers]
    return f"""(SELECT *, CASE WHEN coalesce({response}, '') = '' THEN 'empty' WHEN good THEN 'ok' ELSE 'invalid' END AS ai_status,
  CASE WHEN good THEN coalesce(json_extract_string(doc, '$.skills[*]'), []) ELSE [] END AS ai_skills, {", ".join(fields)}
FROM (SELECT *, coalesce({valid}, false) AS good
  FROM (SELECT *, CASE WHEN json_valid({cleaned(response)}) THEN CAST({cleaned(response)} AS JSON) END AS doc FROM {source})))"""
