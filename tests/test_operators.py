"""Edges of the operators on small hand-made tables: NULL, '', ties, repeats, bad values."""

import datetime as dt
import itertools
import json
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from hirelens.functions import scalars, semistructured, text, web
from hirelens.operators import checks, neighbours, reshape
from hirelens.plans import load, marts, silver, star
from hirelens.session import scratch_path
from hirelens.sources import array_ranges, readers, writers


def rows(df):
    return Counter(tuple(r) for r in df.collect())


def one(spark, value, expr, kind="string"):
    return [r[0] for r in spark.createDataFrame([(v,) for v in value], f"v {kind}").select(expr).collect()]


# --- functions --------------------------------------------------------------------------------


def test_surrogate_key_tells_null_from_blank(spark):
    df = spark.createDataFrame([("a", None), ("a", "")], "x string, y string")
    apart = {r[0] for r in df.select(scalars.surrogate_key("x", "y")).collect()}
    alike = {r[0] for r in df.select(scalars.surrogate_key("x", "y", nulls_as_empty=True)).collect()}
    assert len(apart) == 2 and len(alike) == 1


def test_haversine(spark):
    df = spark.createDataFrame([(48.864716, 2.349014, 52.379189, 4.899431)], "a double, b double, c double, d double")
    miles, km = df.select(
        scalars.haversine("a", "b", "c", "d"), scalars.haversine("a", "b", "c", "d", unit="km")
    ).first()
    assert round(miles) == 267 and round(km) == 430
    with pytest.raises(ValueError):
        scalars.haversine("a", "b", "c", "d", unit="m")


def test_is_active(spark):
    df = spark.createDataFrame(
        [
            ("2001-05-20T00:00:00Z", None, True),
            ("2001-05-20T00:00:00Z", "2001-05-31T10:00:00Z", False),
            ("2001-05-20T00:00:00Z", "2001-06-01T00:00:00Z", True),
            ("2001-04-02T00:00:00Z", None, True),
            ("2001-04-01T00:00:00Z", None, False),
            ("soon", "later", True),
            (None, None, True),
        ],
        "posted string, expires string, want boolean",
    )
    assert all(r[0] == r[1] for r in df.select("want", scalars.is_active("posted", "expires", "2001-06-01")).collect())


def test_urls(spark):
    urls = ["https://a.com/b/c?x=1&y=#f", "http://a.com?x=1", "a.com", "android-app://q/z?max_x=9", "http://a.com/", None]
    assert one(spark, urls, web.url_host("v")) == ["a.com", "a.com", "a.com", "q", "a.com", None]
    assert one(spark, urls, web.url_path("v")) == ["b/c", "", "a.com", "/q/z", "", None]
    assert one(spark, urls, web.url_parameter("v", "x")) == ["1", "1", None, "9", None, None]


def test_title_case_and_skills(spark):
    words = ["ci/cd node.js", "it's 3d", "ÉCOLE ßtraße", "", None]
    assert one(spark, words, text.title_case("v")) == ["Ci/Cd Node.Js", "It'S 3D", "École Sstraße", "", None]
    skills = [" CI/CD\n", "py spark", "golang", " sql ", " ", None]
    assert one(spark, skills, text.normalize_skill("v")) == ["CI/CD", "PySpark", "Golang", "SQL", "", ""]
    df = spark.createDataFrame([(skills,)], "s array<string>").select(text.normalize_skills("s"))
    assert df.first()[0] == ["CI/CD", "PySpark", "Golang", "SQL"]


def test_salary(spark):
    cases = {
        "CTC 12-15 LPA": (12.0, 15.0),
        "from 20 to 18.5 lakhs": (18.5, 20.0),
        "12 LPA": (12.0, 12.0),
        "9.5lakh": (9.5, 9.5),
        "ctc 8 to 4": (4.0, 8.0),
        "ctc 201": (None, None),
        "ctc 0.9": (None, None),
        "500 lpa": (500.0, 500.0),
        "5.3.7 lpa": (3.7, 3.7),
        "1 2 3 lpa": (2.0, 3.0),
        "no pay": (None, None),
        "": (None, None),
    }
    df = text.with_salary(spark.createDataFrame([(k,) for k in cases], "t string"), "t")
    assert {r["t"]: (r["salary_low"], r["salary_high"]) for r in df.collect()} == cases


def test_city(spark):
    said = ["in bengaluru or Pune", "Punekar", "NOIDA.", "Navi-Mumbai", "", None]
    assert one(spark, said, text.extract_city("v")) == ["Bengaluru", None, "Noida", "Mumbai", None, None]


def test_experience_and_education(spark):
    objects = {
        '{"required_experience_in_months": 15}': 1.2,
        '{"required_experience_in_months": 3.0}': 0.2,
        '{"required_experience_in_months": 0}': 0.0,
        '{"required_experience_in_months": null, "experience_mentioned": true}': -1.0,
        '{"experience_mentioned": "true"}': None,
        '{"required_experience_in_months": "12", "experience_mentioned": true}': None,
        '{"required_experience_in_months": 12} x': None,
        "[1]": None,
        "bad": None,
        "": None,
    }
    df = semistructured.with_experience(spark.createDataFrame([(o,) for o in objects], "v string"), "v", "years")
    assert {r["v"]: r["years"] for r in df.collect()} == objects
    levels = ['{"bachelors_degree": true, "postgraduate_degree": true}', '{"bachelors_degree": 1}', None]
    df = semistructured.with_education(spark.createDataFrame([(v,) for v in levels], "v string"), "v", "degree")
    assert [r["degree"] for r in df.collect()] == ["Postgraduate", "Not Specified", "Not Specified"]


def test_responses(spark):
    cases = [
        ('{"skills": ["a"], "salary_min_lpa": " 12.5 "}', "ok", ["a"], 12.5),
        ('```json\n{"skills": ["a"]}\n```\n', "ok", ["a"], None),
        ("{}", "ok", [], None),
        ('{"skills": []}', "ok", [], None),
        ('{"salary_min_lpa": true}', "ok", [], 1.0),
        ('{"skills": [null]}', "invalid", [], None),
        ('{"skills": ["null", null]}', "invalid", [], None),
        ('{"skills": ["null", ""]}', "ok", ["null", ""], None),
        ('{"skills": ["a", {}]}', "invalid", [], None),
        ('{"skills": {"a": 1}}', "invalid", [], None),
        ('{"skills": null}', "invalid", [], None),
        ('{"seniority_level": true}', "invalid", [], None),
        ('{"salary_min_lpa": [1]}', "invalid", [], None),
        ('{"skills": ["a"]} and more', "invalid", [], None),
        ('{"skills": ["a"]}]', "invalid", [], None),
        ('{"skills": ["a"]}, {}', "invalid", [], None),
        ("null", "invalid", [], None),
        ("   ", "invalid", [], None),
        ("", "empty", [], None),
        (None, "empty", [], None),
    ]
    df = spark.createDataFrame([(i, c[0]) for i, c in enumerate(cases)], "i int, r string")
    got = semistructured.with_validated(df, "r", "c").orderBy("i").select("c.status", "c.skills", "c.salary_min_lpa")
    assert [tuple(r) for r in got.collect()] == [c[1:] for c in cases]


# --- reshaping --------------------------------------------------------------------------------


def test_deduplicate_groups_null_keys(spark):
    df = spark.createDataFrame([(None, 1, "a"), (None, 2, "b"), (1, 1, None), (1, 0, "d")], "k int, v int, t string")
    assert rows(reshape.deduplicate(df, ["k"], [F.desc("v")])) == {(None, 2, "b"): 1, (1, 1, None): 1}


def test_pivot(spark):
    df = spark.createDataFrame([("S", "red"), ("S", "blue"), ("S", "red"), ("M", "blue's")], "size string, color string")
    got = reshape.pivot(df, ["size"], "color", prefix="is ", slug_names=True)
    assert set(got.columns) == {"size", "is_red", "is_blue", "is_blues"}
    assert {r["size"]: (r["is_red"], r["is_blue"], r["is_blues"]) for r in got.collect()} == {"S": (2, 1, 0), "M": (0, 0, 1)}
    assert reshape.slug("3 Big-Things!") == "_3_big_things"


def test_union_relations(spark):
    a = spark.createDataFrame([(1, "x")], "id int, name string")
    b = spark.createDataFrame([("red", 2)], "color string, ID2 int")
    got = reshape.union_relations({"a": a, "b": b}, exclude=["id2"])
    assert got.columns == ["_dbt_source_relation", "id", "name", "color"]
    assert rows(got) == {("a", 1, "x", None): 1, ("b", None, None, "red"): 1}
    with pytest.raises(ValueError):
        reshape.union_relations({"a": a}, include=["id"], exclude=["name"])
    with pytest.raises(ValueError):
        reshape.union_relations({"a": a}, include=["nothing"])


def test_unpivot_bool(spark):
    df = spark.createDataFrame([(1, True, 2.5)], "id int, flag boolean, n double")
    assert rows(reshape.unpivot(df, exclude=["id"])) == {(1, "flag", "true"): 1, (1, "n", "2.5"): 1}


def test_date_spine(spark):
    days = [r[0] for r in reshape.date_spine(spark, "day", "2018-01-01", "2018-01-10").collect()]
    assert days == [dt.date(2018, 1, d) for d in range(1, 10)]
    months = [r[0] for r in reshape.date_spine(spark, "month", "2024-01-31", "2024-03-15").collect()]
    assert months == [dt.date(2024, 1, 31), dt.date(2024, 2, 29)]
    assert reshape.date_spine(spark, "hour", "2024-01-01", "2024-01-02").count() == 24
    with pytest.raises(ValueError):
        reshape.date_spine(spark, "day", "2024-01-01", "2024-01-01")


def test_frequency_counts_null(spark):
    df = spark.createDataFrame([("a",), (None,), (None,)], "v string")
    assert [tuple(r) for r in reshape.frequency(df, "v").collect()] == [(None, 2), ("a", 1)]


def test_anti_join_null_ids(spark):
    new = spark.createDataFrame([("a",), ("b",), (None,), ("",)], "id string")
    seen = spark.createDataFrame([("a",), (None,), ("",)], "id string")
    for keep, want in ((True, {("b",): 1, (None,): 1, ("",): 1}), (False, {("b",): 1})):
        assert rows(reshape.anti_join_seen(new, seen, F.col("id"), F.col("id"), keep)) == want


# --- order within groups, against the plain rule ------------------------------------------------


def group_rows(seed, size):
    """Rows of which one group holds a third, with repeats and NULLs."""
    pick = random.Random(seed)
    return [(pick.choice([0, 0, 1, 2, 3, None]), pick.choice([None, *range(60)]), pick.randrange(60)) for _ in range(size)]


def ranked(v):
    return (v is not None, v)


@pytest.mark.parametrize("slices", [40, 1])
@pytest.mark.parametrize("grouped", [True, False])
def test_sequential_values(spark, slices, grouped):
    data = group_rows(1, 400)
    want = Counter()
    key = (lambda r: r[0]) if grouped else (lambda r: "all")
    for k, part in itertools.groupby(sorted(data, key=lambda r: (str(key(r)), ranked(r[1]))), key=key):
        before = None
        for i, row in enumerate(part):
            if i and row[1] is not None and before is not None and row[1] != before + 2:
                want[((k,) if grouped else ()) + (row[1], before)] += 1
            before = row[1]
    df = spark.createDataFrame(data, "g int, v int, w int")
    got = checks.sequential_values(df, "v", 2, group_by=["g"] if grouped else [], slices=slices)
    assert rows(got) == want and want


@pytest.mark.parametrize("slices", [40, 1])
@pytest.mark.parametrize("grouped", [True, False])
@pytest.mark.parametrize("gaps, zero", [("allowed", False), ("not_allowed", True), ("required", False)])
def test_mutually_exclusive_ranges(spark, slices, grouped, gaps, zero):
    data = [(g, lo, None if hi == 7 else (lo or 0) + hi % 3) for g, lo, hi in group_rows(2, 300)]
    meets = {"allowed": lambda a, b: a <= b, "not_allowed": lambda a, b: a == b, "required": lambda a, b: a < b}[gaps]
    want = Counter()
    key = (lambda r: str(r[0])) if grouped else (lambda r: "all")
    ordered = sorted(data, key=lambda r: (key(r), ranked(r[1]), ranked(r[2])))
    for _, part in itertools.groupby(ordered, key=key):
        part = list(part)
        for i, (g, lo, hi) in enumerate(part):
            last = i + 1 == len(part)
            after = None if last else part[i + 1][1]
            order = lo is not None and hi is not None and (lo <= hi if zero else lo < hi)
            line = meets(hi, after) if hi is not None and after is not None else last
            if not (order and line):
                want[((g,) if grouped else ()) + (lo, hi, after, last, order, line)] += 1
    df = spark.createDataFrame(data, "g int, lo int, hi int")
    got = checks.mutually_exclusive_ranges(df, "lo", "hi", "g" if grouped else None, gaps, zero, slices=slices)
    assert rows(got) == want


def test_repeat_rows_in_steps(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "COPIES_PER_STEP", 3)
    df = spark.createDataFrame([("a", 7), ("b", 1), ("c", 3)], "k string, n long")
    assert rows(neighbours.repeat_rows(df, "n")) == {("a",): 7, ("b",): 1, ("c",): 3}


# --- checks: one input that passes, one that fails ----------------------------------------------


def test_two_table_checks(spark):
    a = spark.createDataFrame([(1, "x"), (1, "x"), (2, None)], "k int, v string")
    b = spark.createDataFrame([(2, None), (1, "x")], "k int, v string")
    assert checks.equality(a, b).count() == 0
    assert rows(checks.equality(a, b, multiset=True)) == {("a_minus_b", 1, "x"): 1}
    assert rows(checks.cardinality_equality(a, "k", b, "k")) == {(1, 2): 1, (1, 1): 1}
    assert rows(checks.equal_rowcount(a, b)) == {(3, 2, 1): 1}
    assert rows(checks.fewer_rows_than(b, a)) == {(2, 3, 0): 1}
    # A NULL group has no partner, so it has no difference.
    grouped = checks.equal_rowcount(a, b, ["v"])
    assert rows(grouped) == {("x", "x", 2, 1, 1): 1, (None, None, 1, None, None): 1, (None, None, None, 1, None): 1}
    status = checks.summary(grouped, "equal_rowcount", error_if="> 1", warn_if="> 0").first()
    assert tuple(status) == ("equal_rowcount", 1, "warn")
    only = spark.createDataFrame([(9, "z"), (8, "z")], "k int, v string")
    # Each side's rows, and once more the difference of the sides.
    assert checks.summary(checks.equality(a, only), "equality").first()["failures"] == 4
    uneven = checks.equality(a, only.where("k = 9"))
    assert checks.summary(uneven, "equality").first()["failures"] == 4


def test_row_checks(spark):
    df = spark.createDataFrame([(1, "a"), (5, ""), (None, "  ")], "n int, t string")
    assert checks.accepted_range(df, "n", 1, 5).count() == 0
    assert checks.accepted_range(df, "n", 1, 5, inclusive=False).count() == 2
    assert checks.expression_is_true(df, "n < 5").count() == 1
    assert checks.expression_is_true(df, "> 0", column="n").count() == 0
    assert checks.not_empty_string(df, "t").count() == 2
    assert checks.not_empty_string(df, "t", trim_whitespace=False).count() == 1
    assert checks.not_null(df, "n").count() == 1
    assert checks.at_least_one(df.where("n IS NULL"), "n").count() == 1
    assert checks.at_least_one(df, "n").count() == 0
    assert checks.at_least_one(df, "n", ["t"]).count() == 1
    assert checks.not_constant(df, "n").count() == 0
    assert checks.not_constant(df.where("n = 1"), "n").first()[0] == 1
    assert checks.not_null_proportion(df, "n", 0.6).count() == 0
    assert checks.not_null_proportion(df, "n", 0.7).count() == 1
    assert checks.unique(df.unionAll(df), "n").count() == 2
    assert checks.unique_combination(df.unionAll(df), ["n", "t"]).count() == 3
    assert rows(checks.columns_match_set(df, ["N", "x"])) == {("t", None): 1, (None, "x"): 1}
    assert checks.accepted_values(df, "t", ["a", ""]).count() == 1
    assert checks.not_accepted_values(df, "t", ["b"]).count() == 0


def test_recency(spark):
    df = spark.sql("SELECT timestamp_ntz'2024-01-30 13:00:00' AS at")
    assert checks.recency(df, "at", "hour", 24, "2024-01-31 12:00:00").count() == 0
    assert checks.recency(df, "at", "hour", 22, "2024-01-31 12:00:00").count() == 1
    assert checks.recency(df, "at", "day", 1, "2024-01-31 23:00:00", ignore_time=True).count() == 0
    empty = df.where("at IS NULL")
    assert checks.recency(empty, "at", "day", 1, "2024-01-31").count() == 0


# --- pipeline -----------------------------------------------------------------------------------


def test_job_versions_fan_out(spark):
    """A job with two active versions counts once, and weighs twice in the means."""
    facts = spark.createDataFrame(
        [("1", "c", 2.0, "Remote"), ("2", "c", 5.0, "Onsite"), ("3", "c", 9.0, "Onsite")],
        "job_id string, company_key string, experience_years double, work_mode string",
    )
    jobs = spark.createDataFrame([("1", True), ("1", True), ("2", True), ("3", False)], "source_job_id string, is_active boolean")
    companies = spark.createDataFrame([("c", "C", "s")], "company_key string, company_name string, company_sector string")
    skills = spark.createDataFrame([("c", "b"), ("c", "a"), ("c", '"a"'), ("c", "b")], "company_key string, skill string")
    got = marts.mart_company_hiring(facts, companies, jobs, skills).collect()
    assert [tuple(r) for r in got] == [("C", "s", 2, "a", 3.0, 2 / 3)]


def test_fact_job_skills_versions(spark):
    jobs = spark.createDataFrame([("1", True), ("1", False)], "source_job_id string, is_active boolean")
    listed = spark.createDataFrame([("1", None, "x"), ("1", None, "x"), ("1", None, '""')], "source_job_id string, job_id string, skill string")
    assert star.fact_job_skills(listed, jobs).count() == 4
    assert [r["is_active"] for r in star.fact_job_skills(listed, jobs, dedupe=True).collect()] == [True]


def test_enrich_isolates_failures(spark):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(["a", "bad", "c", " ", None])], "i int, description string")

    def respond(prompts):
        if "bad" in prompts:
            raise RuntimeError("refused")
        return [p.upper() for p in prompts]

    got = silver.enrich(df.repartition(1), respond, prompt=F.col("description"), batch_rows=2)
    assert {r["i"]: r["response"] for r in got.collect()} == {0: None, 1: None, 2: "C", 3: None, 4: None}
    assert {r["i"] for r in got.where("response_error = 'refused'").collect()} == {0, 1}
    checked = semistructured.with_validated(got.withColumn("job_id", F.col("i").cast("string")), "response", "enriched", "response_error")
    assert rows(silver.dead_letters(checked)) == {("0", "refused"): 1, ("1", "refused"): 1, ("2", "C"): 1}


def test_enrich_takes_failures_of_single_prompts(spark):
    df = spark.createDataFrame([("a",), ("bad",), ("short",)], "description string")
    answers = {"a": "A", "bad": RuntimeError("refused"), "short": None}
    got = silver.enrich(df, lambda prompts: [answers[p] for p in prompts], prompt=F.col("description"))
    assert rows(got) == {("a", "A", None): 1, ("bad", None, "refused"): 1, ("short", None, None): 1}
    short = silver.enrich(df, lambda prompts: [], prompt=F.col("description"))
    assert short.where("response_error LIKE '0 responses%'").count() == 3


def test_pending_dedupe_keeps_rows_without_id(spark):
    stored = spark.createDataFrame([("a", 1), ("a", 0), (None, 2), (None, 3)], "source_job_id string, at int")
    done = stored.where("at > 9")
    assert silver.pending(stored, done).count() == 4
    assert rows(silver.pending(stored, done, [F.col("at")])) == {("a", 0): 1, (None, 2): 1, (None, 3): 1}


@pytest.mark.parametrize("ranges", [{}, {"whole_below": 0}, {"whole_below": 0, "chunk_bytes": 1}, {"whole_below": 20, "chunk_bytes": 7}])
def test_scan_json_skips_other_files(spark, tmp_path, ranges):
    inner = tmp_path / "2001" / "06"
    inner.mkdir(parents=True)
    (inner / "a.json").write_text('[\n  {"id": "1", "n": 2},\n  {"id": "2"}\n]')
    (inner / "object.json").write_text('{"id": "3"}')
    (inner / "broken.json").write_text('[{"id": "4"')
    (inner / "empty.json").write_text("")
    (inner / "note.dat").write_text('[{"id": "5"}]')
    (inner / "more.json").write_text('[{"id": "6"}] junk')
    (inner / "two.json").write_text('[{"id": "7"}], [{"id": "8"}]')
    (inner / "odd.json").write_text('[{"id": "9", "n": "x"}, 5, null, "{}", [1], {"id": "10", "n": 3, "z": {"y": [1]}}] ')
    (inner / "none.json").write_text(" [ \n ]\n")
    (inner / "hole.json").write_text('[{"id": "11"},,{"id": "12"}]')
    (inner / "comma.json").write_text('[{"id": "13"}],')
    (inner / "inner.json").write_text('[{"id": "14"}, {"id": "15" "n": 1}, {"id": "16"}]')
    (inner / "curly.json").write_text('[{"id": "17"}}')
    (inner / "spaces.json").write_text(" \n ")
    df = readers.scan_json(spark, str(tmp_path), star_schema(), **ranges)
    assert rows(df) == {("1", 2): 1, ("2", None): 1, ("9", None): 1, ("10", 3): 1}
    rejects = [(r["path"].rsplit("/", 1)[1], r["position"], r["reason"]) for r in readers.scan_rejects(spark, str(tmp_path), **ranges).collect()]
    whole = [(f"{name}.json", None, readers.NO_ARRAY) for name in ("broken", "comma", "curly", "hole", "inner", "more", "object", "spaces", "two")]
    assert sorted(rejects, key=str) == sorted(whole + [("odd.json", i, readers.NO_OBJECT) for i in (1, 2, 3, 4)], key=str)


def test_one_array_is_read_by_many_tasks(spark, tmp_path):
    """Texts full of marks, deep values and odd items, in ranges and chunks smaller than an item."""
    dice = random.Random(5)
    marks = ['"', "\\", "[", "]", "{", "}", ",", "é", "日本", " ", "\n", "a", '\\"', "\\\\", "],[", '{"id": "0"}']

    def text():
        return "".join(dice.choices(marks, k=dice.choice([0, 3, 40, 400])))

    items = [dice.choice([None, 5, text(), [text(), [1, {}]]]) if k % 9 == 0 else {"id": f"{k},{text()}", "n": k, "z": [text(), {"k": text()}]} for k in range(300)]
    for name, indent in (("a", None), ("b", 1)):
        (tmp_path / f"{name}.json").write_text(json.dumps(items, ensure_ascii=name == "a", indent=indent), encoding="utf-8")
    (tmp_path / "cut.json").write_text(json.dumps(items)[:-40])
    (tmp_path / "twice.json").write_text(json.dumps(items) + json.dumps(items))
    (tmp_path / "item.json").write_text(json.dumps(items).replace('"n": 200', '"n" 200'))
    set_before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        options = {"whole_below": 0, "chunk_bytes": 300}
        found = readers.scan_json(spark, str(tmp_path), star_schema(), **options)
        assert rows(found.select("id", "n")) == {(i["id"], i["n"]): 2 for i in items if isinstance(i, dict)}
        rejects = [(r["path"].rsplit("/", 1)[1], r["position"]) for r in readers.scan_rejects(spark, str(tmp_path), **options).collect()]
        odd = [(f"{name}.json", k) for name in "ab" for k, i in enumerate(items) if not isinstance(i, dict)]
        assert sorted(rejects, key=str) == sorted(odd + [(f"{n}.json", None) for n in ("cut", "twice", "item")], key=str)
        whole = readers.scan_json(spark, str(tmp_path), star_schema())
        assert rows(whole.select("id", "n")) == rows(found.select("id", "n"))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", set_before)


def test_ranges_are_cut_in_one_pass_and_parsed_once(spark, tmp_path, monkeypatch):
    """Chunks do not leave Python before they are cut: many in one batch would be a whole range."""
    plans, kept = {}, array_ranges.written
    monkeypatch.setattr(array_ranges, "written", lambda df, name: (plans.update({name: df._jdf.queryExecution().executedPlan().toString()}), kept(df, name))[1])
    (tmp_path / "a.json").write_text(json.dumps([{"id": str(k), "n": k} for k in range(90)]))
    found = readers.scan_json(spark, str(tmp_path), star_schema(), whole_below=0, chunk_bytes=50)
    assert rows(found.select("id", "n")) == {(str(k), k): 1 for k in range(90)}
    assert plans["array_pieces"].count("MapInArrow") == 1
    assert "from_json" in plans["array_items"] and "from_json" not in plans["array_broken"]


def test_ranges_are_read_once_and_again_only_where_they_begin_otherwise(spark, tmp_path, monkeypatch):
    """One reading cuts ranges that begin as they look; items are neither kept as variants nor shuffled by file."""
    made, kept = {}, array_ranges.written
    monkeypatch.setattr(array_ranges, "written", lambda df, name: (made.update({name: df}), kept(df, name))[1])
    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    options = {"whole_below": 0, "chunk_bytes": 200}
    set_before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2000")
    try:
        plain = [{"id": str(k), "n": k} for k in range(900)]
        (tmp_path / "plain.json").write_text(json.dumps(plain))
        found = readers.scan_json(spark, str(tmp_path), star_schema(), **options)
        assert rows(found.select("id", "n")) == {(i["id"], i["n"]): 1 for i in plain}
        assert sum(plan(df).count("MapInArrow") for df in made.values()) == 1 and "array_pieces_again" not in made
        assert made["array_items"].schema["item"].dataType.simpleString() == "string"
        assert "Exchange hashpartitioning" not in plan(found) and "binaryFile" not in plan(found)
        # Whole chunks within texts that look like items, and items deeper than a chunk.
        odd = [{"id": ', {"id": "x"}, [' * (k % 50), "n": k, "z": [[[list(range(90))]]]} for k in range(120)]
        (tmp_path / "plain.json").write_text(json.dumps(odd))
        found = readers.scan_json(spark, str(tmp_path), star_schema(), **options)
        assert rows(found.select("id", "n")) == {(i["id"], i["n"]): 1 for i in odd}
        assert "MapInArrow" in plan(made["array_pieces_again"])
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", set_before)


def test_tables_of_one_name_in_two_schemas(spark):
    for n, schema in enumerate(("hirelens_a", "hirelens_b"), 1):
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {schema}")
        spark.range(n).write.mode("overwrite").saveAsTable(f"{schema}.hl_ev_x")
    try:
        assert readers.tables_by_prefix(spark, "hirelens_a", "HL_ev") == ["hirelens_a.hl_ev_x"]
        both = readers.union_matching_tables(spark, "hl_ev%", "hirelens%", source_column="source_table")
        assert rows(both.groupBy("source_table").count()) == {("hirelens_a.hl_ev_x", 1): 1, ("hirelens_b.hl_ev_x", 2): 1}
    finally:
        for schema in ("hirelens_a", "hirelens_b"):
            spark.sql(f"DROP DATABASE {schema} CASCADE")


def test_neighbours_of_crowded_and_text_values(spark):
    crowd = spark.range(2000).select(F.lit("g").alias("g"), "id").unionAll(spark.sql("SELECT 'g', 1000000000000000L"))
    got = neighbours.link_values(crowd, ["g"], "id", previous="p", following="f", slices=20)
    assert got.where("p = id - 1").count() == 1999 and got.where("f IS NULL").count() == 1
    dates = spark.createDataFrame([("2001-01-01", "2001-01-05"), ("2001-01-04", "2001-01-09")], "lo string, hi string")
    assert checks.mutually_exclusive_ranges(dates, "lo", "hi").count() == 1


def star_schema():
    from pyspark.sql import types as T

    return T.StructType([T.StructField("id", T.StringType()), T.StructField("n", T.IntegerType())])


def test_json_arrays_are_bounded(spark):
    path = scratch_path(spark, "arrays")
    writers.write_json_arrays(spark.range(25).select(F.col("id").cast("string"), F.lit(1).alias("n")).coalesce(1), path, 10)
    files = spark.read.text(path, wholetext=True).select(F.size(F.from_json("value", "array<struct<id: string>>")))
    assert sorted(r[0] for r in files.collect()) == [5, 10, 10]


def test_load_twice_adds_nothing(spark):
    audit = "struct<enriched_at: string, enrichment_confidence: string, failure_reason: string>"
    data = [("1", ["a"], ("t", "high", None)), ("2", [], ("t", "", None)), ("3", [], ("t", "high", "x")), ("4", [], ("t", "high", ""))]
    df = spark.createDataFrame(data, f"source_job_id string, skills array<string>, silver_medallion_audit {audit}")
    first = load.load_rows(df)
    assert {r["source_job_id"]: r["skills"] for r in first.collect()} == {"1": ["a"], "4": None}
    assert load.load_rows(df, first).count() == 0
    nameless = spark.createDataFrame([(None, ["a"], ("t", "high", None)), (None, ["a"], ("t", "high", None)), ("1", ["b"], ("u", "high", None)),
                                      ("1", ["a"], ("t", "high", None))], df.schema)
    first = load.load_rows(nameless)
    assert {r["source_job_id"]: r["skills"] for r in first.collect()} == {None: ["a"], "1": ["b"]} and first.count() == 2
    assert load.load_rows(nameless, first).count() == 0


def test_run_partition_is_replaced(spark):
    path = scratch_path(spark, "run")
    for n in (3, 2):
        writers.write_run_partition(spark.range(n), path, "2001-06-01", "r1")
    writers.write_run_partition(spark.range(1), path, "2001-06-02", "r2")
    assert rows(spark.read.parquet(path).groupBy("run_id").count()) == {("r1", 2): 1, ("r2", 1): 1}


# --- plans --------------------------------------------------------------------------------------


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_plans_prune_and_never_multiply(spark):
    import __spark_entry__ as entry_point

    for name, query in entry_point.queries().items():
        if name.startswith(("sink_", "scan_", "load_")):
            continue
        plan = plan_of(query(spark, "/root/testdata/sf0.001"))
        assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan, name
        assert "BatchEvalPython" not in plan, name


def test_numeric_text_in_responses_is_decimal(spark):
    cases = {"12": "ok", " 1.5e1 ": "ok", "12f": "invalid", "0x1p3": "invalid", "1d": "invalid"}
    rows = [(k, '{"salary_min_lpa": "%s"}' % k) for k in cases]
    df = semistructured.with_validated(spark.createDataFrame(rows, "k string, response string"), "response", "checked")
    assert {r.k: r.status for r in df.select("k", "checked.status").collect()} == cases


def test_sequential_values_of_a_column_called_n(spark):
    df = spark.createDataFrame([(1,), (2,), (4,), (4,)], "n int")
    assert sorted(tuple(r) for r in checks.sequential_values(df, "n").collect()) == [(4, 2), (4, 4)]
