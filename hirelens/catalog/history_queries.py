"""Histories built from deliveries, tables of versions, and unions of tables whose columns differ in type."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import job_ref, surrogate_key
from ..operators import reshape
from ..plans import history, marts, star
from ..session import scratch_path, written
from ..sources import table_log
from .inputs import JOB_SQL, key_sql, posting_skills, stored_postings, table
from .registry import query
from .star_queries import with_ctes

DAYS = [dt.date(2001, 6, k) for k in (1, 2, 3)]
KEYS = ["job_skill_key"]


def listed(spark, sf, stored: DataFrame | None = None) -> DataFrame:
    """The jobs' skills, written once for the days that deliver of them."""
    return written(posting_skills(spark, sf, stored).select("source_job_id", "job_id", "skill"), "listed")


def delivery(rows: DataFrame, k: int) -> DataFrame:
    """What day ``k`` (1 to 3) delivers of the jobs' skills: every fourth order is missing, in turn, and levels change."""
    number = F.regexp_replace(job_ref(), "L", "").cast("bigint")
    return rows.where((number + k) % 4 != 0).select(
        surrogate_key(job_ref(), "skill").alias("job_skill_key"),
        job_ref().alias("job_id"),
        F.col("skill").alias("skill_name"),
        F.when(number % 5 == k, "new").otherwise("known").alias("level"),
    )


HISTORY = f"""SELECT job_skill_key, job_id, skill_name, level, DATE '2001-06-01' + CAST(min(k) - 1 AS INTEGER) AS valid_from,
  CASE WHEN max(k) < 3 THEN DATE '2001-06-01' + CAST(max(k) AS INTEGER) END AS valid_to
FROM (SELECT *, k - row_number() OVER (PARTITION BY job_skill_key, level ORDER BY k) AS island FROM (
  SELECT DISTINCT job_skill_key, job_id, skill_name, k, CASE WHEN number % 5 = k THEN 'new' ELSE 'known' END AS level
  FROM (SELECT {key_sql('job_id', 'skill')} AS job_skill_key, job_id, skill AS skill_name, CAST(replace(job_id, 'L', '') AS BIGINT) AS number
        FROM (SELECT {JOB_SQL} AS job_id, skill FROM listed)), (VALUES (1), (2), (3)) AS days(k)
  WHERE (number + k) % 4 <> 0))
GROUP BY job_skill_key, job_id, skill_name, level, island"""


def _merged(spark, sf, order, stored=None) -> str:
    """The place of a history to which the days were delivered in the given order."""
    place, rows = scratch_path(spark, "history"), listed(spark, sf, stored)
    for k in order:
        history.deliver(spark, place, delivery(rows, k), KEYS, DAYS[k - 1])
    return place


@query("history_build", with_ctes("listed", HISTORY))
def history_build(spark, sf):
    """All deliveries at once."""
    rows = listed(spark, sf)
    days = [delivery(rows, k).withColumn("delivered_at", F.lit(day)) for k, day in enumerate(DAYS, 1)]
    return history.build(days[2].unionAll(days[0]).unionAll(days[1]), KEYS)


@query("history_merge", with_ctes("listed", HISTORY))
def history_merge(spark, sf):
    """One delivery after the other, one of them twice."""
    return history.stored(spark, _merged(spark, sf, [1, 2, 2, 3]))


@query("history_merge_late", with_ctes("listed", HISTORY))
def history_merge_late(spark, sf):
    """The last delivery first, then the first, then the one between."""
    return history.stored(spark, _merged(spark, sf, [3, 1, 2, 3]))


@query("history_current", with_ctes("listed", f"SELECT * FROM ({HISTORY}) WHERE valid_to IS NULL"))
def history_current(spark, sf):
    return marts.current_rows(history.stored(spark, _merged(spark, sf, [1, 2, 3]), open_only=True))


@query("vw_skill_demand_history", with_ctes("listed", f"""SELECT skill_name, count(job_skill_key) AS demand_count, min(valid_from) AS first_seen,
  max(valid_from) AS last_seen FROM ({HISTORY}) WHERE valid_to IS NULL GROUP BY skill_name ORDER BY demand_count DESC, skill_name LIMIT 50"""))
def vw_skill_demand_history(spark, sf):
    return marts.vw_skill_demand(history.stored(spark, _merged(spark, sf, [2, 1, 3])))


@query(
    "vw_jobs_by_city_history",
    with_ctes(
        ("fact", "place", "listed"),
        """SELECT p.city, p.state, count(DISTINCT f.job_id) AS job_count, max(t.skill_name) AS top_skill
FROM fact f JOIN place p USING (location_key)
LEFT JOIN (SELECT location_key, skill_name FROM city_skill
           QUALIFY row_number() OVER (PARTITION BY location_key ORDER BY n DESC, skill_name) = 1) t USING (location_key)
GROUP BY p.city, p.state""",
        city_skill=f"""SELECT location_key, skill_name, count(*) AS n
FROM fact JOIN place USING (location_key) JOIN ({HISTORY}) h ON fact.job_id = h.job_id
WHERE valid_to IS NULL GROUP BY ALL""",
    ),
)
def vw_jobs_by_city_history(spark, sf):
    stg = stored_postings(spark, sf, lines=False)
    rows = history.stored(spark, _merged(spark, sf, [1, 3, 2], stg))
    return marts.vw_jobs_by_city(star.fact_job_postings(stg), star.dim_locations(stg), rows)


# --- tables of versions -----------------------------------------------------------------------


@query("sink_versions", """SELECT s_suppkey, s_name FROM supplier WHERE s_nationkey < 20""")
def sink_versions(spark, sf):
    """A table built, built anew from itself, and a rebuild that fails on its way: readers see the second version."""
    place = scratch_path(spark, "versions")
    rows = table(spark, sf, "supplier").select("s_suppkey", "s_name", "s_nationkey")
    table_log.rebuild(rows, place)
    table_log.rebuild(table_log.read(spark, place).where("s_nationkey < 20").drop("s_nationkey"), place)
    try:
        table_log.rebuild(rows.select("s_suppkey", F.raise_error(F.lit("stopped")).cast("string").alias("s_name")), place)
    except Exception as error:  # the failure is the point
        if "stopped" not in str(error):
            raise
    return table_log.read(spark, place)


@query("sink_schema_log", """SELECT CAST(c_custkey AS BIGINT) AS id, CAST(c_acctbal AS DOUBLE) AS balance, NULL AS remark FROM customer
UNION ALL SELECT s_suppkey, CAST(CAST(s_acctbal AS DECIMAL(12, 2)) AS DOUBLE), s_name FROM supplier""")
def sink_schema_log(spark, sf):
    """Appended rows with a wider number, another kind of number and a new column; the schema comes from the log."""
    place = scratch_path(spark, "schemas")
    table_log.append(table(spark, sf, "customer").selectExpr("cast(c_custkey AS int) AS id", "cast(c_acctbal AS double) AS balance"), place)
    sellers = table(spark, sf, "supplier").selectExpr("cast(s_acctbal AS decimal(12, 2)) AS balance", "cast(s_suppkey AS bigint) AS id", "s_name AS remark")
    table_log.append(sellers, place)
    return table_log.read(spark, place)


# --- unions of unlike types -------------------------------------------------------------------

SUPERSET = """SELECT '{0}' AS source_table, CAST(c_custkey AS BIGINT) AS id, CAST(c_nationkey AS VARCHAR) AS code,
  CAST(floor(c_acctbal) AS DECIMAL(13, 4)) AS balance, CAST(c_nationkey AS DOUBLE) AS share, TIMESTAMP '2001-06-01 00:00:00' AS seen, NULL AS remark FROM customer
UNION ALL SELECT '{1}', s_suppkey, 'N' || CAST(s_nationkey AS VARCHAR), CAST(s_acctbal AS DECIMAL(13, 4)), s_nationkey / 2, TIMESTAMP '2001-06-02 03:04:05', s_name FROM supplier"""


def _unlike(spark, sf):
    buyers = table(spark, sf, "customer").selectExpr(
        "cast(c_custkey AS int) AS id", "c_nationkey AS code", "cast(floor(c_acctbal) AS decimal(10, 1)) AS balance",
        "cast(c_nationkey AS int) AS share", "date '2001-06-01' AS seen",
    )
    sellers = table(spark, sf, "supplier").selectExpr(
        "cast(s_suppkey AS bigint) AS ID", "concat('N', s_nationkey) AS code", "cast(s_acctbal AS decimal(12, 4)) AS balance",
        "s_nationkey / 2 AS share", "timestamp_ntz '2001-06-02 03:04:05' AS seen", "s_name AS remark",
    )
    return {"buyers": buyers, "sellers": sellers}


@query("union_superset", SUPERSET.format("buyers", "sellers"))
def union_superset(spark, sf):
    return reshape.union_relations(_unlike(spark, sf), source_column="source_table")


@query("union_superset_turned", SUPERSET.format("buyers", "sellers").replace("AS id", 'AS "ID"'))
def union_superset_turned(spark, sf):
    """The same tables the other way round: the same types."""
    turned = dict(reversed(_unlike(spark, sf).items()))
    return reshape.union_relations(turned, source_column="source_table")
