"""Table operators and scalar functions over the given tables."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import scalars, web
from ..operators import reshape
from ..session import scratch_path, written
from ..sources import id_index, readers
from .inputs import table
from .registry import query


def _present(c: str, every: int, value=None):
    """A column that is NULL, or ``value``, where the key is a multiple of ``every``."""
    return F.when(F.col("o_orderkey") % every == 0, F.lit(value)).otherwise(F.col(c))


# --- selection ------------------------------------------------------------------------------


@query("star_except", 'SELECT c_custkey AS x_c_custkey, c_name AS x_c_name, c_nationkey AS x_c_nationkey, c_mktsegment AS x_c_mktsegment FROM customer')
def star_except(spark, sf):
    return reshape.star_except(table(spark, sf, "customer"), ["C_ACCTBAL"], prefix="x_")


@query("nullcheck_table", """SELECT c_custkey, c_name, c_nationkey, c_acctbal,
  CASE WHEN c_mktsegment <> 'BUILDING' THEN c_mktsegment END AS c_mktsegment FROM customer""")
def nullcheck_table(spark, sf):
    blank = F.when(F.col("c_mktsegment") == "BUILDING", "").otherwise(F.col("c_mktsegment"))
    return reshape.nullcheck_table(table(spark, sf, "customer").withColumn("c_mktsegment", blank))


@query("scan_table", "SELECT o_orderkey, o_orderpriority FROM orders")
def scan_table(spark, sf):
    return readers.scan_table(spark, f"{sf}/orders.parquet").select("o_orderkey", "o_orderpriority")


@query("in_list", "SELECT doc_id, lang, source FROM documents WHERE lang IN ('en', 'de') AND source IN ('src1', 'src2')")
def in_list(spark, sf):
    rows = table(spark, sf, "documents").select("doc_id", "lang", "source")
    return rows.where(F.col("lang").isin("en", "de") & F.col("source").isin("src1", "src2"))


# --- unions ---------------------------------------------------------------------------------

ACCOUNTS = """SELECT '{0}' AS source_table, c_custkey AS id, c_name AS label, c_nationkey AS nation, c_acctbal AS balance,
  c_mktsegment AS segment, CAST(NULL AS VARCHAR) AS remark FROM customer WHERE c_nationkey < 20
UNION ALL SELECT '{1}', s_suppkey, s_name, s_nationkey, s_acctbal, NULL, 'supplier' FROM supplier WHERE s_nationkey < 20"""


def _accounts(spark, sf):
    buyers = table(spark, sf, "customer").selectExpr(
        "c_custkey AS id", "c_name AS label", "c_nationkey AS nation", "c_acctbal AS balance", "c_mktsegment AS segment"
    )
    sellers = table(spark, sf, "supplier").selectExpr(
        "s_acctbal AS balance", "s_suppkey AS id", "s_name AS label", "s_nationkey AS nation", "'supplier' AS remark"
    )
    return buyers, sellers


@query("union_relations", ACCOUNTS.format("buyers", "sellers"))
def union_relations(spark, sf):
    buyers, sellers = _accounts(spark, sf)
    return reshape.union_relations(
        {"buyers": buyers, "sellers": sellers}, source_column="source_table", where="nation < 20"
    )


@query(
    "union_relations_override",
    """SELECT CAST(c_custkey AS VARCHAR) AS id, c_name AS label FROM customer
UNION ALL SELECT CAST(s_suppkey AS VARCHAR), s_name FROM supplier""",
)
def union_relations_override(spark, sf):
    buyers, sellers = _accounts(spark, sf)
    return reshape.union_relations(
        {"buyers": buyers, "sellers": sellers}, {"id": "string"}, include=["ID", "Label"], source_column=None
    )


@query("union_matching_tables", ACCOUNTS.format("acct_buyers", "acct_sellers"))
def union_matching_tables(spark, sf):
    buyers, sellers = _accounts(spark, sf)
    buyers.createOrReplaceTempView("acct_buyers")
    sellers.createOrReplaceTempView("acct_sellers")
    sellers.createOrReplaceTempView("acct_old")
    return readers.union_matching_tables(
        spark, "ACCT%", exclude="%_old", source_column="source_table", where="nation < 20"
    )


@query("union_all", "SELECT c_nationkey AS nation FROM customer UNION ALL SELECT s_nationkey FROM supplier")
def union_all(spark, sf):
    return table(spark, sf, "customer").selectExpr("c_nationkey AS nation").unionAll(
        table(spark, sf, "supplier").selectExpr("s_nationkey")
    )


@query("except_distinct", "SELECT l_orderkey AS id FROM lineitem EXCEPT SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R'")
def except_distinct(spark, sf):
    lines = table(spark, sf, "lineitem")
    returned = lines.where(F.col("l_returnflag") == "R").selectExpr("l_orderkey AS id")
    return lines.selectExpr("l_orderkey AS id").subtract(returned)


# --- joins ----------------------------------------------------------------------------------


@query("join_inner", "SELECT o_orderkey, c_name, c_mktsegment FROM orders JOIN customer ON o_custkey = c_custkey")
def join_inner(spark, sf):
    buyers = table(spark, sf, "customer")
    return table(spark, sf, "orders").join(buyers, F.col("o_custkey") == F.col("c_custkey")).select(
        "o_orderkey", "c_name", "c_mktsegment"
    )


@query("join_left", """SELECT o_orderkey, l_linenumber, l_quantity FROM orders LEFT JOIN lineitem
  ON o_orderkey = l_orderkey AND l_linenumber = 1""")
def join_left(spark, sf):
    first = table(spark, sf, "lineitem").where(F.col("l_linenumber") == 1)
    return table(spark, sf, "orders").join(first, F.col("o_orderkey") == F.col("l_orderkey"), "left").select(
        "o_orderkey", "l_linenumber", "l_quantity"
    )


@query("join_full", """SELECT a.k AS key_a, n_a, b.k AS key_b, n_b
FROM (SELECT o_custkey AS k, count(*) AS n_a FROM orders WHERE o_orderstatus = 'F' GROUP BY ALL) a
FULL JOIN (SELECT o_custkey AS k, count(*) AS n_b FROM orders WHERE o_orderstatus <> 'F' GROUP BY ALL) b ON a.k = b.k""")
def join_full(spark, sf):
    def counts(chosen, suffix):
        rows = table(spark, sf, "orders").where(chosen)
        return rows.groupBy(F.col("o_custkey").alias(f"key_{suffix}")).agg(F.count(F.lit(1)).alias(f"n_{suffix}"))

    finished = F.col("o_orderstatus") == "F"
    return counts(finished, "a").join(counts(~finished, "b"), F.col("key_a") == F.col("key_b"), "full")


@query("join_cross", """SELECT p.part, p.n, b.bucket, p.n * b.bucket AS weighted
FROM (SELECT l_partkey AS part, count(*) AS n FROM lineitem GROUP BY ALL) p, (SELECT unnest(range(1, 5)) AS bucket) b""")
def join_cross(spark, sf):
    """Every row with each number of a short series: a product with four fixed rows."""
    parts = table(spark, sf, "lineitem").groupBy(F.col("l_partkey").alias("part")).agg(F.count(F.lit(1)).alias("n"))
    numbered = parts.withColumn("bucket", F.explode(F.sequence(F.lit(1), F.lit(4)).cast("array<bigint>")))
    return numbered.withColumn("weighted", F.col("n") * F.col("bucket"))


@query("join_natural", """SELECT event_type, user_id, event_id, ts FROM events
NATURAL JOIN (SELECT event_type, user_id, max(event_id) AS event_id FROM events GROUP BY ALL)""")
def join_natural(spark, sf):
    """Rows that a natural join would bring back to their group: a window filter does it."""
    rows = table(spark, sf, "events").select("event_type", "user_id", "event_id", "ts")
    return reshape.deduplicate(rows, ["event_type", "user_id"], [F.desc("event_id")])


@query("orphan_rows", """SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey IS NOT NULL
  AND o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_custkey % 7 <> 0)""")
def orphan_rows(spark, sf):
    known = table(spark, sf, "customer").where("c_custkey % 7 <> 0")
    return reshape.orphan_rows(table(spark, sf, "orders").select("o_orderkey", "o_custkey"), "o_custkey", known, "c_custkey")


@query("anti_join_seen", """SELECT id, o_orderkey FROM (SELECT CASE WHEN o_orderkey % 11 = 0 THEN NULL
  WHEN o_orderkey % 13 = 0 THEN '' ELSE CAST(o_orderkey AS VARCHAR) END AS id, o_orderkey FROM orders)
WHERE id IS NULL OR id = '' OR o_orderkey % 3 <> 0""")
def anti_join_seen(spark, sf):
    key = F.col("o_orderkey")
    ident = F.when(key % 11 == 0, None).when(key % 13 == 0, "").otherwise(key.cast("string")).alias("id")
    rows = table(spark, sf, "orders").select(ident, "o_orderkey")
    seen = rows.where("o_orderkey % 3 = 0").select("id")
    return reshape.anti_join_seen(rows, seen, F.col("id"), F.col("id"), keep_null_ids=True)


@query("anti_join_indexed", """SELECT 2 AS load, id, o_orderkey FROM (SELECT CASE WHEN o_orderkey % 11 = 0 THEN NULL
  WHEN o_orderkey % 13 = 0 THEN '' ELSE CAST(o_orderkey AS VARCHAR) END AS id, o_orderkey FROM orders)
WHERE id IS NULL OR id = '' OR o_orderkey % 3 <> 0
UNION ALL SELECT 3, NULL, o_orderkey FROM orders WHERE o_orderkey % 11 = 0
UNION ALL SELECT 3, '', o_orderkey FROM orders WHERE o_orderkey % 11 <> 0 AND o_orderkey % 13 = 0""")
def anti_join_indexed(spark, sf):
    """A third of the ids in an index, then all rows loaded behind it, twice; the second time only rows without an id are new."""
    key, path = F.col("o_orderkey"), scratch_path(spark, "index")
    ident = F.when(key % 11 == 0, None).when(key % 13 == 0, "").otherwise(key.cast("string")).alias("id")
    rows = table(spark, sf, "orders").select(ident, "o_orderkey")
    id_index.create(spark, path, rows.count())
    id_index.extend(rows.where("o_orderkey % 3 = 0"), "id", path)
    second = written(id_index.unseen(rows, "id", path), "second")
    id_index.extend(second, "id", path)
    third = id_index.unseen(rows, "id", path)
    return second.select(F.lit(2).alias("load"), "*").unionByName(third.select(F.lit(3).alias("load"), "*"))


# --- aggregates -----------------------------------------------------------------------------


@query("agg_group_by_n", """SELECT l_returnflag, l_linestatus, count(*) AS n, max(l_quantity) AS most FROM lineitem GROUP BY 1, 2""")
def agg_group_by_n(spark, sf):
    rows = table(spark, sf, "lineitem").select("l_returnflag", "l_linestatus", "l_quantity")
    return reshape.group_by_first(rows, 2, F.count(F.lit(1)).alias("n"), F.max("l_quantity").alias("most"))


@query("agg_frequency", """SELECT source AS value, count(*) AS n FROM documents WHERE lang = 'en' GROUP BY source
ORDER BY n DESC, value LIMIT 5""")
def agg_frequency(spark, sf):
    return reshape.frequency(table(spark, sf, "documents"), "source", where="lang = 'en'", max_records=5)


PIVOT = "SELECT l_returnflag, " + ", ".join(
    f"CAST(sum(CASE WHEN l_linestatus = '{v}' THEN 1 ELSE 0 END) AS BIGINT) AS \"n_{n}\""
    for v, n in (("F", "F"), ("O", "O"), ("other''s", "other's"))
)


@query("agg_pivot", PIVOT + " FROM lineitem GROUP BY l_returnflag")
def agg_pivot(spark, sf):
    rows = table(spark, sf, "lineitem")
    return reshape.pivot(rows, ["l_returnflag"], "l_linestatus", ["F", "O", "other's"], prefix="n_")


# The sources that the given documents have; the query finds them by itself.
SOURCES = [f"src{k}" for k in range(20)]


@query("agg_pivot_found", "SELECT lang, " + ", ".join(
    f"count(DISTINCT CASE WHEN source = '{s}' THEN n_chars END) AS of_{s}" for s in SOURCES) + " FROM documents GROUP BY lang")
def agg_pivot_found(spark, sf):
    """The values are looked up first, the headings made plain, and distinct amounts counted."""
    return reshape.pivot(
        table(spark, sf, "documents"), ["lang"], "source", agg="count", then_value="n_chars", else_value=None, prefix="of ",
        slug_names=True, distinct=True,
    )


@query("unpivot", """SELECT s_suppkey, field_name, value FROM (
  SELECT s_suppkey, 's_nationkey' AS field_name, CAST(s_nationkey AS VARCHAR) AS value FROM supplier
  UNION ALL SELECT s_suppkey, 'balance', CAST(CAST(s_acctbal AS DECIMAL(18, 2)) AS VARCHAR) FROM supplier
  UNION ALL SELECT s_suppkey, 'in_debt', CASE WHEN s_acctbal < 0 THEN 'true' ELSE 'false' END FROM supplier)""")
def unpivot(spark, sf):
    rows = table(spark, sf, "supplier").select(
        "s_suppkey", "s_name", "s_nationkey",
        F.col("s_acctbal").cast("decimal(18,2)").alias("balance"), (F.col("s_acctbal") < 0).alias("in_debt"),
    )
    return reshape.unpivot(rows, exclude=["s_suppkey"], remove=["S_NAME"])


@query("win_deduplicate", """SELECT * FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber
  ORDER BY l_shipdate DESC, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus) = 1""")
def win_deduplicate(spark, sf):
    rows = table(spark, sf, "lineitem")
    rest = [c for c in ("l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus")]
    return reshape.deduplicate(rows, ["l_orderkey", "l_linenumber"], [F.desc("l_shipdate"), *map(F.asc, rest)])


# --- row generators -------------------------------------------------------------------------


@query("generate_series", """SELECT generated_number, count(o_orderkey) AS orders
FROM (SELECT unnest(range(1, 1501)) AS generated_number) LEFT JOIN orders ON o_custkey % 1500 + 1 = generated_number
GROUP BY ALL""")
def generate_series(spark, sf):
    """Orders per number of a series, 0 where there is none."""
    counted = table(spark, sf, "orders").groupBy((F.col("o_custkey") % 1500 + 1).alias("number")).agg(F.count(F.lit(1)).alias("n"))
    series = reshape.generate_series(spark, 1500)
    return series.join(counted, F.col("generated_number") == F.col("number"), "left").select(
        "generated_number", F.coalesce("n", F.lit(0)).alias("orders")
    )


def _events_on(spark, sf, datepart, start, end):
    spine = reshape.date_spine(spark, datepart, start, end)
    day = f"date_{datepart}"
    counted = table(spark, sf, "events").groupBy(F.to_date(F.date_trunc(datepart, "ts")).alias("at")).agg(F.count(F.lit(1)).alias("n"))
    return spine.join(counted, F.col(day) == F.col("at"), "left").select(day, F.coalesce("n", F.lit(0)).alias("events"))


@query("date_spine", """SELECT CAST(d AS DATE) AS date_day, count(event_id) AS events
FROM (SELECT unnest(range(TIMESTAMP '2023-12-25', TIMESTAMP '2024-02-01', INTERVAL 1 DAY)) AS d)
LEFT JOIN events ON CAST(ts AS DATE) = CAST(d AS DATE) GROUP BY ALL""")
def date_spine(spark, sf):
    return _events_on(spark, sf, "day", "2023-12-25", "2024-02-01")


@query("date_spine_month", """SELECT CAST(d AS DATE) AS date_month, count(event_id) AS events
FROM (SELECT unnest(range(TIMESTAMP '2023-11-01', TIMESTAMP '2024-04-01', INTERVAL 1 MONTH)) AS d)
LEFT JOIN events ON date_trunc('month', ts) = d GROUP BY ALL""")
def date_spine_month(spark, sf):
    return _events_on(spark, sf, "month", "2023-11-01", "2024-04-01")


@query("win_number_rows", """SELECT day, row_number() OVER (ORDER BY day) AS position, n
FROM (SELECT CAST(ts AS DATE) AS day, count(*) AS n FROM events GROUP BY ALL)""")
def win_number_rows(spark, sf):
    """Position of each day that has events. Days are few, so one window over the counted days is small."""
    days = table(spark, sf, "events").groupBy(F.to_date("ts").alias("day")).agg(F.count(F.lit(1)).alias("n"))
    return days.select("day", F.row_number().over(Window.orderBy("day")).cast("bigint").alias("position"), "n")


# --- arithmetic -----------------------------------------------------------------------------

AMOUNTS = """(SELECT o_orderkey, CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE o_totalprice END AS a,
  CASE WHEN o_orderkey % 5 = 0 THEN 0 WHEN o_orderkey % 11 = 0 THEN NULL ELSE o_custkey END AS b FROM orders)"""


def _amounts(spark, sf):
    divisor = F.when(F.col("o_orderkey") % 5 == 0, F.lit(0).cast("bigint")).otherwise(_present("o_custkey", 11))
    return table(spark, sf, "orders").select("o_orderkey", _present("o_totalprice", 7).alias("a"), divisor.alias("b"))


@query("safe_add", f"SELECT o_orderkey, coalesce(a, 0) + coalesce(b, 0) AS total FROM {AMOUNTS}")
def safe_add(spark, sf):
    return _amounts(spark, sf).select("o_orderkey", scalars.safe_add("a", "b").alias("total"))


@query("safe_subtract", f"SELECT o_orderkey, coalesce(a, 0) - coalesce(b, 0) - 1 AS rest FROM {AMOUNTS}")
def safe_subtract(spark, sf):
    return _amounts(spark, sf).select("o_orderkey", scalars.safe_subtract("a", "b", F.lit(1)).alias("rest"))


@query("safe_divide", f"SELECT o_orderkey, a / nullif(b, 0) AS ratio FROM {AMOUNTS}")
def safe_divide(spark, sf):
    return _amounts(spark, sf).select("o_orderkey", scalars.safe_divide("a", "b").alias("ratio"))


# Prices of every ninth order lie on a bucket's edge, and some outside the range.
PRICES = """(SELECT o_orderkey, CASE WHEN o_orderkey % 9 = 0 THEN CAST((o_orderkey % 13) * 50000 - 50000 AS DOUBLE)
  ELSE o_totalprice END AS price FROM orders)"""


def _prices(spark, sf):
    edge = ((F.col("o_orderkey") % 13) * 50000 - 50000).cast("double")
    price = F.when(F.col("o_orderkey") % 9 == 0, edge).otherwise(F.col("o_totalprice"))
    return table(spark, sf, "orders").select("o_orderkey", price.alias("price"))


@query("width_bucket", f"""SELECT o_orderkey, CASE WHEN price < 0 THEN 0 WHEN price >= 500000 THEN 11
  ELSE CAST(floor(price / 50000) AS BIGINT) + 1 END AS bucket FROM {PRICES}""")
def width_bucket(spark, sf):
    return _prices(spark, sf).select("o_orderkey", scalars.width_bucket("price", 0, 500000, 10).alias("bucket"))


@query("width_bucket_formula", f"""SELECT o_orderkey, CASE WHEN CAST(price AS DECIMAL(38, 9)) % 50000 = 0 THEN 1 ELSE 0 END
  + CAST(least(ceil(price / 50000), 11) AS BIGINT) AS bucket FROM {PRICES}""")
def width_bucket_formula(spark, sf):
    return _prices(spark, sf).select("o_orderkey", scalars.width_bucket_formula("price", 0, 500000, 10).alias("bucket"))


@query("haversine", """SELECT l_orderkey, l_linenumber, l_suppkey, round(mi, 6) AS miles, round(mi * 1.60934, 6) AS km
FROM (SELECT *, 2 * 3961 * asin(sqrt(pow(sin(radians(lat2 - lat1) / 2), 2)
    + cos(radians(lat1)) * cos(radians(lat2)) * pow(sin(radians(lon2 - lon1) / 2), 2))) AS mi
  FROM (SELECT l_orderkey, l_linenumber, l_suppkey, CAST(l_partkey % 120 - 60 AS DOUBLE) AS lat1, CAST(l_partkey % 300 - 150 AS DOUBLE) AS lon1,
    CAST(l_suppkey % 110 - 55 AS DOUBLE) AS lat2, CAST(l_suppkey % 310 - 155 AS DOUBLE) AS lon2 FROM lineitem))""")
def haversine(spark, sf):
    def degrees(key, span):
        return (F.col(key) % span - span // 2).cast("double")

    ends = (degrees("l_partkey", 120), degrees("l_partkey", 300), degrees("l_suppkey", 110), degrees("l_suppkey", 310))
    return table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_suppkey",
        F.round(scalars.haversine(*ends), 6).alias("miles"), F.round(scalars.haversine(*ends, unit="km"), 6).alias("km"),
    )


@query("timestampadd", """SELECT event_id, ts - INTERVAL 36 HOUR AS earlier, CAST(ts + INTERVAL 1 MONTH AS DATE) AS next_month FROM events""")
def timestampadd(spark, sf):
    return table(spark, sf, "events").select(
        "event_id",
        F.timestamp_add("HOUR", F.lit(-36), F.col("ts")).alias("earlier"),
        F.timestamp_add("MONTH", F.lit(1), F.col("ts")).cast("date").alias("next_month"),
    )


# --- URLs -----------------------------------------------------------------------------------

BARE = "replace(replace(url, 'http://', ''), 'https://', '')"


@query("url_host", f"SELECT page_id, split_part(split_part(replace({BARE}, 'android-app://', ''), '/', 1), '?', 1) AS host FROM pages")
def url_host(spark, sf):
    return table(spark, sf, "pages").select("page_id", web.url_host("url").alias("host"))


@query("url_path", f"""SELECT page_id, split_part(CASE WHEN instr(rest, '/') > 0 THEN substr(rest, instr(rest, '/') + 1)
  WHEN instr(rest, '?') > 0 THEN substr(rest, instr(rest, '?')) ELSE rest END, '?', 1) AS path
FROM (SELECT page_id, {BARE} AS rest FROM pages)""")
def url_path(spark, sf):
    return table(spark, sf, "pages").select("page_id", web.url_path("url").alias("path"))


PARAMETERS = ("utm_source", "page", "ref")


@query("url_parameter", "SELECT page_id, " + ", ".join(
    f"nullif(split_part(split_part(url, '{p}=', 2), '&', 1), '') AS {p}" for p in PARAMETERS) + " FROM pages")
def url_parameter(spark, sf):
    return table(spark, sf, "pages").select("page_id", *[web.url_parameter("url", p).alias(p) for p in PARAMETERS])
