"""Operator 7: licence scans by sparse TF-IDF cosine, and inheritance from the nearest ancestor folder.

Only DataFrame functions. Of a text that has a cue word four kinds of pieces are compared: lines and paragraphs with a
cue word, its head, and the text as a whole; equal pieces are one row until the end. Pieces and templates
are sparse vectors of terms, which meet in an equi-join on the term. Files without a licence of their own take that of
the nearest folder above them that has a licence file, by joins on the path.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import prepare, written
from .licence_templates import TEMPLATES, Template

CUES = r"(?i)licen[cs]e|copyright|spdx|public domain|warrant(y|ies)|creative commons|redistribution"
LEAST = 0.5
# A licence file is one by its whole text or its first paragraph, or by its name if anything in it matches.
FILE_LEAST = 0.8
FILE_NAMES = r"(?i)(^|/)(licen[cs]es?|copying|unlicen[cs]e)([._-][^/]*)?$"
PARAGRAPHS = r"\n[ \t\r]*\n"


def terms_of(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit("([a-z0-9]+)"))


def _vectors(terms: DataFrame, idf: DataFrame, *key: str) -> DataFrame:
    """(key, term, weight) with unit length, from (key, term, tf)."""
    weighted = terms.join(idf, "term").withColumn("weight", F.col("tf") * F.col("idf"))
    norm = weighted.groupBy(*key).agg(F.sqrt(F.sum(F.col("weight") * F.col("weight"))).alias("norm"))
    return weighted.join(norm, list(key)).select(*key, "term", (F.col("weight") / F.col("norm")).alias("weight"))


def pieces(files: DataFrame, cues: str = CUES) -> DataFrame:
    """(path, kind, key, piece) of each text with a cue word.

    Kinds: ``line``, ``block`` (a paragraph of several lines), ``head`` (the first paragraph with a letter or digit, and the
    first two) and ``whole``, each only with a cue word of its own. Equal pieces of one kind in a text are one row.
    """
    told = files.where(F.col("text").rlike(cues))
    paragraphs = F.split("text", PARAGRAPHS)
    lines = F.filter(F.split("text", "\n"), lambda x: x.rlike(cues))
    blocks = F.filter(paragraphs, lambda x: x.contains("\n") & x.rlike(cues))
    filled = F.filter(paragraphs, lambda x: x.rlike("[A-Za-z0-9]"))
    first = F.filter(F.transform(F.array(F.lit(1), F.lit(2)), lambda k: F.array_join(F.slice(filled, 1, k), "\n\n")), lambda x: x.rlike(cues))
    named = [("line", lines), ("block", blocks), ("head", first), ("whole", F.array("text"))]
    kinds = F.array(*[F.struct(F.lit(kind).alias("kind"), F.array_distinct(found).alias("found")) for kind, found in named])
    rows = told.select("path", F.inline(kinds)).select("path", "kind", F.explode("found").alias("piece"))
    return rows.select("path", "kind", F.md5("piece").alias("key"), "piece")


def match_pieces(rows: DataFrame, templates: DataFrame, least: float) -> DataFrame:
    """(key, licence, title, similarity): the best template of each piece, of equal ones the first by name.

    ``title`` says whether the template is the title of a licence text. Rarity of a term is counted over all pieces and
    the templates.
    """
    distinct = rows.groupBy("key").agg(F.first("piece").alias("piece"), F.count(F.lit(1)).alias("n"))
    piece_terms = distinct.select("key", "n", F.explode(terms_of(F.col("piece"))).alias("term"))
    piece_terms = piece_terms.groupBy("key", "term").agg(F.count(F.lit(1)).alias("tf"), F.first("n").alias("n"))
    name = ["licence", "title", "number"]
    template_terms = templates.select(*name, F.explode(terms_of(F.col("template"))).alias("term"))
    template_terms = template_terms.groupBy(*name, "term").agg(F.count(F.lit(1)).alias("tf"))
    total = rows.agg(F.count(F.lit(1)).alias("n")).unionAll(templates.agg(F.count(F.lit(1)).alias("n"))).agg(F.sum("n").alias("total"))
    seen = piece_terms.select("term", "n").unionAll(template_terms.select("term", F.lit(1).cast("long").alias("n")))
    counts = seen.groupBy("term").agg(F.sum("n").alias("df"))
    # Only terms of templates can meet; the others count in the lengths alone.
    idf = counts.select("term", (F.log((total.scalar() + 1) / (F.col("df") + 1)) + 1).alias("idf"))
    a = _vectors(piece_terms.select("key", "term", "tf"), idf, "key")
    b = _vectors(template_terms, idf, *name).withColumnRenamed("weight", "other")
    cosine = a.join(b, "term").groupBy("key", *name).agg(F.sum(F.col("weight") * F.col("other")).alias("cosine"))
    rounded = cosine.select("key", *name, F.round("cosine", 4).alias("similarity")).where(F.col("similarity") >= least)
    best = rounded.groupBy("key").agg(F.min(F.struct((-F.col("similarity")).alias("s"), "licence", "title")).alias("b"))
    return best.select("key", F.col("b.licence").alias("licence"), F.col("b.title").alias("title"), (-F.col("b.s")).alias("similarity"))


def template_rows(spark: SparkSession, templates: list[Template]) -> DataFrame:
    """(licence, title, template, number) of templates given as (licence, kind, text)."""
    rows = [
        F.struct(F.lit(licence).alias("licence"), F.lit(kind == "title").alias("title"), F.lit(text).alias("template"), F.lit(k).alias("number"))
        for k, (licence, kind, text) in enumerate(templates)
    ]
    return spark.range(1).select(F.inline(F.array(*rows)))


def texts_below(spark: SparkSession, folder: str) -> DataFrame:
    """Templates from a folder of whole licence texts, each named by its file: more rows for ``scan(extra=...)``."""
    texts = spark.read.text(folder, wholetext=True)
    name = F.regexp_replace(F.col("_metadata.file_name"), r"\.(txt|md)$", "")
    return texts.select(name.alias("licence"), F.lit(False).alias("title"), F.col("value").alias("template"), F.lit(-1).alias("number"))


def scan(
    files: DataFrame, templates: list[Template] = TEMPLATES, least: float = LEAST, file_least: float = FILE_LEAST, extra: DataFrame | None = None
) -> DataFrame:
    """(path, licence, similarity, origin, licence_folder) of every path in ``files`` (path, text).

    ``origin`` is header (a piece of the text matches a template), inherited (the nearest folder above has a licence
    file) or none. A file is its folder's licence file if its whole text is similar to a template by ``file_least``, if
    its head is so to the title of a licence text, or if its name says so and any piece matches. What makes a
    file a licence file outranks its other pieces; then the most similar piece counts, then the first licence by name; of
    several licence files of a folder likewise, then the smallest path. ``extra`` are more templates, such as those of
    :func:`texts_below`. Null and empty texts have no pieces. Rows with one path are one file; null paths are left out.
    Other columns are not read.
    """
    spark = prepare(files.sparkSession)
    files = files.select("path", "text").where(F.col("path").isNotNull())
    found = written(pieces(files), "licence_pieces")
    known = template_rows(spark, templates)
    verdict = match_pieces(found, known if extra is None else known.unionByName(extra), least)
    matched = found.select("path", "kind", "key").join(verdict, "key")
    by_text = ((F.col("kind") == "whole") | ((F.col("kind") == "head") & F.col("title"))) & (F.col("similarity") >= file_least)
    matched = matched.select("path", "licence", "similarity", by_text.alias("by_text"))
    own = matched.groupBy("path").agg(F.min(F.struct((~F.col("by_text")).alias("l"), (-F.col("similarity")).alias("s"), "licence")).alias("b"))
    is_file = ~F.col("b.l") | F.col("path").rlike(FILE_NAMES)
    own = own.select("path", F.col("b.licence").alias("licence"), (-F.col("b.s")).alias("similarity"), is_file.alias("is_file"))
    # Used three times below; Spark does not always find that the matching under it is the same.
    own = written(own, "licence_own")
    folder = F.regexp_extract("path", "^(.*)/[^/]*$", 1)
    folders = own.where("is_file").withColumn("folder", folder).groupBy("folder").agg(
        F.min(F.struct((-F.col("similarity")).alias("s"), "licence", "path")).alias("b")
    )
    folders = folders.select("folder", F.col("b.licence").alias("from_licence"), (-F.col("b.s")).alias("from_similarity"))
    paths = files.select("path").distinct().join(own.drop("is_file"), "path", "left")
    steps = F.split("path", "/")
    above = F.transform(F.sequence(F.lit(1), F.size(steps) - 1), lambda k: F.array_join(F.slice(steps, 1, k), "/"))
    orphans = paths.where(F.col("licence").isNull() & F.col("path").contains("/"))
    asked = orphans.select("path", F.posexplode(above).alias("depth", "folder"))
    nearest = asked.join(folders, "folder").groupBy("path").agg(
        F.max(F.struct("depth", "folder", "from_licence", "from_similarity")).alias("b")
    )
    inherited = nearest.select(
        "path", F.col("b.from_licence").alias("i_licence"), F.col("b.from_similarity").alias("i_similarity"), F.col("b.folder").alias("licence_folder")
    )
    out = paths.join(inherited, "path", "left")
    origin = F.when(F.col("licence").isNotNull(), "header").when(F.col("i_licence").isNotNull(), "inherited").otherwise("none")
    return out.select(
        "path", F.coalesce("licence", "i_licence").alias("licence"),
        F.coalesce("similarity", "i_similarity").alias("similarity"), origin.alias("origin"), "licence_folder",
    )


def document_path() -> Column:
    """Documents as files: source/language/hundred/id; without an id the digest of the text stands for it."""
    number = F.col("doc_id").cast("string")
    hundred = F.coalesce(F.floor(F.col("doc_id") / 100).cast("string"), F.lit("_"))
    name = F.coalesce(number, F.md5(F.coalesce("text", F.lit(""))))
    return F.concat_ws("/", F.coalesce("source", F.lit("_")), F.coalesce("lang", F.lit("_")), hundred, name)


def documents_licences(docs: DataFrame) -> DataFrame:
    """doc_id and the columns of :func:`scan`, one row for each row of ``docs``.

    Rows with one source, language and id are one file and share its verdict; rows without an id go by their text. Null
    and empty texts have no header of their own; long texts are searched whole; an empty table gives no rows. Other columns
    are not read.
    """
    files = docs.select("doc_id", document_path().alias("path"), "text")
    found = scan(files)
    return files.select("doc_id", "path").join(found, "path").select("doc_id", *found.columns)


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


_TEMPLATE_SQL = ", ".join(f"({_quoted(n)}, {kind == 'title'}, {_quoted(text)}, {k})" for k, (n, kind, text) in enumerate(TEMPLATES))
ORACLE = f"""WITH files AS (
  SELECT concat_ws('/', coalesce(source, '_'), coalesce(lang, '_'), coalesce(CAST(CAST(floor(doc_id / 100) AS BIGINT) AS VARCHAR), '_'),
    coalesce(CAST(doc_id AS VARCHAR), md5(coalesce(text, '')))) AS path, doc_id, text FROM documents),
t AS (SELECT * FROM (VALUES {_TEMPLATE_SQL}) v(licence, title, template, number)),
told AS (SELECT path, text, regexp_split_to_array(text, '{PARAGRAPHS}') AS paragraphs FROM files WHERE regexp_matches(text, '{CUES}')),
rows AS (SELECT path, kind, md5(piece) AS key, piece FROM (
    SELECT DISTINCT path, 'line' AS kind, unnest(string_split(text, chr(10))) AS piece FROM told
    UNION ALL SELECT DISTINCT path, 'block', unnest([x FOR x IN paragraphs IF contains(x, chr(10))]) FROM told
    UNION ALL SELECT DISTINCT path, 'head', array_to_string(([x FOR x IN paragraphs IF regexp_matches(x, '[A-Za-z0-9]')])[1:k], chr(10) || chr(10))
      FROM told, (VALUES (1), (2)) heads(k)
    UNION ALL SELECT path, 'whole', text FROM told) WHERE regexp_matches(piece, '{CUES}')),
d AS (SELECT key, first(piece) AS piece, count(*) AS n FROM rows GROUP BY key),
lt AS (SELECT key, term, count(*) AS tf, first(n) AS n FROM (SELECT key, n, unnest(regexp_extract_all(lower(piece), '[a-z0-9]+')) AS term FROM d) GROUP BY key, term),
tt AS (SELECT licence, title, number, term, count(*) AS tf
  FROM (SELECT licence, title, number, unnest(regexp_extract_all(lower(template), '[a-z0-9]+')) AS term FROM t) GROUP BY ALL),
total AS (SELECT (SELECT count(*) FROM rows) + (SELECT count(*) FROM t) AS total),
idf AS (SELECT term, ln((any_value(total) + 1) / (sum(n) + 1)) + 1 AS idf FROM (SELECT term, n FROM lt UNION ALL SELECT term, 1 FROM tt), total GROUP BY term),
a AS (SELECT key, term, tf * idf AS w FROM lt JOIN idf USING (term)),
b AS (SELECT licence, title, number, term, tf * idf AS w FROM tt JOIN idf USING (term)),
na AS (SELECT key, sqrt(sum(w * w)) AS norm FROM a GROUP BY key),
nb AS (SELECT number, sqrt(sum(w * w)) AS norm FROM b GROUP BY number),
cosine AS (SELECT key, licence, title, number, round(sum(a.w / na.norm * (b.w / nb.norm)), 4) AS similarity
  FROM a JOIN b USING (term) JOIN na USING (key) JOIN nb USING (number) GROUP BY ALL),
verdict AS (SELECT key, licence, title, similarity FROM cosine WHERE similarity >= {LEAST}
  QUALIFY row_number() OVER (PARTITION BY key ORDER BY similarity DESC, licence, title) = 1),
matched AS (SELECT path, licence, similarity, (kind = 'whole' OR (kind = 'head' AND title)) AND similarity >= {FILE_LEAST} AS by_text
  FROM rows JOIN verdict USING (key)),
own AS (SELECT path, licence, similarity, by_text OR regexp_matches(path, '{FILE_NAMES}') AS is_file FROM matched
  QUALIFY row_number() OVER (PARTITION BY path ORDER BY by_text DESC, similarity DESC, licence) = 1),
folders AS (SELECT regexp_extract(path, '^(.*)/[^/]*$', 1) AS folder, licence, similarity FROM own WHERE is_file
  QUALIFY row_number() OVER (PARTITION BY folder ORDER BY similarity DESC, licence, path) = 1),
inherited AS (SELECT f.path, g.licence, g.similarity, g.folder FROM files f JOIN folders g ON starts_with(f.path, g.folder || '/')
  QUALIFY row_number() OVER (PARTITION BY f.path ORDER BY length(g.folder) DESC) = 1)
SELECT f.doc_id, f.path, coalesce(o.licence, i.licence) AS licence, coalesce(o.similarity, i.similarity) AS similarity,
  CASE WHEN o.licence IS NOT NULL THEN 'header' WHEN i.licence IS NOT NULL THEN 'inherited' ELSE 'none' END AS origin,
  CASE WHEN o.licence IS NULL THEN i.folder END AS licence_folder
FROM files f LEFT JOIN own o USING (path) LEFT JOIN inherited i USING (path)"""
