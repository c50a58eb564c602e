"""Line dedup by site-relative frequency, in DataFrame functions alone."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from driftwell.llm.store import materialise

#: What HTML text extraction replaces, in this order (pattern, replacement).
#: Each pattern reads a text once: an element or comment without an end goes on to the text's end, a tag ends before the next.
HTML_STEPS = (
    (r"(?is)<(?:script|style)\b[^<>]*>.*?(?:</(?:script|style)\s*>|\z)", ""),
    (r"(?s)<!--.*?(?:-->|\z)", ""),
    (r"(?i)</?(?:p|div|br|li|ul|ol|tr|td|th|table|h[1-6]|article|section|header|footer|nav|title|head|body|html|blockquote|pre|main|aside)\b[^<>]*>", "\n"),
    (r"<[^<>]*>", ""),
)
HTML_ENTITIES = (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&nbsp;", " "), ("&copy;", "©"), ("&middot;", "·"), ("&amp;", "&"))
HOST = r"^[A-Za-z][A-Za-z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:]+)"


def html_text(html: Column) -> Column:
    """The text of HTML: a line for each block element, without scripts, styles, comments and tags."""
    for pattern, put in HTML_STEPS:
        html = F.regexp_replace(html, pattern, put)
    for entity, put in HTML_ENTITIES:
        html = F.replace(html, F.lit(entity), F.lit(put))
    return html


def host_of(url: Column) -> Column:
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), HOST, 1))


def _raw_lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def _trimmed(line: Column) -> Column:
    return F.regexp_replace(line, r"^\s+|\s+$", "")


def _lines(text: Column) -> Column:
    return F.filter(F.transform(_raw_lines(text), _trimmed), lambda x: x != "")


def drop_boilerplate(df: DataFrame, host: Column, text: Column, ratio: float, least_pages: int, name: str = "clean", verbatim: bool = False, held_by: int = 2) -> DataFrame:
    """``df`` and a struct ``name``: host, n_lines, n_dropped, text.

    Lines are trimmed and empty ones left out; if ``verbatim``, only to compare
    and count them, and the text keeps its other lines as they are.  A line goes from all pages of a
    host if the pages that hold it, over the host's pages, are more than
    ``ratio``, and ``held_by`` pages or more hold it; hosts with fewer than
    ``least_pages`` pages lose none.  Null hosts are one host, a null text has no
    line and gets an empty one, a repeated row is a page more, an empty table
    gives an empty table.  A column ``name`` of ``df`` is replaced; columns that
    begin with two underscores are not to be given.

    A host's lost lines are at most its mean distinct lines a page over
    ``ratio``, so they fit a row.  Lines are counted by (host, digest), combined
    before the shuffle, so a hot host or line is no hot task.
    """
    host = F.coalesce(host, F.lit(""))
    pages = df.select(host.alias("host"), _lines(text).alias("lines"))
    held = pages.select("host", F.explode(F.array_distinct(F.transform("lines", lambda x: F.md5(x.cast("binary"))))).alias("line"))
    totals = pages.groupBy("host").agg(F.count("*").alias("pages")).where(F.col("pages") >= least_pages)
    counted = held.groupBy("host", "line").agg(F.count("*").alias("n")).where(F.col("n") >= held_by)
    lost = counted.join(totals, "host").where(F.col("n") / F.col("pages") > ratio)
    lost = materialise(lost.groupBy("host").agg(F.collect_list("line").alias("__lost")).withColumnRenamed("host", "__host"), "boilerplate")
    joined = df.withColumn("__host", host).join(lost, "__host", "left")
    kept = F.filter(F.col("__lines"), lambda x: F.col("__lost").isNull() | ~F.array_contains(F.coalesce("__lost", F.array().cast("array<string>")), F.md5(x.cast("binary"))))
    out = joined.withColumn("__lines", _lines(text)).withColumn("__kept", kept)
    put = F.col("__kept")
    if verbatim:
        gone = F.coalesce("__lost", F.array().cast("array<string>"))
        put = F.filter(_raw_lines(text), lambda x: ~F.array_contains(gone, F.md5(_trimmed(x).cast("binary"))))
    clean = F.struct(F.col("__host").alias("host"), F.size("__lines").cast("long").alias("n_lines"), (F.size("__lines") - F.size("__kept")).cast("long").alias("n_dropped"), F.array_join(put, "\n").alias("text"))
    return out.withColumn(name, clean).drop("__host", "__lost", "__lines", "__kept")


def op10_site_line_dedup(spark, sf_dir: str) -> DataFrame:
    """The pages' texts without the lines that over 0.3 of a host's pages hold, two of them at least."""
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", host_of(F.col("url")).alias("host"), html_text(F.col("html")).alias("text"))
    texts = materialise(pages, "page-texts")  # HTML is read once; lines are counted and cut from its text
    return drop_boilerplate(texts, F.col("host"), F.col("text"), 0.3, 2).select("page_id", "clean.*")


def clean_lines(spark, docs: DataFrame, ratio: float = 0.1, least_pages: int = 20) -> DataFrame:
    """``docs`` without lines that over ``ratio`` of a source's documents hold.

    Only documents that lose a line change, and only by those lines: indentation
    and blank lines of the rest stay.  n_chars follows the text.  A
    document that would lose every line stays as it is: a text that is copied
    as a whole is for the next stage, not boilerplate.
    """
    inner = docs.select(F.struct(*docs.columns).alias("__doc"))
    out = drop_boilerplate(inner, F.col("__doc.source"), F.col("__doc.text"), ratio, least_pages, "__clean", verbatim=True)
    lost = (F.col("__clean.n_dropped") > 0) & (F.col("__clean.n_dropped") < F.col("__clean.n_lines"))
    put = {"text": F.when(lost, F.col("__clean.text")).otherwise(F.col("__doc.text"))}
    if "n_chars" in docs.columns:
        put["n_chars"] = F.when(lost, F.length("__clean.text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("__doc.n_chars"))
    return out.select(*(put.get(c, F.col(f"__doc.`{c}`")).alias(c) for c in docs.columns))


def _sql_text(column: str) -> str:
    for pattern, put in HTML_STEPS:
        column = f"regexp_replace({column}, '{pattern}', E'{put.encode('unicode_escape').decode()}', 'g')"
    for entity, put in HTML_ENTITIES:
        quoted = put.replace("'", "''")
        column = f"replace({column}, '{entity}', '{quoted}')"
    return column


OP10_SQL = rf"""
WITH p AS (SELECT row_number() OVER () AS rid, page_id, lower(regexp_extract(coalesce(url, ''), '{HOST}', 1)) AS host,
    list_filter(list_transform(string_split(coalesce({_sql_text("html")}, ''), chr(10)), lambda x: regexp_replace(x, '^\s+|\s+$', '', 'g')), lambda x: x <> '') AS lines FROM pages),
t AS (SELECT host, count(*) AS pages FROM p GROUP BY host),
c AS (SELECT host, line, count(*) AS n FROM (SELECT host, unnest(list_distinct(lines)) AS line FROM p) GROUP BY host, line),
d AS (SELECT host, line FROM c JOIN t USING (host) WHERE n >= 2 AND n / pages > 0.3),
l AS (SELECT rid, host, generate_subscripts(lines, 1) AS pos, unnest(lines) AS line FROM p),
k AS (SELECT rid, pos, line FROM l WHERE NOT EXISTS (SELECT 1 FROM d WHERE d.host = l.host AND d.line = l.line)),
j AS (SELECT rid, count(*) AS kept, string_agg(line, chr(10) ORDER BY pos) AS text FROM k GROUP BY rid)
SELECT page_id, host, CAST(len(lines) AS BIGINT) AS n_lines, CAST(len(lines) - coalesce(kept, 0) AS BIGINT) AS n_dropped, coalesce(text, '') AS text
FROM p LEFT JOIN j USING (rid)
"""
