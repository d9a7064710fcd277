"""Registered queries: feeds landed from documents (S1-S4, F5, F7, F9) and the
full-page override (J4)."""

from __future__ import annotations

from pyspark.sql import functions as F

from gazette import config as C
from gazette.functions.dates import iso_text
from gazette.plans.common import RUN_TS_SQL, normalise, sql_element, sql_strip, sql_text, table
from gazette.sources import feeds as FD

QUERIES = {}
ORACLES = {}


def register(name, sql=None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return deco


B = FD.FEED_BLOCK
_LINES = f"array_to_string(list_filter(list_transform(string_split(text, chr(10)), lambda x: {sql_strip('x')}), lambda x: x <> ''), ' ')"


@register("feed_items", f"""
WITH d AS (SELECT *, row_number() OVER (PARTITION BY source, lang, doc_id // {B} ORDER BY doc_id) - 1 AS item_pos
           FROM documents WHERE lang <> 'es'),
a AS (SELECT lang AS niche, source AS source_name, item_pos, {sql_strip("split_part(text, chr(10), 1)")} AS title,
             'https://' || source || '.example.com/' || CAST(doc_id AS VARCHAR) AS source_url,
             CASE WHEN lang IN ('en', 'fr') THEN {_LINES} ELSE text END AS content,
             CASE lang WHEN 'en' THEN 'editor@' || source || '.example.com' WHEN 'fr' THEN source || ' desk' END AS author,
             CASE lang WHEN 'en' THEN {RUN_TS_SQL} - to_minutes(doc_id)
                       WHEN 'fr' THEN {RUN_TS_SQL} - to_minutes(doc_id) - INTERVAL 2 HOUR END AS date
      FROM d WHERE item_pos < {C.DEFAULT_RSS_MAX_ARTICLES})
SELECT md5(title || ':' || source_url || ':' || substring(content, 1, {C.HASH_CONTENT_CHARS})) AS article_id,
       niche, source_name, item_pos, title, author, strftime(date, '%Y-%m-%dT%H:%M:%S') AS date,
       CAST(length(content) AS BIGINT) AS content_chars
FROM a WHERE title <> '' AND content <> ''""")
def q_feed_items(spark, sf):
    raw = FD.raw_feeds_from_documents(table(spark, sf, "documents"))
    arts = FD.entries_to_articles(FD.feed_entries(raw), niche_col="lang")
    return normalise(arts.select("article_id", "niche", "source_name", "item_pos", "title", "author",
                                 iso_text("date").alias("date"), F.length("content").alias("content_chars")))


@register("feed_validity", f"""
SELECT 'https://' || source || '.example.com/feed/' || lang || '/' || CAST(doc_id // {B} AS VARCHAR) || '.xml' AS feed_url,
       CASE lang WHEN 'en' THEN 'application/rss+xml; charset=utf-8' WHEN 'fr' THEN 'text/xml' ELSE 'text/html' END AS content_type,
       lang <> 'es' AS valid, CASE WHEN lang <> 'es' THEN count(*) ELSE 0 END AS entries
FROM documents GROUP BY source, lang, doc_id // {B}""")
def q_feed_validity(spark, sf):
    raw = FD.raw_feeds_from_documents(table(spark, sf, "documents"))
    x = raw.select("feed_url", "content_type", FD.feed_valid().alias("valid"), "body")
    parsed = F.from_xml("body", FD.FEED_SCHEMA, FD.XML_OPTIONS)
    return normalise(x.select("feed_url", "content_type", "valid",
                              F.when(F.col("valid"), F.coalesce(F.size(parsed["channel"]["item"]), F.lit(0)))
                              .otherwise(F.lit(0)).cast("bigint").alias("entries")))


# J4 ---------------------------------------------------------------------------------------------
@register("full_content_override", f"""
WITH d AS (SELECT d.doc_id, d.lang, d.source, d.text, p.url AS purl, p.html
           FROM documents d LEFT JOIN pages p ON p.page_id = d.doc_id),
a AS (SELECT doc_id, {sql_strip("split_part(text, chr(10), 1)")} AS title,
             coalesce(purl, 'https://' || source || '.example.com/' || CAST(doc_id AS VARCHAR)) AS source_url, text,
             CASE WHEN html IS NOT NULL THEN {sql_text(sql_element('html', 'article'), ' ')} END AS full_text
      FROM d),
b AS (SELECT doc_id, title, source_url,
             coalesce(full_text IS NOT NULL AND length(full_text) > length(text), false) AS used_full,
             CASE WHEN full_text IS NOT NULL AND length(full_text) > length(text) THEN full_text ELSE text END AS content
      FROM a)
SELECT md5(title || ':' || source_url || ':' || substring(content, 1, {C.HASH_CONTENT_CHARS})) AS article_id,
       doc_id, source_url, used_full, CAST(length(content) AS BIGINT) AS content_chars
FROM b WHERE title <> '' AND content <> ''""")
def q_full_content_override(spark, sf):
    docs = table(spark, sf, "documents")
    pages = table(spark, sf, "pages")
    # feed entries whose link is the landed page of the same number when there is one
    linked = docs.join(pages.select(F.col("page_id").alias("doc_id"), F.col("url").alias("purl")), "doc_id", "left")
    none = F.lit(None).cast("string")
    entries = linked.select(
        F.lit(None).cast("string").alias("feed_url"), F.col("source").alias("source_name"),
        F.lit(0).alias("source_pos"), (F.col("doc_id") + 1).alias("max_articles"),      # no cap
        F.lit(True).alias("fetch_full_content"), F.col("doc_id").alias("item_pos"),
        F.substring_index("text", "\n", 1).alias("title"),
        F.coalesce("purl", F.concat(F.lit("https://"), "source", F.lit(".example.com/"),
                                    F.col("doc_id").cast("string"))).alias("link"),
        none.alias("content_encoded"), F.col("text").alias("description"), none.alias("summary"),
        none.alias("author"), none.alias("author_name"), none.alias("published"), none.alias("updated"),
        none.alias("created"), none.alias("pub_date"))
    arts = FD.entries_to_articles(entries, full_pages=pages, extra=("used_full",))
    return normalise(arts.select("article_id", F.col("item_pos").alias("doc_id"), "source_url", "used_full",
                                 F.length("content").alias("content_chars")))
