"""Registered queries: pages (fields, main content, markup, links, hosts), web
articles, the run cap over both kinds, dates."""

from __future__ import annotations

from pyspark.sql import functions as F

from gazette import config as C
from gazette.functions.dates import iso_text, parse_web_date
from gazette.functions.urls import netloc
from gazette.operators import dedup as D
from gazette.operators import select as S
from gazette.plans.common import (NETLOC_SQL, ORDER_SQL, ORIGIN_SQL, normalise,
                                  sql_element, sql_hashed_articles, sql_text, sql_web_articles, table)
from gazette.sources import pages as P
from gazette.sources.documents import articles_from_documents

QUERIES = {}
ORACLES = {}


def register(name, sql=None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return deco


# S5, F2 (CSS text joins strings with no separator, L5) ----------------------------------
@register("page_title", f"""
SELECT page_id, CASE WHEN regexp_matches(html, '<h1\\b') THEN {sql_text(sql_element('html', 'h1'), '')} END AS title
FROM pages""")
def q_page_title(spark, sf):
    f = P.page_fields(table(spark, sf, "pages"), {"title": "h1"})
    return normalise(f.select("page_id", "title"))


# S9, F4 -------------------------------------------------------------------------------------
@register("page_article", f"""
SELECT page_id, {sql_text(sql_element('html', 'article'), ' ')} AS main_text FROM pages""")
def q_page_article(spark, sf):
    f = P.page_fields(table(spark, sf, "pages"), main=True)
    return normalise(f.select("page_id", "main_text"))


# F4, P8 --------------------------------------------------------------------------------------
@register("strip_markup", f"""
SELECT page_id, {sql_text('html', ' ')} AS text, CAST(length({sql_text('html', ' ')}) AS BIGINT) AS text_chars
FROM pages""")
def q_strip_markup(spark, sf):
    f = P.page_fields(table(spark, sf, "pages"), text=True)
    return normalise(f.select("page_id", F.col("page_text").alias("text"),
                              F.length("page_text").alias("text_chars")))


# S6 (JVM fast path for a[href]) + F11 --------------------------------------------------------
LINKS_SQL = f"""
SELECT page_id, url, unnest(h) AS href, generate_subscripts(h, 1) - 1 AS link_pos
FROM (SELECT page_id, url, regexp_extract_all(html, '<a\\s[^>]*?href="([^"]*)"', 1) AS h FROM pages) q"""


@register("page_links", f"""
SELECT page_id, link_pos, href, {ORIGIN_SQL} || href AS link FROM ({LINKS_SQL}) l""")
def q_page_links(spark, sf):
    x = P.native_links(table(spark, sf, "pages"))
    return normalise(x.select("page_id", "link_pos", "href", "link"))


# S6 with the selector engine + F11 + W2 (first 10 links per page, the web default) ----------
@register("page_links_resolved", f"""
SELECT page_id, link_pos, {ORIGIN_SQL} || href AS link FROM ({LINKS_SQL}) l WHERE link_pos < {C.DEFAULT_WEB_MAX_ARTICLES}""")
def q_page_links_resolved(spark, sf):
    x = P.page_links(table(spark, sf, "pages"), "a[href]", cap=C.DEFAULT_WEB_MAX_ARTICLES)
    return normalise(x.select("page_id", "link_pos", "link"))


# F10 ------------------------------------------------------------------------------------------
@register("netloc", f"SELECT page_id, {NETLOC_SQL} AS netloc FROM pages")
def q_netloc(spark, sf):
    return normalise(table(spark, sf, "pages").select("page_id", netloc("url").alias("netloc")))


# S5, S8 over landed pages ------------------------------------------------------------------------
@register("web_articles", f"""
SELECT article_id, niche, title, source_name, source_url, CAST(length(content) AS BIGINT) AS content_chars
FROM ({sql_web_articles()}) w""")
def q_web_articles(spark, sf):
    w = P.web_articles(table(spark, sf, "pages"))
    return normalise(w.select("article_id", "niche", "title", "source_name", "source_url",
                              F.length("content").alias("content_chars")))


# Web before feeds, first 20 per edition after dedup -----------------------------------
@register("run_cap", f"""
WITH u AS (
  SELECT article_id, niche, run_date, kind_rank, source_pos, source_name, item_pos FROM ({sql_web_articles()}) w
  UNION ALL
  SELECT article_id, niche, run_date, kind_rank, source_pos, source_name, item_pos FROM ({sql_hashed_articles()}) d),
f AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY article_id ORDER BY {ORDER_SQL}) AS k FROM u) q WHERE k = 1)
SELECT niche, rn, kind_rank, source_name, item_pos, article_id FROM (
  SELECT *, row_number() OVER (PARTITION BY niche, run_date ORDER BY {ORDER_SQL}) AS rn FROM f) q
WHERE rn <= {C.DEFAULT_RUN_CAP}""")
def q_run_cap(spark, sf):
    web = P.web_articles(table(spark, sf, "pages"))
    rss = articles_from_documents(table(spark, sf, "documents"))
    unique = D.deduplicate(S.union_kinds(web, rss))
    capped = S.run_cap(unique, C.DEFAULT_RUN_CAP)
    return normalise(capped.select("niche", "rn", "kind_rank", "source_name", "item_pos", "article_id"))


# F8: order dates rendered in the seven web formats, parsed back ------------------------------------
_RENDER = (("yyyy-MM-dd", "%Y-%m-%d"), ("yyyy-MM-dd'T'HH:mm:ss", "%Y-%m-%dT%H:%M:%S"),
           ("yyyy-MM-dd'T'HH:mm:ss'Z'", "%Y-%m-%dT%H:%M:%SZ"), ("MMMM dd, yyyy", "%B %d, %Y"),
           ("MMM dd, yyyy", "%b %d, %Y"), ("dd MMMM yyyy", "%d %B %Y"), ("dd MMM yyyy", "%d %b %Y"))
_FMT_SQL = "CASE o_orderkey % 7 " + " ".join(
    f"WHEN {i} THEN strftime(o_orderdate, '{py}')" for i, (_, py) in enumerate(_RENDER)) + " END"
_PARSE_SQL = "coalesce(" + ", ".join(f"try_strptime(trim(date_text), '{py}')" for _, py in _RENDER) + ")"


@register("parse_web_dates", f"""
SELECT o_orderkey, date_text, strftime({_PARSE_SQL}, '%Y-%m-%dT%H:%M:%S') AS parsed
FROM (SELECT o_orderkey, {_FMT_SQL} AS date_text FROM orders) o""")
def q_parse_web_dates(spark, sf):
    o = table(spark, sf, "orders")
    fmt = F.when(F.lit(False), F.lit(None))
    for i, (sp, _) in enumerate(_RENDER):
        fmt = fmt.when(F.col("o_orderkey") % 7 == i, F.date_format("o_orderdate", sp))
    x = o.select("o_orderkey", fmt.alias("date_text"))
    return normalise(x.select("o_orderkey", "date_text", iso_text(parse_web_date("date_text")).alias("parsed")))


# Per-source selector maps as data (CSS, XPath, descendant chains, child steps) -----
_SELECTORS_BY_LANG = {"en": {"title": "h1", "author": "footer"},
                      "fr": {"title": "//h1", "author": "//footer"},
                      "de": {"title": "article h1", "author": "body footer"},
                      "es": {"title": "//article/h1", "author": "//body/footer"}}


def _xpath_text_sql(tag):
    from gazette.plans.common import sql_decode, sql_strip
    inner = sql_element("html", tag)
    return sql_strip(sql_decode(f"regexp_replace({inner}, '<[^>]*>', '', 'g')"))


@register("page_selectors", f"""
SELECT page_id, {_xpath_text_sql('h1')} AS title, {_xpath_text_sql('footer')} AS author FROM pages""")
def q_page_selectors(spark, sf):
    pages = table(spark, sf, "pages")
    lang = P.page_lang(F.col("url"))
    sel = F.lit(None).cast("map<string,string>")
    for code, m in _SELECTORS_BY_LANG.items():
        sel = F.when(lang == code, F.create_map(*[F.lit(x) for kv in m.items() for x in kv])).otherwise(sel)
    f = P.page_fields(pages.withColumn("selectors", sel))
    return normalise(f.select("page_id", "title", "author"))
