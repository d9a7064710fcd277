"""RSS / Atom feeds.

A landed feed is a row raw_feeds(feed_url, source_name, source_pos, content_type, body,
max_articles, fetch_full_content). Bodies are parsed with Spark's XML reader
(`from_xml`, explicit schema); entries keep their position, so the per-feed cap is a
filter on it. Only markup stripping and the well-formedness test run in Python.
"""

from __future__ import annotations

import datetime as _dt

import pandas as pd
from pyspark.sql import DataFrame, functions as F, types as T

from gazette import config as C
from gazette.functions import html as H
from gazette.functions.dates import parse_feed_date
from gazette.functions.text import has_markup, nonblank, strip_ws
from gazette.functions.urls import netloc
from gazette.sources.documents import KIND_RANK, finish_articles, run_ts_lit

_ITEM = ("title: STRING, link: STRING, description: STRING, `content:encoded`: STRING, summary: STRING, "
         "author: STRING, `dc:creator`: STRING, pubDate: STRING, published: STRING, updated: STRING, "
         "created: STRING, `dc:date`: STRING, guid: STRUCT<_VALUE: STRING, _isPermaLink: STRING>")
_ENTRY = ("title: STRING, link: ARRAY<STRUCT<_href: STRING, _rel: STRING>>, "
          "content: STRING, summary: STRING, "      # text, or of type xhtml the elements as they stand
          "author: ARRAY<STRUCT<name: STRING>>, published: STRING, updated: STRING, created: STRING")
# RSS 0.9x and 2.0 items are in the channel, those of RSS 1.0 next to it.
FEED_SCHEMA = f"channel STRUCT<title: STRING, item: ARRAY<STRUCT<{_ITEM}>>>, item ARRAY<STRUCT<{_ITEM}>>, entry ARRAY<STRUCT<{_ENTRY}>>"
XML_OPTIONS = {"mode": "PERMISSIVE", "ignoreSurroundingSpaces": "false"}


@F.pandas_udf(T.BooleanType())
def _well_formed(body: pd.Series) -> pd.Series:
    import xml.etree.ElementTree as ET

    def ok(b):
        if b is None:
            return None
        try:
            ET.fromstring(b)
            return True
        except ET.ParseError:
            return False
    return pd.Series([ok(b) for b in body], dtype=object)


@F.pandas_udf(T.StringType())
def _strip_markup(text: pd.Series) -> pd.Series:
    return pd.Series([H.strip_markup(t) for t in text], dtype=object)


# The character references the JVM path decodes ('&amp;' last).
_SIMPLE_REFS = (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&amp;", "&"))


def _simple_markup(col: F.Column) -> F.Column:
    """Markup the JVM path reads exactly like the HTML parser: only plain start/end tags
    (no comments, declarations, script/style, stray '<') and the five XML references."""
    odd_ref = col.rlike(r"&(?!(amp|lt|gt|quot|#39);)")
    odd_tag = col.rlike(r"<(?![A-Za-z/])|<[^>]*<|<[^>]*\z|<(?i:script|style|textarea|title)\b|</?[A-Za-z][^>]*[\"']")
    return ~odd_ref & ~odd_tag


def _text_jvm(col: F.Column) -> F.Column:
    def decode(x):
        for ref, ch in _SIMPLE_REFS:
            x = F.replace(x, F.lit(ref), F.lit(ch))
        return x
    parts = F.split(F.regexp_replace(col, r"<[^>]*>", "\u0001"), "\u0001", -1)
    return F.array_join(F.filter(F.transform(parts, lambda p: strip_ws(decode(p))), lambda p: p != ""), " ")


def strip_markup(c) -> F.Column:
    """F4 + P8: HTML-to-text only for values holding both '<' and '>'. Simple markup is
    read in the JVM; anything else goes to the Python parser (which sees null for all
    other rows)."""
    col = F.col(c) if isinstance(c, str) else c
    marked = has_markup(col)
    fast = marked & _simple_markup(col)
    return (F.when(fast, _text_jvm(col))
            .otherwise(F.coalesce(_strip_markup(F.when(marked & ~fast, col)), col)))


def feed_valid(content_type: str = "content_type", body: str = "body") -> F.Column:
    """S3: content type mentions xml/rss/atom, or the body is well-formed XML."""
    typed = F.lower(F.coalesce(F.col(content_type), F.lit(""))).rlike("|".join(C.FEED_CONTENT_TYPES))
    return typed | F.coalesce(_well_formed(F.when(~typed, F.col(body))), F.lit(False))


_ENTRY_FIELDS = ("title", "link", "content_encoded", "description", "summary", "author", "author_name",
                 "published", "updated", "created", "pub_date")


def _entry(**cols) -> F.Column:
    none = F.lit(None).cast("string")
    return F.struct(*[cols.get(k, none).alias(k) for k in _ENTRY_FIELDS])


def feed_entries(raw: DataFrame) -> DataFrame:
    """One row per entry of each valid feed, with its position (item_pos, 0-based)
    and the raw fields. RSS 2.0 and 1.0 items and Atom entries map to one struct shape, so a feed
    is parsed once and exploded once. An item without a link has its guid's, if that is a permanent one."""
    x = raw.filter(feed_valid()).withColumn("_x", F.from_xml("body", FEED_SCHEMA, XML_OPTIONS))
    keep = [c for c in raw.columns if c not in ("body", "content_type")]
    def rss_entry(it):
        guid = F.when((F.lower(F.coalesce(it["guid"]["_isPermaLink"], F.lit("true"))) == "true") & it["guid"]["_VALUE"].contains("://"), it["guid"]["_VALUE"])
        return _entry(
            title=it["title"], link=F.coalesce(F.when(nonblank(it["link"]), it["link"]), guid), content_encoded=it["content:encoded"],
            description=it["description"], summary=it["summary"],
            author=F.coalesce(it["author"], it["dc:creator"]), published=it["published"],
            updated=F.coalesce(it["updated"], it["dc:date"]), created=it["created"], pub_date=it["pubDate"])
    rss, rdf = F.transform("_x.channel.item", rss_entry), F.transform("_x.item", rss_entry)

    def atom_link(it):
        alt = F.filter(it["link"], lambda l: F.coalesce(l["_rel"], F.lit("alternate")) == "alternate")
        return F.coalesce(F.get(alt, 0)["_href"], F.get(it["link"], 0)["_href"])
    atom = F.transform("_x.entry", lambda it: _entry(
        title=it["title"], link=atom_link(it), content_encoded=it["content"],
        summary=it["summary"], author_name=F.get(it["author"], 0)["name"],
        published=it["published"], updated=it["updated"], created=it["created"]))
    empty = F.array().cast(f"array<struct<{', '.join(f + ': string' for f in _ENTRY_FIELDS)}>>")
    both = F.concat(F.coalesce(rss, empty), F.coalesce(rdf, empty), F.coalesce(atom, empty))
    return (x.select(*keep, F.posexplode(both).alias("item_pos", "it"))
            .select(*keep, "item_pos", *[F.col(f"it.{f}").alias(f) for f in _ENTRY_FIELDS]))


def entries_to_articles(entries: DataFrame, niche_col=None, niche: str = C.DEFAULT_NICHE,
                        run_ts=C.DEFAULT_RUN_TS, full_pages: DataFrame | None = None,
                        extra=()) -> DataFrame:
    """W2 cap (first max_articles entries, 20 if null, before validity), strip title and link,
    F5 content chain, F4 markup strip, J4 full-page override, P2, F7, F9."""
    e = entries.filter(F.col("item_pos") < F.coalesce("max_articles", F.lit(C.DEFAULT_RSS_MAX_ARTICLES)))

    def nz(c):
        return F.when(F.col(c) != "", F.col(c))
    e = e.select("*", strip_ws("title").alias("_title"), strip_ws("link").alias("_link"),
                 F.coalesce(nz("content_encoded"), nz("description"), nz("summary"), F.lit("")).alias("_raw"))
    from gazette.session import spread
    e = spread(e.filter(nonblank("_title") & nonblank("_link"))).withColumn("_content", strip_markup("_raw"))
    if full_pages is not None:
        e = full_content_override(e, full_pages)
    name = F.coalesce(F.col("source_name"), netloc("feed_url"))
    df = e.select(
        (F.col(niche_col) if niche_col else F.lit(niche)).alias("niche"),
        F.to_date(run_ts_lit(run_ts)).alias("run_date"),
        F.col("_title").alias("title"), F.col("_content").alias("content"),
        F.coalesce("author", "author_name").alias("author"),
        parse_feed_date("published", "updated", "created", "pub_date").alias("date"),
        F.coalesce("pub_date", "published", "updated", "created").alias("date_text"),
        F.col("_link").alias("source_url"), name.alias("source_name"),
        F.lit(KIND_RANK["rss"]).alias("kind_rank"), F.col("source_pos"),
        F.col("item_pos").cast("long").alias("item_pos"), run_ts_lit(run_ts).alias("ingested_at"),
        *[F.col(c) for c in extra])
    return finish_articles(df, extra)


def full_content_override(e: DataFrame, pages: DataFrame) -> DataFrame:
    """For sources with fetch_full_content, the landed page's main content
    replaces the feed text when strictly longer. Only pages linked by such entries are
    parsed (semi-join before the Python operator), of a URL landed twice the last one."""
    from gazette.sources.pages import last_landed, page_fields
    linked = last_landed(pages, e.filter(F.col("fetch_full_content")).select(F.col("_link").alias("url")))
    full = page_fields(linked, main=True, keep=("url",)).select(F.col("url").alias("_link"), F.col("main_text").alias("_full"))
    out = e.join(full, "_link", "left")
    use = F.coalesce(F.col("fetch_full_content") & F.col("_full").isNotNull()
                      & (F.length("_full") > F.length("_content")), F.lit(False))
    return (out.withColumn("used_full", use)
            .withColumn("_content", F.when(use, F.col("_full")).otherwise(F.col("_content"))).drop("_full"))


# --------------------------------------------------------------------------------------
# Feeds landed from the documents table (so feed work grows with the data): documents of
# one source and language are cut into feeds of FEED_BLOCK consecutive doc ids. Content
# types and encodings vary by language: en RSS description with HTML, fr RSS
# content:encoded (CDATA) with a +0200 date, de plain description served as text/html
# (valid because well-formed), es served as text/html and truncated (invalid).
# --------------------------------------------------------------------------------------
FEED_BLOCK = 25


def _xml_escape(c):
    return F.replace(F.replace(F.replace(c, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")),
                     F.lit(">"), F.lit("&gt;"))


def _html_paragraphs(text):
    esc = _xml_escape(text)  # HTML escaping of the text itself
    return F.concat(F.lit("<p>"), F.replace(esc, F.lit("\n"), F.lit("</p><p>")), F.lit("</p>"))


def raw_feeds_from_documents(docs: DataFrame, run_ts=C.DEFAULT_RUN_TS, max_articles: int | None = None) -> DataFrame:
    epoch = int((run_ts - _dt.datetime(1970, 1, 1)).total_seconds())
    ts = F.timestamp_seconds(F.lit(epoch) - F.col("doc_id") * F.lit(60))   # one item a minute, newest first
    title = F.concat(F.lit("<title>"), _xml_escape(F.substring_index("text", "\n", 1)), F.lit("</title>"))
    url = F.concat(F.lit("https://"), F.col("source"), F.lit(".example.com/"), F.col("doc_id").cast("string"))
    link = F.concat(F.lit("<link>"), url, F.lit("</link>"))
    lang = F.col("lang")
    body = (F.when(lang == "en", F.concat(F.lit("<description>"), _xml_escape(_html_paragraphs(F.col("text"))),
                                          F.lit("</description><author>editor@"), F.col("source"),
                                          F.lit(".example.com</author><pubDate>"),
                                          F.date_format(ts, "EEE, dd MMM yyyy HH:mm:ss"), F.lit(" GMT</pubDate>")))
            .when(lang == "fr", F.concat(F.lit("<description>Résumé</description><content:encoded><![CDATA["),
                                         _html_paragraphs(F.col("text")), F.lit("]]></content:encoded><dc:creator>"),
                                         F.col("source"), F.lit(" desk</dc:creator><pubDate>"),
                                         F.date_format(ts, "EEE, dd MMM yyyy HH:mm:ss"), F.lit(" +0200</pubDate>")))
            .otherwise(F.concat(F.lit("<description>"), _xml_escape(F.col("text")), F.lit("</description>"))))
    item = F.concat(F.lit("<item>"), title, link, body, F.lit("</item>"))
    items = docs.select("source", "lang", "doc_id", F.floor(F.col("doc_id") / FEED_BLOCK).alias("block"),
                        item.alias("item_xml"))
    feeds = items.groupBy("source", "lang", "block").agg(   # at most FEED_BLOCK items per group
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("doc_id", "item_xml"))),
                                 lambda s: s["item_xml"]), "").alias("items"))
    head = F.concat(F.lit('<?xml version="1.0" encoding="UTF-8"?><rss version="2.0" '
                          'xmlns:content="http://purl.org/rss/1.0/modules/content/" '
                          'xmlns:dc="http://purl.org/dc/elements/1.1/"><channel><title>'),
                    F.col("source"), F.lit("</title>"))
    complete = F.concat(head, F.col("items"), F.lit("</channel></rss>"))
    return feeds.select(
        F.concat(F.lit("https://"), F.col("source"), F.lit(".example.com/feed/"), F.col("lang"), F.lit("/"),
                 F.col("block").cast("string"), F.lit(".xml")).alias("feed_url"),
        F.col("source").alias("source_name"),
        F.expr("try_cast(regexp_extract(source, '([0-9]+)$', 1) AS INT)").alias("source_pos"),
        "lang",
        F.when(lang == "en", F.lit("application/rss+xml; charset=utf-8"))
         .when(lang == "fr", F.lit("text/xml")).otherwise(F.lit("text/html")).alias("content_type"),
        F.when(lang == "es", F.concat(head, F.col("items"))).otherwise(complete).alias("body"),
        F.lit(max_articles if max_articles is not None else C.DEFAULT_RSS_MAX_ARTICLES).alias("max_articles"),
        F.lit(False).alias("fetch_full_content"))


def read_feed_files(spark, path: str, sources: DataFrame | None = None) -> DataFrame:
    """Landed feed files (one document per file, any number of files in one read)
    as raw_feeds rows; the file path names the feed and joins the sources dimension
    (source_name, source_pos, max_articles, fetch_full_content, url = file path)."""
    files = (spark.read.option("wholetext", "true").text(path)
             .select(F.col("_metadata.file_path").alias("feed_url"), F.col("value").alias("body"),
                     F.lit(None).cast("string").alias("content_type")))
    if sources is None:
        return files.select("feed_url", F.lit(None).cast("string").alias("source_name"),
                            F.lit(None).cast("int").alias("source_pos"), "content_type", "body",
                            F.lit(C.DEFAULT_RSS_MAX_ARTICLES).alias("max_articles"),
                            F.lit(False).alias("fetch_full_content"))
    dim = sources.select(F.col("url").alias("feed_url"), "source_name", "source_pos", "max_articles",
                         "fetch_full_content")
    return files.join(dim, "feed_url")
