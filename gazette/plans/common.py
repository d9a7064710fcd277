"""Shared pieces of the registered queries: table access, output normalisation and
the DuckDB SQL fragments the oracles are written with."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from gazette import config as C
from gazette.session import prepare, read_table

RUN_TS_SQL = "TIMESTAMP '2024-06-04 09:00:00'"
RUN_DATE_SQL = "DATE '2024-06-04'"
RUN_DATE_TEXT = "2024-06-04"
WS = C.WS_CLASS


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    prepare(spark)
    return read_table(spark, sf_dir, name)


def normalise(df: DataFrame) -> DataFrame:
    """Result shape shared with the SQL oracles: integers as BIGINT, dates as ISO text."""
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.ByteType, T.ShortType, T.IntegerType)):
            c = c.cast("bigint")
        elif isinstance(f.dataType, T.DateType):
            c = F.date_format(c, "yyyy-MM-dd")
        cols.append(c.alias(f.name))
    return df.select(*cols)


def sql_strip(x: str) -> str:
    """F6 in DuckDB."""
    return f"regexp_replace({x}, '\\A{WS}+|{WS}+\\z', '', 'g')"


def sql_articles(where: str = "") -> str:
    """Documents as articles (before the required-field filter and hash)."""
    return f"""
    SELECT doc_id, lang AS niche, {RUN_DATE_SQL} AS run_date,
           {sql_strip("split_part(text, chr(10), 1)")} AS title,
           text AS content, CAST(NULL AS VARCHAR) AS author, 'https://' || source || '.example.com/' || CAST(doc_id AS VARCHAR) AS source_url,
           source AS source_name, CAST(1 AS BIGINT) AS kind_rank,
           CAST(TRY_CAST(regexp_extract(source, '([0-9]+)$', 1) AS INTEGER) AS BIGINT) AS source_pos,
           doc_id AS item_pos
    FROM documents {where}"""


def sql_hashed_articles() -> str:
    return f"""
    SELECT md5(title || ':' || source_url || ':' || substring(content, 1, {C.HASH_CONTENT_CHARS})) AS article_id, *
    FROM ({sql_articles()}) a
    WHERE coalesce(title, '') <> '' AND coalesce(content, '') <> ''"""


ORDER_SQL = "kind_rank ASC NULLS FIRST, source_pos ASC NULLS FIRST, source_name ASC NULLS FIRST, item_pos ASC NULLS FIRST"


def sql_sentences(src: str) -> str:
    """(article_id, niche, s_pos, sentence) in DuckDB, same rule as functions.text.sentences."""
    return f"""
    SELECT article_id, niche, run_date, unnest(s) AS sentence, generate_subscripts(s, 1) - 1 AS s_pos
    FROM (SELECT article_id, niche, run_date,
                 list_filter(list_transform(string_split(regexp_replace(content, '([.!?])[\\t\\n\\f\\r ]+', '\\1' || chr(1), 'g'), chr(1)),
                                            lambda x: {sql_strip("x")}), lambda x: x <> '') AS s
          FROM {src}) q"""


def sql_weights(src: str) -> str:
    """tf·ln(N/df) per (article, term) over src (article_id, niche, run_date, content)."""
    return f"""
    toks AS (SELECT article_id, niche, run_date, s_pos, unnest(regexp_extract_all(lower(sentence), '\\p{{L}}{{3,}}')) AS term
             FROM ({sql_sentences(src)}) s),
    tf AS (SELECT article_id, niche, run_date, term, count(*) AS tf FROM toks GROUP BY ALL),
    dfreq AS (SELECT niche, run_date, term, count(*) AS df FROM tf GROUP BY ALL),
    nart AS (SELECT niche, run_date, count(*) AS n FROM {src} GROUP BY ALL),
    weights AS (SELECT tf.article_id, tf.niche, tf.run_date, tf.term, tf.tf,
                       round(tf.tf * ln(CAST(nart.n AS DOUBLE) / dfreq.df), 9) AS weight
                FROM tf JOIN dfreq USING (niche, run_date, term) JOIN nart USING (niche, run_date)
                WHERE dfreq.df * 2 <= nart.n)"""


def sql_summaries(src: str) -> str:
    """Extractive summaries (article_id, short_summary, detailed_summary, key_insights, tags)."""
    return f"""
    {sql_weights(src)},
    sents AS ({sql_sentences(src)}),
    tagr AS (SELECT article_id, term, row_number() OVER (PARTITION BY article_id ORDER BY weight DESC, term ASC) AS r FROM weights),
    tags AS (SELECT article_id, list(term ORDER BY r) AS tags FROM tagr WHERE r <= 5 GROUP BY article_id),
    scored AS (SELECT toks.article_id, toks.s_pos, round(avg(weights.weight), 9) AS score
               FROM toks JOIN weights USING (article_id, term) GROUP BY ALL),
    topsent AS (SELECT article_id, s_pos, row_number() OVER (PARTITION BY article_id ORDER BY score DESC, s_pos ASC) AS r FROM scored),
    insights AS (SELECT t.article_id, list(s.sentence ORDER BY t.s_pos) AS key_insights
                 FROM topsent t JOIN sents s USING (article_id, s_pos) WHERE t.r <= 5 GROUP BY t.article_id),
    heads AS (SELECT article_id, list(sentence ORDER BY s_pos) FILTER (WHERE s_pos < 8) AS s8 FROM sents GROUP BY article_id),
    summaries AS (
      SELECT a.article_id,
             substring(array_to_string(coalesce(list_slice(h.s8, 1, 3), []), ' '), 1, 500) AS short_summary,
             array_to_string(coalesce(h.s8, []), ' ') AS detailed_summary,
             coalesce(i.key_insights, []) AS key_insights, coalesce(t.tags, []) AS tags
      FROM {src} a LEFT JOIN heads h USING (article_id) LEFT JOIN tags t USING (article_id)
      LEFT JOIN insights i USING (article_id))"""


# The character references that occur in landed pages, decoded as the
# HTML parser does. These legacy references are decoded with or without the closing
# ';' (a title cut after '&amp' reads '&'); '&amp' goes last so '&amp;lt;' reads '&lt;'.
ENTITIES = (("&lt", "<"), ("&gt", ">"), ("&quot", '"'), ("&#39", "'"), ("&copy", "\u00a9"),
            ("&middot", "\u00b7"), ("&nbsp", "\u00a0"), ("&amp", "&"))


def sql_decode(x: str) -> str:
    for ent, ch in ENTITIES:
        x = f"regexp_replace({x}, '{ent};?', '{ch.replace(chr(39), chr(39) * 2)}', 'g')"
    return x


def sql_clean_html(x: str) -> str:
    """Comments, script and style blocks become string separators."""
    x = f"regexp_replace({x}, '(?s)<!--.*?-->', chr(1), 'g')"
    return f"regexp_replace({x}, '(?is)<(script|style)\\b[^>]*>.*?</(script|style)>', chr(1), 'g')"


def sql_text(x: str, sep: str) -> str:
    """Text of an HTML fragment: strings between tags decoded, stripped, non-empty, joined."""
    parts = f"string_split(regexp_replace({sql_clean_html(x)}, '<[^>]*>', chr(1), 'g'), chr(1))"
    return (f"array_to_string(list_filter(list_transform({parts}, lambda x: {sql_strip(sql_decode('x'))}), "
            f"lambda x: x <> ''), '{sep}')")


def sql_element(html: str, tag: str) -> str:
    """Inner HTML of the first <tag> element (no nesting of the same tag)."""
    return f"regexp_extract({html}, '(?s)<{tag}\\b[^>]*>(.*?)</{tag}>', 1)"


NETLOC_SQL = "regexp_extract(url, '^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//([^/?#]*)', 1)"
ORIGIN_SQL = "regexp_extract(url, '^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)', 1)"
LANG_SQL = "regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*/([a-z]{2})(/|$)', 1)"


def sql_web_articles() -> str:
    """Landed pages as web articles: title = h1 text, content = article text (CSS text,
    no separator)."""
    return f"""
    SELECT md5(title || ':' || source_url || ':' || substring(content, 1, {C.HASH_CONTENT_CHARS})) AS article_id, * FROM (
      SELECT page_id, {LANG_SQL} AS niche, {RUN_DATE_SQL} AS run_date,
             CASE WHEN regexp_matches(html, '<h1\\b') THEN {sql_text(sql_element('html', 'h1'), '')} END AS title,
             CASE WHEN regexp_matches(html, '<article\\b') THEN {sql_text(sql_element('html', 'article'), '')} END AS content,
             url AS source_url, {NETLOC_SQL} AS source_name, CAST(0 AS BIGINT) AS kind_rank,
             CAST(0 AS BIGINT) AS source_pos, page_id AS item_pos
      FROM pages) p
    WHERE coalesce(title, '') <> '' AND coalesce(content, '') <> ''"""
