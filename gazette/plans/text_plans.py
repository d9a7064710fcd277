"""Registered queries: tokens and prompts (F12-F14), model responses (F15-F17, E2),
run metrics and error reports (K6, K9, A5, F34), declared extras (P11-P13) and
emerging topics over time (T5)."""

from __future__ import annotations

import datetime as _dt
import re

from pyspark.sql import functions as F

from gazette import config as C
from gazette.functions.text import token_count, token_truncate
from gazette.operators import metrics as M
from gazette.operators import publish as PB
from gazette.operators import summarize as Z
from gazette.plans.common import RUN_TS_SQL, normalise, sql_hashed_articles, table
from gazette.plans.digest_plans import pairs_sql, ranked_pairs
from gazette.plans.edition_plans import CAP, NL, lit, published
from gazette.sources import feeds as FD
from gazette.sources.documents import articles_from_documents, run_ts_lit

QUERIES = {}
ORACLES = {}


def register(name, sql=None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return deco


TOKENS_SQL = "regexp_extract_all(text, '[^\\t\\n\\x{0B}\\f\\r ]+')"


def _truncated_sql(text: str, toks: str, n: int = C.TOKEN_LIMIT) -> str:
    return f"CASE WHEN len({toks}) <= {n} THEN {text} ELSE array_to_string({toks}[1:{n}], ' ') END"


# F12, F13 --------------------------------------------------------------------------------------------
@register("token_truncate", f"""
SELECT doc_id, CAST(len(t) AS BIGINT) AS n_tokens, CAST(length({_truncated_sql('text', 't')}) AS BIGINT) AS truncated_chars,
       md5({_truncated_sql('text', 't')}) AS truncated_md5
FROM (SELECT doc_id, text, {TOKENS_SQL} AS t FROM documents) d""")
def q_token_truncate(spark, sf):
    d = table(spark, sf, "documents")
    tr = token_truncate("text")
    return normalise(d.select("doc_id", token_count("text").alias("n_tokens"), F.length(tr).alias("truncated_chars"),
                              F.md5(tr).alias("truncated_md5")))


# F14 ---------------------------------------------------------------------------------------------------
def sql_fill(template: str, **exprs) -> str:
    text = template.replace("{{", "\u0002").replace("}}", "\u0003")
    out, pos = [], 0
    for m in re.finditer(r"\{(\w+)\}", text):
        out.append(lit(text[pos:m.start()].replace("\u0002", "{").replace("\u0003", "}")))
        out.append(f"({exprs[m.group(1)]})")
        pos = m.end()
    out.append(lit(text[pos:].replace("\u0002", "{").replace("\u0003", "}")))
    return " || ".join(out)


_PROMPT_SQL = sql_fill(Z.SUMMARY_PROMPT, title="title", source="source_name", author="coalesce(author, 'Unknown')",
                       content=_truncated_sql("content", f"regexp_extract_all(content, '[^\\t\\n\\x{{0B}}\\f\\r ]+')"))


@register("prompts", f"""
SELECT article_id, 'article' AS kind, CAST(length({_PROMPT_SQL}) AS BIGINT) AS prompt_chars, md5({_PROMPT_SQL}) AS prompt_md5
FROM ({sql_hashed_articles()}) a""")
def q_prompts(spark, sf):
    p = Z.article_prompts(articles_from_documents(table(spark, sf, "documents")))
    return normalise(p.select("article_id", "kind", F.length("prompt").alias("prompt_chars"),
                              F.md5("prompt").alias("prompt_md5")))


# F15-F17 over responses: JSON (en), JSON inside prose (fr), single-quoted JSON (de),
# prose without braces (es) — built from the extractive summaries of each article -------------------
def _esc_spark(c):
    for a, b in (("\\", "\\\\"), ('"', '\\"'), ("\n", "\\n"), ("\r", "\\r"), ("\t", "\\t")):
        c = F.replace(c, F.lit(a), F.lit(b))
    return c


def _esc_sql(x):
    for a, b in (("'\\'", "'\\\\'"), ("'\"'", "'\\\"'"), ("chr(10)", "'\\n'"), ("chr(13)", "'\\r'"), ("chr(9)", "'\\t'")):
        x = f"replace({x}, {a}, {b})"
    return x


def responses_from_summaries(p):
    def jarr(c):
        return F.concat(F.lit("["), F.array_join(F.transform(c, lambda x: F.concat(F.lit('"'), _esc_spark(x), F.lit('"'))), ", "), F.lit("]"))
    js = F.concat(F.lit('{"short_summary": "'), _esc_spark(F.col("short_summary")),
                  F.lit('", "detailed_summary": "'), _esc_spark(F.col("detailed_summary")),
                  F.lit('", "key_insights": '), jarr(F.col("key_insights")), F.lit(', "tags": '), jarr(F.col("tags")), F.lit("}"))
    resp = (F.when(F.col("niche") == "en", js)
            .when(F.col("niche") == "fr", F.concat(F.lit("Here is the analysis:\n"), js, F.lit("\nHope this helps.")))
            .when(F.col("niche") == "de", F.replace(js, F.lit('"'), F.lit("'")))
            .otherwise(F.concat(F.lit("I could not produce a summary for: "), F.col("title"))))
    return p.select("article_id", resp.alias("response"))


def _jarr_sql(x):
    return f"'[' || array_to_string(list_transform({x}, lambda v: '\"' || {_esc_sql('v')} || '\"'), ', ') || ']'"


_JS_SQL = (f"""'{{"short_summary": "' || {_esc_sql('short_summary')} || '", "detailed_summary": "' || {_esc_sql('detailed_summary')} || """
           f"""'", "key_insights": ' || {_jarr_sql('key_insights')} || ', "tags": ' || {_jarr_sql('tags')} || '}}'""")
_RESP_SQL = (f"CASE niche WHEN 'en' THEN {_JS_SQL} WHEN 'fr' THEN 'Here is the analysis:' || {NL} || {_JS_SQL} || {NL} || 'Hope this helps.' "
             f"WHEN 'de' THEN replace({_JS_SQL}, '\"', '''') ELSE 'I could not produce a summary for: ' || title END")


def parse_sql(src: str) -> str:
    span = ("CASE WHEN strpos(response, '{') > 0 AND strpos(reverse(response), '}') > 0 "
            "AND length(response) - strpos(reverse(response), '}') + 1 > strpos(response, '{') "
            "THEN substring(response, strpos(response, '{'), length(response) - strpos(reverse(response), '}') + 1 - strpos(response, '{') + 1) END")
    return f"""
    SELECT article_id, response, js AS span, coalesce(json_type(js) = 'OBJECT', false) AS ok
    FROM (SELECT article_id, response, CASE WHEN json_valid(span) THEN span END AS js
          FROM (SELECT article_id, response, {span} AS span FROM {src}) q0) q"""


PARSED_SELECT = f"""
SELECT article_id, ok AS parsed,
       CASE WHEN ok THEN substring(coalesce(json_extract_string(span, '$.short_summary'), ''), 1, {C.SHORT_SUMMARY_CHARS}) ELSE '{C.FALLBACK_SHORT_SUMMARY}' END AS short_summary,
       CASE WHEN ok THEN coalesce(json_extract_string(span, '$.detailed_summary'), '') ELSE substring(response, 1, {C.FALLBACK_DETAILED_CHARS}) END AS detailed_summary,
       CASE WHEN ok THEN array_to_string(coalesce(CAST(json_extract(span, '$.key_insights') AS VARCHAR[]), [])[1:5], ' | ') ELSE '{C.FALLBACK_INSIGHT}' END AS key_insights,
       CASE WHEN ok THEN array_to_string(coalesce(CAST(json_extract(span, '$.tags') AS VARCHAR[]), [])[1:5], ', ') ELSE '{', '.join(C.FALLBACK_TAGS)}' END AS tags
FROM parsed"""


def _parsed_out(s):
    return normalise(s.select("article_id", "parsed", "short_summary", "detailed_summary",
                              F.array_join("key_insights", " | ").alias("key_insights"),
                              F.array_join("tags", ", ").alias("tags")))


@register("parse_responses", pairs_sql() + f""",
resp AS (SELECT article_id, {_RESP_SQL} AS response FROM pairs),
parsed AS ({parse_sql('resp')})""" + PARSED_SELECT)
def q_parse_responses(spark, sf):
    return _parsed_out(Z.parse_responses(responses_from_summaries(ranked_pairs(spark, sf, write_pairs=False))))


# F15-F17 over the assistant turns of conversations (prose replies) -----------------------------------------
@register("conversation_responses", f"""
WITH resp AS (SELECT CAST(conv_id AS VARCHAR) || '-' || CAST(turn AS VARCHAR) AS article_id, text AS response
              FROM conversations WHERE role = 'assistant'),
parsed AS ({parse_sql('resp')})""" + PARSED_SELECT)
def q_conversation_responses(spark, sf):
    c = table(spark, sf, "conversations").filter(F.col("role") == "assistant")
    r = c.select(F.concat_ws("-", F.col("conv_id").cast("string"), F.col("turn").cast("string")).alias("article_id"),
                 F.col("text").alias("response"))
    return _parsed_out(Z.parse_responses(r))


# K6, A5, F34 ---------------------------------------------------------------------------------------------
RUN_END = C.DEFAULT_RUN_TS + _dt.timedelta(seconds=930)   # run clock end (parameter)
_PUB_FILES_SQL = f"""
arts AS (SELECT niche, count(DISTINCT 'output/articles/2024-06-04-' ||
           substring(regexp_replace(regexp_replace(substring(title, 1, {C.SLUG_TITLE_CHARS}), '[<>:"/\\\\|?*]', '', 'g'), '\\A{C.WS_CLASS}+|{C.WS_CLASS}+\\z', '', 'g'), 1, {C.FILENAME_MAX_CHARS}) || '.md') AS n
         FROM pairs WHERE rn <= {C.PUBLISHED_ARTICLE_PAGES} GROUP BY niche)"""


@register("run_metrics", pairs_sql(CAP) + f""",
scraped AS (SELECT niche, count(*) AS n FROM src GROUP BY niche),
summ AS (SELECT niche, count(*) AS n FROM pairs GROUP BY niche),
{_PUB_FILES_SQL}
SELECT s.niche, strftime({RUN_TS_SQL}, '%Y-%m-%dT%H:%M:%S') AS start_time,
       strftime(TIMESTAMP '{RUN_END:%Y-%m-%d %H:%M:%S}', '%Y-%m-%dT%H:%M:%S') AS end_time,
       s.n AS articles_scraped, m.n AS articles_summarized, a.n AS articles_published, a.n + 2 AS files_published,
       CAST(930.0 AS DOUBLE) AS duration_seconds
FROM scraped s JOIN summ m USING (niche) JOIN arts a USING (niche)""")
def q_run_metrics(spark, sf):
    from gazette.plans.digest_plans import unique_articles
    pub, _, p = published(spark, sf)
    met = M.run_metrics(unique_articles(spark, sf), p, pub, C.DEFAULT_RUN_TS, RUN_END)
    return normalise(met.select("niche", "start_time", "end_time", "articles_scraped", "articles_summarized",
                                "articles_published", "files_published", "duration_seconds"))


# K9 -----------------------------------------------------------------------------------------------------
B = FD.FEED_BLOCK


@register("error_report", f"""
WITH errs AS (
  SELECT DISTINCT lang AS niche, 'Invalid feed: https://' || source || '.example.com/feed/' || lang || '/' || CAST(doc_id // {B} AS VARCHAR) || '.xml' AS error
  FROM documents WHERE lang = 'es'
  UNION ALL
  SELECT lang AS niche, 'Missing required fields for https://' || source || '.example.com/' || CAST(doc_id AS VARCHAR) AS error
  FROM documents WHERE coalesce({__import__('gazette.plans.common', fromlist=['sql_strip']).sql_strip("split_part(text, chr(10), 1)")}, '') = ''),
heads AS (SELECT niche, count(*) AS n FROM errs GROUP BY niche)
SELECT niche, 'title' AS part, 'Newsletter Generation Errors - 2024-06-04' AS text FROM heads
UNION ALL SELECT niche, 'opening', 'The following errors were encountered during newsletter generation:' FROM heads
UNION ALL SELECT niche, 'closing', '*This issue was automatically created by gazette*' FROM heads
UNION ALL SELECT niche, 'bullet', '- ' || error FROM errs""")
def q_error_report(spark, sf):
    docs = table(spark, sf, "documents")
    raw = FD.raw_feeds_from_documents(docs)
    bad_feeds = raw.filter(~FD.feed_valid()).select(F.col("lang").alias("niche"),
                                                     F.concat(F.lit("Invalid feed: "), "feed_url").alias("error"))
    items = articles_from_documents(docs, validate=False)
    from gazette.functions.text import nonblank
    bad_items = items.filter(~(nonblank("title") & nonblank("content"))).select(
        "niche", F.concat(F.lit("Missing required fields for "), "source_url").alias("error"))
    errs = (bad_feeds.unionByName(bad_items)
            .withColumn("run_date", F.to_date(run_ts_lit(C.DEFAULT_RUN_TS)))
            .withColumn("run_ts", run_ts_lit(C.DEFAULT_RUN_TS)).withColumn("seq", F.col("error")))
    lines = PB.error_report_lines(errs)
    return normalise(lines.select("niche", "part", "text"))


# P11, P12, P13 (declared in configuration) ------------------------------------------------------------------
@register("min_length", f"""
SELECT article_id, CAST(length(content) AS BIGINT) AS content_chars, length(content) >= {C.MIN_CONTENT_LENGTH} AS meets_min
FROM ({sql_hashed_articles()}) a""")
def q_min_length(spark, sf):
    a = articles_from_documents(table(spark, sf, "documents"))
    return normalise(M.min_length(a).select("article_id", F.length("content").alias("content_chars"), "meets_min"))


def _kw_sql(k):
    return f"CAST(regexp_matches(content, '{M.keyword_pattern(k)}') AS INTEGER)"


@register("relevance", f"""
SELECT article_id, CAST({' + '.join(_kw_sql(k) for k in C.RELEVANCE_KEYWORDS)} AS BIGINT) AS relevance
FROM ({sql_hashed_articles()}) a""")
def q_relevance(spark, sf):
    a = articles_from_documents(table(spark, sf, "documents"))
    return normalise(M.relevance(a).select("article_id", "relevance"))


@register("language", f"""
SELECT article_id, niche FROM ({sql_hashed_articles()}) a WHERE niche IN ({', '.join("'" + x + "'" for x in C.LANGUAGES)})""")
def q_language(spark, sf):
    a = articles_from_documents(table(spark, sf, "documents"))
    return normalise(M.language_filter(a).select("article_id", "niche"))


# T5 (batch form): daily counts per topic with the change from the day before ---------------------------------
@register("emerging_topics", """
WITH c AS (SELECT CAST(date_trunc('day', ts) AS DATE) AS d, event_type AS topic, count(*) AS n
           FROM events WHERE ts IS NOT NULL GROUP BY ALL)
SELECT strftime(c.d, '%Y-%m-%d') AS day, c.topic, c.n, coalesce(p.n, 0) AS prev_n, c.n - coalesce(p.n, 0) AS growth
FROM c LEFT JOIN c p ON p.topic IS NOT DISTINCT FROM c.topic AND p.d = c.d - 1""")
def q_emerging_topics(spark, sf):
    from gazette.streaming.topics import daily_topic_counts, emerging
    counts = daily_topic_counts(table(spark, sf, "events"), "ts", "event_type")
    return normalise(emerging(counts).select("day", "topic", "n", "prev_n", "growth"))


# F14 (edition kinds: title and insights prompts) ---------------------------------------------------
def _edition_prompt_sql():
    from gazette.plans.edition_plans import edition_sql
    title = sql_fill(Z.TITLE_PROMPT, niche="niche", topics="lead_topics")
    ins = sql_fill(Z.INSIGHTS_PROMPT, niche="niche", insights="insight_corpus")
    return edition_sql(f"""
SELECT niche, 'title' AS kind, '{Z.TITLE_SYSTEM}' AS system, md5({title}) AS prompt_md5, CAST(length({title}) AS BIGINT) AS prompt_chars FROM ed
UNION ALL
SELECT niche, 'insights', replace('{Z.INSIGHTS_SYSTEM}', '{{niche}}', niche), md5({ins}), CAST(length({ins}) AS BIGINT) FROM ed""")


@register("edition_prompts", _edition_prompt_sql())
def q_edition_prompts(spark, sf):
    from gazette.plans.edition_plans import editions
    e, _ = editions(spark, sf)
    p = Z.edition_prompts(e)
    return normalise(p.select("niche", "kind", "system", F.md5("prompt").alias("prompt_md5"),
                              F.length("prompt").alias("prompt_chars")))
