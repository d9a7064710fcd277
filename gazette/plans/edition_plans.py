"""Registered queries: editions (Z3-Z5), stories, rendering, publishing, social rows,
metrics and errors, declared extras. All over documents as articles, editions by
language, first 20 articles per edition (max_articles_per_run)."""

from __future__ import annotations

from pyspark.sql import functions as F

from gazette import config as C
from gazette.functions.text import article_slug, safe_filename
from gazette.operators import edition as E
from gazette.operators import publish as PB
from gazette.operators import render as R
from gazette.operators import select as S
from gazette.operators import social as SO
from gazette.operators import trends as T
from gazette.plans.common import RUN_TS_SQL, normalise, sql_strip
from gazette.plans.digest_plans import pairs_sql, ranked_pairs
from gazette.sources.documents import run_ts_lit

QUERIES = {}
ORACLES = {}


def register(name, sql=None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return deco


CAP = C.DEFAULT_RUN_CAP
NL = "chr(10)"


def lit(s: str) -> str:
    """A Python string as a DuckDB expression (newlines as chr(10))."""
    parts = s.split("\n")
    out = []
    for i, p in enumerate(parts):
        if p:
            out.append("'" + p.replace("'", "''") + "'")
        if i < len(parts) - 1:
            out.append(NL)
    return "(" + " || ".join(out or ["''"]) + ")"


def capped_pairs(spark, sf):
    return ranked_pairs(spark, sf, run_cap=CAP).withColumn("run_ts", run_ts_lit(C.DEFAULT_RUN_TS))


def editions(spark, sf, pairs=None):
    p = pairs if pairs is not None else capped_pairs(spark, sf)
    return E.assemble(p).withColumn("run_ts", run_ts_lit(C.DEFAULT_RUN_TS)), p


# ---------------------------------------------------------------------------------- SQL pieces
def strip(x):
    return sql_strip(x)


_EDITION_CTES = f""",
stats AS (SELECT niche, run_date, count(*) AS articles_count, count(DISTINCT source_name) AS sources_count FROM pairs GROUP BY ALL),
leads AS (SELECT niche, run_date, array_to_string(list(tags[1] ORDER BY rn)[1:{C.LEAD_TOPICS}], ', ') AS lead_topics
          FROM pairs WHERE rn <= {C.LEAD_TOPIC_SUMMARIES} AND len(tags) > 0 GROUP BY ALL),
ins AS (SELECT niche, run_date, list(insight ORDER BY rn, i_pos)[1:{C.INSIGHT_LINES}] AS insights FROM (
          SELECT niche, run_date, rn, unnest(key_insights) AS insight, generate_subscripts(key_insights, 1) AS i_pos
          FROM pairs WHERE rn <= {C.INSIGHT_ARTICLES}) q GROUP BY ALL),
tex AS (SELECT niche, run_date, rn, unnest(tags) AS tag, generate_subscripts(tags, 1) - 1 AS tag_pos FROM pairs),
tcnt AS (SELECT niche, run_date, tag, count(*) AS mentions, min(rn * 1048576 + tag_pos) AS first_seen
         FROM tex WHERE rn <= {C.TREND_ARTICLES} GROUP BY ALL),
tr AS (SELECT niche, run_date, list(tag || ' (mentioned in ' || CAST(mentions AS VARCHAR) || ' articles)' ORDER BY tag_rank) AS trends
       FROM (SELECT *, row_number() OVER (PARTITION BY niche, run_date ORDER BY mentions DESC, first_seen ASC) AS tag_rank FROM tcnt) q
       WHERE tag_rank <= {C.TREND_TOP} AND mentions >= {C.TREND_MIN_COUNT} GROUP BY ALL),
acnt AS (SELECT niche, run_date, tag, count(*) AS mentions, min(rn * 1048576 + tag_pos) AS first_seen FROM tex GROUP BY ALL),
ttags AS (SELECT niche, run_date, list(tag ORDER BY tag_rank) AS top_tags
          FROM (SELECT *, row_number() OVER (PARTITION BY niche, run_date ORDER BY mentions DESC, first_seen ASC) AS tag_rank FROM acnt) q
          WHERE tag_rank <= 5 GROUP BY ALL),
tsrc AS (SELECT niche, run_date, list(source_name ORDER BY r) AS top_sources FROM (
           SELECT *, row_number() OVER (PARTITION BY niche, run_date ORDER BY n DESC, source_name ASC) AS r
           FROM (SELECT niche, run_date, source_name, count(*) AS n FROM pairs GROUP BY ALL) a) q WHERE r <= 3 GROUP BY ALL),
stories AS (SELECT niche, run_date, list(struct_pack(title := title, source := source_name, url := source_url,
                   summary := short_summary, key_insights := key_insights[1:{C.STORY_INSIGHTS}]) ORDER BY rn) AS top_stories
            FROM pairs WHERE rn <= {C.TOP_STORIES} GROUP BY ALL),
ed AS (SELECT s.niche, s.run_date,
              CASE WHEN coalesce(l.lead_topics, '') = '' THEN s.niche || ' Digest' ELSE s.niche || ' Digest: ' || l.lead_topics END AS title,
              'Welcome to today''s ' || s.niche || ' news digest! We''ve analyzed ' || CAST(s.articles_count AS VARCHAR) ||
              ' articles to bring you the most important developments and insights.' AS introduction,
              coalesce(st.top_stories, []) AS top_stories, coalesce(t.trends, []) AS trends,
              array_to_string(coalesce(i.insights, []), {NL} || {NL}) AS insights,
              s.articles_count, s.sources_count, coalesce(ts.top_sources, []) AS top_sources,
              coalesce(tt.top_tags, []) AS top_tags, coalesce(l.lead_topics, '') AS lead_topics,
              array_to_string(list_transform(coalesce(i.insights, []), lambda x: '- ' || x), {NL}) AS insight_corpus
       FROM stats s LEFT JOIN leads l USING (niche, run_date) LEFT JOIN ins i USING (niche, run_date)
       LEFT JOIN tr t USING (niche, run_date) LEFT JOIN stories st USING (niche, run_date)
       LEFT JOIN tsrc ts USING (niche, run_date) LEFT JOIN ttags tt USING (niche, run_date))"""


def edition_sql(select: str, extra: str = "") -> str:
    return pairs_sql(CAP) + _EDITION_CTES + extra + "\n" + select


def _opt(cond, body):
    return f"CASE WHEN {cond} THEN {body} ELSE '' END"


def _bullets(arr):
    return f"array_to_string(list_transform({arr}, lambda x: '- ' || x || {NL}), '')"


SECTION_SQL = (f"'### ' || title || {lit(chr(10) * 2 + '**Source:** [')} || source_name || '](' || source_url || ')' || {NL} || "
               f"{_opt('coalesce(author, ' + chr(39) * 2 + ') <> ' + chr(39) * 2, lit('**Author:** ') + ' || author || ' + NL)} || "
               f"{_opt('date_iso IS NOT NULL', lit('**Date:** ') + ' || date_iso || ' + NL)} || "
               f"{lit(chr(10) + '**Summary:** ')} || short_summary || {NL} || {NL} || "
               f"{_opt('len(key_insights) > 0', lit('**Key Insights:**' + chr(10)) + ' || ' + _bullets('key_insights') + ' || ' + NL)} || "
               f"{_opt('len(tags) > 0', lit('**Tags:** ') + ' || array_to_string(tags, ' + chr(39) + ', ' + chr(39) + ') || ' + NL)} || "
               f"{lit(chr(10) + '---' + chr(10) * 2)}")
DATE_LONG = f"strftime({RUN_TS_SQL}, '%B %d, %Y')"
DATE_LONG_TIME = f"strftime({RUN_TS_SQL}, '%B %d, %Y at %I:%M %p')"
SECTIONS_CTE = f""",
sec AS (SELECT *, {SECTION_SQL} AS section FROM (SELECT *, CAST(NULL AS VARCHAR) AS date_iso FROM pairs) p),
allsec AS (SELECT niche, run_date, string_agg(section, '' ORDER BY rn) AS all_sections, count(*) AS n_articles FROM sec GROUP BY ALL)"""


# Z3-Z5, A4, F18, F27 --------------------------------------------------------------------------------
@register("edition", edition_sql("""
SELECT niche, CAST(run_date AS VARCHAR) AS run_date, title, introduction, articles_count, sources_count, lead_topics,
       array_to_string(list_transform(top_stories, lambda s: s.title), ' | ') AS story_titles,
       array_to_string(trends, chr(10)) AS trends, insights, insight_corpus,
       array_to_string(top_sources, ', ') AS top_sources, array_to_string(top_tags, ', ') AS top_tags
FROM ed"""))
def q_edition(spark, sf):
    e, _ = editions(spark, sf)
    return normalise(e.select(
        "niche", "run_date", "title", "introduction", "articles_count", "sources_count", "lead_topics",
        F.array_join(F.transform("top_stories", lambda s: s["title"]), " | ").alias("story_titles"),
        F.array_join("trends", "\n").alias("trends"), "insights", "insight_corpus",
        F.array_join("top_sources", ", ").alias("top_sources"), F.array_join("top_tags", ", ").alias("top_tags")))


# F28, O3, O6 ---------------------------------------------------------------------------------------
@register("top_stories", edition_sql("""
SELECT niche, story_rank, s.title AS title, s.source AS source, s.url AS url, s.summary AS summary,
       array_to_string(s.key_insights, ' | ') AS key_insights
FROM (SELECT niche, unnest(top_stories) AS s, generate_subscripts(top_stories, 1) AS story_rank FROM ed) q"""))
def q_top_stories(spark, sf):
    st = E.top_stories(capped_pairs(spark, sf))
    x = st.select("niche", F.posexplode("top_stories").alias("i", "s"))
    return normalise(x.select("niche", (F.col("i") + 1).alias("story_rank"), F.col("s.title").alias("title"),
                              F.col("s.source").alias("source"), F.col("s.url").alias("url"),
                              F.col("s.summary").alias("summary"),
                              F.array_join("s.key_insights", " | ").alias("key_insights")))


# O5 --------------------------------------------------------------------------------------------------
@register("quick_reads", pairs_sql(CAP) + """
SELECT niche, rn, title, source_name, short_summary FROM pairs WHERE rn BETWEEN 6 AND 10""")
def q_quick_reads(spark, sf):
    q = E.quick_reads(capped_pairs(spark, sf))
    return normalise(q.select("niche", "rn", "title", "source_name", "short_summary"))


# J1, J2, P3, Z1 ----------------------------------------------------------------------------------------
@register("pairs", pairs_sql() + """
SELECT article_id, niche, title, source_name, short_summary, array_to_string(tags, ', ') AS tags FROM pairs""")
def q_pairs(spark, sf):
    """Whole editions: no article is numbered, so no edition is one task."""
    p = ranked_pairs(spark, sf, parts=("summary", "tags"), write_pairs=False)
    return normalise(p.select("article_id", "niche", "title", "source_name", "short_summary",
                              F.array_join("tags", ", ").alias("tags")))


# A7-A9 over whole editions ------------------------------------------------------------------------------
@register("source_stats", pairs_sql(None) + """,
tex AS (SELECT niche, run_date, rn, unnest(tags) AS tag, generate_subscripts(tags, 1) - 1 AS tag_pos FROM pairs),
acnt AS (SELECT niche, run_date, tag, count(*) AS mentions, min(rn * 1048576 + tag_pos) AS first_seen FROM tex GROUP BY ALL),
ttags AS (SELECT niche, list(tag ORDER BY tag_rank) AS top_tags
          FROM (SELECT *, row_number() OVER (PARTITION BY niche, run_date ORDER BY mentions DESC, first_seen ASC) AS tag_rank FROM acnt) q
          WHERE tag_rank <= 5 GROUP BY ALL),
tsrc AS (SELECT niche, list(source_name ORDER BY r) AS top_sources FROM (
           SELECT *, row_number() OVER (PARTITION BY niche ORDER BY n DESC, source_name ASC) AS r
           FROM (SELECT niche, source_name, count(*) AS n FROM pairs GROUP BY ALL) a) q WHERE r <= 3 GROUP BY ALL)
SELECT s.niche, s.articles_count, s.sources_count, array_to_string(ts.top_sources, ', ') AS top_sources,
       array_to_string(coalesce(tt.top_tags, []), ', ') AS top_tags
FROM (SELECT niche, count(*) AS articles_count, count(DISTINCT source_name) AS sources_count FROM pairs GROUP BY ALL) s
LEFT JOIN tsrc ts USING (niche) LEFT JOIN ttags tt USING (niche)""")
def q_source_stats(spark, sf):
    st = T.source_stats(ranked_pairs(spark, sf, parts=("tags",)))
    return normalise(st.select("niche", "articles_count", "sources_count",
                               F.array_join("top_sources", ", ").alias("top_sources"),
                               F.array_join("top_tags", ", ").alias("top_tags")))


# F29, F32, F33 --------------------------------------------------------------------------------------------
@register("article_markdown", pairs_sql() + SECTIONS_CTE + f"""
SELECT article_id, '# ' || title || {lit(chr(10) * 2 + '*Published on ')} || {DATE_LONG} || {lit('*' + chr(10) * 2)} || section ||
       {_opt("coalesce(detailed_summary, '') <> ''", lit('## Detailed Summary' + chr(10) * 2) + ' || detailed_summary || ' + NL + ' || ' + NL)} AS page
FROM sec""")
def q_article_markdown(spark, sf):
    p = ranked_pairs(spark, sf, write_pairs=False).withColumn("run_ts", run_ts_lit(C.DEFAULT_RUN_TS))
    return normalise(R.article_page(p).select("article_id", "page"))


# F30, W4, A10, P7 ----------------------------------------------------------------------------------------------
_STORY_SQL = (f"array_to_string(list_transform(top_stories, lambda s, i: '### ' || CAST(i AS VARCHAR) || '. ' || s.title || "
              f"{lit(chr(10) * 2 + '**Source:** [')} || s.source || '](' || s.url || ')' || {NL} || {NL} || s.summary || {NL} || {NL} || "
              f"{_opt('len(s.key_insights) > 0', lit('**Key Points:**' + chr(10)) + ' || ' + _bullets('s.key_insights') + ' || ' + NL)}), '')")
_HEAD_SQL = (f"'# ' || title || {NL} || {NL} || '*Generated on ' || {DATE_LONG} || '*' || {NL} || {NL} || "
                  + lit("## Table of Contents\n\n1. [Introduction](#introduction)\n2. [Top Stories](#top-stories)\n"
                        "3. [Trends](#trends)\n4. [Insights & Analysis](#insights--analysis)\n5. [All Articles](#all-articles)\n\n"
                        "## Introduction\n\n")
                  + f" || introduction || {NL} || {NL} || " + lit("## Top Stories\n\n") + f" || {_STORY_SQL} || "
                  + _opt("len(trends) > 0", lit("## Trends\n\n") + " || " + _bullets("trends") + " || " + NL)
                  + " || " + lit("## Insights & Analysis\n\n") + f" || insights || {NL} || {NL}")
_FOOT_SQL = lit("---\n\n*This newsletter was generated automatically by gazette.*\n")
NEWSLETTER_SQL = (_HEAD_SQL + " || " + _opt("coalesce(n_articles, 0) > 0", lit("## All Articles\n\n") + " || all_sections") + " || " + _FOOT_SQL)


@register("newsletter_markdown", edition_sql(f"""
SELECT niche, {NEWSLETTER_SQL} AS body FROM ed LEFT JOIN allsec USING (niche, run_date)""", SECTIONS_CTE))
def q_newsletter_markdown(spark, sf):
    e, p = editions(spark, sf)
    return normalise(R.newsletter_plain(e, p).select("niche", "body"))


# F30, Z1 without a run cap: every article of an edition, as ordered blocks ---------------------------------------
@register("newsletter_parts", pairs_sql() + _EDITION_CTES + SECTIONS_CTE.split(",\nallsec")[0] + f"""
SELECT niche, CAST(0 AS BIGINT) AS part_no, {_HEAD_SQL} || {lit("## All Articles" + chr(10) * 2)} AS block FROM ed
UNION ALL SELECT niche, rn AS part_no, section AS block FROM sec
UNION ALL SELECT niche, articles_count + 1 AS part_no, {_FOOT_SQL} AS block FROM ed""")
def q_newsletter_parts(spark, sf):
    from gazette.session import materialize
    p = materialize(S.number_editions(ranked_pairs(spark, sf)), "numbered")
    e, _ = editions(spark, sf, p)
    return normalise(R.newsletter_parts(e, p).select("niche", "part_no", "block"))


# F31, F36-F38, O5, A7-A9 (the long layout) ---------------------------------------------------------------------
FULL_METADATA = {"issue_number": 1, "frequency": "daily", "publish_time": "9:00 AM",
                 "social_links": {"mastodon": "https://example.org/@digest", "rss": "https://example.org/feed.xml"}}

_FULL_CTES = SECTIONS_CTE + f""",
quick AS (SELECT niche, run_date, string_agg({NL} || '**[' || title || '](' || source_url || ')**  ' || {NL} || '*' || source_name || '* • ' || short_summary || {lit(chr(10) * 2)},
                 '' ORDER BY rn) AS quick FROM pairs WHERE rn BETWEEN 6 AND 10 GROUP BY ALL),
det AS (SELECT niche, run_date, string_agg({lit(chr(10) + '<details>' + chr(10) + '<summary><strong>')} || title || '</strong> - ' || source_name ||
               {lit('</summary>' + chr(10) * 2 + '**URL:** [')} || source_url || '](' || source_url || ')  ' || {NL} ||
               {_opt("coalesce(author, '') <> ''", "'**Author:** ' || author || '  '")} || {NL} ||
               {_opt("coalesce(date_iso, '') <> ''", "'**Date:** ' || date_iso || '  '")} || {lit(chr(10) * 2)} || '**Summary:** ' || short_summary || {lit(chr(10) * 2)} ||
               {_opt("coalesce(detailed_summary, '') <> ''", lit('**Detailed Summary:**' + chr(10)) + ' || detailed_summary || ' + lit(chr(10) * 2))} ||
               {_opt('len(key_insights) > 0', lit('**Key Insights:**' + chr(10)) + ' || ' + _bullets('key_insights') + ' || ' + NL)} ||
               {_opt('len(tags) > 0', lit('**Tags:** ') + " || array_to_string(tags, ', ') || " + NL)} || {lit(chr(10) + '</details>' + chr(10) * 2)}, '' ORDER BY rn) AS details
        FROM sec GROUP BY ALL)"""
_FULL_STORY_SQL = (f"array_to_string(list_transform(top_stories, lambda s, i: '### ' || CAST(i AS VARCHAR) || '. ' || s.title || {lit(chr(10) * 2 + '*Source: [')} || s.source || "
                   f"'](' || s.url || {lit(')*' + chr(10) * 2)} || s.summary || {lit(chr(10) * 2)} || "
                   f"{_opt('len(s.key_insights) > 0', lit('**Key Takeaways:**' + chr(10)) + ' || ' + _bullets('s.key_insights') + ' || ' + NL)} || "
                   f"'[Read full article →](' || s.url || {lit(')' + chr(10) * 2 + '---' + chr(10))}), '')")
FULL_SQL = " || ".join([
    "'# ' || title", lit("\n\n*"), DATE_LONG, lit(" • Issue #1*\n\n---\n\n## Table of Contents\n\n1. [Today's Highlights](#todays-highlights)\n2. [Top Stories](#top-stories)\n"
        "3. [Trending Topics](#trending-topics)\n4. [Industry Insights](#industry-insights)\n5. [Quick Reads](#quick-reads)\n6. [About This Newsletter](#about-this-newsletter)\n\n"
        "---\n\n## Today's Highlights\n\n"),
    "introduction", lit("\n\n**Today's Coverage:** "), "CAST(articles_count AS VARCHAR)", "' articles analyzed from '", "CAST(sources_count AS VARCHAR)", lit(" sources\n\n---\n\n## Top Stories\n\n"),
    _FULL_STORY_SQL, lit("\n## Trending Topics\n\n"),
    f"CASE WHEN len(trends) > 0 THEN {lit(chr(84) + 'oday' + chr(39) + 's analysis reveals these emerging trends in the ')} || niche || {lit(' industry:' + chr(10) * 2)} || "
    f"array_to_string(list_transform(trends, lambda t: '- **' || t || '**' || {NL}), '') ELSE {lit('*No significant trends detected in today' + chr(39) + 's coverage.*' + chr(10))} END",
    lit("\n---\n\n## Industry Insights\n\n"), "insights", lit("\n\n---\n\n## Quick Reads\n\n*More stories from today's "), "niche", lit(" news:*\n"), "coalesce(quick, '')",
    lit("\n---\n\n## Today's Statistics\n\n- **Articles Analyzed:** "), "CAST(articles_count AS VARCHAR)", lit("\n- **Top Sources:** "), "array_to_string(top_sources, ', ')",
    lit("\n- **Most Common Topics:** "), "array_to_string(top_tags, ', ')", lit("\n\n---\n\n## Browse All Articles\n"), "coalesce(details, '')",
    lit("\n---\n\n## About This Newsletter\n\nThis "), "niche",
    lit(" news digest is generated automatically from the latest articles of its sources.\n\n### Update Frequency\nNew issues are published daily at 9:00 AM UTC.\n\n### Subscribe\n"
        "Stay tuned for subscription options coming soon!\n\n### Connect With Us\n- [Mastodon](https://example.org/@digest)\n- [Rss](https://example.org/feed.xml)\n\n### Feedback\n"
        "Have suggestions or feedback? We'd love to hear from you!\n\n---\n\n*This newsletter was generated automatically by gazette on "), DATE_LONG_TIME, lit(" UTC.*\n")])


@register("newsletter_full", edition_sql(f"""
SELECT niche, body, length(body) AS body_chars FROM (
  SELECT niche, {FULL_SQL} AS body FROM ed LEFT JOIN quick USING (niche, run_date) LEFT JOIN det USING (niche, run_date)) q""", _FULL_CTES))
def q_newsletter_full(spark, sf):
    """The long layout for every edition (first 20 articles each)."""
    e, p = editions(spark, sf)
    return normalise(R.newsletter_full(e, p, FULL_METADATA).select("niche", "body", F.length("body").alias("body_chars")))


# F19, F20, F6 (part names and document titles) --------------------------------------------------------------
def _safe_sql(x):
    removed = "regexp_replace(" + x + ", '[<>:\"/\\\\|?*]', '', 'g')"
    return f"substring({strip(removed)}, 1, {C.FILENAME_MAX_CHARS})"


@register("safe_filename", f"""
SELECT p_partkey, {_safe_sql('p_name')} AS safe_name,
       '2024-06-04-' || {_safe_sql(f'substring(p_name, 1, {C.SLUG_TITLE_CHARS})')} || '.md' AS slug
FROM part""")
def q_safe_filename(spark, sf):
    from gazette.plans.common import table
    p = table(spark, sf, "part")
    return normalise(p.select("p_partkey", safe_filename("p_name").alias("safe_name"),
                              article_slug(F.lit("2024-06-04"), F.col("p_name")).alias("slug")))


# K1, K2, K4, O4, U3, F35 -----------------------------------------------------------------------------------------
def published(spark, sf):
    e, p = editions(spark, sf)
    news = PB.newsletter_rows(R.newsletter_plain(e, p))
    arts = PB.article_rows(R.article_page(p))
    files = news.unionByName(arts)
    idx = PB.index_rows(files.join(e.select("niche", "run_date", "run_ts"), ["niche", "run_date"]))
    return files.unionByName(idx), e, p


_PUB_CTES = f""",
arts AS (SELECT niche, run_date, path FROM (
           SELECT niche, run_date, rn, 'output/articles/' || {_safe_sql('niche')} || '/2024-06-04-' || {_safe_sql(f'substring(title, 1, {C.SLUG_TITLE_CHARS})')} || '.md' AS path,
                  row_number() OVER (PARTITION BY niche, run_date, 'output/articles/2024-06-04-' || {_safe_sql(f'substring(title, 1, {C.SLUG_TITLE_CHARS})')} || '.md' ORDER BY rn DESC) AS k
           FROM pairs WHERE rn <= {C.PUBLISHED_ARTICLE_PAGES}) q WHERE k = 1),
news AS (SELECT niche, run_date, 'output/' || {_safe_sql("'2024-06-04-' || niche || '-digest'")} || '.md' AS path FROM (SELECT DISTINCT niche, run_date FROM pairs) e),
files AS (SELECT niche, run_date, 'newsletter' AS kind, path FROM news UNION ALL SELECT niche, run_date, 'article' AS kind, path FROM arts),
lines AS (SELECT *, '- [' || regexp_replace(regexp_extract(path, '[^/]*$'), '\\.[^.]*$', '') || '](' || substring(path, 8) || ')' || {NL} AS line,
                 row_number() OVER (PARTITION BY niche, run_date, kind ORDER BY path DESC) AS r FROM files)"""


@register("publish_index", pairs_sql(CAP) + _PUB_CTES + f"""
SELECT niche, '# News Digest - Index' || {NL} || {NL} || '*Last updated: ' || {DATE_LONG_TIME} || '*' || {NL} || {NL} ||
       {_opt("count(*) FILTER (WHERE kind = 'newsletter') > 0", lit('## Newsletters' + chr(10) * 2) + " || string_agg(line, '' ORDER BY r) FILTER (WHERE kind = 'newsletter') || " + NL)} ||
       {_opt(f"count(*) FILTER (WHERE kind = 'article' AND r <= {C.INDEX_ARTICLES}) > 0", lit('## Individual Articles' + chr(10) * 2) + f" || string_agg(line, '' ORDER BY r) FILTER (WHERE kind = 'article' AND r <= {C.INDEX_ARTICLES}) || " + NL)} AS body
FROM lines GROUP BY niche""")
def q_publish_index(spark, sf):
    pub, _, _ = published(spark, sf)
    return normalise(pub.filter(F.col("kind") == "index").select("niche", "body"))


# K7, U3 ---------------------------------------------------------------------------------------------------------
@register("site_routing", pairs_sql(CAP) + _PUB_CTES + """,
allf AS (SELECT niche, kind, path FROM files UNION ALL SELECT DISTINCT niche, 'index' AS kind, 'output/index-' || niche || '.md' AS path FROM files)
SELECT niche, kind, path AS source_path,
       CASE WHEN contains(path, '/articles/') THEN 'content/articles/' || niche || '/' ELSE 'content/newsletters/' END || regexp_extract(path, '[^/]*$') AS dest_path
FROM allf
UNION ALL
SELECT niche, kind, path AS source_path, 'content/newsletters/latest-' || niche || '.md' AS dest_path FROM allf WHERE kind = 'newsletter'""")
def q_site_routing(spark, sf):
    pub, _, _ = published(spark, sf)
    return normalise(PB.site_routing(pub).select("niche", "kind", "source_path", "dest_path"))


# K3 -----------------------------------------------------------------------------------------------------------
@register("latest_edition", pairs_sql(CAP) + _PUB_CTES + """
SELECT niche, CAST(run_date AS VARCHAR) AS run_date, 'output/latest-' || niche || '.md' AS path, path AS target
FROM news""")
def q_latest_edition(spark, sf):
    pub, _, _ = published(spark, sf)
    return normalise(PB.latest_rows(pub).select("niche", "run_date", "path", "target"))


# F21, F24, W5, W6, A6, K8 ----------------------------------------------------------------------------------------
def _trunc(x, n):
    return f"CASE WHEN length({x}) <= {n} THEN {x} ELSE substring({x}, 1, {n - 3}) || '...' END"


_THREAD_SQL = edition_sql(f""",
posts AS (SELECT niche, list_concat(
            ['\U0001F4F0 ' || title || {NL} || {NL} || introduction],
            list_transform(top_stories[1:3], lambda s, i: CAST(i AS VARCHAR) || '. ' || s.title || {NL} || {NL} || s.summary || {NL} || {NL} || 'Read more: ' || s.url),
            CASE WHEN len(trends) > 0 THEN ['\U0001F4C8 Today''s Trends:' || {NL} || {NL} ||
                 array_to_string(list_transform(trends[1:3], lambda t: '• ' || t || {NL}), '')] ELSE [] END) AS p FROM ed)
SELECT niche, seq, text, {_trunc('text', 280)} AS text_280, CASE WHEN seq > 0 THEN seq - 1 ELSE -1 END AS reply_to_seq
FROM (SELECT niche, unnest(p) AS text, generate_subscripts(p, 1) - 1 AS seq FROM posts) q""")


@register("thread_posts", _THREAD_SQL.replace("\n,\nposts AS", ",\nposts AS").replace(")\n,\nposts", "),\nposts"))
def q_thread_posts(spark, sf):
    e, _ = editions(spark, sf)
    t = SO.thread_posts(e)   # the first post replies to nothing: -1 in this result
    return normalise(t.select("niche", "seq", "text", "text_280",
                              F.coalesce("reply_to_seq", F.lit(-1)).alias("reply_to_seq")))


# F22, F24, F25 ---------------------------------------------------------------------------------------------------
@register("article_post", pairs_sql() + f"""
SELECT article_id, {_trunc(f"'\U0001F4C4 ' || title || {NL} || {NL} || short_summary || {NL} || {NL} || "
                           f"CASE WHEN len(tags) > 0 THEN array_to_string(list_transform(tags[1:3], lambda t: '#' || replace(t, ' ', '')), ' ') || {NL} || {NL} ELSE '' END || "
                           f"'Read more: ' || source_url", 280)} AS post
FROM pairs""")
def q_article_post(spark, sf):
    p = ranked_pairs(spark, sf, parts=("summary", "tags"), write_pairs=False)
    return normalise(SO.article_post(p).select("article_id", "post"))


# F23, F26, P5 ----------------------------------------------------------------------------------------------------
_INS_POSTS = edition_sql(f""",
ip AS (SELECT niche, list_concat(['\U0001F50D ' || niche || ' Industry Insights - ' || {DATE_LONG} || {NL} || {NL} || 'Key takeaways from today''s news:'],
          list_transform(list_filter(string_split(insights, {NL} || {NL})[1:3], lambda p: length({strip('p')}) > 20), lambda p: {strip('p')})) AS p FROM ed),
x AS (SELECT niche, unnest(p) AS text, generate_subscripts(p, 1) - 1 AS seq FROM ip)
SELECT niche, seq, CASE WHEN seq = 0 THEN {_trunc('text', 278)} || ' \U0001F9F5' ELSE {_trunc('text', 280)} END AS post FROM x""")


@register("insights_thread", _INS_POSTS.replace(")\n,\nip AS", "),\nip AS"))
def q_insights_thread(spark, sf):
    e, _ = editions(spark, sf)
    return normalise(SO.insights_thread(e).select("niche", "seq", "post"))


# A3 ------------------------------------------------------------------------------------------------
@register("lead_topics", edition_sql("""
SELECT niche, lead_topics FROM ed"""))
def q_lead_topics(spark, sf):
    return normalise(T.lead_topics(capped_pairs(spark, sf)).select("niche", "lead_topics"))


# A2 ------------------------------------------------------------------------------------------------
@register("insight_corpus", edition_sql("""
SELECT e.niche, e.insight_corpus, CAST(len(i.insights) AS BIGINT) AS n_lines
FROM ed e JOIN ins i USING (niche, run_date) WHERE e.insight_corpus <> ''"""))
def q_insight_corpus(spark, sf):
    lines = T.insight_lines(capped_pairs(spark, sf)).filter(F.size("insights") > 0)
    return normalise(lines.select(
        "niche", F.array_join(F.transform("insights", lambda i: F.concat(F.lit("- "), i)), "\n").alias("insight_corpus"),
        F.size("insights").alias("n_lines")))
