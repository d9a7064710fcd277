"""Registered queries: summaries, trends, editions."""

from __future__ import annotations

from pyspark.sql import functions as F

from gazette import config as C
from gazette.operators import dedup as D
from gazette.operators import edition as E
from gazette.operators import select as S
from gazette.operators import summarize as Z
from gazette.operators import trends as T
from gazette.plans.common import ORDER_SQL, normalise, sql_hashed_articles, sql_summaries, table
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


def unique_articles(spark, sf):
    """documents → articles → first per hash (nothing seen before)."""
    return D.deduplicate(articles_from_documents(table(spark, sf, "documents")))


def ranked_pairs(spark, sf, run_cap=None, parts=Z.ALL_PARTS, write_pairs=True):
    """Articles of each edition in canonical order (rn), with their extractive summaries.
    run_cap None = whole edition; 20 = max_articles_per_run. The text is
    split once: metadata, sentences (if asked for) and terms are written as one stage, and the
    pairs (no text) as another, since editions aggregate them many ways."""
    from gazette.session import materialize
    if run_cap is None:
        arts = unique_articles(spark, sf)
    else:
        arts = D.first_capped(articles_from_documents(table(spark, sf, "documents")), run_cap)
    sents = Z.with_text_only(arts) if set(parts) == {"tags"} else Z.with_sentences(arts)
    meta = [c for c in sents.columns if c not in ("article_id", "s")]
    p = Z.summaries_from_sentences(sents, keep=meta, parts=parts)
    return materialize(p, "pairs") if write_pairs else p


def head_pairs(spark, sf, k: int):
    """The first k articles of each edition with summaries whose term statistics (N, df)
    come from the whole edition: the per-article work runs for the head only."""
    unique = unique_articles(spark, sf)
    head = D.first_capped(articles_from_documents(table(spark, sf, "documents")), k)
    sents = Z.with_text_only(head)
    meta = [c for c in sents.columns if c not in ("article_id", "s")]
    corpus = Z.with_text_only(unique.select("article_id", "niche", "run_date", "content"))
    return Z.summaries_from_sentences(sents, corpus=corpus, keep=meta, parts=("tags",))


SRC_SQL = f"""
src AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY article_id ORDER BY {ORDER_SQL}) AS k
                      FROM ({sql_hashed_articles()}) a) q WHERE k = 1)"""


def pairs_sql(cap: int | None = None) -> str:
    capped = "" if cap is None else f"WHERE rn <= {cap}"
    return f"""
WITH {SRC_SQL},
ranked AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY niche, run_date ORDER BY {ORDER_SQL}) AS rn FROM src) q {capped}),
{sql_summaries("ranked")[5:] if False else sql_summaries("ranked").lstrip()},
pairs AS (SELECT r.*, s.short_summary, s.detailed_summary, s.key_insights, s.tags
          FROM ranked r JOIN summaries s USING (article_id))"""


# Z2 (extractive provider) ----------------------------------------------------------------
@register("extractive_tags", pairs_sql() + """
SELECT article_id, niche, array_to_string(tags, ', ') AS tags, CAST(len(tags) AS BIGINT) AS n_tags FROM pairs""")
def q_extractive_tags(spark, sf):
    p = ranked_pairs(spark, sf, parts=("tags",), write_pairs=False)
    return normalise(p.select("article_id", "niche", F.array_join("tags", ", ").alias("tags"),
                              F.size("tags").alias("n_tags")))


@register("extractive_summary", pairs_sql() + """
SELECT article_id, short_summary, detailed_summary, array_to_string(key_insights, ' | ') AS key_insights,
       CAST(len(key_insights) AS BIGINT) AS n_insights FROM pairs""")
def q_extractive_summary(spark, sf):
    p = ranked_pairs(spark, sf, parts=("summary", "insights"), write_pairs=False)
    return normalise(p.select("article_id", "short_summary", "detailed_summary",
                              F.array_join("key_insights", " | ").alias("key_insights"),
                              F.size("key_insights").alias("n_insights")))


# A1, W3, P6 -----------------------------------------------------------------------------------
def trends_sql(cap: int | None) -> str:
    where = "" if cap is None else f"WHERE rn <= {cap}"
    return pairs_sql() + f""",
ex AS (SELECT niche, run_date, rn, unnest(tags) AS tag, generate_subscripts(tags, 1) - 1 AS tag_pos FROM pairs {where}),
cnt AS (SELECT niche, run_date, tag, count(*) AS mentions, min(rn * 1048576 + tag_pos) AS first_seen FROM ex GROUP BY ALL),
rk AS (SELECT *, row_number() OVER (PARTITION BY niche, run_date ORDER BY mentions DESC, first_seen ASC) AS tag_rank FROM cnt)
SELECT niche, CAST(run_date AS VARCHAR) AS run_date, tag_rank, tag, mentions,
       tag || ' (mentioned in ' || CAST(mentions AS VARCHAR) || ' articles)' AS trend
FROM rk WHERE tag_rank <= 5 AND mentions >= 2"""


@register("trends", trends_sql(C.TREND_ARTICLES))
def q_trends(spark, sf):
    """Reference semantics: tags of the first 10 articles of each edition (term
    statistics over the whole edition)."""
    return normalise(T.trends(head_pairs(spark, sf, C.TREND_ARTICLES), cap=C.TREND_ARTICLES))


@register("trends_whole_edition", trends_sql(None))
def q_trends_whole_edition(spark, sf):
    """Trends over every article of the edition (cap parameter None)."""
    return normalise(T.trends(ranked_pairs(spark, sf, parts=("tags",), write_pairs=False), cap=None))
