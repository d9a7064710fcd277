"""Registered queries: articles, hashing, dedup (batch and TTL), caps."""

from __future__ import annotations

from pyspark.sql import functions as F

from gazette import config as C
from gazette.operators import dedup as D
from gazette.operators import select as S
from gazette.plans.common import (ORDER_SQL, RUN_TS_SQL, normalise, sql_articles,
                                  sql_hashed_articles, table)
from gazette.sources.documents import articles_from_documents, seen_from_labels

QUERIES = {}
ORACLES = {}


def register(name, sql=None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return deco


def doc_articles(spark, sf):
    return articles_from_documents(table(spark, sf, "documents"))


# M1, P1, P2, O1 ------------------------------------------------------------------
@register("articles_from_documents", f"""
SELECT article_id, niche, CAST(run_date AS VARCHAR) AS run_date, title, source_url, source_name,
       kind_rank, source_pos, item_pos, CAST(length(content) AS BIGINT) AS content_chars
FROM ({sql_hashed_articles()}) a""")
def q_articles_from_documents(spark, sf):
    a = doc_articles(spark, sf)
    return normalise(a.select("article_id", "niche", "run_date", "title", "source_url", "source_name",
                              "kind_rank", "source_pos", "item_pos", F.length("content").alias("content_chars")))


# F1 -------------------------------------------------------------------------------
@register("article_hash", f"""
SELECT item_pos AS doc_id, article_id FROM ({sql_hashed_articles()}) a""")
def q_article_hash(spark, sf):
    return normalise(doc_articles(spark, sf).select(F.col("item_pos").alias("doc_id"), "article_id"))


# W1, U2 (content-only hash: the same story from two sources is one) --------------
CONTENT_KEY_SQL = "md5(title || '::' || content)"


@register("dedup_first", f"""
SELECT article_hash, doc_id, source_name, copies FROM (
  SELECT {CONTENT_KEY_SQL} AS article_hash, item_pos AS doc_id, source_name,
         count(*) OVER (PARTITION BY {CONTENT_KEY_SQL}) AS copies,
         row_number() OVER (PARTITION BY {CONTENT_KEY_SQL} ORDER BY {ORDER_SQL}) AS k
  FROM ({sql_hashed_articles()}) a) q WHERE k = 1""")
def q_dedup_first(spark, sf):
    a = D.with_hash(doc_articles(spark, sf), ("title", None, "content"))
    copies = a.groupBy("article_hash").agg(F.count("*").alias("copies"))
    first = D.keep_first(a)
    return normalise(first.join(copies, "article_hash")
                     .select("article_hash", F.col("item_pos").alias("doc_id"), "source_name", "copies"))


# J3, P4, S10 -----------------------------------------------------------------------
SEEN_SQL = f"""
SELECT a.article_id AS article_hash, a.title, {RUN_TS_SQL} - to_days(3 + 5 * l.quality) AS seen_at
FROM ({sql_hashed_articles()}) a JOIN labels l ON l.doc_id = a.item_pos"""


@register("dedup_seen_anti", f"""
SELECT article_id, doc_id FROM (
  SELECT article_id, item_pos AS doc_id,
         row_number() OVER (PARTITION BY article_id ORDER BY {ORDER_SQL}) AS k
  FROM ({sql_hashed_articles()}) a
  WHERE NOT EXISTS (SELECT 1 FROM ({SEEN_SQL}) s
                    WHERE s.article_hash = a.article_id AND s.seen_at > {RUN_TS_SQL} - INTERVAL 7 DAY)) q
WHERE k = 1""")
def q_dedup_seen_anti(spark, sf):
    a = doc_articles(spark, sf)
    seen = seen_from_labels(table(spark, sf, "labels"), a)
    kept = D.deduplicate(a, seen, C.DEFAULT_RUN_TS)
    return normalise(kept.select("article_id", F.col("item_pos").alias("doc_id")))


# K5 ----------------------------------------------------------------------------------
@register("seen_update", f"""
SELECT article_hash, title, seen_at FROM ({SEEN_SQL}) s WHERE seen_at > {RUN_TS_SQL} - INTERVAL 7 DAY
UNION ALL
SELECT article_id AS article_hash, title, {RUN_TS_SQL} AS seen_at FROM (
  SELECT article_id, title, row_number() OVER (PARTITION BY article_id ORDER BY {ORDER_SQL}) AS k
  FROM ({sql_hashed_articles()}) a
  WHERE NOT EXISTS (SELECT 1 FROM ({SEEN_SQL}) s
                    WHERE s.article_hash = a.article_id AND s.seen_at > {RUN_TS_SQL} - INTERVAL 7 DAY)) q
WHERE k = 1""")
def q_seen_update(spark, sf):
    a = doc_articles(spark, sf)
    seen = seen_from_labels(table(spark, sf, "labels"), a)
    kept = D.deduplicate(a, seen, C.DEFAULT_RUN_TS)
    return normalise(D.seen_update(kept, seen, C.DEFAULT_RUN_TS))


# T2, Z6 (batch, exact) ----------------------------------------------------------------
TTL_SQL = """
WITH RECURSIVE k AS (
  SELECT user_id, event_type, min(ts) AS t FROM events GROUP BY 1, 2
  UNION ALL
  SELECT e.user_id, e.event_type, e.nt FROM (
    SELECT k.user_id, k.event_type,
           (SELECT min(x.ts) FROM events x
             WHERE x.user_id IS NOT DISTINCT FROM k.user_id AND x.event_type IS NOT DISTINCT FROM k.event_type
               AND x.ts >= k.t + INTERVAL 7 DAY) AS nt
    FROM k) e
  WHERE nt IS NOT NULL)
SELECT min(ev.event_id) AS event_id, k.user_id, k.event_type, k.t AS ts
FROM k JOIN events ev ON ev.user_id IS NOT DISTINCT FROM k.user_id
                     AND ev.event_type IS NOT DISTINCT FROM k.event_type AND ev.ts = k.t
GROUP BY k.user_id, k.event_type, k.t"""


@register("ttl_dedup", TTL_SQL)
def q_ttl_dedup(spark, sf):
    ev = table(spark, sf, "events")
    return normalise(D.ttl_dedup(ev, ["user_id", "event_type"], ts="ts", id_col="event_id",
                                 ttl_days=C.SEEN_TTL_DAYS))


# W2, S11, S12, J5 -------------------------------------------------------------------------
# The sources dimension is the configuration: one row per feed, with 10 articles (as in the
# shipped configuration), 1500, or none given (the default of 20) by turns, all of kind rss.
@register("source_cap", f"""
SELECT source_name, doc_id, item_rank FROM (
  SELECT source_name, source_pos, item_pos AS doc_id,
         row_number() OVER (PARTITION BY kind_rank, source_name ORDER BY item_pos) AS item_rank
  FROM ({sql_articles()}) a) q
WHERE item_rank <= CASE source_pos % 3 WHEN 0 THEN 10 WHEN 1 THEN 1500 ELSE 20 END""")
def q_source_cap(spark, sf):
    from gazette.sources.config_dim import feed_dimension, join_sources
    docs = table(spark, sf, "documents")
    items = articles_from_documents(docs, validate=False)  # the cap comes before validity
    turn = F.col("source_pos") % 3
    dim = feed_dimension(docs).withColumn("max_articles", F.when(turn == 0, 10).when(turn == 1, 1500))
    capped = S.cap_per_source(join_sources(items, dim, kinds=("rss",)), "max_articles", "item_rank", largest_cap=1500)
    return normalise(capped.select("source_name", F.col("item_pos").alias("doc_id"), "item_rank"))
