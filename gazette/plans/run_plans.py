"""Registered queries of whole runs: several runs over two days with one ledger, and a run
from a configuration with all its outputs."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import functions as F

from gazette import config as C
from gazette.plans.common import ORDER_SQL, normalise, sql_articles, sql_hashed_articles, sql_web_articles, table
from gazette.plans.digest_plans import SRC_SQL
from gazette.plans.edition_plans import _PUB_CTES, _THREAD_SQL, _safe_sql, CAP, NEWSLETTER_SQL, SECTIONS_CTE, edition_sql
from gazette.session import scratch_path
from gazette.streaming import ledger as L

QUERIES = {}
ORACLES = {}


def register(name, sql=None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return deco


# K1, K2, K3, K5, K6, K7, S10, T1 ---------------------------------------------------------
# Three runs: two on one day, the third on the next. Each is given the earlier runs' articles
# again, which the seen state drops; the last body of a path and the last edition count.
RUN_TIMES = (_dt.datetime(2024, 6, 4, 9), _dt.datetime(2024, 6, 4, 18), _dt.datetime(2024, 6, 5, 9))

_SLUG = _safe_sql(f"substring(title, 1, {C.SLUG_TITLE_CHARS})")


@register("digest_runs", f"""
WITH a AS (SELECT niche, title, doc_id % 3 + 1 AS run_no, CASE WHEN doc_id % 3 = 2 THEN '2024-06-05' ELSE '2024-06-04' END AS run_date,
                  row_number() OVER (PARTITION BY niche, doc_id % 3 ORDER BY {ORDER_SQL}) AS rn
           FROM (SELECT *, item_pos AS doc_id FROM ({sql_hashed_articles().replace('*', 'a.* EXCLUDE (doc_id)', 1)}) a) q),
e AS (SELECT niche, run_date, run_no, count(*) AS n FROM a GROUP BY ALL),
files AS (SELECT niche, run_date, run_no, 'newsletter' AS kind, 'output/' || {_safe_sql("run_date || '-' || niche || '-digest'")} || '.md' AS path FROM e
          UNION ALL SELECT niche, run_date, run_no, 'index' AS kind, 'output/index-' || {_safe_sql('niche')} || '.md' AS path FROM e
          UNION ALL SELECT DISTINCT niche, run_date, run_no, 'article' AS kind, 'output/articles/' || {_safe_sql('niche')} || '/' || run_date || '-' || {_SLUG} || '.md' AS path
                    FROM a WHERE rn <= {C.PUBLISHED_ARTICLE_PAGES}),
cur AS (SELECT niche, run_date, kind, path, max(run_no) AS run_no FROM files GROUP BY ALL),
last AS (SELECT niche, max(run_date) AS run_date FROM cur WHERE kind = 'newsletter' GROUP BY niche),
counted AS (SELECT f.niche, f.run_date, f.run_no, count(*) AS files FROM files f GROUP BY ALL)
SELECT niche, run_date, kind, path, run_no, kind = 'newsletter' AND run_date = (SELECT l.run_date FROM last l WHERE l.niche = cur.niche) AS latest FROM cur
UNION ALL
SELECT e.niche, e.run_date, 'metrics' AS kind, 'new ' || CAST(n AS VARCHAR) || ', summarised ' || CAST(least(n, {CAP}) AS VARCHAR) || ', files ' || CAST(files AS VARCHAR) AS path,
       e.run_no, false AS latest
FROM e JOIN counted USING (niche, run_date, run_no)""")
def q_digest_runs(spark, sf):
    from gazette.digest import run_digest
    from gazette.operators import publish as PB
    from gazette.sources.documents import articles_from_documents
    docs = table(spark, sf, "documents")
    base = scratch_path(spark, "digest-runs")
    out, seen = base + "/published", base + "/seen"
    for k, ts in enumerate(RUN_TIMES):
        run_digest(articles_from_documents(docs, run_ts=ts).filter(F.col("item_pos") % 3 <= k), out, seen, ts)
    runs = L.committed(spark, out)
    now = PB.current_files(spark.read.parquet(out), runs).join(runs.select("run", "run_no"), "run")
    target = PB.latest_rows(now).select("niche", F.col("target").alias("path"), F.lit(True).alias("latest"))
    files = now.join(target, ["niche", "path"], "left").select("niche", "run_date", "kind", "path", "run_no", F.coalesce("latest", F.lit(False)).alias("latest"))
    m = L.read_side(spark, out, "metrics")
    metrics = m.select("niche", "run_date", F.lit("metrics").alias("kind"),
                       F.format_string("new %d, summarised %d, files %d", "articles_scraped", "articles_summarized", "files_published").alias("path"),
                       "run_no", F.lit(False).alias("latest"))
    return normalise(files.unionByName(metrics))


# S11, S12, J5, P9, P10, W2, K1, K2, K4, K6, K7, K8, A6 -------------------------------------
CONFIG = {
    "niche": "World",
    "sources": {"web_scraping": [{"url": "https://example.org/", "max_articles": 3}, {"url": "https://example.net/", "max_articles": 4}],
                "rss_feeds": [{"url": "https://src7.example.com/feed", "name": "src7"}, {"url": "https://src0.example.com/feed", "name": "src0", "max_articles": 3},
                              {"url": "https://src3.example.com/feed", "name": "src3", "max_articles": 50}]},
    "publishing": {"markdown": {"enabled": True}, "twitter": {"enabled": True}, "github": {"enabled": True}},
}
NEWSLETTER_URL = "https://example.org/digest"

_CONFIG_SRC = f"""
items AS (SELECT 'web' AS kind, 0 AS kind_rank, regexp_extract(source_name, '[^.]+[.][^.]+$') AS source_name, item_pos, title, content, CAST(NULL AS VARCHAR) AS author, source_url
          FROM ({sql_web_articles()}) w
          UNION ALL SELECT 'rss' AS kind, 1 AS kind_rank, source_name, item_pos, title, content, author, source_url FROM ({sql_articles()}) d),
conf AS (SELECT * FROM (VALUES ('web', 'example.org', 0, 3), ('web', 'example.net', 1, 4), ('rss', 'src7', 0, 20), ('rss', 'src0', 1, 3), ('rss', 'src3', 2, 50))
         AS c(kind, source_name, source_pos, max_articles)),
taken AS (SELECT * FROM (SELECT i.*, c.source_pos, c.max_articles, row_number() OVER (PARTITION BY i.kind, i.source_name ORDER BY item_pos) AS item_rank
                         FROM items i JOIN conf c USING (kind, source_name)) q WHERE item_rank <= max_articles),
src AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY article_id ORDER BY {ORDER_SQL}) AS k
                       FROM (SELECT *, 'World' AS niche, DATE '2024-06-04' AS run_date,
                                    md5(title || ':' || source_url || ':' || substring(content, 1, {C.HASH_CONTENT_CHARS})) AS article_id
                             FROM taken WHERE coalesce(title, '') <> '' AND coalesce(content, '') <> '') a) q WHERE k = 1)"""

_CLOSING = ("'\U0001F4D6 Read the full newsletter with ' || CAST(articles_count AS VARCHAR) || ' articles and detailed analysis:' || chr(10) || "
            f"'{NEWSLETTER_URL}'")
_THREAD_CTE = (_THREAD_SQL.replace(")\n,\nposts", "),\nposts").replace("\n,\nposts AS", ",\nposts AS")
               .replace("ELSE [] END) AS p FROM ed)", f"ELSE [] END) || [{_CLOSING}] AS p FROM ed)"))


def _config_sql() -> str:
    thread_with, thread_select = _THREAD_CTE[_THREAD_CTE.index(",\nposts AS"):].split("\nSELECT niche, seq", 1)
    pub = _PUB_CTES.replace("files AS (", "pub_files AS (").replace("FROM files)", "FROM pub_files)")
    sql = edition_sql("", SECTIONS_CTE + pub + thread_with + f""",
allf AS (SELECT kind, path FROM pub_files UNION ALL SELECT 'index' AS kind, 'output/index-World.md' AS path),
n AS (SELECT (SELECT count(*) FROM src) AS new, (SELECT count(*) FROM pairs) AS summarised, (SELECT count(*) FROM allf) AS files)
SELECT 'newsletter' AS kind, (SELECT path FROM news) AS path, {NEWSLETTER_SQL} AS body FROM ed LEFT JOIN allsec USING (niche, run_date)
UNION ALL SELECT kind, path, '' AS body FROM allf WHERE kind <> 'newsletter'
UNION ALL SELECT 'route' AS kind, CASE WHEN contains(path, '/articles/') THEN 'content/articles/World/' ELSE 'content/newsletters/' END || regexp_extract(path, '[^/]*$') AS path, '' AS body FROM allf
UNION ALL SELECT 'route' AS kind, 'content/newsletters/latest-World.md' AS path, '' AS body
UNION ALL SELECT 'post' AS kind, CAST(seq AS VARCHAR) AS path, text AS body FROM (SELECT unnest(p) AS text, generate_subscripts(p, 1) - 1 AS seq FROM posts) q
UNION ALL SELECT 'metrics' AS kind, 'new ' || CAST(new AS VARCHAR) || ', summarised ' || CAST(summarised AS VARCHAR) || ', files ' || CAST(files AS VARCHAR) AS path, '' AS body FROM n""")
    return sql.replace(SRC_SQL, _CONFIG_SRC)


def land_tables(spark, sf, path):
    """Documents as feed items by source, pages as web items by site."""
    from gazette.sources.documents import articles_from_documents
    from gazette.sources.landed import land_items
    from gazette.sources.pages import web_articles
    feeds = articles_from_documents(table(spark, sf, "documents"), validate=False).withColumn("kind", F.lit("rss"))
    web = web_articles(table(spark, sf, "pages")).withColumn("kind", F.lit("web"))
    web = web.withColumn("source_name", F.regexp_extract("source_name", r"[^.]+[.][^.]+$", 0))
    land_items(feeds, path)
    land_items(web, path)


@register("digest_from_config", _config_sql())
def q_digest_from_config(spark, sf):
    import dataclasses

    from gazette.digest import digest_from_config
    from gazette.operators import publish as PB
    base = scratch_path(spark, "config-run")
    land_tables(spark, sf, base + "/landed")
    cfg = dataclasses.replace(C.run_config_from_dict(CONFIG), newsletter_url=NEWSLETTER_URL)
    out = base + "/published"
    digest_from_config(spark, cfg, base + "/landed", out, base + "/seen")
    files = PB.current_files(spark.read.parquet(out), L.committed(spark, out))
    rows = files.select("kind", "path", F.when(F.col("kind") == "newsletter", F.col("body")).otherwise("").alias("body"))
    routes = L.read_side(spark, out, "routes").select(F.lit("route").alias("kind"), F.col("dest_path").alias("path"), F.lit("").alias("body"))
    posts = L.read_side(spark, out, "posts").select(F.lit("post").alias("kind"), F.col("seq").cast("string").alias("path"), F.col("text").alias("body"))
    metrics = L.read_side(spark, out, "metrics").select(
        F.lit("metrics").alias("kind"),
        F.format_string("new %d, summarised %d, files %d", "articles_scraped", "articles_summarized", "files_published").alias("path"), F.lit("").alias("body"))
    return normalise(rows.unionByName(routes).unionByName(posts).unionByName(metrics))
