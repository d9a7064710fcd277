"""Registered queries: listing pages, model titles and insights, the provider hook, custom
sources and publishers, and scheduled incremental runs."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import functions as F

from gazette import config as C
from gazette.functions.text import first_line, strip_ws
from gazette.operators import edition as E
from gazette.operators import summarize as Z
from gazette.plans.common import normalise, sql_hashed_articles, sql_strip, sql_web_articles, table
from gazette.plans.edition_plans import capped_pairs, edition_sql
from gazette.plans.text_plans import _PROMPT_SQL
from gazette.session import materialize, scratch_path
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


# S7, S8, J6, S11, W2 ------------------------------------------------------------------------
# Pages of a host, 50 page ids at a time, are linked by a listing page, which names its first
# link twice. Every listing is a web source with its own selectors and a cap of three links.
LISTED = 50
SELECTORS = {"articles": "ul.items li", "title": "h1", "content": "article"}


@register("scrape_listings", f"""
WITH p AS (SELECT page_id, url, regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)', 1) AS host, page_id // {LISTED} AS block FROM pages),
r AS (SELECT *, row_number() OVER (PARTITION BY host, block ORDER BY page_id) AS n FROM p WHERE host <> ''),
l AS (SELECT host, block, url, n AS item_pos FROM r UNION ALL SELECT host, block, url, 0 AS item_pos FROM r WHERE n = 1),
w AS (SELECT source_url, max_by(struct_pack(title := title, content := content, article_id := article_id), item_pos) AS a
      FROM ({sql_web_articles()}) x WHERE item_pos IN (SELECT max(page_id) FROM pages GROUP BY url) GROUP BY source_url)
SELECT a.article_id AS article_id, host || '/' || CAST(block AS VARCHAR) AS source_name, block AS source_pos, item_pos, a.title AS title, url AS source_url,
       CAST(length(a.content) AS BIGINT) AS content_chars
FROM l JOIN w ON w.source_url = l.url WHERE item_pos < 3""")
def q_scrape_listings(spark, sf):
    from gazette.functions.urls import netloc
    from gazette.sources.pages import scrape_sources
    pages = table(spark, sf, "pages").select("page_id", "url", "html")
    p = pages.select("page_id", "url", netloc("url").alias("host"), F.floor(F.col("page_id") / LISTED).alias("block")).filter("host <> ''")
    item = F.concat(F.lit('<li><a href="'), F.replace(F.replace("url", F.lit("&"), F.lit("&amp;")), F.lit('"'), F.lit("&quot;")), F.lit('">page</a></li>'))
    lists = (p.withColumn("item", item).groupBy("host", "block")                 # at most LISTED links each
             .agg(F.transform(F.array_sort(F.collect_list(F.struct("page_id", "item"))), lambda x: x["item"]).alias("items")))
    lists = lists.select("host", "block", F.concat(F.lit("https://"), "host", F.lit("/list/"), F.col("block").cast("string")).alias("url"),
                         F.concat(F.lit('<html><body><ul class="items">'), F.element_at("items", 1), F.array_join("items", ""), F.lit("</ul></body></html>")).alias("html"))
    lists = materialize(lists, "listings")
    sources = lists.select(F.lit("web").alias("kind"), F.concat("host", F.lit("/"), F.col("block").cast("string")).alias("source_name"),
                           F.col("block").cast("int").alias("source_pos"), "url", F.lit(3).alias("max_articles"),
                           F.create_map(*[F.lit(x) for kv in SELECTORS.items() for x in kv]).alias("selectors"))
    landed = pages.unionByName(lists.select(F.xxhash64("url").alias("page_id"), "url", "html"))
    arts = scrape_sources(sources, landed, niche="World")
    return normalise(arts.select("article_id", "source_name", "source_pos", "item_pos", "title", "source_url", F.length("content").alias("content_chars")))


# F18, Z3, Z4, E2 (responses of a model for titles and insights) --------------------------------
# The model's title of an edition is its last article title in quotes, its insights the first
# title; German editions get no response and keep the defaults.
@register("model_titles", edition_sql(f"""
SELECT niche, CASE WHEN m.hi IS NOT NULL THEN regexp_replace(regexp_replace({sql_strip("' \"''' || m.hi || '''\" '")}, '\\A"+|"+\\z', '', 'g'), '\\A''+|''+\\z', '', 'g') ELSE title END AS title,
       CASE WHEN m.lo IS NOT NULL THEN 'On ' || m.lo ELSE insights END AS insights, articles_count
FROM ed LEFT JOIN (SELECT niche, max(title) AS hi, min(title) AS lo FROM pairs WHERE niche <> 'de' GROUP BY niche) m USING (niche)"""))
def q_model_titles(spark, sf):
    p = capped_pairs(spark, sf)
    said = p.filter("niche <> 'de'").groupBy("niche", "run_date").agg(F.max("title").alias("hi"), F.min("title").alias("lo"))
    said = materialize(said, "model-responses")
    titles = said.select("niche", "run_date", F.concat(F.lit(" \"'"), "hi", F.lit("'\" ")).alias("response"))
    insights = said.select("niche", "run_date", F.concat(F.lit("On "), "lo").alias("response"))
    return normalise(E.assemble(p, titles, insights).select("niche", "title", "insights", "articles_count"))


# E2, J1, J2, P1, P3 ---------------------------------------------------------------------------
# A provider that answers with the length of its prompt, and fails (no row) where that is
# divisible by seven: those articles have no pair and no record.
def _length_provider(batches):
    import json

    import pandas as pd
    for pdf in batches:
        ok = pdf[pdf["prompt"].str.len() % 7 != 0]
        said = [json.dumps({"short_summary": f"{len(p)} characters", "tags": [f"t{len(p) % 5}"], "key_insights": []}) for p in ok["prompt"]]
        yield pd.DataFrame({"article_id": ok["article_id"].to_numpy(), "response": said})


@register("provider_records", f"""
SELECT article_id, title, CAST(n AS VARCHAR) || ' characters' AS short_summary, 't' || CAST(n % 5 AS VARCHAR) AS tag
FROM (SELECT article_id, title, length({_PROMPT_SQL}) AS n FROM ({sql_hashed_articles()}) a) q WHERE n % 7 <> 0""")
def q_provider_records(spark, sf):
    arts = articles_from_documents(table(spark, sf, "documents"))
    responses = materialize(Z.call_provider(Z.article_prompts(arts), _length_provider), "responses")
    paired = Z.pairs(arts.drop("content"), Z.parse_responses(responses))
    rec = Z.publish_records(paired)
    return normalise(rec.select("article_id", "article.title", "summary.short_summary", F.element_at("summary.tags", 1).alias("tag")))


# E1, E3 ----------------------------------------------------------------------------------------
def assistant_turns(spark, cfg):
    """A custom source: assistant turns as articles, the conversation as their source."""
    t = table(spark, cfg["sf_dir"], "conversations").filter("role = 'assistant'")
    ts = run_ts_lit(C.DEFAULT_RUN_TS)
    return (t.withColumn("title", strip_ws(first_line(F.col("text")))).select(
        F.md5(F.concat_ws(":", F.col("conv_id").cast("string"), F.col("turn").cast("string")).cast("binary")).alias("article_id"),
        F.lit("Talk").alias("niche"), F.to_date(ts).alias("run_date"), "title", F.col("text").alias("content"),
        F.lit(None).cast("string").alias("author"), F.lit(None).cast("timestamp").alias("date"), F.lit(None).cast("string").alias("date_text"),
        F.concat(F.lit("talk:"), F.col("conv_id").cast("string")).alias("source_url"), F.lit("talk").alias("source_name"),
        F.lit(2).alias("kind_rank"), F.lit(0).alias("source_pos"), (F.col("conv_id") * 1000 + F.col("turn")).alias("item_pos"), ts.alias("ingested_at")))


def plain_text_publisher(editions, pairs):
    """One text file for each article."""
    return pairs.select("niche", "run_date", F.lit("text").alias("kind"), F.concat(F.lit("talk/"), F.col("item_pos").cast("string"), F.lit(".txt")).alias("path"), F.col("title").alias("body"))


def counts_publisher(editions, pairs):
    """One file for each edition with its number of articles."""
    return editions.select("niche", "run_date", F.lit("counts").alias("kind"), F.concat("niche", F.lit(".csv")).alias("path"), F.col("n").cast("string").alias("body"))


@register("custom_hooks", f"""
WITH a AS (SELECT conv_id * 1000 + turn AS item_pos, {sql_strip("split_part(text, chr(10), 1)")} AS title FROM conversations WHERE role = 'assistant')
SELECT 'Talk' AS niche, 'text' AS kind, 'talk/' || CAST(item_pos AS VARCHAR) || '.txt' AS path, title AS body FROM a
UNION ALL SELECT 'Talk' AS niche, 'counts' AS kind, 'Talk.csv' AS path, CAST(count(*) AS VARCHAR) AS body FROM a HAVING count(*) > 0""")
def q_custom_hooks(spark, sf):
    from gazette import schemas
    arts = schemas.custom_source(assistant_turns, spark, {"sf_dir": sf})
    editions = arts.groupBy("niche", "run_date").agg(F.count("*").alias("n"))
    out = schemas.custom_publishers([plain_text_publisher, counts_publisher], editions, arts)
    return normalise(out.select("niche", "kind", "path", "body"))


# T1, T4, K5, S10 ----------------------------------------------------------------------------------
# Two scheduled runs of one stream, a day apart. The second finds the even documents again,
# next to the odd ones, and publishes the odd ones alone.
@register("incremental_runs", f"""
SELECT niche, 1 + item_pos % 2 AS run_no, count(*) AS articles, min(item_pos) AS first_doc, max(item_pos) AS last_doc
FROM ({sql_hashed_articles()}) a GROUP BY ALL""")
def q_incremental_runs(spark, sf):
    from gazette.streaming import ledger as L
    from gazette.streaming.runs import start_incremental
    arts = articles_from_documents(table(spark, sf, "documents"), niche_col="lang").drop("date")
    base = scratch_path(spark, "incremental")

    def build(fresh):
        return fresh.groupBy("niche", "run_date").agg(F.count("*").alias("articles"), F.min("item_pos").alias("first_doc"), F.max("item_pos").alias("last_doc"))

    for k in range(2):
        arts.filter(F.col("item_pos") % 2 <= k).write.mode("append").parquet(base + "/landed")
        stream = spark.readStream.schema(arts.schema).parquet(base + "/landed")
        start_incremental(stream, base + "/seen", base + "/out", base + "/checkpoint", C.DEFAULT_RUN_TS + _dt.timedelta(days=k), build).awaitTermination()
    rows = L.visible(spark.read.parquet(base + "/out"), L.committed(spark, base + "/out"), "run_no")
    return normalise(rows.select("niche", "run_no", "articles", "first_doc", "last_doc"))
