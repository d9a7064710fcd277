"""Landed tables → canonical `articles` rows.

`documents` stand for feed articles (kind rss): title = first line, content = text.
`labels` stand for the catalogue of a previous run (the seen state).
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, functions as F

from gazette import config as C
from gazette.functions.text import article_hash, first_line, nonblank, strip_ws

ARTICLE_COLUMNS = ["article_id", "niche", "run_date", "title", "content", "author", "date",
                   "date_text", "source_url", "source_name", "kind_rank", "source_pos",
                   "item_pos", "ingested_at"]

KIND_RANK = {"web": 0, "rss": 1}   # web sources come before feeds (canonical order)


def run_ts_lit(run_ts: _dt.datetime):
    return F.lit(run_ts).cast("timestamp_ntz")


def source_position(source_col) -> F.Column:
    """Configuration position of a derived source: its numeric suffix (src7 -> 7)."""
    return F.expr(f"try_cast(regexp_extract({source_col}, '([0-9]+)$', 1) AS INT)")


def finish_articles(df: DataFrame, extra=()) -> DataFrame:
    """Required-field filter (P2) and the article hash (F1); canonical column order
    (plus any extra columns asked for)."""
    out = (df.filter(nonblank("title") & nonblank("content") & nonblank("source_url"))
             .withColumn("article_id", article_hash("title", "source_url", "content")))
    return out.select(*ARTICLE_COLUMNS, *extra)


def articles_from_documents(docs: DataFrame, run_ts: _dt.datetime = C.DEFAULT_RUN_TS,
                            niche_col: str | None = "lang", niche: str | None = None,
                            per_item_url: bool = True, validate: bool = True) -> DataFrame:
    """documents → articles; the edition niche is a column (lang) or a constant (P10).

    per_item_url=False gives every item of a source the same URL, so that copies of a
    text in one source hash equal (the hash includes the URL).
    """
    niche_expr = F.lit(niche) if niche is not None else F.col(niche_col)
    url = F.concat(F.lit("https://"), F.col("source"), F.lit(".example.com/"))
    if per_item_url:
        url = F.concat(url, F.col("doc_id").cast("string"))
    df = docs.select(
        niche_expr.alias("niche"),
        F.to_date(run_ts_lit(run_ts)).alias("run_date"),
        strip_ws(first_line(F.col("text"))).alias("title"),
        F.col("text").alias("content"),
        F.lit(None).cast("string").alias("author"),
        F.lit(None).cast("timestamp").alias("date"),
        F.lit(None).cast("string").alias("date_text"),
        url.alias("source_url"),
        F.col("source").alias("source_name"),
        F.lit(KIND_RANK["rss"]).alias("kind_rank"),
        source_position("source").alias("source_pos"),
        F.col("doc_id").alias("item_pos"),
        run_ts_lit(run_ts).alias("ingested_at"),
    )
    return finish_articles(df) if validate else df


def seen_from_labels(labels: DataFrame, articles: DataFrame, run_ts: _dt.datetime = C.DEFAULT_RUN_TS) -> DataFrame:
    """Seen state of a previous run: labelled documents were accepted 3 days before the
    run (quality 0) or 8 days before (quality 1, hence expired with a 7-day TTL)."""
    lab = labels.select(F.col("doc_id").alias("item_pos"), "quality")
    return (articles.select("article_id", "title", "item_pos").join(lab, "item_pos")
            .select(F.col("article_id").alias("article_hash"), "title",
                    (run_ts_lit(run_ts) - F.make_dt_interval(F.lit(3) + F.lit(5) * F.col("quality")))
                    .alias("seen_at")))
