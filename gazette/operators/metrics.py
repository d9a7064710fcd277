"""Run metrics (K6, A5, F34) and the declared quality rules."""

from __future__ import annotations

import datetime as _dt
import re

from pyspark.sql import DataFrame, Observation, functions as F

from gazette import config as C
from gazette.functions.dates import duration_seconds, iso_text
from gazette.operators.select import EDITION
from gazette.sources.documents import run_ts_lit


def run_metrics(unique_articles: DataFrame, paired: DataFrame, published: DataFrame,
                start: _dt.datetime, end: _dt.datetime) -> DataFrame:
    """K6 per edition: articles scraped (after dedup), summarised, article files and all
    files published (L13 keeps both), times as ISO text and the duration."""
    def count(df, name, cond=None):
        d = df if cond is None else df.filter(cond)
        return d.groupBy(*EDITION).agg(F.count("*").alias(name))
    m = (count(unique_articles, "articles_scraped")
         .join(count(paired, "articles_summarized"), list(EDITION), "left")
         .join(count(published, "articles_published", F.col("kind") == "article"), list(EDITION), "left")
         .join(count(published, "files_published"), list(EDITION), "left"))
    s, e = run_ts_lit(start), run_ts_lit(end)
    return m.select(*EDITION, iso_text(s).alias("start_time"), iso_text(e).alias("end_time"),
                    "articles_scraped",
                    *[F.coalesce(c, F.lit(0)).alias(c) for c in ("articles_summarized", "articles_published", "files_published")],
                    duration_seconds(s, e).alias("duration_seconds"))


def observe_counts(df: DataFrame, name: str = "run_counters") -> tuple[DataFrame, Observation]:
    """A5 without an extra job: counters gathered while the DataFrame is written."""
    obs = Observation(name)
    # observed metrics take no DISTINCT aggregates: editions are counted approximately
    return df.observe(obs, F.count(F.lit(1)).alias("rows"),
                      F.approx_count_distinct(F.struct(*EDITION)).alias("editions_approx")), obs


def min_length(articles: DataFrame, n: int = C.MIN_CONTENT_LENGTH) -> DataFrame:
    """Content of at least 100 characters is valid."""
    return articles.withColumn("meets_min", F.length("content") >= n)


def keyword_pattern(keyword: str) -> str:
    """Whole-word, case-insensitive (ASCII word characters as boundaries)."""
    return r"(?i)(^|[^A-Za-z0-9_])" + re.escape(keyword).replace("\\ ", " ") + r"([^A-Za-z0-9_]|$)"


def relevance(articles: DataFrame, keywords=C.RELEVANCE_KEYWORDS) -> DataFrame:
    """Number of configured keywords found in the content."""
    score = sum((F.col("content").rlike(keyword_pattern(k)).cast("int") for k in keywords), F.lit(0))
    return articles.withColumn("relevance", score)


def language_filter(articles: DataFrame, languages=C.LANGUAGES, col: str = "niche") -> DataFrame:
    """Keep the configured languages."""
    return articles.filter(F.col(col).isin(list(languages)))
