"""Per-edition aggregates: trends (A1, W3, P6), insight corpus (A2), lead topics (A3),
counts (A4, A7), top sources and tags (A8, A9)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from gazette import config as C
from gazette.operators.select import EDITION, first_k, order_key


def _ordered_values(value: str, pos: str) -> F.Column:
    return F.transform(F.array_sort(F.collect_list(F.struct(F.col(pos).alias("p"), F.col(value).alias("v")))),
                       lambda x: x["v"])


def tag_counts(paired: DataFrame, cap: int | None = C.TREND_ARTICLES, distinct: bool = False) -> DataFrame:
    """Tag occurrences over the first `cap` articles of each edition (cap None = all).
    A tag repeated inside one article counts twice unless distinct=True (L7)."""
    x = paired if cap is None else first_k(paired, cap)
    ex = x.select(*EDITION, "article_id", order_key().alias("_o"), F.posexplode("tags").alias("tag_pos", "tag"))
    if distinct:
        ex = ex.groupBy(*EDITION, "article_id", "_o", "tag").agg(F.min("tag_pos").alias("tag_pos"))
    # first occurrence = (article in canonical order, position in its tag list)
    return ex.groupBy(*EDITION, "tag").agg(
        F.count("*").alias("mentions"),
        F.min(F.struct("_o", "tag_pos")).alias("first_seen"))


def top_tags(counts: DataFrame, k: int = C.TREND_TOP) -> DataFrame:
    """K most common per edition; ties by first occurrence (Counter.most_common)."""
    w = Window.partitionBy(*EDITION).orderBy(F.col("mentions").desc(), F.col("first_seen").asc())
    return counts.withColumn("tag_rank", F.row_number().over(w)).filter(F.col("tag_rank") <= k)


def trends(paired: DataFrame, cap: int | None = C.TREND_ARTICLES, k: int = C.TREND_TOP,
           min_count: int = C.TREND_MIN_COUNT, distinct: bool = False) -> DataFrame:
    """A1: '{tag} (mentioned in {n} articles)' for the top-k tags with count > 1."""
    top = top_tags(tag_counts(paired, cap, distinct), k).filter(F.col("mentions") >= min_count)
    return top.select(*EDITION, "tag_rank", "tag", "mentions",
                      F.format_string("%s (mentioned in %d articles)", "tag", "mentions").alias("trend"))


def insight_lines(paired: DataFrame, articles: int = C.INSIGHT_ARTICLES,
                  lines: int = C.INSIGHT_LINES) -> DataFrame:
    """A2: insights of the first 10 articles, in order, first 20 (bounded per edition)."""
    ex = (first_k(paired, articles)
          .select(*EDITION, "rn", F.posexplode("key_insights").alias("i_pos", "insight")))
    return (ex.groupBy(*EDITION)
            .agg(F.slice(F.transform(F.array_sort(F.collect_list(F.struct("rn", "i_pos", "insight"))),
                                     lambda x: x["insight"]), 1, lines).alias("insights")))


def lead_topics(paired: DataFrame, scan: int = C.LEAD_TOPIC_SUMMARIES, k: int = C.LEAD_TOPICS) -> DataFrame:
    """A3: first tag of each of the first 5 summaries that have tags; first 3 joined ', '."""
    x = first_k(paired, scan).filter(F.size("tags") > 0).select(
        *EDITION, "rn", F.get(F.col("tags"), 0).alias("topic"))
    return x.groupBy(*EDITION).agg(F.array_join(F.slice(_ordered_values("topic", "rn"), 1, k), ", ")
                                   .alias("lead_topics"))


def source_stats(paired: DataFrame, k_sources: int = 3, k_tags: int = 5) -> DataFrame:
    """Article count, distinct sources, top 3 sources (count desc, name
    asc) and top 5 tags over the whole edition."""
    counts = paired.groupBy(*EDITION).agg(F.count("*").alias("articles_count"),
                                          F.countDistinct("source_name").alias("sources_count"))
    per_src = paired.groupBy(*EDITION, "source_name").agg(F.count("*").alias("n"))
    ws = Window.partitionBy(*EDITION).orderBy(F.col("n").desc(), F.col("source_name").asc())
    srcs = (per_src.withColumn("r", F.row_number().over(ws)).filter(F.col("r") <= k_sources)
            .groupBy(*EDITION).agg(_ordered_values("source_name", "r").alias("top_sources")))
    tags = (top_tags(tag_counts(paired, None), k_tags)
            .groupBy(*EDITION).agg(_ordered_values("tag", "tag_rank").alias("top_tags")))
    empty = F.array().cast("array<string>")
    return (counts.join(srcs, list(EDITION), "left").join(tags, list(EDITION), "left")
            .withColumn("top_sources", F.coalesce("top_sources", empty))
            .withColumn("top_tags", F.coalesce("top_tags", empty)))
