"""Edition assembly (Z3-Z5): title, introduction, top stories, trends, insights.
One row per (niche, run_date); every list is bounded by the caps of the digest."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from gazette import config as C
from gazette.functions.text import title_cleanup
from gazette.operators import trends as T
from gazette.operators.select import EDITION, first_k

# Fixed value: the introduction sentence.
INTRODUCTION = ("Welcome to today's %s news digest! We've analyzed %d articles to bring you the "
                "most important developments and insights.")


POSITIONAL = max(C.TREND_ARTICLES, C.INSIGHT_ARTICLES, C.TOP_STORIES, C.QUICK_READS[1])


def ranked_pairs(paired: DataFrame) -> DataFrame:
    """The numbered head of each edition (first 10): every positional rule reads only it."""
    return first_k(paired, POSITIONAL)


def top_stories(paired: DataFrame, k: int = C.TOP_STORIES, insights: int = C.STORY_INSIGHTS) -> DataFrame:
    """The first 5 pairs as story structs, 3 insights each."""
    x = ranked_pairs(paired).filter(F.col("rn") <= k)
    story = F.struct(F.col("rn").alias("p"), F.col("title").alias("title"),
                     F.col("source_name").alias("source"), F.col("source_url").alias("url"),
                     F.col("short_summary").alias("summary"),
                     F.slice("key_insights", 1, insights).alias("key_insights"))
    return x.groupBy(*EDITION).agg(
        F.transform(F.array_sort(F.collect_list(story)), lambda s: s.dropFields("p")).alias("top_stories"))


def quick_reads(paired: DataFrame, first: int = C.QUICK_READS[0], last: int = C.QUICK_READS[1]) -> DataFrame:
    """Articles 6-10 of each edition."""
    return ranked_pairs(paired).filter(F.col("rn").between(first, last))


def assemble(paired: DataFrame, title_responses: DataFrame | None = None,
             insight_responses: DataFrame | None = None,
             trend_cap: int | None = C.TREND_ARTICLES) -> DataFrame:
    """One edition row. Title and insights come from model responses when given
    (title cleaned by F18), else from the deterministic defaults:
    title = '<niche> Digest: <lead topics>', insights = insight lines as paragraphs."""
    p = ranked_pairs(paired)
    stats = T.source_stats(paired)
    tr = (T.trends(paired if trend_cap is None else p, cap=trend_cap).groupBy(*EDITION)
          .agg(T._ordered_values("trend", "tag_rank").alias("trends")))
    lines = T.insight_lines(p)
    leads = T.lead_topics(p)
    stories = top_stories(p)
    e = (stats.join(stories, list(EDITION), "left").join(tr, list(EDITION), "left")
         .join(lines, list(EDITION), "left").join(leads, list(EDITION), "left"))
    empty = F.array().cast("array<string>")
    e = (e.withColumn("trends", F.coalesce("trends", empty))
          .withColumn("insights_list", F.coalesce("insights", empty))
          .withColumn("lead_topics", F.coalesce("lead_topics", F.lit("")))
          .withColumn("insight_corpus", F.array_join(F.transform("insights_list", lambda i: F.concat(F.lit("- "), i)), "\n"))
          .withColumn("introduction", F.format_string(INTRODUCTION, "niche", "articles_count")))
    default_title = F.when(F.col("lead_topics") == "", F.concat("niche", F.lit(" Digest"))).otherwise(
        F.concat("niche", F.lit(" Digest: "), "lead_topics"))
    default_insights = F.array_join("insights_list", "\n\n")
    if title_responses is not None:
        e = e.join(title_responses.select(*EDITION, F.col("response").alias("_t")), list(EDITION), "left")
        default_title = F.coalesce(title_cleanup("_t"), default_title)
    if insight_responses is not None:
        e = e.join(insight_responses.select(*EDITION, F.col("response").alias("_i")), list(EDITION), "left")
        default_insights = F.coalesce("_i", default_insights)
    return e.select(*EDITION, default_title.alias("title"), "introduction",
                    F.coalesce("top_stories", F.array().cast(
                        "array<struct<title:string,source:string,url:string,summary:string,key_insights:array<string>>>"))
                    .alias("top_stories"),
                    "trends", default_insights.alias("insights"), "articles_count", "sources_count",
                    "top_sources", "top_tags", "lead_topics", "insight_corpus")
