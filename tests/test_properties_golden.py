import datetime as dt
import re

from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from gazette.functions import text as X
from gazette.operators import render as R

ALPHABET = st.sampled_from(list("ab <>:\"/\\|?*.\n\t") + [" ", "\U0001F4F0", "é", "　"])
TEXTS = st.lists(st.text(alphabet=ALPHABET, max_size=300), min_size=1, max_size=25)


def py_truncate(t, n, suffix="..."):
    return t if len(t) <= n else t[: n - len(suffix)] + suffix


def py_sanitize(name):
    return re.sub(r'[<>:"/\\|?*]', "", name).strip()[:200]


@settings(max_examples=15, deadline=None)
@given(TEXTS)
def test_truncate_and_filename_properties(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "s string")
    rows = df.select(X.ellipsis_truncate("s", 280).alias("t"), X.safe_filename("s").alias("f")).collect()
    assert [r.t for r in rows] == [py_truncate(v, 280) for v in values]
    assert [r.f for r in rows] == [py_sanitize(v) for v in values]
    assert all(len(r.t) <= 280 for r in rows)


def test_golden_article_page(spark):
    """F29 + F32 for a publish pair without author and detailed summary (FIXTURES A5)."""
    df = spark.createDataFrame(
        [("AI Article", "Tech Blog", "https://example.com", None, "2024-06-04", "Brief summary...",
          ["Insight 1", "Insight 2"], ["AI", "Technology"], None, dt.datetime(2024, 6, 4, 9))],
        "title string, source_name string, source_url string, author string, date_text_iso string, "
        "short_summary string, key_insights array<string>, tags array<string>, detailed_summary string, run_ts timestamp")
    page = R.article_page(df).first().page
    assert page == ("# AI Article\n\n*Published on June 04, 2024*\n\n"
                    "### AI Article\n\n**Source:** [Tech Blog](https://example.com)\n**Date:** 2024-06-04\n\n"
                    "**Summary:** Brief summary...\n\n**Key Insights:**\n- Insight 1\n- Insight 2\n\n"
                    "**Tags:** AI, Technology\n\n---\n\n")


def test_golden_newsletter_sections(spark):
    """F30 for the newsletter content of FIXTURES A4 (one story, two insights, one trend)."""
    story = F.struct(F.lit("Major AI Breakthrough").alias("title"), F.lit("Tech News").alias("source"),
                     F.lit("https://example.com").alias("url"), F.lit("Researchers achieve new milestone...").alias("summary"),
                     F.array(F.lit("Insight 1"), F.lit("Insight 2")).alias("key_insights"))
    ed = spark.range(1).select(F.lit("AI").alias("niche"), F.lit("2024-06-04").alias("run_date"),
                               F.lit("AI News Digest - June 2024").alias("title"),
                               F.lit("Welcome to this week's AI news digest!").alias("introduction"),
                               F.array(story).alias("top_stories"), F.array(F.lit("Trend 1")).alias("trends"),
                               F.lit("This week showed significant progress...").alias("insights"),
                               F.lit(dt.datetime(2024, 6, 4, 9)).alias("run_ts"))
    pairs = spark.createDataFrame([], "niche string, run_date string, rn int, title string, source_name string, "
                                      "source_url string, author string, date timestamp, short_summary string, "
                                      "key_insights array<string>, tags array<string>")
    body = R.newsletter_plain(ed, pairs).first().body
    assert body.startswith("# AI News Digest - June 2024\n\n*Generated on June 04, 2024*\n\n## Table of Contents\n\n")
    assert ("## Top Stories\n\n### 1. Major AI Breakthrough\n\n**Source:** [Tech News](https://example.com)\n\n"
            "Researchers achieve new milestone...\n\n**Key Points:**\n- Insight 1\n- Insight 2\n\n"
            "## Trends\n\n- Trend 1\n\n## Insights & Analysis\n\nThis week showed significant progress...\n\n---\n\n") in body
    assert "## All Articles" not in body                      # no articles: section omitted
