"""Social posts as rows (F21-F26, W5, W6, P5, A6, K8). Nothing is posted."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from gazette import config as C
from gazette.functions.dates import long_date
from gazette.functions.text import ellipsis_truncate, hashtags, strip_ws
from gazette.operators.select import EDITION

# Post openers.
NEWS_MARK = "\U0001F4F0 "        # newspaper
TRENDS_HEAD = "\U0001F4C8 Today's Trends:\n\n"
TREND_BULLET = "• "
CLOSING_MARK = "\U0001F4D6 "     # open book
ARTICLE_MARK = "\U0001F4C4 "     # page facing up
INSIGHTS_MARK = "\U0001F50D "    # magnifying glass


def _posts_to_rows(df: DataFrame, posts: Column, keep=()) -> DataFrame:
    """posexplode the ordered posts; each post replies to the one before it (W5), and
    the full text and a 280-character version travel together (L11)."""
    x = df.select(*EDITION, *keep, F.posexplode(posts).alias("seq", "text"))
    return x.select(*EDITION, *keep, "seq", "text",
                    ellipsis_truncate("text", C.POST_MAX_CHARS).alias("text_280"),
                    F.when(F.col("seq") > 0, F.col("seq") - 1).alias("reply_to_seq"))


def thread_posts(editions: DataFrame, newsletter_url: str | None = None) -> DataFrame:
    """title post, three story posts, a trends post (three trends) when there are
    trends, and a closing post when a newsletter URL is configured (A6 count)."""
    title = F.concat(F.lit(NEWS_MARK), F.col("title"), F.lit("\n\n"), F.col("introduction"))
    stories = F.transform(F.slice("top_stories", 1, C.THREAD_STORIES), lambda s, i: F.concat(
        (i + 1).cast("string"), F.lit(". "), s["title"], F.lit("\n\n"), s["summary"], F.lit("\n\nRead more: "), s["url"]))
    trends = F.when(F.size("trends") > 0, F.array(F.concat(
        F.lit(TRENDS_HEAD),
        F.array_join(F.transform(F.slice("trends", 1, C.THREAD_TRENDS),
                                 lambda t: F.concat(F.lit(TREND_BULLET), t, F.lit("\n"))), ""))))\
        .otherwise(F.array().cast("array<string>"))
    closing = (F.array(F.concat(F.lit(CLOSING_MARK + "Read the full newsletter with "), F.col("articles_count").cast("string"),
                                F.lit(" articles and detailed analysis:\n" + newsletter_url)))
               if newsletter_url else F.array().cast("array<string>"))
    return _posts_to_rows(editions, F.concat(F.array(title), stories, trends, closing))


def article_post(paired: DataFrame) -> DataFrame:
    """one post per article: title, summary, three hashtags (F25), URL; cut to 280."""
    text = F.concat(F.lit(ARTICLE_MARK), F.col("title"), F.lit("\n\n"), F.col("short_summary"), F.lit("\n\n"),
                    F.when(F.size("tags") > 0, F.concat(hashtags("tags"), F.lit("\n\n"))).otherwise(F.lit("")),
                    F.lit("Read more: "), F.col("source_url"))
    return paired.select("article_id", *EDITION, ellipsis_truncate(text, C.POST_MAX_CHARS).alias("post"))


def insights_thread(editions: DataFrame, run_ts_col: str = "run_ts", marker: str = C.THREAD_MARKER) -> DataFrame:
    """F23 + F26 + P5: an opening post, then the first three blank-line paragraphs of the
    insights kept when their stripped length is over 20 (limit before filter). The first
    post is cut to leave room for ' <marker>', the others to 280."""
    opening = F.concat(F.lit(INSIGHTS_MARK), F.col("niche"), F.lit(" Industry Insights - "), long_date(run_ts_col),
                       F.lit("\n\nKey takeaways from today's news:"))
    paras = F.transform(F.filter(F.slice(F.split(F.coalesce("insights", F.lit("")), "\n\n", -1), 1, C.INSIGHT_PARAGRAPHS),
                                 lambda p: F.length(strip_ws(p)) > C.INSIGHT_PARAGRAPH_MIN_CHARS),
                        lambda p: strip_ws(p))
    rows = _posts_to_rows(editions, F.concat(F.array(opening), paras))
    suffix = " " + marker
    first = F.concat(ellipsis_truncate("text", C.POST_MAX_CHARS - len(suffix)), F.lit(suffix))
    return rows.withColumn("post", F.when(F.col("seq") == 0, first).otherwise(F.col("text_280")))
