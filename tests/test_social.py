import datetime as dt

from pyspark.sql import functions as F

from gazette.operators import social as SO


def test_insights_thread_paragraphs(spark):
    ins = "\n\n".join(["x" * 20, "y" * 21, "  " + "z" * 30 + "  ", "w" * 50])
    df = spark.createDataFrame([("AI", "2024-06-04", dt.datetime(2024, 6, 4, 9), ins)],
                               "niche string, run_date string, run_ts timestamp, insights string")
    posts = [r.post for r in SO.insights_thread(df).orderBy("seq").collect()]
    assert posts[0] == "\U0001F50D AI Industry Insights - June 04, 2024\n\nKey takeaways from today's news: \U0001F9F5"
    assert posts[1:] == ["y" * 21, "z" * 30]                  # first 3 paragraphs, then length > 20


def test_thread_posts_and_reply_chain(spark):
    story = F.struct(F.lit("T").alias("title"), F.lit("S").alias("source"), F.lit("http://u").alias("url"),
                     F.lit("sum").alias("summary"), F.array().cast("array<string>").alias("key_insights"))
    df = (spark.range(1).select(F.lit("AI").alias("niche"), F.lit("d").alias("run_date"), F.lit("Title").alias("title"),
                                F.lit("Intro").alias("introduction"), F.array(story, story, story, story).alias("top_stories"),
                                F.array(F.lit("t1"), F.lit("t2"), F.lit("t3"), F.lit("t4")).alias("trends"),
                                F.lit(7).alias("articles_count")))
    rows = SO.thread_posts(df, newsletter_url="http://n").orderBy("seq").collect()
    assert len(rows) == 6 and [r.reply_to_seq for r in rows] == [None, 0, 1, 2, 3, 4]
    assert rows[4].text == "\U0001F4C8 Today's Trends:\n\n• t1\n• t2\n• t3\n"
    assert rows[5].text.endswith("with 7 articles and detailed analysis:\nhttp://n")
