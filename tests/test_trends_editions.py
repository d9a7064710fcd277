from collections import Counter

from pyspark.sql import functions as F

from gazette.operators import edition as E
from gazette.operators import trends as T


def pairs_df(spark, rows):
    rows = [r + (f"a{r[2]}", 1, 0, "s", r[2]) for r in rows]
    return spark.createDataFrame(rows, "niche string, run_date string, rn int, tags array<string>, key_insights array<string>, "
                                       "article_id string, kind_rank int, source_pos int, source_name string, item_pos int")


def py_trends(tag_lists, cap=10):
    c = Counter(t for tags in tag_lists[:cap] for t in tags)
    return [f"{t} (mentioned in {n} articles)" for t, n in c.most_common(5) if n > 1]


def test_trends_fixture(spark):
    lists = [["a", "b", "x"], ["b", "a", "A"], ["c", "d"], ["d", "c", "e"], ["e", "f"], ["f", "g", "g"],
             ["h"], ["h"], ["i"], ["i"], ["zz", "zz"], ["zz"]]
    rows = [("AI", "2024-06-04", i + 1, t, []) for i, t in enumerate(lists)]
    rows += [("Solo", "2024-06-04", i + 1, [f"u{i}"], []) for i in range(3)]       # all counts 1
    got = T.trends(pairs_df(spark, rows)).orderBy("niche", "tag_rank").collect()
    assert [r.trend for r in got if r.niche == "AI"] == py_trends(lists)
    assert [r for r in got if r.niche == "Solo"] == []


def test_lead_topics_and_insights(spark):
    rows = [("AI", "d", 1, [], ["i1"]), ("AI", "d", 2, ["t2", "x"], ["i2", "i3"]), ("AI", "d", 3, ["t3"], []),
            ("AI", "d", 4, ["t4"], ["i4"]), ("AI", "d", 5, ["t5"], []), ("AI", "d", 6, ["t6"], ["i6"])]
    df = pairs_df(spark, rows)
    assert T.lead_topics(df).first().lead_topics == "t2, t3, t4"
    assert T.insight_lines(df).first().insights == ["i1", "i2", "i3", "i4", "i6"]


def test_edition_assembly_caps_and_empty(spark):
    rows = []
    for niche, n in (("AI", 23), ("Crypto", 1)):
        for i in range(n):
            rows.append((niche, "2024-06-04", f"{niche}{i}", f"Title {i}", f"src{i % 3}", f"http://x/{niche}/{i}",
                         "short", ["k1", "k2", "k3", "k4"], ["shared", f"t{i}"], 1, 0, i))
    df = spark.createDataFrame(rows, "niche string, run_date string, article_id string, title string, source_name string, "
                                     "source_url string, short_summary string, key_insights array<string>, "
                                     "tags array<string>, kind_rank int, source_pos int, item_pos int")
    ed = {r.niche: r for r in E.assemble(df).collect()}
    ai = ed["AI"]
    assert ai.articles_count == 23 and len(ai.top_stories) == 5 and len(ai.top_stories[0].key_insights) == 3
    assert ai.trends == ["shared (mentioned in 10 articles)"]
    assert ai.title == "AI Digest: shared, shared, shared"
    assert ai.introduction.startswith("Welcome to today's AI news digest! We've analyzed 23 articles")
    assert ed["Crypto"].trends == [] and ed["Crypto"].articles_count == 1
    assert [r.rn for r in E.quick_reads(df.withColumn("rn", F.col("item_pos") + 1)).filter("niche = 'AI'").collect()] == [6, 7, 8, 9, 10]
