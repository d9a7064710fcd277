"""Editions without a run cap: positions over sorted ranges, newsletters as ordered blocks."""
import datetime as dt
import glob
import os

from pyspark.sql import functions as F

from gazette import config as C
from gazette.operators import edition as E
from gazette.operators import render as R
from gazette.operators import select as S
from gazette.sources.documents import run_ts_lit

DAY = dt.date(2024, 6, 4)


def _rows(spark, hot=3000):
    rows = [("hot", i) for i in range(hot)] + [(f"n{i % 40}", i) for i in range(200)] + [(None, i) for i in range(5)]
    df = spark.createDataFrame([(n, DAY, 1, i % 7 if i % 11 else None, f"s{i % 3}", i // 2, f"id{n}{i:05d}") for n, i in rows],
                               "niche string, run_date date, kind_rank int, source_pos int, source_name string, item_pos long, article_id string")
    return df.repartition(9, "article_id")


def test_positions_equal_one_window_over_each_edition(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")      # several ranges at this size
    try:
        df = _rows(spark)
        got = S.number_editions(df)
        ranges = got.select("niche", "rn", F.spark_partition_id().alias("p"))
        expect = S.rank_within(df, S.EDITION, order=S.order_spec(("article_id",)))
        assert sorted(map(str, got.collect())) == sorted(map(str, expect.collect()))
        assert ranges.filter("niche = 'hot'").select("p").distinct().count() > 1
        assert S.number_editions(df.limit(0)).count() == 0
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def _pairs(spark):
    rows = [(f"a{i:02d}", "x" if i % 4 else "y", DAY, 1, 1, "src", i, f"Title {i}" if i != 5 else None, "https://e.org/" + str(i),
             None if i % 2 else "Ann", None, "Short.", "Long.", ["one"] if i % 3 else [], ["tag", f"t{i}"] if i % 5 else [])
            for i in range(30)]
    return spark.createDataFrame(rows, "article_id string, niche string, run_date date, kind_rank int, source_pos int, source_name string, "
                                 "item_pos long, title string, source_url string, author string, date timestamp, short_summary string, "
                                 "detailed_summary string, key_insights array<string>, tags array<string>")


def test_blocks_in_order_are_the_newsletter_also_as_files(spark, tmp_path):
    numbered = S.number_editions(_pairs(spark))
    ed = E.assemble(numbered).withColumn("run_ts", run_ts_lit(C.DEFAULT_RUN_TS))
    whole = {r.niche: r.body for r in R.newsletter_plain(ed, numbered).collect()}
    parts = R.newsletter_parts(ed, numbered)
    blocks = {}
    for r in sorted(parts.collect(), key=lambda r: (r.niche, r.part_no)):
        blocks[r.niche] = blocks.get(r.niche, "") + r.block
    assert blocks == whole and len(whole) == 2
    R.write_parts(parts, str(tmp_path / "letters"))
    for niche, body in whole.items():
        files = sorted(glob.glob(os.path.join(str(tmp_path), "letters", f"niche={niche}", "run_date=*", "part-*")))
        assert "".join(open(f, encoding="utf-8").read() for f in files) == body


def test_an_edition_without_articles_has_head_and_footer(spark):
    numbered = S.number_editions(_pairs(spark))
    ed = E.assemble(numbered).withColumn("run_ts", run_ts_lit(C.DEFAULT_RUN_TS))
    parts = R.newsletter_parts(ed, numbered.limit(0)).collect()
    assert sorted(r.part_no for r in parts) == [0, 0, 1, 1] and not any("All Articles\n\n#" in r.block for r in parts)


def test_small_and_large_caps_of_hot_sources(spark):
    sizes = {"small": (30_000, 10), "large": (30_000, 25_000), "short": (50, 20_000), "default": (400, None), "none": (5, 0)}
    rows = None
    for source, (n, cap) in sizes.items():
        one = spark.range(n).select(F.lit(1).alias("kind_rank"), F.lit(source).alias("source_name"), F.col("id").alias("item_pos"),
                                    F.lit(cap).cast("int").alias("max_articles"))
        rows = one if rows is None else rows.unionByName(one)
    expect = {"small": 10, "large": 25_000, "short": 50, "default": C.DEFAULT_RSS_MAX_ARTICLES}
    for largest in (None, 25_000):
        got = S.cap_per_source(rows, largest_cap=largest)
        out = got.groupBy("source_name").agg(F.count("*").alias("n"), F.max("item_pos").alias("last"), F.max("item_rank").alias("r")).collect()
        assert {r.source_name: r.n for r in out} == expect
        assert all(r.last + 1 == r.n == r.r for r in out)
