"""Frequencies travel as numbers by bucket, and blocks of articles are not shuffled."""
import datetime as dt
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from gazette.operators import summarize as Z
from gazette.operators import term_blocks as TB

DAY = dt.date(2024, 6, 4)
COLUMNS = ["article_id", "niche", "run_date"]


def _articles(spark, n=90):
    rows = [(f"id{i:03d}", "ab"[i % 2] if i % 10 else None, DAY, " ".join(f"word{chr(97 + (i * j) % 23)}{chr(97 + j % 5)}" for j in range(i % 7 + 1)) + ".")
            for i in range(n)]
    return spark.createDataFrame(rows, "article_id string, niche string, run_date date, content string")


def _by_python(rows):
    """Articles of an edition that hold a term, and (as term "") all of them."""
    return Counter((r.niche, t) for r in rows if r.niche for t in {"", *r.content.rstrip(".").split()})


def test_numbers_come_back_by_bucket_and_in_the_order_of_places(spark):
    arts = _articles(spark)
    expect = _by_python(arts.collect())
    encoded = TB.encode(Z.with_text_only(arts.repartition(3)), COLUMNS, 400)
    words = encoded.filter("_vocabulary IS NOT NULL").collect()
    assert len({r["_block"] for r in words}) > 3
    assert len(words) == len({(r["_block"], r["_bucket"], r.niche) for r in words})
    assert {(r.niche, t): r["_bucket"] for r in words for t in r["_vocabulary"]}.keys() == {(k, t or TB._EDITION) for k, t in expect}
    back = {(r["_block"], r["_start"]): r["_df"] for r in TB.packed_frequencies(encoded).collect()}
    assert len(back) == len(words)
    for r in words:
        assert back[r["_block"], r["_start"]] == [expect[r.niche, "" if t == TB._EDITION else t] for t in r["_vocabulary"]]


def test_numbers_of_another_corpus(spark):
    arts = _articles(spark)
    head = arts.filter("article_id < 'id020'")
    expect = _by_python(arts.collect())
    own = TB.encode(Z.with_text_only(head), COLUMNS, 300)
    corpus = TB.encode(Z.with_text_only(arts.repartition(2)), ["niche", "run_date"], 400)
    words = own.filter("_vocabulary IS NOT NULL").collect()
    back = {(r["_block"], r["_start"]): r["_df"] for r in TB.packed_frequencies(own, corpus).collect()}
    assert len(back) == len(words)
    for r in words:
        assert back[r["_block"], r["_start"]] == [expect[r.niche, "" if t == TB._EDITION else t] for t in r["_vocabulary"]]


def test_blocks_meet_their_frequencies_without_a_shuffle_of_the_blocks(spark):
    got = Z.summaries_from_sentences(Z.with_sentences(_articles(spark)))
    plan = got._jdf.queryExecution().executedPlan().toString()
    met = plan[plan.index("FlatMapCoGroupsInArrow"):plan.index("MapInArrow run")]
    articles, numbers = met.split("FileScan")
    assert "_rows" in articles and "Exchange" not in articles
    assert "Bucketed: true" in numbers and "Exchange hashpartitioning(_block" in numbers
    assert got.count() == 90
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("gazette_")]


@pytest.mark.parametrize("top", [50, 1 << 61])      # the value and its position in one number, or too large for it
def test_grouped_values_are_those_of_unique(top):
    values = np.random.default_rng(1).integers(0, top, 4000)
    values = np.append(values, values[::3])
    for x in (values, values[:0]):
        distinct, place = TB._grouped(x)
        expect, at = np.unique(x, return_inverse=True)
        assert distinct.tolist() == expect.tolist() and place.tolist() == at.tolist()


def test_positions_come_to_the_rows_of_a_range_by_a_broadcast(spark):
    """The rows move once, to their ranges; the few counts then go to them."""
    from gazette.operators import select as S
    df = spark.range(500).select("id", (F.col("id") % 3).alias("g"), F.pmod(F.xxhash64("id"), F.lit(100)).alias("o"))
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = S.number_by_range(df, ["g"], ["o", "id"])
        plan = got._jdf.queryExecution().executedPlan().toString()
        rows = got.collect()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert "BroadcastHashJoin" in plan and "Exchange hashpartitioning" not in plan
    for g in range(3):
        mine = sorted((r.o, r.id, r.rn) for r in rows if r.g == g)
        assert [rn for _, _, rn in mine] == list(range(1, len(mine) + 1))


def test_rows_pass_unmarked_where_no_key_occurs_twice(spark):
    from gazette.operators import dedup as D
    order = ["kind_rank", "source_pos", "source_name", "item_pos"]
    df = spark.range(200).select(F.concat(F.lit("k"), "id").alias("article_hash"), F.lit("text").alias("content"), F.lit(1).alias("kind_rank"),
                                 F.lit(1).alias("source_pos"), F.lit("s").alias("source_name"), F.col("id").alias("item_pos"))
    assert "Join" not in D.first_copies(df)._jdf.queryExecution().executedPlan().toString()
    again = df.unionByName(df.withColumn("item_pos", F.col("item_pos") + 1000)).withColumn("article_hash", F.when(F.col("item_pos") % 7 > 0, F.col("article_hash")))
    got = {(r.article_hash, r.item_pos) for r in D.first_copies(again).collect()}
    assert got == {(r.article_hash, r.item_pos) for r in D.keep_first(again, order=[F.col(c) for c in order]).collect()}
