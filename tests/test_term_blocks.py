"""Term statistics in blocks: the same tags and insights as by rows of (article, term)."""
import datetime as dt
from decimal import ROUND_HALF_UP, Decimal

import numpy as np
import pytest
from pyspark.sql import Window, functions as F

from gazette.functions.text import strip_ws
from gazette.operators import summarize as Z
from gazette.operators import term_blocks as TB

DAY = dt.date(2024, 6, 4)


def _articles(spark):
    rows = [(f"id{i:03d}", "abc"[i % 3], DAY, ". ".join(
        f"{'Über' if i % 4 else 'common'} word{'xyz'[(i + j) % 3]} rare{'qrst'[j % 4] * (i % 5 + 1)} ab {'pair' * (j % 2)}" for j in range(i % 9 + 1)) + " !\n ")
        for i in range(120)]
    rows += [("id900", "a", DAY, "1 2. 3 no"), ("id901", None, DAY, "common. word here. again word"), ("id902", "a", None, "no day here"),
             ("id903", "d", DAY, "alone in its edition"), ("id904", "a", DAY, None)]
    return spark.createDataFrame(rows, "article_id string, niche string, run_date date, content string")


def _by_rows(sents, corpus=None):
    w = Z.term_weights(sents, corpus)
    wt = Window.partitionBy("article_id").orderBy(F.desc("weight"), "term")
    tags, tops = {}, {}
    for r in w.withColumn("r", F.row_number().over(wt)).filter("r <= 5").orderBy("article_id", "r").collect():
        tags.setdefault(r.article_id, []).append(r.term)
    scored = w.select("article_id", "weight", F.explode("pos").alias("p")).groupBy("article_id", "p").agg(F.round(F.avg("weight"), 9).alias("x"))
    ws = Window.partitionBy("article_id").orderBy(F.desc("x"), "p")
    for r in scored.withColumn("r", F.row_number().over(ws)).filter("r <= 5").orderBy("article_id", "p").collect():
        tops.setdefault(r.article_id, []).append(r.p)
    return tags, tops


@pytest.mark.parametrize("chars", [1, 700, 4_000_000])
def test_tags_and_insights_equal_those_by_rows_at_any_size_of_blocks(spark, monkeypatch, chars):
    sents = Z.with_sentences(_articles(spark)).repartition(3)
    tags, tops = _by_rows(sents)
    monkeypatch.setattr(Z, "encode", lambda s, c: TB.encode(s, c, chars))
    got = Z.summaries_from_sentences(sents).collect()
    text = {r.article_id: r.s for r in sents.collect()}
    assert len(got) == 125 and len(tags) > 100
    for r in got:
        assert r.tags == tags.get(r.article_id, [])
        assert r.key_insights == [text[r.article_id][p] for p in tops.get(r.article_id, [])]
        if text[r.article_id] is not None:
            assert r.short_summary == " ".join(text[r.article_id][:3])[:500] and r.detailed_summary == " ".join(text[r.article_id][:8])


def test_frequencies_of_another_corpus_and_no_articles(spark):
    arts = _articles(spark)
    head = arts.filter("article_id < 'id010'")
    tags, _ = _by_rows(Z.with_sentences(head), Z.with_text_only(arts))
    got = Z.summaries_from_sentences(Z.with_sentences(head), Z.with_text_only(arts), parts=("tags",)).collect()
    assert {r.article_id: r.tags for r in got} == {k.article_id: tags.get(k.article_id, []) for k in head.collect()}
    assert Z.summaries_from_sentences(Z.with_sentences(arts.limit(0))).count() == 0


def test_what_is_shuffled_has_no_row_for_each_article_and_term(spark):
    """Articles that share their terms: one row for each term and block."""
    arts = spark.range(2000).select(F.concat(F.lit("k"), "id").alias("article_id"), F.lit("a").alias("niche"), F.lit(DAY).alias("run_date"),
                                    F.lit("one two three four five six seven").alias("content")).coalesce(1)
    encoded = TB.encode(Z.with_text_only(arts), ["article_id", "niche", "run_date"])
    assert encoded.filter("_vocabulary IS NOT NULL").select(F.sum(F.size("_vocabulary"))).first()[0] == 8
    assert {(r.i, r.df) for r in TB.frequencies(encoded).collect()} == {(i, 2000) for i in range(8)}


def test_rounding_is_half_up_on_decimals(spark):
    x = np.array([0.0, 0.1234567895, 2.0000000005, 1.5, 3.4999999999, 7.123456789499])
    expect = [float(Decimal(repr(v)).quantize(Decimal("1e-9"), ROUND_HALF_UP)) for v in x.tolist()]
    assert TB.round_half_up(x, 9).tolist() == expect
    df = spark.createDataFrame([(v,) for v in x.tolist()], "v double")
    assert [r[0] for r in df.select(F.round("v", 9)).collect()] == expect


def test_strip_takes_all_white_space_of_python(spark):
    texts = [" 　\x1fa b \x85", "", None, "\n\t", "x", "​x"]
    got = [r[0] for r in spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").orderBy("i").select(strip_ws("t")).collect()]
    assert got == [None if t is None else t.strip() for t in texts]
