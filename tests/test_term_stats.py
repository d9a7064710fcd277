"""Term statistics inside the row, and first copies without a shuffle of text."""
import datetime as dt
import math
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from gazette.operators import dedup as D
from gazette.operators import summarize as Z

DAY = dt.date(2024, 6, 4)


def _texts():
    """Editions of different sizes, a word in nearly all texts, one text without words."""
    rows = []
    for i in range(60):
        niche = "a" if i % 3 else "b"
        words = ["common"] * (i % 4 + 1) + [f"word{'xyz'[i % 3]}{'q' * (i % 7)}", "Über"] + ["pair"] * (i % 2)
        rows.append((f"id{i:02d}", niche, DAY, f"{' '.join(words)}. Rare{'r' * i} one! common of it"))
    return rows + [("id98", "a", DAY, "1 2 3"), ("id99", "a", DAY, "")]


def _brute(rows, positions=True):
    occ, df, n = {}, Counter(), Counter()
    for key, niche, day, text in rows:
        n[niche] += 1
        sents = [s for s in re.split(r"(?<=[.!?])[\t\n\f\r ]+", text) if s.strip()]
        at = defaultdict(list)
        for p, s in enumerate(sents):
            for t in re.findall(r"[^\W\d_]{3,}", s.lower()):
                at[t].append(p)
        occ[key, niche] = at
        df.update((niche, t) for t in at)
    out = {}
    for (key, niche), at in occ.items():
        for t, pos in at.items():
            if df[niche, t] * 2 <= n[niche]:
                out[key, t] = (len(pos), sorted(pos), round(len(pos) * math.log(n[niche] / df[niche, t]), 9))
    return out


@pytest.mark.parametrize("heavy_terms", [1, 20, 65536])
def test_weights_equal_brute_force_at_any_split_of_the_terms(spark, heavy_terms):
    rows = _texts()
    arts = spark.createDataFrame(rows, "article_id string, niche string, run_date date, content string")
    got = Z.term_weights(Z.with_sentences(arts), heavy_terms=heavy_terms).collect()
    expect = _brute(rows)
    assert len(got) == len(expect)
    for r in got:
        tf, pos, w = expect[r.article_id, r.term]
        assert (r.tf, sorted(r.pos)) == (tf, pos) and abs(r.weight - w) < 2e-9


def test_weights_over_another_corpus_and_empty_tables(spark):
    rows = _texts()
    arts = spark.createDataFrame(rows, "article_id string, niche string, run_date date, content string")
    head = arts.filter("article_id < 'id10'")
    whole = {(r.article_id, r.term): r.weight for r in Z.term_weights(Z.with_sentences(arts)).collect()}
    got = Z.term_weights(Z.with_sentences(head), corpus=Z.with_text_only(arts)).collect()
    assert got and {(r.article_id, r.term): r.weight for r in got} == {k: v for k, v in whole.items() if k[0] < "id10"}
    assert Z.term_weights(Z.with_sentences(arts.limit(0))).count() == 0


def _exchanged(df):
    """Columns that the plan's shuffles carry."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    cols = set()
    lines = plan.splitlines()
    for i, line in enumerate(lines):
        if "Exchange hashpartitioning" in line or "Exchange rangepartitioning" in line:
            below = lines[i + 1]
            cols.update(re.findall(r"(\w+)#\d+", below.split("functions=")[0]))
    return cols


def test_tags_shuffle_neither_text_nor_occurrences(spark):
    arts = spark.createDataFrame(_texts(), "article_id string, niche string, run_date date, content string")
    from gazette.session import materialize
    sents = materialize(Z.with_text_only(arts), "text")
    tags = Z.summaries_from_sentences(sents, parts=("tags",))
    carried = _exchanged(tags)
    assert "article_id" in carried and not carried & {"content", "s", "_o", "pos", "terms"}


def _copies(spark):
    rows = [("k%d" % (i % 900), i, "text %d" % i) for i in range(1000)]
    rows += [(None, 2000 + i, "none") for i in range(3)] + [("hot", 3000 + i, "hot") for i in range(500)]
    rows += [("hot", 3000, "hot")]                       # a repeated row
    df = spark.createDataFrame(rows, "article_hash string, item_pos long, content string")
    return df.withColumns({"kind_rank": F.lit(1), "source_pos": F.lit(1), "source_name": F.lit("s")})


@pytest.mark.parametrize("bits", [15, 26])
def test_first_copies_are_those_of_keep_first(spark, bits):
    df = _copies(spark)
    got = D.first_copies(df, bits=bits)
    expect = D.keep_first(df)
    assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, expect.collect()), key=str)
    assert got.count() == 902
    assert D.first_copies(df.limit(0)).count() == 0


def test_the_map_of_repeated_keys_has_a_fixed_size_and_spares_single_rows(spark):
    df = spark.range(200_000).select(F.col("id").cast("string").alias("k"))
    df = df.unionByName(df.filter("cast(k as long) % 1000 = 0"))
    rows = D.repeated_bitmap(df, "k").select(F.length("_map").alias("n"), F.bitmap_count("_map").alias("ones")).collect()
    assert {r.n for r in rows} == {4096} and sum(r.ones for r in rows) <= 200 and len(rows) <= 2048
