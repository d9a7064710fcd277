"""Blocks of articles travel as one compressed table each."""
import datetime as dt

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from gazette.operators import summarize as Z
from gazette.operators import term_blocks as TB

DAY = dt.date(2024, 6, 4)
COLUMNS = ["article_id", "niche", "run_date"]


def test_a_block_of_articles_is_one_row_much_smaller_than_its_text(spark):
    arts = spark.range(3000).select(F.concat(F.lit("k"), "id").alias("article_id"), F.lit("a").alias("niche"), F.lit(DAY).alias("run_date"),
                                    F.concat(F.lit("Alpha beta gamma delta. Epsilon zeta eta theta iota kappa. Number "), F.col("id") % 7, F.lit(" lambda.")).alias("content"))
    text = arts.select(F.sum(F.length("content"))).first()[0]
    sents = Z.with_sentences(arts.coalesce(1))
    encoded = TB.encode(sents, [*COLUMNS, "s"], text // 3)
    rows = encoded.filter("_rows IS NOT NULL")
    assert rows.count() == encoded.select("_block").distinct().count() == 3
    assert rows.select(F.sum(F.length("_rows") + F.length("_codes") + F.length("_terms"))).first()[0] * 3 < text
    # without places of sentences a term has one entry for each article
    short = TB.encode(sents, COLUMNS, text).filter("_rows IS NOT NULL").collect()
    assert sum(TB._unpacked(pa.chunked_array([pa.array([bytes(r["_codes"])], pa.binary())])).num_rows for r in short) == 3000 * 12
    assert TB.encode(sents, ["niche", "run_date"]).filter("_rows IS NOT NULL").count() == 0


@pytest.mark.parametrize("repeat", [1, 40])        # few words: places by hashes; many: by the map
def test_places_and_counts_equal_those_of_plain_python(repeat):
    lines = ["one two \x01 three one ab ", "", None, "two two \x01 \x01 four", "one two three", "lost words here"]
    lines = [x if x is None else " ".join([x] * repeat) for x in lines]
    edition = np.array([0, 0, 0, 1, 1, -1])
    for whole in (True, False):
        row, place, terms, of, n, pairs, tf = TB._coded(pa.array(lines, pa.string()), edition, whole)
        names = list(zip(of.tolist(), terms.to_pylist()))
        expect = [(k, w if w == "\x01" else (edition[k], w)) for k, x in enumerate(lines) if edition[k] >= 0
                  for w in (x or "").split() if len(w) > 2 or (whole and w == "\x01")]
        assert [(r, "\x01" if p < 0 else names[p]) for r, p in zip(row.tolist(), place.tolist())] == expect
        words = [x for x in expect if x[1] != "\x01"]
        assert {(p // len(names), names[p % len(names)]): c for p, c in zip(pairs.tolist(), tf.tolist())} == {x: words.count(x) for x in words}
        assert dict(zip(names, n.tolist())) == {t: len({r for r, u in words if u == t}) for _, t in words}
