"""Quicker steps of the language model and of the language identification against plain ones."""
from collections import Counter

import numpy as np

from gazette.llm import langid as L
from gazette.llm import lm_score as S


def test_contexts_stop_at_the_start_of_a_text():
    rng = np.random.default_rng(1)
    for lens in ([1], [3], [5, 1, 1, 2, 3, 9, 4], rng.integers(1, 9, 500).tolist()):
        texts = [rng.integers(0, 256, k).tolist() for k in lens]
        expect = [[t[i - j] if i >= j else 256 for j in range(1, S.CONTEXT + 1)] for t in texts for i in range(len(t))]
        starts = np.cumsum([0, *lens[:-1]]).astype(np.int64)
        assert S.contexts(np.array(sum(texts, []), np.int32), starts, 256).tolist() == expect


def test_letters_of_the_first_256_characters_need_no_marks():
    for t in ["İstanbul Ünï ǅ ß ª² áb ÀÉ Ÿ µ x1y ÷×", "ábc ́d", "\x85é\xa0b_c-d", "日本 a", "", "Plain TEXT 42", "".join(map(chr, range(256)))]:
        assert L.letters(t) == L.WORD.findall(t.lower())
    assert L.letters(None) == [] and L._latin("é") and not L._latin("œ")


def test_grams_of_all_lengths_come_from_one_run_for_each_character(spark):
    words = [("en", "a", 3), ("en", "abc", 2), ("en", "abcdefgh", 1), ("de", "abcdefgh", 5), ("de", "aaaaaaa", 2)]
    expect = Counter()
    for lang, w, n in words:
        for k in range(1, L.LONGEST + 1):
            for g in L.grams(w, k):
                expect[lang, k, g] += n
    got = L.count_grams(spark.createDataFrame([(a, 0, w, n) for a, w, n in words], "lang string, kind int, key string, n long"))
    assert {(r.lang, r.kind, r.key): r.n for r in got.collect()} == dict(expect)
