"""Token alignment, language identification and whitening against brute force, and on rows
with nulls, empty and long texts, ties, repeated rows, clashing columns, and empty tables."""

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

ODD = list(" \n\t\r\xa0\x1c\x85　abcéß'!.1²中😀") + ["  ", "'s", " \xa0 ", "\x1c!", "<|endoftext|>", "<s>", "the ", "word"]


@pytest.fixture(scope="module")
def two():
    import public_tokenizers
    from gazette.llm.token_align import TwoTokenizers, vocabulary_bytes
    return TwoTokenizers(vocabulary_bytes(), vocabulary_bytes(public_tokenizers.path("piece_bpe_32k.model")))


def aligned_by_hand(two, text):
    """(a ids, b ids, groups, links) of one text, by the two libraries and sets of offsets."""
    if not text:
        return [], [], "", []
    a, b = two.a.encode(" " + text, add_special_tokens=False).ids, two.b.encode(text)
    bytes_a, bytes_b = [two.a_bytes[i] for i in a], [two.b_bytes[i] for i in b]
    if not b"".join(bytes_a) == b"".join(bytes_b) == (" " + text).encode():
        return [], [], "", []
    owner = {}
    for side, tokens in enumerate((bytes_a, bytes_b)):
        at = 0
        for k, t in enumerate(tokens):
            for _ in t:
                owner.setdefault(at, [0, 0])[side] = k
                at += 1
    links = sorted({tuple(v) for v in owner.values()})
    ends = [set(np.cumsum([len(t) for t in x]).tolist()) for x in (bytes_a, bytes_b)]
    groups, of = [], defaultdict(lambda: ([], []))
    cuts = sorted(ends[0] & ends[1])
    for side, (ids, tokens) in enumerate(((a, bytes_a), (b, bytes_b))):
        at = 0
        for i, t in zip(ids, tokens):
            at += len(t)
            of[np.searchsorted(cuts, at)][side].append(str(i))
    groups = [",".join(of[k][0]) + "|" + ",".join(of[k][1]) for k in range(len(cuts))]
    return a, b, ";".join(groups), links


def test_merge_path_pieces_equal_a_plain_merge():
    from gazette.llm.token_align import align, merge_path
    rnd = np.random.default_rng(1)
    for _ in range(60):
        end = int(rnd.integers(5, 200))
        a, b = (np.unique(np.append(rnd.integers(1, end, rnd.integers(0, end)), end)) for _ in range(2))
        merged = sorted([(x, 0) for x in a] + [(x, 1) for x in b])
        at = merge_path(a, b, np.arange(len(merged) + 1))
        assert at.tolist() == [sum(s == 0 for _, s in merged[:d]) for d in range(len(merged) + 1)]
        whole = [x.tolist() for x in align(a, b, piece=10 ** 6)]
        for piece in (1, 2, 3, 7):
            assert [x.tolist() for x in align(a, b, piece=piece)] == whole
        assert whole[2] == [i for i, x in enumerate(a) if x in set(b)]
        ends = sorted({*a.tolist(), *b.tolist()})
        assert list(zip(whole[0], whole[1])) == [(int(np.searchsorted(a, e)), int(np.searchsorted(b, e))) for e in ends]


def test_units_give_the_ids_of_whole_texts(two):
    from gazette.llm.token_align import _Texts, _strings
    rnd = random.Random(2)
    texts = ["".join(rnd.choices(ODD, k=rnd.randint(1, 25))) for _ in range(3000)] + ["a▁b", "▁", " ", "\n", "x" * 5000, None, ""]
    got = list(_Texts(two, texts).groups(_strings(50_300)))
    assert got == [aligned_by_hand(two, t)[2] for t in texts]
    two.clear()


def test_align_documents_against_brute_force(spark, two):
    from gazette.llm.token_align import align_documents
    rnd = random.Random(3)
    vocab = ["the", "of", "unbelievable", "Straße", "naïve", "中文", "x1", "don't", "\n"] + ["word%d" % i for i in range(40)]
    texts = [" ".join(rnd.choices(vocab, k=rnd.randint(1, 60))) for _ in range(40)]
    texts += [None, "", " ", "one", "one", "a▁b", "word1 " * 4000]
    rows = [(i if i != 4 else None, t, "n%d" % i, 9) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, chunk string, n_a long")
    hand = [aligned_by_hand(two, t) for t in texts]
    held = Counter()
    for a, b, _, links in hand:
        held.update({(a[i], b[j]) for i, j in links})
    most = Counter()
    for (a, _), n in held.items():
        most[a] = max(most[a], n)
    want = {}
    for (i, _, name, _), (a, b, groups, links) in zip(rows, hand):
        counts = [(a[x], held[(a[x], b[y])]) for x, y in links]
        want[name] = (i, len(a), len(b), groups.count(";") + bool(groups), len(links), sum(n == most[x] for x, n in counts), sum(n for _, n in counts), groups)
    for chunk in (1 << 20, 300):
        got = align_documents(docs, chunk=chunk)
        assert got.columns == ["doc_id", "chunk", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups"]
        assert {r["chunk"]: (r["doc_id"], *r[2:]) for r in got.collect()} == want
    sha = {r["chunk"]: r["groups_sha256"] for r in align_documents(docs, groups=False).collect()}
    assert sha == {k: hashlib.sha256(v[-1].encode()).hexdigest() if v[-1] else "" for k, v in want.items()}
    assert align_documents(docs.limit(0)).collect() == []


def languages(seed=1):
    """Texts of three made-up languages that share letters and a few words."""
    rnd = random.Random(seed)
    ends = {"aa": ["ung", "heit", "en"], "bb": ["eau", "ment", "ez"], "cc": ["ción", "ado", "os"]}
    words = {k: ["".join(rnd.choices("abcdefghilmnoprstu", k=rnd.randint(2, 5))) + rnd.choice(e) for _ in range(300)] + ["no", "la"] for k, e in ends.items()}
    return words, lambda k, n: " ".join(rnd.choices(words[k], k=n))


def votes_by_hand(train, text):
    """Sums of log frequencies by the same rules, from plain counts, nothing pruned."""
    from gazette.llm.langid import LONGEST, WORD_LENGTH, grams, letters
    counts = defaultdict(Counter)
    for lang, t in train:
        for w in letters(t):
            counts[(lang, 0)][w] += 1
            for k in range(1, LONGEST + 1):
                counts[(lang, k)].update(grams(w, k))
    langs = sorted({k for k, _ in counts})
    size = {k: sum(c.values()) for k, c in counts.items()}
    absent = [np.log(0.5 / max(size.get((x, k), 0) for x in langs)) for k in range(LONGEST + 1)]
    log = lambda x, k, g: np.log(counts[(x, k)][g] / size[(x, k)]) - absent[k] if counts[(x, k)][g] else 0.0
    total = np.zeros(len(langs))
    for w in letters(text):
        if any(counts[(x, 0)][w] for x in langs):
            total += [log(x, 0, w) for x in langs]
            continue
        for k in range(LONGEST, 0, -1):
            known = [g for g in grams(w, k) if any(counts[(x, k)][g] for x in langs)]
            if known:
                total += np.array([np.mean([log(x, k, g) for g in known]) for x in langs]) * max(1.0, len(w) / WORD_LENGTH)
                break
    return langs, total


def test_language_votes_against_brute_force(spark):
    from gazette.llm.langid import predict_languages
    words, make = languages()
    rnd = random.Random(5)
    rows = [(i, make(k, rnd.randint(1, 30)), k) for i, k in enumerate(rnd.choices(["aa", "bb", "cc"], k=120))]
    rows += [(200, "nuevanación Neuheitung xyzzy", "aa"), (205, "QQQ " + "x" * 3000, None), (210, make("bb", 3000), None), (210, make("bb", 3000), None), (None, make("cc", 5), "cc")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").withColumn("score", F.lit("old"))
    usable = F.coalesce(F.col("doc_id") % 5 != 0, F.lit(True))
    got = predict_languages(docs, usable)
    assert got.columns == ["doc_id", "text", "lang", "lang_pred", "score"] and got.count() == len(rows)
    train = [(k, t) for i, t, k in rows if (i is None or i % 5) and k is not None]
    hand = {}
    for _, t, _ in rows:
        langs, total = votes_by_hand(train, t)
        best = int(total.argmax())
        hand[t] = (langs[best], 1 / np.exp(total - total[best]).sum())
    for r in got.collect():
        assert r["lang_pred"] == hand[r["text"]][0] and r["score"] == pytest.approx(hand[r["text"]][1])


def test_languages_of_held_out_and_odd_texts(spark):
    from gazette.llm.langid import predict_languages
    words, make = languages()
    rnd = random.Random(6)
    rows = [(i, make(k, rnd.randint(3, 30)), k) for i, k in enumerate(rnd.choices(["aa", "bb", "cc"], k=300))]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    held = predict_languages(docs, F.col("doc_id") % 5 != 0).filter("doc_id % 5 = 0").collect()
    assert np.mean([r["lang"] == r["lang_pred"] for r in held]) > 0.95
    # a cap below the vocabulary leaves the n-grams to decide
    few = predict_languages(docs, F.col("doc_id") % 5 != 0, kept=60).filter("doc_id % 5 = 0").collect()
    assert np.mean([r["lang"] == r["lang_pred"] for r in few]) > 0.8
    odd = spark.createDataFrame([(1000, None, None), (1001, "", "aa"), (1002, "12 34 !?", "bb"), (1003, "中文", None)], docs.schema)
    got = {r["doc_id"]: r for r in predict_languages(docs.unionByName(odd), F.col("doc_id") < 300).collect()}
    assert [(got[i]["lang_pred"], got[i]["score"]) for i in (1000, 1001, 1002)] == [("und", 0.0)] * 3
    assert got[1003]["lang_pred"] in ("aa", "bb", "cc") and 0 < got[1003]["score"] < 1
    none = predict_languages(docs, F.lit(False)).select("lang_pred").distinct().collect()
    assert [r[0] for r in none] == ["und"]
    assert predict_languages(docs.limit(0), F.lit(True)).collect() == []


def whitened_by_hand(vectors, k=4):
    x = np.floor(256 * np.array(vectors, float)).astype(np.int64)
    u = np.unique(x, axis=0)
    n, s = len(u), u.sum(0)
    e, v = np.linalg.eigh(np.cov(u.T, bias=True).reshape(len(s), len(s)))
    e, v = e[::-1][:k], v[:, ::-1][:, :k]
    k = int((e > 1e-9 * e.max()).sum())
    return n, ((n * x - s) ** 2).sum(1), (x - s / n) @ v[:, :k] / np.sqrt(e[:k]), e[:k] / np.cov(u.T, bias=True).trace()


@pytest.mark.parametrize("dims,rows,spread", [(40, 300, None), (6, 50, None), (40, 3, None), (48, 400, [9, 9, 4, 4, 2])])
def test_whitening_against_eigh(spark, dims, rows, spread):
    from gazette.llm.whitening import whiten
    rnd = np.random.default_rng(dims + rows)
    scale = np.ones(dims) if spread is None else np.append(spread, np.ones(dims - len(spread)))
    vectors = (rnd.standard_normal((rows, dims)) * scale).tolist()
    table = [(i, v, "old") for i, v in enumerate(vectors)] + [(rows, vectors[0], "old"), (None, vectors[1], "old")]
    bad = [(900, None, ""), (901, [], ""), (902, [None] * dims, ""), (903, [float("nan")] * dims, ""), (904, [float("inf")] * dims, ""), (905, [1.0] * (dims + 1), "")]
    df = spark.createDataFrame(table + bad, "vec_id long, embedding array<double>, n string")
    got = whiten(df)
    assert got.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    n, deviation, want, share = whitened_by_hand([v for _, v, _ in table])
    out = got.collect()
    assert len(out) == len(table) * want.shape[1] and {r["n"] for r in out} == {n}
    by = {(r["vec_id"], r["component"]): r for r in out}
    assert all(r["identity_error"] < 1e-8 for r in out)
    for c in range(want.shape[1]):
        mine = np.array([by[(i, c + 1)]["whitened"] for i, _, _ in table])
        sign = np.sign(mine @ want[:, c])
        assert np.abs(mine - sign * want[:, c]).max() < 1e-6
        assert by[(0, c + 1)]["explained"] == pytest.approx(share[c], rel=1e-9)
    assert [by[(i, 1)]["deviation"] for i, _, _ in table] == deviation.tolist()


def test_whitening_of_ties_equal_rows_and_nothing(spark):
    from gazette.llm.whitening import leading_eigenvectors, whiten
    ties = np.diag([5.0, 5.0, 3.0, 3.0, 3.0] + [1.0] * 45)
    values, vectors = leading_eigenvectors(lambda q: ties @ q, 50, 64.0, 4)
    assert np.allclose(values, [5, 5, 3, 3]) and np.allclose(ties @ vectors, vectors * values)
    schema = "vec_id long, embedding array<float>"
    assert whiten(spark.createDataFrame([(i, [1.0, 2.0]) for i in range(3)], schema)).collect() == []
    assert whiten(spark.createDataFrame([], schema)).collect() == []
    huge = whiten(spark.createDataFrame([(0, [0.0, 1e16]), (1, [1.0, 0.0]), (2, [2.0, 0.0])], schema)).collect()
    assert any(r["deviation"] is None for r in huge) and {r["n"] for r in huge} == {3}
