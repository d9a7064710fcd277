"""The training-data operations against brute force and on rows with nulls, empty and long
texts, ties, repeated rows, clashing columns, and empty tables."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

WORD = re.compile(r"[^\x20\x09-\x0D]+")
DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def docs_of(spark, texts, source=lambda i: f"s{(i or 0) % 4}"):
    return spark.createDataFrame([(i, t, "en", source(i), len(t or "")) for i, t in texts], DOCS)


def corpus(seed=1, n=60):
    rnd = random.Random(seed)
    vocab = ["the", "of", "and", "to", "in"] + ["w%d" % i for i in range(300)]
    texts = [(i, "\n".join(" ".join(rnd.choices(vocab, k=rnd.randint(1, 40))) + "." for _ in range(rnd.randint(1, 4)))) for i in range(n)]
    texts += [(n, None), (n + 1, ""), (n + 2, " \t\n "), (n + 3, "one"), (n + 4, "one"), (n + 5, " ".join(rnd.choices(vocab, k=5000)))]
    for k in range(6):                                       # copies, exact and near
        i = rnd.randrange(n)
        ws = texts[i][1].split(" ")
        if k % 2 and len(ws) > 60:
            ws[len(ws) // 2] = "changed"
        texts.append((n + 6 + k, " ".join(ws)))
    return texts


def shingle_set(text):
    w = WORD.findall(text or "")
    return {tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def components(ids, links):
    root = {i: i for i in ids}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for a, b in links:
        a, b = sorted((find(a), find(b)))
        root[b] = a
    return {i: find(i) for i in ids}


def test_jaccard_matches_brute_force_at_any_block_size(spark):
    from gazette.llm.jaccard_join import jaccard_links, keep_one_of_each_group
    texts = corpus()
    base = " ".join("g%d" % i for i in range(60))
    texts += [(200 + k, base + " tail%d" % k) for k in range(12)]            # a group of near copies
    sets = {i: shingle_set(t) for i, t in texts}
    links = [(a, b) for a in sets for b in sets if a < b and sets[a] and sets[b] and 10 * len(sets[a] & sets[b]) >= 8 * len(sets[a] | sets[b])]
    want, n = components(sets, links), Counter(x for p in links for x in p)
    docs = docs_of(spark, texts).withColumn("fp", F.lit("clash"))
    for block in (2048, 4):
        got = {r.doc_id: r for r in jaccard_links(docs, max_block=block).collect()}
        assert {i: got[i].component_id for i in sets} == want
        assert {i: got[i].n_links for i in sets} == {i: n[i] for i in sets}
        assert all(got[i].kept == (want[i] == i) for i in sets)
    kept = keep_one_of_each_group(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted({want[i] for i in sets})


def test_jaccard_repeated_and_null_ids(spark):
    from gazette.llm.jaccard_join import jaccard_links, keep_one_of_each_group
    a, b = " ".join("a%d" % i for i in range(20)), " ".join("b%d" % i for i in range(20))
    docs = docs_of(spark, [(1, a), (1, a), (1, b), (None, b), (2, a), (3, None)])
    got = jaccard_links(docs).collect()
    assert len(got) == 6 and sorted(r.n_links for r in got) == [0, 1, 1, 2, 2, 2]
    kept = [(r.doc_id, r.text) for r in keep_one_of_each_group(docs).collect()]
    assert sorted(kept, key=str) == sorted([(1, a), (1, b), (3, None)], key=str)
    assert jaccard_links(docs.limit(0)).count() == 0


def test_band_count_reaches_the_recall():
    from gazette.llm.jaccard_join import bands_and_rows
    bands, rows = bands_and_rows()
    assert 1 - (1 - 0.8 ** rows) ** bands >= 0.999


def near(a, b):
    """Within one word, the longer of five words at least; or equal."""
    if a == b:
        return True
    if max(len(a), len(b)) < 5 or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) <= 1
    short, long_ = sorted((a, b), key=len)
    return any(long_[:i] + long_[i + 1:] == short for i in range(len(long_)))


def test_line_dedup_matches_brute_force(spark):
    from gazette.llm.line_dedup import dedup_lines
    rnd = random.Random(4)
    lines = [" ".join(rnd.choices("abcdefg", k=rnd.randint(0, 9))) for _ in range(25)]
    lines += [" ".join("x%d" % (j if j != 7 else 100 + k) for j in range(15)) for k in range(8)]     # differ in one place
    texts = [(i, "\n".join(rnd.choice(lines).replace(" ", rnd.choice([" ", "  ", "\t"])) for _ in range(rnd.randint(1, 6)))) for i in range(30)]
    texts += [(40, None), (41, ""), (42, "\n\n"), (43, " ".join("y%d" % i for i in range(1500)))]
    seen, want = [], {}
    for i, t in texts:
        kept, dropped, n = [], 0, 0
        for line in (t or "").split("\n"):
            w = WORD.findall(line)
            n += bool(w)
            if w and any(near(w, s) for s in seen):
                dropped += 1
            else:
                kept.append(line)
            if w:
                seen.append(w)
        want[i] = (None if t is None else "\n".join(kept), n, dropped)
    docs = docs_of(spark, texts).withColumn("n_lines", F.lit(-1))
    out = dedup_lines(docs)
    assert {r.doc_id: (r.text, r.n_lines, r.n_dropped) for r in out.collect()} == want
    assert "MapIn" not in out._jdf.queryExecution().toString() and "Python" not in out._jdf.queryExecution().toString()


def test_line_dedup_repeated_and_null_ids(spark):
    from gazette.llm.line_dedup import dedup_lines
    docs = docs_of(spark, [(None, "a b"), (1, "a b\nc"), (2, "c\nd"), (2, "c\nd")])
    got = sorted((str(r.doc_id), r.text) for r in dedup_lines(docs).collect())
    assert got == [("1", "c"), ("2", "d"), ("2", "d"), ("None", "a b")]
    assert dedup_lines(docs.limit(0)).count() == 0


def test_mix_hits_targets(spark):
    from gazette.llm.mixing import mix, take_mix
    rnd = random.Random(2)
    texts = [(i, " ".join("w" for _ in range(rnd.randint(0, 30)))) for i in range(400)] + [(500, None), (501, "")]
    source = lambda i: None if i % 7 == 0 else "big" if i % 3 else "a%d" % (i % 5)
    docs = docs_of(spark, texts, source).withColumn("size", F.lit("clash"))
    rows = mix(docs).collect()
    size, taken, target = Counter(), Counter(), {}
    for r in rows:
        s = source(r.doc_id)
        size[s] += r.size
        taken[s] += r.taken
        target[s] = r.target
        assert r.taken in (0, r.size, 2 * r.size, 3 * r.size)
    order = sorted(size, key=lambda s: (s is None, s or ""))
    weight, want, free = {s: i % 3 + 1 for i, s in enumerate(order)}, dict.fromkeys(order, 0.0), set(order)
    left = float(sum(size.values()))
    while free and left > 1e-9:                       # share, stop at three times, share the excess again
        total, spent = sum(weight[s] for s in free), 0.0
        for s in list(free):
            add = min(left * weight[s] / total, 3 * size[s] - want[s])
            want[s] += add
            spent += add
        free = {s for s in free if want[s] < 3 * size[s] - 1e-9}
        left -= spent
    for s in order:
        assert math.isclose(target[s], want[s], abs_tol=1e-6)
        assert abs(taken[s] - target[s]) <= 30
    assert sorted(map(tuple, rows), key=str) == sorted(map(tuple, mix(docs.repartition(7)).collect()), key=str)
    took = take_mix(docs)
    assert took.columns == docs.columns and took.count() == sum(r.taken // r.size for r in rows if r.size)
    assert mix(docs.limit(0)).count() == 0 and take_mix(docs.filter("text IS NULL")).count() == 0


def test_bpe_matches_the_library(spark):
    tokenizers = pytest.importorskip("tokenizers")
    import public_tokenizers
    from gazette.llm.bpe_prefix import encode_documents
    lib = tokenizers.Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    rnd = random.Random(3)
    texts = corpus() + [(300 + k, "".join(rnd.choice(["a", "aa", " ", "the", "'ll", "\n", "½", "é", "<|endoftext|>", "漢字", "\U0001f600", "\x1c", "\u00a0"]) for _ in range(40))) for k in range(40)]
    docs = docs_of(spark, texts).withColumn("ids", F.lit("clash"))
    full = {r.doc_id: r for r in encode_documents(docs).collect()}
    brief = {r.doc_id: r for r in encode_documents(docs, ids=False, decoded=False).collect()}
    for i, t in texts:
        ids = lib.encode(t or "", add_special_tokens=False).ids
        back = lib.decode(ids, skip_special_tokens=False)
        assert full[i].ids == ids and full[i].n_tokens == len(ids) and full[i].decoded == back == (t or "")
        assert brief[i].ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert brief[i].decoded_sha256 == hashlib.sha256(back.encode()).hexdigest()
    assert encode_documents(docs.limit(0)).count() == 0


def test_every_vocabulary_token_encodes_to_itself():
    from gazette.llm.bpe_prefix import PrefixBpe, vocabulary_bytes
    coder = PrefixBpe(vocabulary_bytes())
    assert all(coder.word_ids(b) == [i] for i, b in coder.bytes_of.items())


def vectors_of(spark, rows):
    return spark.createDataFrame(rows, "vec_id bigint, embedding array<float>, label int")


def odd_vectors():
    return [(900, None, 0), (901, [], 0), (902, [0.0] * 16, 0), (903, [float("nan")] * 16, 0), (904, [1.0] * 15 + [None], 0),
            (905, [float("inf")] + [1.0] * 15, 0), (906, [1.0, 2.0], 0), (907, [2.0, 4.0], 0)]


def test_embedding_links_match_brute_force(spark):
    from gazette.llm.embed_dedup import embedding_links
    rng = np.random.default_rng(1)
    x = rng.standard_normal((150, 16)).astype(np.float32)
    for k in range(40):                              # a group of near copies, and exact ones
        x[100 + k] = x[0] + 0.12 * rng.standard_normal(16) if k < 30 else x[1]
    rows = [(i, v.tolist(), 0) for i, v in enumerate(x)] + odd_vectors()
    good = x.astype(float)
    cos = good @ good.T / np.outer(np.linalg.norm(good, axis=1), np.linalg.norm(good, axis=1))
    links = [(i, j) for i in range(150) for j in range(i) if cos[i, j] >= 0.9] + [(906, 907)]
    ids = [r[0] for r in rows]
    want, n = components(ids, links), Counter(i for p in links for i in p)
    for block in (2048, 8):
        got = {r.vec_id: r for r in embedding_links(vectors_of(spark, rows), max_block=block).collect()}
        found, total = sum(got[i].n_links for i in ids), sum(n.values())
        assert all(got[i].n_links <= n[i] for i in ids) and found >= 0.97 * total
        if found == total:
            assert {i: got[i].component_id for i in ids} == want
        assert all(got[i].kept == (got[i].component_id == i) for i in ids)
    assert embedding_links(vectors_of(spark, rows).limit(0)).count() == 0


def test_top_k_matches_brute_force(spark):
    from gazette.llm.topk_segments import top_k, whole_numbers
    rng = np.random.default_rng(2)
    x = rng.standard_normal((130, 16)).astype(np.float32)
    x[50:60] = x[7]                                  # ties
    rows = [(i, v.tolist(), 0) for i, v in enumerate(x)] + odd_vectors() + [(3, x[3].tolist(), 1), (None, x[0].tolist(), 0)]
    q = np.floor(256 * x.astype(float)).astype(int)
    df = whole_numbers(vectors_of(spark, rows))
    for blocks in ((1024, 8192), (3, 20)):
        got = top_k(df, df.filter("vec_id % 10 = 0"), 5, query_block=blocks[0], row_block=blocks[1]).collect()
        by = {}
        for r in got:
            by.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
        zero = np.zeros(16, int)
        for i in range(0, 130, 10):
            scores = {j: int(q[i] @ q[j]) for j in range(130) if j != i} | {902: int(q[i] @ zero)}
            best = sorted(scores.items(), key=lambda p: (-p[1], p[0]))[:5]
            assert sorted(by[i]) == [(k + 1, j, s) for k, (j, s) in enumerate(best)]
    assert top_k(df.limit(0), df, 5).count() == 0


def test_lm_scores(spark):
    from gazette.llm.lm_score import score_documents
    from gazette.llm.words import crc_mod
    texts = corpus(n=120) + [(400, "ABC déjÀ"), (401, "abc")]
    docs = docs_of(spark, texts).withColumn("row", F.lit(1))
    held = lambda i: zlib.crc32(str(i).encode()) % 7 == 2
    low = lambda t: [re.sub("[A-Z]", lambda m: m[0].lower(), w) for w in WORD.findall(t or "")]
    train = Counter(w for i, t in texts if not held(i) for w in [*low(t), None])
    total, kinds = sum(train.values()), len(train)
    for head in (262_144, 10):                       # counts from the broadcast head, and joined
        got = {r.doc_id: r for r in score_documents(docs, crc_mod("doc_id", 7) == 2, head_words=head).collect()}
        assert len(got) == len(texts)
        for i, t in texts:
            ws = [*low(t), None]
            want = sum(math.log10((train[w] + 1) / (total + kinds + 1)) for w in ws)
            assert got[i].held_out == held(i) and got[i].n_tokens == len(ws) and got[i].train_tokens == total
            assert got[i].n_known == sum(train[w] > 0 for w in ws)
            assert math.isclose(got[i].base_score, want, rel_tol=1e-9) and got[i].score < 0
    assert score_documents(docs.limit(0), F.lit(False)).count() == 0


def test_lm_units_and_words_sum_to_one():
    from gazette.llm.lm_score import CONTEXT, LogBilinear, contexts
    model = LogBilinear(np.arange(1, 41.0))
    ctx = np.tile(np.array([[3, 1, 40, 40]], np.int32), (40, 1))
    assert math.isclose(np.exp(model.log_probabilities(ctx, np.arange(40, dtype=np.int32))).sum(), 1, rel_tol=1e-5)
    got = contexts(np.array([5, 6, 0, 7, 0], np.int32), np.array([0, 3]), 9)
    assert got.shape == (5, CONTEXT) and got[2].tolist() == [6, 5, 9, 9] and got[3].tolist() == [9] * 4 and got[4].tolist() == [7, 9, 9, 9]


def test_lm_learns_word_order():
    from gazette.llm.lm_score import LogBilinear, contexts
    rng = np.random.default_rng(0)
    units = np.tile([1, 2, 3, 4], 5000).astype(np.int32)
    ctx = contexts(units, np.array([0]), 5)
    model = LogBilinear(np.bincount(units, minlength=5).astype(float))
    before = model.log_probabilities(ctx, units).mean()
    model.train(ctx, units, rng)
    assert model.log_probabilities(ctx, units).mean() > before + 0.5


def test_url_parts_and_fixed_rules(spark):
    from gazette.llm.url_rules import judge_urls
    cases = [("http://A.Example.ORG/es/1", "a.example.org", "/es/1", "example.org/es/", "block"),
             ("https://example.org/en/12?x=/es/", "example.org", "/en/12", "example.org/en/1", "block"),
             ("https://example.org/en/2", "example.org", "/en/2", "org/", "allow"),
             ("https://example.org", "example.org", "", None, "allow"), ("http://badexample.org/es/", "badexample.org", "/es/", "org/", "allow"),
             ("x://b.com/de/#f", "b.com", "/de/", "com/de/", "block"), ("http://com/fr/", "com", "/fr/", "com/fr/", "allow"),
             ("nothing", "", "", None, "allow"), (None, "", "", None, "allow"), ("", "", "", None, "allow"), ("http://c.net/a://b", "c.net", "/a://b", None, "allow")]
    pages = spark.createDataFrame([(i, c[0], 1) for i, c in enumerate(cases)] + [(0, cases[0][0], 1)], "page_id bigint, url string, verdict int")
    none = spark.createDataFrame([], "url string, blocked boolean")
    got = judge_urls(pages, none).collect()
    assert len(got) == len(cases) + 1
    for r in got:
        assert (r.host, r.path, r.rule, r.verdict) == cases[r.page_id][1:]
    assert judge_urls(pages.limit(0), none).count() == 0


def test_url_rules_are_mined(spark):
    from gazette.llm.url_rules import judge_urls, mine_rules, url_tokens
    rows = [(f"https://h{i % 9}.net/{'casino' if i % 5 == 0 else 'news'}/{i}{'?promo=1' if i % 2 else ''}", i % 5 == 0 and i % 2 == 1) for i in range(400)] + [(None, True), ("http://z.net/q", None)]
    labelled = spark.createDataFrame(rows, "url string, blocked boolean")
    rules = {tuple(r.tokens): r.confidence for r in mine_rules(labelled, min_support=0.05).collect()}
    toks = {r.url: set(r.t) for r in labelled.filter("url IS NOT NULL").select("url", url_tokens(F.col("url")).alias("t")).collect()}
    for tokens, confidence in rules.items():          # confidence by counting
        hit = [b for u, b in rows if u and b is not None and set(tokens) <= toks[u]]
        assert math.isclose(sum(hit) / len(hit), confidence) and confidence >= 0.6
    assert ("key:promo", "path:casino") in rules and not any({"key:promo", "path:casino"} < set(t) for t in rules)
    pages = spark.createDataFrame([(1, "https://new.net/casino/5?promo=2"), (2, "https://new.net/news/5?promo=2")], "page_id bigint, url string")
    assert {r.page_id: r.verdict for r in judge_urls(pages, labelled, min_support=0.05).collect()} == {1: "block", 2: "allow"}


def labelled_docs(spark, good, bad, n=240):
    rnd = random.Random(6)
    vocab = ["v%d" % i for i in range(200)]
    make = lambda f: " ".join(f(rnd.choices(vocab, k=rnd.randint(20, 60))))
    texts = [(i, make(good if i % 3 else bad)) for i in range(n)] + [(n, None), (n + 1, ""), (n + 2, make(good) * 60)]
    labels = [(i, int(i % 3 > 0), int(i % 3 == 0)) for i in range(n)] + [(n + 9, None, None), (None, 1, 1), (5, 1, 0)]
    return docs_of(spark, texts).withColumn("score", F.lit("clash")), spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")


def held_accuracy(rows, mod, rem, label):
    held = [r for r in rows if r.doc_id < 240 and zlib.crc32(str(r.doc_id).encode()) % mod == rem]
    assert len(held) > 20
    return sum(r.predicted == label(r.doc_id) for r in held) / len(held)


def test_quality_on_held_out_rows(spark):
    from gazette.llm.quality_nbsvm import score_quality
    from gazette.llm.words import crc_mod
    docs, labels = labelled_docs(spark, lambda w: w, lambda w: [x + "%%%" for x in w])
    rows = score_quality(docs, labels, crc_mod("doc_id", 3) != 1).collect()
    assert len(rows) == 243 and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)
    assert held_accuracy(rows, 3, 1, lambda i: int(i % 3 > 0)) > 0.95
    assert score_quality(docs.limit(0), labels, F.lit(True)).count() == 0
    assert score_quality(docs, labels.limit(0), F.lit(True)).count() == 243


def test_toxicity_learns_a_pair_of_terms(spark):
    from gazette.llm.toxicity_fm import score_toxicity
    from gazette.llm.words import crc_mod
    docs, labels = labelled_docs(spark, lambda w: w, lambda w: [*w, "insultx", "groupy"])
    rows = score_toxicity(docs, labels, crc_mod("doc_id", 5) != 0).collect()
    assert len(rows) == 243 and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)
    assert held_accuracy(rows, 5, 0, lambda i: int(i % 3 == 0)) > 0.95
    assert score_toxicity(docs.limit(0), labels, F.lit(True)).count() == 0
    assert score_toxicity(docs, labels.limit(0), F.lit(True)).count() == 243


def test_machine_separates_what_weights_cannot():
    from gazette.llm.toxicity_fm import FactorizationMachine
    rows = [np.array(r) for r in ([0], [1], [0, 1], [])] * 200         # both together, or none
    y = np.array([0.0, 0.0, 1.0, 0.0] * 200)
    m = FactorizationMachine(np.array([10, 11]), seed=1)
    m.fit(rows, y, epochs=60, rate=0.1, factor_rate=0.1, factor_decay=0.0, weight=1.0)
    s = m.scores([[0], [1], [0, 1], []])
    assert s[2] > 0.5 > max(s[0], s[1], s[3])


def test_components(spark):
    from gazette.llm.components import connected_components
    rnd = random.Random(9)
    edges = [(i, i + 1) for i in range(40)] + [(100 + rnd.randrange(30), 100 + rnd.randrange(30)) for _ in range(25)] + [(200, k) for k in range(201, 220)] + [(7, 7), (None, 3)]
    ids = {x for e in edges if None not in e and e[0] != e[1] for x in e}
    want = components(ids, [e for e in edges if None not in e])
    got = connected_components(spark.createDataFrame(edges, "a bigint, b bigint"))
    assert {r.node: r.label for r in got.collect()} == want


def test_pipeline_stages_follow_their_inputs(spark, tmp_path):
    import corpus_pipeline as P
    texts = corpus(n=90)
    docs = docs_of(spark, texts)
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(i, int(i % 4 > 0), 0) for i in range(90)], "doc_id bigint, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    at = docs
    for name, stage in P.STAGES[:-1]:
        out = stage(spark, at, str(tmp_path))
        assert out.columns == docs.columns
        assert {r.doc_id for r in out.select("doc_id").collect()} <= {r.doc_id for r in at.select("doc_id").collect()}
        at = out
    last = P.STAGES[-1][1](spark, at, str(tmp_path)).collect()
    text = {r.doc_id: r.text for r in at.collect()}
    assert len(last) == at.count()
    assert all(r.decoded_sha256 == hashlib.sha256((text[r.doc_id] or "").encode()).hexdigest() and len(r.ids) == r.n_tokens for r in last)
    assert P.run(spark, str(tmp_path)).count() == len(last)


def word_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def test_line_dedup_with_a_bound_that_grows_with_the_line(spark):
    from gazette.llm.line_dedup import dedup_lines
    rnd = random.Random(8)
    lines = []
    for n in [8, 9, 10, 11, 14, 15, 19, 20, 25, 40, 60] * 2:
        base = ["%s%d" % (rnd.choice("pq"), rnd.randrange(40)) for _ in range(n)]
        lines.append(base)
        for edits in (1, 2, n // 5 - 1, n // 5, n // 5, n // 5 + 1, n // 4 + 1):
            w = list(base)
            for _ in range(edits):
                at, kind = rnd.randrange(len(w)), rnd.randrange(3)
                w[at:at + (kind != 1)] = [] if kind == 0 else ["z%d" % rnd.randrange(3)]
            lines.append(w)
    lines += [["c"] * n for n in (10, 12, 13, 30, 36, 40)]                      # one run over and over
    rnd.shuffle(lines)
    gone = [any(a == b or max(len(a), len(b)) >= 5 and word_distance(a, b) <= max(len(a), len(b)) // 5 for b in lines[:i]) for i, a in enumerate(lines)]
    docs = docs_of(spark, [(i, " ".join(w)) for i, w in enumerate(lines)])
    assert [r.n_dropped == 1 for r in dedup_lines(docs, words_per_edit=5).orderBy("doc_id").collect()] == gone and 40 < sum(gone) < len(gone)
    one = [any(a == b or max(len(a), len(b)) >= 5 and word_distance(a, b) <= 1 for b in lines[:i]) for i, a in enumerate(lines)]
    assert [r.n_dropped == 1 for r in dedup_lines(docs).orderBy("doc_id").collect()] == one and 10 < sum(one) < sum(gone)


def test_line_dedup_of_a_hot_half_and_a_very_long_line(spark):
    """20,000 lines that share a half are aggregated by key, never paired; one line of 20,000
    words is near its copy with a word more."""
    import time
    from gazette.llm.line_dedup import dedup_lines
    head = " ".join("h%d" % i for i in range(8))
    lines = ["%s a%d b%d c%d" % (head, i, i * 7 % 9973, i) for i in range(20_000)]
    lines[777] = lines[5] + " more"
    wide = " ".join("w%d" % i for i in range(20_000))
    docs = docs_of(spark, [(0, "\n".join(lines[:10_000])), (1, "\n".join(lines[10_000:])), (2, wide), (3, wide + " end")])
    t = time.time()
    got = {r.doc_id: r.n_dropped for r in dedup_lines(docs).collect()}
    assert got == {0: 1, 1: 0, 2: 0, 3: 1} and time.time() - t < 120


def test_lm_trains_on_every_position_however_partitioned(spark):
    from gazette.llm.lm_score import score_documents
    rnd = random.Random(3)
    texts = [(i, " ".join("abcdefgh"[(k + at) % 8] for at in range(60))) for i in range(120) for k in [rnd.randrange(8)]]
    docs = docs_of(spark, texts)
    held = F.col("doc_id") % 6 == 0
    got = [{r.doc_id: r for r in score_documents(docs.repartition(p), held, shard_tokens=3000).collect()} for p in (1, 9)]
    assert all(math.isclose(got[0][i].score, got[1][i].score, rel_tol=1e-5) for i in got[0])
    rows = [r for r in got[0].values() if r.held_out]
    # each word follows from the one before
    assert sum(r.score for r in rows) > 0.7 * sum(r.base_score for r in rows)


def test_quality_reads_long_words_whole(spark):
    from gazette.llm.quality_nbsvm import NGrams, score_quality, shape
    assert shape("ab," * 40) != shape("ab," * 40 + "1") and shape("x" * 500) == "a"
    grams = [NGrams().of(("ab,c" * 16) + rest) for rest in ("de,f" * 100, "%%0;" * 100)]
    assert set(grams[0].tolist()) != set(grams[1].tolist())
    rnd = random.Random(9)
    head = lambda: "".join(rnd.choices("abcdefgh,", k=64))
    good, bad = (lambda: "".join(rnd.choices("abcdefgh,", k=400))), (lambda: "".join(rnd.choices("01<>{}=;", k=400)))
    docs = docs_of(spark, [(i, head() + (good() if i % 2 else bad())) for i in range(200)])
    labels = spark.createDataFrame([(i, i % 2) for i in range(150)], "doc_id bigint, quality int")
    held = [r for r in score_quality(docs, labels, F.lit(True)).collect() if r.doc_id >= 150]
    assert sum(r.predicted == r.doc_id % 2 for r in held) > 45


def test_labelled_sample_is_bounded_under_repeated_ids(spark):
    from gazette.llm.labelled import labelled_rows
    docs = spark.range(5000).selectExpr("id % 20 AS doc_id", "concat('text ', id) AS text")
    labels = spark.range(20).selectExpr("id AS doc_id", "CAST(id % 2 AS int) AS quality")
    got = labelled_rows(docs, labels, "quality", F.lit(True), max_rows=10).collect()
    assert len(got) == 10
    again = labelled_rows(docs.orderBy("text"), labels, "quality", F.lit(True), max_rows=10).collect()
    assert sorted(got) == sorted(again)


def test_pipeline_stages_keep_clashing_columns_and_take_empty_tables(spark, tmp_path):
    import corpus_pipeline as P
    texts = [(i, "plain words of document %d that people wrote down here\nand a second line %d follows" % (i, i)) for i in range(30)]
    docs = docs_of(spark, texts + [(30, None), (31, "")]).withColumn("score", F.lit("mine")).withColumn("n_lines", F.lit(-1)).withColumn("n_dropped", F.col("doc_id"))
    spark.createDataFrame([(i, i % 2, 0) for i in range(20)], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    for stage in (P.quality, P.line_dedup):
        out = stage(spark, docs, str(tmp_path))
        assert out.columns == docs.columns
        assert all(r.score == "mine" and r.n_lines == -1 and r.n_dropped == r.doc_id for r in out.collect())
        assert stage(spark, docs.limit(0), str(tmp_path)).collect() == []
