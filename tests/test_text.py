import hashlib

from pyspark.sql import functions as F

from gazette.functions import text as X


def one(spark, col, values, schema="s string"):
    df = spark.createDataFrame([(v,) for v in values], schema)
    return [r[0] for r in df.select(col).collect()]


def test_strip_ws_is_python_strip(spark):
    vals = ["  a b  ", "\n\ta ", " x　", "", "\x1cq\x1f", "a​b"]
    assert one(spark, X.strip_ws("s"), vals) == [v.strip() for v in vals]


def test_article_hash_matches_md5(spark):
    df = spark.createDataFrame([("T", "http://u", "c" * 300), ("Ü", "x", "é" * 250)], "t string, u string, c string")
    got = [r[0] for r in df.select(X.article_hash("t", "u", "c")).collect()]
    exp = [hashlib.md5(f"{t}:{u}:{c[:200]}".encode()).hexdigest() for t, u, c in [("T", "http://u", "c" * 300), ("Ü", "x", "é" * 250)]]
    assert got == exp


def py_trunc(t, n, suffix="..."):
    return t if len(t) <= n else t[: n - len(suffix)] + suffix


def test_ellipsis_lengths_and_emoji(spark):
    vals = ["a" * 279, "a" * 280, "a" * 281, "\U0001F4F0" * 300, "b"]
    assert one(spark, X.ellipsis_truncate("s", 280), vals) == [py_trunc(v, 280) for v in vals]


def py_safe(name):
    import re
    name = re.sub(r'[<>:"/\\|?*]', "", name).strip()
    return name[:200]


def test_safe_filename_and_slug(spark):
    vals = ['a<b>c:d"e/f\\g|h?i*j', "  spaced  ", "x" * 250, "T" * 60 + "?"]
    assert one(spark, X.safe_filename("s"), vals) == [py_safe(v) for v in vals]
    assert one(spark, X.article_slug(F.lit("2024-06-04"), F.col("s")), vals) == \
        [f"2024-06-04-{py_safe(v[:50])}.md" for v in vals]


def test_hashtags_and_title_cleanup(spark):
    df = spark.createDataFrame([(["machine learning", "AI", "x y z", "four"],)], "tags array<string>")
    assert df.select(X.hashtags("tags")).first()[0] == "#machinelearning #AI #xyz"
    vals = ['  "Title"  ', "'Quoted'", "\"'Both'\"", "plain"]
    assert one(spark, X.title_cleanup("s"), vals) == [v.strip().strip('"').strip("'") for v in vals]


def test_token_truncate(spark):
    vals = ["a b  c\td", " lead trail ", ""]
    assert one(spark, X.token_count("s"), vals) == [len(v.split()) for v in vals]
    assert one(spark, X.token_truncate("s", 2), vals) == ["a b", " lead trail ", ""]   # within the limit: unchanged
    assert one(spark, X.token_truncate("s", 10), vals) == vals


def test_sentences_and_terms(spark):
    df = spark.createDataFrame([("Hello world. How are you?  Fine!\nNext line no stop\nEnd.",)], "s string")
    r = df.select(X.sentences("s").alias("a"), X.terms("s").alias("t")).first()
    assert r.a == ["Hello world.", "How are you?", "Fine!", "Next line no stop\nEnd."]
    assert r.t == ["hello", "world", "how", "are", "you", "fine", "next", "line", "stop", "end"]
