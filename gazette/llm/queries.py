"""Registered queries of this subpackage: each applies one operator, with production
parameters, to its whole table. ORACLES holds DuckDB SQL where SQL can express the result;
the others are held against brute force in tests/llm."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from gazette.session import prepare, read_table


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    prepare(spark)
    return read_table(spark, sf_dir, name)


def op1_lbl_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    from gazette.llm.lm_score import score_documents
    from gazette.llm.words import crc_mod
    return score_documents(_table(spark, sf_dir, "documents").select("doc_id", "text"), crc_mod("doc_id", 7) == 2)


def op2_segment_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    from gazette.llm.topk_segments import top_k, whole_numbers
    rows = whole_numbers(_table(spark, sf_dir, "embeddings"))
    return top_k(rows, rows.filter("vec_id % 50 = 0"), k=5)


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from gazette.llm.line_dedup import dedup_lines
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return dedup_lines(docs).select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("text_sha256"))


def op4_toxicity_fm(spark: SparkSession, sf_dir: str) -> DataFrame:
    from gazette.llm.toxicity_fm import score_toxicity
    from gazette.llm.words import crc_mod
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = score_toxicity(docs, _table(spark, sf_dir, "labels"), crc_mod("doc_id", 5) != 0)
    return scored.select("doc_id", (crc_mod("doc_id", 5) == 0).alias("held_out"), "score", "predicted")


def op5_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages are labelled by the document that the number in their path names: blocked if
    it is toxic or of low quality."""
    from gazette.llm.url_rules import judge_urls, url_path
    pages = _table(spark, sf_dir, "pages").select("page_id", "url")
    bad = _table(spark, sf_dir, "labels").groupBy("doc_id").agg(F.max((F.col("toxic") == 1) | (F.col("quality") == 0)).alias("blocked"))
    number = F.regexp_extract(url_path(F.col("url")), r"/([0-9]{1,18})(?:[./]|$)", 1)
    numbered = pages.withColumn("doc_id", F.when(number != "", number.cast("long")))
    return judge_urls(pages, numbered.join(bad, "doc_id").select("url", "blocked"))


def op6_crosspolytope_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from gazette.llm.embed_dedup import embedding_links
    return embedding_links(_table(spark, sf_dir, "embeddings"))


def op7_quality_nbsvm(spark: SparkSession, sf_dir: str) -> DataFrame:
    from gazette.llm.quality_nbsvm import score_quality
    from gazette.llm.words import crc_mod
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = score_quality(docs, _table(spark, sf_dir, "labels"), crc_mod("doc_id", 3) != 1)
    return scored.select("doc_id", (crc_mod("doc_id", 3) == 1).alias("held_out"), "score", "predicted")


def op8_bpe_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    from gazette.llm.bpe_prefix import encode_documents
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return encode_documents(docs, ids=False, decoded=False).select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")


def op9_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    from gazette.llm.mixing import mix
    return mix(_table(spark, sf_dir, "documents").select("doc_id", "source", "text")).drop("copies")


def op10_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    from gazette.llm.jaccard_join import jaccard_links
    return jaccard_links(_table(spark, sf_dir, "documents").select("doc_id", "text")).drop("fp")


def op11_token_align(spark: SparkSession, sf_dir: str) -> DataFrame:
    from gazette.llm.token_align import align_documents
    return align_documents(_table(spark, sf_dir, "documents").select("doc_id", "text"), groups=False)


def op12_langid_backoff(spark: SparkSession, sf_dir: str) -> DataFrame:
    from gazette.llm.langid import predict_languages
    from gazette.llm.words import crc_mod
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    found = predict_languages(docs, crc_mod("doc_id", 5) != 0)
    return found.select("doc_id", (crc_mod("doc_id", 5) == 0).alias("held_out"), "lang_pred", "score")


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    from gazette.llm.whitening import whiten
    return whiten(_table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))


QUERIES = {f.__name__: f for f in (op1_lbl_score, op2_segment_topk, op3_line_dedup, op4_toxicity_fm, op5_url_rules, op6_crosspolytope_dedup, op7_quality_nbsvm, op8_bpe_roundtrip, op9_source_mix, op10_jaccard_join,
                                   op11_token_align, op12_langid_backoff, op13_whitening)}

ORACLES = {
    "op2_segment_topk": """
        WITH v AS (SELECT DISTINCT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
                   FROM embeddings
                   WHERE embedding IS NOT NULL AND len(embedding) > 0 AND vec_id IS NOT NULL
                     AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
             s AS (SELECT q.vec_id AS query_id, c.vec_id,
                          CAST(list_sum(list_transform(range(1, len(q.v) + 1), lambda i: q.v[i] * c.v[i])) AS BIGINT) AS score
                   FROM v q JOIN v c ON len(q.v) = len(c.v) AND q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0),
             r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s)
        SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5""",
    "op3_line_dedup": r"""
        WITH raw AS (SELECT doc_id, text, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS pos
                     FROM documents),
             l AS (SELECT doc_id, pos, line, regexp_extract_all(line, '[^\x20\x09-\x0D]+') AS w FROM raw),
             d AS (SELECT w, len(w) AS n, min((doc_id, pos)) AS o FROM l WHERE len(w) > 0 GROUP BY w),
             cut AS (SELECT o, i, list_concat(list_slice(w, 1, i - 1), list_slice(w, i + 1, n)) AS v
                     FROM (SELECT o, w, n, unnest(range(1, n + 1)) AS i FROM d WHERE n >= 5)),
             near AS (SELECT d.o FROM d JOIN cut ON cut.v = d.w WHERE cut.o < d.o
                      UNION SELECT cut.o FROM cut JOIN d ON cut.v = d.w WHERE d.o < cut.o
                      UNION SELECT a.o FROM cut a JOIN (SELECT v, i, min(o) AS o FROM cut GROUP BY ALL) b USING (v, i) WHERE b.o < a.o),
             f AS (SELECT l.*, len(l.w) > 0 AS worded,
                          coalesce(len(l.w) > 0 AND (d.o <> (l.doc_id, l.pos) OR d.o IN (SELECT o FROM near)), false) AS gone
                   FROM l LEFT JOIN d ON d.w = l.w),
             t AS (SELECT doc_id, count(*) FILTER (WHERE worded) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
                          coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '') AS kept
                   FROM f GROUP BY doc_id)
        SELECT x.doc_id, coalesce(t.n_lines, 0) AS n_lines, coalesce(t.n_dropped, 0) AS n_dropped,
               CASE WHEN x.text IS NOT NULL THEN sha256(t.kept) END AS text_sha256
        FROM documents x LEFT JOIN t USING (doc_id)""",
    "op9_source_mix": r"""
        WITH z AS (SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS size FROM documents),
             k AS (SELECT *, CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || CAST(size AS VARCHAR)), 1, 15) AS BIGINT) AS h FROM z),
             s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM k GROUP BY source),
             w AS (SELECT *, CAST((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS DOUBLE) AS weight, source_size * 3.0::DOUBLE AS most FROM s),
             r AS (SELECT *, most / weight AS ratio FROM w),
             v AS (SELECT *, (sum(source_size) OVER () - coalesce(sum(most) OVER b, 0.0::DOUBLE)) / (sum(weight) OVER () - coalesce(sum(weight) OVER b, 0.0::DOUBLE)) AS level,
                          row_number() OVER (ORDER BY ratio, source NULLS LAST) AS place
                   FROM r WINDOW b AS (ORDER BY ratio, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
             y AS (SELECT min_by(level, place) AS level FROM v WHERE level <= ratio),
             t AS (SELECT v.source, source_size, coalesce(least(most, y.level * weight), most) AS target FROM v CROSS JOIN y),
             g AS (SELECT *, CASE WHEN source_size > 0 THEN least(CAST(floor(target / source_size) AS BIGINT), 3) ELSE 0 END AS whole FROM t),
             c AS (SELECT k.source, h, sum(size) AS own, any_value(g.target - g.whole * g.source_size) AS budget
                   FROM k JOIN g ON k.source IS NOT DISTINCT FROM g.source GROUP BY k.source, h),
             u AS (SELECT *, sum(own) OVER (PARTITION BY source ORDER BY h) AS upto FROM c),
             e AS (SELECT source, min(h) AS h, min_by(CASE WHEN abs(upto - budget) < abs(upto - own - budget) THEN 1 ELSE 0 END, h) AS more
                   FROM u WHERE upto >= budget GROUP BY source)
        SELECT k.doc_id, k.size, g.source_size, g.target,
               CAST(k.size * least(g.whole + CASE WHEN k.h < e.h + e.more THEN 1 ELSE 0 END, 3) AS BIGINT) AS taken
        FROM k JOIN g ON k.source IS NOT DISTINCT FROM g.source LEFT JOIN e ON k.source IS NOT DISTINCT FROM e.source""",
}
