"""A training corpus from raw documents: quality, line dedup, near-dedup, mix, BPE.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet
and read again as the next stage's docs. All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from gazette.llm.bpe_prefix import encode_documents
from gazette.llm.jaccard_join import keep_one_of_each_group
from gazette.llm.line_dedup import dedup_lines
from gazette.llm.mixing import take_mix
from gazette.llm.quality_nbsvm import score_quality
from gazette.llm.words import crc_mod
from gazette.session import materialize, prepare, read_table


def _apart(docs: DataFrame, *made: str) -> tuple[DataFrame, dict]:
    """docs with columns named like those a stage makes under other names, and the way back."""
    names = {c: f"_own_{c}" for c in docs.columns if c in made}
    return docs.withColumnsRenamed(names), {new: old for old, new in names.items()}


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects (score below 0.5) go. Null and empty texts are
    scored like any other; repeated rows stay or go together; columns named score or predicted pass."""
    prepare(spark)
    own, back = _apart(docs, "score", "predicted")
    scored = score_quality(own, read_table(spark, sf_dir, "labels"), crc_mod("doc_id", 3) != 1)
    return scored.filter("predicted = 1").select(*own.columns).withColumnsRenamed(back)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that an earlier line makes redundant go; documents of which nothing is left
    go with them. n_chars follows the text. Null and empty texts stay; rows that repeat an id
    and text are treated alike; columns named n_lines or n_dropped pass."""
    prepare(spark)
    docs, back = _apart(docs, "n_lines", "n_dropped")
    out = dedup_lines(docs).filter("n_dropped = 0 OR n_dropped < n_lines")
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(F.col("n_dropped") > 0, F.char_length("text")).otherwise(F.col("n_chars")).cast(docs.schema["n_chars"].dataType))
    return out.select(*docs.columns).withColumnsRenamed(back)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays, the one with the smallest id; see
    `jaccard_join` for nulls, short texts, ties and repeated rows."""
    prepare(spark)
    return keep_one_of_each_group(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources come to their target weights: documents are left out or repeated."""
    prepare(spark)
    return take_mix(docs)


def bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as token ids, with the hash of the text that these ids decode to."""
    prepare(spark)
    return encode_documents(docs, ids=True, decoded=False, cache=80_000).drop("text")


STAGES = [("quality", quality), ("line_dedup", line_dedup), ("near_dedup", near_dedup), ("mix", mix), ("bpe", bpe)]

#: The first stage is a fitted model, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of sf_dir."""
    prepare(spark)
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
