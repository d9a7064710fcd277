"""Canonical table schemas (§1.3) and the checks applied to user extensions."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

ARTICLES = ("article_id STRING, niche STRING, run_date DATE, title STRING, content STRING, author STRING, "
            "date TIMESTAMP, date_text STRING, source_url STRING, source_name STRING, kind_rank INT, "
            "source_pos INT, item_pos BIGINT, ingested_at TIMESTAMP_NTZ")
PUBLISHED = "niche STRING, run_date DATE, kind STRING, path STRING, body STRING"


def _fields(ddl: str):
    out = []
    for part in ddl.split(", "):
        name, typ = part.split(" ", 1)
        out.append((name, typ))
    return out


def conform(df: DataFrame, ddl: str) -> DataFrame:
    """Select the canonical columns in order, cast to their types; a missing column is
    an error (an extension must produce every column, nulls allowed)."""
    missing = [n for n, _ in _fields(ddl) if n not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {missing}")
    return df.select(*[F.col(n).cast(t).alias(n) for n, t in _fields(ddl)])


def custom_source(fn, spark, cfg) -> DataFrame:
    """A custom source is a function (spark, cfg) -> DataFrame of articles."""
    return conform(fn(spark, cfg), ARTICLES)


def custom_publishers(publishers, editions: DataFrame, pairs: DataFrame) -> DataFrame:
    """Each publisher is a function (editions, pairs) -> DataFrame of published rows;
    their rows are one union."""
    frames = [conform(p(editions, pairs), PUBLISHED) for p in publishers]
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out
