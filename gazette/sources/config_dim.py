"""The `sources` and `channels` dimensions.

A configuration is small and lives on the driver; it becomes a DataFrame once and is
broadcast after its row count is checked. A dimension derived from data (distinct
sources of a table) is joined normally and AQE broadcasts it when its measured size
is small.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from gazette import config as C
from gazette.sources.documents import KIND_RANK, source_position

MAX_BROADCAST_ROWS = 100_000

SOURCE_SCHEMA = ("kind STRING, kind_rank INT, source_pos INT, source_name STRING, url STRING, "
                 "max_articles INT, fetch_full_content BOOLEAN, selectors MAP<STRING,STRING>, enabled BOOLEAN")


def _netloc(url: str) -> str:
    from urllib.parse import urlparse
    return urlparse(url).netloc


def sources_frame(spark: SparkSession, cfg: C.RunConfig) -> DataFrame:
    """Configured sources in configuration order; name defaults to the URL's
    netloc (F10), caps to 20 (feeds) / 10 (web) (M8, M9)."""
    rows, pos = [], {"web": 0, "rss": 0}
    for s in cfg.sources:
        rows.append((s.kind, KIND_RANK[s.kind], pos[s.kind], s.name or _netloc(s.url), s.url,
                     s.max_articles if s.max_articles is not None else
                     (C.DEFAULT_RSS_MAX_ARTICLES if s.kind == "rss" else C.DEFAULT_WEB_MAX_ARTICLES),
                     bool(s.fetch_full_content), dict(s.selectors), bool(s.enabled)))
        pos[s.kind] += 1
    return spark.createDataFrame(rows, SOURCE_SCHEMA)


def select_kinds(dim: DataFrame, kinds=("web", "rss")) -> DataFrame:
    """CLI --sources rss|web|all keeps the chosen kinds (unselected scans prune)."""
    return dim.filter(F.col("kind").isin(list(kinds)) & F.col("enabled"))


def feed_dimension(docs: DataFrame, max_articles: int = C.DEFAULT_RSS_MAX_ARTICLES) -> DataFrame:
    """Sources derived from the distinct `source` values of a landed table."""
    return (docs.select(F.col("source").alias("source_name")).distinct()
            .select(F.lit("rss").alias("kind"), F.lit(KIND_RANK["rss"]).alias("kind_rank"),
                    source_position("source_name").alias("source_pos"), "source_name",
                    F.lit(int(max_articles)).alias("max_articles"),
                    F.lit(False).alias("fetch_full_content"), F.lit(True).alias("enabled")))


def broadcast_checked(dim: DataFrame, known_rows: int | None) -> DataFrame:
    """Broadcast hint only when the row count is known to be small."""
    if known_rows is not None and known_rows <= MAX_BROADCAST_ROWS:
        return F.broadcast(dim)
    return dim


def join_sources(items: DataFrame, dim: DataFrame, kinds=("web", "rss"), known_rows: int | None = None) -> DataFrame:
    """Attach name, cap and options of each item's source."""
    d = select_kinds(dim, kinds).select("kind_rank", "source_name", "max_articles", "fetch_full_content")
    return items.join(broadcast_checked(d, known_rows), ["kind_rank", "source_name"])


def channels_frame(spark: SparkSession, cfg: C.RunConfig) -> DataFrame:
    """Enabled publishing channels (preview turns social and site off)."""
    rows = [(name, bool(on) and not (cfg.preview and name != "markdown")) for name, on in cfg.channels]
    return spark.createDataFrame(rows, "channel STRING, enabled BOOLEAN")
