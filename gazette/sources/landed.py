"""Landed items of all kinds in one table, read from a configuration.

Items are partitioned by kind and source, so a run reads the files of the sources its
configuration names: kinds are a filter on a partition column, sources come through a join
with the configuration, which prunes partitions when the job runs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from gazette import config as C
from gazette.operators.select import cap_per_source
from gazette.sources.config_dim import broadcast_checked, select_kinds, sources_frame
from gazette.sources.documents import finish_articles, run_ts_lit

ITEM_COLUMNS = ["kind", "source_name", "item_pos", "title", "content", "author", "date", "date_text", "source_url"]


def land_items(items: DataFrame, path: str) -> None:
    """Adds items (ITEM_COLUMNS) to the landed table. A source's rows are dealt over
    several files by position, so a large source is not one task."""
    (items.select(*ITEM_COLUMNS).withColumn("_deal", F.pmod(F.xxhash64("item_pos"), F.lit(8)))
     .repartition("kind", "source_name", "_deal").drop("_deal")
     .write.mode("append").partitionBy("kind", "source_name").parquet(path))


def read_configured(spark: SparkSession, path: str, cfg: C.RunConfig) -> DataFrame:
    """Landed items of the configuration's enabled sources of the selected kinds, with
    their caps and positions, before caps."""
    dim = select_kinds(sources_frame(spark, cfg), cfg.source_kinds)
    dim = dim.select("kind", "kind_rank", "source_pos", "source_name", "max_articles")
    items = spark.read.parquet(path).filter(F.col("kind").isin(list(cfg.source_kinds)))
    return items.join(broadcast_checked(dim, len(cfg.sources)), ["kind", "source_name"])


def articles_from_config(spark: SparkSession, cfg: C.RunConfig, path: str) -> DataFrame:
    """The configuration's articles: items capped per source (W2, before validity), the
    niche of the configuration (P10), required fields (P2), the article hash (F1)."""
    items = read_configured(spark, path, cfg)
    largest = max([s.max_articles or 0 for s in cfg.sources], default=0)
    items = cap_per_source(items, largest_cap=largest)
    ts = run_ts_lit(cfg.run_ts)
    return finish_articles(items.withColumn("niche", F.lit(cfg.niche)).withColumn("run_date", F.to_date(ts)).withColumn("ingested_at", ts))
