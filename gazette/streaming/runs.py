"""Scheduled incremental runs (T1, T3, T4): each trigger of a file stream builds the
editions of the new articles; seen state and published rows are tables in shared
storage. Both are partitioned by the attempt that wrote them and count once the ledger
(`streaming/ledger.py`) has it; the seen state also by day, so a run
reads the days inside the time to live alone."""

from __future__ import annotations

import datetime as _dt

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

from gazette import config as C
from gazette.operators import dedup as D
from gazette.operators.publish import write_published
from gazette.session import materialize
from gazette.streaming import ledger as L


def seen_table(spark: SparkSession, path: str, run_ts: _dt.datetime | None = None, ttl_days: int = C.SEEN_TTL_DAYS,
               runs: DataFrame | None = None) -> DataFrame | None:
    """The seen state, or nothing when it does not exist yet (any other error is
    raised). With run_ts only the days inside the time to live are read; with the ledger's
    `runs` only what committed runs have marked."""
    try:
        seen = spark.read.schema("article_hash string, title string, seen_at timestamp, seen_date date, run string").parquet(path)
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return None
        raise
    if run_ts is not None:
        seen = seen.filter(F.col("seen_date") >= F.lit((run_ts - _dt.timedelta(days=ttl_days)).date()))
    if runs is not None:
        seen = L.visible(seen, runs)
    return seen.select("article_hash", "title", "seen_at")


def write_seen(rows: DataFrame, path: str, run: str) -> None:
    """K5: the rows of one run, by day; writing the same run again replaces them."""
    (rows.withColumn("seen_date", F.to_date("seen_at")).withColumn("run", F.lit(run))
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("seen_date", "run").parquet(path))


def _query_id(spark: SparkSession) -> str | None:
    """Id of the streaming query whose micro-batch runs; it stays over restarts."""
    return spark.sparkContext.getLocalProperty("sql.streaming.queryId")


def make_batch_fn(seen_path: str, out_path: str, run_ts: _dt.datetime, build,
                  ttl_days: int = C.SEEN_TTL_DAYS, stream: str | None = None):
    """foreachBatch body: dedup against the live seen state (J3 + W1), build the edition
    rows with `build(articles) -> DataFrame[niche, run_date, ...]`, write them and the
    accepted hashes (K5), then commit both as one run of the ledger next to out_path. An epoch that
    is committed already (of the same query, or of `stream`) is left alone, so a repeated micro-batch changes nothing."""
    def run(batch: DataFrame, epoch_id: int) -> None:
        spark = batch.sparkSession
        name = stream or _query_id(spark) or f"{run_ts:%Y-%m-%dT%H-%M-%S}"
        attempt = L.begin(spark, out_path, run_ts, name, epoch_id)
        if attempt is None:
            return
        seen = seen_table(spark, seen_path, run_ts, ttl_days, runs=L.committed(spark, out_path))
        # written once: what is published and what is marked seen are the same rows
        fresh = materialize(D.deduplicate(batch, seen, run_ts, ttl_days), "batch-articles")
        write_published(build(fresh), out_path, attempt.name)
        write_seen(D.seen_update(fresh, None, run_ts), seen_path, attempt.name)
        L.commit(spark, out_path, attempt)
    return run


def start_incremental(articles_stream: DataFrame, seen_path: str, out_path: str, checkpoint: str,
                      run_ts: _dt.datetime, build, available_now: bool = True):
    """One scheduled run = one availableNow trigger over newly landed articles."""
    w = articles_stream.writeStream.foreachBatch(make_batch_fn(seen_path, out_path, run_ts, build))
    w = w.option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()
