"""Registered queries that run Structured Streaming jobs over the landed tables
(availableNow triggers into sinks under the shared checkpoint folder)."""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.sql import functions as F

from gazette.plans.common import normalise, table
from gazette.session import scratch_path

QUERIES = {}
ORACLES = {}


def register(name, sql=None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return deco


@contextmanager
def _state_partitions(spark):
    """The number of state partitions is fixed when a checkpoint is created: the cluster's
    parallelism for a new query, then the session's setting again."""
    key = "spark.sql.shuffle.partitions"
    before = spark.conf.get(key)
    try:
        spark.conf.set(key, str(spark.sparkContext.defaultParallelism))
        yield
    finally:
        spark.conf.set(key, before)


def _events_stream(spark, sf):
    ev = table(spark, sf, "events")
    return spark.readStream.schema(ev.schema).option("pathGlobFilter", "events.parquet").parquet(sf)


def _ttl_sql():
    from gazette.plans.dedup_plans import TTL_SQL
    return TTL_SQL


@register("ttl_dedup_stream", _ttl_sql())
def q_ttl_dedup_stream(spark, sf):
    """Exact 7-day TTL per (user_id, event_type). Events land in three parts by time;
    two are read by one micro-batch each, the third by the restarted query."""
    from gazette.streaming.ttl import accepted_rows, start_ttl_dedup
    ev = table(spark, sf, "events")
    base = scratch_path(spark, "ttl-stream")
    us = F.unix_micros(F.col("ts").cast("timestamp"))
    a, b = ev.agg(F.min(us), F.max(us)).first()
    third = 0 if a is None else (b - a) // 3 + 1
    for k in range(3):
        part = ev if a is None else ev.filter(us.between(a + k * third, a + (k + 1) * third - 1))
        (part if a is not None or k == 0 else part.limit(0)).coalesce(1).write.mode("append").parquet(base + "/landed")
        if k:
            stream = spark.readStream.schema(ev.schema).option("maxFilesPerTrigger", 1).parquet(base + "/landed")
            start_ttl_dedup(stream, ["user_id", "event_type"], base + "/out", base + "/checkpoint").awaitTermination()
    return normalise(accepted_rows(spark, base + "/out").select("event_id", "user_id", "event_type", F.col("ts").cast("timestamp_ntz").alias("ts")))


# A window [day, day + 1) is written once the watermark (latest event time - 1 day)
# reaches its end.
@register("emerging_topics_stream", """
WITH c AS (SELECT CAST(date_trunc('day', ts) AS DATE) AS d, event_type AS topic, count(*) AS n FROM events WHERE ts IS NOT NULL GROUP BY ALL)
SELECT strftime(c.d, '%Y-%m-%d') AS day, c.topic, c.n, coalesce(p.n, 0) AS prev_n, c.n - coalesce(p.n, 0) AS growth
FROM c LEFT JOIN c p ON p.topic IS NOT DISTINCT FROM c.topic AND p.d = c.d - 1
WHERE c.d + INTERVAL 1 DAY <= (SELECT max(ts) FROM events) - INTERVAL 1 DAY""")
def q_emerging_topics_stream(spark, sf):
    """T5: daily topic counts with a one-day watermark, written with their growth once final."""
    from gazette.streaming.topics import emerging_rows, start_emerging
    base = scratch_path(spark, "topics-stream")
    with _state_partitions(spark):
        q = start_emerging(_events_stream(spark, sf), "ts", "event_type", base + "/out", base + "/checkpoint")
    q.awaitTermination()
    return normalise(emerging_rows(spark, base + "/out"))
