"""Exact time-to-live dedup in Structured Streaming.

Rows of a micro-batch are taken in (ts, id) order; a row is accepted when its key has no
accepted row yet or when ts >= last accepted + ttl (TTL counts from acceptance; a duplicate
does not renew it; a row older than the last accepted one is a duplicate).

The state is the output: accepted rows are written by day and attempt, and the last one of
each key inside the time to live is where the next micro-batch goes on. Rows it covers go;
what is left is a batch of its own, chained by `operators.dedup.ttl_chain`, which spreads
a hot key over its time slices, so no key is gathered into one task. The ledger commits each epoch
once, so a micro-batch repeated after a crash or a restart changes nothing.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from gazette import config as C
from gazette.operators import dedup as D
from gazette.session import materialize
from gazette.streaming import ledger as L
from gazette.streaming.runs import _query_id


def _day(us: int) -> _dt.date:
    return (_dt.datetime(1970, 1, 1) + _dt.timedelta(microseconds=us)).date()


def accepted_rows(spark: SparkSession, out_path: str) -> DataFrame:
    """All rows accepted by committed micro-batches."""
    rows = L.visible(spark.read.parquet(out_path), L.committed(spark, out_path))
    return rows.drop("run", "day")


def last_accepted(spark: SparkSession, out_path: str, schema: str, keys, ts: str, since: _dt.date) -> DataFrame | None:
    """(k, last_us): the last accepted time of each key with one since that day; nothing
    before the first micro-batch."""
    try:
        rows = spark.read.schema(f"{schema}, day date, run string").parquet(out_path)
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return None
        raise
    rows = L.visible(rows.filter(F.col("day") >= F.lit(since)), L.committed(spark, out_path))
    return rows.groupBy(F.struct(*keys).alias("k")).agg(F.max(F.unix_micros(F.col(ts).cast("timestamp"))).alias("last_us"))


def make_ttl_batch(out_path: str, keys, ts: str = "ts", id_col: str = "event_id", ttl_days: int = C.SEEN_TTL_DAYS,
                   slice_seconds: int = 3600, stream: str | None = None):
    """foreachBatch body: writes the accepted rows (id, keys, ts) of one micro-batch."""
    keys = list(keys)
    ttl_us = int(ttl_days) * 86400 * 1_000_000

    def run(batch: DataFrame, epoch_id: int) -> None:
        spark = batch.sparkSession
        now = _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None)
        attempt = L.begin(spark, out_path, now, stream or _query_id(spark) or "ttl", epoch_id)
        if attempt is None:
            return
        nodes = materialize(D.ttl_nodes(batch, keys, ts, id_col), "ttl-nodes")
        first = nodes.agg(F.min("us")).first()[0]
        if first is not None:
            schema = ", ".join(f"`{c}` {batch.schema[c].dataType.simpleString()}" for c in (id_col, *keys, ts))
            last = last_accepted(spark, out_path, schema, keys, ts, _day(first - ttl_us))
            if last is not None:      # one row for each key: a hot key is split on the side of the nodes
                nodes = nodes.join(last, "k", "left").filter(F.col("last_us").isNull() | (F.col("us") >= F.col("last_us") + ttl_us)).drop("last_us")
                nodes = materialize(nodes, "ttl-nodes-left")
            rows = D.ttl_rows(D.ttl_chain(nodes, ttl_days, slice_seconds), keys, ts, id_col)
            (rows.withColumn("day", F.to_date(ts)).withColumn("run", F.lit(attempt.name))
             .write.mode("append").partitionBy("day", "run").parquet(out_path))
        L.commit(spark, out_path, attempt)
    return run


def start_ttl_dedup(stream: DataFrame, keys, out_path: str, checkpoint: str, ts: str = "ts", id_col: str = "event_id",
                    ttl_days: int = C.SEEN_TTL_DAYS, available_now: bool = True) -> StreamingQuery:
    """T2 over a streaming DataFrame into out_path; `accepted_rows` reads what is committed."""
    w = (stream.select(id_col, *keys, ts).writeStream.foreachBatch(make_ttl_batch(out_path, keys, ts, id_col, ttl_days))
         .option("checkpointLocation", checkpoint))
    return (w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")).start()
