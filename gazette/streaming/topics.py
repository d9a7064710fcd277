"""Trend detection over time (T5): topic counts per day, batch and streaming."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession, Window, functions as F
from pyspark.sql.streaming import StreamingQuery

from gazette.session import materialize
from gazette.streaming import ledger as L
from gazette.streaming.runs import _query_id


def daily_topic_counts(df: DataFrame, ts: str, topic: str) -> DataFrame:
    """Tumbling one-day windows; partial aggregation before the shuffle."""
    w = F.window(F.col(ts).cast("timestamp"), "1 day")
    return (df.groupBy(w.alias("w"), F.col(topic).alias("topic")).agg(F.count("*").alias("n"))
            .select(F.date_format("w.start", "yyyy-MM-dd").alias("day"), "topic", "n"))


def emerging(counts: DataFrame) -> DataFrame:
    """Change of each topic's count from the calendar day before (one row per day and
    topic; the window holds one topic's days). A topic without a count on that day, such
    as a new one, has a prev_n of 0 and grows by its whole count."""
    w = Window.partitionBy("topic").orderBy("day")
    day_before = F.datediff("day", F.lag("day").over(w)) == 1
    return (counts.withColumn("prev_n", F.coalesce(F.when(day_before, F.lag("n").over(w)), F.lit(0)))
            .withColumn("growth", F.col("n") - F.col("prev_n")))


def stream_topic_counts(stream: DataFrame, ts: str, topic: str, lateness: str = "1 day") -> DataFrame:
    """Streaming form: a watermark bounds state; windows are emitted once final
    (append mode) and rows later than the watermark are dropped. The windows that the
    watermark has not passed when the stream stops are not in the result; a later run
    from the same checkpoint writes them."""
    s = stream.withColumn("_ts", F.col(ts).cast("timestamp")).withWatermark("_ts", lateness)
    return (s.groupBy(F.window("_ts", "1 day").alias("w"), F.col(topic).alias("topic")).agg(F.count("*").alias("n"))
            .select(F.date_format("w.start", "yyyy-MM-dd").alias("day"), "topic", "n"))


def _closed(spark: SparkSession, out_path: str) -> DataFrame:
    """Committed rows of closed days, partitioned by day."""
    return L.visible(spark.read.schema("topic string, n long, prev_n long, growth long, day string, run string").parquet(out_path),
                     L.committed(spark, out_path))


def make_growth_batch(out_path: str, stream: str | None = None):
    """foreachBatch body over closed (day, topic, n): adds prev_n and growth. The day before
    is in the same micro-batch or among the days written earlier, of which only that one is
    read; the ledger commits an epoch once."""
    def run(batch: DataFrame, epoch_id: int) -> None:
        spark = batch.sparkSession
        now = _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None)
        attempt = L.begin(spark, out_path, now, stream or _query_id(spark) or "topics", epoch_id)
        if attempt is None:
            return
        rows = materialize(batch, "topics-closed")
        days = [r[0] for r in rows.select("day").distinct().collect()]          # the days that closed
        if days:
            before = [(_dt.date.fromisoformat(d) - _dt.timedelta(days=1)).isoformat() for d in days]
            known = rows
            if not L.committed(spark, out_path).isEmpty():
                known = rows.unionByName(_closed(spark, out_path).filter(F.col("day").isin(before)).select("day", "topic", "n"))
            prev = known.select(F.date_format(F.date_add(F.to_date("day"), 1), "yyyy-MM-dd").alias("day"), F.struct("topic").alias("k"), F.col("n").alias("prev_n"))
            out = rows.withColumn("k", F.struct("topic")).join(prev, ["day", "k"], "left").select(
                "day", "topic", "n", F.coalesce("prev_n", F.lit(0)).alias("prev_n"), (F.col("n") - F.coalesce("prev_n", F.lit(0))).alias("growth"))
            out.withColumn("run", F.lit(attempt.name)).write.mode("append").partitionBy("day", "run").parquet(out_path)
            L.commit(spark, out_path, attempt)
    return run


def start_emerging(stream: DataFrame, ts: str, topic: str, out_path: str, checkpoint: str, lateness: str = "1 day",
                   available_now: bool = True) -> StreamingQuery:
    """T5 as a stream: a day's counts are final once the watermark has passed it, and are then written with
    their growth against the day before; `emerging_rows` reads them."""
    counts = stream_topic_counts(stream, ts, topic, lateness)
    w = (counts.writeStream.outputMode("append").foreachBatch(make_growth_batch(out_path)).option("checkpointLocation", checkpoint))
    return (w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")).start()


def emerging_rows(spark: SparkSession, out_path: str) -> DataFrame:
    """(day, topic, n, prev_n, growth) of the days that are closed."""
    return _closed(spark, out_path).select("day", "topic", "n", "prev_n", "growth")
