"""Bounded samples of labelled rows, for fitting classifiers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

#: Labelled rows that a classifier is fitted on at most.
MAX_ROWS = 16_384


def labelled_rows(docs: DataFrame, labels: DataFrame, label: str, usable: Column, id_col: str = "doc_id",
                  text: str = "text", max_rows: int = MAX_ROWS) -> DataFrame:
    """(text, y) of up to max_rows labelled documents for which `usable` holds (a condition
    on the id). The rows with the smallest hash of their id are taken, so reruns agree.
    Null labels and ids are left out; an id with several labels takes their majority (a tie
    counts 1), one with several texts the one with the smallest hash. The chosen ids, a bounded table, are broadcast: no text is shuffled."""
    y = labels.filter(F.col(f"`{label}`").isin(0, 1) & F.col(f"`{id_col}`").isNotNull() & usable)
    y = y.groupBy(F.col(f"`{id_col}`").alias("_id")).agg((F.avg(F.col(f"`{label}`")) >= 0.5).cast("int").alias("y"))
    y = y.withColumn("_h", F.pmod(F.xxhash64("_id", F.lit(11)), F.lit(1 << 20)))
    n = y.count()
    if n > 4 * max_rows:        # so that tasks do not send the driver max_rows each
        y = y.filter(F.col("_h") < (2 * max_rows << 20) // n + 1)
    y = y.orderBy("_h", "_id").limit(max_rows).drop("_h")
    found = docs.select(F.col(f"`{id_col}`").alias("_id"), F.col(f"`{text}`").alias("text")).join(F.broadcast(y), "_id")
    ids = found.agg(F.count("*"), F.count_distinct("_id")).first()          # reads ids alone
    if ids[0] > ids[1]:
        found = found.groupBy("_id", "y").agg(F.min(F.struct(F.xxhash64("text").alias("h"), "text")).alias("m")).select("m.text", "y")
    return found.select("text", "y")
