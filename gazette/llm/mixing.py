"""Mixing sources to target weights with hash-threshold histograms (DataFrame functions only).

A document's hash of 60 bits is its place in its source. The sizes are summed by source and
the first 12 bits; in this histogram the bucket is found in which the source's budget ends,
and only that bucket is cut finer, 12 bits at a time, down to one hash. Documents below the
threshold get the extra copy: a filter, without a sort of the documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from gazette.llm.words import word_count
from gazette.session import materialize

WEIGHTS = (1.0, 2.0, 3.0)
MAX_REPEATS = 3
BITS, LEVELS = 12, 5
#: Sources up to which their table (a few numbers each) is broadcast; beyond it is joined by a shuffle.
MAX_BROADCAST_SOURCES = 50_000


def _targets(sources: DataFrame, weights, max_repeats: int) -> DataFrame:
    """Adds `target` to (source, source_size). Sources that stop at max_repeats times their
    size leave the rest to the others by weight, until none is above: with the sources in
    the order in which they reach their limit, the level is the first that holds for all
    that follow. One row per source goes through this, not documents."""
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last()))
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), (F.pmod(rank - 1, F.lit(len(weights))) + 1).cast("int"))
    t = sources.withColumn("weight", w).withColumn("most", F.col("source_size") * F.lit(float(max_repeats)))
    t = t.withColumn("ratio", F.col("most") / F.col("weight"))
    order = Window.orderBy("ratio", F.col("source").asc_nulls_last())
    before, every = order.rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy()
    t = (t.withColumn("level", (F.sum("source_size").over(every) - F.coalesce(F.sum("most").over(before), F.lit(0.0)))
                      / (F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))))
         .withColumn("_at", F.when(F.col("level") <= F.col("ratio"), F.row_number().over(order))))
    t = t.withColumn("level", F.min(F.when(F.col("_at").isNotNull(), F.struct("_at", "level"))).over(every)["level"])
    # rounding may leave no source below its limit
    return t.withColumn("target", F.coalesce(F.least("most", F.col("level") * F.col("weight")), F.col("most"))).select("source", "source_size", "target")


def mix(docs: DataFrame, id_col: str = "doc_id", source: str = "source", text: str = "text",
        weights=WEIGHTS, max_repeats: int = MAX_REPEATS) -> DataFrame:
    """One row per document: (id, size, source_size, target, copies, taken); copies is how
    often the mix takes the whole document, taken = size * copies.

    size: words of the text (null and empty: 0). Sources in code-point order, null last,
    weigh as `weights`, repeating; together they share all words, none above max_repeats
    times its own. A source's taken words differ from its target by less than the size of
    one document (or of the documents that share an id and a size: they are taken alike).
    The choice follows from id and size alone, so reruns agree. Null ids hash as the empty
    text. Sources without words have target 0, and their documents no copies. An empty
    table gives no rows.
    """
    size = word_count(F.col(f"`{text}`"))
    key = F.concat_ws(":", F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit("")), size.cast("string"))
    sized = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{source}`").alias("source"), size.alias("size"),
                        F.conv(F.substring(F.md5(key.cast("binary")), 1, BITS * LEVELS // 4), 16, 10).cast("long").alias("h"))
    sized = materialize(sized, "mix-sizes")
    sources = materialize(sized.groupBy("source").agg(F.sum("size").alias("source_size")), "mix-sources")
    small = F.broadcast if sources.count() <= MAX_BROADCAST_SOURCES else (lambda df: df)
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0))
    state = (_targets(sources, weights, max_repeats)
             .withColumn("whole", F.least(whole.cast("long"), F.lit(max_repeats)))
             .withColumn("budget", F.col("target") - F.col("whole") * F.col("source_size"))
             .withColumn("prefix", F.lit(0).cast("long")).withColumn("below", F.lit(0).cast("long")).withColumn("own", F.lit(0).cast("long")))
    state = materialize(state, "mix-targets")
    for level in range(LEVELS):
        up, down = BITS * (LEVELS - level), BITS * (LEVELS - level - 1)
        at = state.select(F.col("source").alias("_s"), "prefix", "below", "budget")
        inside = sized.join(small(at), F.col("source").eqNullSafe(F.col("_s")) & (F.shiftright("h", up) == F.col("prefix")))
        sums = inside.groupBy("source", F.shiftright("h", down).alias("bucket")).agg(F.sum("size").alias("own"), F.first("below").alias("start"), F.first("budget").alias("budget"))
        w = Window.partitionBy("source").orderBy("bucket")
        sums = sums.withColumn("upto", F.col("start") + F.sum("own").over(w))
        # the first bucket that reaches the budget
        ends = (sums.filter("upto >= budget").groupBy(F.col("source").alias("_s"))
                .agg(F.min(F.struct("bucket", "upto", "own")).alias("b")))
        state = (state.join(small(ends), F.col("source").eqNullSafe(F.col("_s")), "left")
                 .select("source", "source_size", "target", "whole", "budget",
                         F.col("b.bucket").alias("prefix"), (F.col("b.upto") - F.col("b.own")).alias("below"), F.col("b.own").alias("own")))
        state = materialize(state, "mix-state")
    nearer = F.abs(F.col("below") + F.col("own") - F.col("budget")) < F.abs(F.col("below") - F.col("budget"))
    state = state.select(F.col("source").alias("_s"), "source_size", "target", "whole",
                         (F.col("prefix") + nearer.cast("long")).alias("threshold"))
    copies = F.col("whole") + F.coalesce(F.col("h") < F.col("threshold"), F.lit(False)).cast("long")
    out = sized.join(small(state), F.col("source").eqNullSafe(F.col("_s"))).withColumn("copies", F.least(copies, F.lit(max_repeats).cast("long")))
    return out.select(F.col("id").alias(id_col), "size", "source_size", "target", "copies", (F.col("size") * F.col("copies")).alias("taken"))


def take_mix(docs: DataFrame, id_col: str = "doc_id", source: str = "source", text: str = "text", **options) -> DataFrame:
    """The rows of `docs`, each as often as the mix takes it. Documents without words are
    in no mix."""
    chosen = mix(docs, id_col, source, text, **options).filter("copies > 0 AND size > 0")
    # rows that share an id and a size are taken alike, so one decision holds for them
    chosen = chosen.groupBy(F.col(id_col).alias("_id"), F.col("size").alias("_n")).agg(F.max("copies").alias("_copies"))
    found = docs.join(chosen, F.col(f"`{id_col}`").eqNullSafe(F.col("_id")) & (word_count(F.col(f"`{text}`")) == F.col("_n")))
    return found.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_copies").cast("int")))).select(*[F.col(f"`{c}`") for c in docs.columns])
