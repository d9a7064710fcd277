"""Deduplication: first copy per hash (W1/U2), seen anti-join (J3/P4), seen-state
update (K5), and exact time-to-live dedup in batch (T2/Z6).
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, Window, functions as F

from gazette import config as C
from gazette.functions.text import article_hash
from gazette.operators.select import order_spec
from gazette.sources.documents import run_ts_lit


def with_hash(df: DataFrame, columns=("title", "source_url", "content"), name: str = "article_hash") -> DataFrame:
    """F1 over chosen columns: the default is title:source_url:content[:200]; passing
    ('title', None, 'content') hashes title and whole content (same story from two sites:
    without the URL a prefix would join different texts with the same start)."""
    t, u, c = columns
    if u is None:
        return df.withColumn(name, F.md5(F.concat(F.col(t), F.lit("::"), F.col(c)).cast("binary")))
    return df.withColumn(name, article_hash(t, u, c))


def keep_first(df: DataFrame, key: str = "article_hash", order=None) -> DataFrame:
    """The first row per key in canonical order. Planned as a partial + final
    WindowGroupLimit, so each map task sends at most one row per key."""
    w = Window.partitionBy(key).orderBy(*(order or order_spec()))
    return df.withColumn("_k", F.row_number().over(w)).filter("_k = 1").drop("_k")


#: Bits of the map of repeated keys: 8 MB, a fixed size whatever the data.
REPEATED_BITS = 26
_PER_ROW = 15        # bits of the map in one row: 32,768, what bitmap_construct_agg holds


def repeated_bitmap(df: DataFrame, key: str, bits: int = REPEATED_BITS) -> DataFrame:
    """(_bucket, _map): a map of 2^bits places with a one at the hash of each key that occurs
    more than once. At most 2^(bits-15) rows of 4 KB. Only hashes are shuffled, counted by
    task first."""
    counts = df.select(F.xxhash64(key).alias("h")).groupBy("h").agg(F.count("*").alias("c")).filter("c > 1")
    place = F.pmod(F.col("h"), F.lit(1 << bits))
    return (counts.select(F.shiftright(place, _PER_ROW).alias("_bucket"), place.bitwiseAND((1 << _PER_ROW) - 1).alias("_p"))
            .groupBy("_bucket").agg(F.bitmap_construct_agg("_p").alias("_map")))


def first_copies(df: DataFrame, key: str = "article_hash", order=None, bits: int = REPEATED_BITS) -> DataFrame:
    """W1 for rows with text: the same rows as keep_first, but only rows whose key occurs more
    than once (and those few that share their place in the map) go through a shuffle. All
    other rows pass as they are read. The input is scanned three times, once for keys
    alone; where no key occurs twice, the keys are all that is scanned here. A null key is one key, as in keep_first."""
    from gazette.session import materialize
    repeated = materialize(repeated_bitmap(df, key, bits), "repeated-keys")
    if repeated.isEmpty():
        return df
    place = F.pmod(F.xxhash64(key), F.lit(1 << bits))
    in_row = place.bitwiseAND((1 << _PER_ROW) - 1)
    byte = F.conv(F.hex(F.substring(F.col("_map"), (F.shiftright(in_row, 3) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    bit = byte.bitwiseAND(F.element_at(F.array(*[F.lit(1 << i) for i in range(8)]), (in_row % 8 + 1).cast("int")))
    marked = (df.withColumn("_bucket", F.shiftright(place, _PER_ROW))
              .join(F.broadcast(repeated), "_bucket", "left")
              .withColumn("_again", F.coalesce(bit != 0, F.lit(False))).select(*df.columns, "_again"))
    alone = marked.filter("NOT _again").drop("_again")
    return alone.unionByName(keep_first(marked.filter("_again").drop("_again"), key, order))


def first_capped(articles: DataFrame, cap: int, key: str = "article_hash") -> DataFrame:
    """W1 + O2 without moving text: dedup and the per-edition cap run on narrow keys,
    then the kept rows (at most cap per edition) join back to the articles. Text is
    scanned twice but never shuffled."""
    from gazette.operators.select import ORDER_COLS, run_cap
    if key not in articles.columns:
        articles = articles.withColumn(key, F.col("article_id"))
    from gazette.session import materialize
    from gazette.sources.config_dim import MAX_BROADCAST_ROWS
    ident = [key, *ORDER_COLS]
    keys = articles.select(*ident, "niche", "run_date")
    kept = materialize(run_cap(keep_first(keys, key), cap).select(*ident, "rn"), "kept-keys")
    if kept.count() <= MAX_BROADCAST_ROWS:        # checked size: cap x editions rows
        kept = F.broadcast(kept)
    cond = [F.col(f"a.{c}").eqNullSafe(F.col(f"k.{c}")) for c in ident]
    back = articles.alias("a").join(kept.alias("k"), cond).select("a.*", "k.rn")
    return back.dropDuplicates(["niche", "run_date", "rn"])     # repeated rows join together; at most cap per edition are left


def live_seen(seen: DataFrame, run_ts: _dt.datetime, ttl_days: int = C.SEEN_TTL_DAYS) -> DataFrame:
    """Seen entries still inside their time to live at run time."""
    return seen.filter(F.col("seen_at") > run_ts_lit(run_ts) - F.make_dt_interval(F.lit(ttl_days)))


def drop_seen(df: DataFrame, seen: DataFrame, run_ts: _dt.datetime,
              ttl_days: int = C.SEEN_TTL_DAYS, key: str = "article_hash") -> DataFrame:
    """Keep articles whose hash is not live in the seen state."""
    live = live_seen(seen, run_ts, ttl_days).select(F.col("article_hash").alias(key))
    return df.join(live, key, "left_anti")


def deduplicate(df: DataFrame, seen: DataFrame | None = None, run_ts: _dt.datetime = C.DEFAULT_RUN_TS,
                ttl_days: int = C.SEEN_TTL_DAYS, key: str = "article_hash") -> DataFrame:
    """Z6 batch: not seen, and first of each hash inside the batch. The first copy is
    taken before the anti-join (same result), so at most one row per hash meets the
    seen state however many copies a hash has."""
    if key not in df.columns:
        df = df.withColumn(key, F.col("article_id"))
    first = first_copies(df, key) if "content" in df.columns else keep_first(df, key)
    return first if seen is None else drop_seen(first, seen, run_ts, ttl_days, key)


def seen_update(accepted: DataFrame, seen: DataFrame | None, run_ts: _dt.datetime,
                ttl_days: int = C.SEEN_TTL_DAYS) -> DataFrame:
    """K5: the next seen state = live entries plus the accepted articles (time of the run)."""
    new = accepted.select(F.col("article_id").alias("article_hash"), "title",
                          run_ts_lit(run_ts).alias("seen_at"))
    if seen is None:
        return new
    return live_seen(seen, run_ts, ttl_days).unionByName(new)


# --------------------------------------------------------------------------------------
# Exact TTL dedup in batch (T2 semantics, event time).
#
# Within a key, rows are taken in (ts, id) order; a row is accepted when there is no
# accepted row or when ts >= last accepted ts + ttl. Accepted rows form a chain
# a0 = first row, a(i+1) = nxt(a(i)) where nxt(e) = first row with ts >= e.ts + ttl.
#
# No key is gathered into one task: rows become distinct (key, ts) nodes (map-side
# aggregation), nxt is an as-of lookup done per (key, time slice) with a running min,
# and the chain is followed by pointer doubling (joins), so a hot key is spread over
# its time slices and the number of rounds is log2 of the longest chain.
# --------------------------------------------------------------------------------------

def _chain_rounds(span_seconds: float, ttl_seconds: float) -> int:
    """Rounds of doubling needed: a chain has at most floor(span/ttl) steps after its
    first node, and after i rounds every node fewer than 2^i steps away is reached."""
    return max(1, int(span_seconds // ttl_seconds).bit_length())


def ttl_nodes(events: DataFrame, keys, ts: str = "ts", id_col: str = "event_id") -> DataFrame:
    """(k, t, eid, us): the distinct (key, ts), pre-aggregated map-side; the lowest id at a
    timestamp is the row kept. The key is one struct so that joins are null-safe."""
    return (events.select(F.struct(*keys).alias("k"), F.col(ts).alias("t"), F.col(id_col).alias("eid"))
            .groupBy("k", "t").agg(F.min("eid").alias("eid"))
            .withColumn("us", F.unix_micros(F.col("t").cast("timestamp"))))


def ttl_rows(accepted: DataFrame, keys, ts: str, id_col: str) -> DataFrame:
    """Accepted nodes as rows of the events' columns."""
    return accepted.select(F.col("eid").alias(id_col), *[F.col(f"k.{c}").alias(c) for c in keys], F.col("t").alias(ts))


def ttl_dedup(events: DataFrame, keys, ts: str = "ts", id_col: str = "event_id",
              ttl_days: int = C.SEEN_TTL_DAYS, slice_seconds: int = 3600,
              checkpoint: bool = True) -> DataFrame:
    """Rows of `events` accepted under an exact TTL per key (first row always kept)."""
    from gazette.session import materialize
    nodes = ttl_nodes(events, list(keys), ts, id_col)
    if checkpoint:            # six consumers: aggregate the events once
        nodes = materialize(nodes, "ttl-nodes")
    return ttl_rows(ttl_chain(nodes, ttl_days, slice_seconds, checkpoint), list(keys), ts, id_col)


def ttl_chain(nodes: DataFrame, ttl_days: int = C.SEEN_TTL_DAYS, slice_seconds: int = 3600, checkpoint: bool = True) -> DataFrame:
    """The nodes accepted when each key's first node is."""
    from gazette.session import materialize
    ttl_us = int(ttl_days) * 86400 * 1_000_000
    slice_us = int(slice_seconds) * 1_000_000
    # 1. nodes: see ttl_nodes
    # 2. nxt(e) = first node at or after e + ttl. Probes are matched inside their time
    #    slice by a running min over descending time (nodes sort before probes at ties)...
    node_rows = nodes.select("k", F.col("us").alias("at"), F.col("us").alias("node_us"),
                             F.lit(None).cast("long").alias("probe_us"))
    probe_rows = nodes.select("k", (F.col("us") + F.lit(ttl_us)).alias("at"),
                              F.lit(None).cast("long").alias("node_us"), F.col("us").alias("probe_us"))
    both = node_rows.unionByName(probe_rows).withColumn("slice", F.floor(F.col("at") / F.lit(slice_us)))
    w_desc = (Window.partitionBy("k", "slice")
              .orderBy(F.col("at").desc(), F.col("node_us").asc_nulls_last())
              .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    in_slice = (both.withColumn("hit", F.min("node_us").over(w_desc))
                .filter(F.col("probe_us").isNotNull())
                .select("k", "slice", "probe_us", "hit"))
    # ... and a miss takes the first node of the next non-empty slice (one row per slice).
    per_slice = (nodes.groupBy("k", F.floor(F.col("us") / F.lit(slice_us)).alias("slice"))
                 .agg(F.min("us").alias("first_us")).withColumn("is_node", F.lit(1)))
    miss = (in_slice.filter(F.col("hit").isNull()).select("k", "slice").distinct()
            .withColumn("first_us", F.lit(None).cast("long")).withColumn("is_node", F.lit(0)))
    w_later = (Window.partitionBy("k").orderBy(F.col("slice").desc(), F.col("is_node").asc())
               .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    later = (per_slice.unionByName(miss).withColumn("later_us", F.min("first_us").over(w_later))
             .filter("is_node = 0").select("k", "slice", "later_us"))
    jump = (in_slice.join(later, ["k", "slice"], "left")
            .select("k", F.col("probe_us").alias("src"), F.coalesce("hit", "later_us").alias("dst"))
            .filter(F.col("dst").isNotNull()))
    # 3. the chain from each key's first node, by pointer doubling. J(0) = nxt and
    #    J(r+1) = J(r)∘J(r) are written once each (a self-join per level); after round r
    #    (0-based) the reached set holds every chain node fewer than 2^(r+1) steps away.
    #    Chain nodes at different distances are different rows, so no distinct is needed.
    span = nodes.agg(F.min("us").alias("a"), F.max("us").alias("b")).first()
    rounds = 1 if span["a"] is None else _chain_rounds((span["b"] - span["a"]) / 1e6, ttl_us / 1e6)
    if checkpoint:
        jump = materialize(jump, "ttl-jump")
    reached = nodes.groupBy("k").agg(F.min("us").alias("src"))
    for r in range(rounds):
        step = reached.join(jump, ["k", "src"]).select("k", F.col("dst").alias("src"))
        reached = reached.unionByName(step)
        if checkpoint:        # each round reads `reached` twice: write it, or its lineage doubles
            reached = materialize(reached, "ttl-reached")
        if r < rounds - 1:
            jump = (jump.alias("a").join(jump.alias("b"),
                                         (F.col("a.k") == F.col("b.k")) & (F.col("a.dst") == F.col("b.src")))
                    .select(F.col("a.k"), F.col("a.src"), F.col("b.dst")))
            if checkpoint:
                jump = materialize(jump, "ttl-jump")
    return nodes.join(reached.withColumnRenamed("src", "us"), ["k", "us"], "left_semi")
