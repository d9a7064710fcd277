"""Canonical order (O1), per-source and per-edition caps (W2, O2, O3), union of kinds."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from gazette import config as C

# Explicit list order: web before feeds, then configuration order, then item position.
ORDER_COLS = ("kind_rank", "source_pos", "source_name", "item_pos")
EDITION = ("niche", "run_date")


def order_spec(extra: tuple = ()):
    return [F.col(c).asc_nulls_first() for c in ORDER_COLS + tuple(extra)]


def rank_within(df: DataFrame, keys, name: str = "rn", order=None) -> DataFrame:
    """1-based position inside each group in canonical order (a partitioned window)."""
    w = Window.partitionBy(*keys).orderBy(*(order or order_spec()))
    return df.withColumn(name, F.row_number().over(w))


def cap_per_group(df: DataFrame, keys, cap, name: str = "rn", order=None) -> DataFrame:
    """First `cap` rows per group. `row_number() <= cap` plans as WindowGroupLimit, which
    also limits each map partition before the shuffle, so a hot group stays small.
    cap None = no cap (rows are still numbered); cap 0 = nothing."""
    ranked = rank_within(df, keys, name, order)
    if cap is None:
        return ranked
    return ranked.filter(F.col(name) <= F.lit(int(cap)))


#: Caps up to this are taken by a window that each task limits first; a task then holds at
#: most so many rows of a source from each task before it.
WINDOW_CAP = 10_000


def cap_per_source(df: DataFrame, cap_col: str = "max_articles", name: str = "item_rank",
                   largest_cap: int | None = None) -> DataFrame:
    """First max_articles items per source (before any validity filter); a null cap is
    the kind's default. Caps up to WINDOW_CAP go through a window limited before the shuffle.
    Sources with a larger cap are numbered over sorted ranges, so no task holds a whole
    source; largest_cap, if the caller knows the largest cap of the configuration, saves
    looking for such sources."""
    default = F.when(F.col("kind_rank") == 0, C.DEFAULT_WEB_MAX_ARTICLES).otherwise(C.DEFAULT_RSS_MAX_ARTICLES)
    cap = F.coalesce(F.col(cap_col), default)
    source = ("kind_rank", "source_name")
    bound = None if largest_cap is None else max(int(largest_cap), C.DEFAULT_WEB_MAX_ARTICLES, C.DEFAULT_RSS_MAX_ARTICLES)
    known = bound is not None and bound <= WINDOW_CAP
    within = bound if known else WINDOW_CAP
    ranked = cap_per_group(df if known else df.filter(cap <= within), source, within, name, [F.col("item_pos").asc_nulls_first()])
    ranked = ranked.filter(F.col(name) <= cap)
    if known:
        return ranked
    large = number_by_range(df.filter(cap > WINDOW_CAP), source, ("item_pos",), name)
    return ranked.unionByName(large.withColumn(name, F.col(name).cast("int")).filter(F.col(name) <= cap))


def run_cap(df: DataFrame, cap: int | None, name: str = "rn") -> DataFrame:
    """O2: first max_articles_per_run articles of each edition, numbered (rn). cap None =
    every article, not numbered: numbering a whole edition would put it in one task."""
    if cap is None:
        return df
    if cap <= 0:
        return rank_within(df, EDITION, name).limit(0)
    return cap_per_group(df, EDITION, cap, name)


def number_by_range(df: DataFrame, groups, order, name: str = "rn") -> DataFrame:
    """Every row with its 1-based position in its group by the columns `order`, without a task that
    holds a group: rows are dealt by sorted ranges of (group, order) and written, each with
    its place in its range; a group's positions in a range start after its rows in the
    ranges before. One shuffle of the rows; the counts have one row per (group, range), and few of
    them (checked) meet the rows by a broadcast. Null
    groups and null order columns sort first; rows equal in all of them take any order."""
    from gazette.session import materialize
    from gazette.sources.config_dim import MAX_BROADCAST_ROWS
    keys = [F.col(c).asc_nulls_first() for c in (*groups, *order)]
    ranged = (df.repartitionByRange(*keys).sortWithinPartitions(*keys)
              .withColumn("_range", F.spark_partition_id())
              .withColumn("_at", F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)))   # place in the range
    ranged = materialize(ranged, "ranges")
    counts = ranged.groupBy(*groups, "_range").agg(F.count("*").alias("_n"), F.min("_at").alias("_first"))
    before = Window.partitionBy(*groups).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(*[F.col(c).alias(f"_{c}") for c in groups], F.col("_range").alias("_r"), "_first",
                           F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    starts = materialize(starts, "range-starts")
    if starts.count() <= MAX_BROADCAST_ROWS:
        starts = F.broadcast(starts)
    on = [F.col("_range") == F.col("_r"), *[F.col(c).eqNullSafe(F.col(f"_{c}")) for c in groups]]
    return ranged.join(starts, on).select(*df.columns, (F.col("_before") + F.col("_at") - F.col("_first") + 1).alias(name))


def number_editions(df: DataFrame, name: str = "rn", extra: tuple = ("article_id",)) -> DataFrame:
    """Every article's position in its edition, in canonical order and then by `extra`, for
    editions of any size."""
    return number_by_range(df, EDITION, (*ORDER_COLS, *extra), name)


def first_k(df: DataFrame, k: int, name: str = "rn") -> DataFrame:
    """The first k rows of each edition: a filter when rows are numbered, else a
    top-k per edition (WindowGroupLimit, limited per map task before the shuffle)."""
    if name in df.columns:
        return df.filter(F.col(name) <= F.lit(int(k)))
    return cap_per_group(df, EDITION, k, name)


def order_key(*extra) -> Column:
    """Canonical order as one comparable struct (null fields sort first)."""
    return F.struct(*[F.col(c) for c in ORDER_COLS], *extra)


def union_kinds(*frames: DataFrame) -> DataFrame:
    """UNION ALL of web and feed articles; order columns travel with the rows."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
