"""Connected components and blocked pair comparison as Spark jobs.

Both keep every group distributed: a component is never gathered, and a large group of
candidates is compared block by block, each block of bounded size.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, functions as F

from gazette.session import materialize


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, label) for every node of an edge (self-loops and null ends are ignored);
    label is the smallest node of the component.

    Each round hooks every node to its smallest neighbour, follows the hooks to their
    ends by pointer doubling, and contracts the edges. A round at least halves the nodes
    of every component that still has an edge, and each step is written to the shared
    checkpoint folder, so lineage stays short.
    """
    e = (edges.select(F.col(a).alias("a"), F.col(b).alias("b")).filter("a <> b")
         .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
    e = materialize(e, "cc-edges")
    labels = None
    while True:
        if e.isEmpty():
            break
        both = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        up = both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("m")).select("node", F.least("node", "m").alias("up"))
        up = materialize(up, "cc-up")
        while True:
            nxt = (up.alias("p").join(up.alias("q"), F.col("p.up") == F.col("q.node"))
                   .select("p.node", F.col("q.up").alias("up"), (F.col("q.up") != F.col("p.up")).alias("moved")))
            nxt = materialize(nxt, "cc-up")
            moved = not nxt.filter("moved").isEmpty()
            up = nxt.select("node", "up")
            if not moved:
                break
        if labels is None:
            labels = up.select("node", F.col("up").alias("label"))
        else:
            labels = (labels.join(up.select(F.col("node").alias("label"), "up"), "label", "left")
                      .select("node", F.coalesce("up", "label").alias("label")))
        labels = materialize(labels, "cc-labels")
        pa, pb = up.select(F.col("node").alias("a"), F.col("up").alias("ua")), up.select(F.col("node").alias("b"), F.col("up").alias("ub"))
        e = e.join(pa, "a").join(pb, "b").filter("ua <> ub").select(F.least("ua", "ub").alias("a"), F.greatest("ua", "ub").alias("b")).distinct()
        e = materialize(e, "cc-edges")
    if labels is None:
        labels = e.select(F.col("a").alias("node"), F.col("b").alias("label"))
    return labels


def in_blocks(members: DataFrame, key: list[str], node: str, max_block: int) -> DataFrame:
    """Deals the rows of each group (by `key`) into pairs of blocks: adds `blk` (the row's
    own block), and `bi` <= `bj`, the pair it is sent to. Groups up to `max_block` rows
    are one block. Every two rows of a group meet in exactly one pair: two rows of
    different blocks in (bi, bj), two of one block in (b, b)."""
    sizes = members.groupBy(*key).agg(F.count("*").alias("_n"))
    n_blocks = F.ceil(F.col("_n") / F.lit(max_block)).cast("int")
    dealt = (members.join(sizes, key).withColumn("_nb", n_blocks)
             .withColumn("blk", F.pmod(F.xxhash64(F.col(node)), F.col("_nb")).cast("int")))
    return (dealt.withColumn("_k", F.explode(F.sequence(F.lit(0), F.col("_nb") - 1)))
            .withColumn("bi", F.least("blk", "_k")).withColumn("bj", F.greatest("blk", "_k"))
            .drop("_k", "_n", "_nb").repartition(*key, "bi", "bj"))       # else one task had all blocks of a group


def block_links(linked: np.ndarray, left: np.ndarray, right: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of one pair of blocks: rows `left` against rows `right` (the same array for a block
    with itself) with the boolean matrix `linked`. Returns for all rows (by position in
    the block pair) the summed weight of their links and the position of a root row such
    that rows of one component of these links share a root."""
    n = len(weight)
    if left is right:
        np.fill_diagonal(linked, False)
        degree = linked @ weight
    else:
        degree = np.zeros(n, np.int64)
        degree[left] = linked @ weight[right]
        degree[right] = linked.T @ weight[left]
    root = np.arange(n)
    li, ri = np.nonzero(linked)
    li, ri = left[li], right[ri]
    while len(li):
        new = root.copy()
        np.minimum.at(new, root[li], root[ri])
        np.minimum.at(new, root[ri], root[li])
        while (new[new] != new).any():
            new = new[new]
        root = new[root]
        apart = root[li] != root[ri]
        if not apart.any():
            break
        li, ri = li[apart], ri[apart]
    return degree, root
