"""Embedding near-dedup: cross-polytope hashing after fast Hadamard rotations.

1. Equal vectors form a class; one row per class goes on.
2. A hash table rotates a vector (three rounds of random signs and a fast Hadamard
   transform) and names the nearest vertex of the cross-polytope; a key takes one or more
   such hashes. A row is stored under its own key and also sent to the keys of its next
   best vertices (multiprobe).
3. Rows that meet under a key are compared exactly, in blocks of bounded size. A pair that
   meets in several tables counts in the first alone: the tasks make the keys of the
   earlier tables again from the vectors, so neither pairs nor key lists are shuffled.

The number of hashes a key takes grows with the number of vectors, the number of tables
follows from the measured chance of meeting at the threshold and the target recall.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from gazette.llm.components import block_links, connected_components, in_blocks
from gazette.session import materialize

THRESHOLD = 0.9
TARGET_RECALL = 0.998
PROBES = 2
ROWS_PER_KEY = 4096
MAX_BLOCK = 2048
_SEED = 20_240_604


def hadamard(x: np.ndarray) -> np.ndarray:
    """Walsh-Hadamard transform of each row (length a power of two), scaled to keep lengths."""
    n, d = x.shape
    h = 1
    while h < d:
        x = x.reshape(n, d // (2 * h), 2, h)
        x = np.stack([x[:, :, 0] + x[:, :, 1], x[:, :, 0] - x[:, :, 1]], axis=2)
        h *= 2
    return x.reshape(n, d) / np.sqrt(d)


def table_keys(x: np.ndarray, table: int, hashes: int, probes: int) -> np.ndarray:
    """(rows, 1 + probes) keys of unit vectors in one table: the own key, then those of
    the next best vertices. The probe that gives up least on any one hash comes first."""
    n, dim = x.shape
    d = max(2, 1 << (dim - 1).bit_length())
    best, loss, alternatives = np.zeros((n, hashes), np.int64), [], []
    for k in range(hashes):
        rng = np.random.default_rng([_SEED, dim, table, k])
        y = np.zeros((n, d))
        y[:, :dim] = x
        for _ in range(3):
            y = hadamard(y * rng.choice([-1.0, 1.0], d))
        both = np.concatenate([y, -y], axis=1)
        top = np.argpartition(-both, probes, axis=1)[:, :probes + 1]
        height = np.take_along_axis(both, top, 1)
        order = np.argsort(-height, axis=1, kind="stable")
        top, height = np.take_along_axis(top, order, 1), np.take_along_axis(height, order, 1)
        best[:, k] = top[:, 0]
        loss.append(height[:, :1] - height[:, 1:])
        alternatives.append(top[:, 1:])
    radix = (2 * d) ** np.arange(hashes, dtype=np.int64)
    own = best @ radix
    loss, alternatives = np.concatenate(loss, axis=1), np.concatenate(alternatives, axis=1)
    cheap = np.argsort(loss, axis=1, kind="stable")[:, :probes]
    which = cheap // probes
    changed = np.take_along_axis(alternatives, cheap, 1) - np.take_along_axis(best, which, 1)
    return np.concatenate([own[:, None], own[:, None] + changed * radix[which]], axis=1)


@lru_cache(maxsize=32)
def tables_needed(dim: int, hashes: int, probes: int, threshold: float, recall: float, pairs: int = 2000) -> int:
    """Tables for the target recall at the threshold, from the share of random pairs at
    exactly this cosine that meet, taken over as many tables as it takes."""
    rng = np.random.default_rng([_SEED, dim])
    a = rng.standard_normal((pairs, dim))
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    b = rng.standard_normal((pairs, dim))
    b -= (a * b).sum(1, keepdims=True) * a
    norm = np.linalg.norm(b, axis=1, keepdims=True)
    b = np.divide(b, norm, out=np.zeros_like(b), where=norm > 0)
    b = threshold * a + np.sqrt(max(0.0, 1 - threshold ** 2)) * b
    met = np.zeros(pairs, bool)
    for table in range(64):
        ka, kb = table_keys(a, table, hashes, probes), table_keys(b, table, hashes, probes)
        met |= (ka == kb[:, :1]).any(1) | (kb == ka[:, :1]).any(1)
        if met.mean() >= recall:
            return table + 1
    return 64


def _unit(x: np.ndarray) -> np.ndarray:
    big = np.abs(x).max(axis=1, keepdims=True)          # very large or small components do not overflow
    x = x / big
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def usable(vector: str) -> F.Column:
    """Not null, not empty, without null or non-finite components, not all zero."""
    c = F.col(vector)
    finite = F.forall(c, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) != F.lit(float("inf"))))
    return F.coalesce(c.isNotNull() & (F.size(c) > 0) & finite & F.exists(c, lambda v: v != 0), F.lit(False))


def embedding_links(vectors: DataFrame, id_col: str = "vec_id", vector: str = "embedding", threshold: float = THRESHOLD,
                    recall: float = TARGET_RECALL, probes: int = PROBES, rows_per_key: int = ROWS_PER_KEY,
                    max_block: int = MAX_BLOCK) -> DataFrame:
    """One row per vector: (id, n_links, component_id, kept).

    n_links: other rows whose cosine in double precision is at least the threshold (and
    that were found; no pair below it is ever linked). component_id: smallest id reachable
    by links, the row's own included. kept: id = component_id.

    Null, empty and zero vectors and those with null or non-finite components link with
    nothing, nor do vectors of different lengths. Rows that repeat an id are rows of their
    own. A null id comes after all others. An empty table gives no rows.
    """
    base = vectors.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{vector}`").cast("array<double>").alias("v"))
    good = base.filter(usable("v"))
    # -0.0 and 0.0 are one value, here and in the grouping
    good = good.withColumn("v", F.transform("v", lambda x: x + F.lit(0.0)))
    classes = materialize(good.groupBy("v").agg(F.min("id").alias("first"), F.count("*").alias("size"))
                          .withColumn("node", F.sha2(F.to_json("v"), 256)), "embed-classes")
    n, dims = classes.count(), [r[0] for r in classes.select(F.size("v").alias("d")).distinct().limit(64).collect()]
    plans = {}
    for d in dims:
        corners, hashes = 2 * max(2, 1 << (d - 1).bit_length()), 1
        while n / corners ** hashes > rows_per_key and corners ** (hashes + 1) < 2 ** 62:
            hashes += 1
        plans[d] = (hashes, tables_needed(d, hashes, min(probes, corners - 1), threshold, recall))

    def plan(d: int) -> tuple[int, int, int]:
        hashes, tables = plans.get(d) or (1, 16)
        return hashes, tables, min(probes, 2 * max(2, 1 << (d - 1).bit_length()) - 1)

    def deal(batches):
        for batch in batches:
            node, size, v = batch.column(0), batch.column(1), batch.column(2)
            length = np.asarray(v.value_lengths())
            for d in np.unique(length).tolist():
                at = np.flatnonzero(length == d)
                take = pa.array(at)
                part_node, part_size, part_v = node.take(take), size.take(take), v.take(take)
                hashes, tables, p = plan(d)
                x = _unit(part_v.flatten().to_numpy().reshape(-1, d))
                for t in range(tables):
                    keys = table_keys(x, t, hashes, p)
                    for c in range(p + 1):
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(np.full(len(at), d), pa.int32()), pa.array(np.full(len(at), t), pa.int32()), pa.array(keys[:, c], pa.int64()),
                             pa.array(np.full(len(at), c == 0)), part_node, part_size, part_v], names=["dim", "tbl", "bucket", "own", "node", "size", "v"])

    def compare(group: pa.Table) -> pa.Table:
        i, j, t, d = (group.column(c)[0].as_py() for c in ("bi", "bj", "tbl", "dim"))
        own, blk = group.column("own").to_numpy(), group.column("blk").to_numpy()
        left = right = np.arange(len(own))
        if i != j:
            left, right = np.flatnonzero(blk == i), np.flatnonzero(blk == j)
        if not len(left) or not len(right) or not own.any() or len(own) < 2:
            return made.empty_table()
        raw = group.column("v").combine_chunks().flatten().to_numpy().reshape(-1, d)
        x = _unit(raw)
        linked = (x[left] @ x[right].T) >= threshold - 1e-9
        linked &= own[left][:, None] | own[right][None, :]
        li, ri = np.nonzero(linked)
        if left is right:
            li, ri = li[li < ri], ri[li < ri]
        a, b = left[li], right[ri]
        # the exact test, pair by pair, on those within a hair of the threshold or above
        ok = np.zeros(len(a), bool)
        norms = np.linalg.norm(raw, axis=1)
        plain = bool(np.isfinite(norms).all() and (norms > 1e-150).all() and (norms < 1e150).all())
        for k in range(0, len(a), 65_536):
            u, w = a[k:k + 65_536], b[k:k + 65_536]
            ok[k:k + 65_536] = ((raw[u] * raw[w]).sum(1) / (norms[u] * norms[w]) if plain else (x[u] * x[w]).sum(1)) >= threshold
        a, b, li, ri = a[ok], b[ok], li[ok], ri[ok]
        if len(a):          # a pair counts where it meets first: the earliest table, there under the smaller row's own key
            hashes, _, p = plan(d)
            names = group.column("node").to_numpy()
            fresh = np.ones(len(a), bool)
            for s in range(t):
                keys = table_keys(x, s, hashes, p)
                fresh &= ~((keys[a] == keys[b][:, :1]).any(1) | (keys[b] == keys[a][:, :1]).any(1))
            keys = table_keys(x, t, hashes, p)
            at_a, at_b = (keys[b] == keys[a][:, :1]).any(1), (keys[a] == keys[b][:, :1]).any(1)
            both = at_a & at_b & (keys[a, 0] != keys[b, 0])
            fresh &= ~both | (own[a] == (names[a] < names[b]))
            a, b, li, ri = a[fresh], b[fresh], li[fresh], ri[fresh]
        if not len(a):
            return made.empty_table()
        linked = np.zeros(linked.shape, bool)
        linked[li, ri] = True
        if left is right:
            linked |= linked.T
        links, root = block_links(linked, left, right, group.column("size").to_numpy())
        hit = np.zeros(len(own), bool)
        hit[a] = hit[b] = True
        hit = np.flatnonzero(hit)
        node = group.column("node")
        return pa.table([node.take(pa.array(hit)), pa.array(links[hit], pa.int64()), node.take(pa.array(root[hit]))], schema=made)

    made = pa.schema([("node", pa.string()), ("links", pa.int64()), ("root", pa.string())])
    dealt = classes.select("node", "size", "v").mapInArrow(deal, "dim int, tbl int, bucket bigint, own boolean, node string, size bigint, v array<double>")
    # a key that holds one row has no pair
    dealt = in_blocks(dealt, ["dim", "tbl", "bucket"], "node", max_block)
    verified = dealt.groupBy("dim", "tbl", "bucket", "bi", "bj").applyInArrow(compare, "node string, links bigint, root string")
    verified = materialize(verified, "embed-verified")
    links = verified.groupBy("node").agg(F.sum("links").alias("links"))
    comps = connected_components(verified.select(F.col("node").alias("a"), F.col("root").alias("b")))
    named = (classes.select("v", "node", "first", "size").join(links, "node", "left")
             .join(comps, "node", "left").withColumn("label", F.coalesce("label", "node")))
    named = materialize(named, "embed-classes")
    smallest = named.groupBy("label").agg(F.min("first").alias("component_id"))
    named = named.join(smallest, "label").select("node", (F.col("size") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), "component_id")
    norm = F.when(usable("v"), F.sha2(F.to_json(F.transform("v", lambda x: x + F.lit(0.0))), 256))
    out = base.select("id", norm.alias("node")).join(named, "node", "left")
    comp = F.when(F.col("node").isNull(), F.col("id")).otherwise(F.col("component_id"))
    return out.select(F.col("id").alias(id_col), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
                      comp.cast("long").alias("component_id"), F.col("id").eqNullSafe(comp).alias("kept"))
