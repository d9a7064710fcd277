"""N-gram Jaccard join: MinHash banding, verified on full n-gram sets.

1. Every document becomes its set of word shingles (five words), a fingerprint of the
   set and one hash per MinHash band. Documents with equal sets form a class.
2. Band hashes are shuffled; classes that share one are candidates. Candidates are joined
   into candidate groups along a star per band hash, so the rows stay linear in the input.
3. Inside each candidate group all pairs of classes are compared on their full shingle
   sets, in blocks of bounded size (a large group is spread over many tasks). Only link
   counts and one root per row and block leave the task, never the pairs.

The band count is the smallest that finds a pair at the threshold with the target recall.
"""

from __future__ import annotations

import hashlib
import math
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from gazette.llm.components import block_links, connected_components, in_blocks
from gazette.llm.words import WordHashes, mix, shingles, words
from gazette.session import materialize

WIDTH = 5
THRESHOLD = 0.8
TARGET_RECALL = 0.999
MAX_HASHES = 128
MAX_BLOCK = 2048
_COLUMNS = 4096


def bands_and_rows(threshold: float = THRESHOLD, recall: float = TARGET_RECALL, max_hashes: int = MAX_HASHES) -> tuple[int, int]:
    """(bands, rows): the most rows per band (fewest false candidates) for which enough
    bands to reach the recall at the threshold stay within max_hashes."""
    best = None
    for rows in range(1, 33):
        bands = max(1, math.ceil(math.log(1 - recall) / math.log(1 - threshold ** rows)))
        if bands * rows <= max_hashes:
            best = (bands, rows)
    if best is None:
        raise ValueError("max_hashes is too small for this recall")
    return best


def _band_hashes(sets: list[np.ndarray], bands: int, rows: int, chunk: int = 16_384) -> np.ndarray:
    """(len(sets), bands) band hashes of non-empty sets."""
    rng = np.random.default_rng(20_240_604)
    mult = rng.integers(1, 2 ** 63, bands * rows, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    add = rng.integers(0, 2 ** 63, bands * rows, dtype=np.uint64)
    out = np.empty((len(sets), bands), np.uint64)
    i = 0
    while i < len(sets):
        j, n = i, 0
        while j < len(sets) and (j == i or n + len(sets[j]) <= chunk):
            n += len(sets[j])
            j += 1
        flat = np.concatenate(sets[i:j])
        starts = np.cumsum([0] + [len(s) for s in sets[i:j - 1]])
        for b in range(bands):
            acc = np.full(j - i, b + 1, np.uint64)
            for r in range(b * rows, b * rows + rows):
                acc = mix(acc ^ np.minimum.reduceat(flat * mult[r] + add[r], starts))
            out[i:j, b] = acc
        i = j
    return out


def _signatures(docs: DataFrame, id_col: str, text: str, width: int, bands: int, rows: int) -> DataFrame:
    """(id, fp, n, bands): fingerprint, size and band hashes of each shingle set; fp null
    and no bands for documents without words."""
    id_type = docs.schema[id_col].dataType.simpleString()

    def run(batches):
        hashes = WordHashes()
        for batch in batches:
            for k in range(0, batch.num_rows, 256):
                part = batch.slice(k, 256)
                sets = [shingles(hashes.of(words(t)), width) for t in part.column(1).to_pylist()]
                full = [i for i, s in enumerate(sets) if len(s)]
                made: list = [None] * len(sets)
                if full:
                    for i, row in zip(full, _band_hashes([sets[i] for i in full], bands, rows).view(np.int64).tolist()):
                        made[i] = row
                fp = [hashlib.blake2b(s.tobytes(), digest_size=16).hexdigest() if len(s) else None for s in sets]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(fp, pa.string()), pa.array([len(s) for s in sets], pa.int64()), pa.array(made, pa.list_(pa.int64()))], names=["id", "fp", "n", "bands"])

    return docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text}`").alias("text")).mapInArrow(run, f"id {id_type}, fp string, n bigint, bands array<bigint>")


def _linked(sets_a: list[np.ndarray], sets_b: list[np.ndarray] | None, threshold: Fraction) -> np.ndarray:
    """Which of the sets have a Jaccard similarity of at least the threshold, exactly.
    sets_b None: sets_a against itself."""
    both = sets_a if sets_b is None else sets_a + sets_b
    flat = np.concatenate(both)
    owner = np.repeat(np.arange(len(both)), [len(s) for s in both])
    order = np.argsort(flat, kind="stable")
    flat, owner = flat[order], owner[order]
    new = np.concatenate([[True], flat[1:] != flat[:-1]])
    column = np.cumsum(new) - 1
    shared = np.bincount(column)[column] > 1          # a shingle of one set only is in no intersection
    column, owner = column[shared], owner[shared]
    _, column = np.unique(column, return_inverse=True)
    n, na = len(both), len(sets_a)
    inter = np.zeros((na, n if sets_b is None else n - na), np.float32)
    cuts = np.searchsorted(column, np.arange(0, (column[-1] + 1 if len(column) else 0) + _COLUMNS, _COLUMNS))
    for k in range(len(cuts) - 1):
        lo, hi = cuts[k], cuts[k + 1]
        x = np.zeros((n, min(_COLUMNS, column[hi - 1] + 1 - k * _COLUMNS)), np.float32)
        x[owner[lo:hi], column[lo:hi] - k * _COLUMNS] = 1
        inter += x[:na] @ (x if sets_b is None else x[na:]).T
    sizes = np.array([len(s) for s in both], np.int64)
    total = sizes[:na, None] + (sizes if sets_b is None else sizes[na:])[None, :]
    return inter.astype(np.int64) * (threshold.numerator + threshold.denominator) >= threshold.numerator * total


def jaccard_links(docs: DataFrame, id_col: str = "doc_id", text: str = "text", width: int = WIDTH,
                  threshold: float = THRESHOLD, recall: float = TARGET_RECALL, max_block: int = MAX_BLOCK) -> DataFrame:
    """One row per document: (id, class_id, n_links, component_id, kept, fp).

    class_id: smallest id of the documents with the same shingle set. n_links: other
    documents with a similarity of at least the threshold, copies included. component_id:
    smallest id reachable by links. kept: this is the component's first row.

    Documents without words (null, empty or white space) link with nothing and are their
    own class and component. A text of 1 to width-1 words is one shingle. Rows that repeat
    an id with the same set are further documents of the class, with equal results; rows
    that repeat an id with another set are documents of their own. A null id comes after
    all others. An empty table gives no rows.
    """
    bands, rows = bands_and_rows(threshold, recall)
    exact = Fraction(str(threshold))
    sig = materialize(_signatures(docs, id_col, text, width, bands, rows), "jaccard-signatures")
    full = sig.filter("fp IS NOT NULL")
    # One row per distinct set, from here on named by its fingerprint.
    classes = materialize(full.groupBy("fp").agg(F.min("id").alias("class_id"), F.count("*").alias("size"),
                                                 F.first("bands").alias("bands"), F.first("n").alias("n")), "jaccard-classes")
    keyed = classes.select("fp", F.explode("bands").alias("band"))
    met = keyed.groupBy("band").agg(F.min("fp").alias("star"), F.count("*").alias("c")).filter("c > 1")
    edges = keyed.join(met, "band").filter("fp <> star").select(F.col("star").alias("a"), F.col("fp").alias("b"))
    candidates = connected_components(edges)
    # Full sets are made again from the texts of the candidates alone, one text a class.
    names = classes.join(candidates.withColumnRenamed("node", "fp"), "fp").select(F.col("fp").alias("_fp"), F.col("class_id").alias("_id"), "size", "label")
    id_type = docs.schema[id_col].dataType.simpleString()
    texts = docs.select(F.col(f"`{id_col}`").alias("class_id"), F.col(f"`{text}`").alias("text"))
    texts = texts.join(names.select("_id").distinct(), F.col("class_id").eqNullSafe(F.col("_id")), "left_semi")

    def pick(batches):
        """Fingerprints again: a repeated id can have several texts."""
        hashes = WordHashes()
        for batch in batches:
            for k in range(0, batch.num_rows, 256):
                part = batch.slice(k, 256)
                sets = [shingles(hashes.of(words(t)), width) for t in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array([hashlib.blake2b(s.tobytes(), digest_size=16).hexdigest() for s in sets], pa.string()), pa.array([s.tobytes() for s in sets], pa.binary())], names=["class_id", "fp", "shingles"])

    found = texts.mapInArrow(pick, f"class_id {id_type}, fp string, shingles binary")
    members = found.join(names, (F.col("fp") == F.col("_fp")) & F.col("class_id").eqNullSafe(F.col("_id")))
    members = materialize(members.select("fp", "size", "label", "shingles").dropDuplicates(["fp"]), "jaccard-members")

    made = pa.schema([("fp", pa.string()), ("links", pa.int64()), ("root", pa.string())])

    def compare(group: pa.Table) -> pa.Table:
        i, j = group.column("bi")[0].as_py(), group.column("bj")[0].as_py()
        sets = [np.frombuffer(b, np.uint64) for b in group.column("shingles").to_pylist()]
        if i == j:
            left = right = np.arange(len(sets))
            linked = _linked(sets, None, exact)
        else:
            own = group.column("blk").to_numpy()
            left, right = np.flatnonzero(own == i), np.flatnonzero(own == j)
            if not len(left) or not len(right):
                return made.empty_table()
            linked = _linked([sets[k] for k in left], [sets[k] for k in right], exact)
        links, root = block_links(linked, left, right, group.column("size").to_numpy())
        fp = group.column("fp")
        return pa.table([fp, pa.array(links, pa.int64()), fp.take(pa.array(root))], schema=made)

    dealt = in_blocks(members, ["label"], "fp", max_block)
    verified = dealt.groupBy("label", "bi", "bj").applyInArrow(compare, "fp string, links bigint, root string")
    verified = materialize(verified, "jaccard-verified")
    links = verified.groupBy("fp").agg(F.sum("links").alias("links"))
    comps = connected_components(verified.select(F.col("fp").alias("a"), F.col("root").alias("b")))
    named = (classes.select("fp", "class_id", "size").join(links, "fp", "left")
             .join(comps.select(F.col("node").alias("fp"), "label"), "fp", "left").withColumn("label", F.coalesce("label", "fp")))
    named = materialize(named, "jaccard-classes")
    first = named.groupBy("label").agg(F.min(F.struct(F.col("class_id").isNull(), "class_id", "fp")).alias("first"))
    named = named.join(first, "label").select("fp", "class_id", (F.col("size") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
                                              F.col("first.class_id").alias("component_id"), F.col("first.fp").alias("first_fp"))
    out = sig.select("id", "fp").join(named, "fp", "left")
    alone = F.col("fp").isNull()
    return out.select(
        F.col("id").alias(id_col), F.when(alone, F.col("id")).otherwise(F.col("class_id")).alias("class_id"),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.when(alone, F.col("id")).otherwise(F.col("component_id")).alias("component_id"),
        F.when(alone, F.lit(True)).otherwise(F.col("fp").eqNullSafe(F.col("first_fp")) & F.col("id").eqNullSafe(F.col("component_id"))).alias("kept"), "fp")


def keep_one_of_each_group(docs: DataFrame, id_col: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """The rows of `docs` that stay when one document of each group of near-duplicates is
    kept (its smallest id). Documents without words all stay. Rows that repeat one id and
    text stay once."""
    links = jaccard_links(docs, id_col, text, **options)
    gone = links.filter(~F.col("kept")).select(F.col(id_col).alias("_id"), "fp").distinct()
    gone = materialize(gone, "jaccard-dropped")
    # An id whose rows are all dropped needs no look at its text; one that repeats with a
    # kept row keeps the rows with the text of that row.
    kept_ids = links.filter("kept").select(F.col(id_col).alias("_id")).distinct()
    only = gone.select("_id").distinct().join(kept_ids.withColumnRenamed("_id", "_k"), F.col("_id").eqNullSafe(F.col("_k")), "left_anti")
    rest = docs.join(only, F.col(f"`{id_col}`").eqNullSafe(F.col("_id")), "left_anti")
    repeated = (links.groupBy(F.col(id_col).alias("_id")).agg(F.count("*").alias("c")).filter("c > 1").select("_id"))
    repeated = materialize(repeated, "jaccard-repeated")
    if repeated.isEmpty():
        return rest
    single = rest.join(repeated, F.col(f"`{id_col}`").eqNullSafe(F.col("_id")), "left_anti")
    several = rest.join(repeated, F.col(f"`{id_col}`").eqNullSafe(F.col("_id")), "left_semi")
    stay = links.filter("kept AND fp IS NOT NULL").select(F.col(id_col).alias("_id"), F.col("fp").alias("_fp")).distinct()
    id_type = docs.schema[id_col].dataType.simpleString()

    def fingerprint(batches):
        for batch in batches:
            fp = []
            for t in batch.column(1).to_pylist():
                s = shingles(WordHashes().of(words(t)), options.get("width", WIDTH))
                fp.append(hashlib.blake2b(s.tobytes(), digest_size=16).hexdigest() if len(s) else None)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(fp, pa.string())], names=["_i", "_t", "_f"])

    pairs = several.select(F.col(f"`{id_col}`").alias("_i"), F.col(f"`{text}`").alias("_t")).distinct()
    pairs = pairs.mapInArrow(fingerprint, f"_i {id_type}, _t string, _f string")
    wanted = pairs.join(stay, F.col("_i").eqNullSafe(F.col("_id")) & (F.col("_f") == F.col("_fp")), "left_semi").unionByName(pairs.filter("_f IS NULL"))
    wanted = wanted.groupBy("_i", "_f").agg(F.min("_t").alias("_t"))
    several = several.join(wanted.select("_i", "_t"), F.col(f"`{id_col}`").eqNullSafe(F.col("_i")) & F.col(f"`{text}`").eqNullSafe(F.col("_t")), "left_semi").dropDuplicates([id_col, text])
    return single.unionByName(several)
