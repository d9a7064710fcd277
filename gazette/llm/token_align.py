"""Cross-tokenizer alignment: which tokens of two tokenizers cover the same bytes.

A (byte-level BPE) and B (pieces with byte fall-back) encode the same bytes, so both give a
rising list of byte offsets where their tokens end. The two lists of all texts of a chunk,
laid end to end, are merged:

1. Diagonals of the merge, `PIECE` steps apart, are found by binary searches, all at once.
   Between two diagonals lies a piece of the merge; pieces have equal work wherever texts
   begin or end, so one long text is cut like many short ones.
2. Each piece merges its own two slices and emits its overlaps: every end that differs from
   the one before it closes a stretch of bytes covered by one A and one B token (a link).
3. An end of A that is also an end of B closes a group. Groups cross borders of pieces;
   numbering the closed groups over all pieces stitches them.

Documents become counts, the groups as text, and their distinct links with multiplicities,
as places in the chunk's dictionary of id pairs. Only dictionaries go through the corpus-wide
count (one row for each pair and chunk, so no pair is hot) and come back to their chunks.
"""

from __future__ import annotations

import hashlib
import re
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F, types as T

from gazette.llm.bpe_prefix import byte_alphabet, vocabulary_bytes
from gazette.session import materialize

DEFAULT_PIECES = "piece_bpe_32k.model"
#: Steps of the merge in a piece.
PIECE = 1 << 16
#: Bytes of text in a chunk, but for a longer single text.
CHUNK = 2 << 20
#: Units and token ids that a worker remembers.
UNITS, POOL = 200_000, 4_000_000

#: A unit: white space and what follows up to the next blank, tab or line feed. Neither
#: tokenizer has tokens across its border. White space of other kinds never parts units.
UNIT = re.compile(r"\s*\S+(?:[^\S \t\n]\s*\S*)*|\s+")


class _Units(dict):
    """unit -> number; new ones are listed in `fresh`."""

    def __init__(self):
        super().__init__()
        self.fresh: list[str] = []

    def __missing__(self, unit: str) -> int:
        n = self[unit] = len(self)
        self.fresh.append(unit)
        return n


class _Pool:
    """Token ids of all units, one after the other."""

    def __init__(self):
        self.ids, self.used = np.empty(1 << 16, np.int32), 0
        self.start, self.size = np.empty(0, np.int64), np.empty(0, np.int64)

    def add(self, lists: list) -> None:
        sizes = np.fromiter(map(len, lists), np.int64, len(lists))
        total = int(sizes.sum())
        while self.used + total > len(self.ids):
            self.ids = np.concatenate([self.ids, np.empty_like(self.ids)])
        at = self.used
        for x in lists:
            self.ids[at:at + len(x)] = x
            at += len(x)
        self.start = np.concatenate([self.start, self.used + np.cumsum(sizes) - sizes])
        self.size = np.concatenate([self.size, sizes])
        self.used = at

    def of(self, units: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of these units in order, and how many each has."""
        n = self.size[units]
        before = np.cumsum(n) - n
        return self.ids[np.repeat(self.start[units] - before, n) + np.arange(int(n.sum()))], n


class TwoTokenizers:
    """Ids of units by both tokenizers, and the bytes of their tokens."""

    def __init__(self, a_file: bytes, b_file: bytes):
        import sentencepiece
        from tokenizers import Tokenizer
        self.a = Tokenizer.from_str(a_file.decode("utf-8"))
        self.a.encode_special_tokens = True
        self.a.no_truncation()
        self.a.no_padding()
        byte_of = byte_alphabet()
        vocabulary = self.a.get_vocab(with_added_tokens=False)
        self.a_bytes = [b""] * (max(vocabulary.values()) + 1)
        for t, i in vocabulary.items():
            self.a_bytes[i] = bytes(byte_of.get(c, 0) for c in t)
        self.b = sentencepiece.SentencePieceProcessor()
        self.b.LoadFromSerializedProto(b_file)
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.blank = self.b.piece_to_id("▁")
        if any(re.search(r"[^\s▁][▁ \t\n]|▁[\t\n]", p) for p in pieces):
            raise ValueError("a vocabulary with pieces across word borders is not supported")
        self.b_bytes = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode("utf-8")
                        for i, p in enumerate(pieces)]
        self.a_size, self.b_size = (np.fromiter(map(len, x), np.int64, len(x)) for x in (self.a_bytes, self.b_bytes))
        self.clear()

    def clear(self) -> None:
        self.units, self.a_pool, self.b_pool, self.whole = _Units(), _Pool(), _Pool(), np.empty(0, bool)

    def _b_ids(self, units: list[str]) -> list[list[int]]:
        # B puts a blank before every input: the unit's own first blank, or one to take off
        out = self.b.encode([u[1:] if u[0] == " " else u for u in units], num_threads=1)
        for k, u in enumerate(units):
            if u == " ":
                out[k] = [self.blank]
            elif u[0] != " ":
                out[k] = out[k][1:] if out[k][:1] == [self.blank] else []
        return out

    def learn(self) -> None:
        """Encodes the units met for the first time."""
        fresh, self.units.fresh = self.units.fresh, []
        if not fresh:
            return
        a = [e.ids for e in self.a.encode_batch_fast(fresh, add_special_tokens=False)]
        b = self._b_ids(fresh)
        join_a, join_b = self.a_bytes.__getitem__, self.b_bytes.__getitem__
        whole = np.empty(len(fresh), bool)
        for k, u in enumerate(fresh):
            raw = u.encode("utf-8")
            whole[k] = b"".join(map(join_a, a[k])) == raw and b"".join(map(join_b, b[k])) == raw
        self.whole = np.concatenate([self.whole, whole])
        self.a_pool.add(a)
        self.b_pool.add(b)


@lru_cache(maxsize=2)
def _tokenizers(a_file: bytes, b_file: bytes) -> TwoTokenizers:
    return TwoTokenizers(a_file, b_file)


def merge_path(a: np.ndarray, b: np.ndarray, diagonals: np.ndarray) -> np.ndarray:
    """For each diagonal d, how many of the first d elements of the merge of the rising
    arrays a and b come from a (equal ones: a first). Binary searches on all at once."""
    low, high = np.maximum(diagonals - len(b), 0), np.minimum(diagonals, len(a))
    while (open_ := low < high).any():
        mid = (low + high) // 2
        # a[mid] is among the first d elements if it is not above b[d - mid - 1]
        i, j = np.minimum(mid, len(a) - 1), np.clip(diagonals - mid - 1, 0, max(len(b) - 1, 0))
        taken = a[i] <= b[j]
        low, high = np.where(open_ & taken, mid + 1, low), np.where(open_ & ~taken, mid, high)
    return low


def piece_overlaps(a: np.ndarray, b: np.ndarray, i0: int, i1: int, j0: int, j1: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of the piece of the merge that takes a[i0:i1] and b[j0:j1]: places (i, j) of the A
    and B token of each link, and the places i of the ends of a that are ends of b."""
    own_a, own_b = a[i0:i1], b[j0:j1]
    n = len(own_a) + len(own_b)
    end = np.empty(n, np.int64)
    place_a = np.arange(len(own_a)) + np.searchsorted(own_b, own_a, "left")
    from_a = np.zeros(n, bool)
    from_a[place_a] = True
    end[place_a], end[~from_a] = own_a, own_b
    before = np.empty(n, np.int64)
    before[1:] = end[:-1]
    before[:1] = max(a[i0 - 1] if i0 else 0, b[j0 - 1] if j0 else 0)      # the border: one end of the piece before
    step = np.cumsum(from_a)
    i = i0 + step - from_a                                   # ends of a, of b, before this one
    j = j0 + np.arange(n) - step + from_a
    new = end > before
    # an end of b that equals the end before it, one of a, closes a group
    return i[new], j[new], i[~new & ~from_a] - 1


def align(a_ends: np.ndarray, b_ends: np.ndarray, piece: int = PIECE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Links (i, j) of the tokens that end at these rising offsets, and the last A token of
    each group, put together from independent pieces of the merge."""
    total = len(a_ends) + len(b_ends)
    diagonals = np.unique(np.append(np.arange(0, total, piece), total))
    at = merge_path(a_ends, b_ends, diagonals)
    parts = [piece_overlaps(a_ends, b_ends, *map(int, (at[k], at[k + 1], diagonals[k] - at[k], diagonals[k + 1] - at[k + 1])))
             for k in range(len(diagonals) - 1)]
    if not parts:
        return (np.empty(0, np.int64),) * 3
    return tuple(np.concatenate(x) for x in zip(*parts))


class _Texts:
    """Aligned texts of one chunk."""

    def __init__(self, two: TwoTokenizers, texts: list[str | None]):
        found = [UNIT.findall(" " + t) if t else [] for t in texts]
        n = len(texts)
        per_text = np.fromiter(map(len, found), np.int64, n)
        units = np.fromiter((u for f in found for u in map(two.units.__getitem__, f)), np.int64, int(per_text.sum()))
        two.learn()
        whose = np.repeat(np.arange(n), per_text)
        void = np.zeros(n, bool)
        void[whose[~two.whole[units]]] = True
        usable = ~void[whose]
        units, whose = units[usable], whose[usable]
        self.a, per_unit = two.a_pool.of(units)
        a_of = np.repeat(whose, per_unit)
        self.b, per_unit = two.b_pool.of(units)
        b_of = np.repeat(whose, per_unit)
        a_ends, b_ends = np.cumsum(two.a_size[self.a]), np.cumsum(two.b_size[self.b])
        self.i, self.j, closes = align(a_ends, b_ends)
        self.link_of = a_of[self.i]
        self.n_a, self.n_b = np.bincount(a_of, minlength=n), np.bincount(b_of, minlength=n)
        self.n_groups, self.n_links = np.bincount(a_of[closes], minlength=n), np.bincount(self.link_of, minlength=n)
        self._order(a_ends, b_ends, closes)

    def _order(self, a_ends, b_ends, closes) -> None:
        """Ids in the order of the groups' text: code 4 * id + separator before it."""
        ends = a_ends[closes]
        ga, gb = np.searchsorted(ends, a_ends, "left"), np.searchsorted(ends, b_ends, "left")
        a_to, b_to = closes + 1, np.searchsorted(b_ends, ends, "right")       # tokens up to each group's end
        first_a, first_b = np.ones(len(ga), bool), np.ones(len(gb), bool)
        first_a[1:], first_b[1:] = ga[1:] != ga[:-1], gb[1:] != gb[:-1]
        self.codes = np.empty(len(ga) + len(gb), np.int64)
        self.codes[np.arange(len(ga)) + np.append(0, b_to)[ga]] = 4 * self.a + first_a
        self.codes[np.arange(len(gb)) + a_to[gb]] = 4 * self.b + 2 * first_b

    def groups(self, strings: list[str]):
        """The groups of each text: `a1,a2|b1;a3|b2,b3`; empty without tokens."""
        at = 0
        for n in (self.n_a + self.n_b).tolist():
            yield "".join(map(strings.__getitem__, self.codes[at:at + n].tolist()))[1:]
            at += n


@lru_cache(maxsize=2)
def _strings(n: int) -> list[str]:
    """Text of code 4 * id + separator: 0 `,`, 1 `;` (a group begins), 2 `|` (its B part)."""
    return [s + str(i) for i in range(n) for s in (",", ";", "|", "")]


def _chunks(batches, text_at: int, most: int):
    """Rows of the Arrow batches in runs of `most` bytes of text, or one longer text."""
    held, size = [], 0
    for batch in batches:
        lengths = pc.fill_null(pc.binary_length(batch.column(text_at)), 0).to_numpy(zero_copy_only=False)
        start = 0
        for k, n in enumerate(lengths.tolist()):
            if size and size + n > most:
                if k > start:
                    held.append(batch.slice(start, k - start))
                yield pa.Table.from_batches(held)
                held, size, start = [], 0, k
            size += n
        if batch.num_rows > start:
            held.append(batch.slice(start))
        if len(held) > 256:
            held = pa.Table.from_batches(held).combine_chunks().to_batches()
    if held:
        yield pa.Table.from_batches(held)


def align_documents(docs: DataFrame, text: str = "text", a_vocabulary: str | None = None, b_vocabulary: str | None = None,
                    groups: bool = True, chunk: int = CHUNK) -> DataFrame:
    """The columns of `docs` but the text, with n_a and n_b (tokens), n_groups, n_links, n_best
    (links whose id pair is in as many documents as any pair of its A id), count_sum (over
    links: documents that hold the pair linked) and `groups`, the ids as `a1,a2|b1;a3|b2,b3`;
    with groups=False only their hash, `groups_sha256`.

    Texts that are null or empty, or that B's bytes do not give back (U+2581 in the text),
    have zeros and no groups (''). Texts of any length are taken whole; a single one is the
    largest thing held in memory. Repeated rows are documents of their own and count each;
    ties of the highest count all count as best. Columns named like an output are replaced,
    all others pass; ids may be null. An empty table gives no rows.
    """
    spark = docs.sparkSession
    if b_vocabulary is None:
        import public_tokenizers
        b_vocabulary = public_tokenizers.path(DEFAULT_PIECES)
    files = spark.sparkContext.broadcast((vocabulary_bytes(a_vocabulary), vocabulary_bytes(b_vocabulary)))
    name = "groups" if groups else "groups_sha256"
    counts = ["n_a", "n_b", "n_groups", "n_links"]
    kept = [c for c in docs.columns if c not in (text, *counts, "n_best", "count_sum", name)]
    source = docs.select(F.struct(F.lit(0).alias("_"), *[F.col(f"`{c}`") for c in kept]).alias("row"), F.col(f"`{text}`").alias("text"))
    longs, row = T.ArrayType(T.LongType()), source.schema["row"].dataType
    schema = T.StructType([T.StructField("chunk", T.LongType()), T.StructField("row", row),
                           *[T.StructField(c, T.LongType()) for c in counts], T.StructField(name, T.StringType()),
                           T.StructField("places", T.ArrayType(T.IntegerType())), T.StructField("times", T.ArrayType(T.IntegerType())),
                           T.StructField("pairs", longs), T.StructField("held", longs)])

    def lists(values: np.ndarray, whose: np.ndarray, n: int) -> pa.Array:
        return pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(np.bincount(whose, minlength=n))), pa.int32()), pa.array(values))

    def run(batches):
        import os
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from pyspark import TaskContext
        two = _tokenizers(*files.value)
        strings = _strings(max(len(two.a_size), len(two.b_size)))
        kind = None
        for k, table in enumerate(_chunks(batches, 1, chunk)):
            n = table.num_rows
            number = TaskContext.get().partitionId() << 32 | k
            if len(two.units) > UNITS or two.a_pool.used + two.b_pool.used > POOL:
                two.clear()
            done = _Texts(two, table.column(1).to_pylist())
            pair = two_in_one(done)
            pairs, place = np.unique(pair, return_inverse=True)
            seen, times = np.unique(done.link_of * max(len(pairs), 1) + place, return_counts=True)
            whose, place = np.divmod(seen, max(len(pairs), 1))
            held = np.bincount(place, minlength=len(pairs))
            said = list(done.groups(strings))
            if not groups:
                said = [hashlib.sha256(s.encode()).hexdigest() if s else "" for s in said]
            rows = table.column(0).combine_chunks()
            kind = rows.type
            none = pa.nulls(n, pa.list_(pa.int64()))
            for b in pa.table([pa.array(np.full(n, number)), rows, *[pa.array(x.astype(np.int64)) for x in (done.n_a, done.n_b, done.n_groups, done.n_links)],
                               pa.array(said, pa.string()), lists(place.astype(np.int32), whose, n), lists(times.astype(np.int32), whose, n), none, none],
                              names=schema.names).to_batches(max_chunksize=512):
                yield b
            yield pa.RecordBatch.from_arrays(
                [pa.array([number]), pa.nulls(1, kind), *[pa.nulls(1, pa.int64())] * 4, pa.nulls(1, pa.string()), *[pa.nulls(1, pa.list_(pa.int32()))] * 2,
                 pa.array([pairs.astype(np.int64)], pa.list_(pa.int64())), pa.array([held.astype(np.int64)], pa.list_(pa.int64()))], names=schema.names)

    def two_in_one(done: _Texts) -> np.ndarray:
        return done.a[done.i].astype(np.int64) << 32 | done.b[done.j].astype(np.int64)

    stage = materialize(source.mapInArrow(run, schema), "align")
    held = stage.filter("row IS NULL").select("chunk", F.posexplode(F.arrays_zip("pairs", "held")).alias("place", "x"))
    held = held.select("chunk", "place", F.col("x.pairs").alias("pair"), F.col("x.held").alias("held"))
    counted = materialize(held.groupBy("pair").agg(F.sum("held").alias("count")), "align-counts")
    a_id = F.shiftright("pair", 32)
    most = counted.groupBy(a_id.alias("a_id")).agg(F.max("count").alias("most"))          # a row for each id of A at most
    counted = counted.join(F.broadcast(most), a_id == F.col("a_id")).select("pair", "count", (F.col("count") == F.col("most")).alias("best"))
    found = held.select("chunk", "place", "pair").join(counted, "pair").select(F.col("chunk").alias("of"), "place", "count", "best")

    out = T.StructType([stage.schema["row"], *[T.StructField(c, T.LongType()) for c in (*counts, "n_best", "count_sum")], T.StructField(name, T.StringType())])

    def sums(left: pa.Table, right: pa.Table) -> pa.Table:
        place = right.column("place").to_numpy()
        count, best = np.zeros(len(place) + 1, np.int64), np.zeros(len(place) + 1, np.int64)
        count[place], best[place] = right.column("count").to_numpy(), right.column("best").to_numpy()
        places, times = left.column("places").combine_chunks(), left.column("times").combine_chunks()
        to = np.append(0, np.cumsum(pc.list_value_length(places).to_numpy(zero_copy_only=False)))
        p, t = places.flatten().to_numpy(), times.flatten().to_numpy().astype(np.int64)
        total = lambda x: np.diff(np.append(0, np.cumsum(x))[to])
        return pa.table([left.column("row"), *[left.column(c) for c in counts], pa.array(total(t * best[p])), pa.array(total(t * count[p])), left.column(name)], names=out.names)

    aligned = (stage.filter("row IS NOT NULL").drop("pairs", "held").groupBy("chunk")
               .cogroup(found.groupBy("of")).applyInArrow(sums, out))
    return aligned.select(*[F.col(f"row.`{c}`").alias(c) for c in kept], *counts, "n_best", "count_sum", name)
