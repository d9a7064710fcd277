"""BPE encoding by per-prefix dynamic programming, and decoding.

For every prefix of a word there is one token that a correct encoding of this prefix ends
with. A suffix automaton over the vocabulary names, at every position, all tokens that end
there; of these the one that fits the last token of the prefix before it is stored, and
following the back-pointers from the end gives the exact ids. Two tokens fit if merging the
bytes of both would never join anything across their border.

The vocabulary file is read once on the driver and broadcast (fixed size); each worker
builds the automaton once. Texts stay in their partitions: no shuffle.
"""

from __future__ import annotations

import hashlib
import json
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, functions as F, types as T

DEFAULT_VOCABULARY = "byte_bpe_50k.json"

#: Fixed value: the pattern that splits a text before the merges.
SPLIT = (r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")


def vocabulary_bytes(path: str | None = None) -> bytes:
    """The vocabulary file; by default the public 50k byte-level BPE of the box."""
    if path is None:
        import public_tokenizers
        path = public_tokenizers.path(DEFAULT_VOCABULARY)
    with open(path, "rb") as f:
        return f.read()


def byte_alphabet() -> dict[str, int]:
    """Character -> byte of byte-level vocabularies: printable Latin-1 stands for itself,
    the other bytes, in order, for U+0100 and on."""
    plain = [b for b in range(256) if not (b <= 32 or 127 <= b <= 160 or b == 173)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class SuffixAutomaton:
    """Suffix automaton of a set of byte strings: `step` follows a text, and `ending`
    gives the strings of the set that end at the current position, longest first."""

    def __init__(self, strings: dict[bytes, int]):
        self.length, self.link, self.step_to = [0], [-1], [{}]
        ends: dict[int, list[tuple[int, int]]] = {}
        for s, number in strings.items():
            at = 0
            for c in s:
                at = self._add(at, c)
        for s, number in strings.items():
            at = 0
            for c in s:
                at = self.step_to[at][c]
            ends.setdefault(at, []).append((len(s), number))
        # all strings that end here: the state's own, then those of its suffixes
        self.ends: list[tuple] = [()] * len(self.length)
        for at in sorted(range(1, len(self.length)), key=self.length.__getitem__):
            own = tuple(sorted(ends.get(at, ()), reverse=True))
            self.ends[at] = own + self.ends[self.link[at]] if own else self.ends[self.link[at]]

    def _new(self, length: int, link: int, step_to: dict) -> int:
        self.length.append(length)
        self.link.append(link)
        self.step_to.append(step_to)
        return len(self.length) - 1

    def _split(self, at: int, c: int, q: int) -> int:
        """A state for the strings of q up to one longer than at's."""
        copy = self._new(self.length[at] + 1, self.link[q], dict(self.step_to[q]))
        self.link[q] = copy
        while at != -1 and self.step_to[at].get(c) == q:
            self.step_to[at][c] = copy
            at = self.link[at]
        return copy

    def _add(self, last: int, c: int) -> int:
        q = self.step_to[last].get(c)
        if q is not None:
            return q if self.length[q] == self.length[last] + 1 else self._split(last, c, q)
        new = self._new(self.length[last] + 1, 0, {})
        at = last
        while at != -1 and c not in self.step_to[at]:
            self.step_to[at][c] = new
            at = self.link[at]
        if at != -1:
            q = self.step_to[at][c]
            self.link[new] = q if self.length[q] == self.length[at] + 1 else self._split(at, c, q)
        return new


class PrefixBpe:
    """Encoder and decoder of one byte-level vocabulary file."""

    def __init__(self, raw: bytes, cache: int = 250_000, pairs: int = 300_000):
        data = json.loads(raw)
        model, pre = data["model"], data.get("pre_tokenizer") or {}
        if (data.get("normalizer") or model["type"] != "BPE" or pre.get("type") != "ByteLevel" or pre.get("add_prefix_space")
                or not pre.get("use_regex", True) or model.get("ignore_merges")):
            raise ValueError("not a plain byte-level BPE vocabulary")
        byte_of = byte_alphabet()
        self.bytes_of = {i: bytes(byte_of[c] for c in t) for t, i in model["vocab"].items()}
        self.special = {t["content"]: t["id"] for t in data.get("added_tokens", ())}
        if any(t["single_word"] or t["lstrip"] or t["rstrip"] for t in data.get("added_tokens", ())):
            raise ValueError("added tokens with white-space rules are not supported")
        id_of = model["vocab"]
        self.rank, self.parts = {}, {}
        for r, m in enumerate(model["merges"]):
            x, y = m if isinstance(m, list) else m.split(" ")
            made = id_of[x + y]
            self.rank[(id_of[x], id_of[y])] = r
            self.parts.setdefault(made, (id_of[x], id_of[y], r))
        # Tokens that an encoding can contain: bytes, and those whose parts meet first.
        usable = {i for i, b in self.bytes_of.items() if len(b) == 1}
        self._edges: dict[int, tuple] = {}
        for made, (x, y, r) in sorted(self.parts.items(), key=lambda p: p[1][2]):
            if x in usable and y in usable and self._first_joint(x, y) == r:
                usable.add(made)
        self.automaton = SuffixAutomaton({self.bytes_of[i]: i for i in sorted(usable)})
        self.split = regex.compile(SPLIT).findall
        self.split_special = regex.compile("|".join(regex.escape(s) for s in sorted(self.special, key=len, reverse=True))) if self.special else None
        self._fits: dict[int, bool] = {}
        self._young: dict[str, str] = {}
        self._old: dict[str, str] = {}
        self.cache, self.pairs = cache, pairs
        self._decoded = {str(i): b for i, b in self.bytes_of.items()}
        self._decoded |= {str(i): s.encode() for s, i in self.special.items()}

    def _edge(self, token: int, side: int) -> tuple:
        """(piece, rank at which it is merged away) along one edge of the token, from the
        whole token down to a byte; side 0 the left edge, 1 the right."""
        key = 2 * token + side
        found = self._edges.get(key)
        if found is None:
            found, gone, at = [], len(self.rank), token
            while True:
                found.append((at, gone))
                if at not in self.parts:
                    break
                gone = self.parts[at][2]
                at = self.parts[at][side]
            found = self._edges[key] = tuple(found)
        return found

    def _first_joint(self, a: int, b: int) -> int:
        """Rank of the first merge across the border of a and b when the bytes of both are
        merged by rank (leftmost first at equal rank); the number of merges if none."""
        none = best = len(self.rank)
        for x, x_gone in self._edge(a, 1):
            for y, y_gone in self._edge(b, 0):
                r = self.rank.get((x, y), none)
                if r < best and r < x_gone and r <= y_gone:
                    best = r
        return best

    def fits(self, a: int, b: int) -> bool:
        key = a << 20 | b
        ok = self._fits.get(key)
        if ok is None:
            if len(self._fits) >= self.pairs:
                self._fits.clear()
            ok = self._fits[key] = self._first_joint(a, b) == len(self.rank)
        return ok

    def word_ids(self, word: bytes) -> list[int]:
        """Ids of one piece of text that merges do not leave."""
        sam = self.automaton
        step_to, link, length, ends, known = sam.step_to, sam.link, sam.length, sam.ends, self._fits
        last = [-1]      # last[i]: the last token of the prefix of i bytes
        size = [0]
        at = matched = 0
        for i, c in enumerate(word, 1):
            while c not in step_to[at]:      # every byte is a token, so the start knows it
                at = link[at]
                matched = length[at]
            at = step_to[at][c]
            matched += 1
            for n, token in ends[at]:
                if n > matched:
                    continue
                before = last[i - n]
                if before < 0:
                    break
                ok = known.get(before << 20 | token)
                if ok or ok is None and self.fits(before, token):
                    break
            last.append(token)
            size.append(n)
        out, i = [], len(word)
        while i:
            out.append(last[i])
            i -= size[i]
        return out[::-1]

    def _piece(self, piece: str) -> str:
        ids = self._old.get(piece)
        if ids is None:
            ids = ",".join(map(str, self.word_ids(piece.encode("utf-8"))))
        if len(self._young) >= self.cache:
            self._old, self._young = self._young, {}
        self._young[piece] = ids
        return ids

    def encode_joined(self, text: str | None) -> str:
        """Decimal ids joined by commas."""
        if not text:
            return ""
        found = []
        parts = [(text, None)]
        if self.split_special and any(s in text for s in self.special):
            parts, at = [], 0
            for m in self.split_special.finditer(text):
                parts.append((text[at:m.start()], self.special[m[0]]))
                at = m.end()
            parts.append((text[at:], None))
        for part, special in parts:
            pieces = self.split(part)
            get = self._young.get
            done = list(map(get, pieces))
            if None in done:
                for i, ids in enumerate(done):
                    if ids is None:
                        done[i] = self._piece(pieces[i])
            found += done
            if special is not None:
                found.append(str(special))
        return ",".join(found)

    def encode(self, text: str | None) -> list[int]:
        joined = self.encode_joined(text)
        return [int(x) for x in joined.split(",")] if joined else []

    def decode_joined(self, joined: str) -> str:
        if not joined:
            return ""
        return b"".join(map(self._decoded.__getitem__, joined.split(","))).decode("utf-8", "replace")

    def decode(self, ids) -> str:
        return self.decode_joined(",".join(map(str, ids)))


@lru_cache(maxsize=1)
def _coder(raw: bytes, cache: int) -> PrefixBpe:
    return PrefixBpe(raw, cache, cache)


def encode_documents(docs: DataFrame, text: str = "text", vocabulary: str | None = None,
                     ids: bool = True, decoded: bool = True, cache: int = 250_000) -> DataFrame:
    """Adds `ids` (array<int>), `n_tokens`, and `decoded` (the text decoded from these
    ids) to `docs`; with ids=False or decoded=False only their sha256 (`ids_sha256` of the
    decimal ids joined by commas, `decoded_sha256` of the UTF-8 text).

    A worker remembers up to 2 * cache pieces and cache pairs of tokens.

    Null and empty texts have no ids and decode to the empty text. Texts of any length are
    encoded whole. All other columns pass unchanged; columns of `docs` named like an output
    column are replaced. Repeated rows give repeated results.
    """
    spark = docs.sparkSession
    raw = spark.sparkContext.broadcast(vocabulary_bytes(vocabulary))
    made = {"n_tokens": T.LongType(), "ids" if ids else "ids_sha256": T.ArrayType(T.IntegerType()) if ids else T.StringType(),
            "decoded" if decoded else "decoded_sha256": T.StringType()}
    kept = [c for c in docs.columns if c not in made]
    source = docs.select(*[F.col(f"`{c}`") for c in kept], F.col(f"`{text}`").alias("__text"))
    schema = T.StructType([docs.schema[c] for c in kept] + [T.StructField(n, t) for n, t in made.items()])
    sha = lambda s: hashlib.sha256(s.encode("utf-8")).hexdigest()

    def run(batches):
        coder = _coder(raw.value, cache)
        for whole in batches:
            for k in range(0, whole.num_rows, 128):          # ids of few rows at a time stay in memory
                batch = whole.slice(k, 128)
                counts, first, second = [], [], []
                for t in batch.column(len(kept)):
                    joined = coder.encode_joined(t.as_py())
                    back = coder.decode_joined(joined)
                    counts.append(joined.count(",") + 1 if joined else 0)
                    first.append(np.fromstring(joined, np.int32, sep=",") if ids else sha(joined))
                    second.append(back if decoded else sha(back))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(i) for i in range(len(kept))]
                    + [pa.array(counts, pa.int64()), pa.array(first, pa.list_(pa.int32()) if ids else pa.string()), pa.array(second, pa.string())],
                    names=schema.names)

    return source.mapInArrow(run, schema)
