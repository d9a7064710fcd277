"""Line dedup by a deletion-neighbourhood join (DataFrame functions only).

Two lines are near-duplicates if one inserted, deleted or replaced word at most turns one into
the other and the longer has at least five words; shorter lines match when their words are
equal. Of near-duplicates the earliest line stays.

1. Equal lines fall together by the hashes of their words.
2. Two lines within one word agree in their first or their
   last half; lines that share a half emit all variants with one word left out, as hashed
   keys. Of the lines that share a key the earliest is enough, so a key is aggregated, not
   paired, whatever its size. Work and keys grow with the words, at any length of line.

With `words_per_edit` the bound grows with the line, one word for every so many, rounded down
(5: a similarity of 0.8). All variants of several words would be too many, so from two edits on
pairs of neighbours are the keys; this costs many times more (figures in the README), and lines
that share a frequent pair but are not near are compared with one another:

3. Each edit spoils at most two pairs of neighbouring words, so near
   lines share at least `least_shared` pairs, at places no further apart than the bound. A
   line is keyed by its longest pairs (long words are rare), as many as it takes for near
   lines to meet; keys of one line alone go before anything is joined.
4. Lines that share such a key are first held against the earliest of the key alone; only those
   left without a near line meet all earlier ones.
5. The word edit distance is verified on the words.

Text is joined twice, for the candidate lines and for the result; everything else moves
hashes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from gazette.llm.words import word_array
from gazette.session import materialize

MIN_WORDS = 5
#: Positions of candidate lines up to which they are broadcast (some 50 bytes a document and
#: 4 a position); beyond they are joined by a shuffle.
MAX_BROADCAST_LINES = 200_000


def _half(n: Column) -> Column:
    return F.floor(n / 2).cast("int")


def _running_xor(hashes: Column) -> Column:
    """0, then the xor of the first one, two, ... hashes."""
    return F.aggregate(hashes, F.array(F.lit(0).cast("long")), lambda acc, x: F.concat(acc, F.array(F.element_at(acc, -1).bitwiseXOR(x))))


def variant_hashes(words: Column) -> Column:
    """Hashes of the words with each one left out, in order. A list's hash is the xor of its
    words' hashes with their places: the part before the gap keeps its places, the part
    behind it moves one down, so all variants follow from two running xors."""
    stay = _running_xor(F.transform(words, lambda x, j: F.xxhash64(x, j)))
    down = F.reverse(_running_xor(F.reverse(F.transform(words, lambda x, j: F.xxhash64(x, j - 1)))))
    return F.zip_with(F.slice(stay, F.lit(1), F.size(words)), F.slice(down, F.lit(2), F.size(words)), lambda x, y: x.bitwiseXOR(y))


def whole_hash(words: Column) -> Column:
    """The hash of all words, equal to that of a variant with the same words."""
    return F.aggregate(F.transform(words, lambda x, j: F.xxhash64(x, j)), F.lit(0).cast("long"), lambda acc, x: acc.bitwiseXOR(x))


def within_one_word(a: Column, b: Column) -> Column:
    """Whether one inserted, deleted or replaced word at most turns array a into b."""
    def shorter_first(x: Column, y: Column) -> Column:
        same = F.zip_with(F.slice(x, F.lit(1), F.size(x)), F.slice(y, F.lit(1), F.size(x)), lambda u, v: u.eqNullSafe(v))
        at = F.array_position(same, False)                    # first difference, from 1; 0: none
        at = F.when(at == 0, F.size(x) + 1).otherwise(at).cast("int")
        longer_rest = F.slice(y, at + 1, F.size(y))
        shorter_rest = F.slice(x, F.when(F.size(x) == F.size(y), at + 1).otherwise(at), F.size(y))
        return longer_rest == shorter_rest

    near = F.when(F.size(a) <= F.size(b), shorter_first(a, b)).otherwise(shorter_first(b, a))
    return F.when(F.abs(F.size(a) - F.size(b)) > 1, False).otherwise(near)


def bound(n: Column, words_per_edit: int) -> Column:
    """Edits within which a line of n words, the longer one, is near another."""
    return F.greatest(F.lit(1), F.floor(n / words_per_edit).cast("int"))


def least_shared(n: Column, words_per_edit: int) -> Column:
    """Pairs of neighbours that a line of n words shares at least with any near line, the
    longer one allowing two edits or more. A longer line of m words keeps m - 1 of them less two
    for each edit; this is least at m = n or at the next m with one edit more."""
    p = words_per_edit
    j = F.floor(n / p)
    at_next = (j + 1) * (p - 2) - 1
    return F.when(n < 2 * p, F.lit(2 * (p - 2) - 1)).otherwise(F.least(n - 1 - 2 * j, at_next)).cast("int")


def pair_keys(words: Column, words_per_edit: int) -> Column:
    """(k, i): hashes and places of the pairs of neighbours by which a line meets its near
    lines: all but the last `least_shared` - 1 in one order for all lines. Of the pairs that
    near lines share in their alignment the first in that order is a key of both."""
    size = lambda x, y: -(F.octet_length(x) + F.octet_length(y))
    pairs = F.zip_with(F.slice(words, F.lit(1), F.greatest(F.size(words) - 1, F.lit(0))), F.slice(words, F.lit(2), F.size(words)), lambda x, y: F.struct(size(x, y).alias("o"), F.xxhash64(x, y).alias("k")))
    pairs = F.array_sort(F.transform(pairs, lambda p, j: F.struct(p["o"].alias("o"), p["k"].alias("k"), j.alias("i"))))
    return F.transform(F.slice(pairs, F.lit(1), F.greatest(F.size(pairs) - least_shared(F.size(words), words_per_edit) + 1, F.lit(0))), lambda p: F.struct(p["k"].alias("k"), p["i"].alias("i")))


def _as_string(codes: Column) -> Column:
    """A string with one character for each number from 0 on (below a million)."""
    return F.decode(F.unhex(F.array_join(F.transform(codes, lambda c: F.lpad(F.hex(c + 0x10000), 8, "0")), "")), "UTF-32")


def _signature(words: Column) -> Column:
    """One character for each word, by its hash: no two equal words differ."""
    return _as_string(F.transform(words, lambda x: F.pmod(F.xxhash64(x), F.lit(1_000_000))))


def within_words(a: Column, b: Column, most: Column) -> Column:
    """Whether at most `most` inserted, deleted or replaced words turn array a into b."""
    kinds = F.array_distinct(F.concat(a, b))
    code = lambda x: _as_string(F.transform(x, lambda y: F.array_position(kinds, y)))
    return F.call_function("levenshtein", code(a), code(b), most) >= 0


def spaced(line: Column) -> Column:
    """The line's words with one space between them; most lines are so already."""
    messy = F.contains(line, F.lit("  ")) | F.startswith(line, F.lit(" ")) | F.endswith(line, F.lit(" "))
    for c in "\t\n\x0b\x0c\r":
        messy = messy | F.contains(line, F.lit(c))
    return F.when(messy, F.array_join(word_array(line), " ")).otherwise(line)


def _lines(docs: DataFrame, id_col: str, text: str) -> DataFrame:
    """(did, th, pos, s, n): lines with words, as spaced words `s`, n of them."""
    t = F.col(f"`{text}`")
    lines = docs.select(F.col(f"`{id_col}`").alias("did"), F.xxhash64(t).alias("th"), F.posexplode(F.split(t, "\n")).alias("pos", "line"))
    lines = lines.select("did", "th", "pos", spaced(F.col("line")).alias("s")).filter("s <> ''")
    return lines.withColumn("n", F.octet_length("s") - F.octet_length(F.replace("s", F.lit(" "), F.lit(""))) + 1)


def _keyed_lines(docs: DataFrame, id_col: str, text: str, distinct: DataFrame, words_per_edit: int) -> DataFrame:
    """(line, n, k, i): the keys, met by another line, of lines that may have a near line
    with two edits or more."""
    lines = _lines(docs, id_col, text).filter(F.col("n") >= 2 * words_per_edit - 2)
    lines = lines.select(F.xxhash64("s").alias("h"), F.xxhash64(F.lit(7), "s").alias("g"), F.col("n").cast("int").alias("n"), pair_keys(F.split("s", " "), words_per_edit).alias("keys"))
    keys = lines.select(F.explode(F.array_distinct(F.transform("keys", lambda x: x["k"]))).alias("k"))
    shared = materialize(keys.groupBy("k").agg(F.count("*").alias("c")).filter("c > 1").select("k"), "lines-shared")
    rows = lines.select("h", "g", "n", F.explode("keys").alias("x")).select("h", "g", "n", "x.k", "x.i").join(shared, "k", "left_semi")
    # copies of a line fall together; a key that they alone share goes
    rows = materialize(rows.distinct(), "lines-rows")
    met = rows.groupBy("k").agg(F.min("h").alias("a"), F.max("h").alias("b")).filter("a <> b").select("k")
    rows = rows.join(met, "k", "left_semi").join(distinct.select("h", "g", "first"), ["h", "g"])
    return materialize(rows.select(F.col("first").alias("line"), "n", "k", "i"), "lines-keys")


def _near_by_keys(rows: DataFrame, found: DataFrame, min_words: int, words_per_edit: int) -> DataFrame:
    """(line): lines of a near pair, the longer allowing two edits or more, other than its first."""
    most = bound(F.greatest("n", "m"), words_per_edit)
    fits = (F.greatest("n", "m") >= 2 * words_per_edit) & (F.greatest("n", "m") >= min_words) & (F.abs(F.col("n") - F.col("m")) <= most) & (F.abs(F.col("i") - F.col("j")) <= most)
    body = found.select(F.col("line"), F.col("w").alias("wa"), F.col("sig").alias("sa"))
    other = found.select(F.col("line").alias("other"), F.col("w").alias("wb"), F.col("sig").alias("sb"))

    def verified(pairs: DataFrame) -> DataFrame:
        pairs = pairs.filter("other < line").filter(fits).select("line", "other", most.alias("most")).distinct()
        pairs = pairs.join(body, "line").join(other, "other")
        close = F.call_function("levenshtein", F.col("sa"), F.col("sb"), F.col("most")) >= 0
        return pairs.filter(close).filter(within_words(F.col("wa"), F.col("wb"), F.col("most"))).select("line").distinct()

    first = rows.groupBy("k").agg(F.min(F.struct("line", "n", "i")).alias("f")).select("k", F.col("f.line").alias("other"), F.col("f.n").alias("m"), F.col("f.i").alias("j"))
    near = materialize(verified(rows.join(first, "k")), "lines-near-first")
    left = rows.join(near, "line", "left_anti")
    rest = rows.select("k", F.col("line").alias("other"), F.col("n").alias("m"), F.col("i").alias("j"))
    return near.unionByName(verified(left.join(rest, "k")))


def dropped_lines(docs: DataFrame, id_col: str = "doc_id", text: str = "text", min_words: int = MIN_WORDS,
                  words_per_edit: int | None = None) -> DataFrame:
    """(did, th, pos): the lines that an earlier line makes redundant, by document id, hash
    of the text and position (from 0)."""
    if words_per_edit is not None and words_per_edit < 4:
        raise ValueError("a bound of more than a quarter of the words leaves too few shared pairs")
    n, w = F.col("n"), F.col("w")
    few = F.lit(True) if words_per_edit is None else n < 2 * words_per_edit       # lines whose bound is one word
    head = lambda size, k: F.xxhash64(F.lit(0), size, F.call_function("substring_index", F.col("s"), F.lit(" "), k))
    tail = lambda size, k: F.xxhash64(F.lit(1), size, F.call_function("substring_index", F.col("s"), F.lit(" "), -k))
    h, m = _half(n), _half(n - 1)
    shorter, longer = few & (n >= min_words - 1), few & (n >= min_words)
    lines = _lines(docs, id_col, text).select(
        "did", "th", "pos", F.xxhash64("s").alias("h"), F.xxhash64(F.lit(7), "s").alias("g"),
        # as a line of n words, and as the longer of a pair (less one word)
        F.when(shorter, head(n, h)).alias("k0"), F.when(shorter, tail(n, n - h)).alias("k1"),
        F.when(longer, head(n - 1, m)).alias("k2"), F.when(longer, tail(n - 1, n - 1 - m)).alias("k3"))
    lines = materialize(lines, "lines")
    at = F.struct("did", "th", "pos")
    distinct = lines.groupBy("h", "g").agg(F.min(at).alias("first"), F.count("*").alias("c"), *[F.first(k).alias(k) for k in ("k0", "k1", "k2", "k3")])
    distinct = materialize(distinct, "lines-distinct")
    copies = (lines.join(distinct.filter("c > 1").select("h", "g", "first"), ["h", "g"])
              .filter(~at.eqNullSafe(F.col("first"))).select("did", "th", "pos"))

    halves = distinct.select("first", F.explode(F.array_compact(F.array("k0", "k1", "k2", "k3"))).alias("k"))
    shared = halves.groupBy("k").agg(F.count("*").alias("c")).filter("c > 1").select("k")
    wanted = halves.join(shared, "k", "left_semi").select("first")
    if words_per_edit is not None:
        keyed = _keyed_lines(docs, id_col, text, distinct, words_per_edit)
        wanted = wanted.unionByName(keyed.select(F.col("line").alias("first")).distinct())
    wanted = wanted.groupBy(F.col("first.did").alias("_d"), F.col("first.th").alias("_t")).agg(F.collect_set("first.pos").alias("_p"))
    wanted = materialize(wanted, "lines-wanted")
    if (wanted.agg(F.sum(F.size("_p"))).first()[0] or 0) <= MAX_BROADCAST_LINES:
        wanted = F.broadcast(wanted)
    body = F.col(f"`{text}`")
    found = docs.select(F.col(f"`{id_col}`").alias("did"), F.xxhash64(body).alias("th"), body.alias("text")).join(
        wanted, F.col("did").eqNullSafe(F.col("_d")) & (F.col("th") == F.col("_t")))
    split = F.split("text", "\n")
    found = (found.select("did", "th", split.alias("lines"), F.explode("_p").alias("pos"))
             .select(at.alias("line"), F.split(spaced(F.element_at("lines", F.col("pos") + 1)), " ").alias("w")))
    found = found.withColumn("n", F.size("w")).withColumn("whole", whole_hash(w))
    found = found.withColumn("cuts", F.when(longer, variant_hashes(w)))
    if words_per_edit is not None:
        found = found.withColumn("sig", F.when(n >= 2 * words_per_edit - 2, _signature(w)))
    found = materialize(found, "lines-candidates")

    cut = found.select("line", F.posexplode("cuts").alias("i", "k"))
    whole = found.filter(shorter).select("line", F.col("whole").alias("k"))
    by_cut = materialize(cut.groupBy("k", "i").agg(F.min("line").alias("other"), F.count("*").alias("c")), "lines-variants")
    first_cut = by_cut.groupBy("k").agg(F.min("other").alias("other"))
    first_whole = whole.groupBy("k").agg(F.min("line").alias("other"))
    first_same = by_cut.filter("c > 1").select("k", "i", "other")
    # most variants are met by no other line: those that are, are few
    met = by_cut.join(whole.select("k").distinct(), "k", "left_semi").select("k").unionByName(first_same.select("k")).distinct()
    cut = materialize(cut.join(met, "k", "left_semi"), "lines-met")
    earlier = (whole.join(first_cut, "k").select("line", "other")
               .unionByName(cut.join(first_whole, "k").select("line", "other"))
               .unionByName(cut.join(first_same, ["k", "i"]).select("line", "other")).filter("other < line").distinct())
    a, b = found.select("line", F.col("w").alias("wa")), found.select(F.col("line").alias("other"), F.col("w").alias("wb"))
    near = earlier.join(a, "line").join(b, "other").filter(within_one_word(F.col("wa"), F.col("wb")))
    near = near.select("line")
    if words_per_edit is not None:
        near = near.unionByName(_near_by_keys(keyed, found, min_words, words_per_edit))
    near = near.distinct().select(F.col("line.did").alias("did"), F.col("line.th").alias("th"), F.col("line.pos").alias("pos"))
    return copies.unionByName(near)


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text: str = "text", min_words: int = MIN_WORDS,
                words_per_edit: int | None = None) -> DataFrame:
    """`docs` with the redundant lines taken out of the text, plus n_lines (lines with
    words) and n_dropped. The bound is one word at any length, or with words_per_edit (4 or
    more) one for every so many words of the longer line.

    Earlier means a smaller id, then a smaller position; null ids come first. Lines are
    parted by U+000A and compared by their words, so white space makes no difference; lines
    without words stay. A line goes if any earlier line is near it, also one that goes
    itself. Null texts stay null with 0 lines. Texts that share an id are ordered by their
    hash; rows that repeat an id and text are one document and are treated alike. Columns
    named n_lines or n_dropped are replaced, all others pass. An empty table gives no rows.
    """
    gone = dropped_lines(docs, id_col, text, min_words, words_per_edit).groupBy(F.col("did").alias("_d"), F.col("th").alias("_t")).agg(F.collect_set("pos").alias("_gone"))
    body = F.col(f"`{text}`")
    lines = F.split(body, "\n")
    counted = F.size(F.filter(lines, lambda x: F.btrim(x, F.lit(" \t\x0b\x0c\r")) != ""))
    kept = F.array_join(F.filter(lines, lambda x, i: ~F.array_contains("_gone", i)), "\n")
    out = docs.join(gone, F.col(f"`{id_col}`").eqNullSafe(F.col("_d")) & (F.xxhash64(body) == F.col("_t")), "left")
    cols = [F.when(F.col("_gone").isNull(), body).otherwise(kept).alias(text) if c == text else F.col(f"`{c}`")
            for c in docs.columns if c not in ("n_lines", "n_dropped")]
    return out.select(*cols, F.when(body.isNull(), F.lit(0)).otherwise(counted).cast("long").alias("n_lines"),
                      F.coalesce(F.size("_gone"), F.lit(0)).cast("long").alias("n_dropped"))
