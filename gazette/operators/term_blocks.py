"""Term statistics of articles in blocks: document frequencies go to the articles and no
(article, term) row is shuffled.

1. Each task deals its articles, as it reads them, into blocks of a fixed number of bytes.
   A block has a vocabulary: the distinct terms of an edition with the number of the block's
   articles that hold them. Its articles, with their terms as places in it, are one
   compressed Arrow table. One pass over the text.
2. Terms are dealt into BUCKETS by a hash. A block's terms in a bucket are one row, and their
   places follow one another, so a task that sums a bucket sends back the numbers alone. A
   term stands once for each block that holds it, so no bucket is hot.
3. Each block meets its frequencies and ranks every article's terms and sentences.

Memory of a task follows the block (or the longest text), not the corpus; a task that sums
holds as many terms as a block does, up to BUCKETS blocks.
"""

from __future__ import annotations

from decimal import ROUND_HALF_UP, Decimal

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F, types as T

from gazette import config as C
from gazette.operators.select import EDITION

#: Bytes of terms in a block; a longer text is a block of its own.
BLOCK_CHARS = 16_000_000
#: Parts into which a hash deals the terms.
BUCKETS = 512
_MIN_LETTERS = 3
_EDITION = "\u0002"         # the entry of the edition in a vocabulary; no term
_NEXT = "\u0001"            # between the terms of two sentences; no sentence holds it
_VOCABULARY = [T.StructField("_bucket", T.IntegerType()), T.StructField("_start", T.IntegerType()),
               T.StructField("_vocabulary", T.ArrayType(T.StringType())), T.StructField("_held", T.ArrayType(T.LongType()))]


def _packed(columns: dict) -> bytes:
    """A table as one compressed value."""
    table, sink = pa.table(columns), pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
        out.write_table(table.combine_chunks())
    return sink.getvalue().to_pybytes()


def _unpacked(column: pa.ChunkedArray) -> pa.Table:
    return pa.ipc.open_stream(column[0].as_buffer()).read_all()


def _places(values: np.ndarray, ends: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values as they come first, and the place of each value among them (-1 at `ends`)."""
    coded = pa.array(values, mask=ends).dictionary_encode()
    return coded.dictionary.to_numpy(zero_copy_only=False), coded.indices.fill_null(-1).to_numpy(zero_copy_only=False)


def _grouped(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values of 0 and more in order, and the place of each value among them."""
    bits = len(values).bit_length()
    if int(values.max(initial=0)).bit_length() + bits > 63:
        distinct, place = np.unique(values, return_inverse=True)
        return distinct, place
    both = np.sort((values << bits) | np.arange(len(values)))     # with its position, a value sorts as one number
    ordered = both >> bits
    place = np.empty(len(values), np.int64)
    first = np.append(True, ordered[1:] != ordered[:-1])[:len(values)]
    place[both & ((1 << bits) - 1)] = np.cumsum(first) - 1
    return ordered[first], place


def _coded(lines: pa.Array, edition: np.ndarray, whole: bool):
    """For the lines of a block and the number of each article's edition (-1: none): the articles and
    places of all occurrences of terms, -1 between sentences (not `whole`: left out), the terms by
    place, their editions and how many articles hold them, the pairs of article and place, each
    once, and their counts."""
    blanks = pc.replace_substring(lines.fill_null(""), _NEXT, f" {_NEXT} " if whole else " ")
    parts = pc.split_pattern(blanks, " ")
    words = parts.flatten().dictionary_encode()
    at, held = words.indices.to_numpy(), words.dictionary
    row = np.repeat(np.arange(len(lines), dtype=np.int32), np.diff(parts.offsets.to_numpy()))
    del lines, blanks, parts, words         # a block's arrays are large: none stays longer than it is used
    ending = pc.equal(held, _NEXT).to_numpy(zero_copy_only=False)
    use = ((pc.utf8_length(held).to_numpy() >= _MIN_LETTERS) | ending)[at] & (edition[row] >= 0)
    row, at = row[use], at[use]
    entry, ends = edition[row], ending[at]
    entry *= len(held)
    entry += at
    del at, use
    possible = (int(edition.max(initial=-1)) + 1) * len(held)
    if possible <= 4 * len(entry):          # a map of all entries that can be is quicker than hashes
        given = np.zeros(possible, bool)
        given[entry[~ends]] = True
        distinct = np.flatnonzero(given)
        place = (np.cumsum(given) - 1)[entry]
        place[ends] = -1
    else:
        distinct, place = _places(entry, ends)
    of, term = np.divmod(distinct, max(1, len(held)))
    del entry, ends
    word = place >= 0
    each = row[word].astype(np.int64)
    each *= max(1, len(distinct))
    each += place[word]
    each.sort()
    first = np.flatnonzero(np.append(True, each[1:] != each[:-1])) if len(each) else np.zeros(0, np.int64)
    pairs = each[first]
    n = np.bincount(pairs % max(1, len(distinct)), minlength=len(distinct))
    return row, place, held.take(pa.array(term)), of, n, pairs, np.diff(np.append(first, len(each)))


def _buckets(terms: pa.Array) -> np.ndarray:
    """The bucket of each term, the same in every block: its bytes times powers of an odd number."""
    size = pc.binary_length(terms).to_numpy()
    if not size.sum():
        return np.zeros(len(size), np.int64)
    begin = np.cumsum(size, dtype=np.int64) - size
    powers = np.cumprod(np.full(int(size.max()), 0x9E3779B97F4A7C15, np.uint64))
    data = np.frombuffer(terms.buffers()[2], np.uint8)[:int(size.sum())] * powers[np.arange(int(size.sum())) - np.repeat(begin, size)]
    return ((np.add.reduceat(data, begin) >> np.uint64(32)) % np.uint64(BUCKETS)).astype(np.int64)


def _encoder(names: list[str], size_of_block: int, packed: bool, whole: bool):
    """Batches of (names..., _lines) → for each block a row for each bucket and edition with its terms, the first
    one's place (_start) and how many articles hold each (_held)
    and, if `packed`, one with the block's articles: the first column as a list; _rows, their other columns with `_n`, how many codes each
    has, and `_edition`, the place of its edition (-1: none); _codes, `place` for each occurrence of a term,
    -1 between sentences (not `whole`: for each term of an article, with its count `tf`); _terms by place."""
    niche, day = (names.index(c) for c in EDITION)

    def run(batches):
        from pyspark import TaskContext
        block = TaskContext.get().partitionId() << 32
        parts, size = [], 0

        def rows():
            table = pa.Table.from_batches(parts).combine_chunks()
            parts.clear()
            own, lines = table.select(names), [pa.concat_arrays(table.column(len(names)).chunks)]
            del table
            editions: dict[tuple, int] = {}
            edition = np.array([-1 if None in e else editions.setdefault(e, len(editions))
                                for e in zip(own.column(niche).to_pylist(), own.column(day).to_pylist())], np.int64)
            row, place, terms, of, n, pairs, tf = _coded(lines.pop(), edition, whole)
            each = np.bincount(edition[edition >= 0], minlength=len(editions))
            # an edition is an entry of its own; places go by bucket and edition
            entries = pa.concat_arrays([terms, pa.array([_EDITION] * len(editions), pa.string())])
            own_entry = len(of) + np.arange(len(editions))
            of, n = np.append(of, np.arange(len(editions))), np.append(n, each)
            group = _buckets(entries) * max(1, len(editions)) + of
            order = np.argsort(group, kind="stable")
            to = np.empty(len(order) + 1, np.int64)
            to[order], to[-1] = np.arange(len(order)), -1
            entries, group = entries.take(pa.array(order)), group[order]
            starts = np.flatnonzero(np.append(True, group[1:] != group[:-1])[:len(group)])
            ends = pa.array(np.append(starts, len(group)), pa.int32())
            bucket, key_of = np.divmod(group[starts], max(1, len(editions)))
            values = [[], [], []]
            if packed:
                distinct = max(1, len(terms))
                codes = {"place": pa.array(to[place], pa.int32())} if whole else {"place": pa.array(to[pairs % distinct], pa.int32()), "tf": pa.array(tf, pa.int32())}
                held = np.bincount(row if whole else pairs // distinct, minlength=len(edition))
                columns = {c: own.column(c) for c in names[1:]} | {"_n": pa.array(held), "_edition": pa.array(np.append(to[own_entry], -1)[edition])}
                values = [[_packed(columns)], [_packed(codes)], [_packed({"term": entries})]]
            rest, more = len(starts), len(values[0])
            ids = [pa.concat_arrays([pa.nulls(rest, pa.list_(own.column(0).type)), pa.ListArray.from_arrays(pa.array([0, own.num_rows], pa.int32()), own.column(0).chunk(0))])] if packed else []
            keys = list(editions)
            key = [pa.array([keys[e][k] for e in key_of.tolist()] + [None] * more, own.column(c).type) for k, c in enumerate((niche, day))]
            vocabulary = [pa.array(bucket, pa.int32()), pa.array(starts, pa.int32()), pa.ListArray.from_arrays(ends, entries),
                          pa.ListArray.from_arrays(ends, pa.array(n[order], pa.int64()))]
            return pa.RecordBatch.from_arrays(
                [*key, *ids, pa.array([block] * (rest + more), pa.int64()), *(pa.array([None] * rest + v, pa.binary()) for v in values),
                 *(pa.concat_arrays([v, pa.nulls(more, v.type)]) for v in vocabulary)],
                names=[*EDITION, *names[:len(ids)], "_block", "_rows", "_codes", "_terms", *(f.name for f in _VOCABULARY)])

        for batch in batches:
            sizes = pc.fill_null(pc.binary_length(batch.column(len(names))), 0).to_numpy(zero_copy_only=False)
            start = 0
            while start < batch.num_rows:
                upto = start + int(np.searchsorted(size + np.cumsum(sizes[start:], dtype=np.int64), size_of_block)) + 1
                parts.append(batch.slice(start, upto - start))
                size += int(sizes[start:upto].sum())
                start = upto
                if size >= size_of_block:
                    yield rows()
                    block, parts, size = block + 1, [], 0
        if parts:
            yield rows()

    return run


def encode(sents: DataFrame, columns, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """Blocks of articles with sentence arrays `s` (see _encoder), written once: block numbers are those of the
    tasks that dealt them. Where `s` is not among the columns, terms are kept with their counts and not
    where they stand; the edition alone as columns: only vocabularies."""
    from gazette.session import materialize_buckets
    lines = F.regexp_replace(F.lower(F.array_join("s", _NEXT)), r"[^\p{L}\x01]+", " ")
    rows = sents.select(*columns, lines.alias("_lines"))
    names = rows.columns[:-1]
    packed = names != list(EDITION)
    ids = [T.StructField(names[0], T.ArrayType(rows.schema[names[0]].dataType))] if packed else []
    schema = T.StructType([*(T.StructField(c, rows.schema[c].dataType) for c in EDITION), *ids, T.StructField("_block", T.LongType()),
                           *(T.StructField(c, T.BinaryType()) for c in ("_rows", "_codes", "_terms")), *_VOCABULARY])
    whole = any(isinstance(c, str) and c == "s" for c in columns)
    return materialize_buckets(rows.mapInArrow(_encoder(names, block_chars, packed, whole), schema), "_block", "term-blocks", "zstd")


def _summed(own_counts: bool):
    """Rows of all blocks in some buckets → (_block, _start, _df): for the terms of an own row, how many
    articles of the edition hold each. Own rows add their counts if `own_counts`."""
    def run(batches):
        parts = list(batches)
        if not parts:
            return
        table = pa.Table.from_batches(parts).combine_chunks()
        words, counts = pc.split_pattern(_one(table["_words"]), " "), _one(table["_held"])
        size = np.diff(words.offsets.to_numpy())
        editions: dict[tuple, int] = {}
        edition = np.array([editions.setdefault(e, len(editions)) for e in zip(*(table[c].to_pylist() for c in EDITION))], np.int64)
        coded = words.flatten().dictionary_encode()
        distinct, place = _places(np.repeat(edition, size) * len(coded.dictionary) + coded.indices.to_numpy())
        own = table["_own"].to_numpy(zero_copy_only=False)
        each = counts.flatten().to_numpy()
        if not own_counts:
            each = np.where(np.repeat(own, size), 0, each)
        df = np.bincount(place, each, len(distinct)).astype(np.int64)
        out = pa.array(df[place[np.repeat(own, size)]])
        ends = pa.array(np.append(0, np.cumsum(size[own])), pa.int32())
        mine = table.filter(pa.array(own)).combine_chunks()
        yield pa.RecordBatch.from_arrays([_one(mine["_block"]), _one(mine["_start"]), pa.ListArray.from_arrays(ends, out)], names=["_block", "_start", "_df"])
    return run


def _one(column: pa.ChunkedArray) -> pa.Array:
    return pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], column.type)


def packed_frequencies(encoded: DataFrame, corpus: DataFrame | None = None) -> DataFrame:
    """(_block, _start, _df): for the places from _start on, the articles of the edition (of the corpus, if
    given) that hold the term of the block; the place of the edition holds their number."""
    def entries(e, own):
        return (e.filter("_vocabulary IS NOT NULL")
                .select("_bucket", "_block", "_start", *EDITION, F.array_join("_vocabulary", " ").alias("_words"), "_held", F.lit(own).alias("_own")))

    def blocks(e):
        return e.select("_block").distinct().count()
    rows, tasks = entries(encoded, True), blocks(encoded)
    if corpus is not None:
        rows, tasks = rows.unionByName(entries(corpus, False)), tasks + blocks(corpus)
    return (rows.repartition(max(1, min(BUCKETS, tasks)), "_bucket").drop("_bucket")
            .mapInArrow(_summed(corpus is None), "_block bigint, _start int, _df array<bigint>"))


def frequencies(encoded: DataFrame, corpus: DataFrame | None = None) -> DataFrame:
    """(_block, i, df): packed_frequencies with a row for each place. Places not listed have df 1."""
    each = packed_frequencies(encoded, corpus).select("_block", "_start", F.posexplode("_df").alias("k", "df"))
    return each.filter("df <> 1").select("_block", (F.col("_start") + F.col("k")).alias("i"), "df")


def round_half_up(x: np.ndarray, digits: int) -> np.ndarray:
    """Spark's round for values of 0 and more: half up on the decimal digits of the number."""
    scaled = x * 10.0 ** digits
    out = np.floor(scaled + 0.5) / 10.0 ** digits
    for k in np.flatnonzero(np.abs(scaled - np.floor(scaled) - 0.5) < 1e-4):
        out[k] = float(Decimal(repr(float(x[k]))).quantize(Decimal(1).scaleb(-digits), ROUND_HALF_UP))
    return out


def _first(group: np.ndarray, k: int) -> np.ndarray:
    """Of sorted groups, which entries are among the first k of theirs."""
    starts = np.flatnonzero(np.append(True, group[1:] != group[:-1])) if len(group) else np.zeros(0, np.int64)
    return np.arange(len(group)) - np.repeat(starts, np.diff(np.append(starts, len(group)))) < k


def _top(codes: pa.Table, n: np.ndarray, held: np.ndarray, df: np.ndarray, n_tags: int, n_insights: int, digits: int):
    """For the codes of a block's articles, the size of each one's edition (0: none) and how many codes each
    has: (article, place, weight) of the terms that can be among the top n_tags, ties with the last
    one included, and (article, position) of the top sentences, in text order."""
    flat = codes.column("place").to_numpy()
    row = np.repeat(np.arange(len(held), dtype=np.int64), held)
    if "tf" in codes.column_names:
        of, term, tf = row, flat, codes.column("tf").to_numpy()
    else:
        word = flat >= 0
        distinct, place = _grouped(row[word] * len(df) + flat[word])
        tf = np.bincount(place, minlength=len(distinct))
        of, term = np.divmod(distinct, max(1, len(df)))
    d = df[term]
    kept = (d > 0) & (2 * d <= n[of])
    weight = np.zeros(len(term))
    weight[kept] = round_half_up(tf[kept] * np.log(n[of][kept].astype(np.float64) / d[kept]), digits)
    best = top = None
    if n_tags:
        r, c, w = of[kept], term[kept], weight[kept]
        order = np.lexsort((-w, r))
        r, c, w = r[order], c[order], w[order]
        lowest = np.full(len(held), np.inf)
        first = _first(r, n_tags)
        np.minimum.at(lowest, r[first], w[first])
        can = w >= lowest[r]
        best = r[can], c[can], w[can]
    if n_insights:
        before = np.cumsum(~word) - (~word)         # ends of sentences before each entry
        begin = np.cumsum(held) - held
        pos = before - np.repeat(np.append(before, 0)[begin], held)
        use = kept[place]
        width = int(pos.max(initial=0)) + 1
        ordered = (row[word] * width + pos[word])[use]      # in text order
        begins = np.append(True, ordered[1:] != ordered[:-1])[:len(ordered)]
        at, back = ordered[begins], np.cumsum(begins) - 1
        score = round_half_up(np.bincount(back, weight[place][use], len(at)) / np.bincount(back, minlength=len(at)), digits)
        r, p = np.divmod(at, width)
        order = np.lexsort((p, -score, r))
        order = np.sort(order[_first(r[order], n_insights)])
        top = r[order], p[order]
    return best, top


def ranked(encoded: DataFrame, corpus: DataFrame | None, columns: T.StructType, tags: int, insights: int, digits: int,
           short: int = 0, detailed: int = 0) -> DataFrame:
    """The articles of `encoded`, made of `columns`, with `tags`, their top terms by weight round(tf * ln(N/df))
    (ties: term; terms of more than half of the edition drop out), and, from their sentences `s`,
    `key_insights`, the top sentences by rounded mean weight of kept occurrences (ties: position), in
    text order, `short_summary` and `detailed_summary`, the first sentences. A number of 0
    leaves the column out, and `s` is not passed on."""
    names = [c for c in columns.names if c != "s"]
    strings = T.ArrayType(T.StringType())
    added = [*([("tags", strings)] if tags else []), *([("key_insights", strings)] if insights else []),
             *([("short_summary", T.StringType()), ("detailed_summary", T.StringType())] if short else [])]

    def lists(articles: np.ndarray, n: int, values) -> pa.Array:
        ends = np.append(0, np.cumsum(np.bincount(articles, minlength=n)))
        return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), values)

    def score(block: pa.Table, known: pa.Table) -> pa.Table:
        own = _unpacked(block.column("_rows"))
        own = own.append_column(columns.names[0], _one(known[columns.names[0]].drop_null()).flatten())
        edition, held = own.column("_edition").to_numpy(), own.column("_n").to_numpy()
        codes = _unpacked(block.column("_codes"))
        parts = known.filter(pc.field("_start").is_valid()).sort_by("_start")
        df = _one(parts["_df"]).flatten().to_numpy()        # the block's places, one row after another
        best, top = _top(codes, np.where(edition < 0, 0, np.append(df, 0)[edition]), held, df, tags, insights, digits)
        out = [own.column(c) for c in names]
        if tags:
            of, place, weight = best
            terms = _unpacked(block.column("_terms")).column("term").take(pa.array(place)).to_pylist()
            order = sorted(zip(of.tolist(), (-weight).tolist(), terms))
            at = np.array([r for r, _, _ in order], np.int64)
            first = _first(at, tags)
            out.append(lists(at[first], own.num_rows, pa.array([t for (_, _, t), f in zip(order, first) if f], pa.string())))
        if insights or short:
            s = pa.concat_arrays(own.column("s").chunks)
        if insights:
            out.append(lists(top[0], own.num_rows, s.values.take(pa.array(s.offsets.to_numpy()[top[0]] + top[1]))))
        if short:
            heads = pc.list_slice(s, 0, detailed).to_pylist()
            out.append(pa.array([None if x is None else " ".join(x[:short])[:C.SHORT_SUMMARY_CHARS] for x in heads], pa.string()))
            out.append(pa.array([None if x is None else " ".join(x) for x in heads], pa.string()))
        return pa.table(out, names=[*names, *(c for c, _ in added)])

    blocks = encoded.filter("_rows IS NOT NULL")
    rows = blocks.select("_block", "_rows", "_codes", *(["_terms"] if tags else []))
    known = packed_frequencies(encoded, corpus).unionByName(blocks.select("_block", columns.names[0]), allowMissingColumns=True)
    schema = T.StructType([*(T.StructField(c, columns[c].dataType) for c in names), *(T.StructField(c, t) for c, t in added)])
    # the rows lie in buckets of blocks, so only the frequencies and the ids are shuffled
    return rows.groupBy("_block").cogroup(known.groupBy("_block")).applyInArrow(score, schema)
