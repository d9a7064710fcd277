"""LM scoring: a log-bilinear neural model, trained in numpy with noise-contrastive estimation.

The model predicts a unit from the four before it. Units are the most frequent words, the
end of a text, and classes of all other words by the hash of their last letters. Within a
class a word has its share of the class's counts over the whole training corpus (plus one
each, and one for all words never seen), so probabilities of words sum to one.

1. Words of the training texts are counted, all of them.
2. Texts are dealt to rounds and shards by a hash of their id and text; the number of shards
   follows the corpus, not its partitions. In each round every shard trains the model on all
   positions of its texts, from the averaged parameters of the round before; they are
   averaged by positions. Every position of the training texts is an example once.
3. Every text is scored in batches: context vectors times unit vectors, a softmax over all
   units. Counts of the most frequent words (a fixed number) are broadcast; the others are
   joined.
"""

from __future__ import annotations

import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from gazette.llm.words import lower_az, words
from gazette.session import materialize

#: Words with a unit of their own; classes of the other words. With the end 256 units.
OWN_UNITS, CLASSES = 191, 64
CONTEXT, SIZE, NOISE = 4, 16, 12
#: Words whose counts are broadcast, of at most so many characters; the rest is joined.
HEAD_WORDS, HEAD_CHARS = 262_144, 48
#: Rounds of training; positions of a shard in all rounds, and shards at most.
ROUNDS, SHARD_TOKENS, MAX_SHARDS = 4, 1_000_000, 16_384
_END, _SUFFIX = 0, 3
_BATCH = 512        # scores of a batch stay in a core's cache


class Units(dict):
    """word -> unit; 0 is the end, then the frequent words, then the classes. Holds a
    bounded number of words."""

    def __init__(self, frequent: list[str], limit: int = 200_000):
        self.frequent, self.limit = frequent, limit
        self.first_class = 1 + len(frequent)
        self.count = self.first_class + CLASSES
        super().__init__()
        self._refill()

    def _refill(self) -> None:
        self.clear()
        self.update({w: i for i, w in enumerate(self.frequent, 1)})

    def class_of(self, word: str) -> int:
        return self.first_class + zlib.crc32(word[-_SUFFIX:].encode("utf-8", "surrogatepass")) % CLASSES

    def __missing__(self, word: str) -> int:
        if len(self) >= self.limit:
            self._refill()
        u = self[word] = self.class_of(word)
        return u

    def of_word(self, word: str) -> int:
        """The unit of one word, not kept."""
        return self.get(word) or self.class_of(word)

    def of(self, ws: list[str]) -> np.ndarray:
        """Units of a text's words and its end."""
        return np.append(np.fromiter(map(self.__getitem__, ws), np.int32, len(ws)), _END)


def contexts(units: np.ndarray, starts: np.ndarray, start_unit: int) -> np.ndarray:
    """(positions, CONTEXT) units before each position of concatenated texts, nearest
    first; start_unit before a text begins."""
    n = len(units)
    out = np.full((n, CONTEXT), start_unit, np.int32)
    for j in range(1, CONTEXT + 1):
        out[j:, j - 1] = units[:-j]
    ends = np.append(starts[1:], n)
    for i in range(CONTEXT):                # the positions next to a text's start
        at = starts[starts + i < ends] + i
        out[at, i:] = start_unit
    return out


class Known(dict):
    """word -> place in the head, or behind it the place of the unit of any other word. Holds a
    bounded number of other words."""

    def __init__(self, head: list[str], units: Units, limit: int = 200_000):
        super().__init__(zip(head, range(len(head))))
        self.size, self.units, self.limit, self.others = len(head), units, limit, []

    def __missing__(self, word: str) -> int:
        if len(self.others) >= self.limit:
            for w in self.others:
                del self[w]
            self.others.clear()
        place = self[word] = self.size + self.units.of_word(word)
        self.others.append(word)
        return place


class LogBilinear:
    """score(unit | context) = sum_j C_j * q(unit_j) . r(unit) + b(unit), with a diagonal
    C_j for each distance."""

    def __init__(self, unit_counts: np.ndarray, seed: int = 7):
        rng = np.random.default_rng(seed)
        u = len(unit_counts)
        self.share = (unit_counts + 0.5) / (unit_counts + 0.5).sum()
        self.q = rng.normal(0, 0.3, (u + 1, SIZE)).astype(np.float32)     # one more: before the text
        self.r = rng.normal(0, 0.05, (u, SIZE)).astype(np.float32)
        self.c = np.tile((1.0 / np.arange(1, CONTEXT + 1, dtype=np.float32))[:, None], (1, SIZE))
        self.b = np.log(self.share).astype(np.float32)
        self._steps = [np.full(p.shape, 1e-6, np.float32) for p in (self.q, self.r, self.c, self.b)]

    def parameters(self) -> np.ndarray:
        """All parameters and the sums of squares that scale their steps."""
        return np.concatenate([p.ravel() for p in (self.q, self.r, self.c, self.b, *self._steps)])

    def load(self, flat: np.ndarray) -> "LogBilinear":
        at = 0
        for p in (self.q, self.r, self.c, self.b, *self._steps):
            p[...] = flat[at:at + p.size].reshape(p.shape)
            at += p.size
        return self

    def train(self, context: np.ndarray, unit: np.ndarray, rng: np.random.Generator, rate: float = 0.1) -> None:
        """One pass of noise-contrastive steps: tell each unit from NOISE drawn by share."""
        u = len(self.b)
        log_noise = np.log(NOISE * self.share).astype(np.float32)
        draw = Drawer(np.cumsum(self.share))
        for k in range(0, len(unit), 1024):
            ctx, pos = context[k:k + 1024], unit[k:k + 1024]
            n = len(pos)
            noise = draw(rng.random((n, NOISE)))
            flat = (np.arange(n)[:, None] * u + np.concatenate([pos[:, None], noise], axis=1)).ravel()
            h = self.hidden(ctx)
            # all units at once, of which the drawn ones are taken
            z = (h @ self.r.T + (self.b - log_noise)).ravel()[flat].reshape(n, NOISE + 1)
            err = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
            err[:, 0] -= 1
            # scattered into units by matrix products, of few rows at a time that stay in a core's cache
            dr, db, dh = np.zeros_like(self.r), np.zeros_like(self.b), np.empty_like(h)
            for i in range(0, n, 128):
                part = err[i:i + 128]
                weight = np.bincount(flat[i * (NOISE + 1):(i + 128) * (NOISE + 1)] - i * u, part.ravel(), len(part) * u).reshape(-1, u).astype(np.float32)
                dr += weight.T @ h[i:i + 128]
                db += weight.sum(0)
                np.matmul(weight, self.r, out=dh[i:i + 128])
            at = [sums_by(ctx[:, j], dh, len(self.q)) for j in range(CONTEXT)]
            dc = np.stack([(x * self.q).sum(0) for x in at])
            dq = sum(x * c for x, c in zip(at, self.c))
            for p, g, s in zip((self.q, self.r, self.c, self.b), (dq, dr, dc, db), self._steps):
                g /= 32
                s += g * g
                p -= rate * g / np.sqrt(s)

    def hidden(self, context: np.ndarray, tables: list[np.ndarray] | None = None) -> np.ndarray:
        tables = tables or self.tables()
        h = tables[0].take(context[:, 0], axis=0)
        for j in range(1, CONTEXT):
            h += tables[j].take(context[:, j], axis=0)
        return h

    def tables(self) -> list[np.ndarray]:
        return [self.q * self.c[j] for j in range(CONTEXT)]

    def log_probabilities(self, context: np.ndarray, unit: np.ndarray) -> np.ndarray:
        """Natural log of the normalised probability of each unit after its context."""
        # a bound of every score shifts it in the product itself; where it is too far above
        # the scores to keep their digits, the largest of each row does
        longest = np.sqrt((self.r.astype(np.float64) ** 2).sum(1).max())
        highest, lowest = float(self.b.max()), float(self.b.min())
        rt = np.vstack([self.r.T, self.b, np.ones(len(self.b))]).astype(np.float32)
        tables, ones = self.tables(), np.ones(len(self.b), np.float32)
        out = np.empty(len(unit), np.float64)
        for k in range(0, len(unit), _BATCH):
            h = self.hidden(context[k:k + _BATCH], tables)
            reach = np.sqrt(np.einsum("ns,ns->n", h, h)) * longest
            far = 2 * float(reach.max()) + highest - lowest > 60
            wide = np.ones((len(h), SIZE + 2), np.float32)
            wide[:, :SIZE] = h
            wide[:, SIZE + 1] = 0 if far else -(reach + highest)
            z = wide @ rt
            if far:
                z -= z.max(axis=1, keepdims=True)
            own = z[np.arange(len(h)), unit[k:k + _BATCH]].astype(np.float64)
            np.exp(z, out=z)
            out[k:k + _BATCH] = own - np.log((z @ ones).astype(np.float64))
        return out


class Drawer:
    """Places of numbers from 0 to 1 in cumulated shares: looked up in steps of equal width, and
    searched for in the few steps where a share ends."""

    def __init__(self, cumulated: np.ndarray, steps: int = 1 << 15):
        self.cumulated, self.steps = cumulated, steps
        at = np.searchsorted(cumulated, np.arange(steps + 1) / steps)
        self.at = np.minimum(at[1:], len(cumulated) - 1).astype(np.int32)
        self.ends = at[1:] != at[:-1]

    def __call__(self, x: np.ndarray) -> np.ndarray:
        step = (x * self.steps).astype(np.int32)
        out = self.at[step]
        some = np.flatnonzero(self.ends[step].ravel())
        out.ravel()[some] = np.minimum(np.searchsorted(self.cumulated, x.ravel()[some]), len(self.cumulated) - 1)
        return out


def sums_by(group: np.ndarray, rows: np.ndarray, n: int) -> np.ndarray:
    """(n, width) sums of the rows of each group."""
    order = np.argsort(group.astype(np.int16), kind="stable")
    g = group[order]
    starts = np.flatnonzero(np.append(True, g[1:] != g[:-1]))
    out = np.zeros((n, rows.shape[1]), np.float32)
    out[g[starts]] = np.add.reduceat(rows[order], starts, axis=0)
    return out


def _tokens(text: str | None) -> list[str]:
    return words(lower_az(text or ""))


def count_words(docs: DataFrame, text: str, flush: int = 300_000) -> DataFrame:
    """(word, c): how often each word occurs; counted in each task before the shuffle."""
    def run(batches):
        counts: Counter = Counter()

        def out():
            yield pa.RecordBatch.from_arrays([pa.array(list(counts.keys()), pa.string()), pa.array(list(counts.values()), pa.int64())], names=["word", "c"])
            counts.clear()

        for batch in batches:
            for t in batch.column(0):
                counts.update(_tokens(t.as_py()))
                if len(counts) > flush:
                    yield from out()
        yield from out()

    return docs.select(F.col(f"`{text}`").alias("t")).mapInArrow(run, "word string, c bigint").groupBy("word").agg(F.sum("c").alias("c"))


def _train_round(encoded: DataFrame, shards: int, number: int, unit_n: np.ndarray, start) -> DataFrame:
    """(i, x): parameters after a round over (key, units, shard), averaged by positions. A
    shard is trained in the order of its keys, wherever its rows lie."""
    def train(batches):
        total, seen = np.zeros(len(start.value)), 0
        shard, model, rng, held = None, None, None, []

        def step():
            if held:
                flat = np.concatenate(held).astype(np.int32)
                starts = np.cumsum([0] + [len(x) for x in held[:-1]])
                held.clear()
                order = rng.permutation(len(flat))
                model.train(contexts(flat, starts, len(unit_n))[order], flat[order], rng)
                return len(flat)
            return 0

        count = waiting = 0
        for batch in batches:
            for s, units in zip(batch.column(0).to_pylist(), batch.column(1)):
                if s != shard:
                    if model is not None:
                        count += step()
                        total, seen = total + model.parameters().astype(np.float64) * count, seen + count
                    shard, model, rng, count = s, LogBilinear(unit_n).load(start.value), np.random.default_rng([17, number, s]), 0
                    waiting = 0
                held.append(np.frombuffer(units.as_py(), np.uint8))
                waiting += len(held[-1])
                if waiting >= 100_000:
                    count, waiting = count + step(), 0
        if model is not None:
            count += step()
            total, seen = total + model.parameters().astype(np.float64) * count, seen + count
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total)), pa.int32()), pa.array(total), pa.array(np.full(len(total), seen), pa.int64())], names=["i", "x", "n"])

    dealt = encoded.repartition(shards, "shard").sortWithinPartitions("shard", "key", "units").select("shard", "units")
    return dealt.mapInArrow(train, "i int, x double, n bigint").groupBy("i").agg((F.sum("x") / F.sum("n")).alias("x")).orderBy("i")


def score_documents(docs: DataFrame, held_out: Column, id_col: str = "doc_id", text: str = "text",
                    head_words: int = HEAD_WORDS, rounds: int = ROUNDS, shard_tokens: int = SHARD_TOKENS) -> DataFrame:
    """(id, held_out, n_tokens, n_known, train_tokens, base_score, score) for every row.

    Learns from the rows where held_out is false. Tokens are the words, A-Z lower-cased,
    and one end. base_score: sum of log10((c + 1) / (N + V + 1)), with c, N and V the
    token's count, all tokens and distinct tokens of the training texts. score: the model's
    log10 probability. n_known: tokens with c > 0.

    Null and empty texts are their end alone. Texts of any length are scored whole. Rows
    that repeat are scored each. With no training rows every count is 0 and the model knows
    the classes alone. An empty table gives no rows.
    """
    spark = docs.sparkSession
    base = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text}`").alias("text"), held_out.alias("held_out"))
    training = base.filter(~F.col("held_out"))
    counts = materialize(count_words(training, "text"), "lm-counts")
    ends = training.count()
    total = counts.agg(F.coalesce(F.sum("c"), F.lit(0)).alias("n"), F.count("*").alias("v")).first()
    n_all, v_all = int(total["n"]) + ends, int(total["v"]) + (1 if ends else 0)
    # the head: words above a count, the lowest that leaves at most head_words of them
    short = counts.filter(F.char_length("word") <= HEAD_CHARS).withColumn("bin", F.floor(F.log2("c") * 16).cast("int"))
    bins, lowest, held = short.groupBy("bin").count().orderBy(F.desc("bin")).collect(), None, 0
    for b in bins:
        held += b["count"]
        if held > head_words:
            break
        lowest = b["bin"]
    head = short.filter(F.col("bin") >= (2 ** 30 if lowest is None else lowest)).select("word", "c").toArrow()
    head_word, head_count = head.column("word").to_pylist(), head.column("c").to_numpy()
    order = sorted(range(len(head_word)), key=lambda i: (-head_count[i], head_word[i]))
    frequent = [head_word[i] for i in order[:OWN_UNITS]]
    units = Units(frequent)

    # tokens and distinct words of every class, over all counts
    def classes(batches):
        u, n, v = Units(frequent), np.zeros(units.count, np.int64), np.zeros(units.count, np.int64)
        for batch in batches:
            at = np.array([u[w] for w in batch.column(0).to_pylist()], np.int64)
            if len(at):
                n += np.bincount(at, batch.column(1).to_numpy(), len(n)).astype(np.int64)
                v += np.bincount(at, minlength=len(v))
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(n)), pa.int32()), pa.array(n), pa.array(v)], names=["u", "n", "v"])

    per_unit = counts.select("word", "c").mapInArrow(classes, "u int, n bigint, v bigint").groupBy("u").agg(F.sum("n").alias("n"), F.sum("v").alias("v")).collect()
    unit_n, unit_v = np.zeros(units.count), np.zeros(units.count)
    for r in per_unit:
        unit_n[r["u"]], unit_v[r["u"]] = r["n"], r["v"]
    unit_n[_END] = ends

    shards = min(max(1, -(-n_all // shard_tokens)), MAX_SHARDS)
    shared = spark.sparkContext.broadcast((frequent, unit_n))

    words_b = spark.sparkContext.broadcast((head_word, head_count, units.of(head_word)[:-1].astype(np.uint8)))
    base_denominator = float(np.log10(n_all + v_all + 1))

    def encode(batches):
        head_word, head_count, head_unit = words_b.value
        u = Units(shared.value[0])
        places = Known(head_word, u)
        # 10's logarithm of count + 1, 0 outside of the head; the unit; the end comes last
        logs = np.concatenate([np.log10(head_count + 1.0), np.zeros(u.count), [np.log10(ends + 1)]])
        unit_of = np.concatenate([head_unit, np.arange(u.count), [_END]]).astype(np.uint8)      # 256 units
        tail_at, end_at = len(head_word), len(logs) - 1
        in_class = np.zeros(u.count)
        in_class[u.first_class:] = 1.0
        for batch in batches:
            for k in range(0, batch.num_rows, 64):
                part = batch.slice(k, 64)
                rows, n_known, tails = [], [], []
                for t in part.column(3).to_pylist():
                    ws = _tokens(t)
                    x = np.empty(len(ws) + 1, np.int32)
                    x[:-1] = np.fromiter(map(places.__getitem__, ws), np.int32, len(ws))
                    x[-1] = end_at
                    rows.append(x)
                    unknown = np.flatnonzero(x[:-1] >= tail_at)
                    n_known.append(len(ws) - len(unknown) + (1 if ends else 0))
                    tails.append(list(Counter([ws[i] for i in unknown]).items()))
                n_tokens = np.array([len(x) for x in rows])
                starts = np.concatenate([[0], np.cumsum(n_tokens)[:-1]]).astype(np.int64)
                flat = np.concatenate(rows)
                log, flat = logs[flat], unit_of[flat]
                base_sum = np.add.reduceat(log, starts) - n_tokens * base_denominator
                class_sum = np.add.reduceat(log * in_class[flat], starts)
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[:3], pa.array(n_tokens, pa.int64()), pa.array(n_known, pa.int64()), pa.array(base_sum, pa.float64()), pa.array(class_sum),
                     pa.array([x.tobytes() for x in np.split(flat, starts[1:])], pa.binary()),
                     pa.array([[{"word": w, "n": n} for w, n in t] for t in tails], pa.list_(pa.struct([("word", pa.string()), ("n", pa.int64())])))],
                    names=["id", "held_out", "key", "n_tokens", "n_known", "base", "in_class", "units", "tail"])

    # every text is cut into words once more, for training and scoring both; a number for each
    # row keeps rows that repeat an id apart
    key = F.xxhash64("id", F.xxhash64("text"))
    id_type = docs.schema[id_col].dataType.simpleString()
    encoded = base.select("id", "held_out", key.alias("key"), "text").mapInArrow(
        encode, f"id {id_type}, held_out boolean, key bigint, n_tokens bigint, n_known bigint, base double, in_class double, units binary, "
                "tail array<struct<word:string,n:bigint>>")
    encoded = materialize(encoded.withColumn("row", F.monotonically_increasing_id()), "lm-units")
    learned = encoded.filter(~F.col("held_out")).select("key", "units", F.pmod("key", F.lit(rounds)).cast("int").alias("round"),
                                                        F.pmod(F.xxhash64("key"), F.lit(shards)).cast("int").alias("shard"))
    model = LogBilinear(unit_n)
    for number in range(rounds if ends else 0):
        now = spark.sparkContext.broadcast(model.parameters())
        trained = _train_round(learned.filter(F.col("round") == number), shards, number, unit_n, now).toArrow()
        if trained.num_rows:
            model.load(trained.column("x").to_numpy())

    fitted = spark.sparkContext.broadcast((model, unit_n, unit_v, units.first_class))

    def score(batches):
        model, unit_n, unit_v, first_class = fitted.value
        within = np.log10(unit_n + unit_v + 1)
        within[:first_class] = 0.0
        for batch in batches:
            for k in range(0, batch.num_rows, 64):
                part = batch.slice(k, 64)
                rows = [np.frombuffer(x.as_py(), np.uint8) for x in part.column(6)]
                starts = np.cumsum([0] + [len(x) for x in rows[:-1]]).astype(np.int64)
                flat = np.concatenate(rows).astype(np.int32)
                lp = model.log_probabilities(contexts(flat, starts, len(unit_n)), flat) / np.log(10) - within[flat]
                yield pa.RecordBatch.from_arrays([*part.columns[:6], pa.array(np.add.reduceat(lp, starts) + part.column(7).to_numpy())],
                                                 names=["row", "id", "held_out", "n_tokens", "n_known", "base", "model"])

    scored = encoded.select("row", "id", "held_out", "n_tokens", "n_known", "base", "units", "in_class").mapInArrow(
        score, f"row bigint, id {id_type}, held_out boolean, n_tokens bigint, n_known bigint, base double, model double")
    tail = encoded.select("row", F.explode("tail").alias("t")).select("row", "t.word", "t.n")
    rest = tail.join(counts, "word").groupBy("row").agg(F.sum("n").alias("more_known"), F.sum(F.col("n") * F.log10(F.col("c") + 1)).alias("more"))
    out = scored.join(rest, "row", "left")
    more = F.coalesce("more", F.lit(0.0))
    return out.select(F.col("id").alias(id_col), "held_out", "n_tokens", (F.col("n_known") + F.coalesce("more_known", F.lit(0))).alias("n_known"),
                      F.lit(n_all).cast("long").alias("train_tokens"), (F.col("base") + more).alias("base_score"), (F.col("model") + more).alias("score"))
