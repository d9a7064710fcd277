"""Quality classifier: naive Bayes support vectors.

Indicators of word and shape n-grams are scaled by their class log-count ratios; a linear
hinge-loss model over them is fitted by dual coordinate descent on a bounded sample of
labelled rows, and its margin becomes a probability by a logistic fit on rows that the
descent has not seen. Counts of the n-grams are made by Spark; the model holds a bounded
number of n-grams and is broadcast; scoring is one pass over the texts without a shuffle.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from gazette.llm.labelled import MAX_ROWS, labelled_rows
from gazette.llm.words import WordHashes, lower_az, mix, words
from gazette.session import materialize

MAX_FEATURES = 65_536
MIN_COUNT = 3
#: Words of more characters are taken in pieces of so many: as a whole each would be unique
#: and unknown to the model.
LONG_WORD, PIECE = 64, 16
_SLOTS = 22


def shape(word: str) -> str:
    """Letters as a, digits as 0, each run once; other characters as they are, runs cut to three."""
    out = []
    for c in word:
        s = "a" if c.isalpha() else "0" if c.isdigit() else c
        if out and out[-1] == s and (s in "a0" or len(out) > 2 and out[-2] == out[-3] == s):
            continue
        out.append(s)
    return "".join(out)


def in_pieces(ws: list[str]) -> list[str]:
    """The words, long ones cut into pieces."""
    if not ws or max(map(len, ws)) <= LONG_WORD:
        return ws
    return [p for w in ws for p in ([w] if len(w) <= LONG_WORD else [w[k:k + PIECE] for k in range(0, len(w), PIECE)])]


class _Shapes(dict):
    def __init__(self, hashes: WordHashes):
        super().__init__()
        self.hashes = hashes

    def __missing__(self, word: str) -> int:
        if len(self) >= 200_000:
            self.clear()
        h = self[word] = self.hashes["\x00" + shape(word)]
        return h


class NGrams:
    """Hashes of a text's n-grams: words (1, 2), shapes with repetition marked (1, 2, 3),
    and binned marks of the whole text. Long words are several, their pieces."""

    def __init__(self):
        self.hashes = WordHashes()
        self.shapes = _Shapes(self.hashes)

    def of(self, text: str | None) -> np.ndarray:
        ws = in_pieces(words(lower_az(text or "")))
        n = len(ws)
        h = self.hashes.of(ws)
        s = np.fromiter(map(self.shapes.__getitem__, ws), np.uint64, n)
        again = np.zeros(n, np.uint64)
        again[1:] = h[1:] == h[:-1]
        s = s + again * np.uint64(0x51ED270B)
        k = np.uint64(0x9E3779B97F4A7C15)
        kinds = len(np.unique(h))
        marks = [int(np.log2(n + 1)), 32 + (10 * kinds // n if n else 11), 64 + (int(20 * again.sum()) // n if n else 0)]
        parts = [h, h[:-1] * k + h[1:] + np.uint64(1), s + np.uint64(2), s[:-1] * k + s[1:] + np.uint64(3),
                 (s[:-2] * k + s[1:-1]) * k + s[2:] + np.uint64(4), np.array(marks, np.uint64) * np.uint64(0xABCDEF12345) + np.uint64(5)]
        return mix(np.concatenate(parts))


def dual_descent(rows: list[tuple[np.ndarray, np.ndarray]], y: np.ndarray, n_features: int, c: np.ndarray, epochs: int = 12, seed: int = 1) -> tuple[np.ndarray, float]:
    """Weights and bias of the L2-regularised hinge loss by dual coordinate descent; rows
    are (indices, values), y is +1 or -1, c the cost of each row."""
    w, bias, alpha = np.zeros(n_features), 0.0, np.zeros(len(rows))
    norm = np.array([float(v @ v) + 1.0 for _, v in rows])
    rng = np.random.default_rng(seed)
    for _ in range(epochs):
        for i in rng.permutation(len(rows)):
            at, v = rows[i]
            g = y[i] * (w[at] @ v + bias) - 1.0
            new = min(max(alpha[i] - g / norm[i], 0.0), c[i])
            if new != alpha[i]:
                step = (new - alpha[i]) * y[i]
                w[at] += step * v
                bias += step
                alpha[i] = new
    return w, bias


def logistic_fit(margin: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """(a, b) of 1 / (1 + exp(-(a * margin + b))) by Newton steps, slightly regularised."""
    a, b = 1.0, 0.0
    t = np.where(y > 0, (y.sum() + 1) / (y.sum() + 2), 1 / ((1 - y).sum() + 2))
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a * margin + b, -30, 30)))
        g = np.array([((p - t) * margin).sum() + 1e-3 * (a - 1), (p - t).sum() + 1e-3 * b])
        q = p * (1 - p)
        hess = np.array([[(q * margin * margin).sum() + 1e-3, (q * margin).sum()], [(q * margin).sum(), q.sum() + 1e-3]])
        step = np.linalg.solve(hess + 1e-9 * np.eye(2), g)
        a, b = a - float(np.clip(step[0], -5, 5)), b - float(np.clip(step[1], -5, 5))
        if np.abs(step).max() < 1e-8:
            break
    return max(a, 0.0), b


class NbSvm:
    """The model: sorted n-gram hashes, their weights (log-count ratio times hinge weight),
    their ratios, and the logistic fit."""

    def __init__(self, features: np.ndarray, ratios: np.ndarray):
        order = np.argsort(features)
        self.features, self.ratios = features[order], ratios[order]
        self.weights, self.bias, self.a, self.b = np.zeros(len(features)), 0.0, 0.0, 0.0
        self.slots = np.zeros(1 << _SLOTS, bool)
        self.slots[(self.features >> np.uint64(64 - _SLOTS)).astype(np.int64)] = True

    def indices(self, ngrams: np.ndarray) -> np.ndarray:
        """Positions of the distinct known n-grams."""
        if not len(self.features):
            return np.zeros(0, np.int64)
        left = ngrams[self.slots[(ngrams >> np.uint64(64 - _SLOTS)).astype(np.int64)]]
        at = np.minimum(np.searchsorted(self.features, left), len(self.features) - 1)
        return np.unique(at[self.features[at] == left])

    def scaled(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """A row of the linear model: positions and their ratios, at length one."""
        v = self.ratios[at]
        length = np.sqrt(v @ v)
        return at, v / length if length > 0 else v

    def margin(self, row: tuple[np.ndarray, np.ndarray]) -> float:
        return float(self.weights[row[0]] @ row[1] + self.bias)

    def score(self, ngrams: np.ndarray) -> float:
        return float(1 / (1 + np.exp(-np.clip(self.a * self.margin(self.scaled(self.indices(ngrams))) + self.b, -60, 60))))


def fit(sample: DataFrame, max_features: int = MAX_FEATURES, min_count: int = MIN_COUNT, cost: float = 1.0) -> NbSvm:
    """Fits the model on (text, y). The sample's rows are bounded by the caller, the n-grams
    by max_features (those with the largest ratio for their count). Without rows of both
    classes every score is the smoothed share of label 1."""
    def grams(batches):
        make = NGrams()
        for batch in batches:
            for k in range(0, batch.num_rows, 256):
                part = batch.slice(k, 256)
                found = [np.unique(make.of(t)).view(np.int64) for t in part.column(0).to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column(1), pa.array(found, pa.list_(pa.int64()))], names=["y", "grams"])

    rows = materialize(sample.mapInArrow(grams, "y int, grams array<bigint>"), "nbsvm-rows")

    def count(batches):
        for batch in batches:
            for k in range(0, batch.num_rows, 1024):
                part = batch.slice(k, 1024)
                y, g = part.column(0).to_numpy(), part.column(1)
                flat = g.flatten().to_numpy()
                of = np.repeat(y, np.diff(g.offsets.to_numpy()))
                key, at, n = np.unique(flat, return_inverse=True, return_counts=True)
                ones = np.bincount(at, of, len(key)).astype(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(ones), pa.array(n - ones)], names=["gram", "n1", "n0"])

    size = rows.groupBy().agg(F.coalesce(F.sum("y"), F.lit(0)).alias("n1"), F.count("*").alias("n")).first()
    n1, n0 = int(size["n1"]), int(size["n"]) - int(size["n1"])
    counts = rows.mapInArrow(count, "gram bigint, n1 bigint, n0 bigint").groupBy("gram").agg(F.sum("n1").alias("n1"), F.sum("n0").alias("n0")).filter(F.col("n1") + F.col("n0") >= min_count)
    ratio = F.log(((F.col("n1") + 1) / F.lit(n1 + 2)) / ((F.col("n0") + 1) / F.lit(n0 + 2)))
    best = counts.withColumn("r", ratio).orderBy(F.desc(F.abs("r") * F.sqrt(F.col("n1") + F.col("n0"))), "gram").limit(max_features).select("gram", "r").toArrow()
    model = NbSvm(best.column("gram").to_numpy().view(np.uint64), best.column("r").to_numpy())
    if not n1 or not n0:
        model.b = float(np.log((n1 + 1) / (n0 + 1)))
        return model
    # the driver gets positions of known n-grams alone: four bytes each, a few hundred a row
    known = sample.sparkSession.sparkContext.broadcast(model)

    def positions(batches):
        for batch in batches:
            at = [known.value.indices(g.values.to_numpy().view(np.uint64)).astype(np.int32) for g in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(at, pa.list_(pa.int32()))], names=["y", "at"])

    packed = rows.mapInArrow(positions, "y int, at array<int>").toArrow()
    y = packed.column("y").to_numpy()
    xs = [model.scaled(g.values.to_numpy()) for chunk in packed.column("at").chunks for g in chunk]
    sign = np.where(y > 0, 1.0, -1.0)
    last = np.arange(len(y)) % 5 == 4
    if len(set(y[last])) < 2 or len(set(y[~last])) < 2:
        last = np.zeros(len(y), bool)
    train = np.flatnonzero(~last)
    model.weights, model.bias = dual_descent([xs[i] for i in train], sign[train], len(model.features), np.full(len(train), cost))
    held = np.flatnonzero(last) if last.any() else train
    margins = np.array([model.margin(xs[i]) for i in held])
    model.a, model.b = logistic_fit(margins, (y[held] > 0).astype(float))
    return model


def score_quality(docs: DataFrame, labels: DataFrame, usable: Column, id_col: str = "doc_id", text: str = "text",
                  label: str = "quality", max_rows: int = MAX_ROWS) -> DataFrame:
    """`docs` with `score` (0 to 1, higher: label 1 likelier) and `predicted` (score >= 0.5).
    Only the text is scored; null and empty texts get the score of a text without words.
    Learns from at most max_rows labelled rows with `usable` ids. Columns named score or
    predicted are replaced. Repeated rows get equal scores. An empty table gives no rows."""
    spark = docs.sparkSession
    model = spark.sparkContext.broadcast(fit(labelled_rows(docs, labels, label, usable, id_col, text, max_rows)))
    kept = [c for c in docs.columns if c not in ("score", "predicted")]
    schema = T.StructType([docs.schema[c] for c in kept] + [T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())])

    def run(batches):
        make, m = NGrams(), model.value
        for batch in batches:
            score = np.array([m.score(make.of(t.as_py())) for t in batch.column(len(kept))], np.float64)
            yield pa.RecordBatch.from_arrays([batch.column(i) for i in range(len(kept))] + [pa.array(score), pa.array((score >= 0.5).astype(np.int32))], names=schema.names)

    return docs.select(*[F.col(f"`{c}`") for c in kept], F.col(f"`{text}`").alias("__text")).mapInArrow(run, schema)
