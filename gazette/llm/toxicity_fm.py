"""Toxicity: a factorization machine over hashed terms.

Terms are a text's words and the four- and five-letter starts of longer words, hashed. The machine
has a weight per term and a factor vector per term whose products add what two terms mean
together. It is fitted in numpy on a bounded sample of labelled rows, holds a bounded number
of terms, and is broadcast; scoring is one pass over the texts without a shuffle.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F, types as T

from gazette.llm.labelled import MAX_ROWS, labelled_rows
from gazette.session import materialize

MAX_TERMS = 8192
MIN_COUNT = 3
FACTORS = 8
STEMS = (4, 5)
#: Least log ratio of the class shares (label 1 over 0) * sqrt(count) of a term that the
#: machine holds: terms that speak for label 1, alone or with others.
MIN_STRENGTH = 10.0
_find = re.compile(r"\w+").findall


def terms_of(word: str) -> tuple[int, ...]:
    """Hashed terms of one lower-cased word."""
    h = lambda s: xxhash.xxh3_64_intdigest(s.encode("utf-8", "surrogatepass")) >> 1
    return (h(word), *(h(word[:n] + "*") for n in STEMS if len(word) > n))


class TermIndex(dict):
    """word -> positions of its terms in the model; holds a bounded number of words."""

    def __init__(self, position: dict[int, int] | None = None, limit: int = 300_000):
        super().__init__()
        self.position, self.limit = position, limit

    def __missing__(self, word: str) -> tuple[int, ...]:
        if len(self) >= self.limit:
            self.clear()
        found = terms_of(word)
        if self.position is not None:
            found = tuple(self.position[t] for t in found if t in self.position)
        self[word] = found
        return found

    def of(self, text: str | None) -> list[int]:
        """Distinct terms of a text (positions, or hashes without a model), sorted."""
        return sorted(set().union(*map(self.__getitem__, set(_find((text or "").lower())))))


class FactorizationMachine:
    def __init__(self, terms: np.ndarray, factors: int = FACTORS, seed: int = 3):
        self.position = {int(t): i for i, t in enumerate(terms)}
        self.w0, self.w = 0.0, np.zeros(len(terms))
        self.v = np.random.default_rng(seed).normal(0, 0.01, (len(terms), factors))

    def logits(self, at: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Of rows given as concatenated positions with their starts: logits, and the sums
        of the factor vectors. Every row ends with an empty slot, the position len(w)."""
        w = np.append(self.w, 0.0)
        v = np.vstack([self.v, np.zeros(self.v.shape[1])])
        sums = np.add.reduceat(v[at], starts, axis=0)
        squares = np.add.reduceat(v[at] ** 2, starts, axis=0)
        return self.w0 + np.add.reduceat(w[at], starts) + 0.5 * (sums ** 2 - squares).sum(1), sums

    def fit(self, rows: list[np.ndarray], y: np.ndarray, epochs: int = 20, batch: int = 256, rate: float = 0.1, factor_rate: float = 0.01, decay: float = 1e-5, factor_decay: float = 1e-2, weight: float = 5.0, seed: int = 5) -> None:
        """Logistic loss, adaptive gradient steps on shuffled batches; rows of label 1 count
        `weight` times."""
        rng, none = np.random.default_rng(seed), len(self.w)
        share = (y.sum() + 1) / (len(y) + 2)
        self.w0 = float(np.log(share / (1 - share)))
        gw, gv, g0 = np.full(none, 1e-8), np.full(self.v.shape, 1e-8), 1e-8
        for _ in range(epochs):
            order = rng.permutation(len(rows))
            for k in range(0, len(rows), batch):
                part = order[k:k + batch]
                at = np.concatenate([np.append(rows[i], none) for i in part]).astype(np.int64)
                size = np.array([len(rows[i]) + 1 for i in part])
                starts = np.concatenate([[0], np.cumsum(size)[:-1]])
                z, sums = self.logits(at, starts)
                err = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - y[part]) * np.where(y[part] > 0, weight, 1.0) / len(part)
                of = np.repeat(np.arange(len(part)), size)
                real = at < none
                at, of = at[real], of[real]
                e = err[of]
                dw = np.bincount(at, e, none)
                dv = np.zeros(self.v.shape)
                pull = e[:, None] * (sums[of] - self.v[at])
                for f in range(dv.shape[1]):
                    dv[:, f] = np.bincount(at, pull[:, f], none)
                seen = np.bincount(at, minlength=none) > 0
                dw[seen] += decay * self.w[seen]
                dv[seen] += factor_decay * self.v[seen]
                gw += dw ** 2
                gv += dv ** 2
                g0 += err.sum() ** 2
                self.w -= rate * dw / np.sqrt(gw)
                self.v -= factor_rate * dv / np.sqrt(gv)
                self.w0 -= rate * err.sum() / np.sqrt(g0)

    def scores(self, rows: list[list[int]]) -> np.ndarray:
        none = len(self.w)
        at = np.array([p for r in rows for p in (*r, none)], np.int64)
        starts = np.concatenate([[0], np.cumsum([len(r) + 1 for r in rows])[:-1]]).astype(np.int64)
        return 1 / (1 + np.exp(-np.clip(self.logits(at, starts)[0], -60, 60)))


def fit(sample: DataFrame, max_terms: int = MAX_TERMS, min_count: int = MIN_COUNT) -> FactorizationMachine:
    """Fits a machine on (text, y); the sample's rows are bounded by the caller. The terms
    are those whose share is most above that in the rows of label 0, for their count."""
    def extract(batches):
        index = TermIndex()
        for batch in batches:
            for k in range(0, batch.num_rows, 256):
                part = batch.slice(k, 256)
                yield pa.RecordBatch.from_arrays([part.column(1), pa.array([index.of(t) for t in part.column(0).to_pylist()], pa.list_(pa.int64()))], names=["y", "terms"])

    rows = materialize(sample.mapInArrow(extract, "y int, terms array<bigint>"), "fm-rows")
    size = rows.groupBy().agg(F.coalesce(F.sum("y"), F.lit(0)).alias("n1"), F.count("*").alias("n")).first()
    n1, n0 = int(size["n1"]), int(size["n"]) - int(size["n1"])
    counts = rows.select("y", F.explode("terms").alias("term")).groupBy("term").agg(F.sum("y").alias("n1"), F.count("*").alias("n")).filter(F.col("n") >= min_count)
    p1, p0 = (F.col("n1") + 0.5) / F.lit(n1 + 1.0), (F.col("n") - F.col("n1") + 0.5) / F.lit(n0 + 1.0)
    strength = F.log(p1 / p0) * F.sqrt("n")
    best = counts.filter(strength >= MIN_STRENGTH).orderBy(F.desc(strength), "term").limit(max_terms).select("term")
    model = FactorizationMachine(best.toArrow().column("term").to_numpy())
    if not n1 or not n0:
        model.w0 = float(np.log((n1 + 1) / (n0 + 1)))
        model.v[:] = 0
        return model
    known = best.select(F.col("term").alias("t"))
    packed = rows.withColumn("i", F.monotonically_increasing_id())
    packed = materialize(packed, "fm-numbered")
    pairs = (packed.select("i", F.explode("terms").alias("t")).join(F.broadcast(known), "t").groupBy("i").agg(F.collect_list("t").alias("t")))
    table = packed.select("i", "y").join(pairs, "i", "left").select("y", F.coalesce("t", F.array().cast("array<bigint>")).alias("t")).orderBy("i").toArrow()
    y = table.column("y").to_numpy().astype(float)
    model.fit([np.array(sorted(model.position[t] for t in r), np.int64) for r in table.column("t").to_pylist()], y)
    return model


def score_toxicity(docs: DataFrame, labels: DataFrame, usable: Column, id_col: str = "doc_id", text: str = "text",
                   label: str = "toxic", max_rows: int = MAX_ROWS) -> DataFrame:
    """`docs` with `score` (0 to 1, higher: label 1 likelier) and `predicted` (score >= 0.5).
    Only the text is scored; null and empty texts get the score of a text without terms.
    Learns from at most max_rows labelled rows with `usable` ids. Columns named score or
    predicted are replaced. Repeated rows get equal scores. An empty table gives no rows."""
    spark = docs.sparkSession
    model = spark.sparkContext.broadcast(fit(labelled_rows(docs, labels, label, usable, id_col, text, max_rows)))
    kept = [c for c in docs.columns if c not in ("score", "predicted")]
    schema = T.StructType([docs.schema[c] for c in kept] + [T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())])

    def run(batches):
        m = model.value
        index = TermIndex(m.position)
        for batch in batches:
            if not batch.num_rows:
                continue
            score = m.scores([index.of(t.as_py()) for t in batch.column(len(kept))])
            yield pa.RecordBatch.from_arrays([batch.column(i) for i in range(len(kept))] + [pa.array(score), pa.array((score >= 0.5).astype(np.int32))], names=schema.names)

    return docs.select(*[F.col(f"`{c}`") for c in kept], F.col(f"`{text}`").alias("__text")).mapInArrow(run, schema)
