"""Language identification by words first, backing off to ever shorter character n-grams.

Every word of a text votes with one vector, the log of its relative frequency in each
language. A word that no language knows votes with the mean over its longest n-grams (of
five characters, then four, down to one) that any language knows. The votes are
added up; the language with the highest sum wins.

Words are counted over all training texts: in each task by language, so one row for each
task, language and word is shuffled. The n-grams are counted from the counted words, never
from the texts. Of each table a language keeps its most frequent entries, down to a
count found from a histogram, so no language is sorted in one task and equal counts stay
or go together. The kept entries, bounded by MAX_ENTRIES in all, are broadcast; scoring is
one pass over the texts without a shuffle.
"""

from __future__ import annotations

import re
from collections import Counter
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, functions as F, types as T

from gazette.session import materialize, spread

#: Longest n-gram.
LONGEST = 5
#: Words, and n-grams of each length, that a language keeps at most, and entries of all
#: languages together (some 40 bytes each when broadcast).
KEPT, MAX_ENTRIES = 30_000, 1_500_000
#: Characters of an unseen word that weigh as much as one word (scripts without blanks).
WORD_LENGTH = 8
#: Distinct words that a worker counts, or remembers the votes of, at a time.
HELD = 200_000

#: A word: a letter and what letters and marks follow it.
WORD = regex.compile(r"\p{L}[\p{L}\p{M}]*")
#: The same in texts of the first 256 characters, which have no marks.
LATIN_WORD = re.compile("[" + "".join(c for c in map(chr, range(256)) if WORD.fullmatch(c)) + "]+")


def letters(text: str | None) -> list[str]:
    """The words of a text in lower case; none without letters."""
    if not text:
        return []
    text = text.lower()
    return (LATIN_WORD if _latin(text) else WORD).findall(text)


def _latin(text: str) -> bool:
    if text.isascii():
        return True
    try:
        text.encode("latin-1")
        return True
    except UnicodeEncodeError:
        return False


def grams(word: str, k: int) -> list[str]:
    """Runs of k characters of the word with a blank on either side."""
    padded = f" {word} "
    return [padded[i:i + k] for i in range(len(padded) - k + 1)]


def _counted(held: dict[str, Counter]) -> pa.RecordBatch:
    langs, kinds, keys, counts = [], [], [], []
    for (lang, kind), of in held.items():
        langs += [lang] * len(of)
        kinds += [kind] * len(of)
        keys += of.keys()
        counts += of.values()
    return pa.RecordBatch.from_arrays([pa.array(langs, pa.string()), pa.array(kinds, pa.int32()), pa.array(keys, pa.string()), pa.array(counts, pa.int64())],
                                      names=["lang", "kind", "key", "n"])


_COUNTS = "lang string, kind int, key string, n long"


def count_words(docs: DataFrame, lang: str, text: str) -> DataFrame:
    """(lang, kind 0, key, n): how often each word is in the texts of each language."""
    def run(batches):
        held, size = {}, 0
        for batch in batches:
            for of, t in zip(batch.column(0), batch.column(1)):
                found = held.setdefault((of.as_py(), 0), Counter())
                size -= len(found)
                found.update(letters(t.as_py()))
                size += len(found)
                if size > HELD:
                    yield _counted(held)
                    held, size = {}, 0
        yield _counted(held)

    rows = docs.select(F.col(f"`{lang}`").alias("lang"), F.col(f"`{text}`").alias("text")).filter("lang IS NOT NULL")
    return spread(rows).mapInArrow(run, _COUNTS).groupBy("lang", "kind", "key").agg(F.sum("n").alias("n"))


def count_grams(words: DataFrame) -> DataFrame:
    """(lang, kind, key, n) with kind the length: n-grams of the counted words. From each character of a
    word on, the run of LONGEST (fewer at its end) is counted; the shorter n-grams begin these runs."""
    def counted(held):
        out: dict[tuple, Counter] = {}
        for lang, runs in held.items():
            kinds = [out.setdefault((lang, k), Counter()) for k in range(1, LONGEST + 1)]
            for run, n in runs.items():
                for k, of in enumerate(kinds[:len(run)], 1):
                    of[run[:k]] += n
        return _counted(out)

    def run(batches):
        held, size = {}, 0
        for batch in batches:
            for lang, word, n in zip(*(c.to_pylist() for c in batch.columns)):
                of = held.setdefault(lang, {})
                size -= len(of)
                padded = f" {word} "
                for i in range(len(padded)):
                    g = padded[i:i + LONGEST]
                    of[g] = of.get(g, 0) + n
                size += len(of)
                if size > HELD:
                    yield counted(held)
                    held, size = {}, 0
        yield counted(held)

    return words.select("lang", "key", "n").mapInArrow(run, _COUNTS).groupBy("lang", "kind", "key").agg(F.sum("n").alias("n"))


def _most_frequent(counts: DataFrame, kept: int) -> DataFrame:
    """Entries whose count is at least the smallest one with which no more than `kept`
    entries of their language and kind remain (quarters of a doubling, from a histogram)."""
    step = F.floor(4 * F.log2("n")).cast("int")
    steps = counts.groupBy("lang", "kind", step.alias("step")).agg(F.count("*").alias("c")).collect()      # some 100 rows for each language and kind
    least: dict[tuple, int] = {}
    for key in {(r["lang"], r["kind"]) for r in steps}:
        total = 0
        for s, c in sorted(((r["step"], r["c"]) for r in steps if (r["lang"], r["kind"]) == key), reverse=True):
            total += c
            if total > kept:
                break
            least[key] = s
    spark = counts.sparkSession
    bar = spark.createDataFrame([(a, k, s) for (a, k), s in least.items()], "lang string, kind int, least int")
    return counts.join(F.broadcast(bar), ["lang", "kind"]).filter(step >= F.col("least")).drop("least")


class LanguageModel:
    """Votes of words and n-grams, from (lang, kind, key, n) and the totals of each
    language and kind."""

    def __init__(self, entries: pa.Table, totals: list[tuple[str, int, int]]):
        self.langs = sorted({lang for lang, _, _ in totals})
        at = {lang: i for i, lang in enumerate(self.langs)}
        size = np.zeros((LONGEST + 1, len(self.langs)))
        for lang, kind, n in totals:
            size[kind, at[lang]] = n
        #: an entry that a language lacks counts as half an occurrence in the largest one
        self.absent = np.log(0.5 / np.maximum(size.max(1, initial=1), 1))
        self.share = size[0] / max(size[0].sum(), 1)
        names = entries.column("lang").combine_chunks().dictionary_encode()
        lang = np.array([at[x] for x in names.dictionary.to_pylist()], np.int64)[names.indices.to_numpy()] if len(names) else np.empty(0, np.int64)
        kind = entries.column("kind").to_numpy()
        log = np.log(entries.column("n").to_numpy() / size[kind, lang]) - self.absent[kind] if len(names) else np.empty(0)
        self.known: list[dict[str, tuple]] = [{} for _ in range(LONGEST + 1)]
        for k, key, a, v in zip(kind.tolist(), entries.column("key").to_pylist(), lang.tolist(), log.tolist()):
            self.known[k][key] = self.known[k].get(key, ()) + ((a, v),)

    def vote(self, word: str) -> list[float]:
        """Log frequency of the word in each language, above that of an absent entry."""
        out = [0.0] * len(self.langs)
        own = self.known[0].get(word)
        if own:
            for a, v in own:
                out[a] = v
            return out
        padded = f" {word} "
        for k in range(LONGEST, 0, -1):
            known = self.known[k]
            found = [f for i in range(len(padded) - k + 1) if (f := known.get(padded[i:i + k]))]
            if found:
                for f in found:
                    for a, v in f:
                        out[a] += v
                share = max(1.0, len(word) / WORD_LENGTH) / len(found)
                return [x * share for x in out]
        return out


class _Votes(dict):
    """word -> row of a matrix of votes. Starts again after `limit` words."""

    def __init__(self, model: LanguageModel, limit: int = HELD):
        super().__init__()
        self.model, self.limit = model, limit
        self.rows = np.empty((1024, len(model.langs)))

    def __missing__(self, word: str) -> int:
        n = len(self)
        if n == len(self.rows):
            self.rows = np.concatenate([self.rows, np.empty_like(self.rows)])
        self.rows[n] = self.model.vote(word)
        self[word] = n
        return n

    def of(self, text: str | None) -> tuple[str, float]:
        """Language of a text and its share of the likelihood; `und`, 0 without letters."""
        ws = letters(text)
        langs = self.model.langs
        if not ws or not langs:
            return "und", 0.0
        if len(self) > self.limit:
            self.clear()
        at = np.fromiter(map(self.__getitem__, ws), np.int64, len(ws))
        total = self.rows[at].sum(0)
        if not total.any():                     # nothing known: the commonest language
            best = int(self.model.share.argmax())
            return langs[best], float(self.model.share[best])
        best = int(total.argmax())              # ties: the first in order
        return langs[best], float(1 / np.exp(total - total[best]).sum())


@lru_cache(maxsize=2)
def _model(raw: bytes, totals: tuple) -> LanguageModel:
    return LanguageModel(pa.ipc.open_stream(raw).read_all(), list(totals))


def fit_languages(docs: DataFrame, usable: Column, lang: str = "lang", text: str = "text", kept: int = KEPT) -> tuple[bytes, tuple]:
    """Entries (Arrow stream) and totals of a model learned from the rows of `docs` for which
    `usable` holds and whose language is not null."""
    words = materialize(count_words(docs.filter(usable), lang, text), "langid-words")
    counts = materialize(words.unionByName(count_grams(words)), "langid-counts")
    totals = tuple((r["lang"], r["kind"], r["n"]) for r in counts.groupBy("lang", "kind").agg(F.sum("n").alias("n")).collect())
    n_langs = max(len({t[0] for t in totals}), 1)
    entries = _most_frequent(counts, min(kept, MAX_ENTRIES // ((LONGEST + 1) * n_langs))).orderBy("kind", "key", "lang").toArrow()
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, entries.schema) as w:
        w.write_table(entries)
    return sink.getvalue().to_pybytes(), totals


def predict_languages(docs: DataFrame, usable: Column, lang: str = "lang", text: str = "text", kept: int = KEPT) -> DataFrame:
    """`docs` with `lang_pred`, one of the languages learned, and `score`, its share of the
    likelihood over all of them (0 to 1).

    Learns from the rows for which `usable` holds (a condition on columns of `docs`) and
    whose language is not null; an empty language is one like any other. Null and empty
    texts and texts without letters are `und` with score 0, and so is every text if
    nothing was learned. A text of which not even a character is known gets the
    commonest language. Whole texts are read; ties go to the language first in order.
    Repeated rows count each. Columns named lang_pred or score are replaced, all others
    pass. An empty table gives no rows.
    """
    spark = docs.sparkSession
    raw, totals = fit_languages(docs, usable, lang, text, kept)
    model = spark.sparkContext.broadcast((raw, totals))
    cols = [c for c in docs.columns if c not in ("lang_pred", "score")]
    source = docs.select(F.struct(F.lit(0).alias("_"), *[F.col(f"`{c}`") for c in cols if c != text]).alias("row"), F.col(f"`{text}`").alias("text"))
    schema = T.StructType([*source.schema.fields, T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])

    def run(batches):
        votes = _Votes(_model(*model.value))
        for batch in batches:
            found = [votes.of(t.as_py()) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64())], names=schema.names)

    out = spread(source).mapInArrow(run, schema)
    return out.select(*[F.col("text").alias(c) if c == text else F.col(f"row.`{c}`").alias(c) for c in cols], "lang_pred", "score")
