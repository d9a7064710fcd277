"""Summaries: prompts (F14), response parsing (F15-F17), the extractive provider that
runs on Spark (Z2, default), a provider hook for remote models (E2), and the
article ⨝ summary pairing (J1, J2, P3).
"""

from __future__ import annotations

from typing import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, functions as F

from gazette import config as C
from gazette.functions.text import sentences, terms, token_truncate
from gazette.operators.select import EDITION
from gazette.operators.term_blocks import encode, ranked

SUMMARY_COLUMNS = ["article_id", "short_summary", "detailed_summary", "key_insights", "tags",
                   "provider", "parsed"]

SHORT_SENTENCES = 3       # extractive short summary: first 3 sentences
DETAILED_SENTENCES = 8    # extractive detailed summary: first 8 sentences
EXTRACT_TAGS = 5
EXTRACT_INSIGHTS = 5
WEIGHT_DIGITS = 9

# ---------------------------------------------------------------------------
# The three prompt texts, as the model receives them.
# ---------------------------------------------------------------------------
SUMMARY_SYSTEM = "You are an expert news analyst and summarizer."
SUMMARY_PROMPT = """
You are an expert news summarizer. Analyze the following article and provide:

1. A short summary (2-3 sentences) capturing the main point
2. A detailed summary (1-2 paragraphs) with key information
3. 3-5 key insights or takeaways as bullet points
4. 3-5 relevant tags/categories

Article Title: {title}
Source: {source}
Author: {author}

Content:
{content}

Please format your response as JSON with the following structure:
{{
    "short_summary": "...",
    "detailed_summary": "...",
    "key_insights": ["insight1", "insight2", ...],
    "tags": ["tag1", "tag2", ...]
}}
"""
TITLE_SYSTEM = "You are a professional newsletter editor."
TITLE_PROMPT = """
Generate an engaging, professional newsletter title for a {niche} news digest.

Top topics covered: {topics}

Requirements:
- Catchy but professional
- Includes the niche ({niche})
- Under 10 words
- Relevant to current news cycle

Provide only the title, no explanation.
"""
INSIGHTS_SYSTEM = "You are an expert {niche} industry analyst."
INSIGHTS_PROMPT = """
Based on the following key insights from today's {niche} news, provide a brief analysis
of the overall trends, patterns, and what they mean for the industry.

Key insights:
{insights}

Write 2-3 paragraphs of thoughtful analysis. Focus on:
1. Major themes and patterns
2. What this means for the future
3. Action items for readers

Keep it concise and insightful.
"""
# ---------------------------------------------------------------------------


def _fill(template: str, **cols) -> F.Column:
    """Fill {name} slots of a fixed template with columns (literal parts stay literal)."""
    import re
    parts, pos = [], 0
    text = template.replace("{{", "\u0002").replace("}}", "\u0003")
    for m in re.finditer(r"\{(\w+)\}", text):
        parts.append(F.lit(text[pos:m.start()].replace("\u0002", "{").replace("\u0003", "}")))
        parts.append(cols[m.group(1)])
        pos = m.end()
    parts.append(F.lit(text[pos:].replace("\u0002", "{").replace("\u0003", "}")))
    return F.concat(*parts)


def article_prompts(articles: DataFrame, max_tokens: int = C.TOKEN_LIMIT) -> DataFrame:
    """F14 (article kind): one prompt row per article; content cut to max_tokens words.
    An absent author prints as 'Unknown'."""
    return articles.select(
        "article_id", *EDITION, F.lit("article").alias("kind"),
        F.lit(SUMMARY_SYSTEM).alias("system"),
        _fill(SUMMARY_PROMPT, title=F.col("title"), source=F.col("source_name"),
              author=F.coalesce(F.col("author"), F.lit("Unknown")),
              content=token_truncate(F.col("content"), max_tokens)).alias("prompt"))


def edition_prompts(editions: DataFrame) -> DataFrame:
    """F14 (title and insights kinds), from lead topics (A3) and the insight corpus (A2)."""
    title = editions.select(
        *EDITION, F.lit("title").alias("kind"), F.lit(TITLE_SYSTEM).alias("system"),
        _fill(TITLE_PROMPT, niche=F.col("niche"), topics=F.col("lead_topics")).alias("prompt"))
    insights = editions.select(
        *EDITION, F.lit("insights").alias("kind"),
        F.replace(F.lit(INSIGHTS_SYSTEM), F.lit("{niche}"), F.col("niche")).alias("system"),
        _fill(INSIGHTS_PROMPT, niche=F.col("niche"), insights=F.col("insight_corpus")).alias("prompt"))
    return title.unionByName(insights)


# --------------------------------------------------------------------------- parsing
SUMMARY_JSON_SCHEMA = ("short_summary STRING, detailed_summary STRING, "
                       "key_insights ARRAY<STRING>, tags ARRAY<STRING>, _corrupt STRING")


def json_span(c) -> F.Column:
    """from the first '{' to the last '}' (null when there is none)."""
    s = F.col(c) if isinstance(c, str) else c
    start = F.locate("{", s)
    end = F.length(s) - F.locate("}", F.reverse(s)) + 1
    return F.when((start > 0) & (F.locate("}", F.reverse(s)) > 0) & (end > start),
                  F.substring(s, start, end - start + 1))


def one_document(span: F.Column) -> F.Column:
    """Whether the span is a single JSON value with nothing behind it. As the one element
    of a list and as the one member of an object it must stay a whole document: text that
    follows the value breaks at least one of the two."""
    return ((F.json_array_length(F.concat(F.lit("["), span, F.lit("]"))) == 1)
            & (F.size(F.json_object_keys(F.concat(F.lit('{"v":'), span, F.lit("}")))) == 1))


def parse_responses(responses: DataFrame, provider: str = "model", strict: bool = False) -> DataFrame:
    """F16 + F17: responses(article_id, response) → summaries.

    JSON is read with single quotes refused; a span that does not parse as an object, or
    that has text behind the object, takes the fixed fall-back. strict: the whole response
    (white space around it aside) must be the object. Missing keys become ''/[] (a JSON null list too), the
    short summary is cut to 500 characters and lists to 5 items."""
    span = json_span("response")
    if strict:
        span = F.when(F.btrim("response", F.lit(" \t\r\n")) == span, span)
    parsed = F.from_json(span, SUMMARY_JSON_SCHEMA,
                         {"allowSingleQuotes": "false", "mode": "PERMISSIVE",
                          "columnNameOfCorruptRecord": "_corrupt"})
    df = responses.withColumn("_j", parsed)
    ok = (span.isNotNull() & F.col("_j").isNotNull() & F.col("_j._corrupt").isNull()
          & F.coalesce(one_document(span), F.lit(False)))
    empty = F.array().cast("array<string>")
    return df.select(
        "article_id",
        F.when(ok, F.substring(F.coalesce(F.col("_j.short_summary"), F.lit("")), 1, C.SHORT_SUMMARY_CHARS))
         .otherwise(F.lit(C.FALLBACK_SHORT_SUMMARY)).alias("short_summary"),
        F.when(ok, F.coalesce(F.col("_j.detailed_summary"), F.lit("")))
         .otherwise(F.substring("response", 1, C.FALLBACK_DETAILED_CHARS)).alias("detailed_summary"),
        F.when(ok, F.slice(F.coalesce(F.col("_j.key_insights"), empty), 1, C.SUMMARY_LIST_ITEMS))
         .otherwise(F.array(F.lit(C.FALLBACK_INSIGHT))).alias("key_insights"),
        F.when(ok, F.slice(F.coalesce(F.col("_j.tags"), empty), 1, C.SUMMARY_LIST_ITEMS))
         .otherwise(F.array(*[F.lit(t) for t in C.FALLBACK_TAGS])).alias("tags"),
        F.lit(provider).alias("provider"),
        ok.alias("parsed"),
    )


# --------------------------------------------------------------------------- extractive
def with_sentences(articles: DataFrame) -> DataFrame:
    """The one pass over the text: sentence array `s` per article (content dropped)."""
    return articles.withColumn("s", sentences("content")).drop("content")


def with_text_only(articles: DataFrame) -> DataFrame:
    """For term statistics alone: the whole text as one element. Sentence splits never
    cut a letter run, so its terms are exactly the terms of the sentences."""
    return articles.withColumn("s", F.array("content")).drop("content")


#: Terms that stand in more than a HEAVY_TERMS-th of all (article, term) pairs are heavy. The
#: pairs of all terms sum to the total, so fewer than HEAVY_TERMS terms can be: a proven bound.
HEAVY_TERMS = 65536


_OCCURRENCES = {True: "array<struct<term:string,p:int>>", False: "array<string>"}


def with_terms(sents: DataFrame, key: str = "article_id", positions: bool = True, keep=()) -> DataFrame:
    """(key, edition, columns to keep, terms): the distinct terms of each text with their counts (`tf`) and the
    sentence of each occurrence (`pos`), all inside the row: sorted occurrences, then the
    runs of equal terms. No shuffle; the work is n log n in a text's length."""
    if positions:
        each = F.flatten(F.transform("s", lambda s, i: F.transform(
            terms(s), lambda t: F.struct(t.alias("term"), i.cast("int").alias("p")))))
        term = lambda o: o["term"]
    else:
        each = F.flatten(F.transform("s", lambda s: terms(s)))
        term = lambda o: o
    x = sents.select(key, *EDITION, *keep, F.coalesce(F.sort_array(each), F.array().cast(_OCCURRENCES[positions])).alias("_o"))
    starts = F.array_compact(F.transform("_o", lambda o, i: F.when(
        (i == 0) | (term(o) != term(F.get("_o", i - 1))), i)))
    x = x.withColumn("_b", F.array_append(starts, F.size("_o")))     # where each run begins, and the end

    def entry(b, j):
        n = F.get("_b", j + 1) - b
        cols = [term(F.get("_o", b)).alias("term"), n.cast("bigint").alias("tf")]
        if positions:
            cols.append(F.transform(F.slice("_o", b + 1, n), lambda o: o["p"]).alias("pos"))
        return F.struct(*cols)
    runs = F.slice("_b", 1, F.size("_b") - 1)
    return x.select(key, *EDITION, *keep, F.transform(runs, entry).alias("terms"))


def distinct_terms(sents: DataFrame) -> DataFrame:
    """(edition, terms) for document frequencies alone: each term of a text once."""
    each = F.array_distinct(F.flatten(F.transform("s", lambda s: terms(s))))
    return sents.select(*EDITION, F.transform(each, lambda t: F.struct(t.alias("term"))).alias("terms"))


def term_frequencies(counted: DataFrame) -> DataFrame:
    """(edition, term, df): articles that hold the term, summed by task before the shuffle."""
    one = counted.select(*EDITION, F.explode(F.transform("terms", lambda t: t["term"])).alias("term"))
    return one.groupBy(*EDITION, "term").agg(F.count("*").alias("df"))


def term_weights(sents: DataFrame, corpus: DataFrame | None = None, key: str = "article_id",
                 positions: bool = True, heavy_terms: int = HEAVY_TERMS, write: bool = True) -> DataFrame:
    """tf·ln(N/df) per (article, term), rounded to 9 places, with the sentence positions
    of the term's occurrences (`pos`, one entry per occurrence). Terms are counted inside
    the row; only partial sums of (edition, term) are shuffled for df. N and df are per edition
    over the corpus (default: the articles). Terms in more than half of the edition drop out.

    Weights come back to the articles in two parts. Heavy terms, fewer than `heavy_terms`
    whatever the corpus, are broadcast. Each of the others stands in at most a
    heavy_terms-th of the pairs, so no key of their join is hot."""
    from gazette.session import materialize as _mat
    given = "terms" in sents.columns         # a written frame of with_terms
    counted = sents if given else with_terms(sents, key, positions)
    ccounted = counted if corpus is None else distinct_terms(corpus)
    if write:                     # two or three readers each: the text is tokenised once
        counted = counted if given else _mat(counted, "terms")
        ccounted = counted if corpus is None else _mat(ccounted, "corpus-terms")
    n = ccounted.groupBy(*EDITION).agg(F.count("*").alias("n"))
    df = term_frequencies(ccounted)
    if write:
        df = _mat(df, "term-df")
    pairs_of_all = df.agg(F.sum("df")).first()[0] or 0
    marked = df.join(n, list(EDITION)).withColumn("heavy", F.col("df") * heavy_terms > F.lit(pairs_of_all))
    weight = F.round(F.col("tf") * F.log(F.col("n").cast("double") / F.col("df")), WEIGHT_DIGITS).alias("weight")
    out = [key, *EDITION, "term", "tf", *(["pos"] if positions else []), weight]
    rows = counted.select(key, *EDITION, F.inline("terms"))
    on = [*EDITION, "term"]
    heavy = marked.filter("heavy").select(*on, "df", "n")
    light = marked.filter("NOT heavy").select(*on, "df", "n")
    kept = F.col("df") * 2 <= F.col("n")
    by_heavy = rows.join(F.broadcast(heavy.filter(kept)), on).select(*out)
    rest = rows.join(F.broadcast(heavy.select(*on)), on, "left_anti")
    by_light = rest.join(light.filter(kept), on).select(*out)
    return by_heavy.unionByName(by_light)


ALL_PARTS = ("summary", "tags", "insights")


def summaries_from_sentences(sents: DataFrame, corpus: DataFrame | None = None, keep=(), parts=ALL_PARTS) -> DataFrame:
    """Z2 on sentence frames (article_id, niche, run_date, s, ...): short = first 3
    sentences (cut to 500), detailed = first 8, tags = top 5 terms by weight (ties:
    term), key_insights = top 5 sentences by mean weight of their kept term occurrences
    (ties: position), in text order; weights as in term_weights, N and df over the corpus (default: the
    articles). Articles are taken in blocks (see term_blocks), each row by itself: the text is
    read once and written once with its terms."""
    summary, tags, insights = (p in parts for p in ALL_PARTS)
    columns = list(dict.fromkeys(["article_id", *EDITION, *keep]))
    if insights:
        columns.append("s")
    elif summary:
        columns.append(F.slice("s", 1, DETAILED_SENTENCES).alias("s"))
    encoded = encode(sents, columns)
    of_corpus = None if corpus is None else encode(corpus, EDITION)
    out = ranked(encoded, of_corpus, sents.select(*columns).schema, EXTRACT_TAGS if tags else 0, EXTRACT_INSIGHTS if insights else 0, WEIGHT_DIGITS,
                 SHORT_SENTENCES if summary else 0, DETAILED_SENTENCES)
    added = [c for given, names in ((summary, ["short_summary", "detailed_summary"]), (tags, ["tags"]), (insights, ["key_insights"]))
             if given for c in names]
    return out.select("article_id", *keep, *added, F.lit("extractive").alias("provider"), F.lit(True).alias("parsed"))


def extractive_summaries(articles: DataFrame, corpus: DataFrame | None = None) -> DataFrame:
    """Z2 default provider, all on Spark."""
    sents = with_sentences(articles.select("article_id", *EDITION, "content"))
    csents = None if corpus is None else with_text_only(corpus.select("article_id", *EDITION, "content"))
    return summaries_from_sentences(sents, csents)


# --------------------------------------------------------------------------- provider hook
Provider = Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]


def call_provider(prompts: DataFrame, provider: Provider, parallelism: int | None = None) -> DataFrame:
    """Run a model client over prompts with mapInPandas. `provider` maps batches of
    (article_id, system, prompt) to batches of (article_id, response); a failed call
    returns no row for its article (P3). Parallelism = number of partitions."""
    df = prompts.select("article_id", "system", "prompt")
    if parallelism:
        df = df.repartition(parallelism)
    return df.mapInPandas(provider, "article_id string, response string")


def summarize(articles: DataFrame, responses: DataFrame | None = None,
              corpus: DataFrame | None = None) -> DataFrame:
    """Summaries for the given (already capped) articles: parsed model responses when
    a responses table is given, else the extractive provider."""
    if responses is not None:
        return parse_responses(responses.join(articles.select("article_id"), "article_id", "left_semi"))
    return extractive_summaries(articles, corpus)


def pairs(articles: DataFrame, summaries: DataFrame) -> DataFrame:
    """Article ⨝ summary on article_id (inner: failed summaries drop out)."""
    return articles.join(summaries, "article_id")


def publish_records(paired: DataFrame) -> DataFrame:
    """Nested {'article', 'summary'} records with the article date as ISO text."""
    return paired.select(
        "article_id", *EDITION,
        F.struct("title", "source_name", "source_url", "author",
                 F.date_format("date", "yyyy-MM-dd'T'HH:mm:ss").alias("date")).alias("article"),
        F.struct("short_summary", "detailed_summary", "key_insights", "tags").alias("summary"))
