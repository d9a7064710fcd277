"""URL filters: association rules mined with Spark's FP-growth, and fixed host and path rules.

URLs become sets of tokens (host parts, path segments, query keys, ...). FP-growth finds the
frequent combinations of tokens among labelled URLs; those that go with the label `block`
often enough become rules. Rules are matched through an inverted index: each rule hangs
under its rarest token, and only URLs with that token are tested for the others.
"""

from __future__ import annotations

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame, functions as F

from gazette.session import materialize

#: Least share of the labelled URLs that a mined combination covers; it bounds the number
#: of frequent tokens, so also that of the rules.
MIN_SUPPORT = 0.005
MIN_CONFIDENCE = 0.6
BLOCK = "label:block"
#: Fixed rules: (verdict, host and path).
RULES = (("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"), ("allow", "com/fr/"), ("block", "com/de/"))
_AZ = ("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def url_host(url: Column) -> Column:
    """After the first `://` up to `/`, `?`, `#` or the end, A-Z lower-cased; else empty."""
    return F.coalesce(F.translate(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), *_AZ), F.lit(""))


def url_path(url: Column) -> Column:
    """After the host up to `?`, `#` or the end; empty without `://`."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def url_tokens(url: Column) -> Column:
    """Distinct tokens of a URL: scheme, host parts from the right, path segments (numbers
    as their length), extension, query keys, fragment."""
    host, path = url_host(url), url_path(url)
    query = F.coalesce(F.regexp_extract(url, r"(?s)^[^?#]*\?([^#]*)", 1), F.lit(""))
    parts = F.filter(F.split(host, r"\."), lambda x: x != "")
    named = F.transform(F.reverse(parts), lambda x, i: F.concat(F.lit("host"), i.cast("string"), F.lit(":"), x))
    segment = lambda x: F.concat(F.lit("path:"), F.when(F.regexp_like(x, F.lit(r"^[0-9]+(\.|$)")), F.concat(F.lit("#"), F.length(F.regexp_extract(x, "^[0-9]+", 0)).cast("string"))).otherwise(F.regexp_replace(x, r"\.[A-Za-z0-9]+$", "")))
    segments = F.transform(F.filter(F.split(path, "/"), lambda x: x != ""), segment)
    extension = F.regexp_extract(path, r"\.([A-Za-z0-9]+)$", 1)
    keys = F.transform(F.filter(F.split(query, "&"), lambda x: x != ""), lambda x: F.concat(F.lit("key:"), F.split(x, "=")[0]))
    one = lambda name, value: F.when(value != "", F.array(F.concat(F.lit(name), value))).otherwise(F.array().cast("array<string>"))
    scheme = F.coalesce(F.translate(F.regexp_extract(url, r"^([A-Za-z][A-Za-z0-9+.-]*)://", 1), *_AZ), F.lit(""))
    fragment = F.coalesce(F.regexp_extract(url, r"(?s)#(.*)$", 1), F.lit(""))
    return F.array_distinct(F.concat(one("scheme:", scheme), named, segments, one("ext:", extension), keys, one("frag:", fragment)))


def mine_rules(labelled: DataFrame, url: str = "url", blocked: str = "blocked", min_support: float = MIN_SUPPORT,
               min_confidence: float = MIN_CONFIDENCE) -> DataFrame:
    """(rule_id, tokens, anchor, confidence, support): token combinations of which at least
    min_confidence of the labelled URLs are blocked. A combination that one with a token
    less already covers with the same confidence or more is pruned. Null labels are left
    out; without labelled URLs there are no rules."""
    spark = labelled.sparkSession
    t = labelled.filter(F.col(f"`{blocked}`").isNotNull()).select(F.array_union(url_tokens(F.col(f"`{url}`")), F.when(F.col(f"`{blocked}`"), F.array(F.lit(BLOCK))).otherwise(F.array().cast("array<string>"))).alias("items"))
    t = materialize(t.filter(F.size("items") > 0), "url-items")
    empty = spark.createDataFrame([], "rule_id string, tokens array<string>, anchor string, confidence double, support bigint")
    if t.isEmpty():
        return empty
    sets = FPGrowth(itemsCol="items", minSupport=min_support).fit(t).freqItemsets
    sets = materialize(sets.select(F.array_sort("items").alias("items"), F.col("freq").alias("n")), "url-itemsets")
    plain = sets.filter(~F.array_contains("items", BLOCK))
    with_label = sets.filter(F.array_contains("items", BLOCK) & (F.size("items") > 1)).select(F.array_remove("items", BLOCK).alias("items"), F.col("n").alias("hits"))
    rules = with_label.join(plain, "items").withColumn("confidence", F.col("hits") / F.col("n"))
    less = rules.select(F.col("items").alias("whole"), F.explode(F.transform("items", lambda x: F.array_remove("items", x))).alias("items"))
    covered = (less.join(rules.select("items", F.col("confidence").alias("simpler")), "items").groupBy(F.col("whole").alias("items")).agg(F.max("simpler").alias("simpler")))
    rules = rules.join(covered, "items", "left").filter((F.col("confidence") >= min_confidence) & (F.col("simpler").isNull() | (F.col("simpler") < F.col("confidence"))))
    single = plain.filter(F.size("items") == 1).select(F.col("items")[0].alias("token"), F.col("n").alias("token_n"))
    anchors = (rules.select("items", F.explode("items").alias("token")).join(single, "token")
               .groupBy("items").agg(F.min(F.struct("token_n", "token")).alias("a")))
    return rules.join(anchors, "items").select(F.concat_ws(" ", "items").alias("rule_id"), F.col("items").alias("tokens"),
                                               F.col("a.token").alias("anchor"), "confidence", F.col("hits").alias("support"))


def fixed_rule(host: Column, path: Column, rules=RULES) -> Column:
    """(verdict, rule) of the longest rule that fits the host or a domain above it and the
    start of the path; null if none does."""
    ordered = sorted(rules, key=lambda r: -len(r[1]))
    out = F.lit(None).cast("struct<verdict:string,rule:string>")
    for verdict, rule in reversed(ordered):
        h, p = rule.split("/", 1)
        fits = ((host == h) | F.endswith(host, F.lit("." + h))) & F.startswith(path, F.lit("/" + p))
        out = F.when(fits, F.struct(F.lit(verdict).alias("verdict"), F.lit(rule).alias("rule"))).otherwise(out)
    return out


def judge_urls(pages: DataFrame, labelled: DataFrame, id_col: str = "page_id", url: str = "url", blocked: str = "blocked",
               rules=RULES, min_support: float = MIN_SUPPORT, min_confidence: float = MIN_CONFIDENCE) -> DataFrame:
    """(id, host, path, rule, verdict, mined_rule, confidence) for every row of `pages`.

    A fixed rule decides where one fits; else the URL is blocked if a mined rule matches it,
    and allowed if none does. mined_rule is the matching rule with the largest confidence
    (ties: larger support, then code-point order). Null URLs and those without `://` have
    an empty host and path, fit no fixed rule, and are judged by their tokens. Repeated
    rows are judged each. An empty table gives no rows.
    """
    mined = materialize(mine_rules(labelled, url, blocked, min_support, min_confidence), "url-rules")
    u = F.col(f"`{url}`")
    tokens = pages.select(u.alias("url")).filter("url IS NOT NULL").distinct().withColumn("tokens", url_tokens(F.col("url")))
    hits = (tokens.select("url", "tokens", F.explode("tokens").alias("anchor"))
            .join(mined.withColumnRenamed("tokens", "needed"), "anchor").filter(F.size(F.array_except("needed", "tokens")) == 0))
    order = F.struct("confidence", "support", F.col("rule_id"))
    best = hits.groupBy(F.col("url").alias("_url")).agg(F.max(order).alias("best"))
    best = best.select("_url", F.col("best.rule_id").alias("mined_rule"), F.col("best.confidence").alias("confidence"))
    out = pages.select(F.col(f"`{id_col}`"), u.alias("_u")).withColumn("host", url_host(F.col("_u"))).withColumn("path", url_path(F.col("_u")))
    out = out.withColumn("_fixed", fixed_rule(F.col("host"), F.col("path"), rules)).join(best, F.col("_u") == F.col("_url"), "left")
    method = F.when(F.col("mined_rule").isNotNull(), "block").otherwise("allow")
    return out.select(F.col(f"`{id_col}`"), "host", "path", F.col("_fixed.rule").alias("rule"),
                      F.coalesce(F.col("_fixed.verdict"), method).alias("verdict"), "mined_rule", "confidence")
