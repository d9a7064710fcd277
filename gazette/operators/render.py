"""Markdown rendering as column expressions.

Each document is one `concat` over an edition row plus an ordered, bounded list of
article sections (at most the run cap per edition).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from gazette.functions.dates import iso_text, long_date, long_date_time
from gazette.functions.text import nonblank
from gazette.operators.select import EDITION

GENERATOR = "gazette"   # name printed in footers


def _s(c) -> Column:
    return F.coalesce(F.col(c) if isinstance(c, str) else c, F.lit(""))


def _opt(cond: Column, *parts) -> Column:
    """A block only when its value is present."""
    return F.when(cond, F.concat(*parts)).otherwise(F.lit(""))


def _bullets(arr, prefix: str = "- ") -> Column:
    return F.array_join(F.transform(arr, lambda x: F.concat(F.lit(prefix), x, F.lit("\n"))), "")


# Fixed value layouts below (section headings, labels and separators).
def article_section(title="title", source_name="source_name", source_url="source_url", author="author",
                    date_text="date_text", short_summary="short_summary", key_insights="key_insights",
                    tags="tags") -> Column:
    """one article block."""
    ki, tg = F.col(key_insights), F.col(tags)
    return F.concat(
        F.lit("### "), _s(title), F.lit("\n\n"),
        F.lit("**Source:** ["), _s(source_name), F.lit("]("), _s(source_url), F.lit(")\n"),
        _opt(nonblank(author), F.lit("**Author:** "), F.col(author), F.lit("\n")),
        _opt(nonblank(date_text), F.lit("**Date:** "), F.col(date_text), F.lit("\n")),
        F.lit("\n**Summary:** "), _s(short_summary), F.lit("\n\n"),
        _opt(F.coalesce(F.size(ki), F.lit(0)) > 0, F.lit("**Key Insights:**\n"), _bullets(ki), F.lit("\n")),
        _opt(F.coalesce(F.size(tg), F.lit(0)) > 0, F.lit("**Tags:** "), F.array_join(tg, ", "), F.lit("\n")),
        F.lit("\n---\n\n"))


def with_sections(paired: DataFrame) -> DataFrame:
    """Pairs with their article date as ISO text (P1) and their F29 block."""
    p = paired if "date_text_iso" in paired.columns else paired.withColumn("date_text_iso", iso_text("date"))
    return p.withColumn("section", article_section(date_text="date_text_iso"))


def _require_cap(paired: DataFrame) -> None:
    if "rn" not in paired.columns:
        raise ValueError("rendering lists every article of an edition: give pairs numbered by a "
                         "run cap (max_articles_per_run), so that each edition stays bounded")


def edition_sections(paired: DataFrame) -> DataFrame:
    """All article blocks of an edition in order (A10: ordered listagg, bounded by the cap)."""
    _require_cap(paired)
    p = with_sections(paired)
    return p.groupBy(*EDITION).agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("rn", "section"))), lambda x: x["section"]), "")
        .alias("all_sections"),
        F.count("*").alias("n_articles"))


def _stories(arr: Column, numbered_heading: str, points_label: str) -> Column:
    def one(s, i):
        return F.concat(
            F.lit(numbered_heading), (i + 1).cast("string"), F.lit(". "), _s(s["title"]), F.lit("\n\n"),
            F.lit("**Source:** ["), _s(s["source"]), F.lit("]("), _s(s["url"]), F.lit(")\n\n"),
            _s(s["summary"]), F.lit("\n\n"),
            _opt(F.size(s["key_insights"]) > 0, F.lit(points_label), _bullets(s["key_insights"]), F.lit("\n")))
    return F.array_join(F.transform(arr, one), "")


def _plain_head(run_ts_col: str) -> Column:
    """F30 up to the articles, from an edition row."""
    return F.concat(
        F.lit("# "), _s("title"), F.lit("\n\n"),
        F.lit("*Generated on "), long_date(run_ts_col), F.lit("*\n\n"),
        F.lit("## Table of Contents\n\n1. [Introduction](#introduction)\n2. [Top Stories](#top-stories)\n"
              "3. [Trends](#trends)\n4. [Insights & Analysis](#insights--analysis)\n5. [All Articles](#all-articles)\n\n"),
        F.lit("## Introduction\n\n"), _s("introduction"), F.lit("\n\n"),
        F.lit("## Top Stories\n\n"), _stories(F.col("top_stories"), "### ", "**Key Points:**\n"),
        _opt(F.size("trends") > 0, F.lit("## Trends\n\n"), _bullets(F.col("trends")), F.lit("\n")),
        F.lit("## Insights & Analysis\n\n"), _s("insights"), F.lit("\n\n"))


def _plain_foot(generator: str) -> Column:
    return F.lit(f"---\n\n*This newsletter was generated automatically by {generator}.*\n")


def newsletter_plain(editions: DataFrame, paired: DataFrame, run_ts_col: str = "run_ts",
                     generator: str = GENERATOR) -> DataFrame:
    """heading, date, contents, introduction, top stories (W4 numbering), trends,
    insights, all articles, footer. One string per edition, so `paired` is a capped run;
    newsletter_parts is the same for editions of any size."""
    e = editions.join(edition_sections(paired), list(EDITION), "left")
    body = F.concat(
        _plain_head(run_ts_col),
        _opt(F.coalesce(F.col("n_articles"), F.lit(0)) > 0, F.lit("## All Articles\n\n"), _s("all_sections")),
        _plain_foot(generator))
    return e.withColumn("body", body)


def newsletter_parts(editions: DataFrame, numbered: DataFrame, run_ts_col: str = "run_ts",
                     generator: str = GENERATOR) -> DataFrame:
    """F30 for editions without a cap: (edition, part_no, block), the newsletter of an edition
    being its blocks in the order of part_no. Part 0 is everything before the articles, part rn
    an article's block, the last part the footer. `numbered` comes from number_editions;
    no edition meets in one task, and no text is shuffled here. Null titles, summaries and
    lists render as empty, as in newsletter_plain; an edition without articles has two parts."""
    count = numbered.groupBy(*EDITION).agg(F.count("*").alias("_n"))
    e = editions.join(count, list(EDITION), "left").withColumn("_n", F.coalesce("_n", F.lit(0)))
    head = e.select(*EDITION, F.lit(0).cast("bigint").alias("part_no"), F.concat(
        _plain_head(run_ts_col), F.when(F.col("_n") > 0, F.lit("## All Articles\n\n")).otherwise(F.lit(""))).alias("block"))
    foot = e.select(*EDITION, (F.col("_n") + 1).alias("part_no"), _plain_foot(generator).alias("block"))
    articles = with_sections(numbered).select(*EDITION, F.col("rn").cast("bigint").alias("part_no"), F.col("section").alias("block"))
    return head.unionByName(articles).unionByName(foot)


def write_parts(parts: DataFrame, path: str) -> None:
    """The blocks as text files in order: within an edition's folder, file names and the lines of a
    file follow part_no, so the files one after another are the newsletter. Every block ends
    in a line end, which the writer puts there."""
    keys = [*EDITION, "part_no"]
    (parts.repartitionByRange(*keys).sortWithinPartitions(*keys)
     .select(*EDITION, F.substring("block", F.lit(1), F.length("block") - 1).alias("block"))
     .write.mode("errorifexists").partitionBy(*EDITION).option("lineSep", "\n").text(path))


#: Contents of the long layout: its sections with the anchors that Markdown gives headings.
_FULL_SECTIONS = ("Today's Highlights", "Top Stories", "Trending Topics", "Industry Insights", "Quick Reads", "About This Newsletter")
_FULL_CONTENTS = "## Table of Contents\n\n" + "".join(
    f"{i}. [{h}](#{h.lower().replace(chr(39), '').replace(' ', '-')})\n" for i, h in enumerate(_FULL_SECTIONS, 1)) + "\n---\n\n"


def newsletter_full(editions: DataFrame, paired: DataFrame, metadata: dict | None = None,
                    run_ts_col: str = "run_ts", generator: str = GENERATOR) -> DataFrame:
    """the long layout (contents, highlights, stories, trending topics, insights, quick reads
    O5, statistics A7-A9, every article, about). Metadata defaults through F36; social
    links are a map rendered with title-cased names (F37, F38)."""
    md = dict(metadata or {})
    _require_cap(paired)
    p = with_sections(paired)
    quick = (p.filter(F.col("rn").between(6, 10))
             .withColumn("q", F.concat(F.lit("\n**["), _s("title"), F.lit("]("), _s("source_url"), F.lit(")**  \n*"),
                                       _s("source_name"), F.lit("* • "), _s("short_summary"), F.lit("\n\n")))
             .groupBy(*EDITION).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("rn", "q"))),
                                                             lambda x: x["q"]), "").alias("quick")))
    details = (p.withColumn("d", F.concat(
        F.lit("\n<details>\n<summary><strong>"), _s("title"), F.lit("</strong> - "), _s("source_name"),
        F.lit("</summary>\n\n**URL:** ["), _s("source_url"), F.lit("]("), _s("source_url"), F.lit(")  \n"),
        _opt(nonblank("author"), F.lit("**Author:** "), F.col("author"), F.lit("  ")), F.lit("\n"),
        _opt(nonblank("date_text_iso"), F.lit("**Date:** "), F.col("date_text_iso"), F.lit("  ")), F.lit("\n\n"),
        F.lit("**Summary:** "), _s("short_summary"), F.lit("\n\n"),
        _opt(nonblank("detailed_summary"), F.lit("**Detailed Summary:**\n"), F.col("detailed_summary"), F.lit("\n\n")),
        _opt(F.size("key_insights") > 0, F.lit("**Key Insights:**\n"), _bullets(F.col("key_insights")), F.lit("\n")),
        _opt(F.size("tags") > 0, F.lit("**Tags:** "), F.array_join("tags", ", "), F.lit("\n")),
        F.lit("\n</details>\n\n")))
        .groupBy(*EDITION).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("rn", "d"))),
                                                        lambda x: x["d"]), "").alias("details")))
    e = editions.join(quick, list(EDITION), "left").join(details, list(EDITION), "left")
    issue = F.lit(str(md.get("issue_number", "1")))
    sources_count = F.coalesce(F.col("sources_count").cast("string"), F.lit("multiple"))
    social = md.get("social_links") or {}
    social_map = F.create_map(*[F.lit(x) for kv in social.items() for x in kv]) if social else None
    frequency = md.get("frequency", "daily")
    about_freq = (F.concat(F.lit("New issues are published daily at "), F.lit(md.get("publish_time", "9:00 AM")), F.lit(" UTC.\n"))
                  if frequency == "daily" else
                  F.concat(F.lit("New issues are published weekly, every "), F.lit(md.get("publish_day", "Monday")), F.lit(".\n")))
    links = (F.array_join(F.transform(F.map_entries(social_map), lambda kv: F.concat(
        F.lit("- ["), F.initcap(kv["key"]), F.lit("]("), kv["value"], F.lit(")\n"))), "") if social_map is not None else F.lit(""))
    body = F.concat(
        F.lit("# "), _s("title"), F.lit("\n\n*"), long_date(run_ts_col), F.lit(" • Issue #"), issue, F.lit("*\n\n---\n\n"),
        F.lit(_FULL_CONTENTS), F.lit("## Today's Highlights\n\n"), _s("introduction"), F.lit("\n\n**Today's Coverage:** "),
        F.col("articles_count").cast("string"), F.lit(" articles analyzed from "), sources_count, F.lit(" sources\n\n---\n\n"),
        F.lit("## Top Stories\n\n"), F.array_join(F.transform("top_stories", lambda s, i: F.concat(
            F.lit("### "), (i + 1).cast("string"), F.lit(". "), _s(s["title"]), F.lit("\n\n*Source: ["), _s(s["source"]),
            F.lit("]("), _s(s["url"]), F.lit(")*\n\n"), _s(s["summary"]), F.lit("\n\n"),
            _opt(F.size(s["key_insights"]) > 0, F.lit("**Key Takeaways:**\n"), _bullets(s["key_insights"]), F.lit("\n")),
            F.lit("[Read full article →]("), _s(s["url"]), F.lit(")\n\n---\n"))), ""),
        F.lit("\n## Trending Topics\n\n"),
        F.when(F.size("trends") > 0, F.concat(
            F.lit("Today's analysis reveals these emerging trends in the "), F.col("niche"), F.lit(" industry:\n\n"),
            F.array_join(F.transform("trends", lambda t: F.concat(F.lit("- **"), t, F.lit("**\n"))), "")))
         .otherwise(F.lit("*No significant trends detected in today's coverage.*\n")),
        F.lit("\n---\n\n## Industry Insights\n\n"), _s("insights"), F.lit("\n\n---\n\n"),
        F.lit("## Quick Reads\n\n*More stories from today's "), F.col("niche"), F.lit(" news:*\n"), _s("quick"),
        F.lit("\n---\n\n## Today's Statistics\n\n- **Articles Analyzed:** "), F.col("articles_count").cast("string"),
        F.lit("\n- **Top Sources:** "), F.array_join(F.slice("top_sources", 1, 3), ", "),
        F.lit("\n- **Most Common Topics:** "), F.array_join(F.slice("top_tags", 1, 5), ", "),
        F.lit("\n\n---\n\n## Browse All Articles\n"), _s("details"),
        F.lit("\n---\n\n## About This Newsletter\n\nThis "), F.col("niche"),
        F.lit(" news digest is generated automatically from the latest articles of its sources.\n\n"
              "### Update Frequency\n"), about_freq,
        F.lit("\n### Subscribe\n"),
        F.lit(f"[Subscribe to receive updates]({md['subscribe_url']})\n" if md.get("subscribe_url")
              else "Stay tuned for subscription options coming soon!\n"),
        F.lit("\n### Connect With Us\n"), links,
        F.lit("\n### Feedback\nHave suggestions or feedback? "),
        F.lit(f"Email us at [{md['feedback_email']}](mailto:{md['feedback_email']})" if md.get("feedback_email")
              else "We'd love to hear from you!"),
        F.lit("\n\n---\n\n*This newsletter was generated automatically by "), F.lit(generator), F.lit(" on "),
        long_date_time(run_ts_col), F.lit(" UTC.*\n"))
    return e.withColumn("body", body)


def article_page(paired: DataFrame, run_ts_col: str = "run_ts") -> DataFrame:
    """F32: heading, publication date, F29 block, detailed summary when present."""
    p = with_sections(paired)
    return p.withColumn("page", F.concat(
        F.lit("# "), _s("title"), F.lit("\n\n*Published on "), long_date(run_ts_col), F.lit("*\n\n"), F.col("section"),
        _opt(nonblank("detailed_summary"), F.lit("## Detailed Summary\n\n"), F.col("detailed_summary"), F.lit("\n\n"))))
