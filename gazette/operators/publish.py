"""Published rows and sinks.

`published(niche, run_date, kind, path, body)` holds what the Markdown channel writes;
files are rows, so the same job writes every edition. Partitions are those of one run:
a retry replaces its own rows and another run of the day adds its rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from gazette import config as C
from gazette.functions.dates import day_text, long_date_time
from gazette.functions.text import article_slug, path_stem, relative_to, safe_filename
from gazette.operators.select import EDITION

OUTPUT_DIR = "output"
SITE_TITLE = "News Digest - Index"


def newsletter_rows(rendered: DataFrame, run_ts_col: str = "run_ts", output_dir: str = OUTPUT_DIR) -> DataFrame:
    """K1: '<date>-<niche>-digest.md' (sanitised) in the output folder."""
    name = F.concat(safe_filename(F.concat(day_text(run_ts_col), F.lit("-"), F.col("niche"), F.lit("-digest"))), F.lit(".md"))
    return rendered.select(*EDITION, F.lit("newsletter").alias("kind"),
                           F.concat(F.lit(output_dir + "/"), name).alias("path"), F.col("body"))


def article_rows(pages: DataFrame, run_ts_col: str = "run_ts", output_dir: str = OUTPUT_DIR,
                 k: int = C.PUBLISHED_ARTICLE_PAGES) -> DataFrame:
    """K2: article pages of the first 5 pairs, in a folder per niche; equal file names
    overwrite, so the last article written under a name is the one kept."""
    x = pages.filter(F.col("rn") <= k).select(
        *EDITION, "rn", F.lit("article").alias("kind"),
        F.concat(F.lit(output_dir + "/articles/"), safe_filename("niche"), F.lit("/"), article_slug(day_text(run_ts_col), F.col("title"))).alias("path"),
        F.col("page").alias("body"))
    w = Window.partitionBy(*EDITION, "path").orderBy(F.col("rn").desc())
    return x.withColumn("_k", F.row_number().over(w)).filter("_k = 1").drop("_k", "rn")


def index_rows(published: DataFrame, run_ts_col: str = "run_ts", output_dir: str = OUTPUT_DIR,
               title: str = SITE_TITLE, articles: int = C.INDEX_ARTICLES) -> DataFrame:
    """Per edition, newsletters by path descending, then the first 20 article
    paths descending; each line '- [stem](relative path)'. One index file per niche."""
    p = published.filter(F.col("kind").isin("newsletter", "article")).withColumn(
        "is_article", F.array_contains(F.split("path", "/"), "articles"))
    p = p.withColumn("line", F.concat(F.lit("- ["), path_stem("path"), F.lit("]("),
                                      relative_to(F.col("path"), output_dir), F.lit(")\n")))
    w = Window.partitionBy(*EDITION, "is_article").orderBy(F.col("path").desc())
    p = p.withColumn("r", F.row_number().over(w)).filter(~F.col("is_article") | (F.col("r") <= articles))

    def section(is_art):
        return F.array_join(F.transform(F.array_sort(F.collect_list(
            F.when(F.col("is_article") == is_art, F.struct("r", "line")))), lambda x: x["line"]), "")
    g = p.groupBy(*EDITION, run_ts_col).agg(section(False).alias("news"), section(True).alias("arts"))
    body = F.concat(
        F.lit(f"# {title}\n\n*Last updated: "), long_date_time(run_ts_col), F.lit("*\n\n"),
        F.when(F.col("news") != "", F.concat(F.lit("## Newsletters\n\n"), F.col("news"), F.lit("\n"))).otherwise(F.lit("")),
        F.when(F.col("arts") != "", F.concat(F.lit("## Individual Articles\n\n"), F.col("arts"), F.lit("\n"))).otherwise(F.lit("")))
    return g.select(*EDITION, F.lit("index").alias("kind"), F.concat(F.lit(output_dir + "/index-"), safe_filename("niche"), F.lit(".md")).alias("path"), body.alias("body"))


def latest_rows(published: DataFrame, output_dir: str = OUTPUT_DIR) -> DataFrame:
    """K3: per niche, the newsletter of the latest run date, of that day's last run (max_by, no sort)."""
    n = published.filter(F.col("kind") == "newsletter")
    last = F.struct("run_date", *[c for c in ("run",) if c in n.columns], "path")
    return n.groupBy("niche").agg(F.max_by(F.struct("run_date", "path", "body"), last).alias("m")).select(
        "niche", F.col("m.run_date").alias("run_date"), F.lit("latest").alias("kind"),
        F.concat(F.lit(output_dir + "/latest-"), safe_filename("niche"), F.lit(".md")).alias("path"),
        F.col("m.path").alias("target"), F.col("m.body").alias("body"))


def site_routing(published: DataFrame) -> DataFrame:
    """K7: a path with an 'articles' part goes to content/articles/<niche>/, anything else
    to content/newsletters/; the newsletter of a niche's last run date also becomes
    content/newsletters/latest-<niche>.md (L12: only newsletters, not the index)."""
    name = F.element_at(F.split("path", "/"), -1)
    is_art = F.array_contains(F.split("path", "/"), "articles")
    routed = published.select(*EDITION, "kind", F.col("path").alias("source_path"),
                              F.when(is_art, F.concat(F.lit("content/articles/"), safe_filename("niche"), F.lit("/"), name))
                              .otherwise(F.concat(F.lit("content/newsletters/"), name)).alias("dest_path"))
    latest = (published.filter(F.col("kind") == "newsletter").groupBy("niche", "kind")
              .agg(F.max(F.struct("run_date", "path")).alias("m"))
              .select("niche", "m.run_date", "kind", F.col("m.path").alias("source_path"),
                      F.concat(F.lit("content/newsletters/latest-"), safe_filename("niche"), F.lit(".md")).alias("dest_path")))
    return routed.unionByName(latest)


def error_report_lines(errors: DataFrame, run_ts_col: str = "run_ts", generator: str = "gazette") -> DataFrame:
    """K9 as lines: per edition with errors a title, an opening line and a closing line
    (from a count), and one bullet row per error — no edition is gathered into one row;
    the issue writer emits bullets ordered by `seq`."""
    head = errors.groupBy(*EDITION, run_ts_col).agg(F.count("*").alias("n_errors"))
    fixed = head.select(*EDITION, "n_errors", F.explode(F.array(
        F.struct(F.lit("title").alias("part"), F.concat(F.lit("Newsletter Generation Errors - "),
                                                         day_text(run_ts_col)).alias("text")),
        F.struct(F.lit("opening").alias("part"),
                 F.lit("The following errors were encountered during newsletter generation:").alias("text")),
        F.struct(F.lit("closing").alias("part"),
                 F.lit(f"*This issue was automatically created by {generator}*").alias("text")))).alias("l"))
    fixed = fixed.select(*EDITION, "l.part", "l.text", F.lit(None).cast("string").alias("seq"))
    bullets = errors.select(*EDITION, F.lit("bullet").alias("part"),
                            F.concat(F.lit("- "), F.col("error")).alias("text"), F.col("seq").cast("string"))
    return fixed.unionByName(bullets)


def error_report(errors: DataFrame, run_ts_col: str = "run_ts", generator: str = "gazette") -> DataFrame:
    """K9: one report body per edition with errors (none without), bullets in error
    order. For run-level errors (few per run); per-item failures use the line form."""
    g = errors.groupBy(*EDITION, run_ts_col).agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("seq", "error"))),
                                 lambda x: F.concat(F.lit("- "), x["error"], F.lit("\n"))), "").alias("lines"),
        F.count("*").alias("n_errors"))
    return g.select(*EDITION, "n_errors",
                    F.concat(F.lit("Newsletter Generation Errors - "), day_text(run_ts_col)).alias("title"),
                    F.concat(F.lit("The following errors were encountered during newsletter generation:\n\n"),
                             F.col("lines"), F.lit(f"\n*This issue was automatically created by {generator}*")).alias("body"))


def write_published(published: DataFrame, path: str, run: str = "run", fmt: str = "parquet") -> None:
    """K1 sink: partitioned by niche, run date and run; a retry of a run replaces only its
    own partitions."""
    (published.withColumn("run", F.lit(run)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("niche", "run_date", "run").format(fmt).save(path))


def current_files(published: DataFrame, runs: DataFrame | None = None) -> DataFrame:
    """The files as they stand after all runs: of equal paths of an edition the last run's
    body (equal names overwrite, other files stay). With the ledger's `runs` only
    committed ones count. Run names begin with the padded run number, so the greatest name is the last run."""
    if runs is not None:
        from gazette.streaming.ledger import visible
        published = visible(published, runs)
    last = published.groupBy(*EDITION, "path").agg(F.max_by(F.struct("kind", "body", "run"), "run").alias("f"))
    return last.select(*EDITION, "f.kind", "path", "f.body", "f.run")


def for_enabled_channels(rows: DataFrame, channels: DataFrame, n_channels: int = 3,
                         channel_col: str = "channel") -> DataFrame:
    """Keep the rows of enabled channels (markdown on by default, social and site
    off; preview turns both off). The channels dimension is configuration (checked size)."""
    from gazette.sources.config_dim import broadcast_checked
    on = channels.filter(F.col("enabled")).select(F.col("channel").alias(channel_col))
    return rows.join(broadcast_checked(on, n_channels), channel_col, "left_semi")
