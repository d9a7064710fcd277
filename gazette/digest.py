"""One digest run as a batch job (entry point A): articles from any sources → dedup
against the seen state → run cap → summaries → editions → published rows, seen state
and metrics. Every edition present in the articles is built at once."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession, functions as F

from gazette import config as C
from gazette.operators import dedup as D
from gazette.operators import edition as E
from gazette.operators import metrics as M
from gazette.operators import publish as PB
from gazette.operators import render as R
from gazette.operators import select as S
from gazette.operators import social as SO
from gazette.operators import summarize as Z
from gazette.session import materialize
from gazette.sources.documents import run_ts_lit
from gazette.streaming import ledger as L
from gazette.streaming.runs import seen_table, write_seen


def run_digest(articles: DataFrame, out_path: str, seen_path: str, run_ts: _dt.datetime = C.DEFAULT_RUN_TS,
               run_cap: int = C.DEFAULT_RUN_CAP, responses: DataFrame | None = None,
               ttl_days: int = C.SEEN_TTL_DAYS, mark: str = "ingested", channels: dict | None = None,
               newsletter_url: str | None = None, layout: str = "plain", metadata: dict | None = None) -> DataFrame:
    """Build and write every edition of `articles` (canonical article rows, e.g. a
    union of web, feed and document articles). Returns the run metrics per edition.

    Everything a run writes becomes visible together, when the ledger gets its row at the end
    (K5: the seen state with the editions it stands for): the published files of the Markdown channel
    (`publish.current_files` has the last body of every path, K1), and next to them
    `-posts` (K8, channel social), `-routes` (K7, channel site) and `-metrics` (K6). `channels` maps
    names to on or off (default: Markdown only, P9); `layout` is 'plain' (F30) or 'full' (F31, with its
    `metadata`). A run repeated after a crash
    starts anew; repeated after success it finds its articles seen, so another run with the same
    run_ts adds what has landed since. mark='ingested' records every new article, also
    those cut by the cap (L1); 'summarized' records only the articles of the editions."""
    if mark not in ("ingested", "summarized"):
        raise ValueError("mark is 'ingested' or 'summarized'")
    if layout not in ("plain", "full"):
        raise ValueError("layout is 'plain' or 'full'")
    if run_cap is None or run_cap <= 0:
        raise ValueError("a digest run needs a positive run cap (max_articles_per_run)")
    on = {"markdown": True, "social": False, "site": False} | (channels or {})
    spark = articles.sparkSession
    start = _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None)
    run = L.begin(spark, out_path, run_ts)
    seen = seen_table(spark, seen_path, run_ts, ttl_days, runs=L.committed(spark, out_path))
    fresh = D.deduplicate(articles, seen, run_ts, ttl_days)
    fresh = materialize(fresh, "run-articles")                      # scraped (after dedup)
    capped = D.first_capped(fresh, run_cap)
    if responses is None:
        paired = Z.pairs(capped, Z.extractive_summaries(capped))
    else:
        paired = Z.pairs(capped, Z.summarize(capped, responses))
    paired = materialize(paired.withColumn("run_ts", run_ts_lit(run_ts)), "run-pairs")
    editions = materialize(E.assemble(paired).withColumn("run_ts", run_ts_lit(run_ts)), "run-editions")
    letters = R.newsletter_plain(editions, paired) if layout == "plain" else R.newsletter_full(editions, paired, metadata)
    files = PB.newsletter_rows(letters).unionByName(
        PB.article_rows(R.article_page(paired)))
    files = materialize(files if on["markdown"] else files.limit(0), "run-files")
    index = PB.index_rows(files.join(editions.select(*S.EDITION, "run_ts"), list(S.EDITION)))
    published = materialize(files.unionByName(index), "run-published")
    PB.write_published(published, out_path, run.name)
    if on["social"]:
        _write_side(SO.thread_posts(editions, newsletter_url), out_path, "posts", run)
    if on["site"]:
        _write_side(PB.site_routing(published), out_path, "routes", run)
    accepted = fresh if mark == "ingested" else paired.select("article_id", "title")
    write_seen(D.seen_update(accepted, None, run_ts), seen_path, run.name)
    end = _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None)
    metrics = materialize(M.run_metrics(fresh, paired, published, start, end), "run-metrics")
    _write_side(metrics, out_path, "metrics", run)
    L.commit(spark, out_path, run)
    return metrics


def _write_side(rows: DataFrame, out_path: str, what: str, run: L.Run) -> None:
    (rows.withColumn("run", F.lit(run.name)).write.mode("append").partitionBy("run")
     .parquet(L.side_path(out_path, what)))


def digest_from_config(spark: SparkSession, cfg: C.RunConfig, landed: str, out_path: str, seen_path: str) -> DataFrame:
    """Entry point A from a configuration: its sources' landed items become articles, and all
    outputs of its channels are written. `landed` is the table that `sources/landed.py` writes, by
    kind and source, so kinds and sources that are not configured are not read."""
    from gazette.sources.landed import articles_from_config
    arts = articles_from_config(spark, cfg, landed)
    channels = {name: bool(on) and not (cfg.preview and name != "markdown") for name, on in cfg.channels}
    return run_digest(arts, out_path, seen_path, cfg.run_ts, cfg.run_cap, ttl_days=cfg.ttl_days,
                      channels=channels, newsletter_url=cfg.newsletter_url)
