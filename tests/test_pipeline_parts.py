import datetime as dt
import tempfile

import pandas as pd
from pyspark.sql import functions as F

from gazette import config as C
from gazette.operators import dedup as D
from gazette.operators import publish as PB
from gazette.operators import summarize as Z
from gazette.sources import config_dim as CD
from gazette.sources import pages as P
from gazette.sources.documents import articles_from_documents
from tests.conftest import SF001

CFG = {"niche": "AI",
       "sources": {"rss_feeds": [{"url": "https://feeds.example.com/a.xml", "name": "Feed A", "max_articles": 3},
                                 {"url": "https://other.example.org:8443/f.xml"}],
                   "web_scraping": [{"url": "https://site.example.com/list", "name": "Site", "max_articles": 2,
                                     "selectors": {"articles": "ul.items li", "title": "h1.t", "content": "div.body",
                                                   "author": "//span[@class='by']", "date": "time"}}]},
       "publishing": {"markdown": {"enabled": True}, "twitter": {"enabled": True}, "github": {"enabled": True}}}


def test_config_dimensions(spark):
    cfg = C.run_config_from_dict(CFG)
    dim = {r.source_name: r for r in CD.sources_frame(spark, cfg).collect()}
    assert dim["Feed A"].max_articles == 3 and dim["Feed A"].kind_rank == 1
    assert dim["other.example.org:8443"].max_articles == 20            # name = netloc, default cap
    assert dim["Site"].max_articles == 2 and dim["Site"].kind_rank == 0
    rss_only = C.run_config_from_dict(CFG, sources="rss")
    sel = CD.select_kinds(CD.sources_frame(spark, rss_only), rss_only.source_kinds)
    assert {r.kind for r in sel.collect()} == {"rss"}
    ch = {r.channel: r.enabled for r in CD.channels_frame(spark, C.run_config_from_dict(CFG, preview=True)).collect()}
    assert ch == {"markdown": True, "social": False, "site": False}
    assert C.run_config_from_dict(CFG, niche="crypto").niche == "crypto"


LIST = """<html><body><ul class="items"><li><a href="/p/1">one</a></li><li><a href="p/2">two</a></li>
<li><a href="/p/3">three</a></li></ul></body></html>"""
ART = """<html><body><h1 class="t">Title {n}</h1><span class="by"> Ann </span><time datetime="2024-06-0{n}">June {n}, 2024</time>
<div class="body"><p>Body</p><p>of {n}</p></div></body></html>"""


def test_scrape_sources_links_to_pages(spark):
    cfg = C.run_config_from_dict(CFG)
    dim = CD.sources_frame(spark, cfg)
    pages = spark.createDataFrame(
        [(1, "https://site.example.com/list", LIST), (2, "https://site.example.com/p/1", ART.format(n=1)),
         (3, "https://site.example.com/p/2", ART.format(n=2)), (4, "https://site.example.com/p/3", ART.format(n=3))],
        "page_id long, url string, html string")
    arts = P.scrape_sources(dim, pages, niche="AI").orderBy("item_pos").collect()
    assert [(a.title, a.content, a.author, a.date, a.source_url, a.item_pos) for a in arts] == [
        ("Title 1", "Bodyof 1", "Ann", dt.datetime(2024, 6, 1), "https://site.example.com/p/1", 0),
        ("Title 2", "Bodyof 2", "Ann", dt.datetime(2024, 6, 2), "https://site.example.com/p/2", 1)]


def test_scrape_sources_repeated_links_and_pages(spark):
    """A link named twice gives one article per link, also where two sources share a listing
    or a page, and a page landed twice counts once, as landed last."""
    sel = {"articles": "ul li", "title": "h1.t", "content": "div.body"}
    other = {"articles": "ul li", "title": "span.by", "content": "div.body"}
    cfg = C.run_config_from_dict({"sources": {"web_scraping": [
        {"url": "https://s.example.com/l", "name": "A", "max_articles": 5, "selectors": sel},
        {"url": "https://s.example.com/l", "name": "B", "selectors": other}]}})
    listing = "<ul>" + "".join(f'<li><a href="/p/{n}">x</a></li>' for n in (1, 2, 1)) + "</ul>"
    pages = spark.createDataFrame(
        [(1, "https://s.example.com/l", "<ul><li><a href='/p/9'>old</a></li></ul>"), (2, "https://s.example.com/l", listing),
         (3, "https://s.example.com/p/1", ART.format(n=7)), (4, "https://s.example.com/p/2", ART.format(n=2)),
         (5, "https://s.example.com/p/1", ART.format(n=1)), (5, "https://s.example.com/p/1", ART.format(n=1)), (6, None, None)],
        "page_id long, url string, html string")
    arts = P.scrape_sources(CD.sources_frame(spark, cfg), pages).collect()
    assert sorted((a.source_name, a.item_pos, a.title) for a in arts) == [
        ("A", 0, "Title 1"), ("A", 1, "Title 2"), ("A", 2, "Title 1"), ("B", 0, "Ann"), ("B", 1, "Ann"), ("B", 2, "Ann")]


def test_web_articles_dates_and_repeated_pages(spark):
    pages = spark.createDataFrame([(1, "https://s.example.com/en/1", ART.format(n=1)), (1, "https://s.example.com/en/1", ART.format(n=1))],
                                  "page_id long, url string, html string")
    arts = P.web_articles(pages, {"title": "h1", "content": "div.body", "date": "time"}).collect()
    assert [(a.title, a.date) for a in arts] == [("Title 1", dt.datetime(2024, 6, 1))] * 2


def test_provider_hook_and_pairs(spark):
    arts = articles_from_documents(spark.read.parquet(f"{SF001}/documents.parquet")).limit(7)

    def provider(batches):
        for pdf in batches:
            yield pd.DataFrame({"article_id": pdf["article_id"],
                                "response": ['{"short_summary": "s", "tags": ["x"]}'] * len(pdf)})
    responses = Z.call_provider(Z.article_prompts(arts), provider, parallelism=2)
    summ = Z.summarize(arts, responses)
    paired = Z.pairs(arts, summ)
    assert paired.count() == 7 and {r.tags[0] for r in paired.collect()} == {"x"}
    rec = Z.publish_records(paired).first()
    assert rec.article.title and rec.summary.short_summary == "s"


def test_published_sink_overwrites_only_its_partition(spark):
    out = tempfile.mkdtemp(prefix="pub-")
    day1 = spark.createDataFrame([("AI", dt.date(2024, 6, 3), "newsletter", "p1", "v1"),
                                  ("AI", dt.date(2024, 6, 4), "newsletter", "p2", "v1")],
                                 "niche string, run_date date, kind string, path string, body string")
    PB.write_published(day1, out)
    rerun = spark.createDataFrame([("AI", dt.date(2024, 6, 4), "newsletter", "p2", "v2")],
                                  "niche string, run_date date, kind string, path string, body string")
    PB.write_published(rerun, out)
    got = {(r.run_date, r.body) for r in spark.read.parquet(out).collect()}
    assert got == {(dt.date(2024, 6, 3), "v1"), (dt.date(2024, 6, 4), "v2")}


def test_incremental_runs_keep_state(spark):
    from gazette.streaming.runs import start_incremental
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    land = tempfile.mkdtemp(prefix="land-")
    arts = articles_from_documents(docs, per_item_url=False).drop("date")
    arts.filter("item_pos < 100").write.mode("append").parquet(land)
    seen, out, ck = (tempfile.mkdtemp(prefix=p) for p in ("seen-", "out-", "ck-"))

    def build(fresh):
        return fresh.groupBy("niche", "run_date").agg(F.count("*").alias("n"))

    def run():
        stream = spark.readStream.schema(arts.schema).parquet(land)
        start_incremental(stream, seen, out, ck, C.DEFAULT_RUN_TS, build).awaitTermination()
    run()
    first = spark.read.parquet(seen).count()
    arts.filter("item_pos >= 100").write.mode("append").parquet(land)
    run()
    total = spark.read.parquet(seen).count()
    expect = D.deduplicate(arts).count()           # one batch over everything
    assert first > 0 and total == expect


def test_feed_files_and_extension_hooks(spark):
    import os
    from gazette import schemas
    from gazette.sources import feeds as FD
    d = tempfile.mkdtemp(prefix="feeds-")
    rss = ("<rss><channel><item><title>T1</title><link>http://x/1</link><description>d1</description></item>"
           "<item><title>T2</title><link>http://x/2</link><description>d2</description></item></channel></rss>")
    for name in ("a.xml", "b.xml"):
        with open(os.path.join(d, name), "w") as fh:
            fh.write(rss)
    raw = FD.read_feed_files(spark, d)
    arts = FD.entries_to_articles(FD.feed_entries(raw))
    assert arts.count() == 4 and {r.source_name for r in arts.collect()} == {""}   # file URLs have no host
    ok = schemas.custom_source(lambda s, c: arts, spark, {})
    assert ok.columns[0] == "article_id"
    import pytest
    with pytest.raises(ValueError):
        schemas.custom_source(lambda s, c: arts.drop("title"), spark, {})


def test_observed_counters(spark):
    from gazette.operators.metrics import observe_counts
    arts = articles_from_documents(spark.read.parquet(f"{SF001}/documents.parquet"))
    observed, obs = observe_counts(arts)
    observed.write.format("noop").mode("overwrite").save()      # counters ride along the write
    got = obs.get
    assert got["rows"] == arts.count() and got["editions_approx"] == arts.select("niche").distinct().count()


def test_enabled_channels(spark):
    rows = spark.createDataFrame([("markdown", "a.md"), ("social", "post 1"), ("site", "content/a.md")],
                                 "channel string, item string")
    full = CD.channels_frame(spark, C.run_config_from_dict(CFG))
    preview = CD.channels_frame(spark, C.run_config_from_dict(CFG, preview=True))
    assert {r.channel for r in PB.for_enabled_channels(rows, full).collect()} == {"markdown", "social", "site"}
    assert {r.channel for r in PB.for_enabled_channels(rows, preview).collect()} == {"markdown"}


def test_run_digest_end_to_end(spark):
    from gazette.digest import run_digest
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    arts = articles_from_documents(docs, per_item_url=False)
    out, seen = tempfile.mkdtemp(prefix="digest-out-"), tempfile.mkdtemp(prefix="digest-seen-")
    m = {r.niche: r for r in run_digest(arts, out, seen + "/state", run_cap=5).collect()}
    assert set(m) == {r.niche for r in arts.select("niche").distinct().collect()}
    assert all(r.articles_summarized <= 5 and r.files_published >= 2 for r in m.values())
    pub = spark.read.parquet(out)
    assert pub.filter("kind = 'newsletter'").count() == len(m) and pub.filter("kind = 'index'").count() == len(m)
    # a second run the same day: everything is seen now, nothing is scraped again
    again = run_digest(arts, out, seen + "/state", run_cap=5).collect()
    assert again == [] or all(r.articles_scraped == 0 for r in again)
    # a later run the same day with new articles keeps the earlier seen rows
    later = dt.datetime(2024, 6, 4, 18, 0)
    extra = articles_from_documents(docs, run_ts=later).limit(3)
    run_digest(extra, out, seen + "/state", run_ts=later, run_cap=5)
    assert spark.read.parquet(seen + "/state").count() == arts.dropDuplicates(["article_id"]).count() + 3


def test_run_digest_marks_summarized_only(spark):
    from gazette.digest import run_digest
    arts = articles_from_documents(spark.read.parquet(f"{SF001}/documents.parquet"))
    out, seen = tempfile.mkdtemp(prefix="digest-out-"), tempfile.mkdtemp(prefix="digest-seen-")
    m = run_digest(arts, out, seen + "/s", run_cap=3, mark="summarized").collect()
    assert spark.read.parquet(seen + "/s").count() == sum(r.articles_summarized for r in m)


def test_two_runs_a_day_keep_every_page(spark):
    from gazette.digest import run_digest
    from gazette.operators.publish import current_files
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    arts = articles_from_documents(docs)
    first = arts.filter("item_pos % 2 = 0")
    out, seen = tempfile.mkdtemp(prefix="digest-out-"), tempfile.mkdtemp(prefix="digest-seen-")
    run_digest(first, out, seen + "/s", run_cap=5)
    before = {(r.niche, r.path) for r in spark.read.parquet(out).select("niche", "path").collect()}
    later = dt.datetime(2024, 6, 4, 18, 0)
    run_digest(articles_from_documents(docs, run_ts=later).filter("item_pos % 2 = 1"), out, seen + "/s", run_ts=later, run_cap=5)
    files = current_files(spark.read.parquet(out))
    after = [(r.niche, r.path) for r in files.select("niche", "path").collect()]
    assert before < set(after) and len(after) == len(set(after))
    assert files.filter("kind = 'newsletter' AND run LIKE '%T09%'").count() == 0      # an equal name: the later body


def test_two_batches_publish_all_they_mark_seen(spark):
    from gazette.streaming.runs import make_batch_fn
    arts = articles_from_documents(spark.read.parquet(f"{SF001}/documents.parquet"))
    out, seen = tempfile.mkdtemp(prefix="runs-out-"), tempfile.mkdtemp(prefix="runs-seen-")
    run = make_batch_fn(seen + "/s", out, dt.datetime(2024, 6, 4, 9, 0), lambda a: a.select("niche", "run_date", "article_id"))
    run(arts.filter("item_pos < 40"), 0)
    run(arts.filter("item_pos >= 40 AND item_pos < 90"), 1)
    run(arts.filter("item_pos >= 40 AND item_pos < 90"), 1)                         # a retry
    published = [r[0] for r in spark.read.parquet(out).select("article_id").collect()]
    marked = [r[0] for r in spark.read.parquet(seen + "/s").select("article_hash").collect()]
    assert sorted(published) == sorted(marked) and len(set(marked)) == len(marked)


def test_caps_null_large_and_repeated(spark):
    from gazette.operators.dedup import first_capped
    from gazette.operators.select import cap_per_source
    items = spark.range(3000).selectExpr("1 AS kind_rank", "'a' AS source_name", "id AS item_pos", "2500 AS max_articles")
    assert cap_per_source(items).count() == 2500
    assert cap_per_source(items, largest_cap=2500).count() == 2500
    assert cap_per_source(items.withColumn("max_articles", F.lit(None).cast("int"))).count() == 20
    arts = articles_from_documents(spark.read.parquet(f"{SF001}/documents.parquet"))
    twice = arts.unionByName(arts)
    capped = first_capped(twice, 2)
    assert capped.groupBy("niche", "run_date", "rn").count().filter("count > 1").count() == 0
    assert capped.groupBy("niche", "run_date").count().filter("count > 2").count() == 0


def test_seen_state_errors_are_raised(spark, tmp_path):
    import pytest
    from gazette.streaming.runs import seen_table
    assert seen_table(spark, str(tmp_path / "none")) is None
    (tmp_path / "bad").mkdir()
    (tmp_path / "bad" / "part-0.parquet").write_bytes(b"not parquet")
    with pytest.raises(Exception):
        seen_table(spark, str(tmp_path / "bad")).count()


def test_us_zone_names_have_fixed_offsets(spark):
    from gazette.functions.dates import parse_feed_date
    rows = [("Sat, 01 Jun 2024 10:00:00 EST", "2024-06-01 15:00:00"), ("01 Jun 24 10:00:00 GMT", "2024-06-01 10:00:00"),
            ("01 Jun 2024", "2024-06-01 00:00:00"), ("June 1, 2024 10:00", "2024-06-01 10:00:00")]
    got = spark.createDataFrame(rows, "s string, want string").select(parse_feed_date("s").cast("string").alias("t"), "want").collect()
    assert [r.t for r in got] == [r.want for r in got]
