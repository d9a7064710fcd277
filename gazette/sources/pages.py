"""Raw pages → fields, links and web articles.

HTML is parsed once per page inside mapInPandas; everything around it (caps, joins,
filters, order) is DataFrame work. Project only the needed columns before the Python
operator: Catalyst cannot push a projection or filter through it.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, functions as F

from gazette import config as C
from gazette.functions import html as H
from gazette.functions.urls import netloc, resolve_link
from gazette.sources.documents import KIND_RANK, finish_articles, run_ts_lit

FIELDS_SCHEMA = ("page_id long, title string, content string, author string, date_text string, "
                 "main_text string, page_text string, links array<string>")


def _fields_fn(default_selectors: dict, link_selector: str | None, want_main: bool, want_text: bool, keep: tuple = ()):
    def run(batches):
        cache = {}

        def sel(text):
            if text not in cache:
                cache[text] = H.Selector(text)
            return cache[text]

        for pdf in batches:
            out = {k: [] for k in ("page_id", "title", "content", "author", "date_text",
                                   "main_text", "page_text", "links")}
            has_map = "selectors" in pdf.columns
            for i in range(len(pdf)):
                root = H.parse(pdf["html"].iat[i])
                sels = dict(default_selectors)
                if has_map and pdf["selectors"].iat[i] is not None:
                    sels.update({k: v for k, v in dict(pdf["selectors"].iat[i]).items() if v})
                vals = {f: (sel(sels[f]).first_text(root) if sels.get(f) else None)
                        for f in ("title", "content", "author", "date")}
                date = vals["date"]
                if sels.get("date") and not date:            # L18: then the datetime attribute
                    node = sel(sels["date"]).first_node(root)
                    date = node.get("datetime") if node is not None else None
                lsel = sels.get("articles", link_selector)
                out["page_id"].append(pdf["page_id"].iat[i])
                out["title"].append(vals["title"])
                out["content"].append(vals["content"])
                out["author"].append(vals["author"])
                out["date_text"].append(date)
                out["main_text"].append(H.main_content(root) if want_main else None)
                out["page_text"].append(H.get_text(root, " ", True) if want_text else None)
                out["links"].append(H.link_hrefs(root, lsel) if lsel else [])
            yield pd.DataFrame({k: pdf[k].to_numpy() for k in keep} | out)
    return run


def page_fields(pages: DataFrame, selectors: dict | None = None, link_selector: str | None = None,
                main: bool = False, text: bool = False, keep: tuple = ()) -> DataFrame:
    """S5/S6/S9/F4 in one pass per page. A `selectors` MAP column (per source, E4)
    overrides the defaults row by row. Returns page_id plus the fields, one row per row
    of `pages`; `keep` columns travel with their row, so nothing is joined back."""
    H.validate_selectors(selectors or {})
    if link_selector:
        H.Selector(link_selector)
    cols = ["page_id", "html"] + (["selectors"] if "selectors" in pages.columns else [])
    fn = _fields_fn(dict(selectors or {}), link_selector, main, text, tuple(keep))
    kept = "".join(f"{c} {pages.schema[c].dataType.simpleString()}, " for c in keep)
    from gazette.session import spread
    return spread(pages.select(*cols, *keep)).mapInPandas(fn, kept + FIELDS_SCHEMA)


def last_landed(pages: DataFrame, urls: DataFrame) -> DataFrame:
    """(page_id, url, html): of the pages at `urls`, the one landed last (largest page_id)
    per URL. Only ids are grouped; the HTML is joined to them once."""
    wanted = pages.select("page_id", "url").join(urls.select("url").distinct(), "url", "left_semi")
    last = wanted.groupBy("url").agg(F.max("page_id").alias("page_id"))
    return pages.select("page_id", "url", "html").join(last, ["url", "page_id"], "left_semi").dropDuplicates(["url"])


def page_links(pages: DataFrame, selector: str | None = "a[href]", cap: int | None = None,
               cap_col: str | None = None) -> DataFrame:
    """S6 + F11 + W2: (page_id, url, link_pos, href, link) — hrefs of the selected
    elements resolved against the page URL, first `cap` per page (before any fetch)."""
    own = ("url", *([cap_col] if cap_col else []))
    x = (page_fields(pages, link_selector=selector, keep=own)
         .select("page_id", *own, F.posexplode("links").alias("link_pos", "href")))
    if cap is not None:
        x = x.filter(F.col("link_pos") < cap)
    if cap_col:
        x = x.filter(F.col("link_pos") < F.col(cap_col))
    return x.withColumn("link", resolve_link("url", "href"))


def native_links(pages: DataFrame) -> DataFrame:
    """All a[href] of a page with the JVM regex engine (double-quoted attributes) — the
    fast path for the default link selector; entities in hrefs decoded."""
    hrefs = F.regexp_extract_all("html", F.lit(r'<a\s[^>]*?href="([^"]*)"'), 1)
    x = pages.select("page_id", "url", F.posexplode(hrefs).alias("link_pos", "href"))
    dec = F.col("href")
    # legacy references decode with or without ';' as in the HTML parser; '&amp' last
    for ent, ch in (("&lt", "<"), ("&gt", ">"), ("&quot", '"'), ("&#39", "'"), ("&amp", "&")):
        dec = F.regexp_replace(dec, ent + ";?", ch)
    return x.withColumn("href", dec).withColumn("link", resolve_link("url", "href"))


def page_lang(url) -> F.Column:
    """Edition niche of a landed page: the language segment of its path (/en/...)."""
    return F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*/([a-z]{2})(/|$)", 1)


def web_articles(pages: DataFrame, selectors: dict | None = None, run_ts=C.DEFAULT_RUN_TS,
                 niche: str | None = None) -> DataFrame:
    """S5/S8 over landed pages: each page is an article of the web source named by its
    host; title and content from the selectors (default h1 / article); both required."""
    sels = selectors or {"title": "h1", "content": "article"}
    from gazette.functions.dates import parse_web_date
    df = page_fields(pages, sels, keep=("url",)).select(
        (F.lit(niche) if niche else page_lang(F.col("url"))).alias("niche"),
        F.to_date(run_ts_lit(run_ts)).alias("run_date"),
        "title", "content", "author",
        parse_web_date("date_text").alias("date"), "date_text",
        F.col("url").alias("source_url"), netloc("url").alias("source_name"),
        F.lit(KIND_RANK["web"]).alias("kind_rank"), F.lit(0).alias("source_pos"),
        F.col("page_id").alias("item_pos"), run_ts_lit(run_ts).alias("ingested_at"))
    return finish_articles(df)


def scrape_sources(sources: DataFrame, pages: DataFrame, run_ts=C.DEFAULT_RUN_TS,
                   niche: str = C.DEFAULT_NICHE) -> DataFrame:
    """S7/S8 + J6: list pages of web sources → links (S6, first max_articles) → the
    landed article pages (inner join on the resolved URL) → fields (S5) → articles.
    `sources` rows: source_name, source_pos, url, max_articles, selectors. One article per
    link of a listing, so a link named twice gives two (dedup takes the first); of a URL
    landed twice the last page counts. Sources may share a listing or a page."""
    web = sources.filter(F.col("kind") == "web")
    listing = (web.join(last_landed(pages, web), "url")
               .select("page_id", "url", "html", "selectors", "source_name", "source_pos", "max_articles"))
    own = ("url", "source_name", "source_pos", "max_articles")
    links = (page_fields(listing.withColumn("max_articles", F.coalesce("max_articles", F.lit(C.DEFAULT_WEB_MAX_ARTICLES))), keep=own)
             .select(*own, F.posexplode("links").alias("item_pos", "href"))
             .filter(F.col("item_pos") < F.col("max_articles"))
             .select("source_name", "source_pos", "item_pos", resolve_link("url", "href").alias("link")))
    target = last_landed(pages, links.select(F.col("link").alias("url"))).withColumnRenamed("url", "link")
    # a page is parsed once per source that links it, however often it does
    at = ["source_name", "source_pos", "link"]
    parsed = (links.select(*at).distinct().join(target, "link")
              .join(web.select("source_name", "source_pos", "selectors"), ["source_name", "source_pos"]))
    fields = page_fields(parsed, keep=tuple(at))
    df = links.select(*at, "item_pos").join(fields, at)
    from gazette.functions.dates import parse_web_date
    out = df.select(F.lit(niche).alias("niche"), F.to_date(run_ts_lit(run_ts)).alias("run_date"),
                    "title", "content", "author", parse_web_date("date_text").alias("date"), "date_text",
                    F.col("link").alias("source_url"), "source_name",
                    F.lit(KIND_RANK["web"]).alias("kind_rank"), "source_pos",
                    F.col("item_pos").cast("long").alias("item_pos"), run_ts_lit(run_ts).alias("ingested_at"))
    return finish_articles(out)
