"""Run configuration and the fixed values the digest semantics depend on."""

from __future__ import annotations

import datetime as _dt
from dataclasses import dataclass, field

# ---------------------------------------------------------------------------
# Fixed values. These must stay equal to the digest's documented behaviour for
# results to match: caps, list sizes, texts of fall-backs and markers, formats.
# ---------------------------------------------------------------------------
DEFAULT_RSS_MAX_ARTICLES = 20          # per feed, when the source gives none
DEFAULT_WEB_MAX_ARTICLES = 10          # per web source, when the source gives none
DEFAULT_RUN_CAP = 20                   # max_articles_per_run
SEEN_TTL_DAYS = 7                      # seen-article time to live
HASH_CONTENT_CHARS = 200               # content prefix inside the article hash
PUBLISHED_ARTICLE_PAGES = 5            # individual article pages per edition
TREND_ARTICLES = 10                    # articles whose tags feed the trends
TREND_TOP = 5                          # most common tags considered
TREND_MIN_COUNT = 2                    # a trend needs count > 1
TOP_STORIES = 5                        # stories in an edition
STORY_INSIGHTS = 3                     # insights kept per top story
LEAD_TOPIC_SUMMARIES = 5               # summaries scanned for lead topics
LEAD_TOPICS = 3                        # lead topics in the title prompt
INSIGHT_ARTICLES = 10                  # articles whose insights feed the analysis
INSIGHT_LINES = 20                     # insight lines kept
SHORT_SUMMARY_CHARS = 500              # parsed short summary cut
SUMMARY_LIST_ITEMS = 5                 # parsed insights/tags cut
FALLBACK_DETAILED_CHARS = 500          # detailed summary cut in the fall-back
FALLBACK_SHORT_SUMMARY = "AI-generated summary of the article."
FALLBACK_INSIGHT = "Key insight extracted from article"
FALLBACK_TAGS = ("AI", "Technology")
TOKEN_LIMIT = 3000                     # tokens of content sent in a prompt
POST_MAX_CHARS = 280                   # social post length
ELLIPSIS = "..."
THREAD_MARKER = "\U0001F9F5"           # thread delimiter (spool of thread emoji)
THREAD_STORIES = 3
THREAD_TRENDS = 3
POST_HASHTAGS = 3
INSIGHT_PARAGRAPHS = 3                 # paragraphs considered for the insights thread
INSIGHT_PARAGRAPH_MIN_CHARS = 20       # kept when stripped length > 20
SLUG_TITLE_CHARS = 50
FILENAME_MAX_CHARS = 200
FILENAME_FORBIDDEN_CLASS = r'[<>:"/\\|?*]'
INDEX_ARTICLES = 20                    # article links in the index
QUICK_READS = (6, 10)                  # 1-based positions of the quick reads
BODY_FALLBACK_CHARS = 5000             # main-content fall-back cut (body only)
MAIN_CONTENT_CHAIN = ("article", "main", ".article-content", ".post-content",
                      ".entry-content", "#content")
WEB_DATE_FORMATS = ("%Y-%m-%d", "%Y-%m-%dT%H:%M:%S", "%Y-%m-%dT%H:%M:%SZ",
                    "%B %d, %Y", "%b %d, %Y", "%d %B %Y", "%d %b %Y")
FEED_CONTENT_TYPES = ("xml", "rss", "atom")
DEFAULT_NICHE = "News"
RELEVANCE_KEYWORDS = ("artificial intelligence", "machine learning", "deep learning",
                      "neural network", "AI", "ML", "LLM", "GPT", "transformer")
MIN_CONTENT_LENGTH = 100
LANGUAGES = ("en",)
# Characters Python's str.strip() removes (str.isspace), as a regex class usable
# by both Java regex and RE2.
WS_CLASS = (r"[\t\n\x{0B}\f\r\x{1C}-\x{1F} \x{85}\x{A0}\x{1680}\x{2000}-\x{200A}"
            r"\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]")
WS_CHARS = "".join(c for c in map(chr, range(0x3001)) if c.isspace())    # the same, as text
# ASCII whitespace used to split words and sentences.
ASCII_WS_CLASS = r"[\t\n\x{0B}\f\r ]"
# ---------------------------------------------------------------------------

DEFAULT_RUN_TS = _dt.datetime(2024, 6, 4, 9, 0, 0)


@dataclass(frozen=True)
class SourceConfig:
    """One configured source (feed or web page list)."""
    url: str
    kind: str = "rss"                       # 'rss' or 'web'
    name: str | None = None
    max_articles: int | None = None
    fetch_full_content: bool = False
    selectors: dict = field(default_factory=dict)
    enabled: bool = True


@dataclass(frozen=True)
class RunConfig:
    niche: str = DEFAULT_NICHE
    run_ts: _dt.datetime = DEFAULT_RUN_TS
    run_cap: int | None = DEFAULT_RUN_CAP
    ttl_days: int = SEEN_TTL_DAYS
    sources: tuple = ()
    source_kinds: tuple = ("web", "rss")     # CLI --sources rss|web|all
    channels: tuple = (("markdown", True), ("social", False), ("site", False))
    preview: bool = False
    newsletter_url: str | None = None


def run_config_from_dict(cfg: dict, niche: str | None = None, sources: str = "all",
                         preview: bool = False, max_articles: int | None = None,
                         run_ts: _dt.datetime | None = None) -> RunConfig:
    """Read the YAML-shaped configuration once, on the driver (it is small)."""
    src = []
    scfg = cfg.get("sources", {}) or {}
    for item in scfg.get("web_scraping", []) or []:
        src.append(SourceConfig(url=item["url"], kind="web", name=item.get("name"),
                                max_articles=item.get("max_articles"),
                                selectors=dict(item.get("selectors") or {})))
    for item in scfg.get("rss_feeds", []) or []:
        src.append(SourceConfig(url=item["url"], kind="rss", name=item.get("name"),
                                max_articles=item.get("max_articles"),
                                fetch_full_content=bool(item.get("fetch_full_content", False))))
    kinds = {"rss": ("rss",), "web": ("web",), "all": ("web", "rss")}[sources]
    pub = cfg.get("publishing", {}) or {}
    channels = (("markdown", bool((pub.get("markdown") or {}).get("enabled", True))),
                ("social", bool((pub.get("twitter") or {}).get("enabled", False)) and not preview),
                ("site", bool((pub.get("github") or {}).get("enabled", False)) and not preview))
    summ = cfg.get("summarization", {}) or {}
    cap = max_articles if max_articles is not None else summ.get("max_articles_per_run", DEFAULT_RUN_CAP)
    return RunConfig(niche=niche or cfg.get("niche", DEFAULT_NICHE),
                     run_ts=run_ts or DEFAULT_RUN_TS, run_cap=cap, sources=tuple(src),
                     source_kinds=kinds, channels=channels, preview=preview)
