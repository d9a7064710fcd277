"""Scalar text rules as Column expressions (JVM-side, inside whole-stage codegen)."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from gazette import config as C


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip_ws(c) -> Column:
    """strip Unicode whitespace at both ends, like Python's str.strip()."""
    return F.btrim(_col(c), F.lit(C.WS_CHARS))


def first_line(c) -> Column:
    return F.substring_index(_col(c), "\n", 1)


def nonblank(c) -> Column:
    """Truthiness of a string (P2): null and '' both fail."""
    return F.coalesce(_col(c), F.lit("")) != F.lit("")


def article_hash(title, source_url, content) -> Column:
    """md5 hex of 'title:source_url:content[:200]' (absent values print as None)."""
    def s(c):
        return F.coalesce(_col(c), F.lit("None"))
    return F.md5(F.concat(s(title), F.lit(":"), s(source_url), F.lit(":"),
                          F.substring(s(content), 1, C.HASH_CONTENT_CHARS)))


def has_markup(c) -> Column:
    """Clean a text only when both '<' and '>' occur."""
    return F.contains(_col(c), F.lit("<")) & F.contains(_col(c), F.lit(">"))


def words(c) -> Column:
    """Whitespace tokens of a text (F12/F13 stand-in for model tokens)."""
    return F.regexp_extract_all(_col(c), F.lit(r"[^\t\n\x{0B}\f\r ]+"), 0)


def token_count(c) -> Column:
    """F13."""
    return F.size(words(c))


def token_truncate(c, max_tokens: int = C.TOKEN_LIMIT) -> Column:
    """the text itself when within the limit, else its first N tokens joined by ' '."""
    toks = words(c)
    return F.when(F.size(toks) <= max_tokens, _col(c)).otherwise(
        F.array_join(F.slice(toks, 1, max_tokens), " "))


def ellipsis_truncate(c, n: int, suffix: str = C.ELLIPSIS) -> Column:
    """keep when len <= n, else first n-len(suffix) characters plus suffix."""
    x = _col(c)
    return F.when(F.length(x) <= n, x).otherwise(
        F.concat(F.substring(x, 1, n - len(suffix)), F.lit(suffix)))


def safe_filename(c) -> Column:
    """drop <>:"/\\|?*, strip, cut to 200 characters."""
    cleaned = strip_ws(F.regexp_replace(_col(c), C.FILENAME_FORBIDDEN_CLASS, ""))
    return F.substring(cleaned, 1, C.FILENAME_MAX_CHARS)


def article_slug(date_str, title) -> Column:
    """'<date>-<sanitised title[:50]>.md'."""
    return F.concat(_col(date_str), F.lit("-"),
                    safe_filename(F.substring(_col(title), 1, C.SLUG_TITLE_CHARS)), F.lit(".md"))


def title_cleanup(c) -> Column:
    """strip whitespace, then double quotes, then single quotes (ends only)."""
    x = strip_ws(c)
    x = F.regexp_replace(x, r'\A"+|"+\z', "")
    return F.regexp_replace(x, r"\A'+|'+\z", "")


def hashtags(tags, n: int = C.POST_HASHTAGS) -> Column:
    """'#'+tag without spaces for the first n tags, joined by ' '."""
    return F.array_join(F.transform(F.slice(_col(tags), 1, n),
                                    lambda t: F.concat(F.lit("#"), F.replace(t, F.lit(" "), F.lit("")))), " ")


def sentences(c) -> Column:
    """Sentences of a text: split after . ! ? followed by whitespace; stripped, non-empty."""
    marked = F.regexp_replace(_col(c), r"([.!?])[\t\n\f\r ]+", "$1\u0001")
    parts = F.split(marked, "\u0001", -1)
    return F.filter(F.transform(parts, lambda s: strip_ws(s)), lambda s: s != F.lit(""))


def terms(c) -> Column:
    """Lower-case letter runs of at least three letters."""
    return F.regexp_extract_all(F.lower(_col(c)), F.lit(r"\p{L}{3,}"), 0)


def paragraphs(c) -> Column:
    return F.split(_col(c), "\n\n", -1)


def path_stem(c) -> Column:
    """file name without its last suffix."""
    name = F.element_at(F.split(_col(c), "/", -1), -1)
    return F.regexp_replace(name, r"\.[^.]*\z", "")


def relative_to(c, root: str) -> Column:
    """path relative to an output root."""
    prefix = root.rstrip("/") + "/"
    return F.when(F.startswith(_col(c), F.lit(prefix)),
                  F.substring(_col(c), len(prefix) + 1, 1 << 30)).otherwise(_col(c))
