"""Date parsing and formatting.

All parsed values are UTC wall-clock timestamps (the session time zone is UTC).
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from gazette.functions.text import strip_ws

# The seven web date formats in the order they are tried
# (%Y-%m-%d, %Y-%m-%dT%H:%M:%S, %Y-%m-%dT%H:%M:%SZ, %B %d, %Y, %b %d, %Y,
#  %d %B %Y, %d %b %Y), written as Spark datetime patterns.
WEB_PATTERNS = ("yyyy-M-d", "yyyy-M-d'T'H:m:s", "yyyy-M-d'T'H:m:s'Z'", "MMMM d, yyyy",
                "MMM d, yyyy", "d MMMM yyyy", "d MMM yyyy")
# Feed dates: RFC 822 with zone name or numeric offset (weekday removed first),
# then ISO 8601 (Atom).
FEED_PATTERNS = ("d MMM yyyy H:m:s z", "d MMM yyyy H:m:s Z", "d MMM yyyy H:m z", "d MMM yyyy H:m Z")
# RFC 822 zone names have fixed offsets, whatever the season.
ZONE_OFFSETS = (("EST", "-0500"), ("EDT", "-0400"), ("CST", "-0600"), ("CDT", "-0500"), ("MST", "-0700"),
                ("MDT", "-0600"), ("PST", "-0800"), ("PDT", "-0700"))


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


# A necessary shape for each pattern: a pattern is only tried on text that has it, so
# failed attempts (costly) are skipped without changing which pattern wins.
_WEB_SHAPES = (r"^\d+-\d+-\d+$", r"^\d+-\d+-\d+T[^Z]*$", r"^\d+-\d+-\d+T.*Z$",
               r"^[A-Za-z]", r"^[A-Za-z]", r"^\d+\s+[A-Za-z]", r"^\d+\s+[A-Za-z]")
_DAY_SHAPE = r"^\d+\s+[A-Za-z]{3}\s+\d{4}$"
_LONG_SHAPE = r"^[A-Z][a-z]+ \d+, \d{4} \d+:\d+$"
_FEED_SHAPE = r"^\d+\s+[A-Za-z]+\s+\d+\s+\d"


def _try(s: Column, pattern: str, shape: str | None = None) -> Column:
    parsed = F.try_to_timestamp(s, F.lit(pattern))
    return parsed if shape is None else F.when(s.rlike(shape), parsed)


def parse_web_date(c) -> Column:
    """F8: first of the seven formats that parses the stripped text, else null."""
    s = F.regexp_replace(strip_ws(c), r"\s+", " ")          # blanks inside match any run of them
    return F.when(F.coalesce(s, F.lit("")) != "",
                  F.coalesce(*[_try(s, p, shape) for p, shape in zip(WEB_PATTERNS, _WEB_SHAPES)]))


def parse_feed_date(*candidates) -> Column:
    """the first candidate (published, updated, created, pubDate) that parses."""
    outs = []
    for c in candidates:
        s = F.regexp_replace(strip_ws(c), r"\s+", " ")
        rfc = F.regexp_replace(s, r"^[A-Za-z]{3,9},\s*", "")
        for zone, offset in ZONE_OFFSETS:
            rfc = F.regexp_replace(rfc, rf"\s{zone}$", f" {offset}")
        rfc = F.regexp_replace(rfc, r"^(\d+\s+[A-Za-z]+\s+)(?=(?:69|[7-9]\d)(?:\s|$))", "$119")      # two-digit years: 69 and up 19..
        rfc = F.regexp_replace(rfc, r"^(\d+\s+[A-Za-z]+\s+)(?=\d\d(?:\s|$))", "$120")             # ... below 20..
        outs.append(F.coalesce(*[_try(rfc, p, _FEED_SHAPE) for p in FEED_PATTERNS],
                               _try(rfc, "d MMM yyyy", _DAY_SHAPE), _try(s, "MMMM d, yyyy H:m", _LONG_SHAPE), F.try_to_timestamp(s)))
    return F.coalesce(*outs)


def iso_text(ts) -> Column:
    """Date as ISO text (seconds), null stays null."""
    return F.date_format(_col(ts), "yyyy-MM-dd'T'HH:mm:ss")


def long_date(ts) -> Column:
    """'%B %d, %Y' (e.g. June 04, 2024)."""
    return F.date_format(_col(ts), "MMMM dd, yyyy")


def long_date_time(ts) -> Column:
    """'%B %d, %Y at %I:%M %p'."""
    return F.date_format(_col(ts), "MMMM dd, yyyy 'at' hh:mm a")


def day_text(ts) -> Column:
    """'%Y-%m-%d'."""
    return F.date_format(_col(ts), "yyyy-MM-dd")


def duration_seconds(start, end) -> Column:
    """end - start in seconds (microsecond precision)."""
    return (F.unix_micros(_col(end).cast("timestamp")) - F.unix_micros(_col(start).cast("timestamp"))) / F.lit(1e6)
