import datetime as dt

from gazette.functions.dates import parse_feed_date, parse_web_date
from gazette.functions.urls import netloc, resolve_link


def rows(spark, col, values, schema="s string"):
    df = spark.createDataFrame([(v,) for v in values], schema)
    return [r[0] for r in df.select(col).collect()]


def py_web(s):
    fmts = ["%Y-%m-%d", "%Y-%m-%dT%H:%M:%S", "%Y-%m-%dT%H:%M:%SZ", "%B %d, %Y", "%b %d, %Y", "%d %B %Y", "%d %b %Y"]
    if not s:
        return None
    for f in fmts:
        try:
            return dt.datetime.strptime(s.strip(), f)
        except ValueError:
            pass
    return None


def test_web_dates_fixture(spark):
    vals = ["2024-06-04", "2024-06-04T09:05:07", "2024-06-04T09:05:07Z", "June 4, 2024", "Jun 04, 2024",
            "4 June 2024", "04 Jun 2024", "june 4, 2024", "  7 Jun 2024 ", "", None, "garbage", "2024-02-30"]
    assert rows(spark, parse_web_date("s"), vals) == [py_web(v) for v in vals]


def test_feed_dates_to_utc(spark):
    vals = ["Tue, 04 Jun 2024 09:00:00 GMT", "Tue, 04 Jun 2024 09:00:00 +0200", "2024-06-04T09:00:00Z",
            "2024-06-04T09:00:00-05:00", "not a date", None]
    exp = [dt.datetime(2024, 6, 4, 9), dt.datetime(2024, 6, 4, 7), dt.datetime(2024, 6, 4, 9),
           dt.datetime(2024, 6, 4, 14), None, None]
    assert rows(spark, parse_feed_date("s"), vals) == exp


def test_netloc_and_resolve(spark):
    from urllib.parse import urljoin, urlparse
    pairs = [("http://u:p@h.example.com:8080/a/b?q#f", "/x"), ("https://h.com/a/b/c", "../d"),
             ("https://h.com/a/b/c", "d?e"), ("https://h.com/a", "//cdn.com/z"), ("https://h.com/a", "mailto:x@y"),
             ("https://h.com/a/", "/./p/../q"), ("https://h.com/a", ""), ("https://h.com/a", "#top")]
    df = spark.createDataFrame(pairs, "base string, href string")
    got = [tuple(r) for r in df.select(netloc("base"), resolve_link("base", "href")).collect()]
    assert got == [(urlparse(b).netloc, urljoin(b, h)) for b, h in pairs]
