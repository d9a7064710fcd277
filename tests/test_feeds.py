import datetime as dt

from pyspark.sql import functions as F

from gazette.sources import feeds as FD

RSS = """<?xml version="1.0"?><rss version="2.0" xmlns:content="http://purl.org/rss/1.0/modules/content/" xmlns:dc="http://purl.org/dc/elements/1.1/"><channel><title>F</title>
<item><title> Only description </title><link>http://x/1</link><description>plain text</description><pubDate>Tue, 04 Jun 2024 09:00:00 GMT</pubDate></item>
<item><title>Encoded</title><link>http://x/2</link><description>short</description><content:encoded><![CDATA[<p>full <b>body</b></p>]]></content:encoded><dc:creator>Dee</dc:creator><pubDate>Tue, 04 Jun 2024 09:00:00 +0200</pubDate></item>
<item><title>Html desc</title><link>http://x/3</link><description>&lt;p&gt;a &amp;amp; b&lt;/p&gt;</description><author>al@x (Al)</author></item>
<item><title>No link</title><description>x</description></item>
<item><link>http://x/5</link><description>no title</description></item>
<item><title>Empty</title><link>http://x/6</link><description></description></item>
</channel></rss>"""
ATOM = """<feed xmlns="http://www.w3.org/2005/Atom"><title>A</title>
<entry><title>Atom one</title><link rel="alternate" href="http://a/1"/><content type="html">&lt;p&gt;atom body&lt;/p&gt;</content><author><name>Zed</name></author><updated>2024-06-04T09:00:00Z</updated></entry>
<entry><title>Atom two</title><link href="http://a/2"/><summary>sum only</summary><published>2024-06-03T10:00:00-02:00</published></entry>
</feed>"""


def raw(spark, rows):
    return spark.createDataFrame(
        [(u, n, 0, ct, b, cap, False) for u, n, ct, b, cap in rows],
        "feed_url string, source_name string, source_pos int, content_type string, body string, max_articles int, fetch_full_content boolean")


def test_rss_and_atom_entries(spark):
    df = raw(spark, [("http://x/feed", "X", "application/rss+xml", RSS, 20),
                     ("http://a/feed", None, "application/atom+xml", ATOM, 20),
                     ("http://b/feed", "B", "text/html", "<rss><channel><item><title>t", 20)])
    arts = FD.entries_to_articles(FD.feed_entries(df)).orderBy("source_name", "item_pos").collect()
    got = [(a.source_name, a.item_pos, a.title, a.content, a.author, a.date) for a in arts]
    assert got == [
        ("X", 0, "Only description", "plain text", None, dt.datetime(2024, 6, 4, 9)),
        ("X", 1, "Encoded", "full body", "Dee", dt.datetime(2024, 6, 4, 7)),
        ("X", 2, "Html desc", "a & b", "al@x (Al)", None),
        ("a", 0, "Atom one", "atom body", "Zed", dt.datetime(2024, 6, 4, 9)),
        ("a", 1, "Atom two", "sum only", None, dt.datetime(2024, 6, 3, 12)),
    ]


def test_cap_before_validity(spark):
    df = raw(spark, [("http://x/feed", "X", "application/rss+xml", RSS, 2)])
    arts = FD.entries_to_articles(FD.feed_entries(df)).collect()
    assert sorted(a.item_pos for a in arts) == [0, 1]
    df = raw(spark, [("http://x/feed", "X", "application/rss+xml", RSS, 4)])
    assert FD.entries_to_articles(FD.feed_entries(df)).count() == 3   # entry 3 has no link


def test_validity(spark):
    df = raw(spark, [("u1", "a", "text/xml", "<broken", 1), ("u2", "b", "text/html", "<ok/>", 1),
                     ("u3", "c", "text/html", "<broken", 1), ("u4", "d", None, "<a><b/></a>", 1)])
    got = dict((r[0], r[1]) for r in df.select("feed_url", FD.feed_valid().alias("v")).collect())
    assert got == {"u1": True, "u2": True, "u3": False, "u4": True}


def test_markup_fast_path_equals_parser(spark):
    from gazette.functions import html as H
    vals = ["<p>a &amp; b</p><p> c </p>", "<p>x</p>\n<p>y&lt;z</p>", "<b>bold</b>text<br/>more",
            "<p>a &copy; b</p>", "<!-- c --><p>q</p>", "<p>1 < 2 > 0</p>", "<script>var x;</script><p>s</p>",
            "<a href='x'>l</a>", "plain < text >", "<p>&#233;t&eacute;</p>", "<p>  </p><p> w </p>"]
    df = spark.createDataFrame([(v,) for v in vals], "s string")
    got = [r[0] for r in df.select(FD.strip_markup("s")).collect()]
    assert got == [H.strip_markup(v) for v in vals]


RDF = """<?xml version="1.0"?><rdf:RDF xmlns:rdf="http://www.w3.org/1999/02/22-rdf-syntax-ns#" xmlns="http://purl.org/rss/1.0/" xmlns:dc="http://purl.org/dc/elements/1.1/">
<channel rdf:about="http://r/"><title>R</title><link>http://r/</link></channel>
<item rdf:about="http://r/1"><title>Rdf one</title><link>http://r/1</link><description>first &amp;amp; more</description><dc:creator>Ray</dc:creator><dc:date>2024-06-04T09:00:00+02:00</dc:date></item>
<item rdf:about="http://r/2"><title>Rdf two</title><link>http://r/2</link><description>second</description></item></rdf:RDF>"""
GUID = """<rss version="2.0"><channel><title>G</title>
<item><title>Guid link</title><guid>http://g/1</guid><description>a</description><pubDate>Fri, 31 Dec 99 23:59:00 GMT</pubDate></item>
<item><title>Guid permanent</title><guid isPermaLink="true">http://g/2</guid><description>b</description><pubDate>Tue,  04  Jun  24 09:00:00 GMT</pubDate></item>
<item><title>No permanent link</title><guid isPermaLink="false">http://g/3</guid><description>c</description></item>
<item><title>No address</title><guid>tag-4</guid><description>d</description></item>
<item><title>Own link</title><link>http://g/5</link><guid>http://other/5</guid><description>e</description></item></channel></rss>"""
XHTML = """<feed xmlns="http://www.w3.org/2005/Atom"><title>A</title>
<entry><title>Elements</title><link href="http://a/1"/><content type="xhtml"><div xmlns="http://www.w3.org/1999/xhtml"><p>one <b>two</b></p><p>three</p></div></content></entry>
<entry><title>Plain</title><link href="http://a/2"/><content>plain text</content></entry>
<entry><title>Summary</title><link href="http://a/3"/><summary type="xhtml"><div xmlns="http://www.w3.org/1999/xhtml"><p>sum</p></div></summary></entry></feed>"""


def test_feed_shapes(spark):
    df = raw(spark, [("http://r/f", "R", "application/rdf+xml", RDF, 20), ("http://g/f", "G", "application/rss+xml", GUID, 20),
                     ("http://a/f", "A", "application/atom+xml", XHTML, 20)])
    arts = FD.entries_to_articles(FD.feed_entries(df)).orderBy("source_name", "item_pos").collect()
    assert [(a.source_name, a.item_pos, a.title, a.content, a.source_url, a.author, a.date) for a in arts] == [
        ("A", 0, "Elements", "one two three", "http://a/1", None, None),
        ("A", 1, "Plain", "plain text", "http://a/2", None, None),
        ("A", 2, "Summary", "sum", "http://a/3", None, None),
        ("G", 0, "Guid link", "a", "http://g/1", None, dt.datetime(1999, 12, 31, 23, 59)),
        ("G", 1, "Guid permanent", "b", "http://g/2", None, dt.datetime(2024, 6, 4, 9)),
        ("G", 4, "Own link", "e", "http://g/5", None, None),
        ("R", 0, "Rdf one", "first &amp; more", "http://r/1", "Ray", dt.datetime(2024, 6, 4, 7)),
        ("R", 1, "Rdf two", "second", "http://r/2", None, None)]
