import pytest

from gazette.functions import html as H

PAGE = """<html><head><title>T &amp; t</title><style>p{x}</style><script>var s="</p>";</script></head>
<body><nav><a href="/n1">Nav</a></nav><div class="post-content main" id="content"><h1 class="title">Big <b>Head</b>line</h1>
<p>First <i>para</i>.</p><!-- c --><p>Second&nbsp;para</p><span class="author">Ann</span><time datetime="2024-06-04">June 4</time></div>
<ul class="list"><li><h2><a href="/a1">A1</a></h2></li><li class="x"><span>no link</span></li><li><a href="b2">B2</a></li></ul>
<div class="card"><div class="inner"><a href="/nested">n</a></div></div></body></html>"""


@pytest.fixture(scope="module")
def root():
    return H.parse(PAGE)


def test_css_subset(root):
    assert H.Selector("h1").first_text(root) == "BigHeadline"          # CSS text: no separator
    assert H.Selector("h1.title").first_text(root) == "BigHeadline"
    assert H.Selector("#content p").first_text(root) == "Firstpara."
    assert H.Selector(".author").first_text(root) == "Ann"
    assert H.Selector("div.post-content span.author").first_text(root) == "Ann"
    assert H.Selector("time[datetime]").first_node(root).get("datetime") == "2024-06-04"
    assert H.Selector(".missing").first_text(root) is None


def test_xpath_subset(root):
    assert H.Selector("//h1").first_text(root) == "Big Headline"        # XPath text: concatenated
    assert H.Selector("//span[@class='author']").first_text(root) == "Ann"
    assert H.Selector("//a/@href").first_text(root) == "/n1"
    with pytest.raises(ValueError):
        H.Selector("//div[contains(@class,'x')]")
    with pytest.raises(ValueError):
        H.Selector("div > p")


def test_get_text_space_join_and_raw_text(root):
    body = H.select_one(root, H.parse_css("body"))
    text = H.get_text(body, " ", True)
    assert "Big Head line First para . Second para" in text.replace("  ", " ") or "Second" in text
    assert "var s" not in H.get_text(root, " ", True)
    assert H.get_text(H.parse("<p>a<!-- x -->b</p>"), " ") == "a b"   # a comment splits strings


def test_main_content_chain():
    assert H.main_content(H.parse("<body><main>M</main><article>A <b>b</b></article></body>")) == "A b"
    assert H.main_content(H.parse("<body><div class='entry-content'>E</div><div id='content'>C</div></body>")) == "E"
    assert H.main_content(H.parse("<body><div id='content'>C</div></body>")) == "C"
    long = "<body><script>x</script>" + "<p>w</p>" * 3000 + "</body>"
    out = H.main_content(H.parse(long))
    assert len(out) == 5000 and "x" not in out
    assert H.main_content(H.parse("<html><head></head></html>")) is None   # no body at all


def test_links_nested_anchor(root):
    assert H.link_hrefs(root, "ul.list li") == ["/a1", "b2"]           # li without href uses inner a
    assert H.link_hrefs(root, "article h2 a") == []
    assert H.link_hrefs(root, ".card") == ["/nested"]
    assert H.link_hrefs(root, "//li//a/@href") == ["/a1", "b2"]


def test_strip_markup_entities():
    assert H.strip_markup("<p>a &amp; b</p><p> c </p>") == "a & b c"
    assert H.strip_markup(None) is None


def test_native_links_match_parser(spark):
    from gazette.sources import pages as P
    html = ('<a href="/a?x=1&amp;y=2">1</a><a href="/b&ampc">2</a><a class="z" href="/c&lt;d">3</a>'
            '<a href="rel/e">4</a>')
    df = spark.createDataFrame([(1, "https://h.example.com/p/q", html)], "page_id long, url string, html string")
    native = [r.link for r in P.native_links(df).orderBy("link_pos").collect()]
    parsed = [r.link for r in P.page_links(df, "a[href]").orderBy("link_pos").collect()]
    assert native == parsed == ["https://h.example.com/a?x=1&y=2", "https://h.example.com/b&c",
                                "https://h.example.com/c<d", "https://h.example.com/p/rel/e"]
