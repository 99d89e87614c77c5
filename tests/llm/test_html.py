import pytest

from sedimenta.llm.html import Page, extract, host_of

PAGE = """<!DOCTYPE html><html><head><title>t</title><style>p{}</style><script>var t="</p><p>no</p>";</script></head><body>
<header>Site name</header><nav><ul><li><a href="/x">menu</a></ul></nav><div id="cookie-notice">We use cookies</div>
<div class="main-%d"><article class="post"><header><h1>Title &amp; more</h1></header><p>First   para&shy;graph<br>goes on &lt;here&gt;
 and <b>on</b>.</p><div class="ad-slot">Buy</div><ul><li>one<li>two</ul><table><tr><td>a<td>b</table><p>Last &#8212; caf&eacute;
<div class="share-links"><a href=#>share</a></div><section class="comments"><p>a reader's comment that is long enough to win by itself, or so</p></section></article></div>
<aside><p>Related</p></aside><form><label>Mail</label><textarea>x</textarea></form><footer>&copy; us</footer></body></html>"""
TEXT = "Title & more\nFirst para\xadgraph goes on <here> and on.\none\ntwo\na\nb\nLast — café"


def own(source):
    return Page(source).extract(None)


@pytest.mark.parametrize(("source", "text"), [
    (PAGE % 3, TEXT),
    ("", ""), ("   ", ""), ("plain &amp; simple", "plain & simple"), ("<p>a<p>b", "a\nb"), ("<div><p>unclosed <b>x</div><footer>f", "unclosed x"),
    ("<body><article><p>a</p><!-- c --><p>b<footer>f</footer>", "a\nb"), ("<script>only()", ""), ("<!-- never closed", ""),
    ("<div>1 < 2 and 3 > 2</div>", "1 < 2 and 3 > 2"), ("<DIV><P>Upper</P></DIV>", "Upper"), ("<div hidden>no</div><div>yes</div>", "yes"),
    ("<p>x &amp;amp; y&nbsp;z</p>", "x &amp; y z"), ('<div title="a > b">t</div>', "t"), ("</div></p>odd</x>", "odd"),
    ("<article><h2 id='side-effects'>Side effects</h2><p>a</p><section id='related-work'><p>b</p></section><p class='notice-period'>c</p></article>", "Side effects\na\nb\nc"),
    ("<div><h3 id=search-algorithms>S</h3><ul id='menu-of-the-day'><li>m</ul><p class='ad'>x</p><p>t</p></div>", "S\nm\nt"),
    ("<article><div id='sidebar'>x</div><div class='ad-slot'>y</div><div role='navigation'>z</div><p>t</p></article>", "t"),
    ("<div id='cookie-notice'>x</div><div><p>t</p></div>", "t"),
    ("<main><div class=story><h2>H</h2><blockquote>Q</blockquote><pre>a\n b</pre></div></main>", "H\nQ\na b"),
])
def test_main_text(source, text):
    assert own(source) == text


def page(article, wrong=""):
    return f"<body><div class='lead-1'>{article}</div><div class='other'>{wrong}</div></body>"


def test_the_host_decides(stored):
    rows = [(i, f"https://a.example/{i}", page(f"<p>article number {i} has text</p>", "<p>x</p>")) for i in range(5)]
    # On this page the wrong container is the longer one; its host's pages agree on the other.
    rows.append((9, "https://A.example:80/9", page("<p>short one</p>", "<p>" + "boiler plate " * 20 + "</p>")))
    # Without host, or alone, a page decides for itself.
    rows += [(10, None, rows[-1][2]), (11, "https://b.example/1", rows[-1][2]), (12, "https://a.example/12", "<td><p>no such container</p>")]
    rows += [(13, "https://a.example/13", None), (14, "", ""), (None, None, None), (9, "https://A.example:80/9", rows[5][2])]
    frame = stored([(*r, 1, "x") for r in rows], "page_id long, url string, html string, n_chars long, _host string")
    got = extract(frame).collect()
    assert len(got) == len(rows) and got[0].__fields__ == ["page_id", "url", "text", "n_chars"]
    text = {r["page_id"]: r["text"] for r in got}
    assert text[3] == "article number 3 has text" and text[9] == "short one" and text[12] == "no such container"
    assert text[10] == text[11] == ("boiler plate " * 20).strip()
    assert text[13] == text[14] == text[None] == ""
    assert all(r["n_chars"] == len(r["text"]) for r in got)
    assert extract(frame.limit(0)).count() == 0


def test_hosts(spark):
    urls = ["https://user:pw@Ex.ample.com:8080/p?q#f", "http://a.b", "//a.b/c", "", None, "mailto:x@y.z", "HTTPS://A.B?x"]
    rows = spark.createDataFrame([(u,) for u in urls], "url string")
    assert [r[0] for r in rows.select(host_of(rows["url"])).collect()] == ["ex.ample.com", "a.b", None, None, None, None, "a.b"]
