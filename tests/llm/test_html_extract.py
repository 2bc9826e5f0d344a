import html
import re

import pytest

from finlattice.llm import html_extract
from finlattice.llm.html_extract import extract, extract_pages, host_paths, parse

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var a="</p><article>";</script></head><body class="has-sidebar">
<header><h1>Site</h1></header><nav><ul><li><a href="/">Home</a><li>More</ul></nav><div class="cookie-notice">We use cookies</div>
<div id="main-content"><article class="post-12"><h1>A &amp; B&nbsp;&lt;c&gt;</h1><p>First <b>bold<i>er</b>
 text.<p>Second<br>line &#233;<ul><li>one<li>two <a href=x>link</a></ul><div class="ad">Buy</div><form>Name <input></form><!-- no > --><aside>Side</aside>
<table><tr><td>c1<td>c2</table><pre>a  b</pre></article><div class="comments"><p>Nice post, a long comment that says very much indeed about nothing at all</p></div></div>
<div class="sidebar"><p>Other</p></div><footer>&copy; me</footer></body></html>"""


def test_one_page():
    assert extract(PAGE, None) == "A & B <c>\nFirst bolder text.\nSecond line é\none\ntwo link\nc1\nc2\na b"


def test_broken_pages():
    assert extract("", None) == ""
    assert extract("just text &amp; more", None) == "just text & more"
    assert extract("<p>a<p>b</div></section>c < d", None) == "a\nb\nc < d"
    assert extract("<div><script>x", None) == ""
    assert extract('<p title="a>b">t</p><p class="x', None).startswith("t")
    assert extract("<!-- never closed <p>x</p>", None) == ""
    assert len(parse("<div>" * 5000 + "x" + "</div>" * 5000).nodes) == 5001


def test_whole_table(spark):
    """Every page of the table is an article of one heading and paragraphs; read it off with patterns."""
    pages = spark.read.parquet("/root/testdata/sf0.1/pages.parquet")
    source = {r.page_id: r.html for r in pages.collect()}
    got = extract_pages(pages).collect()
    assert len(got) == len(source)
    for r in got:
        body = re.search(r"<article>(.*)</article>", source[r.page_id], re.S)[1]
        blocks = re.split(r"</?(?:p|h1)>", re.sub(r"</?b>|<br>", " ", body))
        want = "\n".join(x for x in (" ".join(html.unescape(b).split()) for b in blocks) if x)
        assert r.text == want and r.n_chars == len(want)


def test_consensus_and_odd_rows(spark):
    odd = "<html><body><div class='story-1'><p>short tale</p></div><div class='wide'><p>a long piece that isn't the story but happens to be longer here</p></div></body></html>"
    usual = "<html><body><div class='story-{0}'><p>This is the story of page {0}, which is long enough to win every vote.</p></div><div class='wide'><p>tiny</p></div></body></html>"
    rows = [(i, "http://A.com:80/x", usual.format(i)) for i in range(20)] + [(50, "https://u@a.com/y?z", odd), (60, None, None), (61, "nonsense", ""), (62, "http://b.com", "<p>" + "long " * 100_000), (None, "http://b.com", "<p>x"), (62, "http://b.com", "<p>y")]
    pages = spark.createDataFrame([(*r, "clash") for r in rows], "page_id long, url string, html string, path string")
    for limit in (20_000, 0):
        got = {(r.page_id, r.url): r.text for r in extract_pages(pages, limit).collect()}
        assert got[(50, "https://u@a.com/y?z")] == "short tale"
        assert got[(60, None)] == "" and got[(61, "nonsense")] == "" and got[(None, "http://b.com")] == "x"
    assert extract_pages(pages).count() == len(rows)
    assert {r.host for r in host_paths(pages).collect()} == {"a.com", "b.com"}
    assert extract_pages(pages.limit(0)).count() == 0


def test_pages_without_article_or_main_are_whole():
    body = "<p>" + "The body of the story goes on. " * 8 + "</p>"
    nav = "<nav><a href=/>Home</a></nav>"
    cases = [
        f"<div id=post><h1>Title</h1><p>Lead of it.</p><div class=body>{body}</div><p>End of it.</p></div>",
        f"<div class=page><div class=post><h1>Title</h1><div class=one>{body}</div><div class=two><p>{'Second section. ' * 9}</p></div></div><div class=sidebar>Other</div></div>",
        f"<div class=wrap><div class=title><h1>T</h1></div><div class=body>{body * 9}</div></div>",
        f"<div class=wrap><section class=a>{body}</section><section class=b>{body}</section><section class=c>{body}</section></div>",
        f"<table><tr><td><h2>Title</h2><div>{body}</div></td></tr></table>",
    ]
    for case in cases:
        got = extract(f"<html><body>{nav}{case}<footer>me</footer></body></html>", None)
        want = re.sub("<div class=sidebar>Other</div>", "", case)
        want = "\n".join(x for x in (" ".join(b.split()) for b in re.split("<[^>]*>", want)) if x)
        assert got == want, case
    small = f"<html><body><div class=wrap><div class=text>{body * 4}</div></div><div class=foot><p>© me</p></div></body></html>"
    assert "©" not in extract(small, None)


def test_words_on_wrappers_lose_no_article():
    article = "<h1>Title</h1><p>The first paragraph of it.</p><p>The second one.</p>"
    want = "Title\nThe first paragraph of it.\nThe second one."
    around = "<nav><a href=/>Home</a></nav><div class=cookie-notice><p>We use cookies</p></div>{}<div class=sidebar><p>Other</p></div><footer>me</footer>"
    words = "layout sidebar-right|wrapper sidebar-right|content hidden-xs|page menu-open|layout-header-fixed|post social|search-result|single-comment-open"
    wrappers = [f'<div class="{w}">{{}}</div>' for w in words.split("|")] + ["<form id=aspnet>{}</form>", '<form><div class="wrapper sidebar-left">{}</div></form>']
    for w in wrappers:
        assert extract(f"<html><body>{around.format(w.format(article))}</body></html>", None) == want, w
        untitled = article.replace("h1", "h2")
        if "comment" not in w:
            assert extract(f"<html><body>{around.format(w.format(untitled))}</body></html>", None) == want, w
    inner = f'<div class="layout sidebar-right">{around.format(article)}</div>'
    assert extract(f"<html><body>{inner}</body></html>", None) == want
    two = '<div class="post social"><h2>One</h2><p>The first of them.</p></div><div class="post social"><h2>Two</h2><p>The other of them.</p></div>'
    assert extract(f"<html><body><nav>Menu</nav>{two}</body></html>", None) == "One\nThe first of them.\nTwo\nThe other of them."


def test_junk_stays_out_whatever_its_share():
    comments = "<div class=comments>" + "<p>A comment that goes on and on about very little.</p>" * 40 + "</div>"
    assert extract(f"<html><body><h1>Title</h1><p>A short article.</p>{comments}</body></html>", None) == "Title\nA short article."
    assert extract(f"<html><body><nav>{'menu ' * 50}</nav><footer>me</footer></body></html>", None) == ""
    plain = "<html><body><div><h2>Story</h2><p>" + "It goes on for a while. " * 20 + "</p></div><div><p>Junk that has no class.</p></div></body></html>"
    assert "Junk" not in extract(plain, ">html>body>div")


def test_deep_and_broken_pages_take_time_in_proportion():
    deep = 50_000
    assert extract("<div>" * deep + "<p>text</p>", None) == "text"
    assert extract("<div class=sidebar>" * deep + "<p>text</p>", None) == "text"
    assert extract("<li><ul>" + "<div>" * deep + "<li>x</li>" * 1000 + "<p>text", None).endswith("text")
    assert extract("<p><table>" + "<div>" * deep + "text", None) == "text"
    assert extract("<a " * deep + "<p>text", None).endswith("text")
    assert extract("</b>" * deep + "<b>" * deep + "</i>" * deep + "text", None) == "text"


ARTICLE = "<p>First paragraph of the story, long enough to count as one of its own.</p><p>Second paragraph of the story, which goes on for a while yet.</p>"
CLASSES = "related notice search ad promo overlay hidden-xs social widget-title header-text banner-text share comment reply-quote sponsor-name".split()


@pytest.mark.parametrize("word", CLASSES)
@pytest.mark.parametrize("around", ["article", "div class='story'"])
def test_class_words_inside_the_article(word, around):
    source = f"<body><nav>Menu one two</nav><{around}><h1>Title</h1>{ARTICLE}<p class='{word}'>A paragraph that belongs to it.</p><h2 class='{word}'>A heading</h2></{around.split()[0]}></body>"
    for path in (None, html_extract.parse(source).path(html_extract.best_container(html_extract.parse(source))[0])):
        text = html_extract.extract(source, path)
        assert "A paragraph that belongs to it." in text and "A heading" in text and "Menu" not in text
    links = source.replace("A paragraph that belongs to it.", "<a href=x>Other story</a> <a href=y>One more</a>")
    assert "Other story" not in html_extract.extract(links, None)
    assert "Advertisement" not in html_extract.extract(source.replace("A paragraph that belongs to it.", "Advertisement"), None)


LONG = " ".join(f"Sentence number {i} of the long article." for i in range(40))


@pytest.mark.parametrize(
    "odd",
    [
        f"<div class='story'><p>Short teaser only.</p></div><div class='longread'><p>{LONG}</p></div>",
        f"<div class='story'><p>Short teaser only.</p></div><div class='wrap'><div class='story'><p>{LONG}</p></div></div>",
        f"<div class='story'><p>{LONG}</p></div><div class='story-2'><p>The second part of it.</p></div>",
    ],
)
def test_teasers_and_parts(spark, odd):
    rows = [(i, "http://h.example/x", f"<body><div class='story'><h1>T{i}</h1>{ARTICLE}</div></body>") for i in range(20)] + [(99, "http://h.example/y", f"<body>{odd}</body>")]
    text = {r.page_id: r.text for r in html_extract.extract_pages(spark.createDataFrame(rows, "page_id int, url string, html string")).collect()}
    assert LONG in text[99] and ("second part" in text[99]) == ("story-2" in odd)
    assert all("First paragraph" in text[i] for i in range(20))


@pytest.mark.parametrize("word", ["discussion", "reader-responses", "feedback", "opinions", "x1"])
def test_readers_comments_by_structure(word):
    entry = "<div class='entry'><span class='author'>Ann</span> <time>May 1</time><p>I think so too, and more than that.</p></div>"
    source = f"<body><div class='story'><h1>Title</h1>{ARTICLE * 2}<div class='{word}'>{entry * 3}</div></div></body>"
    text = html_extract.extract(source, None)
    assert "I think so too" not in text and "Second paragraph" in text
    # a live report is made of such entries itself
    report = f"<body><div class='story'><h1>Title</h1><div class='updates'>{entry * 9}</div></div></body>"
    assert "I think so too" in html_extract.extract(report, None)
