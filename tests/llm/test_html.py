from hypothesis import given
from hypothesis import strategies as st

from assayer.llm import html_wrappers as h

BLOG = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style></head><body class="sidebar">
<header><h2>Site</h2></header><div id="cookie-notice">We use cookies</div><div class="main menu">a b</div>
<div class="page"><div class="post-content"><h1>Head &amp; tail</h1><p>One<b>two</b> &#233;<br>three</p>
<form>Sub<input></form><p>Four<aside>side</aside></p><!-- <p>no</p> -->{more}</div>
<section id="comments"><p>reader says</p></section></div><div class="footer">foot</div></body></html>"""


def test_main_text_of_a_layout():
    wrapper = h.fold(h.stream(BLOG))
    assert h.containers(wrapper) == ["div.content.post", "body"]
    assert h.main_text(BLOG.replace("{more}", ""), h.containers(wrapper)) == "Head & tail Onetwo é three Four"


def test_article_wins_and_its_header_stays():
    page = "<body><p>x</p><article><header><h1>A</h1></header><p>b<p>c &lt;d&gt;<footer>e</footer></article><p>y"
    assert h.main_text(page, ["*article", "body"]) == "A b c <d>"


def test_broken_pages():
    assert h.main_text("", ["body"]) == "" and h.main_text("a < b <c", ["body"]) == "a < b"
    assert h.main_text("<article><p>x<script>if(a<b)'</p>'</script>y", ["*article"]) == "xy"
    assert h.main_text('<p title="a>b">x</p><p title="c>y', ["body"]) == "x y"
    assert h.main_text("<!-- open", ["body"]) == "" and h.main_text("<nav>x</nav></p>y", []) == "y"


@given(st.text(st.sampled_from('<>/!-abp"= &;')))
def test_any_text_is_read(page):
    h.main_text(page, ["body"])
    h.fold(h.stream(page))


def test_folding_and_alignment():
    assert h.fold(list("abab")) == [("+", ("a", "b"))]
    assert h.fold(list("aabcbcd")) == [("+", ("a",)), ("+", ("b", "c")), "d"]
    assert h.align(list("abc"), list("ac")) == ["a", ("?", ("b",)), "c"]
    assert h.align(["x", ("+", ("p", "#"))], ["x", "p", "#"]) == ["x", ("+", ("p", "#"))]
    merged = h.align(list("axb"), list("ayb"))
    assert merged == ["a", ("?", ("x",)), ("?", ("y",)), "b"]
    assert h.align(merged, list("ab")) == merged
    assert h.from_text(h.as_text(merged)) == merged
    assert h.expression(merged) == "<a> (<x>)? (<y>)? <b>"


def test_extract(spark):
    page = BLOG.replace("{more}", "<p>More</p>")
    rows = [
        (1, "http://a.example/x", BLOG.replace("{more}", "")),
        (2, "HTTP://A.example?y", page),
        (2, "HTTP://A.example?y", page),
        (3, None, "<p>alone"),
        (4, "odd", None),
        (5, "", ""),
        (None, "http://b.example/", "<main>m</main><p>z" + "<p>long" * 20_000),
    ]
    pages = spark.createDataFrame(
        [(*r, "x", "y") for r in rows], "page_id long, url string, html string, host string, roots string"
    )
    assert h.infer_wrappers(pages).count() == 3
    found = sorted((str(r["id"]), str(r["url"]), r["text"]) for r in h.extract(pages).collect())
    text = "Head & tail Onetwo é three Four"
    assert found == sorted(
        [
            ("1", "http://a.example/x", text),
            ("2", "HTTP://A.example?y", text + " More"),
            ("2", "HTTP://A.example?y", text + " More"),
            ("3", "None", "alone"),
            ("4", "odd", ""),
            ("5", "", ""),
            ("None", "http://b.example/", "m"),
        ]
    )
    assert h.extract(pages.limit(0)).count() == 0


def test_shuffled_wrappers(spark, monkeypatch):
    monkeypatch.setattr(h, "BROADCAST_BYTES", -1)
    pages = spark.createDataFrame([(1, "http://a/", "<p>x"), (2, "http://a/", "<p>y")],
                                  "page_id long, url string, html string")
    assert sorted(r["text"] for r in h.extract(pages).collect()) == ["x", "y"]


def text_of(page):
    return h.main_text(page, h.containers(h.fold(h.stream(page))))


def test_all_main_containers_are_joined():
    lead = '<body><p>x</p><div class="article-lead">Lead</div><div class="article-body"><p>Body</div>'
    assert text_of(lead) == "Lead Body"
    assert text_of("<main>a</main><p>x</p><article>bbb</article>") == "a bbb"
    assert text_of('<div class="content"><p>x</p><article>a<main>b</main></article></div>') == "a b"


def test_layouts_with_words_of_noise_keep_their_text():
    for name in ('class="layout has-sidebar"', 'id="content" class="no-comments"', 'class="banner-page"'):
        assert text_of(f"<body><p>x</p><div {name}><article><p>One</p></article></div>") == "One"
    plain = '<body><p>x</p><div class="sidebar-page"><p>Long text</p><div class="sidebar">s</div></div>'
    assert text_of(plain) == "x Long text"
    teasers = '<article>One</article><div class="related"><article>long teaser</article></div>'
    assert text_of(teasers) == "One"


def test_references_of_any_length():
    decoded = h._decoded
    long = "9" * 5_000
    assert decoded(f"a&#{long};b&#{long}c") == "a\ufffdb\ufffdc"
    assert decoded("&#" + "0" * 5_000 + "65;&#65;&#x41;&#0;&#x" + "f" * 5_000 + ";") == "AAA\ufffd\ufffd"
    assert decoded("&# &#; &amp;#65;") == "&# &#; &#65;"
