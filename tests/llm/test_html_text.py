import pytest

from traitlens.llm import html_text as H

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var a="<p>no</p>";</script></head><body>
<header>Top</header><nav><ul><li><a href="/">Home</a><li><a href="/b">B</a></ul></nav><div class="cookie-notice">OK?</div>
<div id="main"><article><h1>Title &amp; more</h1><p>First   paragraph<br>goes on<p>Second, with <b>bold</b> &lt;text&gt;
and a <a href="x">link</a>.<div class="ad-box">Buy</div><ul><li>one<li>two</ul><form>name</form></article>
<section class="comments"><p>I like this article very much and wrote a long comment about it.</p></section></div>
<aside>Side</aside><footer>&copy; F</footer></body></html>"""


def test_article_without_furniture():
    assert H.main_text(PAGE) == ("Title & more\nFirst paragraph goes on\nSecond, with bold <text> and a link.\none\ntwo")


@pytest.mark.parametrize("html,text", [
    (None, ""), ("", ""), ("<html><body></body></html>", ""), ("plain &amp; text", "plain & text"),
    ("<p>a<p>b &am", "a\nb &am"), ("<body><p>ends in a tag <a hre", "ends in a tag"), ("<p>a</b></p></div>b", "a\nb"),
    ("<body><div><p>x" * 3000, "\n".join(["x"] * 3000)), ("<script>only</script>", "")])
def test_odd_pages(html, text):
    assert H.main_text(html) == text


def test_sections_beside_the_largest_are_kept():
    a = "".join(f"<p>Paragraph {i} of the first section has some words in it.</p>" for i in range(12))
    b = "".join(f"<p>Paragraph {i} of the second one has as many.</p>" for i in range(3))
    html = f"<body><main><section>{a}</section><section>{b}</section></main><footer>f</footer></body>"
    assert H.main_text(html).count("\n") == 14


def test_rows(spark):
    pages = spark.createDataFrame([(1, "u", PAGE, "x"), (1, "u", PAGE, "x"), (None, None, None, None)],
                                  "page_id long, url string, html string, text string")
    rows = H.extract(pages).collect()
    assert len(rows) == 3 and {(r.page_id, r.n_chars) for r in rows} == {(1, len(H.main_text(PAGE))), (None, 0)}
    assert H.extract(pages.where("false")).count() == 0


@pytest.mark.parametrize("wrapper", ["div class='content with-sidebar'", "div class='site has-sidebar'",
                                     "section class='post share-enabled'", "form", "div id='search-map'"])
def test_wrappers_with_furniture_names_keep_the_article(wrapper):
    lines = [f"Paragraph {i} of the article has some words in it." for i in range(8)]
    article = "".join(f"<p>{x}</p>" for x in lines)
    small = "<div class='sidebar'><p>Side words</p></div><form>your name</form>"
    for heading in ("<h1>Head</h1>", ""):
        html = f"<body><{wrapper}>{heading}{article}{small}</{wrapper.split()[0]}><footer>f</footer></body>"
        assert H.main_text(html).split("\n") == (["Head"] if heading else []) + lines


@pytest.mark.parametrize("comments", ["section class='comments'", "div id='comments'", "div class='discussion'",
                                      "ol class='comment-list'", "div id='disqus_thread'"])
@pytest.mark.parametrize("wrapper", ["main", "div class='post with-sidebar'", "div class='comments-open'"])
def test_long_comments_are_not_the_article(wrapper, comments):
    """Twenty reader comments longer than a short article go, inside its wrapper or beside it."""
    lines = [f"Paragraph {i} of a short article." for i in range(4)]
    article = "<h1>Head</h1>" + "".join(f"<p>{x}</p>" for x in lines)
    replies = "".join(f"<p>Reader {i} wrote a comment that is much longer than any paragraph of the article is, "
                      "with many words about it and about other things.</p>" for i in range(20))
    tag, end = comments.split()[0], wrapper.split()[0]
    section = f"<{comments}>{replies}</{tag}>"
    for html in (f"<body><{wrapper}>{article}{section}</{end}><footer>f</footer></body>",
                 f"<body><{wrapper}>{article}</{end}>{section}<footer>f</footer></body>"):
        assert H.main_text(html).split("\n") == ["Head", *lines]


def test_densities_equal_brute_force():
    """Characters, tags and links counted anew for every node of random trees give the same root."""
    import random

    rnd = random.Random(3)

    def tree(depth):
        if depth == 0 or rnd.random() < 0.2:
            return "word " * rnd.randint(1, 30)
        tag = rnd.choice(["div", "section", "p", "a", "ul", "b"])
        return f"<{tag}>" + "".join(tree(depth - 1) for _ in range(rnd.randint(1, 4))) + f"</{tag}>"
    for _ in range(60):
        dom = H.Dom(f"<body>{tree(5)}</body>")
        n = len(dom.tags)
        up = [set() for _ in range(n)]
        for i in range(1, n):
            up[i] = up[dom.parents[i]] | {i, dom.parents[i]}
        up[0] = {0}
        counted = []
        for i in range(n):
            texts = [(node, sum(map(len, t.split()))) for node, _, t in dom.texts if i in up[node]]
            linked = sum(size for node, size in texts if any(dom.tags[k] == "a" for k in up[node]))
            inner = [k for k in range(n) if k != i and i in up[k]]
            counted.append((sum(s for _, s in texts), len(inner), linked, sum(dom.tags[k] == "a" for k in inner)))
        body = dom.tags.index("body")
        ratio = counted[body][2] / counted[body][0] if counted[body][0] else 0.0
        dense = [H.density(*c, ratio) for c in counted]
        total = [sum(dense[k] for k in range(1, n) if dom.parents[k] == i and dom.tags[k] not in H.INLINE)
                 for i in range(n)]
        got_dense, got_total = H.densities(dom, body)
        assert got_dense == pytest.approx(dense) and got_total == pytest.approx(total)
