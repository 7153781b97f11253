"""Main text of pages, with and without marks, and inference of wrappers."""

from talkatlas.llm import pages


def test_marked_article():
    page = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style></head><body class="sidebar-left">
    <header><h1>Site</h1></header><nav><ul><li><a href=1>Home</a><li>More</ul></nav>
    <div id="cookie-notice">We use <b>cookies</b></div>
    <article data-x="hidden"><div class="entry-header"><h1>A &amp;amp; B &lt;p&gt;</h1></div>
    <p>One <b>two</b>,<br>three&nbsp;four<p>Five <i>six
      <ul><li>x<li>y</ul><script>var t="</p>";</script><form><input>Name</form>
    <aside>Side</aside><table><tr><td>1<td>2</table>
    <div class="ad-box">Buy</div><section class="user-comments"><article><p>First!</p></article></section>
    <p>Last &copy; 3 < 4</p></article><footer>foot</footer><!-- open"""
    expected = ["A &amp; B <p>", "One two, three four", "Five six", "x", "y", "1", "2", "Last © 3 < 4"]
    assert pages.main_text(page) == "\n".join(expected)


def test_names_of_what_is_not_the_article():
    inside = ["commentlist", "site-footer", "mainNav sub-menu", "post-sidebar", "cookieBanner", "newsletter-box"]
    for name in inside:
        assert pages.main_text(f'<article><p>x<div class="{name}"><p>y</div><p>z</article>') == "x\nz"
        assert pages.main_text(f'<body><p>x</p><section id="{name}">y</section></body>') == "x"
    for name in ["commentary", "entry-header", "reading", "paradise", "shadow"]:
        assert pages.main_text(f'<article><p>x<div class="{name}"><p>y</div></article>') == "x\ny"


def test_odd_pages():
    assert pages.main_text("") == ""
    assert pages.main_text("just text") == "just text"
    assert pages.main_text("<p>a<script>never closed") == "a"
    assert pages.main_text("</p></div><p>a</b><article>") == "a"
    assert pages.main_text('<article><p title="a>b">x</p><p class=\'y>z\'>w') == "x\nw"
    assert pages.main_text("<p " + 'a="' * 2000) == ""
    assert len(pages.main_text("<article>" + "<div>" * 3000 + "deep" + "<p>x</p>" * 3000)) == 4 + 6000


def test_names_do_not_lose_the_article():
    assert pages.main_text('<div class="site has-sidebar"><article><p>x</p></article></div>') == "x"
    assert pages.main_text('<article class="post category-social tag-search"><p>x</p></article>') == "x"
    page = '<article><h2 id="social-impact">a</h2><section id="related-work"><p>b</p></section><p class="share-price">c</p></article>'
    assert pages.main_text(page) == "a\nb\nc"
    # An article in something that only its name sets apart, if there is no other; comments are none.
    inner = '<article><p>x</p><div class="comments"><article><p>no</p></article></div></article>'
    assert pages.main_text(f'<div class="social-page">{inner}</div><div class="z">w</div>') == "x"
    assert pages.main_text(f'<div class="teaser"><article>t</article></div>{inner}') == "x"
    assert pages.main_text(f'<aside>{inner}</aside><div class="z">w</div>') == "w"


def test_long_attributes():
    long = "a > b " * 20_000
    assert pages.main_text(f'<article><p title="{long}">x</p><p title=\'{long}\'>y</p></article>') == "x\ny"


def layout(n, extra="", notice="All rights reserved"):
    items = "".join(f"<p>text number {i} on page {n}</p>" for i in range(1 + n % 5))
    return (
        f'<body><div class=x>Welcome all</div><div class=c><div class=by>Written by us</div>{items}{extra}</div>'
        f"<div class=z>Bye {n}</div><div class=w>{notice}</div></body>"
    )


def test_inference_of_repeats_options_and_slots():
    found = pages.infer([layout(1), layout(3, "<table><tr><td>q</table>"), layout(2)])
    pattern = found.pattern()
    assert "<div.z>#TEXT</>" in pattern and f"<div.x>[{pages.digest('Welcome all'):x}]</>" in pattern
    assert "(<table>" in pattern and "(#TEXT)+" in pattern
    said = pages.decisions(found)
    assert said["main"] == "body/div.c"
    assert sorted(said["template"]) == sorted(
        [("body/div.x", pages.digest("Welcome all")), ("body/div.c/div.by", pages.digest("Written by us")), ("body/div.w", pages.digest("All rights reserved"))]
    )
    # The wrapper survives its packing, and two pages are no template.
    assert pages.unpacked(found.packed()) == found
    assert pages.decisions(pages.infer([layout(1), layout(2), layout(2)]))["template"] == []


def test_order_of_pages_does_not_matter():
    many = [layout(i, "<ul><li>q</ul>" * (i % 3), "old" if i == 4 else "All rights reserved") for i in range(9)]
    halves = pages.merged(pages.infer(many[:4]), pages.infer(many[4:]))
    for other in (pages.infer(many[::-1]), halves):
        said = pages.decisions(other)
        assert said["main"] == "body/div.c"
        # One page has another notice, so that is a slot.
        assert {t for t, _ in said["template"]} == {"body/div.x", "body/div.c/div.by"}


def test_the_wrapper_decides(spark):
    rows = [(i, f"http://plain.example/{i}", layout(i)) for i in range(40)]
    # Every other host has one page only, without a template.
    rows += [(100 + i, f"http://h{i}.example/", layout(i + 2)) for i in range(3)]
    marked = '<article><div class=by>Written by us</div><p>only {0}</p></article><div class=s>Read on</div>'
    rows += [(200 + i, f"http://marked.example/{i}", marked.format(i)) for i in range(5)]
    table = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(7)
    found = {r["page_id"]: r["text"] for r in pages.extract(table).collect()}
    for i in range(40):
        article = "\n".join(f"text number {j} on page {i}" for j in range(1 + i % 5))
        assert found[i] == article != pages.main_text(layout(i))
    assert all(found[100 + i].startswith("Written by us\ntext number 0") for i in range(3))
    assert [found[200 + i] for i in range(5)] == [f"only {i}" for i in range(5)]


def test_special_rows(spark):
    body = "<body><div class=m><a href=1>menu</a></div><div class=c><p>{}</p><p>more text here</p></div></body>"
    rows = [(i, f"http://h.example/{i}", body.format(f"story number {i} and so on"), "w") for i in range(8)]
    rows += [(1, rows[1][1], rows[1][2], "w"), (20, None, None, "w"), (None, "x", "<article>a</article>", "w"), (21, "https://one.example", "", None)]
    rows += [(22, "http://long.example/", "<article><p>" + "word " * 200_000 + "</p></article>", "w")]
    table = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    found = {}
    for r in pages.extract(table).collect():
        found.setdefault(r["page_id"], []).append(r["text"])
    assert found[1] == ["story number 1 and so on\nmore text here"] * 2
    assert (found[20], found[None], found[21]) == ([""], ["a"], [""])
    assert len(found[22][0]) == 5 * 200_000 - 1
    assert pages.extract(table.limit(0)).collect() == []
