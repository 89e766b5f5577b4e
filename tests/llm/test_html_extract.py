import numpy as np
import pytest
from helpers import LONG, frame

from capset.llm.html_blocks import blocks
from capset.llm.html_extract import Features, Labeller, declared, extract, fit
from capset.llm.html_layouts import made_pages

PAGE = "page_id long, url string, html string"
WORDS = ("der ein the of lane river mountain walked slowly because every stone under water carries small light "
         "across many quiet fields while people talk about seasons").split()


def text(html):
    return [b.text for b in blocks(html)]


@pytest.mark.parametrize(("html", "want"), [
    (None, []), ("", []), ("   \n", []), ("plain &amp; simple", ["plain & simple"]),
    ("<p>a <b>b</b>c<p>d", ["a bc", "d"]),
    ("<p>a\n  b\tc</p>", ["a b c"]),
    ("<div>x<br>y<br/>z</div>", ["x", "y", "z"]),
    ("<script>var t='</p>';</script><p>x</p><style>p{}</style>", ["x"]),
    ("<!-- <p>no</p> --><p>yes</p><!-- open <p>no</p>", ["yes"]),
    ("<title>no</title><h1>A</h1><ul><li>b<li>c</ul>", ["A", "b", "c"]),
    ("<p>1 < 2 &lt; 3 &amp;lt; &copy; &#65;&#x42; &amp x &eacute;</p>", ["1 < 2 < 3 &lt; © AB & x é"]),
    ('<p title="a > b">x</p><p title=\'</p>\'>y</p>', ["x", "y"]),
    ("<table><tr><td>a<td>b<tr><td>c</table>", ["a", "b", "c"]),
    ("<textarea><p>no</p></textarea>x</div></b>y", ["x", "y"]),
    ("<![CDATA[a & b]]>", ["a & b"]), ("<p>a<wbr>b&nbsp;c</p>", ["ab c"]), ("<p", ["<p"]), ("a<", ["a<"]),
])
def test_blocks(html, want):
    assert text(html) == want


def test_stray_quotes_and_unclosed_elements():
    assert [b.text for b in blocks("<p title=it's>one two</p><p>don't three</p><p>four</p>")] == ["one two", "don't three", "four"]
    assert [b.text for b in blocks('<p class="a"">one</p><p title = "x>y">two</p>')] == ["one", "two"]
    for tag in ("select", "object", "math", "svg", "noscript"):
        assert [b.text for b in blocks(f"<p>one</p><{tag}><p>two</p>")] == ["one", "two"], tag
    assert [b.text for b in blocks("<p>one</p><script>two")] == ["one"]


def test_paths_and_links():
    page = blocks('<nav id="topMenu"><ul><li><a href=x>home</a></ul></nav><article><p>t <a>l</a></p></article><div style="display: none">h</div>')
    assert [b.path for b in page] == [("nav top menu", "ul", "li", "a"), ("article", "p"), ("div hidden",)]
    assert page[0].linked == 1.0 and 0 < page[1].linked < 1


@pytest.fixture(scope="module")
def weights():
    return fit([f"<p>{' '.join(WORDS)}</p>"], made=700)


def test_held_out_layouts(weights):
    """Blocks of made pages with other seeds: the labels are known."""
    labeller, features = Labeller(), Features()
    labeller.w = weights
    right = total = 0
    for html, main in made_pages(WORDS, 150, 77):
        page = blocks(html)
        if page:
            got = labeller.label([features.page(page)])[0] >= 0.5
            right += sum(g == main(b.text) for g, b in zip(got, page, strict=True))
            total += len(page)
    assert right >= 0.96 * total


def page(main, extra=""):
    return (f'<html><head><title>t</title></head><body><header class="site-header"><a href="/">Brand name</a></header><nav><ul><li><a href=a>Home</a>'
            f'<li><a href=b>News</a></ul></nav><div class="cookie-notice"><p>We use cookies to walk slowly</p></div><article><h1>A quiet river</h1>{main}'
            f'{extra}</article><aside class="sidebar"><p>small fields</p></aside><form class="login"><label>Name</label><button>Send</button></form>'
            '<div class="comments"><p>people talk about stone</p></div><footer>&copy; 2024 the lane</footer></body></html>')


def test_whole_pages(spark, weights):
    body = [" ".join(WORDS[i:] + WORDS[:i]) + "." for i in range(0, 20, 4)]
    main = "".join(f"<p>{b}</p>" for b in body)
    rows = [(1, "u", page(main)), (2, None, None), (3, "u", ""), (4, "u", "<script>x</script>"), (5, "u", page(main)), (5, "u", page(main)),
            (None, "u", page(main)), (7, "u", page(main, '<div class="ad">Buy now</div>')),
            (8, "u", page("".join(f"<p>{b} {i}</p>" for i in range(60) for b in body)))]
    got = extract(frame(spark, rows, PAGE), weights)
    assert got.columns == ["page_id", "url", "text", "n_chars", "n_blocks"]
    got = got.collect()
    want = "\n".join(["A quiet river", *body])
    by = {r.page_id: r for r in got}
    assert len(got) == len(rows)
    for i in (1, 5, None, 7):
        assert by[i].text == want, i
    assert by[2].text == by[3].text == by[4].text == "" and by[2].n_chars == 0 and by[2].url is None
    assert all(r.n_chars == len(r.text) for r in got)
    assert by[8].text.count("\n") == 300
    assert extract(frame(spark, [], PAGE), weights).collect() == []


def test_very_long_page(spark, weights):
    got = extract(frame(spark, [(1, "u", page(f"<p>{LONG}</p>")), (2, "u", "<div>" * 5000 + "x")], PAGE), weights).collect()
    assert {r.page_id: r.text.count("lang") for r in got}[1] == 60_000


def test_batches_do_not_change_labels(weights):
    labeller, features = Labeller(), Features()
    labeller.w = weights
    pages = [features.page(blocks(h)) for h, _ in made_pages(WORDS, 20, 5)]
    pages = [p for p in pages if p[0]]
    for one, many in zip([labeller.label([p])[0] for p in pages], labeller.label(pages), strict=True):
        assert np.allclose(one, many, atol=1e-5)


def test_declared_labels():
    assert declared(blocks("<nav>x</nav><article><p>y</p><aside>z</aside></article>")).tolist() == [0, 1, 0]
    assert declared(blocks("<div>x</div>")) is None and declared(blocks("<article>x</article>")) is None


def test_unclosed_tags_cost_linear_time():
    import time

    for part in ("<a ", '<a x="', "<a x='", '<a x="">y<a z="', "<![CDATA[ >", "</p", "<a b=c'", "<p title=\"'>", "<!x "):
        for tail in ("", ">", '">', "'>", " x"):
            page = "<p>one two</p>" + part * (1_000_000 // len(part)) + tail
            t = time.perf_counter()
            blocks(page)
            assert time.perf_counter() - t < 20, (part, tail)


def test_the_fast_scan_changes_nothing():
    """Against the pattern tried anew at every place."""
    import random

    from capset.llm import html_blocks as H

    class Never(H._Endless):
        def at(self, i):
            return False

    rng = random.Random(8)
    parts = ["<a ", 'x="', "'", '"', ">", "<p>", "</p>", "text ", "=", "<!--", "-->", "<![CDATA[", "]]>", "<script>", "</script>", "<!", "<", "/"]
    own = H._Endless
    for _ in range(4000):
        page = "".join(rng.choice(parts) for _ in range(rng.randint(1, 25)))
        fast = blocks(page)
        H._Endless = Never
        try:
            assert fast == blocks(page), page
        finally:
            H._Endless = own


def test_text_of_formulas_and_objects_stays():
    page = "<main><p>Let <math><mi>x</mi></math> be</p><object data=a.swf><p>the words shown instead</p></object></main>"
    assert [b.text for b in blocks(page)] == ["Let x be", "the words shown instead"]
