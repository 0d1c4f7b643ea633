import re
import time
from html import unescape

import numpy as np

from dialoom.llm import html_extraction as H


def net():
    return H.trained()


def text(html):
    return H.main_texts([html], net())[0]


def test_pages_by_their_markup():
    page = (
        '<!DOCTYPE html><html><head><title>t</title><script>var x="</p>";</script><style>p{}</style></head><body><nav><ul><li><a href="/a">Home</a></li><li><a href="/b">About us</a></li></ul></nav>'
        '<div class="ad">Ontin the of resting thea.</div><article><h1>Reading the sea &amp; sky.</h1><p>First paragraph of\n  the article, with <b>bold</b>&nbsp;words.<p>Second one &lt;here&gt;, unclosed.<br>After a break.</article>'
        '<section id="comments"><h3>Comments</h3><div class="comment"><p>Nice thing to read, thanks.</p></div></section><footer>&copy; 2024 Some firm &middot; <a href="/p">Privacy</a></footer></body></html>'
    )
    assert text(page) == "Reading the sea & sky.\nFirst paragraph of the article, with bold words.\nSecond one <here>, unclosed. After a break."


def test_odd_pages():
    assert H.main_texts([None, "", "   ", "<html></html>", "<script>alert(1)"], net()) == [""] * 5
    for broken in ("<p", "<p>text &am", "<a href='", "</div></div>", "<!-- no end", "<![CDATA[x", "<p class=\"a>b", "<" * 2000, "<p>" * 3000, "&" * 5000):
        assert isinstance(text(broken), str)


def test_blocks():
    b = H.blocks_of("<div>one<p>two <i>three</i><p>four<ul><li>five<li>six</ul>seven<noscript>no</noscript><svg><text>no</text></svg></div>tail &eacute;&#233;&notit;")
    assert [x.text for x in b] == ["one", "two three", "four", "five", "six", "seven", "tail éé¬it;"]
    assert [t for t, _ in b[3].node.path()] == ["div", "ul", "li"]


def test_head_and_math():
    assert [x.text for x in H.blocks_of("<html><head><title>t</title><body><p>Hello there")] == ["Hello there"]
    assert [x.text for x in H.blocks_of("<head><title>t</title><p>Hello <math><mi>x</mi><annotation>tex</annotation></math>!")] == ["Hello x!"]
    words = " ".join(f"name{chr(97 + k)}" for k in range(20))
    assert len(H.blocks_of(f'<div class="{words}">x')[0].node.words) == 20


def test_large_and_deep_pages_take_linear_time():
    def seconds(html):
        start = time.monotonic()
        H.blocks_of(html)
        return time.monotonic() - start

    assert seconds("".join(f"<div>t{k}" for k in range(8000))) < 3
    assert seconds('<p class="a" id=\'b\'>some text here</p>' * 250_000) < 20  # 10 MB
    assert seconds("<div>" * 5000 + "</section>" * 5000 + "<li>x" * 5000) < 3
    deep = "".join(f"<div>t{k}" for k in range(3000))
    assert len(H.vectors(H.blocks_of(deep))) == 3000


def plain_article(html):
    """The article of the test pages, by their markup alone."""
    inner = re.search(r"<article>(.*?)(?:</article>|\Z)", html, re.S)[1]
    inner = re.sub(r"<br>", " ", re.sub(r"</?b>", "", re.sub(r"<!--.*?-->", "", inner, flags=re.S)))
    inner = re.sub(r'<div class="ad">.*?</div>', "<p>", inner, flags=re.S)
    parts = [re.sub(r"\s+", " ", unescape(re.sub(r"<[^>]*>", "", x))).strip() for x in re.split(r"</?(?:h\d|p|ul|li|div|table|tr|td|blockquote|pre)\b[^>]*>", inner)]
    return "\n".join(x for x in parts if x)


def test_known_texts_of_whole_pages(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    want = {r.page_id: plain_article(r.html) for r in pages.collect()}
    got = {r.page_id: r.text for r in H.op4_html_extraction(pages).collect()}
    wrong = [k for k in want if want[k] != got[k]]
    assert len(want) == len(got) and not wrong


LAYOUTS = [
    (
        '<html><head><title>Blog</title><body class="home blog"><div id="page"><div id="masthead"><a href="/">A Blog</a><div class="site-menu"><a href="/a">About</a> <a href="/c">Contact</a></div></div>'
        '<div id="primary"><div class="hentry"><h2 class="entry-title">How we moved the old barn</h2><div class="entry"><p>It took four days and a borrowed tractor to move the barn across the meadow, and nobody was sure that it would hold.</p>'
        "<p>On the last evening we sat on the beams, tired, and watched the swallows look for a door that was not there any more.</p></div></div></div>"
        '<div id="secondary" class="widget-area"><h3>Recent posts</h3><ul><li><a href="/1">Spring</a></li><li><a href="/2">Rain</a></li></ul></div><div id="colophon">Proudly powered by something</div></div>',
        ["How we moved the old barn", "It took four days", "On the last evening"], ["About", "Recent posts", "Rain", "powered"],
    ),
    (
        "<!doctype html><title>Docs</title><header><nav><a href=/>Home</a><a href=/api>API</a></nav></header><main><h1>Reading a table</h1><p>A table is read in row groups, and each of them can be skipped if its statistics rule it out.</p>"
        "<pre>read(path)\nfilter(rows)</pre><table><tr><th>Option<th>Meaning<tr><td>merge<td>reads all footers first</table><p>Columns that no expression asks for are never decoded at all.</p></main>"
        '<aside class="toc"><p>On this page</p><a href=#a>Reading</a></aside><footer>Licensed under some terms &copy; 2020</footer>',
        ["Reading a table", "A table is read", "Columns that no"], ["API", "On this page", "Licensed"],
    ),
    (
        '<html><body><table width=100%><tr><td class="menu"><a href=a>News</a><br><a href=b>Sports</a><br><a href=c>Weather</a></td><td class="story"><h1>Bridge opens after long repair</h1><p>The bridge over the lower river was opened again on Monday morning, eleven months after the flood.</p>'
        '<p>Drivers had taken the long way around the lake since then, and many shops on the far bank had closed for the winter.</p></td></tr></table><p class="copyright">Copyright 1999 The Paper. All rights reserved.</p></body></html>',
        ["Bridge opens", "The bridge over", "Drivers had taken"], ["Sports", "All rights reserved"],
    ),
    (
        '<body><div class="cookie-banner"><p>We use cookies to improve your visit.</p><button>Accept</button></div><div class="topbar"><form action="/s"><label>Search</label><input></form></div><article class="post"><header><h1>Notes on bread</h1></header><section><p>Flour, water, salt and a long cold night are all that this loaf asks for, and a very hot oven.</p>'
        "<ul><li>Keep the dough wet.</li><li>Fold it four times.</li></ul></section></article><section class=\"comments\"><h2>3 comments</h2><article><p>Great recipe, thanks for posting this!</p></article></section></body>",
        ["Notes on bread", "Flour, water", "Keep the dough wet.", "Fold it four times."], ["cookies", "Search", "Great recipe"],
    ),
]


def test_layouts_unlike_the_makers():
    kept = lost = left = came = 0
    for html, main, other in LAYOUTS:
        got = text(html)
        kept += sum(x in got for x in main)
        lost += sum(x not in got for x in main)
        left += sum(x not in got for x in other)
        came += sum(x in got for x in other)
    print("main parts kept", kept, "lost", lost, "; other parts left out", left, "taken", came)
    assert lost <= 1 and came <= 2


def test_gradients():
    model, maker = H.Labeller(1), H.PageMaker(5)
    data = [maker.labelled() for _ in range(3)]
    model.p = {k: v.astype(np.float64) for k, v in model.p.items()}
    x, mask = H.padded([d[0] for d in data])
    x = x.astype(np.float64)
    y = np.zeros_like(mask)
    for c, (_, labels) in enumerate(data):
        y[: len(labels), c] = labels

    def loss():
        p = model.probabilities(x, mask)
        return -(mask * (y * np.log(p) + (1 - y) * np.log(1 - p))).sum() / mask.sum()

    grads = model.gradients(x, mask, y)
    rng = np.random.default_rng(0)
    for name, g in grads.items():
        for _ in range(6):
            at = tuple(rng.integers(0, n) for n in model.p[name].shape)
            keep, step = model.p[name][at], 1e-4
            model.p[name][at] = keep + step
            up = loss()
            model.p[name][at] = keep - step
            down = loss()
            model.p[name][at] = keep
            assert abs((up - down) / (2 * step) - g[at]) < 1e-3 + 0.02 * abs(g[at])


def test_held_out_pages():
    maker, right, total = H.PageMaker(999), 0, 0
    for _ in range(300):
        x, y = maker.labelled()
        if len(x):
            p = net().probabilities(*H.padded([x]))[:, 0]
            right += int(((p >= 0.5) == y).sum())
            total += len(y)
    print("block accuracy", right / total)
    assert right / total > 0.97


def test_query(spark, tables):
    pages = tables("pages")
    out = H.op4_html_extraction(pages).collect()
    assert len(out) == pages.count() and all(r.n_chars == len(r.text) for r in out)
    empty = spark.createDataFrame([(1, None, None), (None, "u", "")], "page_id long, url string, html string")
    assert sorted((r.text, r.n_chars) for r in H.op4_html_extraction(empty).collect()) == [("", 0), ("", 0)]
    assert H.op4_html_extraction(empty.where("false")).collect() == []
