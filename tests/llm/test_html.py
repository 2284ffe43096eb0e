import html
import re
import time

import numpy as np

from logpulse.llm import html_extract
from logpulse.llm.common import prepare
from logpulse.llm.html_blocks import leaves
from logpulse.llm.html_extract import Labeller, Pages, teacher
from logpulse.llm.queries import op10_html_extraction

SF = "/root/testdata/sf0.01"


def brute(page):
    """The article of a page of the given tables, by its markup alone."""
    inner = re.search(r"<article>(.*?)</article>", page, re.S)
    blocks = re.split(r"</?(?:p|h1)>", inner[1]) if inner else []
    texts = [" ".join(html.unescape(re.sub(r"<[^>]*>", " " if "br" in b else "", b.replace("<br>", " "))).split()) for b in blocks]
    return "\n\n".join(t for t in texts if t)


def test_query_extracts_the_articles(spark):
    pages = {r.page_id: r for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    got = op10_html_extraction(spark, SF).collect()
    assert len(got) == len(pages)
    for r in got:
        assert (r.url, r.text, r.n_chars) == (pages[r.page_id].url, brute(pages[r.page_id].html), len(r.text))


def test_leaves_of_awkward_markup():
    def texts(page):
        return [x.text for x in leaves(page)]

    assert texts("a &lt;b&gt; &amp;amp;<br>c\n\n d") == ["a <b> &amp; c d"]
    assert texts("<p>one<p>two <b>bo<i>ld</b> x</i><div>three</p>four</div>five") == ["one", "two bold x", "three", "four", "five"]
    assert texts("<ul><li>a<li>b<ul><li>c</ul></ul><table><tr><td>x<td>y<tr><td>z</table>") == ["a", "b", "c", "x", "y", "z"]
    assert texts("<script>var t='</p>';</script>x<style>p{}</style>y<!-- <p>no</p> -->z<script>open") == ["x yz"]
    assert texts('<p title="a > b">q</p> 1 < 2 <3 <a href=x>link') == ["q", "1 < 2 <3 link"]
    assert texts("<p>if <math><mi>x</mi><mo>=</mo><mn>2</mn></math> then<noscript> still <b>here</b></noscript> on</p>") == ["if x=2 then still here on"]
    assert texts("<p>a <object data=x>b</object> <canvas>c</canvas> <video src=y>d</video> <audio>e</audio> f</p><p>g</p>") == ["a b c d e f", "g"]
    drawn = leaves("<p>a <svg><path d=1/>" + "<path/>" * 30 + "<text>b</text></svg> c</p><p>d <math/> e</p>")
    assert [(x.text, x.path) for x in drawn] == [("a b c", (("p",),)), ("d e", (("p",),))]
    assert texts("<p>a <noscript>b<p>c") == ["a b", "c"]
    assert texts("") == texts("<div></div>") == texts("<!-- open") == [] and texts("<") == ["<"]
    assert [x.linked for x in leaves("<p><a href=x>ab</a>cd</p><p>ef</p>")] == [2, 0]
    begin = time.time()
    leaves('<a "' * 20_000), leaves("<div>" * 20_000 + "x"), leaves('<p ' + '"' * 100_000), leaves("<script>" * 10_000), leaves("<b>" * 20_000 + "</i>" * 20_000)
    assert time.time() - begin < 20


def test_teacher():
    assert teacher((("body",), ("article", "post"), ("p",))) and teacher((("div", "main", "content"), ("p",)))
    assert not teacher((("body",), ("p",))) and not teacher((("article",), ("div", "comment", "list"), ("p",))) and not teacher((("nav",), ("main",)))


def test_labeller_gradients_and_masks():
    pages = [leaves(f"<nav><li>a{k}</nav><article>{'<p>one two.' * k}</article>") for k in (1, 3, 0)]
    p, net = Pages(pages), Labeller()
    labels = np.array([teacher(x.path) for page in pages for x in page], float)
    _, grads = net.gradients(p, np.arange(3), labels)
    for w, g in zip(net.parameters(), grads):
        for k in np.flatnonzero(np.abs(g.reshape(-1)) > 1e-7)[:15]:
            flat, step = w.reshape(-1), 1e-5
            old = flat[k]
            flat[k] = old + step
            up = net.gradients(p, np.arange(3), labels)[0]
            flat[k] = old - step
            down = net.gradients(p, np.arange(3), labels)[0]
            flat[k] = old
            assert abs((up - down) / (2 * step) - g.reshape(-1)[k]) < 1e-6
    together = net.probabilities(p)
    alone = np.concatenate([net.probabilities(Pages([page])) for page in pages])
    assert np.allclose(together, alone)


def test_nulls_long_pages_repeats_and_no_training_pages(spark):
    prepare(spark)
    long = "<body><nav><li>x</nav><div>" + "<p>word word.</p>" * 3000 + "</div><footer>f</footer></body>"
    df = spark.createDataFrame([(1, None, "t"), (2, "", "t"), (3, long, "t"), (3, long, "t"), (None, "<div>plain text here.</div>", "t")], "page_id long, html string, Text string")
    assert html_extract.train(df) is None
    got = html_extract.main_text(df, None).collect()
    assert [r.text.count("word word.") for r in got] == [0, 0, 3000, 3000, 0] and got[0].text == "" and got[4].text == "plain text here."
    assert set(got[0].asDict()) == {"page_id", "html", "text"}
    net = Labeller().fit([leaves("<nav><li>menu</nav><article><p>some text here.</p></article>")] * 8, rounds=2)
    assert html_extract.main_text(df, net).count() == 5 and html_extract.main_text(df.limit(0), net).count() == 0


def test_a_very_long_page_is_read_by_itself(monkeypatch):
    sizes, cells = [1, 2, 3] * 85 + [20_000], []
    pages = Pages([leaves("<p>word one." * n) for n in sizes])
    net, lanes = Labeller(), Labeller._lanes

    def noted(pages, which):
        at, real = lanes(pages, which)
        cells.append(at.size)
        return at, real

    monkeypatch.setattr(Labeller, "_lanes", staticmethod(noted))
    got = net.probabilities(pages)
    assert max(cells) <= html_extract.CELLS and len(got) == sum(sizes)
    for k in (0, 1, 254, 255):
        alone = net.probabilities(Pages([leaves("<p>word one." * sizes[k])]))
        assert np.allclose(got[pages.starts[k] : pages.starts[k] + sizes[k]], alone)
