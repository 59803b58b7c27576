import random
import time
import tracemalloc

import numpy as np
import pytest
from helpers import frame
from pyspark.sql import functions as F

from vitrine.llm import html_text
from vitrine.llm.html_text import Network, blocks_of, composed, extract, fit, main_text, probabilities, rows_of, stated_label, training_set

PAGES = "page_id long, url string, html string"
PARAGRAPHS = [" ".join(random.Random(i).choice(html_text.PLAIN) for _ in range(12 + i % 30)).capitalize() + "." for i in range(60)]


def _page(i, shape=0):
    draw = random.Random(i)
    body = [draw.choice(PARAGRAPHS) for _ in range(draw.randrange(1, 7))]
    article = f"<h1>Title {i}</h1>" + "".join(f"<p>{b}" + "</p>" * draw.randrange(2) for b in body)
    opened, closed = [("<article>", "</article>"), ("<main>", "</main>"), ('<div class="post"><div class=entry>', "</div></div>")][shape]
    page = (
        f'<!DOCTYPE html><html><head><title>x</title><style>p{{}}</style><script>var t="</p><p>no</p>";</script></head><body><nav><ul><li><a href="/">Home<li><a href="/n">News</ul></nav>'
        f'<!-- note --><div class="cookie"><p>We use cookies</p><button>Accept</button></div>{opened}{article}{closed}'
        f'<section class="comments"><h3>Comments</h3><div class="comment"><p>{draw.choice(PARAGRAPHS)}</p></div></section><form><label>Name</label><input></form><footer>&copy; all rights reserved</footer>'
    )
    return page, "\n".join([f"Title {i}", *body])


@pytest.fixture(scope="module")
def network():
    return fit(training_set([_page(i)[0] for i in range(80)], composed_pages=300), epochs=4)


def test_blocks():
    page = "<p>a&amp;b&nbsp; c\n d<b>e</b><br>f<p>g<ul><li>1<li>2 <a href='x>y'>link</a></ul><script>if (a<b) x</SCRIPT>t<td>u</td></b></p>&lt;v <w"
    blocks = blocks_of(page)
    assert [b.text for b in blocks] == ["a&b c de f", "g", "1", "2 link", "t", "u", "<v"]  # the tag at the end never closes
    assert blocks[3].path == ("ul", "li") and blocks[3].linked == 4
    assert [b.text for b in blocks_of("x < y <!-- never closed <p>")] == ["x < y"]
    assert blocks_of("") == [] and blocks_of("<script>") == [] and [b.text for b in blocks_of("<div" * 3 + "plain")] == []
    assert blocks_of('<div class="ad-Box" id=mainContent>x</div>')[0].path == ("div", ".ad", ".box", ".main", ".content")
    assert len(blocks_of("<div>" * 5000 + "deep")) == 1
    assert blocks_of("<div" * 50_000) == []


def _texts(page):
    return [b.text for b in blocks_of(page)]


def test_no_text_is_lost_but_that_of_scripts_styles_titles_and_text_areas():
    assert _texts('<p>before</p><svg viewBox="0"/><p>after</p>') == ["before", "after"]
    assert _texts("<p>one</p><svg><g><path d='M0'/><circle r=1 /><text>label</text></g></svg><p>two</p>") == ["one", "label", "two"]
    assert _texts("<p>one<noscript><p>two<p>three") == ["one", "two", "three"]
    assert _texts("<p>if <math><mi>x</mi><mo>=</mo><mn>2</mn></math> then</p>") == ["if x=2 then"]
    for name in ("object", "canvas", "iframe", "template", "noscript"):
        assert _texts(f"<p>one</p><{name}>two</{name}><p>three") == ["one", "two", "three"]
        assert _texts(f"<p>one</p><{name}>two<p>three") == ["one", "two", "three"]
    for name in ("script", "style", "title", "textarea"):
        assert _texts(f"<p>one</p><{name}>two</{name} ><p>three") == ["one", "three"]
        assert _texts(f"<p>one</p><{name}>two<p>three") == ["one"]
    assert _texts("<p title=it's>Hello</p><p title=it's>you</p>") == ["Hello", "you"]
    assert _texts("<p title='it > \"x\"' a = \"b>c\">Hello</p><i a=\"unclosed>x</i>") == ["Hello", "x"]
    assert _texts("<ul><li>a<ul><li>b<li>c</ul>d<li>e</ul><table><tr><td>f<td>g<tr><td>h</table>") == ["a", "b", "c", "d", "e", "f", "g", "h"]


def test_all_names_of_a_path_count(network):
    words = " ".join(f"w{i}" for i in range(60))
    assert "aside" in blocks_of(f'<aside><div class="{words}"><p>text</p></div></aside>')[0].path
    opening = "<aside>" + f'<div class="{words}">' * 9
    block = blocks_of(opening + "<p>text</p>")[0]
    names = list(block.path)
    assert len(names) == 1 + 9 * 61 + 1 and names[0] == "aside" and stated_label(block.path) == 0
    assert list(reversed(block.path)) == names[::-1]
    flat = np.mean([network.names[html_text._row(n)] for n in names], axis=0)
    other = blocks_of("<p>x</p>")[0]
    assert np.allclose(network.inputs([rows_of(other), rows_of(block), rows_of(block)])[1:, : html_text.VECTOR], flat)


def test_junk_is_read_in_linear_time(network):
    n = 40_000
    pages = ["<i>a</b>" * n, "<i>" * n + "<div></div>" * n, "<div>" * n + "<li></li>" * n, "<li><ul>" + "<div>" * n + "<li></li>" * n, "<div>x" * n, "<svg><a>" * n + "x", "<p a='" * n, "</p>" * n]
    began = time.process_time()
    found = [blocks_of(p) for p in pages]
    assert time.process_time() - began < 30
    assert [len(f) for f in found[:2]] == [1, 0] and len(found[4]) == n
    assert len(probabilities(network, [[rows_of(b) for b in found[4]]])[0]) == n


def test_stated_labels():
    assert stated_label(("html", "article", "p")) == 1
    assert stated_label(("article", "aside", "p")) == stated_label(("div", ".comments", "article", ".comment", "p")) == stated_label(("header", "h1")) == 0
    assert stated_label(("article", "header", "h1")) == 1
    assert stated_label(("div", "p")) is None


def test_gradients_against_differences():
    """A training step's gradient of both LSTMs equals what small changes of the weights do to the loss."""
    network = Network.new(3)
    draw = np.random.default_rng(1)
    sizes, n = [2, 4], 6
    x, labels = draw.normal(size=(n, html_text.INPUT)), draw.integers(0, 2, n).astype(float)

    def loss():
        hidden, _ = html_text._pass(network, x, sizes)
        p = html_text._sigmoid(hidden @ network.out[:-1] + network.out[-1])
        return -np.mean(labels * np.log(p) + (1 - labels) * np.log(1 - p))

    hidden, kept = html_text._pass(network, x, sizes)
    error = (html_text._sigmoid(hidden @ network.out[:-1] + network.out[-1]) - labels) / n
    d_hidden = np.concatenate([error[:, None] * network.out[:-1], np.zeros((1, 2 * html_text.HIDDEN))])
    for k, lstm in enumerate((network.forward, network.backward)):
        rows, inputs, memory = kept[k]
        grads, _ = html_text._back(lstm, inputs, memory, d_hidden[rows, k * html_text.HIDDEN : (k + 1) * html_text.HIDDEN])
        for name, place in (("x", (3, 7)), ("h", (2, 40)), ("b", (5,))):
            keep = lstm[name][place]
            lstm[name][place] = keep + 1e-5
            above = loss()
            lstm[name][place] = keep - 1e-5
            below = loss()
            lstm[name][place] = keep
            assert np.isclose((above - below) / 2e-5, grads[name][place], rtol=1e-4, atol=1e-8)


def test_pages_label_alike_alone_and_together(network):
    pages = [[rows_of(b) for b in blocks_of(_page(i)[0])] for i in range(9)] + [[]]
    alone = [probabilities(network, [p])[0] for p in pages]
    assert all(np.allclose(a, b) for a, b in zip(alone, probabilities(network, pages), strict=True))


def test_a_long_page_does_not_pad_the_others(network):
    row = rows_of(blocks_of("<p>some words</p>")[0])
    pages = [[row]] * 127 + [[row] * 3000]
    tracemalloc.start()
    found = probabilities(network, pages)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 50e6
    assert all(np.allclose(a, probabilities(network, [p])[0]) for a, p in ((found[0], pages[0]), (found[-1], pages[-1])))


def test_labels_of_held_out_pages(network):
    """Pages with the article's tag, with another design, and composed ones of other seeds."""
    for shape in (0, 1, 2):
        found = [blocks_of(_page(i, shape)[0]) for i in range(500, 560)]
        right = 0
        for i, (blocks, p) in enumerate(zip(found, probabilities(network, [[rows_of(b) for b in x] for x in found]), strict=True)):
            right += "\n".join(b.text for b, q in zip(blocks, p, strict=True) if q >= 0.5) == _page(500 + i, shape)[1]
        assert right >= 54
    draw, wrong, total = random.Random(77), 0, 0
    for _ in range(100):
        blocks, labels = composed(PARAGRAPHS, draw)
        p = probabilities(network, [[rows_of(b) for b in blocks]])[0]
        wrong, total = wrong + int(((p >= 0.5) != np.array(labels)).sum()), total + len(labels)
    assert wrong <= 0.06 * total


def test_query_rows(spark):
    rows = [(i, f"u{i}", _page(i)[0]) for i in range(60)]
    odd = [(60, None, None), (61, "u", ""), (None, "u", _page(5)[0]), (5, "u", _page(5)[0]), (62, "u", "<article>" + "<p>" + "word " * 30_000 + "</article>")]
    pages = spark.createDataFrame(rows + odd, PAGES).withColumn("text", F.lit("x")).withColumn("n_chars", F.lit("y"))
    got = main_text(pages.repartition(3)).collect()
    assert len(got) == len(rows) + len(odd)
    assert all(r.n_chars == len(r.text) for r in got)
    texts = {r.page_id: r.text for r in got}
    assert sum(texts[i] == _page(i)[1] for i in range(60)) >= 57
    assert texts[60] == texts[61] == ""
    assert texts[62] in (("word " * 30_000).strip(), "")
    assert {r.text for r in got if r.page_id in (None, 5)} == {texts[5]}


def test_empty_table(spark, network):
    assert extract(spark.createDataFrame([], PAGES), network).count() == 0
    assert main_text(spark.createDataFrame([], PAGES)).count() == 0
    assert frame(spark).count() > 0
