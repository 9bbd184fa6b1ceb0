import html
import re

import numpy as np
import pytest

from cases import SF
from gaugeworks.llm import html_extraction
from gaugeworks.llm.boosting import fit
from gaugeworks.llm.dom import node_features, parse
from gaugeworks.llm.html_extraction import BOILERPLATE, CONTENT, OUTER, decode, extract, main_texts, train
from gaugeworks.llm.page_layouts import Composer


def blocks(page):
    return [n.text for n in parse(page) if n.text]


@pytest.mark.parametrize(
    ("page", "want"),
    [
        ("", []),
        ("plain  text\n here", ["plain text here"]),
        ("<p>a<p>b<b>c</b>d<br>e", ["a", "bcd e"]),
        ("<div>x<p>y</p>z</div>", ["x", "y", "z"]),
        ("<ul><li>a<li>b<ul><li>c</ul></ul>", ["a", "b", "c"]),
        ("<p>1 &lt; 2 &amp; &eacute;&#233;&#x41; &copy &nbsp; x</p>", ["1 < 2 & ééA © x"]),
        ("<script>var t='</p><p>no';</script><p>yes</p><style>p{}</style>", ["yes"]),
        ("<p>a</div></p>b<!-- <p>no</p> --><p>c", ["a", "b", "c"]),
        ("<head><title>t</title><meta x></head><body><p class=\"a>b\">c</p>", ["c"]),
        ("<table><tr><td>a<td>b<tr><td>c</table>", ["a", "b", "c"]),
        ("<form><input><label>l</label><button>b</button><select><option>o</select></form><p>c", ["l", "c"]),
        ("<p>a <b>b<p>c", ["a b", "c"]),
        ("<P>A</P><DIV ID=x>B</DIV>", ["A", "B"]),
        ("a<script>unclosed <p>b", ["a"]),
        ("<noscript><p>n</p></noscript><p>m</p><svg><text>s</text></svg>", ["m"]),
        ("<p>x < y and y > z</p>", ["x < y and y > z"]),
    ],
)
def test_blocks_of_odd_markup(page, want):
    assert blocks(page) == want


@pytest.mark.parametrize(
    "page, want",
    [
        ("<p>a <math><mi>x</mi></math> b</p>", ["a x b"]),
        ("<div><object data=f><p>o</p></object>p</div>", ["o", "p"]),
        ("<div><button>b</div><p>c</p>", ["c"]),
        ("<div>a<svg><text>s</div><p>c</p>", ["a", "c"]),
        ("<div>a <noscript><div>n</div>m</noscript>b</div>", ["a b"]),
        ("<p>a<noscript><p>n</p>m</noscript> b</p>c", ["a b", "c"]),
    ],
)
def test_hidden_elements_end_with_the_block_around_them(page, want):
    assert [" ".join(t.split()) for t in blocks(page)] == want


def test_parents_come_before_their_children():
    for seed in range(30):
        nodes = parse(Composer(seed).page()[0])
        assert all(node.parent < i for i, node in enumerate(nodes))
        assert all(nodes[c].parent == i for i, node in enumerate(nodes) for c in node.children)
        assert node_features(nodes, {}).shape[0] == len(nodes)


def test_decoding_equals_the_best_of_all_labellings():
    rng = np.random.default_rng(3)
    nodes = parse("<div><p>a</p><div><p>b</p></div></div><p>c</p>")
    n = len(nodes)
    allowed = {OUTER: (OUTER, CONTENT, BOILERPLATE), CONTENT: (CONTENT, BOILERPLATE), BOILERPLATE: (BOILERPLATE,)}
    for _ in range(20):
        log_p, follows = np.log(rng.dirichlet([1, 1, 1], n)), rng.normal(size=(3, 3))

        def value(labels):
            total = log_p[0, labels[0]]
            for i in range(1, n):
                up = labels[nodes[i].parent]
                if labels[i] not in allowed[up]:
                    return -np.inf
                total += log_p[i, labels[i]] + follows[up, labels[i]]
            return total

        best = max(np.ndindex(*[3] * n), key=value)
        assert value(decode(nodes, log_p, follows)) == pytest.approx(value(best))


def test_trees_learn_an_interaction():
    rng = np.random.default_rng(2)
    x = rng.normal(size=(3000, 5)).astype(np.float32)
    y = (x[:, 0] * x[:, 1] > 0).astype(int) + (x[:, 2] > 1)
    trees = fit(x[:2000], y[:2000], 3)
    assert (trees.log_probabilities(x[2000:]).argmax(axis=1) == y[2000:]).mean() > 0.9
    assert np.exp(trees.log_probabilities(x)).sum(axis=1) == pytest.approx(1)


def test_held_out_accuracy():
    model = train()
    hit = wrong = missed = exact = 0
    for seed in range(10**6, 10**6 + 150):
        page, texts = Composer(seed).page()
        want = [t for t, label in texts if label == CONTENT]
        got = [t for t in main_texts([page], model)[0].split("\n\n") if t]
        hit += len(set(want) & set(got))
        wrong += len(set(got) - set(want))
        missed += len(set(want) - set(got))
        exact += want == got
    assert hit / (hit + wrong) > 0.96 and hit / (hit + missed) > 0.97 and exact > 120


def article(inner):
    body = "".join(f"<p>Sentence number {i} of the article has quite a few words in it, as they do.</p>" for i in range(5))
    return (
        '<html><body><header><a href="/">Home</a></header><nav><ul><li><a href="/a">A</a></li><li><a href="/b">B</a></li>'
        f"</ul></nav><article><h1>Title</h1>{body}</article>{inner}<footer>&copy; me</footer></body></html>"
    )


@pytest.mark.parametrize(
    "extra",
    [
        '<aside class="sidebar"><h3>More</h3><ul><li><a href="#">x</a></li><li><a href="#">y</a></li></ul></aside>',
        '<section id="comments"><h2>Comments</h2><div class="comment"><p>I liked this article a lot, thank you.</p></div></section>',
        '<div class="cookie-notice"><p>We use cookies on this site to make it work.</p></div>',
        '<div class="ad">Buy these fine shoes today.</div>',
        '<form class="newsletter"><label>Mail</label><input name="m"></form>',
    ],
)
def test_what_is_not_the_article_goes(extra):
    want = "\n\n".join(["Title"] + [f"Sentence number {i} of the article has quite a few words in it, as they do." for i in range(5)])
    assert main_texts([article(extra)], train()) == [want]


SENTENCES = [f"Sentence number {i} of the article has quite a few words in it, as they do." for i in range(5)]
MENU = '<nav><ul><li><a href="/a">A</a></li><li><a href="/b">B</a></li></ul></nav>'


@pytest.mark.parametrize("around", [("", ""), (MENU, "<footer>&copy; me</footer>")], ids=["bare", "furnished"])
@pytest.mark.parametrize("outer", ["<article>{}</article>", "<div id=main>{}</div>"])
@pytest.mark.parametrize(
    "inner, kept",
    [
        ('<aside>Related: <a href="/x">foo</a> <a href="/y">bar</a></aside>', []),
        ('<div class="ad">Buy these fine shoes today.</div>', []),
        ('<blockquote>It is said that this was so.</blockquote>', ["It is said that this was so."]),
    ],
)
def test_within_the_article(around, outer, inner, kept):
    body = "".join(f"<p>{t}</p>" for t in SENTENCES)
    page = f"<html><body>{around[0]}{outer.format('<h1>Title</h1>' + body + inner + body)}{around[1]}</body></html>"
    assert main_texts([page], train())[0].split("\n\n") == ["Title", *SENTENCES, *kept, *SENTENCES]


def test_links_that_belong_to_the_article_stay():
    links = "<ul><li><a href=/r>The full report</a></li><li><a href=/m>The minutes</a></li></ul>"
    body = "".join(f"<p>{t}</p>" for t in SENTENCES)
    page = f"<html><body>{MENU}<article><h1>Title</h1>{body}{links}{body}</article><footer>&copy; me</footer></body></html>"
    assert main_texts([page], train())[0].split("\n\n") == ["Title", *SENTENCES, "The full report", "The minutes", *SENTENCES]


@pytest.mark.parametrize("page", ["hello there", "Just a page of plain text, without any tags at all. It has two sentences."])
def test_text_without_markup_is_the_article(page):
    assert main_texts([page], train()) == [page]


def test_nulls_empty_repeats_long_and_clashing_names(spark):
    long = article("").replace("</article>", "<p>" + "word " * 300_000 + "</p></article>")
    rows = [(1, "u", article(""), "x"), (1, "u", article(""), "x"), (2, None, None, "x"), (None, "v", "", None), (3, "w", long, "x")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text string").repartition(2)
    got = extract(pages)
    assert got.columns == ["page_id", "url", "text", "n_chars"]
    by = sorted((r.page_id or 0, r.n_chars) for r in got.collect())
    assert [p for p, _ in by] == [0, 1, 1, 2, 3] and by[0][1] == by[3][1] == 0
    assert by[1] == by[2] and by[4][1] > 1_400_000
    assert extract(pages.limit(0)).collect() == []


@pytest.mark.skipif(not SF.exists(), reason="test tables are not here")
def test_test_pages_give_their_articles(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    got = {r.page_id: r.text for r in html_extraction.extract(pages).collect()}
    for r in pages.collect():
        inner = re.search(r"<article>(.*?)</article>", r.html, re.S)[1]
        pieces = re.split(r"</?(?:p|h1|li|ul)>", inner.replace("<br>", " "))
        texts = [" ".join(html.unescape(re.sub(r"<[^>]+>", "", p)).split()) for p in pieces]
        assert got[r.page_id] == "\n\n".join(t for t in texts if t)
