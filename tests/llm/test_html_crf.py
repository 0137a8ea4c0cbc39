import html
import itertools
import re

import numpy as np
import pytest

from roadlens.llm import html_crf as H
from roadlens.llm import queries as Q


@pytest.fixture(scope="module")
def field():
    return H.fit(H._labelled([], 300, 5), epochs=150)


def test_query_matches_the_marked_articles(spark, sf):
    got = {r.page_id: r for r in Q.QUERIES["op1_dom_crf"](spark, sf).collect()}
    for r in spark.read.parquet(f"{sf}/pages.parquet").collect():
        article = re.search("<article>(.*?)</article>", r.html, re.S)[1]
        want = " ".join(html.unescape(re.sub("<[^>]+>", " ", article)).split())
        assert (got[r.page_id].text, got[r.page_id].n_chars, got[r.page_id].url) == (want, len(want), r.url)


def test_held_out_layouts(field):
    rng = np.random.default_rng(77)
    right = total = 0
    for _ in range(150):
        found = H.blocks(H._made_page(rng, "other words than those it was trained on entirely".split()))
        gold = [int(H._GOLD in b.text) for b in found]
        for b in found:
            b.text = b.text.replace(H._GOLD, "")
        right += sum(a == b for a, b in zip(gold, field.decode(found), strict=True))
        total += len(gold)
    assert right >= 0.97 * total


def test_viterbi_is_the_best_sequence(rng):
    names = ["in:p", "in:nav", "bias", "near:p", "over:div"]
    for _ in range(20):
        field = H.Field(dict(zip(names, rng.normal(size=5) * 3, strict=True)), rng.normal(size=(2, 2)) * 2)
        found = H.blocks("".join(rng.choice(["<p>a b c</p>", "<nav>x</nav>", "<div><p>long text, with commas.</p></div>"], 7)))

        def value(labels):
            unary = sum(y * sum(field.weights.get(f, 0) for f in H.features(b, i / len(found)))
                        for i, (b, y) in enumerate(zip(found, labels, strict=True)))
            return unary + sum(field.steps[a, b] for a, b in itertools.pairwise(labels))

        best = max(itertools.product([0, 1], repeat=len(found)), key=value)
        assert np.isclose(value(field.decode(found)), value(best))


def test_gradient_finds_the_maximum():
    """On pages with one kind of block, the fitted chance is the share of label 1."""
    page = H.blocks("<p>a b c d.</p>")
    field = H.fit([(page, [1])] * 30 + [(page, [0])] * 10, epochs=400, penalty=1e-6)
    score = sum(field.weights.get(f, 0) for f in H.features(page[0], 0.0))
    assert abs(1 / (1 + np.exp(-score)) - 0.75) < 0.02


@pytest.mark.parametrize(("page", "texts"), [
    ("<p>a<b>b</b> c&amp;d &eacute; &#8364;</p>", ["ab c&d é €"]),
    ("<p>one<p>two<br>three<li>x", ["one", "two", "three", "x"]),
    ("a<script>if (a < b) { '<p>' }</script>b<style>p{}</style><!-- <p>no</p> -->c", ["abc"]),
    ("<select><option>x</select><button>go</button><textarea><p>t</textarea>y", ["y"]),
    ("<div title='a > b'>q</div> 1 < 2 <", ["q", "1 < 2 <"]),
    ("<head><title>t</title><body>text", ["text"]), ("</p></div>  \n ", []), ("<script>open", []), ("", []), (None, []),
    ("&nbsp;a  \n b", ["a b"])])
def test_blocks(page, texts):
    assert [b.text for b in H.blocks(page)] == texts


def test_awkward(spark, field):
    pages = [None, "", "   ", "<nav><a href=x>menu</a></nav>", "<article><h1>T</h1><p>" + "word " * 50_000 + "</p></article>",
             "<article><p>Same.</p></article>", "<article><p>Same.</p></article>", "<" * 3000, "<p " + "\"" * 3000]
    df = spark.createDataFrame([(i, "u", p, "clash", 7, "x") for i, p in enumerate(pages)],
                               "page_id long, url string, html string, text string, n_chars int, _rest string")
    got = H.extract(df, field)
    assert set(got.columns) == set(df.columns)
    rows = {r.page_id: r for r in got.collect()}
    assert [rows[i].text for i in (0, 1, 2, 3)] == [""] * 4 and rows[0].n_chars == 0
    assert rows[5].text == rows[6].text == "Same." and rows[4].n_chars == len("T") + 50_000 * 5
    assert H.extract(df.limit(0), field).count() == 0 and H.train(df.limit(0), sample=5, made=20).weights


def test_noise_inside_the_article(field):
    page = ('<div class="wrap"><header><a href=/>Home</a></header><article><h1>Title of it</h1><p>First paragraph, of text.</p>'
            '<div class="advertisement">Buy this now.</div><p>Second paragraph, of text.</p><form><label>Name</label></form>'
            '<section id="comments"><p>I do not agree, at all.</p></section></article><aside>Other</aside><footer>&copy; us</footer></div>')
    assert H.main_text(page, field) == "Title of it First paragraph, of text. Second paragraph, of text."


def test_training_on_pages_with_noise_inside_the_article():
    """Marked pages whose articles hold comments and adverts: both are learned as no text, and left out of new pages."""
    words = "river stone market letter window garden bridge paper morning village".split()
    rng = np.random.default_rng(3)
    some = lambda n: " ".join(rng.choice(words, n)).capitalize() + "."

    def page():
        text = [some(int(rng.integers(8, 30))) for _ in range(int(rng.integers(2, 6)))]
        body = "".join(f"<p>{t}</p>" for t in text)
        extra = f'<div class="ad">{some(6)}</div>', f'<section id="comments"><h3>Comments</h3><p>{some(9)}</p><p>{some(20)}</p></section>'
        return (f'<body class="popular"><nav><a href=x>{some(1)}</a></nav><article class="post">{body[:body.index("</p>") + 4]}{extra[0]}'
                f'{body[body.index("</p>") + 4:]}{extra[1]}</article><footer>{some(4)}</footer></body>'), " ".join(text)

    marked = [page()[0] for _ in range(200)]
    labelled = H._labelled(marked, 0, 5)
    assert all(y == 0 for found, ys in labelled for b, y in zip(found, ys, strict=True) if "comments" in b.names or "ad" in b.names)
    assert all(y == 1 for found, ys in labelled for b, y in zip(found, ys, strict=True) if b.tags[-2:] == ("article", "p"))
    field = H.fit(H._labelled(marked, 200, 5), epochs=150)
    for _ in range(20):
        html_, want = page()
        assert H.main_text(html_, field) == want
