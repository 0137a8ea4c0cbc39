"""Main text of web pages: a linear-chain conditional random field over a page's text blocks.

A page is cut at block-level tags into leaf blocks of text. Each block is described by its ancestor tags,
the words in their classes, ids and roles, and by its text: length, share of link text, punctuation,
place in the page. The field decides for each block whether it is part of the article; a label
depends on the block and on the label before it, and Viterbi finds the best sequence.

It is trained on labelled pages: at most ``SAMPLE`` rows of the table (smallest hash of their id) that mark
their article with ``article`` or ``main``, and ``MADE`` pages put together from the sample's texts, whose
articles, menus, headers, footers, sidebars, notices, adverts, forms and comments stand in many
kinds of markup, so that the labels are known and the field does not depend on one layout.

Defined results: a null or empty page, or one without an article, has empty text. Unclosed and stray tags
are accepted. Text of scripts, styles, forms' controls and comments in the markup is never a block.
Every input row gives one row; pages are read whole; other columns pass through unchanged.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadlens.llm.common import packed, sampled

SAMPLE = 300
MADE = 400
EPOCHS = 200

_MARKUP = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*>"
    r"|<(script|style|textarea|title|noscript|iframe|xmp)\b(?:\"[^\"]*\"|'[^']*'|[^\"'>])*>.*?(?:</\1\s*>|\Z)"
    r"|<(/?)([a-z][^\s/>]*)((?:\"[^\"]*\"|'[^']*'|[^\"'>])*)>", re.S | re.I)
_ATTRIBUTE = re.compile(r"\b(?:class|id|role|itemprop)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd mark q rp rt ruby s samp "
                    "small span strike strong sub sup time tt u var wbr".split())
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_HIDDEN = frozenset("head select option button svg math object canvas audio video template datalist map".split())
#: Opening one of the first closes an open one of the second.
_CLOSES = {"p": ("p",), "li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr",), "td": ("td", "th"),
           "th": ("td", "th"), "body": ("head",)}
_BLOCKS_CLOSE_P = frozenset("article aside blockquote div dl fieldset footer form h1 h2 h3 h4 h5 h6 header hr main nav ol "
                            "p pre section table ul".split())
_WORDS = frozenset("cookie cookies copyright subscribe newsletter login sign share comment comments reply advertisement "
                   "sponsored privacy terms menu search related".split())
_ARTICLE = {"article", "main"}
# Attribute words of what is no article text, also where it stands inside the article.
_NO_TEXT = set("ad ads advert advertisement sponsored promo comment comments replies responses discussion cookie notice alert consent gdpr "
               "disclaimer newsletter popup modal banner share social sidebar widget related recommended popular subscribe login search menu "
               "navbar breadcrumbs navigation copyright".split())
_GOLD = "\ue000"  # marks article text in made pages


class Block:
    """``inner`` are the ancestors' attribute words below the innermost article or main."""

    __slots__ = ("tags", "names", "text", "linked", "inner")

    def __init__(self, tags: tuple[str, ...], names: tuple[str, ...], text: str, linked: int, inner: tuple[str, ...] = ()):
        self.tags, self.names, self.text, self.linked, self.inner = tags, names, text, linked, inner


def blocks(page: str | None) -> list[Block]:
    """The page's leaf blocks in order, with ancestor tags, ancestors' attribute words and link characters."""
    out: list[Block] = []
    stack: list[tuple[str, tuple[str, ...]]] = []
    parts: list[str] = []
    links = linked = hidden = 0

    def end_block() -> None:
        nonlocal linked
        text = " ".join(html.unescape("".join(parts)).split())
        if text:
            below = max((i + 1 for i, (t, _) in enumerate(stack) if t in _ARTICLE), default=len(stack))
            out.append(Block(tuple(t for t, _ in stack), tuple(n for _, names in stack for n in names), text, linked,
                             tuple(n for _, names in stack[below:] for n in names)))
        parts.clear()
        linked = 0

    def pop(to: int) -> None:
        nonlocal links, hidden
        for tag, _ in stack[to:]:
            links -= tag == "a"
            hidden -= tag in _HIDDEN
        del stack[to:]

    def add(text: str) -> None:
        nonlocal linked
        if not hidden and text:
            parts.append(text)
            if links:
                linked += len(text)

    at = 0
    page = page or ""
    for m in _MARKUP.finditer(page):
        add(page[at:m.start()])
        at = m.end()
        tag = (m[3] or "").lower()
        if not tag:
            continue
        inline = tag in _INLINE
        if not inline:
            end_block()
        if m[2]:
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] == tag:
                    pop(i)
                    break
            continue
        closes = _CLOSES.get(tag, ()) or (("p",) if tag in _BLOCKS_CLOSE_P else ())
        for i in range(len(stack) - 1, -1, -1):
            if stack[i][0] in closes:
                pop(i)
                break
            if stack[i][0] not in _INLINE and stack[i][0] not in closes and tag != "body":
                break
        if tag in _VOID or m[4].endswith("/") and inline:
            continue
        names = tuple(w for found in _ATTRIBUTE.findall(m[4]) for w in re.split(r"[^a-z]+", "".join(found).lower()) if w)
        stack.append((tag, names))
        links += tag == "a"
        hidden += tag in _HIDDEN
    add(page[at:])
    end_block()
    return out


def features(block: Block, place: float) -> list[str]:
    tags, text = block.tags, block.text
    words = text.split()
    out = ["bias", f"n{min(8, len(words).bit_length())}", f"link{int(4 * block.linked / max(1, len(text)))}", f"place{int(place * 4)}"]
    out += [f"in:{t}" for t in set(tags)]
    near = [t for t in tags if t not in _INLINE][-2:]
    out += [f"near:{t}" for t in near[-1:]] + [f"over:{t}" for t in near[:-1]]
    for name in set(block.names):
        out.append(f"name:{name}")
        if len(name) > 4:
            out.append(f"stem:{name[:4]}")
    out.append(f"end:{text[-1] in '.!?…'}")
    out.append(f"commas{min(3, text.count(','))}")
    if "©" in text:
        out.append("sign")
    if len(words) < 30:
        out += [f"word:{w}" for w in {w.lower().strip('.,:;!?') for w in words} & _WORDS]
    return out


# --- labelled pages -------------------------------------------------------------------------------------------------

_MAIN = ["<article>|</article>", "<main>|</main>", '<div id="content">|</div>', '<div class="post-content">|</div>',
         '<section class="entry">|</section>', '<div class="article-body">|</div>', '<div class="story">|</div>',
         '<main><article class="post">|</article></main>', '<div class="page"><div class="text">|</div></div>',
         '<div itemprop="articleBody">|</div>', '<div role="main">|</div>', '<table><tr><td class="main">|</td></tr></table>']
_NOISE = {
    "menu": ["<nav>|</nav>", '<ul class="menu">|</ul>', '<div id="navbar">|</div>', '<div class="breadcrumbs">|</div>', '<div role="navigation">|</div>'],
    "header": ["<header>|</header>", '<div class="header">|</div>', '<div id="masthead">|</div>', '<div class="site-header">|</div>', '<div class="top-bar">|</div>'],
    "footer": ["<footer>|</footer>", '<div class="footer">|</div>', '<div id="bottom">|</div>', '<div class="copyright">|</div>', '<div class="site-footer">|</div>'],
    "sidebar": ["<aside>|</aside>", '<div class="sidebar">|</div>', '<div class="widget">|</div>', '<div id="right-column">|</div>',
                '<div class="related">|</div>', '<div class="recommended">|</div>', '<section class="popular">|</section>'],
    "notice": ['<div class="cookie-notice">|</div>', '<div class="notice">|</div>', '<div class="alert">|</div>', '<div id="cookie-banner">|</div>',
               '<div class="consent">|</div>', '<div class="gdpr">|</div>', '<div class="disclaimer">|</div>', '<div role="alert">|</div>',
               '<div class="newsletter">|</div>', '<div class="popup">|</div>', '<div class="modal">|</div>', '<div class="banner">|</div>'],
    "ad": ['<div class="ad">|</div>', '<div class="ads">|</div>', '<div class="advert">|</div>', '<div class="advertisement">|</div>',
           '<div class="sponsored">|</div>', '<div class="promo">|</div>', '<aside class="ad">|</aside>', '<div id="ad-top">|</div>', '<p class="ad">|</p>'],
    "form": ["<form>|</form>", '<form class="search">|</form>', '<form id="login">|</form>', '<div class="subscribe"><form>|</form></div>'],
    "comments": ['<section id="comments">|</section>', '<div class="comments">|</div>', '<ol class="comment-list"><li class="comment">|</li></ol>',
                 '<div class="comment">|</div>', '<div class="replies">|</div>', '<section class="discussion">|</section>',
                 '<div class="reader-comments">|</div>', '<div class="responses">|</div>'],
    "share": ['<div class="share">|</div>', '<ul class="social">|</ul>', '<div class="tags">|</div>'],
}
_INSIDE = ("ad", "notice", "form", "comments", "share", "sidebar", "menu")


def _made_page(rng: np.random.Generator, prose: list[str]) -> str:
    pick = lambda of: of[int(rng.integers(len(of)))]
    words = lambda n: " ".join(html.escape(pick(prose)) for _ in range(n))

    def sentence() -> str:
        return words(int(rng.integers(2, 40))).capitalize() + "."

    def noise(kind: str) -> str:
        a, b = pick(_NOISE[kind]).split("|")
        links = [f'<a href="#">{words(int(rng.integers(1, 3)))}</a>' for _ in range(int(rng.integers(2, 7)))]
        if kind == "menu" or kind in ("share", "sidebar", "header", "footer") and rng.random() < 0.5:
            body = "".join(f"<li>{x}</li>" for x in links) if rng.random() < 0.7 else " | ".join(links)
            body = f"<ul>{body}</ul>" if rng.random() < 0.5 and body.startswith("<li>") else body
        elif kind == "form":
            body = f"<label>{words(2)}</label><input name=q><p>{sentence()}</p>"
        elif kind == "footer":
            body = f"&copy; {words(3)} &middot; {sentence()}"
        else:
            body = "".join(pick([f"<p>{sentence()}</p>", sentence(), f"<div>{sentence()}</div>", f"<h3>{words(2)}</h3>"])
                           for _ in range(int(rng.integers(1, 4))))
        return a + body + b

    title = words(int(rng.integers(2, 12)))
    article = [f"<h1>{_GOLD}{title}</h1>"] if rng.random() < 0.9 else []
    for _ in range(int(rng.integers(1, 9))):
        article.append(pick([f"<p>{_GOLD}{sentence()} {sentence()}</p>"] * 6 + [
            f"<h2>{_GOLD}{words(3)}</h2>", f"<p>{_GOLD}{words(4)} <a href='#'>{words(2)}</a> {words(9)}.</p>",
            f"<blockquote>{_GOLD}{sentence()}</blockquote>", f"<ul><li>{_GOLD}{sentence()}</li><li>{_GOLD}{words(4)}</li></ul>",
            f"<p><b>{_GOLD}{words(5)}.<br><p>{_GOLD}{sentence()}", f"<figure><figcaption>{_GOLD}{words(6)}</figcaption></figure>",
            f"<pre>{_GOLD}{words(9)}</pre>", f"<table><tr><td>{_GOLD}{words(2)}</td><td>{_GOLD}{words(2)}</td></tr></table>"]))
    for kind in _INSIDE:
        if rng.random() < 0.25:
            at = len(article) if kind in ("comments", "share") else int(rng.integers(1, len(article) + 1)) if article else 0
            article.insert(at, noise(kind))
    a, b = pick(_MAIN).split("|")
    before = [noise(k) for k in ("header", "menu", "notice", "ad", "sidebar", "form") if rng.random() < 0.45]
    after = [noise(k) for k in ("share", "comments", "ad", "sidebar", "notice", "form", "footer") if rng.random() < 0.45]
    rng.shuffle(before)
    wrap = pick([("", ""), ("", ""), ('<div class="wrapper">', "</div>"), ('<div id="page"><div class="container">', "</div></div>")])
    return f"<html><head><title>{title}</title></head><body>{wrap[0]}{''.join(before)}{a}{''.join(article)}{b}{''.join(after)}{wrap[1]}</body></html>"


def _labelled(pages: list[str], made: int, seed: int) -> list[tuple[list[Block], list[int]]]:
    out = []
    prose: list[str] = []
    for page in pages:
        found = blocks(page)
        prose += [w for b in found for w in b.text.split()[:50]]
        if any(_ARTICLE & set(b.tags) for b in found):
            out.append((found, [int(bool(_ARTICLE & set(b.tags)) and not {"nav", "aside", "footer", "form"} & set(b.tags)
                                    and not _NO_TEXT & set(b.inner)) for b in found]))
    rng = np.random.default_rng(seed)
    prose = prose or ["one", "two", "three", "four", "five"]
    for _ in range(made):
        found = blocks(_made_page(rng, prose))
        out.append((found, [int(_GOLD in b.text) for b in found]))
        for b in found:
            b.text = b.text.replace(_GOLD, "")
    return [(b, y) for b, y in out if b]


# --- the field ------------------------------------------------------------------------------------------------------

class Field:
    """Weights of label 1 by feature (label 0 is the zero point), and of the label pairs."""

    def __init__(self, weights: dict[str, float], steps: np.ndarray):
        self.weights, self.steps = weights, steps

    def decode(self, found: list[Block]) -> list[int]:
        """The best labels, by Viterbi."""
        get, n = self.weights.get, len(found)
        (s00, s01), (s10, s11) = self.steps.tolist()
        zero = one = 0.0
        back = []
        for i, block in enumerate(found):
            score = sum(get(f, 0.0) for f in features(block, i / n))
            if i:
                from0, from1 = zero + s01 >= one + s11, zero + s00 >= one + s10
                back.append((0 if from1 else 1, 0 if from0 else 1))
                zero, one = max(zero + s00, one + s10), max(zero + s01, one + s11) + score
            else:
                one = score
        labels = [int(one > zero)] if n else []
        for pair in reversed(back):
            labels.append(pair[labels[-1]])
        return labels[::-1]


def fit(labelled: list[tuple[list[Block], list[int]]], epochs: int = EPOCHS, penalty: float = 0.02) -> Field:
    """Maximum likelihood with forward and backward sums over all pages at once, by Adam."""
    index: dict[str, int] = {}
    lengths = np.array([len(y) for _, y in labelled])
    pages, longest = len(labelled), int(lengths.max())
    at, ids = [], []
    gold = np.zeros((pages, longest), int)
    for p, (found, y) in enumerate(labelled):
        gold[p, :len(y)] = y
        for i, block in enumerate(found):
            mine = [index.setdefault(f, len(index)) for f in features(block, i / len(found))]
            ids += mine
            at += [p * longest + i] * len(mine)
    at, ids = np.array(at), np.array(ids)
    inside = np.arange(longest)[None] < lengths[:, None]
    w = np.zeros(len(index) + 4)
    goal = np.concatenate([np.bincount(ids, gold.ravel()[at], len(index)), np.zeros(4)])
    for a in range(2):
        for b in range(2):
            goal[len(index) + 2 * a + b] = (inside[:, 1:] & (gold[:, :-1] == a) & (gold[:, 1:] == b)).sum()
    m = v = np.zeros_like(w)
    for epoch in range(1, epochs + 1):
        unary = np.bincount(at, w[ids], pages * longest).reshape(pages, longest)
        steps = w[-4:].reshape(2, 2)
        score = np.stack([np.zeros_like(unary), unary], axis=2)
        ahead = np.zeros((pages, longest, 2))
        behind = np.zeros((pages, longest, 2))
        ahead[:, 0] = score[:, 0]
        for i in range(1, longest):
            ahead[:, i] = np.logaddexp(ahead[:, i - 1, :1] + steps[0], ahead[:, i - 1, 1:] + steps[1]) + score[:, i]
        for i in range(longest - 2, -1, -1):
            nxt = score[:, i + 1] + behind[:, i + 1]
            behind[:, i] = np.where(inside[:, i + 1, None], np.logaddexp(steps[:, 0] + nxt[:, :1], steps[:, 1] + nxt[:, 1:]), 0)
        total = np.logaddexp(*(ahead[np.arange(pages), lengths - 1].T))[:, None]
        chance = np.exp(np.minimum(ahead[:, :, 1] + behind[:, :, 1] - total, 0)) * inside
        expect = np.concatenate([np.bincount(ids, chance.ravel()[at], len(index)), np.zeros(4)])
        for a in range(2):
            for b in range(2):
                pair = ahead[:, :-1, a] + steps[a, b] + (score + behind)[:, 1:, b] - total
                expect[len(index) + 2 * a + b] = (np.exp(np.minimum(pair, 0)) * inside[:, 1:]).sum()
        slope = (goal - expect) / pages - penalty / pages * w
        m, v = 0.9 * m + 0.1 * slope, 0.999 * v + 0.001 * slope * slope
        w = w + 0.1 * (m / (1 - 0.9 ** epoch)) / (np.sqrt(v / (1 - 0.999 ** epoch)) + 1e-8)
    return Field({f: float(w[i]) for f, i in index.items() if abs(w[i]) > 1e-4}, w[-4:].reshape(2, 2))


def train(pages: DataFrame, page_id: str = "page_id", column: str = "html", sample: int = SAMPLE, made: int = MADE, seed: int = 5) -> Field:
    some = sampled(pages.filter(F.length(column) > 0).select(page_id, F.col(column).alias("html")), sample, page_id, "html").toPandas()
    return fit(_labelled(some["html"].tolist(), made, seed))


def main_text(page: str | None, field: Field) -> str:
    found = blocks(page)
    return " ".join(b.text for b, y in zip(found, field.decode(found), strict=True) if y)


def extract(pages: DataFrame, field: Field, column: str = "html") -> DataFrame:
    """``pages`` with ``text`` (the article) and ``n_chars`` instead of columns of these names."""
    shared = pages.sparkSession.sparkContext.broadcast(field)

    @F.pandas_udf("string")
    def article(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series([main_text(page, shared.value) for page in batch], dtype=object)

    alone, rest = packed(pages, column)
    found = alone.withColumn("_text", article(column))
    kept = [c for c in rest if c not in ("text", "n_chars")]
    return found.select(*[rest[c] for c in kept], F.col("_text").alias("text"), F.length("_text").cast("long").alias("n_chars"))
