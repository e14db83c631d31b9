"""Main text of web pages: a linear-chain conditional random field over leaf blocks.

A page is read into its leaf blocks: runs of text between block-level tags, in
page order, each with its ancestors. A block is main text or not; features
are its ancestors' tags and class words, its nearest container (its words, links
and headings), and its text (length, share of link text, closing sign, place on
the page, the blocks beside it). The labels of
a page's blocks form a chain; weights are fitted by maximum likelihood
(forward-backward) on labelled pages, and a page is decoded by Viterbi.

Labelled pages: PAGES pages, first by a hash of their id, whose landmark tags
(article, main; not nav, aside, footer, form, ...) label the blocks, and for
each of them VARIANTS pages with the same texts set in another layout
(containers named by class or id, by names that tell nothing, or not at all;
notices, adverts, sidebars, forms, reader comments), so that tags alone do not
decide. A fit takes the first MAX_TRAIN_BLOCKS blocks of a training page and
MAX_TEXTS texts of it for each layout. Extraction reads every whole page. The
marks of the generated layouts are read in training alone: no attribute of a real
page is a label.

Defined cases: null or empty html and pages without text give ''; broken or
cut-off markup is read as far as it goes; scripts, styles, comments, titles
and other text that is not shown are no blocks; an element that hides its text
hides none where it is not closed (scripts and styles do); a block or text ends an
unclosed head; choices of a form are no blocks; without a page to learn from
the layouts are filled with stock sentences; repeated rows give repeated results.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from carestat.llm.common import keep_ids

PAGES = 200
VARIANTS = 4
MAX_TRAIN_BLOCKS = 80  # blocks of one training page used in the fit
MAX_TEXTS = 12  # texts of a training page set in one generated layout, main and other each
_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(script|style)\b[^>]*>.*?(?:</\1\s*>|\Z)"
    # text of these is not shown, up to the closing tag if there is one
    r"|<(template|title|svg|iframe|textarea|noframes|xmp)\b(?:\"[^\"]*\"|'[^']*'|[^>\"'])*+(?:(?<=/)>|>(?:.*?</\2\s*>)?)"
    r"|</?([a-zA-Z][^\s/>]*)((?:\"[^\"]*\"|'[^']*'|[^>\"'])*+>|[^>]*(?:>|\Z))"
    r"|<[!?][^>]*(?:>|\Z)", re.S | re.I)
_ATTR = re.compile(r"(?<![^\s\"'/])(class|id|role|itemprop|hidden|style|data-part)\s*(?:=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+))?", re.I)
_WORD = re.compile(r"[a-z]+")
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd mark q s samp small span strike strong sub sup time tt u var wbr img".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
IN_HEAD = frozenset("html head title base link meta style script noscript template".split())
CHOICES = frozenset("select option optgroup datalist".split())
HOLDERS = frozenset("article main nav header footer aside section form figure table ul ol dl details dialog menu".split())
_SELF_CLOSING = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}


class Block:
    __slots__ = ("text", "path", "links", "label")

    def __init__(self, text: str, path: tuple, links: int, label):
        self.text, self.path, self.links, self.label = text, path, links, label


def blocks(page: str | None, marked: bool = False) -> list[Block]:
    """Leaf blocks of a page. A path entry is (tag, class words, label, number of the element); labels are
    read from pages that ``layout`` made and marked only."""
    out: list[Block] = []
    if not page:
        return out
    stack: list[tuple] = []
    raw: list[str] = []
    linked = in_link = serial = 0
    at, head = 0, False

    def flush():
        nonlocal linked
        if raw and not (stack and stack[-1][0] in CHOICES):
            text = " ".join(html.unescape("".join(raw)).split())
            if text:
                label = next((e[2] for e in reversed(stack) if e[2] is not None), None)
                out.append(Block(text, tuple(stack), min(linked, len(text)), label))
        raw.clear()
        linked = 0

    for m in _TOKEN.finditer(page):
        piece = page[at:m.start()]
        head = head and not piece.strip()
        if piece and not head:
            raw.append(piece)
            if in_link:
                linked += len(piece)
        at = m.end()
        tag = m[3]
        if tag is None:
            continue
        tag, closing = tag.lower(), page[m.start() + 1] == "/"
        if tag == "head":
            head = not closing
            continue
        head = head and tag in IN_HEAD
        if tag == "a":
            in_link = 0 if closing else 1
        if tag == "br":
            raw.append(" ")
        if tag in INLINE or tag == "br" or head:
            continue
        flush()
        in_link = 0
        if closing:
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] == tag:
                    del stack[i:]
                    break
            continue
        if tag in VOID:
            continue
        while tag not in CHOICES and stack and stack[-1][0] in CHOICES:
            stack.pop()
        if stack and stack[-1][0] == "p":  # a block ends an open paragraph
            stack.pop()
        ends = _SELF_CLOSING.get(tag)
        while ends and stack and stack[-1][0] in ends:
            stack.pop()
        words, label = (), None
        if "=" in m[4] or "hidden" in m[4]:
            found = []
            for name, value in _ATTR.findall(m[4]):
                name, value = name.lower(), value.strip("\"'").lower()
                if name == "data-part":
                    label = int(value) if marked else None
                elif name == "hidden" or (name == "style" and "none" in value):
                    found.append("hidden")
                elif name != "style":
                    found += _WORD.findall(value)
            words = tuple(found)
        if not (m[4].endswith("/>")):
            serial += 1
            stack.append((tag, words, label, serial))
    if at < len(page) and (not head or page[at:].strip()):
        raw.append(page[at:])
    flush()
    return out


def path_features(path: tuple) -> list[str]:
    out = {"bias"}
    for depth, (tag, words, *_) in enumerate(reversed(path)):
        out.add("a " + tag)
        if depth == 0:
            out.add("t " + tag)
        for w in words:
            out.add("c " + w)
    near = next((e for e in reversed(path) if e[0] in HOLDERS or e[1]), None)
    if near:
        out.add("n " + near[0])
        out.update("m " + w for w in near[1])
        if not near[1]:
            out.add("n plain " + near[0])
    return sorted(out)


def text_features(b: Block, i: int, n: int) -> list[str]:
    words = b.text.count(" ") + 1
    return [f"w {min(8, words.bit_length())}", f"l {int(4 * b.links / max(1, len(b.text)))}",
            "e " + (b.text[-1] if b.text[-1] in ".!?:;,…|" else "x"), f"q {4 * i // n}",
            "f first" if i == 0 else "f last" if i == n - 1 else "f mid", "s sign" if b.text[0] in "©®»«|•" else "s none"]


def _holder(b: Block) -> int:
    """Number of the nearest element that holds more than one leaf, 0 for the page."""
    return next((e[3] for e in reversed(b.path) if e[0] in HOLDERS or e[0] == "div"), 0)


def around_features(page: list[Block]) -> list[list[str]]:
    """For each block what is around it: words, link share and headings of its container, and its neighbours."""
    words, links, chars, heads = {}, {}, {}, {}
    holders = [_holder(b) for b in page]
    for b, h in zip(page, holders):
        words[h] = words.get(h, 0) + b.text.count(" ") + 1
        links[h], chars[h] = links.get(h, 0) + b.links, chars.get(h, 0) + len(b.text)
        if b.path and b.path[-1][0] in ("h1", "h2"):
            heads[h] = min(heads.get(h, "h9"), b.path[-1][0])
    top = max(words.values(), default=0)
    size = [min(8, (b.text.count(" ") + 1).bit_length()) for b in page]
    out = []
    for i, (b, h) in enumerate(zip(page, holders)):
        out.append([f"cw {min(10, words[h].bit_length())}", f"cl {int(4 * links[h] / max(1, chars[h]))}", f"ch {heads.get(h, '-')}",
                    f"cs {int(4 * words[h] / max(1, top))}", f"pw {size[i - 1] if i else '-'}", f"nw {size[i + 1] if i + 1 < len(page) else '-'}"])
    return out


class Chain:
    """Weights of the field: score of main over other text per feature, and of label pairs."""

    def __init__(self, weights: dict[str, float], steps: np.ndarray, start: float):
        self.weights, self.steps, self.start, self._paths = weights, steps, start, {}

    def unary(self, b: Block, i: int, n: int, around: list[str]) -> float:
        key = tuple(e[:2] for e in b.path)
        known = self._paths.get(key)
        if known is None:
            if len(self._paths) > 50_000:
                self._paths.clear()
            known = self._paths[key] = sum(self.weights.get(f, 0.0) for f in path_features(b.path))
        return known + sum(self.weights.get(f, 0.0) for f in text_features(b, i, n)) + sum(self.weights.get(f, 0.0) for f in around)

    def decode(self, page: list[Block]) -> list[int]:
        """Most likely labels, by Viterbi."""
        if not page:
            return []
        n, back, around = len(page), [], around_features(page)
        (s00, s01), (s10, s11) = self.steps.tolist()
        lo, hi = 0.0, self.unary(page[0], 0, n, around[0]) + self.start
        for i in range(1, n):
            from_lo, from_hi = (0 if lo + s00 >= hi + s10 else 1), (0 if lo + s01 > hi + s11 else 1)
            back.append((from_lo, from_hi))
            lo, hi = max(lo + s00, hi + s10), max(lo + s01, hi + s11) + self.unary(page[i], i, n, around[i])
        label = int(hi >= lo)
        out = [label]
        for step in reversed(back):
            label = step[label]
            out.append(label)
        return out[::-1]

    def text(self, page: str | None) -> str:
        found = blocks(page)
        return "\n\n".join(b.text for b, y in zip(found, self.decode(found)) if y)


def fit(pages: list[list[Block]], labels: list[list[int]], ridge: float = 1e-3, steps: int = 120) -> Chain:
    """Maximum likelihood by Adam on the exact gradient from forward-backward."""
    pages, labels = [p[:MAX_TRAIN_BLOCKS] for p in pages if p], [y[:MAX_TRAIN_BLOCKS] for y in labels if y]
    index: dict[str, int] = {}
    rows, cols = [], []
    n, t = len(pages), max(map(len, pages))
    real, gold = np.zeros((t, n), bool), np.zeros((t, n), np.int64)
    for j, (page, ys) in enumerate(zip(pages, labels)):
        around = around_features(page)
        for i, b in enumerate(page):
            real[i, j], gold[i, j] = True, ys[i]
            for f in path_features(b.path) + text_features(b, i, len(page)) + around[i]:
                rows.append(i * n + j)
                cols.append(index.setdefault(f, len(index)))
    rows, cols, k = np.array(rows), np.array(cols), len(index)
    p = np.zeros(k + 5)
    m, v = np.zeros_like(p), np.zeros_like(p)
    pair_gold = np.zeros((2, 2))
    both = real[1:] & real[:-1]
    np.add.at(pair_gold, (gold[:-1][both], gold[1:][both]), 1)
    for it in range(1, steps + 1):
        w, tr, start = p[:k], p[k:k + 4].reshape(2, 2), p[k + 4]
        u = np.zeros((t, n, 2))
        u[:, :, 1] = np.bincount(rows, w[cols], t * n).reshape(t, n)
        u[0, :, 1] += start
        fw = np.zeros((t, n, 2))
        fw[0] = u[0]
        for i in range(1, t):
            new = np.logaddexp(fw[i - 1, :, 0, None] + tr[0], fw[i - 1, :, 1, None] + tr[1]) + u[i]
            fw[i] = np.where(real[i][:, None], new, fw[i - 1])
        bw = np.zeros((t, n, 2))
        for i in range(t - 2, -1, -1):
            x = bw[i + 1] + u[i + 1]
            new = np.logaddexp(tr[:, 0] + x[:, 0, None], tr[:, 1] + x[:, 1, None])
            bw[i] = np.where(real[i + 1][:, None], new, bw[i + 1])
        z = np.logaddexp(fw[-1, :, 0], fw[-1, :, 1])
        node = np.exp(fw + bw - z[None, :, None])[:, :, 1] * real
        pair = np.zeros((2, 2))
        for a in (0, 1):
            for c in (0, 1):
                pair[a, c] = (np.exp(fw[:-1, :, a] + tr[a, c] + u[1:, :, c] + bw[1:, :, c] - z) * both).sum()
        err = (node - gold * real) / n
        grad = np.r_[np.bincount(cols, err.ravel()[rows], k), ((pair - pair_gold) / n).ravel(), err[0].sum()] + ridge * p
        m, v = 0.9 * m + 0.1 * grad, 0.99 * v + 0.01 * grad ** 2
        p -= 0.15 * (1 - 0.98 * it / steps) * (m / (1 - 0.9 ** it)) / (np.sqrt(v / (1 - 0.99 ** it)) + 1e-8)
    return Chain({f: float(p[i]) for f, i in index.items()}, p[k:k + 4].reshape(2, 2).copy(), float(p[k + 4]))


_MAIN, _OTHER = {"article", "main"}, {"nav", "aside", "footer", "form", "header", "menu", "dialog"}


def landmark_labels(page: list[Block]) -> list[int]:
    """1 for blocks whose innermost landmark is the article's."""
    out = []
    for b in page:
        mark = next((e[0] for e in reversed(b.path) if e[0] in _MAIN or e[0] in _OTHER), None)
        out.append(int(mark in _MAIN))
    return out


# fixed values: how layouts name their parts
MAIN = ["<article>", "<main>", "<main><article>", '<div class="content">', '<div id="main-content">', '<div class="post-body">',
        '<div class="entry-content">', '<section class="article-body">', '<div id="content" class="story">', '<div role="main">', '<div class="text">']
HEADER = ["<header>", '<div id="header">', '<div class="site-header">', '<div class="top-bar">', '<div class="masthead">']
MENU = ["<nav>", '<div class="menu">', '<div id="navigation">', '<ul class="nav">', '<div class="breadcrumb">', '<div role="navigation">']
NOTICE = ['<div class="cookie-notice">', '<div id="cookie-banner">', '<div class="consent">', '<section class="notice">', '<div role="alert" class="alert">', '<div class="gdpr popup">', '<div class="modal">']
ADVERT = ['<div class="ad">', '<div class="advert">', '<div class="ads sponsored">', '<aside class="promo">', '<div id="banner-ad">', '<div class="advertisement">', '<section class="sponsor">']
SIDEBAR = ["<aside>", '<div class="sidebar">', '<div id="sidebar">', '<div class="widget related">', '<div class="related-posts">', '<aside class="recommended">']
COMMENTS = ['<section id="comments">', '<div class="comments">', '<div class="comment-list">', '<section class="discussion comments">', '<div class="reader-comments">', '<ol class="commentlist">', '<div class="comment">', '<div class="responses replies">']
FORM = ["<form>", '<form class="newsletter">', '<div class="subscribe"><form>', '<form id="search">', '<div class="login">']
FOOTER = ["<footer>", '<div id="footer">', '<div class="site-footer">', '<div class="copyright">', '<div role="contentinfo">']
STOCK = ["The quick brown fox jumps over the lazy dog.", "A second sentence follows the first one, as it should.", "Read more", "All rights reserved."]


def layout(rng: np.random.Generator, main: list[str], other: list[str]) -> str:
    """A page with the given texts in a random layout; data-part marks them."""
    plain = rng.random()  # how often a part has a name that tells nothing, or none

    def pick(names):
        name = names[rng.integers(len(names))]
        if rng.random() < plain * 0.6:
            own = "".join(chr(97 + c) for c in rng.integers(26, size=int(rng.integers(2, 7))))
            name = (f'<div class="{own}">', f'<div id="{own}-{rng.integers(99)}">', "<div>", f'<section class="{own}">')[rng.integers(4)]
        return name

    def some(texts):
        return html.escape(texts[rng.integers(len(texts))])

    def wrap(opening: str, label: int, inner: str) -> str:
        opening = re.sub(r"^<(\w+)", rf'<\1 data-part="{label}"', opening)
        return opening + inner + "".join(f"</{t}>" for t in re.findall(r"<(\w+)", opening)[::-1])

    def links(n):
        return "<ul>" + "".join(f'<li><a href="#">{" ".join(some(other + main).split()[:rng.integers(1, 4)])}</a></li>' for _ in range(n)) + "</ul>"

    def para(texts):
        return f"<p>{some(texts)}</p>" if rng.random() < 0.8 else some(texts)

    advert = lambda: wrap(pick(ADVERT), 0, para(other + main))
    notice = lambda: wrap(pick(NOTICE), 0, para(other + main) + ("<button>OK</button>" if rng.random() < 0.5 else ""))
    sidebar = lambda: wrap(pick(SIDEBAR), 0, ("<h3>" + some(other) + "</h3>") * (rng.random() < 0.5) + (links(4) if rng.random() < 0.6 else para(other + main)))
    form = lambda: wrap(pick(FORM), 0, f"<label>{some(other)}</label><input><button>{some(other)}</button>" + para(other) * (rng.random() < 0.5))

    def comments():
        each = ["<p>{}</p>", '<div class="comment"><p>{}</p></div>', '<li class="comment">{}</li>', '<article class="comment"><p>{}</p></article>', '<div class="comment-body">{}</div>', "<div><b>Ann</b><p>{}</p></div>"]
        shape = pick(each)
        return wrap(pick(COMMENTS), 0, "<h3>Comments</h3>" * (rng.random() < 0.5) + "".join(shape.format(some(main)) for _ in range(rng.integers(1, 5))))

    body = []
    for text in main:
        t, r = html.escape(text), rng.random()
        body.append(f"<p>{t}</p>" if r < 0.7 else f"<div>{t}</div>" if r < 0.75 else f"<blockquote><p>{t}</p></blockquote>" if r < 0.8
                    else f"<h2>{t[:60]}</h2>" if r < 0.88 else f"<ul><li>{t}</li></ul>" if r < 0.95 else f"<section><p>{t}</p></section>")
        if rng.random() < 0.08:
            body.append((advert, sidebar, form, notice)[rng.integers(4)]())
    title = f"<h1>{html.escape(main[0][:60])}</h1>"
    inner = (title if rng.random() < 0.6 else wrap("<header>", 1, title) if rng.random() < 0.3 else "") + "".join(body)
    if rng.random() < 0.25:
        inner += comments()
    parts = []
    if rng.random() < 0.3:
        parts.append(notice())
    if rng.random() < 0.7:
        parts.append(wrap(pick(HEADER), 0, para(other) + (wrap(pick(MENU), 0, links(4)) if rng.random() < 0.5 else "")))
    if rng.random() < 0.7:
        parts.append(wrap(pick(MENU), 0, links(int(rng.integers(2, 8)))))
    parts += [make() for make in (advert, sidebar, form) if rng.random() < 0.3]
    parts.append(wrap(pick(MAIN), 1, inner))
    parts += [make() for make in (comments, sidebar, advert, form, notice) if rng.random() < 0.35]
    if rng.random() < 0.85:
        parts.append(wrap(pick(FOOTER), 0, "&copy; " * (rng.random() < 0.6) + para(other)))
    page = "".join(parts)
    return page if rng.random() < 0.6 else f'<div class="{pick(["wrapper", "page", "container", "layout"])}">{page}</div>'


def labelled_pages(found: list[tuple[int, str]], variants: int = VARIANTS) -> tuple[list[list[Block]], list[list[int]]]:
    pages, labels = [], []
    for number, text in found or [(i, None) for i in range(60)]:
        own = blocks(text)
        ys = landmark_labels(own)
        if any(ys) and not all(ys):
            pages.append(own)
            labels.append(ys)
        main = [b.text for b, y in zip(own, ys) if y][:MAX_TEXTS] or STOCK
        other = [b.text for b, y in zip(own, ys) if not y][:MAX_TEXTS] or STOCK
        for v in range(variants):
            made = blocks(layout(np.random.default_rng([number & 0xFFFFFFFF, v]), main, other), marked=True)
            pages.append(made)
            labels.append([b.label if b.label is not None else 0 for b in made])
    return pages, labels


def train(pages: DataFrame, id_col: str = "page_id", html_col: str = "html", bound: int = PAGES) -> Chain:
    ids = (pages.select(F.col(id_col).alias("id")).where("id is not null").distinct()
           .orderBy(F.xxhash64("id"), "id").limit(bound))
    rows = keep_ids(pages.select(F.col(id_col).cast("long").alias("id"), F.col(html_col).alias("html")), ids, "id")
    found = sorted({(r["id"], r["html"]) for r in rows.where("html is not null").collect()})
    return fit(*labelled_pages(found))


def extract(spark: SparkSession, pages: DataFrame, model: Chain, html_col: str = "html", keep: tuple[str, ...] = ("page_id", "url")) -> DataFrame:
    """The kept columns, text and n_chars of every page."""
    shared = spark.sparkContext.broadcast((model.weights, model.steps, model.start))
    kept = [f for f in pages.schema.fields if f.name in keep]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chain = Chain(*shared.value)
        for b in batches:
            text = [chain.text(t) for t in b.column(len(kept)).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(i) for i in range(len(kept))] + [pa.array(text, pa.string()), pa.array([len(t) for t in text], pa.int64())],
                                             names=[f.name for f in kept] + ["text", "n_chars"])
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept) + ", text string, n_chars long"
    return pages.select(*[f.name for f in kept], F.col(html_col).cast("string").alias("_html")).mapInArrow(run, schema)
