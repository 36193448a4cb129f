"""HTML main-text extraction by a recurrent block labeller.

A page is read as a sequence of leaf blocks: the text between two borders of block-level elements (inline
elements don't end a block, ``<br>`` is white space). Comments, scripts, styles and other raw text are no
blocks. A block's features are

* its tag path: the mean vector of the tokens of all elements around it, and the sum of its own element's
  (a token is a tag name or a part of a class, id, role or itemprop value, hashed to ``PATH_SLOTS``);
* its words: the mean vector of all its words and punctuation, lower-cased and hashed to ``WORD_SLOTS``;
* a few numbers (length, share of link text, punctuation, digits, capitals, place on the page).

A bidirectional LSTM in numpy reads the whole page's sequence in both directions and labels every block
as main text or not, so each decision depends on all of the page. The vectors and the LSTM are learned
together (Adam, back-propagation through time).

Learning. Up to ``SAMPLE_PAGES`` pages of at most ``SAMPLE_CHARS`` characters, chosen by a hash, give the
texts. Where such a page has an ``<article>``, it is learned from as it is: blocks in the article, but not
in an element for other purposes inside it, are main text (twice an epoch). Besides, these texts are laid out
anew in ``LAYOUTS`` generated pages whose main blocks are known: with and without ``<article>``, under
various containers, among menus, headers, cookie notices, adverts, forms, sidebars, related links, reader
comments and footers of various tags, classes and languages. Class tokens are left out at random, so that
the labeller doesn't depend on one of them. The fit runs in one task over that bounded sample.

Result: the main blocks of every whole page in page order, character references decoded, runs of white
space (Unicode) turned into one space, trimmed, joined by ``\\n``. A page that is null, empty or without
main text has the empty text. Rows that repeat are extracted alike; page_id and url (null or not) pass
through. An empty table gives no row. Extra columns are ignored.
"""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter
from html import unescape

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratecell.llm.common import MARKS, ship, slices, token_hashes

SAMPLE_PAGES = 400
SAMPLE_CHARS = 1 << 16
SAMPLE_BLOCKS = 40          # paragraphs of a sampled page in one generated layout
LAYOUTS = 2000              # generated pages in all
EPOCHS = 6
PATH_SLOTS, PATH_DIM = 2048, 16
WORD_SLOTS, WORD_DIM = 4096, 8
NUMBERS = 8
HIDDEN = 24
INPUT = 2 * PATH_DIM + WORD_DIM + NUMBERS
CELLS = 1 << 16             # blocks, padding included, that one pass of the LSTM holds

# FIXED values: HTML elements whose content is raw text and no block, elements without content, and
# elements that don't interrupt a line of text.
RAW = frozenset("script style title textarea template iframe noembed noframes xmp svg".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd mark q rp rt ruby s samp "
                   "small span strike strong sub sup time tt u var wbr br img".split())
# An element of these kinds ends an open one of the same kind.
SELF_ENDING = frozenset("p li td th tr dt dd option".split())


# --- reading a page ---------------------------------------------------------------------------------

_TAG = re.compile(r"""<(?:!--.*?(?:-->|\Z)|[!?][^>]*+(?:>|\Z)
    |(/?)([a-zA-Z][^\s/>]*+)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>
    |(/?)([a-zA-Z][^\s/>]*+)([^>]*+)(?:>|\Z))""", re.S | re.X)
_ATTR = re.compile(r"""(?<![\w-])(class|id|role|itemprop|data-main)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])|\d+")
_ends: dict[str, re.Pattern] = {}


def _element(name: str, attrs: str) -> tuple[list[int], list[int], int | None]:
    """Slots of an element's tag, slots of its class and id tokens, and its mark in a generated page."""
    mark, parts = None, []
    for key, *values in _ATTR.findall(attrs):
        value = "".join(values)
        if key.lower() == "data-main":
            mark = int(value)
        else:
            parts += [p.lower() for p in _PART.findall(value)]
    slot = [zlib.crc32(p.encode()) % PATH_SLOTS for p in dict.fromkeys(parts)]
    return [zlib.crc32(b"<" + name.encode()) % PATH_SLOTS], slot, mark


class Page:
    """Blocks of one page: texts, links (characters of link text), at (each one's element number); and its
    elements: names, parents, tags, parts (slots) and marks. Element 0 is the page itself."""

    def __init__(self, html: str):
        self.texts, self.links, self.at = [], [], []
        self.names, self.parents, self.tags, self.parts, self.marks = ["#page"], [-1], [[0]], [[]], [None]
        known: dict = {}
        stack, open_, pieces, link, linked, pos = [0], Counter(), [], 0, 0, 0

        def flush():
            nonlocal link
            text = " ".join("".join(pieces).split())
            if text:
                self.texts.append(text)
                self.links.append(link)
                self.at.append(stack[-1])
            pieces.clear()
            link = 0

        def say(raw: str):
            nonlocal link
            piece = unescape(raw) if "&" in raw else raw
            pieces.append(piece)
            if linked:
                link += len(piece)

        for m in iter(lambda: _TAG.search(html, pos), None):
            if m.start() > pos:
                say(html[pos:m.start()])
            pos = m.end()
            name = m[2] or m[5]
            if not name:
                continue
            name, close, attrs = name.lower(), m[1] or m[4], m[3] or m[6] or ""
            if name in RAW and not close:
                if name not in _ends:
                    _ends[name] = re.compile(rf"</{name}(?=[\s/>])[^>]*+(?:>|\Z)", re.I)
                end = _ends[name].search(html, pos)
                pos = end.end() if end else len(html)
                if name != "svg":
                    flush()
            elif name in INLINE:
                if name == "br":
                    pieces.append(" ")
                elif name == "a":
                    linked = max(linked - 1, 0) if close else linked + 1
            elif close:
                flush()
                if open_[name]:
                    while True:
                        gone = self.names[stack.pop()]
                        open_[gone] -= 1
                        if gone == name:
                            break
                linked = 0
            else:
                flush()
                linked = 0
                if name in VOID:
                    continue
                top = self.names[stack[-1]]
                if top == "p" or (top == name and name in SELF_ENDING):
                    open_[top] -= 1
                    stack.pop()
                key = (name, attrs)
                if key not in known:
                    known[key] = _element(name, attrs)
                tag, part, mark = known[key]
                self.names.append(name)
                self.parents.append(stack[-1])
                self.tags.append(tag)
                self.parts.append(part)
                self.marks.append(mark)
                stack.append(len(self.names) - 1)
                open_[name] += 1
        say(html[pos:])
        flush()


# --- features ---------------------------------------------------------------------------------------

_KINDS = np.zeros((256, 3), np.int32)            # punctuation, digit, capital
_KINDS[[i for i in range(33, 127) if not chr(i).isalnum()], 0] = 1
_KINDS[48:58, 1] = 1
_KINDS[65:91, 2] = 1


def _sums(values: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Sums of consecutive runs of rows; a run may be empty."""
    out = np.zeros((len(sizes), *values.shape[1:]), values.dtype)
    full = sizes > 0
    if full.any():
        out[full] = np.add.reduceat(values, (np.cumsum(sizes) - sizes)[full])
    return out


class Batch:
    """Feature indices of the blocks of several pages."""

    def __init__(self, pages: list[Page], keep=None):
        self.sizes = np.array([len(p.texts) for p in pages], np.int64)
        offset = np.cumsum([0] + [len(p.names) for p in pages])
        parent = np.concatenate([np.array(p.parents, np.int64) + (np.array(p.parents) >= 0) * o
                                 for p, o in zip(pages, offset)])
        depth = np.zeros(len(parent), np.int64)
        for i, p in enumerate(parent.tolist()):
            depth[i] = depth[p] + 1 if p >= 0 else 0
        self.parent, self.depth = parent, depth
        order = np.argsort(depth, kind="stable")
        self.levels = np.split(order, np.cumsum(np.bincount(depth))[:-1])
        tokens = [t + (q if keep is None or keep() else []) for p in pages for t, q in zip(p.tags, p.parts)]
        self.token_count = np.array([len(t) for t in tokens], np.int64)
        self.token_slot = np.array([s for t in tokens for s in t], np.int64)
        self.leaf_node = np.concatenate([np.array(p.at, np.int64) + o for p, o in zip(pages, offset)])
        texts = [t.lower().encode() for p in pages for t in p.texts]
        raw = [t.encode() for p in pages for t in p.texts]
        words, leaf = token_hashes(texts, MARKS)
        self.word_slot = (words % np.uint64(WORD_SLOTS)).astype(np.int64)
        self.word_count = np.bincount(leaf, minlength=len(texts))
        size = np.array([len(t) for t in raw], np.int64)
        kinds = np.zeros((len(raw), 3), np.int32)
        for a, b in slices(len(raw), size.tolist()):
            kinds[a:b] = _sums(_KINDS[np.frombuffer(b"".join(raw[a:b]), np.uint8)], size[a:b])
        chars = np.array([len(t) for p in pages for t in p.texts], np.float32)
        links = np.array([n for p in pages for n in p.links], np.float32)
        place = np.concatenate([np.arange(n) for n in self.sizes])
        whole = np.repeat(self.sizes, self.sizes)
        n_words = self.word_count.astype(np.float32)
        self.numbers = np.stack([
            np.log1p(n_words) / 4, np.log1p(chars) / 8, np.minimum(links / np.maximum(chars, 1), 1),
            *(kinds / np.maximum(chars, 1)[:, None]).T.clip(0, 1), place / np.maximum(whole, 1), 1 / (1 + place)],
            axis=1).astype(np.float32)

    def inputs(self, w: dict) -> np.ndarray:
        """The input rows of all blocks."""
        own = _sums(w["path"][self.token_slot], self.token_count)
        around = own.copy()
        for level in self.levels[1:]:
            around[level] += around[self.parent[level]]
        at = self.leaf_node
        words = np.zeros((len(at), WORD_DIM), np.float32)
        for a, b in slices(len(at), self.word_count.tolist(), 1 << 18):
            lo, hi = self.word_count[:a].sum(), self.word_count[:b].sum()
            words[a:b] = _sums(w["word"][self.word_slot[lo:hi]], self.word_count[a:b])
        words /= np.maximum(self.word_count, 1)[:, None]
        return np.concatenate([around[at] / (self.depth[at] + 1)[:, None], own[at], words, self.numbers], axis=1,
                              dtype=np.float32)

    def input_gradients(self, g: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Gradients of the path and word vectors from those of the input rows."""
        at = self.leaf_node
        around = np.zeros((len(self.parent), PATH_DIM), np.float32)
        np.add.at(around, at, g[:, :PATH_DIM] / (self.depth[at] + 1)[:, None])
        for level in self.levels[:0:-1]:
            np.add.at(around, self.parent[level], around[level])
        np.add.at(around, at, g[:, PATH_DIM:2 * PATH_DIM])
        path = np.zeros((PATH_SLOTS, PATH_DIM), np.float32)
        np.add.at(path, self.token_slot, np.repeat(around, self.token_count, axis=0))
        word = np.zeros((WORD_SLOTS, WORD_DIM), np.float32)
        each = g[:, 2 * PATH_DIM:2 * PATH_DIM + WORD_DIM] / np.maximum(self.word_count, 1)[:, None]
        np.add.at(word, self.word_slot, np.repeat(each, self.word_count, axis=0))
        return path, word


# --- the recurrent network ---------------------------------------------------------------------------

def _sigmoid(x):
    return 0.5 * np.tanh(0.5 * x) + 0.5


def new_weights(rng: np.random.Generator) -> dict[str, np.ndarray]:
    def normal(*shape, scale):
        return (rng.standard_normal(shape) * scale).astype(np.float32)

    w = {"path": normal(PATH_SLOTS, PATH_DIM, scale=0.1), "word": normal(WORD_SLOTS, WORD_DIM, scale=0.1),
         "out": normal(2 * HIDDEN, scale=0.2), "out_b": np.zeros(1, np.float32)}
    for way in ("f", "b"):
        w["x" + way] = normal(INPUT, 4 * HIDDEN, scale=INPUT ** -0.5)
        w["h" + way] = normal(HIDDEN, 4 * HIDDEN, scale=HIDDEN ** -0.5)
        bias = np.zeros(4 * HIDDEN, np.float32)
        bias[HIDDEN:2 * HIDDEN] = 1          # remember by default
        w["c" + way] = bias
    return w


def lstm(x: np.ndarray, live: np.ndarray, w: dict, way: str, trace: list | None = None) -> np.ndarray:
    """States (time, page, HIDDEN) of one direction over inputs (time, page, INPUT); where ``live``
    (time, page, 1) is 0, the state is carried over."""
    steps, n, _ = x.shape
    out = np.zeros((steps, n, HIDDEN), np.float32)
    h = np.zeros((n, HIDDEN), np.float32)
    c = np.zeros((n, HIDDEN), np.float32)
    order = range(steps) if way == "f" else range(steps - 1, -1, -1)
    wx, wh, b = w["x" + way], w["h" + way], w["c" + way]
    k = HIDDEN
    for t in order:
        z = x[t] @ wx + h @ wh + b
        i, f, o, g = _sigmoid(z[:, :k]), _sigmoid(z[:, k:2 * k]), _sigmoid(z[:, 2 * k:3 * k]), np.tanh(z[:, 3 * k:])
        m = live[t]
        new_c = f * c + i * g
        tanh_c = np.tanh(new_c)
        if trace is not None:
            trace.append((t, h, c, i, f, o, g, tanh_c))
        c = m * new_c + (1 - m) * c
        h = m * (o * tanh_c) + (1 - m) * h
        out[t] = h
    return out


def lstm_gradients(x, live, w, way, trace, d_out):
    """Gradients of the inputs and of the direction's three weights."""
    wx, wh = w["x" + way], w["h" + way]
    n = x.shape[1]
    dx = np.zeros_like(x)
    dwx, dwh, db = np.zeros_like(wx), np.zeros_like(wh), np.zeros(4 * HIDDEN, np.float32)
    dh, dc = np.zeros((n, HIDDEN), np.float32), np.zeros((n, HIDDEN), np.float32)
    for t, h, c, i, f, o, g, tanh_c in reversed(trace):
        m = live[t]
        total = dh + d_out[t]
        d_new_h, d_new_c = total * m, dc * m
        d_new_c = d_new_c + d_new_h * o * (1 - tanh_c ** 2)
        dz = np.concatenate([d_new_c * g * i * (1 - i), d_new_c * c * f * (1 - f), d_new_h * tanh_c * o * (1 - o),
                             d_new_c * i * (1 - g ** 2)], axis=1)
        dx[t] = dz @ wx.T
        dwx += x[t].T @ dz
        dwh += h.T @ dz
        db += dz.sum(axis=0)
        dh = total * (1 - m) + dz @ wh.T
        dc = dc * (1 - m) + d_new_c * f
    return dx, {"x" + way: dwx, "h" + way: dwh, "c" + way: db}


def _padded(rows: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, tuple]:
    """Rows of consecutive pages as (time, page, width), which cells are live, and the rows' places."""
    page = np.repeat(np.arange(len(sizes)), sizes)
    time = np.arange(len(rows)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    x = np.zeros((int(sizes.max(initial=0)), len(sizes), rows.shape[1]), np.float32)
    live = np.zeros((*x.shape[:2], 1), np.float32)
    x[time, page] = rows
    live[time, page] = 1
    return x, live, (time, page)


def label(batch: Batch, w: dict) -> np.ndarray:
    """Probability of main text for every block."""
    rows = batch.inputs(w)
    start = np.cumsum(batch.sizes) - batch.sizes
    out = np.zeros(len(rows))
    order = [p for p in np.argsort(batch.sizes, kind="stable") if batch.sizes[p]]
    at = 0
    while at < len(order):
        # pages of similar length go through the network together
        end = at + 1
        while end < len(order) and (end + 1 - at) * batch.sizes[order[end]] <= CELLS:
            end += 1
        group = order[at:end]
        index = np.concatenate([np.arange(start[p], start[p] + batch.sizes[p]) for p in group])
        x, live, (time, page) = _padded(rows[index], batch.sizes[group])
        h = np.concatenate([lstm(x, live, w, "f"), lstm(x, live, w, "b")], axis=2)
        out[index] = _sigmoid((h @ w["out"])[time, page] + w["out_b"][0])
        at = end
    return out


def loss_and_gradients(batch: Batch, truth: np.ndarray, w: dict) -> tuple[float, dict]:
    """Mean cross-entropy of the blocks and its gradients by weight."""
    x, live, (time, page) = _padded(batch.inputs(w), batch.sizes)
    trace_f, trace_b = [], []
    h = np.concatenate([lstm(x, live, w, "f", trace_f), lstm(x, live, w, "b", trace_b)], axis=2)
    p = _sigmoid((h @ w["out"])[time, page] + w["out_b"][0])
    loss = -np.mean(np.log(np.where(truth == 1, p, 1 - p) + 1e-9))
    d = ((p - truth) / len(truth)).astype(np.float32)
    grads = {"out": h[time, page].T @ d, "out_b": np.array([d.sum()], np.float32)}
    dh = np.zeros_like(h)
    dh[time, page] = d[:, None] * w["out"]
    dx_f, more_f = lstm_gradients(x, live, w, "f", trace_f, dh[:, :, :HIDDEN])
    dx_b, more_b = lstm_gradients(x, live, w, "b", trace_b, dh[:, :, HIDDEN:])
    grads |= more_f | more_b
    grads["path"], grads["word"] = batch.input_gradients((dx_f + dx_b)[time, page])
    return float(loss), grads


# --- pages to learn from ------------------------------------------------------------------------------

# FIXED values: elements that hold no main text where they stand in an article, and words in their
# classes that say so.
OTHER_TAGS = frozenset("nav aside footer form header noscript button select menu dialog".split())
OTHER_WORDS = frozenset("ad ads advert advertisement sponsored promo banner menu sidebar footer comments comment cookie "
                        "notice share social related newsletter subscribe breadcrumb widget".split())
_OTHER_SLOTS = frozenset(zlib.crc32(t.encode()) % PATH_SLOTS for t in OTHER_WORDS)

# FIXED values: what generated pages are made of. Containers of main text; then, by purpose, elements with
# their attributes and phrases that stand in such elements.
MAIN = ["article", "main", "article class='post'", "div class='content'", "div id='content'", "div class='post-body'",
        "div class='entry-content'", "section class='story'", "div class='article-body'", "div itemprop='articleBody'",
        "div role='main'", "main id='main-content'", "div class='text'", "div", "section", "td", "body"]
OTHERS = {
    "menu": ["nav", "div class='menu'", "ul class='nav'", "div id='navbar'", "nav class='main-navigation'", "div class='topnav'",
             "div role='navigation'", "menu", "div class='breadcrumbs'", "nav aria-label='Breadcrumb'", "ul id='menu'"],
    "header": ["header", "div class='header'", "div id='masthead'", "header class='site-header'", "div role='banner'",
               "div class='top-bar'", "header id='page-header'"],
    "notice": ["div class='cookie-notice'", "div id='cookie-banner'", "div class='consent'", "div class='notice'",
               "div role='alert'", "section class='gdpr'", "div role='dialog'", "p class='notice'", "noscript",
               "div class='alert warning'", "div class='paywall'", "dialog", "div class='notification'", "aside class='notice'"],
    "advert": ["div class='ad'", "div class='advert'", "aside class='ads'", "div class='sponsored'", "div id='ad-slot'",
               "div class='banner-ad'", "section class='promo'", "div class='advertisement'", "ins class='adsbygoogle'",
               "p class='ad'", "div class='commercial'"],
    "form": ["form", "form class='search'", "form class='newsletter'", "div class='subscribe'", "form id='signup'",
             "div class='login'", "form class='contact-form'", "fieldset"],
    "sidebar": ["aside", "div class='sidebar'", "div id='sidebar'", "aside class='related'", "div class='widget'",
                "section class='recommended'", "div class='right-column'", "div role='complementary'", "aside class='sidebar'",
                "div class='most-read'", "section id='related-posts'", "div class='share-buttons'", "ul class='social'",
                "div class='tags'", "div class='author-box'"],
    "comments": ["section id='comments'", "div class='comments'", "ol class='comment-list'", "div id='disqus_thread'",
                 "section class='reader-comments'", "div class='discussion'", "ul class='replies'", "div class='responses'"],
    "footer": ["footer", "div class='footer'", "div id='footer'", "footer class='site-footer'", "div role='contentinfo'",
               "div class='copyright'", "div class='legal'"],
}
PHRASES = {
    "menu": "Home|About us|Contact|News|Sport|Archive|Start|Über uns|Kontakt|Accueil|À propos|Inicio|Contacto|Next page|Menu",
    "header": "Daily News|The Journal|Log in|Welcome back|Sign up|Anmelden|Connexion|Iniciar sesión|Search this site",
    "notice": "We use cookies to improve your experience.|Accept all|This site uses cookies. Read our privacy policy.|"
              "Please enable JavaScript.|Wir verwenden Cookies.|Nous utilisons des cookies.|Usamos cookies en este sitio.|"
              "You have 2 free articles left this month.|Your browser is out of date.|Alle akzeptieren",
    "advert": "Advertisement|Sponsored|Buy now and save 50%|Special offer|Anzeige|Publicité|Publicidad|Learn more|Shop now",
    "form": "Subscribe to our newsletter|Your e-mail address|Search|Send|Name|Password|Abonnieren|Envoyer|Enviar|Submit",
    "sidebar": "Related articles|Most read|You may also like|Share this|Follow us|Tags|Recent posts|Mehr zum Thema|"
               "Articles liés|Más leídos|About the author|Trending now",
    "comments": "3 comments|Reply|Leave a comment|Posted by guest on 12 May|I totally agree with this.|Great article!|"
                "Report|Kommentare|Antworten|Commentaires|Répondre|Comentarios|Responder|First!|Log in to comment",
    "footer": "© 2024 All rights reserved|Terms of use|Privacy policy|Imprint|Impressum|Datenschutz|Mentions légales|"
              "Aviso legal|Contact us|Powered by",
}
WORDS_WITHOUT_PAGES = ("the sun rose over the quiet town and people went to work while rain was expected later in the day "
                       "der Markt war an diesem Morgen sehr voll le train est arrivé en retard la casa tiene un jardín").split()


def marked_by_article(page: Page) -> np.ndarray | None:
    """Which blocks of a page with an ``<article>`` are main text; None if it has none."""
    inside, other = [False], [False]
    for name, parent, part in zip(page.names[1:], page.parents[1:], page.parts[1:]):
        starts = name == "article"
        inside.append(starts or inside[parent])
        other.append(not starts and (other[parent] or name in OTHER_TAGS or not _OTHER_SLOTS.isdisjoint(part)))
    if not any(inside):
        return None
    return np.array([inside[n] and not other[n] for n in page.at], np.int64)


def marked(page: Page) -> np.ndarray:
    """Which blocks of a generated page are main text."""
    mark = [0]
    for parent, m in zip(page.parents[1:], page.marks[1:]):
        mark.append(mark[parent] if m is None else m)
    return np.array([mark[n] for n in page.at], np.int64)


def _with(element: str, mark: int | None = None) -> tuple[str, str]:
    return f"<{element}{'' if mark is None else f' data-main={mark}'}>", f"</{element.split()[0]}>"


def layout(rng: random.Random, main: list[str], pool: list[str]) -> str:
    """A page that holds ``main`` as its main text; ``pool``: texts to fill the rest with."""
    def words(low, high):
        return " ".join(rng.choice(pool).split()[:rng.randint(low, high)])

    def filler(kind):
        return rng.choice(PHRASES[kind].split("|")) if rng.random() < 0.5 else words(1, 25)

    def links(kind, n):
        items = [f"<a href='/x'>{words(1, 3) if rng.random() < 0.5 else rng.choice(PHRASES[kind].split('|'))}</a>" for _ in range(n)]
        return f"<ul><li>{'</li><li>'.join(items)}</li></ul>" if rng.random() < 0.6 else " | ".join(items)

    def part(kind):
        start, end = _with(rng.choice(OTHERS[kind]), 0)
        if kind in ("menu", "footer") and rng.random() < 0.7:
            inner = links(kind, rng.randint(2, 7)) + (f"<p>{filler(kind)}</p>" if kind == "footer" else "")
        elif kind == "comments":
            inner = "".join(rng.choice([f"<div class='comment'><b>{words(1, 2)}</b><p>{filler(kind)}</p><a href='#'>Reply</a></div>",
                                        f"<li><p>{words(3, 40)}</p></li>", f"<article class='comment'><p>{words(3, 40)}</p></article>"])
                            for _ in range(rng.randint(1, 6)))
            inner = f"<h3>{filler(kind)}</h3>" * rng.randint(0, 1) + inner
            if rng.random() < 0.4:
                inner += f"<form><label>{filler('form')}</label><textarea>x</textarea><button>{filler('form')}</button></form>"
        elif kind == "form":
            inner = f"<label>{filler(kind)}</label><input type=text><button>{filler(kind)}</button>"
        elif kind == "sidebar":
            inner = f"<h{rng.randint(2, 4)}>{filler(kind)}</h3>" + (links(kind, rng.randint(2, 6)) if rng.random() < 0.5
                                                                  else f"<p>{words(4, 40)}</p>" * rng.randint(1, 3))
        else:
            inner = rng.choice(["{}", "<p>{}</p>", "<div><p>{}</p><button>OK</button></div>", "<span>{}</span> <a href='/y'>more</a>"]
                               ).format(filler(kind))
        return start + inner + end

    def block(text):
        text = text.replace("&", "&amp;").replace("<", "&lt;")
        kind = rng.random()
        if kind < 0.72:
            return rng.choice(["<p>{}</p>", "<p>{}", "<p><b>{}<br>", "<p>{}</p>", "<p class='par'>{}</p>"]).format(text)
        if kind < 0.80:
            return "<{0}>{1}</{0}>".format(rng.choice(["h2", "h3", "h4"]), " ".join(text.split()[:rng.randint(2, 10)]))
        if kind < 0.86:
            items = text.split(". ")
            return f"<ul><li>{'</li><li>'.join(items[:6])}</li></ul>" if rng.random() < 0.7 else f"<ol><li>{'<li>'.join(items[:6])}</ol>"
        return rng.choice(["<blockquote><p>{}</p></blockquote>", "<div>{}</div>", "<pre>{}</pre>", "<table><tr><td>{}</td></tr></table>",
                           "<p>{} <a href='/z'>link</a> <i>text</i></p>", "<section><p>{}</p></section>"]).format(text)

    def some(kinds, share):
        return [part(k) for k in kinds if rng.random() < share]

    top = some(["notice", "header", "menu", "form", "advert", "menu"], 0.45)
    if rng.random() < 0.3:
        top += some(["sidebar", "notice"], 0.5)
    if rng.random() < 0.12:             # articles that repeat a line or a word, as junk pages do
        at, line = rng.randint(0, len(main)), words(1, 8)
        main = main[:at] + ([line] * rng.randint(3, 90) if rng.random() < 0.7 else [" ".join(line.split()[:1] * 30)] * 2) + main[at:]
    # Notices and the like also occur as lines of an article.
    blocks = [block(t if rng.random() < 0.95 else filler(rng.choice(list(PHRASES)))) for t in main]
    if rng.random() < 0.75:
        blocks.insert(0, f"<h1>{' '.join(main[0].split()[:9]) or words(2, 8)}</h1>")
    for kind in ("advert", "sidebar", "form", "notice", "menu", "footer"):
        if rng.random() < 0.15:
            blocks.insert(rng.randint(0, len(blocks)), part(kind))
    if rng.random() < 0.2:
        blocks.append(part("comments"))
    start, end = _with(rng.choice(MAIN), 1)
    content = start + "".join(blocks) + end
    for _ in range(rng.choice([0, 0, 1, 2])):
        content = f"<div class='{rng.choice(['wrapper', 'container', 'row', 'page', 'x1', 'inner', 'layout', 'site'])}'>{content}</div>"
    rest = some(["sidebar", "comments", "advert", "form", "sidebar", "notice"], 0.35)
    if rng.random() < 0.8:
        rest.append(part("footer"))
    head = "<!DOCTYPE html><html><head><title>x</title><style>p{}</style></head><body>" if rng.random() < 0.9 else ""
    script = "<script>var a='</p>'</script>"
    parts = top + [content] + rest
    return head + "".join(p + (script if rng.random() < 0.1 else "") + ("<!-- x -->" if rng.random() < 0.1 else "") for p in parts) + \
        ("</body></html>" if rng.random() < 0.9 else "")


def train(pages: list[str], epochs: int = EPOCHS, seed: int = 1) -> dict[str, np.ndarray]:
    """Weights learned from pages and from layouts of their texts."""
    rng = random.Random(seed)
    real = []
    for html in pages:
        page = Page(html)
        truth = marked_by_article(page)
        if truth is not None and len(truth):
            real.append((page, truth))
    stories = [[t for t, m in zip(p.texts, truth) if m] for p, truth in real]
    stories = [s for s in stories if s]
    if len(stories) < 20:
        stories += [[" ".join(rng.choices(WORDS_WITHOUT_PAGES, k=rng.randint(8, 60))) + "." for _ in range(rng.randint(1, 12))]
                    for _ in range(60)]
    pool = [t for s in stories for t in s]
    examples = 2 * [x for x in real if len(x[1]) <= 4 * SAMPLE_BLOCKS]
    for story in stories:
        for _ in range(-(-LAYOUTS // len(stories))):
            a = rng.randrange(len(story))
            page = Page(layout(rng, story[a:a + rng.randint(1, SAMPLE_BLOCKS)], pool))
            if page.texts:
                examples.append((page, marked(page)))
    gen = np.random.default_rng(seed)
    w = new_weights(gen)
    first = {k: np.zeros_like(v) for k, v in w.items()}
    second = {k: np.zeros_like(v) for k, v in w.items()}
    step, size = 0, 32
    total = epochs * -(-len(examples) // size)
    for _ in range(epochs):
        rng.shuffle(examples)
        for a in range(0, len(examples), size):
            some = sorted(examples[a:a + size], key=lambda e: len(e[1]))
            batch = Batch([e[0] for e in some], keep=lambda: rng.random() > 0.15)
            _, grads = loss_and_gradients(batch, np.concatenate([e[1] for e in some]), w)
            norm = np.sqrt(sum(float((g ** 2).sum()) for g in grads.values()))
            step += 1
            rate = 0.01 * (1 - 0.9 * step / total)
            for k, g in grads.items():
                g = g * min(1, 5 / (norm + 1e-9))
                first[k] = 0.9 * first[k] + 0.1 * g
                second[k] = 0.999 * second[k] + 0.001 * g * g
                w[k] -= (rate * (first[k] / (1 - 0.9 ** step)) / (np.sqrt(second[k] / (1 - 0.999 ** step)) + 1e-8)).astype(np.float32)
    return w


# --- Spark ----------------------------------------------------------------------------------------------

def fit(pages: DataFrame) -> dict[str, np.ndarray]:
    """Weights learned in one task from at most ``SAMPLE_PAGES`` pages."""
    ship(pages.sparkSession)
    small = pages.select(F.col("html").cast("string").alias("html"), F.xxhash64("page_id", "url").alias("h")).where(
        F.length("html") <= SAMPLE_CHARS)
    # About thrice the sample by a threshold on the hash, then the smallest hashes of those.
    share = min(1.0, 3 * SAMPLE_PAGES / max(pages.count(), 1))
    some = small.where(F.pmod("h", F.lit(1 << 30)) < int(share * (1 << 30))).orderBy("h", "html").limit(SAMPLE_PAGES)

    def run(found: pd.DataFrame) -> pd.DataFrame:
        w = train(found.sort_values(["h", "html"])["html"].tolist())
        return pd.DataFrame({"name": list(w), "shape": [list(v.shape) for v in w.values()],
                             "data": [v.astype("<f4").tobytes() for v in w.values()]})

    rows = some.groupBy().applyInPandas(run, "name string, shape array<int>, data binary").collect()
    if not rows:
        return train([])
    return {r["name"]: np.frombuffer(r["data"], "<f4").reshape(r["shape"]) for r in rows}


def extract(pages: DataFrame, weights: dict[str, np.ndarray] | None = None) -> DataFrame:
    """page_id, url, text, n_chars of every page."""
    spark = pages.sparkSession
    ship(spark)
    p = pages.select("page_id", F.col("url").cast("string").alias("url"),
                     F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"))
    w = weights or fit(pages)

    def run(batches):
        for batch in batches:
            html = batch.column(2).to_pylist()
            out = []
            for a, b in slices(len(html), [len(h) for h in html]):
                found = [Page(h) for h in html[a:b]]
                main = iter(label(Batch(found), w) >= 0.5)
                out += ["\n".join([t for t in page.texts if next(main)]) for page in found]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(out, pa.string()), pa.array([len(t) for t in out], pa.int64())],
                ["page_id", "url", "text", "n_chars"])

    id_type = p.schema["page_id"].dataType.simpleString()
    return p.mapInArrow(run, f"page_id {id_type}, url string, text string, n_chars long")
