"""Main text of web pages by a recurrent block labeller.

A page is cut into its leaf blocks of text: the text between two tags of block elements, with
comments, scripts, styles and form controls left out, character references decoded and white
space turned into single spaces. Every block has the path of the block elements around it (tag
names and the words of their class, id and role, hashed), its words (hashed) and a few measures.
A bidirectional LSTM in numpy reads the page's blocks in order, so each label depends on the
whole page; the blocks labelled as main text are joined by an empty line.

The labeller is fitted to ``TRAIN_PAGES`` pages (the first ``TRAIN_CHARS`` characters of each),
taken by hash. There are no labels, so the pages themselves give them: text below ``article`` or
``main`` (else blocks of ``LONG_WORDS`` words) is main text. As one site's markup teaches too
little, each page's text is also laid out anew ``LAYOUTS`` times: main text in one of many usual
containers, and around it menus, headers, sidebars, notices, adverts, forms, comments and
footers filled with text of other pages. Neither seeds nor samples depend on the partitioning.

Edge cases: null and empty html, and pages without main text, give an empty text; null ids and
urls and repeated rows are pages like any other; unclosed or stray tags and cut-off pages are
read as browsers would, roughly; a very long page is read whole, at about 300 bytes of a task's
memory a block besides its text; an empty table gives an empty result; other columns of the
input pass unused.
"""

from __future__ import annotations

import html as entities
import random
import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dailylake.llm.common import chunks, table

TRAIN_PAGES, TRAIN_CHARS, LAYOUTS, LONG_WORDS = 96, 100_000, 9, 12
PATH_SLOTS, WORD_SLOTS, VECTOR, MEASURES, HIDDEN = 1 << 12, 1 << 13, 16, 6, 20
EPOCHS, BATCH, RATE = 10, 32, 0.01
#: How often a pass reads the sampled pages as they are.
AS_THEY_ARE = 4
STEADY = 0.98
#: Share of a block's marks and words that a pass of the fit leaves out.
LEFT_OUT = {"path": 0.1, "word": 0.4}
#: Marks of the path that a block keeps, innermost first to stay.
PATH_MARKS = 48
#: Padded blocks that one pass of the labeller holds.
CELLS = 1 << 15

_RAW = "script|style|textarea|title|iframe|noscript|xmp|noembed|noframes"
_TOKEN = re.compile(
    rf"<!--.*?(?:--!?>|\Z)|<({_RAW})(?=[\s/>])[^>]*>.*?(?:</\1(?=[\s/>])[^>]*>|\Z)|<[!?][^>]*(?:>|\Z)|</(?![a-zA-Z])[^>]*(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>=]++|=\s*+\"[^\"]*+\"|=\s*+'[^']*+'|=)*+)>|<[a-zA-Z/][^>]*\Z", re.S | re.I)
_ATTRIBUTE = re.compile(r"(?:^|[\s\"'/])(class|id|role)\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+)", re.I)
_NAME = re.compile(r"[a-z]+|[0-9]+")
#: Block elements: their tags end a block of text.
_BLOCK = frozenset(
    "address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "header hgroup hr html ins legend li main menu nav object ol optgroup option p pre search section select summary svg table tbody td template tfoot "
    "th thead tr ul".split())
_VOID = frozenset(["hr"])
_HEADINGS = frozenset(["h1", "h2", "h3", "h4", "h5", "h6"])
#: Text below these is no text of the page.
_CONTROLS = frozenset(["button", "select", "option", "optgroup", "svg", "template", "object"])
#: An open element of the second group is closed by the first; the search ends at the third.
_CLOSES = {
    "li": (("li",), ("ul", "ol", "menu", "dir")), "dt": (("dt", "dd"), ("dl",)), "dd": (("dt", "dd"), ("dl",)), "option": (("option",), ("select",)),
    "td": (("td", "th"), ("tr", "table")), "th": (("td", "th"), ("tr", "table")), "tr": (("tr",), ("table",)),
    "tbody": (("tbody", "thead", "tfoot"), ("table",)), "tfoot": (("tbody", "thead", "tfoot"), ("table",))}


@dataclass(frozen=True, slots=True)
class Block:
    text: str
    path: tuple[int, ...]
    tag: str
    linked: float
    main: bool | None


def _slot(kind: str, word: str, slots: int) -> int:
    return zlib.crc32(f"{kind}:{word}".encode()) % slots


def _marks(tag: str, attributes: str) -> tuple[int, ...]:
    words = [w for _, value in _ATTRIBUTE.findall(attributes) for w in _NAME.findall(value.lower())] if "=" in attributes else []
    return (_slot("tag", tag, PATH_SLOTS), *(_slot("name", w, PATH_SLOTS) for w in words[:8]))


def blocks(page: str, marked: bool = False) -> list[Block]:
    """The leaf blocks of a page. ``marked`` reads labels from ``data-main`` attributes and from article and main."""
    out: list[Block] = []
    # open block elements: tag, marks of the path, inside a control, label
    stack: list[tuple[str, tuple[int, ...], bool, bool | None]] = [("", (), False, None)]
    opened: Counter[str] = Counter()
    held: list[str] = []
    chars = [0, 0]
    in_link = False

    def flush() -> None:
        if held:
            text = " ".join("".join(held).split())
            tag, path, control, main = stack[-1]
            if text and not control:
                out.append(Block(text, path, tag, chars[1] / max(1, chars[0]), main))
            held.clear()
            chars[0] = chars[1] = 0

    def close(tag: str) -> None:
        flush()
        while True:
            top = stack.pop()[0]
            opened[top] -= 1
            if top == tag:
                return

    def said(raw: str) -> None:
        text = entities.unescape(raw) if "&" in raw else raw
        held.append(text)
        n = len(text.strip())
        chars[0] += n
        chars[1] += n * in_link

    at = 0
    for m in _TOKEN.finditer(page):
        if m.start() > at:
            said(page[at:m.start()])
        at = m.end()
        if not m[3]:
            continue
        tag, ends = m[3].lower(), bool(m[2])
        if tag == "br":
            held.append(" ")
        elif tag == "a":
            in_link = not ends
        elif tag not in _BLOCK:
            continue
        elif ends:
            if opened[tag] > 0:
                close(tag)
            elif tag == "p":
                flush()
        else:
            flush()
            if stack[-1][0] == "p" or tag in _HEADINGS and stack[-1][0] in _HEADINGS:
                close(stack[-1][0])
            if tag in _CLOSES and any(opened[t] for t in _CLOSES[tag][0]):
                same, bounds = _CLOSES[tag]
                for top, *_ in reversed(stack):
                    if top in same:
                        close(top)
                        break
                    if top in bounds:
                        break
            if tag in _VOID:
                continue
            _, path, control, main = stack[-1]
            if marked:
                sign = re.search(r'data-main="([01])"', m[4])
                main = sign[1] == "1" if sign else True if tag in ("article", "main") else main
            stack.append((tag, (path + _marks(tag, m[4]))[-PATH_MARKS:], control or tag in _CONTROLS, main))
            opened[tag] += 1
    if at < len(page):
        said(page[at:])
    flush()
    return out


def _words(text: str) -> list[int]:
    return [zlib.crc32(w.encode("utf-8", "replace")) % WORD_SLOTS for w in text.lower().split()]


def _measures(block: Block, n_words: int) -> list[float]:
    text = block.text
    return [
        np.log1p(n_words) / 3, block.linked, float(text[-1] in ".!?…:;\"'”»"), float(block.tag in _HEADINGS), float(block.tag == "p"),
        sum(text.count(c) for c in ".,;") / max(1, n_words)]


# --- The network: inputs x of a page's blocks, two LSTMs, one label a block -----------------

Weights = dict[str, np.ndarray]


def initial(rng: np.random.Generator) -> Weights:
    """Random matrices; the vectors of path marks and words start at zero, so unseen ones say nothing."""
    size = 2 * VECTOR + MEASURES
    made: Weights = {"path": np.zeros((PATH_SLOTS, VECTOR)), "word": np.zeros((WORD_SLOTS, VECTOR))}
    for way in ("ahead", "back"):
        made[f"{way}_x"] = rng.normal(0, size**-0.5, (size, 4 * HIDDEN))
        made[f"{way}_h"] = rng.normal(0, HIDDEN**-0.5, (HIDDEN, 4 * HIDDEN))
        bias = np.zeros(4 * HIDDEN)
        bias[HIDDEN:2 * HIDDEN] = 1.0  # the forget gate is open at first
        made[f"{way}_b"] = bias
    made["out"] = rng.normal(0, (2 * HIDDEN) ** -0.5, 2 * HIDDEN)
    made["out_b"] = np.zeros(1)
    return {k: v.astype(np.float32) for k, v in made.items()}


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def _step(z: np.ndarray, c: np.ndarray) -> tuple[np.ndarray, ...]:
    i, f, o = (_sigmoid(z[:, k * HIDDEN:(k + 1) * HIDDEN]) for k in range(3))
    g = np.tanh(z[:, 3 * HIDDEN:])
    c = f * c + i * g
    return i, f, o, g, c, np.tanh(c)


def lstm(x: np.ndarray, w: Weights, way: str) -> np.ndarray:
    """Hidden states (steps, pages, HIDDEN) for inputs (steps, pages, size)."""
    steps, n, _ = x.shape
    out = np.empty((steps, n, HIDDEN), np.float32)
    h = c = np.zeros((n, HIDDEN), np.float32)
    for a in range(0, steps, 512):
        zx = x[a:a + 512] @ w[f"{way}_x"] + w[f"{way}_b"]
        for t in range(len(zx)):
            _, _, o, _, c, s = _step(zx[t] + h @ w[f"{way}_h"], c)
            out[a + t] = h = o * s
    return out


def lstm_gradient(x: np.ndarray, w: Weights, way: str) -> tuple[np.ndarray, object]:
    """Hidden states, and a function from their gradient to those of the inputs and weights."""
    steps, n, _ = x.shape
    zx = x @ w[f"{way}_x"] + w[f"{way}_b"]
    h = c = np.zeros((n, HIDDEN), np.float32)
    kept, hs = [], [h]
    for t in range(steps):
        i, f, o, g, now, s = _step(zx[t] + h @ w[f"{way}_h"], c)
        kept.append((i, f, o, g, c, s))
        c, h = now, o * s
        hs.append(h)

    def backward(dout: np.ndarray) -> tuple[np.ndarray, Weights]:
        dz = np.empty((steps, n, 4 * HIDDEN), np.float32)
        dh = dc = np.zeros((n, HIDDEN), np.float32)
        for t in range(steps - 1, -1, -1):
            i, f, o, g, before, s = kept[t]
            dh = dh + dout[t]
            dc = dc + dh * o * (1 - s * s)
            dz[t] = np.concatenate([dc * g * i * (1 - i), dc * before * f * (1 - f), dh * s * o * (1 - o), dc * i * (1 - g * g)], axis=1)
            dc = dc * f
            dh = dz[t] @ w[f"{way}_h"].T
        flat = dz.reshape(-1, 4 * HIDDEN)
        past = np.stack(hs[:-1]).reshape(-1, HIDDEN)
        return dz @ w[f"{way}_x"].T, {
            f"{way}_x": x.reshape(len(flat), -1).T @ flat, f"{way}_h": past.T @ flat, f"{way}_b": flat.sum(0)}

    return np.stack(hs[1:]), backward


def _reversal(lengths: np.ndarray, steps: int) -> np.ndarray:
    """Step of each page's mirrored order; padding stays behind."""
    t = np.arange(steps)[:, None]
    return np.where(t < lengths, lengths - 1 - t, t)


def _means(vectors: np.ndarray, rows: list) -> np.ndarray:
    return np.stack([vectors[r].mean(0) if len(r) else np.zeros(VECTOR, np.float32) for r in rows])


def inputs(page: list[Block], w: Weights) -> np.ndarray:
    """One row for each block: mean vector of its path marks, of its words, and the measures."""
    path: dict[tuple[int, ...], np.ndarray] = {}
    out = np.empty((len(page), 2 * VECTOR + MEASURES), np.float32)
    for k, b in enumerate(page):
        if b.path not in path:
            path[b.path] = w["path"][list(b.path)].sum(0) if b.path else 0.0
        words = _words(b.text)
        out[k, :VECTOR] = path[b.path]
        out[k, VECTOR:2 * VECTOR] = w["word"][words].mean(0)
        out[k, 2 * VECTOR:] = _measures(b, len(words))
    return out


def label(pages: list[np.ndarray], w: Weights) -> list[np.ndarray]:
    """Whether each block is main text, for pages given by their inputs; pages of like length go together."""
    out: list[np.ndarray] = [np.zeros(0, bool)] * len(pages)
    order = sorted((k for k in range(len(pages)) if len(pages[k])), key=lambda k: len(pages[k]))
    while order:
        steps = len(pages[order[-1]])
        group = [order.pop() for _ in range(min(len(order), max(1, CELLS // steps)))]
        lengths = np.array([len(pages[k]) for k in group])
        x = np.zeros((steps, len(group), 2 * VECTOR + MEASURES), np.float32)
        for j, k in enumerate(group):
            x[:lengths[j], j] = pages[k]
        mirror, column = _reversal(lengths, steps), np.arange(len(group))
        ahead = lstm(x, w, "ahead")
        back = lstm(x[mirror, column], w, "back")[mirror, column]
        score = ahead @ w["out"][:HIDDEN] + back @ w["out"][HIDDEN:] + w["out_b"]
        for j, k in enumerate(group):
            out[k] = score[:lengths[j], j] > 0
    return out


# --- Fitting -------------------------------------------------------------------------------

#: Usual containers (tag and class or id words) of main text and of what stands around it.
_MAIN = (
    "article", "main", "article.post", "main#content", "div.content", "div#content", "div.post", "div.post-body", "div.entry-content", "div.article",
    "div.article-body", "div.story-body", "section.text", "section.article-content", "div#main", "div.main-content", "td.content", "div.body-text", "div")
_AROUND = {
    "menu": ("nav", "ul.menu", "div.nav", "div.navbar", "div#navigation", "ol.breadcrumb", "div.breadcrumbs", "nav.top-nav", "ul.tabs", "div.menu", "div.toc"),
    "header": ("header", "div.header", "div#header", "header.site-header", "div.masthead", "div.top-bar", "div.banner", "div.branding"),
    "side": ("aside", "div.sidebar", "div#sidebar", "aside.widget", "div.widget", "div.related", "section.related-posts", "div.recommended", "div.popular",
             "div.trending", "div.rail", "td.sidebar", "div.secondary", "div.teasers", "div.more"),
    "notice": ("div.cookie-notice", "div.cookie", "div#cookie-banner", "div.consent", "div.gdpr", "div.notice", "div.alert", "div.banner-message", "dialog",
               "div.popup", "div.modal", "div.disclaimer", "section.notification", "aside.notice", "div.paywall", "p.notice"),
    "advert": ("div.ad", "div.ads", "div.advert", "div.advertisement", "ins.adsbygoogle", "div.sponsored", "div.promo", "aside.ad", "section.promotion",
               "div.ad-slot", "div.sponsor", "p.ad"),
    "form": ("form", "form.search", "form#login", "div.newsletter", "div.subscribe", "div.signup", "form.contact", "div.search-box", "div.login", "fieldset"),
    "comments": ("section.comments", "div.comments", "div#comments", "ol.comment-list", "div.comment", "div.discussion", "div.replies", "section#respond",
                 "div.reader-comments", "div.feedback", "ul.commentlist", "div.reviews", "div#disqus-thread", "aside.comments"),
    "share": ("div.share", "div.social", "ul.tags", "div.sharing", "div.post-meta", "div.author-box", "div.byline", "div.pagination", "div.follow"),
    "footer": ("footer", "div.footer", "div#footer", "footer.site-footer", "div.copyright", "div.legal", "div.bottom", "div.colophon"),
}
#: Phrases that usually stand in these places.
_PHRASES = {
    "menu": ("Home", "About us", "Contact", "News", "Sport", "Products", "Blog", "Next", "Previous"),
    "header": ("Welcome", "Daily news", "Sign in", "The home of good reading"),
    "side": ("Related articles", "Most read", "You may also like", "Recent posts", "Archives", "Read more"),
    "notice": ("We use cookies to improve your experience on this site.", "Accept all", "This site uses cookies.", "Please accept our privacy policy.",
               "You have reached your limit of free articles.", "By continuing you agree to our terms of use."),
    "advert": ("Advertisement", "Sponsored", "Buy now and save", "Limited offer", "Shop today"),
    "form": ("Subscribe to our newsletter", "Your email address", "Search", "Log in", "Password", "Send", "Name"),
    "comments": ("Comments", "Reply", "Leave a comment", "3 comments", "says:", "Report", "I agree", "Great article, thanks!"),
    "share": ("Share this", "Tweet", "Follow us", "Tags", "Posted by", "Print", "2 min read"),
    "footer": ("© 2024 All rights reserved.", "Privacy policy", "Terms of use", "Imprint", "Powered by", "Contact us"),
}


def _element(rng: random.Random, kind: str, inner: str, sign: str = "", bare: float = 0.0) -> str:
    """``kind`` is a tag with class or id words; ``bare`` is the chance to leave these out."""
    tag, mark, words = re.fullmatch(r"(\w+)([.#]?)(.*)", kind).groups()
    name = {".": "class", "#": "id"}.get(mark)
    if name and rng.random() < bare:
        name = None
    if name and rng.random() < 0.3:
        words += rng.choice(["-wrapper", " box", " block", "-area", " clearfix", "-inner", " col-8"])
    start = f'<{tag}{f" {name}={chr(34)}{words}{chr(34)}" if name else ""}{sign}>'
    body = f"{start}{inner}</{tag}>"
    return f"<table><tr>{body}</tr></table>" if tag == "td" else body


def _around(rng: random.Random, kind: str, prose: list[str]) -> str:
    """Markup of one menu, notice, comment section and so on."""
    phrase = lambda: rng.choice(_PHRASES[kind]) if rng.random() < 0.6 else " ".join(rng.choice(prose).split()[:rng.randint(1, 5)])
    text = lambda n=60: " ".join(rng.choice(prose).split()[:rng.randint(4, n)])
    links = lambda n: "".join(f'<li><a href="/x">{phrase()}</a></li>' for _ in range(n))
    wrap = lambda s: rng.choice(["<p>{}</p>", "<div>{}</div>", "<span>{}</span>", "{}"]).format(s)
    made = {
        "menu": lambda: f"<ul>{links(rng.randint(2, 9))}</ul>" if rng.random() < 0.8 else rng.choice([" | ", " ", "<br>"]).join(f'<a href="/x">{phrase()}</a>' for _ in range(4)),
        "header": lambda: wrap(phrase()) + (f"<h1>{phrase()}</h1>" if rng.random() < 0.3 else "") + (f"<p>{text(12)}</p>" if rng.random() < 0.4 else ""),
        "side": lambda: f"<h3>{phrase()}</h3>" + (f"<ul>{links(rng.randint(2, 6))}</ul>" if rng.random() < 0.5 else "".join(f"<p>{text(30)}</p>" for _ in range(rng.randint(1, 4)))),
        "notice": lambda: wrap(phrase() if rng.random() < 0.5 else text(30)) + (f"<button>{phrase()}</button>" if rng.random() < 0.5 else wrap(phrase())),
        "advert": lambda: wrap(text(25)) + (wrap(phrase()) if rng.random() < 0.4 else ""),
        "form": lambda: "".join(f"<label>{phrase()}</label><input name=q>" for _ in range(rng.randint(1, 3))) + wrap(phrase()) + (f"<p>{text(20)}</p>" if rng.random() < 0.4 else ""),
        "comments": lambda: f"<h3>{phrase()}</h3>" * (rng.random() < 0.7) + "".join(
            rng.choice(["<div class=comment>{}</div>", "<li>{}</li>", "{}", "<article class=comment data-main=\"0\">{}</article>"]).format(
                wrap(phrase()) + "".join(f"<p>{text()}</p>" for _ in range(rng.randint(1, 2)))) for _ in range(rng.randint(1, 5))),
        "share": lambda: wrap(phrase()) + (f"<ul>{links(3)}</ul>" if rng.random() < 0.4 else wrap(phrase())),
        "footer": lambda: wrap(phrase()) + (f"<p>{text(20)}</p>" if rng.random() < 0.5 else "") + (f"<ul>{links(3)}</ul>" if rng.random() < 0.4 else ""),
    }[kind]()
    return _element(rng, rng.choice(_AROUND[kind]), made, ' data-main="0"', 0.1 if kind in ("menu", "footer") else 0.0)


def lay_out(rng: random.Random, own: list[str], prose: list[str]) -> str:
    """A page with ``own`` as its main text, marked as such, and other text around it."""
    around = lambda kind, chance: _around(rng, kind, prose) if rng.random() < chance else ""
    body = []
    if rng.random() < 0.7:
        head = f"<h1>{' '.join(own[0].split()[:8])}</h1>"
        body.append(f"<header>{head}</header>" if rng.random() < 0.2 else head)
    phrases = [p for kind in _PHRASES.values() for p in kind]
    for text in own:
        if rng.random() < 0.15:  # short lines, and such as stand elsewhere, in the main text
            body.append(f"<p>{rng.choice(phrases) if rng.random() < 0.5 else ' '.join(rng.choice(prose).split()[:rng.randint(1, 4)])}</p>")
        body.append(rng.choices(
            ["<p>{}</p>", "<div>{}</div>", "<p><b>{}</b><br>", "<ul><li>{}</li></ul>", "<blockquote>{}</blockquote>", "<h2>{}</h2>", "<table><tr><td>{}</td></tr></table>",
             "<figure><figcaption>{}</figcaption></figure>", "<p>{} <a href=/y>more of it</a> here.</p>", "<pre>{}</pre>"],
            [30, 3, 2, 3, 2, 2, 1, 1, 3, 1])[0].format(entities.escape(text)))
        body.append(around("advert", 0.06) + around("share", 0.03) + around("side", 0.02) + around("notice", 0.02) + around("form", 0.02))
    if rng.random() < 0.12:  # columns of a table
        beside = [f'<td{rng.choice(["", " class=left", " class=menu", " width=20"])}>{_around(rng, rng.choice(["menu", "side", "advert"]), prose)}</td>' for _ in range(rng.randint(1, 2))]
        cells = beside[:1] + [f'<td{rng.choice(["", " class=content", " class=text", " id=main"])} data-main="1">{"".join(body)}</td>'] + beside[1:]
        main = f'<table><tr>{"".join(cells)}</tr></table>'
    else:
        main = _element(rng, rng.choice(_MAIN), "".join(body), ' data-main="1"', 0.25)
    before = [around("notice", 0.3), around("header", 0.6), around("menu", 0.7), around("advert", 0.3), around("side", 0.25), around("form", 0.2)]
    after = [around("share", 0.3), around("advert", 0.2), around("comments", 0.5), around("side", 0.4), around("form", 0.3), around("menu", 0.2), around("footer", 0.7), around("notice", 0.2)]
    if rng.random() < 0.5:
        rng.shuffle(before)
    if rng.random() < 0.3:
        rng.shuffle(after)
    page = "".join(before) + main + "".join(after)
    for _ in range(rng.randint(0, 2)):
        page = _element(rng, rng.choice(["div.wrapper", "div.container", "div#page", "div.row", "div", "section", "div.site", "div.layout"]), page)
    return f'<html><body data-main="0">{page}</body></html>'


def examples(pages: list[str]) -> list[list[Block]]:
    """Labelled blocks of the pages as they are, where their markup tells, and of their text laid out anew."""
    parsed = [blocks(p, marked=True) for p in pages]
    told = any(b.main for page in parsed for b in page)
    own = [[b.text for b in page if (b.main if told else len(b.text.split()) >= LONG_WORDS)] for page in parsed]
    own = [[" ".join(t.split()[:120]) for t in texts[:12]] for texts in own if texts] or [[p for k in _PHRASES.values() for p in k if len(p) > 20]]
    prose = sorted({t for texts in own for t in texts})
    out = [page for page in parsed if any(b.main for b in page)] * AS_THEY_ARE
    for k, texts in enumerate(own):
        rng = random.Random(k)
        for _ in range(LAYOUTS * max(1, TRAIN_PAGES // len(own))):
            some = texts[:rng.randint(1, len(texts))]
            out.append(blocks(lay_out(rng, some, prose), marked=True))
    return [page[:400] for page in out if page]


def train(pages: list[list[Block]], epochs: int = EPOCHS) -> Weights:
    """Weights of the network by Adam on the log loss of the blocks' labels."""
    rng = np.random.default_rng(7)
    w = initial(rng)
    moved = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in w.items()}
    steady = {k: v.copy() for k, v in w.items()}  # the running mean of the weights, which is the result
    words = [[np.array(_words(b.text)) for b in p] for p in pages]
    paths = [[np.array(b.path, dtype=np.int64) for b in p] for p in pages]
    rest = [np.array([_measures(b, len(x)) for b, x in zip(p, ws)], np.float32) for p, ws in zip(pages, words)]
    truth = [np.array([bool(b.main) for b in p], np.float32) for p in pages]
    step = 0
    for epoch in range(epochs):
        order = rng.permutation(len(pages))
        for a in range(0, len(order), BATCH):
            group = sorted(order[a:a + BATCH].tolist(), key=lambda k: -len(pages[k]))
            lengths = np.array([len(pages[k]) for k in group])
            steps, n = int(lengths.max()), len(group)
            at = np.concatenate([np.arange(m) * n + j for j, m in enumerate(lengths)])  # cell of each block
            flat = {}
            x = np.zeros((steps * n, 2 * VECTOR + MEASURES), np.float32)
            for name, lists, mean, cols in (("path", paths, False, slice(0, VECTOR)), ("word", words, True, slice(VECTOR, 2 * VECTOR))):
                # some marks and words are left out, so that no one of them decides
                kept = [i[rng.random(len(i)) > LEFT_OUT[name]] for k in group for i in lists[k]]
                count = np.array([len(i) for i in kept])
                cell = np.repeat(at, count)
                share = (1 / np.repeat(np.maximum(count, 1), count) if mean else np.ones(len(cell))).astype(np.float32)
                ids = np.concatenate(kept) if len(cell) else np.zeros(0, np.int64)
                held = w[name][ids] * share[:, None]
                x[:, cols] = np.stack([np.bincount(cell, held[:, v], steps * n) for v in range(VECTOR)], axis=1)
                flat[name] = (ids, cell, share, cols)
            x[at, 2 * VECTOR:] = np.concatenate([rest[k] for k in group])
            x = x.reshape(steps, n, -1)
            mirror, column = _reversal(lengths, steps), np.arange(n)
            ahead, ahead_back = lstm_gradient(x, w, "ahead")
            back, back_back = lstm_gradient(x[mirror, column], w, "back")
            both = np.concatenate([ahead, back[mirror, column]], axis=2)
            y = np.zeros(steps * n, np.float32)
            weight = np.zeros(steps * n, np.float32)
            y[at], weight[at] = np.concatenate([truth[k] for k in group]), 1 / len(at)
            d = ((_sigmoid(both @ w["out"] + w["out_b"]).reshape(-1) - y) * weight).reshape(steps, n, 1).astype(np.float32)
            dboth = d * w["out"]
            dx, grad = ahead_back(dboth[:, :, :HIDDEN])
            dx_back, more = back_back(dboth[:, :, HIDDEN:][mirror, column])
            dx = (dx + dx_back[mirror, column]).reshape(steps * n, -1)
            grad |= more | {"out": (both * d).sum((0, 1)), "out_b": d.sum().reshape(1)}
            for name, (ids, cell, share, cols) in flat.items():
                g = dx[cell][:, cols] * share[:, None]
                grad[name] = np.stack([np.bincount(ids, g[:, v], len(w[name])) for v in range(VECTOR)], axis=1) + 1e-5 * w[name]
            step += 1
            rate = RATE * (1 - 0.9 * epoch / epochs)
            for k, g in grad.items():
                m, v = moved[k]
                m += 0.1 * (g - m)
                v += 0.01 * (g * g - v)
                w[k] -= (rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)).astype(np.float32)
                steady[k] += (1 - min(STEADY, step / (step + 10))) * (w[k] - steady[k])
    return steady


def fit(pages: DataFrame, html_col: str = "html") -> Weights:
    """The labeller's weights, from ``TRAIN_PAGES`` pages at most."""
    part = pages.select(F.substring(html_col, 1, TRAIN_CHARS).alias("html")).where("html is not null")
    some = part.orderBy(F.xxhash64("html"), "html").limit(TRAIN_PAGES)
    return train(examples([r["html"] for r in some.collect()]))


def extract(pages: DataFrame, weights: Weights | None = None, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``page_id``, ``url`` and the main ``text`` of every page."""
    spark = pages.sparkSession
    shared = spark.sparkContext.broadcast(weights or fit(pages, html_col))

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w = shared.value
        for part in chunks(batches, text_col=2, limit=4 << 20):
            parsed = [blocks(t or "") for t in part.column(2).to_pylist()]
            kept = label([inputs(p, w) for p in parsed], w)
            texts = ["\n\n".join(b.text for b, k in zip(p, keep) if k) for p, keep in zip(parsed, kept)]
            yield pa.RecordBatch.from_arrays([part.column(0).combine_chunks(), part.column(1).combine_chunks(), pa.array(texts, pa.string())], ["page_id", "url", "text"])

    kind = pages.schema[id_col].dataType.simpleString()
    own = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"))
    return own.mapInArrow(task, f"page_id {kind}, url string, text string")


def main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Registered query: the main text of every page."""
    return extract(table(spark, sf_dir, "pages")).withColumn("n_chars", F.length("text").cast("long"))
