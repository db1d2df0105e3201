"""Main text of web pages by a tree-structured graphical model over the DOM.

Every element has a hidden label, content or not. A unary potential scores the element's own features (tags, links in it
and in its parent, length, sentences, place and share of its text, elements like it, words of classes, ids and roles), and a
pairwise potential ties it to its parent's label, by kind of tag. Messages are passed from the leaves up and back down (sum-product, exact on a tree), and a
text block is kept if the marginal of the element that holds it says content. All potentials are fitted together to
labelled pages, by the gradient of their likelihood, which the same messages give. As no labelled pages are given, the
labelled ones are composed here; in half of them no tag, class or role tells the parts apart.

Defined cases: a null or empty page has no text; a broken or cut page is read as far as it goes; an open tag that its
context closes (p, li, ...) is closed; repeated rows are pages of their own; columns other than the named ones are ignored.
"""

from __future__ import annotations

import html as entities
import re
from collections import Counter
from collections.abc import Iterator
from functools import cached_property, lru_cache
from math import exp, log1p

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .storage import light_batches
from .text import slices

_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<(script|style|template|noscript|textarea|select|svg|iframe|title)\b[^>]*>.*?(?:</\1\s*>|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|\Z)", re.S | re.I)
_CUT_TAG = re.compile(r"<[a-zA-Z/!?]")
_ATTR = re.compile(r"\b(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_WORD = re.compile(r"[a-z]+")
#: Tags without content, tags that start a block, and the open tags that a new one closes.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset("html head body address article aside blockquote dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr li main nav ol p pre section summary table tbody td tfoot th thead tr ul".split())
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
_INLINE = frozenset("a abbr b bdi bdo cite code em font i kbd label mark q s small span strong sub sup u var".split())
#: Elements that name what they hold.
_PARTS = frozenset("main article nav aside footer header form dialog".split())
_STOPS = ".!?\u3002\u0964"
_SPACE = re.compile(r"\s+")


class Page:
    """parent, tag and attributes of each element in page order (0 is the root), and the text blocks (element, text).

    Read in one pass: what is open is counted, never searched for, so depth and stray end tags cost nothing more.
    """

    def __init__(self, source: str):
        self.parent, self.tag, self.words, self.inside, self.before = [-1], ["root"], [()], [""], [0]
        self.text, self.linked, self.own, self.marks = [0], [0], [0], [0]
        self.blocks: list[tuple[int, str]] = []
        stack, holders, paragraphs, opened = [0], [0], [], {}  # open elements, those that hold text, those that a block ends
        open_parts, total, at = [], 0, 0
        holder = 0

        def text(raw: str) -> None:
            nonlocal holder, total
            if raw:
                if not open_parts:
                    holder = holders[-1]
                open_parts.append(raw)
                n = len(raw) - raw.count(" ")
                self.text[stack[-1]] += n
                self.own[holder] += n
                total += n
                if opened.get("a"):
                    self.linked[stack[-1]] += n

        def close() -> None:
            whole = _SPACE.sub(" ", entities.unescape("".join(open_parts))).strip()
            open_parts.clear()
            if whole:
                self.blocks.append((holder, whole))
                self.marks[holder] += sum(map(whole.count, _STOPS))

        def pop() -> str:
            n = stack.pop()
            name = self.tag[n]
            opened[name] -= 1
            if name not in _INLINE:
                holders.pop()
            if name == "p":
                paragraphs.pop()
            return name

        for m in _TOKEN.finditer(source):
            text(source[at : m.start()])
            at = m.end()
            ending, name = m[2], (m[3] or "").lower()
            if not name:
                continue
            if name == "br":
                text(" ")
                continue
            if name in BLOCK:
                close()
            if ending:
                if opened.get(name):
                    while pop() != name:
                        pass
                continue
            if name in BLOCK and paragraphs and holders[-1] == paragraphs[-1]:  # a block ends an open paragraph
                while pop() != "p":
                    pass
            while self.tag[stack[-1]] in CLOSES.get(name, ()):
                pop()
            up, n = stack[-1], len(self.tag)
            self.parent.append(up)
            self.tag.append(name)
            for count in (self.text, self.linked, self.own, self.marks):
                count.append(0)
            self.before.append(total)
            self.inside.append(name if name in _PARTS else self.inside[up])
            self.words.append(tuple(sorted({w for a in _ATTR.finditer(m[4]) for w in _WORD.findall((a[2] or a[3] or a[4] or "").lower())})) if m[4] else ())
            if name not in VOID and not (m[4] or "").endswith("/"):
                stack.append(n)
                opened[name] = opened.get(name, 0) + 1
                if name not in _INLINE:
                    holders.append(n)
                if name == "p":
                    paragraphs.append(n)
        cut = _CUT_TAG.search(source, at)
        text(source[at : cut.start()] if cut else source[at:])
        close()
        for n in range(len(self.tag) - 1, 0, -1):
            self.text[self.parent[n]] += self.text[n]
            self.linked[self.parent[n]] += self.linked[n]
        self.alike = Counter(zip(self.parent, self.tag, strict=True))
        self.has_main = any(t in ("main", "article") and size for t, size in zip(self.tag, self.text, strict=True))

    @cached_property
    def keys(self) -> list[tuple]:
        return [self.key(n) for n in range(len(self.tag))]

    @cached_property
    def all_features(self) -> list[list[str]]:
        known: dict[tuple, list[str]] = {}
        return [known[k] if k in known else known.setdefault(k, features(k)) for k in self.keys]

    def key(self, n: int) -> tuple:
        """What is known of an element, in a few steps each: equal for elements that look alike."""
        size, whole, up = self.text[n], max(1, self.text[0]), self.parent[n]
        above = self.text[up] if n else 0
        place = (self.before[n] * 2 + size) / (2 * whole)
        return (
            self.tag[n], self.tag[up] if n else "", 5 * self.linked[n] // size if size else -1, 5 * self.linked[up] // above if above else -1, min(6, size.bit_length() // 2), min(6, self.own[n].bit_length() // 2),
            min(2, self.marks[n]) if self.own[n] else -1, min(3, self.alike[up, self.tag[n]].bit_length()), 5 * size // whole, 0 if place < 0.15 else 2 if place > 0.85 else 1,
            self.inside[n], self.has_main, min(5, whole.bit_length() // 3), self.words[n], self.words[up] if n else (),
        )

    def features(self, n: int) -> list[str]:
        return features(self.key(n))


#: Names of the first parts of ``Page.key``; the page's length counts together with others only.
_NAMES = ("tag", "parent", "link", "uplink", "size", "own", "marks", "alike", "share", "place", "inside", "main")


def features(key: tuple) -> list[str]:
    """Features of an element: its tag and its parent's, links and text in it, its place and its likes, and words of both elements' attributes."""
    inside, main, own = key[10], key[11], key[5]
    joint = [f"inside={inside},main={main}", f"whole={key[12]},main={main}", f"whole={key[12]},inside={inside}", f"inside={inside},own={own}", f"own={own},marks={key[6]}", f"own={own},link={key[2]}", f"place={key[9]},own={own}"]
    return ["bias", *(f"{n}={v}" for n, v in zip(_NAMES, key[:12], strict=True)), *joint, *(f"word={w}" for w in key[-2]), *(f"up={w}" for w in key[-1])]


def _log_sum(a: float, b: float) -> float:
    return max(a, b) + log1p(exp(-abs(a - b)))


def _kind(tag: str) -> str:
    return "inline" if tag in _INLINE else "section" if tag in ("div", "section", "td", "ul", "ol", "table", "body", "html", "root") else "leaf" if tag in ("p", "li", "h1", "h2", "h3", "h4", "h5", "h6", "pre", "blockquote", "dd", "dt", "figcaption", "tr", "tbody") else "part"


class Model:
    """Log potentials: weights of features (content against not) and, by kind of tag, log P(label | parent's label)."""

    def __init__(self, unary: dict[str, float], pair: dict[str, list[list[float]]]):
        self.unary, self.pair = unary, pair

    def beliefs(self, page: Page, edges: bool = True) -> tuple[np.ndarray, list | None]:
        """P(content) of each element, and per element below the root the log weights of (parent's label, own label)."""
        n = len(page.tag)
        kinds = [self.pair[_kind(t)] for t in page.tag]
        known: dict[tuple, float] = {}
        score = []
        for key in page.keys:
            if key not in known:
                known[key] = sum(self.unary.get(f, 0.0) for f in features(key))
            score.append(known[key])
        up0, up1 = [0.0] * n, list(score)  # beliefs of the element from itself and what is below it
        sent: list[tuple[float, float]] = [(0.0, 0.0)] * n
        for i in range(n - 1, 0, -1):
            (t00, t01), (t10, t11) = kinds[i]
            b0, b1 = up0[i], up1[i]
            m0, m1 = _log_sum(t00 + b0, t01 + b1), _log_sum(t10 + b0, t11 + b1)
            sent[i] = (m0, m1)
            above = page.parent[i]
            up0[above] += m0
            up1[above] += m1
        full0, full1, rests = list(up0), list(up1), [(0.0, 0.0)] * n
        for i in range(1, n):  # downwards: what the parent knows without this child
            (t00, t01), (t10, t11) = kinds[i]
            above, (m0, m1) = page.parent[i], sent[i]
            r0, r1 = full0[above] - m0, full1[above] - m1
            rests[i] = (r0, r1)
            full0[i] += _log_sum(r0 + t00, r1 + t10)
            full1[i] += _log_sum(r0 + t01, r1 + t11)
        content = 1 / (1 + np.exp(np.clip(np.asarray(full0) - np.asarray(full1), -700, 700)))
        return content, [None, *([[rests[i][a] + kinds[i][a][b] + (up0, up1)[b][i] for b in (0, 1)] for a in (0, 1)] for i in range(1, n))] if edges else None

    def marginals(self, page: Page) -> np.ndarray:
        return self.beliefs(page, False)[0]

    def extract(self, source: str | None) -> str:
        if not source:
            return ""
        page = Page(source)
        content = self.marginals(page)
        return "\n".join(text for holder, text in page.blocks if content[holder] >= 0.5)


def _start(pages: list[tuple[Page, list[int]]], steps: int, rate: float, l2: float) -> Model:
    """Where the fit starts: logistic weights of the elements by themselves, and smoothed counts of label pairs."""
    names: dict[str, int] = {}
    rows, y = [], []
    pair = {k: [[1.0, 1.0], [1.0, 1.0]] for k in ("inline", "section", "leaf", "part")}
    for page, labels in pages:
        for n in range(len(page.tag)):
            rows.append([names.setdefault(f, len(names)) for f in page.all_features[n]])
            y.append(labels[n])
            if n:
                pair[_kind(page.tag[n])][labels[page.parent[n]]][labels[n]] += 1
    sizes = np.asarray([len(r) for r in rows])
    flat, of, target = np.concatenate(rows), np.repeat(np.arange(len(rows)), sizes), np.asarray(y, np.float64)
    w = np.zeros(len(names))
    counts = np.maximum(np.bincount(flat, minlength=len(names)), 5)
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(np.bincount(of, w[flat], len(rows)), -30, 30)))
        w -= rate * (np.bincount(flat, (p - target)[of], len(names)) / counts + l2 * w)
    return Model({f: float(w[k]) for f, k in names.items()}, {k: np.log(np.asarray(t) / np.asarray(t).sum(axis=1, keepdims=True)).tolist() for k, t in pair.items()})


def gradient(model: Model, page: Page, labels: list[int]) -> tuple[float, dict[str, float], dict[str, np.ndarray]]:
    """Log-likelihood of the page's labels, and its gradient by unary and pairwise potentials: observed less expected."""
    content, edges = model.beliefs(page)
    unary: dict[str, float] = {}
    pair = {k: np.zeros((2, 2)) for k in model.pair}
    total = 0.0
    for n, label in enumerate(labels):
        p = content[n] if label else 1 - content[n]
        for f in page.all_features[n]:
            unary[f] = unary.get(f, 0.0) + label - content[n]
        if n:
            e = np.asarray(edges[n])
            e = np.exp(e - e.max())
            e /= e.sum()
            above = labels[page.parent[n]]
            pair[_kind(page.tag[n])] -= e
            pair[_kind(page.tag[n])][above, label] += 1
            total += np.log(max(e[above, label] / max(e[above].sum(), 1e-300), 1e-300))  # given the parent's label
        else:
            total += np.log(max(p, 1e-300))
    return total, unary, pair


def train(pages: list[tuple[Page, list[int]]], steps: int = 200, rate: float = 0.5, l2: float = 1e-3, rounds: int = 5) -> Model:
    """Fit all potentials on pages whose elements are labelled, a page at a time, by the gradient of the labels' likelihood."""
    model = _start(pages, steps, rate, l2)
    for k in range(rounds):
        step = 0.1 / (1 + k)
        for page, labels in pages:
            _, unary, pair = gradient(model, page, labels)
            for f, g in unary.items():
                model.unary[f] += step * (g / len(labels) ** 0.5 - l2 * model.unary[f])
            for kind, g in pair.items():
                model.pair[kind] = (np.asarray(model.pair[kind]) + step * g / len(labels) ** 0.5).tolist()
    return model


#: Layouts of the labelled pages, as (opening tag, closing tag) of parts that hold content or do not.
CONTENT = ["<article>|</article>", "<main>|</main>", '<div class="content">|</div>', '<div id="main-content">|</div>', '<div class="post entry">|</div>', '<section class="article body">|</section>', '<div class="story text">|</div>', '<div role="main">|</div>']
OTHER = [
    "<nav>|</nav>", "<header>|</header>", "<footer>|</footer>", "<aside>|</aside>", "<form>|</form>",
    '<div class="ad">|</div>', '<div class="ads advert banner">|</div>', '<div class="sponsored promo advertisement">|</div>', '<aside class="sidebar">|</aside>', '<div class="sidebar widget">|</div>',
    '<div class="cookie notice consent">|</div>', '<div id="cookies" class="notice">|</div>', '<div class="alert newsletter subscribe popup">|</div>', '<div class="menu navigation">|</div>', '<ul class="menu nav">|</ul>',
    '<div class="breadcrumb">|</div>', '<section class="comments">|</section>', '<div id="comments" class="comment reply">|</div>', '<section class="related recommended">|</section>', '<div class="share social">|</div>',
    '<div class="footer copyright">|</div>', '<div class="header masthead">|</div>', '<div role="navigation">|</div>', '<div role="banner">|</div>', '<div role="complementary">|</div>', '<div role="contentinfo">|</div>', '<div class="login search form">|</div>', "<dialog>|</dialog>",
]


#: Plain openings of parts without a name of their own.
PLAIN = ["|", "<div>|</div>", "<div><div>|</div></div>", "<table><tr><td>|</td></tr></table>", "<section>|</section>", "<center>|</center>"]


class Composer:
    """Labelled pages from layouts. A block's first letter is its label: C for content, N for anything else.

    Half of the pages name their parts by tags, classes and roles; the others don't, and hold only what can be told by its form
    beside the content: lists and rows of links, forms, buttons, short notices. What stands beside a named article is none of it,
named or not. Some pages are nothing but a few blocks.
    """

    def __init__(self, seed: int, content: list[str] | None = None, other: list[str] | None = None, plain: list[str] | None = None, named: float = 0.35, few: float = 0.3):
        self.named, self.few = named, few
        self.rng, self.layouts, self.others, self.plain = np.random.default_rng(seed), content or CONTENT, other or OTHER, plain or PLAIN

    def number(self, low: int, high: int) -> int:
        return int(self.rng.integers(low, high))

    def one(self, of: list) -> str:
        return of[self.number(0, len(of))]

    def prose(self, mark: str, most: int, stops: bool = True) -> str:
        words = ["loremipsum"[:k] for k in self.rng.integers(1, 9, self.number(1, max(2, most))).tolist()]  # their lengths are all that counts
        for k in range(self.number(4, 12), len(words), self.number(6, 14)):
            words[k - 1] += "." if stops else ""
        return mark + " ".join(words) + ("." if stops and self.rng.random() < 0.9 else "")

    def links(self, mark: str, n: int) -> list[str]:
        return [f"<a href=x>{self.prose(mark, 4, False)}</a>" for _ in range(n)]

    def content(self) -> list[str]:
        c, p = self.prose, self.number
        every = [
            f"<h2>{c('C', 7, False)}</h2>", f"<ul><li>{c('C', 14)}</li><li>{c('C', 14)}</li><li>{c('C', 4, False)}</li></ul>", f"<blockquote>{c('C', 30)}</blockquote>", f"<p><b>{c('C', 40)}<br><p>{c('C', 30)} <a href=x>{c('', 3)}</a> {c('', 20)}</p>",
            f"<pre>{c('C', 20)}</pre>", f"<div>{c('C', 30)}</div>", f"<table><tr><td>{c('C', 6, False)}</td><td>{c('C', 6, False)}</td></tr></table>", f"<section><p>{c('C', 60)}</p></section>", f"<figure><figcaption>{c('C', 8)}</figcaption></figure>", f"<p>{c('C', 4)}</p>", f"<ol><li>{c('C', 9)}</li></ol>", f"<dl><dt>{c('C', 3, False)}</dt><dd>{c('C', 15)}</dd></dl>",
        ]
        body = [f"<p>{c('C', 90)}</p>" for _ in range(p(1, 9))] + [x for x in every if self.rng.random() < 0.3]
        self.rng.shuffle(body)
        return [*([f"<h1>{c('C', 10, False)}</h1>"] if self.rng.random() < 0.8 else []), *body]

    def noise(self, plain: bool) -> str:
        items = self.links("N", self.number(2, 9))
        every = [f"<ul>{''.join(f'<li>{a}</li>' for a in items)}</ul>", "<div>" + self.one([" | ", " ", " &middot; "]).join(items) + "</div>", f"<label>{self.prose('N', 4, False)}</label><input><button>{self.prose('', 2, False)}</button>", "".join(f"<div>{a}</div>" for a in items), f"<p>{self.prose('N', 6, False)} {' '.join(items[:3])}</p>"]
        if not plain:
            every += [self.prose("N", 14), f"<p>{self.prose('N', 25)}</p>", f"<h3>{self.prose('N', 5, False)}</h3><p>{self.prose('N', 40)}</p><p>{self.prose('N', 20)}</p>", f"<div>{self.prose('N', 20)}</div>"] * 2
        return self.one(every)

    def wrapped(self, layout: str, inner: str) -> str:
        opening, closing = layout.split("|")
        return opening + inner + closing

    def source(self) -> str:
        kind = self.rng.random()
        if kind < self.few:  # a few blocks and nothing else
            if kind < self.few / 3:
                if self.rng.random() < 0.4:  # with a part that its tag names, inside or outside
                    small = self.wrapped(self.one([*self.others, "<form>|</form>", "<nav>|</nav>"]), self.one([self.noise(False), self.prose("N", 5, False), f"<label>{self.prose('N', 2, False)}</label>"]))
                    near = self.one([f"<p>{self.prose('C', 5, False)}</p>", self.prose("C", 6), f"<h1>{self.prose('C', 3)}</h1><p>{self.prose('C', 9)}</p>"])
                    return self.one([f"<main>{near}{small}</main>", f"<article>{near}{small}</article>", f"<main>{near}</main>{small}", f"{small}<article>{near}</article>", f"<body>{small}<div>{near}</div></body>", f"{small}{near}"])
                return self.wrapped(self.one(["|", "<body>|</body>", "<html><body>|</body></html>", "<div>|</div>", "<html><head><title>x</title></head><body>|"]), self.prose("C", self.one([1, 3, 6, 12, 60, 200]), self.rng.random() < 0.5))
            inner = self.one(["".join(self.content()[: self.number(1, 4)]), self.prose("C", 40), f"<h1>{self.prose('C', 3, False)}</h1><p>{self.prose('C', 4)}</p>", f"<p>{self.prose('C', 3, False)}</p><p>{self.prose('C', 3, False)}</p>", f"<main>{self.prose('C', 3, False)}<ul><li>{'</li><li>'.join(self.links('C', 2))}</li></ul></main>"])
            if self.rng.random() < 0.25:  # links that belong to the text
                inner = self.wrapped(self.one(["<main>|</main>", "<article>|</article>"]), self.one(["", f"<p>{self.prose('C', 12)}</p>", f"<h1>{self.prose('C', 5, False)}</h1>"]) + f"<ul><li>{'</li><li>'.join(self.links('C', self.number(1, 5)))}</li></ul>" + self.one(["", f"<p>{self.prose('C', 12)}</p>"]))
            return self.wrapped(self.one(["|", "<body>|</body>", "<html><body>|</body></html>", "<div>|</div>"]), inner)
        named = kind < self.few + self.named
        body = self.content()
        if named and self.rng.random() < 0.5:
            body.insert(self.number(1, len(body) + 1), self.wrapped(self.one(self.others), self.noise(False)))
        if named and self.rng.random() < 0.3:
            body.append(f"<ul><li>{'</li><li>'.join(self.links('C', self.number(2, 5)))}</li></ul>")
        parts = [self.wrapped(self.one(self.others if named else self.plain), self.noise(not named)) for _ in range(self.number(1, 6))]
        layout = self.one(self.layouts if named else self.plain)
        if layout.startswith(("<article", "<main")) and self.rng.random() < 0.6:  # what stands beside a named article needs no name
            parts += [self.wrapped(self.one(self.plain), self.noise(False)) for _ in range(self.number(1, 3))]
        parts.insert(self.number(0, len(parts) + 1), self.wrapped(layout, "".join(body)))
        return self.wrapped(self.one(["|", "<div class=wrapper>|</div>", "<div id=page class=container>|</div>"]), "".join(parts)).join(("<html><body>", "</body></html>"))

    def page(self) -> tuple[Page, list[int]]:
        page = Page(self.source())
        labels = [-1] * len(page.tag)
        for holder, text in page.blocks:
            labels[holder] = max(labels[holder], int(text[0] == "C"))
        for k in range(len(page.tag) - 1, 0, -1):  # an element around content is content
            up = page.parent[k]
            if labels[k] >= 0 and page.tag[up] not in ("body", "html", "root") and not set(page.words[up]) & {"wrapper", "container"}:
                labels[up] = max(labels[up], labels[k])
        return page, [max(0, v) for v in labels]


@lru_cache(maxsize=4)
def labelled_pages(n: int = 1000, seed: int = 5) -> list[tuple[Page, list[int]]]:
    composer = Composer(seed)
    return [composer.page() for _ in range(n)]


@lru_cache(maxsize=1)
def default_model() -> Model:
    """The model fitted to ``labelled_pages``; a process fits it once."""
    return train(labelled_pages())


def extract_main_text(pages: DataFrame, model: Model | None = None, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Rows (page_id, url, text, n_chars), one per page."""
    sent = pages.sparkSession.sparkContext.broadcast(model or default_model())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "html", 4 << 20):
            texts = [sent.value.extract(source.as_py()) for source in part.column("html")]
            yield pa.RecordBatch.from_arrays([part.column("id"), part.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], ["page_id", "url", "text", "n_chars"])

    rows = light_batches(pages).select(F.col(id_col).cast("long").alias("id"), F.col(url_col).cast("string").alias("url"), F.col(html_col).alias("html"))
    return rows.mapInArrow(run, "page_id long, url string, text string, n_chars long")
