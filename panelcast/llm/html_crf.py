"""Main text of web pages by a linear-chain conditional random field.

The leaf blocks of a page form a chain; each has features of its ancestors'
tags and names (class, id, role), of its text (length, share of links, end
mark), of the text around it in the same container and of its neighbours in
the chain. On pages without ``article`` and ``main`` the text features have
weights of their own, so that such a page is told by its text where its names
say nothing. A CRF with two labels, main
text or not, is trained on labelled pages by maximum likelihood (forward and
backward sums, L2, Adam) and decodes each page by Viterbi; the blocks it marks
are the text.

Labelled pages are of two kinds: pages written by ``labelled_pages`` from
templates that state each block's label (with semantic elements and usual
names, and plain ones: bare bodies, unnamed or strangely named boxes, tables), and a bounded sample (``SAMPLE_PAGES``
by a hash of the HTML) of given pages whose own semantic elements label them
(inside ``article`` or ``main``, or in navigation, headers, footers, asides,
forms). Everything else covers all pages: extraction is one pass of Arrow
batches without a shuffle.

Cases: null or empty HTML, or a page without main text, gives an empty text;
broken markup is read as far as it goes; a page of any length is read whole;
equal rows are extracted alike; an empty table gives no rows; other columns
are kept by ``extract`` as they are. Time is in proportion to the page: the
scores of an element's ancestors are summed once per element.
"""

from __future__ import annotations

import random
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelcast.llm.html_blocks import Block, Element, leaf_blocks

SAMPLE_PAGES = 200
TEMPLATE_PAGES = 1000


# ---- features ---------------------------------------------------------------------------------

@dataclass
class BlockFeatures:
    """A block's own features and, through its element, those of all its ancestors."""

    own: tuple[str, ...]
    element: Element | None

    def __iter__(self):
        yield from self.own
        if self.element:
            for e in self.element.path():
                yield from e.fresh


def _bucket(n: float, edges: tuple) -> int:
    return sum(n >= x for x in edges)


_WORDS, _LINKS, _AROUND = (2, 4, 8, 15, 30, 60), (0.01, 0.3, 0.7), (5, 15, 40, 100, 250)


def features(blocks: list[Block]) -> list[BlockFeatures]:
    plain = not any(b.element and b.element.in_main for b in blocks)
    words = [b.text.count(" ") + 1 for b in blocks]
    shape = [f"{_bucket(w, _WORDS)}{_bucket(b.link_chars / len(b.text), _LINKS)}" for w, b in zip(words, blocks)]
    around: dict[int, list[float]] = {}
    for w, b in zip(words, blocks):
        box = around.setdefault(id(b.element and b.element.container), [0, 0, 0])
        box[0] += w
        box[1] += b.link_chars
        box[2] += len(b.text)
    out = []
    for at, b in enumerate(blocks):
        e = b.element
        near, tag = e and e.near, e.tag if e else "none"
        box = around[id(e and e.container)]
        text = f"box:{_bucket(box[0], _AROUND)}{_bucket(box[1] / box[2], _LINKS)}"
        f = ["bias", f"leaf:{tag}", f"words:{shape[at][0]}", f"links:{shape[at][1]}", f"stop:{b.text[-1] in '.!?…:;'}", text,
             f"prev:{shape[at - 1] if at else 'none'}", f"next:{shape[at + 1] if at + 1 < len(blocks) else 'none'}"]
        if near is not None:
            f += [f"near:{near.tag}", *dict.fromkeys(f"near:{n}" for n in near.names if n != near.tag)]
        if "©" in b.text:
            f.append("copyright")
        if at == 0:
            f.append("first")
        if at == len(blocks) - 1:
            f.append("last")
        if len(blocks) == 1:
            f.append("only")
        if plain:
            f += ["plain", *[f"plain:{x}" for x in f[1:8]], f"plain:{shape[at]}", f"plain:{tag}:{shape[at]}"]
        out.append(BlockFeatures(tuple(f), e))
    return out


# ---- model ------------------------------------------------------------------------------------

@dataclass
class Crf:
    """Weights (feature x label), transitions (label x label), start weights; label 1 is main text."""

    index: dict[str, int]
    emit: np.ndarray
    move: np.ndarray
    start: np.ndarray

    def scores(self, chain: list[BlockFeatures]) -> np.ndarray:
        if not hasattr(self, "_weight"):
            self._weight = {name: tuple(self.emit[i].tolist()) for name, i in self.index.items()}
        weight, above = self._weight, {}

        def add(a: float, b: float, names) -> tuple[float, float]:
            for x in names:
                if x in weight:
                    w = weight[x]
                    a, b = a + w[0], b + w[1]
            return a, b
        out = []
        for f in chain:
            # the nearest ancestor whose sum is known, then down again
            path, e = [], f.element
            while e is not None and id(e) not in above:
                path.append(e)
                e = e.parent
            total = above[id(e)] if e is not None else (0.0, 0.0)
            for e in reversed(path):
                total = above[id(e)] = add(*total, e.fresh)
            out.append(add(*total, f.own))
        return np.array(out).reshape(-1, 2)

    def decode(self, chain: list[BlockFeatures]) -> list[int]:
        """Viterbi: the likeliest labels of the whole chain."""
        if not chain:
            return []
        s, m, back = self.scores(chain).tolist(), self.move.tolist(), []
        a0, a1 = s[0][0] + self.start[0], s[0][1] + self.start[1]
        for e0, e1 in s[1:]:
            from0 = (a0 + m[0][0], a1 + m[1][0])
            from1 = (a0 + m[0][1], a1 + m[1][1])
            back.append((int(from0[1] > from0[0]), int(from1[1] > from1[0])))
            a0, a1 = max(from0) + e0, max(from1) + e1
        label = int(a1 > a0)
        labels = [label]
        for pair in reversed(back):
            label = pair[label]
            labels.append(label)
        return labels[::-1]


def train(chains: list[list[BlockFeatures]], labels: list[list[int]], steps: int = 200, l2: float = 1e-3, rate: float = 0.1) -> Crf:
    """Maximum likelihood with L2 by Adam; all chains at once, padded."""
    pairs = [(c, y) for c, y in zip(chains, labels) if c]
    index = {f: i for i, f in enumerate(sorted({f for c, _ in pairs for block in c for f in block}))}
    n, width = len(pairs), max((len(c) for c, _ in pairs), default=1)
    block, feature = [], []
    gold, real = np.zeros((n, width), dtype=int), np.zeros((n, width), dtype=bool)
    for i, (c, y) in enumerate(pairs):
        gold[i, :len(y)], real[i, :len(y)] = y, True
        for t, f in enumerate(c):
            known = [index[x] for x in f]
            block += [i * width + t] * len(known)
            feature += known
    block, feature = np.array(block, dtype=int), np.array(feature, dtype=int)
    emit, move, start = np.zeros((len(index), 2)), np.zeros((2, 2)), np.zeros(2)
    params = [emit, move, start]
    first, second = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    onehot = np.eye(2)[gold] * real[..., None]
    gold_move = np.einsum("nti,ntj->ij", onehot[:, :-1], onehot[:, 1:])
    for step in range(1, steps + 1):
        s = np.stack([np.bincount(block, weights=emit[feature, k], minlength=n * width) for k in (0, 1)], -1).reshape(n, width, 2)
        alpha, beta = np.zeros_like(s), np.zeros_like(s)
        alpha[:, 0] = s[:, 0] + start
        for t in range(1, width):
            nxt = np.logaddexp.reduce(alpha[:, t - 1, :, None] + move, axis=1) + s[:, t]
            alpha[:, t] = np.where(real[:, t, None], nxt, alpha[:, t - 1])
        for t in range(width - 2, -1, -1):
            nxt = np.logaddexp.reduce(move + (s[:, t + 1] + beta[:, t + 1])[:, None, :], axis=2)
            beta[:, t] = np.where(real[:, t + 1, None], nxt, beta[:, t + 1])
        z = np.logaddexp.reduce(alpha[:, -1], axis=1)
        p = np.exp(alpha + beta - z[:, None, None]) * real[..., None]
        both = np.exp(alpha[:, :-1, :, None] + move + (s[:, 1:] + beta[:, 1:])[:, :, None, :] - z[:, None, None, None]) * real[:, 1:, None, None]
        diff = (onehot - p).reshape(-1, 2)
        grads = [np.stack([np.bincount(feature, weights=diff[block, k], minlength=len(index)) for k in (0, 1)], -1) / n - l2 * emit,
                 (gold_move - both.sum((0, 1))) / n - l2 * move, (onehot[:, 0] - p[:, 0]).sum(0) / n]
        for q, g, m1, m2 in zip(params, grads, first, second):
            m1 += 0.1 * (g - m1)
            m2 += 0.01 * (g * g - m2)
            q += rate * (m1 / (1 - 0.9 ** step)) / (np.sqrt(m2 / (1 - 0.99 ** step)) + 1e-8)
    return Crf(index, emit, move, start)


# ---- labelled pages ---------------------------------------------------------------------------

#: Usual names of parts of a page.
MAIN_NAMES = "content post entry story article body text main page single prose".split()
OTHER = {
    "nav": "nav menu navbar navigation breadcrumb breadcrumbs topnav sitenav tabs toc pagination pager".split(),
    "header": "header masthead topbar branding banner site logo".split(),
    "footer": "footer bottom copyright legal colophon credits".split(),
    "aside": "sidebar aside widget related recommended popular trending rail more links tags".split(),
    "ad": "ad ads advert advertisement sponsor sponsored promo promotion adbox commercial".split(),
    "notice": "notice cookie cookies consent gdpr alert popup modal overlay banner privacy warning message".split(),
    "form": "form search login signup signin subscribe newsletter register contact".split(),
    "comments": "comments comment replies reply discussion responses respond disqus feedback thread".split(),
    "social": "share social sharing follow buttons toolbar author byline meta".split(),
}
_TAGS = {"nav": ("nav", "div", "ul", "header"), "header": ("header", "div"), "footer": ("footer", "div"), "aside": ("aside", "div", "section"),
         "ad": ("div", "aside", "section", "p"), "notice": ("div", "section", "aside", "p"), "form": ("form", "div"),
         "comments": ("section", "div", "ol", "aside"), "social": ("div", "ul")}


class _Writer:
    """Writes a page and notes the label of every block in page order."""

    def __init__(self, rng: random.Random):
        self.rng, self.out, self.labels = rng, [], []

    def words(self, lo: int, hi: int) -> str:
        r = self.rng
        text = " ".join("".join(r.choice("aeioulnrstdm") for _ in range(r.randint(2, 9))) for _ in range(r.randint(lo, hi)))
        return text.capitalize()

    def leaf(self, tag: str, text: str, label: int, link: bool = False) -> None:
        inner = f'<a href="/x">{text}</a>' if link else text
        self.out.append(f"<{tag}>{inner}</{tag}>")
        self.labels.append(label)

    def other(self, kind: str) -> None:
        r = self.rng
        tag = r.choice(_TAGS[kind])
        names = r.sample(OTHER[kind], r.choice((1, 1, 2)))
        plain = tag in ("nav", "header", "footer", "aside", "form") and r.random() < 0.4
        attr = "" if plain else f' {r.choice(("class", "class", "id"))}="{r.choice("- _").join(names) if r.random() < 0.5 else names[0]}"'
        self.out.append(f"<{tag}{attr}>")
        if kind in ("nav", "social") or kind == "aside" and r.random() < 0.5:
            wrap = tag not in ("ul", "ol")
            self.out.append("<ul>" if wrap else "")
            for _ in range(r.randint(2, 7)):
                self.leaf("li", self.words(1, 4), 0, True)
            self.out.append("</ul>" if wrap else "")
        elif kind == "form":
            self.leaf(r.choice(("label", "p", "legend")), self.words(1, 5), 0)
            self.out.append('<input name="q">')
            self.leaf("button", self.words(1, 2), 0)
        elif kind == "comments":
            if tag != "ol":
                self.leaf("h3", self.words(1, 3), 0)
            for _ in range(r.randint(1, 4)):
                if tag == "ol":
                    self.leaf("li", self.words(4, 40) + r.choice((".", "!")), 0)
                else:
                    self.out.append(f'<div class="{r.choice(OTHER["comments"])}">' if r.random() < 0.6 else "<div>")
                    self.leaf("p", self.words(4, 40) + r.choice((".", "!")), 0)
                    self.out.append("</div>")
        elif tag == "p" or r.random() < 0.4:
            self.out.append(self.words(3, 30) + ".")
            self.labels.append(0)
        else:
            for _ in range(r.randint(1, 2)):
                self.leaf("p", ("© " if kind == "footer" else "") + self.words(3, 30) + r.choice((".", "")), 0)
        self.out.append(f"</{tag}>")

    def main(self) -> None:
        r = self.rng
        tag = r.choice(("article", "article", "article", "main", "main", "div", "section"))
        name = f' class="{r.choice(MAIN_NAMES)}"' if tag in ("div", "section") or r.random() < 0.3 else ""
        self.out.append(f"<{tag}{name}>")
        inner = r.random() < 0.3
        self.out.append(f'<div class="{r.choice(MAIN_NAMES)}">' if inner else "")
        top = r.random()
        if top < 0.2:
            self.out.append("<header>")
            self.leaf(r.choice(("h1", "h1", "h2")), self.words(2, 12), 1)
            if r.random() < 0.5:
                self.out.append(f'<p class="{r.choice(("byline", "meta", "author"))}">{self.words(2, 6)}</p>')
                self.labels.append(0)
            self.out.append("</header>")
        elif top < 0.85:
            self.leaf("h1", self.words(2, 12), 1)
        for i in range(r.randint(1, 9)):
            kind = r.random()
            if kind < 0.7:
                linked = f' <a href="/x">{self.words(1, 3)}</a>' if r.random() < 0.1 else ""
                self.leaf("p", self.words(*r.choice(((1, 3), (4, 20), (20, 90)))) + linked + r.choice((".", ".", "", "!")), 1)
            elif kind < 0.78:
                self.leaf(r.choice(("h2", "h3")), self.words(1, 7), 1)
            elif kind < 0.84:
                self.out.append("<ul>")
                for _ in range(r.randint(2, 4)):
                    self.leaf("li", self.words(2, 15), 1)
                self.out.append("</ul>")
            elif kind < 0.9:
                self.out.append("<blockquote>")
                self.leaf("p", self.words(5, 30) + ".", 1)
                self.out.append("</blockquote>")
            elif kind < 0.94:
                self.leaf("pre", self.words(5, 20), 1)
            else:
                self.other(r.choice(("ad", "social", "aside", "notice", "form")))
        self.out.append("</div>" if inner else "")
        if r.random() < 0.2:
            self.other("comments")
        self.out.append(f"</{tag}>")


class _PlainWriter(_Writer):
    """Pages without ``article`` and ``main`` whose names say little: the text has to tell."""

    def box(self, tag: str, *, named: float = 0.5) -> str:
        """A start tag, with no name, or one that is in no list."""
        r = self.rng
        if r.random() >= named:
            return f"<{tag}>"
        return f'<{tag} {r.choice(("class", "id"))}="{"".join(r.choice("bcfghjkpqvwxyz") + r.choice("aeiou") for _ in range(r.randint(1, 4)))}">'

    def links(self, tag: str) -> None:
        r = self.rng
        self.out.append(self.box(tag))
        form = r.random()
        if form < 0.5:
            self.out.append("<ul>")
            for _ in range(r.randint(2, 9)):
                self.leaf("li", self.words(1, 4), 0, True)
            self.out.append("</ul>")
        elif form < 0.8:
            self.out.append(r.choice((" | ", " ", " - ")).join(f'<a href="/{i}">{self.words(1, 3)}</a>' for i in range(r.randint(2, 7))))
            self.labels.append(0)
        else:
            if r.random() < 0.6:
                self.leaf(r.choice(("h3", "h4")), self.words(1, 3), 0)
            for _ in range(r.randint(2, 5)):
                self.leaf("p", self.words(2, 8), 0, True)
        self.out.append(f"</{tag}>")

    def brand(self, tag: str) -> None:
        self.out.append(self.box(tag) + self.words(1, 3) + f"</{tag}>")
        self.labels.append(0)

    def imprint(self, tag: str) -> None:
        r = self.rng
        self.out.append(self.box(tag))
        for _ in range(r.randint(1, 2)):
            text = r.choice(("© ", "Copyright ", "")) + str(r.randint(1998, 2026)) + " " + self.words(1, 6)
            self.leaf(r.choice(("p", "div")), text + r.choice((".", "")), 0)
        self.out.append(f"</{tag}>")

    def prose(self) -> None:
        r = self.rng
        if r.random() < 0.85:
            self.leaf(r.choice(("h1", "h1", "h2")), self.words(2, 10), 1)
        for i in range(r.randint(1, 9)):
            kind = r.random()
            if kind < 0.75:
                linked = f' <a href="/x">{self.words(1, 3)}</a>' if r.random() < 0.2 else ""
                self.leaf(r.choice(("p", "p", "p", "p", "div")), self.words(*r.choice(((3, 8), (6, 25), (20, 90), (20, 90)))) + linked + r.choice((".", ".", ".", "!", "")), 1)
            elif kind < 0.83:
                self.leaf(r.choice(("h2", "h3")), self.words(1, 7), 1)
            elif kind < 0.9:
                self.out.append("<ul>")
                for _ in range(r.randint(2, 4)):
                    self.leaf("li", self.words(3, 15) + r.choice((".", "")), 1)
                self.out.append("</ul>")
            elif kind < 0.95:
                self.out.append("<blockquote>")
                self.leaf("p", self.words(5, 30) + ".", 1)
                self.out.append("</blockquote>")
            else:
                self.leaf("pre", self.words(5, 20), 1)

    def solo(self) -> None:
        """Text and nothing else, down to a single run of it."""
        r = self.rng
        tag = r.choice(("p", "p", "div", "font", "center", "pre", ""))
        for i in range(r.choice((1, 1, 2, 3))):
            if i == 0 and r.random() < 0.3:
                self.leaf(r.choice(("h1", "h2")), self.words(1, 8), 1)
            text = self.words(*r.choice(((1, 3), (2, 6), (6, 25), (20, 90)))) + r.choice((".", ".", ".", ""))
            if tag in ("", "font"):
                self.out.append(text if not tag else f"<font>{text}</font>")
                self.labels.append(1)
                break
            self.leaf(tag, text, 1)

    def page(self) -> None:
        r = self.rng
        if r.random() < 0.15:
            wrap = r.random() < 0.3
            self.out.append(self.box("div", named=0.8) if wrap else "")
            self.solo()
            self.out.append("</div>" if wrap else "")
            return
        table, cell = r.random() < 0.25, r.random()
        tag = "td" if table else r.choice(("div", "div", "div", "section"))
        head = [k for k in ("brand", "links") if r.random() < 0.45]
        tail = [k for k in ("links", "imprint") if r.random() < 0.5]
        if table:
            self.out.append("<table><tr>")
        for k in head:
            getattr(self, k)(tag)
        if r.random() < 0.2 and not table:
            self.other(r.choice(("nav", "form", "notice", "ad", "header")))
        if table and cell < 0.5:
            self.out.append("</tr><tr>")
        wrap = table or r.random() < 0.6
        self.out.append(self.box(tag) if wrap else "")
        self.prose()
        self.out.append(f"</{tag}>" if wrap else "")
        for k in tail:
            getattr(self, k)(tag)
        if r.random() < 0.2 and not table:
            self.other(r.choice(("footer", "comments", "aside", "ad", "social")))
        if table:
            self.out.append("</tr></table>")


def labelled_pages(count: int = TEMPLATE_PAGES, seed: int = 7, plain: float = 0.45) -> list[tuple[str, list[int]]]:
    """Pages from templates and the label of each of their blocks; a share of ``plain`` is without semantic elements."""
    rng, pages = random.Random(seed), []
    for _ in range(count):
        if rng.random() < plain:
            w = _PlainWriter(rng)
            w.page()
            pages.append(("<html><body>" + "".join(w.out) + "</body></html>", w.labels))
            continue
        w = _Writer(rng)
        before = [k for k in ("notice", "header", "nav", "ad", "form") if rng.random() < 0.5]
        after = [k for k in ("comments", "aside", "social", "ad", "form", "footer", "notice") if rng.random() < 0.45]
        if rng.random() < 0.2:
            before.append("aside")
        for k in before:
            w.other(k)
        w.main()
        for k in after:
            w.other(k)
        pages.append(("<html><body>" + "".join(w.out) + "</body></html>", w.labels))
    return pages


def semantic_labels(blocks: list[Block]) -> list[int] | None:
    """Labels of a page whose own elements tell: inside article or main and no other part; None if it has neither."""
    others = {n for names in OTHER.values() for n in names}
    if not any(e.tag in ("article", "main") for b in blocks for e in b.path):
        return None
    out = []
    for b in blocks:
        label, inside, around = 0, False, ""
        for e in b.path:
            if e.tag in ("article", "main"):
                label = 1
            elif e.tag in ("nav", "header", "footer", "aside", "form") or others.intersection(e.names):
                label = 0
            elif label == 0 and inside and e.tag in ("h1", "h2") and around == "header":
                label = 1  # a headline in the article's own header
            inside, around = inside or e.tag in ("article", "main"), e.tag
        out.append(label)
    return out


def fit(pages: DataFrame, sample_pages: int = SAMPLE_PAGES, html: str = "html") -> Crf:
    """Train on the template pages and about ``sample_pages`` of ``pages``, whole, picked by a hash."""
    total = pages.count()
    share = sample_pages / total if total else 0.0
    rows = pages.filter(F.col(html).isNotNull() & (F.pmod(F.xxhash64(html), F.lit(1 << 30)) < share * (1 << 30))).select(html).distinct().collect()
    chains, labels = [], []
    for source, wanted in [*((r[0], None) for r in rows), *labelled_pages()]:
        blocks = leaf_blocks(source)
        wanted = semantic_labels(blocks) if wanted is None else wanted
        if wanted is not None and len(wanted) == len(blocks):
            chains.append(features(blocks))
            labels.append(wanted)
    return train(chains, labels)


def main_text(model: Crf, source: str | None) -> str:
    if not source:
        return ""
    blocks = leaf_blocks(source)
    return "\n".join(b.text for b, label in zip(blocks, model.decode(features(blocks))) if label)


def extract(pages: DataFrame, model: Crf, html: str = "html") -> DataFrame:
    """``pages`` with ``text``, the main text of each."""
    shared = pages.sparkSession.sparkContext.broadcast(model)  # bounded by the sample: weights only

    @F.pandas_udf("string")
    def run(sources: pd.Series) -> pd.Series:
        return pd.Series([main_text(shared.value, s) for s in sources], index=sources.index, dtype=object)

    return pages.withColumn("text", run(F.col(html)))
