"""Main text of web pages: a recurrent labeller reads a page's blocks in order and keeps those of the article.

A page is cut into leaf blocks, runs of text between block-level tags. A block's input is the mean of vectors of the tags
and class words on its path, the mean of hashed word vectors of its text, and a few figures of its shape. An LSTM runs
over the blocks in both directions, so each decision rests on the whole page; a logistic layer labels every block.

The network is trained here in numpy, on at most `training_pages` pages chosen by a hash of page_id, and on pages
composed from their paragraphs. Labels come from elements that state their purpose (article, nav, aside, footer, class
words such as "comment"); in half of the training pages the article's own tags are hidden and furniture of many designs
is mixed in, so that the network learns what surrounds an article and not only its tag. The model has a fixed size.
"""

from __future__ import annotations

import bisect
import html
import random
import re
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitrine.llm.common import per_worker

#: HTML elements by the way they part text.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
SILENT = set("script style textarea title".split())
FOREIGN = {"svg", "math"}
BLOCKS = set("address article aside blockquote body button canvas caption center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html iframe legend li main menu nav noscript object ol optgroup option p pre search section select summary svg table tbody td template tfoot th thead tr ul".split())
#: An element that begins closes an open one of these kinds, up to the given parents.
CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "option": ({"option"}, {"select"}),
    "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
}
#: What element names and class words say about their content.
ARTICLE_TAGS = {"article", "main"}
FURNITURE_TAGS = set("nav aside footer form button select dialog menu fieldset noscript template iframe canvas svg".split())
ARTICLE_WORDS = set("article articlebody content entry maincontent post postcontent story".split())
FURNITURE_WORDS = set(
    "ad ads advert advertisement adverts banner breadcrumb breadcrumbs byline comment comments consent cookie cookies copyright disclaimer disqus footer"
    " header menu modal nav navbar navigation newsletter notice pager pagination popup promo promoted recommended related replies reply respond search share sharing"
    " sidebar signup social sponsor sponsored subscribe tags teaser toolbar widget".split()
)

# A quote opens a value only after an equals sign: title=it's has none.
TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*>|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:=\s*+(?:\"[^\"]*+\"|'[^']*+')|[^<>])*+)>|[^<]+|<", re.DOTALL)
NAMES = re.compile(r"(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.IGNORECASE)
WORDS = re.compile(r"[a-z0-9]+")
CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")
SHORT = 256  # names of a path that is kept as a tuple


class Deep:
    """A path of many names: those of its last element and the path above it, so deep pages cost one node an element."""

    __slots__ = ("above", "own", "size")

    def __init__(self, above: tuple[str, ...] | Deep, own: tuple[str, ...]) -> None:
        self.above, self.own, self.size = above, own, len(above) + len(own)

    def __len__(self) -> int:
        return self.size

    def __reversed__(self) -> Iterator[str]:
        path = self
        while isinstance(path, Deep):
            yield from reversed(path.own)
            path = path.above
        yield from reversed(path)

    def __iter__(self) -> Iterator[str]:
        return reversed(list(reversed(self)))


def below(path: tuple[str, ...] | Deep, names: tuple[str, ...]) -> tuple[str, ...] | Deep:
    return path + names if isinstance(path, tuple) and len(path) + len(names) <= SHORT else Deep(path, names)


@dataclass
class Block:
    path: tuple[str, ...] | Deep  # element names and, marked by a dot, class words; outermost first
    text: str
    linked: int  # characters inside links


@lru_cache(20_000)
def _names(attributes: str) -> tuple[str, ...]:
    words = []
    for match in NAMES.finditer(attributes):
        value = next((g for g in match.groups() if g is not None), "")
        words += WORDS.findall(CAMEL.sub(" ", value).lower())
    return tuple("." + w for w in words)


class _Open:
    """Open elements of a page, found by name without a search, so that junk of any size is read in linear time."""

    def __init__(self) -> None:
        self.names: list[str] = []
        self.paths: list[tuple[str, ...] | Deep] = [()]
        self.places: dict[str, list[int]] = {}
        self.blocks: list[int] = []  # places of block-level elements

    def push(self, tag: str, path: tuple[str, ...] | Deep) -> None:
        self.places.setdefault(tag, []).append(len(self.names))
        if tag in BLOCKS:
            self.blocks.append(len(self.names))
        self.names.append(tag)
        self.paths.append(path)

    def close(self, depth: int) -> None:
        """Close all elements from `depth` on."""
        while len(self.names) > depth:
            tag = self.names.pop()
            self.places[tag].pop()
            self.paths.pop()
        while self.blocks and self.blocks[-1] >= depth:
            self.blocks.pop()

    def last(self, tag: str) -> int | None:
        found = self.places.get(tag)
        return found[-1] if found else None

    def first_after(self, tags: set[str], place: int) -> int | None:
        found = [x[bisect.bisect_right(x, place)] for x in map(self.places.get, tags) if x and x[-1] > place]
        return min(found) if found else None


def blocks_of(page: str) -> list[Block]:
    """Leaf blocks in page order: references decoded, white space inside made one space, empty ones left out.

    Text of scripts, styles, titles and text areas is none of the page's, up to their end or that of the page. All other
    text is part of some block, whatever its element.
    """
    out: list[Block] = []
    open_ = _Open()
    parts: list[str] = []
    linked = at = 0
    last = page.rfind(">")

    def flush() -> None:
        nonlocal linked
        if parts:
            text = " ".join(html.unescape("".join(parts)).split())
            if text:
                out.append(Block(open_.paths[-1], text, min(linked, len(text))))
            parts.clear()
        linked = 0

    def close(depth: int) -> None:
        if open_.blocks and open_.blocks[-1] >= depth:
            flush()
        open_.close(depth)

    while at < len(page):
        match = TOKEN.match(page, at)
        if match[0] == "<" and page[at + 1 : at + 2].isalpha() and at > last:  # a tag that never closes
            break
        at = match.end()
        tag = match[2]
        if tag is None:
            token = match[0]
            if token[0] != "<" or token == "<":
                parts.append(token)
                if open_.places.get("a"):
                    linked += len(token)
            continue
        tag = tag.lower()
        if match[1]:
            depth = open_.last(tag)
            if depth is not None:
                close(depth)
            elif tag in BLOCKS:
                flush()
            continue
        if tag in VOID:
            if tag == "hr":
                flush()
            elif tag == "br":
                parts.append(" ")
            continue
        if match[3].endswith("/") and (tag in FOREIGN or any(open_.places.get(x) for x in FOREIGN)):
            if tag in BLOCKS:
                flush()
            continue
        if tag in SILENT:
            end = re.compile(f"</{tag}\\b[^>]*>", re.IGNORECASE).search(page, at)
            at = end.end() if end else len(page)
            continue
        if tag in BLOCKS:
            flush()
            if open_.blocks and open_.names[open_.blocks[-1]] == "p":
                close(open_.blocks[-1])
            if tag in CLOSES:
                kinds, parents = CLOSES[tag]
                depth = open_.first_after(kinds, max((x[-1] for x in map(open_.places.get, parents) if x), default=-1))
                if depth is not None:
                    close(depth)
        open_.push(tag, below(open_.paths[-1], (tag, *_names(match[3]))))
    flush()
    return out


def stated_label(path: tuple[str, ...]) -> int | None:
    """1 or 0 if the innermost element with a stated purpose says so, None if none does."""
    for name in reversed(path):
        word = name[1:] if name[0] == "." else None
        if name in FURNITURE_TAGS or word in FURNITURE_WORDS:
            return 0
        if name in ARTICLE_TAGS or word in ARTICLE_WORDS:
            return 1
        if name == "header" and not ARTICLE_TAGS & set(path):
            return 0
    return None


# ---- inputs -------------------------------------------------------------------------------------------------------

VECTOR, TABLE, SHAPE = 12, 1 << 13, 6
INPUT, HIDDEN = 2 * VECTOR + SHAPE, 16
TEXT_WORD = re.compile(r"\w+|©")


@lru_cache(200_000)
def _row(name: str) -> int:
    return zlib.crc32(name.encode("utf-8", "replace")) % TABLE


def rows_of(block: Block) -> tuple[list[int] | Deep, list[int], list[float]]:
    """Table rows of the path's names (or the path itself, if deep) and of the words, and figures of the block's shape."""
    text, words = block.text, TEXT_WORD.findall(block.text.lower())
    stops = sum(text.count(c) for c in ".!?")
    shape = [min(np.log1p(len(text)) / 8, 2.0), min(len(words) / 100, 2.0), block.linked / len(text), stops / (len(words) + 1), float(text[-1] in ".!?"), min(len(block.path) / 10, 2.0)]
    names = block.path if isinstance(block.path, Deep) else [_row(n) for n in block.path if n not in ("html", "body")] or [_row("")]
    return names, [_row("\t" + w) for w in words] or [_row("")], shape


@dataclass
class Network:
    """Embedding tables of path names and words, two LSTMs and the layer that labels blocks."""

    names: np.ndarray
    words: np.ndarray
    forward: dict[str, np.ndarray]
    backward: dict[str, np.ndarray]
    out: np.ndarray

    @classmethod
    def new(cls, seed: int = 5) -> Network:
        draw = np.random.default_rng(seed)
        lstm = lambda: {"x": draw.normal(0, 0.25, (INPUT, 4 * HIDDEN)), "h": draw.normal(0, 0.25, (HIDDEN, 4 * HIDDEN)), "b": np.concatenate([np.zeros(HIDDEN), np.ones(HIDDEN), np.zeros(2 * HIDDEN)])}
        return cls(draw.normal(0, 0.4, (TABLE, VECTOR)), draw.normal(0, 0.05, (TABLE, VECTOR)), lstm(), lstm(), np.append(draw.normal(0, 0.3, 2 * HIDDEN), 0.0))

    def inputs(self, blocks: list[tuple]) -> np.ndarray:
        x = np.empty((len(blocks), INPUT))
        deep = [(i, b[0]) for i, b in enumerate(blocks) if isinstance(b[0], Deep)]
        if deep:
            blocks = [([0], *b[1:]) if isinstance(b[0], Deep) else b for b in blocks]
        for part, table, k in ((slice(0, VECTOR), self.names, 0), (slice(VECTOR, 2 * VECTOR), self.words, 1)):
            sizes = np.fromiter((len(b[k]) for b in blocks), np.int64, len(blocks))
            rows = np.fromiter((r for b in blocks for r in b[k]), np.int64, int(sizes.sum()))
            starts = np.concatenate(([0], np.cumsum(sizes)[:-1]))
            x[:, part] = np.add.reduceat(table[rows], starts, axis=0) / sizes[:, None]
        x[:, 2 * VECTOR :] = [b[2] for b in blocks]
        sums: dict[int, np.ndarray] = {}
        for i, path in deep:
            x[i, :VECTOR] = self._sum(path, sums) / len(path)
        return x

    def _sum(self, path: Deep, sums: dict[int, np.ndarray]) -> np.ndarray:
        """Sum of the vectors of all names of a deep path; each element is added once for all paths through it."""
        chain = []
        while isinstance(path, Deep) and id(path) not in sums:
            chain.append(path)
            path = path.above
        total = sums[id(path)] if isinstance(path, Deep) else self.names[[_row(n) for n in path]].sum(axis=0)
        for node in reversed(chain):
            total = sums[id(node)] = total + self.names[[_row(n) for n in node.own]].sum(axis=0)
        return total


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


STEPS = 50_000  # padded blocks (pages x longest) that are scored at once


def _run(lstm: dict, x: np.ndarray, keep: bool = True) -> tuple[np.ndarray, list]:
    """Outputs (time, page, HIDDEN) of an LSTM over x (time, page, INPUT), and, with `keep`, what its gradient needs."""
    steps, pages, _ = x.shape
    h, c, out, kept = np.zeros((pages, HIDDEN)), np.zeros((pages, HIDDEN)), np.empty((steps, pages, HIDDEN)), []
    entry = x @ lstm["x"] + lstm["b"]
    for t in range(steps):
        z = entry[t] + h @ lstm["h"]
        i, f, o = _sigmoid(z[:, :HIDDEN]), _sigmoid(z[:, HIDDEN : 2 * HIDDEN]), _sigmoid(z[:, 2 * HIDDEN : 3 * HIDDEN])
        g = np.tanh(z[:, 3 * HIDDEN :])
        before = h, c
        c = f * c + i * g
        tc = np.tanh(c)
        h = out[t] = o * tc
        if keep:
            kept.append((*before, i, f, o, g, tc))
    return out, kept


def _back(lstm: dict, x: np.ndarray, kept: list, d_out: np.ndarray) -> tuple[dict, np.ndarray]:
    grads, dx = {k: np.zeros_like(v) for k, v in lstm.items()}, np.empty_like(x)
    dh, dc = np.zeros(d_out.shape[1:]), np.zeros(d_out.shape[1:])
    for t in range(len(x) - 1, -1, -1):
        h, c, i, f, o, g, tc = kept[t]
        dh = dh + d_out[t]
        dc = dc + dh * o * (1 - tc * tc)
        dz = np.concatenate([dc * g * i * (1 - i), dc * c * f * (1 - f), dh * tc * o * (1 - o), dc * i * (1 - g * g)], axis=1)
        grads["x"] += x[t].T @ dz
        grads["h"] += h.T @ dz
        grads["b"] += dz.sum(axis=0)
        dx[t], dh, dc = dz @ lstm["x"].T, dz @ lstm["h"].T, dc * f
    return grads, dx


def _pad(sizes: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """Row of each (time, page), and of its mirror image; len(rows) where a page has ended."""
    total, longest = sum(sizes), max(sizes)
    ahead, mirror = np.full((longest, len(sizes)), total), np.full((longest, len(sizes)), total)
    at = 0
    for p, n in enumerate(sizes):
        ahead[:n, p] = np.arange(at, at + n)
        mirror[:n, p] = np.arange(at + n - 1, at - 1, -1)
        at += n
    return ahead, mirror


def _pass(network: Network, x: np.ndarray, sizes: list[int], keep: bool = True):
    """Both LSTMs over pages of `sizes` blocks whose inputs follow each other in x: the joined outputs by block."""
    padded = np.concatenate([x, np.zeros((1, INPUT))])
    joined, kept = np.zeros((len(x) + 1, 2 * HIDDEN)), []
    for k, (lstm, rows) in enumerate(zip((network.forward, network.backward), _pad(sizes), strict=True)):
        own = padded[rows]
        out, memory = _run(lstm, own, keep)
        joined[rows, k * HIDDEN : (k + 1) * HIDDEN] = out
        if keep:
            kept.append((rows, own, memory))
    return joined[:-1], kept


def probabilities(network: Network, pages: list[list[tuple]]) -> list[np.ndarray]:
    """Probability of each block of each page to belong to the article; pages of like length run together,
    at most 128 and `STEPS` padded blocks (or one page)."""
    out: list = [np.zeros(0)] * len(pages)
    order = sorted((i for i in range(len(pages)) if pages[i]), key=lambda i: len(pages[i]))
    groups: list[list[int]] = []
    for i in order:  # the longest so far
        if not groups or len(groups[-1]) == 128 or (len(groups[-1]) + 1) * len(pages[i]) > STEPS:
            groups.append([])
        groups[-1].append(i)
    for some in groups:
        sizes = [len(pages[i]) for i in some]
        hidden, _ = _pass(network, network.inputs([b for i in some for b in pages[i]]), sizes, keep=False)
        p = _sigmoid(hidden @ network.out[:-1] + network.out[-1])
        for i, part in zip(some, np.split(p, np.cumsum(sizes)[:-1]), strict=True):
            out[i] = part
    return out


def fit(pages: list[tuple[list[tuple], np.ndarray]], *, epochs: int = 6, rate: float = 0.05, batch: int = 16, seed: int = 5) -> Network:
    """Train on (blocks, labels) of pages with at least one block; gradients through time, steps by Adagrad."""
    network, draw = Network.new(seed), np.random.default_rng(seed)
    dense = [*network.forward.values(), *network.backward.values(), network.out]
    squares = [np.full(p.shape, 1e-4) for p in dense]
    table_squares = [np.full(TABLE, 1e-4), np.full(TABLE, 1e-4)]
    for _ in range(epochs):
        order = draw.permutation(len(pages))
        for low in range(0, len(order), batch):
            some = sorted(order[low : low + batch], key=lambda i: len(pages[i][0]))
            blocks, sizes = [b for i in some for b in pages[i][0]], [len(pages[i][0]) for i in some]
            hidden, kept = _pass(network, network.inputs(blocks), sizes)
            labels = np.concatenate([pages[i][1] for i in some])
            error = (_sigmoid(hidden @ network.out[:-1] + network.out[-1]) - labels) / len(labels)
            grads, dx = [], np.zeros((len(blocks) + 1, INPUT))
            d_hidden = np.concatenate([error[:, None] * network.out[:-1], np.zeros((1, 2 * HIDDEN))])
            for k, (lstm, (rows, x, memory)) in enumerate(zip((network.forward, network.backward), kept, strict=True)):
                own, part = _back(lstm, x, memory, d_hidden[rows, k * HIDDEN : (k + 1) * HIDDEN])
                grads += own.values()
                np.add.at(dx, rows, part)
            grads.append(np.append(hidden.T @ error, error.sum()))
            for p, g, s in zip(dense, grads, squares, strict=True):
                s += g * g
                p -= rate * g / np.sqrt(s)
            for k, table in enumerate((network.names, network.words)):
                lengths = np.array([len(b[k]) for b in blocks])
                rows = np.array([r for b in blocks for r in b[k]])
                spread = np.repeat(dx[:-1, k * VECTOR : (k + 1) * VECTOR] / lengths[:, None], lengths, axis=0)
                found, inverse = np.unique(rows, return_inverse=True)
                g = np.zeros((len(found), VECTOR))
                np.add.at(g, inverse, spread)
                table_squares[k][found] += (g * g).mean(axis=1)
                table[found] -= rate * g / np.sqrt(table_squares[k][found])[:, None]
    return network


# ---- training pages -----------------------------------------------------------------------------------------------

#: Furniture of many designs: path, phrases (none: words of the pages), words per block, whether the text is a link.
FURNITURE = [
    (("nav", "ul", "li", "a"), [], (1, 3), True), (("header", "div", ".logo"), [], (1, 3), False), (("div", ".menu", "ul", "li", "a"), ["Home", "About", "Contact", "News"], (1, 2), True),
    (("div", ".sidebar", "ul", "li", "a"), [], (2, 8), True), (("aside", "p"), [], (5, 25), False), (("div", ".widget", "h3"), ["Popular", "Latest", "Archive"], (1, 3), False),
    (("div", ".ad"), [], (3, 12), False), (("div", ".banner", "p"), ["Advertisement", "Sponsored"], (3, 10), True), (("section", ".promo", "p"), [], (4, 16), True),
    (("div", ".cookie", "p"), ["We use cookies", "Accept all", "This site uses cookies to improve your experience."], (3, 20), False), (("div", ".consent", "button"), ["Accept", "Decline"], (1, 2), False), (("div", ".notice", "p"), [], (4, 20), False),
    (("form", "label"), ["Name", "E-mail", "Search"], (1, 2), False), (("form", "button"), ["Send", "Subscribe"], (1, 2), False), (("div", ".newsletter", "p"), ["Sign up for our newsletter"], (4, 12), False), (("select", "option"), [], (1, 2), False),
    (("div", ".comments", "div", ".comment", "p"), [], (5, 50), False), (("section", ".comments", "h3"), ["Comments", "Leave a reply"], (1, 3), False), (("ul", ".replies", "li", ".comment"), [], (4, 40), False), (("div", ".comment", "span"), [], (1, 4), False),
    (("div", ".related", "ul", "li", "a"), [], (3, 10), True), (("div", ".share", "a"), ["Share", "Tweet", "E-mail this"], (1, 2), True), (("div", ".breadcrumb", "a"), [], (1, 3), True), (("div", ".tags", "a"), [], (1, 2), True),
    (("footer", "p"), ["© all rights reserved", "Privacy policy", "Terms of use"], (3, 12), False), (("footer", "div", "a"), [], (1, 3), True), (("div", ".footer"), ["© 2020"], (2, 10), False), (("div", ".copyright"), ["© all rights reserved"], (2, 8), False),
    (("svg", "text"), ["Menu", "Search"], (1, 3), False), (("noscript",), ["Please enable JavaScript"], (3, 12), False), (("div", "canvas"), [], (1, 8), False),
]
BODIES = [("article",), ("main", "article"), ("div", ".content"), ("div", ".post", "div", ".entry"), ("div", ".wrap", "div"), ("section",), ("div", ".story"), ("td",), ("main",), ("div",)]
PLAIN = "the of and to a in is it that was for on are with as his they be at one have this from or had by not but what some we can out other were all there when up use".split()


def composed(paragraphs: list[str], draw: random.Random) -> tuple[list[Block], list[int]]:
    """A page of furniture around, and now and then within, an article made of some of `paragraphs`."""
    words = " ".join(draw.sample(paragraphs, min(3, len(paragraphs)))).split() or PLAIN
    blocks: list[Block] = []
    labels: list[int] = []

    def furniture(inside: tuple[str, ...] = ()) -> None:
        path, phrases, (few, many), link = draw.choice(FURNITURE)
        if draw.random() < 0.25:  # a design whose class words say nothing
            path = tuple(n for n in path if n[0] != ".") or ("div",)
        for _ in range(draw.choice([1, 1, 2, 6]) if link or "comment" in str(path) else 1):
            n = draw.randrange(few, many + 1)
            text = draw.choice(phrases) if phrases and draw.random() < 0.7 else " ".join(draw.choice(words) for _ in range(n))
            blocks.append(Block(("html", "body", *inside, *path), text, len(text) if link else 0))
            labels.append(0)

    for _ in range(draw.randrange(1, 6)):
        furniture()
    body = draw.choice(BODIES)
    if draw.random() < 0.8:
        title = " ".join(draw.choice(words) for _ in range(draw.randrange(1, 12)))
        blocks.append(Block(("html", "body", *body, draw.choice(["h1", "h1", "h2"])), title, 0))
        labels.append(1)
    for _ in range(draw.choice([1, 1, 2, 3, 5, 8, 14])):
        text = draw.choice(paragraphs) if paragraphs else " ".join(draw.choice(PLAIN) for _ in range(40))
        kind = draw.choice([("p",)] * 10 + [("blockquote", "p"), ("ul", "li"), ("h2",), ("h3",), ("pre",), ("div",), ("figure", "figcaption"), ("table", "tr", "td")])
        if kind[0] in ("h2", "h3", "ul") or draw.random() < 0.15:
            text = " ".join(text.split()[: draw.randrange(1, 9)])
        blocks.append(Block(("html", "body", *body, *kind), text, draw.choice([0, 0, len(text) // 6])))
        labels.append(1)
        if draw.random() < 0.08:
            furniture(body)
    for _ in range(draw.randrange(0, 7)):
        furniture(body if draw.random() < 0.15 else ())
    return blocks, labels


def training_set(pages: list[str], seed: int = 5, composed_pages: int = 500) -> list[tuple[list[tuple], np.ndarray]]:
    """Blocks and labels of the pages whose elements state their purpose, each also with its article tags hidden, and of
    composed pages."""
    draw, out, paragraphs = random.Random(seed), [], []
    for page in pages:
        blocks = blocks_of(page)
        stated = [stated_label(b.path) for b in blocks]
        paragraphs += [b.text for b, s in zip(blocks, stated, strict=True) if s == 1]
        if 1 not in stated or any(isinstance(b.path, Deep) for b in blocks):
            continue
        labels = np.array([s or 0 for s in stated], float)
        out.append(([rows_of(b) for b in blocks], labels))
        hidden = tuple(ARTICLE_TAGS) + tuple("." + w for w in ARTICLE_WORDS)
        masked = [Block(tuple("div" if n in hidden else n for n in b.path), b.text, b.linked) for b in blocks]
        out.append(([rows_of(b) for b in masked], labels))
    for _ in range(composed_pages):
        blocks, labels = composed(paragraphs, draw)
        out.append(([rows_of(b) for b in blocks], np.array(labels, float)))
    return out


# ---- operator -----------------------------------------------------------------------------------------------------


def train(pages: DataFrame, *, training_pages: int = 250, longest: int = 500_000) -> Network:
    """Network trained on about `training_pages` rows of `pages` (page_id, html) at most, chosen by a hash of page_id among
    those of up to `longest` characters; so what the driver holds is bounded."""
    known = pages.where("page_id is not null").where(F.length("html") <= longest)
    share = training_pages / max(known.count(), 1)
    chosen = known.where(F.pmod(F.xxhash64("page_id"), F.lit(1_000_003)) < share * 1_000_003).select(F.col("page_id").cast("string").alias("k"), "html")
    rows = sorted((r.k, r.html) for r in chosen.toLocalIterator())
    return fit(training_set([h for _, h in rows]))


def extract(pages: DataFrame, network: Network) -> DataFrame:
    """One row per row of `pages` (page_id, url, html): page_id, url, text, n_chars (code points).

    The blocks that the network takes for the article, in page order, joined by line feeds; empty if there are none.
    A null html counts as empty. Page ids may repeat or be null. No rows, no result.
    """
    shared = pages.sparkSession.sparkContext.broadcast(network)
    token = uuid.uuid4().hex

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        network = per_worker(token, lambda: shared.value)
        for batch in batches:
            texts = []
            sources = batch.column(2).to_pylist()
            for low in range(0, len(sources), 512):
                found = [blocks_of(s or "") for s in sources[low : low + 512]]
                labels = probabilities(network, [[rows_of(b) for b in blocks] for blocks in found])
                texts += ["\n".join(b.text for b, p in zip(blocks, ps, strict=True) if p >= 0.5) for blocks, ps in zip(found, labels, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())], names=["page_id", "url", "text", "n_chars"])

    rows = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), F.col("html").cast("string"))
    return rows.mapInArrow(run, "page_id long, url string, text string, n_chars long")


def main_text(pages: DataFrame, *, training_pages: int = 250) -> DataFrame:
    """`extract` with a network trained on `pages` themselves."""
    return extract(pages, train(pages, training_pages=training_pages))
