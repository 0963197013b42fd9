"""Main text of web pages: a recurrent labeller over the sequence of a page's text blocks.

A page is cut into blocks, the texts between block-level tags. Each block is read as a
vector: the hashed names, classes and ids of the tags above it, its hashed words, and how
long and how linked it is. A bidirectional LSTM in numpy passes over the whole sequence
in both directions, so that every block is classified with the document before and
behind it in view. What is classified as article is joined.

Nobody labels blocks by hand here. The network is trained on a bounded sample of pages
whose own markup says what a block is (an ``article`` or ``main`` element, a ``nav``, a
``form``), and on pages composed of the same blocks under the container names that sites
use. In training the names that give a label away are hidden at random, so that the
network must also learn from the words, the lengths and the neighbours.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from html import unescape

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foliate.llm.frames import map_texts

PATH_DIM, WORD_DIM, NUMBERS = 96, 32, 5
INPUT = PATH_DIM + WORD_DIM + NUMBERS
BATCH = 256

# HTML's void elements, elements whose content is no markup, phrasing elements that don't end a block, foreign elements and the tags that end them.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = ("script", "style", "textarea", "title")
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr img svg math noscript object audio video canvas iframe".split())
FOREIGN = ("svg", "math")
BREAKOUT = frozenset("blockquote body center dd div dl dt h1 h2 h3 h4 h5 h6 head hr li menu ol p pre table ul".split())

_QUOTED = r"(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+"


def _tokens(attributes: str) -> re.Pattern:
    return re.compile(
        r"<!--(?:.*?-->|.*)|<(?P<raw>" + "|".join(RAW) + rf")(?=[\s/>])(?P<open>(?:{attributes})>)(?P<body>.*?)(?:</(?P=raw)(?=[\s/>])[^>]*>|\Z)"
        rf"|<(?P<close>/?)(?P<name>[a-zA-Z][^\s/>]*)(?P<attributes>{attributes})>"
        r"|<[!?][^>]*>|[^<]+|<",
        re.DOTALL | re.IGNORECASE,
    )


#: A tag ends at the first ``>`` outside quotes, or where there is none at the first of all.
_TOKEN = _tokens(_QUOTED + r"|[^>]*+")
#: For the rest of a page that has no ``>`` outside quotes: looking for one at every tag would take the square of its length.
_UNQUOTED = _tokens(r"[^>]*+")
_WELL_QUOTED = re.compile(_QUOTED)
_NAMED = re.compile(r"""\b(?:class|id|role|itemprop|aria-label)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.IGNORECASE)
_PIECES = re.compile(r"[a-z]+|[0-9]+")
_CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")


@dataclass
class BlockOfText:
    text: str
    path: tuple[str, ...]
    linked: float


def blocks_of(html: str | None) -> list[BlockOfText]:
    """The text blocks of a page in order; scripts, styles, comments and other markup have no text."""
    out: list[BlockOfText] = []
    stack: list[tuple[str, tuple[str, ...]]] = []
    parts: list[str] = []
    path: tuple[str, ...] = ()
    linked = links = foreign = at = 0

    def flush() -> None:
        nonlocal parts, linked
        text = " ".join("".join(parts).split())
        if text:
            out.append(BlockOfText(text, path, min(1.0, linked / len(text))))
        parts, linked = [], 0

    def pop_to(depth: int) -> None:
        nonlocal links, foreign
        links -= sum(name == "a" for name, _ in stack[depth:])
        foreign -= sum(name in FOREIGN for name, _ in stack[depth:])
        del stack[depth:]

    def say(text: str) -> None:
        nonlocal path, linked
        if not parts:
            path = tuple(dict.fromkeys(p for _, names in stack for p in names))
        said = unescape(text)
        parts.append(said)
        linked += len(said.strip()) if links else 0

    html = html or ""
    last, pattern = html.rfind(">"), _TOKEN
    while at < len(html):
        if at > last:
            # No tag can end any more; only a comment may still begin.
            say(html[at:].partition("<!--")[0])
            break
        m = pattern.match(html, at)
        token, name, at = m.group(), m["name"], m.end()
        within = m["open"] or m["attributes"] or ""
        if pattern is _TOKEN and (within.count('"') % 2 or within.count("'") % 2) and not _WELL_QUOTED.fullmatch(within.removesuffix(">") if m["open"] else within):
            pattern = _UNQUOTED
        if name is None:
            if m["raw"] is not None and foreign and m["open"].endswith("/>"):
                at = m.end("open")
            if m["raw"] is None and (token[0] != "<" or len(token) == 1):
                say(token)
            continue
        name = name.lower()
        if name in ("br", "wbr"):
            parts.append(" " if name == "br" else "")
            continue
        if foreign and name in BREAKOUT and not m["close"]:
            pop_to(next(depth for depth, (n, _) in enumerate(stack) if n in FOREIGN))
        inline = name in INLINE or foreign > 0 and name not in BREAKOUT
        if not inline:
            flush()
        if name in VOID or not m["close"] and (foreign or name in FOREIGN) and m["attributes"].endswith("/"):
            continue
        if m["close"]:
            for depth in range(len(stack) - 1, -1, -1):
                if stack[depth][0] == name:
                    pop_to(depth)
                    break
            continue
        if not inline:
            # A block ends a paragraph that was left open, with what is open inside it; an item ends its predecessor.
            ends = {"p"} | ({name} if name in ("li", "dt", "dd", "option", "tr", "td", "th") else set())
            for depth in range(len(stack) - 1, -1, -1):
                if stack[depth][0] in ends:
                    pop_to(depth)
                    break
                if stack[depth][0] not in INLINE:
                    break
        attributes = m["attributes"]
        names = [name]
        if "=" in attributes:
            for found in _NAMED.findall(attributes):
                names += _PIECES.findall(_CAMEL.sub(" ", "".join(found)).lower())
        stack.append((name, tuple(names)))
        links += name == "a"
        foreign += name in FOREIGN
    flush()
    return out


def _hashed(name: str, size: int) -> int:
    return zlib.crc32(name.encode()) % size


class Reader:
    """Block vectors; remembers where names and words hash to, within a bound."""

    def __init__(self) -> None:
        self._path: dict[tuple[str, ...], list[int]] = {}

    def vectors(self, blocks: Sequence[BlockOfText]) -> np.ndarray:
        n = len(blocks)
        x = np.zeros((n, INPUT), np.float32)
        if not n:
            return x
        for i, block in enumerate(blocks):
            at = self._path.get(block.path)
            if at is None:
                if len(self._path) > 50_000:
                    self._path.clear()
                at = self._path[block.path] = [_hashed(p, PATH_DIM) for p in block.path]
            x[i, at] = 1
        # Blocks are words with one space between. A word hashes by its first and last byte and its length.
        raw = [b.text.encode() for b in blocks]
        data = np.frombuffer(b" ".join(raw) + b" ", np.uint8).astype(np.int64)
        stops = np.flatnonzero(data == 0x20)
        starts = np.r_[0, stops[:-1] + 1]
        codes = (data[starts] * 31 + data[stops - 1] * 7 + stops - starts) % WORD_DIM
        owner = np.searchsorted(np.cumsum([len(t) + 1 for t in raw]), starts, side="right")
        counts = np.bincount(owner * WORD_DIM + codes, minlength=n * WORD_DIM).reshape(n, WORD_DIM)
        words = counts.sum(axis=1)
        x[:, PATH_DIM : PATH_DIM + WORD_DIM] = counts / np.sqrt(words)[:, None]
        tail = x[:, PATH_DIM + WORD_DIM :]
        tail[:, 0] = np.minimum(np.log1p(words), 6.0) / 4
        tail[:, 1] = [b.linked for b in blocks]
        tail[:, 2] = np.arange(n) / n
        tail[:, 3] = [b.text[-1] in ".!?…。" for b in blocks]
        tail[:, 4] = min(n, 200) / 200
        return x


@dataclass
class Network:
    """Weights of two LSTMs (forward, backward: input, recurrent, bias) and of the output."""

    weights: dict[str, np.ndarray]

    @staticmethod
    def new(hidden: int, seed: int) -> Network:
        rng = np.random.default_rng(seed)
        w = {}
        for side in "fb":
            w[side + "x"] = rng.normal(0, 1 / np.sqrt(INPUT), (INPUT, 4 * hidden))
            w[side + "h"] = rng.normal(0, 1 / np.sqrt(hidden), (hidden, 4 * hidden))
            bias = np.zeros(4 * hidden)
            bias[hidden : 2 * hidden] = 1
            w[side + "b"] = bias
        w["o"] = rng.normal(0, 1 / np.sqrt(2 * hidden), 2 * hidden)
        w["c"] = np.zeros(1)
        return Network({k: v.astype(np.float32) for k, v in w.items()})


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def _lstm(x: np.ndarray, mask: np.ndarray, w: dict[str, np.ndarray], side: str, keep: bool) -> tuple[np.ndarray, list]:
    """Hidden states of one direction over (steps, pages, input); padding leaves the state as it is."""
    steps, pages, _ = x.shape
    hidden = len(w[side + "h"])
    h = c = np.zeros((pages, hidden), np.float32)
    out, tape = np.zeros((steps, pages, hidden), np.float32), []
    inputs = x @ w[side + "x"] + w[side + "b"]
    for t in range(steps) if side == "f" else range(steps - 1, -1, -1):
        z = inputs[t] + h @ w[side + "h"]
        i, f, o = (_sigmoid(z[:, k * hidden : (k + 1) * hidden]) for k in (0, 1, 2))
        g = np.tanh(z[:, 3 * hidden :])
        m = mask[t][:, None]
        new_c = f * c + i * g
        squashed = np.tanh(new_c)
        if keep:
            tape.append((t, h, c, i, f, o, g, squashed, m))
        h = np.where(m, o * squashed, h)
        c = np.where(m, new_c, c)
        out[t] = h
    return out, tape


def _lstm_gradient(x: np.ndarray, d_out: np.ndarray, tape: list, w: dict[str, np.ndarray], side: str, grads: dict[str, np.ndarray]) -> None:
    d_h = d_c = np.zeros_like(d_out[0])
    d_inputs = np.zeros((*d_out.shape[:2], 4 * d_out.shape[2]), np.float32)
    for t, h, c, i, f, o, g, squashed, m in reversed(tape):
        d_h = d_h + d_out[t]
        through = np.where(m, d_h, 0)
        d_new = np.where(m, d_c, 0) + through * o * (1 - squashed**2)
        d_z = np.concatenate([d_new * g * i * (1 - i), d_new * c * f * (1 - f), through * squashed * o * (1 - o), d_new * i * (1 - g**2)], axis=1)
        d_inputs[t] = d_z
        grads[side + "h"] += h.T @ d_z
        d_h = np.where(m, 0, d_h) + d_z @ w[side + "h"].T
        d_c = np.where(m, d_new * f, d_c)
    flat = d_inputs.reshape(-1, d_inputs.shape[2])
    grads[side + "x"] += x.reshape(-1, x.shape[2]).T @ flat
    grads[side + "b"] += flat.sum(axis=0)


def _padded(pages: Sequence[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    steps = max(len(p) for p in pages)
    x = np.zeros((steps, len(pages), INPUT), np.float32)
    mask = np.zeros((steps, len(pages)), bool)
    for i, p in enumerate(pages):
        x[: len(p), i] = p
        mask[: len(p), i] = True
    return x, mask


def _forward(network: Network, x: np.ndarray, mask: np.ndarray, keep: bool = False) -> tuple[np.ndarray, np.ndarray, list, list]:
    w = network.weights
    ahead, tape_f = _lstm(x, mask, w, "f", keep)
    back, tape_b = _lstm(x, mask, w, "b", keep)
    both = np.concatenate([ahead, back], axis=2)
    return _sigmoid(both @ w["o"] + w["c"]), both, tape_f, tape_b


#: Blocks of padded input that one pass may hold.
_CELLS = 40_000


def label(network: Network, pages: Sequence[np.ndarray]) -> list[np.ndarray]:
    """For each page the probability of each block to be article text. Pages of like length share a pass."""
    out: list[np.ndarray] = [np.zeros(0, np.float32)] * len(pages)
    waiting = sorted((i for i in range(len(pages)) if len(pages[i])), key=lambda i: len(pages[i]))
    while waiting:
        longest = len(pages[waiting[-1]])
        take = max(1, min(BATCH, _CELLS // longest))
        some, waiting = waiting[-take:], waiting[:-take]
        p, *_ = _forward(network, *_padded([pages[i] for i in some]))
        for k, i in enumerate(some):
            out[i] = p[: len(pages[i]), k]
    return out


def fit(pages: Sequence[tuple[np.ndarray, np.ndarray]], hidden: int = 16, epochs: int = 16, rate: float = 0.01, hide: float = 0.25, seed: int = 7) -> Network:
    """Train on (vectors, labels): 1 article, 0 not, NaN unknown. ``hide``: the share of a page's tag names hidden per pass."""
    network, rng = Network.new(hidden, seed), np.random.default_rng(seed)
    w = network.weights
    m, v, step = {k: np.zeros_like(x) for k, x in w.items()}, {k: np.zeros_like(x) for k, x in w.items()}, 0
    pages = sorted((p for p in pages if len(p[0])), key=lambda p: len(p[0]))
    groups = [pages[a : a + 32] for a in range(0, len(pages), 32)]
    for epoch in range(epochs):
        for g in rng.permutation(len(groups)):
            x, mask = _padded([p[0] for p in groups[g]])
            y = np.full(mask.shape, np.nan, np.float32)
            for i, (_, labels) in enumerate(groups[g]):
                y[: len(labels), i] = labels
            x[:, :, :PATH_DIM] *= rng.random((1, len(groups[g]), PATH_DIM)) >= hide * rng.integers(0, 2, (1, len(groups[g]), 1))
            p, both, tape_f, tape_b = _forward(network, x, mask, keep=True)
            known = mask & ~np.isnan(y)
            d = np.where(known, p - np.nan_to_num(y), 0).astype(np.float32) / max(1, known.sum())
            grads = {k: np.zeros_like(a) for k, a in w.items()}
            grads["o"] += np.tensordot(d, both, axes=([0, 1], [0, 1]))
            grads["c"] += d.sum()
            d_both = d[:, :, None] * w["o"]
            _lstm_gradient(x, d_both[:, :, :hidden], tape_f, w, "f", grads)
            _lstm_gradient(x, d_both[:, :, hidden:], tape_b, w, "b", grads)
            step += 1
            norm = np.sqrt(sum(float((a**2).sum()) for a in grads.values()))
            scale = min(1.0, 1.0 / (norm + 1e-9))
            for k in w:
                a = grads[k] * scale
                m[k] = 0.9 * m[k] + 0.1 * a
                v[k] = 0.999 * v[k] + 0.001 * a * a
                w[k] -= (rate * (1 - epoch / (epochs + 2)) * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.999**step)) + 1e-8)).astype(np.float32)
    return network


# Elements and container names by what they hold.
ARTICLE_TAGS = ("article", "main")
OTHER_TAGS = ("nav", "header", "footer", "aside", "form", "menu", "dialog", "button", "head", "fieldset")
ARTICLE_NAMES = "article content post entry body story text main page prose markdown blog news"
OTHER_NAMES = {
    "menu": "menu nav navigation navbar breadcrumb breadcrumbs toc pagination pager tabs skip links",
    "header": "header masthead banner topbar logo branding site",
    "footer": "footer copyright legal colophon bottom imprint",
    "sidebar": "sidebar widget rail related recommended popular recent trending tags archive secondary complementary",
    "notice": "notice cookie consent gdpr alert message popup modal overlay newsletter subscribe signup paywall promo",
    "advert": "ad ads advert advertisement sponsor sponsored adsense promo banner teaser",
    "form": "form search login signin contact input field",
    "comments": "comment comments reply replies disqus respond discussion thread reader",
    "share": "share social sharing follow buttons meta byline author bio",
}
_OTHER = frozenset(" ".join(OTHER_NAMES.values()).split()) - {"site", "message", "bottom", "text", "author", "meta", "byline", "tags", "links", "recent", "thread", "reader", "field", "skip", "page"}


def marked_labels(blocks: Sequence[BlockOfText]) -> np.ndarray:
    """What a page's markup says of its blocks: the innermost name that tells decides; NaN where none does."""
    out = np.full(len(blocks), np.nan, np.float32)
    for i, block in enumerate(blocks):
        for name in reversed(block.path):
            if name in OTHER_TAGS or name in _OTHER:
                out[i] = 0
                break
            if name in ARTICLE_TAGS:
                out[i] = 1
                break
    return out


def compose(texts: Sequence[str], short: Sequence[str], rng: np.random.Generator) -> tuple[list[BlockOfText], np.ndarray]:
    """A page of given texts under container names, and its labels."""
    rows: list[tuple[BlockOfText, int]] = []

    def pick(words: str) -> list[str]:
        names = words.split()
        return [str(names[rng.integers(len(names))]) for _ in range(1 + int(rng.random() < 0.5))]

    def some(source: Sequence[str]) -> str:
        return source[int(rng.integers(len(source)))]

    def put(container: Sequence[str], kind: str) -> None:
        base = ("html", "body")
        if kind == "article":
            if rng.random() < 0.8:
                rows.append((BlockOfText(some(short), (*base, *container, "h1"), 0.0), 1))
            for _ in range(int(rng.integers(1, 12))):
                tag = ("p", "p", "p", "p", "h2", "li", "blockquote")[int(rng.integers(7))]
                extra = ("ul",) if tag == "li" else ()
                rows.append((BlockOfText(some(short) if tag == "h2" or rng.random() < 0.15 else some(texts), (*base, *container, *extra, tag), 0.0 if rng.random() < 0.8 else float(rng.random() * 0.3)), 1))
            return
        many = int(rng.integers(2, 8)) if kind in ("menu", "sidebar", "share") else int(rng.integers(1, 5))
        for _ in range(many):
            if kind == "menu" or kind in ("sidebar", "footer", "share", "header") and rng.random() < 0.5:
                words = some(short).split()[: int(rng.integers(1, 5))]
                tail = ("ul", "li", "a") if rng.random() < 0.7 else ("a",)
                rows.append((BlockOfText(" ".join(words), (*base, *container, *tail), 1.0), 0))
            else:
                tag = ("p", "div", "span", "li", "label", "h3")[int(rng.integers(6))]
                source = texts if kind in ("comments", "notice", "advert") and rng.random() < 0.6 else short
                rows.append((BlockOfText(some(source), (*base, *container, tag), 0.0 if rng.random() < 0.7 else float(rng.random())), 0))

    tags = {"menu": "nav", "header": "header", "footer": "footer", "sidebar": "aside", "form": "form", "comments": "section", "notice": "div", "advert": "div", "share": "div"}
    before = [k for k in ("notice", "header", "menu", "form", "advert", "share") if rng.random() < 0.5]
    after = [k for k in ("share", "advert", "comments", "sidebar", "form", "menu", "notice", "footer") if rng.random() < 0.5]
    holder = [("article",), ("main",), ("main", "article"), ("div", *pick(ARTICLE_NAMES)), ("section", *pick(ARTICLE_NAMES)), ("div", *pick(ARTICLE_NAMES), "article")][int(rng.integers(6))]
    for kind in [*before, "article", *after]:
        if kind == "article":
            put(holder, kind)
            continue
        own = (tags[kind] if rng.random() < 0.6 else "div", *(pick(OTHER_NAMES[kind]) if rng.random() < 0.85 or tags[kind] in ("div", "section") else ()))
        # Some of these stand inside the article's own container.
        put((*holder, *own) if rng.random() < 0.4 else own, kind)
    return [b for b, _ in rows], np.array([y for _, y in rows], np.float32)


@dataclass(frozen=True)
class ExtractParameters:
    """Bounds of the training set: at most ``sample_pages`` pages, those with the smallest hash of their id, and ``composed_pages`` made of their blocks."""

    sample_pages: int = 300
    composed_pages: int = 900
    seed: int = 7
    threshold: float = 0.5
    #: Pages of more blocks are extracted like all others, but not fitted on.
    fitted_blocks: int = 400


def train_extractor(pages: DataFrame, params: ExtractParameters = ExtractParameters(), id_col: str = "page_id", html_col: str = "html") -> Network:
    """Fit on a bounded sample of the pages; every page is extracted by the result."""
    ids = pages.select(F.col(id_col).alias("id")).where("id is not null").distinct().withColumn("h", F.xxhash64(F.col("id").cast("string"))).orderBy("h", "id").limit(params.sample_pages)
    # At most sample_pages ids: a bounded broadcast. Of repeated ids one row is taken.
    sample = pages.select(F.col(id_col).alias("__id"), F.col(html_col).alias("html")).join(F.broadcast(ids), F.col("__id") == F.col("id"))
    rows = sample.groupBy("h", "id").agg(F.min_by("html", F.xxhash64("html")).alias("html")).toLocalIterator()
    parsed = [blocks_of(r["html"]) for r in sorted(rows, key=lambda r: (r["h"], r["html"] or ""))]
    return train_on_blocks(parsed, params)


def train_on_blocks(parsed: Sequence[Sequence[BlockOfText]], params: ExtractParameters) -> Network:
    reader, rng = Reader(), np.random.default_rng(params.seed)
    every = [b.text for blocks in parsed for b in blocks]
    texts = [t for t in every if len(t.split()) >= 8] or ["words of an article that nobody has written yet, all in one sentence."]
    short = [" ".join(t.split()[:8]) for t in every if t.split()] or ["some words"]
    train = [(reader.vectors(blocks), marked_labels(blocks)) for blocks in parsed if len(blocks) <= params.fitted_blocks]
    for _ in range(params.composed_pages):
        blocks, labels = compose(texts, short, rng)
        train.append((reader.vectors(blocks), labels))
    return fit(train, seed=params.seed)


def extractor(network: Network, threshold: float) -> Callable[[list[str | None]], dict[str, Sequence]]:
    reader = Reader()

    def extract(pages: list[str | None]) -> dict[str, Sequence]:
        parsed = [blocks_of(html) for html in pages]
        chances = label(network, [reader.vectors(blocks) for blocks in parsed])
        texts = [" ".join(b.text for b, p in zip(blocks, of, strict=True) if p >= threshold) for blocks, of in zip(parsed, chances, strict=True)]
        return {"text": texts, "n_chars": [len(t) for t in texts], "n_blocks": [len(b) for b in parsed], "n_article_blocks": [int((p >= threshold).sum()) for p in chances]}

    return extract


def extract_text(pages: DataFrame, network: Network, threshold: float = 0.5, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``page_id``, ``url``, ``text`` and ``n_chars`` of every page.

    A null page is an empty one; a page without an article block has an empty text.
    Character references are decoded, runs of white space in a block become one space,
    blocks are joined by one space in page order. Repeated rows give repeated results. Only
    the three columns are read.
    """
    picked = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), F.col(html_col).cast("string").alias("html"))
    sent = pages.sparkSession.sparkContext.broadcast(network)
    return map_texts(picked, lambda: extractor(sent.value, threshold), "text string, n_chars bigint, n_blocks bigint, n_article_blocks bigint", text="html")
