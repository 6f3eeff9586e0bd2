"""Main text of web pages by a recurrent block labeller.

A page is cut into leaf blocks, the text between two block-level tags.  Each block has a vector: its tag path (tags, and
words of class, id and role, hashed), its words (hashed) and a few sizes.  A bidirectional LSTM in numpy reads the whole
sequence and labels every block as main text or not, with the context of the document on both sides.

There are no labelled pages, so the labeller is trained on a bounded sample of the table (``SAMPLE`` pages with the lowest
hash of url and html, of less than 200,000 characters) whose blocks a few semantic tags label, each also in variants: with other tags and class names in place
of the semantic ones, and with further menus, notices, adverts, forms, sidebars and comments in and around the article.

Scripts, styles, comments, the head and elements with the attribute ``hidden`` have no blocks; what style or aria-hidden
hide is left to the labeller, with a mark in its path.  Elements that are not known as blocks (math, svg, button, picture,
custom ones) are part of the text around them.  Character references are decoded; white space in a block becomes one space.  Null, empty or tagless html: no blocks give the empty text; bare text is one block.  Pages are read whole;
equal rows give equal results; an empty table gives an empty table; a table with no semantic tags trains on the variants'
own parts only, and then labels every block by them.
"""

from __future__ import annotations

import html as entities
import math
import re
import zlib
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SAMPLE = 160
VARIANTS = 4
#: Blocks of training pages beyond this many are left out of the training (not of the extraction).
TRAIN_BLOCKS = 120
PATH_BINS, WORD_BINS, SIZES = 96, 32, 8
WIDTH = PATH_BINS + WORD_BINS + SIZES
HIDDEN = 16
EPOCHS = 14

# Element names of HTML.
BLOCK = frozenset("html head body title address article aside blockquote caption center col colgroup dd details dialog dir div dl dt fieldset figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 header hgroup hr iframe legend li listing main marquee menu nav noframes noscript ol optgroup option p plaintext pre script search section select style summary table tbody td template textarea tfoot th thead tr ul xmp".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
SKIPPED = frozenset("script style noscript template iframe head title".split())
FOREIGN = frozenset("svg math".split())
RAW = "script|style|noscript|template|iframe|textarea|title"
CLOSED_BY_LIKE = frozenset("li dt dd tr td th option p".split())
KEEPS_ITEMS = frozenset("ul ol dl table body div section article main aside nav form td".split())

TOKEN = re.compile(
    rf"<!--.*?(?:-->|\Z)|<(?P<raw>{RAW})\b(?:\"[^\"]*\"|'[^']*'|[^>\"'])*>.*?(?:</(?P=raw)\s*>|\Z)|<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*)(?P<attr>(?:\"[^\"]*\"|'[^']*'|[^>\"'])*)(?:>|\Z)|<[!?/][^>]*(?:>|\Z)|(?P<text>[^<]+|<)",
    re.S | re.I,
)
ATTRIBUTE = re.compile(r"""([^\s"'<>/=]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>"']+)))?""")
NAMES = frozenset("class id role".split())
UNSEEN = re.compile(r"display\s*:\s*none", re.I)


@dataclass
class Block:
    path: tuple[tuple[str, ...], ...]  # per open element: its tag, and the words of its names
    text: str
    linked: float  # share of the characters in links


def blocks(page: str | None) -> list[Block]:
    out: list[Block] = []
    stack: list[tuple[str, ...]] = []
    parts: list[str] = []
    linked, hidden, links = 0, 0, 0

    def flush():
        nonlocal linked
        if parts:
            text = " ".join(entities.unescape("".join(parts)).split())
            if text and not hidden:
                out.append(Block(tuple(stack), text, min(1.0, linked / len(text))))
            parts.clear()
        linked = 0

    def pop(at: int):
        nonlocal hidden, links
        for element in stack[at:]:
            hidden -= element[0] in SKIPPED or element[-1] == "?gone"
            links -= element[0] == "a"
        del stack[at:]

    for m in TOKEN.finditer(page or ""):
        if (text := m["text"]) is not None:
            parts.append(text)
            linked += len(text) if links else 0
            continue
        if (tag := m["tag"]) is None:
            if m["raw"] and m["raw"].lower() == "textarea":
                flush()
            continue
        tag = tag.lower()
        if tag in BLOCK:
            flush()
        elif tag == "br":
            parts.append(" ")
        if m["end"]:
            at = next((i for i in range(len(stack) - 1, -1, -1) if stack[i][0] == tag), None)
            # An inline end tag does not close blocks that were opened meanwhile.
            if at is not None and (tag in BLOCK or all(e[0] not in BLOCK for e in stack[at:])):
                pop(at)
            continue
        if tag in VOID:
            continue
        if tag in BLOCK:
            at = next((i for i in range(len(stack) - 1, -1, -1) if stack[i][0] == "p"), None)
            if at is not None:
                pop(at)  # a paragraph holds no blocks
        if tag in CLOSED_BY_LIKE:
            at = next((i for i in range(len(stack) - 1, -1, -1) if stack[i][0] == tag or stack[i][0] in KEEPS_ITEMS), None)
            if at is not None and stack[at][0] == tag:
                pop(at)
        attributes = m["attr"] or ""
        if attributes.rstrip().endswith("/") and (tag in FOREIGN or any(e[0] in FOREIGN for e in stack)):
            continue
        names, mark = [], []
        for name, *values in ATTRIBUTE.findall(attributes):
            name, value = name.lower(), values[0] or values[1] or values[2]
            if name in NAMES:
                names += re.findall(r"[a-z]+", value.lower())
            elif name == "hidden" and value.lower() != "until-found":
                mark = ["?gone"]
            elif not mark and (name == "hidden" or (name == "aria-hidden" and value.lower() == "true") or (name == "style" and UNSEEN.search(value))):
                mark = ["?hidden"]
        element = (tag, *names, *mark)
        hidden += tag in SKIPPED or element[-1] == "?gone"
        links += tag == "a"
        stack.append(element)
    flush()
    return out


@lru_cache(1 << 16)
def _bin(word: str, bins: int) -> tuple[int, float]:
    h = zlib.crc32(word.encode())
    return h % bins, 1.0 if h >> 16 & 1 else -1.0


def vectors(page: list[Block]) -> np.ndarray:
    x = np.zeros((len(page), WIDTH), np.float32)
    for i, b in enumerate(page):
        for depth, element in enumerate(reversed(b.path)):
            weight = 1.0 if depth < 6 else 0.5
            for word in element:
                at, sign = _bin(word, PATH_BINS)
                x[i, at] += sign * weight
        words = b.text.lower().split()
        for word in words:
            at, sign = _bin(word, WORD_BINS)
            x[i, PATH_BINS + at] += sign / math.sqrt(len(words))
        ends = sum(b.text.count(c) for c in ".,;:!?")
        x[i, -SIZES:] = (min(1.0, math.log1p(len(words)) / 6), b.linked, min(1.0, ends / max(1, len(words)) * 3), i / max(1, len(page) - 1), 1 / (1 + i), 1 / (len(page) - i), min(1.0, len(b.path) / 12), len(words) < 4)
    return np.clip(x, -3, 3)


# -- the labeller ------------------------------------------------------------------------------------------------------


@dataclass
class Labeller:
    """Weights of both directions: (input, 4 x hidden), (hidden, 4 x hidden), bias; then of the output."""

    weights: list[np.ndarray] = field(default_factory=list)

    @staticmethod
    def fresh(seed: int = 5) -> Labeller:
        rng = np.random.default_rng(seed)
        out = []
        for _ in range(2):
            bias = np.zeros(4 * HIDDEN)
            bias[HIDDEN : 2 * HIDDEN] = 1  # remember, to begin with
            out += [rng.normal(0, 1 / math.sqrt(WIDTH), (WIDTH, 4 * HIDDEN)), rng.normal(0, 1 / math.sqrt(HIDDEN), (HIDDEN, 4 * HIDDEN)), bias]
        return Labeller([*out, rng.normal(0, 0.3, 2 * HIDDEN), np.zeros(1)])


def _gates(a: np.ndarray):
    s = 1 / (1 + np.exp(-a[:, : 3 * HIDDEN]))
    return s[:, :HIDDEN], s[:, HIDDEN : 2 * HIDDEN], s[:, 2 * HIDDEN :], np.tanh(a[:, 3 * HIDDEN :])


def _forward(x: np.ndarray, mask: np.ndarray, w: list[np.ndarray], reverse: bool, tape: list | None = None) -> np.ndarray:
    """Hidden states (pages, blocks, HIDDEN); ``mask`` is 1 where a page has a block, elsewhere the state stays."""
    n, steps, _ = x.shape
    ahead = x.reshape(n * steps, -1) @ w[0]
    ahead = (ahead + w[2]).reshape(n, steps, -1)
    h, c, out = np.zeros((n, HIDDEN)), np.zeros((n, HIDDEN)), np.zeros((n, steps, HIDDEN))
    for t in range(steps - 1, -1, -1) if reverse else range(steps):
        i, f, o, g = _gates(ahead[:, t] + h @ w[1])
        here = mask[:, t, None]
        c2 = f * c + i * g
        squashed = np.tanh(c2)
        if tape is not None:
            tape.append((t, here, h, c, i, f, o, g, squashed))
        c = here * c2 + (1 - here) * c
        h = here * (o * squashed) + (1 - here) * h
        out[:, t] = h
    return out


def _backward(x: np.ndarray, grad: np.ndarray, w: list[np.ndarray], tape: list) -> list[np.ndarray]:
    g0, g1, g2 = (np.zeros_like(v) for v in w)
    dh, dc = np.zeros((len(x), HIDDEN)), np.zeros((len(x), HIDDEN))
    for t, here, h, c, i, f, o, g, squashed in reversed(tape):
        dh = dh + grad[:, t]
        dout, dstay = here * dh, (1 - here) * dh
        dcell = here * dc + dout * o * (1 - squashed**2)
        da = np.hstack([dcell * g * i * (1 - i), dcell * c * f * (1 - f), dout * squashed * o * (1 - o), dcell * i * (1 - g**2)])
        g0 += x[:, t].T @ da
        g1 += h.T @ da
        g2 += da.sum(0)
        dh, dc = da @ w[1].T + dstay, dcell * f + (1 - here) * dc
    return [g0, g1, g2]


def _padded(pages: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    steps = max(len(p) for p in pages)
    x, mask = np.zeros((len(pages), steps, WIDTH), np.float32), np.zeros((len(pages), steps))
    for i, p in enumerate(pages):
        x[i, : len(p)], mask[i, : len(p)] = p, 1
    return x, mask


def label(model: Labeller, pages: list[np.ndarray], cells: int = 20_000) -> list[np.ndarray]:
    """For every block whether it is main text; pages of like length are read side by side, about ``cells`` blocks at once."""
    out: list[np.ndarray] = [np.zeros(0, bool)] * len(pages)
    order = sorted((i for i in range(len(pages)) if len(pages[i])), key=lambda i: len(pages[i]))
    at, w = 0, model.weights
    while at < len(order):
        stop = at + 1
        while stop < len(order) and (stop - at + 1) * len(pages[order[stop]]) <= cells:
            stop += 1
        x, mask = _padded([pages[i] for i in order[at:stop]])
        states = np.concatenate([_forward(x, mask, w[:3], False), _forward(x, mask, w[3:6], True)], axis=2)
        kept = states @ w[6] + w[7] > 0
        for k, i in enumerate(order[at:stop]):
            out[i] = kept[k, : len(pages[i])]
        at = stop
    return out


def train(pages: list[tuple[np.ndarray, np.ndarray]], epochs: int = EPOCHS, seed: int = 5, rate: float = 0.01) -> Labeller:
    """By backpropagation through the sequences, with Adam."""
    model, rng = Labeller.fresh(seed), np.random.default_rng(seed)
    first, second, step = [np.zeros_like(v) for v in model.weights], [np.zeros_like(v) for v in model.weights], 0
    order = sorted(range(len(pages)), key=lambda i: len(pages[i][0]))
    batches = [order[i : i + 32] for i in range(0, len(order), 32)]
    for _ in range(epochs):
        for b in rng.permutation(len(batches)):
            chosen = [pages[i] for i in batches[b]]
            x, mask = _padded([p for p, _ in chosen])
            y = np.zeros(mask.shape)
            for i, (_, own) in enumerate(chosen):
                y[i, : len(own)] = own
            w, there, back = model.weights, [], []
            states = np.concatenate([_forward(x, mask, w[:3], False, there), _forward(x, mask, w[3:6], True, back)], axis=2)
            error = (1 / (1 + np.exp(-(states @ w[6] + w[7]))) - y) * mask / mask.sum()
            grad = error[:, :, None] * w[6]
            grads = _backward(x, grad[:, :, :HIDDEN], w[:3], there) + _backward(x, grad[:, :, HIDDEN:], w[3:6], back)
            grads += [np.einsum("pb,pbh->h", error, states), np.array([error.sum()])]
            step += 1
            for k, g in enumerate(grads):
                first[k] = 0.9 * first[k] + 0.1 * g
                second[k] = 0.999 * second[k] + 0.001 * g * g
                w[k] = w[k] - rate * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)
    return model


# -- training pages ----------------------------------------------------------------------------------------------------

ARTICLE = ("article", "main")
#: Elements that are no main text even inside an article, and words of class, id or role that say the same.
ASIDE_TAGS = frozenset("nav header footer aside form menu button select".split())
ASIDE_WORDS = frozenset(
    "ad ads advert advertisement sponsored promo banner nav navbar navigation menu menubar breadcrumb breadcrumbs header masthead topbar footer bottombar sidebar rail widget related recommended cookie cookies consent gdpr notice popup modal newsletter subscribe signup login form search comment comments respond reply discussion share social toolbar pager pagination copyright".split()
)
#: What stands for an article in the variants.
HOLDERS = (("article",), ("main",), ("div", "content"), ("div", "main", "content"), ("div", "article", "body"), ("div", "post"), ("div", "entry", "content"), ("section", "story"), ("div", "text"), ("td", "content"), ("div",))
KINDS = (
    (("nav",), "li"), (("div", "menu"), "li"), (("div", "nav", "bar"), "a"), (("ul", "breadcrumb"), "li"), (("header",), "div"), (("div", "header"), "p"), (("div", "masthead"), "h1"), (("footer",), "p"),
    (("div", "footer"), "p"), (("aside",), "p"), (("div", "sidebar"), "p"), (("div", "sidebar", "widget"), "li"), (("div", "related"), "li"), (("div", "ad"), "p"), (("div", "ads"), "div"), (("div", "advert"), "p"),
    (("section", "sponsored"), "p"), (("div", "promo", "banner"), "p"), (("div", "cookie", "notice"), "p"), (("div", "cookie", "consent", "banner"), "div"), (("div", "notice"), "p"), (("div", "popup", "modal"), "p"),
    (("form",), "label"), (("form", "search"), "div"), (("div", "newsletter", "signup"), "p"), (("div", "login"), "label"), (("div", "comments"), "p"), (("section", "comments"), "div"), (("div", "comment", "list"), "p"),
    (("ol", "comments"), "li"), (("div", "share", "social"), "a"), (("div", "pagination"), "a"), (("div", "copyright"), "p"),
)


def teacher(b: Block) -> bool | None:
    """Main text by semantic tags alone; None where no element says anything."""
    inside = None
    for element in b.path:
        if element[0] in ASIDE_TAGS or ASIDE_WORDS & set(element[1:]):
            return False
        if element[0] in ARTICLE:
            inside = True
    return inside


def variant(page: list[Block], truth: list[bool], rng: np.random.Generator) -> tuple[list[Block], list[bool]]:
    """The page with another holder for its article and more blocks that are no main text, made of the page's own words."""
    words = [w for b in page for w in b.text.split()] or ["text"]
    holder = HOLDERS[rng.integers(len(HOLDERS))]
    wrapped = bool(rng.integers(2))
    out = []
    for b, good in zip(page, truth):
        path = tuple(holder if e[0] in ARTICLE else e for e in b.path)
        if wrapped:
            path = tuple(x for e in path for x in ([e, ("div", "page", "wrapper")] if e[0] == "body" else [e]))
        text, linked = b.text, b.linked
        if good and rng.random() < 0.3:  # lists, quotes, headings and tables occur in articles too
            kind = [("ul",), ("blockquote",), ("h2",), ("h3",), ("table",), ("figure",)][rng.integers(6)]
            path = (*path[:-1], kind, ("li",)) if kind[0] == "ul" else (*path[:-1], kind)
        if good and rng.random() < 0.1:
            text = " ".join(text.split()[: rng.integers(1, 8)])
        out.append((Block(path, text, linked), good))
    article = [i for i, (_, good) in enumerate(out) if good]
    root = out[0][0].path[:2] if out else (("html",), ("body",))
    root = tuple(e for e in root if e[0] in ("html", "body"))
    for _ in range(rng.integers(1, 7)):
        kind, leaf = KINDS[rng.integers(len(KINDS))]
        own = []
        prefix = root
        where = rng.integers(4)
        if where == 3 and article:  # inside the article
            prefix = out[article[0]][0].path[:-1]
        for _ in range(rng.integers(1, 7)):
            size = int(rng.integers(1, 6) if leaf in ("li", "a", "label") else rng.integers(2, 40))
            start = int(rng.integers(len(words)))
            linked = 1.0 if leaf in ("li", "a") and rng.random() < 0.8 else 0.0
            own.append((Block((*prefix, kind, (leaf,), *([("a",)] if linked else [])), " ".join(words[start : start + size]), linked), False))
        at = 0 if where == 0 else len(out) if where < 3 else int(rng.integers(article[0] + 1, article[-1] + 2)) if article else 0
        out[at:at] = own
        article = [i for i, (_, good) in enumerate(out) if good]
    return [b for b, _ in out], [good for _, good in out]


def training_pages(pages: list[str], seed: int = 5) -> list[tuple[np.ndarray, np.ndarray]]:
    rng = np.random.default_rng(seed)
    out = []
    for page in pages:
        found = blocks(page)[:TRAIN_BLOCKS]
        said = [teacher(b) for b in found]
        if not any(said):
            continue
        truth = [bool(s) for s in said]
        for own, good in [(found, truth), *(variant(found, truth, rng) for _ in range(VARIANTS))]:
            out.append((vectors(own), np.array(good, float)))
    return out


#: Where the sample has no page with semantic tags: these words in such a page.
PLAIN = "<html><body><nav><a href=x>home</a></nav><article><h1>On this page</h1>" + "".join(f"<p>{'words of one more paragraph, ' * k}end.</p>" for k in range(1, 9)) + "</article><footer>all the rest</footer></body></html>"


def fit(df: DataFrame, sample: int = SAMPLE) -> Labeller:
    """Trained on ``sample`` pages (a bounded collect), the same ones on every run."""
    chosen = df.where("html is not null and length(html) < 200000").select("html", F.xxhash64("url", "html").alias("h")).orderBy("h").limit(sample).collect()
    pages = training_pages([r.html for r in chosen])
    return train(pages or training_pages([PLAIN] * 8))


def extract(df: DataFrame, model: Labeller) -> DataFrame:
    """(page_id, url, text, n_chars, n_blocks) of every page."""

    def run(batches):
        for batch in batches:
            for start in range(0, len(batch), 256):
                part = batch.slice(start, 256)
                found = [blocks(h) for h in part.column(2).to_pylist()]
                marks = label(model, [vectors(b) for b in found])
                texts = ["\n".join(b.text for b, keep in zip(own, kept) if keep) for own, kept in zip(found, marks)]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64()), pa.array([len(b) for b in found], pa.int64())],
                    ["page_id", "url", "text", "n_chars", "n_blocks"],
                )

    kind = f"page_id {df.schema['page_id'].dataType.simpleString()}, url string, text string, n_chars long, n_blocks long"
    return df.select("page_id", F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html")).mapInArrow(run, kind)
