"""Main text of web pages: a bidirectional LSTM labels the leaf blocks of a page in their document-wide context.

A page becomes a sequence of blocks (runs of text between block-level tags).  Each block is a hashed vector of its tag
path, with class and id words, a hashed vector of its words, and a few numbers.  The LSTM, in numpy, reads the sequence
in both directions and gives each block its chance of being article text.

It is trained here on a bounded sample of pages.  Their blocks are labelled by landmark tags and class names, and the
same texts are put into other page layouts as well, so that the model learns to tell articles by more than one tag.
"""

from __future__ import annotations

import html as entities
import re
import zlib
from bisect import bisect_left
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Pages that the model is trained on, at most, and their greatest length in characters.
TRAINING_PAGES, TRAINING_CHARS = 160, 65_536
PATH_SIZE, WORD_SIZE, NUMBERS, HIDDEN = 64, 32, 5, 16
INPUT = PATH_SIZE + WORD_SIZE + NUMBERS
#: Blocks that are held in one padded batch, about.
BATCH_BLOCKS = 1 << 14
#: Places of a sequence whose inputs are multiplied at once.
STEPS = 4096

# HTML's void, raw-text and block-level elements, and those whose opening ends a paragraph.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template textarea iframe svg math object canvas audio video select".split())
BLOCK = frozenset(
    "address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset figcaption"
    " figure footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol option p pre"
    " search section summary table tbody td tfoot th thead title tr ul".split()
)
ENDS_ITSELF = {"li": ("ul", "ol", "menu"), "dt": ("dl",), "dd": ("dl",), "tr": ("table",), "td": ("tr",), "th": ("tr",), "option": ()}
# What pages call their main part and everything around it; used for training labels only.
MAIN_TAGS = frozenset(("article", "main"))
MAIN_WORDS = frozenset("article content entry post story main body".split())
ASIDE_TAGS = frozenset("nav footer aside form head menu button dialog select".split())
ASIDE_WORDS = frozenset(
    "ad ads advert advertisement banner breadcrumb breadcrumbs comment comments cookie cookies consent footer header"
    " masthead menu modal nav navbar navigation newsletter notice popup promo related search share sharing sidebar"
    " social sponsor sponsored subscribe widget disqus reply replies toolbar".split()
)
_TAG = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>")
_NAME = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)")
_MARK = re.compile("[>\"']")
_NAMES = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_PART = re.compile(r"[a-z]+|\d+")


class Place:
    """Where a block stands: the names of its element, ``tag`` and ``.word`` for class and id words, and the place above.

    ``fresh`` are the names that no element above has; what is known of the whole path is kept from element to element,
    so that a path of any depth costs its last element.
    """

    __slots__ = ("above", "names", "fresh", "inner", "aside", "header", "main", "main_tag", "vector")

    def __init__(self, above: Place | None = None, names: tuple[str, ...] = (), fresh: tuple[str, ...] = ()):
        self.above, self.names, self.fresh = above, names, fresh
        self.inner: dict[tuple[str, ...], Place] = {}
        self.vector: np.ndarray | None = None
        self.aside = bool(above and above.aside) or any((n[1:] in ASIDE_WORDS) if n[0] == "." else n in ASIDE_TAGS for n in names)
        self.main_tag = bool(above and above.main_tag) or any(n in MAIN_TAGS for n in names)
        self.main = bool(above and above.main) or any(n[0] == "." and n[1:] in MAIN_WORDS for n in names)
        self.header = bool(above and above.header) or "header" in names

    def path(self) -> tuple[str, ...]:
        """All names from the root."""
        chain, at = [], self
        while at is not None:
            chain.append(at.names)
            at = at.above
        return tuple(name for names in reversed(chain) for name in names)


@dataclass
class Block:
    """Text of one block, its place, and how much of it is links."""

    place: Place
    text: str
    linked: int

    @property
    def path(self) -> tuple[str, ...]:
        return self.place.path()


class _Ends:
    """Where tags end whose quotes do not pair up: each mark is followed once, however many tags begin before it."""

    def __init__(self, html: str):
        self._html, self._known = html, {}
        self._marks = [m.start() for m in _MARK.finditer(html)]
        self._same = [-1] * len(self._marks)
        later: dict[str, int] = {}
        for k in range(len(self._marks) - 1, -1, -1):
            mark = html[self._marks[k]]
            self._same[k], later[mark] = later.get(mark, -1), k

    def after(self, at: int) -> int:
        """The ``>`` outside of quotes that ends a tag read from ``at`` on; -1 if there is none."""
        k, passed = bisect_left(self._marks, at), []
        while k < len(self._marks) and k not in self._known and self._html[self._marks[k]] != ">":
            passed.append(k)
            k = self._same[k] + 1 if self._same[k] >= 0 else len(self._marks)
        end = self._known.get(k, self._marks[k]) if k < len(self._marks) else -1
        self._known.update(dict.fromkeys(passed, end))
        return end


def blocks(html: str, root: Place | None = None) -> list[Block]:
    """The blocks of a page that have text, in page order.  Scripts, styles and markup are gone, references decoded.

    Time and memory grow with the page, however deep or broken it is.  Pages read under one ``root`` share their places.
    """
    out: list[Block] = []
    here = root or Place()
    stack: list[tuple[str, Place]] = []
    open_at: dict[str, list[int]] = {}  # depths of the open elements by tag
    within: dict[str, int] = {}  # how many open elements have a name
    text: list[str] = []
    state = [0, 0]  # open links, and characters inside them

    def flush() -> None:
        if text:
            plain = " ".join(entities.unescape("".join(text)).split())
            if plain:
                out.append(Block(here, plain, min(state[1], len(plain))))
            text.clear()
        state[1] = 0

    def pop_to(depth: int) -> None:
        nonlocal here
        while len(stack) > depth:
            tag, here = stack.pop()
            open_at[tag].pop()
            for name in inside.pop():
                within[name] -= 1

    inside: list[tuple[str, ...]] = []

    def last(tag: str) -> int:
        depths = open_at.get(tag)
        return depths[-1] if depths else -1

    at, end, final, ends = 0, len(html), html.rfind(">"), None
    while at < end:
        begin = at
        closing = tag = rest = ""
        look = at
        while True:
            less = html.find("<", look)
            if less < 0 or less > final:
                # No tag can end any more; an open comment still hides the rest.
                less = html.find("<!--", less) if less >= 0 else -1
                stop, at = (less if less >= 0 else end), end
                break
            if html.startswith("<!--", less):
                close = html.find("-->", less + 4)
                stop, at = less, close + 3 if close >= 0 else end
                break
            name = _NAME.match(html, less)
            if name:
                whole = _TAG.match(html, less) if ends is None else None
                if whole is None:
                    ends = ends or _Ends(html)
                    close = ends.after(name.end())
                    close = close if close >= 0 else html.find(">", name.end())
                    closing, tag, rest, at = name[1], name[2], html[name.end() : close], close + 1
                else:
                    closing, tag, rest, at = whole[1], whole[2], whole[3], whole.end()
                stop = less
                break
            if html[less + 1 : less + 2] in ("!", "?", "/"):
                stop, at = less, html.find(">", less + 1) + 1
                break
            look = less + 1
        if stop > begin:
            text.append(html[begin:stop])
            if state[0]:
                state[1] += stop - begin
        if not tag:
            continue
        tag = tag.lower()
        if not closing and tag in RAW:
            if rest.endswith("/") and tag in ("svg", "math"):
                continue
            close = re.compile(rf"</{tag}\b", re.I).search(html, at)
            close = html.find(">", close.end()) if close else -1
            at = close + 1 if close >= 0 else end
            continue
        if tag == "br":
            text.append(" ")
            continue
        if tag == "a":
            state[0] = max(0, state[0] + (-1 if closing else 1))
            continue
        if tag not in BLOCK:
            continue
        flush()
        state[0] = 0
        if tag in VOID:
            continue
        if closing:
            if last(tag) >= 0:
                pop_to(last(tag))
            continue
        if stack and stack[-1][0] in ("p", "h1", "h2", "h3", "h4", "h5", "h6") and (stack[-1][0] == "p" or tag[0] == "h"):
            pop_to(len(stack) - 1)
        if tag in ENDS_ITSELF and last(tag) > max((last(t) for t in ENDS_ITSELF[tag]), default=-1):
            pop_to(last(tag))
        if tag == "body" and stack and stack[-1][0] == "head":
            pop_to(len(stack) - 1)
        words = [w for m in _NAMES.finditer(rest) for w in _PART.findall((m[1] or m[2] or m[3] or "").lower())]
        names = (tag, *(f".{w}" for w in dict.fromkeys(words)))
        inner = here.inner.get(names)
        if inner is None:
            inner = here.inner[names] = Place(here, names, tuple(n for n in names if not within.get(n)))
        stack.append((tag, here))
        inside.append(names)
        open_at.setdefault(tag, []).append(len(stack) - 1)
        for n in names:
            within[n] = within.get(n, 0) + 1
        here = inner
    flush()
    return out


class Places:
    """A root for the places of many pages, taken anew once it holds many."""

    def __init__(self, most: int = 20_000):
        self._most, self._root, self._pages = most, Place(), 0

    def read(self, htmls: list[str | None]) -> list[list[Block]]:
        self._pages += 1
        if self._pages % 16 == 0 and self._size() > self._most:
            self._root = Place()
        return [blocks(h or "", self._root) for h in htmls]

    def _size(self) -> int:
        count, left = 0, [self._root]
        while left and count <= self._most:
            count += 1
            left.extend(left.pop().inner.values())
        return count


class Features:
    """Turns blocks into input vectors, remembering the places of words that recur."""

    def __init__(self) -> None:
        self._words: dict[str, int] = {}

    @staticmethod
    def _hashed(name: str) -> tuple[int, int]:
        code = zlib.crc32(name.encode("utf-8", "replace"))
        return code % PATH_SIZE, 1 if code >> 16 & 1 else -1

    def _path(self, place: Place) -> np.ndarray:
        """Hashed sums of the distinct names of a path; made from the place above."""
        chain, at = [], place
        while at is not None and at.vector is None:
            chain.append(at)
            at = at.above
        found = np.zeros(PATH_SIZE, np.int16) if at is None else at.vector
        for at in reversed(chain):
            found = found.copy()
            for name in at.fresh:
                if name not in ("html", "body"):
                    where, sign = self._hashed(name)
                    found[where] += sign
            at.vector = found
        return found

    def __call__(self, page: list[Block]) -> np.ndarray:
        out = np.zeros((len(page), INPUT), np.float32)
        for row, block in zip(out, page):
            row[:PATH_SIZE] = self._path(block.place)
            if block.place.names:
                where, sign = self._hashed("leaf " + block.place.names[-1])
                row[where] += sign
            words = block.text.split()
            places = []
            for w in words:
                place = self._words.get(w)
                if place is None:
                    place = zlib.crc32(w.lower().encode("utf-8", "replace")) % WORD_SIZE
                    if len(self._words) < 200_000:
                        self._words[w] = place
                places.append(place)
            counts = np.bincount(places, minlength=WORD_SIZE)
            row[PATH_SIZE : PATH_SIZE + WORD_SIZE] = 0.3 * counts / np.sqrt(max((counts**2).sum(), 1))
            n = len(block.text)
            row[-NUMBERS:] = (
                min(len(words), 100) / 50,
                block.linked / n,
                float(block.text[-1] in ".!?…"),
                float(n < 25),
                float("©" in block.text),
            )
        return out


@dataclass
class Model:
    """Weights of two LSTMs (forward, backward) and of the output; gates are input, forget, output and candidate."""

    weights: dict[str, np.ndarray] = field(default_factory=dict)

    @classmethod
    def fresh(cls, seed: int = 5) -> Model:
        random, out = np.random.default_rng(seed), {}
        for way in "fb":
            out[f"{way}x"] = random.normal(0, 0.15, (INPUT, 4 * HIDDEN))
            out[f"{way}h"] = random.normal(0, 0.15, (HIDDEN, 4 * HIDDEN))
            out[f"{way}c"] = np.concatenate([np.zeros(HIDDEN), np.ones(HIDDEN), np.zeros(2 * HIDDEN)])
        out["o"], out["oc"] = random.normal(0, 0.15, 2 * HIDDEN), np.zeros(1)
        return cls({k: v.astype(np.float32) for k, v in out.items()})

    def _run(self, way: str, x: np.ndarray, real: np.ndarray, keep: bool):
        n, t, _ = x.shape
        into, chunk = np.zeros((n, 0, 4 * HIDDEN), np.float32), -1
        h = c = np.zeros((n, HIDDEN), np.float32)
        states, trail = np.zeros((n, t, HIDDEN), np.float32), []
        for k in range(t) if way == "f" else range(t - 1, -1, -1):
            if k // STEPS != chunk:  # a long page is not multiplied as a whole
                chunk = k // STEPS
                into = x[:, chunk * STEPS : (chunk + 1) * STEPS] @ self.weights[f"{way}x"] + self.weights[f"{way}c"]
            gates = into[:, k % STEPS] + h @ self.weights[f"{way}h"]
            sig = 1 / (1 + np.exp(-gates[:, : 3 * HIDDEN]))
            i, f, o, g = sig[:, :HIDDEN], sig[:, HIDDEN : 2 * HIDDEN], sig[:, 2 * HIDDEN :], np.tanh(gates[:, 3 * HIDDEN :])
            here = real[:, k, None]
            new_c = f * c + i * g
            tanh_c = np.tanh(new_c)
            if keep:
                trail.append((k, h, c, i, f, o, g, tanh_c))
            h, c = np.where(here, o * tanh_c, h), np.where(here, new_c, c)
            states[:, k] = h
        return states, trail

    def chances(self, x: np.ndarray, real: np.ndarray) -> np.ndarray:
        """Chance of each place (n, t) to be article text."""
        both = np.concatenate([self._run(way, x, real, False)[0] for way in "fb"], axis=2)
        return 1 / (1 + np.exp(-(both @ self.weights["o"] + self.weights["oc"][0])))

    def slopes(self, x: np.ndarray, real: np.ndarray, y: np.ndarray) -> tuple[dict[str, np.ndarray], float]:
        """Gradient of the mean log loss by backpropagation through time."""
        runs = {way: self._run(way, x, real, True) for way in "fb"}
        both = np.concatenate([runs[w][0] for w in "fb"], axis=2)
        p = 1 / (1 + np.exp(-(both @ self.weights["o"] + self.weights["oc"][0])))
        total = max(int(real.sum()), 1)
        loss = -float((np.log(np.where(y, p, 1 - p) + 1e-7) * real).sum()) / total
        off = (p - y) * real / total
        out = {"o": np.einsum("nt,nth->h", off, both), "oc": np.array([off.sum()])}
        for at, way in enumerate("fb"):
            above = off[:, :, None] * self.weights["o"][at * HIDDEN : (at + 1) * HIDDEN]
            dx, dh = np.zeros_like(self.weights[f"{way}x"]), np.zeros_like(self.weights[f"{way}h"])
            dc = np.zeros(4 * HIDDEN, np.float32)
            from_h = from_c = np.zeros((len(x), HIDDEN), np.float32)
            for k, h, c, i, f, o, g, tanh_c in reversed(runs[way][1]):
                here = real[:, k, None]
                to_h = above[:, k] + from_h
                cell = to_h * o * (1 - tanh_c**2) + from_c
                gates = np.concatenate([cell * g * i * (1 - i), cell * c * f * (1 - f), to_h * tanh_c * o * (1 - o), cell * i * (1 - g**2)], axis=1)
                gates = np.where(here, gates, 0)
                dx += x[:, k].T @ gates
                dh += h.T @ gates
                dc += gates.sum(axis=0)
                from_h = np.where(here, gates @ self.weights[f"{way}h"].T, to_h)
                from_c = np.where(here, cell * f, from_c)
            out[f"{way}x"], out[f"{way}h"], out[f"{way}c"] = dx, dh, dc
        return out, loss


def padded(pages: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    longest = max((len(p) for p in pages), default=0)
    x, real = np.zeros((len(pages), longest, INPUT), np.float32), np.zeros((len(pages), longest), bool)
    for k, p in enumerate(pages):
        x[k, : len(p)], real[k, : len(p)] = p, True
    return x, real


def landmark(block: Block) -> bool:
    """The training label: inside a main part, and in nothing that stands around or inside it."""
    place = block.place
    if place.aside or (place.header and not place.main_tag):
        return False
    return place.main_tag or place.main


#: Layouts for training: what stands for an article, and what surrounds or interrupts it.  {} is the text.
ARTICLES = (
    "<article>{}</article>", "<main>{}</main>", "<main><article>{}</article></main>", '<div class="content">{}</div>',
    '<div id="main">{}</div>', '<section class="post">{}</section>', '<div class="article-body">{}</div>',
    '<div class="entry-content">{}</div>', '<div class="story"><div>{}</div></div>', '<article class="post" id="story">{}</article>',
)
LISTS = ("<nav>{}</nav>", '<div class="menu">{}</div>', '<div class="breadcrumbs">{}</div>', '<div class="related">{}</div>', '<div class="share-buttons">{}</div>', '<header class="site-header">{}</header>')
NOISE = (
    '<div class="ad">{}</div>', '<aside class="sidebar">{}</aside>', "<aside>{}</aside>", '<div class="cookie-notice">{}</div>',
    '<div class="notice">{}</div>', '<div class="banner">{}</div>', "<form><label>{}</label><input><button>Go</button></form>",
    '<div id="comments">{}</div>', '<section class="comments"><div class="comment">{}</div></section>', '<div class="promo">{}</div>',
    '<div class="newsletter">{}</div>', "<header>{}</header>", '<div class="sidebar">{}</div>', '<div class="advert">{}</div>',
)
ENDS = ("<footer>{}</footer>", '<div class="footer">{}</div>', "<footer><p>{}</p></footer>")


def varied(pages: list[list[Block]], number: int, seed: int = 11) -> list[tuple[list[Block], np.ndarray]]:
    """The pages' texts in other layouts, with labels known from where they were put."""
    random = np.random.default_rng(seed)
    pool = [b.text for p in pages for b in p if landmark(b)]
    short = [b.text for p in pages for b in p if not landmark(b) and len(b.text) < 60]
    if not pool or not short:
        return []
    out = []

    def some(texts: list[str], least: int, most: int) -> list[str]:
        return [texts[int(k)] for k in random.integers(0, len(texts), int(random.integers(least, most)))]

    def pick(options: tuple[str, ...]) -> str:
        return options[int(random.integers(0, len(options)))]

    for _ in range(number):
        good, parts, marks = set(), [], {}

        def put(text: str, is_good: bool) -> str:
            mark = f"@{len(marks)}@"
            marks[mark] = text
            if is_good:
                good.add(mark)
            return mark

        def noise() -> str:
            texts = some(pool if random.random() < 0.6 else short, 1, 4)
            return pick(NOISE).format("".join(f"<p>{put(t, False)}</p>" if random.random() < 0.6 else f"<div>{put(t, False)}</div>" for t in texts))

        def links() -> str:
            return pick(LISTS).format("<ul>" + "".join(f'<li><a href="/">{put(t, False)}</a></li>' for t in some(short, 2, 8)) + "</ul>")

        parts.append(f"<head><title>{put(pick(tuple(pool))[:60], False)}</title></head>")
        parts += [links() if random.random() < 0.7 else noise() for _ in range(int(random.integers(0, 4)))]
        inside = [f"<h1>{put(pick(tuple(pool))[:60], True)}</h1>"] if random.random() < 0.8 else []
        for text in some(pool, 1, 14):
            kind = random.random()
            if kind < 0.08:
                inside.append(f"<h2>{put(text[:50], True)}</h2>")
            elif kind < 0.14:
                inside.append(f"<ul><li>{put(text[:80], True)}</li><li>{put(text[80:160] or text[:9], True)}</li></ul>")
            elif kind < 0.18:
                inside.append(f"<blockquote>{put(text, True)}</blockquote>")
            else:
                inside.append(f"<p>{put(text if random.random() < 0.8 else text[:20], True)}</p>")
            if random.random() < 0.08:
                inside.append(noise())
        if random.random() < 0.15:
            inside.append(noise())
        parts.append(pick(ARTICLES).format("".join(inside)))
        parts += [links() if random.random() < 0.3 else noise() for _ in range(int(random.integers(0, 3)))]
        if random.random() < 0.9:
            parts.append(pick(ENDS).format(put(("© " if random.random() < 0.5 else "") + some(short, 1, 2)[0], False)))
        page = blocks("<html><body>" + "".join(parts) + "</body></html>")
        labels = np.array([b.text in good for b in page])
        out.append(([Block(b.place, marks.get(b.text, b.text), len(marks.get(b.text, b.text)) if b.linked else 0) for b in page], labels))
    return out


def fitted(htmls: list[str], epochs: int = 10, width: int = 64) -> Model | None:
    """The model trained on the given pages and their texts in other layouts; None without a page that has an article."""
    real_pages = [p for p in map(blocks, htmls) if p]
    cases = [(p, np.array([landmark(b) for b in p])) for p in real_pages] + varied(real_pages, 3 * len(real_pages))
    if not any(y.any() for _, y in cases):
        return None
    features = Features()
    cut = [(x[k : k + width], y[k : k + width]) for x, y in ((features(p), y) for p, y in cases) for k in range(0, len(y), width)]
    model, random = Model.fresh(), np.random.default_rng(3)
    mean = {k: np.zeros_like(v) for k, v in model.weights.items()}
    square = {k: np.zeros_like(v) for k, v in model.weights.items()}
    step = 0
    for epoch in range(epochs):
        for part in np.array_split(random.permutation(len(cut)), max(1, len(cut) // 32)):
            x, real = padded([cut[k][0] for k in part])
            y = np.zeros(real.shape, bool)
            for row, k in zip(y, part):
                row[: len(cut[k][1])] = cut[k][1]
            slopes, _ = model.slopes(x, real, y)
            step += 1
            rate = 0.02 * (1 - epoch / epochs) + 0.001
            for name, slope in slopes.items():
                mean[name] = 0.9 * mean[name] + 0.1 * slope
                square[name] = 0.99 * square[name] + 0.01 * slope**2
                move = rate * (mean[name] / (1 - 0.9**step)) / (np.sqrt(square[name] / (1 - 0.99**step)) + 1e-8)
                model.weights[name] = (model.weights[name] - move).astype(np.float32)
    return model


def trained(pages: DataFrame, html: str = "html", limit: int = TRAINING_PAGES) -> Model | None:
    """The model for ``pages``, from at most ``limit`` different ones with at most ``TRAINING_CHARS`` characters.

    If no page of the sample has an article, it is drawn from the pages that have one.
    """
    rows = pages.select(F.col(f"`{html}`").cast("string").alias("html"))
    rows = rows.where(F.length("html").between(1, TRAINING_CHARS))
    model = fitted(sampled(rows, limit))
    return fitted(sampled(rows.mapInArrow(_with_article, rows.schema), limit)) if model is None else model


def sampled(rows: DataFrame, limit: int) -> list[str]:
    """At most ``limit`` different values of the only column of ``rows``, by the least hashes, in their order."""
    rows = rows.toDF("html").withColumn("h", F.xxhash64("html"))
    # Only hashes are dealt out to leave copies out, and then the few pages that have one of the least.
    least = [r.h for r in rows.select("h").distinct().orderBy("h").limit(limit).collect()]
    if not least:
        return []
    return [r.html for r in rows.where(F.col("h").isin(least)).distinct().orderBy("h", "html").limit(limit).collect()]


def _with_article(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, 256):
            part = batch.slice(at, 256)
            yield part.filter(pa.array([any(map(landmark, blocks(h))) for h in part.column(0).to_pylist()], pa.bool_()))


def labelled(pages: list[list[Block]], model: Model | None, features: Features) -> list[np.ndarray]:
    """For each page, which blocks are article text.  Without a model all are."""
    if model is None:
        return [np.ones(len(p), bool) for p in pages]
    out = [np.zeros(0, bool)] * len(pages)
    order = sorted(range(len(pages)), key=lambda k: len(pages[k]))
    at = 0
    while at < len(order):
        stop = at + 1
        while stop < len(order) and (stop + 1 - at) * len(pages[order[stop]]) <= BATCH_BLOCKS:
            stop += 1
        group = order[at:stop]
        x, real = padded([features(pages[k]) for k in group])
        for k, chance in zip(group, model.chances(x, real)):
            out[k] = chance[: len(pages[k])] >= 0.5
        at = stop
    return out


def extracted(pages: DataFrame, model: Model | None, html: str = "html", out: str = "text") -> DataFrame:
    """``pages`` with the main text in the column ``out``: article blocks in page order, joined by two newlines.

    Null or empty html gives empty text, and so does a page without article blocks.  An existing column ``out`` is
    replaced; all others and repeated rows pass through.
    """
    kept = [c for c in pages.columns if c != out]
    source = pages.select(*(F.col(f"`{c}`") for c in kept), F.col(f"`{html}`").cast("string").alias("__html"))
    schema = T.StructType([*source.schema.fields[:-1], T.StructField(out, T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features, places = Features(), Places()
        for whole in batches:
            for at in range(0, whole.num_rows, 256):
                batch = whole.slice(at, 256)
                found = places.read(batch.column(len(kept)).to_pylist())
                texts = ["\n\n".join(b.text for b, y in zip(p, good) if y) for p, good in zip(found, labelled(found, model, features))]
                yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(texts, pa.string())], names=[*kept, out])

    return source.mapInArrow(run, schema)
