"""Main text of web pages by a recurrent labeller over their blocks.

A page becomes its sequence of leaf blocks. Each block is described by its tag path (tags, class
and id words, hashed), by its words (hashed) and by a few numbers; a bidirectional LSTM reads the
whole sequence and labels every block, so a block is judged in the context of all the others. The
network is plain numpy. It is trained here, on a bounded sample of pages and on pages composed from
their texts, with labels a teacher gives to blocks whose path says what they are: the nearest
element that says anything counts, whatever contains it. Other blocks carry no label, path words are
dropped at random, and some composed pages have nameless elements, so that words and context count too.
"""

from __future__ import annotations

import html
import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stopwise.llm.common import smallest

PATH_DIM, WORD_DIM, NUMBERS = 128, 32, 6
INPUT = PATH_DIM + WORD_DIM + NUMBERS
HIDDEN = 16
#: Pages the labeller is trained on, pages composed from them, blocks of a training window and windows.
SAMPLE_PAGES, COMPOSED_PAGES, WINDOW, WINDOWS = 300, 400, 120, 1000
EPOCHS, BATCH = 16, 16
SEED = 6
#: Blocks labelled together at most, whatever the pages' lengths.
BLOCKS_AT_ONCE = 20_000

#: Elements whose content is no text of the page.
HIDDEN_TAGS = frozenset("head script style noscript template svg math iframe object select textarea".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements that do not end a block; every other one does.
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data dfn em font i img ins kbd label mark q s samp small "
    "span strike strong sub sup time tt u var wbr".split()
)
#: An opening tag of these ends an open element of the same kind.
CLOSES_ITSELF = frozenset("p li dt dd tr td th option".split())

#: What the teacher knows: words of a path that name boilerplate, and those that name the article.
NOT_MAIN = frozenset(
    "nav menu header footer aside sidebar side ad ads advert advertisement sponsor promo banner cookie notice "
    "consent popup modal form login search comment comments reply replies disqus related share social breadcrumb "
    "breadcrumbs pager pagination newsletter subscribe widget toolbar copyright legal button".split()
)
MAIN = frozenset("article main content post entry story".split())
#: An element named as one of these holds the whole page: its other names say nothing. Names that
#: start like the second ones say what a page has, not what an element is.
CONTAINER = frozenset("wrapper wrap container layout page site outer root body html".split())
OF_PAGE = ("has-", "with-", "no-", "is-", "js-")
#: Elements of a block's path that are looked at, from the block outwards.
NEAREST = 8

_NAME = re.compile(r"[a-zA-Z][^\s/>]*")
_ATTRIBUTE = re.compile(r"[\s/]*([^\s/>=]*)(\s*=\s*)?")
_BARE = re.compile(r"[^\s>]*")
_NAMING = frozenset(("class", "id", "role"))
_PART = re.compile(r"[a-z]+")


class Block:
    __slots__ = ("path", "text", "linked", "verdict")

    def __init__(self, path: tuple[str, ...], text: str, linked: int, verdict: int | None):
        self.path, self.text, self.linked, self.verdict = path, text, linked, verdict


class Reader:
    """Tags of a page from left to right, in time linear in its length whatever it holds.

    Attributes are read as browsers do: a quote opens a value only right behind an equals sign, and
    one that never closes is an ordinary character. A tag that never ends is closed at the next
    angle bracket, like all tags behind it.
    """

    def __init__(self, page: str):
        self.page = page
        self.last = {c: page.rfind(c) for c in "\"'>"}
        self.naive = False
        self.lacking: set[str] = set()  # end tags that do not come any more

    def tag(self, at: int) -> tuple[str, str, bool, int] | None:
        """(name, class and id and role, whether it closes itself, end) of the opening tag at ``at``."""
        m = _NAME.match(self.page, at + 1)
        if at > self.last[">"]:
            return None
        name, named, i, slash = m[0].lower(), [], m.end(), False
        while not self.naive:
            m = _ATTRIBUTE.match(self.page, i)
            key, i = m[1], m.end()
            if i >= len(self.page):
                self.naive = True  # no end outside quotes, so none for any tag from here on
                break
            slash = not key and "/" in m[0]
            if m[2]:
                quote = self.page[i]
                if quote in "\"'" and i < self.last[quote]:
                    end = self.page.index(quote, i + 1)
                    value, i = self.page[i + 1 : end], end + 1
                else:
                    value = _BARE.match(self.page, i)[0]
                    i += len(value)
                if key.lower() in _NAMING:
                    named.append(value)
            elif self.page[i] == ">":
                return name, " ".join(named).lower(), slash, i + 1
            elif not m[0]:
                i += 1
        end = self.page.index(">", at)
        return name, "", self.page[end - 1] == "/", end + 1

    def hidden_end(self, tag: str, at: int) -> int:
        """End of the hidden element opened before ``at``; ``at`` itself where it never ends."""
        if tag not in self.lacking:
            pattern = r"</head\s*>|(?=<body[\s>])" if tag == "head" else rf"</{tag}\s*>"
            found = re.compile(pattern, re.I).search(self.page, at)
            if found:
                return found.end()
            self.lacking.add(tag)
        return len(self.page) if tag in ("script", "style") else at


def _words(tag: str, named: str) -> tuple[tuple[str, ...], int | None]:
    """Words of an element, and what they say: 1 main text, 0 boilerplate, None nothing."""
    tokens = [t for t in named.split() if not t.startswith(OF_PAGE)]
    words = [w for t in tokens for w in _PART.findall(t)]
    says = {tag, *words}
    if says & CONTAINER:
        return (f"<{tag}>",), None
    verdict = 0 if says & NOT_MAIN else 1 if says & MAIN else None
    return (f"<{tag}>", *words), verdict


def blocks(page: str | None) -> list[Block]:
    """Leaf blocks of a page in order: path words, text (references decoded, white space joined),
    linked characters, and what the nearest element that says anything makes of them.

    A path holds the words of the NEAREST elements around a block, as far as the one that says
    what it is, and of that one, however far out it is.
    """
    page = page or ""
    reader = Reader(page)
    out: list[Block] = []
    stack: list[tuple[str, tuple[str, ...], int | None, int]] = []  # tag, words, verdict, index of who gave it
    opened: Counter = Counter()
    parts: list[str] = []
    at, links, linked = 0, 0, 0

    def flush() -> None:
        nonlocal linked
        text = " ".join("".join(parts).split())
        if text:
            verdict, by = (stack[-1][2], stack[-1][3]) if stack else (None, -1)
            near = stack[max(by, len(stack) - NEAREST, 0) :]
            if 0 <= by < len(stack) - NEAREST:
                near = [stack[by], *near]
            out.append(Block(tuple(w for e in near for w in e[1]), text, linked, verdict))
        parts.clear()
        linked = 0

    def add(raw: str) -> None:
        nonlocal linked
        if raw:
            text = html.unescape(raw)
            parts.append(text)
            if links:
                linked += len(text)

    def pop() -> None:
        opened[stack.pop()[0]] -= 1

    def past(mark: str, start: int) -> int:
        end = page.find(mark, start)
        return len(page) if end < 0 else end + len(mark)

    while at < len(page):
        start = page.find("<", at)
        if start < 0:
            add(page[at:])
            break
        add(page[at:start])
        head = page[start + 1 : start + 2]
        if page.startswith("<!--", start):
            at = past("-->", start + 4)
        elif page.startswith("<![CDATA[", start):
            at = past("]]>", start)
            parts.append(page[start + 9 : at].removesuffix("]]>"))
        elif head in ("!", "?"):
            at = past(">", start)
        elif head == "/" and page[start + 2 : start + 3].isalpha() and start < reader.last[">"]:
            at = page.index(">", start) + 1
            tag = _NAME.match(page, start + 2)
            tag = tag[0].lower() if tag else ""
            if tag == "a":
                links = 0
            if tag in INLINE or tag in HIDDEN_TAGS:
                continue
            flush()
            if opened[tag] > 0:
                while stack[-1][0] != tag:
                    pop()
                pop()
                links = 0
        elif _NAME.match(head) and (found := reader.tag(start)):
            tag, named, closed, at = found
            if tag in HIDDEN_TAGS:
                if not closed:
                    flush()
                    at = reader.hidden_end(tag, at)
                continue
            if tag in INLINE:
                if tag == "br":
                    parts.append(" ")
                elif tag == "a":
                    links = 1
                continue
            flush()
            if tag not in VOID and not closed:
                if stack and (stack[-1][0] == "p" or (tag in CLOSES_ITSELF and stack[-1][0] == tag)):
                    pop()  # a block cannot be inside a paragraph
                words, verdict = _words(tag, named)
                if verdict is None and stack:
                    verdict, by = stack[-1][2], stack[-1][3]
                else:
                    by = len(stack) if verdict is not None else -1
                stack.append((tag, words, verdict, by))
                opened[tag] += 1
        else:
            add("<")
            at = start + 1
    flush()
    return out


def teacher(block: Block) -> int | None:
    """1 main text, 0 boilerplate, None where the path does not say."""
    return block.verdict


def _bucket(word: str, dim: int) -> int:
    return zlib.crc32(word.encode("utf-8", "surrogatepass")) % dim


def describe(page: list[Block], drop: np.random.Generator | None = None) -> np.ndarray:
    """(blocks, INPUT) features of a page. ``drop`` leaves path words out at random, for training."""
    x = np.zeros((len(page), INPUT), np.float32)
    for i, b in enumerate(page):
        path = b.path if drop is None else [w for w in b.path if drop.random() > 0.2]
        for w in path:
            x[i, _bucket(w, PATH_DIM)] += 1  # two places, so that words that share one differ in the other
            x[i, _bucket(f"#{w}", PATH_DIM)] += 1
        words = b.text.lower().split()
        found = np.bincount([_bucket(w, WORD_DIM) for w in words], minlength=WORD_DIM)
        x[i, PATH_DIM : PATH_DIM + WORD_DIM] = found / len(words)
        size = len(b.text)
        x[i, PATH_DIM + WORD_DIM :] = (
            np.log1p(size) / 6, min(1.0, b.linked / size), b.text.count(".") / len(words), i / len(page),
            np.log1p(len(b.path)) / 3, b.text[-1] in ".!?",
        )
    return x


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


class Lstm:
    """One direction over (time, batch, INPUT); masked steps hand their state on unchanged."""

    def __init__(self, weights: np.ndarray, bias: np.ndarray):
        self.weights, self.bias = weights, bias

    def forward(self, x: np.ndarray, mask: np.ndarray) -> tuple[np.ndarray, list]:
        steps, n, _ = x.shape
        h = c = np.zeros((n, HIDDEN), np.float32)
        out, tape = np.zeros((steps, n, HIDDEN), np.float32), []
        inside = x @ self.weights[:INPUT] + self.bias
        for t in range(steps):
            z = inside[t] + h @ self.weights[INPUT:]
            i, f, o = (_sigmoid(z[:, k * HIDDEN : (k + 1) * HIDDEN]) for k in range(3))
            g = np.tanh(z[:, 3 * HIDDEN :])
            m = mask[t][:, None]
            new = f * c + i * g
            tape.append((h, c, i, f, o, g, new, m))
            c = m * new + (1 - m) * c
            h = m * (o * np.tanh(new)) + (1 - m) * h
            out[t] = h
        return out, tape

    def backward(self, x: np.ndarray, tape: list, grad: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        dw, db = np.zeros_like(self.weights), np.zeros_like(self.bias)
        dh = dc = np.zeros_like(tape[0][0])
        for t in range(len(tape) - 1, -1, -1):
            h, c, i, f, o, g, new, m = tape[t]
            dh = dh + grad[t]
            tanh = np.tanh(new)
            inner = m * dh
            dnew = m * dc + inner * o * (1 - tanh**2)
            dz = np.concatenate(
                [dnew * g * i * (1 - i), dnew * c * f * (1 - f), inner * tanh * o * (1 - o), dnew * i * (1 - g**2)], axis=1
            )
            dw += np.concatenate([x[t], h], axis=1).T @ dz
            db += dz.sum(axis=0)
            dh = (1 - m) * dh + dz @ self.weights[INPUT:].T
            dc = (1 - m) * dc + dnew * f
        return dw, db


class Labeller:
    """A forward and a backward LSTM and a logistic output over both and over the block itself."""

    def __init__(self, params: list[np.ndarray]):
        self.params = params

    @classmethod
    def fresh(cls) -> Labeller:
        rng = np.random.default_rng(SEED)
        params: list[np.ndarray] = []
        for _ in range(2):
            scale = 1 / np.sqrt(INPUT + HIDDEN)
            bias = np.zeros(4 * HIDDEN, np.float32)
            bias[HIDDEN : 2 * HIDDEN] = 1  # remember at first
            params += [rng.normal(0, scale, (INPUT + HIDDEN, 4 * HIDDEN)).astype(np.float32), bias]
        output = [rng.normal(0, 0.2, 2 * HIDDEN).astype(np.float32), np.zeros(1, np.float32), np.zeros(INPUT, np.float32)]
        return cls(params + output)

    def _run(self, x: np.ndarray, mask: np.ndarray) -> tuple:
        ahead, back = Lstm(*self.params[0:2]), Lstm(*self.params[2:4])
        out1, tape1 = ahead.forward(x, mask)
        out2, tape2 = back.forward(x[::-1], mask[::-1])
        both = np.concatenate([out1, out2[::-1]], axis=2)
        return ahead, back, tape1, tape2, both, _sigmoid(both @ self.params[4] + self.params[5] + x @ self.params[6])

    def label(self, pages: list[np.ndarray]) -> list[np.ndarray]:
        """Per page the probability of each block; pages of like length go together."""
        out: list[np.ndarray] = [np.zeros(0)] * len(pages)
        order = sorted((i for i in range(len(pages)) if len(pages[i])), key=lambda i: len(pages[i]))
        start = 0
        while start < len(order):
            stop = start + 1
            while stop < len(order) and len(pages[order[stop]]) * (stop + 1 - start) <= BLOCKS_AT_ONCE:
                stop += 1
            part = order[start:stop]
            x, mask = _padded([pages[i] for i in part])
            p = self._run(x, mask)[-1]
            for k, i in enumerate(part):
                out[i] = p[: len(pages[i]), k]
            start = stop
        return out

    def train(self, pages: list[np.ndarray], labels: list[np.ndarray]) -> None:
        """Adam on the log loss of labelled blocks; a label of -1 is none."""
        rng = np.random.default_rng(SEED)
        m, v, t = [np.zeros_like(p) for p in self.params], [np.zeros_like(p) for p in self.params], 0
        order = np.array(sorted(range(len(pages)), key=lambda i: len(pages[i])))
        batches = [order[i : i + BATCH] for i in range(0, len(order), BATCH)]
        for _ in range(EPOCHS):
            for k in rng.permutation(len(batches)):
                x, mask = _padded([pages[i] for i in batches[k]])
                y = np.full(mask.shape, -1.0, np.float32)
                for j, i in enumerate(batches[k]):
                    y[: len(labels[i]), j] = labels[i]
                ahead, back, tape1, tape2, both, p = self._run(x, mask)
                known = (y >= 0).astype(np.float32)
                err = (p - y) * known / max(1.0, known.sum())
                grad = err[:, :, None] * self.params[4]
                g = [*ahead.backward(x, tape1, grad[:, :, :HIDDEN]), *back.backward(x[::-1], tape2, grad[::-1, :, HIDDEN:])]
                g += [np.einsum("tn,tnh->h", err, both), np.array([err.sum()], np.float32), np.einsum("tn,tnh->h", err, x)]
                t += 1
                for i, one in enumerate(g):
                    m[i] = 0.9 * m[i] + 0.1 * one
                    v[i] = 0.999 * v[i] + 0.001 * one * one
                    step = 0.01 * (m[i] / (1 - 0.9**t)) / (np.sqrt(v[i] / (1 - 0.999**t)) + 1e-8)
                    self.params[i] = (self.params[i] - step).astype(np.float32)


def _padded(pages: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    steps = max(map(len, pages))
    x, mask = np.zeros((steps, len(pages), INPUT), np.float32), np.zeros((steps, len(pages)), np.float32)
    for k, page in enumerate(pages):
        x[: len(page), k], mask[: len(page), k] = page, 1
    return x, mask


def compose(texts: list[str], count: int = COMPOSED_PAGES) -> list[tuple[str, str]]:
    """Pages of many layouts from given block texts: what the teacher's words stand for, in any order.

    Each comes as it is to be read and as the teacher sees it; where these differ, elements of the
    first are nameless, and their blocks are the same.
    """
    if not texts:
        return []
    rng = np.random.default_rng(SEED)
    one = lambda items: items[int(rng.integers(len(items)))]
    few = lambda a, b, make: "".join(make() for _ in range(int(rng.integers(a, b))))
    say = lambda n: html.escape(" ".join(one(texts).split()[: int(rng.integers(1, n))]))
    lists = lambda tag: f"<{tag}><ul>{few(2, 8, lambda: f'<li><a href=x>{say(4)}</a></li>')}</ul></{tag.split()[0]}>"
    boxes = sorted(NOT_MAIN - {"nav", "header", "footer", "aside", "form", "button", "menu", "side", "body"})
    around = [
        lambda: lists(one(["nav", "header", 'div class="menu"', 'div class="breadcrumbs"'])),
        lambda: f'<div class="{one(boxes)}"><p>{say(30)}</p></div>',
        lambda: f'<div id="{one(boxes)}">{say(20)}</div>',
        lambda: f"<aside><h3>{say(5)}</h3>{few(1, 4, lambda: f'<p>{say(25)}</p>')}</aside>",
        lambda: "<{0}>{1}</{0}>".format(one(["header", "footer", "aside", "nav", "form"]), few(1, 4, lambda: f"<p>{say(25)}</p>")),
        lambda: f"<form><label>{say(4)}</label><button>{say(3)}</button></form>",
        lambda: f'<div class="comments">{few(1, 5, lambda: f"<p>{say(40)}</p>")}</div>',
    ]
    mains = ("article", "main", 'div class="content"', 'div id="content"', 'div class="post"', 'section class="entry"', 'div class="story"')
    outer = ("", "", 'div class="wrapper"', 'div class="page sidebar-right has-comments"', "div", 'div id="site"')
    pages = []
    for k in range(count):
        paragraph = lambda: f"<{one(['p', 'p', 'p', 'blockquote', 'h2', 'h3', 'li', 'td', 'pre', 'dd'])}>{say(120)}"
        main, shell = one(mains), one(outer)
        inset = f"<aside class=related><p>{say(15)}</p></aside>" if rng.random() < 0.3 else ""
        body = f"<h1>{say(12)}</h1>{few(1, one([9, 9, 60]), paragraph)}{inset}{few(0, 5, paragraph)}"
        before, after = few(0, 4, lambda: one(around)()), few(0, 4, lambda: one(around)())
        end = f"<footer><p>&copy; {say(12)}</p></footer>"
        inner = lambda tag: f"{before}<{tag}>{body}</{tag.split()[0]}>{after}{end}"
        whole = lambda tag: f"<body><{shell}>{inner(tag)}</{shell.split()[0]}></body>" if shell else f"<body>{inner(tag)}</body>"
        shown = f'div class="{one("abcdefgxyz")}{int(rng.integers(100))}"' if k % 3 == 0 else main
        pages.append((whole(shown), whole(main)))
    return pages


def _windows(page: list, labels: np.ndarray) -> Iterator[tuple[list, np.ndarray]]:
    """A long page in windows of WINDOW blocks, the last one of full size as well."""
    for start in range(0, max(1, len(page)), WINDOW):
        start = max(0, min(start, len(page) - WINDOW))
        yield page[start : start + WINDOW], labels[start : start + WINDOW]


def fit(sample: list[str]) -> Labeller | None:
    """A labeller trained on these pages and on composed ones; None if they hold no block."""
    rng = np.random.default_rng(SEED)
    labelled = [(page, [teacher(b) for b in page]) for page in map(blocks, sample) if page]
    for shown, seen in compose([b.text for page, _ in labelled for b in page]):
        labelled.append((blocks(shown), [teacher(b) for b in blocks(seen)]))
    windows = [
        w for page, known in labelled for w in _windows(page, np.array([-1 if k is None else k for k in known], np.float32))
    ]
    if not windows:
        return None
    chosen = rng.permutation(len(windows))[:WINDOWS]
    labeller = Labeller.fresh()
    labeller.train([describe(windows[i][0], rng) for i in chosen], [windows[i][1] for i in chosen])
    return labeller


def _fitted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    labeller = fit(sorted(page for batch in batches for page in batch["html"]))
    if labeller is not None:
        yield pd.DataFrame({"at": range(len(labeller.params)), "param": [p.tobytes() for p in labeller.params]})


def train(pages: DataFrame) -> Labeller | None:
    """A labeller fitted on at most SAMPLE_PAGES pages, those with the smallest hash, and on composed ones.

    The sample meets in one task, which trains; the driver gets the weights. Without a page that
    holds a block there is nothing to learn, and no labeller.
    """
    usable = pages.filter(F.col("html").isNotNull())
    chosen = smallest(usable, SAMPLE_PAGES, usable.count(), *pages.columns).select("html")
    rows = chosen.repartition(1).mapInPandas(_fitted, "at int, param binary").orderBy("at").collect()
    if not rows:
        return None
    like = Labeller.fresh().params
    return Labeller([np.frombuffer(r["param"], np.float32).reshape(p.shape) for r, p in zip(rows, like)])


def extract(pages: DataFrame, labeller: Labeller | None) -> DataFrame:
    """``pages`` with text and n_chars (code points) in place of html.

    ``pages`` needs html; all other columns and every row stay. A null or empty page has the empty
    text, and so has a page without a block of main text. Nothing is capped: whole pages are read
    and every block labelled as main text is kept. Without a labeller, every block is main text that
    no element around it calls boilerplate.
    """
    shared = pages.sparkSession.sparkContext.broadcast(labeller and labeller.params)

    def texts(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        own = Labeller(shared.value) if shared.value else None
        for batch in batches:
            out = []
            for start in range(0, len(batch), 256):
                parsed = [blocks(page) for page in batch.iloc[start : start + 256]]
                if own is None:
                    marked = [np.array([b.verdict != 0 for b in page], float) for page in parsed]
                else:
                    marked = own.label([describe(page) if page else np.zeros((0, INPUT), np.float32) for page in parsed])
                for page, p in zip(parsed, marked):
                    text = "\n".join(b.text for b, q in zip(page, p) if q >= 0.5)
                    out.append((text, len(text)))
            yield pd.DataFrame(out, columns=["text", "n_chars"])

    found = F.pandas_udf(texts, "text string, n_chars long")
    rest = [F.col(c) for c in pages.columns if c not in ("html", "text", "n_chars")]
    return pages.withColumn("__found", found(F.col("html"))).select(*rest, "__found.text", "__found.n_chars")
