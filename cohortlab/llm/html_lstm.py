"""Main text of web pages by a recurrent block labeller.

A page is a sequence of leaf blocks. Each block gets a vector of its hashed
tag path (tags, and words of classes and ids, of the enclosing elements), its
hashed words and a few statistics; a bidirectional LSTM in numpy reads the
sequence both ways, so that every block is labelled in the context of the whole
page. Blocks labelled main are joined in page order.

The network is trained on the driver, on pages laid out by ``layouts``: known
kinds of parts (menus, headers, adverts, comments, ...) in varied order, markup
and naming around an article, filled with words of a bounded sample of the
pages at hand. Seeds are fixed, so reruns agree.

Defined results: a null or empty page, or one without a main block, has the
empty text; repeated rows get equal texts; other columns play no part.
"""

from __future__ import annotations

from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import checkpoint_table, hash_sample, map_arrow
from .html_blocks import blocks

PATH, WORDS, STATS = 256, 48, 10
WIDTH = PATH + WORDS + STATS
HIDDEN = 24
SAMPLE_PAGES = 100
VOCABULARY = 5000
TRAINING_PAGES = 1500
TOGETHER = 64
STEPS = 4096


def vector(path, text: str, linked: int, place: float, out: np.ndarray) -> None:
    """Writes a block's features into ``out``."""
    for depth, element in enumerate(reversed(path)):
        for name in element:
            out[crc32(name.encode()) % PATH] = 1
            if depth == 0 and name.startswith("<"):
                out[crc32(f"leaf{name}".encode()) % PATH] = 1
    words = text.split()
    n, chars = len(words), len(text)
    hashed = np.bincount([crc32(w.lower().encode()) % WORDS for w in words], minlength=WORDS)
    out[PATH:PATH + WORDS] = hashed / np.sqrt((hashed ** 2).sum())
    out[PATH + WORDS:] = (
        np.log1p(n) / 4, np.log1p(chars) / 6, min(1.0, linked / chars), text[-1] in ".!?\"'", text.count(",") / n,
        sum(map(str.isupper, text)) / chars, sum(map(str.isdigit, text)) / chars, place, text[0] in "©•|»<>", n < 4)


def page_vectors(page: str) -> tuple[list[str], np.ndarray]:
    """The blocks' texts and features."""
    rows = list(blocks(page))
    x = np.zeros((len(rows), WIDTH), dtype=np.float32)
    for i, (path, text, linked) in enumerate(rows):
        vector(path, text, linked, i / len(rows), x[i])
    return [r[1] for r in rows], x


# ------------------------------------------------------------------ the network

def sigmoid(z):
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


class Labeller:
    """Two LSTMs (forward, backward) and an output unit over both states."""

    def __init__(self, seed: int = 3):
        rng = np.random.default_rng(seed)
        self.p = {}
        for d in "fb":
            self.p[f"wx{d}"] = rng.normal(0, 1 / np.sqrt(WIDTH), (WIDTH, 4 * HIDDEN)).astype(np.float32)
            self.p[f"wh{d}"] = rng.normal(0, 1 / np.sqrt(HIDDEN), (HIDDEN, 4 * HIDDEN)).astype(np.float32)
            bias = np.zeros(4 * HIDDEN, dtype=np.float32)
            bias[HIDDEN:2 * HIDDEN] = 1  # remember at first
            self.p[f"b{d}"] = bias
        self.p["wo"] = rng.normal(0, 0.2, 2 * HIDDEN).astype(np.float32)
        self.p["bo"] = np.zeros(1, dtype=np.float32)

    def run(self, x: np.ndarray, mask: np.ndarray, d: str, trace: list | None = None) -> np.ndarray:
        """States of one direction for x [steps, pages, WIDTH]; where the mask
        is 0 the state stays as it is."""
        steps, pages, _ = x.shape
        h = np.zeros((pages, HIDDEN), dtype=np.float32)
        c = np.zeros_like(h)
        out = np.zeros((steps, pages, HIDDEN), dtype=np.float32)
        order = range(steps) if d == "f" else range(steps - 1, -1, -1)
        wh, b = self.p[f"wh{d}"], self.p[f"b{d}"]
        inputs, held = None, -1
        for t in order:
            if t // STEPS != held:  # the inputs' part, for a bounded number of steps at once
                held = t // STEPS
                inputs = x[held * STEPS:(held + 1) * STEPS] @ self.p[f"wx{d}"]
            z = inputs[t - held * STEPS] + h @ wh + b
            i, f, o = (sigmoid(z[:, k * HIDDEN:(k + 1) * HIDDEN]) for k in (0, 1, 2))
            g = np.tanh(z[:, 3 * HIDDEN:])
            m = mask[t][:, None]
            new = f * c + i * g
            tanh = np.tanh(new)
            if trace is not None:
                trace.append((t, i, f, o, g, c, tanh, h))
            c = m * new + (1 - m) * c
            h = m * (o * tanh) + (1 - m) * h
            out[t] = h
        return out

    def scores(self, pages: list[np.ndarray]) -> list[np.ndarray]:
        """Probability of being main text, for each block of each page."""
        result: list[np.ndarray] = [np.zeros(0)] * len(pages)
        order = sorted((i for i in range(len(pages)) if len(pages[i])), key=lambda i: len(pages[i]))
        lo = 0
        while lo < len(order):  # pages of similar length together, long ones alone
            longest = len(pages[order[min(lo + TOGETHER, len(order)) - 1]])
            part = order[lo:lo + (TOGETHER if longest <= 512 else 1)]
            x, mask = padded([pages[i] for i in part])
            states = np.concatenate([self.run(x, mask, d) for d in "fb"], axis=2)
            p = sigmoid(states @ self.p["wo"] + self.p["bo"])
            for k, i in enumerate(part):
                result[i] = p[:len(pages[i]), k]
            lo += len(part)
        return result

    def gradients(self, x, mask, y) -> dict[str, np.ndarray]:
        """Of the mean log loss over the blocks, by backpropagation through time."""
        traces: dict[str, list] = {"f": [], "b": []}
        states = {d: self.run(x, mask, d, traces[d]) for d in "fb"}
        both = np.concatenate([states["f"], states["b"]], axis=2)
        dz = (sigmoid(both @ self.p["wo"] + self.p["bo"]) - y) * mask / mask.sum()
        grads = {"wo": np.tensordot(dz, both, axes=([0, 1], [0, 1])), "bo": np.array([dz.sum()])}
        dboth = dz[:, :, None] * self.p["wo"]
        for d, part in (("f", slice(0, HIDDEN)), ("b", slice(HIDDEN, 2 * HIDDEN))):
            dstate = dboth[:, :, part]
            dh = np.zeros_like(dstate[0])
            dc = np.zeros_like(dh)
            dwx = np.zeros_like(self.p[f"wx{d}"])
            dwh = np.zeros_like(self.p[f"wh{d}"])
            db = np.zeros_like(self.p[f"b{d}"])
            for t, i, f, o, g, c, tanh, h in reversed(traces[d]):
                dh = dh + dstate[t]
                m = mask[t][:, None]
                dnew = dc * m + dh * m * o * (1 - tanh ** 2)
                gates = np.concatenate([dnew * g * i * (1 - i), dnew * c * f * (1 - f),
                                        dh * m * tanh * o * (1 - o), dnew * i * (1 - g ** 2)], axis=1)
                dwx += x[t].T @ gates
                dwh += h.T @ gates
                db += gates.sum(axis=0)
                dh = gates @ self.p[f"wh{d}"].T + dh * (1 - m)
                dc = dnew * f + dc * (1 - m)
            grads |= {f"wx{d}": dwx, f"wh{d}": dwh, f"b{d}": db}
        return grads


def padded(pages: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    steps = max(len(p) for p in pages)
    x = np.zeros((steps, len(pages), WIDTH), dtype=np.float32)
    mask = np.zeros((steps, len(pages)), dtype=np.float32)
    for k, p in enumerate(pages):
        x[:len(p), k] = p
        mask[:len(p), k] = 1
    return x, mask


def fit(pages: list[np.ndarray], marks: list[np.ndarray], epochs: int = 14, batch: int = 32,
        rate: float = 0.01, seed: int = 3) -> Labeller:
    """Adam with clipped gradients; the same pages give the same network."""
    net = Labeller(seed)
    rng = np.random.default_rng(seed)
    moments = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in net.p.items()}
    order = sorted(range(len(pages)), key=lambda i: len(pages[i]))
    groups = [order[k:k + batch] for k in range(0, len(order), batch)]
    step = 0
    for epoch in range(epochs):
        rate_now = rate * (1 - epoch / epochs)
        for k in rng.permutation(len(groups)):
            x, mask = padded([pages[i] for i in groups[k]])
            y = np.zeros(mask.shape, dtype=np.float32)
            for j, i in enumerate(groups[k]):
                y[:len(marks[i]), j] = marks[i]
            grads = net.gradients(x, mask, y)
            norm = np.sqrt(sum((g ** 2).sum() for g in grads.values()))
            step += 1
            for name, g in grads.items():
                g = g * min(1, 5 / (norm + 1e-9))
                a, b = moments[name]
                a += 0.1 * (g - a)
                b += 0.001 * (g * g - b)
                net.p[name] -= (rate_now * (a / (1 - 0.9 ** step)) / (np.sqrt(b / (1 - 0.999 ** step)) + 1e-8)).astype(np.float32)
    return net


# ------------------------------------------------------------------ training pages

ARTICLE = ("<article>", "<article>", '<article class="post">', "<main>", "<main>", '<div class="content">', '<div id="content">', '<div class="post">', '<div class="entry">',
           '<div class="article body">', '<section class="story">', '<div class="text">', '<div class="page main">',
           '<td class="body">', "<div>")
#: kinds of parts that are not main text: opening tags, and the shape of what they hold
PARTS = (
    (("<nav>", '<div class="nav">', '<div id="menu">', '<ul class="menu">', '<div class="navbar top">', '<div class="breadcrumb">',
      '<div class="pagination">', '<div class="tags">', '<div class="share social">', '<div class="toolbar">'), "links"),
    (("<header>", '<div id="header">', '<div class="masthead">', '<div class="top bar">', '<div class="logo">'), "short"),
    (("<footer>", '<div id="footer">', '<div class="copyright">', '<div class="legal">', '<div class="bottom">'), "foot"),
    (("<aside>", '<div class="sidebar">', '<div id="side">', '<div class="widget">', '<div class="related">',
      '<div class="recommended">', '<section class="more">'), "mixed"),
    (('<div class="ad">', '<div class="ads">', '<div class="advert">', '<div class="advertisement">', '<div class="banner">',
      '<div class="promo">', '<div class="sponsored">', '<ins class="adsbygoogle">', '<div id="ad">'), "prose"),
    (('<div class="cookie notice">', '<div class="notice">', '<div class="alert">', '<div class="consent banner">',
      '<div class="gdpr">', '<div class="popup modal">', '<div class="newsletter">', '<div class="subscribe">',
      '<div class="warning message">'), "prose"),
    (("<form>", '<form class="search">', '<div class="login">', '<form id="signup">'), "form"),
    (('<div class="comments">', '<section id="comments">', '<ol class="comment list">', '<div class="comment">',
      '<div id="disqus">', '<div class="replies">', '<div class="reviews">', '<section class="discussion">'), "comments"),
)


def _close(tag: str) -> str:
    return f"</{tag[1:].split()[0].rstrip('>')}>"


def pick_noise(rng: np.random.Generator):
    """How a page spells its words: mostly plainly, else loud, in capitals or with symbols."""
    kind = rng.random()
    if kind < 0.8:
        return lambda w: w
    if kind < 0.87:
        return lambda w: w.upper() + "!!"
    if kind < 0.93:
        return lambda w: w + " |"
    marks = ("###", "***", "%%%", "$$$")
    return lambda w: w + marks[len(w) % 4]


def layout(rng: np.random.Generator, vocabulary: list[str]) -> str:
    """One page; main blocks begin with the mark U+0001, which ``marked`` removes."""
    noise = pick_noise(rng)

    def words(lo: int, hi: int) -> str:
        return " ".join(noise(vocabulary[i]) for i in rng.integers(0, len(vocabulary), rng.integers(lo, hi + 1)))

    def pick(options):
        return options[rng.integers(len(options))]

    def prose(mark: str = "", lo: int = 4, hi: int = 90) -> str:
        if rng.random() < 0.15:
            return mark + words(1, 3).capitalize() + "."
        text = mark + ". ".join(words(3, 14).capitalize() for _ in range(max(1, int(rng.integers(lo, hi + 1)) // 9))) + "."
        if rng.random() < 0.35:
            k = text.find(" ") + 1 if rng.random() < 0.5 else 0
            tag = pick(("b", "i", "em", "a href='/x'", "span"))
            text = text[:k] + f"<{tag}>" + text[k:] + (f"</{tag.split()[0]}>" if rng.random() < 0.6 else "")
        return text

    def holds(shape: str) -> str:
        if shape == "links":
            item = pick(("<li><a href='/p'>{}</a></li>", "<a href='/p'>{}</a><br>", "<span><a href='/p'>{}</a></span>"))
            rows = "".join(item.format(words(1, 3)) for _ in range(rng.integers(2, 9)))
            return f"<ul>{rows}</ul>" if item.startswith("<li>") else rows
        if shape == "short":
            return pick(("<div>{}</div>", "<p>{}</p>", "<a href='/'>{}</a>", "<h1>{}</h1>", "{}")).format(words(1, 6))
        if shape == "foot":
            return pick(("&copy; {}", "<p>&copy; {}</p>", "{}", "<p>{}</p>")).format(words(2, 25) + pick(("", ".")))
        if shape == "form":
            return "<label>{}</label><input><p>{}</p>".format(words(1, 4), words(2, 10))
        if shape == "comments":
            item = pick(('<div class="comment"><b>{}</b><p>{}</p></div>', "<li><p>{1}</p></li>", "<p>{1}</p>",
                         '<div class="author">{}</div><div class="reply">{}</div>'))
            return pick(("", "<h3>{}</h3>".format(words(1, 3)))) + "".join(
                item.format(words(1, 2), prose(hi=40)) for _ in range(rng.integers(1, 6)))
        if shape == "mixed":
            return "<h3>{}</h3>".format(words(1, 4)) + (holds("links") if rng.random() < 0.5 else f"<p>{prose(hi=30)}</p>")
        return pick(("<p>{}</p>", "{}", "<div>{}</div>", "<span>{}</span>")).format(prose(hi=40))

    def part() -> str:
        tags, shape = pick(PARTS)
        tag = pick(tags)
        return tag + holds(shape) + _close(tag)

    main = ["<h1>\1{}</h1>".format(words(2, 12))] if rng.random() < 0.8 else []
    if rng.random() < 0.2:
        main.append('<div class="{}">\1{}</div>'.format(pick(("byline", "date", "author")), words(2, 5)))
    for _ in range(rng.integers(1, 14)):
        kind = rng.random()
        if kind < 0.72:
            main.append(pick(("<p>{}</p>", "<p>{}", "<p>{}</p>", "<p>{}<br>")).format(prose("\1", 1, 130)))
        elif kind < 0.8:
            main.append("<{0}>\1{1}</{0}>".format(pick(("h2", "h3")), words(1, 8)))
        elif kind < 0.87:
            main.append("<ul>" + "".join(f"<li>\1{words(2, 15)}</li>" for _ in range(rng.integers(2, 5))) + "</ul>")
        elif kind < 0.91:
            main.append(f"<blockquote>{prose(chr(1))}</blockquote>")
        elif kind < 0.94:
            main.append(f"<table><tr><td>\1{words(1, 5)}</td><td>\1{words(1, 5)}</td></tr></table>")
        elif kind < 0.96:
            main.append(f"<pre>\1{words(3, 20)}</pre>")
        else:
            main.append(part())  # within the article, but not of it
    tag = pick(ARTICLE)
    body = [part() for _ in range(rng.integers(0, 5))]
    body.append(tag + "".join(main) + _close(tag))
    body += [part() for _ in range(rng.integers(0, 5))]
    if tag == "<div>" or rng.random() < 0.2:
        body = ['<div class="{}">'.format(pick(("wrapper", "container", "site", "page"))), *body, "</div>"]
    return "<html><head><title>{}</title></head><body>{}</body></html>".format(words(1, 8), "".join(body))


def layouts(vocabulary: list[str], pages: int = TRAINING_PAGES, seed: int = 11) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Features and marks of generated pages."""
    rng = np.random.default_rng(seed)
    xs, ys = [], []
    for _ in range(pages):
        rows = list(blocks(layout(rng, vocabulary)))
        x = np.zeros((len(rows), WIDTH), dtype=np.float32)
        for i, (path, text, linked) in enumerate(rows):
            vector(path, text.replace("\1", "") or ".", linked, i / len(rows), x[i])
        xs.append(x)
        ys.append(np.array(["\1" in r[1] for r in rows], dtype=np.float32))
    return xs, ys


def _page_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for page in b.column("t"):
            words = {w for _, text, _ in blocks(page.as_py()) for w in text.split() if len(w) < 30}
            plain = {w.replace("&", "and").replace("<", "").replace("\1", "") for w in words}
            yield pa.RecordBatch.from_arrays([pa.array(sorted(plain - {""}), pa.string())], ["word"])


def train(pages: DataFrame, html: str = "html", sample_pages: int = SAMPLE_PAGES, vocabulary: int = VOCABULARY) -> Labeller:
    """A network for these pages: generated layouts, filled with at most
    ``vocabulary`` words of ``sample_pages`` pages."""
    known = pages.where(F.col(html).isNotNull()).select(F.col(html).alias("t"))
    sample = checkpoint_table(hash_sample(known, ["t"], sample_pages), "sample_pages")
    words = checkpoint_table(map_arrow(sample, _page_words, "word string").distinct(), "page_words")
    chosen = sorted(r["word"] for r in hash_sample(words, ["word"], vocabulary).collect())
    return fit(*layouts(chosen or ["word", "text", "line", "page"]))


# ------------------------------------------------------------------ extraction

def _extractor(net: Labeller, keep: list[str], threshold: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            column, size, lo, held = b.column("__html"), 0, 0, []
            for i in range(b.num_rows):
                page = column[i].as_py() or ""
                held.append(page_vectors(page))
                size += len(page)
                if size >= 1 << 20 or i + 1 == b.num_rows:
                    marks = net.scores([x for _, x in held])
                    out = [" ".join([t for t, m in zip(ts, ms, strict=True) if m >= threshold])
                           for (ts, _), ms in zip(held, marks, strict=True)]
                    yield pa.RecordBatch.from_arrays(
                        [*[b.column(k)[lo:i + 1] for k in keep], pa.array(out, pa.string())], [*keep, "__main"])
                    size, lo, held = 0, i + 1, []
    return run


def extract(pages: DataFrame, net: Labeller, html: str = "html", keep: list[str] | None = None,
            out: str = "text", threshold: float = 0.5) -> DataFrame:
    """The columns ``keep`` (default all but ``html``) and the main text as ``out``."""
    keep = [c for c in pages.columns if c not in (html, out)] if keep is None else keep
    d = pages.select(*keep, F.coalesce(F.col(html), F.lit("")).alias("__html"))
    schema = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in d.schema.fields if f.name != "__html")
    return map_arrow(d, _extractor(net, keep, threshold), f"{schema}__main string").withColumnRenamed("__main", out)
