"""Main text of pages: a recurrent network labels every block of a page.

A page is read as its sequence of blocks. A block's input is the sum of the vectors
of the hashed names on its path (elements, classes, ids), the mean of the vectors of
its hashed words, and its length, share of link text and place. Two LSTM layers in
numpy read the sequence in both directions, so that each label rests on the whole
page; blocks labelled as main text are joined.

The network learns from at most ``SAMPLE`` pages (least seeded hash) that name their
article: blocks inside ``article`` or ``main`` are main text unless a name on the path
says otherwise. Each of them is also rewritten with other containers for its article
and other matter around it, whose labels are known, so that the network does not
depend on one layout.

Results for the odd cases: NULL, empty and textless pages have the empty text; a page
is never cut, however long; rows that repeat an id are extracted each; if no page
names an article, the rewritten layouts of ``SEEDS`` are all there is to learn from;
an empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from planefold.llm.html_blocks import Block, blocks
from planefold.llm.ship import ready
from planefold.llm.words import GRAPH, U64, mix, pieces, split

SAMPLE = 150
SEED = 3
VARIANTS = 3
EPOCHS = 14
BATCH = 32
RATE = 0.01
HIDDEN = 12
PATHS, PATH_SIZE = 2048, 12
WORDS, WORD_SIZE = 4096, 6
PLAIN = 4
INPUT = PATH_SIZE + WORD_SIZE + PLAIN
F32 = np.float32

#: Names of what surrounds an article, and of containers of one. Fixed values.
AROUND = (
    "nav|header|footer|aside|form|div class=menu|div class=navigation|div class=sidebar|div class=footer|div class=header|"
    "div class=ad|div class=ads|div class=advert|div class=sponsored|div class=promo|div class=banner|div class=cookie-notice|"
    "div class=notice|div id=cookie-consent|div class=newsletter|div class=subscribe|div class=comments|section class=comments|"
    "div class=comment|div id=disqus-thread|div class=related|div class=share|div class=social|div class=breadcrumb|"
    "div class=pagination|div class=login|div id=sidebar|div class=widget|div class=copyright|div class=popup|div class=modal"
).split("|")
INSIDE = (
    "article|main|main|div class=content|div class=article|div class=post|div class=entry-content|div id=content|div id=main|"
    "section class=article-body|div class=story|div class=text|div class=post-content|body"
).split("|")
UNWANTED = frozenset(
    "nav header footer aside form button select textarea label .menu .navigation .nav .sidebar .footer .header .ad .ads .advert "
    ".sponsored .promo .banner .cookie .notice .consent .newsletter .subscribe .comments .comment .related .share .social "
    ".breadcrumb .pagination .login .widget .copyright .popup .modal".split()
)
SEEDS = ("A first line.", "Some words of a paragraph that is longer than a line of a menu.", "More of it follows here, and ends.")


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-x))


def _weak_labels(found: list[Block]) -> list[int]:
    """1 inside an article or main element and outside of what is named as unwanted."""
    return [int(bool({"article", "main"} & set(b.path)) and not UNWANTED & set(b.path)) for b in found]


def _open(name: str) -> tuple[str, str]:
    tag, _, attribute = name.partition(" ")
    key, _, value = attribute.partition("=")
    return (f'<{tag} {key}="{value}">' if attribute else f"<{tag}>"), f"</{tag}>"


def rewritten(main: list[str], other: list[str], random: np.random.Generator) -> tuple[list[Block], list[int]]:
    """Blocks and labels of a page of known layout made of the texts of a page."""
    other = other or list(SEEDS)

    def beside() -> str:
        begin, end = _open(AROUND[random.integers(len(AROUND))])
        many = [other[i] for i in random.integers(len(other), size=random.integers(1, 5))]
        style = random.integers(4)
        if style == 0:
            return begin + "<ul>" + "".join(f'<li><a href="#">{t} \x01</a></li>' for t in many) + "</ul>" + end
        if style == 1:
            return begin + "".join(f"<p>{t} \x01</p>" for t in many) + end
        if style == 2:
            return begin + "".join(f"<div>{t} \x01</div>" for t in main[:1] + many) + end
        return begin + many[0] + " \x01" + end

    inside = INSIDE[random.integers(len(INSIDE))]
    begin, end = _open(inside) if inside != "body" else ("", "")
    body = []
    for i, text in enumerate(main):
        tag = "h1" if i == 0 and random.random() < 0.7 else ("p", "p", "p", "div", "li", "h2", "blockquote")[random.integers(7)]
        body.append(f"<{tag}>{text}</{tag}>")
        if random.random() < 0.04:
            body.append(beside())
    before = [beside() for _ in range(random.integers(0, 4))]
    after = [beside() for _ in range(random.integers(0, 4))]
    title = f"<head><title>{main[0]} \x01</title></head>"
    found = blocks(f"<html>{title}<body>" + "".join(before) + begin + "".join(body) + end + "".join(after) + "</body></html>")
    labels = [int("\x01" not in b.text) for b in found]
    for block in found:
        block.text = block.text.replace("\x01", "").strip()
    kept = [(b, y) for b, y in zip(found, labels) if b.text]
    return [b for b, _ in kept], [y for _, y in kept]


def _bucket(name: str) -> int:
    value = 0
    for byte in name.encode():
        value = (value * 257 + byte + 1) & 0xFFFFFFFFFFFFFFFF
    return int(mix(np.array([value], dtype=U64))[0] % U64(PATHS))


_buckets: dict[str, int] = {}


class Labeller:
    """Bidirectional LSTM over the blocks of pages."""

    def __init__(self) -> None:
        random = np.random.default_rng(SEED)

        def normal(*shape: int, by: float) -> np.ndarray:
            return (random.standard_normal(shape) * by).astype(F32)

        self.w = {"path": normal(PATHS, PATH_SIZE, by=0.3), "word": normal(WORDS, WORD_SIZE, by=0.1)}
        for side in "fb":
            self.w["w" + side] = normal(INPUT, 4 * HIDDEN, by=INPUT**-0.5)
            self.w["u" + side] = normal(HIDDEN, 4 * HIDDEN, by=HIDDEN**-0.5)
        self.w["out"] = normal(2 * HIDDEN + INPUT, by=0.2)
        self.w["bias"] = np.zeros(1, dtype=F32)
        self.memory: dict[str, list] = {}
        self.updates = 0

    def _inputs(self, pages: list[list[Block]]) -> dict:
        """Vectors of all blocks of some pages, and what they were made of."""
        flat = [b for page in pages for b in page]
        size = np.array([len(page) for page in pages])
        names: list[int] = []
        for block in flat:
            for name in block.path:
                if name not in _buckets:
                    if len(_buckets) > 100_000:
                        _buckets.clear()
                    _buckets[name] = _bucket(name)
                names.append(_buckets[name])
        of_name = np.repeat(np.arange(len(flat)), [len(b.path) for b in flat])
        words = split(pa.array([b.text for b in flat], pa.string()), GRAPH, lower=True)
        word = (words.hashes % U64(WORDS)).astype(np.int64)
        x = np.zeros((len(flat), INPUT), dtype=F32)
        name = np.array(names, dtype=np.int64)
        np.add.at(x[:, :PATH_SIZE], of_name, self.w["path"][name])
        if len(word):
            x[:, PATH_SIZE : PATH_SIZE + WORD_SIZE] = np.add.reduceat(self.w["word"][word], words.first[:-1], axis=0) / words.counts[:, None]
        place = np.concatenate([np.arange(n) / max(n, 1) for n in size]) if len(size) else np.zeros(0)
        chars = np.array([len(b.text) for b in flat])
        x[:, -PLAIN:] = np.stack([np.log1p(chars) / 5, [b.linked for b in flat], place, np.ones(len(flat))], axis=1)
        return {"x": x, "size": size, "name": name, "of_name": of_name, "word": word, "of_word": words.text_of(), "words": words.counts}

    def _layer(self, side: str, x: np.ndarray, on: np.ndarray, keep: bool) -> tuple[np.ndarray, list]:
        """States of one direction over (step, page)."""
        steps, pages = on.shape
        recur = self.w["u" + side]
        h = c = np.zeros((pages, HIDDEN), dtype=F32)
        out, saved = np.zeros((steps, pages, HIDDEN), dtype=F32), []
        for t in range(steps) if side == "f" else range(steps - 1, -1, -1):
            a = x[t] + h @ recur
            gates = _sigmoid(a[:, : 3 * HIDDEN])
            i, f, o = gates[:, :HIDDEN], gates[:, HIDDEN : 2 * HIDDEN], gates[:, 2 * HIDDEN :]
            g = np.tanh(a[:, 3 * HIDDEN :])
            cell = f * c + i * g
            tanh = np.tanh(cell)
            if keep:
                saved.append((t, i, f, o, g, c, tanh, h))
            live = on[t][:, None]
            h, c = np.where(live, o * tanh, h), np.where(live, cell, c)
            out[t] = h
        return out, saved

    def _pass(self, given: dict, keep: bool) -> tuple[np.ndarray, dict]:
        """Logit of every block."""
        size = given["size"]
        page = np.repeat(np.arange(len(size)), size)
        step = np.arange(len(page)) - np.repeat(np.cumsum(size) - size, size)
        on = np.zeros((int(size.max()), len(size)), dtype=bool)
        on[step, page] = True
        states, saved = [], {}
        for side in "fb":
            x = np.zeros((*on.shape, 4 * HIDDEN), dtype=F32)
            x[step, page] = given["x"] @ self.w["w" + side]
            out, saved[side] = self._layer(side, x, on, keep)
            states.append(out[step, page])
        features = np.concatenate([*states, given["x"]], axis=1)
        return features @ self.w["out"] + self.w["bias"][0], {"saved": saved, "features": features, "on": on, "at": (step, page)}

    def _back(self, side: str, saved: list, d_out: np.ndarray, on: np.ndarray, grads: dict) -> np.ndarray:
        recur = self.w["u" + side]
        d_h = d_c = np.zeros((on.shape[1], HIDDEN), dtype=F32)
        d_x = np.zeros((*on.shape, 4 * HIDDEN), dtype=F32)
        grads["u" + side] = np.zeros_like(recur)
        for t, i, f, o, g, c, tanh, h in reversed(saved):
            live = on[t][:, None]
            d = d_h + d_out[t]
            d_cell = np.where(live, d_c + d * o * (1 - tanh * tanh), 0)
            d_a = np.concatenate([d_cell * g * i * (1 - i), d_cell * c * f * (1 - f), np.where(live, d, 0) * tanh * o * (1 - o), d_cell * i * (1 - g * g)], axis=1)
            d_x[t] = d_a
            grads["u" + side] += h.T @ d_a
            d_h = np.where(live, 0, d) + d_a @ recur.T
            d_c = np.where(live, d_cell * f, d_c)
        return d_x

    def step(self, pages: list[list[Block]], labels: list[list[int]]) -> float:
        """One update; mean loss."""
        given = self._inputs(pages)
        logit, kept = self._pass(given, keep=True)
        y = np.array([v for page in labels for v in page], dtype=F32)
        p = _sigmoid(logit)
        d = ((p - y) / len(y)).astype(F32)
        features, (step, page) = kept["features"], kept["at"]
        grads = {"out": features.T @ d, "bias": np.array([d.sum()], dtype=F32)}
        d_features = d[:, None] * self.w["out"]
        d_input = d_features[:, 2 * HIDDEN :].copy()
        for side, part in (("f", slice(0, HIDDEN)), ("b", slice(HIDDEN, 2 * HIDDEN))):
            d_out = np.zeros((*kept["on"].shape, HIDDEN), dtype=F32)
            d_out[step, page] = d_features[:, part]
            d_x = self._back(side, kept["saved"][side], d_out, kept["on"], grads)[step, page]
            grads["w" + side] = given["x"].T @ d_x
            d_input += d_x @ self.w["w" + side].T
        grads["path"], grads["word"] = np.zeros_like(self.w["path"]), np.zeros_like(self.w["word"])
        np.add.at(grads["path"], given["name"], d_input[given["of_name"], :PATH_SIZE])
        share = d_input[:, PATH_SIZE : PATH_SIZE + WORD_SIZE] / np.maximum(given["words"], 1)[:, None]
        np.add.at(grads["word"], given["word"], share[given["of_word"]])
        self._adam(grads)
        return float(-np.mean(y * np.log(p + 1e-7) + (1 - y) * np.log(1 - p + 1e-7)))

    def _adam(self, grads: dict[str, np.ndarray]) -> None:
        self.updates += 1
        for name, grad in grads.items():
            m, v = self.memory.get(name, (0, 0))
            m, v = 0.9 * m + 0.1 * grad, 0.99 * v + 0.01 * grad * grad
            self.memory[name] = [m, v]
            fix = np.sqrt(1 - 0.99**self.updates) / (1 - 0.9**self.updates)
            self.w[name] = (self.w[name] - RATE * fix * m / (np.sqrt(v) + 1e-8)).astype(F32)

    def label(self, pages: list[list[Block]]) -> list[np.ndarray]:
        """Which blocks of each page are main text."""
        labels: list[np.ndarray] = [np.zeros(0, dtype=bool)] * len(pages)
        order = sorted((i for i, page in enumerate(pages) if page), key=lambda i: len(pages[i]))
        for lo in range(0, len(order), 4 * BATCH):
            some = order[lo : lo + 4 * BATCH]
            given = self._inputs([pages[i] for i in some])
            hit = self._pass(given, keep=False)[0] > 0
            for i, own in zip(some, np.split(hit, np.cumsum(given["size"])[:-1])):
                labels[i] = own
        return labels


def fit(pages: list[str], variants: int = VARIANTS) -> Labeller:
    """Labeller learned from pages that name their article, and rewritten forms of them."""
    random = np.random.default_rng(SEED)
    found: list[list[Block]] = []
    labels: list[list[int]] = []
    texts: list[tuple[list[str], list[str]]] = [(list(SEEDS), list(SEEDS[:1]))]
    for page in pages:
        own = blocks(page)
        weak = _weak_labels(own)
        if any(weak):
            found.append(own)
            labels.append(weak)
            safe = [b.text.replace("<", " ").replace("&", "+") for b in own]
            texts.append(([t for t, y in zip(safe, weak) if y], [t for t, y in zip(safe, weak) if not y]))
    for main, other in texts:
        for _ in range(variants if len(texts) > 1 else 60):
            own, known = rewritten(main, other, random)
            found.append(own)
            labels.append(known)
    model = Labeller()
    order = sorted(range(len(found)), key=lambda i: len(found[i]))
    batches = [order[i : i + BATCH] for i in range(0, len(order), BATCH)]
    for _ in range(EPOCHS):
        for i in random.permutation(len(batches)):
            model.step([found[j] for j in batches[i]], [labels[j] for j in batches[i]])
    model.memory = {}
    return model


def train(pages: DataFrame, size: int = SAMPLE) -> Labeller:
    """Labeller learned from at most ``size`` rows of ``html``."""
    ready(pages.sparkSession)
    html = pages.select(F.col("html").cast("string").alias("html")).filter("html IS NOT NULL")
    least = html.select(F.xxhash64(F.lit(SEED), "html").alias("h")).distinct().orderBy("h").limit(size)
    rows = html.withColumn("h", F.xxhash64(F.lit(SEED), "html")).join(F.broadcast(least), "h").distinct()
    return fit([r["html"] for r in sorted(rows.collect(), key=lambda r: (r["h"], r["html"]))])


def _texts(model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches, "html", limit=1 << 20):
            pages = [blocks(p or "") for p in piece.column("html").to_pylist()]
            labels = model.value.label(pages)
            texts = ["\n".join(b.text for b, y in zip(page, own) if y) for page, own in zip(pages, labels)]
            yield pa.RecordBatch.from_pydict({"page_id": piece.column("page_id"), "url": piece.column("url"), "text": pa.array(texts, pa.string())})

    return run


def extract(pages: DataFrame, model: Labeller) -> DataFrame:
    """``page_id, url, text`` for every row of ``page_id, url, html``."""
    ready(pages.sparkSession)
    pages = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    return pages.mapInArrow(_texts(pages.sparkSession.sparkContext.broadcast(model)), "page_id long, url string, text string")
