"""Main text of web pages: a bidirectional LSTM labels the blocks of each page in its whole context."""

from __future__ import annotations

import random
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trawl.llm.common import ALPHANUMERIC, Words, read, text_function
from trawl.llm.html_blocks import Block, leaf_blocks

PATH_DIMS, WORD_DIMS, NUMBERS, HIDDEN = 64, 32, 6, 12
DIMS = PATH_DIMS + WORD_DIMS + NUMBERS
#: Pages to fit to, and blocks of the longest of them.
TRAIN_PAGES, TRAIN_BLOCKS = 200, 200
#: Pages read for each page to fit to, as some turn out to be too long or to have their main part inside another.
DRAWN = 5
#: Pages that name a main part.
NAMES_MAIN = r"""(?i)<(article|main)\b|\brole\s*=\s*["']?(article|main)\b"""
#: Cells (blocks and padding) that are labelled together.
CELLS = 20_000

# HTML's names for the main part of a page, and common names of the other parts.
MAIN = {"article", "main", "role:main", "role:article"}
OTHER = set("""nav header footer aside form menu head dialog role:navigation role:banner role:contentinfo
role:complementary role:search role:dialog""".split())
OTHER_WORDS = set("""ad ads advert advertisement banner breadcrumb breadcrumbs comment comments consent cookie cookies
disqus dialog footer gdpr header login masthead menu modal nav navbar navigation newsletter notice notices pagination
popup promo promoted recommended related reply replies respond search share sharing sidebar social sponsor sponsored
subscribe tags toolbar widget""".split())


def is_other(name: str) -> bool:
    return name in OTHER or (":" in name and name.split(":", 1)[1] in OTHER_WORDS)


def weak_label(path: list[str]) -> int:
    """1 if the names of the elements say that a block is in the main part and not in another part inside it."""
    inside = 0
    for name in path:
        if name in MAIN:
            inside = 1
        elif is_other(name):
            return 0
    return inside


def features(blocks: list[Block]) -> np.ndarray:
    """One row per block: path names and words, hashed, and lengths, links, signs and place."""
    x = np.zeros((len(blocks), DIMS), np.float32)
    texts = [b.text for b in blocks]
    words = Words([t.lower().encode() for t in texts], ALPHANUMERIC)
    slot = (words.hashes % np.uint64(WORD_DIMS)).astype(np.int64)
    counts = np.bincount(words.text * WORD_DIMS + slot, minlength=len(blocks) * WORD_DIMS).reshape(-1, WORD_DIMS)
    x[:, PATH_DIMS:PATH_DIMS + WORD_DIMS] = counts / np.maximum(1, counts.sum(1, keepdims=True))
    for n, block in enumerate(blocks):
        for name in block.path:
            x[n, zlib.crc32(name.encode()) % PATH_DIMS] = 1
        size = len(block.text)
        x[n, -NUMBERS:] = (np.log1p(size) / 5, block.linked / size, block.text.count(",") * 20 / size,
                           (block.text.count(".") + block.text.count("!") + block.text.count("?")) * 20 / size,
                           float(block.text[-1] in ".!?"), n / len(blocks))
    return x


# --- pages to learn from ----------------------------------------------------------------------

def variants(blocks: list[Block], rng: random.Random) -> list[tuple[list[Block], list[int]]]:
    """A page as it is, and again with parts of other kinds put in and the main part's own names taken out.

    The second form has notices, comments, side bars and forms made of the page's own
    sentences under the usual names. As the main part then is an unnamed element in half of
    the cases, the labeller has to use what stands before and after a block.
    """
    labels = [weak_label(b.path) for b in blocks]
    prose = [b.text for b, y in zip(blocks, labels) if y] or [b.text for b in blocks]
    plain = rng.random() < 0.5
    name = rng.choice(["class:content", "class:post", "class:story", "id:content", "class:text"])
    changed, ys = [], []
    root = ["html", "body"]

    def part(path: list[str], sizes: list[int], linked: bool = False) -> None:
        for size in sizes:
            words = rng.choice(prose).split()
            first = rng.randrange(len(words))
            text = " ".join(words[first:first + size])
            changed.append(Block(text, root + path, len(text) if linked else 0))
            ys.append(0)

    def other(inside: list[str]) -> None:
        word = rng.choice(sorted(OTHER_WORDS))
        kind = rng.choice(["div", "section", "aside", "ul", "form", "header", "footer", "nav"])
        sizes = [rng.choice([2, 5, 15, 40]) for _ in range(rng.randint(1, 4))]
        leaf = rng.choice([["p"], ["li"], ["div", "p"], []])
        part(inside + [kind, rng.choice(["class:", "id:"]) + word, *leaf], sizes, rng.random() < 0.3)

    if rng.random() < 0.5:
        other([])
    main_at = [n for n, y in enumerate(labels) if y]
    break_at = rng.choice(main_at) if main_at and rng.random() < 0.4 else -1
    for n, (block, y) in enumerate(zip(blocks, labels)):
        path = block.path
        if y and plain:
            path = [p for q in path for p in (["div", name] if q in MAIN else [q])]
        changed.append(Block(block.text, path, block.linked))
        ys.append(y)
        if n == break_at:
            other(["div", name] if plain else ["article"])
    if rng.random() < 0.7:
        other([])
    return [(blocks, labels), (changed, ys)]


def training_rows(pages: list[str]) -> list:
    """Of each page the features and labels of its variants as bytes; pages without a main part give none."""
    xs, ys, sizes = [], [], []
    for page in pages:
        blocks = leaf_blocks(page)
        x, y, n = [], [], []
        if len(blocks) <= TRAIN_BLOCKS and any(weak_label(b.path) for b in blocks):
            for own, labels in variants(blocks, random.Random(zlib.crc32(page.encode()))):
                x.append(features(own).tobytes())
                y.append(np.array(labels, np.int8).tobytes())
                n.append(len(own))
        xs.append(b"".join(x))
        ys.append(b"".join(y))
        sizes.append(n)
    return [xs, ys, sizes]


# --- the network ------------------------------------------------------------------------------

def sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def backwards(x: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Each row's first ``size`` steps in reverse order; the padding stays behind them."""
    step = np.arange(x.shape[1])
    at = np.where(step < sizes[:, None], sizes[:, None] - 1 - step, step)
    return x[np.arange(len(x))[:, None], at]


class BlockLabeller:
    """Two LSTM layers, one along the page and one against it, and a logistic unit on both states."""

    def __init__(self, seed: int = 7):
        rng = np.random.default_rng(seed)
        self.p = {"out": np.zeros(2 * HIDDEN, np.float32), "bias": np.zeros(1, np.float32)}
        for side in "fb":
            self.p[f"wx{side}"] = rng.normal(0, 0.15, (DIMS, 4 * HIDDEN)).astype(np.float32)
            self.p[f"wh{side}"] = rng.normal(0, 0.2, (HIDDEN, 4 * HIDDEN)).astype(np.float32)
            self.p[f"b{side}"] = np.repeat(np.float32([0, 1, 0, 0]), HIDDEN)
        self.p["out"] = rng.normal(0, 0.2, 2 * HIDDEN).astype(np.float32)

    def _run(self, x: np.ndarray, side: str, keep: bool = False):
        """States of all steps; gates in the order input, forget, output, candidate."""
        n, steps, _ = x.shape
        drive = x @ self.p[f"wx{side}"] + self.p[f"b{side}"]
        h, c = np.zeros((n, HIDDEN), np.float32), np.zeros((n, HIDDEN), np.float32)
        states, kept = np.zeros((n, steps, HIDDEN), np.float32), []
        for t in range(steps):
            gates = drive[:, t] + h @ self.p[f"wh{side}"]
            i, f, o = (sigmoid(gates[:, k * HIDDEN:(k + 1) * HIDDEN]) for k in range(3))
            g = np.tanh(gates[:, 3 * HIDDEN:])
            before, h_before = c, h
            c = f * c + i * g
            h = o * np.tanh(c)
            states[:, t] = h
            if keep:
                kept.append((i, f, o, g, before, c, h_before))
        return states, kept

    def _back(self, x: np.ndarray, d_states: np.ndarray, kept: list, side: str, grads: dict) -> None:
        n, steps, _ = x.shape
        wh = self.p[f"wh{side}"]
        dh_next, dc_next = np.zeros((n, HIDDEN), np.float32), np.zeros((n, HIDDEN), np.float32)
        d_gates = np.zeros((n, steps, 4 * HIDDEN), np.float32)
        d_wh = np.zeros_like(wh)
        for t in range(steps - 1, -1, -1):
            i, f, o, g, before, c, h_before = kept[t]
            tc = np.tanh(c)
            dh = d_states[:, t] + dh_next
            dc = dh * o * (1 - tc * tc) + dc_next
            d = np.concatenate([dc * g * i * (1 - i), dc * before * f * (1 - f), dh * tc * o * (1 - o),
                                dc * i * (1 - g * g)], axis=1)
            d_gates[:, t] = d
            d_wh += h_before.T @ d
            dh_next, dc_next = d @ wh.T, dc * f
        grads[f"wh{side}"] = d_wh
        grads[f"wx{side}"] = np.tensordot(x, d_gates, ([0, 1], [0, 1]))
        grads[f"b{side}"] = d_gates.sum((0, 1))

    def gradients(self, x: np.ndarray, y: np.ndarray, sizes: np.ndarray) -> dict:
        """Of the mean logistic loss over all blocks."""
        rx = backwards(x, sizes)
        forth, kept_f = self._run(x, "f", True)
        back, kept_b = self._run(rx, "b", True)
        both = np.concatenate([forth, backwards(back, sizes)], axis=2)
        valid = np.arange(x.shape[1]) < sizes[:, None]
        d = ((sigmoid(both @ self.p["out"] + self.p["bias"]) - y) * valid / valid.sum()).astype(np.float32)
        grads = {"out": np.tensordot(both, d, ([0, 1], [0, 1])), "bias": d.sum(keepdims=True).ravel()}
        spread = d[:, :, None] * self.p["out"]
        self._back(x, spread[:, :, :HIDDEN], kept_f, "f", grads)
        self._back(rx, backwards(spread[:, :, HIDDEN:], sizes), kept_b, "b", grads)
        return grads

    def probabilities(self, pages: list[np.ndarray]) -> list[np.ndarray]:
        """Of each page's blocks; pages of like length are run together."""
        out: list = [np.zeros(0)] * len(pages)
        order = [n for n in sorted(range(len(pages)), key=lambda n: len(pages[n])) if len(pages[n])]
        while order:
            most = len(pages[order[-1]])
            group = order[-max(1, CELLS // most):]
            order = order[:-len(group)]
            x, sizes = padded([pages[n] for n in group])
            forth, back = self._run(x, "f")[0], backwards(self._run(backwards(x, sizes), "b")[0], sizes)
            p = sigmoid(np.concatenate([forth, back], axis=2) @ self.p["out"] + self.p["bias"])
            for row, n in enumerate(group):
                out[n] = p[row, :sizes[row]]
        return out

    def main_texts(self, pages: list[str]) -> list[str]:
        blocks = [leaf_blocks(p) for p in pages]
        scores = self.probabilities([features(b) if b else np.zeros((0, DIMS), np.float32) for b in blocks])
        return ["\n\n".join(b.text for b, p in zip(own, ps) if p >= 0.5) for own, ps in zip(blocks, scores)]


class NamesOnly(BlockLabeller):
    """What is left where there is nothing to learn from: all blocks outside the parts whose names say that they are others."""

    def main_texts(self, pages: list[str]) -> list[str]:
        return ["\n\n".join(b.text for b in leaf_blocks(p) if not any(map(is_other, b.path))) for p in pages]


def padded(rows: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    sizes = np.array([len(r) for r in rows])
    x = np.zeros((len(rows), sizes.max(), *rows[0].shape[1:]), rows[0].dtype)
    for n, r in enumerate(rows):
        x[n, :len(r)] = r
    return x, sizes


def fit(rows: list[tuple[np.ndarray, np.ndarray]], epochs: int = 8, rate: float = 0.01, batch: int = 16,
        seed: int = 7) -> BlockLabeller:
    """Adam over pages ``(features, labels)``."""
    model, rng = BlockLabeller(seed), np.random.default_rng(seed)
    mean = {k: np.zeros_like(v) for k, v in model.p.items()}
    square = {k: np.zeros_like(v) for k, v in model.p.items()}
    step = 0
    for _ in range(epochs):
        for part in np.array_split(rng.permutation(len(rows)), max(1, len(rows) // batch)):
            x, sizes = padded([rows[n][0] for n in part])
            y, _ = padded([rows[n][1] for n in part])
            step += 1
            for k, g in model.gradients(x, y, sizes).items():
                mean[k] = 0.9 * mean[k] + 0.1 * g
                square[k] = 0.999 * square[k] + 0.001 * g * g
                model.p[k] -= rate * (mean[k] / (1 - 0.9 ** step)) / (np.sqrt(square[k] / (1 - 0.999 ** step)) + 1e-8)
    return model


# --- on DataFrames ----------------------------------------------------------------------------

def train(pages: DataFrame, id_col: str = "page_id", html_col: str = "html",
          most: int = TRAIN_PAGES) -> BlockLabeller:
    """A labeller fitted to at most ``most`` pages, chosen by a hash of the id.

    There are no labels: those of the training blocks come from HTML's own names for parts
    of a page (``weak_label``). Of the network's inputs those names are a part only, and in
    half of the changed pages the main part has lost its own. Pages are drawn among those that name a main part, five
    for each that is needed, and the first that can be used are. Where no page can, the names of other parts decide.
    """
    ids = (pages.where(F.col(html_col).rlike(NAMES_MAIN)).select(F.col(id_col).alias("_id")).dropDuplicates()
           .orderBy(F.xxhash64("_id"), "_id").limit(DRAWN * most))
    rows = text_function(training_rows, "x binary, y binary, n array<int>", ["x", "y", "n"],
                         [pa.binary(), pa.binary(), pa.list_(pa.int32())])
    found = (pages.select(F.col(id_col).alias("_id"), F.col(html_col).alias("_html"))
             .join(F.broadcast(ids), "_id").limit(2 * DRAWN * most).select("_id", rows("_html").alias("f")).select("_id", "f.*"))
    usable = found.where(F.size("n") > 0).orderBy(F.xxhash64("_id"), "_id", F.xxhash64("x")).limit(most)
    learn = []
    for row in sorted(usable.collect(), key=lambda r: (r["_id"], r["x"])):
        x, y = np.frombuffer(row["x"], np.float32).reshape(-1, DIMS), np.frombuffer(row["y"], np.int8)
        at = 0
        for n in row["n"]:
            learn.append((x[at:at + n], y[at:at + n].astype(np.float32)))
            at += n
    return fit(learn) if learn else NamesOnly()


def extract(pages: DataFrame, model: BlockLabeller, html_col: str = "html") -> DataFrame:
    """``pages`` with ``text`` and ``n_chars`` in place of columns of these names.

    ``text`` joins the blocks labelled as main, in page order, by two line feeds. It is empty
    for a null or empty page and one without such blocks. Whole pages are read, however long
    or broken. Repeated rows, null ids and other columns stay as they are; an empty table
    gives an empty result.
    """
    shared = pages.sparkSession.sparkContext.broadcast(model)

    def texts(part: list[str]) -> list:
        found = shared.value.main_texts(part)
        return [found, [len(t) for t in found]]
    done = text_function(texts, "text string, n_chars bigint", ["text", "n_chars"], [pa.string(), pa.int64()])
    return pages.withColumn("__trawl_found", done(html_col)).withColumns(
        {c: F.col(f"__trawl_found.{c}") for c in ("text", "n_chars")}).drop("__trawl_found")


def op2_html_text(spark, sf_dir):
    pages = read(spark, sf_dir, "pages")
    return extract(pages.select("page_id", "url", "html"), train(pages)).drop("html")
