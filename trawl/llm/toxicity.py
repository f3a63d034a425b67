"""Toxicity of a text: a factorization machine over hashed terms."""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trawl.llm.common import ALPHANUMERIC, Words, read, remainder, text_function
from trawl.llm.samples import bounded_sample
from trawl.sources.shared import write_shared

BITS = 18
FACTORS = 8
#: Rates of the factors of which the calibration rows choose one.
FACTOR_RATES = (0.005, 0.05)
#: Numbers of terms that the factors may be for, and spreads of the pairs' sum, in logits, to choose from.
PAIRED_TERMS, PAIR_SIZES = (4, 16, 64, 256, 1024), (0.3, 1.0, 3.0, 10.0)
#: Shrinkage of the weights to choose from. The more idle terms have a weight, the more length decides.
SPARSITIES = (5e-3, 2e-2, 6e-2)
#: A text's terms may be divided by this power of their number. Undivided they tell more in long texts.
LENGTH_POWER = 0.0
#: Labelled rows to fit to, of each label.
PER_LABEL = 3000
STEMS = (4, 5)
#: Training documents that a term of the model must be in.
LEAST_DOCS = 5


def terms(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Number of the text and bucket of every word and of its first 4 and 5 bytes.

    Words are lower-cased runs of letters and digits. Their beginnings stand for all forms
    of a word.
    """
    words = Words([t.lower().encode() for t in texts], ALPHANUMERIC)
    text, hashes = [words.text], [words.hashes]
    for size in STEMS:
        which, found = words.beginnings(size)
        text.append(words.text[which])
        hashes.append(found)
    return np.concatenate(text), (np.concatenate(hashes) >> np.uint64(64 - BITS)).astype(np.int64)


def distinct_terms(texts: list[str]) -> list:
    text, bucket = terms(texts)
    pairs = np.unique(text << BITS | bucket)
    firsts = np.searchsorted(pairs, np.arange(len(texts) + 1) << BITS)
    own = (pairs & ((1 << BITS) - 1)).astype(np.int32)
    return [[own[a:b] for a, b in zip(firsts, firsts[1:])]]


@dataclass
class FactorizationMachine:
    """``bias + sum of weights + sum over pairs of terms of the product of their factors``.

    A text has the terms that occur in it, each once and divided by the ``power`` of their number. ``slot`` gives the row of a bucket,
    or -1. ``scale`` and ``shift`` turn the sum into the logit of a probability.
    """

    slot: np.ndarray
    bias: float
    weights: np.ndarray
    factors: np.ndarray
    scale: float = 1.0
    shift: float = 0.0
    power: float = 0.0

    def raw(self, text: np.ndarray, row: np.ndarray, n_texts: int) -> np.ndarray:
        """The sums, given the distinct pairs (text, row) in order of the texts."""
        out = np.full(n_texts, self.bias)
        if len(text):
            firsts = np.concatenate(([0], np.flatnonzero(np.diff(text)) + 1))
            v = self.factors[row]
            both = np.add.reduceat(v, firsts, axis=0) ** 2 - np.add.reduceat(v * v, firsts, axis=0)
            x = np.diff(np.append(firsts, len(text))) ** -self.power
            out[text[firsts]] += np.add.reduceat(self.weights[row], firsts) * x + both.sum(1) / 2 * x * x
        return out

    def logits(self, texts: list[str]) -> np.ndarray:
        text, bucket = terms(texts)
        row = self.slot[bucket]
        size = len(self.weights) + 1
        pairs = np.unique(text[row >= 0] * size + row[row >= 0])
        return self.raw(pairs // size, pairs % size, len(texts)) * self.scale + self.shift

    def score(self, texts: list[str]) -> np.ndarray:
        return sigmoid(self.logits(texts))


def sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


class Sample:
    """Rows of terms as a sparse matrix, each row scaled to length 1. Columns are taken one by one, to hold little at a time."""

    def __init__(self, rows: list[np.ndarray], n_terms: int):
        sizes = np.array([len(r) for r in rows])
        self.full = np.flatnonzero(sizes)
        self.first = (np.cumsum(sizes) - sizes)[self.full]
        self.term = np.concatenate(rows).astype(np.int32)
        self.row = np.repeat(np.arange(len(rows), dtype=np.int32), sizes)
        self.value = (1 / np.sqrt(np.maximum(sizes, 1))).astype(np.float32)[self.row]
        self.shape = len(rows), n_terms

    def times(self, u: np.ndarray) -> np.ndarray:
        out = np.zeros((self.shape[0], u.shape[1]))
        if len(self.full):
            for k, column in enumerate(u.T):
                out[self.full, k] = np.add.reduceat(column.astype(np.float32)[self.term] * self.value, self.first, dtype=float)
        return out

    def sums(self, a: np.ndarray) -> np.ndarray:
        """For each term the sum over the rows that have it."""
        return np.stack([np.bincount(self.term, self.value * c.astype(np.float32)[self.row], self.shape[1]) for c in a.T],
                        axis=1)


def telling_pairs(sample: Sample, residual: np.ndarray, rounds: int = 25, seed: int = 7) -> np.ndarray:
    """Columns by which terms tell in pairs what the weights leave: leading eigenvectors times the root of their values.

    Of the sum over rows of ``residual * x x'`` with centred columns and without its diagonal only positive
    eigenvalues count, as factors can stand for no others. Orthogonal iteration, shifted so that the largest values lead; the
    matrix itself is never made.
    """
    rows, n_terms = sample.shape
    k = min(FACTORS, n_terms)
    residual = residual[:, None]
    ones = np.ones((rows, 1))
    mean, told = sample.sums(ones) / rows, sample.sums(residual)
    squares = np.bincount(sample.term, sample.value ** 2 * residual.astype(np.float32)[sample.row, 0], n_terms)[:, None]
    diagonal = squares - 2 * mean * told + mean * mean * residual.sum()

    def product(u: np.ndarray) -> np.ndarray:
        a = (sample.times(u) - mean.T @ u) * residual
        return sample.sums(a) - mean * a.sum(0) - diagonal * u
    start = np.linalg.qr(np.random.default_rng(seed).normal(size=(n_terms, k)))[0]
    u = start
    for _ in range(6):
        u = np.linalg.qr(product(u))[0]
    shift = np.abs(np.linalg.eigvalsh(u.T @ product(u))).max()
    u = start
    for _ in range(rounds):
        u = np.linalg.qr(product(u) + shift * u)[0]
    inner = u.T @ product(u)
    values, turn = np.linalg.eigh((inner + inner.T) / 2)
    columns = (u @ turn)[:, ::-1] * np.sqrt(np.maximum(values[::-1], 0))
    return np.pad(columns, ((0, 0), (0, FACTORS - k)))


def fit(rows: list[np.ndarray], labels: np.ndarray, slot: np.ndarray, n_terms: int, odds: float,
        epochs: int = 10, rate: float = 0.1, sparsities: tuple[float, ...] = SPARSITIES, factor_rates: tuple[float, ...] = FACTOR_RATES,
        seed: int = 7, power: float = LENGTH_POWER) -> FactorizationMachine:
    """Weights, then factors for what the weights leave, then both by stochastic gradient descent.

    Every fourth row calibrates, and chooses after each step: the weights' shrinkage and epochs, how many terms the factors that start
    from ``telling_pairs`` are for and how large they are, if any, and the rate and epochs of the descent from there. ``rows``
    are the texts' rows of the model. Weights shrink towards 0. Terms outside the start have no factors, so that a
    long text's many idle terms add nothing. ``odds`` is the odds of label 1 among all labelled rows over that among the sample.
    """
    best = FactorizationMachine(slot, 0.0, np.zeros(n_terms), np.zeros((n_terms, FACTORS)), power=power)
    if not len(rows):
        best.shift = -30.0
        return best
    if len(set(labels.tolist())) < 2:
        best.shift = 30.0 if labels[0] else -30.0
        return best
    learn, held = [n for n in range(len(rows)) if n % 4], [n for n in range(len(rows)) if n % 4 == 0]
    own, own_labels, rest, rest_labels = [rows[n] for n in learn], labels[learn], [rows[n] for n in held], labels[held]
    least = np.inf

    def keep_best(models: Iterator[FactorizationMachine]) -> None:
        nonlocal least, best
        for model in models:
            loss = calibrate(model, sums_of(model, rest), rest_labels, odds)
            if loss < least:
                least, best = loss, replace(model, weights=model.weights.copy(), factors=model.factors.copy())
    zero, shrinkage = best, sparsities[0]
    for sparsity in sparsities:
        before = least
        keep_best(descent(own, own_labels, zero, epochs, rate, sparsity, 0.0, seed))
        shrinkage = sparsity if least < before else shrinkage
    if n_terms and learn and any(len(r) for r in own):
        linear = best
        keep_best(pair_starts(linear, own, own_labels, rest))
        if best is not linear:
            start = best
            for factor_rate in factor_rates:
                keep_best(descent(own, own_labels, start, epochs, rate, shrinkage, factor_rate, seed))
    return best


def sums_of(model: FactorizationMachine, rows: list[np.ndarray]) -> np.ndarray:
    parts = [rows[at:at + 100] for at in range(0, len(rows), 100)]
    return np.concatenate([model.raw(np.repeat(np.arange(len(p)), [len(r) for r in p]), np.concatenate(p), len(p))
                           for p in parts])


def pair_starts(linear: FactorizationMachine, own: list[np.ndarray], labels: np.ndarray,
                rest: list[np.ndarray]) -> Iterator[FactorizationMachine]:
    """The model with factors for the terms that the eigenvectors single out, for more and more of them, in several sizes."""
    told = sigmoid(sums_of(linear, own) * linear.scale + linear.shift)
    columns = telling_pairs(Sample(own, len(linear.weights)), labels - told)
    for kind in (1, FACTORS):
        v = columns * (np.arange(FACTORS) < kind)
        size = (v * v).sum(1)
        for most in PAIRED_TERMS:
            kept = size >= (np.partition(size, -most)[-most] if most < len(size) else 0)
            factors = v * kept[:, None]
            alone = replace(linear, bias=0.0, weights=np.zeros_like(linear.weights), factors=factors)
            spread = sums_of(alone, rest).std()
            if spread > 0:
                for logits in PAIR_SIZES:
                    yield replace(linear, factors=factors * np.sqrt(logits / spread / linear.scale))


def descent(rows: list[np.ndarray], labels: np.ndarray, start: FactorizationMachine, epochs: int, rate: float,
            sparsity: float, factor_rate: float, seed: int) -> Iterator[FactorizationMachine]:
    """The model after each epoch. Each weight and each term's row of factors has a step size of its own.

    The sums are scaled and shifted as in the start, so that its size is that of a logit.
    """
    rng = np.random.default_rng(seed)
    scale, shift = start.scale, start.shift
    model = replace(start, bias=start.bias * scale + shift, weights=start.weights * scale,
                    factors=start.factors * np.sqrt(scale), scale=1.0, shift=0.0)
    w, v, n_terms = model.weights, model.factors, len(model.weights)
    paired = v.any(1)
    seen_w, seen_v, seen_b = np.full(n_terms, 1e-2), np.full((n_terms, 1), 1e-2), 1e-2
    for _ in range(epochs):
        for n in rng.permutation(len(rows)):
            own = rows[n]
            x = max(1, len(own)) ** -model.power
            both = own[paired[own]] if factor_rate else own[:0]
            factors = v[both]
            total = factors.sum(0)
            z = model.bias + w[own].sum() * x + (total @ total - (factors * factors).sum()) / 2 * x * x
            g = float(sigmoid(z)) - labels[n]
            seen_b += g * g
            model.bias -= rate * g / np.sqrt(seen_b)
            if not len(own):
                continue
            seen_w[own] += (g * x) ** 2
            step = rate / np.sqrt(seen_w[own])
            moved = w[own] - step * g * x
            w[own] = np.sign(moved) * np.maximum(np.abs(moved) - step * sparsity * x, 0)
            if len(both):
                slope = g * (total - factors) * x * x
                seen_v[both] += (slope * slope).mean(1, keepdims=True)
                v[both] = factors - factor_rate / np.sqrt(seen_v[both]) * slope
        yield model


def calibrate(model: FactorizationMachine, z: np.ndarray, labels: np.ndarray, odds: float) -> float:
    """Logistic regression of the label on the sums ``z``, with rows weighted as they occur among all labelled rows.

    The targets are a little inside 0 and 1, so that few rows, or rows of one label, give
    no certainty. The loss on these rows is returned.
    """
    n_toxic = labels.sum()
    target = np.where(labels == 1, (n_toxic + 1) / (n_toxic + 2), 1 / (len(labels) - n_toxic + 2))
    weight = np.where(labels == 1, odds, 1.0)
    weight /= weight.sum()
    center, spread = z.mean(), max(z.std(), 1e-6)
    x = (z - center) / spread
    a, b = 1.0, 0.0
    for _ in range(500):
        g = weight * (sigmoid(a * x + b) - target)
        a -= 2 * ((g * x).sum() + 1e-4 * a) / ((weight * x * x).sum() + 1e-3)
        b -= 2 * g.sum()
    a = max(a, 1e-3)
    model.scale, model.shift = a / spread, b - a * center / spread
    found = sigmoid(a * x + b)
    return float(-(weight * (target * np.log(found) + (1 - target) * np.log(1 - found))).sum())


def train(docs: DataFrame, labels: DataFrame, trainable, id_col: str = "doc_id", text_col: str = "text",
          label_col: str = "toxic", per_label: int = PER_LABEL) -> FactorizationMachine:
    """A model of the labelled documents for which the condition ``trainable`` on the labels' id holds.

    It is fitted to at most ``per_label`` rows of either label, chosen by a hash of the id.
    Its terms are all those in ``LEAST_DOCS`` of these rows, whatever their labels, so that a term may tell only
    together with another. Terms with neither weight nor factors leave the model.
    One task holds the terms of the sample's texts, 4 bytes each, and the driver gets the model only. Labels other than 0 and 1 are left out.
    Without any labels all scores are 0; with one label only, all scores are that label.
    """
    usable = labels.where(trainable & F.col(label_col).isin(0, 1)).select(
        F.col(id_col).alias("_id"), F.col(label_col).cast("int").alias("_label"))
    prior = {r["_label"]: r["n"] for r in usable.groupBy("_label").agg(F.count("*").alias("n")).collect()}
    chosen = bounded_sample(usable, "_id", "_label", per_label, 2 * per_label)
    texts = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    found = text_function(distinct_terms, "buckets array<int>", ["buckets"], [pa.list_(pa.int32())])
    sample = write_shared(
        texts.join(F.broadcast(chosen), "_id").limit(4 * per_label)
        .select("_id", "_label", found("_text").alias("f")).select("_id", "_label", "f.buckets"), "toxicity-sample")
    def fitted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = pickle.dumps(fitted_to(pa.Table.from_batches(batches), prior))
        yield pa.RecordBatch.from_arrays([pa.array([made], pa.binary())], names=["model"])

    # Fitted by a task, since the driver would keep for good much of the memory that it takes.
    made = [] if sample.isEmpty() else sample.coalesce(1).mapInArrow(fitted, "model binary").collect()
    return pickle.loads(made[0]["model"]) if made else fit([], np.zeros(0), np.full(1 << BITS, -1, np.int32), 0, 1.0)


def fitted_to(sample: pa.Table, prior: dict[int, int]) -> FactorizationMachine:
    """A model of the rows ``(_id, _label, buckets)``, given the number of labelled rows of each label."""
    rows = sample.sort_by([("_id", "ascending"), ("_label", "ascending")])
    target = rows["_label"].to_numpy().astype(float)
    found = [b.values.to_numpy() for b in rows["buckets"]]
    docs = np.zeros(1 << BITS, np.int32)
    for buckets in found:
        docs[buckets] += 1
    kept = np.flatnonzero(docs >= LEAST_DOCS)
    slot = np.full(1 << BITS, -1, np.int32)
    slot[kept] = np.arange(len(kept))
    own = [slot[b] for b in found]
    own = [r[r >= 0] for r in own]
    n_rows, n_toxic = len(target), int(target.sum())
    odds = (prior.get(1, 0) / max(1, prior.get(0, 0))) / max(1e-9, n_toxic / max(1, n_rows - n_toxic))
    return without_idle_terms(fit(own, target, slot, len(kept), odds))


def without_idle_terms(model: FactorizationMachine) -> FactorizationMachine:
    """The same model without the terms that add nothing."""
    busy = (model.weights != 0) | model.factors.any(1)
    place = np.append(np.where(busy, np.cumsum(busy) - 1, -1), -1)
    return replace(model, slot=place[model.slot], weights=model.weights[busy], factors=model.factors[busy])


def score(docs: DataFrame, model: FactorizationMachine, text_col: str = "text",
          threshold: float = 0.5) -> DataFrame:
    """``docs`` with ``score`` (0 to 1) and ``predicted`` (0 or 1) in place of columns of these names.

    The whole text is used. A null or empty text, or one without any of the model's terms, has
    the score of its bias. Repeated rows, null ids and other columns stay as they are; an
    empty table gives an empty result.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    scored = text_function(lambda texts: [shared.value.score(texts)], "score double", ["score"], [pa.float64()])
    return (docs.withColumn("__trawl_found", scored(text_col)).withColumn("score", F.col("__trawl_found.score"))
            .withColumn("predicted", (F.col("score") >= threshold).cast("int")).drop("__trawl_found"))


def train_on_folds(docs: DataFrame, labels: DataFrame) -> FactorizationMachine:
    """Learnt from four of the five folds of the labels."""
    return train(docs, labels, remainder("doc_id", 5) != 0)


def op8_toxicity(spark, sf_dir):
    docs = read(spark, sf_dir, "documents")
    model = train_on_folds(docs, read(spark, sf_dir, "labels"))
    rows = docs.select("doc_id", "text", F.coalesce(remainder("doc_id", 5) == 0, F.lit(False)).alias("held_out"))
    return score(rows, model).select("doc_id", "held_out", "score", "predicted")
