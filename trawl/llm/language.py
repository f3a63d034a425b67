"""Language of a text: averaged embeddings of hashed subwords under a linear softmax."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trawl.llm.common import byte_flags, read, remainder, text_function
from trawl.llm.samples import bounded_sample

BITS = 15
DIM = 16
SIZES = (2, 3, 4)
LETTERS = byte_flags(b"abcdefghijklmnopqrstuvwxyz" + bytes(range(128, 256)))
UNKNOWN = "und"
#: Training rows: of each language, and in all.
PER_LANGUAGE, MOST_ROWS = 600, 3000
#: Error among accepted texts that the rejection threshold is set to.
ACCEPTED_ERROR = 0.01


def subwords(texts: list[str]) -> list[tuple[np.ndarray, np.ndarray]]:
    """Per size the buckets of all subwords of all texts, and where each text's begin.

    Subwords are runs of 2 to 4 bytes of the lower-cased UTF-8 text. All but letters count as
    blanks, and a run may begin or end with blanks.
    """
    gap = b" " * max(SIZES)
    parts = [gap + t.lower().encode() for t in texts]
    firsts = np.concatenate(([0], np.cumsum([len(p) for p in parts])))[:-1]
    raw = np.frombuffer(b"".join(parts) + gap, np.uint8)
    letter = LETTERS[raw]
    codes = np.where(letter, raw, 32).astype(np.uint32)
    found, rolled = [], codes
    for size in range(2, max(SIZES) + 1):
        rolled = rolled[:-1] * np.uint32(257) + codes[size - 1:]
        if size in SIZES:
            lead = 1 if size > 2 else 0
            at = np.flatnonzero(letter[lead:lead + len(rolled)])
            buckets = (rolled[at] + np.uint32(size)) * np.uint32(2654435769) >> np.uint32(32 - BITS)
            found.append((buckets, np.searchsorted(at, firsts)))
    return found


def sums(values: np.ndarray, firsts: np.ndarray) -> np.ndarray:
    """Row sums of consecutive groups, some of which may be empty."""
    bounds = np.append(firsts, len(values))
    full = np.flatnonzero(np.diff(bounds))
    out = np.zeros((len(firsts), values.shape[1]))
    if len(full):
        out[full] = np.add.reduceat(values, firsts[full], axis=0)
    return out


def shares(texts: list[str]) -> list:
    """Of each text its distinct buckets and the share of each among its subwords."""
    found = subwords(texts)
    buckets, weights = [], []
    for n in range(len(texts)):
        own = [b[f[n]:f[n + 1] if n + 1 < len(f) else len(b)] for b, f in found]
        distinct, counts = np.unique(np.concatenate(own), return_counts=True)
        buckets.append(distinct.astype(np.int32))
        weights.append((counts / max(1, counts.sum())).astype(np.float32))
    return [buckets, weights]


@dataclass
class LanguageModel:
    """``table`` holds, of each bucket, its embedding times the softmax weights.

    The mean of embeddings times the weights is the mean of these rows, so prediction needs
    no more than them.
    """

    languages: list[str]
    table: np.ndarray
    bias: np.ndarray
    temperature: float = 1.0
    threshold: float = 0.0

    def scores(self, texts: list[str]) -> np.ndarray:
        total, n = np.zeros((len(texts), len(self.languages))), np.zeros(len(texts))
        for buckets, firsts in subwords(texts):
            total += sums(self.table[buckets], firsts)
            n += np.diff(np.append(firsts, len(buckets)))
        return softmax((total / np.maximum(n, 1)[:, None] + self.bias) / self.temperature)

    def predict(self, texts: list[str]) -> list:
        if not self.languages:
            return [[UNKNOWN] * len(texts), [0.0] * len(texts), [False] * len(texts)]
        probability = self.scores(texts)
        best, top = probability.argmax(1), probability.max(1)
        lettered = [next(filter(str.isalpha, t), None) is not None for t in texts]
        return [[self.languages[b] if ok else UNKNOWN for b, ok in zip(best, lettered)],
                [float(p) if ok else 0.0 for p, ok in zip(top, lettered)],
                [bool(ok and p >= self.threshold) for p, ok in zip(top, lettered)]]


def softmax(logits: np.ndarray) -> np.ndarray:
    e = np.exp(logits - logits.max(-1, keepdims=True))
    return e / e.sum(-1, keepdims=True)


def fit(rows: list[tuple], epochs: int = 12, rate: float = 4.0, seed: int = 7) -> LanguageModel:
    """Stochastic gradient descent over ``(language, buckets, shares)``; every fifth row calibrates.

    The temperature makes the scores of the rows that were set aside as likely as possible, when
    each of them is taken to have some other language with the probability that one in all of
    them is wrong; else a set without errors would make every score 1.
    The rejection threshold is the least score from which on at most ``ACCEPTED_ERROR`` of
    them are wrong.
    """
    rows = [(lang, np.asarray(b, np.int64), np.asarray(w, np.float32)) for lang, b, w in rows if len(b)]
    languages = sorted({lang for lang, _, _ in rows})
    if not languages:
        return LanguageModel([], np.zeros((1 << BITS, 0), np.float32), np.zeros(0))
    target = {lang: n for n, lang in enumerate(languages)}
    aside, learn = rows[::5], [r for n, r in enumerate(rows) if n % 5] or rows
    rng = np.random.default_rng(seed)
    embedding = rng.normal(0, 0.1, (1 << BITS, DIM)).astype(np.float32)
    weights = np.zeros((DIM, len(languages)), np.float32)
    bias = np.zeros(len(languages))
    steps, total = 0, epochs * len(learn)
    for _ in range(epochs):
        for n in rng.permutation(len(learn)):
            lang, buckets, share = learn[n]
            pace = rate * (1 - steps / total)
            steps += 1
            mean = share @ embedding[buckets]
            gradient = softmax(mean @ weights + bias)
            gradient[target[lang]] -= 1
            gradient = gradient.astype(np.float32)
            back = weights @ gradient
            weights -= pace * np.outer(mean, gradient)
            bias -= 0.01 * pace * gradient
            embedding[buckets] -= (10 * pace) * np.outer(share, back)
    table = embedding @ weights
    logits = np.array([w @ table[b] + bias for _, b, w in aside])
    truth = np.array([target[lang] for lang, _, _ in aside])
    doubt = 1 / (len(truth) + 1)
    belief = np.full(logits.shape, doubt / max(1, len(languages) - 1))
    belief[np.arange(len(truth)), truth] = 1 - doubt
    spread = np.geomspace(0.05, 50, 90)
    loss = [-(belief * np.log(np.maximum(softmax(logits / t), 1e-12))).sum() for t in spread]
    temperature = float(spread[int(np.argmin(loss))])
    probability = softmax(logits / temperature)
    order = np.argsort(-probability.max(1))
    wrong = np.cumsum(probability.argmax(1)[order] != truth[order]) / np.arange(1, len(order) + 1)
    good = np.flatnonzero(wrong <= ACCEPTED_ERROR)
    threshold = float(probability.max(1)[order][good[-1]]) if len(good) else 1.0
    return LanguageModel(languages, table.astype(np.float32), bias, temperature, threshold)


def train(docs: DataFrame, trainable, id_col: str = "doc_id", text_col: str = "text",
          lang_col: str = "lang", per_language: int = PER_LANGUAGE, most: int = MOST_ROWS) -> LanguageModel:
    """A model of the rows for which the condition ``trainable`` holds and the language is known.

    It is fitted to at most ``per_language`` rows of a language and ``most`` rows in all,
    chosen by a hash of the id; the texts are turned into buckets on the executors.
    """
    known = docs.where(trainable & F.col(lang_col).isNotNull())
    chosen = bounded_sample(known.select(F.col(id_col).alias("_id"), F.col(lang_col).alias("_lang")),
                            "_id", "_lang", per_language, most)
    features = text_function(shares, "buckets array<int>, weights array<float>", ["buckets", "weights"],
                             [pa.list_(pa.int32()), pa.list_(pa.float32())])
    texts = known.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    found = (texts.join(F.broadcast(chosen), "_id").limit(2 * most)
             .select("_id", "_lang", features("_text").alias("f")).select("_id", "_lang", "f.buckets", "f.weights"))
    rows = found.toArrow().sort_by([("_id", "ascending"), ("_lang", "ascending")])
    return fit(list(zip(rows["_lang"].to_pylist(), rows["buckets"].combine_chunks().to_numpy(False),
                        rows["weights"].combine_chunks().to_numpy(False))))


def identify(docs: DataFrame, model: LanguageModel, text_col: str = "text") -> DataFrame:
    """``docs`` with ``lang_pred``, ``score`` and ``accepted`` in place of columns of these names.

    The whole text is used. A null or empty text, or one without letters, is ``und`` with
    score 0 and not accepted; so is every text if the model has learnt no language. Among
    equal scores the language first in the alphabet wins. ``accepted`` tells whether the
    score reaches the model's threshold. Repeated rows, null ids and other columns stay as
    they are; an empty table gives an empty result.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    predict = text_function(lambda texts: shared.value.predict(texts),
                            "lang_pred string, score double, accepted boolean",
                            ["lang_pred", "score", "accepted"], [pa.string(), pa.float64(), pa.bool_()])
    found = docs.withColumn("__trawl_found", predict(text_col))
    return found.withColumns({c: F.col(f"__trawl_found.{c}") for c in ("lang_pred", "score", "accepted")}).drop("__trawl_found")


def op1_language(spark, sf_dir):
    """Languages of all documents; learnt from two thirds of them."""
    docs = read(spark, sf_dir, "documents")
    model = train(docs, remainder("doc_id", 3) != 1)
    rows = docs.select("doc_id", "text", F.coalesce(remainder("doc_id", 3) == 1, F.lit(False)).alias("held_out"))
    return identify(rows, model).select("doc_id", "held_out", "lang_pred", "score", "accepted")
