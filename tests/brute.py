"""Scores of one document for one query, straight from their formulas."""

import math
import re
from collections import Counter

from trawl.functions.text import STOPWORDS

# Fixed value: 3 to 25 word characters, inner ' or -, optional leading # or @.
WORDS = re.compile(r"[\#\@\w](['\-]?\w){2,24}", re.UNICODE)


def words(text):
    return [m.group() for m in WORDS.finditer((text or "").lower()) if m.group() not in STOPWORDS]


class Corpus:
    """Term counts of each document, and which terms an index with the given cuts knows and posts."""

    def __init__(self, docs, min_df=0, max_df=math.inf):
        self.counts = {doc: Counter(words(text)) for doc, text in docs}
        every = Counter(t for counts in self.counts.values() for t in counts)
        self.df = {t: n for t, n in every.items() if n > min_df}
        self.posted = {t for t, n in self.df.items() if n < max_df}

    def tf(self, doc, term):
        return self.counts.get(doc, {}).get(term, 0) if term in self.posted else 0

    def postings(self, term):
        return [(doc, self.tf(doc, term)) for doc in sorted(self.counts) if self.tf(doc, term)]

    def matches(self, query):
        """Documents that hold a posted term of the query."""
        return [d for d in self.counts if any(self.tf(d, t) for t in set(words(query)))]


def cosine(corpus, query, doc, n_docs):
    """u·v / (|u||v|) over the query's known terms; a vector without length counts as of length 1."""
    terms = sorted(set(words(query)) & corpus.df.keys())
    idf = [math.log10((n_docs + 1) / (corpus.df[t] + 1)) for t in terms]
    u = [words(query).count(t) * i for t, i in zip(terms, idf)]
    v = [corpus.tf(doc, t) * i for t, i in zip(terms, idf)]
    return math.sumprod(u, v) / ((math.hypot(*u) or 1) * (math.hypot(*v) or 1))


def binary(corpus, query, doc):
    return sum(corpus.tf(doc, t) > 0 for t in set(words(query)))


def bm25(corpus, query, doc, k1=1.5):
    n = len(corpus.posted)

    def gain(term):
        df, tf = corpus.df[term], corpus.tf(doc, term)
        return math.log((n + 1) / (df + 0.5)) * (k1 + 1) / (1 + k1 / tf) if tf else 0
    return math.fsum(gain(t) for t in words(query) if t in corpus.posted)


def blend(body, title, anchor, rank, views, length, top_rank, top_views):
    """Weighted mean of a document's five values; a signal without a maximum has no weight."""
    parts = [(60, body), (20, title / length), (10, anchor / length)]
    if top_rank:
        parts.append((5, max(rank, 0) / top_rank))
    if top_views:
        parts.append((5, math.log(1 + max(views, 0), 1 + top_views)))
    return math.fsum(w * x for w, x in parts) / sum(w for w, _ in parts)


def scores(corpus, query, score):
    return {doc: score(doc) for doc in corpus.matches(query)}


def best(found, k=100):
    order = sorted(found, key=lambda d: (-math.floor(found[d] * 1e9 + 0.5), d))
    return [(i + 1, d) for i, d in enumerate(order[:k])]
