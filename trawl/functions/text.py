"""Tokenising and counting, as column expressions and row-local projections."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# 3 to 25 word characters, inner ' or -, optional leading # or @.
TOKEN_PATTERN = r"[#@\p{L}\p{N}_](?:['\-]?[\p{L}\p{N}_]){2,24}"

# The customary English stopword list of text toolkits.
ENGLISH_STOPWORDS = """
i me my myself we our ours ourselves you your yours yourself yourselves he him
his himself she her hers herself it its itself they them their theirs
themselves what which who whom this that these those am is are was were be been
being have has had having do does did doing a an the and but if or because as
until while of at by for with about against between into through during before
after above below to from up down in out on off over under again further then
once here there when where why how all any both each few more most other some
such no nor not only own same so than too very s t can will just don should now
d ll m o re ve y ain aren couldn didn doesn hadn hasn haven isn ma mightn mustn
needn shan shouldn wasn weren won wouldn
don't should've aren't couldn't didn't doesn't hadn't hasn't haven't isn't
mightn't mustn't needn't shan't shouldn't wasn't weren't won't wouldn't
you're you've you'll you'd she's it's that'll
he'd he'll he's i'd i'll i'm i've it'd it'll she'd she'll they'd they'll
they're they've we'd we'll we're we've
""".split()

# Words too common in the corpus to be worth indexing.
CORPUS_STOPWORDS = [
    "category", "references", "also", "external", "links", "may", "first",
    "see", "history", "people", "one", "two", "part", "thumb", "including",
    "second", "following", "many", "however", "would", "became",
]

STOPWORDS = ENGLISH_STOPWORDS + CORPUS_STOPWORDS


def quoted(value: str) -> str:
    """A string as an SQL literal."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _tokens_sql(text: str) -> str:
    return f"regexp_extract_all(lower({text}), {quoted(TOKEN_PATTERN)}, 0)"


def _kept_sql(tokens: str, stopwords: Iterable[str] | None) -> str:
    words = list(STOPWORDS if stopwords is None else stopwords)
    if not words:
        return tokens
    return f"filter({tokens}, t -> t NOT IN ({', '.join(map(quoted, words))}))"


# SQL text, because a list of some 200 literals is parsed far faster than it is built one by one.

def tokenize(text: str) -> Column:
    """Lower-cased tokens of a text column in text order; NULL text stays NULL."""
    return F.expr(_tokens_sql(text))


def remove_stopwords(tokens: str, stopwords: Iterable[str] | None = None) -> Column:
    """Drop stopwords from a token array, keeping order and repeats (array_except would lose repeats)."""
    return F.expr(_kept_sql(tokens, stopwords))


def terms(text: str, stopwords: Iterable[str] | None = None) -> Column:
    """Tokens of a text column without stopwords."""
    return F.expr(_kept_sql(_tokens_sql(text), stopwords))


def count_tokens(df: DataFrame, keys: list[str], tokens: Column, count: str = "tf") -> DataFrame:
    """One row per input row and distinct token: ``(*keys, term, count)``.

    A row holds its whole token list, so equal tokens are brought together by
    sorting the array and measuring the runs. No rows are exchanged: a corpus of
    any size is counted in the scan stage.
    """
    ordered = df.select(*keys, F.sort_array(tokens).alias("_tokens"))
    starts = ordered.withColumn("_starts", F.array_compact(F.transform(
        "_tokens",
        lambda t, i: F.when((i == 0) | (t != F.get(F.col("_tokens"), i - 1)), i),
    )))
    runs = F.transform("_starts", lambda s, i: F.struct(
        F.get(F.col("_tokens"), s).alias("term"),
        (F.coalesce(F.get(F.col("_starts"), i + 1), F.size("_tokens")) - s).alias("n"),
    ))
    return (starts.select(*keys, F.explode(runs).alias("_run"))
            .select(*keys, "_run.term", F.col("_run.n").alias(count)))


def term_frequencies(df: DataFrame, id_col: str, text_col: str,
                     stopwords: Iterable[str] | None = None) -> DataFrame:
    """``(term, doc_id, tf)`` for a table with one row per document."""
    source = df.withColumnRenamed(id_col, "doc_id")
    return count_tokens(source, ["doc_id"], terms(text_col, stopwords)).select("term", "doc_id", "tf")


def token_frequencies(docs: DataFrame) -> DataFrame:
    """``(term, doc_id, tf)`` for documents that come tokenised: ``(doc_id, tokens)``."""
    return count_tokens(docs, ["doc_id"], F.col("tokens")).select("term", "doc_id", "tf")
