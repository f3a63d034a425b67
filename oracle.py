"""DuckDB equivalents of the registered queries, built from shared fragments."""

from __future__ import annotations

# Rules in this file's own words: nothing is imported from the package, so a wrong value there shows.
MIN_DF = 5
TITLE_PATTERN = "<title>([^<]*)</title>"
LINK_PATTERN = '<a href="([^"]*)">([^<]*)</a>'
MARKUP_PATTERN = "(?is)<(?:script.*?</script|style.*?</style|!--.*?--|[^>]*)>"
# A token begins with #, @ or a word character; 2 to 24 word characters follow, each with ' or - before it or not.
WORD = r"[\p{L}\p{N}_]"
TOKEN_PATTERN = f"(?:[#@]|{WORD})(?:'{WORD}|-{WORD}|{WORD}){{2,24}}"
# Common English words, then words common in the corpus.
STOPWORDS = """
i me my myself we our ours ourselves you your yours yourself yourselves he him his himself she her hers herself it its
itself they them their theirs themselves what which who whom this that these those am is are was were be been being have
has had having do does did doing a an the and but if or because as until while of at by for with about against between
into through during before after above below to from up down in out on off over under again further then once here there
when where why how all any both each few more most other some such no nor not only own same so than too very s t can
will just don should now d ll m o re ve y ain aren couldn didn doesn hadn hasn haven isn ma mightn mustn needn shan
shouldn wasn weren won wouldn don't should've aren't couldn't didn't doesn't hadn't hasn't haven't isn't mightn't
mustn't needn't shan't shouldn't wasn't weren't won't wouldn't you're you've you'll you'd she's it's that'll he'd he'll
he's i'd i'll i'm i've it'd it'll she'd she'll they'd they'll they're they've we'd we'll we're we've
category references also external links may first see history people one two part thumb including second following many
however would became""".split()

HOT_DF = 100
LOOKUP_TERMS = ["tion", "anth", "absentterm"]
BLOCK_DOCS = 256
K = 100


def _text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


STOP_LIST = ", ".join(_text(w) for w in STOPWORDS)


def _tokens(column: str) -> str:
    return f"regexp_extract_all(lower({column}), {_text(TOKEN_PATTERN)})"


def _with(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


# --- inputs -------------------------------------------------------------------------------

DOCS = "docs AS (SELECT doc_id AS id, text FROM documents)"
PAGE_DOCS = f"""page_docs AS (
  SELECT page_id AS id, regexp_extract(html, {_text(TITLE_PATTERN)}, 1) AS title,
         regexp_replace(html, {_text(MARKUP_PATTERN)}, ' ', 'g') AS text
  FROM pages)"""
RAW_LINKS = f"""raw_links AS (
  SELECT page_id AS src, unnest(regexp_extract_all(html, {_text(LINK_PATTERN)}, 1)) AS href,
         unnest(regexp_extract_all(html, {_text(LINK_PATTERN)}, 2)) AS text
  FROM pages)"""
LINKS = f"""{RAW_LINKS},
link_targets AS (SELECT href, min(src) AS dst FROM raw_links GROUP BY href),
links AS (SELECT src, dst, text FROM raw_links JOIN link_targets USING (href))"""
EDGES = "edges AS (SELECT DISTINCT src, dst FROM links)"
PAIRS = """pv_lines AS (
  SELECT CASE WHEN event_type = 'error' THEN 'en.wikipedia' ELSE CAST(user_id AS VARCHAR) END
         || ' ' || event_type || ' ' || CAST(CAST(floor(value) AS BIGINT) AS VARCHAR) AS value
  FROM events),
pv_pairs AS (
  SELECT TRY_CAST(split_part(value, ' ', 1) AS BIGINT) AS id, TRY_CAST(split_part(value, ' ', 3) AS BIGINT) AS views
  FROM pv_lines
  WHERE TRY_CAST(split_part(value, ' ', 1) AS BIGINT) IS NOT NULL
    AND TRY_CAST(split_part(value, ' ', 3) AS BIGINT) IS NOT NULL)"""
VIEWS = f"{PAIRS},\nviews AS (SELECT id, CAST(sum(views) AS BIGINT) AS views FROM pv_pairs GROUP BY id)"
Q_TERMS = """q_terms AS (
  SELECT query_id, CAST(max(q_len) AS INTEGER) AS q_len, term, CAST(count(*) AS INTEGER) AS q_tf
  FROM (SELECT query_id, greatest(1, len(list_distinct(tokens))) AS q_len, unnest(tokens) AS term FROM q_tokens)
  GROUP BY query_id, term)"""


def _query_tokens(source: str) -> str:
    return f"""q_tokens AS (
  SELECT query_id, list_filter({_tokens('text')}, lambda t: t NOT IN ({STOP_LIST})) AS tokens
  FROM {source})"""


QUERY_TERMS = _query_tokens("(SELECT item_id AS query_id, text FROM benchmark)") + ",\n" + Q_TERMS
ODD_TERMS = _query_tokens("""(SELECT item_id * 4 AS query_id, text FROM benchmark
    UNION ALL SELECT item_id * 4 + 1, '' FROM benchmark UNION ALL SELECT item_id * 4 + 2, 'the of and' FROM benchmark
    UNION ALL SELECT item_id * 4 + 3, 'zzzunknown ' || text FROM benchmark)""") + ",\n" + Q_TERMS


def _counts(name: str, source: str, id_col: str = "id", text: str = "text") -> str:
    return f"""{name}_tf AS (
  SELECT term, doc_id, CAST(count(*) AS INTEGER) AS tf
  FROM (SELECT {id_col} AS doc_id, unnest({_tokens(text)}) AS term FROM {source})
  WHERE term NOT IN ({STOP_LIST}) GROUP BY term, doc_id)"""


def _index(name: str, source: str, id_col: str = "id", text: str = "text", min_df: int = 0, max_df: int | None = None) -> str:
    return f"""{_counts(name, source, id_col, text)},
{name}_stats AS (
  SELECT term, count(*) AS df, CAST(sum(tf) AS BIGINT) AS term_total FROM {name}_tf GROUP BY term HAVING count(*) > {min_df}),
{name}_postings AS (
  SELECT t.term, t.doc_id, t.tf FROM {name}_tf t JOIN {name}_stats s ON t.term = s.term
  WHERE {'true' if max_df is None else f's.df < {max_df}'})"""


BODY = f"{DOCS},\n" + _index("body", "docs")
PAGE_BODY = _index("body", "page_docs")
TITLE = _index("title", "page_docs", text="title")
ANCHOR = _index("anchor", "links", id_col="dst")


# --- ranking ------------------------------------------------------------------------------

def _cosine(n_docs: str) -> str:
    return f"""n AS (SELECT count(DISTINCT id) AS n FROM {n_docs}),
q_weights AS (
  SELECT q.query_id, q.term, log10((n.n + 1) / (s.df + 1)) AS idf, q.q_tf * log10((n.n + 1) / (s.df + 1)) AS w
  FROM q_terms q JOIN body_stats s USING (term), n),
q_norms AS (
  SELECT query_id, CASE WHEN sum(w * w) = 0 THEN 1 ELSE sqrt(sum(w * w)) END AS q_norm FROM q_weights GROUP BY query_id),
body_sums AS (
  SELECT w.query_id, p.doc_id, sum(p.tf * w.idf * w.w) AS dot, sqrt(sum(p.tf * w.idf * p.tf * w.idf)) AS norm
  FROM q_weights w JOIN body_postings p USING (term) GROUP BY w.query_id, p.doc_id),
body_scores AS (
  SELECT query_id, doc_id, dot / ((CASE WHEN norm = 0 THEN 1 ELSE norm END) * q_norm) AS score
  FROM body_sums JOIN q_norms USING (query_id))"""


def _binary(name: str) -> str:
    return f"""{name}_scores AS (
  SELECT q.query_id, p.doc_id, CAST(count(*) AS DOUBLE) AS score
  FROM q_terms q JOIN {name}_postings p USING (term) GROUP BY q.query_id, p.doc_id)"""


def _top(scores: str, k: int = K) -> str:
    return f"""top AS (
  SELECT * FROM (
    SELECT query_id, doc_id, score, CAST(row_number() OVER (
      PARTITION BY query_id ORDER BY floor(score * 1e9 + 0.5) DESC, doc_id) AS INTEGER) AS rank
    FROM {scores}) WHERE rank <= {k})"""


BM25 = """n AS (SELECT count(*) AS n FROM body_stats),
gains AS (
  SELECT q.query_id, p.doc_id, sum(
    q.q_tf * ln(1 + (n.n - s.df + 0.5) / (s.df + 0.5)) * p.tf * 2.5 / (p.tf + 1.5)) AS score
  FROM q_terms q JOIN body_stats s USING (term) JOIN body_postings p USING (term), n
  GROUP BY q.query_id, p.doc_id)"""
BM25_LENGTHS = """n AS (SELECT count(*) AS n FROM body_stats),
sizes AS (SELECT doc_id, CAST(sum(tf) AS DOUBLE) AS size FROM body_tf GROUP BY doc_id),
mean AS (SELECT avg(size) AS mean FROM sizes),
gains AS (
  SELECT q.query_id, p.doc_id, sum(
    q.q_tf * ln(1 + (n.n - s.df + 0.5) / (s.df + 0.5)) * p.tf * 2.5 / (p.tf + 1.5 * (0.25 + 0.75 * size / mean))) AS score
  FROM q_terms q JOIN body_stats s USING (term) JOIN body_postings p USING (term) JOIN sizes z ON z.doc_id = p.doc_id, n, mean
  GROUP BY q.query_id, p.doc_id)"""
BODY_RUN = _with(BODY, QUERY_TERMS, _cosine("docs"), _top("body_scores"))


def _titled(rounded: bool = False) -> str:
    score = "round(score, 6)" if rounded else "score"
    return f"""SELECT query_id, rank, doc_id, coalesce(title, CAST(doc_id AS VARCHAR)) AS title, {score} AS score
FROM top LEFT JOIN page_docs ON id = doc_id"""


def _blend(signals: bool) -> str:
    base = """candidates AS (
  SELECT query_id, doc_id FROM body_scores UNION SELECT query_id, doc_id FROM title_scores
  UNION SELECT query_id, doc_id FROM anchor_scores),
q_lens AS (SELECT query_id, max(q_len) AS q_len FROM q_terms GROUP BY query_id)"""
    columns = """c.query_id, c.doc_id, coalesce(b.score, 0) AS body, coalesce(t.score, 0) / q_len AS title,
         coalesce(a.score, 0) / q_len AS anchor"""
    joins = """candidates c JOIN q_lens USING (query_id)
  LEFT JOIN body_scores b ON b.query_id = c.query_id AND b.doc_id = c.doc_id
  LEFT JOIN title_scores t ON t.query_id = c.query_id AND t.doc_id = c.doc_id
  LEFT JOIN anchor_scores a ON a.query_id = c.query_id AND a.doc_id = c.doc_id"""
    if not signals:
        return f"""{base},
blended AS (
  SELECT query_id, doc_id, 0.6 / 0.9 * body + 0.2 / 0.9 * title + 0.1 / 0.9 * anchor AS score
  FROM (SELECT {columns} FROM {joins}))"""
    return f"""{base},
tops AS (SELECT (SELECT max(pagerank) FROM ranks) AS pr, (SELECT max(views) FROM views) AS pv),
blended AS (
  SELECT query_id, doc_id, 0.6 * body + 0.2 * title + 0.1 * anchor
         + 0.05 * (CASE WHEN pagerank > 0 THEN pagerank / pr ELSE 0 END)
         + 0.05 * (CASE WHEN views > 0 THEN ln(1 + views) / ln(1 + pv) ELSE 0 END) AS score
  FROM (SELECT {columns}, coalesce(r.pagerank, 0) AS pagerank, coalesce(v.views, 0) AS views
        FROM {joins} LEFT JOIN ranks r ON r.id = c.doc_id LEFT JOIN views v ON v.id = c.doc_id), tops)"""


def _ranks(iterations: int, source: str = "true", page: str = "true") -> str:
    """The recurrence, one CTE per round, over the links and pages with the given properties."""
    ctes = [LINKS, f"edges AS (SELECT DISTINCT src, dst FROM links WHERE {source})", f"""vertices AS (
  SELECT id, coalesce(out, 0) AS out FROM (
    SELECT src AS id FROM edges UNION SELECT dst FROM edges UNION SELECT page_id FROM pages WHERE {page})
  LEFT JOIN (SELECT src, count(*) AS out FROM edges GROUP BY src) ON src = id)""",
            "r0 AS MATERIALIZED (SELECT id, out, CAST(1 AS DOUBLE) AS rank FROM vertices)"]
    for i in range(1, iterations + 1):
        ctes.append(f"""r{i} AS MATERIALIZED (
  SELECT v.id, v.out, 0.15 + 0.85 * coalesce(received, 0) AS rank
  FROM vertices v LEFT JOIN (
    SELECT dst, sum(rank / out) AS received FROM edges JOIN r{i - 1} ON id = src GROUP BY dst) ON dst = v.id)""")
    ctes.append(f"""ranks AS (
  SELECT id, rank * (SELECT count(*) / sum(rank) FROM r{iterations}) AS pagerank
  FROM r{iterations} WHERE id IN (SELECT page_id FROM pages WHERE {page}))""")
    return ",\n".join(ctes)


# --- evaluation ---------------------------------------------------------------------------

QRELS = """plain_stats AS (SELECT term, count(*) AS df FROM body_tf GROUP BY term),
rarest AS (
  SELECT query_id, term FROM (
    SELECT query_id, q.term, row_number() OVER (PARTITION BY query_id ORDER BY df, q.term) AS i
    FROM q_terms q JOIN plain_stats USING (term)) WHERE i = 1),
qrels AS (SELECT query_id, doc_id FROM rarest JOIN body_tf USING (term))"""
MARKED = """marked AS (
  SELECT query_id, rank, CASE WHEN r.doc_id IS NULL THEN 0 ELSE 1 END AS hit
  FROM top LEFT JOIN qrels r USING (query_id, doc_id))"""


def _round3(x: str) -> str:
    return f"CAST(format('{{:.3f}}', CAST({x} AS DOUBLE)) AS DOUBLE)"


def _harmonic(a: str, b: str) -> str:
    return f"CASE WHEN {a} = 0 OR {b} = 0 THEN 0.0 ELSE {_round3(f'2.0 / (1.0 / {a} + 1.0 / {b})')} END"


QUALITY = f"""sums AS (
  SELECT item_id AS query_id, (SELECT count(DISTINCT doc_id) FROM qrels q WHERE q.query_id = item_id) AS relevant,
         count(*) FILTER (rank <= 5) AS n5, coalesce(sum(hit) FILTER (rank <= 5), 0) AS h5,
         count(*) FILTER (rank <= 30) AS n30, coalesce(sum(hit) FILTER (rank <= 30), 0) AS h30
  FROM benchmark LEFT JOIN marked ON marked.query_id = item_id GROUP BY item_id),
basic AS (
  SELECT query_id, {_round3('CASE WHEN n5 = 0 THEN 0 ELSE h5 / n5 END')} AS p5,
         {_round3('CASE WHEN n30 = 0 THEN 0 ELSE h30 / n30 END')} AS p30,
         {_round3('CASE WHEN relevant = 0 THEN 1 ELSE h30 / relevant END')} AS r30
  FROM sums),
with_f1 AS (SELECT *, {_harmonic('p30', 'r30')} AS f1 FROM basic),
hits AS (
  SELECT query_id, rank, hit, sum(hit) OVER (PARTITION BY query_id ORDER BY rank) / rank AS prec
  FROM marked WHERE rank <= 40),
aps AS (SELECT query_id, avg(prec) AS ap FROM hits WHERE hit = 1 GROUP BY query_id),
quality AS (
  SELECT query_id, p5 AS precision, r30 AS recall, f1, {_round3('coalesce(ap, 0)')} AS average_precision,
         {_harmonic('p5', 'f1')} AS quality
  FROM with_f1 LEFT JOIN aps USING (query_id))"""
EVALUATION = _with(BODY, QUERY_TERMS, _cosine("docs"), _top("body_scores"), QRELS, MARKED, QUALITY)


def statements() -> dict[str, str]:
    plain = _with(f"{DOCS},\n" + _index("body", "docs"))
    body = _with(BODY)
    added = _with("docs AS (SELECT doc_id AS id, text FROM documents UNION ALL SELECT -1 - item_id, text FROM benchmark)",
                  _index("body", "docs"))
    pages = _with(PAGE_DOCS)
    tf = "SELECT term, doc_id, tf FROM {}_postings"
    run = "SELECT query_id, rank, doc_id, round(score, 6) AS score FROM top"
    all_indexes = [PAGE_DOCS, PAGE_BODY, TITLE]
    scores = [QUERY_TERMS, _cosine("page_docs"), _binary("title"), _binary("anchor")]
    metric = lambda columns: f"{EVALUATION}SELECT query_id, {columns} FROM quality"
    return {
        "tokenize_docs": f"""SELECT doc_id AS id, CAST(generate_subscripts({_tokens('text')}, 1) - 1 AS INTEGER) AS pos,
  unnest({_tokens('text')}) AS token FROM documents""",
        "stopword_filter": f"""SELECT id, CAST(len(kept) AS INTEGER) AS n_tokens, array_to_string(kept, ' ') AS tokens
FROM (SELECT doc_id AS id, list_filter({_tokens('text')}, lambda t: t NOT IN ({STOP_LIST})) AS kept FROM documents)""",
        "term_counts": _with(DOCS, _counts("body", "docs")) + "SELECT term, doc_id, tf FROM body_tf",
        "query_vectors": _with(QUERY_TERMS) + "SELECT query_id, q_len, term, q_tf FROM q_terms",
        "document_frequency": plain + "SELECT term, df FROM body_stats",
        "collection_frequency": plain + "SELECT term, term_total FROM body_stats",
        "rare_term_cut": _with(f"{DOCS},\n" + _index("body", "docs", min_df=MIN_DF)) + tf.format("body"),
        "hot_term_cut": _with(f"{DOCS},\n" + _index("body", "docs", min_df=MIN_DF, max_df=HOT_DF))
        + """SELECT s.term, s.df, count(p.doc_id) AS n_postings
FROM body_stats s LEFT JOIN body_postings p ON s.term = p.term GROUP BY s.term, s.df""",
        "title_index": _with(PAGE_DOCS, TITLE) + tf.format("title"),
        "anchor_index": _with(LINKS, ANCHOR) + tf.format("anchor"),
        "posting_lookup": body + tf.format("body") + f" WHERE term IN ({', '.join(map(_text, LOOKUP_TERMS))})",
        "posting_scan": body + f"""SELECT term, doc_id // {BLOCK_DOCS} AS block, CAST(count(*) AS INTEGER) AS n_postings,
  string_agg(doc_id || ':' || tf, ' ' ORDER BY doc_id) AS postings
FROM body_postings GROUP BY term, doc_id // {BLOCK_DOCS}""",
        "posting_scan_ordered": _with(PAGE_DOCS, TITLE) + """SELECT term, doc_id, tf,
  CAST(row_number() OVER (PARTITION BY term ORDER BY doc_id) AS INTEGER) AS place FROM title_postings""",
        "index_add_docs": added + "SELECT term, df, term_total FROM body_stats",
        "index_segments": added + "SELECT term, df, term_total FROM body_stats",
        "index_compacted": added + tf.format("body"),
        "corpus_links": _with(RAW_LINKS) + "SELECT src, CAST('0x' || substr(md5(href), 1, 8) AS BIGINT) AS dst, text FROM raw_links",
        "link_edges": _with(LINKS, EDGES) + "SELECT src, dst FROM edges",
        "link_vertices": "SELECT DISTINCT page_id AS id, page_id AS title FROM pages",
        "pagerank_3": _with(_ranks(3)) + "SELECT id, round(pagerank, 6) AS pagerank FROM ranks",
        "pagerank_10": _with(_ranks(10)) + "SELECT id, round(pagerank, 6) AS pagerank FROM ranks",
        "pagerank_out_of_corpus": _with(_ranks(10, "src % 5 <> 0", "page_id % 5 <> 0"))
        + "SELECT id, round(pagerank, 6) AS pagerank FROM ranks",
        "pageviews_read": _with(PAIRS) + "SELECT id, views FROM pv_pairs",
        "pageviews_parse": _with(PAIRS) + "SELECT id, views FROM pv_pairs",
        "pageviews_map": _with(VIEWS) + "SELECT id, views FROM views",
        "pageviews_map_last": """SELECT user_id AS id, arg_max(CAST(floor(value) AS BIGINT), event_id) AS views
FROM events WHERE event_type <> 'error' GROUP BY user_id""",
        "pageviews_map_max": _with(PAIRS) + "SELECT id, max(views) AS views FROM pv_pairs GROUP BY id",
        "title_map": pages + "SELECT id, title FROM page_docs",
        "title_map_repeated": pages + "SELECT id % 10 AS id, min(title) AS title FROM page_docs GROUP BY id % 10",
        "signal_max": _with(VIEWS) + "SELECT coalesce(max(views), 0) AS max_value FROM views",
        "pagerank_lookup": _with(_ranks(3)) + """SELECT event_id AS pos, user_id AS id, round(coalesce(pagerank, 0), 6) AS pagerank
FROM events LEFT JOIN ranks ON id = user_id""",
        "pageview_lookup": _with(VIEWS) + """SELECT page_id AS pos, page_id AS id, coalesce(views, 0) AS views
FROM pages LEFT JOIN views ON id = page_id""",
        "search_body": BODY_RUN + run,
        "search_title": _with(PAGE_DOCS, TITLE, QUERY_TERMS, _binary("title"), _top("title_scores")) + _titled(),
        "search_anchor": _with(PAGE_DOCS, LINKS, ANCHOR, QUERY_TERMS, _binary("anchor"), _top("anchor_scores")) + _titled(),
        "search_combined": _with(_ranks(10), VIEWS, *all_indexes, ANCHOR, *scores, _blend(True), _top("blended"))
        + _titled(rounded=True),
        "search_combined_large_batch": _with(_ranks(10), VIEWS, *all_indexes, ANCHOR, *scores, _blend(True), _top("blended"))
        + _titled(rounded=True),
        "empty_queries": _with(BODY, ODD_TERMS, _cosine("docs"), _top("body_scores")) + run,
        "search_combined_no_signals": _with(LINKS, *all_indexes, ANCHOR, *scores, _blend(False), _top("blended")) + run,
        "search_bm25": _with(BODY, QUERY_TERMS, BM25, _top("gains")) + run,
        "search_bm25_pruned": _with(BODY, QUERY_TERMS, BM25, _top("gains", 10)) + run,
        "search_bm25_lengths": _with(BODY, QUERY_TERMS, BM25_LENGTHS, _top("gains", 20)) + run,
        "search_body_by_term": BODY_RUN + run,
        "title_resolve": pages + """SELECT doc_id, coalesce(p.title, CAST(doc_id AS VARCHAR)) AS title
FROM documents LEFT JOIN page_docs p ON p.id = doc_id""",
        "precision_at_5": metric("precision"),
        "recall_at_30": metric("recall"),
        "f1_at_30": metric("f1"),
        "average_precision_40": metric("average_precision"),
        "results_quality": metric("quality"),
        "evaluate": metric("precision, recall, f1, average_precision, quality"),
        "index_save_load": BODY_RUN + run,
        "signals_save_load": _with(_ranks(3), VIEWS, PAGE_DOCS) + """SELECT id, title, round(pagerank, 6) AS pagerank, views
FROM page_docs LEFT JOIN ranks USING (id) LEFT JOIN views USING (id)""",
        "qrels_json": _with(DOCS, _counts("body", "docs"), QUERY_TERMS, QRELS) + "SELECT query_id, doc_id FROM qrels",
        "qrels_json_object": _with(DOCS, _counts("body", "docs"), QUERY_TERMS, QRELS)
        + "SELECT query_id, doc_id FROM qrels",
    }
