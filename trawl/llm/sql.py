"""What SQL can say of the registered queries, for DuckDB."""

from __future__ import annotations

import re

from trawl.llm.license_templates import TEMPLATES

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
BLANK_FREE = r"'[^\x20\x09-\x0D]+'"
ALNUM = r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'"
FOLDED = f"translate(coalesce(text, ''), '{UPPER}', '{LOWER}')"

DECONTAMINATION = f"""
WITH doc_words AS (SELECT doc_id, regexp_extract_all({FOLDED}, {ALNUM}) AS w FROM documents),
item_words AS (SELECT item_id, regexp_extract_all({FOLDED}, {ALNUM}) AS w FROM benchmark),
windows AS (
  SELECT item_id, o, n, w[o:o + n - 1] AS win
  FROM (SELECT item_id, w, least(10, len(w)) AS n, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS o
        FROM item_words WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT n FROM windows),
places AS (
  SELECT doc_id, i, n, w[i:i + n - 1] AS win
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM doc_words, sizes WHERE len(w) >= n)),
found AS (SELECT doc_id, i, n, item_id, o FROM places JOIN windows USING (win, n)),
hits AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit
  FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM found) GROUP BY doc_id),
items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM found) GROUP BY doc_id),
islands AS (
  SELECT doc_id, item_id, n, i - o AS diagonal,
         i - row_number() OVER (PARTITION BY doc_id, item_id, i - o ORDER BY i) AS island FROM found),
lengths AS (
  SELECT doc_id, max(size) AS longest
  FROM (SELECT doc_id, count(*) + max(n) - 1 AS size FROM islands GROUP BY doc_id, item_id, diagonal, island)
  GROUP BY doc_id)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated, coalesce(longest, 0) AS longest
FROM doc_words LEFT JOIN hits USING (doc_id) LEFT JOIN items USING (doc_id) LEFT JOIN lengths USING (doc_id)"""

REPEATS = f"""
WITH words AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), {BLANK_FREE}) AS w FROM documents),
windows AS (
  SELECT doc_id, i, w[i:i + 19] AS win
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 18)) AS i FROM words WHERE len(w) >= 20)),
ranked AS (SELECT doc_id, i, row_number() OVER (PARTITION BY win ORDER BY doc_id, i) AS nth FROM windows),
gone AS (SELECT DISTINCT doc_id, p FROM (SELECT doc_id, unnest(range(i, i + 20)) AS p FROM ranked WHERE nth > 1)),
single AS (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS p FROM words),
kept AS (
  SELECT doc_id, string_agg(word, ' ' ORDER BY p) AS kept, count(*) AS n
  FROM single ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id)
SELECT doc_id, len(w) AS n_words, len(w) - coalesce(n, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM words LEFT JOIN kept USING (doc_id)"""

NEAR_DUPLICATES = f"""
WITH RECURSIVE words AS (SELECT doc_id, regexp_extract_all({FOLDED}, {BLANK_FREE}) AS w FROM documents),
shingles AS (
  SELECT DISTINCT doc_id, s FROM (
    SELECT doc_id, unnest(CASE WHEN len(w) >= 3 THEN list_transform(range(1, len(w) - 1), lambda i: w[i:i + 2])
                               WHEN len(w) > 0 THEN [w] ELSE [] END) AS s FROM words)),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
common AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n
  FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY 1, 2),
linked AS (
  SELECT a, b FROM common JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
  WHERE 100 * common.n >= 85 * (x.n + y.n - common.n)),
edges AS (SELECT a, b FROM linked UNION ALL SELECT b, a FROM linked),
reached AS (
  SELECT doc_id AS id, doc_id AS other FROM documents
  UNION SELECT reached.id, edges.b FROM reached JOIN edges ON edges.a = reached.other)
SELECT d.doc_id, coalesce(s.n, 0) AS n_shingles, r.component_id, d.doc_id = r.component_id AS kept
FROM documents d LEFT JOIN sizes s USING (doc_id)
JOIN (SELECT id, min(other) AS component_id FROM reached GROUP BY id) r ON r.id = d.doc_id"""

# --- license scans: every template as a pattern over the words joined by blanks

_MARKUP = re.compile(r"[\[\]]|\{\w+:\d+-\d+\}|[A-Za-z0-9]+")


def _pattern(markup: str) -> tuple[str, int]:
    """A template as a pattern, and the number of its mandatory words."""
    pattern, depth, fixed = "", 0, 0
    for part in _MARKUP.findall(markup):
        if part in "[]":
            depth += 1 if part == "[" else -1
            pattern += "(?:" if part == "[" else ")?"
        elif part[0] == "{":
            pattern += "(?: [^ ]+){" + part[part.index(":") + 1:-1].replace("-", ",") + "}"
        else:
            pattern += " " + part.lower()
            fixed += depth == 0
    return pattern + " ", fixed


def _licenses() -> str:
    hits = []
    for t in TEMPLATES:
        pattern, fixed = _pattern(t.markup)
        hits.append(f"{{'label': '{t.label}', 'fixed': {fixed}, 'hit': regexp_matches(j, '{pattern}')}}")
    return f"""
WITH words AS (SELECT doc_id, regexp_extract_all({FOLDED}, {ALNUM}) AS w FROM documents),
joined AS (
  SELECT doc_id, w, ' ' || array_to_string(w, ' ') || ' ' AS j,
         list_filter(range(1, len(w) + 1), lambda i: w[i:i + 3] IN (['under', 'the', 'mit', 'license'],
           ['apache', 'license', 'version', '2']) OR w[i:i + 2] = ['cc', 'by', 'nc']) AS places FROM words),
found AS (SELECT doc_id, w, j, places, list_filter([{', '.join(hits)}], lambda h: h.hit) AS hits FROM joined)
SELECT doc_id, len(w) AS n_words, len(places) AS n_base, list_min(places) - 1 AS first_word,
       list_max(places) - 1 AS last_word,
       concat_ws(',', CASE WHEN contains(j, ' apache license version 2 ') THEN 'apache-2' END,
                 CASE WHEN contains(j, ' cc by nc ') THEN 'cc-by-nc' END,
                 CASE WHEN contains(j, ' under the mit license ') THEN 'mit' END) AS base_labels,
       coalesce(array_to_string(list_sort(list_distinct(list_transform(hits, lambda h: h.label))), ','), '') AS labels,
       coalesce(list_max(list_transform(hits, lambda h: h.fixed)) / (list_max(list_transform(hits, lambda h: h.fixed)) + 4.0::DOUBLE),
                0.0::DOUBLE) AS score
FROM found"""


LICENSES = _licenses()

# --- crc32, which is no function of DuckDB's, by its table

_CRC_TABLE = """crc AS (
  SELECT list_transform(range(256), lambda n: list_reduce(list_prepend(n, range(8)), lambda c, k:
    CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t)"""


def _crc32(key: str) -> str:
    digits = f"lambda i: CAST('0x' || substr(hex(encode({key})), 2 * i + 1, 2) AS BIGINT)"
    return (f"xor(list_reduce(list_prepend(4294967295, list_transform(range(strlen({key})), {digits})), "
            "lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295)")


SPELLING = f"""
WITH RECURSIVE {_CRC_TABLE},
runs AS (
  SELECT doc_id, run, count(*) AS n
  FROM (SELECT doc_id, unnest(regexp_extract_all({FOLDED}, '[a-z\\x{{C0}}-\\x{{FF}}]+')) AS run FROM documents)
  WHERE length(run) >= 5 GROUP BY doc_id, run),
hashed AS (
  SELECT run, n, {_crc32("key")} AS h
  FROM (SELECT run, n, coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run AS key FROM runs), crc),
words AS (
  SELECT word, CAST(sum(n) AS BIGINT) AS n
  FROM (SELECT n, CASE WHEN h % 97 = 0 THEN left(run, CAST(h % length(run) AS INT))
                       || substr(run, CAST(h % length(run) AS INT) + 2) ELSE run END AS word FROM hashed)
  WHERE length(word) >= 5 GROUP BY word HAVING sum(n) >= 3),
cuts AS (
  SELECT word, n, i, length(word) AS size, left(word, i) || substr(word, i + 2) AS rest
  FROM (SELECT word, n, CAST(unnest(range(length(word))) AS INT) AS i FROM words)),
gone AS (SELECT DISTINCT cuts.word AS a, words.word AS b, cuts.n AS an, words.n AS bn
         FROM cuts JOIN words ON cuts.rest = words.word),
near AS (
  SELECT a, b, bn FROM gone UNION ALL SELECT b, a, an FROM gone UNION ALL
  SELECT x.word, y.word, y.n FROM cuts x JOIN cuts y ON x.rest = y.rest AND x.i = y.i AND x.size = y.size AND x.word <> y.word),
best AS (
  SELECT a AS word, b, bn, count(*) OVER (PARTITION BY a) AS n_near FROM near
  QUALIFY row_number() OVER (PARTITION BY a ORDER BY bn DESC, b) = 1),
forms AS (SELECT word, n, n_near, CASE WHEN bn >= 2 * n THEN b END AS form, CASE WHEN bn >= 2 * n THEN bn END AS form_n
          FROM words LEFT JOIN best USING (word)),
up AS (SELECT word, word AS root, 0 AS steps FROM words
       UNION ALL SELECT up.word, forms.form, steps + 1 FROM up JOIN forms ON forms.word = up.root WHERE forms.form IS NOT NULL)
SELECT word, form, root, n, coalesce(n_near, 0) AS n_near, form_n
FROM forms JOIN (SELECT word, arg_max(root, steps) AS root FROM up GROUP BY word) USING (word)"""


def _leaf(n_chars: str) -> str:
    values = ["CAST(doc_id AS VARCHAR)", "source", "lang", f"CAST({n_chars} AS VARCHAR)", "text"]
    return "sha256(" + " || ".join(f"coalesce(strlen({v}) || ':' || {v}, '-')" for v in values) + ")"


_CLIMB = """SELECT {keys}, level + 1 AS level, i // 2 AS i,
           sha256(CASE WHEN i % 2 = 1 THEN nodes[i] || node ELSE node || coalesce(nodes[i + 2], '') END) AS node,
           proof || CASE WHEN i % 2 = 1 THEN nodes[i] ELSE coalesce(nodes[i + 2], '') END AS proof"""
_HALVED = "list_transform(range(1, len(nodes) + 1, 2), lambda k: sha256(nodes[k] || coalesce(nodes[k + 1], '')))"

MANIFEST = f"""
WITH RECURSIVE {_CRC_TABLE},
leaves AS (
  SELECT coalesce('=' || lang, '') AS tree, doc_id, leaf, changed,
         row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i, row_number() OVER () AS id
  FROM (SELECT doc_id, lang, {_leaf("n_chars")} AS leaf,
               CASE WHEN {_crc32("CAST(doc_id AS VARCHAR)")} % 7 = 0 AND n_chars IS NOT NULL
                    THEN {_leaf("n_chars + 1")} ELSE {_leaf("n_chars")} END AS changed FROM documents, crc)),
trees AS (
  SELECT tree, 0 AS level, list(leaf ORDER BY i) AS nodes FROM leaves GROUP BY tree
  UNION ALL SELECT tree, level + 1, {_HALVED} FROM trees WHERE len(nodes) > 1),
subroots AS (SELECT tree, nodes[1] AS subroot, row_number() OVER (ORDER BY tree) - 1 AS j FROM trees WHERE len(nodes) = 1),
tops AS (
  SELECT 0 AS level, list(subroot ORDER BY j) AS nodes FROM subroots
  UNION ALL SELECT level + 1, {_HALVED} FROM tops WHERE len(nodes) > 1),
low AS (
  SELECT id, tree, 0 AS level, i, changed AS node, '' AS proof FROM leaves
  UNION ALL {_CLIMB.format(keys="id, tree")} FROM low JOIN trees USING (tree, level) WHERE len(nodes) > 1),
high AS (
  SELECT id, 0 AS level, j AS i, node, proof FROM low JOIN trees USING (tree, level) JOIN subroots USING (tree)
  WHERE len(nodes) = 1
  UNION ALL {_CLIMB.format(keys="id")} FROM high JOIN tops USING (level) WHERE len(nodes) > 1),
ends AS (SELECT id, node, proof, nodes[1] AS root FROM high JOIN tops USING (level) WHERE len(nodes) = 1)
SELECT doc_id, leaf, subroot, root, sha256(proof) AS proof_sha256, node AS folded_root, node = root AS verified
FROM leaves JOIN ends USING (id) JOIN subroots USING (tree)"""
