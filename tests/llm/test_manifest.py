"""Merkle trees against a plain build."""

import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from trawl.llm.manifest import FIELDS, build_forest, completed, document_manifest, fold, height, leaf_digest, position


def digest(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf_of(row):
    return digest(*["-" if row[c] is None else f"{len(str(row[c]).encode())}:{row[c]}" for c in FIELDS])


def tree(leaves):
    levels = [leaves]
    while len(levels[-1]) > 1:
        last = levels[-1]
        levels.append([digest(*last[i:i + 2]) for i in range(0, len(last), 2)])
    return levels


def way(levels, i):
    """The sibling's side and digest on each level, None without one."""
    found = []
    for nodes in levels[:-1]:
        found.append((i % 2 == 1, nodes[i ^ 1] if i ^ 1 < len(nodes) else None))
        i //= 2
    return found


def brute(rows):
    groups = {}
    for row in rows:
        groups.setdefault(row["lang"], []).append(row)
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {}
    for g in names:
        groups[g].sort(key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, leaf_of(r)))
        trees[g] = tree([leaf_of(r) for r in groups[g]])
    top = tree([trees[g][-1][0] for g in names])
    return sorted((str(r["doc_id"]), leaf_of(r), trees[g][-1][0], top[-1][0], str(way(trees[g], i) + way(top, n)))
                  for n, g in enumerate(names) for i, r in enumerate(groups[g]))


@pytest.mark.parametrize("leaves", [1, 2, 3, 5, 8, 13, 31, 64, 100])
def test_log_order_is_the_closed_form(leaves):
    nodes = [digest(str(i)).encode() for i in range(leaves)]
    log = list(completed(nodes, 0, 0, height(leaves), leaves))
    levels = tree([n.decode() for n in nodes])
    for at, (level, index, node) in enumerate(log):
        assert levels[level][index] == node.decode()
        assert position(np.array([index]), level, leaves)[0] == at
    assert len(log) == sum(map(len, levels))


def test_log_of_builders_has_no_gaps(spark):
    rows = spark.range(150).select(F.when(F.col("id") < 149, "a").otherwise("b").alias("tree"),
                                   F.sha2(F.col("id").cast("string"), 256).alias("digest"), "id")
    forest = build_forest(rows, ["id"], levels=2)
    log = sorted((r.first, r.last, bytes(r.nodes)) for r in forest.log.where("tree = 'a'").collect())
    assert [a for a, _, _ in log] == [0, *[b + 1 for _, b, _ in log[:-1]]]
    want = completed([digest(str(i)).encode() for i in range(149)], 0, 0, 8, 149)
    assert b"".join(n for _, _, n in log).hex() == b"".join(d for _, _, d in want).decode()
    assert {r.tree for r in forest.roots.collect()} == {"a", "b"}


def sample(n):
    rng = random.Random(3)
    return [(rng.choice([None, *range(200)]), rng.choice(["x", None, "é\n"]), rng.choice(["en"] * 8 + ["de", None, "", "zz", "ä"]),
             rng.choice([None, 5, 99]), rng.choice(["", None, "t1", "t2" * 5000])) for _ in range(n)] + [(7, "a", "en", 1, "t")] * 5


SCHEMA = "doc_id bigint, source string, lang string, n_chars bigint, text string"


@pytest.mark.parametrize("levels", [10, 2, 1])
def test_proofs(spark, levels):
    """Nulls in every column, empty groups' names, equal rows, long texts; columns with the operator's own names."""
    docs = spark.createDataFrame(sample(150), SCHEMA)
    clash = docs.select("*", *[F.lit(1).alias(c) for c in ("tree", "rank", "leaves", "digest", "block", "root")])
    made = document_manifest(clash, levels=levels, extra={"key": F.col("doc_id")})
    proofs = made.proofs(["key"]).withColumn("folded", fold(F.col("digest"), F.col("siblings"))).collect()
    got = sorted((str(r.key), r.digest, r.subroot, r.root, str([tuple(s) for s in r.siblings])) for r in proofs)
    assert got == brute([r.asDict() for r in docs.collect()])
    assert all(r.folded == r.root for r in proofs) and {r.root for r in proofs} == {r.root for r in made.root().collect()}


def test_a_change_shows(spark):
    docs = spark.createDataFrame(sample(40), SCHEMA)
    other = leaf_digest([F.concat("text", F.lit("!")) if c == "text" else F.col(c) for c in FIELDS])
    proofs = document_manifest(docs, extra={"other": other, "text": F.col("text")}).proofs(["other", "text"])
    checked = proofs.select("text", (fold(F.col("other"), F.col("siblings")) == F.col("root")).alias("same")).collect()
    assert all(r.same == (r.text is None) for r in checked)


def test_one_row_and_none(spark):
    row = (1, "s", None, None, "")
    made = document_manifest(spark.createDataFrame([row], SCHEMA), extra={"doc_id": F.col("doc_id")})
    only = made.proofs(["doc_id"]).collect()
    assert len(only) == 1 and only[0].digest == only[0].subroot == only[0].root and only[0].siblings == []
    empty = document_manifest(spark.createDataFrame([], SCHEMA), extra={"doc_id": F.col("doc_id")})
    assert empty.proofs(["doc_id"]).count() == 0 and empty.root().count() == 0
