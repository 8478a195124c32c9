"""Common ancestors of many taxa and root-to-leaf paths, against a version in plain Python."""

from __future__ import annotations

import random
from collections import Counter, defaultdict

import pytest

from strandwise.operators import sketches, taxonomy

#: child -> parent
TREE = {"1": None, "a": "1", "b": "1", "aa": "a", "ab": "a", "aaa": "aa", "aab": "aa", "ba": "b", "baa": "ba", "other": None}


def line(taxid: str) -> list[str]:
    out = [taxid]
    while TREE[out[-1]]:
        out.append(TREE[out[-1]])
    return out


def common(taxa) -> str | None:
    taxa = list(taxa)
    if len(set(taxa)) == 1:
        return taxa[0]
    if any(t not in TREE for t in taxa):
        return None
    return next((t for t in line(taxa[0]) if all(t in line(u) for u in taxa)), None)


@pytest.fixture(scope="module")
def closure(spark):
    from strandwise.storage import stored

    return stored(taxonomy.ancestors(spark.createDataFrame([(k, v, "S") for k, v in TREE.items()], "taxid string, parent_taxid string, rank string")))


def test_fold(spark, closure):
    rng = random.Random(2)
    rows = [(rng.choice([None, *range(40)]), rng.choice([*TREE, *TREE, "unknown", None])) for _ in range(140)] + [(100, "aaa"), (100, "aaa"), (101, "aaa"), (101, "aa"), (102, "aaa"), (102, "other"), (103, "unknown")]
    got = taxonomy.fold_to_common(spark.createDataFrame(rows, "k long, taxid string"), closure, "k")
    of = defaultdict(set)
    for k, taxid in rows:
        if taxid is not None:
            of[k].add(taxid)
    assert {r.k: r.taxid for r in got.collect()} == {k: common(v) for k, v in of.items()}
    assert got.count() == len(of)
    two = taxonomy.fold_to_common(spark.createDataFrame([("x", 1, "aaa"), ("x", 1, "ab"), ("x", 2, "b"), (None, 2, "ba"), (None, 2, "b")], "p string, q int, taxid string"), closure, ["p", "q"])
    assert {(r.p, r.q, r.taxid) for r in two.collect()} == {("x", 1, "a"), ("x", 2, "b"), (None, 2, "b")}


def test_paths_and_ties(spark, closure):
    rng = random.Random(9)
    taxa = {f"w{i}": rng.choice([t for t in TREE if t != "other"]) for i in range(30)}
    reads = {(i, f"w{rng.randrange(34)}") for i in range(60) for _ in range(rng.randrange(1, 7))} | {(100, "w99")}
    want = {}
    for i in {i for i, _ in reads}:
        hits = Counter(taxa[w] for j, w in reads if j == i and w in taxa)
        score = {t: sum(hits[u] for u in line(t)) for t in hits}
        if score:
            top = max(score.values())
            want[i] = (common(t for t, s in score.items() if s == top), top, sum(hits.values()))
    known = spark.createDataFrame(list(taxa.items()), "word string, taxid string")
    got = sketches.classify_reads(spark.createDataFrame(list(reads), "seq_id int, word string"), sketches.word_taxa(known, closure), closure)
    assert {r.seq_id: (r.taxid, r.score, r.hits) for r in got.collect()} == want
    assert len({v[0] for v in want.values()}) > 4


def test_shared_words_go_to_common_ancestors(spark, closure):
    rows = [("both", "aaa"), ("both", "aab"), ("all", "aaa"), ("all", "baa"), ("up", "aaa"), ("up", "a"), ("lost", "aaa"), ("lost", "other")]
    got = sketches.word_taxa(spark.createDataFrame(rows, "word string, taxid string"), closure)
    assert {r.word: r.taxid for r in got.collect()} == {"both": "aa", "all": "1", "up": "a"}
