"""The parity-sketch join against all pairs, its bounds, and odd tables."""

from __future__ import annotations

import random
import re

import numpy as np
import pytest

from strandwise.llm import parity_join

SCHEMA = "doc_id long, text string, band int, word string"


def shingles(text: str | None, width: int) -> frozenset:
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lower)
    return frozenset(tuple(words[i : i + width]) for i in range(max(1, len(words) - width + 1))) if words else frozenset()


def brute(rows: list[tuple], width: int = 4, percent: int = 85) -> list[tuple]:
    """(doc_id, n_shingles, component_id) by comparing every pair of rows."""
    sets = [shingles(text, width) for _, text, *_ in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            same = rows[i][0] == rows[j][0]
            if a and b and rows[i][0] is not None and rows[j][0] is not None and (same or 100 * len(a & b) >= percent * len(a | b)):
                root[find(i)] = find(j)
    least: dict[int, int] = {}
    for i, (doc, *_) in enumerate(rows):
        if doc is not None:
            least[find(i)] = min(least.get(find(i), doc), doc)
    return sorted(((doc, len(sets[i]), None if doc is None else least[find(i)]) for i, (doc, *_) in enumerate(rows)), key=repr)


def result(df) -> list[tuple]:
    return sorted((tuple(r[c] for c in ("doc_id", "n_shingles", "component_id")) for r in df.collect()), key=repr)


def edited(rng: random.Random, words: list[str], n: int) -> str:
    words = list(words)
    for _ in range(n):
        words[rng.randrange(len(words))] = f"new{rng.randrange(10**6)}"
    return " ".join(words)


def test_whole_small_table(spark):
    table = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    rows = [tuple(r) for r in table.collect()]
    assert result(parity_join.similar_groups(table)) == brute(rows)


@pytest.mark.parametrize("percent", [60, 85, 95])
def test_edited_copies_of_all_sizes(spark, percent):
    rng = random.Random(percent)
    rows = []
    for size in (1, 3, 4, 5, 9, 12, 20, 33, 60, 150, 400):
        base = [f"w{rng.randrange(500)}" for _ in range(size)]
        for n in [0, 0, *(int(size * f) for f in (0.005, 0.01, 0.02, 0.03, 0.05, 0.1))]:
            rows.append((len(rows), edited(rng, base, n), 1, "x"))
        rows.append((len(rows), " ".join(base[: int(size * percent / 100) + 1]), 1, "x"))
    table = spark.createDataFrame(rows, SCHEMA).repartition(4)
    assert result(parity_join.similar_groups(table, percent=percent)) == brute(rows, percent=percent)


def test_large_groups_and_shared_passages(spark, monkeypatch):
    """Hundreds of near copies, and as many texts that only share a passage; blocks of a few members."""
    monkeypatch.setattr(parity_join, "BLOCK", 16)
    rng = random.Random(8)
    base, passage = [f"b{i}" for i in range(80)], [f"p{i}" for i in range(40)]
    rows = [(i, edited(rng, base, rng.randrange(3)), 0, "") for i in range(150)]
    rows += [(1000 + i, " ".join([f"o{rng.randrange(10**6)}" for _ in range(20)] + passage), 0, "") for i in range(120)]
    assert result(parity_join.similar_groups(spark.createDataFrame(rows, SCHEMA).repartition(4))) == brute(rows)


def test_odd_rows(spark):
    rows = [(1, None, 0, ""), (2, "", 0, ""), (3, " \t\n", 0, ""), (None, "same words are here now", 0, ""), (4, "Same words ARE here now", 0, ""), (5, "same words are here now", 0, None), (5, "same words are here now", 0, ""), (6, "alone", 0, ""), (7, "alone", 0, ""), (7, "quite another text of words", 0, ""), (8, "quite another text of words", 0, ""), (-9, "École École", 0, ""), (10, "école école", 0, "")]
    rows += [(20, "long " * 5000 + " ".join(f"x{i}" for i in range(3000)), 0, ""), (21, " ".join(f"x{i}" for i in range(2990)), 0, "")]
    table = spark.createDataFrame(rows, SCHEMA)
    assert result(parity_join.similar_groups(table)) == brute(rows)
    assert parity_join.similar_groups(table.limit(0)).count() == 0


@pytest.mark.parametrize("percent", [70, 85])
def test_bounds_hold_and_linked_sets_share_a_posting(percent):
    rng = np.random.default_rng(percent)
    for size in (2, 5, 6, 7, 8, 10, 15, 16, 40, 100, 333, 1000, 5000):
        for _ in range(20):
            a = np.unique(rng.integers(0, 2**63, size).astype(np.uint64))
            b = np.unique(np.concatenate([rng.permutation(a)[rng.integers(0, max(1, size // 8)) :], rng.integers(0, 2**63, rng.integers(0, max(1, size // 8))).astype(np.uint64)]))
            both, apart = len(np.intersect1d(a, b)), len(np.setxor1d(a, b))
            linked = 100 * both >= percent * (len(a) + len(b) - both)
            assert not linked or apart <= parity_join.allowed(np.array(len(a)), np.array(len(b)), percent)
            band = parity_join.bands_of(min(len(a), len(b)), percent)[-1]
            if not linked or not apart:
                continue
            assert band in parity_join.bands_of(max(len(a), len(b)), percent)
            k, parts = (int(x[band]) for x in parity_join.layouts(percent)[1:])
            (va, wa), (vb, wb) = parity_join.parity(a, band, parts), parity_join.parity(b, band, parts)
            assert np.bitwise_count(wa ^ wb).sum() <= apart and (va != vb).sum() <= apart <= k
            shared = np.intersect1d(parity_join.posted(va, wa, k), parity_join.posted(vb, wb, k))
            assert (va[shared] == vb[shared]).any()
