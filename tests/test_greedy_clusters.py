"""Greedy clusters by held words against a sequential version."""

from __future__ import annotations

import random

import pytest

from strandwise.operators import scan, sketches


def brute(sets: dict[int, set], length: dict[int, int], share: float) -> dict[int, int]:
    centres, out = [], {}
    for k in sorted(length, key=lambda k: (-length[k], k)):
        own = sets.get(k, set())
        out[k] = next((c for c in centres if own and len(own & sets.get(c, set())) >= share * len(own)), k)
        if out[k] == k:
            centres.append(k)
    return out


@pytest.mark.parametrize(("share", "first"), [(0.85, 8), (0.85, 1), (0.5, 2), (1.0, 1)])
def test_against_sequential(spark, share, first):
    rng = random.Random(int(share * 100) + first)
    bases = [[f"{b}w{i}" for i in range(40)] for b in range(4)]
    sets = {}
    for k in range(160):
        if k % 3 == 0:
            base = rng.choice(bases)
            own = set(rng.sample(base, rng.randrange(3, 40))) | {f"own{k}_{i}" for i in range(rng.randrange(3))}
        else:
            own = {f"c{rng.randrange(60)}" for _ in range(rng.randrange(1, 9))} | {"the"}
        sets[k] = own
    sets |= {200 + i: set(bases[0]) for i in range(12)} | {300 + i: set(bases[1]) - {bases[1][i % 6]} | {f"z{i}"} for i in range(60)}
    length = {k: len(v) + rng.randrange(3) for k, v in sets.items()} | {900: 50, 901: 0}
    of = spark.createDataFrame([(k, w) for k, v in sets.items() for w in v for _ in range(2)], "seq_id long, word string")
    got = sketches.greedy_clusters(of, spark.createDataFrame(list(length.items()), "seq_id long, length int"), share, first=first).collect()
    assert {r.seq_id: r.centroid for r in got} == brute(sets, length, share) and len(got) == len(length)


def test_empty(spark):
    got = sketches.greedy_clusters(spark.createDataFrame([], "seq_id long, word string"), spark.createDataFrame([(1, 3)], "seq_id long, length int"))
    assert [tuple(r) for r in got.collect()] == [(1, 1)]


def test_words_of_one_sequence_are_not_dealt(spark, monkeypatch):
    sets, seen = {k: {f"own{k}_{i}" for i in range(50 if k < 8 else 1)} | {f"c{i}" for i in range(9)} for k in range(16)}, []
    monkeypatch.setattr(sketches, "dealt", lambda rows, *by: seen.append(rows.count()) or scan.dealt(rows, *by))
    of = spark.createDataFrame([(k, w) for k, v in sets.items() for w in v], "seq_id long, word string")
    length = {k: len(v) for k, v in sets.items()}
    got = sketches.greedy_clusters(of, spark.createDataFrame(list(length.items()), "seq_id long, length int")).collect()
    assert {r.seq_id: r.centroid for r in got} == brute(sets, length, 0.85) and seen == [16 * 9]
