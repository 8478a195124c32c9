"""Distances between all sketches, dealt over block pairs."""

from __future__ import annotations

import math
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from strandwise.operators import sketches


def made(n: int) -> dict[int, frozenset]:
    rng = random.Random(n)
    own = {i: frozenset([7, *(rng.randrange(100, 100 + n) for _ in range(5))]) for i in range(n)}  # 7 is in every sketch
    return own | {n + i: own[i % 3] for i in range(20)} | {2 * n: frozenset([5])}


@pytest.mark.parametrize(("n", "block"), [(40, 512), (300, 8), (300, 50)])
def test_every_pair_once(spark, n, block):
    own = made(n)
    table = spark.createDataFrame([(k, h) for k, v in own.items() for h in v], "seq_id long, h long")
    classes, members = sketches.sketch_classes(table)
    got = sketches.block_pairs(classes, 3, block=block).collect()
    least = {}
    for k in sorted(own):
        least.setdefault(own[k], k)
    assert {r.seq_id: r.representative for r in members.collect()} == {k: least[v] for k, v in own.items()}
    reps = sorted(least.values())
    want = {(a, b): len(own[a] & own[b]) for a in reps for b in reps if a > b and own[a] & own[b]}
    assert Counter((r.a, r.b) for r in got) == Counter(dict.fromkeys(want, 1))
    for r in got:
        j = want[r.a, r.b] / len(own[r.a] | own[r.b])
        assert r.shared == want[r.a, r.b] and math.isclose(r.jaccard, j) and math.isclose(r.distance, max(0, -math.log(2 * j / (1 + j)) / 3), abs_tol=1e-12)


def test_no_task_holds_a_hot_hash(spark):
    """One word in every document: the keys of the join are pairs of blocks, none of them much over a block."""
    own = made(300)
    classes, _ = sketches.sketch_classes(spark.createDataFrame([(k, h) for k, v in own.items() for h in v], "seq_id long, h long"))
    plan = sketches.block_pairs(classes, 3, block=30)
    assert plan.count() > 40_000
    blocks = math.ceil(300 / 30)
    own_block = F.pmod(F.xxhash64("seq_id"), F.lit(blocks))
    assert classes.groupBy(own_block).count().agg(F.max("count")).first()[0] < 3 * 30


def test_sketches_are_cut_before_the_shuffle(spark):
    """One exchange, of ranked rows; hashes that come twice count once."""
    of = spark.createDataFrame([(k, f"w{k * i % 97}") for k in range(1, 6) for i in range(200)], "seq_id long, word string")
    cut = sketches.sketch(of, 7)
    assert cut._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 1
    all_of = of.select("seq_id", sketches.portable_hash(F.col("word")).alias("h")).distinct().collect()
    want = {(k, h) for k in range(1, 6) for h in sorted(r.h for r in all_of if r.seq_id == k)[:7]}
    assert Counter((r.seq_id, r.h) for r in cut.collect()) == Counter(dict.fromkeys(want, 1))
