"""The prefix trie against its SQL and a recursive version, contraction of long chains, and odd tables."""

from __future__ import annotations

import hashlib
import math
import random
import zlib
from collections import defaultdict

import duckdb
import pytest

from strandwise.llm import prefix_trie

SCHEMA = "conv_id long, turn long, role string, text string, id string, place int"
COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def brute(rows: list[tuple]) -> list[tuple]:
    own = defaultdict(list)
    for conv, turn, role, text, *_ in rows:
        if conv is not None:
            own[conv].append((turn is not None, turn or 0, role or "", text or ""))
    turns = {c: [(r, t) for *_, r, t in sorted(v)] for c, v in own.items()}
    members, ends = defaultdict(list), defaultdict(list)
    for c in turns:
        h = zlib.crc32(str(c).encode()) % 6
        base = c - int(math.fmod(c, 100))  # the remainder has the sign of the id, as in SQL
        built = tuple(turns.get(base, [])[:h] + turns[c][h:])
        for d in range(len(built) + 1):
            members[built[:d]].append(c)
        ends[built].append(c)
    kids = defaultdict(list)
    for node in members:
        if node:
            kids[node[:-1]].append(node)
    leaves, saved = {}, {}
    for node in sorted(members, key=len, reverse=True):
        leaves[node] = sum(leaves[k] for k in kids[node]) or 1
        saved[node] = (len(members[node]) - 1) * (len(node[-1][1]) if node else 0) + sum(saved[k] for k in kids[node])
    digest = lambda node: hashlib.sha256(",".join(map(str, sorted(ends[node]))).encode()).hexdigest()
    return sorted(((min(m), len(n), min(members[n[:-1]]) if n else None, len(m), len(kids[n]), leaves[n], saved[n], digest(n)) for n, m in members.items()), key=repr)


def result(df) -> list[tuple]:
    return sorted((tuple(r[c] for c in COLUMNS) for r in df.collect()), key=repr)


def test_sql_and_brute_force_on_the_table(spark):
    path = "/root/testdata/sf0.001/conversations.parquet"
    table = spark.read.parquet(path)
    want = brute([tuple(r) for r in table.select("conv_id", "turn", "role", "text").collect()])
    assert result(prefix_trie.prefix_trie(table)) == want
    with duckdb.connect() as c:
        c.execute(f"CREATE VIEW conversations AS SELECT * FROM '{path}'")
        rows = c.execute(f"SELECT {', '.join(COLUMNS)} FROM ({prefix_trie.TRIE_SQL})").fetchall()
    assert sorted(rows, key=repr) == want


def test_odd_rows(spark):
    rng = random.Random(3)
    rows = [(rng.choice([0, 5, 7, 100, 101, 164, 205, 250, 399, -3, None]), rng.choice([None, 0, 1, 1, 2, 9]), rng.choice([None, "", "user", "bot"]), rng.choice([None, "", "hi", "hi", "yo 漢🙂"]), "x", 1) for _ in range(160)]
    rows += [(600 + i, 0, "user", "same", None, None) for i in range(12)] + [(700, None, None, None, None, None)]
    table = spark.createDataFrame(rows, SCHEMA).repartition(5)
    assert result(prefix_trie.prefix_trie(table)) == brute(rows)
    assert prefix_trie.prefix_trie(table.limit(0)).count() == 0


def test_one_long_conversation_and_many_copies(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "PIECE", 40)
    rows = [(1, t, "user", f"turn {t % 7}", "", 0) for t in range(300)]
    rows += [(c, t, "user", f"text {t}", "", 0) for c in range(2000, 2100) for t in range(4)]
    assert result(prefix_trie.prefix_trie(spark.createDataFrame(rows, SCHEMA))) == brute(rows)


@pytest.mark.parametrize("shape", ["chain", "star", "random", "caterpillar", "one"])
def test_contraction(spark, shape):
    rng = random.Random(shape)
    n = {"chain": 200, "one": 1}.get(shape, 150)
    above = {"chain": lambda i: i - 1, "star": lambda i: 0, "random": lambda i: rng.randrange(i), "caterpillar": lambda i: i - 1 if i % 2 else max(0, i - 2), "one": None}[shape]
    parent = [None] + [above(i) for i in range(1, n)]
    value = [rng.randrange(10) for _ in range(n)]
    total = list(value)
    for i in range(n - 1, 0, -1):
        total[parent[i]] += total[i]
    nodes = spark.createDataFrame([(i, parent[i], value[i], 1) for i in range(n)], "id long, parent long, v long, one long")
    got = {r.id: (r.v, r.one) for r in prefix_trie.subtree_totals(nodes, ["v", "one"]).collect()}
    assert {i: v for i, (v, _) in got.items()} == dict(enumerate(total)) and got[0][1] == n


def test_cycles_are_an_error(spark):
    nodes = spark.createDataFrame([(0, None, 1), (1, 2, 1), (2, 1, 1)], "id long, parent long, v long")
    with pytest.raises(RuntimeError, match="not contracted"):
        prefix_trie.subtree_totals(nodes, ["v"], rounds=3)
