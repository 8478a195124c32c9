"""Queries take whole tables: small tables on which a part would give other rows."""

from __future__ import annotations

import math
from collections import Counter

import duckdb
import numpy as np
from pyspark.sql import functions as F

from strandwise import table_queries
from strandwise.operators import alignments, graph, reads, sketches


def test_trim_reads_takes_long_texts(spark, tmp_path):
    rows = [(1, "word " * 1000), (2, None), (3, "word " * 20)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    assert {r.doc_id: len(r.seq) for r in table_queries.QUERIES["trim_reads"](spark, str(tmp_path)).collect()} == {1: 5000, 3: 100}


def test_complexity_filter_sees_windows(spark, tmp_path):
    prose = " ".join(str(i * i * 7919) for i in range(300))
    texts = [prose, prose[:900] + "a" * 60 + prose[900:], "acgt" * 40, prose[:20], "", None, prose[:300] + "ab" * 12 + prose[300:600], "\U0001f600" * 80 + prose]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")

    def brute(text):
        windows = [text[i : i + 50] for i in range(max(1, len(text) - 49))]
        found = []
        for w in windows:
            n = len(w) - 2
            counts = Counter(w[i : i + 3] for i in range(n))
            entropy = -sum(c / n * math.log2(c / n) for c in counts.values()) / math.log2(min(n, 64)) if n > 1 else 0.0
            found.append((entropy, sum(c * (c - 1) for c in counts.values()) / (n * (n - 1)) if n > 1 else 0.0))
        return min(e for e, _ in found), max(s for _, s in found)

    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: r.c for r in docs.select("doc_id", reads.low_complexity(F.col("text")).alias("c")).collect()}
    for i, text in enumerate(texts):
        entropy, score = brute(text or "")
        assert abs(got[i].entropy - entropy) < 1e-9 and abs(got[i].dust - score) < 1e-9 and got[i].low == (entropy < 0.3 or score > 0.20)
    assert [got[i].low for i in (0, 1, 2, 7)] == [False, True, True, True]
    assert {r.doc_id for r in table_queries.QUERIES["complexity_filter"](spark, str(tmp_path)).collect()} == {i for i in got if not got[i].low}


def test_components_keep_all_edges(spark):
    rng = np.random.default_rng(3)
    rows = [(i, int(rng.integers(0, 40)), float(rng.integers(-1000, 10000)) + float(rng.choice([0, 0.5]))) for i in range(240)] + [(240, 99, 5.0), (241, 99, 4005.0), (242, 99, 8004.99), (243, 99, 5.0)]
    root = list(range(len(rows)))
    for a, ka, va in rows:
        for b, kb, vb in rows:
            if ka == kb and abs(va - vb) < 4000:
                low, high = sorted((root[a], root[b]))
                root = [low if r == high else r for r in root]
    df = spark.createDataFrame(rows, "id long, k long, v double")
    got = {r.id: r.component for r in graph.connected_components(df, graph.near_values(df, "k", "v", 4000)).collect()}
    assert got == dict(enumerate(root))
    assert got[240] == got[243] != got[241] == got[242]


def test_cluster_sequences_takes_documents(spark, tmp_path):
    rng = np.random.default_rng(8)
    texts = [" ".join(f"w{x}" for x in rng.integers(0, 10_000, 60)) for _ in range(20)]
    texts += [f"{t} and a tail" for t in texts[:10]] + [None, "", "one two"]
    spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    grams = [{tuple(w[i : i + 3]) for i in range(len(w) - 2)} for w in ((t or "").split() for t in texts)]
    brute = {}
    for i, own in enumerate(grams):
        holds = [j for j, other in enumerate(grams) if own and j != i and len(texts[j] or "") > len(texts[i]) and len(own & other) >= 0.85 * len(own)]
        brute[i] = max(holds, key=lambda j: len(texts[j]), default=i)
    assert {r.seq_id: r.centroid for r in table_queries.QUERIES["cluster_sequences"](spark, str(tmp_path)).collect()} == brute
    assert sum(i != c for i, c in brute.items()) == 10


def test_passing_variants_at_the_least_mean(spark, tmp_path):
    """Discounts of mean 0.05 in decimals; as doubles they are a little less, whatever tasks their sum is split over."""
    rows = [(1, i * 7 % 11 / 100, "N", "O") for i in range(605)] + [(2, 0.05, "N", "O"), (3, 0.049, "N", "O"), (3, 0.052, "N", "O"), (4, None, "N", "O")]
    table, got = spark.createDataFrame(rows, "l_suppkey long, l_discount double, l_returnflag string, l_linestatus string"), {}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1k")
    spark.conf.set("spark.sql.files.openCostInBytes", "1k")
    try:
        for n in (1, 2, 16, 24):
            table.repartition(n).write.parquet(f"{tmp_path}/{n}/lineitem.parquet")
            got[n] = sorted(r.l_suppkey for r in table_queries.QUERIES["passing_variants"](spark, f"{tmp_path}/{n}").collect())
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert got == dict.fromkeys(got, [2, 3])


def test_refine_rounds_by_pieces(spark, tmp_path):
    """Texts over several pieces, two rows of one read, reads and roles without a number; rows of the query's own SQL."""
    rng = np.random.default_rng(4)
    base = "".join(rng.choice(list("ACGTn \U0001f600"), 13_000))
    rows = [(i, 0, "user" if i % 3 else "system", base[: 300 * i + 1] if i % 4 else base[i : 4096 * (i % 3 + 1) + i].lower()) for i in range(44)]
    rows += [(50, 0, "user", "ACGT" * 3000), (50, 0, "user", base[:9000]), (51, None, "user", base), (52, 1, None, base[:40]), (53, 0, "user", None), (54, 0, "user", "")]
    spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").write.parquet(f"{tmp_path}/conversations.parquet")
    got = {(r.key, r.step): r.seq for r in table_queries.QUERIES["refine_rounds"](spark, str(tmp_path)).collect()}
    duck = duckdb.connect()
    duck.execute(f"CREATE VIEW conversations AS SELECT * FROM '{tmp_path}/conversations.parquet/*.parquet'")
    want = {(key, step): seq for key, step, seq in duck.execute(table_queries.SQL["refine_rounds"]).fetchall()}
    assert {k: len(s) for k, s in got.items()} == {k: len(s) for k, s in want.items()} and got == want
    turns = spark.createDataFrame([("k", i, base[: 100 * i]) for i in range(1, 90)], "key string, read long, seq string")
    current = spark.createDataFrame(alignments.first_letters(turns).collect(), "key string, seq string")
    few = alignments.agreeing(turns, current, tenths=10, small=100)
    assert "Broadcast" not in few._jdf.queryExecution().executedPlan().toString()
    assert few.count() == alignments.agreeing(turns, current, tenths=10).count() == 89


def test_cluster_sequences_of_a_hot_centre(spark):
    """Many near copies of one sequence go to several tasks, as sets of a row each; words that come twice count once."""
    base = [f"w{i}" for i in range(100)]
    own = {0: [*base, "long"]} | {k: [w for i, w in enumerate(base) if i % 90 != k] for k in range(1, 41)} | {90: ["other", "words"]}
    of = spark.createDataFrame([(k, w) for k, v in own.items() for w in v + v[:3]], "seq_id long, word string")
    lengths = spark.createDataFrame([(k, len(v)) for k, v in own.items()], "seq_id long, length int")
    for block in (2, 1024):
        got = {r.seq_id: r.centroid for r in sketches.cluster_sequences(of, lengths, block=block).collect()}
        assert got == {k: 90 if k == 90 else 0 for k in own}
