"""Running values by ranges against plain windows, where one key fills many ranges."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from strandwise.operators import intervals, scan
from strandwise.sources import readers


@pytest.fixture
def hot(spark):
    rng = random.Random(5)
    rows = [("hot" if i % 3 else rng.choice(["a", "b", None]), i * 7 % 1000, rng.choice([None, i % 11, i]), i) for i in range(1000)]
    return spark.createDataFrame(rows, "key string, at int, v long, id long")


@pytest.mark.parametrize("before", [False, True])
def test_equals_windows(spark, hot, before):
    spark.conf.set("spark.sql.shuffle.partitions", "9")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        ranges = scan.dealt(hot, ["key"], ["at", "id"])
        assert ranges.filter("key = 'hot'").select("_range").distinct().count() > 4
        got = scan.running(ranges, ["key"], ["at", "id"], {kind: (kind, F.col("v")) for kind in scan.KINDS}, before).drop("_range")
        w = Window.partitionBy("key").orderBy("at", "id").rowsBetween(Window.unboundedPreceding, -1 if before else 0)
        want = hot.select("*", *[scan.KINDS[kind][0](F.col("v")).over(w).alias(kind) for kind in scan.KINDS])
        assert sorted(got.collect(), key=lambda r: r.id) == sorted(want.collect(), key=lambda r: r.id)
        assert scan.running(scan.dealt(hot.limit(0), ["key"], ["at"]), ["key"], ["at"], {"n": ("sum", F.col("v"))}).count() == 0
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def _naive_merge(rows, gap):
    out = []
    for s, e in sorted(rows):
        if out and s <= out[-1][1] + gap:
            out[-1] = (out[-1][0], max(out[-1][1], e), out[-1][2] + 1)
        else:
            out.append((s, e, 1))
    return sorted(out)


@pytest.mark.parametrize("gap", [0, 3])
def test_intervals_of_one_key(spark, gap):
    rng = random.Random(gap)
    rows = [(s, s + rng.choice([0, 1, 2, 40])) for s in (rng.randrange(4000) for _ in range(1500))]
    table = spark.createDataFrame([("c", s, e) for s, e in rows], "chrom string, start long, end long")
    got = intervals.merge_intervals(table, ["chrom"], gap).collect()
    assert sorted((r.start, r.end, r.n) for r in got) == _naive_merge(rows, gap)
    places = sorted({s for s, _ in rows})
    runs = [(a, b) for a, b, _ in _naive_merge([(p, p) for p in places], 1)]
    got = intervals.runs(table.withColumn("pos", F.col("start")), ["chrom"]).collect()
    assert sorted((r.start, r.end) for r in got) == runs


def test_headers_far_above_their_lines(spark, tmp_path):
    lines = []
    for c in range(5):
        lines += [f">Cluster {c}"] + [f"{i}\t100aa, >n{c}_{i}... {'*' if i == 0 else 'at 90%'}" for i in range(400)]
    (tmp_path / "x.clstr").write_text("\n".join(lines) + "\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        rows = readers.read_cdhit(spark, str(tmp_path / "x.clstr")).collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert sorted((r.cluster, r.member, r.is_centroid) for r in rows) == sorted((c, f"n{c}_{i}", i == 0) for c in range(5) for i in range(400))
