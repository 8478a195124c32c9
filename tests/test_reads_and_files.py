"""Molecular words by pattern, qualities by place, mates, and files a group."""

from __future__ import annotations

import re
import statistics
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from strandwise.operators import alignments, hits, reads, taxonomy, variants
from strandwise.sources import readers, writers


def cut(spark, seq, qual, pattern):
    row = spark.createDataFrame([(seq, qual)], "seq string, qual string").select(reads.cut_pattern(F.col("seq"), F.col("qual"), pattern).alias("c")).first().c
    return tuple(row) if row else None


@pytest.mark.parametrize(("pattern", "want"), [
    ("NNN", ("ACG", "", "TTGCA", "45678")), ("NXXCC", ("A", "TT", "CGGCA", "23678")), ("NNNNNNNN", ("ACGTTGCA", "", "", "")), ("NNNNNNNNN", None),
    ("(?P<umi_1>.{2})", ("AC", "", "GTTGCA", "345678")), ("(?P<umi_1>.{2})(?P<discard_1>GT)(?P<cell_1>T|A)", ("AC", "T", "GCA", "678")),
    ("A(?P<umi_1>C(?:G|T)+)G", ("CGTT", "", "AGCA", "1678")), ("(?P<umi_1>[^T)]+)(T+)(?P<umi_2>.)", ("ACGG", "", "TTCA", "4578")), ("(?P<umi_1>G+)", None), ("(?P<umi_1>A)CGTTGCA$", ("A", "", "CGTTGCA", "2345678")),
    (r"(?P<umi_1>A\)?)", ("A", "", "CGTTGCA", "2345678")), ("[]A](?P<umi_1>.)", ("C", "", "AGTTGCA", "1345678")),
])
def test_patterns(spark, pattern, want):
    assert cut(spark, "ACGTTGCA", "12345678", pattern) == want
    if want and not re.fullmatch("[NCX]+", pattern):
        found = re.match(pattern, "ACGTTGCA")
        assert "".join(v for k, v in found.groupdict().items() if k.startswith("umi")) == want[0]


@pytest.mark.parametrize("pattern", ["A|(?P<umi_1>C)", "(A(?P<umi_1>C))", "(?P<umi_1>"])
def test_patterns_that_cannot_be_cut(pattern):
    with pytest.raises((ValueError, re.error)):
        reads.cut_pattern(F.lit("A"), F.lit("I"), pattern)


def test_mates_share_their_words_and_one_can_go(spark):
    rows = [("r1", 1, "AACCGG", "IIIIII"), ("r1", 2, "TTGGCC", "JJJJJJ"), ("r2", 1, "AA", "II"), ("r2", 2, "TTTTTT", "IIIIII"), ("r3", 2, "TTTTTT", "IIIIII"), ("r4", 1, "GGGGG", "IIIII")]
    table = spark.createDataFrame([(*r, "x", "y") for r in rows], "read_id string, mate int, seq string, qual string, umi string, cell string")
    got = {(r.read_id, r.mate, r.seq, r.umi, r.cell) for r in reads.extract_pattern(table, "NNC", "NN").collect()}
    assert got == {("r1_C_AATT", 1, "CGG", "AATT", "C"), ("r1_C_AATT", 2, "GGCC", "AATT", "C"), ("r4_G_GG", 1, "GG", "GG", "G")}
    got = {(r.read_id, r.mate, r.seq, r.qual) for r in reads.extract_pattern(table, "NNC", discard=1).collect()}
    assert got == {("r1_C_AA", 1, "TTGGCC", "JJJJJJ")}


def test_quality_and_length(spark):
    rows = [("a", "!5I"), ("a", "55"), ("a", "I"), ("a", ""), ("a", None), ("b", "I")]
    got = {(r.key, r.cycle): tuple(r)[2:] for r in reads.quality_by_cycle(spark.createDataFrame(rows, "key string, qual string"), ["key"]).collect()}
    assert got == {("a", 0): (3, 20.0, 0, 0, 20, 40, 40), ("a", 1): (2, 20.0, 20, 20, 20, 20, 20), ("a", 2): (1, 40.0, 40, 40, 40, 40, 40), ("b", 0): (1, 40.0, 40, 40, 40, 40, 40)}
    lengths = reads.length_histogram(spark.createDataFrame([("x",), ("yy",), ("zz",), ("",), (None,)], "seq string")).collect()
    assert {(r.length, r.reads) for r in lengths} == {(0, 1), (1, 1), (2, 2)}


def test_orientation_and_insert(spark):
    rows = [
        ("fr", 1 + 64, "c", 100, "10M"), ("fr", 1 + 128 + 16, "c", 150, "4M2I6M"), ("rf", 1 + 64 + 16, "c", 100, "10M"), ("rf", 1 + 128, "c", 150, "10M"), ("tandem", 1 + 64, "c", 10, "5M"), ("tandem", 1 + 128, "c", 30, "5M"),
        ("other", 1 + 64, "c", 10, "5M"), ("other", 1 + 128, "d", 30, "5M"), ("single", 1 + 64, "c", 1, "5M"), ("thrice", 1 + 64, "c", 1, "5M"), ("thrice", 1 + 64, "c", 2, "5M"), ("thrice", 1 + 128, "c", 9, "5M"), ("gone", 1 + 64 + 4, "c", 1, None), ("gone", 1 + 128, "c", 1, "5M"), ("fr", 1 + 64 + 256, "c", 7, "9M"),
    ]
    pairs = alignments.read_pairs(spark.createDataFrame(rows, "read_id string, flag int, ref string, pos long, cigar string"))
    assert {(r.read_id, r.orientation, r.insert) for r in pairs.collect()} == {("fr", "FR", 60), ("rf", "RF", 42), ("tandem", "TANDEM", 21)}
    sizes = [3, 9, 9, 12, 40, 41, 100]
    table = spark.createDataFrame([(str(i), "FR", s) for i, s in enumerate(sizes)] + [("x", "RF", 5)], "read_id string, orientation string, insert long")
    got = {r.orientation: r for r in alignments.insert_sizes(table).collect()}
    middle = statistics.median(sizes)
    assert (got["FR"].pairs, got["FR"].median, got["FR"].deviation) == (7, middle, statistics.median([abs(s - middle) for s in sizes]))
    assert abs(got["FR"].sd - statistics.stdev(sizes)) < 1e-9 and got["RF"].sd is None and got["RF"].deviation == 0


def test_best_reference_with_its_sequence(spark):
    screen = spark.createDataFrame([("s", 0.9, "5/10", "a\\b"), ("s", 0.9, "7/10", "c"), ("s", 0.8, "9/10", "d"), ("t", None, None, "e")], "sample string, identity double, `shared-hashes` string, `query-ID` string")
    assert {r["query-ID"] for r in hits.best_reference(screen).collect()} == {"c"}
    references = spark.createDataFrame([("c", "ACGT"), ("a\\b", "GG"), ("e", "TT")], "seq_id string, seq string")
    assert {(r.sample, r.seq_id, r.seq) for r in hits.best_reference_sequence(screen, references, ["sample"]).collect()} == {("s", "c", "ACGT"), ("t", "e", "TT")}
    only = screen.filter("`query-ID` = 'a\\\\b'")
    assert [(r.seq_id, r.seq) for r in hits.best_reference_sequence(only, references).collect()] == [("a-b", "GG")]
    assert hits.best_reference(screen.limit(0)).count() == 0


def test_labels_and_passing(spark):
    rows = [(1, True, 0.5, 0.9), (2, False, 0.01, 0.9), (3, True, 0.01, 0.1), (4, True, 0.5, 0.1), (5, True, 0.5, None)]
    table = variants.labelled(spark.createDataFrame(rows, "id int, passed boolean, p double, freq double"), F.col("passed"), F.col("p"))
    assert {r.id: r.filter for r in table.collect()} == {1: "PASS", 2: "ft;sb", 3: "sb", 4: "PASS", 5: "PASS"}
    assert {r.id for r in variants.passing(table, 0.5).collect()} == {1} and {r.id for r in variants.passing(table, 0.5, pass_only=False).collect()} == {1, 2}


def test_groups_in_files_of_bounded_size(spark, tmp_path):
    rows = [("hot", f"h{i}", "ACGT" * (i % 5 + 1)) for i in range(900)] + [(f"g{i % 40}", f"s{i}", "GG") for i in range(120)] + [(None, "n", "A")]
    table = spark.createDataFrame(rows, "taxid string, seq_id string, seq string")
    writers.write_fasta(table, str(tmp_path / "fasta"), by="taxid", width=7, most=100)
    sizes = defaultdict(list)
    for f in (tmp_path / "fasta").glob("taxid=*/part-*"):
        sizes[f.parent.name].append(f.read_text().count(">"))
    assert all(len(v) == 1 for k, v in sizes.items() if k != "taxid=hot") and 9 <= len(sizes["taxid=hot"]) <= 16 and max(sizes["taxid=hot"]) <= 100
    back = readers.read_fasta(spark, str(tmp_path / "fasta" / "*")).select(F.regexp_extract("file", "taxid=([^/]+)", 1).alias("t"), "seq_id", "seq")
    assert {tuple(r) for r in back.collect()} == {(t or "__HIVE_DEFAULT_PARTITION__", i, s) for t, i, s in rows}
    clusters = spark.createDataFrame([("s1", i % 3, f"c{i}", ["a", "b"]) for i in range(30)], "sample string, cluster int, centroid string, members array<string>")
    writers.write_cluster_json(clusters, str(tmp_path / "json"), by=["sample", "cluster"])
    back = spark.read.json(str(tmp_path / "json"))
    assert {(r.sample, r.cluster, r.centroid, tuple(r.members)) for r in back.collect()} == {tuple([*r[:3], tuple(r[3])]) for r in clusters.collect()}


def test_sequences_a_taxon(spark):
    report = spark.createDataFrame([("a", "t1"), ("b", "t1"), ("c", "t2")], "name string, resolved string")
    got = taxonomy.taxon_sequences(report, spark.createDataFrame([("a", "AC"), ("b", "GG"), ("x", "T")], "seq_id string, seq string"))
    assert {tuple(r) for r in got.collect()} == {("t1", "a", "AC"), ("t1", "b", "GG")}
