"""Operators that the other tests leave out, and faults that were found in them."""

from __future__ import annotations

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from strandwise.operators import alignments, clusters, flow, graph, hits, intervals, reads, report, sheets, sketches, taxonomy, variants
from strandwise.sources import readers, writers


def rows(df, *columns):
    return sorted(tuple(r) for r in (df.select(*columns) if columns else df).collect())


def brute_groups(words):
    """Words by falling number, each taking what it reaches and nobody took before."""
    n = Counter(words)
    order, group = sorted(n, key=lambda w: (-n[w], w)), {}
    for root in order:
        todo = [] if root in group else [root]
        while todo:
            w = todo.pop()
            if w not in group:
                group[w] = root
                todo += [x for x in order if x not in group and len(x) == len(w) and sum(a != b for a, b in zip(x, w, strict=True)) == 1 and n[w] >= 2 * n[x] - 1]
    out = Counter()
    for w, k in n.items():
        out[group[w]] += k
    return sorted(out.items())


def test_directional_groups(spark):
    rng = random.Random(4)
    cases = [["AAAA"] * 10 + ["TTAA"] * 10 + ["TAAA"] * 2, ["A"], [], ["".join(rng.choice("AC") for _ in range(5)) for _ in range(60)], ["".join(rng.choices("ACG", (8, 2, 1), k=6)) for _ in range(300)]]
    for words in cases:
        df = spark.createDataFrame([(w,) for w in words], "umi string")
        assert rows(reads.umi_representatives(reads.dedup_umi(df)), "umi", "reads") == brute_groups(words)
    assert rows(reads.umi_representatives(reads.dedup_umi(spark.createDataFrame([(w,) for w in cases[0]], "umi string"), method="cluster")), "reads") == [(22,)]


def test_centres_are_no_members(spark):
    """c holds most of its words in b, b in a, c too few in a: c founds a cluster, as b is no centre."""
    words = {"a": range(100), "b": range(12, 100), "c": [*range(30, 90), *range(200, 212)]}
    words = {k: [f"w{x}" for x in v] for k, v in words.items()}
    words["b"] += [f"w{x}" for x in range(200, 212)]
    df = spark.createDataFrame([(k, w) for k, v in words.items() for w in v], "seq_id string, word string")
    lengths = spark.createDataFrame([("a", 1000), ("b", 900), ("c", 800)], "seq_id string, length int")
    found = dict(rows(sketches.cluster_sequences(df, lengths, 0.85, 100)))
    assert found["a"] == found["b"] == "a" and found["c"] == "c"
    assert all(found[c] == c for c in found.values())


def test_readers(spark, tmp_path):
    p = lambda name, text: (tmp_path / name).write_text(text) and str(tmp_path / name)
    fasta = p("a.fa", ">x a->b > c\r\nAC\r\nGT\r\n>y\nNN")
    assert rows(readers.read_fasta(spark, fasta), "seq_id", "description", "seq") == [("x", "x a->b > c", "ACGT"), ("y", "y", "NN")]
    hit = p("h.tsv", "".join(f"q{i}\ts\ta \"title\t90\t1\t2\t3\t0\t0\t1\t2\t1\t2\t0.1\t50\n" for i in range(3)))
    assert [r.title for r in readers.read_hits(spark, hit).collect()] == ['a "title'] * 3
    mm = p("m.tsv", "a\ta\na\tb\nc\tc\n")
    assert rows(readers.read_mmseqs_members(spark, mm), "cluster", "member", "is_centroid") == [(0, "a", True), (0, "b", False), (1, "c", True)]
    uc = p("u.uc", "S\t0\t9\t*\t*\t*\t*\t*\ta\t*\nH\t0\t8\t99\t+\t0\t0\t=\tb\ta\nC\t0\t2\t*\t*\t*\t*\t*\ta\t*\n")
    assert rows(readers.read_uc(spark, uc), "cluster", "member", "is_centroid") == [(0, "a", True), (0, "b", False)]
    screen = p("s.tsv", "0.9\t9/10\t2\t0.01\tref\ta \"b\n")
    assert readers.read_screen(spark, screen).first()["query-comment"] == 'a "b'
    sam = p("x.sam", "@HD\tVN:1\nr1\t0\tc\t5\t60\t2M\t*\t0\t0\tAC\tI\"\n")
    assert rows(readers.read_sam(spark, sam), "read_id", "pos", "qual") == [("r1", 5, 'I"')]
    pile = p("p.txt", 'c\t1\tA\t2\t.,\t"I\n')
    assert rows(readers.read_mpileup(spark, pile), "pos", "bases", "quals") == [(1, ".,", '"I')]
    (tmp_path / "j").mkdir()
    (tmp_path / "j" / "one.json").write_text('{"n": 1}')
    (tmp_path / "j" / "two.json").write_text('{"n": 2, "id": "own"}')
    assert rows(readers.read_json_records(spark, str(tmp_path / "j")), "id", "n") == [("one", 1), ("own", 2)]
    writers.write_cluster_json(spark.createDataFrame([("s1", 0, "a")], "sample string, cluster int, centroid string"), str(tmp_path / "out"))
    assert spark.read.json(str(tmp_path / "out/sample=s1")).first().centroid == "a"


def test_fastq_over_many_splits(spark, tmp_path):
    text = {f"s{k}_R1": [f"@r{i}/1\n{'ACGT' * (i % 7)}\n+\n{'@III' * (i % 7)}\n" for i in range(400 + k)] for k in range(3)}
    for name, records in text.items():
        (tmp_path / f"{name}.fastq").write_text("".join(records))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes"), spark.conf.get("spark.sql.files.openCostInBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1500")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        got = rows(readers.read_fastq(spark, str(tmp_path)), "sample", "read_id", "seq", "qual")
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before[0])
        spark.conf.set("spark.sql.files.openCostInBytes", before[1])
    assert got == sorted((f"s{k}", f"r{i}", "ACGT" * (i % 7), "@III" * (i % 7)) for k in range(3) for i in range(400 + k))


def test_numbers_run_on_over_ranges(spark):
    keys = spark.createDataFrame([(x % 50, f"k{x}") for x in range(300)], "a int, b string").repartition(7)
    assert [r.n for r in graph.numbered(keys, ["a", "b"], "n").orderBy("a", "b").collect()] == list(range(300))
    members = spark.createDataFrame([(f"f{x % 3}", x % 5) for x in range(40)], "file string, cluster int")
    names = {(r.file, r.cluster): r.cluster_id for r in clusters.renumber(members, ["file", "cluster"]).collect()}
    assert [names[k] for k in sorted(names)] == [f"cl{i}" for i in range(15)]


def test_taxa_and_reports(spark):
    samples, by_taxon = taxonomy.taxa_counts(spark.createDataFrame([("s", "1"), ("s", "1"), ("s", "2"), ("t", None)], "sample string, taxid string"))
    assert rows(samples) == [("s", 2), ("t", 0)] and rows(by_taxon) == [("s", "1", 2), ("s", "2", 1)]
    reports = spark.createDataFrame([("a", "unclassified", 5), ("a", "root", 9), ("b", "root", 3)], "file string, name string, clade_reads long")
    assert rows(taxonomy.unclassified_reads(reports)) == [("a", 5), ("b", 0)]
    assert rows(taxonomy.mismatched_names(*[spark.createDataFrame([(x,) for x in names], "name string") for names in ("ab", "bc")])) == [("a",), ("c",)]
    of = spark.createDataFrame([("x", "w1"), ("x", "w2"), ("x", "w3"), ("y", "w3")], "seq_id string, word string")
    taxa = spark.createDataFrame([("w1", "31"), ("w2", "20"), ("w3", "32")], "word string, taxid string")
    tree = spark.createDataFrame([("1", None, "R"), ("20", "1", "G"), ("31", "20", "S"), ("32", "20", "S")], "taxid string, parent_taxid string, rank string")
    assert rows(sketches.classify_words(of, taxa, taxonomy.ancestors(tree))) == [("x", "31", 2), ("y", "32", 1)]


def test_deep_trees(spark):
    chain = spark.createDataFrame([(str(i), str(i - 1) if i else None) for i in range(40)], "taxid string, parent_taxid string")
    up = taxonomy.ancestors(chain)
    assert rows(up.filter("taxid = '39'"), "depth") == [(i,) for i in range(40)] and up.count() == 40 * 41 // 2
    with pytest.raises(RuntimeError):
        taxonomy.ancestors(spark.createDataFrame([("a", "b"), ("b", "a")], "taxid string, parent_taxid string"), rounds=3)


def test_names_and_ids(spark):
    records = spark.createDataFrame([("s", "a", "a b", "AC")], "sample string, seq_id string, description string, seq string")
    assert rows(flow.rename_records(records, "sample", "it1")) == [("s", "s_it1", "s_it1", "AC")] and rows(flow.rename_records(records, "sample"), "seq_id") == [("s",)]
    own = flow.constraint_ids(spark.createDataFrame([("s", "m")], "sample string, mapping_id string")).first()
    assert (own.id, own.cluster_id, own.step, own.is_constraint, own.iteration, own.previous_step) == ("s_m-CONSTRAINT", "m", "constraint", True, "variant-calling", "constraint")
    genomes = spark.createDataFrame([("a", "4", None), ("b", "1", True), ("c", "1", False), ("d", None, None)], "id string, iteration string, is_constraint boolean")
    assert rows(report.final_genomes(genomes, 4), "id") == [("a",), ("b",)]
    assert [r[0] for r in spark.createDataFrame([("x_taxid12_y",), ("x",)], "f string").select(clusters.taxid_from_file(F.col("f"))).collect()] == ["12", ""]
    _, bad = sheets.validate_samples(spark.createDataFrame([("ok", "a.fastq.gz", ""), ("b d", "b.fq.gz", None), ("c", "c.txt", "")], "sample string, fastq_1 string, fastq_2 string"))
    assert rows(bad, "sample") == [("b d",), ("c",)]


def test_columns(spark):
    df = spark.createDataFrame([(1, 2, 3)], "a int, b int, c_x int")
    assert report.try_select(df, ["b", {"a": "z"}, "none"]).columns == ["b", "z"] and report.try_drop(df, ["a", "none"]).columns == ["b", "c_x"]
    assert report.reorder(df, ["c_x", "none"]).columns == ["c_x", "a", "b"] and report.prefix_columns(df, "p", ["a"]).columns == ["a", "(p) b", "(p) c_x"]
    assert [report.find_column(df, c) for c in ("a", "x", "none")] == ["a", "c_x", None]
    stats = spark.createDataFrame([("s", "tool", "reads", "1"), ("s", "tool", "bases", "2")], "sample string, namespace string, title string, value string")
    suffixes = spark.createDataFrame([("tool", "bases", "Mb")], "namespace string, title string, suffix string")
    assert sorted(report.general_stats(stats, suffixes).columns) == ["sample", "tool. bases (Mb)", "tool. reads"]
    wide = spark.createDataFrame([("s_m-CONSTRAINT_constraint", "s", "m-CONSTRAINT", "constraint", 1), ("s_c_it1", "s", "c", "it1", 2)], "id string, sample string, cluster string, step string, v int")
    seen = report.mapping_overview(wide, spark.createDataFrame([("m", "sp")], "id string, species string"), ["v"]).collect()
    assert [(r.cluster, r.species, r.v) for r in seen] == [("m", "sp", 1)]


def test_variants_and_depths(spark):
    low = spark.createDataFrame([("c", 1, 0), ("c", 2, 5), ("c", 3, 9)], "ref string, pos int, depth int")
    assert rows(intervals.low_depth(low, 5)) == [("c", 0, 1)] and rows(intervals.low_depth(low, 5, True)) == [("c", 0, 1), ("c", 1, 2)]
    calls = spark.createDataFrame([(True, 0.5), (False, 0.5), (True, 0.01), (False, 0.01)], "passed boolean, p double")
    assert [r[0] for r in calls.select(variants.filter_label(F.col("passed"), F.col("p"))).collect()] == ["PASS", "ft", "sb", "ft;sb"]
    strands = spark.createDataFrame([(10, 4, 6, 6)], "ref_dp int, ref_rv int, alt_dp int, alt_rv int")
    assert rows(variants.strand_depths(strands), "ref_fw", "alt_fw") == [(6, 0)]
    order = variants.sort_variants(spark.createDataFrame([("b", 1, "A", "C"), ("a", 9, "A", "C"), ("a", 2, "G", "T"), ("a", 2, "A", "T")], "chrom string, pos int, ref string, alt string"))
    assert [(r.chrom, r.pos, r.ref) for r in order.collect()] == [("a", 2, "A"), ("a", 2, "G"), ("a", 9, "A"), ("b", 1, "A")]
    number = spark.createDataFrame([(1500.0, 20000)], "n double, size int").select(*clusters.n_counts(F.col("n"), F.col("size"))).first()
    assert tuple(number) == (300, 1.5)
    assert spark.createDataFrame([(1, 3)], "a int, b int").select(hits.percent_aligned(F.col("a"), F.col("b"))).first()[0] == 33.33
    pile = spark.createDataFrame([(1, 3, 1, 0, 0), (2, 0, 0, 0, 0)], "pos int, A int, C int, G int, T int")
    assert rows(pile.withColumn("w", alignments.weighted_entropy(alignments.entropy())), "pos", "w") == [(1, 0.06), (2, 0.0)]
    assert [r[0] for r in spark.createDataFrame([("AAAAAA",), ("ACGTAC",), ("A",)], "s string").select(reads.dust(F.col("s"))).collect()] == [2.0, 0.0, 0.0]
