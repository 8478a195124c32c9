"""Operators on small fixtures whose rows are derived by hand."""

from __future__ import annotations

import importlib.util
import math

from pyspark.sql import functions as F

from strandwise.operators import alignments, clusters, flow, graph, hits, intervals, reads, report, sheets, sketches, taxonomy, variants
from strandwise.sources import readers, writers


def rows(df, *columns):
    return sorted(tuple(r) for r in (df.select(*columns) if columns else df).collect())


def test_hit_thresholds(spark):
    df = spark.createDataFrame([("a", 0.01, 50.0, 80, 100), ("b", 0.02, 50.0, 80, 100), ("c", 0.01, 49.0, 80, 100), ("d", 0.01, 50.0, 79, 100)], "query string, evalue double, bitscore double, length long, qlen long")
    assert rows(hits.filter_hits(df), "query") == [("a",)]
    assert len(rows(hits.filter_hits(df, 0, 0, 0))) == 4


def test_key_values(spark):
    df = spark.createDataFrame([('x|species="some virus"; segment=L; segment=S',), ("none",)], "t string")
    assert [r[0] for r in df.select(hits.key_values(F.col("t"))).collect()] == [{"species": "some virus", "segment": "S"}, {}]


TREE = [("1", None, "R"), ("10", "1", "D"), ("20", "10", "G"), ("31", "20", "S"), ("32", "20", "S"), ("40", "31", "S1")]


def test_taxonomy(spark):
    tree = spark.createDataFrame(TREE, "taxid string, parent_taxid string, rank string")
    up = taxonomy.ancestors(tree)
    assert rows(up.filter("taxid = '40'"), "ancestor", "depth") == [("1", 4), ("10", 3), ("20", 2), ("31", 1), ("40", 0)]
    calls = lambda *x: spark.createDataFrame(x, "flag string, name string, taxid string")
    one = calls(("U", "a", "0"), ("C", "b", "31"), ("C", "c", "31"), ("C", "d", "20"), ("U", "e", "0"))
    two = calls(("C", "a", "32"), ("U", "b", "0"), ("C", "c", "32"), ("C", "d", "31"), ("U", "e", "0"))
    assert rows(taxonomy.merge_classifiers(one, two, up, "lca"), "name", "flag", "taxid") == [("a", "C", "32"), ("b", "C", "31"), ("c", "C", "20"), ("d", "C", "20"), ("e", "U", "0")]
    assert rows(taxonomy.merge_classifiers(one, two, up, "lowest"), "name", "taxid")[3] == ("d", "31")
    assert rows(taxonomy.merge_classifiers(one, two, up, "2"), "name", "taxid")[2] == ("c", "32")
    assert rows(taxonomy.simplify_to_rank(tree.select("taxid"), tree, up, "G"), "taxid", "resolved")[4:] == [("32", "20"), ("40", "20")]
    assert rows(taxonomy.precluster(one, two, tree, up, "lca", "G"), "name", "resolved") == [("a", "20"), ("b", "20"), ("c", "20"), ("d", "20")]


def test_clusters(spark):
    members = spark.createDataFrame([("s", 0, "NC_1", True), ("s", 0, "NODE_1", False), ("s", 0, "other", False), ("s", 1, "NC_2", True), ("s", 2, "k141_3", True)], "sample string, cluster int, seq_id string, is_centroid boolean")
    kept = clusters.filter_members(members)
    assert rows(kept, "cluster", "seq_id", "external_reference") == [(0, "NC_1", True), (0, "NODE_1", True), (2, "k141_3", False)]
    depth = spark.createDataFrame([("s", "NODE_1", 0.4), ("s", "k141_3", 0.5)], "sample string, seq_id string, percent double")
    found = clusters.extract_clusters(members, depth, threshold=1.0, keep_n=1)
    assert rows(found, "cluster", "megahit", "size") == [(2, 0.5, 0)]
    assert len(rows(clusters.extract_clusters(members, depth, threshold=0.4, keep_n=0))) == 2


def test_assembly_stats(spark):
    df = spark.createDataFrame([("s", n) for n in (10, 10, 5, 5, 2)], "sample string, length long")
    assert rows(clusters.assembly_stats(df), "contigs", "total", "largest", "n50", "l50") == [(5, 32, 10, 10, 2)]


def test_components(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(20)] + [(50, 49), (7, 7)], "src long, dst long")
    vertices = spark.createDataFrame([(i,) for i in [*range(21), 49, 50, 99]], "id long")
    found = dict(rows(graph.connected_components(vertices, edges)))
    assert found == {**{i: 0 for i in range(21)}, 49: 49, 50: 49, 99: 99}
    weights = spark.createDataFrame([(1, 2, 0.0), (1, 3, 0.5), (1, 4, 0.9)], "src long, dst long, weight double")
    assert rows(graph.filter_edges(weights, 0.9), "dst") == [(3,)] and rows(graph.filter_edges(weights, 0.5, "ani"), "dst") == [(2,), (3,)]


def test_intervals(spark):
    df = spark.createDataFrame([("c", 0, 10), ("c", 2, 3), ("c", 10, 12), ("c", 20, 21)], "chrom string, start long, end long")
    merged = intervals.merge_intervals(df, ["chrom"])
    assert rows(merged, "start", "end", "n") == [(0, 12, 3), (20, 21, 1)]
    assert rows(intervals.merge_intervals(merged, ["chrom"]), "start", "end") == [(0, 12), (20, 21)]
    indels = spark.createDataFrame([("c", 10, 3), ("d", 20, 9)], "chrom string, pos long, len long")
    assert rows(intervals.mask_without_indels(df, indels), "start") == [(2,), (20,)]
    seqs = spark.createDataFrame([("c", "ACGTACGT"), ("e", "AC")], "chrom string, seq string")
    cuts = spark.createDataFrame([("c", 1, 3), ("c", 2, 4), ("c", 7, 99)], "chrom string, start long, end long")
    assert rows(intervals.mask_sequence(seqs, cuts)) == [("c", "ANNNACGN"), ("e", "AC")]


def test_pileup_and_consensus(spark):
    reads_ = spark.createDataFrame([(0, "r", 1, "2M1I1M", "ACTG"), (0, "r", 1, "1M1D1M", "AG"), (4, "r", 1, "4M", "AAAA"), (0, "r", 2, "1S2M", "TCG")], "flag int, ref string, pos long, cigar string, seq string")
    piled = alignments.pileup(alignments.aligned_bases(reads_), ["ref", "pos"])
    assert rows(piled, "pos", "A", "C", "G", "T", "ins", "del") == [(1, 2, 0, 0, 0, 0, 0), (2, 0, 2, 0, 0, 1, 1), (3, 0, 0, 3, 0, 0, 0)]
    assert rows(alignments.consensus(piled, ["ref"], 3)) == [("r", "NNG")]
    assert rows(alignments.contig_consensus(piled, ["ref"])) == [("r", "AC+G")]
    tie = spark.createDataFrame([("r", 1, 5, 0, 5, 0, 0, 0), ("r", 2, 0, 0, 0, 0, 0, 0), ("r", 3, 7, 3, 0, 0, 0, 0)], "ref string, pos long, A long, C long, G long, T long, ins long, del long")
    assert rows(alignments.consensus(tie, ["ref"])) == [("r", "RNA")]
    assert rows(tie.withColumn("e", alignments.entropy()).withColumn("w", alignments.weighted_entropy(F.col("e"))).withColumn("b", alignments.majority_base()), "pos", "e", "b") == [(1, 1.0, "N"), (2, 0.0, "N"), (3, 0.881, "A")]


def test_variants(spark):
    df = spark.createDataFrame([(1, "A", "+TT"), (2, "A", "-TT"), (3, "A", "C")], "pos int, ref string, alt string")
    assert rows(variants.typed(df), "type", "ref", "alt") == [("DEL", "ATT", "A"), ("INS", "A", "ATT"), ("SNP", "A", "C")]
    table = spark.createDataFrame([(8, 2, 1, 5), (0, 0, 0, 0)], "a int, b int, c int, d int")
    p = [r[0] for r in table.select(variants.strand_bias(*[F.col(c) for c in "abcd"])).collect()]
    brute = sum(math.comb(10, x) * math.comb(6, 9 - x) for x in (8, 9)) / math.comb(16, 9)
    assert abs(p[0] - brute) < 1e-12 and p[1] == 1.0
    reference = spark.createDataFrame([("k", "ACGTAC")], "key string, seq string")
    calls = spark.createDataFrame([("k", 1, "A", "G"), ("k", 2, "CGT", "C"), ("k", 6, "C", "CTT")], "key string, pos long, ref string, alt string")
    assert rows(variants.apply_variants(reference, calls)) == [("k", "GCACTT")]
    snps = spark.createDataFrame([("k", 3, 0, "A", "C"), ("k", 4, 1, "A", "G"), ("k", 6, 0, "T", "C"), ("k", 8, 2, "T", "G")], "key string, pos int, frame int, ref string, alt string")
    assert rows(variants.merge_codons(snps, ["key"]), "pos", "ref", "alt", "n") == [(3, "AA", "CG", 2), (6, "T", "C", 1), (8, "T", "G", 1)]
    multi = spark.createDataFrame([(1, "C,T", "5,6")], "pos int, alt string, ad string")
    assert rows(variants.split_alleles(multi, ["ad"]), "alt", "ad", "allele") == [("C", "5", 1), ("T", "6", 2)]


def test_reads(spark):
    df = spark.createDataFrame([("a", "ACGT" * 15, "#" * 4 + "I" * 56), ("b", "ACGT" * 12, "I" * 48), ("c", "ACG" * 17 + "A" * 20, "I" * 71)], "read_id string, seq string, qual string")
    out = {r.read_id: len(r.seq) for r in reads.trim_reads(df).collect()}
    assert out == {"a": 57, "c": 51}  # the first window of mean 30 holds one bad base
    umis = spark.createDataFrame([("AAAA",)] * 5 + [("AAAT",)] * 2 + [("GGGG",)], "umi string")
    assert rows(reads.umi_representatives(reads.dedup_umi(umis)), "umi", "reads") == [("AAAA", 7), ("GGGG", 1)]
    assert [r[0] for r in spark.createDataFrame([("A" * 20,), ("",)], "s string").select(reads.complexity(F.col("s"))).collect()] == [0.0, 0.0]


def test_sketches(spark):
    a, b = "ACGTTGCATTGACCGTAAAC", "ACGTTGCATTGACCGTAAAG"
    df = spark.createDataFrame([("a", a), ("b", b)], "seq_id string, seq string")
    k = 5
    words = lambda s: {min(w, w[::-1].translate(str.maketrans("ACGT", "TGCA"))) for w in (s[i : i + k] for i in range(len(s) - k + 1))}
    j = len(words(a) & words(b)) / len(words(a) | words(b))
    found = sketches.mash_distances(sketches.sketch(sketches.words(df, k, canonical_words=True), 1000), k).first()
    assert abs(found.jaccard - j) < 1e-12 and abs(found.distance + math.log(2 * j / (1 + j)) / k) < 1e-12
    lengths = df.select("seq_id", F.length("seq").alias("length"))
    assert len({r.centroid for r in sketches.cluster_sequences(sketches.words(df, k), lengths, 0.8, 20).collect()}) == 1


def test_report(spark):
    df = spark.createDataFrame([("s_c_it1.x", 1), ("s_c_consensus", 2), ("nokey", 3), ("s_d-CONSTRAINT_constraint", 4)], "id string, v int")
    split = report.split_id(df)
    assert rows(split, "sample", "cluster", "step") == [("s", "c", "consensus"), ("s", "c", "it1"), ("s", "d-CONSTRAINT", "constraint")]
    last, ignored = report.last_iteration(split)
    assert rows(last, "id") == [("s_c_it1",), ("s_d-CONSTRAINT_constraint",)] and rows(ignored, "id") == [("s_c_consensus",)]
    assert rows(report.split_constraints(split)[0], "cluster") == [("d",)]
    assert report.drop_null_columns(spark.createDataFrame([(1, None)], "a int, b int")).columns == ["a"]
    sheet = spark.createDataFrame([("ok", "a.fa", "", "x"), ("b_d", "b.fa", "sp", "x"), ("c", "c.txt", "sp", ""), ("d", "d.fa", "", "L")], "id string, sequence string, species string, segment string").withColumn("samples", F.lit(""))
    _, bad = sheets.validate_constraints(sheet.withColumn("segment", F.when(F.col("id") == "ok", "").otherwise(F.col("segment"))))
    assert {r.id: list(r.failed) for r in bad.collect()} == {"b_d": ["id"], "c": ["sequence"], "d": ["segment needs species"]}
    assert rows(flow.include_exclude(*[spark.createDataFrame([(x,) for x in ids], "id string") for ids in ("aab", "b", "")])) == [("a",)]


def test_files(spark, tmp_path):
    p = lambda name, text: (tmp_path / name).write_text(text) and str(tmp_path / name)
    fasta = p("a.fa", ">x one two\nAC\nGT\n>y\nNN\n")
    assert rows(readers.read_fasta(spark, fasta), "seq_id", "description", "seq") == [("x", "x one two", "ACGT"), ("y", "y", "NN")]
    fastq = p("s1_R1.fastq", "@r1/1\nAC\n+\nI@\n@r2 1:N\nGG\n+\n@I\n")
    assert rows(readers.read_fastq(spark, fastq)) == [("s1", "r1", 1, "AC", "I@"), ("s1", "r2", 1, "GG", "@I")]
    clstr = p("c.clstr", ">Cluster 0\n0\t5nt, >a... *\n1\t4nt, >b... at 90%\n>Cluster 1\n0\t3nt, >c... *\n")
    assert rows(readers.read_cdhit(spark, clstr), "cluster", "member", "is_centroid") == [(0, "a", True), (0, "b", False), (1, "c", True)]
    report_file = p("k.txt", "10.0\t10\t10\tU\t0\tunclassified\n90.0\t90\t1\tR\t1\troot\n80.0\t80\t2\tD\t2\t  Viruses\n70.0\t70\t70\tF\t3\t    Fam\n5.0\t5\t5\tD\t4\t  Bact\n")
    assert rows(readers.read_kraken_report(spark, report_file).filter("parent_taxid is not null"), "taxid", "parent_taxid") == [("2", "1"), ("3", "2"), ("4", "1")]
    nodes = p("nodes.dmp", "1\t|\t1\t|\tno rank\t|\n2\t|\t1\t|\tsuperkingdom\t|\n")
    assert sorted(rows(readers.read_nodes(spark, nodes)), key=str) == [("1", None, "no rank"), ("2", "1", "superkingdom")]
    mm = p("m.tsv", "a\ta\na\tb\nc\tc\n")
    assert sorted(rows(readers.read_mmseqs(spark, mm).fillna("-"), "cluster", "centroid", "member")) == [(0, "a", "b"), (1, "c", "-")]
    idx = p("i.tsv", "a\t10\t30\t0\nb\t10\t10\t0\n*\t0\t0\t5\n")
    assert rows(readers.read_idxstats(spark, idx), "ref", "percent") == [("a", 75.0), ("b", 25.0)]
    quast = p("q.tsv", "contigs\t5\nN50\t10\n")
    assert readers.read_key_values(spark, quast).first().asDict() == {"file": "q", "N50": "10", "contigs": "5"}
    assert readers.read_tables(spark, [idx, str(tmp_path / "missing.tsv")]) is not None and readers.read_tables(spark, [str(tmp_path / "none.csv")]) is None
    if importlib.util.find_spec("yaml"):
        sheet = p("s.yaml", "- sample: a\n  depth: 3\n- sample: b\n")
        assert rows(readers.read_tables(spark, [sheet, idx]).filter("sample is not null").fillna(0), "sample", "depth") == [("a", 3), ("b", 0)]
    members = p("n.tsv","NODE_1\t0\nNC_9\t0\nNODE_2\t1\n")
    assert rows(readers.read_membership(spark, members), "member", "is_centroid") == [("NC_9", True), ("NODE_1", False), ("NODE_2", True)]
    df = spark.createDataFrame([("x", "ACGT", "t1")], "seq_id string, seq string, taxid string")
    writers.write_fasta(df, str(tmp_path / "out"), by="taxid", width=3)
    assert rows(readers.read_fasta(spark, str(tmp_path / "out/taxid=t1")), "seq_id", "seq") == [("x", "ACGT")]
    assert writers.write_tsv(df, str(tmp_path / "t"), ["note"]) and not writers.write_tsv(df.limit(0), str(tmp_path / "e"))
    assert spark.read.text(str(tmp_path / "t")).count() == 3
    calls = spark.createDataFrame([("c", 2, "A", "G", "PASS", 3), ("c", 1, "T", "G", "PASS", 4)], "chrom string, pos int, ref string, alt string, filter string, dp int")
    writers.write_vcf(calls, str(tmp_path / "v"), writers.vcf_header([("c", 9)], "s"), F.concat(F.lit("DP="), "dp"), ["dp"])
    assert rows(readers.read_vcf(spark, str(tmp_path / "v")), "pos", "alt") == [(1, "G"), (2, "G")]


def test_assembly_stats_of_empty_contigs(spark):
    df = spark.createDataFrame([("a", 4, 2), ("a", 0, 0), ("a", None, 0), ("b", 0, 0), ("b", 0, 0), ("c", None, None)], "sample string, length long, gc long")
    names = ["sample", "contigs", "total", "largest", "n50", "l50"]
    assert rows(clusters.assembly_stats(df), *names) == [("a", 3, 4, 4, 4, 1), ("b", 2, 0, 0, 0, 1), ("c", 1, None, None, None, None)]
    shares = clusters.assembly_stats(df, gc="gc", n="gc").collect()
    assert {(r["sample"], r["gc"], r["n_per_100k"]) for r in shares} == {("a", 50.0, 5e4), ("b", None, None), ("c", None, None)}


def test_merge_intervals_of_odd_places(spark):
    """As the query's SQL on one thread: no start goes with the last interval, copies count once, reversed ones stand apart."""
    df = spark.createDataFrame([("a", 1, 4), ("a", None, None), ("a", None, None), ("a", 9, 11), ("a", 9, 11), ("a", 2, 3), ("b", None, None), ("c", 5, 2), ("c", 5, 2), ("d", 3, None), ("d", 3, 5), ("d", 6, 7)], "chrom string, start long, end long")
    got = {(r.chrom, r.start, r.end, r.n) for r in intervals.merge_intervals(df, ["chrom"]).collect()}
    assert got == {("a", 1, 4, 2), ("a", 9, 11, 4), ("b", None, None, 1), ("c", 5, 2, 1), ("d", 3, 5, 2), ("d", 6, 7, 1)}
