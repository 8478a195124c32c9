"""Writers: FASTA by group, tables with a comment head, cluster JSON and variant rows."""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


#: Most rows of a file of a group.
FILE_ROWS = 100_000


def dealt_to_files(rows: DataFrame, by: list[str], most: int = FILE_ROWS) -> DataFrame:
    """rows dealt by group for a writer of at most most rows a file: a group of up to most rows is one task's, a larger one is
    split into as many parts as it needs, and small groups share a task. Groups are counted first; which part a row is in
    follows from the row."""
    sizes = rows.groupBy(*by).agg(F.count("*").alias("_n")).withColumn("_files", F.ceil(F.col("_n") / most)).drop("_n")
    keys = functools.reduce(lambda x, y: x & y, [F.col(f"r.{c}").eqNullSafe(F.col(f"s.{c}")) for c in by])
    joined = rows.alias("r").join(sizes.filter("_files > 1").alias("s"), keys, "left").select("r.*", F.coalesce("_files", F.lit(1)).alias("_files"))
    part = F.pmod(F.xxhash64(*[c for c, kind in rows.dtypes if "map" not in kind]), F.col("_files")).alias("_part")
    return joined.select(*rows.columns, part).repartition(*by, "_part").sortWithinPartitions(*by, "_part").drop("_part")


def write_fasta(sequences: DataFrame, path: str, by: str | None = None, width: int = 0, most: int = FILE_ROWS) -> None:
    """Records as text, one folder a value of by, of one file or, from most records, of several; width > 0 breaks sequence
    lines. Values of by name their folders, as by=value."""
    seq = F.regexp_replace("seq", f"(.{{{width}}})(?=.)", "$1\n") if width else F.col("seq")
    lines = sequences.select(*([by] if by else []), F.concat(F.lit(">"), "seq_id", F.lit("\n"), seq).alias("value"))
    (dealt_to_files(lines, [by], most).write.partitionBy(by) if by else lines.write).option("maxRecordsPerFile", most).text(path)


def write_tsv(df: DataFrame, path: str, comments: list[str] = ()) -> bool:
    """A tab-separated table with a header under comment lines, in one file; nothing, and False, when df has no rows.

    A report table is small; use df.write.csv for large ones."""
    if df.isEmpty():
        return False
    cells = [F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")) for c in df.columns]
    head = [f"#{c}" for c in comments] + ["\t".join(df.columns)]
    rows = df.select(F.lit(1).alias("o"), F.monotonically_increasing_id().alias("n"), F.concat_ws("\t", *cells).alias("value"))
    top = df.sparkSession.createDataFrame([(0, i, v) for i, v in enumerate(head)], "o int, n long, value string")
    top.unionAll(rows).coalesce(1).sortWithinPartitions("o", "n").select("value").write.text(path)
    return True


def write_cluster_json(clusters: DataFrame, path: str, by: list[str] = ("sample",), most: int = FILE_ROWS) -> None:
    """One object a row, in one folder a sample, or a value of the columns in by (("sample", "cluster"): a folder a cluster)."""
    dealt_to_files(clusters, list(by), most).write.partitionBy(*by).option("maxRecordsPerFile", most).json(path)


def vcf_header(contigs: list[tuple[str, int]], sample: str) -> list[str]:
    """Header lines of a variant file. The names of filters and format fields."""
    filters = [("PASS", "Passed every filter"), ("ft", "No more frequent than errors are, by Fisher's exact test"), ("sb", "Strand bias")]
    depths = [("REF_DP", "Reads with the reference base"), ("REF_RV", "Reverse reads with the reference base"), ("REF_QUAL", "Mean quality of the reference base")]
    depths += [("ALT_DP", "Reads with the alternate base"), ("ALT_RV", "Reverse reads with the alternate base"), ("ALT_QUAL", "Mean quality of the alternate base")]
    formats = [("GT", "1", "String", "Genotype"), *[(k, "1", "Integer", d) for k, d in depths], ("ALT_FREQ", "1", "Float", "Share of reads with the alternate base")]
    lines = ["##fileformat=VCFv4.2", *[f"##contig=<ID={c},length={n}>" for c, n in contigs], '##INFO=<ID=DP,Number=1,Type=Integer,Description="Reads at the position">']
    lines += [f'##FILTER=<ID={k},Description="{d}">' for k, d in filters] + [f'##FORMAT=<ID={k},Number={n},Type={t},Description="{d}">' for k, n, t, d in formats]
    return [*lines, "\t".join(["#CHROM", "POS", "ID", "REF", "ALT", "QUAL", "FILTER", "INFO", "FORMAT", sample])]


def write_vcf(variants: DataFrame, path: str, header: list[str], info: Column, formats: list[str]) -> None:
    """Variant rows (chrom, pos, ref, alt, filter and the columns in formats) in order under the header, in one file: a
    sample's calls on a viral genome are few."""
    own = F.concat_ws(":", *[F.col(f).cast("string") for f in formats])
    value = F.concat_ws("\t", "chrom", F.col("pos").cast("string"), F.lit("."), "ref", "alt", F.lit("."), "filter", info, F.lit(":".join(formats)), own)
    rows = variants.select(F.lit(1).alias("o"), F.col("chrom").alias("c"), F.col("pos").cast("long").alias("n"), value.alias("value"))
    top = variants.sparkSession.createDataFrame([(0, "", i, v) for i, v in enumerate(header)], "o int, c string, n long, value string")
    top.unionAll(rows).coalesce(1).sortWithinPartitions("o", "c", "n").select("value").write.text(path)
