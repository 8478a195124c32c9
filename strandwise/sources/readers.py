"""Readers: every one returns a DataFrame and takes a path, a glob or a list of paths that Spark can read."""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strandwise import schemas
from strandwise.operators.scan import dealt, running

#: Most bytes of a sheet that the driver parses.
MOST_SHEET = 16 << 20


def read_fasta(spark: SparkSession, path) -> DataFrame:
    """(file, seq_id, description, seq): records split at '>' at a line's start, whatever the number of sequence lines; id is the first word."""
    records = spark.read.option("lineSep", "\n>").text(path).select(F.input_file_name().alias("file"), F.regexp_replace(F.regexp_replace("value", "\r", ""), "^\\s*>", "").alias("value")).filter(F.trim("value") != "")
    head = F.split("value", "\n", 2)
    named = records.select("file", F.trim(head[0]).alias("head"), F.regexp_replace(F.coalesce(F.try_element_at(head, F.lit(2)), F.lit("")), "\\s", "").alias("seq"))
    return named.select("file", F.split("head", "\\s+")[0].alias("seq_id"), F.col("head").alias("description"), "seq")


def _numbered(lines: DataFrame) -> DataFrame:
    """Lines with their file and their order in it. Order follows Spark's file splits, which follow the file."""
    return lines.select(F.input_file_name().alias("file"), F.monotonically_increasing_id().alias("line"), "value")


def _line_numbers(lines: DataFrame) -> DataFrame:
    """(file, n, value) of _numbered() lines, n from 0 in each file: a line's place in its split, and the lines of the file's
    splits before it. Only the splits' sizes meet in a window."""
    placed = lines.withColumn("part", F.shiftright("line", 33))
    sizes = placed.groupBy("file", "part").agg(F.min("line").alias("first"), F.count("*").alias("size"))
    before = F.coalesce(F.sum("size").over(Window.partitionBy("file").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return placed.join(sizes.select("file", "part", "first", before.alias("before")), ["file", "part"]).select("file", (F.col("line") - F.col("first") + F.col("before")).alias("n"), "value")


def read_fastq(spark: SparkSession, path, sample: str | None = None) -> DataFrame:
    """(sample, read_id, mate, seq, qual): records of four lines. A quality line may begin with '@', so records are told
    apart by their lines' number in the file."""
    lines, n = _line_numbers(_numbered(spark.read.text(path))), F.col("n")
    line = lambda k: F.max(F.when(F.col("k") == k, F.col("value")))
    cut = lines.select("file", F.regexp_replace("value", "\\r$", "").alias("value"), F.floor(n / 4).alias("record"), (n % 4).alias("k"))
    whole = cut.groupBy("file", "record").agg(line(0).alias("head"), line(1).alias("seq"), line(2).alias("plus"), line(3).alias("qual")).filter("head like '@%' and plus like '+%'")
    mate = F.coalesce(F.expr("try_cast(nullif(regexp_extract(head, '(?:/|\\\\s)([12])(?::|$)', 1), '') as int)"), F.lit(1))
    own = F.lit(sample) if sample else F.regexp_extract("file", "([^/]+?)(?:_R?[12])?\\.(?:fq|fastq)(?:\\.gz)?$", 1)
    name = F.regexp_replace(F.split(F.expr("substring(head, 2)"), "\\s+")[0], "/[12]$", "")
    return whole.select(own.alias("sample"), name.alias("read_id"), mate.alias("mate"), "seq", "qual")


def read_hits(spark: SparkSession, path) -> DataFrame:
    """Headerless tab-separated hits, 15 columns."""
    return spark.read.schema(schemas.HITS).csv(path, sep="\t", quote="")


def _csv(sep: str, header: bool = True) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, path: spark.read.csv(path, sep=sep, header=header, inferSchema=True)


def _length(spark: SparkSession, path: str) -> int:
    """Bytes of a file or folder; 0 if there is none."""
    jvm = spark.sparkContext._jvm
    found = jvm.org.apache.hadoop.fs.Path(path)
    fs = found.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs.getContentSummary(found).getLength() if fs.exists(found) else 0


def read_yaml_sheet(spark: SparkSession, path: str) -> DataFrame:
    """A YAML sheet of MOST_SHEET bytes at most, parsed on the driver: a list gives a row an item, a mapping one row."""
    import yaml

    if _length(spark, path) > MOST_SHEET:
        raise ValueError(f"{path} is over {MOST_SHEET} bytes")
    found = yaml.safe_load(spark.read.text(path, wholetext=True).first()[0])
    return spark.createDataFrame(found if isinstance(found, list) else [found])


READERS: dict[str, Callable[[SparkSession, str], DataFrame]] = {"tsv": _csv("\t"), "txt": _csv("\t"), "csv": _csv(","), "json": lambda spark, path: spark.read.option("multiLine", True).json(path), "yaml": read_yaml_sheet, "yml": read_yaml_sheet}


def read_tables(spark: SparkSession, paths: list[str]) -> DataFrame | None:
    """Files by suffix as one union by name; missing and empty files are left out; None if none is left."""
    frames = []
    for path in paths:
        suffix = path.rsplit(".", 1)[-1].lower()
        if suffix not in READERS:
            raise ValueError(f"no reader for .{suffix}")
        if _length(spark, path):
            frames.append(READERS[suffix](spark, path))
    return functools.reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames) if frames else None


def read_json_records(spark: SparkSession, path, key: str = "id") -> DataFrame:
    """JSON records; where key is missing, the file's name without suffix stands for it."""
    rows = spark.read.option("multiLine", True).json(path).withColumn("_file", F.regexp_extract(F.input_file_name(), "([^/]+?)(?:\\.[^./]*)?$", 1))
    own = F.coalesce(F.col(key).cast("string"), F.col("_file")) if key in rows.columns else F.col("_file")
    return rows.withColumn(key, own).drop("_file")


def read_key_values(spark: SparkSession, path, keys: list[str] | None = None) -> DataFrame:
    """Two-column reports, one row a file: (file, one column a key), file without folder and suffix. Files of one name in
    several folders are rows of their own. keys: the columns to take; without them all keys that occur, which are collected
    first, as many as Spark pivots at most (spark.sql.pivotMaxValues)."""
    rows = spark.read.schema("key string, value string").csv(path, sep="\t", quote="").withColumn("_path", F.input_file_name())
    wide = rows.groupBy("_path").pivot("key", keys).agg(F.first("value"))
    return wide.select(F.regexp_extract("_path", "([^/]+?)(?:\\.[^./]*)?$", 1).alias("file"), *[F.col(f"`{c}`") for c in wide.columns if c != "_path"])


def read_cdhit(spark: SparkSession, path) -> DataFrame:
    """(file, cluster, member, is_centroid) of .clstr files: each member belongs to the last header above it."""
    header = F.expr("try_cast(nullif(regexp_extract(value, '^>Cluster\\\\s+(\\\\d+)', 1), '') as long)")
    marked = running(dealt(_numbered(spark.read.text(path)), ["file"], ["line"]), ["file"], ["line"], {"cluster": ("last", header)})
    members = marked.filter(~F.col("value").startswith(">Cluster")).withColumn("member", F.regexp_extract("value", ">(.+?)\\.\\.\\.", 1)).filter("member <> ''")
    return members.select("file", "cluster", "member", F.col("value").endswith("*").alias("is_centroid"))


def read_mmseqs(spark: SparkSession, path) -> DataFrame:
    """(file, cluster, centroid, member) of centroid-member tables; clusters are numbered in order of appearance; a row
    that repeats the centroid founds the cluster and adds no member (null where it has no other)."""
    rows = _numbered(spark.read.text(path)).withColumn("p", F.split("value", "\t")).select("file", "line", F.col("p")[0].alias("centroid"), F.col("p")[1].alias("member"))
    seen = rows.groupBy("file", "centroid").agg(F.min("line").alias("at"))
    numbered = seen.select("file", "centroid", (F.row_number().over(Window.partitionBy("file").orderBy("at")) - 1).cast("long").alias("cluster"))
    return numbered.join(rows.filter("member <> centroid"), ["file", "centroid"], "left").select("file", "cluster", "centroid", "member")


def read_mmseqs_members(spark: SparkSession, path) -> DataFrame:
    """(file, cluster, member, is_centroid) of centroid-member tables, as the other cluster readers have it."""
    rows = read_mmseqs(spark, path)
    centres = rows.select("file", "cluster", F.col("centroid").alias("member"), F.lit(True).alias("is_centroid")).distinct()
    return centres.unionAll(rows.filter("member is not null").select("file", "cluster", "member", F.lit(False)))


def read_uc(spark: SparkSession, path) -> DataFrame:
    """(file, cluster, member, is_centroid) of .uc records: S is a centroid, H a member, C a summary."""
    rows = spark.read.schema(schemas.UC).csv(path, sep="\t", quote="").filter("record in ('S', 'H')")
    return rows.select(F.input_file_name().alias("file"), "cluster", "member", (F.col("record") == "S").alias("is_centroid"))


def read_membership(spark: SparkSession, path, header: bool = False, contigs: str | None = None) -> DataFrame:
    """(file, cluster, member, is_centroid) of member-cluster tables; the centroid is the first name that the contig pattern
    doesn't match, else the first name."""
    from strandwise.operators.clusters import CONTIGS

    lines = _numbered(spark.read.text(path)).withColumn("p", F.split("value", "\t")).select("file", "line", F.col("p")[0].alias("member"), F.col("p")[1].alias("cluster"))
    if header:
        top = lines.groupBy("file").agg(F.min("line").alias("_top"))  # a row a file
        lines = lines.join(top, "file").filter("line > _top").drop("_top")
    order = F.struct(F.col("member").rlike(contigs or CONTIGS).alias("contig"), "line")
    first = lines.groupBy(F.col("file").alias("_file"), F.col("cluster").alias("_cluster")).agg(F.min(order)["line"].alias("_first"))
    joined = lines.join(first, (F.col("file") == F.col("_file")) & F.col("cluster").eqNullSafe(F.col("_cluster")))
    return joined.select("file", "cluster", "member", (F.col("line") == F.col("_first")).alias("is_centroid"))


def read_idxstats(spark: SparkSession, path) -> DataFrame:
    """(file, ref, length, mapped, unmapped, percent): share of the file's mapped reads, in percent."""
    rows = spark.read.schema(schemas.IDXSTATS).csv(path, sep="\t").withColumn("file", F.input_file_name())
    total = F.sum("mapped").over(Window.partitionBy("file"))
    return rows.filter("ref <> '*'").withColumn("percent", F.when(total > 0, 100 * F.col("mapped") / total).otherwise(0.0))


def read_nodes(spark: SparkSession, path) -> DataFrame:
    """(taxid, parent_taxid, rank) of a taxonomy dump; the root has no parent."""
    p = F.split("value", "\\s*\\|\\s*")
    rows = spark.read.text(path).select(F.trim(p[0]).alias("taxid"), F.trim(p[1]).alias("parent_taxid"), F.trim(p[2]).alias("rank"))
    return rows.withColumn("parent_taxid", F.when(F.col("taxid") != F.col("parent_taxid"), F.col("parent_taxid")))


def read_kraken_report(spark: SparkSession, path) -> DataFrame:
    """(file, percent, clade_reads, direct_reads, rank, taxid, name, parent_taxid) of reports whose names are indented by
    two spaces a level: the parent is the last row above that is one level up."""
    p = F.split("value", "\t")
    rows = _numbered(spark.read.text(path)).select("file", "line", F.trim(p[0]).cast("double").alias("percent"), F.trim(p[1]).cast("long").alias("clade_reads"), F.trim(p[2]).cast("long").alias("direct_reads"), F.trim(p[3]).alias("rank"), F.trim(p[4]).alias("taxid"), p[5].alias("raw"))
    rows = rows.withColumn("level", ((F.length("raw") - F.length(F.ltrim("raw"))) / 2).cast("int")).withColumn("name", F.trim("raw")).drop("raw")
    ranges = dealt(rows, ["file"], ["line"])
    deepest = ranges.agg(F.max("level")).first()[0] or 0  # ranks of a taxonomy, a few dozen
    above = {f"_at{level}": ("last", F.when(F.col("level") == level, F.col("taxid"))) for level in range(deepest)}
    parent = F.coalesce(*[F.when(F.col("level") == level + 1, F.col(f"_at{level}")) for level in range(deepest)], F.lit(None).cast("string"))
    placed = running(ranges, ["file"], ["line"], above, before=True) if above else ranges
    return placed.withColumn("parent_taxid", F.when(F.col("rank") != "U", parent)).drop("line", "level", "_range", *above)


def read_screen(spark: SparkSession, path) -> DataFrame:
    """Sketch screen results, six columns."""
    return spark.read.schema(schemas.SCREEN).csv(path, sep="\t", quote="")


def read_vcf(spark: SparkSession, path) -> DataFrame:
    """Variant rows without the header."""
    return spark.read.schema(schemas.VCF).csv(path, sep="\t", comment="#", quote="")


def read_sam(spark: SparkSession, path) -> DataFrame:
    """Aligned reads: the eleven fixed columns."""
    return spark.read.schema(schemas.SAM).csv(path, sep="\t", comment="@", quote="")


def read_mpileup(spark: SparkSession, path) -> DataFrame:
    """Pileup rows: reference, position, base, depth, bases, qualities."""
    return spark.read.schema(schemas.MPILEUP).csv(path, sep="\t", quote="")
