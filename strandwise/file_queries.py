"""Queries that write the driver's tables in the file formats and read them back, each with the DuckDB SQL of the same rows."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandwise.operators import clusters, intervals, report, taxonomy, variants
from strandwise.sources import readers, writers
from strandwise.storage import shared_folder
from strandwise.table_queries import TREE, Tables, _tree, query


def _folder(spark) -> str:
    """A new folder where driver and executors find what was written."""
    return f"{shared_folder(spark)}/files-{uuid.uuid4().hex}"


def _written(rows: DataFrame, groups: list[str], order: list[str]) -> str:
    """The path of text files of rows (value, ...): the lines of a group stand in one file, in order."""
    path = _folder(rows.sparkSession)
    rows.repartition(*groups).sortWithinPartitions(*groups, *order).select("value").write.text(path)
    return path


def _tabs(*columns):
    """Values as one line, nulls empty."""
    return F.concat_ws("\t", *[F.coalesce((F.col(c) if isinstance(c, str) else c).cast("string"), F.lit("")) for c in columns])


LETTERS_ONLY = "regexp_replace(text, '[^A-Za-z]', '', 'g')"


def _letters(c: str = "text"):
    return F.regexp_replace(c, "[^A-Za-z]", "")


@query(f"SELECT source AS taxid, doc_id::varchar AS seq_id, {LETTERS_ONLY} AS seq FROM documents WHERE text IS NOT NULL AND source IS NOT NULL")
def fasta_files(spark, d):
    docs = Tables(spark, d).documents.filter("text is not null and source is not null")
    path = _folder(spark)
    writers.write_fasta(docs.select(F.col("source").alias("taxid"), F.col("doc_id").cast("string").alias("seq_id"), _letters().alias("seq")), path, by="taxid", width=60, most=2000)
    return readers.read_fasta(spark, f"{path}/*").select(F.regexp_extract("file", "taxid=([^/]+)", 1).alias("taxid"), "seq_id", "seq")


@query(f"SELECT 'x' AS sample, conv_id || '_' || turn AS read_id, turn % 2 + 1 AS mate, {LETTERS_ONLY} AS seq, repeat('@', length({LETTERS_ONLY})) AS qual FROM conversations WHERE text IS NOT NULL")
def fastq_files(spark, d):
    turns = Tables(spark, d).conversations.filter("text is not null")
    value = F.concat(F.lit("@"), F.concat_ws("_", "conv_id", "turn"), F.lit("/"), F.col("turn") % 2 + 1, F.lit("\n"), _letters(), F.lit("\n+\n"), F.repeat(F.lit("@"), F.length(_letters())))
    path = _written(turns.select(value.alias("value"), "conv_id", "turn"), ["conv_id"], ["turn"])
    return readers.read_fastq(spark, path, "x").withColumn("mate", F.col("mate").cast("long"))


@query("SELECT l_orderkey::varchar AS query, l_partkey::varchar AS subject, l_shipdate::date::varchar AS title, l_tax AS pident, l_quantity::bigint AS length, l_discount AS evalue, l_extendedprice AS bitscore FROM lineitem")
def hit_files(spark, d):
    whole = [F.lit(0)] * 6
    value = _tabs("l_orderkey", "l_partkey", F.to_date("l_shipdate"), "l_tax", F.lit(50), F.lit(60), F.col("l_quantity").cast("long"), *whole, "l_discount", "l_extendedprice")
    path = _written(Tables(spark, d).lineitem.select(value.alias("value"), "l_orderkey"), ["l_orderkey"], [])
    return readers.read_hits(spark, path).select("query", "subject", "title", "pident", "length", "evalue", "bitscore")


@query("SELECT n_nationkey::int AS n_nationkey, n_name, NULL::int AS r_regionkey, NULL AS r_name FROM nation UNION ALL SELECT NULL, NULL, r_regionkey::int, r_name FROM region UNION ALL SELECT c_custkey::int, c_name, NULL, NULL FROM customer")
def table_files(spark, d):
    """Tables of several suffixes as one; an absent and an empty one are left out."""
    t, path = Tables(spark, d), _folder(spark)
    t.nation.select("n_nationkey", "n_name").write.csv(f"{path}/nation.tsv", sep="\t", header=True)
    t.region.select("r_regionkey", "r_name").write.csv(f"{path}/region.csv", header=True)
    t.customer.select(F.col("c_custkey").alias("n_nationkey"), F.col("c_name").alias("n_name")).write.csv(f"{path}/customer.txt", sep="\t", header=True)
    read = readers.read_tables(spark, [f"{path}/{name}" for name in ("nation.tsv", "region.csv", "absent.tsv", "customer.txt")])
    return read.select(F.col("n_nationkey").cast("int").alias("n_nationkey"), "n_name", F.col("r_regionkey").cast("int").alias("r_regionkey"), "r_name")


@query("SELECT p_brand AS sample, (p_size // 10)::bigint AS cluster, p_name AS centroid, length(p_name)::bigint AS size FROM part")
def cluster_json_files(spark, d):
    path = _folder(spark)
    own = Tables(spark, d).part.select(F.col("p_brand").alias("sample"), F.floor(F.col("p_size") / 10).alias("cluster"), F.col("p_name").alias("centroid"), F.length("p_name").alias("size"))
    writers.write_cluster_json(own, path, by=["sample", "cluster"])
    return spark.read.json(path).select("sample", F.col("cluster").cast("long").alias("cluster"), "centroid", "size")


@query("SELECT p_brand AS brand, coalesce(key, 'none') AS id, p_name AS name FROM (SELECT *, CASE WHEN p_size % 2 = 0 THEN p_partkey::varchar END AS key FROM part)")
def json_records(spark, d):
    """A file a brand, of one list of records each; those without an id take their file's name, of which "none" is left."""
    path = _folder(spark)
    record = F.struct(F.col("p_brand").alias("brand"), F.when(F.col("p_size") % 2 == 0, F.col("p_partkey").cast("string")).alias("id"), F.col("p_name").alias("name"))
    listed = Tables(spark, d).part.groupBy(F.col("p_brand").alias("folder")).agg(F.to_json(F.collect_list(record)).alias("value"))
    listed.write.partitionBy("folder").text(path)
    rows = readers.read_json_records(spark, f"{path}/*").select("brand", "id", "name")
    return rows.withColumn("id", F.when(F.col("id").startswith("part-"), "none").otherwise(F.col("id")))


@query("SELECT n_name AS name, max(value) FILTER (key = 'customers')::bigint AS customers, max(value) FILTER (key = 'balance')::bigint AS balance FROM (SELECT n_name, 'customers' AS key, count(*) AS value FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY 1 UNION ALL SELECT n_name, 'balance', floor(max(c_acctbal)) FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY 1) GROUP BY 1")
def key_value_files(spark, d):
    t, path = Tables(spark, d), _folder(spark)
    own = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey")).groupBy("n_name").agg(F.count("*").alias("customers"), F.floor(F.max("c_acctbal")).alias("balance"))
    pairs = own.select("n_name", F.explode(F.array(*[F.struct(F.lit(k).alias("k"), F.col(c).cast("string").alias("v")) for k, c in (("name", "n_name"), ("customers", "customers"), ("balance", "balance"))])).alias("p"))
    pairs.select("n_name", _tabs("p.k", "p.v").alias("value")).repartition("n_name").write.partitionBy("n_name").text(path)
    return readers.read_key_values(spark, f"{path}/*").select("name", F.col("customers").cast("long").alias("customers"), F.col("balance").cast("long").alias("balance"))


CLUSTERED = "SELECT p_size::bigint AS cluster, 'n' || p_partkey AS member, p_partkey = min(p_partkey) OVER (PARTITION BY p_size) AS is_centroid FROM part"


def _clustered(spark, d):
    part = Tables(spark, d).part
    first = part.groupBy("p_size").agg(F.min("p_partkey").alias("top"))
    return part.join(first, "p_size").select(F.col("p_size").alias("cluster"), F.concat(F.lit("n"), "p_partkey").alias("member"), F.concat(F.lit("n"), "top").alias("centroid"), (F.col("p_partkey") == F.col("top")).alias("is_centroid"), F.col("p_partkey").alias("n"))


@query(CLUSTERED)
def cdhit_files(spark, d):
    rows = _clustered(spark, d)
    lines = rows.select("cluster", "n", F.concat(F.lit("0\t10aa, >"), "member", F.lit("... "), F.when(F.col("is_centroid"), "*").otherwise("at 97.5%")).alias("value"))
    heads = rows.select("cluster").distinct().select("cluster", F.lit(-1).cast("long").alias("n"), F.concat(F.lit(">Cluster "), "cluster").alias("value"))
    return readers.read_cdhit(spark, _written(lines.unionAll(heads), ["cluster"], ["n"])).select("cluster", "member", "is_centroid")


@query(f"SELECT member, is_centroid, count(*) OVER (PARTITION BY cluster) AS n FROM ({CLUSTERED})")
def mmseqs_files(spark, d):
    """Clusters are numbered anew within a file, so their sizes are compared, not their numbers."""
    rows = _clustered(spark, d)
    path = _written(rows.select("cluster", "n", _tabs("centroid", "member").alias("value")), ["cluster"], ["n"])
    read = readers.read_mmseqs_members(spark, path)
    return read.join(read.groupBy("file", "cluster").agg(F.count("*").alias("n")), ["file", "cluster"]).select("member", "is_centroid", "n")


@query(CLUSTERED)
def uc_files(spark, d):
    rows = _clustered(spark, d)
    kind = F.when(F.col("is_centroid"), "S").otherwise("H")
    own = rows.select("cluster", "n", _tabs(kind, "cluster", F.lit(10), F.lit("99.0"), F.lit("+"), F.lit("0"), F.lit("0"), F.lit("10M"), "member", F.when(F.col("is_centroid"), "*").otherwise(F.col("centroid"))).alias("value"))
    sums = rows.groupBy("cluster").agg(F.count("*").alias("k"), F.min("centroid").alias("c")).select("cluster", F.lit(1 << 60).alias("n"), _tabs(F.lit("C"), "cluster", "k", F.lit("*"), F.lit("*"), F.lit("*"), F.lit("*"), F.lit("*"), "c", F.lit("*")).alias("value"))
    return readers.read_uc(spark, _written(own.unionAll(sums), ["cluster"], ["n"])).select("cluster", "member", "is_centroid")


@query("WITH m AS (SELECT p_size AS cluster, CASE WHEN p_partkey % 3 = 0 THEN 'ref_' ELSE 'NODE_' END || p_partkey AS member, p_partkey FROM part), o AS (SELECT *, row_number() OVER (PARTITION BY cluster ORDER BY member LIKE 'NODE%', p_partkey) AS place FROM m) SELECT cluster::varchar AS cluster, member, place = 1 AS is_centroid FROM o")
def membership_files(spark, d):
    """A cluster's centroid is its first name that is no contig's, else its first."""
    name = F.concat(F.when(F.col("p_partkey") % 3 == 0, "ref_").otherwise("NODE_"), "p_partkey")
    path = _written(Tables(spark, d).part.select("p_size", "p_partkey", _tabs(name, "p_size").alias("value")), ["p_size"], ["p_partkey"])
    return readers.read_membership(spark, path).select("cluster", "member", "is_centroid")


@query("SELECT p_brand AS sample, p_partkey::varchar AS ref, p_size::bigint AS length, p_partkey % 7 AS mapped, round(CASE WHEN total > 0 THEN 100.0 * (p_partkey % 7) / total ELSE 0.0 END + 1e-9, 6) AS percent FROM part JOIN (SELECT p_brand, sum(p_partkey % 7) AS total FROM part GROUP BY 1) USING (p_brand)")
def idxstats_files(spark, d):
    part, path = Tables(spark, d).part, _folder(spark)
    rows = part.select("p_brand", _tabs("p_partkey", "p_size", F.col("p_partkey") % 7, F.lit(0)).alias("value")).unionAll(part.select("p_brand").distinct().select("p_brand", F.lit("*\t0\t0\t9")))
    rows.repartition("p_brand").write.partitionBy("p_brand").text(path)
    read = readers.read_idxstats(spark, f"{path}/*")
    return read.select(F.url_decode(F.url_decode(F.regexp_extract("file", "p_brand=([^/]+)", 1))).alias("sample"), "ref", "length", "mapped", F.round(F.col("percent") + F.lit(1e-9), 6).alias("percent"))


@query(f"WITH RECURSIVE {TREE} SELECT taxid, parent_taxid, rank FROM tree")
def taxonomy_dump(spark, d):
    tree = _tree(Tables(spark, d))
    line = F.concat_ws("\t|\t", "taxid", F.coalesce("parent_taxid", "taxid"), "rank", F.lit(""))
    return readers.read_nodes(spark, _written(tree.select("taxid", line.alias("value")), ["taxid"], []))


@query("SELECT 'n' || n_nationkey AS taxid, 'r' || n_regionkey AS parent_taxid, 'F' AS rank, n_name AS name, 1::bigint AS direct_reads FROM nation UNION ALL SELECT 'r' || r_regionkey, '1', 'D', r_name, 0 FROM region UNION ALL SELECT 'c' || c_custkey, 'n' || c_nationkey, 'S', c_name, 2 FROM customer UNION ALL SELECT '0', NULL, 'U', 'unclassified', 9 FROM region")
def kraken_reports(spark, d):
    """A report a region: lines in depth-first order, names indented by their level."""
    t = Tables(spark, d)
    row = lambda level, rank, taxid, name, n: _tabs(F.lit("1.5"), F.lit(7), F.lit(n), F.lit(rank), taxid, F.concat(F.lit("  " * level), name))
    key = lambda k, c: F.concat(F.lit(k), c)
    own = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
    none = F.lit(-1).cast("long")
    order = lambda region, nation, customer: [F.col(region).cast("long").alias("a"), nation.cast("long").alias("b"), customer.cast("long").alias("c")]
    lines = t.region.select(*order("r_regionkey", F.lit(-3), none), row(0, "U", F.lit("0"), F.lit("unclassified"), 9).alias("value"))
    lines = lines.unionAll(t.region.select(*order("r_regionkey", F.lit(-2), none), row(0, "R", F.lit("1"), F.lit("root"), 0)))
    lines = lines.unionAll(t.region.select(*order("r_regionkey", F.lit(-1), none), row(1, "D", key("r", F.col("r_regionkey")), F.col("r_name"), 0)))
    lines = lines.unionAll(t.nation.select(*order("n_regionkey", F.col("n_nationkey"), none), row(2, "F", key("n", F.col("n_nationkey")), F.col("n_name"), 1)))
    lines = lines.unionAll(own.select(*order("n_regionkey", F.col("c_nationkey"), F.col("c_custkey")), row(3, "S", key("c", F.col("c_custkey")), F.col("c_name"), 2)))
    read = readers.read_kraken_report(spark, _written(lines, ["a"], ["b", "c"]))
    return read.filter("taxid <> '1'").select("taxid", "parent_taxid", "rank", "name", "direct_reads")


@query("SELECT p_partkey::varchar AS \"query-ID\", p_size || '/50' AS \"shared-hashes\", round(p_retailprice, 2) AS identity, p_size::bigint AS \"median-multiplicity\" FROM part")
def screen_files(spark, d):
    value = _tabs(F.round("p_retailprice", 2), F.concat("p_size", F.lit("/50")), "p_size", F.lit("0.0"), "p_partkey", "p_name")
    path = _written(Tables(spark, d).part.select("p_partkey", value.alias("value")), ["p_partkey"], [])
    return readers.read_screen(spark, path).select("query-ID", "shared-hashes", "identity", "median-multiplicity")


@query("SELECT 'p' || p_size AS chrom, p_partkey AS pos, substr(p_brand, 1, 1) AS ref, substr(p_type, 1, 2) AS alt, CASE WHEN p_size % 2 = 0 THEN 'PASS' ELSE 'ft;sb' END AS filter, 'DP=' || p_size AS info, 'GT:REF_DP' AS format, '1:' || p_partkey AS sample FROM part")
def vcf_files(spark, d):
    part, path = Tables(spark, d).part, _folder(spark)
    rows = part.select(F.concat(F.lit("p"), "p_size").alias("chrom"), F.col("p_partkey").alias("pos"), F.substring("p_brand", 1, 1).alias("ref"), F.substring("p_type", 1, 2).alias("alt"), F.when(F.col("p_size") % 2 == 0, "PASS").otherwise("ft;sb").alias("filter"), F.lit(1).alias("GT"), F.col("p_partkey").alias("REF_DP"), "p_size")
    writers.write_vcf(variants.sort_variants(rows), path, writers.vcf_header([("p1", 100)], "s"), F.concat(F.lit("DP="), "p_size"), ["GT", "REF_DP"])
    return readers.read_vcf(spark, path).select("chrom", "pos", "ref", "alt", "filter", "info", "format", "sample")


@query("SELECT l_orderkey || '/' || l_linenumber AS read_id, CASE WHEN l_linestatus = 'F' THEN 16 ELSE 0 END AS flag, l_partkey::varchar AS ref, day(l_shipdate)::bigint AS pos, l_quantity::bigint || 'M' AS cigar FROM lineitem")
def sam_files(spark, d):
    line = Tables(spark, d).lineitem
    value = _tabs(F.concat_ws("/", "l_orderkey", "l_linenumber"), F.when(F.col("l_linestatus") == "F", 16).otherwise(0), "l_partkey", F.dayofmonth("l_shipdate"), F.lit(60), F.concat(F.col("l_quantity").cast("long"), F.lit("M")), F.lit("*"), F.lit(0), F.lit(0), F.lit("*"), F.lit("*"))
    heads = line.select("l_partkey").distinct().select("l_partkey", F.concat(F.lit("@SQ\tSN:"), "l_partkey", F.lit("\tLN:31")).alias("value"))
    path = _written(line.select("l_partkey", value.alias("value")).unionAll(heads), ["l_partkey"], ["value"])
    return readers.read_sam(spark, path).select("read_id", "flag", "ref", "pos", "cigar")


@query("SELECT l_partkey::varchar AS chrom, day(l_shipdate)::bigint - 1 AS start, day(l_shipdate)::bigint AS \"end\" FROM lineitem GROUP BY l_partkey, day(l_shipdate) HAVING count(*) < 2")
def low_depth_files(spark, d):
    """Positions of less than two reads in mpileup rows, as intervals."""
    depth = Tables(spark, d).lineitem.groupBy("l_partkey", F.dayofmonth("l_shipdate").alias("pos")).agg(F.count("*").alias("n"))
    path = _written(depth.select("l_partkey", "pos", _tabs("l_partkey", "pos", F.lit("A"), "n", F.lit(".,"), F.lit("II")).alias("value")), ["l_partkey"], ["pos"])
    return intervals.low_depth(readers.read_mpileup(spark, path), 2)


@query("SELECT r_name AS name, count(*) AS nations FROM region JOIN nation ON r_regionkey = n_regionkey GROUP BY 1 UNION ALL SELECT c_mktsegment, count(*) FROM customer GROUP BY 1")
def tsv_files(spark, d):
    t, path = Tables(spark, d), _folder(spark)
    own = t.region.join(t.nation, F.col("r_regionkey") == F.col("n_regionkey")).groupBy(F.col("r_name").alias("name")).agg(F.count("*").alias("nations"))
    own = own.unionAll(t.customer.groupBy("c_mktsegment").agg(F.count("*")))
    assert writers.write_tsv(own, path, ["a comment"]) and not writers.write_tsv(own.limit(0), f"{path}-none")
    return spark.read.csv(path, sep="\t", header=True, comment="#", schema="name string, nations long")


TAXA = f"WITH RECURSIVE {TREE}, s AS (SELECT 'c' || o_custkey AS taxid, o_orderkey::varchar AS seq_id, o_orderpriority AS seq FROM orders), r AS (SELECT taxid, arg_min(ancestor, depth) AS resolved FROM closure WHERE ancestor LIKE 'n%' GROUP BY 1) SELECT resolved, seq_id, regexp_replace(seq, '[^A-Z]', '', 'g') AS seq FROM s JOIN r USING (taxid)"


@query(TAXA)
def taxon_fasta_files(spark, d):
    """Orders as sequences, put to the nation of their customer, in a file a nation."""
    t, path = Tables(spark, d), _folder(spark)
    calls = t.orders.select(F.col("o_orderkey").cast("string").alias("name"), F.lit("C").alias("flag"), F.concat(F.lit("c"), "o_custkey").alias("taxid"))
    tree = _tree(t)
    up = taxonomy.ancestors(tree)
    resolved = taxonomy.precluster(calls, calls, tree, up, "lca", "F")
    sequences = t.orders.select(F.col("o_orderkey").cast("string").alias("seq_id"), F.regexp_replace("o_orderpriority", "[^A-Z]", "").alias("seq"))
    writers.write_fasta(taxonomy.taxon_sequences(resolved, sequences), path, by="resolved", most=500)
    return readers.read_fasta(spark, f"{path}/*").select(F.regexp_extract("file", "resolved=([^/]+)", 1).alias("resolved"), "seq_id", "seq")


@query("SELECT user_id % 50 || '_' || user_id % 7 AS id, CASE WHEN user_id % 3 = 0 THEN 'constraint' ELSE 'other' END AS kind, count(*) AS n FROM events GROUP BY ALL")
def constraint_split(spark, d):
    """Rows of constraints and others apart, the mark taken off."""
    cluster = F.concat(F.col("user_id") % 7, F.when(F.col("user_id") % 3 == 0, "-CONSTRAINT").otherwise(""))
    own = Tables(spark, d).events.select((F.col("user_id") % 50).alias("sample"), cluster.alias("cluster"), F.lit("it1").alias("step"))
    fixed, other = report.split_constraints(own)
    both = fixed.withColumn("kind", F.lit("constraint")).unionByName(other.withColumn("kind", F.lit("other")), allowMissingColumns=True)
    return both.groupBy(F.concat_ws("_", "sample", "cluster").alias("id"), "kind").agg(F.count("*").alias("n"))


@query("SELECT p_partkey, regexp_extract(name, '_taxid([0-9]+)_', 1) AS taxid, (n_per * largest // 100000)::bigint AS n, round(n_per / 1000, 2) AS percent_n FROM (SELECT p_partkey, 'part_taxid' || p_size || '_x.fa' AS name, p_retailprice AS n_per, p_size::bigint AS largest FROM part)")
def derived_counts(spark, d):
    n, percent = clusters.n_counts(F.col("p_retailprice"), F.col("p_size"))
    name = F.concat(F.lit("part_taxid"), "p_size", F.lit("_x.fa"))
    return Tables(spark, d).part.select("p_partkey", clusters.taxid_from_file(name).alias("taxid"), n.cast("long").alias("n"), percent.alias("percent_n"))
