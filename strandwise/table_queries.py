"""The operators applied to the driver's tables, each with the DuckDB SQL of the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strandwise.operators import alignments, clusters, flow, graph, hits, intervals, reads, report, sheets, sketches, taxonomy, variants
from strandwise.storage import stored

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    """Registers a query under its function's name."""

    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


class Tables:
    """The tables of one folder, by name."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def __getattr__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")


# ------------------------------------------------------------------ hits: lineitem as hits, part as references


def _hits(t: Tables) -> DataFrame:
    text = lambda c: F.col(c).cast("string")
    return t.lineitem.select(text("l_orderkey").alias("query"), text("l_partkey").alias("subject"), F.col("l_discount").alias("evalue"), F.col("l_extendedprice").alias("bitscore"), F.col("l_quantity").cast("long").alias("length"), F.lit(50).cast("long").alias("qlen"), F.col("l_linenumber").cast("long").alias("line"), F.col("l_suppkey").alias("supp"), F.col("l_shipdate").cast("timestamp").cast("long").alias("shipped"))


HITS = "SELECT l_orderkey::varchar AS query, l_partkey::varchar AS subject, l_discount AS evalue, l_extendedprice AS bitscore, l_quantity::bigint AS length, 50::bigint AS qlen, l_linenumber::bigint AS line, l_suppkey AS supp, epoch(l_shipdate)::bigint AS shipped FROM lineitem"
FILTERED = f"SELECT *, length / qlen AS aligned FROM ({HITS}) WHERE evalue <= 0.05 AND bitscore >= 5000 AND length / qlen >= 0.8"


def _filtered(t: Tables) -> DataFrame:
    return hits.filter_hits(_hits(t), max_evalue=0.05, min_bitscore=5000, min_aligned=0.8)


@query(f"SELECT query, subject, evalue, bitscore, length, line, aligned FROM ({FILTERED})")
def hit_filter(spark, d):
    return _filtered(Tables(spark, d)).select("query", "subject", "evalue", "bitscore", "length", "line", "aligned")


def _best(t, n):
    order = [F.desc("bitscore"), F.col("evalue"), F.col("subject"), F.col("line"), F.col("supp"), F.col("shipped")]
    return hits.best_hits(_hits(t), n, order).select("query", "subject", "bitscore", "evalue", F.col("place").cast("long").alias("place"))


BEST = f"SELECT query, subject, bitscore, evalue, place FROM (SELECT *, row_number() OVER (PARTITION BY query ORDER BY bitscore DESC, evalue, subject, line, supp, shipped) AS place FROM ({HITS})) WHERE place <= "


@query(BEST + "1")
def best_hit(spark, d):
    return _best(Tables(spark, d), 1)


@query(BEST + "5")
def top5_hits(spark, d):
    return _best(Tables(spark, d), 5)


def _parts(t):
    return t.part.select(F.col("p_partkey").cast("string").alias("seq_id"), F.col("p_name").alias("seq"))


@query(f"SELECT p_partkey::varchar AS seq_id, p_name AS seq FROM part WHERE p_partkey::varchar IN (SELECT subject FROM ({FILTERED}))")
def hits_to_refs(spark, d):
    t = Tables(spark, d)
    return hits.matched_references(_filtered(t), _parts(t))[0]


@query(f"SELECT DISTINCT subject AS seq_id FROM ({FILTERED}) WHERE subject NOT IN (SELECT p_partkey::varchar FROM part WHERE p_size > 10)")
def missing_refs(spark, d):
    t = Tables(spark, d)
    return hits.matched_references(_filtered(t), _parts(t).join(t.part.filter("p_size > 10").select(F.col("p_partkey").cast("string").alias("seq_id")), "seq_id"))[1]


@query(f"SELECT o_orderkey::varchar AS seq_id, o_orderpriority AS seq FROM orders UNION ALL SELECT p_partkey::varchar, p_name FROM part WHERE p_partkey::varchar IN (SELECT subject FROM ({FILTERED}))")
def contigs_with_refs(spark, d):
    t = Tables(spark, d)
    contigs = t.orders.select(F.col("o_orderkey").cast("string").alias("seq_id"), F.col("o_orderpriority").alias("seq"))
    return hits.with_references(contigs, _filtered(t), _parts(t))


@query("SELECT page_id, regexp_extract(html, 'lang=\"([^\"]*)\"', 1) AS lang FROM pages")
def key_values(spark, d):
    t = Tables(spark, d)
    tag = F.regexp_extract("html", "<html [^>]*>", 0)
    return t.pages.select("page_id", hits.key_values(tag)["lang"].alias("lang"))


# ------------------------------------------------------------------ flow

@query("SELECT o_orderkey, c_custkey, c_name FROM orders JOIN customer ON o_custkey = c_custkey")
def keyed_joins(spark, d):
    t = Tables(spark, d)
    return flow.join_one(t.orders.withColumnRenamed("o_custkey", "key"), t.customer.withColumn("key", F.col("c_custkey")), ["key"]).select("o_orderkey", "c_custkey", "c_name")


@query("SELECT coalesce(d.doc_id, l.doc_id) AS doc_id, d.n_chars, l.toxic, coalesce(l.quality, d.n_chars) AS value FROM documents d FULL JOIN labels l ON d.doc_id = l.doc_id")
def outer_remainder(spark, d):
    t = Tables(spark, d)
    out = flow.join_remainder(t.documents.select("doc_id", "n_chars"), t.labels, ["doc_id"], {"value": ("quality", "n_chars")})
    return out.select("doc_id", "n_chars", "toxic", "value")


@query("SELECT c.c_custkey, s.s_suppkey, c_nationkey::bigint AS nation FROM customer c JOIN supplier s ON c_nationkey = s_nationkey")
def combine_by_key(spark, d):
    t = Tables(spark, d)
    out = flow.combine(t.customer.withColumn("nation", F.col("c_nationkey").cast("long")), t.supplier.withColumn("nation", F.col("s_nationkey").cast("long")), ["nation"])
    return out.select("c_custkey", "s_suppkey", "nation")


@query("SELECT n.n_name AS sample, r.r_name AS id FROM nation n JOIN region r ON r.r_regionkey % 2 = 0 OR n.n_name IN (SELECT n_name FROM nation WHERE n_regionkey = r.r_regionkey)")
def theta_assign(spark, d):
    t = Tables(spark, d)
    listed = t.nation.groupBy("n_regionkey").agg(F.concat_ws(";", F.collect_list("n_name")).alias("names"))
    constraints = t.region.join(listed, F.col("r_regionkey") == F.col("n_regionkey")).select(F.col("r_name").alias("id"), F.when(F.col("r_regionkey") % 2 == 1, F.col("names")).alias("samples"))
    return flow.assign_constraints(t.nation.select(F.col("n_name").alias("sample")), constraints).select("sample", "id")


@query("SELECT user_id, unnest(list_sort(list(event_id))) AS items, count(*) >= 3 AS complete FROM events GROUP BY user_id")
def group_transpose(spark, d):
    t = Tables(spark, d)
    grouped = flow.group_rows(t.events.withColumn("expected", F.lit(3)), ["user_id"], "event_id", "expected")
    return flow.transpose(grouped, "items").select("user_id", "items", "complete")


@query("SELECT event_id, CASE WHEN value > 50 THEN 'high' WHEN event_type = 'click' THEN 'click' ELSE 'other' END AS branch FROM events UNION ALL SELECT o_orderkey, 'order' FROM orders")
def branch_mix(spark, d):
    t = Tables(spark, d)
    split = flow.branch(t.events, {"high": F.col("value") > 50, "click": F.col("event_type") == "click"})
    return flow.mix(split.select("event_id", "branch"), t.orders.select(F.col("o_orderkey").alias("event_id"), F.lit("order").alias("branch")))


@query("SELECT e.user_id, n, top FROM (SELECT user_id, count(*) AS n FROM events GROUP BY 1) e JOIN (SELECT user_id, max(value) AS top FROM events GROUP BY 1) m ON e.user_id = m.user_id")
def multi_map(spark, d):
    views = flow.multi_map(Tables(spark, d).events, ids=["user_id"], values=["user_id", "value"])
    return views["ids"].groupBy("user_id").agg(F.count("*").alias("n")).join(views["values"].groupBy("user_id").agg(F.max("value").alias("top")), "user_id")


@query("SELECT c_name AS name, c_mktsegment AS segment, c_acctbal AS balance FROM customer UNION ALL SELECT s_name, NULL, s_acctbal FROM supplier")
def union_by_name(spark, d):
    t = Tables(spark, d)
    a = t.customer.select(F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment"), F.col("c_acctbal").alias("balance"))
    return flow.mix(a, t.supplier.select(F.col("s_acctbal").alias("balance"), F.col("s_name").alias("name"))).select("name", "segment", "balance")


@query("SELECT DISTINCT event_type, user_id FROM events")
def distinct_collect(spark, d):
    return Tables(spark, d).events.select("event_type", "user_id").distinct()


@query("SELECT page_id, regexp_replace(url, '[|/\\\\]', '-', 'g') AS name FROM pages")
def clean_names(spark, d):
    return Tables(spark, d).pages.select("page_id", flow.clean_name(F.col("url")).alias("name"))


@query("SELECT source AS sample, 'low reads' AS kind, n_chars::varchar AS detail FROM documents WHERE n_chars < 200 UNION ALL SELECT lang, 'long', n_chars::varchar FROM documents WHERE n_chars > 10000")
def failures(spark, d):
    docs = Tables(spark, d).documents
    return flow.failure_report(docs, "low reads", F.col("n_chars") < 200, "source", "n_chars").unionAll(flow.failure_report(docs, "long", F.col("n_chars") > 10000, "lang", "n_chars"))


@query("SELECT page_id, list_filter(['url', 'unique url'], lambda r: CASE WHEN r = 'url' THEN NOT coalesce(regexp_matches(url, '^https://'), false) ELSE n > 1 END)::varchar[] AS failed FROM (SELECT *, count(*) OVER (PARTITION BY url) AS n FROM pages) WHERE n > 1 OR NOT coalesce(regexp_matches(url, '^https://'), false)")
def sheet_validation(spark, d):
    _, bad = sheets.validate(Tables(spark, d).pages, {"url": "^https://"}, unique=[["url"]])
    return bad.select("page_id", "failed")


@query("SELECT conv_id::varchar AS sample FROM conversations GROUP BY conv_id HAVING count(DISTINCT role) > 1")
def mixed_roles(spark, d):
    return sheets.mixed_endedness(Tables(spark, d).conversations.select(F.col("conv_id").cast("string").alias("sample"), F.col("role").alias("single_end")))


# ------------------------------------------------------------------ taxonomy: region > nation > customer, supplier


def _tree(t: Tables) -> DataFrame:
    root = t.region.sparkSession.createDataFrame([("1", None, "R")], "taxid string, parent_taxid string, rank string")
    node = lambda df, k, key, p, parent, rank: df.select(F.concat(F.lit(k), key).alias("taxid"), (F.concat(F.lit(p), parent) if parent else F.lit("1")).alias("parent_taxid"), F.lit(rank).alias("rank"))
    return root.unionAll(node(t.region, "r", "r_regionkey", "", None, "D")).unionAll(node(t.nation, "n", "n_nationkey", "r", "n_regionkey", "F")).unionAll(node(t.customer, "c", "c_custkey", "n", "c_nationkey", "S")).unionAll(node(t.supplier, "s", "s_suppkey", "n", "s_nationkey", "S"))


TREE = """tree AS (SELECT '1' AS taxid, NULL::varchar AS parent_taxid, 'R' AS rank UNION ALL SELECT 'r' || r_regionkey, '1', 'D' FROM region
 UNION ALL SELECT 'n' || n_nationkey, 'r' || n_regionkey, 'F' FROM nation UNION ALL SELECT 'c' || c_custkey, 'n' || c_nationkey, 'S' FROM customer
 UNION ALL SELECT 's' || s_suppkey, 'n' || s_nationkey, 'S' FROM supplier),
closure AS (SELECT taxid, taxid AS ancestor, 0::bigint AS depth FROM tree UNION ALL SELECT c.taxid, t.parent_taxid, depth + 1 FROM closure c JOIN tree t ON c.ancestor = t.taxid WHERE t.parent_taxid IS NOT NULL)"""
WITH = f"WITH RECURSIVE {TREE} "


@query(WITH + "SELECT taxid, ancestor, depth FROM closure")
def ancestors(spark, d):
    return taxonomy.ancestors(_tree(Tables(spark, d))).select("taxid", "ancestor", F.col("depth").cast("long").alias("depth"))


@query(WITH + "SELECT ancestor AS taxid, count(*) AS n, max(depth) AS deepest FROM closure GROUP BY 1")
def descendants(spark, d):
    return taxonomy.descendants(taxonomy.ancestors(_tree(Tables(spark, d)))).groupBy("taxid").agg(F.count("*").alias("n"), F.max("depth").cast("long").alias("deepest"))


def _calls(t: Tables):
    line = t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey")).join(t.customer, F.col("o_custkey") == F.col("c_custkey")).join(t.supplier, F.col("l_suppkey") == F.col("s_suppkey"))
    one = line.groupBy("l_orderkey").agg(F.min("c_nationkey").alias("n"), F.min("c_acctbal").alias("bal"), F.min("l_suppkey").alias("s"), F.min("l_partkey").alias("p"))
    first = one.select(F.col("l_orderkey").cast("string").alias("name"), F.when(F.col("bal") > 0, "C").otherwise("U").alias("flag"), F.when(F.col("bal") > 0, F.concat(F.lit("n"), "n")).otherwise("0").alias("taxid"))
    second = one.select(F.col("l_orderkey").cast("string").alias("name"), F.when(F.col("p") % 5 > 0, "C").otherwise("U").alias("flag"), F.when(F.col("p") % 5 > 0, F.concat(F.lit("s"), "s")).otherwise("0").alias("taxid"))
    return first, second


CALLS = WITH + """, one AS (SELECT l_orderkey, min(c_nationkey) AS n, min(c_acctbal) AS bal, min(l_suppkey) AS s, min(l_partkey) AS p FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey JOIN supplier ON l_suppkey = s_suppkey GROUP BY 1),
calls AS (SELECT l_orderkey::varchar AS name, CASE WHEN bal > 0 THEN 'C' ELSE 'U' END AS f1, CASE WHEN bal > 0 THEN 'n' || n ELSE '0' END AS a, CASE WHEN p % 5 > 0 THEN 'C' ELSE 'U' END AS f2, CASE WHEN p % 5 > 0 THEN 's' || s ELSE '0' END AS b FROM one),
lca AS (SELECT a, b, arg_min(x.ancestor, x.depth) AS lca FROM (SELECT DISTINCT a, b FROM calls) JOIN closure x ON x.taxid = a JOIN closure y ON y.taxid = b AND y.ancestor = x.ancestor GROUP BY 1, 2) """


@query(CALLS + "SELECT name, a, b, lca FROM calls LEFT JOIN lca USING (a, b)")
def lca_pairs(spark, d):
    t = Tables(spark, d)
    one, two = _calls(t)
    pairs = one.select("name", F.col("taxid").alias("a")).join(two.select("name", F.col("taxid").alias("b")), "name")
    return taxonomy.common_ancestor(pairs, taxonomy.ancestors(_tree(t))).select("name", "a", "b", "lca")


MERGED = """SELECT name, CASE WHEN f1 = 'U' AND f2 = 'C' THEN f2 ELSE f1 END AS flag, CASE WHEN f1 = 'U' AND f2 = 'C' THEN b WHEN (f1 = 'C' AND f2 = 'U') OR a = b THEN a WHEN lca = a THEN b WHEN lca = b THEN a ELSE coalesce(lca, '1') END AS taxid FROM calls LEFT JOIN lca USING (a, b)"""


@query(CALLS + MERGED)
def merge_classifiers(spark, d):
    t = Tables(spark, d)
    return taxonomy.merge_classifiers(*_calls(t), taxonomy.ancestors(_tree(t)), "lowest")


SIMPLE = ", levels(rank, level) AS (VALUES ('R', 9), ('D', 8), ('F', 3), ('S', 1)), nearest AS (SELECT c.taxid, arg_min(c.ancestor, c.depth) AS resolved FROM closure c JOIN tree t ON t.taxid = c.ancestor JOIN levels USING (rank) WHERE level >= 3 GROUP BY 1) "


@query(WITH + SIMPLE + "SELECT taxid, resolved FROM nearest")
def simplify_rank(spark, d):
    tree = _tree(Tables(spark, d))
    return taxonomy.simplify_to_rank(tree.select("taxid"), tree, taxonomy.ancestors(tree), "F")


@query(CALLS.replace("lca AS", "x0 AS (SELECT 1), lca AS") + SIMPLE + f"SELECT m.name, m.flag, m.taxid, n.resolved FROM ({MERGED}) m JOIN nearest n ON m.taxid = n.taxid WHERE m.flag <> 'U' AND m.taxid <> '0'")
def precluster_report(spark, d):
    t = Tables(spark, d)
    tree = _tree(t)
    return taxonomy.precluster(*_calls(t), tree, taxonomy.ancestors(tree), "lowest", "F").select("name", "flag", "taxid", "resolved")


@query(WITH + "SELECT DISTINCT taxid FROM closure WHERE ancestor IN ('r1', 'n3') AND taxid NOT IN (SELECT taxid FROM closure WHERE ancestor = 'n7') AND taxid <> 'n8'")
def include_exclude(spark, d):
    tree = _tree(Tables(spark, d))
    up = taxonomy.ancestors(tree)
    pick = lambda *ids: tree.filter(F.col("taxid").isin(*ids)).select("taxid")
    ids = lambda df: df.select(F.col("taxid").alias("id"))
    return flow.include_exclude(ids(taxonomy.relatives(pick("r1", "n3"), up)), ids(taxonomy.relatives(pick("n7"), up)), ids(pick("n8"))).select(F.col("id").alias("taxid"))


def _counts(t):
    return t.orders.groupBy(F.concat(F.lit("c"), "o_custkey").alias("taxid"), F.col("o_orderpriority").alias("sample")).agg(F.count("*").alias("reads"))


COUNTS = ", counts AS (SELECT 'c' || o_custkey AS taxid, o_orderpriority AS sample, count(*) AS reads FROM orders GROUP BY 1, 2) "


@query(WITH + COUNTS + "SELECT sample, ancestor AS taxid, sum(reads)::bigint AS reads, round(100 * sum(reads) / any_value(total), 6) AS percent FROM counts JOIN closure USING (taxid) JOIN (SELECT sample, sum(reads) AS total FROM counts GROUP BY 1) USING (sample) WHERE ancestor LIKE 'n%' GROUP BY 1, 2")
def taxon_table(spark, d):
    t = Tables(spark, d)
    tree = _tree(t)
    return taxonomy.taxon_table(_counts(t), tree, taxonomy.ancestors(tree), "F").withColumn("percent", F.round("percent", 6))


@query(WITH + COUNTS + "SELECT ancestor AS taxid, sum(reads)::bigint AS clade_reads, coalesce(sum(reads) FILTER (depth = 0), 0)::bigint AS direct_reads FROM counts JOIN closure USING (taxid) GROUP BY 1")
def clade_report(spark, d):
    t = Tables(spark, d)
    return taxonomy.clade_counts(_counts(t), taxonomy.ancestors(_tree(t)))


@query(WITH + ", w AS (SELECT 'c' || c_custkey AS leaf, c_custkey::double AS weight FROM customer), s AS (SELECT ancestor AS taxid, leaf, weight / sum(weight) OVER (PARTITION BY ancestor) AS share FROM closure JOIN w ON closure.taxid = leaf), k AS (SELECT 'n' || c_nationkey AS taxid, count(*) AS reads FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1) SELECT leaf AS taxid, round(sum(reads * share), 6) AS reads FROM k JOIN s USING (taxid) GROUP BY 1")
def reestimate(spark, d):
    t = Tables(spark, d)
    weights = t.customer.select(F.concat(F.lit("c"), "c_custkey").alias("taxid"), F.col("c_custkey").cast("double").alias("weight"))
    counts = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).groupBy(F.concat(F.lit("n"), "c_nationkey").alias("taxid")).agg(F.count("*").alias("reads"))
    return taxonomy.reestimate(counts, weights, taxonomy.ancestors(_tree(t))).withColumn("reads", F.round("reads", 6))


@query("SELECT 'root;' || r_name || ';' || replace(n_name, '_', ' ') AS lineage, count(*) AS reads FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY 1")
def lineage_rows(spark, d):
    t = Tables(spark, d)
    names = t.nation.select(F.concat(F.lit("n"), "n_nationkey").alias("taxid"), F.concat(F.lit("f__"), "n_name").alias("name")).unionAll(t.region.select(F.concat(F.lit("r"), "r_regionkey"), F.concat(F.lit("d__"), "r_name"))).unionAll(_tree(t).filter("taxid = '1'").select("taxid", F.lit("root")))
    counts = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).groupBy(F.concat(F.lit("n"), "c_nationkey").alias("taxid")).agg(F.count("*").alias("reads"))
    return taxonomy.lineage_rows(counts, taxonomy.ancestors(_tree(t)), names)


# ------------------------------------------------------------------ clusters: lineitem as cluster members


def _members(t):
    name = F.concat(F.when(F.col("l_returnflag") == "A", "NODE_").when(F.col("l_returnflag") == "N", "TRINITY_").otherwise("k1_"), F.col("l_orderkey"), F.lit("_"), "l_linenumber")
    return t.lineitem.select((F.col("l_orderkey") % 20).cast("string").alias("sample"), (F.col("l_partkey") % 50).alias("cluster"), name.alias("seq_id"), F.col("l_quantity").alias("percent")).groupBy("sample", "cluster", "seq_id").agg(F.sum("percent").alias("percent"))


MEMBERS = "SELECT (l_orderkey % 20)::varchar AS sample, l_partkey % 50 AS cluster, CASE l_returnflag WHEN 'A' THEN 'NODE_' WHEN 'N' THEN 'TRINITY_' ELSE 'k1_' END || l_orderkey || '_' || l_linenumber AS seq_id, sum(l_quantity) AS percent FROM lineitem GROUP BY 1, 2, 3"


def _depth(t):
    m = _members(t)
    return clusters.cluster_depth(m.select("sample", "cluster", "seq_id"), m.groupBy("sample", "seq_id").agg(F.sum("percent").alias("percent")))


DEPTH_ALL = f"WITH m AS ({MEMBERS}), dep AS (SELECT sample, seq_id, sum(percent) AS percent FROM m GROUP BY 1, 2) SELECT m.sample, m.cluster, coalesce(sum(dep.percent) FILTER (m.seq_id LIKE 'NODE%'), 0) AS spades, coalesce(sum(dep.percent) FILTER (m.seq_id LIKE 'k1%'), 0) AS megahit, coalesce(sum(dep.percent) FILTER (m.seq_id LIKE 'TRINITY%'), 0) AS trinity FROM m JOIN dep USING (sample, seq_id) GROUP BY 1, 2"


@query(DEPTH_ALL)
def cluster_depth(spark, d):
    return _depth(Tables(spark, d))


@query(f"SELECT sample, cluster, spades, megahit, trinity FROM (SELECT *, row_number() OVER (PARTITION BY sample ORDER BY spades + megahit + trinity DESC, cluster) AS place, max(greatest(spades, megahit, trinity)) OVER (PARTITION BY sample) AS top FROM ({DEPTH_ALL})) WHERE greatest(spades, megahit, trinity) >= 1000 OR (top < 1000 AND place <= 5)")
def cluster_filter(spark, d):
    return clusters.filter_clusters(_depth(Tables(spark, d)), ["spades", "megahit", "trinity"], threshold=1000, keep_n=5)


def _flagged(t):
    w = Window.partitionBy("sample", "cluster").orderBy("seq_id")
    return _members(t).withColumn("is_centroid", F.row_number().over(w) == 1)


FLAGGED = f"SELECT *, row_number() OVER (PARTITION BY sample, cluster ORDER BY seq_id) = 1 AS is_centroid FROM ({MEMBERS})"


@query(f"SELECT sample, count(*) AS clusters, round(avg(size), 6) AS mean_size, count(*) FILTER (size = 0) AS singletons FROM (SELECT sample, cluster, count(*) FILTER (NOT is_centroid) AS size FROM ({FLAGGED}) GROUP BY 1, 2) GROUP BY 1")
def cluster_summary(spark, d):
    return clusters.cluster_summary(clusters.cluster_sizes(_flagged(Tables(spark, d)))).withColumn("mean_size", F.round("mean_size", 6))


@query(f"SELECT sample, cluster, seq_id, is_centroid, external_reference FROM (SELECT *, max(seq_id LIKE '%NODE%') OVER w AS found, max(is_centroid AND NOT seq_id LIKE '%NODE%') OVER w AS external_reference FROM ({FLAGGED}) WINDOW w AS (PARTITION BY sample, cluster)) WHERE found AND (seq_id LIKE '%NODE%' OR is_centroid)")
def cluster_members(spark, d):
    return clusters.filter_members(_flagged(Tables(spark, d)), "(NODE)").select("sample", "cluster", "seq_id", "is_centroid", "external_reference")


@query(f"SELECT sample, cluster, 'cl' || (dense_rank() OVER (ORDER BY sample, cluster) - 1) AS cluster_id FROM (SELECT DISTINCT sample, cluster FROM ({MEMBERS}))")
def renumber(spark, d):
    return clusters.renumber(_members(Tables(spark, d)).select("sample", "cluster").distinct(), ["sample", "cluster"])


@query(f"SELECT f.sample, f.cluster, spades, megahit, trinity, size FROM (SELECT sample, cluster, spades, megahit, trinity FROM ({DEPTH_ALL}) WHERE greatest(spades, megahit, trinity) >= 1000) f JOIN (SELECT sample, cluster, count(*) FILTER (NOT is_centroid) AS size FROM ({FLAGGED}) GROUP BY 1, 2) s USING (sample, cluster)")
def cluster_report(spark, d):
    t = Tables(spark, d)
    m = _flagged(t)
    return clusters.extract_clusters(m.drop("percent"), m.groupBy("sample", "seq_id").agg(F.sum("percent").alias("percent")), 1000, 0).select("sample", "cluster", "spades", "megahit", "trinity", "size")


@query("SELECT doc_id, length(text) >= 500 AND floor(100 * len(regexp_extract_all(text, 'N')) / length(text)) <= 1 AS passed FROM documents WHERE length(text) > 0")
def contig_quality(spark, d):
    good, bad = clusters.split_by_quality(Tables(spark, d).documents.filter("length(text) > 0").withColumn("seq", F.col("text")), 500, 1)
    return good.select("doc_id", F.lit(True).alias("passed")).unionAll(bad.select("doc_id", F.lit(False)))


@query("WITH o AS (SELECT source AS sample, length(text) AS n, row_number() OVER (PARTITION BY source ORDER BY length(text) DESC) AS i, sum(length(text)) OVER (PARTITION BY source ORDER BY length(text) DESC ROWS UNBOUNDED PRECEDING) AS s, sum(length(text)) OVER (PARTITION BY source) AS total FROM documents) SELECT sample, count(*) AS contigs, any_value(total)::bigint AS total, max(n) AS largest, max(n) FILTER (s >= total / 2) AS n50, min(i) FILTER (s >= total / 2) AS l50 FROM o GROUP BY 1")
def assembly_stats(spark, d):
    docs = Tables(spark, d).documents.select(F.col("source").alias("sample"), F.length("text").cast("long").alias("length"))
    return clusters.assembly_stats(docs)


# ------------------------------------------------------------------ graph

PAIRS = "SELECT s.s_suppkey AS a, min(t.s_suppkey) AS b FROM supplier s JOIN supplier t ON s.s_nationkey = t.s_nationkey AND t.s_suppkey < s.s_suppkey AND abs(s.s_acctbal - t.s_acctbal) < 4000 GROUP BY 1"


@query(f"WITH RECURSIVE e AS (SELECT a, b FROM ({PAIRS}) UNION ALL SELECT b, a FROM ({PAIRS})), r AS (SELECT s_suppkey AS id, s_suppkey AS c FROM supplier UNION SELECT r.id, e.b FROM r JOIN e ON r.c = e.a) SELECT id, min(c) AS component, dense_rank() OVER (ORDER BY min(c)) - 1 AS cluster FROM r GROUP BY id")
def components(spark, d):
    s = Tables(spark, d).supplier.select("s_suppkey", "s_nationkey", "s_acctbal")
    o = s.toDF("t_suppkey", "t_nationkey", "t_acctbal")
    near = s.join(o, F.col("s_nationkey") == F.col("t_nationkey")).filter("t_suppkey < s_suppkey").withColumn("weight", F.abs(F.col("s_acctbal") - F.col("t_acctbal")))
    edges = near.filter("weight < 4000").groupBy(F.col("s_suppkey").alias("src")).agg(F.min("t_suppkey").alias("dst"))
    found = graph.connected_components(s.select(F.col("s_suppkey").alias("id")), edges)
    return found.join(graph.membership(found), "id").select("id", "component", "cluster")


NEAR = "SELECT s.s_suppkey AS a, t.s_suppkey AS b FROM supplier s JOIN supplier t ON s.s_nationkey = t.s_nationkey AND t.s_suppkey <> s.s_suppkey AND abs(s.s_acctbal - t.s_acctbal) < 4000"


@query(f"WITH RECURSIVE e AS ({NEAR}), r AS (SELECT s_suppkey AS id, s_suppkey AS c FROM supplier UNION SELECT r.id, e.b FROM r JOIN e ON r.c = e.a) SELECT id, min(c) AS component, dense_rank() OVER (ORDER BY min(c)) - 1 AS cluster FROM r GROUP BY id")
def components_all_edges(spark, d):
    s = Tables(spark, d).supplier.select(F.col("s_suppkey").alias("id"), "s_nationkey", "s_acctbal")
    found = graph.connected_components(s, graph.near_values(s, "s_nationkey", "s_acctbal", 4000))
    return found.join(graph.membership(found), "id").select("id", "component", "cluster")


# ------------------------------------------------------------------ pileup: letters of documents by place, per language


def _letters(t):
    docs = t.documents.filter("text <> ''").select(F.col("lang").alias("ref"), F.posexplode(F.split(F.translate("text", "acgt", "ACGT"), "")).alias("p", "kind"), F.col("doc_id"))
    return docs.select("ref", (F.col("p") + 1).cast("long").alias("pos"), F.col("kind"), "doc_id")


LETTERS = "SELECT lang AS ref, generate_subscripts(l, 1) AS pos, unnest(l) AS kind, doc_id FROM (SELECT lang, doc_id, string_split(translate(text, 'acgt', 'ACGT'), '') AS l FROM documents WHERE text <> '')"
PILE = f"""SELECT ref, pos, count(*) FILTER (kind = 'A') AS "A", count(*) FILTER (kind = 'C') AS "C", count(*) FILTER (kind = 'G') AS "G", count(*) FILTER (kind = 'T') AS "T", count(*) FILTER (kind = ' ') AS ins, count(*) FILTER (kind = '.') AS del FROM ({LETTERS}) GROUP BY 1, 2"""


def _pile(t):
    kind = F.when(F.col("kind") == " ", "ins").when(F.col("kind") == ".", "del").otherwise(F.col("kind"))
    return alignments.pileup(_letters(t).withColumn("kind", kind), ["ref", "pos"])


@query(PILE)
def pileup(spark, d):
    return _pile(Tables(spark, d))


PART = lambda b: f"""CASE WHEN "{b}" > 0 THEN -("{b}" / n) * log2("{b}" / n) ELSE 0 END"""
ENTROPY = " + ".join(PART(b) for b in "ACGT")
TOP = 'greatest("A", "C", "G", "T")'


@query(f"""SELECT ref, pos, CASE WHEN n > 0 THEN round({ENTROPY}, 2) ELSE 0.0 END AS entropy, CASE WHEN n = 0 OR {TOP} / n < 0.7 THEN 'N' WHEN "A" = {TOP} THEN 'A' WHEN "C" = {TOP} THEN 'C' WHEN "G" = {TOP} THEN 'G' ELSE 'T' END AS base FROM (SELECT *, ("A" + "C" + "G" + "T") AS n FROM ({PILE}))""")
def entropy(spark, d):
    n = alignments.depth()
    part = lambda x: F.when(F.col(x) > 0, -(F.col(x) / n) * F.log2(F.col(x) / n)).otherwise(0.0)
    piled = _pile(Tables(spark, d))
    exact = F.when(n > 0, F.round(part("A") + part("C") + part("G") + part("T"), 2)).otherwise(0.0)
    return piled.select("ref", "pos", exact.alias("entropy"), alignments.majority_base(0.7).alias("base"))


MASK = " + ".join(f"""(CASE WHEN "{b}" = {TOP} THEN {v} ELSE 0 END)""" for b, v in (("A", 1), ("C", 2), ("G", 4), ("T", 8)))


@query(f"""SELECT ref, string_agg(CASE WHEN n >= 10 THEN substr('NACMGRSVTWYHKDBN', ({MASK})::int + 1, 1) ELSE 'N' END, '' ORDER BY pos) AS seq FROM (SELECT *, ("A" + "C" + "G" + "T") AS n FROM ({PILE})) GROUP BY 1""")
def consensus_seq(spark, d):
    return alignments.consensus(_pile(Tables(spark, d)), ["ref"], 10)


def _first_letters(t):
    """(ref, pos, base): each place's letter in the first document that has the place. Id and code point pack into one number,
    so that the least is found by hash aggregation; ids from 0 to 2**42 fit, others are an error."""
    packed = F.when(F.col("doc_id").between(0, (1 << 42) - 1), F.col("doc_id") * (1 << 21) + F.ascii("kind")).otherwise(F.raise_error(F.lit("doc_id doesn't fit in 42 bits")).cast("long"))
    letters = _letters(t).select("ref", "pos", packed.alias("packed"))
    least = letters.groupBy("ref", "pos").agg(F.min("packed").alias("packed"))
    code = F.lpad(F.hex(F.pmod("packed", F.lit(1 << 21))), 8, "0")
    return least.select("ref", "pos", F.decode(F.unhex(code), "UTF-32").alias("base"))


def _called(t):
    first = _first_letters(t).withColumnRenamed("base", "ref_base")
    return variants.call_variants(_pile(t).join(first, ["ref", "pos"]), ["ref", "pos"], 10, 0.25)


CALLED = f"""SELECT p.ref, p.pos, f.ref_base, v.alt, CASE f.ref_base WHEN 'A' THEN "A" WHEN 'C' THEN "C" WHEN 'G' THEN "G" WHEN 'T' THEN "T" ELSE 0 END AS ref_depth, v.k AS alt_depth, "A" + "C" + "G" + "T" AS total, v.k / ("A" + "C" + "G" + "T") AS freq
FROM ({PILE}) p JOIN (SELECT ref, pos, arg_min(kind, doc_id) AS ref_base FROM ({LETTERS}) GROUP BY 1, 2) f USING (ref, pos), LATERAL (VALUES ('A', "A"), ('C', "C"), ('G', "G"), ('T', "T")) v(alt, k)
WHERE "A" + "C" + "G" + "T" >= 10 AND v.alt <> f.ref_base AND v.k / ("A" + "C" + "G" + "T") >= 0.25"""


@query(CALLED)
def call_variants(spark, d):
    return _called(Tables(spark, d))


@query(f"SELECT * FROM ({CALLED}) WHERE freq >= 0.4")
def variant_filter(spark, d):
    return variants.filter_frequency(_called(Tables(spark, d)), 0.4)


@query(f"SELECT ref, count(*) FILTER (ref_base IN ('A', 'G') AND alt IN ('A', 'G') OR ref_base IN ('C', 'T') AND alt IN ('C', 'T')) AS ts, count(*) AS snps FROM ({CALLED}) GROUP BY 1")
def variant_stats(spark, d):
    called = _called(Tables(spark, d)).withColumnRenamed("ref", "key").withColumnRenamed("ref_base", "ref")
    return variants.variant_stats(called, ["key"]).select(F.col("key").alias("ref"), "ts", "snps")


@query("SELECT p_partkey, CASE WHEN p_size % 3 = 0 THEN 'INS' WHEN p_size % 3 = 1 THEN 'DEL' ELSE 'SNP' END AS type, CASE WHEN p_size % 3 = 1 THEN 'A' || substr(p_brand, 1, 2) ELSE 'A' END AS ref, CASE WHEN p_size % 3 = 0 THEN 'A' || substr(p_brand, 1, 2) WHEN p_size % 3 = 1 THEN 'A' ELSE substr(p_brand, 1, 2) END AS alt FROM part")
def variant_type(spark, d):
    p = Tables(spark, d).part
    sign = F.when(F.col("p_size") % 3 == 0, "+").when(F.col("p_size") % 3 == 1, "-").otherwise("")
    return variants.typed(p.select("p_partkey", F.lit("A").alias("ref"), F.concat(sign, F.substring("p_brand", 1, 2)).alias("alt"))).select("p_partkey", "type", "ref", "alt")


@query("SELECT p_type AS sample, count(*) FILTER (p_size % 3 = 2) AS \"SNP\", count(*) FILTER (p_size % 3 = 0) AS \"INS\", count(*) FILTER (p_size % 3 = 1) AS \"DEL\" FROM part GROUP BY 1")
def variant_counts(spark, d):
    p = Tables(spark, d).part
    sign = F.when(F.col("p_size") % 3 == 0, "+T").when(F.col("p_size") % 3 == 1, "-T").otherwise("T")
    return variants.variant_counts(variants.typed(p.select(F.col("p_type").alias("sample"), F.lit("A").alias("ref"), sign.alias("alt"))), "sample")


@query("SELECT p_partkey, unnest(string_split(p_name, ' ')) AS alt, generate_subscripts(string_split(p_name, ' '), 1) AS allele FROM part")
def split_alleles(spark, d):
    p = Tables(spark, d).part.select("p_partkey", F.regexp_replace("p_name", " ", ",").alias("alt"))
    return variants.split_alleles(p).select("p_partkey", "alt", F.col("allele").cast("long").alias("allele"))


@query("""WITH t AS (SELECT l_suppkey, count(*) FILTER (l_returnflag = 'A' AND l_linestatus = 'F') AS a, count(*) FILTER (l_returnflag = 'A' AND l_linestatus = 'O') AS b, count(*) FILTER (l_returnflag = 'N' AND l_linestatus = 'F') AS c, count(*) FILTER (l_returnflag = 'N' AND l_linestatus = 'O') AS d FROM lineitem GROUP BY 1),
p AS (SELECT l_suppkey, sum(exp(lgamma(a + b + 1) + lgamma(c + d + 1) + lgamma(a + c + 1) + lgamma(b + d + 1) - lgamma(a + b + c + d + 1) - lgamma(x + 1) - lgamma(a + b - x + 1) - lgamma(a + c - x + 1) - lgamma(d - a + x + 1))) AS p FROM t, LATERAL (SELECT unnest(range(a, least(a + b, a + c) + 1)) AS x) r GROUP BY 1)
SELECT l_suppkey, a AS "AF", b AS "AO", c AS "NF", d AS "NO", round(least(1.0, p), 9) AS p_value FROM t JOIN p USING (l_suppkey)""")
def strand_bias(spark, d):
    n = lambda flag, status: F.count_if((F.col("l_returnflag") == flag) & (F.col("l_linestatus") == status)).alias(f"{flag}{status}")
    table = Tables(spark, d).lineitem.groupBy("l_suppkey").agg(n("A", "F"), n("A", "O"), n("N", "F"), n("N", "O"))
    return table.withColumn("p_value", F.round(variants.strand_bias(*[F.col(c) for c in ("AF", "AO", "NF", "NO")]), 9))


@query(f"WITH v AS (SELECT ref AS key, pos, pos % 3 AS frame, ref_base, max(alt) AS alt FROM ({CALLED}) GROUP BY ALL), g AS (SELECT *, pos - row_number() OVER (PARTITION BY key, pos - frame ORDER BY pos) AS island FROM v) SELECT key, min(pos) AS pos, string_agg(ref_base, '' ORDER BY pos) AS ref, string_agg(alt, '' ORDER BY pos) AS alt, count(*) AS n FROM g GROUP BY key, pos - frame, island")
def codon_merge(spark, d):
    one = _called(Tables(spark, d)).groupBy(F.col("ref").alias("key"), "pos", (F.col("pos") % 3).alias("frame"), F.col("ref_base").alias("ref")).agg(F.max("alt").alias("alt"))
    return variants.merge_codons(one, ["key"]).withColumn("n", F.col("n").cast("long"))


@query(f"WITH c AS (SELECT ref, pos, arg_min(kind, doc_id) AS base FROM ({LETTERS}) GROUP BY 1, 2), v AS (SELECT ref, pos, max(alt) AS alt FROM ({CALLED}) GROUP BY 1, 2) SELECT c.ref AS key, string_agg(coalesce(v.alt, c.base), '' ORDER BY c.pos) AS seq FROM c LEFT JOIN v ON c.ref = v.ref AND c.pos = v.pos GROUP BY 1")
def apply_variants(spark, d):
    t = Tables(spark, d)
    first = _first_letters(t)
    reference = intervals.sequence(first, ["ref"]).withColumnRenamed("ref", "key")
    called = _called(t).groupBy(F.col("ref").alias("key"), "pos").agg(F.max("alt").alias("alt")).withColumn("ref", F.lit("X"))
    return variants.apply_variants(reference, called)


# ------------------------------------------------------------------ intervals: events by user and hour


def _hours(t):
    at = F.floor(F.col("ts").cast("timestamp").cast("long") / 3600)
    return t.events.select(F.col("user_id").alias("chrom"), at.alias("start"), (at + 1 + F.col("event_id") % 5).alias("end"), "event_id", "event_type")


HOURS = "SELECT user_id AS chrom, floor(epoch(ts) / 3600)::bigint AS start, floor(epoch(ts) / 3600)::bigint + 1 + event_id % 5 AS \"end\", event_id, event_type FROM events"


@query(f"SELECT chrom, min(start) AS start, max(start) AS \"end\" FROM (SELECT *, start - row_number() OVER (PARTITION BY chrom ORDER BY start) AS g FROM (SELECT DISTINCT chrom, start FROM ({HOURS}))) GROUP BY chrom, g")
def runs(spark, d):
    return intervals.runs(_hours(Tables(spark, d)).select("chrom", F.col("start").alias("pos")), ["chrom"])


@query(f"WITH m AS (SELECT *, CASE WHEN start > max(\"end\") OVER (PARTITION BY chrom ORDER BY start, \"end\" ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) THEN 1 ELSE 0 END AS new FROM ({HOURS})), g AS (SELECT *, sum(new) OVER (PARTITION BY chrom ORDER BY start, \"end\" ROWS UNBOUNDED PRECEDING) AS g FROM m) SELECT chrom, min(start) AS start, max(\"end\") AS \"end\", count(*) AS n FROM g GROUP BY chrom, g")
def interval_merge(spark, d):
    return intervals.merge_intervals(_hours(Tables(spark, d)), ["chrom"])


@query(f"WITH h AS ({HOURS}), i AS (SELECT chrom, start AS a, start + 3 AS b FROM h WHERE event_type = 'purchase') SELECT DISTINCT chrom, start, \"end\" FROM h WHERE NOT EXISTS (SELECT 1 FROM i WHERE i.chrom = h.chrom AND (h.start >= a AND h.start < b OR h.\"end\" >= a AND h.\"end\" < b))")
def indel_mask(spark, d):
    h = _hours(Tables(spark, d))
    indels = h.filter("event_type = 'purchase'").select("chrom", F.col("start").alias("pos"), F.lit(4).alias("len"))
    return intervals.mask_without_indels(h.select("chrom", "start", "end").distinct(), indels)


@query(f"WITH h AS ({HOURS}), b AS (SELECT DISTINCT chrom AS key, start AS rs, start + 2 AS re, 100::bigint AS qs FROM h WHERE event_type = 'click') SELECT DISTINCT h.chrom AS key, h.start AS pos, qs + h.start - rs AS query_pos FROM h JOIN b ON h.chrom = b.key AND h.start >= rs AND h.start < re")
def block_projection(spark, d):
    h = _hours(Tables(spark, d))
    start = F.col("start")
    blocks = h.filter("event_type = 'click'").select(F.col("chrom").alias("key"), start.alias("ref_start"), (start + 2).alias("ref_end"), F.lit(100).cast("long").alias("query_start"), F.lit(102).cast("long").alias("query_end")).distinct()
    return intervals.project_positions(blocks, h.select(F.col("chrom").alias("key"), start.alias("pos"))).distinct()


@query("SELECT n_name AS chrom, substr(n_name, 1, 1) || repeat('N', least(3, greatest(length(n_name) - 1, 0))) || substr(n_name, 5) AS seq FROM nation")
def mask_intervals(spark, d):
    n = Tables(spark, d).nation.select(F.col("n_name").alias("chrom"), F.col("n_name").alias("seq"))
    both = n.select("chrom", F.lit(1).alias("start"), F.lit(3).alias("end")).unionAll(n.select("chrom", F.lit(2), F.lit(4)))
    return intervals.mask_sequence(n, both)


@query("SELECT n_name AS key, substr('zzzzzzzzzzzzzzzzzzzz', 1, 2) || substr(n_name, 3) AS seq FROM nation WHERE length(n_name) > 3")
def patch(spark, d):
    n = Tables(spark, d).nation.filter("length(n_name) > 3").select(F.col("n_name").alias("key"), F.col("n_name").alias("seq"))
    reference = n.select("key", F.repeat(F.lit("z"), F.length("seq")).alias("seq"))
    low = n.select("key", F.explode(F.array(F.lit(0), F.lit(1)).cast("array<long>")).alias("pos"))
    blocks = n.select("key", F.lit(0).cast("long").alias("ref_start"), F.lit(3).cast("long").alias("ref_end"), F.lit(0).cast("long").alias("query_start"), F.lit(3).cast("long").alias("query_end"))
    return intervals.patch_low_coverage(n, reference, low, blocks)


# ------------------------------------------------------------------ alignments: lineitem by part and day


def _aligned(t):
    flag = F.when(F.col("l_returnflag") == "R", 4).otherwise(0) + F.when(F.col("l_linestatus") == "F", 16).otherwise(0) + F.when(F.col("l_linenumber") == 1, 3).otherwise(0)
    return t.lineitem.select(F.col("l_partkey").alias("ref"), F.dayofmonth("l_shipdate").cast("long").alias("pos"), flag.alias("flag"), (F.col("l_suppkey") % 3).cast("int").alias("mapq"), F.col("l_quantity").cast("long").alias("length"), F.col("l_extendedprice").alias("quality"), (F.col("l_orderkey") % 100).cast("long").alias("tlen"), "l_orderkey", "l_linenumber", "l_suppkey", F.col("l_shipdate").cast("timestamp").cast("long").alias("shipped"))


ALIGNED = "SELECT l_partkey AS ref, day(l_shipdate)::bigint AS pos, l_returnflag <> 'R' AS mapped, l_linestatus = 'F' AS reverse, l_linenumber = 1 AS paired, l_suppkey % 3 AS mapq, l_quantity::bigint AS length, l_extendedprice AS quality, l_orderkey % 100 AS tlen, l_orderkey, l_linenumber, l_suppkey, epoch(l_shipdate)::bigint AS shipped FROM lineitem"


@query(f"SELECT ref, count(*) FILTER (mapped) AS mapped, count(*) FILTER (NOT mapped) AS unmapped FROM ({ALIGNED}) GROUP BY 1")
def ref_counts(spark, d):
    return alignments.reference_counts(_aligned(Tables(spark, d)))


@query(f"SELECT count(*) AS total, count(*) FILTER (mapped) AS mapped, count(*) FILTER (paired) AS proper_pair, count(*) FILTER (reverse) AS reverse FROM ({ALIGNED})")
def flag_counts(spark, d):
    return alignments.flag_counts(_aligned(Tables(spark, d))).select("total", "mapped", "proper_pair", "reverse")


@query(f"SELECT ref, count(*) AS reads, count(*) FILTER (mapped) AS mapped, round(100 * count(*) FILTER (mapped) / count(*), 6) AS percent_mapped, count(*) FILTER (paired) AS proper_pairs, round(avg(tlen) FILTER (paired AND tlen > 0), 6) AS insert_mean, round(avg(length), 6) AS mean_length, count(*) FILTER (mapped AND mapq = 0) AS mq0, coalesce(sum(length) FILTER (mapped), 0)::bigint AS bases_mapped FROM ({ALIGNED}) GROUP BY 1")
def align_summary(spark, d):
    out = alignments.alignment_summary(_aligned(Tables(spark, d)), ["ref"])
    r = lambda c: F.round(c, 6).alias(c)
    return out.select("ref", "reads", "mapped", r("percent_mapped"), "proper_pairs", r("insert_mean"), r("mean_length"), "mq0", "bases_mapped")


@query(f"WITH dep AS (SELECT ref, pos, count(*) AS depth FROM ({ALIGNED}) GROUP BY 1, 2), f AS (SELECT r.ref, i AS pos, coalesce(depth, 0) AS depth FROM (SELECT DISTINCT ref FROM dep) r CROSS JOIN range(1, 32) t(i) LEFT JOIN dep ON dep.ref = r.ref AND dep.pos = i) SELECT ref, round(avg(depth), 6) AS mean, min(depth) AS min, max(depth) AS max, median(depth)::double AS median, round(100 * count(*) FILTER (depth >= 1) / 31, 6) AS x1, round(100 * count(*) FILTER (depth >= 5) / 31, 6) AS x5 FROM f GROUP BY 1")
def depth_summary(spark, d):
    depth = _aligned(Tables(spark, d)).groupBy("ref", "pos").agg(F.count("*").alias("depth"))
    out = alignments.depth_summary(depth, depth.select("ref").distinct().withColumn("length", F.lit(31)))
    return out.select("ref", F.round("mean", 6).alias("mean"), "min", "max", "median", F.round("x1", 6).alias("x1"), F.round("x5", 6).alias("x5"))


@query(f"SELECT l_orderkey, l_linenumber, ref, row_number() OVER (PARTITION BY ref, pos, reverse ORDER BY quality DESC, l_orderkey, l_linenumber, l_suppkey, shipped) > 1 AS duplicate FROM ({ALIGNED})")
def mark_duplicates(spark, d):
    rows = _aligned(Tables(spark, d)).withColumn("strand", alignments.has(F.col("flag"), "reverse"))
    return alignments.mark_duplicates(rows, ["ref", "pos", "strand"], "quality", ["l_orderkey", "l_linenumber", "l_suppkey", "shipped"]).select("l_orderkey", "l_linenumber", "ref", "duplicate")


@query("SELECT source AS key, base, count(*) AS n FROM (SELECT source, unnest(string_split(text, '')) AS base FROM documents) WHERE base <> '' GROUP BY 1, 2")
def cycle_metrics(spark, d):
    docs = Tables(spark, d).documents.select(F.col("source").alias("key"), F.col("text").alias("seq"), F.lit("").alias("qual"))
    return alignments.cycle_metrics(docs, ["key"]).groupBy("key", "base").agg(F.sum("n").alias("n"))


# ------------------------------------------------------------------ reads: documents and conversations as reads


@query("SELECT lang AS key, count(*) AS reads, round(avg(length(text)), 6) AS mean_length, round(100 * sum(len(regexp_extract_all(text, '[GCgc]'))) / sum(length(text)), 6) AS gc, round(100 * sum(len(regexp_extract_all(text, '[Nn]'))) / sum(length(text)), 6) AS n_share FROM documents GROUP BY 1")
def read_qc(spark, d):
    docs = Tables(spark, d).documents.select(F.col("lang").alias("key"), F.col("text").alias("seq"))
    return reads.read_qc(docs, "key").select("key", "reads", *[F.round(c, 6).alias(c) for c in ("mean_length", "gc", "n_share")])


@query("SELECT source AS key, copies, count(*) AS sequences FROM (SELECT source, text, count(*) AS copies FROM documents GROUP BY 1, 2) GROUP BY 1, 2")
def read_duplicates(spark, d):
    return reads.duplication(Tables(spark, d).documents.select(F.col("source").alias("key"), F.col("text").alias("seq")), "key")


@query("SELECT source, n, n >= 50 AS passed FROM (SELECT source, count(*) AS n FROM documents GROUP BY 1)")
def read_gates(spark, d):
    counts = Tables(spark, d).documents.groupBy("source").agg(F.count("*").alias("n"))
    good, bad = reads.gate(counts, "n", 50)
    return good.withColumn("passed", F.lit(True)).unionAll(bad.withColumn("passed", F.lit(False)))


FOUR = "(III.|II.I|I.II|.III)"
TRIMMED = f"""WITH a AS (SELECT doc_id, regexp_replace(text, '(A{{10,}}|C{{10,}}|G{{10,}}|T{{10,}})$', '') AS seq FROM documents WHERE text IS NOT NULL),
b AS (SELECT *, regexp_replace(regexp_replace(seq, '[a-zA-Z]', 'I', 'g'), '[^I]', '#', 'g') AS q FROM a),
c AS (SELECT *, length(regexp_extract(q, '^(.*?){FOUR}', 1)) AS ahead, length(regexp_extract(reverse(q), '^(.*?){FOUR}', 1)) AS behind FROM b WHERE regexp_matches(q, '{FOUR}')),
d AS (SELECT doc_id, substr(seq, ahead + 1, length(seq) - ahead - behind) AS seq, substr(q, ahead + 1, length(seq) - ahead - behind) AS q FROM c)
SELECT doc_id, seq FROM d WHERE length(q) >= 50 AND length(replace(q, 'I', '')) <= 0.5 * length(q)"""


@query(TRIMMED)
def trim_reads(spark, d):
    docs = Tables(spark, d).documents.select("doc_id", F.col("text").alias("seq"), F.regexp_replace(F.regexp_replace("text", "[a-zA-Z]", "I"), "[^I]", "#").alias("qual"))
    return reads.trim_reads(docs, mean=25, max_low=0.5).select("doc_id", "seq")


@query("""WITH k AS (SELECT p_partkey, length(p_name) - 2 AS n, substr(p_name, i::int, 3) AS w FROM part, LATERAL (SELECT unnest(range(1, greatest(length(p_name) - 1, 1))) AS i) r),
c AS (SELECT p_partkey, n, w, count(*) AS c FROM k GROUP BY ALL),
s AS (SELECT p_partkey, round(sum(-(c / n) * log2(c / n)) / log2(least(any_value(n), 64)), 6) AS complexity, round(sum(c * (c - 1) / 2) / greatest(any_value(n) - 1, 1), 6) AS dust FROM c GROUP BY 1)
SELECT p_partkey, CASE WHEN length(p_name) < 4 THEN 0.0 ELSE s.complexity + 0.0 END AS complexity, coalesce(s.dust, 0.0) AS dust FROM part LEFT JOIN s USING (p_partkey)""")
def complexity(spark, d):
    return Tables(spark, d).part.select("p_partkey", F.round(reads.complexity(F.col("p_name")), 6).alias("complexity"), F.round(reads.dust(F.col("p_name")), 6).alias("dust"))


@query()
def complexity_filter(spark, d):
    return reads.filter_complexity(Tables(spark, d).documents.select("doc_id", F.col("text").alias("seq")))


@query("SELECT conv_id, turn, substr(text, 1, 4) AS umi, substr(text, 5) AS seq FROM conversations")
def umi_extract(spark, d):
    c = Tables(spark, d).conversations.select("conv_id", "turn", F.col("text").alias("seq"), F.lit("").alias("qual"), F.lit("r").alias("read_id"))
    return reads.extract_umi(c, 4).select("conv_id", "turn", "umi", "seq")


SMALL = "abcdefghijklmnopqrstuvwxyz"


def _umi_sql(key: str = "") -> str:
    """Groups: what the commonest word reaches over links to words at most half as common, nearly. key: a column and a comma."""
    same = f" AND a.{key[:-1]} = b.{key[:-1]}" if key else ""
    of = lambda x: f"{x}.{key}" if key else ""
    both = lambda x, y: f" AND {x}.{key[:-1]} = {y}.{key[:-1]}" if key else ""
    return f"""WITH RECURSIVE c AS (SELECT {key} translate(substr(text, 1, 8), '{SMALL}', '{SMALL.upper()}') AS umi, count(*) AS n FROM conversations GROUP BY ALL),
e AS (SELECT {of('a')} a.umi AS a, b.umi AS b FROM c a JOIN c b ON a.umi <> b.umi AND length(a.umi) = length(b.umi){same} AND a.n >= 2 * b.n - 1 AND len(list_filter(range(1, length(a.umi) + 1), lambda i: a.umi[i] <> b.umi[i])) = 1),
r AS (SELECT {key} umi AS a, umi AS b FROM c UNION SELECT {of('r')} r.a, e.b FROM r JOIN e ON r.b = e.a{both('r', 'e')}),
g AS (SELECT {of('r')} r.b, r.a, row_number() OVER (PARTITION BY {of('r')} r.b ORDER BY c.n DESC, r.a) AS place FROM r JOIN c ON c.umi IS NOT DISTINCT FROM r.a{both('r', 'c')})
SELECT {of('g')} g.a AS umi, sum(c.n)::bigint AS reads FROM g JOIN c ON c.umi IS NOT DISTINCT FROM g.b{both('g', 'c')} WHERE place = 1 GROUP BY ALL"""


@query(_umi_sql())
def umi_dedup(spark, d):
    c = Tables(spark, d).conversations.select(F.translate(F.substring("text", 1, 8), SMALL, SMALL.upper()).alias("umi"))
    return reads.umi_representatives(reads.dedup_umi(c)).select("umi", "reads")


@query(_umi_sql("role,"))
def umi_dedup_mapped(spark, d):
    c = Tables(spark, d).conversations.select("role", F.translate(F.substring("text", 1, 8), SMALL, SMALL.upper()).alias("umi"))
    return reads.umi_representatives(reads.dedup_umi(c, ["role"]), ["role"]).select("role", "umi", "reads")


# ------------------------------------------------------------------ word sets: documents against the benchmark


def _words(df, key, k=3):
    return sketches.words(df.select(F.col(key).alias("seq_id"), F.lower("text").alias("seq")), k, split=" ")


WORDS = lambda table, key: f"SELECT DISTINCT seq_id, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS word FROM (SELECT {key} AS seq_id, list_filter(string_split(lower(text), ' '), lambda x: x <> '') AS w FROM {table}) t, LATERAL (SELECT unnest(range(1, len(t.w) - 1)) AS i) r"


@query(f"SELECT seq_id, count(*) AS shared FROM ({WORDS('documents', 'doc_id')}) WHERE word IN (SELECT word FROM ({WORDS('benchmark', 'item_id')})) GROUP BY 1 HAVING count(*) >= 5")
def contaminant_screen(spark, d):
    t = Tables(spark, d)
    return sketches.contaminated(_words(t.documents, "doc_id"), _words(t.benchmark, "item_id"), 5)


@query(f"SELECT doc_id AS seq_id FROM documents WHERE doc_id NOT IN (SELECT seq_id FROM ({WORDS('documents', 'doc_id')}) WHERE word IN (SELECT word FROM ({WORDS('benchmark', 'item_id')})) GROUP BY 1 HAVING count(*) >= 5)")
def host_removal(spark, d):
    t = Tables(spark, d)
    return sketches.without_host(t.documents.select(F.col("doc_id").alias("seq_id")), sketches.contaminated(_words(t.documents, "doc_id"), _words(t.benchmark, "item_id"), 5))


HASH = "('0x' || substr(md5(word), 1, 15))::bigint"
SKETCH = f"SELECT seq_id, h FROM (SELECT *, row_number() OVER (PARTITION BY seq_id ORDER BY h) AS n FROM (SELECT DISTINCT seq_id, {HASH} AS h FROM ({WORDS('benchmark', 'item_id')}))) WHERE n <= 50"


@query(SKETCH)
def sketch(spark, d):
    return sketches.sketch(_words(Tables(spark, d).benchmark, "item_id"), 50)


@query(SKETCH.replace(WORDS("benchmark", "item_id"), WORDS("documents", "doc_id")))
def sketch_documents(spark, d):
    return sketches.sketch(_words(Tables(spark, d).documents, "doc_id"), 50)


SINGLE = f"SELECT seq_id, h FROM (SELECT *, row_number() OVER (PARTITION BY seq_id ORDER BY h) AS n FROM (SELECT DISTINCT seq_id, {HASH} AS h FROM (SELECT item_id AS seq_id, unnest(list_filter(string_split(lower(text), ' '), lambda x: x <> '')) AS word FROM benchmark))) WHERE n <= 50"


@query(f"WITH s AS ({SINGLE}), n AS (SELECT seq_id, count(*) AS n FROM s GROUP BY 1), p AS (SELECT x.seq_id AS a, y.seq_id AS b, count(*) AS shared FROM s x JOIN s y ON x.h = y.h AND x.seq_id > y.seq_id GROUP BY 1, 2) SELECT a, b, round(shared / (na.n + nb.n - shared), 6) AS jaccard, round(greatest(0.0, -ln(2 * (shared / (na.n + nb.n - shared)) / (1 + shared / (na.n + nb.n - shared))) / 3), 6) AS distance FROM p JOIN n na ON na.seq_id = a JOIN n nb ON nb.seq_id = b")
def mash_distance(spark, d):
    out = sketches.mash_distances(sketches.sketch(_words(Tables(spark, d).benchmark, "item_id", 1), 50), 3)
    return out.select("a", "b", F.round("jaccard", 6).alias("jaccard"), F.round("distance", 6).alias("distance"))


@query(f"WITH r AS (SELECT {HASH} AS h, count(*) AS times FROM ({WORDS('documents', 'doc_id')}) GROUP BY 1), s AS ({SKETCH}) SELECT s.seq_id AS ref, count(times) AS shared, count(*) AS total, round(pow(count(times) / count(*), 1 / 3.0), 6) AS identity, median(times)::double AS multiplicity FROM s LEFT JOIN r USING (h) GROUP BY 1")
def screen_refs(spark, d):
    t = Tables(spark, d)
    refs = sketches.sketch(_words(t.benchmark, "item_id"), 50).withColumnRenamed("seq_id", "ref")
    seen = _words(t.documents, "doc_id").select(sketches.portable_hash(F.col("word")).alias("h"))
    return sketches.screen(seen, refs, 3).withColumn("identity", F.round("identity", 6))


@query("SELECT sample, \"query-ID\", identity, \"shared-hashes\" FROM (SELECT p_type AS sample, p_partkey::varchar AS \"query-ID\", round(p_retailprice / 10, 0) AS identity, p_size || '/50' AS \"shared-hashes\", row_number() OVER (PARTITION BY p_type ORDER BY round(p_retailprice / 10, 0) DESC, p_size DESC, p_partkey::varchar) AS n FROM part) WHERE n = 1")
def best_reference(spark, d):
    rows = Tables(spark, d).part.select(F.col("p_type").alias("sample"), F.col("p_partkey").cast("string").alias("query-ID"), F.round(F.col("p_retailprice") / 10, 0).alias("identity"), F.concat("p_size", F.lit("/50")).alias("shared-hashes"))
    return hits.best_reference(rows, ["sample"]).select("sample", "query-ID", "identity", "shared-hashes")


@query()
def cluster_sequences(spark, d):
    docs = Tables(spark, d).documents
    return sketches.cluster_sequences(_words(docs, "doc_id"), docs.select(F.col("doc_id").alias("seq_id"), F.length("text").alias("length")))


KNOWN = f"SELECT word, min(source || ':' || lang) AS taxid FROM ({WORDS('documents', 'doc_id')}) JOIN documents ON doc_id = seq_id GROUP BY 1"


@query(f"SELECT seq_id, taxid, score FROM (SELECT seq_id, taxid, count(*) AS score, row_number() OVER (PARTITION BY seq_id ORDER BY count(*) DESC, taxid) AS n FROM ({WORDS('benchmark', 'item_id')}) JOIN ({KNOWN}) USING (word) GROUP BY 1, 2) WHERE n = 1")
def kmer_classify(spark, d):
    t = Tables(spark, d)
    tree = t.documents.select(F.concat(F.lit("l:"), "lang").alias("taxid"), F.lit("1").alias("parent_taxid"), F.lit("G").alias("rank")).distinct()
    tree = tree.unionAll(t.documents.select(F.concat_ws(":", "source", "lang").alias("taxid"), F.concat(F.lit("l:"), "lang").alias("parent_taxid"), F.lit("S").alias("rank")).distinct())
    tree = tree.unionAll(spark.createDataFrame([("1", None, "R")], tree.schema))
    known = _words(t.documents, "doc_id").join(t.documents.select(F.col("doc_id").alias("seq_id"), F.concat_ws(":", "source", "lang").alias("taxid")), "seq_id").groupBy("word").agg(F.min("taxid").alias("taxid"))
    return sketches.classify_words(_words(t.benchmark, "item_id"), known, taxonomy.ancestors(tree))


# ------------------------------------------------------------------ reports: events as metrics of samples


def _metrics(t):
    step = F.concat(F.lit("it"), (F.dayofmonth("ts") % 9 + 1))
    return t.events.select(F.concat_ws("_", F.col("user_id") % 50, F.col("user_id") % 7, step).alias("id"), F.lit("m").alias("module"), F.lit("s").alias("section"), F.col("event_type").alias("metric"), "value").groupBy("id", "module", "section", "metric").agg(F.max("value").alias("value"))


METRICS = "SELECT (user_id % 50) || '_' || (user_id % 7) || '_it' || (day(ts) % 9 + 1) AS id, event_type AS metric, max(value) AS value FROM events GROUP BY 1, 2"
WIDE = f"SELECT id, max(value) FILTER (metric = 'click') AS clicks, max(value) FILTER (metric = 'purchase') AS purchases FROM ({METRICS}) WHERE metric IN ('click', 'purchase') GROUP BY 1"
SPLIT = f"SELECT *, split_part(id, '_', 1) AS sample, split_part(id, '_', 2) AS cluster, split_part(id, '_', 3) AS step FROM ({WIDE})"


def _wide(t):
    return report.select_metrics(_metrics(t), [("m", "s", "click", "clicks"), ("m", "s", "purchase", "purchases")])


@query(WIDE)
def metric_select(spark, d):
    return _wide(Tables(spark, d))


@query(f"SELECT id, a.value AS clicks, b.value AS views FROM (SELECT * FROM ({METRICS}) WHERE metric = 'click') a FULL JOIN (SELECT * FROM ({METRICS}) WHERE metric = 'view') b USING (id)")
def outer_metrics(spark, d):
    m = _metrics(Tables(spark, d))
    part = lambda metric, name: m.filter(F.col("metric") == metric).select("id", F.col("value").alias(name))
    return report.join_metrics([part("click", "clicks"), part("view", "views")])


@query(SPLIT)
def split_key(spark, d):
    return report.split_id(_wide(Tables(spark, d)))


@query(f"SELECT id, 102 - substr(step, 3)::bigint AS rank FROM ({SPLIT})")
def step_rank(spark, d):
    return report.split_id(_wide(Tables(spark, d))).select("id", report.step_rank(F.col("step")).cast("long").alias("rank"))


@query(f"WITH s AS (SELECT *, 102 - substr(step, 3)::int AS r FROM ({SPLIT})) SELECT id, coalesce(last_value(clicks IGNORE NULLS) OVER (PARTITION BY sample, cluster ORDER BY r ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), first_value(clicks IGNORE NULLS) OVER (PARTITION BY sample, cluster ORDER BY r ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)) AS clicks FROM s")
def fill_group(spark, d):
    return report.fill_group(report.split_id(_wide(Tables(spark, d))), ["clicks"], ["sample", "cluster"], [report.step_rank(F.col("step"))]).select("id", "clicks")


@query(f"SELECT id FROM (SELECT id, row_number() OVER (PARTITION BY sample, cluster ORDER BY 102 - substr(step, 3)::int) AS n FROM ({SPLIT})) WHERE n = 1")
def last_iteration(spark, d):
    return report.last_iteration(report.split_id(_wide(Tables(spark, d))))[0].select("id")


@query(f"WITH s AS (SELECT *, 102 - substr(step, 3)::int AS r FROM ({SPLIT})) SELECT sample, count(*) AS n FROM s WHERE r = (SELECT min(r) FROM s) GROUP BY 1")
def final_counts(spark, d):
    return report.final_counts(report.split_id(_wide(Tables(spark, d))))


@query(f"SELECT s.id, s.sample, s.cluster, s.step, s.clicks, s.purchases, c.events FROM ({SPLIT}) s LEFT JOIN (SELECT (user_id % 50)::varchar AS sample, (user_id % 7)::varchar AS cluster, count(*) AS events FROM events WHERE event_type <> 'view' GROUP BY 1, 2) c USING (sample, cluster)")
def contigs_overview(spark, d):
    t = Tables(spark, d)
    own = t.events.filter("event_type <> 'view'").groupBy((F.col("user_id") % 50).cast("string").alias("sample"), (F.col("user_id") % 7).cast("string").alias("cluster")).agg(F.count("*").alias("events"))
    return report.contigs_overview([_wide(t)], own)[0].select("id", "sample", "cluster", "step", "clicks", "purchases", "events")


@query("SELECT c_mktsegment AS sample, n, total FROM (SELECT c_mktsegment, count(*) AS n FROM customer GROUP BY 1) LEFT JOIN (SELECT c_mktsegment, round(sum(o_totalprice), 2) AS total FROM customer JOIN orders ON c_custkey = o_custkey GROUP BY 1) USING (c_mktsegment)")
def samples_overview(spark, d):
    t = Tables(spark, d)
    samples = t.customer.groupBy(F.col("c_mktsegment").alias("sample")).agg(F.count("*").alias("n"))
    summary = t.customer.join(t.orders, F.col("c_custkey") == F.col("o_custkey")).groupBy(F.col("c_mktsegment").alias("sample")).agg(F.round(F.sum("o_totalprice"), 2).alias("total"))
    return report.samples_overview(samples, summary)


BRANDS = [f"Brand#{n}" for n in range(1, 26)]


@query("SELECT r_name AS sample, " + ", ".join(f"min(p_size) FILTER (p_brand = '{b}')::varchar AS \"{b} - size\", min(p_type) FILTER (p_brand = '{b}') AS \"{b} - type\"" for b in BRANDS) + " FROM part, region WHERE p_partkey % 5 = r_regionkey GROUP BY 1")
def constraint_summary(spark, d):
    t = Tables(spark, d)
    own = t.part.join(t.region, F.col("p_partkey") % 5 == F.col("r_regionkey")).select(F.col("r_name").alias("sample"), report.group_label(F.col("p_brand"), F.lit(None).cast("string"), F.col("p_name")).alias("idgroup"), "p_size", "p_type")
    least = own.groupBy("sample", "idgroup").agg(F.min("p_size").alias("size"), F.min("p_type").alias("type"))
    return report.constraint_summary(least, ["size", "type"])


TURNS = "SELECT role AS key, conv_id * 1000 + turn AS read, generate_subscripts(l, 1) AS pos, unnest(l) AS kind FROM (SELECT role, conv_id, turn, string_split(translate(text, 'acgt', 'ACGT'), '') AS l FROM conversations WHERE text <> '')"


def _refined_sql(rounds: int) -> str:
    """Each round piles up the turns a tenth of whose letters agree with the sequence of the round before."""
    steps = [f"l AS ({TURNS})", "c0 AS (SELECT key, pos, arg_min(kind, read) AS base FROM l GROUP BY 1, 2)"]
    for n in range(1, rounds + 1):
        steps.append(f"a{n} AS (SELECT read, key FROM l JOIN c{n - 1} USING (key, pos) GROUP BY 1, 2 HAVING 10 * count(*) FILTER (kind = base) >= count(*))")
        counts = ", ".join(f"count(*) FILTER (kind = '{x}') AS \"{x}\"" for x in "ACGT")
        steps.append(f"p{n} AS (SELECT *, (\"A\" + \"C\" + \"G\" + \"T\") AS n FROM (SELECT key, pos, {counts} FROM l JOIN a{n} USING (read, key) GROUP BY 1, 2))")
        steps.append(f"c{n} AS (SELECT c.key, c.pos, CASE WHEN n >= 10 AND ({MASK}) < 15 THEN substr('{alignments.IUPAC}', ({MASK})::int + 1, 1) ELSE c.base END AS base FROM c{n - 1} c LEFT JOIN p{n} p ON p.key = c.key AND p.pos = c.pos)")
    return f"WITH {', '.join(steps)} " + " UNION ALL ".join(f"SELECT key, 'it{n}' AS step, string_agg(base, '' ORDER BY pos) AS seq FROM c{n} GROUP BY 1" for n in range(1, rounds + 1))


@query(_refined_sql(3))
def refine_rounds(spark, d):
    turns = Tables(spark, d).conversations
    reads = turns.select(F.col("role").alias("key"), (F.col("conv_id") * 1000 + F.col("turn")).alias("read"), F.translate("text", "acgt", "ACGT").alias("seq")).filter("seq <> ''")

    def align(current):
        return alignments.piled_reads(reads, alignments.agreeing(reads, current))

    return alignments.refine(align, alignments.first_letters(reads), 3)


# ------------------------------------------------------------------ whole operators beside the narrower queries above


@query(f"""SELECT ref, pos, round_even(e, 3) + 0.0 AS entropy, CASE WHEN n > 0 THEN round_even(round_even(e, 3) * n / (n + 50), 3) + 0.0 ELSE 0.0 END AS weighted FROM (SELECT ref, pos, n, CASE WHEN n > 0 THEN {ENTROPY} ELSE 0.0 END AS e FROM (SELECT *, ("A" + "C" + "G" + "T") AS n FROM ({PILE})))""")
def entropy_weighted(spark, d):
    piled = _pile(Tables(spark, d)).withColumn("entropy", alignments.entropy())
    return piled.select("ref", "pos", "entropy", alignments.weighted_entropy(F.col("entropy")).alias("weighted"))


SAMPLE_TAXA = "SELECT l_orderkey % 20 AS sample, CASE WHEN l_returnflag <> 'R' THEN (l_partkey % 50)::varchar END AS taxid FROM lineitem"


@query(f"WITH h AS ({SAMPLE_TAXA}), n AS (SELECT sample, count(DISTINCT taxid) AS ntaxa FROM h GROUP BY 1) SELECT sample, taxid, count(*) AS hits, ntaxa FROM h JOIN n USING (sample) WHERE taxid IS NOT NULL GROUP BY ALL")
def taxa_counts(spark, d):
    rows = Tables(spark, d).lineitem.select((F.col("l_orderkey") % 20).alias("sample"), F.when(F.col("l_returnflag") != "R", (F.col("l_partkey") % 50).cast("string")).alias("taxid"))
    samples, by_taxon = taxonomy.taxa_counts(rows)
    return by_taxon.join(samples, "sample")


@query("SELECT user_id AS file, coalesce(sum(event_id) FILTER (event_type = 'view'), 0)::bigint AS reads FROM events GROUP BY 1")
def unclassified_reads(spark, d):
    name = F.when(F.col("event_type") == "view", "unclassified").otherwise(F.col("event_type"))
    return taxonomy.unclassified_reads(Tables(spark, d).events.select(F.col("user_id").alias("file"), name.alias("name"), F.col("event_id").alias("clade_reads")))


@query("SELECT event_id FROM events WHERE day(ts) % 9 + 1 = 4 OR user_id % 7 = 0")
def final_genomes(spark, d):
    rows = Tables(spark, d).events.select("event_id", (F.dayofmonth("ts") % 9 + 1).alias("iteration"), (F.col("user_id") % 7 == 0).alias("is_constraint"))
    return report.final_genomes(rows, 4).select("event_id")


@query("SELECT DISTINCT (l_orderkey % 20) || '_' || (l_partkey % 50) || '-CONSTRAINT' AS id, (l_partkey % 50)::varchar AS cluster_id, 'constraint' AS step FROM lineitem")
def constraint_ids(spark, d):
    pairs = Tables(spark, d).lineitem.select((F.col("l_orderkey") % 20).alias("sample"), (F.col("l_partkey") % 50).alias("mapping_id")).distinct()
    return flow.constraint_ids(pairs).select("id", "cluster_id", "step")


@query("SELECT p_partkey, p_brand || '_contigs' AS seq_id FROM part")
def rename_records(spark, d):
    parts = Tables(spark, d).part.select("p_partkey", F.col("p_name").alias("seq_id"), F.col("p_brand").alias("sample"))
    return flow.rename_records(parts, "sample", "contigs").select("p_partkey", "seq_id")


EDGES = "SELECT l_orderkey AS src, l_partkey AS dst, l_discount AS weight FROM lineitem"


@query(f"SELECT *, 'default' AS mode FROM ({EDGES}) WHERE weight > 0 AND weight < 0.05 UNION ALL SELECT *, 'ani' FROM ({EDGES}) WHERE weight <= 1 - 0.97")
def edges_filter(spark, d):
    edges = Tables(spark, d).lineitem.select(F.col("l_orderkey").alias("src"), F.col("l_partkey").alias("dst"), F.col("l_discount").alias("weight"))
    return graph.filter_edges(edges, 0.05).withColumn("mode", F.lit("default")).unionAll(graph.filter_edges(edges, 0.97, "ani").withColumn("mode", F.lit("ani")))


@query(f"SELECT count(*) AS total, count(*) FILTER (mapped) AS mapped, count(*) FILTER (paired) AS paired, count(*) FILTER (paired) AS proper_pair, count(*) FILTER (NOT mapped) AS unmapped, count(*) FILTER (reverse) AS reverse, " + ", ".join(f"0::bigint AS {n}" for n in ("mate_unmapped", "read1", "read2", "secondary", "qc_fail", "duplicate", "supplementary")) + f", ref % 10 AS part FROM ({ALIGNED}) GROUP BY ref % 10")
def flag_counts_all(spark, d):
    return alignments.flag_counts(_aligned(Tables(spark, d)).withColumn("part", F.col("ref") % 10), ["part"])


@query(f"SELECT ref, round(stddev(tlen) FILTER (paired AND tlen > 0), 6) AS insert_sd, round(avg(quality) + 1e-9, 6) AS mean_quality FROM ({ALIGNED}) GROUP BY 1")
def align_spread(spark, d):
    out = alignments.alignment_summary(_aligned(Tables(spark, d)), ["ref"])
    return out.select("ref", F.round("insert_sd", 6).alias("insert_sd"), F.round(F.col("mean_quality") + F.lit(1e-9), 6).alias("mean_quality"))


STEPS = ", ".join(f"round(100 * count(*) FILTER (depth >= {c}) / 5000, 6) AS x{c}" for c in alignments.COVERAGE)


@query(f"WITH dep AS (SELECT l_suppkey % 5 AS ref, l_orderkey % 5000 + 1 AS pos, count(*) AS depth FROM lineitem GROUP BY 1, 2), f AS (SELECT r.ref, i AS pos, coalesce(depth, 0) AS depth FROM (SELECT DISTINCT ref FROM dep) r CROSS JOIN range(1, 5001) t(i) LEFT JOIN dep ON dep.ref = r.ref AND dep.pos = i) SELECT ref, {STEPS} FROM f GROUP BY 1")
def depth_steps(spark, d):
    depth = Tables(spark, d).lineitem.groupBy((F.col("l_suppkey") % 5).alias("ref"), (F.col("l_orderkey") % 5000 + 1).alias("pos")).agg(F.count("*").alias("depth"))
    out = alignments.depth_summary(depth, depth.select("ref").distinct().withColumn("length", F.lit(5000)))
    return out.select("ref", *[F.round(f"x{c}", 6).alias(f"x{c}") for c in alignments.COVERAGE])


@query("SELECT key, cycle, base, count(*) AS n, round(avg(unicode(base) - 33), 6) AS mean_quality FROM (SELECT role AS key, generate_subscripts(l, 1) - 1 AS cycle, unnest(l) AS base FROM (SELECT role, string_split(text, '') AS l FROM conversations WHERE text <> '')) GROUP BY 1, 2, 3")
def cycle_profile(spark, d):
    turns = Tables(spark, d).conversations.select(F.col("role").alias("key"), F.col("text").alias("seq"), F.col("text").alias("qual"))
    out = alignments.cycle_metrics(turns, ["key"])
    return out.select("key", F.col("cycle").cast("long").alias("cycle"), "base", "n", F.round("mean_quality", 6).alias("mean_quality"))


# ------------------------------------------------------------------ alleles: conversations as reads on the longest text of their role


def _turn_reads(t):
    """Turns as aligned reads: a text of 12 letters and more has two inserted after its first third and three deleted after its
    second; the text is its own quality string, so blanks, digits and stops are below 20."""
    third, length = F.floor(F.length("text") / 3), F.length("text")
    cigar = F.when(length >= 12, F.concat(third, F.lit("M2I"), third, F.lit("M3D"), length - 2 * third - 2, F.lit("M"))).otherwise(F.concat(length, F.lit("M")))
    flag = F.when(F.col("conv_id") % 2 == 1, 16).otherwise(0)
    return t.conversations.filter("text <> ''").select(F.col("role").alias("ref"), (F.col("conv_id") % 7 + 1).alias("pos"), flag.alias("flag"), cigar.alias("cigar"), F.col("text").alias("seq"), F.col("text").alias("qual"))


def _turn_references(t):
    longest = F.max(F.struct(F.length("text").alias("n"), "text"))["text"]
    return t.conversations.groupBy(F.col("role").alias("ref")).agg(longest.alias("seq"))


_AZ = "'abcdefghijklmnopqrstuvwxyz', 'ABCDEFGHIJKLMNOPQRSTUVWXYZ'"
TURN_READS = f"""turns AS (SELECT role AS ref, conv_id % 7 + 1 AS p, conv_id % 2 = 1 AS rev, translate(text, {_AZ}) AS s, text AS q, length(text) AS n, length(text) // 3 AS k FROM conversations WHERE text <> ''),
places AS (SELECT ref, rev, n, k, p, unnest(range(1, n + 1)) AS i, unnest(string_split(s, '')) AS base, unnest(list_transform(string_split(q, ''), lambda x: unicode(x) - 33)) AS quality FROM turns),
found AS (SELECT ref, p + i - 1 - CASE WHEN n >= 12 AND i > k + 2 THEN 2 ELSE 0 END + CASE WHEN n >= 12 AND i > 2 * k + 2 THEN 3 ELSE 0 END AS pos, base AS allele, 0 AS deleted, quality, rev FROM places WHERE n < 12 OR i <= k OR i > k + 2
 UNION ALL SELECT ref, p + k - 1, '+' || substr(s, k + 1, 2), 0, (unicode(substr(q, k + 1, 1)) + unicode(substr(q, k + 2, 1)) - 66) // 2, rev FROM turns WHERE n >= 12
 UNION ALL SELECT ref, p + 2 * k - 1, '-', 3, unicode(substr(q, 2 * k + 2, 1)) - 33, rev FROM turns WHERE n >= 12
 UNION ALL SELECT ref, p + 2 * k + d, '*', 0, unicode(substr(q, 2 * k + 2, 1)) - 33, rev FROM turns, range(0, 3) r(d) WHERE n >= 12),
counted AS (SELECT ref, pos, allele, deleted, count(*) AS dp, count(*) FILTER (rev) AS rv, sum(quality) AS quality FROM found WHERE quality >= 20 GROUP BY ALL),
longest AS (SELECT ref, seq FROM (SELECT role AS ref, text AS seq, row_number() OVER (PARTITION BY role ORDER BY length(text) DESC, encode(text) DESC) AS place FROM conversations) WHERE place = 1)"""
CALLED_ALLELES = f"""WITH {TURN_READS},
own AS (SELECT ref, unnest(range(1, length(seq) + 1)) AS pos, unnest(string_split(translate(seq, 'acgt', 'ACGT'), '')) AS base FROM longest),
depth AS (SELECT ref, pos, sum(dp) AS total FROM counted WHERE allele IN ('A', 'C', 'G', 'T', '*') GROUP BY 1, 2),
calls AS (SELECT c.ref AS chrom, c.pos, own.base AS ref, CASE WHEN c.allele = '-' THEN '-' || translate(substr(l.seq, c.pos + 1, 3), 'acgt', 'ACGT') ELSE c.allele END AS alt, coalesce(r.dp, 0) AS ref_dp, coalesce(r.rv, 0) AS ref_rv, r.quality / r.dp AS ref_qual, c.dp AS alt_dp, c.rv AS alt_rv, c.quality / c.dp AS alt_qual, c.dp / total AS freq, total::bigint AS total
 FROM counted c JOIN own ON own.ref = c.ref AND own.pos = c.pos JOIN longest l ON l.ref = c.ref JOIN depth d ON d.ref = c.ref AND d.pos = c.pos LEFT JOIN counted r ON r.ref = c.ref AND r.pos = c.pos AND r.allele = own.base
 WHERE (c.allele IN ('A', 'C', 'G', 'T') OR c.allele LIKE '+_%' OR c.deleted > 0) AND c.allele <> own.base AND total >= 10 AND c.dp / total >= 0.05)"""
_QUALS = "round(ref_qual + 1e-9, 6) AS ref_qual, round(alt_qual + 1e-9, 6) AS alt_qual, round(freq + 1e-9, 6) AS freq"


def _called_alleles(t):
    return variants.call_alleles(alignments.count_alleles(alignments.alleles(_turn_reads(t))), _turn_references(t), min_depth=10, min_freq=0.05)


def _six(name: str):
    return F.round(F.col(name) + F.lit(1e-9), 6).alias(name)


@query(f"{CALLED_ALLELES} SELECT chrom, pos, ref, alt, ref_dp, ref_rv, alt_dp, alt_rv, total, {_QUALS} FROM calls")
def call_alleles(spark, d):
    return _called_alleles(Tables(spark, d)).select("chrom", "pos", "ref", "alt", "ref_dp", "ref_rv", _six("ref_qual"), "alt_dp", "alt_rv", _six("alt_qual"), _six("freq"), "total")


@query(f"{CALLED_ALLELES} SELECT chrom, pos, CASE WHEN alt LIKE '+%' THEN 'INS' WHEN alt LIKE '-%' THEN 'DEL' ELSE 'SNP' END AS type, CASE WHEN alt LIKE '-%' THEN ref || substr(alt, 2) ELSE ref END AS ref, CASE WHEN alt LIKE '+%' THEN ref || substr(alt, 2) WHEN alt LIKE '-%' THEN ref ELSE alt END AS alt, ref_dp - ref_rv AS ref_fw, alt_dp - alt_rv AS alt_fw FROM calls")
def typed_alleles(spark, d):
    return variants.strand_depths(variants.typed(_called_alleles(Tables(spark, d)))).select("chrom", "pos", "type", "ref", "alt", "ref_fw", "alt_fw")


_COUNT_OF = ", ".join(f"""coalesce(sum(dp) FILTER (allele = '{b}'), 0) AS "{b}\"""" for b in "ACGT")


@query(f"""WITH {TURN_READS}, piled AS (SELECT ref, pos, {_COUNT_OF}, coalesce(sum(dp) FILTER (allele = '*'), 0) AS gone FROM counted GROUP BY 1, 2),
top AS (SELECT ref, pos, allele, dp FROM (SELECT *, row_number() OVER (PARTITION BY ref, pos ORDER BY dp DESC, encode(allele)) AS place FROM counted WHERE allele LIKE '+_%') WHERE place = 1),
sized AS (SELECT *, ("A" + "C" + "G" + "T") AS n FROM piled)
SELECT ref, string_agg(CASE WHEN n >= 1 THEN substr('NACMGRSVTWYHKDBN', ({MASK})::int + 1, 1) ELSE 'N' END || CASE WHEN n + gone > 0 AND dp / (n + gone) >= 0.02 THEN substr(allele, 2) ELSE '' END, '' ORDER BY pos) AS seq FROM sized LEFT JOIN top USING (ref, pos) GROUP BY 1""")
def inserted_consensus(spark, d):
    return alignments.inserted_consensus(alignments.count_alleles(alignments.alleles(_turn_reads(Tables(spark, d)))), insertion=0.02)


# ------------------------------------------------------------------ words of taxa at every level: conversations against documents


def _word_tree(t):
    """Root, languages, and a source of a language under its language."""
    pairs = t.documents.select("lang", "source").distinct()
    low = pairs.select(F.concat_ws(":", "source", "lang").alias("taxid"), F.concat(F.lit("l:"), "lang").alias("parent_taxid"), F.lit("S").alias("rank"))
    mid = pairs.select(F.concat(F.lit("l:"), "lang").alias("taxid"), F.lit("1").alias("parent_taxid"), F.lit("G").alias("rank")).distinct()
    return low.unionAll(mid).unionAll(t.documents.sparkSession.createDataFrame([("1", None, "R")], low.schema))


def _taken_words(t):
    """Words with the taxon of their document: of every third only its language is known, of every seventh nothing."""
    taxid = F.when(F.col("doc_id") % 7 == 0, "1").when(F.col("doc_id") % 3 == 0, F.concat(F.lit("l:"), "lang")).otherwise(F.concat_ws(":", "source", "lang"))
    return sketches.words(t.documents.select(taxid.alias("taxid"), F.lower("text").alias("seq")), 1, "taxid", split=" ").distinct()


WORD_TREE = """word_tree AS (SELECT '1' AS taxid, NULL AS parent UNION ALL SELECT DISTINCT 'l:' || lang, '1' FROM documents UNION ALL SELECT DISTINCT source || ':' || lang, 'l:' || lang FROM documents),
up AS (SELECT taxid, taxid AS ancestor, 0 AS steps FROM word_tree UNION ALL SELECT u.taxid, w.parent, steps + 1 FROM up u JOIN word_tree w ON w.taxid = u.ancestor WHERE w.parent IS NOT NULL),
height AS (SELECT taxid, max(steps) AS level FROM up GROUP BY 1),
held AS (SELECT DISTINCT CASE WHEN doc_id % 7 = 0 THEN '1' WHEN doc_id % 3 = 0 THEN 'l:' || lang ELSE source || ':' || lang END AS taxid, unnest(list_filter(string_split(lower(text), ' '), lambda x: x <> '')) AS word FROM documents),
sized AS (SELECT word, count(*) AS n FROM held GROUP BY 1),
common AS (SELECT word, ancestor, count(*) AS under FROM held JOIN up USING (taxid) GROUP BY 1, 2),
word_taxon AS (SELECT word, arg_max(ancestor, level) AS taxid FROM common JOIN sized USING (word) JOIN height ON height.taxid = ancestor WHERE under = n GROUP BY 1)"""


@query(f"WITH RECURSIVE {WORD_TREE} SELECT word, taxid FROM word_taxon")
def word_taxa(spark, d):
    t = Tables(spark, d)
    return sketches.word_taxa(_taken_words(t), taxonomy.ancestors(_word_tree(t)))


@query(f"""WITH RECURSIVE {WORD_TREE},
said AS (SELECT DISTINCT conv_id * 1000 + turn AS seq_id, unnest(list_filter(string_split(lower(text), ' '), lambda x: x <> '')) AS word FROM conversations),
found AS (SELECT seq_id, taxid, count(*) AS n FROM said JOIN word_taxon USING (word) GROUP BY 1, 2),
scored AS (SELECT f.seq_id, f.taxid, sum(g.n) AS score FROM found f JOIN up u ON u.taxid = f.taxid JOIN found g ON g.seq_id = f.seq_id AND g.taxid = u.ancestor GROUP BY 1, 2),
best AS (SELECT seq_id, max(score) AS score FROM scored GROUP BY 1),
ends AS (SELECT seq_id, taxid, score FROM scored JOIN best USING (seq_id, score)),
ties AS (SELECT seq_id, count(*) AS k FROM ends GROUP BY 1),
shared AS (SELECT seq_id, ancestor, count(*) AS under FROM ends JOIN up USING (taxid) GROUP BY 1, 2)
SELECT seq_id, arg_max(ancestor, level) AS taxid, any_value(best.score)::bigint AS score, any_value(h.hits)::bigint AS hits FROM shared JOIN ties USING (seq_id) JOIN best USING (seq_id) JOIN height ON height.taxid = ancestor JOIN (SELECT seq_id, sum(n) AS hits FROM found GROUP BY 1) h USING (seq_id) WHERE under = k GROUP BY 1""")
def classify_turns(spark, d):
    t = Tables(spark, d)
    turns = t.conversations.select((F.col("conv_id") * 1000 + F.col("turn")).alias("seq_id"), F.lower("text").alias("seq"))
    up = stored(taxonomy.ancestors(_word_tree(t)))
    return sketches.classify_reads(sketches.words(turns, 1, split=" "), sketches.word_taxa(_taken_words(t), up), up)


# ------------------------------------------------------------------ distances between all documents

_DOC_SKETCH = SKETCH.replace(WORDS("benchmark", "item_id"), WORDS("documents", "doc_id"))
DOC_CLASSES = f"""s AS ({_DOC_SKETCH}), whole AS (SELECT seq_id, list_sort(list(h)) AS sketch FROM s GROUP BY 1), classes AS (SELECT sketch, min(seq_id) AS representative FROM whole GROUP BY 1)"""


@query(f"""WITH {DOC_CLASSES}, p AS (SELECT representative AS seq_id, unnest(sketch) AS h, len(sketch) AS n FROM classes),
pairs AS (SELECT x.seq_id AS a, y.seq_id AS b, count(*) AS shared, any_value(x.n + y.n) AS n FROM p x JOIN p y ON x.h = y.h AND x.seq_id > y.seq_id GROUP BY 1, 2)
SELECT a, b, shared, round(shared / (n - shared) + 1e-9, 6) AS jaccard, round(greatest(0.0, -ln(2 * (shared / (n - shared)) / (1 + shared / (n - shared))) / 3) + 1e-9, 6) AS distance FROM pairs""")
def document_distances(spark, d):
    classes, _ = sketches.sketch_classes(sketches.sketch(_words(Tables(spark, d).documents, "doc_id"), 50))
    return sketches.block_pairs(classes, 3).select("a", "b", "shared", _six("jaccard"), _six("distance"))


@query(f"WITH {DOC_CLASSES} SELECT seq_id, representative FROM whole JOIN classes USING (sketch)")
def sketch_members(spark, d):
    return sketches.sketch_classes(sketches.sketch(_words(Tables(spark, d).documents, "doc_id"), 50))[1]


# ------------------------------------------------------------------ reads: quality and length by place, molecular words by pattern


_QUANTILE = lambda p, name: f"min(quality) FILTER (100 * up >= {p} * n) AS {name}"


@query(f"""WITH q AS (SELECT role AS key, generate_subscripts(l, 1) - 1 AS cycle, unicode(unnest(l)) - 33 AS quality FROM (SELECT role, string_split(text, '') AS l FROM conversations WHERE text <> '')),
c AS (SELECT key, cycle, quality, count(*) AS k FROM q GROUP BY ALL),
r AS (SELECT *, sum(k) OVER (PARTITION BY key, cycle ORDER BY quality) AS up, sum(k) OVER (PARTITION BY key, cycle) AS n FROM c)
SELECT key, cycle, max(n)::bigint AS n, round(sum(quality * k) / max(n) + 1e-9, 6) AS mean, {_QUANTILE(10, 'p10')}, {_QUANTILE(25, 'q1')}, {_QUANTILE(50, 'median')}, {_QUANTILE(75, 'q3')}, {_QUANTILE(90, 'p90')} FROM r GROUP BY 1, 2""")
def quality_by_cycle(spark, d):
    turns = Tables(spark, d).conversations.select(F.col("role").alias("key"), F.col("text").alias("qual"))
    out = reads.quality_by_cycle(turns, ["key"])
    return out.select("key", F.col("cycle").cast("long").alias("cycle"), "n", _six("mean"), "p10", "q1", "median", "q3", "p90")


@query("SELECT source AS key, lang, length(text) AS length, count(*) AS reads FROM documents WHERE text IS NOT NULL GROUP BY ALL")
def length_histogram(spark, d):
    docs = Tables(spark, d).documents.select(F.col("source").alias("key"), "lang", F.col("text").alias("seq"))
    return reads.length_histogram(docs, ["key", "lang"]).withColumn("length", F.col("length").cast("long"))


_MATES = "SELECT conv_id || '_' || turn // 2 AS name, turn % 2 + 1 AS mate, text AS seq FROM conversations"


@query(f"""WITH r AS ({_MATES}), c AS (SELECT *, CASE WHEN mate = 1 THEN substr(seq, 1, 3) || substr(seq, 6, 1) ELSE substr(seq, 1, 2) END AS umi, CASE WHEN mate = 1 THEN substr(seq, 4, 2) ELSE '' END AS cell, CASE WHEN mate = 1 THEN length(seq) >= 8 ELSE length(seq) >= 2 END AS ok,
 CASE WHEN mate = 1 THEN substr(seq, 7) ELSE substr(seq, 3) END AS rest FROM r),
w AS (SELECT name, coalesce(max(umi) FILTER (mate = 1), '') || coalesce(max(umi) FILTER (mate = 2), '') AS umi, coalesce(max(cell) FILTER (mate = 1), '') || coalesce(max(cell) FILTER (mate = 2), '') AS cell FROM c GROUP BY 1 HAVING bool_and(ok) AND bool_or(mate = 1))
SELECT name || CASE WHEN w.cell <> '' THEN '_' || w.cell ELSE '' END || '_' || w.umi AS read_id, mate, rest AS seq, w.umi, w.cell FROM c JOIN w USING (name)""")
def umi_pattern(spark, d):
    turns = Tables(spark, d).conversations
    mates = turns.select(F.concat_ws("_", "conv_id", F.floor(F.col("turn") / 2)).alias("read_id"), (F.col("turn") % 2 + 1).alias("mate"), F.col("text").alias("seq"), F.col("text").alias("qual"))
    return reads.extract_pattern(mates, "NNNCCNXX", "NN").select("read_id", "mate", "seq", "umi", "cell")


@query(f"""WITH r AS ({_MATES}), m AS (SELECT *, regexp_extract(seq, '^([^aeiou ]{{1,3}})([aeiou])([a-z]+)( )', ['a', 'b', 'c', 'd'], 's') AS g FROM r WHERE mate = 1 AND regexp_matches(seq, '^[^aeiou ]{{1,3}}[aeiou][a-z]+ ', 's'))
SELECT name || '_' || g.a || g.c AS read_id, 1::bigint AS mate, g.b || substr(seq, length(g.a || g.b || g.c || g.d) + 1) AS seq, g.a || g.c AS umi FROM m""")
def umi_expression(spark, d):
    turns = Tables(spark, d).conversations
    mates = turns.select(F.concat_ws("_", "conv_id", F.floor(F.col("turn") / 2)).alias("read_id"), (F.col("turn") % 2 + 1).alias("mate"), F.col("text").alias("seq"), F.col("text").alias("qual"))
    out = reads.extract_pattern(mates, r"^(?P<umi_1>[^aeiou ]{1,3})[aeiou](?P<umi_2>[a-z]+)(?P<discard_1> )", discard=2)
    return out.select("read_id", F.col("mate").cast("long").alias("mate"), "seq", "umi")


# ------------------------------------------------------------------ pairs: lines 1 and 2 of an order as mates


def _mates(t):
    flag = 1 + F.when(F.col("l_linenumber") == 1, 64).when(F.col("l_linenumber") == 2, 128).otherwise(64 + 256) + F.when(F.col("l_returnflag") == "N", 16).otherwise(0) + F.when(F.col("l_quantity") > 48, 4).otherwise(0)
    cigar = F.concat(F.lit("2S"), F.col("l_quantity").cast("int"), F.lit("M1D3I"))
    return t.lineitem.select(F.col("l_orderkey").alias("read_id"), flag.alias("flag"), (F.col("l_suppkey") % 3).alias("ref"), F.dayofyear("l_shipdate").cast("long").alias("pos"), cigar.alias("cigar"))


PAIRED = """e AS (SELECT l_orderkey AS read_id, l_linenumber AS line, l_suppkey % 3 AS ref, l_returnflag = 'N' AS reverse, dayofyear(l_shipdate) + CASE WHEN l_returnflag = 'N' THEN l_quantity::bigint ELSE 0 END AS five FROM lineitem WHERE l_linenumber <= 2 AND l_quantity <= 48),
g AS (SELECT read_id, count(*) FILTER (line = 1) AS n1, count(*) FILTER (line = 2) AS n2 FROM e GROUP BY 1 HAVING n1 = 1 AND n2 = 1),
pairs AS (SELECT a.read_id, a.ref, CASE WHEN a.reverse = b.reverse THEN 'TANDEM' WHEN (CASE WHEN a.reverse THEN b.five ELSE a.five END) <= (CASE WHEN a.reverse THEN a.five ELSE b.five END) THEN 'FR' ELSE 'RF' END AS orientation, abs(a.five - b.five) + 1 AS "insert" FROM g JOIN e a ON a.read_id = g.read_id AND a.line = 1 JOIN e b ON b.read_id = g.read_id AND b.line = 2 WHERE a.ref = b.ref)"""


@query(f'WITH {PAIRED} SELECT read_id, ref, orientation, "insert" FROM pairs')
def read_pairs(spark, d):
    return alignments.read_pairs(_mates(Tables(spark, d)))


@query(f"""WITH {PAIRED}, m AS (SELECT ref, orientation, median("insert") AS med FROM pairs GROUP BY 1, 2)
SELECT ref, orientation, count(*) AS pairs, round(avg("insert") + 1e-9, 6) AS mean, round(stddev_samp("insert") + 1e-9, 5) AS sd, min("insert") AS min, max("insert") AS max, any_value(med)::double AS median, median(abs("insert" - med))::double AS deviation FROM pairs JOIN m USING (ref, orientation) GROUP BY 1, 2""")
def insert_sizes(spark, d):
    out = alignments.insert_sizes(alignments.read_pairs(_mates(Tables(spark, d))), ["ref"])
    return out.select("ref", "orientation", "pairs", _six("mean"), F.round(F.col("sd") + F.lit(1e-9), 5).alias("sd"), "min", "max", "median", "deviation")


# ------------------------------------------------------------------ references with sequences, passing variants, lists


@query("SELECT sample, name AS seq_id, seq, identity FROM (SELECT p_type AS sample, replace('p' || chr(92) || p_partkey, chr(92), '-') AS name, p_name AS seq, round(p_retailprice / 10, 0) AS identity, row_number() OVER (PARTITION BY p_type ORDER BY round(p_retailprice / 10, 0) DESC, p_size DESC, p_partkey::varchar) AS n, p_partkey FROM part) WHERE n = 1 AND p_partkey % 4 <> 0")
def best_reference_sequence(spark, d):
    part = Tables(spark, d).part
    name = F.concat(F.lit("p\\"), F.col("p_partkey").cast("string"))
    rows = part.select(F.col("p_type").alias("sample"), name.alias("query-ID"), F.round(F.col("p_retailprice") / 10, 0).alias("identity"), F.concat("p_size", F.lit("/50")).alias("shared-hashes"))
    return hits.best_reference_sequence(rows, part.filter("p_partkey % 4 <> 0").select(name.alias("seq_id"), F.col("p_name").alias("seq")), ["sample"]).select("sample", "seq_id", "seq", "identity")


def _strand_table(t):
    n = lambda flag, status: F.count_if((F.col("l_returnflag") == flag) & (F.col("l_linestatus") == status)).alias(f"{flag}{status}")
    table = t.lineitem.groupBy("l_suppkey").agg(n("R", "F"), n("R", "O"), n("N", "F"), n("N", "O"), variants.excess(F.col("l_discount"), 0.05).alias("excess"))
    return table.withColumn("p_value", variants.strand_bias(*[F.col(c) for c in ("NF", "NO", "RF", "RO")]))


STRANDS = """WITH t AS (SELECT l_suppkey, count(*) FILTER (l_returnflag = 'N' AND l_linestatus = 'F') AS a, count(*) FILTER (l_returnflag = 'N' AND l_linestatus = 'O') AS b, count(*) FILTER (l_returnflag = 'R' AND l_linestatus = 'F') AS c, count(*) FILTER (l_returnflag = 'R' AND l_linestatus = 'O') AS d, avg(l_discount) AS freq FROM lineitem GROUP BY 1),
p AS (SELECT l_suppkey, sum(exp(lgamma(a + b + 1) + lgamma(c + d + 1) + lgamma(a + c + 1) + lgamma(b + d + 1) - lgamma(a + b + c + d + 1) - lgamma(x + 1) - lgamma(a + b - x + 1) - lgamma(a + c - x + 1) - lgamma(d - a + x + 1))) AS p FROM t, LATERAL (SELECT unnest(range(a, least(a + b, a + c) + 1)) AS x) r GROUP BY 1),
marked AS (SELECT l_suppkey, freq, concat_ws(';', CASE WHEN a <= b + c THEN NULL ELSE 'ft' END, CASE WHEN p < 0.05 THEN 'sb' END) AS label FROM t JOIN p USING (l_suppkey)) """


@query(STRANDS + "SELECT l_suppkey, CASE WHEN label = '' THEN 'PASS' ELSE label END AS filter FROM marked")
def variant_labels(spark, d):
    table = _strand_table(Tables(spark, d))
    return variants.labelled(table, F.col("NF") <= F.col("NO") + F.col("RF"), F.col("p_value")).select("l_suppkey", "filter")


@query(STRANDS + "SELECT l_suppkey FROM marked WHERE label = '' AND freq >= 0.05")
def passing_variants(spark, d):
    table = variants.labelled(_strand_table(Tables(spark, d)), F.col("NF") <= F.col("NO") + F.col("RF"), F.col("p_value"))
    return variants.passing(table, 0, "excess").select("l_suppkey")


@query("SELECT event_type AS key, array_to_string(list_sort(list(user_id)), ',') AS items, count(*) AS n FROM (SELECT DISTINCT event_type, user_id FROM events WHERE user_id IS NOT NULL) GROUP BY 1")
def collect_items(spark, d):
    events = Tables(spark, d).events.withColumnRenamed("event_type", "key")
    return flow.collect_items(events, "user_id", ["key"], distinct=True).select("key", F.array_join("items", ",").alias("items"), "n")


# ------------------------------------------------------------------ clusters of documents by the words that they hold


@query(f"""WITH RECURSIVE w AS (SELECT DISTINCT seq_id, word FROM ({WORDS('documents', 'doc_id')})),
o AS (SELECT doc_id AS seq_id, row_number() OVER (ORDER BY length(text) DESC NULLS LAST, doc_id) AS i FROM documents),
n AS (SELECT seq_id, count(*) AS n FROM w GROUP BY 1),
held AS (SELECT a.seq_id AS a, c.seq_id AS c, count(*) AS shared FROM w a JOIN w c ON a.word = c.word AND a.seq_id <> c.seq_id GROUP BY 1, 2),
before AS (SELECT oa.i, list(oc.i) AS cs FROM held JOIN n ON n.seq_id = a JOIN o oa ON oa.seq_id = a JOIN o oc ON oc.seq_id = c WHERE shared >= 0.85 * n AND oc.i < oa.i GROUP BY 1),
r AS (SELECT 0::bigint AS i, []::bigint[] AS centres UNION ALL SELECT o.i, CASE WHEN list_has_any(coalesce(cs, []), centres) THEN centres ELSE list_append(centres, o.i) END FROM r JOIN o ON o.i = r.i + 1 LEFT JOIN before ON before.i = o.i),
final AS (SELECT centres FROM r ORDER BY i DESC LIMIT 1)
SELECT o.seq_id, t.seq_id AS centroid FROM o LEFT JOIN before ON before.i = o.i, final, LATERAL (SELECT coalesce(list_min(list_intersect(cs, centres)), o.i) AS ci) x JOIN o t ON t.i = ci""")
def greedy_clusters(spark, d):
    docs = Tables(spark, d).documents
    return sketches.greedy_clusters(_words(docs, "doc_id"), docs.select(F.col("doc_id").alias("seq_id"), F.coalesce(F.length("text"), F.lit(-1)).alias("length")))
