"""Contig clusters: members, depth, filters, summaries and assembly statistics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strandwise.operators.graph import numbered

#: Names of contigs (matched anywhere but for the first), and of assemblers (at the start of a name, in order).
CONTIGS = r"^(TRINITY)|(NODE)|(k\d+)|(scaffold\d+)"
ASSEMBLERS = {"spades": r"^(?:(spades)|(NODE))", "megahit": r"^(?:(megahit)|(k\d+))", "trinity": r"^(?:(trinity)|(TRINITY))"}


def assembler(name: Column) -> Column:
    label = F.lit("unknown")
    for key, pattern in reversed(ASSEMBLERS.items()):
        label = F.when(name.rlike(pattern), F.lit(key)).otherwise(label)
    return label


def taxid_from_file(file: Column) -> Column:
    return F.regexp_extract(file, r"_taxid(\d+)_", 1)


def renumber(members: DataFrame, keys: list[str]) -> DataFrame:
    """members with cluster_id cl0, cl1, ... in the order of keys (file and number in it). The numbering runs over clusters."""
    numbers = numbered(members.select(*keys).distinct(), keys, "cluster_id").withColumn("cluster_id", F.concat(F.lit("cl"), F.col("cluster_id").cast("string")))
    return members.join(numbers, keys)


def filter_members(members: DataFrame, pattern: str = CONTIGS) -> DataFrame:
    """members (sample, cluster, seq_id, is_centroid): members that match the pattern and all centroids stay; clusters
    without a matching member whose centroid doesn't match go. external_reference: the centroid doesn't match."""
    w = Window.partitionBy("sample", "cluster")
    hit = F.col("seq_id").rlike(pattern)
    marked = members.withColumn("_hit", hit).withColumn("_any", F.max("_hit").over(w)).withColumn("external_reference", F.max(F.col("is_centroid") & ~F.col("_hit")).over(w))
    return marked.filter("_any and (_hit or is_centroid)").drop("_hit", "_any")


def cluster_depth(members: DataFrame, depths: DataFrame) -> DataFrame:
    """(sample, cluster, spades, megahit, trinity): summed read percentage (sample, seq_id, percent) by assembler; names of
    no known assembler count nowhere."""
    joined = members.join(depths, ["sample", "seq_id"]).withColumn("_a", assembler(F.col("seq_id")))
    sums = [F.sum(F.when(F.col("_a") == a, F.col("percent")).otherwise(0.0)).alias(a) for a in ASSEMBLERS]
    found = joined.groupBy("sample", "cluster").agg(*sums)
    return members.select("sample", "cluster").distinct().join(found, ["sample", "cluster"], "left").fillna(0.0, list(ASSEMBLERS))


def filter_clusters(depth: DataFrame, columns: list[str], threshold: float = 1.0, keep_n: int = 5) -> DataFrame:
    """Clusters of which any column reaches the threshold; for samples without one, the keep_n of most summed depth."""
    total = sum((F.col(c) for c in columns), F.lit(0.0))
    w = Window.partitionBy("sample")
    marked = depth.withColumn("_ok", F.greatest(*columns, F.lit(float("-inf"))) >= threshold).withColumn("_total", total)
    marked = marked.withColumn("_none", ~F.max("_ok").over(w)).withColumn("_place", F.row_number().over(w.orderBy(F.desc("_total"), "cluster")))
    return marked.filter(F.col("_ok") | (F.col("_none") & (F.col("_place") <= keep_n))).drop("_ok", "_total", "_none", "_place")


def cluster_sizes(members: DataFrame) -> DataFrame:
    """(sample, cluster, size, members): members besides the centroid, and their names in order, comma-joined."""
    own = F.when(~F.col("is_centroid"), F.col("seq_id"))
    return members.groupBy("sample", "cluster").agg(F.count(own).alias("size"), F.concat_ws(",", F.sort_array(F.collect_list(own))).alias("members"))


def cluster_summary(sizes: DataFrame, before: DataFrame | None = None) -> DataFrame:
    """(sample, clusters, removed, mean_size, singletons); removed counts against the clusters (sample, cluster) before."""
    out = sizes.groupBy("sample").agg(F.count("*").alias("clusters"), F.avg("size").alias("mean_size"), F.count_if(F.col("size") == 0).alias("singletons"))
    if before is None:
        return out
    total = before.groupBy("sample").agg(F.count_distinct("cluster").alias("all"))
    return out.join(total, "sample").withColumn("removed", F.col("all") - F.col("clusters")).drop("all")


def extract_clusters(members: DataFrame, depths: DataFrame, threshold: float = 1.0, keep_n: int = 5, pattern: str = CONTIGS) -> DataFrame:
    """Clusters end to end: pattern filter, depth by assembler, threshold or best n; with size, members, external flag."""
    kept = filter_members(members, pattern)
    passed = filter_clusters(cluster_depth(kept, depths), list(ASSEMBLERS), threshold, keep_n)
    flags = kept.groupBy("sample", "cluster").agg(F.max("external_reference").alias("external_reference"))
    return passed.join(cluster_sizes(kept), ["sample", "cluster"]).join(flags, ["sample", "cluster"])


def split_by_quality(contigs: DataFrame, min_length: int, max_n: float) -> tuple[DataFrame, DataFrame]:
    """(pass, fail) of contigs (seq): length, and floor of the percentage of 'N'; an empty sequence fails."""
    share = F.floor(100 * F.regexp_count("seq", F.lit("N")) / F.length("seq"))
    ok = F.coalesce((F.length("seq") >= min_length) & (share <= max_n), F.lit(False))
    return contigs.filter(ok), contigs.filter(~ok)


def assembly_stats(contigs: DataFrame, key: str = "sample", length: str = "length", gc: str | None = None, n: str | None = None) -> DataFrame:
    """(key, contigs, total, largest, n50, l50[, gc, n_per_100k]): n50 is the length at which the sorted running total
    reaches half; lengths are counted first, so a key's window has a row a length. A key of empty contigs only reaches it at
    its first; one without letters has no shares."""
    counted = contigs.groupBy(key, length).agg(F.count("*").alias("k"))
    w = Window.partitionBy(key).orderBy(F.desc(length))
    run = counted.withColumn("sum", F.sum(F.col(length) * F.col("k")).over(w)).withColumn("cum", F.sum("k").over(w)).withColumn("total", F.sum(F.col(length) * F.col("k")).over(Window.partitionBy(key)))
    # within one length the half is reached at its ceil((half - sum before) / length)-th contig
    half = F.col("total") / 2
    before = F.col("sum") - F.col(length) * F.col("k")
    place = F.col("cum") - F.col("k") + F.greatest(F.lit(1), F.ceil(F.try_divide(half - before, F.col(length))))
    reached = F.col("sum") >= half
    out = run.groupBy(key).agg(F.sum("k").alias("contigs"), F.max("total").alias("total"), F.max(length).alias("largest"), F.max(F.when(reached, F.col(length))).alias("n50"), F.min(F.when(reached, place)).cast("long").alias("l50"))
    if gc and n:
        more = contigs.groupBy(key).agg(F.try_divide(100 * F.sum(gc), F.sum(length)).alias("gc"), F.try_divide(1e5 * F.sum(n), F.sum(length)).alias("n_per_100k"))
        out = out.join(more, key)
    return out


def n_counts(per_100k: Column, largest: Column) -> tuple[Column, Column]:
    """(number of N, percentage of N) from N per 100 kbp."""
    return (per_100k * largest / 1e5).cast("int"), F.round(per_100k / 1000, 2)
