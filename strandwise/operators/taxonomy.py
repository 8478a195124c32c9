"""Taxonomies as edge tables (taxid, parent_taxid, rank): closures, ancestors in common, merging of classifiers, clade counts."""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strandwise.storage import stored

#: Levels of the ranks; ranks between them have none and are passed through.
LEVELS = {"R": 9, "D": 8, "K": 7, "P": 6, "C": 5, "O": 4, "F": 3, "G": 2, "S": 1}


def ancestors(taxonomy: DataFrame, rounds: int = 9) -> DataFrame:
    """(taxid, ancestor, depth): each taxon with itself (depth 0) and all above it. By doubling: a round puts the ancestors of
    those that are reached at the full depth so far on top, so a tree of depth d takes about log2(d) rounds of one join. A tree
    deeper than 2 ** rounds levels, or with a cycle, is an error."""
    nodes = taxonomy.select("taxid", F.col("taxid").alias("ancestor"), F.lit(0).alias("depth"))
    known = stored(taxonomy.select("taxid", "parent_taxid").join(taxonomy.select(F.col("taxid").alias("parent_taxid")), "parent_taxid", "left_semi").select("taxid", F.col("parent_taxid").alias("ancestor"), F.lit(1).alias("depth")).distinct())
    reach = 1
    for _ in range(rounds + 1):
        ends = known.filter(F.col("depth") == reach).select(F.col("taxid").alias("_leaf"), F.col("ancestor").alias("taxid"))
        further = stored(ends.join(known, "taxid").select(F.col("_leaf").alias("taxid"), "ancestor", (F.col("depth") + reach).alias("depth")).distinct())
        if further.isEmpty():
            return nodes.unionAll(known).groupBy("taxid", "ancestor").agg(F.min("depth").alias("depth"))
        known, reach = known.unionAll(further), 2 * reach
    raise RuntimeError("ancestors did not settle")


def descendants(closure: DataFrame) -> DataFrame:
    """(taxid, descendant, depth) from a closure."""
    return closure.select(F.col("ancestor").alias("taxid"), F.col("taxid").alias("descendant"), "depth")


def common_ancestor(pairs: DataFrame, closure: DataFrame) -> DataFrame:
    """pairs (a, b, ...) with lca: the deepest ancestor that both have; null if they have none."""
    distinct = pairs.select("a", "b").distinct()
    up_a = closure.select(F.col("taxid").alias("a"), F.col("ancestor").alias("c"), F.col("depth").alias("da"))
    up_b = closure.select(F.col("taxid").alias("b"), F.col("ancestor").alias("c"))
    found = distinct.join(up_a, "a").join(up_b, ["b", "c"]).groupBy("a", "b").agg(F.min_by("c", "da").alias("lca"))
    return pairs.join(found, ["a", "b"], "left")


def fold_to_common(found: DataFrame, closure: DataFrame, key: str | list[str]) -> DataFrame:
    """(key, taxid): of rows (key, taxid, ...) the deepest taxon that all taxa of a key lie under, itself included; null where
    they have none in common, or one of them isn't in the closure.

    One aggregation for any number of taxa: an ancestor is common to all if as many of the key's taxa lie under it as there
    are. Keys of one taxon, most of them as a rule, are settled without their ancestors."""
    keys = [key] if isinstance(key, str) else list(key)
    distinct = found.filter("taxid is not null").select(*keys, "taxid").distinct()
    sized = distinct.groupBy(*keys).agg(F.count("*").alias("_n"), F.min("taxid").alias("taxid"))
    level = closure.groupBy("taxid").agg(F.max("depth").alias("_level"))
    up = closure.select("taxid", "ancestor").join(level.withColumnRenamed("taxid", "ancestor"), "ancestor")
    several = sized.filter("_n > 1").select(*[F.col(k).alias(f"_{k}") for k in keys], "_n")
    same = functools.reduce(lambda x, y: x & y, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys])
    counted = distinct.join(several, same).join(up, "taxid").groupBy(*keys, "_n", "ancestor", "_level").agg(F.count("*").alias("_under"))
    common = counted.groupBy(*keys).agg(F.max(F.when(F.col("_under") == F.col("_n"), F.struct("_level", "ancestor")))["ancestor"].alias("taxid"))
    lost = sized.filter("_n > 1").select(*keys).exceptAll(common.select(*keys)).withColumn("taxid", F.lit(None).cast("string"))
    return sized.filter("_n = 1").select(*keys, "taxid").unionAll(common.select(*keys, "taxid")).unionAll(lost)


def merge_classifiers(first: DataFrame, second: DataFrame, closure: DataFrame, strategy: str = "lca") -> DataFrame:
    """(name, flag, taxid) from two tables (flag C or U, name, taxid). Where only one classifies, it wins; equal taxids stay;
    else strategy decides: '1' or '2' take that table, 'lca' the common ancestor, 'lowest' the lower of two that lie on one
    line, else the common ancestor. Names that one table lacks keep the other's row."""
    if strategy not in ("1", "2", "lca", "lowest"):
        raise ValueError(f"unknown strategy {strategy}")
    one = first.select("name", F.col("flag").alias("f1"), F.col("taxid").alias("a"))
    two = second.select("name", F.col("flag").alias("f2"), F.col("taxid").alias("b"))
    both = common_ancestor(one.join(two, "name", "full"), closure)
    prefer_two = F.col("f1").isNull() | ((F.col("f1") == "U") & (F.col("f2") == "C"))
    same = F.col("f2").isNull() | ((F.col("f1") == "C") & (F.col("f2") == "U")) | (F.col("a") == F.col("b"))
    lca = F.coalesce("lca", F.lit("1"))
    rule = {"1": F.col("a"), "2": F.col("b"), "lca": lca, "lowest": F.when(F.col("lca") == F.col("a"), F.col("b")).when(F.col("lca") == F.col("b"), F.col("a")).otherwise(lca)}[strategy]
    flag = F.when(prefer_two, F.col("f2")).when(same | F.lit(strategy == "1"), F.col("f1")).when(F.lit(strategy == "2"), F.col("f2")).otherwise(F.col("f1"))
    return both.select("name", flag.alias("flag"), F.when(prefer_two, F.col("b")).when(same, F.col("a")).otherwise(rule).alias("taxid"))


def mismatched_names(first: DataFrame, second: DataFrame) -> DataFrame:
    """(name) that only one of two classification tables has."""
    a, b = first.select("name").distinct().withColumn("x", F.lit(1)), second.select("name").distinct().withColumn("y", F.lit(1))
    return a.join(b, "name", "full").filter("x is null or y is null").select("name")


def simplify_to_rank(taxids: DataFrame, taxonomy: DataFrame, closure: DataFrame, rank: str) -> DataFrame:
    """taxids (taxid, ...) with resolved: the nearest taxon, itself first, whose level is rank's or above; without one the
    last that can be reached."""
    if rank not in LEVELS:
        raise ValueError(f"unknown rank {rank}")
    level = F.coalesce(F.element_at(F.create_map(*[F.lit(x) for kv in LEVELS.items() for x in kv]), F.col("rank")), F.lit(-1))
    ranked = taxonomy.select(F.col("taxid").alias("ancestor"), level.alias("level"))
    up = taxids.select("taxid").distinct().join(closure, "taxid").join(ranked, "ancestor")
    found = up.groupBy("taxid").agg(F.coalesce(F.min_by("ancestor", F.when(F.col("level") >= LEVELS[rank], F.col("depth"))), F.max_by("ancestor", "depth")).alias("resolved"))
    return taxids.join(found, "taxid", "left").withColumn("resolved", F.coalesce("resolved", "taxid"))


def relatives(taxids: DataFrame, closure: DataFrame, children: bool = True, parents: bool = False) -> DataFrame:
    """(taxid): the given ones with everything below (children) and above (parents) them."""
    out = taxids.select("taxid")
    if children:
        out = out.unionAll(taxids.select(F.col("taxid").alias("ancestor")).join(closure, "ancestor").select("taxid"))
    if parents:
        out = out.unionAll(taxids.join(closure, "taxid").select(F.col("ancestor").alias("taxid")))
    return out.distinct()


def classified(df: DataFrame) -> DataFrame:
    """Rows with a taxon: neither flag U nor taxid 0."""
    return df.filter((F.col("flag") != "U") & (F.col("taxid") != "0"))


def clade_counts(counts: DataFrame, closure: DataFrame) -> DataFrame:
    """(taxid, clade_reads, direct_reads) from counts (taxid, reads)."""
    direct = counts.groupBy("taxid").agg(F.sum("reads").alias("direct_reads"))
    clade = direct.join(closure, "taxid").groupBy("ancestor").agg(F.sum("direct_reads").alias("clade_reads"))
    return clade.withColumnRenamed("ancestor", "taxid").join(direct, "taxid", "left").select("taxid", "clade_reads", F.coalesce("direct_reads", F.lit(0)).alias("direct_reads"))


def taxa_counts(hits: DataFrame) -> tuple[DataFrame, DataFrame]:
    """((sample, ntaxa), (sample, taxid, hits)) of classified rows (sample, taxid): taxa a sample, and hits a taxon. A null
    taxid is no taxon."""
    by_taxon = hits.filter("taxid is not null").groupBy("sample", "taxid").agg(F.count("*").alias("hits"))
    return hits.select("sample").distinct().join(by_taxon.groupBy("sample").agg(F.count("*").alias("ntaxa")), "sample", "left").fillna(0, ["ntaxa"]), by_taxon


def unclassified_reads(reports: DataFrame, key: str = "file") -> DataFrame:
    """(key, reads): the clade reads of a report's unclassified row, 0 for reports without one."""
    return reports.groupBy(key).agg(F.coalesce(F.sum(F.when(F.trim("name") == "unclassified", F.col("clade_reads"))), F.lit(0)).cast("long").alias("reads"))


def taxon_table(counts: DataFrame, taxonomy: DataFrame, closure: DataFrame, rank: str = "S") -> DataFrame:
    """(sample, taxid, reads, percent) of counts (sample, taxid, reads) summed to the taxa of one rank; percent of all reads."""
    at_rank = taxonomy.filter(F.col("rank") == rank).select(F.col("taxid").alias("ancestor"))
    total = counts.groupBy("sample").agg(F.sum("reads").alias("total"))
    clade = counts.join(closure, "taxid").join(at_rank, "ancestor", "left_semi").groupBy("sample", F.col("ancestor").alias("taxid")).agg(F.sum("reads").alias("reads"))
    return clade.join(total, "sample").select("sample", "taxid", "reads", (100 * F.col("reads") / F.col("total")).alias("percent"))


def reestimate(counts: DataFrame, weights: DataFrame, closure: DataFrame) -> DataFrame:
    """(taxid, reads): reads at each node (taxid, reads) dealt to the weighted taxa (taxid, weight) in its clade, by weight."""
    below = closure.select(F.col("taxid").alias("leaf"), F.col("ancestor").alias("taxid")).join(weights.select(F.col("taxid").alias("leaf"), "weight"), "leaf")
    share = below.withColumn("share", F.try_divide(F.col("weight"), F.sum("weight").over(Window.partitionBy("taxid"))))
    return counts.join(share, "taxid").groupBy(F.col("leaf").alias("taxid")).agg(F.sum(F.col("reads") * F.col("share")).alias("reads"))


def lineage_rows(counts: DataFrame, closure: DataFrame, names: DataFrame) -> DataFrame:
    """(lineage, reads): paths of names from the root, rank prefixes cut and underscores as blanks, with summed reads."""
    clean = F.regexp_replace(F.regexp_replace("name", "^[a-z]__", ""), "_", " ")
    path = closure.join(names.select(F.col("taxid").alias("ancestor"), clean.alias("n")), "ancestor").groupBy("taxid").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct(-F.col("depth"), "n"))), lambda s: s["n"]), ";").alias("lineage"))
    return counts.join(path, "taxid").groupBy("lineage").agg(F.sum("reads").alias("reads"))


def precluster(first: DataFrame, second: DataFrame, taxonomy: DataFrame, closure: DataFrame, strategy: str = "lowest", rank: str | None = None, keep: DataFrame | None = None, drop: DataFrame | None = None) -> DataFrame:
    """(name, flag, taxid, resolved): merged classifications, classified only, within a whitelist (taxid) or outside a
    blacklist, simplified to a rank."""
    merged = classified(merge_classifiers(first, second, closure, strategy))
    merged = merged.join(keep, "taxid", "left_semi") if keep is not None else merged
    merged = merged.join(drop, "taxid", "left_anti") if drop is not None else merged
    return simplify_to_rank(merged, taxonomy, closure, rank) if rank else merged.withColumn("resolved", F.col("taxid"))


def taxon_sequences(report: DataFrame, sequences: DataFrame) -> DataFrame:
    """(resolved, seq_id, seq, ...) of the sequences (seq_id, ...) that precluster() puts to a taxon: the sequences a taxon, for
    write_fasta(by="resolved"). Names without a sequence, and sequences without a taxon, are left out."""
    return sequences.join(report.select(F.col("name").alias("seq_id"), "resolved"), "seq_id").select("resolved", *sequences.columns)
