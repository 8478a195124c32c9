"""Variants: calls from pileups, alleles, filters, codons, statistics and their application to a reference."""

from __future__ import annotations

import math
from fractions import Fraction

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strandwise.operators.alignments import depth
from strandwise.operators.intervals import bases, sequence


def call_variants(piled: DataFrame, keys: list[str], min_depth: int = 10, min_freq: float = 0.25) -> DataFrame:
    """(keys, ref_base, alt, ref_depth, alt_depth, total, freq) of a pileup with ref_base: bases other than the reference's
    with enough reads."""
    long = piled.withColumn("total", depth()).filter(F.col("total") >= min_depth).select(*keys, "ref_base", "total", F.explode(F.array(*[F.struct(F.lit(b).alias("alt"), F.col(b).alias("alt_depth")) for b in "ACGT"])).alias("v"), *"ACGT")
    ref_depth = F.element_at(F.create_map(*[x for b in "ACGT" for x in (F.lit(b), F.col(b))]), F.col("ref_base"))
    alt_depth = F.col("v.alt_depth")
    named = long.select(*keys, "ref_base", F.col("v.alt").alias("alt"), F.coalesce(ref_depth, F.lit(0)).alias("ref_depth"), alt_depth.alias("alt_depth"), "total", (alt_depth / F.col("total")).alias("freq"))
    return named.filter((F.col("alt") != F.col("ref_base")) & (F.col("freq") >= min_freq) & (F.col("alt_depth") > 0))


def call_alleles(counted: DataFrame, references: DataFrame, key: str = "ref", min_depth: int = 10, min_freq: float = 0.25) -> DataFrame:
    """(chrom, pos, ref, alt, ref_dp, ref_rv, ref_qual, alt_dp, alt_rv, alt_qual, freq, total) of count_alleles() on references
    (key, seq), named by key: bases other than the reference's, inserted strings as +X and deleted ones as -X (for typed()), of enough
    frequency at places of enough depth. total: reads with A, C, G, T or the place deleted; an insertion or deletion stands at
    the place before it. Qualities are means, null without any. Places outside the reference are left out.

    Depths are summed over a place's alleles, of which there are as many as strings, not reads. Deleted strings are read from
    the reference only for deletions that are called."""
    own = bases(references.select(F.col(key).alias("chrom"), "seq"), "chrom").select("chrom", "pos", F.col("base").alias("_ref"))
    at = counted.withColumnRenamed(key, "chrom").join(own, ["chrom", "pos"])
    w = Window.partitionBy("chrom", "pos")
    depth_of = F.when(F.col("allele").isin("A", "C", "G", "T", "*"), F.col("dp")).otherwise(0)
    is_ref = F.col("allele") == F.translate("_ref", "acgt", "ACGT")
    of_ref = lambda c, name: F.max(F.when(is_ref, F.col(c))).over(w).alias(name)
    summed = at.select("*", F.sum(depth_of).over(w).alias("total"), of_ref("dp", "ref_dp"), of_ref("rv", "ref_rv"), of_ref("quality", "_ref_quality"))
    change = F.col("allele").isin("A", "C", "G", "T") | F.col("allele").startswith("+") | F.col("deleted").isNotNull()
    zero = lambda c: F.coalesce(c, F.lit(0).cast("long"))
    freq = F.try_divide("dp", "total")
    called = summed.filter(change & ~is_ref & (F.col("total") >= min_depth) & (freq >= min_freq))
    called = called.select("chrom", "pos", F.translate("_ref", "acgt", "ACGT").alias("ref"), "allele", "deleted", zero("ref_dp").alias("ref_dp"), zero("ref_rv").alias("ref_rv"), F.try_divide("_ref_quality", "ref_dp").alias("ref_qual"), F.col("dp").alias("alt_dp"), F.col("rv").alias("alt_rv"), F.try_divide("quality", "dp").alias("alt_qual"), freq.alias("freq"), "total")
    taken = called.filter("deleted is not null").select("chrom", "pos", "deleted").distinct().join(references.select(F.col(key).alias("chrom"), "seq"), "chrom")
    strings = taken.select("chrom", "pos", "deleted", F.concat(F.lit("-"), F.translate(F.substring("seq", (F.col("pos") + 1).cast("int"), F.col("deleted").cast("int")), "acgt", "ACGT")).alias("_gone"))
    named = called.join(strings, ["chrom", "pos", "deleted"], "left").withColumn("alt", F.coalesce("_gone", "allele"))
    return named.select("chrom", "pos", "ref", "alt", "ref_dp", "ref_rv", "ref_qual", "alt_dp", "alt_rv", "alt_qual", "freq", "total")


def typed(variants: DataFrame) -> DataFrame:
    """Variants with type, and '+X' and '-X' alternates as whole alleles: +X appends to the reference, -X extends it."""
    plus, minus = F.col("alt").startswith("+"), F.col("alt").startswith("-")
    rest = F.substring("alt", 2, 1 << 30)
    return variants.withColumns({
        "type": F.when(plus, "INS").when(minus, "DEL").otherwise("SNP"),
        "alt": F.when(plus, F.concat("ref", rest)).when(minus, F.col("ref")).otherwise(F.col("alt")),
        "ref": F.when(minus, F.concat("ref", rest)).otherwise(F.col("ref")),
    })


def strand_depths(variants: DataFrame) -> DataFrame:
    """Forward depths from total and reverse ones."""
    return variants.withColumns({"ref_fw": F.col("ref_dp") - F.col("ref_rv"), "alt_fw": F.col("alt_dp") - F.col("alt_rv")})


def first_at_position(variants: DataFrame, keys: list[str], order: list[Column | str]) -> DataFrame:
    """One row a key: of several variants at a place the first."""
    return variants.withColumn("_n", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).filter("_n = 1").drop("_n")


def strand_bias(a: Column, b: Column, c: Column, d: Column) -> Column:
    """One-sided (greater) Fisher exact p-value of [[a, b], [c, d]]."""

    @F.pandas_udf("double")
    def run(a: pd.Series, b: pd.Series, c: pd.Series, d: pd.Series) -> pd.Series:
        table = np.stack([x.to_numpy(dtype=np.int64) for x in (a, b, c, d)])
        logs = np.concatenate([[0.0], np.cumsum(np.log(np.arange(1, int(table.sum(0).max(initial=0)) + 1)))])
        out = []
        for a, b, c, d in table.T.tolist():
            x = np.arange(a, min(a + b, a + c) + 1)
            fixed = logs[a + b] + logs[c + d] + logs[a + c] + logs[b + d] - logs[a + b + c + d]
            out.append(min(1.0, math.fsum(np.exp(fixed - logs[x] - logs[a + b - x] - logs[a + c - x] - logs[d - a + x]))))
        return pd.Series(out, dtype=float)

    return run(a, b, c, d)


def filter_label(passed: Column, p_value: Column, alpha: float = 0.05) -> Column:
    """PASS, or ft (failed test) and sb (strand bias) joined by ';'."""
    label = F.concat_ws(";", F.when(~passed, "ft"), F.when(p_value < alpha, "sb"))
    return F.when(label == "", "PASS").otherwise(label)


def labelled(variants: DataFrame, passed: Column, p_value: Column, alpha: float = 0.05) -> DataFrame:
    """variants with filter, the label of filter_label()."""
    return variants.withColumn("filter", filter_label(passed, p_value, alpha))


def excess(value: Column, least: float) -> Column:
    """Aggregate: by how much the sum of the values exceeds as many times least, in units of 2**-60; 0 and more if their mean
    reaches it. Sums of integers, so neither their order nor how they are split over tasks moves a mean that all but ties
    with least, as the rounding of a plain mean does. Nulls don't count; digits of a value beyond 2**-60 are cut off."""
    whole = F.floor(value * (1 << 30))
    rest = F.floor((value * (1 << 30) - whole) * (1 << 30))
    least_whole, least_rest = divmod(int(Fraction(least) * (1 << 60)), 1 << 30)
    return F.sum(whole - least_whole).cast("decimal(20,0)") * (1 << 30) + F.sum(rest - least_rest)


def passing(variants: DataFrame, least: float = 0.0, freq: str = "freq", pass_only: bool = True) -> DataFrame:
    """Variants labelled PASS, if only those are asked for, of at least that allele frequency; a null frequency doesn't reach it."""
    kept = variants.filter(F.col("filter") == "PASS") if pass_only else variants
    return kept.filter(F.col(freq) >= least)


def filter_frequency(variants: DataFrame, least: float = 0.75, freq: str | None = "freq") -> DataFrame:
    """Variants of at least that allele frequency: freq, or alt_depth / total."""
    return variants.filter((F.col(freq) if freq else F.col("alt_depth") / F.col("total")) >= least)


def merge_codons(variants: DataFrame, keys: list[str]) -> DataFrame:
    """SNPs (pos, frame 0-2, ref, alt) on consecutive places of one codon as one variant; its other fields are the first's.
    (keys, pos, ref, alt, n)."""
    codon = F.col("pos") - F.col("frame")
    w = Window.partitionBy(*keys, "_codon").orderBy("pos")
    grouped = variants.withColumn("_codon", codon).withColumn("_island", F.col("pos") - F.row_number().over(w))
    items = F.array_sort(F.collect_list(F.struct("pos", "ref", "alt")))
    out = grouped.groupBy(*keys, "_codon", "_island").agg(items.alias("v"))
    joined = lambda f: F.array_join(F.transform("v", lambda s: s[f]), "")
    return out.select(*keys, F.col("v")[0]["pos"].alias("pos"), joined("ref").alias("ref"), joined("alt").alias("alt"), F.size("v").alias("n"))


def variant_counts(variants: DataFrame, key: str) -> DataFrame:
    """(key, SNP, INS, DEL)."""
    return variants.groupBy(key).agg(*[F.count_if(F.col("type") == t).alias(t) for t in ("SNP", "INS", "DEL")])


def variant_stats(variants: DataFrame, keys: list[str]) -> DataFrame:
    """SNPs, indels, MNPs, multiallelic records, transitions, transversions and the twelve substitutions of records (ref, alt
    with ',' between alternates)."""
    alleles = F.split("alt", ",")
    one = variants.withColumn("_a", F.explode(alleles))
    snp = (F.length("ref") == 1) & (F.length("_a") == 1)
    pair = F.concat("ref", F.lit(">"), "_a")
    transitions = ["A>G", "G>A", "C>T", "T>C"]
    counts = [F.count_if(snp).alias("snps"), F.count_if(F.length("ref") != F.length("_a")).alias("indels"), F.count_if((F.length("ref") == F.length("_a")) & (F.length("ref") > 1)).alias("mnps"), F.count_if(snp & pair.isin(transitions)).alias("ts"), F.count_if(snp & ~pair.isin(transitions)).alias("tv")]
    counts += [F.count_if(snp & (pair == f"{a}>{b}")).alias(f"{a}_{b}") for a in "ACGT" for b in "ACGT" if a != b]
    multi = variants.groupBy(*keys).agg(F.count("*").alias("records"), F.count_if(F.size(alleles) > 1).alias("multiallelic"))
    return multi.join(one.groupBy(*keys).agg(*counts), keys)


def split_alleles(variants: DataFrame, per_allele: list[str] = ()) -> DataFrame:
    """A row an alternate; values in per_allele are comma-joined lists, dealt in order."""
    out = variants.select("*", F.posexplode(F.split("alt", ",")).alias("_i", "_alt"))
    for c in per_allele:
        out = out.withColumn(c, F.try_element_at(F.split(c, ","), F.col("_i") + 1))
    return out.withColumn("alt", F.col("_alt")).withColumn("allele", F.col("_i") + 1).drop("_i", "_alt")


def apply_variants(reference: DataFrame, variants: DataFrame) -> DataFrame:
    """(key, seq): reference (key, seq) with variants (key, pos, ref, alt): at pos stands alt, and the rest of ref goes. Of
    overlapping variants the first by place, then by allele, is taken at each place."""
    one = first_at_position(variants, ["key", "pos"], ["ref", "alt"])
    gone = one.filter("length(ref) > 1").select("key", F.explode(F.sequence(F.col("pos") + 1, F.col("pos") + F.length("ref") - 1)).alias("pos")).distinct().withColumn("gone", F.lit(True))
    placed = bases(reference).join(one.select("key", F.col("pos").cast("long").alias("pos"), "alt"), ["key", "pos"], "left").join(gone, ["key", "pos"], "left")
    return sequence(placed.withColumn("base", F.when(F.col("gone"), "").when(F.col("alt").isNotNull(), F.col("alt")).otherwise(F.col("base"))), ["key"])


def sort_variants(variants: DataFrame) -> DataFrame:
    return variants.orderBy("chrom", "pos", "ref", "alt")
