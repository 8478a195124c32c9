"""Search hits: filters, best hits, reference look-ups and title annotations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def filter_hits(hits: DataFrame, max_evalue: float = 0.01, min_bitscore: float = 50, min_aligned: float = 0.80) -> DataFrame:
    """Hits within all thresholds; a threshold of 0 switches its rule off."""
    out = hits.withColumn("aligned", F.col("length") / F.col("qlen"))
    for limit, rule in ((max_evalue, F.col("evalue") <= max_evalue), (min_bitscore, F.col("bitscore") >= min_bitscore), (min_aligned, F.col("aligned") >= min_aligned)):
        if limit:
            out = out.filter(rule)
    return out


def best_hits(hits: DataFrame, n: int = 1, order: list[Column] | None = None) -> DataFrame:
    """The n best hits of each query: bitscore, then evalue and subject."""
    w = Window.partitionBy("query").orderBy(*(order or [F.desc("bitscore"), "evalue", "subject"]))
    return hits.withColumn("place", F.row_number().over(w)).filter(F.col("place") <= n)


def matched_references(hits: DataFrame, references: DataFrame) -> tuple[DataFrame, DataFrame]:
    """References (seq_id, ...) that a hit names, and the (seq_id) of hits that no reference has."""
    named = hits.select(F.col("subject").alias("seq_id")).distinct()
    return references.join(named, "seq_id", "left_semi"), named.join(references, "seq_id", "left_anti")


def with_references(contigs: DataFrame, hits: DataFrame, references: DataFrame) -> DataFrame:
    """Contigs together with the references that they hit."""
    return contigs.unionByName(matched_references(hits, references)[0], allowMissingColumns=True)


def percent_aligned(length: Column, total: Column) -> Column:
    return F.round(100 * length / total, 2)


def key_values(title: Column) -> Column:
    """Map of key="value" and key=value pairs in a title; the last of equal keys wins."""
    keys, values = (F.regexp_extract_all(title, F.lit(r'(\w+)=(?:"([^"]*)"|([^;\s"]+))'), F.lit(i)) for i in (1, 2))
    plain = F.regexp_extract_all(title, F.lit(r'(\w+)=(?:"([^"]*)"|([^;\s"]+))'), F.lit(3))
    pairs = F.arrays_zip(keys.alias("k"), F.zip_with(values, plain, lambda a, b: F.when(b == "", a).otherwise(b)).alias("v"))
    last = F.filter(pairs, lambda p, i: ~F.exists(F.slice(pairs, i + 2, F.size(pairs)), lambda q: q["k"] == p["k"]))
    return F.map_from_entries(last)


def best_reference(screen: DataFrame, keys: list[str] = ()) -> DataFrame:
    """The top row of each screen by identity, then shared hashes 'a/b'; ties by query. An aggregation, so that one screen of
    any number of rows isn't sorted in one task."""
    shared = F.split_part("shared-hashes", F.lit("/"), F.lit(1)).cast("long")
    rank = F.struct(F.col("identity").alias("i"), shared.alias("s"))
    best = screen.withColumn("_rank", rank).groupBy(*keys, "_rank").agg(F.min_by(F.struct(*[f"`{c}`" for c in screen.columns]), F.col("`query-ID`")).alias("_row"))
    return best.groupBy(*keys).agg(F.max_by("_row", "_rank").alias("_row")).filter("_row is not null").select("_row.*")


def best_reference_sequence(screen: DataFrame, references: DataFrame, keys: list[str] = ()) -> DataFrame:
    """best_reference() rows with seq_id and seq of the reference (seq_id, seq) that each names; backslashes in ids stand as -
    in the result. Top rows whose reference is missing are left out, as a search without a result is."""
    top = best_reference(screen, keys).withColumn("_id", F.col("`query-ID`"))
    named = references.select(F.col("seq_id").alias("_id"), F.col("seq").alias("_seq"))
    joined = top.join(named, "_id")
    return joined.select(*[f"`{c}`" for c in screen.columns], F.translate("_id", "\\", "-").alias("seq_id"), F.col("_seq").alias("seq"))
