"""Exact duplicates by two-pass Bloom filtering: only rows whose hash may repeat are shuffled."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strandwise.llm.bloom import bits_for, may_hold, repeated_bits
from strandwise.storage import stored


def _hash(text: Column) -> Column:
    """Lowercase hexadecimal SHA-256 of the text in UTF-8; a null counts as empty."""
    return F.sha2(F.coalesce(text.cast("string"), F.lit("")).cast("binary"), 256)


def _id(df: DataFrame) -> Column:
    return df["doc_id"].cast("long")


def exact_groups(docs: DataFrame) -> DataFrame:
    """(doc_id, keep_id, group_size, kept, text_sha256) for every row of docs (doc_id, text, any other columns).

    Of equal texts the row with the largest doc_id stays; null and empty texts are equal. Rows that repeat that doc_id
    with that text are all marked kept. A null doc_id is below every other; a group with no other id has a null keep_id
    and keeps its rows. First pass: a Bloom bitmap of the hashes hit more than once. Second pass: rows outside it pass
    straight through as groups of one, the others are counted by hash; a hot hash is partly counted before the shuffle.
    The counts are stored, so that the join on the hash has plain shuffles on both sides, which the skew join can split
    (over an aggregation it can't), or none where the counts are small.
    """
    rows = docs.select(_id(docs).alias("doc_id"), _hash(docs["text"]).alias("text_sha256"))
    short = rows.select(F.xxhash64("text_sha256").alias("h"))
    bitmap = repeated_bits(short, "h", bits_for(docs.select("doc_id").count()))
    marked = rows.withColumn("again", may_hold(docs, bitmap, F.xxhash64("text_sha256")))
    alone = marked.filter("not again").select("doc_id", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"), F.lit(True).alias("kept"), "text_sha256")
    again = marked.filter("again").drop("again")
    groups = stored(again.groupBy("text_sha256").agg(F.max("doc_id").alias("keep_id"), F.count("*").alias("group_size")))
    joined = again.join(groups, "text_sha256").select("doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256")
    return alone.unionAll(joined)


def without_copies(docs: DataFrame) -> DataFrame:
    """The rows of docs that stay, columns as given, whatever their names: of each text the row with the largest doc_id, once.

    Rows outside the Bloom bitmap aren't shuffled; of the others, each text's rows meet by hash, partly reduced first.
    Null and empty texts are equal; a null doc_id is below every other; of rows that tie, any one stays.
    """
    hashed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"), _id(docs).alias("_id"), _hash(docs["text"]).alias("_sha"))
    bitmap = repeated_bits(hashed.select(F.xxhash64("_sha").alias("h")), "h", bits_for(docs.select("doc_id").count()))
    marked = hashed.withColumn("_again", may_hold(docs, bitmap, F.xxhash64("_sha")))
    again = marked.filter("_again")
    keep = again.groupBy("_sha").agg(F.max("_id").alias("_keep"))
    last = again.join(keep, "_sha").filter(F.col("_id").eqNullSafe(F.col("_keep"))).dropDuplicates(["_sha"])
    return marked.filter("not _again").select("_row.*").unionAll(last.select("_row.*"))


EXACT_SQL = """
SELECT doc_id,
       max(doc_id) OVER (PARTITION BY h) AS keep_id,
       count(*) OVER (PARTITION BY h) AS group_size,
       doc_id = max(doc_id) OVER (PARTITION BY h) AS kept,
       h AS text_sha256
FROM (SELECT doc_id, sha256(coalesce(text, '')) AS h FROM documents)
"""
