"""Mixing sources to target weights by systematic sampling over prefix sums. DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strandwise.storage import stored

#: Fixed-point unit of expected copies, so that prefix sums are exact in any order.
UNIT = 1 << 32
LEAST_BUCKETS, ROWS_A_BUCKET = 256, 4096
WORD = "[^\\x20\\x09-\\x0D]+"


def words_in(text: Column) -> Column:
    """Number of runs of characters other than space and the controls 9 to 13; null: 0."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights: tuple[float, ...] = (3, 1, 2), share: float = 1.5, most: int = 2) -> DataFrame:
    """(source, source_size, target) from sizes (source, size): one row a source.

    Sources by code point, null last, take the weights in turn; the targets share share times all sizes by weight, and
    none exceeds most times its source's size: what is over goes to the others by weight. Closed form: in order of
    most * size / weight, sources are full as long as the level that the rest would get isn't lower. The windows run
    over sources (one row each), not documents.
    """
    total = sizes.groupBy("source").agg(F.sum("size").cast("long").alias("source_size"))
    order = Window.orderBy(F.col("source").isNull(), F.col("source"))
    turn = (F.row_number().over(order) - 1) % len(weights)
    weighted = total.withColumn("weight", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), turn + 1))
    weighted = weighted.withColumn("ratio", F.lit(float(most)) * F.col("source_size") / F.col("weight"))
    level_order = Window.orderBy("ratio", F.col("source").isNull(), F.col("source"))
    below = level_order.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    levels = weighted.select(
        "*",
        (F.lit(share) * F.sum("source_size").over(everything) - F.lit(float(most)) * F.coalesce(F.sum("source_size").over(below), F.lit(0))).alias("left"),
        (F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(below), F.lit(0.0))).alias("rest"),
    )
    level = F.max(F.when(F.col("left") / F.col("rest") < F.col("ratio"), F.col("left") / F.col("rest"))).over(everything)
    levels = levels.withColumn("level", level)
    full = F.col("level").isNull() | (F.col("ratio") <= F.col("level"))
    return levels.select("source", "source_size", F.when(full, F.lit(float(most)) * F.col("source_size")).otherwise(F.col("level") * F.col("weight")).alias("target"))


def copies(groups: DataFrame, expected: Column, seed: int = 17) -> DataFrame:
    """groups (source, size, row_key, members, ...) with copies, the copies of all members: systematic sampling within each source.

    The expected copies of the rows (expected a member, 0 or more) are prefix-summed within the source; with one random
    offset a source, a row is emitted once for each integer that its part of the sum crosses, so a source's total is within
    one copy of what is expected. Order: size class (a quarter of an octave), then a hash bucket, then row_key; sums over
    buckets come first, so no window holds a whole source's rows. A null source is a source of its own.
    """
    n = max(LEAST_BUCKETS, -(-groups.count() // ROWS_A_BUCKET))
    units = F.round(expected * UNIT).cast("long") * F.col("members")
    names = [f"`{c}`" for c in groups.columns]
    cut = groups.select(F.struct(*names).alias("_row"), F.struct("source").alias("_s"), F.floor(F.log2(F.col("size") + 1) * 4).cast("int").alias("_c"), F.pmod(F.xxhash64("row_key"), F.lit(n)).alias("_b"), units.alias("_units"))
    keys = ["_s", "_c", "_b"]
    sums = cut.groupBy(*keys).agg(F.sum("_units").alias("_sum"))
    class_sums = sums.groupBy("_s", "_c").agg(F.sum("_sum").alias("_class_sum"))
    before = Window.unboundedPreceding, -1
    class_before = class_sums.select("_s", "_c", F.coalesce(F.sum("_class_sum").over(Window.partitionBy("_s").orderBy(F.desc("_c")).rowsBetween(*before)), F.lit(0)).alias("_class_before"))
    in_class = F.coalesce(F.sum("_sum").over(Window.partitionBy("_s", "_c").orderBy("_b").rowsBetween(*before)), F.lit(0))
    starts = sums.select(*keys, in_class.alias("_in_class")).join(class_before, ["_s", "_c"]).select(*keys, (F.col("_in_class") + F.col("_class_before")).alias("_start"))
    inner = Window.partitionBy(*keys).orderBy("_row.row_key", "_row.size").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    joined = cut.withColumn("_end", F.sum("_units").over(inner)).join(starts, keys)
    offset = F.pmod(F.xxhash64(F.coalesce("_s.source", F.lit("")), F.lit(seed)), F.lit(UNIT))
    end = F.col("_end") + F.col("_start") + offset
    return joined.select("_row.*", (F.floor(end / UNIT) - F.floor((end - F.col("_units")) / UNIT)).alias("copies"))


def _row_key() -> Column:
    """Tells documents apart: the id and a hash of the text. Never null itself, and equal where both are."""
    return F.struct(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("h"))


def _drawn(docs: DataFrame, weights: tuple[float, ...], share: float, most: int, seed: int) -> DataFrame:
    """(row_key, source, size, members, source_size, target, copies): rows that repeat id, text and source are one group of so
    many members. The words of every text are counted once; no text is shuffled."""
    sized = docs.select(_row_key().alias("row_key"), F.col("source").cast("string").alias("source"), words_in(F.col("text").cast("string")).alias("size"))
    groups = stored(sized.groupBy("row_key", "source", "size").agg(F.count("*").alias("members")))
    totals = groups.select("source", (F.col("size") * F.col("members")).alias("size"))
    targets = source_targets(totals, weights, share, most).select(F.struct("source").alias("_s"), "source_size", "target")
    joined = groups.withColumn("_s", F.struct("source")).join(targets, "_s").drop("_s")
    expected = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    return copies(joined, expected, seed)


def _share(nth: Column) -> Column:
    """Copies of the nth member of a group, from 1."""
    return F.floor(F.col("copies") / F.col("members")) + (nth <= F.col("copies") % F.col("members")).cast("long")


def mix_sources(docs: DataFrame, weights: tuple[float, ...] = (3, 1, 2), share: float = 1.5, most: int = 2, seed: int = 17) -> DataFrame:
    """(doc_id, source, size, source_size, target, copies, taken) for every row of docs (doc_id, text, source, ...).

    Null texts have size 0, a null source is a source of its own, a source of empty texts has target 0. Rows that repeat
    a doc_id, text and source share their copies evenly. Other columns, whatever their names, play no part. An empty table
    gives no rows. Very long texts are counted whole; a source's words come within about its longest document of the target.
    """
    rows = _drawn(docs, weights, share, most, seed).withColumn("nth", F.explode(F.sequence(F.lit(1).cast("long"), F.col("members"))))
    rows = rows.select(F.col("row_key.doc_id").alias("doc_id"), "source", "size", "source_size", "target", _share(F.col("nth")).cast("long").alias("copies"))
    return rows.withColumn("taken", F.col("size") * F.col("copies"))


def mixed_documents(docs: DataFrame, weights: tuple[float, ...] = (3, 1, 2), share: float = 1.5, most: int = 2, seed: int = 17) -> DataFrame:
    """docs itself mixed: each row as often as its copies say, columns as given, whatever their names.

    Copies are drawn on ids; then each text meets its number once, in one shuffle. Only rows that repeat doc_id, text and
    source are numbered within their group, to share its copies; ties there are taken in any order.
    """
    drawn = stored(_drawn(docs, weights, share, most, seed).filter("copies > 0").select(F.struct("row_key", "source").alias("_key"), "members", "copies"))
    tagged = docs.select(F.struct(_row_key().alias("row_key"), F.col("source").cast("string").alias("source")).alias("_key"), F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"))
    joined = tagged.join(drawn, "_key")
    once = joined.filter("members = 1").select("_row", "copies")
    if not drawn.filter("members > 1").isEmpty():
        several = joined.filter("members > 1").withColumn("_nth", F.row_number().over(Window.partitionBy("_key").orderBy("_key")))
        once = once.unionAll(several.select("_row", _share(F.col("_nth")).cast("long").alias("copies")).filter("copies > 0"))
    return once.select("_row", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))).alias("_copy")).select("_row.*")
