"""Half-open intervals (chrom, start, end) and positions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strandwise.operators.scan import dealt, running

#: Width of the bins that turn range joins into equi joins.
BIN = 1 << 14
#: Letters of a sequence in one row, where it is cut.
PIECE = 1 << 12


def merge_intervals(df: DataFrame, keys: list[str], gap: int = 0) -> DataFrame:
    """Overlapping or touching (up to gap apart) intervals as one, with n: how many went in. A key's intervals are scanned by
    ranges, so a key of any number of them is no single task's work. Equal intervals are counted first, so no order among them
    is left open. An interval without a start goes with its key's last, one without an end stands after those of its start."""
    order = ["_no_start", "start", "_no_end", "end"]
    # those that end before they start, by more than gap, don't reach their own copies, and stay rows of their own
    apart = F.when(F.col("start") > F.col("end") + gap, F.monotonically_increasing_id())
    counted = df.select(*keys, "start", "end").withColumn("_apart", apart).groupBy(*keys, "start", "end", "_apart").agg(F.count("*").alias("_copies")).drop("_apart")
    placed = counted.withColumns({"_no_start": F.col("start").isNull(), "_no_end": F.col("end").isNull()})
    far = running(dealt(placed, keys, order), keys, order, {"_far": ("max", F.col("end"))}, before=True)
    marked = far.withColumn("_new", F.when(F.col("start") > F.col("_far") + gap, 1).otherwise(0))
    return running(marked, keys, order, {"_g": ("sum", F.col("_new"))}).groupBy(*keys, "_g").agg(F.min("start").alias("start"), F.max("end").alias("end"), F.sum("_copies").alias("n")).drop("_g")


def runs(df: DataFrame, keys: list[str], pos: str = "pos") -> DataFrame:
    """Distinct positions as runs of consecutive ones: (keys, start, end), end inclusive. Scanned by ranges, as intervals are."""
    placed = running(dealt(df.select(*keys, pos).distinct(), keys, [pos]), keys, [pos], {"_n": ("sum", F.lit(1))})
    return placed.groupBy(*keys, (F.col(pos) - F.col("_n")).alias("_g")).agg(F.min(pos).alias("start"), F.max(pos).alias("end")).drop("_g")


def low_depth(depth: DataFrame, limit: int, inclusive: bool = False) -> DataFrame:
    """0-based one-base intervals of positions (ref, pos, depth; 1-based) below the limit."""
    low = F.col("depth") <= limit if inclusive else F.col("depth") < limit
    return depth.filter(low).select(F.col("ref").alias("chrom"), (F.col("pos") - 1).alias("start"), F.col("pos").alias("end"))


def _bins(df: DataFrame, start: Column, end: Column) -> DataFrame:
    return df.withColumn("_bin", F.explode(F.sequence(F.floor(start / BIN), F.floor(end / BIN))))


def mask_without_indels(intervals: DataFrame, indels: DataFrame) -> DataFrame:
    """Intervals whose start and end lie in no indel (chrom, pos, len): from pos on, len - 1 positions. By bins, an equi join."""
    spans = _bins(indels.select("chrom", F.col("pos").alias("a"), (F.col("pos") + F.col("len") - 1).alias("b")).filter("b > a"), F.col("a"), F.col("b"))
    ends = intervals.select("chrom", F.explode(F.array_distinct(F.array("start", "end"))).alias("at"), "start", "end").withColumn("_bin", F.floor(F.col("at") / BIN))
    bad = ends.join(spans, ["chrom", "_bin"]).filter("at >= a and at < b").select("chrom", "start", "end").distinct()
    return intervals.join(bad, ["chrom", "start", "end"], "left_anti")


def project_positions(blocks: DataFrame, positions: DataFrame) -> DataFrame:
    """positions (key, pos) through blocks (key, ref_start, ref_end, query_start, query_end), half-open: (key, pos, query_pos);
    positions in no block are lost."""
    cut = _bins(blocks.filter("ref_end > ref_start"), F.col("ref_start"), F.col("ref_end") - 1)
    found = positions.withColumn("_bin", F.floor(F.col("pos") / BIN)).join(cut, ["key", "_bin"]).filter("pos >= ref_start and pos < ref_end")
    return found.select("key", "pos", (F.col("query_start") + F.col("pos") - F.col("ref_start")).alias("query_pos"))


def pieces(sequences: DataFrame, *keys: str) -> DataFrame:
    """(keys, block, piece): seq cut every PIECE letters, blocks numbered from 0."""
    return sequences.select(*keys, F.posexplode(F.regexp_extract_all("seq", F.lit(f"(?s).{{1,{PIECE}}}"), F.lit(0))).alias("block", "piece"))


def bases(sequences: DataFrame, key: str = "key") -> DataFrame:
    """(key, pos, base) of each position, from 1."""
    letters = pieces(sequences, key).select(key, "block", F.posexplode(F.split("piece", "")).alias("p", "base")).filter("base <> ''")
    return letters.select(key, (F.col("block").cast("long") * PIECE + F.col("p") + 1).alias("pos"), "base")


def sequence(rows: DataFrame, keys: list[str], base: str = "base", pos: str = "pos") -> DataFrame:
    """(keys, seq): bases joined in order of position. A sequence is one value, so it meets in one row, as pieces that are
    joined before."""
    joined = lambda at, part: F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(at, part))), lambda s: s[part]), "")
    parts = rows.groupBy(*keys, F.floor(F.col(pos) / PIECE).alias("_block")).agg(joined(pos, base).alias("_part"))
    return parts.groupBy(*keys).agg(joined("_block", "_part").alias("seq"))


def mask_sequence(sequences: DataFrame, intervals: DataFrame) -> DataFrame:
    """sequences (chrom, seq) with N on every interval (chrom, start, end)."""
    merged = intervals.groupBy("chrom").agg(F.array_sort(F.collect_list(F.struct("start", "end"))).alias("cuts"))
    at = lambda a, b: F.substring(F.col("seq"), a + 1, F.greatest(b - a, F.lit(0)))
    start = F.struct(F.lit(0).cast("long").alias("at"), F.lit("").alias("out"))

    def step(acc, cut):
        s, e = F.greatest(acc["at"], cut["start"].cast("long")), F.least(cut["end"].cast("long"), F.length("seq").cast("long"))
        s = F.least(s, F.length("seq").cast("long"))
        return F.struct(F.greatest(acc["at"], e).alias("at"), F.concat(acc["out"], at(acc["at"], s), F.repeat(F.lit("N"), F.greatest(e - s, F.lit(0)).cast("int"))).alias("out"))

    done = F.aggregate("cuts", start, step, lambda acc: F.concat(acc["out"], at(acc["at"], F.length("seq").cast("long"))))
    return sequences.join(merged, "chrom", "left").select("chrom", F.when(F.col("cuts").isNull(), F.col("seq")).otherwise(done).alias("seq"))


def patch_low_coverage(consensus: DataFrame, reference: DataFrame, low: DataFrame, blocks: DataFrame) -> DataFrame:
    """(key, seq): consensus (key, seq) where the positions in low (key, pos; 0-based in the reference) take the reference's
    base at the place that the blocks give; positions without a place stay."""
    place = project_positions(blocks, low)
    bases_of = bases(reference).withColumnRenamed("base", "new").withColumn("pos", F.col("pos") - 1)
    patch = place.join(bases_of, ["key", "pos"]).groupBy("key", (F.col("query_pos") + 1).alias("pos")).agg(F.first("new").alias("new"))
    return sequence(bases(consensus).join(patch, ["key", "pos"], "left").withColumn("base", F.coalesce("new", "base")), ["key"])
