"""Aligned reads and pileups: counts, depth, metrics, duplicates, entropy and consensus."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strandwise.operators.intervals import PIECE, bases, pieces, sequence
from strandwise.operators.scan import dealt, running
from strandwise.storage import stored

#: Flag bits, coverage steps, and IUPAC codes by the set of bases A 1, C 2, G 4, T 8.
FLAGS = {"paired": 1, "proper_pair": 2, "unmapped": 4, "mate_unmapped": 8, "reverse": 16, "read1": 64, "read2": 128, "secondary": 256, "qc_fail": 512, "duplicate": 1024, "supplementary": 2048}
COVERAGE = (1, 5, 10, 50, 100, 200, 500, 750, 1000)
IUPAC = "NACMGRSVTWYHKDBN"


def has(flag: Column, name: str) -> Column:
    return flag.bitwiseAND(FLAGS[name]) > 0


def reference_counts(alignments: DataFrame) -> DataFrame:
    """(ref, mapped, unmapped)."""
    return alignments.groupBy("ref").agg(F.count_if(~has(F.col("flag"), "unmapped")).alias("mapped"), F.count_if(has(F.col("flag"), "unmapped")).alias("unmapped"))


def flag_counts(alignments: DataFrame, keys: list[str] = ()) -> DataFrame:
    """Total and one count a flag."""
    return alignments.groupBy(*keys).agg(F.count("*").alias("total"), F.count_if(~has(F.col("flag"), "unmapped")).alias("mapped"), *[F.count_if(has(F.col("flag"), n)).alias(n) for n in FLAGS])


def alignment_summary(alignments: DataFrame, keys: list[str]) -> DataFrame:
    """Totals, mapped share, pairs, insert mean and deviation, mean length and quality, MQ0, bases mapped."""
    flag = F.col("flag")
    mapped = ~has(flag, "unmapped")
    insert = F.when(has(flag, "proper_pair") & (F.col("tlen") > 0), F.col("tlen"))
    return alignments.groupBy(*keys).agg(
        F.count("*").alias("reads"), F.count_if(mapped).alias("mapped"), (100 * F.count_if(mapped) / F.count("*")).alias("percent_mapped"), F.count_if(has(flag, "proper_pair")).alias("proper_pairs"),
        F.avg(insert).alias("insert_mean"), F.stddev(insert).alias("insert_sd"), F.avg("length").alias("mean_length"), F.avg("quality").alias("mean_quality"), F.count_if(mapped & (F.col("mapq") == 0)).alias("mq0"), F.sum(F.when(mapped, F.col("length")).otherwise(0)).alias("bases_mapped"),
    )


def read_pairs(alignments: DataFrame, keys: list[str] = ()) -> DataFrame:
    """(keys, read_id, ref, orientation, insert) of alignments (keys, read_id, flag, ref, pos, cigar): names with one primary
    mapped first read and one such second read on the same reference. A hash aggregation by name brings the two together.

    insert: bases from one read's 5' end to the other's, both included. FR: the forward read's 5' end comes first, RF: it comes
    after the reverse read's; TANDEM: both reads point the same way."""
    flag = F.col("flag")
    steps = F.regexp_extract_all("cigar", F.lit(r"(\d+)[MDN=X]"), F.lit(1))
    size = F.aggregate(steps, F.lit(0).cast("long"), lambda total, n: total + n.cast("long"))
    own = alignments.filter(has(flag, "paired") & ~has(flag, "unmapped") & ~has(flag, "secondary") & ~has(flag, "supplementary"))
    five = F.when(has(flag, "reverse"), F.col("pos") + size - 1).otherwise(F.col("pos")).cast("long")
    ends = own.select(*keys, "read_id", has(flag, "read1").alias("first"), has(flag, "read2").alias("second"), F.struct("ref", has(flag, "reverse").alias("reverse"), five.alias("five")).alias("e"))
    end = lambda name: F.max(F.when(F.col(name), F.col("e"))).alias(name[0])
    both = ends.groupBy(*keys, "read_id").agg(F.count_if("first").alias("n1"), F.count_if("second").alias("n2"), end("first"), end("second")).filter("n1 = 1 and n2 = 1 and f.ref = s.ref")
    forward, back = F.when(F.col("f.reverse"), F.col("s.five")).otherwise(F.col("f.five")), F.when(F.col("f.reverse"), F.col("f.five")).otherwise(F.col("s.five"))
    kind = F.when(F.col("f.reverse") == F.col("s.reverse"), "TANDEM").when(forward <= back, "FR").otherwise("RF")
    return both.select(*keys, "read_id", F.col("f.ref").alias("ref"), kind.alias("orientation"), (F.abs(F.col("f.five") - F.col("s.five")) + 1).alias("insert"))


def insert_sizes(pairs: DataFrame, keys: list[str] = ()) -> DataFrame:
    """(keys, orientation, pairs, mean, sd, min, max, median, deviation) of read_pairs(); deviation: the median of the distances
    from the median. All from counts by size, of which there are as many as sizes, however many pairs; a median of an even
    number is the mean of the middle two."""
    by = [*keys, "orientation"]

    def middle(counted: DataFrame, value: str, name: str) -> DataFrame:
        w = Window.partitionBy(*by)
        ranked = counted.withColumn("_up", F.sum("k").over(w.orderBy(value))).withColumn("_n", F.sum("k").over(w))
        at = lambda place: F.min(F.when(F.col("_up") >= place, F.col(value)))
        return ranked.groupBy(*by).agg(((at(F.floor((F.col("_n") + 1) / 2)) + at(F.floor(F.col("_n") / 2) + 1)) / 2).alias(name))

    counted = pairs.groupBy(*by, "insert").agg(F.count("*").alias("k"))
    n, total, squares = F.sum("k"), F.sum(F.col("insert") * F.col("k")), F.sum(F.col("insert").cast("double") * F.col("insert") * F.col("k"))
    spread = F.sqrt(F.greatest(F.lit(0.0), F.try_divide(squares - total * (total / n), n - 1)))
    summed = counted.groupBy(*by).agg(n.alias("pairs"), (total / n).alias("mean"), F.when(n > 1, spread).alias("sd"), F.min("insert").alias("min"), F.max("insert").alias("max"))
    medians = middle(counted, "insert", "median")
    apart = counted.join(medians, by).withColumn("apart", F.abs(F.col("insert") - F.col("median"))).groupBy(*by, "apart").agg(F.sum("k").alias("k"))
    return summed.join(medians, by).join(middle(apart, "apart", "deviation"), by)


def cycle_metrics(reads: DataFrame, keys: list[str] = ()) -> DataFrame:
    """(keys, cycle, base, n, mean_quality) of reads (seq, qual): base distribution and quality by cycle."""
    cycles = reads.select(*keys, F.posexplode(F.split("seq", "")).alias("cycle", "base"), "qual").filter("base <> ''")
    quality = F.ascii(F.substring("qual", F.col("cycle") + 1, F.lit(1))) - 33
    return cycles.groupBy(*keys, "cycle", "base").agg(F.count("*").alias("n"), F.avg(quality).alias("mean_quality"))


def depth_summary(depth: DataFrame, lengths: DataFrame) -> DataFrame:
    """(ref, mean, min, max, median, percent of bases at each COVERAGE step) of covered positions (ref, pos, depth) on
    references (ref, length): positions that are missing have depth 0; depths are counted first."""
    counted = depth.groupBy("ref", "depth").agg(F.count("*").alias("k"))
    covered = counted.groupBy("ref").agg(F.sum("k").alias("c"))
    zero = lengths.join(covered, "ref", "left").select("ref", F.lit(0).cast("long").alias("depth"), (F.col("length") - F.coalesce("c", F.lit(0))).alias("k")).filter("k > 0")
    rows = counted.join(lengths, "ref", "left_semi").select("ref", F.col("depth").cast("long").alias("depth"), "k").unionAll(zero).groupBy("ref", "depth").agg(F.sum("k").alias("k"))
    w = Window.partitionBy("ref")
    ranked = rows.withColumn("up", F.sum("k").over(w.orderBy("depth"))).withColumn("n", F.sum("k").over(w))
    at = lambda place: F.min(F.when(F.col("up") >= place, F.col("depth")))
    shares = [(100 * F.sum(F.when(F.col("depth") >= c, F.col("k")).otherwise(0)) / F.max("n")).alias(f"x{c}") for c in COVERAGE]
    middle = (at(F.floor((F.col("n") + 1) / 2)) + at(F.floor(F.col("n") / 2) + 1)) / 2
    return ranked.groupBy("ref").agg((F.sum(F.col("depth") * F.col("k")) / F.max("n")).alias("mean"), F.min("depth").alias("min"), F.max("depth").alias("max"), middle.alias("median"), *shares)


def mark_duplicates(alignments: DataFrame, keys: list[str], quality: str, ties: list[str]) -> DataFrame:
    """alignments with duplicate: not the read of the highest quality among those with the same keys (reference, 5' position,
    strand, mate)."""
    w = Window.partitionBy(*keys).orderBy(F.desc(quality), *ties)
    return alignments.withColumn("duplicate", F.row_number().over(w) > 1)


def aligned_bases(alignments: DataFrame) -> DataFrame:
    """(ref, pos, kind) of each base of alignments (ref, pos 1-based, cigar, seq): A, C, G, T or other at its place; del at
    each deleted place; ins at the place before an insertion."""
    parts = F.regexp_extract_all("cigar", F.lit(r"(\d+)([MIDNSHP=X])"), F.lit(0))
    empty = F.array().cast("array<struct<at:long,from:long,n:long,op:string>>")
    init = F.struct(F.col("pos").cast("long").alias("r"), F.lit(1).cast("long").alias("q"), empty.alias("out"))

    def step(acc, part):
        op, n = F.right(part, F.lit(1)), F.regexp_extract(part, r"^(\d+)", 1).cast("long")
        on_ref, on_read = op.isin("M", "=", "X", "D", "N"), op.isin("M", "=", "X", "I", "S")
        return F.struct(
            F.when(on_ref, acc["r"] + n).otherwise(acc["r"]).alias("r"), F.when(on_read, acc["q"] + n).otherwise(acc["q"]).alias("q"),
            F.concat(acc["out"], F.array(F.struct(acc["r"].alias("at"), acc["q"].alias("from"), n.alias("n"), op.alias("op")))).alias("out"),
        )

    blocks = alignments.filter(~has(F.col("flag"), "unmapped")).select("ref", "seq", F.explode(F.aggregate(parts, init, step, lambda a: a["out"])).alias("b"))
    steps = F.when(F.col("b.op") == "I", F.array(F.lit(0).cast("long"))).otherwise(F.sequence(F.lit(0).cast("long"), F.col("b.n") - 1))
    rows = blocks.filter("b.op in ('M', '=', 'X', 'D', 'I')").select("ref", "seq", "b", F.explode(steps).alias("i"))
    base = F.upper(F.substring("seq", (F.col("b.from") + F.col("i")).cast("int"), F.lit(1)))
    kind = F.when(F.col("b.op") == "I", "ins").when(F.col("b.op") == "D", "del").otherwise(base)
    return rows.select("ref", F.when(F.col("b.op") == "I", F.col("b.at") - 1).otherwise(F.col("b.at") + F.col("i")).alias("pos"), kind.alias("kind"))


def alleles(alignments: DataFrame, keys: list[str] = ("ref",)) -> DataFrame:
    """(keys, pos, allele, deleted, quality, reverse) of alignments (keys, pos 1-based, flag, cigar, seq, qual): a letter at each
    aligned place, * at each deleted one, and at the place before an insertion + and the whole inserted string, before a
    deletion - with how many bases it takes out. Letters a-z count as A-Z.

    quality: a letter's own, the mean of an insertion's letters rounded down, for deletions that of the base before; null where
    the read has none (* or no string). Unmapped reads, and reads without a sequence, give no rows. Each part of a read goes
    on by itself, so long reads aren't copied for each of their places."""
    parts = F.regexp_extract_all("cigar", F.lit(r"(\d+)([MIDNSHP=X])"), F.lit(0))
    empty = F.array().cast("array<struct<at:long,from:long,n:long,op:string>>")
    init = F.struct(F.col("pos").cast("long").alias("r"), F.lit(1).cast("long").alias("q"), empty.alias("out"))

    def step(acc, part):
        op, n = F.right(part, F.lit(1)), F.regexp_extract(part, r"^(\d+)", 1).cast("long")
        on_ref, on_read = op.isin("M", "=", "X", "D", "N"), op.isin("M", "=", "X", "I", "S")
        block = F.struct(acc["r"].alias("at"), acc["q"].alias("from"), n.alias("n"), op.alias("op"))
        return F.struct(F.when(on_ref, acc["r"] + n).otherwise(acc["r"]).alias("r"), F.when(on_read, acc["q"] + n).otherwise(acc["q"]).alias("q"), F.concat(acc["out"], F.array(block)).alias("out"))

    upper = F.translate("seq", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ")
    mapped = alignments.filter(~has(F.col("flag"), "unmapped") & F.col("cigar").isNotNull() & F.col("seq").isNotNull())
    reads = mapped.select(*keys, has(F.col("flag"), "reverse").alias("reverse"), upper.alias("seq"), F.when(F.length("qual") == F.length("seq"), F.col("qual")).alias("qual"), F.explode(F.aggregate(parts, init, step, lambda a: a["out"])).alias("b"))
    start, size = F.col("b.from").cast("int"), F.col("b.n").cast("int")
    cut = lambda c: F.when(F.col("b.op") == "D", F.substring(c, start - 1, F.lit(1))).otherwise(F.substring(c, start, size))
    blocks = reads.filter("b.op in ('M', '=', 'X', 'D', 'I') and b.n > 0").select(*keys, "reverse", F.col("b.at").alias("at"), F.col("b.n").alias("n"), F.col("b.op").alias("op"), cut("seq").alias("s"), cut("qual").alias("q"))
    score = lambda c: F.ascii(c) - 33
    letters = F.arrays_zip(F.split("s", "").alias("base"), F.split(F.coalesce("q", F.lit("")), "").alias("q"))
    aligned = blocks.filter("op not in ('I', 'D')").select(*keys, "reverse", "at", F.posexplode(letters).alias("i", "l")).filter("l.base <> ''")
    none = F.lit(None).cast("long")
    out = aligned.select(*keys, (F.col("at") + F.col("i")).alias("pos"), F.col("l.base").alias("allele"), none.alias("deleted"), F.when(F.col("l.q") != "", score(F.col("l.q"))).alias("quality"), "reverse")
    marks = F.filter(F.split("q", ""), lambda x: x != "")
    mean = F.floor(F.try_divide(F.aggregate(marks, F.lit(0), lambda total, x: total + score(x)), F.size(marks))).cast("int")
    inserted = blocks.filter("op = 'I' and s <> ''").select(*keys, (F.col("at") - 1).alias("pos"), F.concat(F.lit("+"), "s").alias("allele"), none.alias("deleted"), mean.alias("quality"), "reverse")
    deleted = blocks.filter("op = 'D'").withColumn("quality", F.when(F.col("q") != "", score(F.col("q"))))
    before = deleted.select(*keys, (F.col("at") - 1).alias("pos"), F.lit("-").alias("allele"), F.col("n").alias("deleted"), "quality", "reverse")
    gone = deleted.select(*keys, F.explode(F.sequence("at", F.col("at") + F.col("n") - 1)).alias("pos"), F.lit("*").alias("allele"), none.alias("deleted"), "quality", "reverse")
    return out.unionAll(inserted).unionAll(before).unionAll(gone)


def count_alleles(found: DataFrame, keys: list[str] = ("ref",), min_quality: int = 20) -> DataFrame:
    """(keys, pos, allele, deleted, dp, rv, quality) of alleles(): reads, reverse ones and the sum of qualities for each allele
    string, from rows of at least min_quality or without one. Reads are counted before the shuffle, so a deep place is a row
    an allele and task."""
    good = found.filter(F.col("quality").isNull() | (F.col("quality") >= min_quality))
    return good.groupBy(*keys, "pos", "allele", "deleted").agg(F.count("*").alias("dp"), F.count_if("reverse").alias("rv"), F.sum("quality").alias("quality"))


def inserted_consensus(counted: DataFrame, keys: list[str] = ("ref",), min_depth: int = 1, insertion: float = 0.1) -> DataFrame:
    """(keys, seq) of count_alleles(): at each place the commonest of A, C, G, T (an IUPAC code for ties, N under min_depth),
    and after it the commonest inserted string, if it has at least that share of the reads there; of equally common ones the
    first in order. Reads with the place deleted count as depth for the share, not for the base."""
    n = lambda allele: F.sum(F.when(F.col("allele") == allele, F.col("dp")).otherwise(0)).alias("gone" if allele == "*" else allele)
    plus = F.col("allele").startswith("+")
    top = F.min(F.when(plus, F.struct((-F.col("dp")).alias("n"), F.expr("substring(allele, 2)").alias("s"))))
    piled = counted.groupBy(*keys, "pos").agg(*[n(b) for b in ("A", "C", "G", "T", "*")], top.alias("top"))
    share = F.try_divide(-F.col("top.n"), depth() + F.col("gone"))
    after = F.when(share >= insertion, F.col("top.s")).otherwise("")
    return sequence(piled.withColumn("base", F.concat(consensus_base(min_depth), F.coalesce(after, F.lit("")))), list(keys))


def pileup(counted: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, A, C, G, T, ins, del) from rows with a kind each. Counted before the shuffle, so deep places are cheap."""
    return counted.groupBy(*keys).agg(*[F.count_if(F.col("kind") == k).alias(k) for k in ("A", "C", "G", "T", "ins", "del")])


def depth(a="A", c="C", g="G", t="T") -> Column:
    return F.col(a) + F.col(c) + F.col(g) + F.col(t)


def entropy() -> Column:
    """Shannon entropy in bits of A, C, G, T, rounded half to even to 3 places; 0 without reads."""
    n = depth()
    part = lambda x: F.when(F.col(x) > 0, -(F.col(x) / n) * F.log2(F.col(x) / n)).otherwise(0.0)
    total = part("A") + part("C") + part("G") + part("T")
    return F.when(n > 0, F.bround(total, 3) + 0.0).otherwise(0.0)


def weighted_entropy(value: Column, k: int = 50) -> Column:
    """An entropy weighted by depth, rounded half to even to 3 places; 0 without reads."""
    return F.when(depth() > 0, F.bround(value * depth() / (depth() + k), 3) + 0.0).otherwise(0.0)


def majority_base(share: float = 0.7) -> Column:
    """The base with at least that share of reads, ties in the order A, C, G, T; else N."""
    top = F.greatest("A", "C", "G", "T")
    base = F.when(F.col("A") == top, "A").when(F.col("C") == top, "C").when(F.col("G") == top, "G").otherwise("T")
    return F.when((depth() > 0) & (top / depth() >= share), base).otherwise("N")


def consensus_base(min_depth: int = 10) -> Column:
    """The commonest base, an IUPAC code for ties, N under the depth."""
    top = F.greatest("A", "C", "G", "T")
    mask = sum((F.when(F.col(b) == top, v).otherwise(0) for b, v in (("A", 1), ("C", 2), ("G", 4), ("T", 8))), F.lit(0))
    return F.when(depth() >= F.greatest(F.lit(min_depth), F.lit(1)), F.substring(F.lit(IUPAC), mask + 1, F.lit(1))).otherwise("N")


def consensus(piled: DataFrame, keys: list[str], min_depth: int = 10) -> DataFrame:
    """(keys, seq) from a pileup with pos."""
    return sequence(piled.withColumn("base", consensus_base(min_depth)), keys)


def contig_consensus(piled: DataFrame, keys: list[str], min_depth: int = 1, insertion: float = 0.1) -> DataFrame:
    """consensus() with + after places where insertions reach the share of reads."""
    mark = F.when((depth() > 0) & (F.col("ins") / depth() >= insertion), "+").otherwise("")
    return sequence(piled.withColumn("base", F.concat(consensus_base(min_depth), mark)), keys)


def first_letters(reads: DataFrame) -> DataFrame:
    """(key, seq) of reads (key, read, seq): at each place the letter of the least read that is long enough. A read gives what
    it is longer than all before it, so a key's reads are scanned by ranges as lengths, and few texts are read."""
    sized = reads.filter("read is not null and seq <> ''").select("key", "read", "seq", F.length("seq").cast("long").alias("n"))
    order = ["read", "n"]
    far = running(dealt(sized.select("key", *order), ["key"], order), ["key"], order, {"_far": ("max", F.col("n"))}, before=True)
    longer = far.withColumn("_far", F.coalesce("_far", F.lit(0))).filter("n > _far").select(F.col("key").alias("_key"), F.col("read").alias("_read"), F.col("n").alias("_n"), F.col("_far").cast("int").alias("_far"))
    texts = sized.join(longer, F.col("key").eqNullSafe(F.col("_key")) & (F.col("read") == F.col("_read")) & (F.col("n") == F.col("_n")))
    one = texts.groupBy("key", "read", "n", "_far").agg(F.min("seq").alias("seq"))
    tails = one.select("key", F.col("_far").alias("pos"), F.substring("seq", F.col("_far") + 1, (F.col("n") - F.col("_far")).cast("int")).alias("base"))
    return sequence(tails, ["key"])


def equal_letters(a: Column, b: Column) -> Column:
    """Places at which two strings of one length have the same letter."""

    @F.pandas_udf("long")
    def run(a: pd.Series, b: pd.Series) -> pd.Series:
        codes = lambda x: np.frombuffer(x.encode("utf-32-le"), dtype=np.uint32)
        return pd.Series([int(np.count_nonzero(codes(x) == codes(y))) for x, y in zip(a, b)], dtype="int64")

    return run(a, b)


def agreeing(reads: DataFrame, current: DataFrame, tenths: int = 1, small: int = 1 << 22) -> DataFrame:
    """(key, read) of reads (key, read, seq), placed from 1, of whose letters at least so many tenths are those of the key's
    current sequence (key, seq). Compared by pieces, so letters aren't shuffled; current sequences of more than small letters
    aren't broadcast either, however little their files and the plan's estimate are."""
    large = (current.agg(F.sum(F.length("seq").cast("long"))).first()[0] or 0) > small
    own = pieces(current, "key").withColumnRenamed("piece", "own")
    both = pieces(reads, "key", "read").join(own.hint("merge") if large else F.broadcast(own), ["key", "block"])
    n = F.least(F.length("piece"), F.length("own"))
    cut = both.withColumn("n", n).select("key", "read", "n", equal_letters(F.substring("piece", F.lit(1), n), F.substring("own", F.lit(1), n)).alias("k"))
    return cut.groupBy("key", "read").agg(F.sum("k").alias("k"), F.sum("n").alias("n")).filter(10 * F.col("k") >= tenths * F.col("n")).select("key", "read")


def piled_reads(reads: DataFrame, kept: DataFrame) -> DataFrame:
    """The pileup of reads (key, read, seq), placed from 1, that are among kept (key, read): places with A, C, G or T."""
    cut = pieces(reads, "key", "read").join(kept, ["key", "read"], "left_semi")
    letters = cut.select("key", "block", F.posexplode(F.split("piece", "")).alias("p", "kind")).filter(F.col("kind").isin("A", "C", "G", "T"))
    return pileup(letters.select("key", (F.col("block").cast("long") * PIECE + F.col("p") + 1).alias("pos"), "kind"), ["key", "pos"])


def refine(align, reference: DataFrame, rounds: int = 3, min_depth: int = 10) -> DataFrame:
    """(key, step, seq) of all rounds: align(reference) gives a pileup (key, pos, A ... del) on the current sequences, whose
    consensus is the next reference; N keeps the reference's base. Steps it1, it2, ..."""
    current, out = stored(reference.select("key", "seq")), None
    for n in range(1, rounds + 1):
        called = align(current).withColumn("base", consensus_base(min_depth)).select("key", "pos", F.when(F.col("base") != "N", F.col("base")).alias("new"))
        # a row a letter, however small its file is: not to be broadcast
        merged = bases(current).join(called.hint("merge"), ["key", "pos"], "left").withColumn("base", F.coalesce("new", "base"))
        current = stored(sequence(merged, ["key"]))
        step = current.select("key", F.lit(f"it{n}").alias("step"), "seq")
        out = step if out is None else out.unionAll(step)
    return out
